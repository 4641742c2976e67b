import hashlib
import random
import re

import pytest
from textloom.llm import decontaminate
from textloom.llm.decontaminate import contamination, drop_contaminated

from .helpers import ODD, docs


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", low) if w]


def brute(rows, items):
    out = []
    for i, t in rows:
        d, hit, ids = words(t), set(), set()
        for item, text in items:
            w = words(text)
            n = min(13, len(w))
            for s in range(len(w) - n + 1 if w else 0):
                for p in range(len(d) - n + 1):
                    if d[p : p + n] == w[s : s + n]:
                        hit |= set(range(p, p + n))
                        if item is not None:
                            ids.add(str(item))
        listed = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((i, len(d), len(hit), len(ids), listed, bool(hit) and 20 * len(hit) >= len(d)))
    return sorted(out, key=repr)


def case():
    rng = random.Random(2)
    vocabulary = ["ab", "Cd", "é", "ef1", "x" * 70, "gh"]
    some = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, " ".join(some(rng.choice([1, 2, 5, 13, 20])))) for k in range(12)]
    items += [(3, items[3][1]), (None, " ".join(some(15))), (50, None), (51, ""), (10, "lonely")]
    rows = []
    for k in range(60):
        text = some(rng.randint(0, 30))
        if k % 3 == 0:
            at = rng.randint(0, len(text))
            text[at:at] = words(rng.choice(items)[1])
        rows.append((k, ", ".join(text)))
    return rows + [(70, "word " * 400 + items[4][1] + " word" * 400)], items


@pytest.mark.parametrize("block,spread,heavy", [(200_000, 1, 1), (7, 1_000_000, 1000), (7, 20, 5)])
def test_against_brute_force(spark, monkeypatch, block, spread, heavy):
    """Broadcast windows, one shuffled join, and several of them with hot tokens."""
    for name, value in (("BLOCK", block), ("SPREAD", spread), ("HEAVY_SHARE", heavy)):
        monkeypatch.setattr(decontaminate, name, value)
    rows, items = case()
    got = contamination(docs(spark, rows + ODD), spark.createDataFrame(items, "item_id bigint, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows + ODD, items)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert contamination(docs(spark, []), none).count() == 0
    assert all(r.n_hit == 0 and not r.contaminated for r in contamination(docs(spark, ODD), none).collect())


def test_drop(spark):
    passage = " ".join(f"p{k}" for k in range(20))
    item = spark.createDataFrame([(1, passage)], "item_id bigint, text string")
    rows = [(1, passage + " and more"), (2, "clean text"), (3, None), (4, "x " * 300 + " ".join(passage.split()[:13])), (2, "clean too")]
    df = docs(spark, rows)
    got = drop_contaminated(df, item)
    assert got.columns == df.columns and sorted(r.doc_id for r in got.collect()) == [2, 2, 3, 4]
    shared = docs(spark, [(1, passage), (1, "clean"), (None, passage), (None, "fine")])
    assert sorted(r.text for r in drop_contaminated(shared, item).collect()) == ["clean", "fine"]
