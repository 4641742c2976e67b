import math
import random
import re
import zlib

import numpy as np
import pytest
from textloom.llm import toxicity
from textloom.llm.toxicity import drop_toxic

from .helpers import LONG, docs


def corpus():
    rng = random.Random(5)
    clean = ["".join(rng.choice(["ra", "lo", "mi", "te", "su", "no"]) for _ in range(rng.randint(1, 4))) for _ in range(300)]
    bad = ["vilefool", "dumbfool", "vilescum"]
    rows, labels = [], []
    for i in range(600):
        words = [rng.choice(clean) for _ in range(rng.randint(5, 150))]
        toxic = int(i % 4 == 0)
        for _ in range(toxic * max(1, len(words) // 15)):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return rows, labels


def test_held_out_accuracy_and_misspellings(spark):
    rows, labels = corpus()
    extra = [(9000, None), (9001, ""), (9002, LONG), (9003, "you vilefoool"), (9004, "dumbfol and vilescumm"), (None, "no id")]
    known = spark.createDataFrame(labels + [(1, 1, 1), (2, 1, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs(spark, rows + extra), known).collect()}
    assert len(got) == len(rows) + len(extra)
    assert all(r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    held = [(got[i].predicted, t) for i, _, t in labels if got[i].held_out]
    assert sum(p == t for p, t in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    assert got[9003].predicted == 1 and got[9004].predicted == 1
    assert got[9000].score == got[9001].score < 0.3
    kept = drop_toxic(docs(spark, rows + extra), known)
    assert kept.columns == docs(spark, []).columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.predicted}


def test_without_labels(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = toxicity.toxicity(docs(spark, [(1, "some text"), (1, "some text"), (2, None)]), none).collect()
    assert [r.predicted for r in got] == [0, 0, 0]
    assert toxicity.toxicity(docs(spark, []), none).count() == 0


def test_features_stay_within_words():
    ids, counts = toxicity.features("Abc, abc abd!")
    assert len(counts) == 2 and counts.sum() == len(ids)  # a repeated word counts once
    one, _ = toxicity.features("abc")
    assert list(ids[: counts[0]]) == list(one)


# --- the score, by plain loops over spans, words and n-grams ------------------------------------------------------------------


def bucket(gram):
    h, mask = 0, (1 << 64) - 1
    for c in gram:
        h = (h * 1099511628211 + c + len(gram)) & mask
    h ^= h >> 29
    return ((h * 0xBF58476D1CE4E5B9 & mask) >> 40) % toxicity.BUCKETS


def brute_score(slim, text):
    weight, bias, a, b = slim
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", low) if w]
    words = [w for k, w in enumerate(words) if k == 0 or w != words[k - 1]]
    starts = list(range(0, max(1, len(words) - 16 + 1), 8))
    if len(words) > 16 and starts[-1] != len(words) - 16:
        starts.append(len(words) - 16)
    best = -math.inf
    for s in starts:
        total = n = 0
        for w in words[s : s + 16]:
            marked = b" " + w.encode() + b" "
            for size in (3, 4, 5, 6):
                for k in range(len(marked) - size + 1):
                    total += weight[bucket(marked[k : k + size])]
                    n += 1
        best = max(best, total / max(120, n) + bias)
    return 1 / (1 + math.exp(-max(-30, min(30, a * best + b))))


@pytest.mark.parametrize("seed", range(5))
def test_scores_against_brute_force(seed):
    rng = random.Random(seed)
    slim = (np.random.default_rng(seed).normal(0, 3, toxicity.BUCKETS), -1.0, 1.3, 0.2)
    texts = [None, "", "?!", "a", "ab é", "x" * 500, "same same same", LONG[:2000]]
    texts += [" ".join("".join(rng.choice("abcdé中Z9") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(1, 90))) for _ in range(20)]
    for t in texts:
        assert abs(toxicity.score_one(slim, t) - brute_score(slim, t)) < 1e-9


def test_ties_and_clashing_columns(spark):
    """Equal texts score alike wherever they stand; columns named like the operator's own stay as they are."""
    rows, labels = corpus()
    same = [(7000 + k, rows[4][1]) for k in range(5)] + [(7000, rows[4][1])]
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    table = docs(spark, rows + same).withColumnRenamed("words", "toxic")
    got = [r.score for r in toxicity.toxicity(table, known).collect() if r.doc_id >= 7000]
    assert len(got) == 6 and len(set(got)) == 1
    kept = drop_toxic(table, known)
    assert kept.columns == table.columns and {r.toxic for r in kept.collect()} == {"w"}
