import hashlib
import random
import re

from pyspark.sql import functions as F
from textloom.llm import fill_in_middle as fim

from .helpers import ODD, docs

TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def brute(doc_id, text):
    text = text or ""
    units = TOKEN.findall(text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def odd_texts():
    draw = random.Random(3)
    bits = ["a", "Zed", "P", "S", "M", "<", ">", "<P", "S>", "M>", " ", "\n", "é", "ſ", "İ", "中", "🙂", "́", "?", "9", "\x00", "word"]
    return [(i, "".join(draw.choice(bits) for _ in range(draw.randint(0, 60)))) for i in range(1000, 3000)]


def test_against_brute_force(spark):
    rows = ODD + odd_texts() + [(20, "a<P>b"), (21, "x <M>"), (22, "<P <S M>"), (23, "<" * 50), (24, "Pé" * 300_000)]
    got = fim.fill_in_middle(docs(spark, rows))
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    want = sorted(repr((i, *brute(i, t))) for i, t in rows)
    assert sorted(repr(tuple(r)) for r in got.collect()) == want
    forms = {r.form for r in got.select("form").distinct().collect()}
    assert forms == {"plain", "psm", "spm"}


def test_round_trip(spark):
    """A document that ends or begins like a sentinel is still taken apart where it was put together."""
    rows = odd_texts() + [(5000 + i, t) for i in range(40) for t in ("<P", "P>", "<<S", "a<M", ">", "S><")]
    got = fim.fill_in_middle(docs(spark, rows)).select("doc_id", fim.restored(F.col("output"), F.col("form")).alias("text"))
    assert sorted((r.doc_id, r.text) for r in got.collect()) == sorted(rows)
    r = fim.digests(docs(spark, [(1, "Ab, c")])).first()
    assert r.restored_sha256 == hashlib.sha256(b"Ab, c").hexdigest()


def test_only_changes_and_sentinels_are_events():
    assert len(list(fim.automaton().iter(" " + "a" * 1000 + " " * 1000 + " "))) == 2
    starts, ends, found = fim.events("ab, <S>x")
    assert (starts.tolist(), ends.tolist(), found) == ([0, 5, 7], [2, 6, 8], True)
    units = fim.Units("ab, cd")
    assert [units.end(k) for k in range(units.n + 1)] == [0, 2, 3, 4, 6]


def test_share_of_forms(spark):
    rows = [(i, "some words here") for i in range(3000)]
    n = {r.form: r["count"] for r in fim.fill_in_middle(docs(spark, rows)).groupBy("form").count().collect()}
    assert abs(n["plain"] / 3000 - 0.1) < 0.02 and abs(n["spm"] / 3000 - 0.18) < 0.02
    other = fim.fill_in_middle(docs(spark, rows), plain=0, suffix_first=100).groupBy("form").count().collect()
    assert [(r.form, r["count"]) for r in other] == [("spm", 3000)]


def test_empty(spark):
    assert fim.digests(docs(spark, [])).count() == 0
