import math
import re
from collections import defaultdict

import pytest
from textloom.llm import mixing

from .helpers import LONG

SCHEMA = "doc_id bigint, text string, source string, `key` string, `order` bigint, size bigint, cut bigint, taken string, copy int"


def table(spark, rows):
    """rows: (doc_id, text, source); the other columns have the operator's inner names."""
    return spark.createDataFrame([(*r, "k", None, -5, 7, "t", 9) for r in rows], SCHEMA).repartition(3)


def count(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes, weights, share, epochs):
    """Clamp and hand on, source by source."""
    free, out, left = {s for s in sizes if weights.get(s)}, dict.fromkeys(sizes, 0.0), share * sum(sizes.values())
    while free:
        total = sum(weights[s] for s in free)
        over = {s for s in free if left * weights[s] / total > epochs * sizes[s]}
        if not over:
            return out | {s: left * weights[s] / total for s in free}
        for s in over:
            out[s] = epochs * sizes[s]
            left -= out[s]
        free -= over
    return out


ODD = [(1, "alpha beta", "b"), (2, None, "b"), (3, "", None), (4, "one\x0btwo three", None), (5, LONG, "a"), (5, LONG, "a"), (None, "no id", "é"), (None, "no id either here", "é"), (7, "x", "")]


@pytest.mark.parametrize("share, epochs", [(1.5, 2.0), (4.0, 2.0), (1.5, 1.75)])
def test_against_brute_force(spark, share, epochs):
    rows = ODD + [(100 + i, "w " * (i * i % 97), ["a", "b", "c", "é", None, "d"][i % 6 if i % 3 else 0]) for i in range(900)]
    docs = table(spark, rows)
    weights = mixing.cycled_weights(docs, (3, 1, 2))
    order = sorted({r[2] for r in rows if r[2] is not None}) + [None]
    want_weights = {s: (3.0, 1.0, 2.0)[i % 3] for i, s in enumerate(order)}
    assert {r.source: r.weight for r in weights.collect()} == want_weights
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += count(text)
    want = targets(sizes, want_weights, share, epochs)
    got = [r for r in mixing.mixture(docs, weights, share, epochs).collect()]
    again = mixing.mixture(docs.repartition(7), weights, share, epochs).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again)) and len(got) == len(rows)
    source_of = {i: s for i, _, s in rows}
    assert sorted((r.doc_id or -1, r.size) for r in got) == sorted((i or -1, count(t)) for i, t, _ in rows)
    taken = defaultdict(int)
    for r in got:
        s = source_of[r.doc_id]
        assert r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6
        assert 0 <= r.taken <= math.ceil(epochs) * r.size
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2, s
    # Whole documents but for one of each source, and for rows that share an id.
    parts = [r for r in got if r.size and r.taken % r.size]
    assert len({r.doc_id for r in parts}) <= len(sizes)


def test_one_round_clamps_another(spark):
    """What a clamped source leaves over lifts the next above its cap."""
    rows = [(i, "w " * n, s) for i, (s, n) in enumerate([("a", 10), ("b", 60), ("c", 1000), ("d", 5000)])]
    docs = table(spark, rows)
    weights = spark.createDataFrame([("a", 8.0), ("b", 1.0), ("c", 1.0), ("d", 0.0)], "source string, weight double")
    got = {r.doc_id: r.target for r in mixing.mixture(docs, weights, 0.1).collect()}
    want = targets({"a": 10, "b": 60, "c": 1000, "d": 5000}, {"a": 8.0, "b": 1.0, "c": 1.0}, 0.1, 2.0)
    assert got == {i: want[s] for i, s in enumerate("abcd")} and got[0] == 20 and got[1] == 120 and got[3] == 0


def test_ties_share_what_is_missing(spark):
    """A thousand rows of one id (or none) hold the whole source: each gives its part."""
    docs = table(spark, [(None, "a b c d", "hot")] * 1000 + [(5, "x y", "small")])
    weights = spark.createDataFrame([("hot", 1.0), ("small", 0.0)], "source string, weight double")
    got = mixing.mixture(docs, weights, share=0.5).collect()
    assert {r.taken for r in got if r.doc_id is None} == {2} and [r.taken for r in got if r.doc_id == 5] == [0]


def test_texts(spark):
    rows = [(i, f"w{i} x \t y\n", s) for i in range(60) for s in "ab"] + ODD
    docs = table(spark, rows)
    weights = mixing.cycled_weights(docs, (3, 1, 2))
    plan = mixing._mixed(docs, weights, 1.5, 2.0, 13, "doc_id", "text", "source").collect()
    out = mixing.mixed_texts(docs, weights)
    assert out.columns == [*docs.columns, "_copy"]
    want, got = defaultdict(int), defaultdict(int)
    for r in plan:
        want[(r.id, r.key)] += r.taken
    for r in out.collect():
        got[(r.doc_id, "=" + r.source if r.source is not None else "")] += count(r.text)
        assert (r.size, r.taken, r.copy) == (-5, "t", 9)
    assert dict(got) == {k: v for k, v in want.items() if v}


def test_empty_and_wordless(spark):
    weights = spark.createDataFrame([("a", 1.0)], "source string, weight double")
    assert mixing.mixture(table(spark, []), weights).count() == 0
    assert mixing.cycled_weights(table(spark, []), (3, 1, 2)).count() == 0
    (r,) = mixing.mixture(table(spark, [(1, " ", "a")]), weights).collect()
    assert (r.size, r.source_size, r.target, r.taken) == (0, 0, 0.0, 0)


def test_numbers_over_ranges(spark):
    names = [f"s{i:04d}" for i in range(500)] + ["\U0001f642", "￿", "Z", None]
    rows = spark.createDataFrame([(n,) for n in names], "source string").repartition(5)
    got = {r.source: r.number for r in mixing.numbered(rows, "source").collect()}
    order = sorted(n for n in names if n is not None) + [None]
    assert got == {n: i for i, n in enumerate(order)}
