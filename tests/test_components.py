"""Components over all links, and loops that end by themselves."""

import random

from pyspark.sql import functions as F
from textloom.operators import controls as C
from textloom.operators import sampling as P
from textloom.plans.registry import QUERIES


def roots(edges):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(up)}


def test_all_links_count(spark, tmp_path):
    """Line items of any quantity, number and discount link their order and supplier."""
    links = [(o, s) for k in range(12) for o, s in ((k, k), (k + 1, k), (40 + 2 * k, 20 + k))]
    rows = [(o, s, float(k % 50), k % 7, 0.01 * (k % 9)) for k, (o, s) in enumerate(links)]
    spark.createDataFrame(rows, "l_orderkey bigint, l_suppkey bigint, l_quantity double, l_linenumber int, l_discount double").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {r.node: r.root for r in QUERIES["all_connected_components"](spark, str(tmp_path)).collect()}
    assert got == roots([(2 * o, 2 * s + 1) for o, s in links])


def test_hubs_chains_and_loops(spark):
    """A hub with a third of all links, chains, rings, and nodes that are linked with themselves alone."""
    draw = random.Random(7)
    edges = [("hub", f"h{i:04d}") for i in range(600)] + [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(90)] + [(f"r{i}", f"r{(i + 1) % 9}") for i in range(9)] + [("self", "self")]
    edges += [(f"x{draw.randint(0, 900):03d}", f"x{draw.randint(0, 900):03d}") for _ in range(700)]
    draw.shuffle(edges)
    df = spark.createDataFrame(edges + [(None, "h0001")], "a string, b string").repartition(6)
    assert {r.node: r.root for r in P.components(df).collect()} == roots(edges)
    assert P.components(df.limit(0)).count() == 0


def test_chains_of_families_have_no_deepest(spark):
    """A chain of 24: each member's name is made from the one before it."""
    none = spark.createDataFrame([], "key string, gender string, number string, proper boolean, plural string")
    text = "key string, family string, template string, ident string, sources array<string>, gender string, number string, proper boolean, plural string"
    members = [(f"k{i}", "f", "{source}x", f"{i}", [f"k{i - 1}"]) for i in range(1, 25)]
    df = spark.createDataFrame(members, text.split(", gender")[0])
    said = spark.createDataFrame([("k0", "a")], "key string, fr string")
    got = {r.key: (r.expected, r.problem) for r in C.family_names(df, said, none).collect()}
    assert len(got) == 24 and got["k24"][1] is None and got["k24"][0].count("x") == 24


def test_members_of_families_are_worked_out_once(spark):
    """What makes the members, patterns tried on every key, isn't done again for each thing that is asked of them."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def ident(key):
        seen.add(1)
        return key[1:]

    none = spark.createDataFrame([], "key string, gender string, number string, proper boolean, plural string")
    made = spark.createDataFrame([(f"k{i}", "f", "{source}x", [f"k{i - 1}"]) for i in range(1, 5)] + [("k9", "f", "{source}x", ["z"])], "key string, family string, template string, sources array<string>")
    members = made.select("key", "family", "template", ident("key").alias("ident"), "sources")
    names = C.family_names(members, spark.createDataFrame([("k0", "a")], "key string, fr string"), none)
    assert {(r.key, r.expected, r.problem) for r in names.collect()} == {(f"k{i}", "A" + "x" * i, None) for i in range(1, 5)} | {("k9", None, "unknown source")}
    assert seen.value == 5


def test_what_hangs_on_one_node_is_set_aside(spark, monkeypatch):
    """After a round, later ones look only at links that aren't a star's yet, not at every node again."""
    draw = random.Random(3)
    edges = [(100 + o, draw.randint(0, 4) + 20 * (o % 3)) for o in range(200) for _ in range(3)] + [(900, 901), (901, 902), (950, 950)]
    totals, attach = [], P.attach
    monkeypatch.setattr(P, "attach", lambda rows, groups, key, size, total: totals.append(total) or attach(rows, groups, key, size, total))
    want = roots(edges)
    assert {r.node: r.root for r in P.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()} == want
    assert max(totals[2:]) <= len(want)
