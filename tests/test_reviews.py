"""Sampling, packing, components, change sets and the pipeline's sequential parts against plain Python."""

import random

import pytest
from textloom.operators import changes as K
from textloom.operators import inventory as I
from textloom.operators import sampling as P
from textloom.operators import search as S


def test_quotas(spark):
    rng = random.Random(1)
    for n in (30, 57, 80):
        sizes = {f"z{k}": rng.randint(1, 40) for k in range(9)}
        got = {r.stratum: r.quota for r in P.quotas(spark.createDataFrame(list(sizes.items()), "stratum string, size bigint"), max(n, sum(min(5, s) for s in sizes.values()))).collect()}
        total = max(n, sum(min(5, s) for s in sizes.values()))
        assert sum(got.values()) == total and all(min(5, sizes[z]) <= q <= sizes[z] for z, q in got.items())
        base = {z: min(5, s) for z, s in sizes.items()}
        rest, room = total - sum(base.values()), sum(sizes.values()) - sum(base.values())
        whole = {z: base[z] + rest * (sizes[z] - base[z]) // room for z in sizes}
        for z in sorted(sizes, key=lambda z: (-(rest * (sizes[z] - base[z]) % room), z))[: total - sum(whole.values())]:
            whole[z] += 1
        assert got == whole
    with pytest.raises(ValueError):
        P.quotas(spark.createDataFrame([("z", 3)], "stratum string, size bigint"), 4)


def test_packing(spark):
    rng = random.Random(2)
    blocks = [(t, f"b{k:02}", rng.choice([3, 8, 20, 60, 130])) for t in ("x", "y") for k in range(30)]
    got = P.pack(spark.createDataFrame(blocks, "theme string, block string, size bigint"), cap=100, tolerance=10).collect()
    assert sorted((r.theme, r.block, r.size) for r in got) == sorted(blocks)
    zones = {}
    for r in got:
        zones.setdefault(r.zone, []).append(r)
    for rs in zones.values():
        assert sum(r.size for r in rs) <= 110 or any(r.size > 100 for r in rs)
        assert len({r.theme for r in rs}) == 1


def test_components(spark):
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(60)] + [(rng.randint(100, 160), rng.randint(100, 160)) for _ in range(30)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in P.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in list(parent)}


def test_completion(spark):
    members = spark.createDataFrame([("z1", "a"), ("z2", "b"), ("z2", "gone")], "zone string, id string")
    inventory = spark.createDataFrame([("a", "u1", "t"), ("b", "u2", "t"), ("c", "u9", "s"), ("d", "u2", "t"), ("e", "u8", "t"), ("f", "u7", "new")], "id string, unit string, theme string")
    links = spark.createDataFrame([("a", "c")], "a string, b string")
    got = {r.id: (r.zone, r.how) for r in P.complete(members, inventory, links).collect()}
    assert got == {"a": ("z1", "kept"), "b": ("z2", "kept"), "c": ("z1", "family"), "d": ("z2", "unit"), "e": ("z1", "theme"), "f": ("new", "new")}


def test_plan(spark):
    a = [(1, 1, "correction", "k1", "old", "new"), (1, 2, "correction", "k2", "old", "new"), (1, 3, "correction", "k3", "x", "y"), (1, 4, "correction", "k4", "old", "new"), (1, 5, "correction", "k5", "a", "b"), (1, 6, "correction", "k5", "a", "c"), (1, 7, "correction", "out", "a", "b"), (1, 8, "trace", "k1", "wrong", None), (1, 9, "correction", "none", "a", "b"), (1, 10, "correction", "k6", "old", "new")]
    actions = spark.createDataFrame(a, "lot int, i int, type string, key string, before string, after string")
    perimeter = actions.filter("key != 'out'").select("lot", "key").distinct()
    defs = spark.createDataFrame([("k1", "f1", "old", "project"), ("k1", "f2", "old", "project"), ("k2", "f1", "new", "project"), ("k3", "f1", "z", "project"), ("k4", "f0", "old", "vanilla"), ("k5", "f1", "a", "project"), ("k6", "own", "old", "jar")], "key string, file string, value string, layer string")
    got = {r.i: (r.verdict, r.why, r.files) for r in K.plan_lot(actions, perimeter, defs).collect()}
    assert got[1] == ("apply", "", ["f1", "f2"]) and got[2] == ("done", "", []) and got[10] == ("apply", "", ["own"])
    assert {i: got[i][1] for i in (3, 4, 5, 6, 7, 8, 9)} == {3: "text has changed", 4: "text of the base game", 5: "key corrected twice", 6: "key corrected twice", 7: "outside the perimeter", 8: "quoted text isn't the key's", 9: "unknown key"}


def test_packet_of_groups(spark):
    rows = spark.createDataFrame([("a", 3), ("b", 4), ("c", 9), ("d", 1)], "key string, n int")
    assert [(r.key, r.taken) for r in K.first_packet(rows, 10).orderBy("key").collect()] == [("a", 3), ("b", 4)]
    assert [(r.key, r.taken) for r in K.first_packet(rows.filter("key = 'c'"), 5).collect()] == [("c", 5)]


def test_batches_have_context(spark):
    rows = spark.createDataFrame([("u", f"{k:03}") for k in range(25)], "unit string, key string")
    got = {r.batch: (list(r["keys"]), list(r.context)) for r in I.batches(rows, 10, 3).collect()}
    assert got[0][1] == [] and got[1][1] == ["007", "008", "009"] and got[2] == (["020", "021", "022", "023", "024"], ["017", "018", "019"])


def test_greedy_covers(spark):
    rows = [("t", "a", k) for k in range(6)] + [("t", "b", k) for k in range(4, 9)] + [("t", "c", 0)]
    got = [(r["rank"], r.rendering, r.new) for r in I.covers(spark.createDataFrame(rows, "term string, rendering string, key bigint")).orderBy("rank").collect()]
    assert got == [(1, "a", 6), (2, "b", 3)]


def test_search(spark):
    index = spark.createDataFrame([("1", "a", "item.x", "Water", "pack", {"fr_fr": "Été", "ko_kr": "물"}, ["fr_fr"], ["ko_kr"]), ("2", "b", "item.y", None, "none", {}, [], ["fr_fr"])], "id string, ns string, key string, en string, origin string, translations map<string,string>, present_pack array<string>, present_mods array<string>")
    f = S.folded_index(index)
    ids = lambda **k: [r.id for r in S.search(f, **k).collect()]
    assert ids(q="ete") == ["1"] and ids(q="물") == [] and ids(q="물", field="all") == ["1"] and ids(q="ITEM.Y", field="key") == ["2"]
    assert ids(present=["fr_fr"], scope="pack") == ["1"] and ids(present=["fr_fr"], absent=["ko_kr"]) == ["2"]
    assert S.whole_number("0", 5) == 0 and S.whole_number("x", 5) == 5 and S.whole_number(-1, 5) == 5
    decisions = spark.createDataFrame([("item.x", 1, "kept", None, None)], "key string, seq int, type string, fr string, file string")
    glossary = spark.createDataFrame([("Water", "Eau"), ("Wat", "No")], "en string, fr string")
    marks = spark.createDataFrame([("1", "look")], "id string, note string")
    r = {x.id: x for x in S.detail(index, decisions, glossary, marks).collect()}["1"]
    assert [(t.en, t.fr) for t in r.terms] == [("Water", "Eau")] and r.mark == "look" and not r.uncertain
    queue = spark.createDataFrame([("1", "a", "item.x", "old"), ("2", "b", "item.y", "old")], "id string, ns string, key string, note string")
    again = S.mark(queue, spark.createDataFrame([("1", "a", "item.x", "new")], queue.schema))
    assert {(x.id, x.note) for x in again.collect()} == {("1", "new"), ("2", "old")}
    gone = spark.createDataFrame([("1", None, None), (None, "b", "item.y")], "id string, ns string, key string")
    assert S.unmark(queue, gone).count() == 0
