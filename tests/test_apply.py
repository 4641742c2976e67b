import json

import pytest
from pyspark.sql import functions as F
from textloom.operators import apply as A
from textloom.sources.commits import Commits, Conflict

FR = "assets/own/lang/fr_fr.json"
FILES = [
    (FR, json.dumps({"b.key": "Vieux", "a.key": "Autre", "n": 5})),
    ("assets/second/lang/fr_fr.json", json.dumps({"b.key": "Vieux aussi"})),
    ("assets/own/lang/en_us.json", json.dumps({"b.key": "Old"})),
    ("books/guide/fr_fr/entries/x.json", json.dumps({"name": "Fiche", "pages": [{"text": "Une page"}, "seconde"]})),
    ("journal/fr_fr.markdown", "# Un\n"),
]
OTHERS = [("jar", "j1", "mod", "fr_fr", "jar.key", "Officiel", 1), ("vanilla", "", "base", "fr_fr", "base.key", "Jeu", 1), ("jar", "j0", "early", "en_us", "jar.key", "Official", 1)]
FIELDS = [c.split()[0] for c in A.ACTION.split(", ")]


def store(spark, path):
    s = A.project(spark, str(path / "store"))
    s.commit("start", {"files": spark.createDataFrame(FILES, "file string, text string")})
    return s


def run(spark, s, lot, actions, perimeter=None, apply=True):
    rows = [tuple({"lot": lot, "i": i, "reason": "r"}.get(c) if c not in a else a[c] for c in FIELDS) for i, a in enumerate(actions)]
    df = spark.createDataFrame(rows, A.ACTION)
    inside = spark.createDataFrame([(k,) for k in perimeter or {a.get("key") for a in actions}], "key string")
    others = spark.createDataFrame(OTHERS, "layer string, jar string, ns string, locale string, key string, value string, ord int")
    planned = A.apply_lot(s, lot, df, inside, others, "2026-01-01") if apply else A.plan(s, df, inside, others)
    return {r.i: (r.verdict, r.why) for r in planned.actions.collect()}


def fix(key, before, after, **more):
    return {"type": "correction", "key": key, "before": before, "after": after, **more}


def texts(s):
    return {r.file: r.text for r in s.read("files").collect()}


def test_every_kind_of_text(spark, tmp_path):
    s = store(spark, tmp_path)
    lot = [
        fix("b.key", "Vieux aussi", "Neuf"),
        fix("jar.key", "Officiel", "Le nôtre"),
        fix("new.key", None, "Créé", space="third"),
        fix("guide/entries/x.json#/pages/0/text", "Une page", "Une \"belle\" page"),
        fix("journal", "# Un\n", "# Deux\n"),
        {"type": "trace", "key": "a.key", "after": "Autre"},
        {"type": "exception", "key": "b.key", "control": "codes"},
        {"type": "exception", "key": "b.key", "control": "terms", "object": ["x"]},
        {"type": "generic", "word": "pierre"},
        {"type": "followup", "key": "a.key", "control": "codes"},
    ]
    assert {v for v, _ in run(spark, s, "l1", lot).values()} == {"apply"}
    got = texts(s)
    assert got[FR] == json.dumps({"a.key": "Autre", "b.key": "Neuf", "n": 5}, indent=2) + "\n"
    assert json.loads(got["assets/second/lang/fr_fr.json"]) == {"b.key": "Neuf"}
    # The first namespace of a jar that has the key, in any language.
    assert json.loads(got["assets/early/lang/fr_fr.json"]) == {"jar.key": "Le nôtre"}
    assert json.loads(got["assets/third/lang/fr_fr.json"]) == {"new.key": "Créé"}
    assert got["books/guide/fr_fr/entries/x.json"] == json.dumps({"name": "Fiche", "pages": [{"text": "Une \"belle\" page"}, "seconde"]}, indent=4) + "\n"
    assert got["journal/fr_fr.markdown"] == "# Deux\n" and got["assets/own/lang/en_us.json"] == FILES[2][1]
    decided = {(r.key, r.seq, r.type, r.fr) for r in s.read("decisions").collect()}
    assert decided == {("b.key", 1, "correction", "Neuf"), ("jar.key", 1, "correction", "Le nôtre"), ("new.key", 1, "correction", "Créé"), ("journal", 1, "correction", "# Deux\n"), ("a.key", 1, "decision", "Autre"), (lot[3]["key"], 1, "correction", lot[3]["after"])}
    prints = {(r.control, tuple(r.object)): r.fingerprint for r in s.read("exceptions").collect()}
    assert prints[("terms", ("x",))] is None and len(prints[("codes", ())]) == 12
    assert [tuple(r) for r in s.read("generic").collect()] == [("pierre", "r")] and s.read("followups").count() == 1
    # The same lot again changes nothing, and neither does the same work under another name.
    version = s.version()
    assert set(run(spark, s, "l1", lot).values()) == {("done", "")} and s.version() == version
    assert {v for v, _ in run(spark, s, "l2", [a for a in lot if a["type"] != "trace"], apply=False).values()} == {"done"}
    gone = run(spark, s, "l3", [{"type": "removal", "key": "b.key", "control": "terms", "object": ["x"]}])
    assert gone == {0: ("apply", "")} and {tuple(r.object) for r in s.read("exceptions").collect()} == {()}
    s.compact()
    assert texts(s) == got and s.read("exceptions").count() == 1 and len(s.manifest()["parts"]) == 1


def test_one_refusal_stops_all(spark, tmp_path):
    s = store(spark, tmp_path)
    pinned = spark.createDataFrame([("codes", "a.key", [], "r", None, None, "d", True)], A.TABLES["exceptions"][0])
    s.commit("pins", {"exceptions": pinned})
    got = run(
        spark,
        s,
        "l1",
        [
            fix("b.key", "Vieux", "Neuf"),  # what is shown is the last namespace's text
            fix("b.key", "Vieux aussi", "Neuf"),
            fix("base.key", "Jeu", "Partie"),
            fix("nowhere", None, "x"),
            fix("guide/entries/x.json#/pages/7/text", "a", "b"),
            fix("outside", "a", "b"),
            {"type": "trace", "key": "a.key", "after": "Faux"},
            {"type": "removal", "key": "a.key", "control": "codes"},
            {"type": "removal", "key": "a.key", "control": "terms"},
            {"type": "dance", "key": "a.key"},
            fix("a.key", "Autre", "Bien"),
        ],
        perimeter={"b.key", "base.key", "nowhere", "guide/entries/x.json#/pages/7/text", "a.key"},
    )
    whys = [got[i][1] for i in range(11)]
    assert whys == ["text has changed", "key corrected twice", "text of the base game", "no namespace to write to", "no text at the pointer", "outside the perimeter", "cites another text than the key will have", "exception is pinned", "no such exception", "unknown type", ""]
    assert texts(s) == dict(FILES) and "l1" not in s.manifest()["done"] and s.read("decisions").count() == 0


def test_a_crash_between_two_tables(spark, tmp_path):
    """The first table is staged, the second fails: readers see the old state whole, and the second run ends the work."""
    s = Commits(spark, str(tmp_path / "c"), {"a": ("k string, v int", ["k"]), "b": ("k string, v int", ["k"])})
    rows = lambda n: spark.createDataFrame([("x", n), ("y", n)], "k string, v int")
    s.commit("one", {"a": rows(1), "b": rows(1)})
    bad = rows(2).withColumn("v", F.when(F.col("k") == "y", F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        s.commit("two", {"a": rows(2), "b": bad})
    see = lambda t: {(r.k, r.v) for r in Commits(spark, str(tmp_path / "c"), s.tables).read(t).collect()}
    assert see("a") == see("b") == {("x", 1), ("y", 1)} and s.manifest()["done"] == ["one"]
    assert s.commit("two", {"a": rows(2), "b": rows(2)}) and not s.commit("two", {"a": rows(3)})
    assert see("a") == see("b") == {("x", 2), ("y", 2)}
    s.commit("three", {}, {"a": spark.createDataFrame([("x",)], "k string")})
    assert see("a") == {("y", 2)} and {(r.k, r.v) for r in s.read("a", 2).collect()} == {("x", 2), ("y", 2)}


def test_two_at_once(spark, tmp_path):
    """A commit that was planned against an older version is told so, and leaves nothing behind that is read."""
    tables = {"a": ("k string, v int", ["k"])}
    late, early = Commits(spark, str(tmp_path / "c"), tables), Commits(spark, str(tmp_path / "c"), tables)
    row = spark.createDataFrame([("x", 1)], "k string, v int")
    early.commit("first", {"a": row})
    late.version = lambda f=late.version, seen=[0]: seen.pop() if seen else f()
    with pytest.raises(Conflict):
        late.commit("second", {"a": row.withColumn("v", F.lit(2))})
    assert late.read("a").collect() == row.collect() and late.manifest()["done"] == ["first"]


def test_language_edits_of_many_keys_take_no_squares(spark):
    from textloom.sources.writers import language_edits

    n = 3000
    text = "{" + ", ".join(f'"k{i:06d}": "v{i}"' for i in range(n)) + ', "n": 3}'
    files = spark.createDataFrame([("a", text), ("b", '{"x": "1", // said\n "y": "2"}'), ("c", "{broken")], "file string, text string")
    edits = spark.range(n).selectExpr("'a' as file", "format_string('k%06d', id * 2) as key", "concat('w', id) as value", "1 as ord")
    more = spark.createDataFrame([("b", "x", "9", 1), ("c", "x", "9", 1), ("new", "q\"", "é", 1), ("new", "q\"", "è", 2)], "file string, key string, value string, ord int")
    out = language_edits(files, edits.unionByName(more))
    assert "map_keys" not in out._jdf.queryExecution().executedPlan().toString()  # a map's keys are looked through one by one
    got = {r.file: r for r in out.collect()}
    want = {f"k{i:06d}": f"v{i}" for i in range(n)} | {f"k{i * 2:06d}": f"w{i}" for i in range(n)} | {"n": 3}
    assert list(json.loads(got["a"].text).items()) == sorted(want.items()) and got["a"].problem is None
    assert (got["b"].problem, got["c"].problem, got["b"].text) == ("holds comments", "unreadable", None)
    assert got["new"].text == '{\n  "q\\"": "è"\n}\n'
