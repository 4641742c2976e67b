"""Readers, writers and the incremental refresh."""

import json
import zipfile

import pytest
from pyspark.sql import functions as F
from textloom.operators import model as M
from textloom.sources import readers as R
from textloom.sources import writers as W
from textloom.streaming.refresh import last_by_event_time, refresh

from .test_controls import ENTRY


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_lang_files(spark, tmp_path):
    put(tmp_path / "assets/a/lang/en_us.json", '﻿{"k": "v", "n": 3, "o": {"x": 1}, "k": "w"}')
    put(tmp_path / "assets/a/lang/fr_fr.json", '{"k": "é" // said\n}')
    put(tmp_path / "assets/a/lang/notes.json", '{"k": "no locale"}')
    put(tmp_path / "assets/b/lang/en_us.json", "{broken")
    files = R.whole_texts(spark, str(tmp_path))
    got = {(r.ns, r.locale, r.key, r.value) for r in R.lang_files(files, "project", tolerant=True).collect()}
    assert ("a", "en_us", "k", "w") in got and ("a", "fr_fr", "k", "é") in got and not any(r[0] == "b" for r in got)
    assert {r.file.rsplit("/", 3)[1] for r in R.unreadable(files, tolerant=True).collect()} == {"b"}


def test_jars(spark, tmp_path):
    inner = tmp_path / "inner.jar"
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("assets/in/lang/fr_fr.json", json.dumps({"k": "dedans"}))
    (tmp_path / "jars").mkdir()
    with zipfile.ZipFile(tmp_path / "jars/mod.jar", "w") as z:
        z.writestr("assets/out/lang/en_us.json", json.dumps({"k": "outside"}))
        z.write(inner, "META-INF/inner.jar")
    got = {(r.jar, r.ns, r.locale, r.value) for r in R.jar_langs(spark, str(tmp_path / "jars")).collect()}
    assert got == {("mod", "out", "en_us", "outside"), ("mod", "in", "fr_fr", "dedans")}


def test_books(spark):
    en = {"name": "Fish", "icon": "a:fish, b:net", "pages": [{"type": "text", "text": "One"}, {"text ": "Two", "item": "a:rod"}, {"nested": {"title": "Deep"}}]}
    fr = {"name": "Poisson", "pages": [{"text": "Un"}]}
    rows = lambda d: spark.createDataFrame([("b.json", json.dumps(d))], "file string, text string")
    pairs = {r.key: (r.en, r.fr) for r in R.paired_books(R.books(rows(en)), R.books(rows(fr))).collect()}
    assert pairs == {"b.json#/name": ("Fish", "Poisson"), "b.json#/pages/0/text": ("One", "Un"), "b.json#/pages/1/text ": ("Two", ""), "b.json#/pages/2/nested/title": ("Deep", "")}
    (o,) = R.book_objects(rows(en)).collect()
    assert o.objects == ["a:fish", "a:rod", "b:net"]


def test_quests(spark):
    snbt = """{ group: "g" order_index: 2 quests: [ { id: "00AB" title: "{quests.a.title}" description: ["{quests.a.d1}" "x"] icon: "a:fish" dependencies: ["0001"] invisible: true
      tasks: [ { id: "7" title: "{quests.a.t}" item: "a:rod" type: "item" } ] } ] extra: [I; 1, 2] n: -3.5d }"""
    q = R.quests(spark.createDataFrame([("c1", snbt), ("c2", "{broken"), ("c3", '{ quests: [ {id: "1"} ] }')], "chapter string, snbt string"))
    rows = {r.id: r for r in q.collect()}
    r = rows["questAB"]
    assert (r.place, r.hidden, r.dependencies, r["keys"]) == (2, True, ["quest1"], ["quests.a.title", "quests.a.d1"])
    assert rows["quest1"].place == 999
    tips = spark.createDataFrame([("tip.a", "a:x")], "key string, object_id string")
    fields = spark.createDataFrame([("b#/name", ["a:fish"])], "key string, objects array<string>")
    got = {tuple(x) for x in R.text_links(q, tips, fields).collect()}
    assert got == {("quests.a.t", "a:rod"), ("quests.a.title", "a:fish"), ("quests.a.d1", "a:fish"), ("tip.a", "a:x"), ("b#/name", "a:fish")}
    assert {r.group: [c.place for c in r.chapters] for r in R.quest_tree(q).collect()} == {"g": [2], None: [999]}


def parsed(df):
    """How often a plan goes to Python."""
    return df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython")


def test_quests_are_parsed_once_and_by_all_tasks(spark):
    rows = spark.createDataFrame([(f"c{i}", f'{{ group: "g" quests: [ {{ id: "{i}" title: "{{t.k{i}}}" icon: "a:b" tasks: [ {{ title: "{{t.n}}" item: "a:c" }} ] }} ] }}') for i in range(1, 21)], "chapter string, snbt string").coalesce(1)
    q = R.quests(rows)
    assert parsed(q) == 1 and q.rdd.getNumPartitions() >= 8
    assert {r.id for r in q.collect()} == {f"quest{i}" for i in range(1, 21)}


def test_links_of_a_quest_come_from_one_look(spark):
    rows = spark.createDataFrame([("c", '{ quests: [ { id: "1" title: "{k.a} {k.b}" tasks: [ { title: "{k.t}" item: "a:c" }, { title: "none" item: "a:d" }, { title: "{k.u}" } ] }, { id: "2" title: "{k.c}" icon: "a:b" } ] }')], "chapter string, snbt string")
    links = R.text_links(R.quests(rows), spark.createDataFrame([], "key string, object_id string"), spark.createDataFrame([], "key string, objects array<string>"))
    assert parsed(links) == 1
    assert {tuple(r) for r in links.collect()} == {("k.t", "a:c"), ("k.c", "a:b")}


def test_named_tags():
    ok = {"{a: 1b, b: [I; 1 2] c: 'x\\'y' d: \"\\\\\"} ": {"a": "1b", "b": ["1", "2"], "c": "x'y", "d": "\\"}, "[ B;1, {}]": ["1", {}], ",word": "word", "{[a: 1}": None, "{a: 1, a: 2}": {"a": "2"}, "": None, "{a 1}": None}
    assert {k: json.loads(v) if (v := R.snbt_to_json(k)) is not None else None for k in ok} == ok
    assert [R.snbt_to_json(x) for x in ("{a:: 1}", "{a: 1]", "{a: }", "{a}", "{} {}", "]", ":", "{a: 1;}", '{a: "x}', "[a: 1]", "[1", "{a: 1} x")] == [None] * 12


def test_scripts(spark):
    source = """// tip("a:no", "no.key")
    tip(["a:one", 'b:two'], "some.key", [f(1, "x"), g("other.key")]) /* tip("a:no") */
    say("tpl.key", player.getName(), "season" + n) ; s = "not // a comment"
    e.create("my:red_apple") e.create('my:stone_wall', 'block')
    Text.of('Hard coded')"""
    scripts = spark.createDataFrame([("a.js", source)], "path string, source string")
    calls = R.calls(scripts, ["tip", "say"])
    links = {r.key: r.objects for r in R.tooltip_links(calls.filter("name = 'tip'")).collect()}
    assert links == {"some.key": ["a:one", "b:two"], "other.key": ["a:one", "b:two"]}
    (t,) = R.argument_types(calls.filter("name = 'say'")).collect()
    assert (t.key, t.types) == ("tpl.key", [["object"], ["season"]])
    from textloom.operators.inventory import hardcoded, registrations

    known = spark.createDataFrame([("block.my.stone_wall",)], "key string")
    assert [tuple(r) for r in registrations(scripts, known).collect()] == [("item.my.red_apple", "Red Apple")]
    assert [(r.line, r.text) for r in hardcoded(scripts).collect()] == [(5, "Hard coded")]


def test_small_sources(spark):
    lines = ["[wood]", '"mod:oak" = true', "ash = false", "[leaves]", "pine = true", "[entries]", "late = true"]
    toml = spark.createDataFrame([("f", i, t) for i, t in enumerate(lines)], "file string, n int, text string")
    assert {r.essence for r in R.essences(toml).collect()} == {"wood.mod.oak", "leaves.pine"}
    trades = spark.createDataFrame([("s", "a:x", False), ("s", "a:y", True), ("t", "a:x", False)], "shop string, item string, has_nbt boolean")
    assert [r.id for r in R.sold_items(trades).collect()] == ["a:x"]
    glossary = spark.createDataFrame([("Jar", "Bocal", "food", 1), ("Jar", "Pot", None, 2)], "en string, fr string, sense string, ord int")
    assert R.glossary_entries(glossary).first().fr == "Pot"
    with pytest.raises(ValueError, match="trades: rows that break {'priced': 1}"):
        R.checked(trades, {"priced": ~F.col("has_nbt")}, "trades")


def test_snapshot_and_packets(spark, tmp_path):
    e = spark.createDataFrame([("project", "", "a", "fr_fr", "k", "v", 1)], ENTRY)
    W.write_snapshot(e, str(tmp_path / "s"), 3, complete=False)
    assert R.read_snapshot(spark, str(tmp_path / "s"), 3, complete=False).first().value == "v"
    with pytest.raises(ValueError):
        R.read_snapshot(spark, str(tmp_path / "s"), 3)
    texts = spark.createDataFrame([("z", f"{i:02}", "e", "f") for i in range(5)], "zone string, id string, en string, fr string")
    rows = W.packets(texts, "F1", 2)
    assert rows.columns == ["zone", "packet", "id", "fr"] and {(r.packet, r.id) for r in rows.collect()} == {(1, "00"), (1, "01"), (2, "02"), (2, "03"), (3, "04")}
    with pytest.raises(ValueError):
        W.packets(texts, "judge", 2)
    glossary = spark.createDataFrame([("b|c", "x", None, "o", "why"), ("A", "y", "s", "o", None)], "en string, fr string, sense string, origin string, reason string")
    lines = [r.line for r in W.glossary_markdown(glossary).orderBy("place").collect()]
    assert lines[0].startswith("## o") and lines[1] == "| A | y | s |  |" and lines[2] == "| b\\|c | x |  | Why |"


def test_refresh_touches_only_new_namespaces(spark, tmp_path):
    src, store, ckpt = (str(tmp_path / x) for x in ("src", "store", "ckpt"))
    batches = [[("project", "", "a", "fr_fr", "k1", "v1", 1), ("jar", "j", "b", "en_us", "k2", "v2", 2)], [("project", "", "b", "fr_fr", "k2", "v3", 3)]]
    done = []
    for rows in batches:
        done += rows
        df = spark.createDataFrame(rows, ENTRY)
        df.coalesce(1).write.mode("append").parquet(src)
        got = refresh(spark, src, df.schema, store, ckpt)
        want = M.key_index(spark.createDataFrame(done, ENTRY))
        key = lambda d: sorted(repr(r) for r in d.select("id", "en", "origin", "present_pack", "present_mods").collect())
        assert key(got) == key(want)
    assert key(refresh(spark, src, df.schema, store, ckpt)) == key(want)  # nothing new


def test_stream_of_decisions(spark, tmp_path):
    from datetime import datetime

    rows = [("a", datetime(2024, 1, 1, 0, 0), "x"), ("a", datetime(2024, 1, 1, 0, 5), "y"), ("b", datetime(2024, 1, 1), "z")]
    spark.createDataFrame(rows, "k string, ts timestamp, v string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, ts timestamp, v string").parquet(str(tmp_path / "in"))
    q = last_by_event_time(stream, "k", "ts", "v").writeStream.outputMode("complete").format("memory").queryName("latest").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    q.awaitTermination()
    assert {tuple(r) for r in spark.table("latest").collect()} == {("a", "y"), ("b", "z")}
