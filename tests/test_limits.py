"""No result is cut off by depth, length, number or script; rules replace whole words only."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F
from textloom.functions import lineage
from textloom.functions import text as T
from textloom.operators import controls as C
from textloom.operators import inventory as I
from textloom.operators import matching as X
from textloom.operators import model as M
from textloom.operators import sampling as P
from textloom.sources import readers as R

TEXT = "key string, en string, origin_en string, fr string, origin_fr string, ns_project string, en_rebuilt string, english string"


def texts(spark, rows):
    return spark.createDataFrame([(k, e, "project", f, "project", "ns", None, e) for k, e, f in rows], TEXT)


def values(spark, c, rows):
    return [r.v for r in spark.createDataFrame([(x,) for x in rows], "a string").select(c.alias("v")).collect()]


def test_folding_knows_all_scripts(spark):
    assert values(spark, T.fold(F.col("a")), ["ガラス", "Ǆ ά ЙЁ", "á\U0001d165", "한국"]) == ["カラス", "ǆ α ие", "a", "한국"]


def test_stems_keep_double_s(spark):
    assert values(spark, T.stem_fr(F.col("a")), ["stress", "Mots", "feux", "os", "été"]) == ["stress", "mot", "feu", "os", "ete"]


def test_reasons(spark):
    got = values(spark, T.readable_reason(F.col("a")), ["lot A-1, verdict x : garder", "fiche du 03/04 : x-1", "réponse du 12/09 à la question q-1 : nom propre", "choix (lot 3) ; lot B-2", None])
    assert got == ["Garder", "", "Nom propre", "Choix", ""]


def test_long_chain_of_families(spark):
    n = 100
    members = spark.createDataFrame([(f"k{i}", "f", "", "{source}s", [f"k{i + 1}"], 1) for i in range(n)], "key string, family string, ident string, template string, sources array<string>, ord int")
    said = spark.createDataFrame([(f"k{n}", "nom")], "key string, fr string")
    none = spark.createDataFrame([], "key string, gender string, number string, proper boolean, plural string")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = {r.key: (r.expected, r.problem) for r in C.family_names(members, said, none).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(got) == n and got["k0"] == ("Nom" + "s" * n, None)


def test_deep_json(spark):
    deep = "x"
    for i in range(60):
        deep = {"a": deep} if i % 2 else [deep, i]
    rows = spark.createDataFrame([(1, json.dumps(deep)), (2, "not json"), (3, '"top"'), (4, '{"b": [], "c": {"d": "e"}}')], "id int, t string")
    got = {(r.id, r.pointer): r.value for r in M.flatten_json(rows, "id", "t").collect()}
    assert got == {(1, "/a/0" * 30): "x", (3, ""): "top", (4, "/c/d"): "e"}
    assert values(spark, M.dotted(F.col("a")), ["/pages/0/text", "/a", "", "/x/1/2"]) == ["pages[0].text", "a", "", "x[1][2]"]


def test_many_arguments(spark):
    args = ["'a:b'"] + [f"'k.x{i}'" for i in range(150)]
    found = spark.createDataFrame([("p", "n", args)], "path string, name string, args array<string>")
    assert R.tooltip_links(found).count() == 150
    typed = spark.createDataFrame([("p", "n", ["'k.t'"] + ["season"] * 150)], "path string, name string, args array<string>")
    assert len(R.argument_types(typed).first().types) == 150


@pytest.mark.parametrize("text", ["{a:[1}]", "[1}", "{a 1}", "{a:}", "{:1}", "{a:1", "a b", "{a:1}}", "{a::1}", "[a:1]", "{a:'x}", "", "{[1]:2}"])
def test_broken_quests(text):
    assert R.snbt_to_json(text) is None


def test_sound_quests():
    for text, want in [('{a: [I; 1 2, 3] "b c":\'x\\\'y\', d:{}}', {"a": ["1", "2", "3"], "b c": "x'y", "d": {}}), ("[]", []), ("5b", "5b"), ("{a:1,,b:[{c:2}]}", {"a": "1", "b": [{"c": "2"}]})]:
        assert json.loads(R.snbt_to_json(text)) == want


def test_spelling_replaces_whole_words(spark):
    forms = spark.createDataFrame([("vert", "rouge", False, "s"), ("Et", "Ou", True, "s"), ("a.b", "$1\\c", False, "s")], "form string, right string, exact boolean, source string")
    said = texts(spark, [("k1", "x", "le vert et le verteau, Vert VERT"), ("k2", "x", "Et etc"), ("k3", "x", "axb a.b")])
    books = spark.createDataFrame([], "key string, en string, fr string")
    got = {r.key: r.expected for r in C.spelling_control(said, books, books, forms).collect()}
    assert got == {"k1": "le rouge et le verteau, Rouge ROUGE", "k2": "Ou etc", "k3": "axb $1\\c"}


def test_case_lowers_whole_words(spark):
    said = texts(spark, [("item.a.b", "x", "Chat de Chat. Chat et Chatte"), ("item.a.c", "x", "Le Mur")])
    got = {r.key: r.expected for r in C.case_control(said, []).collect()}
    assert got == {"item.a.b": "Chat de chat. Chat et chatte", "item.a.c": "Le mur"}


def test_keys_inside_words(spark):
    rng = random.Random(2)
    pick = lambda n: "".join(rng.choice("ab.c") for _ in range(n))
    words = [pick(rng.randint(0, 12)) for _ in range(60)]
    keys = ["", *(pick(rng.randint(1, 7)) for _ in range(80))]
    got = {r.key for r in I.contained_keys(spark.createDataFrame([(k,) for k in keys], "key string"), spark.createDataFrame([(w,) for w in words], "word string")).collect()}
    assert got == {k for k in keys if any(k in w for w in words)}


def test_minority_register(spark):
    rows = [("u", "1", "tu manges"), ("u", "2", "votre main"), ("u", "3", "vous, viens-tu"), ("v", "4", "ton pas"), ("w", "5", "te voir"), ("w", "6", "vos")]
    got = {tuple(r) for r in I.minority_texts(spark.createDataFrame(rows, "unit string, key string, fr string")).collect()}
    assert got == {("u", "formal", "2"), ("u", "formal", "3")}


def test_associations_work_out_grams_once(spark):
    """Counts by brute force; what is left to do after counting reads counts alone, and no text again."""
    en = ["the stone", "a stone wall", "stone", "wall", "the wall of stone"] * 2
    fr = ["la pierre", "un mur de pierre", "pierre", "mur", "pierre et mur"] * 2
    pairs = spark.createDataFrame([(f"k{i}", e, f) for i, (e, f) in enumerate(zip(en, fr))], "key string, en string, fr string")
    out = I.associations(pairs, spark.createDataFrame([("stone",), ("wall",), ("none",)], "term string"), least=4)
    got = {(r.term, r.rendering): (r.both, r.n_term, r.n_rendering) for r in out.collect()}
    assert got == {("stone", "pierre"): (8, 8, 8), ("stone", "mur"): (4, 8, 6), ("wall", "mur"): (6, 6, 6), ("wall", "pierre"): (4, 6, 8)}
    assert "regexp_extract_all" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_renderings(spark):
    assert [r.v for r in spark.range(1).select(F.array_join(I.rendering_words(F.lit("§aThe Iron-door's {x} doors, 3 boxes"), T.stem_en, I.STOP_EN), " ").alias("v")).collect()] == ["the iron-door' door boxe"]
    rows = [(str(i), "red stone", "pierre rouge" if i < 6 else "caillou") for i in range(10)]
    got = [(r["rank"], r.rendering, r.new) for r in I.renderings(spark.createDataFrame(rows, "key string, en string, fr string"), spark.createDataFrame([("stone",)], "term string")).orderBy("rank").collect()]
    assert got == [(1, "pierre rouge", 6), (2, "caillou", 4)]


def test_draw_is_the_order_of_hashes(spark):
    members = [(s, i) for s, n in (("a", 3), ("b", 400), ("c", 5000)) for i in range(n)]
    quota = [("a", 3, 3), ("b", 400, 10), ("c", 5000, 700)]
    got = {tuple(r) for r in P.draw(spark.createDataFrame(members, "stratum string, id int"), spark.createDataFrame(quota, "stratum string, size bigint, quota bigint"), "seed").collect()}
    want = set()
    for s, n, q in quota:
        order = sorted(range(n), key=lambda i: (hashlib.sha1(f"seed|{i}".encode()).hexdigest(), i))
        want |= {(s, i) for i in order[:q]}
    assert got == want


@pytest.mark.parametrize("most", [0, 1000])
def test_citations_against_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(X, "BROADCAST_NAMES", most)
    rng = random.Random(7)
    names = [tuple(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(8)]
    rows = [(k, [rng.choice("abcd") for _ in range(rng.randint(0, 30))]) for k in range(40)]
    want = set()
    for k, ws in rows:
        at = 0
        while at < len(ws):
            fit = [n for n in names if tuple(ws[at : at + len(n)]) == n]
            if fit:
                best = max(fit, key=len)
                want.add((k, at, len(best), best))
            at += len(best) if fit else 1
    got = {(r.key, r.pos, r.len, tuple(r.motif)) for r in X.citations(spark.createDataFrame(rows, "key int, ws array<string>"), spark.createDataFrame([(list(n),) for n in names], "motif array<string>")).collect()}
    assert got == want


def test_rules_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(lineage, "MOST_RULES", 3)
    assert lineage.rules(spark.range(3), "x").count() == 3
    with pytest.raises(ValueError, match="over 3 rules"):
        lineage.rules(spark.range(4), "x")


def test_jars_go_to_python_in_small_batches(spark, tmp_path):
    import io
    import zipfile

    def jar(**files):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for name, data in files.items():
                z.writestr(name, data)
        return out.getvalue()

    for i in range(6):
        inner = jar(**{f"assets/in{i}/lang/fr_fr.json": '{"k": "v"}'})
        (tmp_path / f"m{i}.jar").write_bytes(jar(**{f"assets/ns{i}/lang/en_us.json": '﻿{"a": "b", "n": 1} // x', "lib/in.jar": inner, "other.txt": "x"}))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = {(r.jar, r.ns, r.locale, r.key, r.value) for r in R.jar_langs(spark, str(tmp_path), batch=1).collect()}
    assert got == {x for i in range(6) for x in ((f"m{i}", f"ns{i}", "en_us", "a", "b"), (f"m{i}", f"in{i}", "fr_fr", "k", "v"))}
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
