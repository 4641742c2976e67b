"""The rule operators on a tiny invented corpus, and fault injection: every corrupted key has to be reported."""

import random
import re

import pytest
from textloom.operators import controls as C
from textloom.operators import ledger as L
from textloom.operators import matching as X
from textloom.operators import model as M

ENTRY = "layer string, jar string, ns string, locale string, key string, value string, ord bigint"


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [
        ("vanilla", "", "base", "en_us", "block.base.stone", "Stone"), ("vanilla", "", "base", "fr_fr", "block.base.stone", "Roche"),
        ("vanilla", "", "base", "en_us", "block.base.oak_planks", "Oak Planks"), ("vanilla", "", "base", "fr_fr", "block.base.oak_planks", "Planches de chêne"),
        ("jar", "a", "furniture", "en_us", "block.furniture.sofa", "Sofa"), ("jar", "a", "furniture", "fr_fr", "block.furniture.table", "Table"),
        ("jar", "b", "furniture", "en_us", "block.furniture.table", "Table"),
        ("project", "", "village", "en_us", "item.village.red_key", " "), ("project", "", "village", "fr_fr", "item.village.red_key", "Clé rouge"),
        ("project", "", "village", "fr_fr", "block.furniture.sofa", "Canapé"), ("project", "", "furniture", "fr_fr", "block.furniture.sofa", "Sofa"),
        ("project", "", "village", "ko_kr", "item.village.forgotten", "x"), ("project", "", "village", "fr_fr", "_comment", "hidden"),
        ("project", "", "village", "en_us", "dialog.hello", "Hello, take %s 5 Red Keys"), ("project", "", "village", "fr_fr", "dialog.hello", "Bonjour, prenez %s 5 clés bleues"),
        ("project", "", "village", "en_us", "item.village.iron_door", "Iron Door"), ("project", "", "village", "fr_fr", "item.village.iron_door", "Porte en fer"),
        ("project", "", "village", "en_us", "dialog.door", "Open the Iron Door"), ("project", "", "village", "fr_fr", "dialog.door", "Ouvre le portail"),
        ("project", "", "village", "en_us", "dialog.lost", "Lost"), ("project", "", "village", "en_us", "dialog.nothing", ""),
        ("project", "", "village", "en_us", "block.x.oak_slab", "Oak Slab"), ("project", "", "village", "fr_fr", "block.x.oak_slab", "Dalle de chêne"),
        ("project", "", "village", "en_us", "block.x.rock_slab", "Rock Slab"), ("project", "", "village", "fr_fr", "block.x.rock_slab", "Dalle de roche"),
    ]
    entries = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], ENTRY)
    rebuilt = spark.createDataFrame([("item.village.red_key", "Red Key")], "key string, en string")
    books = spark.createDataFrame([("b#/name", "Iron Door", "La porte"), ("b#/text", "Text", "")], "key string, en string, fr string")
    journal = spark.createDataFrame([("journal", "# A\n- b", "# A\n## b")], "key string, en string, fr string")
    return entries, M.effective_text(entries, rebuilt).cache(), books, journal


def found(df):
    return {(r.key, r.status) for r in df.collect()}


def details(df):
    return {r.key: r.detail for r in df.collect()}


def test_merge(corpus):
    entries, texts, *_ = corpus
    rows = {r.key: r for r in texts.collect()}
    assert rows["block.furniture.sofa"].fr == "Canapé" and rows["block.furniture.sofa"].origin_fr == "project"
    assert rows["item.village.red_key"].english == "Red Key" and rows["item.village.red_key"].en == " "
    assert rows["block.base.stone"].origin_fr == "vanilla"
    (d,) = M.duplicate_definitions(entries).collect()
    assert d.key == "block.furniture.sofa" and d.definitions == {"furniture": "Sofa", "village": "Canapé"}
    index = {r.id: r for r in M.key_index(entries).collect()}
    assert index["lang:village:dialog.lost"].origin == "pack" and index["lang:furniture:block.furniture.sofa"].present_pack == ["fr_fr"]


def test_coverage(corpus):
    entries, texts, books, _ = corpus
    got = details(C.coverage(texts, M.witnesses(entries), M.duplicate_definitions(entries), books))
    assert got["dialog.lost"] == "English without French"
    assert got["item.village.forgotten"].startswith("only in witnesses: ko_kr")
    assert got["b#/text"] == "book field without French"
    assert got["dialog.nothing"] == "object without English"
    assert got["block.furniture.sofa"].startswith("defined in several")
    assert "block.base.stone" not in got and "_comment" not in got


def test_codes_and_numbers(corpus, spark):
    _, texts, books, journal = corpus
    assert found(C.code_control(texts, books, journal)) == {("journal", "blocking")}
    pairs = spark.createDataFrame([("k", "%s of 10", "project", "5", "project", "ns", None, "%s of 10")], texts.schema)
    assert details(C.code_control(pairs, books, journal.limit(0)))["k"] == "lost: %s"
    assert details(C.number_control(pairs, books))["k"] == "lost: 10"


def test_conventions(corpus):
    _, texts, books, journal = corpus
    got = {(r.key, r.object[0]) for r in C.convention_control(texts, books, journal, familiar="^village").collect()}
    assert ("dialog.hello", "formal address") in got
    assert ("block.x.oak_slab", "naming") in got and ("block.x.rock_slab", "naming") not in got


def test_terms(corpus, spark):
    _, texts, books, _ = corpus
    terms = spark.createDataFrame([("keys?", ["clé"], "all", None, ["clés bleues"], "r", 1), ("door", ["Porte"], "names", None, [], "r", 2)], "english string, french array<string>, scope string, keys string, banned array<string>, reason string, ord int")
    got = {(r.key, r.detail, r.status) for r in C.term_control(texts, books, terms).collect()}
    assert ("dialog.hello", "forbidden rendering", "blocking") in got
    assert not any(k == "dialog.door" for k, _, _ in got)  # names only


def test_references(corpus, spark):
    _, texts, _, _ = corpus
    names = M.registry(texts)
    none = spark.createDataFrame([], "key string, object_id string")
    pins = spark.createDataFrame([("dialog.door", "item.village.none")], "key string, object string")
    got = {(r.key, r.detail) for r in C.reference_control(texts, names, none, pins).collect()}
    assert ("dialog.door", "displayed name not used") in got and ("dialog.door", "pin not used") in got
    assert ("dialog.hello", "displayed name not used") in got
    assert not any(k == "item.village.iron_door" for k, _ in got)


def test_spelling_accents_case(corpus, spark):
    _, texts, books, journal = corpus
    forms = spark.createDataFrame([("portail", "portique", False, "s"), ("ouvre", "x", True, "s")], "form string, right string, exact boolean, source string")
    (r,) = C.spelling_control(texts, books, journal, forms).collect()
    assert (r.key, r.expected) == ("dialog.door", "Ouvre le portique")
    vocabulary = spark.createDataFrame([("bleues", "bleuès")], "folded string, form string")
    (r,) = C.accent_control(texts, books, journal, vocabulary).collect()
    assert r.expected == "Bonjour, prenez %s 5 clés bleuès"
    fr = spark.createDataFrame([("item.a.b", "x", "project", "Porte En Fer", "project", "a", None, "x"), ("dialog.z", "x", "project", "chez anna", "project", "a", None, "x")], texts.schema)
    got = {(r.key, r.detail) for r in C.case_control(fr, ["Anna"]).collect()}
    assert got == {("item.a.b", "capital inside a name"), ("dialog.z", "proper noun written small")}


def test_templates_and_width(corpus, spark):
    _, texts, *_ = corpus
    rows = [("a", "du %s", [["object"]]), ("b", "en %s", [["season"]]), ("c", "le %s", None), ("d", "%2$s et le %1$s", [["object"], ["other"]]), ("e", "%s", None), ("f", "100%% le %s %s", [["other"], ["object"]])]
    said = spark.createDataFrame([(k, "x", "project", t, "project", "n", None, "x") for k, t, _ in rows], texts.schema)
    arguments = spark.createDataFrame([(k, t) for k, _, t in rows if t], "key string, types array<array<string>>")
    assert found(C.template_control(said, arguments)) == {("a", "blocking"), ("b", "blocking"), ("c", "flagged"), ("d", "blocking")}
    long = spark.createDataFrame([("item.shop.x", "Short", "project", "Un nom de boutique vraiment beaucoup trop long pour deux lignes", "project", "n", None, "Short"), ("gui.y", "A long English text", "jar", "Un texte encore plus long", "jar", "n", None, "A long English text")], texts.schema)
    limits = spark.createDataFrame([(None, ["gui.y"], None, 40, None, "cut off", "m", "p", 1)], "key string, keys array<string>, pattern string, limit int, lines int, behaviour string, mod string, proof string, ord int")
    assert found(C.width_control(long, spark.createDataFrame([("shop:x",)], "id string"), limits)) == {("item.shop.x", "blocking"), ("gui.y", "flagged")}


def test_families(spark):
    families = spark.createDataFrame([("a", "x.a_{id}", "Oeufs de {source}", ["s.{id}"], 1), ("c1", "x.c1_{id}", "{source} un", ["x.c2_{id}"], 2), ("c2", "x.c2_{id}", "{source} deux", ["x.c1_{id}"], 3), ("g", "x.g_{id}", "{source} fumé{e}", ["s.{id}"], 4)], "family string, pattern string, template string, sources array<string>, ord int")
    keys = spark.createDataFrame([("x.a_bee",), ("x.c1_q",), ("x.c2_q",), ("x.g_bee",)], "key string")
    said = spark.createDataFrame([("s.bee", "Abeille")], "key string, fr string")
    none = spark.createDataFrame([], "key string, gender string, number string, proper boolean, plural string")
    got = {r.key: (r.expected, r.problem) for r in C.family_names(C.family_members(keys, families), said, none).collect()}
    assert got == {"x.a_bee": ("Oeufs d'abeille", None), "x.g_bee": (None, "unknown gender"), "x.c1_q": (None, "source has no expected name"), "x.c2_q": (None, "source has no expected name")}


def test_leftmost_longest(spark):
    rng = random.Random(3)
    texts = [(str(k), [rng.choice("abcd") for _ in range(40)]) for k in range(40)]
    names = [["a"], ["a", "b"], ["a", "b", "c"], ["b", "c", "d"], ["d", "d"]]
    got = {}
    for r in X.citations(spark.createDataFrame(texts, "key string, ws array<string>"), spark.createDataFrame([(n,) for n in names], "motif array<string>")).collect():
        got.setdefault(r.key, []).append((r.pos, r.motif))
    for key, ws in texts:
        want, i = [], 0
        while i < len(ws):
            best = max((n for n in names if ws[i : i + len(n)] == n), key=len, default=None)
            if best:
                want.append((i, best))
            i += len(best) if best else 1
        assert sorted(got.get(key, [])) == want


def test_ledger(spark):
    find = spark.createDataFrame([("c", "k1", "blocking", "", "", "d", "", []), ("c", "k2", "flagged", "", "", "d", "", ["o"]), ("c", "k3", "flagged", "", "", "d", "", []), ("c", "k4", "blocking", "", "", "d", "", [])], "control string, key string, status string, actual string, expected string, detail string, proof string, object array<string>")
    exc = spark.createDataFrame([("c", "k1", [], "why", False, None, None, 1), ("c", "k2", ["other"], "why", False, None, None, 2), ("c", "k4", [], "why", False, "stale", None, 3), ("c", "k3", [], " ", False, None, None, 4)], "control string, key string, object array<string>, reason string, pin boolean, fingerprint string, question string, ord int")
    import hashlib

    debt = spark.createDataFrame([("c", "k2", ["o"], hashlib.sha1(b"two").hexdigest()[:12]), ("c", "k3", [], "old"), ("c", "k9", [], "x")], "control string, key string, object array<string>, fingerprint string")
    vals = spark.createDataFrame([("k2", "two"), ("k3", "three")], "key string, value string")
    r = L.reconcile(find, exc, debt, vals).cache()
    assert {x.key: (x.bucket, x.escalated) for x in r.collect()} == {"k1": ("covered", False), "k2": ("debt", False), "k3": ("blocking", True), "k4": ("blocking", False)}
    assert {x.ord for x in L.orphan_exceptions(exc, r, ["c"]).collect()} == {2, 3}
    assert {x.key for x in L.resolved_debt(debt, r, ["c"]).collect()} == {"k9"}
    assert L.exit_code(r, exc) == 1


def test_injected_faults_are_all_found(spark):
    """At least 100 faults of each kind, by a fixed seed."""
    rng = random.Random(20260928)
    faults = {"codes": lambda t: t.replace("%s", "", 1), "numbers": lambda t: t.replace("12", "13", 1), "apostrophe": lambda t: t.replace("'", "’", 1), "ligature": lambda t: t.replace("coeur", "cœur", 1)}
    rows, want = [], {k: set() for k in faults}
    for i in range(600):
        text = f"Prends %s et 12 morceaux du coeur d'or numéro {i}"
        kind = rng.choice([*faults, *faults, None])
        if kind:
            text = faults[kind](text)
            want[kind].add(f"k{i}")
        rows.append((f"k{i}", f"Take %s and 12 pieces of number {i}", "project", text, "project", "ns", None, f"Take %s and 12 pieces of number {i}"))
    texts = spark.createDataFrame(rows, "key string, en string, origin_en string, fr string, origin_fr string, ns_project string, en_rebuilt string, english string")
    none = spark.createDataFrame([], "key string, en string, fr string")
    assert min(map(len, want.values())) >= 100
    assert {r.key for r in C.code_control(texts, none, none).collect()} == want["codes"]
    assert {r.key for r in C.number_control(texts, none).collect()} == want["numbers"]
    rules = {}
    for r in C.convention_control(texts, none, none).collect():
        rules.setdefault(r.object[0], set()).add(r.key)
    assert rules == {"apostrophe": want["apostrophe"], "ligature": want["ligature"]}


def test_titles_sheets_and_family_nouns(spark):
    rows = [("item.a.oak_log", "Oak Log", "Bûche de chêne"), ("item.a.birch_log", "Birch Log", "Bûche de bouleau"), ("item.a.iron_sewing_needle", "Iron Sewing Needle", "Aiguille de couture en fer"), ("item.a.gold_sewing_needle", "Gold Sewing Needle", "Aiguille de couture en or"), ("item.a.fish", "Red Fish", "Poisson rouge")]
    rows += [("quests.q.title", "Any Log", "Un tronc"), ("quests.r.title", "Any Log", "Une bûche"), ("quests.s.d", "Bring a sewing needle", "Apporte une épingle"), ("quests.t.d", "Bring an Iron Sewing Needle", "Apporte une épingle")]
    texts = spark.createDataFrame([(k, e, "project", f, "project", "a", None, e) for k, e, f in rows], "key string, en string, origin_en string, fr string, origin_fr string, ns_project string, en_rebuilt string, english string")
    names = M.registry(texts).cache()
    links = spark.createDataFrame([(k, f"a:{o}") for k in ("quests.q.title", "quests.r.title") for o in ("oak_log", "birch_log")] + [(k, "a:iron_sewing_needle") for k in ("quests.s.d", "quests.t.d")], "key string, object_id string")
    (r,) = C.title_control(texts, names, links).collect()
    assert (r.key, r.expected) == ("quests.q.title", "buch")
    (r,) = C.family_noun_control(texts, names, links).collect()
    assert (r.key, r.expected) == ("quests.s.d", "aiguille de couture")
    books = spark.createDataFrame([("f", "x/fish.json", "/name", "Old name", "Vieux nom", ["a:fish"]), ("g", "y/fish.json", "/name", "The Red Fish", "x", ["a:fish"]), ("h", "z/other.json", "/name", "x", "y", ["a:fish"])], "key string, file string, pointer string, en string, fr string, objects array<string>")
    (r,) = C.sheet_control(books, names).collect()
    assert (r.key, r.expected) == ("f", "Poisson rouge")
    extra = {tuple(r.en_tokens) for r in C.aliases(names).collect()} - {tuple(r.en_tokens) for r in names.collect()}
    assert extra == set()  # all ids have the words of their names, but for the fish, whose one word is no alias


def test_number_gaps_are_worked_out_once(spark):
    from textloom.operators import verify as V

    schema = "key string, en string, origin_en string, fr string, origin_fr string, ns_project string, en_rebuilt string, english string"
    rows = [("a", "Pay 1,234 in 5", "Payez 1 234 en cinq"), ("b", "Pay 12", "Payez"), ("c", "2 of 3", "3 sur 2"), ("d", "1,234", "1,234"), ("e", "none", "rien")]
    texts = spark.createDataFrame([(k, e, "project", f, "project", "ns", None, e) for k, e, f in rows], schema).coalesce(1)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString().count("english separator")
    found = C.number_control(texts, spark.createDataFrame([], "key string, en string, fr string"))
    assert plan(found) == 1 and found.rdd.getNumPartitions() >= 8
    assert {r.key: r.detail for r in found.collect()} == {"b": "lost: 12", "c": "order: 2 3 / 3 2", "d": "english separator: 1,234"}
    judged = V.verify(V.Tables(texts=texts, spark=spark), ["numbers"])
    assert plan(judged) == 0  # the findings are staged
    assert {(r.key, r.bucket) for r in judged.collect()} == {("b", "blocking"), ("c", "blocking"), ("d", "blocking")}


def test_ledgers_are_matched_by_their_keys(spark, monkeypatch):
    """Only findings and texts of keys that ledgers name are shuffled to them, with what comes out of matching all; texts are dealt by key."""
    import hashlib

    from textloom.operators import verify as V

    schema = "key string, en string, origin_en string, fr string, origin_fr string, ns_project string, en_rebuilt string, english string"
    rows = [(f"k{i}", "Pay 12 in 5", "Payez" if i % 2 else "Payez 5 en 12") for i in range(12)]
    said = spark.createDataFrame([(k, e, "project", f, "project", "ns", None, e) for k, e, f in rows], schema)
    prints = {k: hashlib.sha1(f.encode()).hexdigest()[:12] for k, _, f in rows}
    t = V.Tables(texts=said, spark=spark)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    free = V.verify(t, ["numbers"])
    assert {(r.key, r.bucket, r.exception, r.escalated) for r in free.collect()} == {(k, "blocking", None, False) for k in prints}
    t.exceptions = spark.createDataFrame([("numbers", "k1", [], "why", False, None, None, 4), ("numbers", "k1", [], "why", False, None, None, 3), ("numbers", "k2", [], "why", False, "old", None, 5), ("codes", "k3", [], "why", False, None, None, 6)], V.EMPTY["exceptions"])
    t.debt = spark.createDataFrame([("numbers", "k4", [], prints["k4"]), ("numbers", "k5", [], "old"), ("numbers", None, [], "old")], V.EMPTY["debt"])
    few = V.verify(t, ["numbers"])
    assert plan(few).count("LeftAnti") == 1 and plan(few).count("LeftSemi") >= 2
    got = sorted((r.key, r.bucket, r.exception or 0, r.escalated) for r in few.collect())
    assert [g for g in got if g[1:] != ("blocking", 0, False)] == [("k1", "covered", 3, False), ("k4", "debt", 0, False), ("k5", "blocking", 0, True)] and len(got) == 12
    monkeypatch.setattr(V, "MOST_KEYS", 6)
    all_ = V.verify(t, ["numbers"])
    assert "LeftAnti" not in plan(all_) and few.dtypes == all_.dtypes
    assert sorted((r.key, r.bucket, r.exception or 0, r.escalated) for r in all_.collect()) == got
    none = spark.createDataFrame([], "key string, en string, fr string")
    assert "roundrobin" not in C.number_control(said, none)._jdf.queryExecution().executedPlan().toString().lower()


def generated(node):
    """The names of columns beside what is exploded, of every explode in a plan."""
    names = [re.sub(r"#\d+L?", "", node.output().mkString(" "))] if node.nodeName() == "Generate" else []
    below = node.children()
    return names + [x for i in range(below.size()) for x in generated(below.apply(i))]


def test_words_travel_without_their_texts(spark):
    """Words looked up in the vocabulary carry a key and a digest, not the text; texts that share a key are put right one by one."""
    none = spark.createDataFrame([], "key string, en string, fr string")
    schema = "key string, en string, origin_en string, fr string, origin_fr string, ns_project string, en_rebuilt string, english string"
    said = spark.createDataFrame([("text.a", e, "project", f, "project", "ns", None, e) for e, f in (("stone", "Un gateau sale"), ("wall", "gateau, gateau mur"))], schema)
    vocabulary = spark.createDataFrame([("gateau", "gâteau"), ("sale", "sale"), ("mur", "mûr"), ("mur", "mur")], "folded string, form string")
    out = C.accent_control(said, none, none, vocabulary)
    assert sorted((r.expected, r.detail) for r in out.collect()) == [("Un gâteau sale", "gateau -> gâteau"), ("gâteau, gâteau mur", "gateau -> gâteau")]
    assert "fr" not in " ".join(generated(out._jdf.queryExecution().optimizedPlan())).split()
