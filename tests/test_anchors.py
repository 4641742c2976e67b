"""Rules looked up by their words against rules tried on every text."""

import random

import pytest
from pyspark.sql import functions as F
from textloom.functions import lineage
from textloom.operators import anchors
from textloom.operators import controls as C

TEXTS = "key string, en string, origin_en string, fr string, origin_fr string, ns_project string, en_rebuilt string, english string"
ALPHABET = ["Iron", "iron", "ſword", "SWORD", "İron", "ıron", "fer-blanc", "l'eau", "Ender", "éclat", "ÉCLAT", "éclat", "x1", "_a", "Straße", "the"]


def project(spark, rows):
    return spark.createDataFrame([(k, en, "project", fr, "project", "project", None, en) for k, en, fr in rows], TEXTS).repartition(3)


def none(spark):
    return spark.createDataFrame([], "key string, en string, fr string")


def found(df):
    return sorted(repr(r) for r in df.collect())


def corpus(draw):
    line = lambda: " ".join(draw.choice(ALPHABET) for _ in range(draw.randint(1, 8))).replace(" the ", draw.choice([", the; ", " the-", "’the "]))
    return [(f"text.{i}", line(), line()) for i in range(150)]


def test_spelling(spark, monkeypatch):
    draw = random.Random(2)
    texts = project(spark, corpus(draw))
    forms = {" ".join(draw.choice(ALPHABET) for _ in range(draw.randint(1, 3))) for _ in range(120)} | {"-", "(the)", "the-", "absent word"}
    forms = spark.createDataFrame([(f, f"r{i}", i % 2 == 0, "s") for i, f in enumerate(sorted(forms))], "form string, right string, exact boolean, source string")
    want = found(C.spelling_control(texts, none(spark), none(spark), forms))
    monkeypatch.setattr(anchors, "FEW", 3)
    assert found(C.spelling_control(texts, none(spark), none(spark), forms)) == want and len(want) > 100


def test_terms_and_senses(spark, monkeypatch):
    draw = random.Random(3)
    texts = project(spark, corpus(draw))
    english = sorted({" ".join(draw.choice(ALPHABET) for _ in range(draw.randint(1, 2))) for _ in range(60)} | {"iron|sword", "sw.rd", "iron(?= the)"})
    terms = spark.createDataFrame([(e, [draw.choice(ALPHABET)], draw.choice(["all", "texts"]), draw.choice([None, "[02468]$"]), [draw.choice(ALPHABET)], "r", i) for i, e in enumerate(english)], "english string, french array<string>, scope string, keys string, banned array<string>, reason string, ord int")
    double = spark.createDataFrame([(e, ["éclat", "eclat"][:1]) for e in english], "english string, right array<string>")
    words = spark.createDataFrame([("eclat", "éclat")], "folded string, form string")
    judge = lambda: found(C.term_control(texts, none(spark), terms)) + found(C.accent_control(texts, none(spark), none(spark), words, double))
    want = judge()
    monkeypatch.setattr(anchors, "FEW", 3)
    assert judge() == want and len(want) > 100
    monkeypatch.setattr(lineage, "MOST_RULES", 2)
    with pytest.raises(ValueError, match="terms"):
        C.term_control(texts, none(spark), terms).count()


def test_a_hundred_thousand_rules(spark):
    """Far more rules than may be tried on each text; a third of the texts holds one of the words."""
    forms = spark.range(100_000).select(F.concat(F.lit("mot"), F.col("id").cast("string"), F.lit(" commun")).alias("form"), F.lit("juste").alias("right"), F.lit(False).alias("exact"), F.lit("s").alias("source"))
    rows = spark.range(3000).select(F.concat(F.lit("text."), F.col("id").cast("string")).alias("key"), F.when(F.col("id") % 3 == 0, F.concat(F.lit("un Mot"), (F.col("id") * 7).cast("string"), F.lit(" commun"))).otherwise("commun mot7").alias("fr"))
    texts = rows.select("key", F.lit("x").alias("en"), F.lit("project").alias("origin_en"), "fr", F.lit("project").alias("origin_fr"), F.lit("project").alias("ns_project"), F.lit(None).cast("string").alias("en_rebuilt"), F.lit("x").alias("english"))
    got = C.spelling_control(texts, none(spark), none(spark), forms)
    assert got.count() == 1000 and {r.expected for r in got.select("expected").distinct().collect()} == {"un Juste"}


def test_families(spark, monkeypatch):
    draw = random.Random(6)
    keys = [f"{draw.choice(['block', 'item'])}.{draw.choice(['m', 'n'])}.{draw.choice(['oak', 'iron', 'a_b'])}{draw.choice(['', '_planks', '_slab', '_x.y'])}" for _ in range(300)] + ["block.m._planks", "", "oak"]
    patterns = ["block.m.{id}_planks", "block.m.{id}", "{id}.n.oak", "item.{id}.oak", "block.n.oak_slab", "{id}", "block.{id}.{id}_slab", "item.n.{id}k", "block.m.{id}_planks"]
    df = spark.createDataFrame([(k,) for k in set(keys)], "key string")
    families = spark.createDataFrame([(f"f{i}", p, "t", ["s"], i) for i, p in enumerate(patterns)], "family string, pattern string, template string, sources array<string>, ord int")
    want = found(C.family_members(df, families))
    monkeypatch.setattr(anchors, "FEW", 2)
    assert found(C.family_members(df, families)) == want and len(want) > 10
    many = spark.range(60_000).select(F.col("id").cast("string").alias("family"), F.concat(F.lit("block.m.{id}_"), F.col("id").cast("string")).alias("pattern"), F.lit("t").alias("template"), F.array(F.lit("s")).alias("sources"), F.col("id").cast("int").alias("ord"))
    held = spark.range(2000).select(F.concat(F.lit("block.m.oak_"), (F.col("id") * 3).cast("string")).alias("key"))
    got = C.family_members(held, many).select("key", "family", "ident").collect()
    assert len(got) == 2000 and {r.ident for r in got} == {"oak"} and all(r.key == f"block.m.oak_{r.family}" for r in got)


def test_widths_by_key_and_by_pattern(spark):
    texts = project(spark, [("text.a", "ab", "abcdefgh"), ("text.b", "ab", "abcdefgh"), ("text.c", "ab", "ab")])
    limits = [(None, ["text.a", "text.b"], None, 12, None, "cut", "m", "p", 3), ("text.a", ["text.a"], "^text", 20, None, "scroll", "m", "q", 2), ("text.c", None, None, 100, None, "cut", "m", "r", 1)]
    limits = spark.createDataFrame(limits, "key string, keys array<string>, pattern string, limit int, lines int, behaviour string, mod string, proof string, ord int")
    got = C.width_control(texts, spark.createDataFrame([], "id string"), limits).collect()
    assert sorted((r.key, r.status, r.proof) for r in got) == [("text.a", "blocking", "m: p"), ("text.b", "blocking", "m: p")]
