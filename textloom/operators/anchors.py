"""Texts and rules that are matched by pattern, paired by a word that both must hold instead of each with each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lineage import listed, rules, stage

#: So few rules are tried on every text at once; more are looked up by their words. Both ways give the same pairs.
FEW = 200
WORDS = r"(?U)(\w+)"


def folded(c: Column) -> Column:
    """Letters that a pattern without regard to case takes for each other become one: by way of capitals, the dotted one among them."""
    return F.lower(F.replace(F.upper(c), F.lit("\u0130"), F.lit("I")))


def words(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(folded(c), F.lit(WORDS), 1))


def literal(pattern: Column) -> Column:
    """A pattern that is plain words, hyphens and apostrophes; null for any other."""
    return F.when(pattern.rlike(r"(?U)^[\w '’-]*\w[\w '’-]*$"), pattern)


def matched(texts: DataFrame, table: DataFrame, text: str, anchor: Column, fits: Column, what: str) -> DataFrame:
    """The pairs of texts (with a `key`) and rules that fit. anchor: of a rule, words that stand in every text that it fits, as whole words; null
    if none are known, and of such rules there may be MOST_RULES.

    A rule is looked up by the one of its words that the fewest texts have, so the pairs to be tried are few; a rule with a word that no text
    has is out at once. Words travel with keys alone, and only texts that hold an anchor are sent.
    """
    if table.limit(FEW + 1).count() <= FEW:
        return texts.join(F.broadcast(table), fits)
    numbered = stage(table.withColumn("rule_words", F.coalesce(words(anchor), F.array().cast("array<string>"))).withColumn("rule", F.monotonically_increasing_id()), "rules")
    bare = numbered.filter(F.size("rule_words") == 0).drop("rule_words", "rule")
    each = numbered.select("rule", F.size("rule_words").alias("size"), F.explode("rule_words").alias("word"))
    wanted = listed(each.select("word").distinct())
    held = stage(texts.select("key", F.explode(words(F.col(text))).alias("word")).join(wanted, "word", "left_semi").distinct(), "held")
    often = held.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    anchors = each.join(often, "word").groupBy("rule", "size").agg(F.min_by("word", F.struct("n", "word")).alias("word"), F.count(F.lit(1)).alias("found"))
    anchors = stage(anchors.filter("found = size").select("rule", "word"), "anchors")
    pairs = held.join(listed(anchors), "word").select("key", "rule")
    looked_up = texts.join(pairs, "key").join(listed(numbered.drop("rule_words")), "rule").drop("rule").filter(fits)
    return looked_up.unionByName(texts.join(rules(bare, what), fits)) if not bare.isEmpty() else looked_up


def templated(keys: DataFrame, table: DataFrame, pattern: str, hole: str, fits: Column, what: str) -> DataFrame:
    """The pairs of keys (key) and rules whose pattern, a text with a hole in it, fits; as matched(), by what stands before and after the hole.

    A key is cut at the lengths of its own beginnings that are some rule's, and what is left at the ends that rules have: two joins by
    equality. Patterns without a hole or with several are tried on every key, and there may be MOST_RULES of them.
    """
    if table.limit(FEW + 1).count() <= FEW:
        return keys.join(F.broadcast(table), fits)
    parts = F.split(F.col(pattern), f"\\Q{hole}\\E", -1)
    cut = stage(table.withColumn("rule_before", parts[0]).withColumn("rule_after", F.get(parts, F.lit(1))).withColumn("rule_parts", F.size(parts)), "rules")
    inner = ("rule_before", "rule_after", "rule_parts")
    one, other = cut.filter("rule_parts = 2"), cut.filter("rule_parts != 2").drop(*inner)
    cuts = lambda c: F.sequence(F.lit(0), F.length(c))
    begun = keys.select("key", F.explode(F.transform(cuts(F.col("key")), lambda n: F.left("key", n))).alias("rule_before")).join(listed(one.select("rule_before").distinct()), "rule_before", "left_semi")
    rest = begun.select("key", "rule_before", F.expr("substr(key, length(rule_before) + 1)").alias("rest"))
    ended = rest.select("key", "rule_before", F.explode(F.transform(cuts(F.col("rest")), lambda n: F.right("rest", n))).alias("rule_after"))
    pairs = ended.join(listed(one), ["rule_before", "rule_after"]).select("key", *table.columns)
    looked_up = keys.join(pairs, "key").filter(fits)
    return looked_up.unionByName(keys.join(rules(other, what), fits)) if not other.isEmpty() else looked_up
