"""Dictionary matching over token n-grams: leftmost-longest, without overlaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.lineage import listed, stage

#: Names up to this many rows are joined as a broadcast table; a larger dictionary is joined by a shuffle on the n-gram.
BROADCAST_NAMES = 200_000


def hits(texts: DataFrame, names: DataFrame, around: int = 0, keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, pos, len, motif) of every place where a name's words stand, overlaps included. texts: key, ws; names: motif (arrays).

    A text's words are joined by the first word of a name, each with as many words after it as the longest name has, and the rest is
    compared there; the words of a whole text are never sent along, and no n-gram is materialised. With `around`, so many words before
    each hit come along as `before`, the word after it as `after` (null at the end), and whether the hit is the whole text as `whole`; so do
    the texts' columns in `keep`.
    """
    motifs = names.select("motif").filter(F.size("motif") > 0).distinct()
    motifs = motifs.withColumn("head", F.col("motif")[0])
    n, longest = motifs.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("motif")), F.lit(1))).first()
    if n <= BROADCAST_NAMES:
        motifs = F.broadcast(motifs)
    wide = longest + bool(around)
    at = F.transform("ws", lambda w, i: F.struct(i.alias("pos"), F.slice("ws", i + 1, wide).alias("next"), *earlier(i, around)))
    starts = texts.select("key", *keep, F.explode(at).alias("x")).select("key", *keep, "x.*", F.col("x.next")[0].alias("head"))
    found = starts.join(motifs, "head").filter(F.slice("next", 1, F.size("motif")) == F.col("motif")).withColumn("len", F.size("motif"))
    if not around:
        return found.select("key", "pos", "len", "motif")
    after = F.get("next", F.col("len"))
    return found.select("key", *keep, "pos", "len", "motif", "before", after.alias("after"), ((F.col("pos") == 0) & after.isNull()).alias("whole"))


def earlier(i: Column, n: int) -> list[Column]:
    """The n words before place i of ws, as `before`; none if n is 0."""
    return [F.slice("ws", F.greatest(i - n, F.lit(0)) + 1, F.least(i, F.lit(n))).alias("before")] if n else []


def without_overlaps(found: Column) -> Column:
    """Of an array<struct<pos, less, motif>>, the leftmost hits, the longest first, each starting where the one before has ended.

    less is the length of the motif below zero, so that the natural order of the structs is the order of picking.
    """
    return F.aggregate(
        F.array_sort(found),
        F.struct(F.lit(0).alias("free"), F.slice(found, 1, 0).alias("kept")),
        lambda a, x: F.when(x["pos"] >= a["free"], F.struct((x["pos"] - x["less"]).alias("free"), F.concat(a["kept"], F.array(x)).alias("kept"))).otherwise(a),
        lambda a: a["kept"],
    )


def citations(texts: DataFrame, names: DataFrame) -> DataFrame:
    """(key, pos, len, motif) of the names cited in each text, leftmost-longest. Of the hits of one place, the longest is kept at once;
    those of one text are folded in order."""
    return leftmost_longest(hits(texts, names))


def leftmost_longest(found: DataFrame) -> DataFrame:
    """(key, pos, len, motif) of the hits that a reader from left to right takes."""
    longest = found.groupBy("key", "pos").agg(F.max_by("motif", "len").alias("motif"))
    rows = longest.groupBy("key").agg(F.collect_list(F.struct("pos", (-F.size("motif")).alias("less"), "motif")).alias("found"))
    return rows.select("key", F.explode(without_overlaps(F.col("found"))).alias("x")).select("key", "x.pos", (-F.col("x.less")).alias("len"), "x.motif")


# Words that join names; a light colour, which isn't the colour; and what a block made of another is called by a word of its own.
COORDINATION = ["or", "and"]
LIGHT, LIGHT_COLOURS = "light", ["blue", "gray"]
RENAMED = ["Fence Gate", "Glass Pane", "Window Pane", "Rose Bush"]


def citations_in_context(texts: DataFrame, names: DataFrame) -> DataFrame:
    """citations() as a reader understands them, with the names that a coordination leaves out ("Umbra or Highland Wool": both wools).

    texts: key, ws, name (whether the text is a name itself). A name doesn't cite itself as a whole; a light colour isn't the colour; and
    a block that goes by a word of its own isn't what it is made of. What is left over at such a place may still cite a shorter name.

    After a conjunction, the words before it (two, else one) take the place of the first words of the cited name: the name that keeps the
    most of it and exists is cited as well. These candidates are at most twice as many as the name has words, and looked up by one join.
    """
    renamed = F.array(*(T.words(F.lit(x)) for x in RENAMED))
    found = hits(texts, names, around=3, keep=("name",))
    pale = F.coalesce((F.try_element_at("before", F.lit(-1)) == LIGHT) & F.col("motif")[0].isin(*LIGHT_COLOURS), F.lit(False))
    other = F.coalesce(F.array_contains(renamed, F.array(F.element_at("motif", -1), F.col("after"))), F.lit(False))
    found = stage(found.filter(~(F.col("name") & F.col("whole")) & ~pale & ~other).select("key", "pos", "len", "motif", "before"), "hits")
    cited = leftmost_longest(found)
    joined = found.filter(F.size("before") > 1).filter(F.element_at("before", -1).isin(*COORDINATION)).join(cited, ["key", "pos", "len", "motif"], "left_semi")
    modifier = F.slice("before", 1, F.size("before") - 1)
    last = F.array(F.element_at(modifier, -1))
    tail = lambda k: F.slice("motif", k + 1, F.size("motif"))
    each = F.transform(F.sequence(F.lit(1), F.size("motif") - 1), lambda k: F.array(F.when(F.size(modifier) == 2, F.concat(modifier, tail(k))), F.concat(last, tail(k))))
    tries = joined.filter("len > 1").select("key", "pos", F.posexplode(F.flatten(each)).alias("rank", "motif"))
    known = names.select("motif").distinct()
    meant = tries.join(listed(known), "motif").groupBy("key", "pos").agg(F.min_by("motif", "rank").alias("motif"))
    return cited.unionByName(meant.select("key", "pos", F.size("motif").alias("len"), "motif"))


def common_prefix(groups: DataFrame, by: str, words: str, stop: list[str]) -> DataFrame:
    """(by, prefix, n): the words that all arrays of a group begin with, without stop words at its end.

    Two counts and no list: a prefix is common if it is there as often as the group has rows.
    """
    sized = groups.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    rows = groups.select(by, F.explode(F.transform(F.sequence(F.lit(1), F.size(words)), lambda i: F.slice(words, 1, i))).alias("prefix"))
    shared = rows.groupBy(by, "prefix").agg(F.count(F.lit(1)).alias("m")).join(sized, by).filter("m = n")
    stops = F.array(*(F.lit(s) for s in stop))
    whole = shared.groupBy(by).agg(F.max_by("prefix", F.size("prefix")).alias("prefix"), F.max("n").alias("n"))
    kept = F.size(F.filter("prefix", lambda w: ~F.array_contains(stops, w)))
    last = F.aggregate(
        "prefix",
        F.struct(F.lit(0).alias("i"), F.lit(0).alias("last")),
        lambda a, w: F.struct((a["i"] + 1).alias("i"), F.when(F.array_contains(stops, w), a["last"]).otherwise(a["i"] + 1).alias("last")),
        lambda a: a["last"],
    )
    return whole.filter(kept > 0).select(by, F.slice("prefix", 1, last).alias("prefix"), "n")


def name_families(names: DataFrame, stop_en: list[str], stop_fr: list[str]) -> DataFrame:
    """(ending, prefix, n): endings of two words or more that several names share in English, and how all of them begin in French."""
    rows = names.filter("citable and size(en_tokens) > 2")
    ends = rows.select("key", "fr_tokens", F.explode(F.transform(F.sequence(F.lit(2), F.size("en_tokens") - 1), lambda n: F.slice("en_tokens", F.size("en_tokens") - n + 1, n))).alias("ending"))
    ends = ends.filter(~F.col("ending")[0].isin(*stop_en)).join(names.select(F.col("en_tokens").alias("ending")).distinct(), "ending", "left_anti")
    return common_prefix(ends, "ending", "fr_tokens", stop_fr).filter("n > 1")
