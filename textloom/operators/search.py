"""Faceted, accent-folded search over a key index, and the review queue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.lineage import rules


def folded_index(index: DataFrame) -> DataFrame:
    """index with the folded columns that searches read; compute once and write or persist it."""
    return (
        index.withColumn("f_key", T.fold(F.col("key")))
        .withColumn("f_en", T.fold(F.coalesce("en", F.lit(""))))
        .withColumn("f_fr", T.fold(F.coalesce(F.col("translations")["fr_fr"], F.lit(""))))
        .withColumn("f_all", F.transform(F.map_values("translations"), T.fold))
    )


def whole_number(value, default: int) -> int:
    """A non-negative whole number, or the default; zero is valid."""
    try:
        number = int(str(value))
    except (TypeError, ValueError):
        return default
    return number if number >= 0 else default


def search(folded: DataFrame, q: str = "", field: str = "default", ns: str | None = None, origin: str | None = None, present: list[str] = (), absent: list[str] = (), scope: str = "all") -> DataFrame:
    """Rows that fit: equalities first, then presence (any of `present`, none of `absent`, in the pack or anywhere), then the text.

    field: key, all (key, English, any translation), or default (English or French).
    """
    rows = folded
    if ns:
        rows = rows.filter(F.col("ns") == ns)
    if origin:
        rows = rows.filter(F.col("origin") == origin)
    here = F.col("present_pack") if scope == "pack" else F.array_union("present_pack", "present_mods")
    if present:
        rows = rows.filter(F.arrays_overlap(here, F.array(*map(F.lit, present))))
    if absent:
        rows = rows.filter(~F.arrays_overlap(here, F.array(*map(F.lit, absent))))
    if q:
        want = T.fold(F.lit(q))
        has = lambda c: F.contains(c, want)
        if field == "key":
            rows = rows.filter(has(F.col("f_key")))
        elif field == "all":
            rows = rows.filter(has(F.col("f_key")) | has(F.col("f_en")) | F.exists("f_all", has))
        else:
            rows = rows.filter(has(F.col("f_en")) | has(F.col("f_fr")))
    return rows


def page(rows: DataFrame, offset=0, limit=50, order=("ns", "key")) -> DataFrame:
    """A page of the rows in a total order."""
    return rows.orderBy(*order).offset(whole_number(offset, 0)).limit(whole_number(limit, 50))


def facets(rows: DataFrame) -> DataFrame:
    """(facet, value, n): how many rows each namespace, origin and locale has."""
    kinds = F.array(
        F.struct(F.lit("ns").alias("facet"), F.array("ns").alias("values")),
        F.struct(F.lit("origin").alias("facet"), F.array("origin").alias("values")),
        F.struct(F.lit("locale").alias("facet"), F.array_union("present_pack", "present_mods").alias("values")),
    )
    return rows.select(F.explode(kinds).alias("x")).select("x.facet", F.explode("x.values").alias("value")).groupBy("facet", "value").agg(F.count(F.lit(1)).alias("n"))


def detail(index: DataFrame, decisions: DataFrame, glossary: DataFrame, marks: DataFrame, most: int = 12) -> DataFrame:
    """index with its decisions in order, its glossary terms (longest first, whole words, `most` at most) and its review mark."""
    rows = index.select("id", "ns", "key", "en")
    told = decisions.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("seq", "type", "fr"))).alias("decisions"), F.bool_or(F.col("file").isNull()).alias("unplaced"))
    owners = index.groupBy("key").agg(F.count_distinct("ns").alias("owners"))
    bounded = F.expr("concat('(?iU)', if(term rlike '(?U)^\\\\w', '\\\\b', ''), '\\\\Q', term, '\\\\E', if(term rlike '(?U)\\\\w$', '\\\\b', ''))")
    met = rows.join(rules(glossary.select(F.col("en").alias("term"), F.col("fr").alias("term_fr")).withColumn("regex", bounded), "glossary"), F.expr("en rlike regex"))
    order = F.struct((-F.length("term")).alias("l"), "term", "term_fr")
    terms = met.groupBy("id").agg(F.slice(F.array_sort(F.collect_set(order)), 1, most).alias("terms"))
    terms = terms.select("id", F.transform("terms", lambda t: F.struct(t["term"].alias("en"), t["term_fr"].alias("fr"))).alias("terms"))
    out = rows.join(told, "key", "left").join(owners, "key").join(terms, "id", "left").join(marks.select("id", F.col("note").alias("mark")), "id", "left")
    return out.withColumn("uncertain", (F.col("owners") > 1) & F.coalesce("unplaced", F.lit(False))).drop("unplaced", "owners")


def health(index: DataFrame, unreadable: DataFrame) -> DataFrame:
    """(item, n): entries, keys, locales and unreadable files."""
    a = index.agg(F.count(F.lit(1)).alias("entries"), F.count_distinct("key").alias("keys"))
    b = index.select(F.explode(F.array_union("present_pack", "present_mods")).alias("l")).agg(F.count_distinct("l").alias("locales"))
    c = unreadable.agg(F.count(F.lit(1)).alias("unreadable"))
    one = a.crossJoin(b).crossJoin(c)  # three single rows
    return one.select(F.explode(F.map_from_arrays(F.array(*map(F.lit, one.columns)), F.array(*(F.col(x) for x in one.columns)))).alias("item", "n"))


def mark(queue: DataFrame, marks: DataFrame) -> DataFrame:
    """The review queue after marks are put: a mark of the same id replaces the one before."""
    return queue.join(marks.select("id"), "id", "left_anti").unionByName(marks)


def unmark(queue: DataFrame, gone: DataFrame) -> DataFrame:
    """The queue without marks of the given id, or, where an id is null, of the given namespace and key."""
    by_name = gone.filter("id is null").select("ns", "key")
    return queue.join(gone.filter("id is not null").select("id"), "id", "left_anti").join(by_name, ["ns", "key"], "left_anti")


def count_matching(rows: DataFrame, patterns: dict[str, str], without: str | None = None, origin: str | None = None, top: int = 8) -> DataFrame:
    """(space, n): the spaces with the most rows whose columns match all patterns, in any case, and not `without`."""
    for c, p in patterns.items():
        rows = rows.filter(F.col(c).rlike(f"(?iU){p}"))
    if without:
        rows = rows.filter(~F.col("fr").rlike(f"(?iU){without}"))
    if origin:
        rows = rows.filter(F.col("origin") == origin)
    return rows.groupBy("space").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "space").limit(top)
