"""Mixing sources to target weights by capped water-filling, in DataFrame functions only.

Sources share a budget of words by weight; a source may be repeated up to a number of epochs. Rounds of filling find the water level: a
source whose share is above its cap is clamped there, and what it leaves over raises the level for the others, until no share is above.
A round is one sum over the table of sources, and the driver holds the level alone.

A source's target is then so many whole repetitions of all its documents and a rest of words. For the rest, documents are ordered by a
seeded hash of their id and taken whole until the rest is reached; the document at which it is reached gives as many words as are
missing. That place is found from sums of words by leading bits of the hash, level by level, so no source is ever sorted as a whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import attach, fresh, save

WORD = r"[^\x20\x09-\x0D]+"
#: The hash has 60 bits; a level looks at it without so many of its last ones. Each level is 1/1024 of the one before, the last one whole.
SHIFTS = (50, 40, 30, 0)
SEED = 13


def size_of(text: Column) -> Column:
    """The number of words."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def key_of(source: Column) -> Column:
    """A source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def order_of(ident: Column, seed: int) -> Column:
    """The seeded hash by which documents are drawn: the first 15 hex digits of SHA-256, a number below 2^60."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(named, 256), 1, 15), 16, 10).cast("bigint")


def numbered(rows: DataFrame, by: str) -> DataFrame:
    """rows with `number`: from 0 on, by code points of the column, null last. Ranges are counted, and numbered each for itself."""
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(ranges, F.col(by).asc_nulls_last()).withColumn("range", F.spark_partition_id())
    dealt = save(dealt, "ranges")
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("range").agg(F.count(F.lit(1)).alias("rows"))
    before = counts.select("range", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy(F.col(by).asc_nulls_last()))
    return dealt.join(F.broadcast(before), "range").select(*rows.columns, (inside - 1 + F.col("before")).alias("number"))


def cycled_weights(docs: DataFrame, weights: Sequence[float], source_col: str = "source") -> DataFrame:
    """source, weight: the weights in turn, repeating, over the sources by code point, null last."""
    sources = numbered(docs.select(F.col(source_col).cast("string").alias("source")).distinct(), "source")
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    return sources.select("source", F.element_at(cycle, (F.col("number") % len(weights) + 1).cast("int")).alias("weight"))


def water_level(sources: DataFrame, budget: float) -> float:
    """The level at which min(cap, level * weight) sums up to the budget. sources: cap and weight, both doubles, a row a source.

    Sources of weight zero take nothing. If all caps together are below the budget, every source with a weight ends at its cap.
    """
    above = F.lit(False)
    level, clamped = 0.0, -1
    while True:
        r = sources.agg(
            F.coalesce(F.sum(F.when(above, F.col("cap"))), F.lit(0.0)).alias("cap"),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)).alias("weight"),
            F.count(F.when(above, 1)).alias("clamped"),
        ).first()
        if r.clamped <= clamped or not r.weight:
            return level
        level, clamped = (budget - r.cap) / r.weight, r.clamped
        above = F.col("cap") < F.lit(level) * F.col("weight")


def _targets(facts: DataFrame, weights: DataFrame, share: float, epochs: float) -> DataFrame:
    """A row a source: key, n_docs, source_size, target, whole (repetitions of all its documents), need (words beyond these)."""
    sums = facts.groupBy("key").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    weighed = weights.groupBy(key_of(F.col("source")).alias("key")).agg(F.max(F.col("weight").cast("double")).alias("weight"))
    sources = sums.join(weighed, "key", "left").select(
        "key", "n_docs", "source_size", (F.col("source_size") * F.lit(epochs)).alias("cap"), F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)).alias("weight")
    )
    sources = save(sources, "sources")
    budget = share * float(sources.agg(F.sum("source_size")).first()[0] or 0)
    target = F.least(F.col("cap"), F.lit(water_level(sources, budget)) * F.col("weight"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("bigint")
    need = F.floor(F.col("target") - F.col("whole") * F.col("source_size") + F.lit(0.5)).cast("bigint")
    return sources.withColumn("target", target).withColumn("whole", whole).withColumn("need", need).drop("cap", "weight")


def _cuts(facts: DataFrame, targets: DataFrame) -> DataFrame:
    """A row a source with a need: key, cut (the hash at which it is reached), rest (words that hash still has to give), tied (words it has)."""
    needs = targets.filter("need > 0").select("key", "need")
    rows = facts.filter("size > 0").select("key", "order", "size")
    for shift in SHIFTS:
        part = F.shiftright("order", shift)
        sums = rows.groupBy("key", part.alias("part")).agg(F.sum("size").alias("words")).join(needs, "key")
        upto = F.sum("words").over(Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, 0))
        at = save(sums.withColumn("upto", upto).filter("upto >= need and upto - words < need"), "cut")
        needs = at.select("key", (F.col("need") - F.col("upto") + F.col("words")).alias("need"))
        if shift:
            rows = save(rows.withColumn("part", part).join(at.select("key", "part"), ["key", "part"]).drop("part"), "near-cut")
    return at.select("key", F.col("part").alias("cut"), (F.col("need") - F.col("upto") + F.col("words")).alias("rest"), F.col("words").alias("tied"))


def _taken() -> Column:
    """The words that a document gives: rows that share the hash of the cut (the same id) share what it has to give."""
    shared = F.floor(F.col("rest").cast("double") * F.col("size") / F.col("tied"))
    extra = F.when(F.col("order") < F.col("cut"), F.col("size")).when(F.col("order") == F.col("cut"), shared).otherwise(F.lit(0))
    return (F.col("whole") * F.col("size") + extra).cast("bigint")


def _mixed(docs: DataFrame, weights: DataFrame, share: float, epochs: float, seed: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """id, key, size, source_size, target, taken of each row of docs."""
    facts = docs.select(
        F.col(id_col).alias("id"), key_of(F.col(source_col)).alias("key"), order_of(F.col(id_col), seed).alias("order"), size_of(F.col(text_col)).alias("size")
    )
    facts = save(facts, "facts")
    targets = save(_targets(facts, weights, share, epochs), "targets")
    plan = save(targets.join(_cuts(facts, targets), "key", "left"), "mixture")
    total = targets.agg(F.sum("n_docs")).first()[0] or 0
    return attach(facts, plan, "key", "n_docs", total).select("id", "key", "size", "source_size", "target", _taken().alias("taken"))


def mixture(
    docs: DataFrame, weights: DataFrame, share: float = 1.5, epochs: float = 2.0, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """A row for each row of docs: its id, size, source_size, target (of its source) and taken, the words that the mix takes of it.

    weights: source, weight. All sources share `share` times all sizes by weight, none beyond `epochs` times its own size; a source without
    a weight gets none. A source's taken words are its target but for a word, or, where rows share the id at which the target is reached,
    for a word a row; no document is taken more often than `epochs`, rounded up. Null texts have size 0, null is a source of its own,
    and rows without an id, like rows that share one, are drawn alike. Other columns aren't read; an empty table gives an empty one.
    """
    mixed = _mixed(docs, weights, share, epochs, seed, id_col, text_col, source_col)
    return mixed.select(F.col("id").alias(id_col), "size", "source_size", "target", "taken")


def mixed_texts(
    docs: DataFrame, weights: DataFrame, share: float = 1.5, epochs: float = 2.0, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """The mix itself: docs with a row for each repetition and its number, `copy` (or a fresh name), from 1 on.

    A document that gives a part of its words comes last with these words, joined by single spaces. Documents without words aren't in it.
    """
    copy, taken, n, ident, key = (fresh(x, docs) for x in ("copy", "mix_taken", "mix_size", "mix_id", "mix_key"))
    # Rows that share an id, a source and a size give the same number of words.
    each = _mixed(docs, weights, share, epochs, seed, id_col, text_col, source_col).filter("taken > 0").groupBy("id", "key", "size").agg(F.max("taken"))
    each = each.toDF(ident, key, n, taken)
    same = F.col(id_col).eqNullSafe(F.col(ident)) & (key_of(F.col(source_col)) == F.col(key)) & (size_of(F.col(text_col)) == F.col(n))
    copies = F.sequence(F.lit(1), F.ceil(F.col(taken) / F.col(n)).cast("int"))
    left = F.col(taken) - (F.col(copy) - 1) * F.col(n)
    words = F.array_remove(F.split(F.col(text_col), r"[\x20\x09-\x0D]+"), "")
    text = F.when(left < F.col(n), F.array_join(F.slice(words, F.lit(1), left.cast("int")), " ")).otherwise(F.col(text_col))
    return docs.join(each, same).withColumn(copy, F.explode(copies)).withColumn(text_col, text).select(*docs.columns, copy)


#: The query's mix in DuckDB: the level in closed form, over the sources in order of cap by weight; documents by running sums.
ORACLE = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
    ('0x' || substr(sha256('13:' || coalesce(doc_id::varchar, '')), 1, 15))::bigint as h
  from documents
), s as (
  select source, sum(size)::bigint as source_size, [3.0, 1.0, 2.0][((row_number() over (order by source nulls last)) - 1) % 3 + 1]::double as weight from d group by source
), r as (
  select *, 2.0::double * source_size as cap, row_number() over (order by 2.0::double * source_size / weight, source nulls last) as k from s
), levels as (
  select k, cap, weight, (1.5::double * (select sum(source_size) from s)::double
    - coalesce(sum(cap) over (order by k rows between unbounded preceding and 1 preceding), 0)) / (sum(weight) over (order by k rows between current row and unbounded following)) as level
  from r
), t as (
  select source, source_size, least(cap, weight * (select first(level order by k) from levels where cap >= level * weight)) as target from r
), w as (
  select *, case when source_size > 0 then floor(target / source_size) else 0 end::bigint as whole from t
), n as (
  select *, floor(target - whole * source_size + 0.5)::bigint as need from w
), c as (
  select d.*, n.source_size, n.target, n.whole, n.need,
    sum(d.size) over (partition by d.source order by h range between unbounded preceding and current row) as upto, sum(d.size) over (partition by d.source, h) as tied
  from d join n on d.source is not distinct from n.source
)
select doc_id, size, source_size, target,
  (whole * size + case when upto <= need then size when upto - tied < need then floor((need - upto + tied)::double * size / tied) else 0 end)::bigint as taken
from c
"""
