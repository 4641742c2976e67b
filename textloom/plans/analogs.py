"""The driver tables read as a layered corpus: every row of a table becomes a definition, a pair, a finding or an opinion.

Each function has the SQL of the same rows beside it, as a common table expression of the same name for the oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import model


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: list[str], n) -> F.Column:
    """values[n]."""
    return F.element_at(F.array(*(F.lit(v) for v in values)), (n + 1).cast("int"))


LAYER = ["vanilla", "jar", "jar", "project", "project"]
LOCALES = ["en_us", "fr_fr", "en_us", "fr_fr", "ko_kr", "zh_cn"]
KINDS = ["item", "block", "entity", "quests", "dialog", "_note", "book"]


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as definitions: eight of them share a key, in several layers, jars, namespaces and locales."""
    d = table(spark, sf_dir, "documents")
    group = F.floor(F.col("doc_id") / 8)
    layer = pick(LAYER, F.col("doc_id") % 5)
    return d.select(
        F.col("doc_id").alias("ord"),
        layer.alias("layer"),
        F.when(layer == "jar", F.col("source")).otherwise("").alias("jar"),
        F.concat(F.lit("ns"), (F.col("doc_id") % 3).cast("string")).alias("ns"),
        pick(LOCALES, F.floor(F.col("doc_id") / 2) % 6).alias("locale"),
        F.concat(pick(KINDS, group % 7), F.lit(".ns"), (group % 3).cast("string"), F.lit(".k"), group.cast("string")).alias("key"),
        F.col("text").alias("value"),
    )


def _listed(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


ENTRIES = f"""entries as (
  select doc_id as ord, {_listed(LAYER)}[doc_id % 5 + 1] as layer, case when doc_id % 5 in (1, 2) then source else '' end as jar,
    'ns' || (doc_id % 3) as ns, {_listed(LOCALES)}[doc_id // 2 % 6 + 1] as locale,
    {_listed(KINDS)}[doc_id // 8 % 7 + 1] || '.ns' || (doc_id // 8 % 3) || '.k' || (doc_id // 8) as key, text as value
  from documents)"""

RANKED = f"""{ENTRIES}, ranked as (
  select *, row_number() over (partition by locale, key order by list_position(['vanilla', 'jar', 'project'], layer) desc, jar desc, ns desc, ord desc) as r from entries),
merged as (select locale, key, value, layer as origin, ns from ranked where r = 1)"""

TEXTS = f"""{RANKED}, own as (
  select key, arg_max(ns, (locale, ns, ord)) as ns_project from entries where layer = 'project' and locale in ('en_us', 'fr_fr') group by key),
texts as (
  select coalesce(e.key, f.key) as key, e.value as en, e.origin as origin_en, f.value as fr, f.origin as origin_fr, ns_project, coalesce(e.value, '') as english
  from (select * from merged where locale = 'en_us') e full join (select * from merged where locale = 'fr_fr') f on e.key = f.key
    left join own on own.key = coalesce(e.key, f.key))"""


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.effective_text(entries(spark, sf_dir))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of a conversation with the turn after them, as English and French of one key."""
    a = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.col("text").alias("en"))
    b = a.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("en").alias("fr"))
    return a.join(b, ["conv_id", "turn"]).select(F.concat_ws(".", F.lit("turn"), "conv_id", "turn").alias("key"), "en", "fr", F.col("role").alias("space"))


PAIRS = """pairs as (
  select 'turn.' || a.conv_id || '.' || a.turn as key, a.text as en, b.text as fr, a.role as space
  from conversations a join conversations b on a.conv_id = b.conv_id and b.turn = a.turn + 1)"""


def paired_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pairs in the columns of effective texts, all the project's."""
    p = pairs(spark, sf_dir)
    return p.select("key", "en", F.lit("project").alias("origin_en"), "fr", F.lit("project").alias("origin_fr"), F.col("space").alias("ns_project"), F.lit(None).cast("string").alias("en_rebuilt"), F.col("en").alias("english"))


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items as book fields, each with the item after it as its French (the last one has none)."""
    b = table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("bigint").alias("i"), F.col("text").alias("en"))
    n = b.select((F.col("i") - 1).alias("i"), F.col("en").alias("fr"))
    return b.join(n, "i", "left").select(F.concat(F.lit("book/"), F.col("i").cast("string"), F.lit("#/text")).alias("key"), "en", F.coalesce("fr", F.lit("")).alias("fr"))


BOOKS = """books as (
  select 'book/' || a.item_id || '#/text' as key, a.text as en, coalesce(b.text, '') as fr
  from benchmark a left join benchmark b on cast(b.item_id as bigint) = cast(a.item_id as bigint) + 1)"""


def journal(spark: SparkSession) -> DataFrame:
    """A change log of a few lines, in which the third structure line differs."""
    return spark.createDataFrame([("journal", "# One\n- a\n- b\n---", "# Un\n- a\n## b\n---")], "key string, en string, fr string")


def findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as findings: control and status by source and language, the text as what is found."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.concat(F.lit("c-"), F.col("lang")).alias("control"),
        F.concat(F.lit("k"), F.floor(F.col("doc_id") / 2).cast("string")).alias("key"),
        F.when(F.col("n_chars") % 2 == 0, "blocking").otherwise("flagged").alias("status"),
        F.col("text").alias("actual"),
        F.lit("").alias("expected"),
        F.col("doc_id").cast("string").alias("detail"),
        F.lit("").alias("proof"),
        F.when(F.col("n_chars") % 3 == 0, F.array(F.col("source"))).otherwise(F.array().cast("array<string>")).alias("object"),
    )


FINDINGS = """findings as (
  select 'c-' || lang as control, 'k' || (doc_id // 2) as key, case when n_chars % 2 = 0 then 'blocking' else 'flagged' end as status, text as actual,
    cast(doc_id as varchar) as detail, case when n_chars % 3 = 0 then source else '' end as object from documents),
vals as (select 'k' || (doc_id // 2) as key, max(text) as value from documents group by 1)"""


def values(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.groupBy(F.concat(F.lit("k"), F.floor(F.col("doc_id") / 2).cast("string")).alias("key")).agg(F.max("text").alias("value"))


def exceptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as exceptions: those of low quality lack a reason, toxic ones wait for an answer."""
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id")
    return rows.select(
        F.concat(F.lit("c-"), F.col("lang")).alias("control"),
        F.concat(F.lit("k"), F.floor(F.col("doc_id") / 2).cast("string")).alias("key"),
        F.when(F.col("n_chars") % 4 == 0, F.array(F.col("source"))).otherwise(F.array().cast("array<string>")).alias("object"),
        F.when(F.col("quality") == 1, "known").otherwise(" ").alias("reason"),
        (F.col("n_chars") % 11 == 0).alias("pin"),
        F.lit(None).cast("string").alias("fingerprint"),
        F.when(F.col("toxic") == 1, "why").otherwise("").alias("question"),
        F.col("doc_id").alias("ord"),
    )


EXCEPTIONS = """exceptions as (
  select 'c-' || lang as control, 'k' || (doc_id // 2) as key, case when n_chars % 4 = 0 then source else '' end as object,
    case when quality = 1 then 'known' else ' ' end as reason, n_chars % 11 = 0 as pin, case when toxic = 1 then 'why' else '' end as question, doc_id as ord
  from labels join documents using (doc_id)),
valid as (select * from exceptions where trim(reason) <> '' and not pin)"""


def debt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as debt of the findings of their key, with a fingerprint that half of the texts still have."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.concat(F.lit("c-"), F.col("lang")).alias("control"),
        F.concat(F.lit("k"), F.floor(F.col("doc_id") / 2).cast("string")).alias("key"),
        F.when(F.col("n_chars") % 3 == 0, F.array(F.col("source"))).otherwise(F.array().cast("array<string>")).alias("object"),
        F.left(F.sha1(F.col("text").cast("binary")), F.lit(12)).alias("fingerprint"),
    ).join(table(spark, sf_dir, "labels").select(F.concat(F.lit("k"), F.floor((F.col("doc_id") + 1) / 2).cast("string")).alias("key")).distinct(), "key", "left_semi")


DEBT = """debt as (
  select 'c-' || lang as control, 'k' || (doc_id // 2) as key, case when n_chars % 3 = 0 then source else '' end as object, left(sha1(text), 12) as fingerprint
  from documents where 'k' || (doc_id // 2) in (select 'k' || ((doc_id + 1) // 2) from labels))"""

RECONCILED = f"""{FINDINGS}, {EXCEPTIONS}, {DEBT}, judged as (
  select f.*, (select min(ord) from valid v where v.control = f.control and v.key = f.key and (v.object = '' or v.object = f.object)) as exception,
    exists(select 1 from debt d where d.control = f.control and d.key = f.key and d.object = f.object) as owed,
    exists(select 1 from debt d, vals v where d.control = f.control and d.key = f.key and d.object = f.object and v.key = f.key and d.fingerprint = left(sha1(v.value), 12)) as same
  from findings f), reconciled as (
  select *, case when exception is not null then 'covered' when same then 'debt' when owed then 'blocking' else status end as bucket,
    exception is null and owed and not same as escalated from judged)"""
