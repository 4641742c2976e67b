"""Changes over the driver tables: JSON edited by pointer, lots committed and read back, what changes do to the findings, settings checked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.lineage import place, spread, stage
from ..operators import apply as A
from ..operators import measure as Me
from ..operators import verify as V
from ..sources import json_edits as J
from ..sources import readers as R
from ..sources import settings as S
from .analogs import pick, table
from .phrase_queries import _GAPS, _payments

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


_SHEET = """'{\n    "name": "' || {name} || '",\n    "pages": [\n        {\n            "text": "' || {text} || '",\n            "n": ' || p_size || '\n        },\n        "last"\n    ],\n    "none": {}\n}\n'"""


@query(
    f"""select 'p' || p_partkey as file, case p_partkey % 5 when 3 then null when 4 then null else {_SHEET.replace('{name}', "case p_partkey % 5 when 1 then 'part ' || p_partkey else p_name end").replace('{text}', "case when p_partkey % 5 = 2 then p_type else p_brand end")} end as text,
  case p_partkey % 5 when 3 then 'no text at /pages/0/n' when 4 then 'no text at /pages/9' end as problem from part"""
)
def pointer_edits(spark, sf_dir):
    """Nested JSON of every part with one text replaced; a pointer to a number, and one beyond a list's end, refuse the file."""
    p = spread(table(spark, sf_dir, "part"))
    form = F.col("p_partkey") % 5
    file = F.concat(F.lit("p"), F.col("p_partkey").cast("string"))
    page = F.struct(F.when(form == 2, "old").otherwise(F.col("p_brand")).alias("text"), F.col("p_size").alias("n"))
    pages = F.concat(F.lit("["), F.to_json(page), F.lit(', "last"]'))
    body = F.concat(F.lit('{"name": '), J.quoted(F.col("p_name")), F.lit(', "pages": '), pages, F.lit(', "none": {}}'))
    pointer = pick(["/name", "name/", "/pages/0/text", "/pages/0/n", "/pages/9"], form)
    value = pick(["p_name", "part", "p_type", "x", "x"], form)
    value = F.when(form == 0, F.col("p_name")).when(form == 1, F.concat(F.lit("part "), F.col("p_partkey").cast("string"))).when(form == 2, F.col("p_type")).otherwise(value)
    return J.set_pointers(p.select(file.alias("file"), body.alias("text")), p.select(file.alias("file"), pointer.alias("pointer"), value.alias("value"), F.lit(1).alias("ord")))


def _project(spark, sf_dir) -> tuple[A.Commits, DataFrame]:
    """A project with a language file for each nation, and a lot with a correction for two customers in three, and traces for the others."""
    c = table(spark, sf_dir, "customer")
    key = F.concat(F.lit("k."), F.col("c_custkey").cast("string"))
    line = F.concat(J.quoted(key), F.lit(": "), J.quoted(F.col("c_name")))
    files = c.groupBy(F.concat(F.lit("assets/n"), F.col("c_nationkey").cast("string"), F.lit("/lang/fr_fr.json")).alias("file")).agg(F.concat(F.lit("{"), F.array_join(F.collect_list(line), ", "), F.lit("}")).alias("text"))
    store = A.project(spark, place(spark, "project"))
    store.commit("start", {"files": files})
    fix = F.col("c_custkey") % 3 > 0
    values = {"lot": F.lit("l1"), "i": F.col("c_custkey").cast("int"), "type": F.when(fix, "correction").otherwise("trace"), "key": key, "before": F.when(fix, F.col("c_name")), "after": F.when(fix, F.col("c_mktsegment")).otherwise(F.col("c_name")), "reason": F.lit("r")}
    actions = c.select(*(values.get(n, F.lit(None)).cast(k).alias(n) for n, k in (x.split() for x in A.ACTION.split(", "))))
    return store, actions


@query("select 'n' || c_nationkey as ns, 'k.' || c_custkey as key, case when c_custkey % 3 > 0 then c_mktsegment else c_name end as value, case when c_custkey % 3 > 0 then 'correction' else 'decision' end as decided, 2 as version from customer")
def lot_round_trip(spark, sf_dir):
    """A lot over all customers, committed as a whole and read back: texts and decisions."""
    store, actions = _project(spark, sf_dir)
    none = spark.createDataFrame([], "layer string, jar string, ns string, locale string, key string, value string, ord int")
    A.apply_lot(store, "l1", actions, actions.select("key"), none, "2026-01-01")
    now = R.lang_files(store.read("files"), "project").select("ns", "key", "value")
    return now.join(store.read("decisions").select("key", F.col("type").alias("decided")), "key").withColumn("version", F.lit(store.version()))


@query("with p as (select c_custkey, case when c_custkey % 10 = 0 then 'outside the perimeter' when c_custkey % 3 > 0 and c_custkey % 7 = 0 then 'text has changed' when c_custkey % 3 = 0 and c_custkey % 7 = 0 then 'cites another text than the key will have' else '' end as why from customer) select c_custkey as i, case when why = '' then 'apply' else 'refused' end as verdict, why from p")
def lot_refusals(spark, sf_dir):
    """The same lot with texts that have changed, and keys beyond the perimeter: what is refused, and why; nothing of it is written."""
    store, actions = _project(spark, sf_dir)
    odd = F.col("i") % 7 == 0
    actions = actions.withColumn("before", F.when(odd & F.col("before").isNotNull(), "other").otherwise(F.col("before"))).withColumn("after", F.when(odd & (F.col("type") == "trace"), "other").otherwise(F.col("after")))
    none = spark.createDataFrame([], "layer string, jar string, ns string, locale string, key string, value string, ord int")
    planned = A.apply_lot(store, "l1", actions, actions.filter("i % 10 > 0").select("key"), none, "2026-01-01")
    if store.version() != 1:
        raise AssertionError("a refused lot was written")
    return planned.actions.select("i", "verdict", "why")


@query(f"with {_GAPS} select key, 'gone' as side, gap as detail from gaps join g using (key) where k % 5 = 0 and gap <> '' union all select key, 'new', 'lost: ' || least(t || r, d) || ' ' || greatest(t || r, d) from g where k % 5 = 0")
def finding_differences(spark, sf_dir):
    """What a change to every fifth order's sentence does to the number findings, without judging the others again."""
    texts = stage(_payments(spark, sf_dir), "texts")
    changes = texts.filter("cast(substr(key, 7) as bigint) % 5 = 0").select("key", F.lit("rien").alias("fr"))
    return Me.differential(Me.Prepared(V.Tables(texts=texts, spark=spark)), changes, ["numbers"]).select("key", "side", "detail")


@query(f"with {_GAPS}, f as (select key, row_number() over (order by key) as n from gaps where gap <> '') select key from f where n <= 150")
def measured_lot(spark, sf_dir):
    """The perimeter of a lot: the first 150 number findings, by key; the rule waits until the measure switches it on."""
    tables = V.Tables(texts=_payments(spark, sf_dir), spark=spark, off=frozenset(V.RULES))
    return Me.measure_lot(tables, "l1", ["numbers"], rules=["numbers"])["perimeter"]


@query(
    """with e as (select p_brand, p_partkey, row_number() over (partition by p_brand order by p_partkey) - 1 as n from part), b as (
  select p_brand, n, case p_partkey % 4 when 1 then ['juste: needed, said'] when 2 then ['casse: flag'] when 3 then ['a record', 'forme: needed, said', 'juste: needed, said'] else [] end as rules from e)
select p_brand || '/formes_interdites.json' as file, n::varchar as entry, unnest(rules) as rule from b union all select distinct p_brand || '/homographes.json', null, 'missing' from part"""
)
def settings_quarantine(spark, sf_dir):
    """Parts as known mistakes, a folder for each brand: entries that lack a field, have one of another type, or are no records; and a missing file."""
    p = table(spark, sf_dir, "part")
    form = F.col("p_partkey") % 4
    entry = (
        F.when(form == 0, F.to_json(F.struct(F.col("p_name").alias("forme"), F.col("p_type").alias("juste"))))
        .when(form == 1, F.to_json(F.struct(F.col("p_name").alias("forme"))))
        .when(form == 2, F.to_json(F.struct(F.col("p_name").alias("forme"), F.col("p_type").alias("juste"), F.lit("no").alias("casse"))))
        .otherwise(F.lit("7"))
    )
    lists = p.groupBy("p_brand").agg(F.array_sort(F.collect_list(F.struct("p_partkey", entry.alias("json")))).alias("x"))
    files = lists.select(F.concat("p_brand", F.lit("/formes_interdites.json")).alias("file"), F.concat(F.lit("["), F.array_join("x.json", ", "), F.lit("]")).alias("text"))
    return S.settings(files, {n: S.TABLES[n] for n in ("formes_interdites", "homographes")})[1]
