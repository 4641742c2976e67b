"""Sampling, measurement, packing and change sets over whole driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import changes as K
from ..operators import sampling as P
from .analogs import table

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _members(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("stratum"), F.col("c_custkey").alias("id"))


_QUOTA = """s as (select c_nationkey as stratum, count(*) as size from customer group by 1), t as (select (sum(size) * 9 // 10)::bigint - sum(least(5, size)) as rest, sum(size) - sum(least(5, size)) as room from s),
w as (select s.*, least(5, size) as base, ((size - least(5, size)) * rest // room)::bigint as whole, ((size - least(5, size)) * rest % room)::bigint as remainder, rest from s, t),
q as (select *, row_number() over (order by remainder desc, stratum) <= rest - sum(whole) over () as more from w),
quota as (select stratum, size, (base + whole + more::int)::bigint as quota from q)"""


def _quota(spark, sf_dir):
    """Nine tenths of all customers, by nation."""
    m = _members(spark, sf_dir)
    return P.quotas(m.groupBy("stratum").agg(F.count(F.lit(1)).alias("size")), m.count() * 9 // 10)


@query(f"with {_QUOTA} select * from quota")
def stratum_quotas(spark, sf_dir):
    return _quota(spark, sf_dir)


@query(
    f"""with {_QUOTA}, r as (select c_nationkey as stratum, c_custkey as id, row_number() over (partition by c_nationkey order by sha1('seed|' || c_custkey), c_custkey) as n from customer)
select stratum, id from r join quota using (stratum) where n <= quota"""
)
def stratified_draw(spark, sf_dir):
    return P.draw(_members(spark, sf_dir), _quota(spark, sf_dir), "seed")


_VERDICTS = """verdicts as (select o_orderkey as id, case o_orderstatus when 'F' then 'major' when 'O' then 'minor' else 'correct' end as class,
  case when o_orderkey % 5 = 0 then 'never displayed: old' else 'seen' end as reason, o_orderpriority as zone from orders)"""


def _verdicts(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "F", "major").when(F.col("o_orderstatus") == "O", "minor").otherwise("correct").alias("class"),
        F.when(F.col("o_orderkey") % 5 == 0, "never displayed: old").otherwise("seen").alias("reason"),
        F.col("o_orderpriority").alias("zone"),
    )


@query(
    f"""with {_VERDICTS}, v as (select *, class = 'correct' and starts_with(reason, 'never displayed:') as dead from verdicts)
select zone, count(*) filter (not dead) as n, count(*) filter (class = 'major') as major, count(*) filter (class = 'minor') as minor, count(*) filter (class = 'correct' and not dead) as correct, count(*) filter (dead) as dead from v group by rollup (zone)"""
)
def quality_by_zone(spark, sf_dir):
    v = _verdicts(spark, sf_dir)
    return P.quality(v.select("zone", "id"), v.drop("zone")).drop("bound", "holds")


@query()
def clopper_pearson(spark, sf_dir):
    """Upper bounds of the share of major defects per zone; tested against closed forms and the binomial sum."""
    v = _verdicts(spark, sf_dir)
    return P.quality(v.select("zone", "id"), v.drop("zone")).select("zone", "n", "major", "bound", "holds")


@query("select s_suppkey, 1 - power(0.05, 1.0 / (s_suppkey + 1)) as bound from supplier")
def bound_without_defects(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select("s_suppkey", P.bound_without_defects(F.col("s_suppkey") + 1).alias("bound"))


@query(
    f"""with {_VERDICTS}, d as (select id, class from verdicts where class <> 'correct'), c as (select id, class from verdicts where class = 'correct' and not starts_with(reason, 'never displayed:') order by sha1('seed|' || id), id limit (select count(*) from d))
select * from d union all select * from c"""
)
def bench_choice(spark, sf_dir):
    return P.bench(_verdicts(spark, sf_dir), "seed")


_ALERTS = "alerts as (select distinct case when l_linenumber % 2 = 0 then 'F1' else 'F2' end as net, l_orderkey as id from lineitem where l_discount > 0.05)"


def _alerts(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").filter("l_discount > 0.05").select(F.when(F.col("l_linenumber") % 2 == 0, "F1").otherwise("F2").alias("net"), F.col("l_orderkey").alias("id")).distinct()


@query(
    f"""with {_VERDICTS}, {_ALERTS}, t as (select count(*) filter (class <> 'correct') as d, count(*) filter (class = 'major') as m, count(*) filter (class = 'correct') as c from verdicts),
h as (select net, count(*) as alerts, count(*) filter (class <> 'correct') as tr, count(*) filter (class = 'major') as mj from alerts join verdicts using (id) group by net)
select net, alerts, tr as "true", tr / alerts as precision, tr / d as recall, mj / m as major_recall, (alerts - tr) / c as false_alarms from h, t"""
)
def net_yield(spark, sf_dir):
    return P.net_yield(_alerts(spark, sf_dir), _verdicts(spark, sf_dir).select("id", "class"))


@query(
    f"""with {_VERDICTS}, {_ALERTS}, n as (select id, list_sort(list(distinct net)) as nets from alerts group by id), x as (select id, unnest(list_concat(nets, ['F1 + F2'])) as net from n)
select net, count(*) as alerts, count(*) filter (class in ('major', 'minor')) as confirmed, count(*) filter (class = 'major') as majors, count(*) filter (class in ('major', 'minor')) / count(*) as precision from x left join verdicts using (id) group by net"""
)
def pack_yield(spark, sf_dir):
    a = _alerts(spark, sf_dir).groupBy("id").agg(F.array_sort(F.collect_set("net")).alias("nets"))
    return P.pack_yield(a, _verdicts(spark, sf_dir))


@query(
    """select n_nationkey, case when n_nationkey / 25.0 < 0.6 or n_regionkey / 10.0 > 0.15 then 'tighten' else 'keep' end as wide, case when n_regionkey / 50.0 < 0.05 and n_nationkey % 2 = 0 then 'drop' when n_regionkey / 10.0 > 0.15 then 'tighten' else 'keep' end as narrow,
round_even(0.5 * n_nationkey, 0)::bigint as expected from nation"""
)
def net_decisions(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    r, k = F.col("n_regionkey"), F.col("n_nationkey")
    return n.select("n_nationkey", P.decide(k / 25.0, r / 10.0).alias("wide"), P.decide_narrow(r / 50.0, k % 2, r / 10.0).alias("narrow"), P.projection(F.lit(0.5), F.lit(0.5), k, F.lit(0.5)).alias("expected"))


_OPINIONS = """a as (select id, class, 'x' as correction, case when id % 3 = 0 then 'q' end as question from verdicts), b as (select id, case when id % 4 = 0 then 'minor' else class end as class, case when id % 6 = 0 then 'y' else 'x' end as correction, case when id % 3 = 0 then 'q' when id % 7 = 0 then 'r' end as question from verdicts),
c as (select id, 'major' as class, null as correction, null as question from verdicts where id % 8 = 0)"""


def _opinions(spark, sf_dir):
    v = _verdicts(spark, sf_dir).select("id", "class")
    n = F.col("id")
    a = v.select("id", "class", F.lit("x").alias("correction"), F.when(n % 3 == 0, "q").alias("question"))
    b = v.select("id", F.when(n % 4 == 0, "minor").otherwise(F.col("class")).alias("class"), F.when(n % 6 == 0, "y").otherwise("x").alias("correction"), F.when(n % 3 == 0, "q").when(n % 7 == 0, "r").alias("question"))
    c = v.filter(n % 8 == 0).select("id", F.lit("major").alias("class"), F.lit(None).cast("string").alias("correction"), F.lit(None).cast("string").alias("question"))
    return a, b, c


@query(
    f"""with {_VERDICTS}, {_OPINIONS} select a.id, case when a.class = b.class then a.class else c.class end as class, case when a.class = b.class then 'agreed' when c.class is not null then 'third' else 'pending' end as state,
case when a.class = b.class and a.correction <> b.correction then b.correction end as variant, coalesce(a.question, '') || case when b.question is not null and b.question is distinct from a.question then b.question else '' end as questions
from a join b using (id) left join c using (id)"""
)
def review_verdicts(spark, sf_dir):
    return P.verdicts(*_opinions(spark, sf_dir)).select("id", "class", "state", "variant", F.array_join("questions", "").alias("questions"))


@query(f"with {_VERDICTS}, {_OPINIONS} select class, count(*) as n, sum((question is not null)::int)::bigint as questions from a group by class")
def verdict_totals(spark, sf_dir):
    a, _, _ = _opinions(spark, sf_dir)
    return P.verdict_totals(a.withColumn("questions", F.array_compact(F.array("question"))))


@query("select coalesce(c_custkey, o_custkey) as id, case when c_custkey is null then 'F2' when o_custkey is null then 'F1' else 'F1,F2' end as nets from customer full join (select distinct o_custkey from orders) on c_custkey = o_custkey")
def merged_nets(spark, sf_dir):
    f1 = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("note"))
    f2 = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id")).distinct().withColumn("note", F.lit("order"))
    return P.merged_nets(f1, f2).select("id", F.array_join("nets", ",").alias("nets"))


@query(
    """with recursive e as (select l_orderkey * 2 as a, l_suppkey * 2 + 1 as b from lineitem where l_quantity = 50 and l_linenumber = 1 and l_discount = 0.05), u as (select a, b from e union select b, a from e),
r(node, root) as (select a, least(a, b) from u union select u.a, r.root from u join r on u.b = r.node where r.root < u.a) select node, min(root) as root from r group by node"""
)
def connected_components(spark, sf_dir):
    """Orders and suppliers that a few line items link."""
    li = table(spark, sf_dir, "lineitem").filter("l_quantity = 50 and l_linenumber = 1 and l_discount = 0.05")
    return P.components(li.select((F.col("l_orderkey") * 2).alias("a"), (F.col("l_suppkey") * 2 + 1).alias("b")))


@query()
def all_connected_components(spark, sf_dir):
    """Orders and suppliers that any line item links; tested against plain Python."""
    li = table(spark, sf_dir, "lineitem")
    return P.components(li.select((F.col("l_orderkey") * 2).alias("a"), (F.col("l_suppkey") * 2 + 1).alias("b")))


@query("select c_nationkey as family, first_id as a, c_custkey as b from customer join (select c_nationkey, min(c_custkey) as first_id from customer group by 1) using (c_nationkey) where c_custkey <> first_id")
def family_links(spark, sf_dir):
    m = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("family"), F.col("c_custkey").alias("key"))
    rows = P.family_links(m)
    return rows.join(m, F.col("b") == F.col("key")).select("family", "a", "b")


@query()
def pack_zones(spark, sf_dir):
    """Users' events packed by type, first-fit decreasing: sequential within a theme, tested against plain Python."""
    e = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("theme"), F.col("user_id").cast("string").alias("block")).agg(F.count(F.lit(1)).alias("size"))
    return P.pack(e, cap=150, tolerance=10)


@query(
    """with m as (select cast(c_custkey as varchar) as id, 'zone-' || (c_custkey % 7) as zone, c_mktsegment as unit, cast(c_nationkey % 3 as varchar) as theme from customer),
stay as (select * from m where id not like '%9'), u as (select unit, arg_max(zone, id) as z from stay group by unit) select id, zone, 'kept' as how from stay union all select m.id, coalesce(z, '?'), 'unit' from m left join u using (unit) where m.id like '%9'"""
)
def zone_completion(spark, sf_dir):
    """Customers that have no zone yet join that of their segment."""
    m = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.concat(F.lit("zone-"), (F.col("c_custkey") % 7).cast("string")).alias("zone"), F.col("c_mktsegment").alias("unit"), (F.col("c_nationkey") % 3).cast("string").alias("theme"))
    none = spark.createDataFrame([], "a string, b string")
    return P.complete(m.filter("id not like '%9'").select("zone", "id"), m.drop("zone"), none)


@query("select o_orderpriority as zone, count(*) as texts, count(*) filter (o_orderstatus = 'F') as judged, case when count(*) filter (o_orderstatus = 'F') = 0 then 'to do' when count(*) filter (o_orderstatus = 'F') < count(*) then 'begun' else 'done' end as state from orders group by 1")
def review_progress(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return P.progress(o.select(F.col("o_orderpriority").alias("zone"), F.col("o_orderkey").alias("id")), o.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id")))


# --- change sets --------------------------------------------------------------------------------------------------------------

_TYPES = ["correction", "trace", "exception", "removal", "question", "other"]
_ACTIONS = f"""actions as (select c_nationkey as lot, c_custkey as i, {str(_TYPES)}[c_custkey % 6 + 1] as type, case when c_custkey % 50 = 0 then ' ' else 'k' || (c_custkey // 2) end as key,
  case when c_custkey % 4 = 0 then 'now' else 'old' end as "before", case when c_custkey % 9 = 0 then null else 'new' end as "after", case when c_custkey % 11 = 0 then '' else 'why' end as reason, case when c_custkey % 13 = 0 then '?' end as question from customer)"""


def _actions(spark, sf_dir):
    n = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("lot"),
        n.alias("i"),
        F.element_at(F.array(*(F.lit(t) for t in _TYPES)), (n % 6 + 1).cast("int")).alias("type"),
        F.when(n % 50 == 0, " ").otherwise(F.concat(F.lit("k"), F.floor(n / 2).cast("string"))).alias("key"),
        F.when(n % 4 == 0, "now").otherwise("old").alias("before"),
        F.when(n % 9 != 0, "new").alias("after"),
        F.when(n % 11 == 0, "").otherwise("why").alias("reason"),
        F.when(n % 13 == 0, "?").alias("question"),
    )


@query(
    f"""with {_ACTIONS}, n as (select *, count(*) over (partition by lot) as n from actions)
select lot, i, unnest(list_filter([case when n > 150 then 'too many actions' end, case when type = 'other' then 'unknown type' end, case when trim(key) = '' then 'no key' end, case when type = 'correction' and "after" is null then 'no new text' end,
  case when type in ('correction', 'exception') and trim(reason) = '' then 'no reason' end, case when type = 'question' and question is null then 'no question' end], lambda x: x is not null)) as problem from n"""
)
def lot_validate(spark, sf_dir):
    return K.lot_problems(_actions(spark, sf_dir))


def _definitions(spark, sf_dir):
    s = table(spark, sf_dir, "customer")
    n = F.col("c_custkey")
    return s.select(F.concat(F.lit("k"), (n % 400).cast("string")).alias("key"), F.concat(F.lit("file"), (n % 2).cast("string")).alias("file"), F.when(n % 3 == 0, "now").otherwise("new").alias("value"), F.when(n % 400 % 5 == 0, "vanilla").when(n % 400 % 5 == 1, "jar").otherwise("project").alias("layer"))


_PLAN = f"""{_ACTIONS}, defs as (select 'k' || (c_custkey % 400) as key, 'file' || (c_custkey % 2) as file, case when c_custkey % 3 = 0 then 'now' else 'new' end as value, case when c_custkey % 400 % 5 = 0 then 'vanilla' when c_custkey % 400 % 5 = 1 then 'jar' else 'project' end as layer from customer),
d as (select key, bool_and(layer = 'vanilla') as vanilla, coalesce(arg_max(value, file) filter (layer = 'project'), arg_max(value, file)) as value, string_agg(distinct file, ',' order by file) filter (layer = 'project') as files, min(file) filter (layer = 'jar') as owner from (select distinct key, file, layer, max(value) over (partition by key, file) as value from defs) group by key),
p as (select a.*, count(*) filter (type = 'correction') over (partition by lot, key) as twice from actions a),
v as (select p.*, d.value, d.files, d.owner, case when i % 17 = 0 then 'outside the perimeter' when type = 'correction' and twice > 1 then 'key corrected twice' when type = 'correction' and value is null then 'unknown key' when type = 'correction' and vanilla then 'text of the base game'
  when type = 'correction' and value is distinct from "before" and value is distinct from "after" then 'text has changed' when type in ('trace', 'exception') and "before" is not null and value is distinct from "before" then 'quoted text isn''t the key''s' end as why from p left join d using (key))"""


@query()
def lot_plan(spark, sf_dir):
    """What becomes of each action against the current definitions; tested case by case."""
    a = _actions(spark, sf_dir)
    inside = a.filter("i % 17 <> 0").select("lot", "key").distinct()
    return K.plan_lot(a, inside, _definitions(spark, sf_dir)).select("lot", "i", "verdict", "why", F.array_join("files", ",").alias("files"))


@query("select event_type as unit, event_id as id, (row_number() over (partition by event_type order by event_id) - 1) // 150 as chunk from events")
def lot_chunks(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("unit"), F.col("event_id").alias("id"))
    return K.chunks(e, "id", 150, by="unit")


@query("with g as (select o_custkey as key, count(*) as n from orders group by 1), r as (select *, sum(n) over (order by key) as t from g) select key, n, n as taken from r where t <= 1000")
def first_packet(spark, sf_dir):
    g = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return K.first_packet(g, 1000)


@query("with f as (select p_name as key, p_type as control, p_brand as expected, count(*) over (partition by p_name) as n from part) select key, control, expected from f where n = 1 and control in ('spelling') and expected <> ''")
def safe_corrections(spark, sf_dir):
    f = table(spark, sf_dir, "part").select(F.col("p_name").alias("key"), F.col("p_type").alias("control"), F.col("p_brand").alias("expected"))
    return K.safe_corrections(f)


@query(
    """with e as (select c_nationkey as packet, c_custkey as id from customer), o as (select c_nationkey as packet, o_custkey as id, count(*) as n, 'major' as class from orders join customer on o_custkey = c_custkey group by all)
select coalesce(e.packet, o.packet) as packet, coalesce(e.id, o.id) as id, unnest(list_filter([case when o.n is null then 'missing' end, case when o.n > 1 then 'repeated' end, case when o.n is not null then 'no correction' end], lambda x: x is not null)) as problem from e full join o on e.packet = o.packet and e.id = o.id"""
)
def output_problems(spark, sf_dir):
    """Orders as a reviewer's outputs for their customers: missing, repeated, and none with a correction."""
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("packet"), F.col("c_custkey").alias("id"))
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id")).join(c, "id").withColumns({"class": F.lit("major"), "correction": F.lit(""), "reason": F.lit("r")})
    return K.output_problems(c, o)


@query(
    "with v as (select o_orderkey as id, case when o_orderstatus = 'F' then 'major' else 'correct' end as class from orders) select cast(id as varchar) as key, case when id % 5 = 0 then 'question' when c_custkey is null then 'missing' when c_name <> 'Customer#000000001' then 'stale' else 'action' end as verdict from v left join customer on id = c_custkey where class = 'major'"
)
def verdict_actions(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    v = o.select(
        F.col("o_orderkey").cast("string").alias("id"), F.when(F.col("o_orderstatus") == "F", "major").otherwise("correct").alias("class"), F.lit("Customer#000000001").alias("before"), F.lit("x").alias("correction"),
        F.when(F.col("o_orderkey") % 5 == 0, F.array(F.lit("?"))).otherwise(F.array().cast("array<string>")).alias("questions"),
    )
    said = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("key"), F.col("c_name").alias("fr"))
    return K.actions_from_verdicts(v, said).select("key", "verdict")


@query("select doc_id, sha1(replace(text, chr(10), chr(10) || '')) as same, sha1(case when contains(text, chr(10)) then 'first' || substr(text, instr(text, chr(10))) else 'first' end) as edited from documents")
def line_edits(spark, sf_dir):
    """The first line of every document replaced."""
    edits = F.create_map(F.lit(1), F.lit("first"), F.lit(1_000_000), F.lit("beyond"))
    return table(spark, sf_dir, "documents").select("doc_id", F.sha1(F.col("text").cast("binary")).alias("same"), F.sha1(K.replaced_lines(F.col("text"), edits).cast("binary")).alias("edited"))


@query("with v as (select p_name as key, cast(p_partkey as varchar) as member, case when p_size % 2 = 0 then ['fs', 'ms'] else ['fs', 'fp'] end as allowed from part), n as (select key, count(*) as n from v group by 1), m as (select key, unnest(allowed) as a from v), k as (select key, a from m group by key, a having count(*) = (select n from n where n.key = m.key)) select n.key, coalesce((select string_agg(a, ',' order by a) from k where k.key = n.key), '') as agreements from n")
def possible_agreements(spark, sf_dir):
    """Which agreements all parts of a name allow."""
    v = table(spark, sf_dir, "part").select(F.col("p_name").alias("key"), F.col("p_partkey").cast("string").alias("member"), F.when(F.col("p_size") % 2 == 0, F.array(F.lit("fs"), F.lit("ms"))).otherwise(F.array(F.lit("fs"), F.lit("fp"))).alias("allowed"))
    return K.possible_agreements(v).select("key", F.array_join("agreements", ",").alias("agreements"))


@query("select p_name as en, p_type as sense, case when p_brand = 'Brand#1' then 'fixed' else p_brand end as fr, false as near from (select p_name, p_type, min(p_brand) as p_brand from part group by all)")
def glossary_upsert(spark, sf_dir):
    g = table(spark, sf_dir, "part").groupBy(F.col("p_name").alias("en"), F.col("p_type").alias("sense")).agg(F.min("p_brand").alias("fr"))
    return K.upsert_glossary(g, g.filter("fr = 'Brand#1'").withColumn("fr", F.lit("fixed")))


@query("with r as (select o_custkey as lot, o_orderkey as i, row_number() over (partition by o_custkey order by sha1(o_custkey || '|' || o_orderkey), o_orderkey) as n from orders) select lot, i from r where n <= 3")
def lot_sample(spark, sf_dir):
    a = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("lot"), F.col("o_orderkey").alias("i"))
    return K.lot_sample(a, 3).select(F.col("lot").cast("bigint").alias("lot"), "i")
