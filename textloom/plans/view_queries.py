"""The small views over whole driver tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import views as V
from .analogs import ENTRIES, entries, pick, table
from .phrase_queries import quoted

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


_BLOCKS = ["quests:a", "book:b/c", "journal", "mod/x", "lib", "elsewhere"]


@query(f"select p_partkey as id, {quoted(['quests', 'books', 'books', 'mods', 'mods', 'other'])}[p_partkey % 6 + 1] as theme, case when p_partkey % 2 = 0 then 'u/names' else 'u/text.p' || p_partkey end as sub, {quoted(['Français', 'Coréen', 'xx_yy'])}[p_partkey % 3 + 1] as label from part")
def themes_and_units(spark, sf_dir):
    """Theme of a block, sub-unit of a key, label of a locale."""
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    n = k.cast("string")
    key = F.when(k % 2 == 0, F.concat(F.lit("item.parts.p"), n)).otherwise(F.concat(F.lit("text.p"), n, F.lit(".more.x")))
    return p.select(
        k.alias("id"), V.theme_of(pick(_BLOCKS, k % 6), {"mods": ["mod", "lib"]}).alias("theme"), V.sub_unit(key, F.lit("u")).alias("sub"), V.locale_label(pick(["fr_fr", "ko_kr", "xx_yy"], k % 3)).alias("label")
    )


@query(f"with {ENTRIES}, l as (select distinct ns, key, locale from entries) select locale, case locale when 'en_us' then 'Anglais' when 'fr_fr' then 'Français' when 'ko_kr' then 'Coréen' else 'Chinois simplifié' end as label, count(*) as n from l group by 1")
def locales_of_index(spark, sf_dir):
    """The locales that an index has, with their labels."""
    from ..operators.model import key_index

    return V.locales(key_index(entries(spark, sf_dir)))


@query("select 'traced keys' as item, count(distinct user_id) as n from events union all select 'decisions', count(*) from events union all select 'glossary terms', count(*) from part")
def traced_counters(spark, sf_dir):
    return V.counters(table(spark, sf_dir, "events").select(F.col("user_id").alias("key")), table(spark, sf_dir, "part"))


def _revisions(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    row = lambda d, v: d.select(F.col("p_brand").alias("file"), F.col("p_partkey").cast("string").alias("key"), v.alias("value"))
    k = F.col("p_partkey") % 5
    after = F.when(k == 1, F.replace("p_name", F.lit("e"), F.lit("é"))).when(k == 2, F.concat("p_name", F.lit("!"))).otherwise(F.col("p_name"))
    return row(p.filter(k != 3), F.col("p_name")), row(p.filter(k != 4), after), spark.createDataFrame([("Brand#1",)], "file string")


@query(
    """with r as (select p_brand as file, cast(p_partkey as varchar) as key, p_partkey % 5 as k, p_name as a, case p_partkey % 5 when 1 then replace(p_name, 'e', 'é') when 2 then p_name || '!' else p_name end as b from part where p_brand <> 'Brand#1'),
d as (select file, key, case when k = 3 then 'appeared' when k = 4 then 'disappeared' when a = b then null when k = 1 then 'accents' else 'substance' end as kind, case when k <> 3 then a end as "before", case when k <> 4 then b end as "after" from r)
select file, kind, key, "before", "after", count(*) over (partition by file, kind) as n from d where kind is not null"""
)
def listed_differences(spark, sf_dir):
    """Every difference of two revisions, with both texts."""
    return V.diff_listing(*_revisions(spark, sf_dir))


@query("select 1 as code")
def difference_code(spark, sf_dir):
    a, b, bad = _revisions(spark, sf_dir)
    return spark.createDataFrame([(V.diff_code(V.diff_listing(a, b, bad), bad),)], "code int")


_CLASSES = ["accents", "ligature", "absent", "equal"]


@query(
    """with k as (select p_partkey as k, case p_partkey // 4 % 3 when 0 then 'item.parts.p' || p_partkey when 1 then 'book/b' || p_partkey || '#/x' else 'text.p' || p_partkey end as key, p_partkey % 4 as c, p_name from part)
select 'decided' as what, key, case when c = 0 then 'accents' else 'ligature' end as detail, p_name as said from k where c < 2
union all select 'dead', key, case k // 4 % 3 when 0 then 'parts' when 1 then 'book' else 'mod' end, '' from k where c = 2"""
)
def reconciled_provenance(spark, sf_dir):
    """What reconciling provenance appends, and the keys that it sets aside with their namespaces."""
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    n, form = k.cast("string"), F.floor(k / 4) % 3
    key = F.when(form == 0, F.concat(F.lit("item.parts.p"), n)).when(form == 1, F.concat(F.lit("book/b"), n, F.lit("#/x"))).otherwise(F.concat(F.lit("text.p"), n)).alias("key")
    classes = p.select(key, pick(_CLASSES, k % 4).alias("class"))
    decisions = p.select(key, F.lit(1).alias("seq"), F.lit("a").alias("type"), F.lit("f").alias("fr"), F.lit("kubejs/assets/mod/lang/fr_fr.json").alias("file"))
    more, dead = V.reconciled_decisions(classes, decisions, p.select(key, F.col("p_name").alias("fr")), "today")
    return more.select(F.lit("decided").alias("what"), "key", F.col("type").alias("detail"), F.col("fr").alias("said")).unionByName(dead.select(F.lit("dead").alias("what"), "key", F.col("ns").alias("detail"), F.lit("").alias("said")))


@query("select 'item.parts.p' || p_partkey || '.desc.1' as key, 'parts:p' || p_partkey as object_id from part where p_partkey % 2 = 0")
def implied_links(spark, sf_dir):
    p, n = table(spark, sf_dir, "part"), F.col("p_partkey").cast("string")
    return V.implied_links(p.select(F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("item.parts.p"), n, F.lit(".desc.1"))).otherwise(F.concat(F.lit("item.parts.p"), n)).alias("key")))


@query("select distinct n_name as fr from nation where n_nationkey % 2 = 0 union all select 'shop ' || n_name from nation where n_nationkey % 2 = 1")
def names_of_people(spark, sf_dir):
    """Those that players talk to, and professions and shops."""
    n, k = table(spark, sf_dir, "nation"), F.col("n_nationkey").cast("string")
    npc = n.filter("n_nationkey % 2 = 0").select(F.concat(F.lit("dialog.npc.a"), k, F.lit(".name")).alias("key"), F.col("n_name").alias("fr"))
    shops = n.filter("n_nationkey % 2 = 1").select(F.concat(F.lit("shop.society_trading.a"), k).alias("key"), F.concat(F.lit(" shop "), "n_name").alias("fr"))
    rows = V.people(shops.unionByName(npc))
    return V.npc_names(npc.unionByName(shops)).unionByName(spark.createDataFrame([(r,) for r in rows], "fr string"))


@query("select p_partkey as id, case when p_size % 3 = 2 then p_name || ', x' else case p_size % 3 when 0 then string_split(p_name, ' ')[1] else p_name end end as start from part")
def written_prefixes(spark, sf_dir):
    """The first one, two or four words of names of three."""
    p = table(spark, sf_dir, "part")
    n = F.element_at(F.array(F.lit(1), F.lit(2), F.lit(4)), (F.col("p_size") % 3 + 1).cast("int"))
    return p.select(F.col("p_partkey").alias("id"), V.written_prefix(F.concat("p_name", F.lit(", x")), n).alias("start"))


@query(
    """select p_partkey as id, case when p_partkey % 4 = 1 then 'ete' when p_partkey % 4 = 2 then 'élève' end as said, case when p_partkey % 4 = 1 then 'été' when p_partkey % 4 = 2 then 'élevé' end as "right" from part where p_partkey % 4 in (1, 2)"""
)
def accent_drifts(spark, sf_dir):
    """Names that a text writes with other accents, though never as they are."""
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey") % 4
    text = pick(["Un ete puis un Été bleu", "Un ete bleu", "Un élève", "Un hiver"], k)
    name = pick(["Été", "Été", "élevé", "Été"], k)
    d = T.accent_drift(text, F.lower(name))
    return p.select(F.col("p_partkey").alias("id"), d.alias("d")).filter("d is not null").select("id", "d.said", "d.right")


_TYPES = ["correction", "trace", "exception", "generic"]


@query(
    f"""with a as (select c_nationkey as lot, c_custkey as i, {quoted(_TYPES)}[c_custkey % 4 + 1] as type, c_custkey as k from customer), s as (select *, row_number() over (partition by lot order by sha1(lot || '|' || i), i) as r from a),
e as (select lot, i, 'k' || k as key, type, case when type = 'generic' or k % 5 = 0 then '' else 'en' || k end as english, case type when 'correction' then 'old' when 'trace' then 'new' when 'exception' then case when k % 5 = 0 then '' else 'fr' || k end else '' end as "before",
  case when type in ('correction', 'trace') then 'new' else '' end as "after" from s where r <= 5)
select lot, row_number() over (partition by lot order by i)::int as n, key, english, "before", "after", type from e"""
)
def sample_pages(spark, sf_dir):
    """Five actions of each nation as a reviewer sees them."""
    c, n = table(spark, sf_dir, "customer"), F.col("c_custkey")
    key = F.concat(F.lit("k"), n.cast("string")).alias("key")
    actions = c.select(F.col("c_nationkey").cast("string").alias("lot"), n.alias("i"), pick(_TYPES, n % 4).alias("type"), key, F.lit("old").alias("before"), F.lit("new").alias("after"), F.lit("why").alias("reason"))
    texts = c.filter("c_custkey % 5 > 0").select(key, F.concat(F.lit("en"), n.cast("string")).alias("english"), F.concat(F.lit("fr"), n.cast("string")).alias("fr"))
    return V.sample_page(actions, texts, 5).select(F.col("lot").cast("bigint").alias("lot"), "n", "key", "english", "before", "after", "type")


@query("select distinct cast(c_custkey as varchar) as key from customer where c_nationkey in (1, 3)")
def keys_of_questions(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    q = c.groupBy(F.col("c_nationkey").cast("string").alias("id")).agg(F.collect_list(F.col("c_custkey").cast("string")).alias("keys"))
    return V.question_keys(q, [r.id for r in q.filter("id in ('1', '3')").select("id").collect()])


@query(f"with {ENTRIES} select ns, string_agg(distinct jar, ',' order by jar) as jars from entries where layer = 'jar' group by ns")
def jars_of_namespaces(spark, sf_dir):
    return V.jars_of(entries(spark, sf_dir)).select("ns", F.array_join("jars", ",").alias("jars"))
