"""Layered definitions, indexes, search, sets and the pipeline over whole driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import inventory as I
from ..operators import model as M
from ..operators import search as S
from .analogs import ENTRIES, PAIRS, RANKED, TEXTS, entries, pairs, table, texts
from .text_queries import fold_sql

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query(f"with {RANKED} select * from merged")
def layered_merge(spark, sf_dir):
    return M.merge_layers(entries(spark, sf_dir))


@query(f"with {TEXTS} select key, en, origin_en, fr, origin_fr, ns_project, english from texts")
def effective_text(spark, sf_dir):
    return texts(spark, sf_dir).drop("en_rebuilt")


@query(f"with {TEXTS} select key, fr from texts where not starts_with(key, '_') and origin_fr = 'project'")
def project_texts(spark, sf_dir):
    return M.project_texts(texts(spark, sf_dir)).select("key", "fr")


@query(
    f"""with {ENTRIES}, l as (select key, ns, arg_max(value, ord) as value from entries where layer = 'project' and locale = 'fr_fr' group by key, ns)
select key, count(distinct value) as n_values, string_agg(ns || '=' || sha1(value), ',' order by ns) as definitions from l where not starts_with(key, '_') group by key having count(distinct value) > 1"""
)
def duplicate_definitions(spark, sf_dir):
    d = M.duplicate_definitions(entries(spark, sf_dir))
    listed = F.array_join(F.transform(F.map_entries("definitions"), lambda e: F.concat(e["key"], F.lit("="), F.sha1(e["value"].cast("binary")))), ",")
    return d.select("key", "n_values", listed.alias("definitions"))


@query(f"with {ENTRIES} select ns, key, string_agg(distinct locale, ',' order by locale) as locales from entries where layer = 'project' and locale in ('ko_kr', 'zh_cn') group by ns, key")
def witness_texts(spark, sf_dir):
    return M.witnesses(entries(spark, sf_dir)).select("ns", "key", F.array_join(F.map_keys("texts"), ",").alias("locales"))


_INDEX = f"""{ENTRIES}, l as (
  select ns, key, locale, arg_max(value, (layer = 'project', jar, ord)) as value, bool_or(layer = 'project') as pack, bool_or(layer <> 'project') as mods from entries group by all),
idx as (select 'lang:' || ns || ':' || key as id, ns, key, max(value) filter (locale = 'en_us') as en,
    coalesce(max(case when pack then 'pack' else 'jar' end) filter (locale = 'en_us'), 'none') as origin,
    coalesce(string_agg(locale || '=' || sha1(value), ',' order by locale) filter (locale <> 'en_us'), '') as translations,
    coalesce(string_agg(locale, ',' order by locale) filter (pack), '') as present_pack, coalesce(string_agg(locale, ',' order by locale) filter (mods), '') as present_mods,
    max(value) filter (locale = 'fr_fr') as fr
  from l group by ns, key)"""


@query(f"with {_INDEX} select id, ns, key, en, origin, translations, present_pack, present_mods from idx")
def key_index_presence(spark, sf_dir):
    i = M.key_index(entries(spark, sf_dir))
    listed = F.array_join(F.transform(F.map_entries("translations"), lambda e: F.concat(e["key"], F.lit("="), F.sha1(e["value"].cast("binary")))), ",")
    return i.select("id", "ns", "key", "en", "origin", listed.alias("translations"), F.array_join("present_pack", ",").alias("present_pack"), F.array_join("present_mods", ",").alias("present_mods"))


@query(f"with {_INDEX} select key, string_agg(ns, ',' order by ns) as namespaces, count(*) > 1 as uncertain from idx group by key")
def uncertain_keys(spark, sf_dir):
    return M.names_by_key(M.key_index(entries(spark, sf_dir))).select("key", F.array_join("namespaces", ",").alias("namespaces"), "uncertain")


@query(f"with {ENTRIES} select key, arg_min(ns, (jar, ns, ord)) as ns from entries where layer = 'jar' group by key")
def first_jar_namespace(spark, sf_dir):
    return M.first_namespace(entries(spark, sf_dir))


@query("select event_id as id, '/k' as pointer, json_extract_string(props, '$.k') as value from events where json_type(props, '$.k') = 'VARCHAR' union all select event_id, '', json_extract_string(json_object('v', event_type), '$.v') from events")
def json_flatten(spark, sf_dir):
    """String leaves of the events' properties, and of their type written as a JSON string."""
    e = table(spark, sf_dir, "events")
    rows = e.select("event_id", "props").unionByName(e.select("event_id", F.concat(F.lit('"'), "event_type", F.lit('"')).alias("props")))
    return M.flatten_json(rows, "event_id", "props")


@query("select event_id as id, 'k' as field, json_extract_string(props, '$.k') as value from events where trim(coalesce(json_extract_string(props, '$.k'), '')) <> ''")
def json_fields(spark, sf_dir):
    return M.array_fields(table(spark, sf_dir, "events"), "event_id", "props", ["k", "absent"])


@query("select doc_id as id, generate_subscripts(string_split(text, chr(10)), 1)::int as line, unnest(string_split(text, chr(10))) as content from documents")
def numbered_lines(spark, sf_dir):
    return M.numbered_lines(table(spark, sf_dir, "documents"), "doc_id", "text")


@query(
    f"""with {TEXTS} select case when starts_with(key, 'quests.') then 'quests' else coalesce(ns_project, '') end as unit, count(*) as keys,
  count(*) filter (trim(coalesce(fr, '')) = '') as missing from texts where not starts_with(key, '_') and trim(english) <> '' group by 1"""
)
def inventory_units(spark, sf_dir):
    return I.units(texts(spark, sf_dir))


@query(
    f"""with {TEXTS} select case when coalesce(origin_fr = 'vanilla', false) then 'base game' when starts_with(key, '_') then 'comment' when trim(english) = '' then 'without English' else 'kept' end as reason,
  count(*) as n from texts group by 1"""
)
def inventory_exclusions(spark, sf_dir):
    t = texts(spark, sf_dir)
    return I.exclusion_counts(t, t.limit(0).select("key"))


@query(
    f"""with {ENTRIES}, e as (select ns, key, arg_max(value, (jar, ord)) as en from entries where layer = 'jar' and locale = 'en_us' group by all)
select ns, key, en from e where not starts_with(key, '_') and trim(en) <> '' and key not in (select key from entries where layer <> 'vanilla' and locale = 'fr_fr' and trim(value) <> '')"""
)
def inventory_delta(spark, sf_dir):
    return I.delta(entries(spark, sf_dir))


@query(
    """with r as (select source as unit, lpad(cast(doc_id as varchar), 12, '0') as key, row_number() over (partition by source order by doc_id) - 1 as place from documents)
select unit, place // 200 as batch, count(*)::int as keys, min(key) as first_key, (case when place // 200 = 0 then 0 else 30 end)::int as context from r group by all"""
)
def make_batches(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("unit"), F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("key"))
    return I.batches(d).select("unit", "batch", F.size("keys").alias("keys"), F.col("keys")[0].alias("first_key"), F.size("context").alias("context"))


@query(f"with {PAIRS} select p_name as term, count(*) as n from pairs join (select distinct p_name from part) on contains(lower(en), lower(p_name)) group by 1")
def batch_terms(spark, sf_dir):
    g = table(spark, sf_dir, "part").select(F.col("p_name").alias("en")).distinct()
    return I.batch_terms(pairs(spark, sf_dir), g).select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


_SEGMENTS = "select c_mktsegment as en, n_name as fr, cast(c_custkey as varchar) as key from customer join nation on c_nationkey = n_nationkey"


@query(f"with p as ({_SEGMENTS}) select en, count(distinct fr) as n_variants, count(*) as n_places from p group by en having count(distinct fr) > 1")
def divergence_index(spark, sf_dir):
    """Segments as English texts, nations of their customers as French ones."""
    d = I.divergences(_segments(spark, sf_dir))
    places = F.aggregate(F.map_values("variants"), F.lit(0), lambda a, x: a + F.size(x))
    return d.select("en", F.size("variants").cast("bigint").alias("n_variants"), places.cast("bigint").alias("n_places"))


def _segments(spark, sf_dir):
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_mktsegment").alias("en"), F.col("n_name").alias("fr"), F.col("c_custkey").cast("string").alias("key"))


@query(
    f"with p as ({_SEGMENTS}), c as (select en, min(fr) as after from p group by en) select key, fr as before, after from p join c using (en) where fr <> after"
)
def divergence_choices(spark, sf_dir):
    """The first variant of each English text put in the place of the others."""
    p = _segments(spark, sf_dir)
    return I.apply_choices(I.divergences(p), p.groupBy("en").agg(F.min("fr").alias("fr")))


@query(
    """select p_type as en, count(*) as n, string_agg(distinct p_brand, ',' order by p_brand) as spaces, array_to_string(list_sort(list(cast(p_partkey as varchar)))[1:3], ',') as sample from part group by p_type having count(*) >= 3"""
)
def glossary_candidates(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(
        F.col("p_type").alias("en"), F.col("p_brand").alias("space"), F.col("p_partkey").cast("string").alias("key"), F.lit(None).cast("string").alias("witness"), F.lit("project").alias("origin"), F.col("p_name").alias("fr")
    )
    return I.glossary_candidates(p).select("en", "n", F.array_join("spaces", ",").alias("spaces"), F.array_join("sample", ",").alias("sample"))


@query(
    rf"""with {PAIRS}, w as (select key, unnest(list_distinct(regexp_extract_all(replace(lower(strip_accents(en)), 'œ', 'oe'), '([a-z0-9]+)', 1))) as term, regexp_extract_all(replace(lower(strip_accents(fr)), 'œ', 'oe'), '([a-z0-9]+)', 1) as fw from pairs),
s as (select term, length(term) >= 4 and len(list_filter(fw, lambda x: length(x) >= 4 and (starts_with(x, term) or starts_with(term, x)))) > 0 as kept from w where term in (select lower(unnest(string_split(p_name, ' '))) from part) or term in ('tion', 'ment', 'ouque', 'thenand'))
select term, count(*) filter (kept) as kept, count(*) filter (not kept) as translated from s group by term having count(*) filter (kept) > 0 and count(*) filter (not kept) > 0"""
)
def term_treatment(spark, sf_dir):
    own = table(spark, sf_dir, "part").select(F.explode(F.split(F.lower("p_name"), " ")).alias("term"))
    terms = own.unionByName(spark.createDataFrame([("tion",), ("ment",), ("ouque",), ("thenand",)], "term string")).distinct()
    return I.term_treatment(pairs(spark, sf_dir), terms)


@query(
    rf"""with d as (select source as unit, ' ' || regexp_replace(lower(text), '[^\p{{L}}\p{{N}}_]+', ' ', 'g') || ' ' as t from documents),
c as (select unit, count(*) filter (regexp_matches(t, ' (tu|te|toi|ton|ta|tes) ')) as familiar, count(*) filter (regexp_matches(t, ' (vous|votre|vos) ')) as formal from d group by unit)
select * from c where familiar > 0 and formal > 0"""
)
def register_mix(spark, sf_dir):
    return I.register_mix(table(spark, sf_dir, "documents").select(F.col("source").alias("unit"), F.col("text").alias("fr")))


_REV = """a as (select source as file, cast(doc_id as varchar) as key, text as value from documents),
b as (select source as file, cast(doc_id as varchar) as key, case when n_chars % 5 = 0 then strip_accents(text) when n_chars % 5 = 1 then text || '!' else text end as value from documents where n_chars % 7 <> 0)"""


@query(
    f"""with {_REV} select a.file, a.key, case when b.key is null then 'disappeared' when {fold_sql('a.value')} = {fold_sql('b.value')} then 'accents' else 'substance' end as kind
from a left join b using (file, key) where a.file <> 'src3' and a.value is distinct from b.value"""
)
def revision_diff(spark, sf_dir):
    """Documents against a revision without some, with others stripped of their accents or changed; one file can't be read."""
    d = table(spark, sf_dir, "documents")
    a = d.select(F.col("source").alias("file"), F.col("doc_id").cast("string").alias("key"), F.col("text").alias("value"))
    bare = F.translate("text", *T._FOLD_MN)
    changed = F.when(F.col("n_chars") % 5 == 0, bare).when(F.col("n_chars") % 5 == 1, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    b = d.filter("n_chars % 7 <> 0").select(F.col("source").alias("file"), F.col("doc_id").cast("string").alias("key"), changed.alias("value"))
    return I.revision_diff(a, b, spark.createDataFrame([("src3",)], "file string"))


@query(
    f"""select cast(doc_id as varchar) as key, case when n_chars % 6 = 0 then 'absent' when n_chars % 6 = 1 then case when upper(text) = text then 'equal' when contains(text, 'ß') then 'accents' else 'case' end
  when n_chars % 6 = 2 then case when strip_accents(text) = text then 'equal' else 'accents' end when n_chars % 6 = 3 then 'substance' when n_chars % 6 = 4 then 'blank' else 'equal' end as class from documents"""
)
def provenance_classes(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    k = F.col("n_chars") % 6
    now = F.when(k == 1, F.upper("text")).when(k == 2, F.translate("text", *T._FOLD_MN)).when(k == 3, F.concat("text", F.lit("!"))).when(k == 4, " ").otherwise(F.col("text"))
    said = d.filter(k != 0).select(F.col("doc_id").cast("string").alias("key"), now.alias("fr"))
    decided = d.select(F.col("doc_id").cast("string").alias("key"), F.col("text").alias("decided"))
    return I.provenance_classes(decided, said)


@query(
    r"""with k as (select distinct unnest(regexp_extract_all(lower(text), '([a-z]{4,})', 1)) as key from conversations),
p as (select distinct unnest(regexp_extract_all(lower(text), '([a-z]{4,})', 1)) as w from documents), j as (select distinct unnest(regexp_extract_all(lower(text), '([a-z]{3,})', 1)) as w from benchmark)
select key, case when key in (select w from p) then 'pack' when key in (select w from j) then 'jar' when left(key, 3) in (select w from j) then 'prefix' else 'suspect' end as state from k"""
)
def key_liveness(spark, sf_dir):
    ws = lambda t, n: table(spark, sf_dir, t).select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(f"([a-z]{{{n},}})"), 1)).alias("word")).distinct()
    keys = ws("conversations", 4).select(F.col("word").alias("key"), F.left("word", F.lit(3)).alias("prefix"))
    return I.key_liveness(keys, ws("documents", 4), ws("benchmark", 3))


@query()
def rendering_associations(spark, sf_dir):
    """French n-grams that go with English ones over all pairs."""
    return I.associations(pairs(spark, sf_dir).select("key", "en", "fr"), least=4)


@query(
    """with n as (select c_mktsegment as term, n_name as rendering, count(*)::int as new from customer join nation on c_nationkey = n_nationkey group by all)
select * from (select term, (row_number() over (partition by term order by new desc, rendering))::int as rank, rendering, new from n) where rank <= 4"""
)
def rendering_covers(spark, sf_dir):
    """Greedy covers of each segment's customers by their nations."""
    return I.covers(_segments(spark, sf_dir).select(F.col("en").alias("term"), F.col("fr").alias("rendering"), "key"))


# --- search ----------------------------------------------------------------------------------------------------------------

_HIT = f"contains({fold_sql('coalesce(en, {0})')}, 'eau') or contains({fold_sql('coalesce(fr, {0})')}, 'eau')".replace("{0}", "''")


def _folded(spark, sf_dir):
    return S.folded_index(M.key_index(entries(spark, sf_dir)))


@query(f"with {_INDEX} select id, origin from idx where {_HIT}")
def search_default(spark, sf_dir):
    return S.search(_folded(spark, sf_dir), "Éau").select("id", "origin")


@query(f"with {_INDEX} select id from idx where ns = 'ns1' and (contains(',' || present_pack || ',' || present_mods || ',', ',fr_fr,') or contains(',' || present_pack || ',' || present_mods || ',', ',ko_kr,')) and not contains(',' || present_pack || ',' || present_mods || ',', ',zh_cn,')")
def search_presence(spark, sf_dir):
    return S.search(_folded(spark, sf_dir), ns="ns1", present=["fr_fr", "ko_kr"], absent=["zh_cn"]).select("id")


@query(f"with {_INDEX} select id from idx where contains(',' || present_pack || ',', ',fr_fr,') and contains({fold_sql('key')}, 'item.')")
def search_in_pack(spark, sf_dir):
    return S.search(_folded(spark, sf_dir), "ITEM.", field="key", present=["fr_fr"], scope="pack").select("id")


@query(
    f"""with {_INDEX} select 'ns' as facet, ns as value, count(*) as n from idx group by all union all select 'origin', origin, count(*) from idx group by all
union all select 'locale', l, count(*) from (select unnest(list_distinct(list_filter(string_split(present_pack || ',' || present_mods, ','), lambda x: x <> ''))) as l from idx) group by all"""
)
def search_facets(spark, sf_dir):
    return S.facets(M.key_index(entries(spark, sf_dir)))


@query(f"with {_INDEX} select id from idx order by ns, key limit 25 offset 10")
def search_page(spark, sf_dir):
    """The second page of ids in a total order; the limit is the feature."""
    return S.page(M.key_index(entries(spark, sf_dir)), 10, 25).select("id")


@query(f"with {_INDEX} select 'entries' as item, count(*) as n from idx union all select 'keys', count(distinct key) from idx union all select 'locales', count(distinct l) from (select unnest(string_split(present_pack || ',' || present_mods, ',')) as l from idx) where l <> '' union all select 'unreadable', 0")
def search_health(spark, sf_dir):
    i = M.key_index(entries(spark, sf_dir))
    return S.health(i, i.limit(0))


@query("select lang as space, count(*) as n from documents where regexp_matches(text, '(?i)license') group by 1 order by n desc, space limit 8")
def search_counts(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("lang").alias("space"), F.col("text").alias("en"))
    return S.count_matching(d, {"en": "license"})


# --- sets ------------------------------------------------------------------------------------------------------------------


@query("select c_nationkey as nation from customer union select s_nationkey from supplier")
def set_union(spark, sf_dir):
    a = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"))
    return a.union(table(spark, sf_dir, "supplier").select("s_nationkey")).distinct()


@query("select o_custkey as cust from orders intersect select c_custkey from customer")
def set_intersection(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("cust")).intersect(table(spark, sf_dir, "customer").select("c_custkey"))


@query("select nation, count(*) as n from (select c_nationkey as nation from customer except all select s_nationkey from supplier) group by 1")
def multiset_difference(spark, sf_dir):
    a = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"))
    return a.exceptAll(table(spark, sf_dir, "supplier").select("s_nationkey")).groupBy("nation").agg(F.count(F.lit(1)).alias("n"))


@query("select c_custkey as id from customer where c_custkey not in (select o_custkey from orders) union all select distinct o_custkey from orders where o_custkey not in (select c_custkey from customer)")
def symmetric_difference(spark, sf_dir):
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    b = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id")).distinct()
    return a.join(b, "id", "left_anti").unionByName(b.join(a, "id", "left_anti"))


@query("select o_custkey as id, case when count(*) > 1 then 'in several zones' end as problem from orders group by 1 having count(*) > 1 union all select c_custkey, 'in no zone' from customer where c_custkey not in (select o_custkey from orders)")
def exactly_once(spark, sf_dir):
    """Customers that orders cover not exactly once."""
    from ..operators.sampling import cover_problems

    members = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("zone"), F.col("o_custkey").alias("id"))
    return cover_problems(members, table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id")))
