"""The rule operators and the ledgers over whole driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import controls as C
from ..operators import ledger as L
from ..operators import matching as X
from ..operators import model as M
from .analogs import (
    BOOKS, DEBT, ENTRIES, EXCEPTIONS, PAIRS, RECONCILED, TEXTS, books, debt, entries, exceptions, findings, journal, paired_texts, pairs, table, texts, values,
)
from .text_queries import CODES_SQL, words_sql

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _rows(df):
    """Findings in scalar columns."""
    return df.select("control", "key", "status", "detail", F.array_join("object", ",").alias("object"))


@query(
    f"""with {TEXTS}, {BOOKS}, w as (select ns, key, string_agg(distinct locale, ', ' order by locale) as ls, bool_or(trim(value) <> '') as said from entries where layer = 'project' and locale in ('ko_kr', 'zh_cn') group by all),
d as (select key from (select key, ns, arg_max(value, ord) as value from entries where layer = 'project' and locale = 'fr_fr' group by all) group by key having count(distinct value) > 1),
s as (select t.key, t.fr, (select bool_or(said) from w where w.key = t.key) as said from texts t where origin_en = 'project' and not starts_with(key, '_') and not starts_with(key, 'quests.') and trim(english) = '' and trim(coalesce(fr, '')) = '')
select 'coverage' as control, key, 'blocking' as status, case when fr is null then 'English without French' else 'blank French' end as detail, '' as object from texts
  where trim(english) <> '' and not starts_with(key, '_') and (coalesce(origin_en <> 'vanilla', true) or origin_fr = 'project') and trim(coalesce(fr, '')) = ''
union all select 'coverage', w.key, 'blocking', 'only in witnesses: ' || ls, '' from w left join texts t using (key) where t.fr is null and not starts_with(w.key, '_') and (not starts_with(w.key, 'quests.') or trim(coalesce(t.english, '')) <> '')
union all select 'coverage', key, 'flagged', 'defined in several files with different values', '' from d where not starts_with(key, '_')
union all select 'coverage', key, 'blocking', 'book field without French', '' from books where trim(en) <> '' and trim(fr) = ''
union all select 'coverage', key, 'blocking', case when fr is not null and said is null then 'blank without witness' else 'object without English' end, '' from s where not (fr is null and said is not null) and coalesce(said, true)"""
)
def control_coverage(spark, sf_dir):
    e = entries(spark, sf_dir)
    return _rows(C.coverage(texts(spark, sf_dir), M.witnesses(e), M.duplicate_definitions(e), books(spark, sf_dir)))


@query(
    f"""with {PAIRS}, {BOOKS}, p as (select key, en, fr from pairs where fr <> '' union all select key, en, fr from books where fr <> '')
select 'codes' as control, key, 'blocking' as status from p where en <> '' and list_sort(regexp_extract_all(en, '({CODES_SQL})', 1)) <> list_sort(regexp_extract_all(fr, '({CODES_SQL})', 1))
union all select 'codes', 'journal', 'blocking'"""
)
def control_codes(spark, sf_dir):
    return C.code_control(paired_texts(spark, sf_dir), books(spark, sf_dir), journal(spark)).select("control", "key", "status")


@query(f"with {TEXTS} select 'essences' as control, 'wood_type.' || lower(n_name) as key, 'blocking' as status from nation where 'wood_type.' || lower(n_name) not in (select key from texts where coalesce(fr, '') <> '')")
def control_essences(spark, sf_dir):
    e = table(spark, sf_dir, "nation").select(F.concat(F.lit("wood_type."), F.lower("n_name")).alias("essence"))
    return C.essence_control(texts(spark, sf_dir), e).select("control", "key", "status")


@query(
    """with g as (select p_name as en, p_type as fr, p_partkey as ord from part), f as (select en, regexp_replace(lower(fr), '([a-z]{3,}?)[sx]\\b', '\\1', 'g') as form from g)
select 'glossary' as control, 'glossary:' || en as key, 'blocking' as status from f group by en having count(distinct form) > 1""".replace("\\\\", "\\")
)
def control_glossary(spark, sf_dir):
    """Part names as terms and their types as French: those with several types contradict themselves."""
    g = table(spark, sf_dir, "part").select(F.col("p_name").alias("en"), F.col("p_type").alias("fr"), F.lit("").alias("sense"), F.col("p_partkey").alias("ord"))
    return C.glossary_control(paired_texts(spark, sf_dir), books(spark, sf_dir), g).select("control", "key", "status")


@query()
def control_numbers(spark, sf_dir):
    """Pairs and books that lose numbers; the French side's number words are tested against plain Python."""
    return _rows(C.number_control(paired_texts(spark, sf_dir), books(spark, sf_dir)))


def _labels(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").cast("string").alias("key"), F.col("c_nationkey").cast("string").alias("label"), F.col("c_mktsegment").alias("rendering"))


@query(
    """with n as (select c_nationkey, c_mktsegment, count(*) as n from customer group by all), m as (select *, row_number() over (partition by c_nationkey order by n desc, c_mktsegment) as r, lead(n) over (partition by c_nationkey order by n desc, c_mktsegment) as next from n)
select cast(c_nationkey as varchar) as label, cast(c_custkey as varchar) as key, customer.c_mktsegment as rendering, m.c_mktsegment as "right", n from customer join m using (c_nationkey) where r = 1 and n > next and customer.c_mktsegment <> m.c_mktsegment"""
)
def label_majority(spark, sf_dir):
    return C.label_majority(_labels(spark, sf_dir))


def _part_names(spark, sf_dir):
    """Parts as named objects: their name in English, brand and type in French."""
    p = table(spark, sf_dir, "part")
    rows = p.select(
        F.concat(F.lit("item.parts.p"), F.col("p_partkey").cast("string")).alias("key"), F.col("p_name").alias("english"), F.concat_ws(" ", "p_type", "p_brand").alias("fr"), F.lit("project").alias("origin_fr")
    )
    return M.registry(rows)


@query(
    f"""with n as (select 'item.parts.p' || p_partkey as key, p_name as en, p_type || ' ' || p_brand as fr from part), t as (select key, {words_sql('en')} as ew, {words_sql('fr')} as fw from n)
select key, array_to_string(ew, ' ') as en_tokens, array_to_string(fw, ' ') as fr_tokens, len(ew) >= 2 or (len(ew) = 1 and length(ew[1]) >= 5) as citable from t"""
)
def name_registry(spark, sf_dir):
    return _part_names(spark, sf_dir).select("key", F.array_join("en_tokens", " ").alias("en_tokens"), F.array_join("fr_tokens", " ").alias("fr_tokens"), "citable")


@query(
    f"""with n as (select 'item.parts.p' || p_partkey as key, {words_sql('p_name')} as ew, {words_sql("p_type || ' ' || p_brand")} as fw from part)
select array_to_string(ew, ' ') as en_tokens, min(key) as head, count(*)::int as keys from n group by ew having count(distinct fw) > 1"""
)
def homonym_groups(spark, sf_dir):
    return M.homonym_groups(_part_names(spark, sf_dir)).select(F.array_join("en_tokens", " ").alias("en_tokens"), "head", F.size("keys").alias("keys"))


@query(
    f"""with n as (select 'item.parts.p' || p_partkey as key, {words_sql('p_name')} as ew, {words_sql("p_type || ' ' || p_brand")} as fw from part),
g as (select min(key) as key, string_agg(key, ',' order by key) as object from n group by ew having count(distinct fw) > 1),
l as (select c_nationkey, c_mktsegment, count(*) as n from customer group by all), m as (select *, row_number() over (partition by c_nationkey order by n desc, c_mktsegment) as r, lead(n) over (partition by c_nationkey order by n desc, c_mktsegment) as next from l)
select 'homonyms' as control, key, 'blocking' as status, 'one English name, several French ones' as detail, object from g union all
select 'homonyms', cast(c_custkey as varchar), 'blocking', 'label rendered otherwise elsewhere', cast(c_nationkey as varchar) from customer join m using (c_nationkey) where r = 1 and n > next and customer.c_mktsegment <> m.c_mktsegment"""
)
def control_homonyms(spark, sf_dir):
    return _rows(C.homonym_control(M.homonym_groups(_part_names(spark, sf_dir)), _labels(spark, sf_dir)))


def _terms(spark):
    rows = [("the", ["le", "la"], "all", None, ["les"], "articles", 1), ("and", ["Et"], "texts", "^turn", ["und"], "links", 2), ("of", ["de"], "names", None, [], "names", 3)]
    return spark.createDataFrame(rows, "english string, french array<string>, scope string, keys string, banned array<string>, reason string, ord int")


def _has(words: str, name: str) -> str:
    return f"contains(' ' || array_to_string({words}, ' ') || ' ', ' {name} ')"


@query(
    f"""with {PAIRS}, {BOOKS}, p as (select key, en, fr from pairs union all select key, en, fr from books where fr <> ''), w as (select key, en, {words_sql('fr')} as ws,
  regexp_matches(en, '(?i)(^|[^\\p{{L}}\\p{{N}}_])the($|[^\\p{{L}}\\p{{N}}_])') as a from p)
select 'terms' as control, key, 'flagged' as status, 'imposed term absent' as detail, 'the' as object from w where a and not {_has('ws', 'le')} and not {_has('ws', 'la')}
union all select 'terms', key, 'blocking', 'forbidden rendering', 'the ≠ les' from w where a and {_has('ws', 'les')}"""
)
def control_terms(spark, sf_dir):
    """An imposed term over all pairs and books: absent, or rendered as it mustn't be."""
    return _rows(C.term_control(paired_texts(spark, sf_dir), books(spark, sf_dir), _terms(spark).filter("english = 'the'")))


@query()
def control_terms_scoped(spark, sf_dir):
    """Terms with scopes, key filters and capitals."""
    return _rows(C.term_control(paired_texts(spark, sf_dir), books(spark, sf_dir), _terms(spark)))


def _limits(spark):
    rows = [("turn.1.0", None, None, 100, None, None, None, "by hand", 1), (None, None, r"\.0$", 102, 3, "cut off", "mod", "screen", 2), (None, ["turn.2.0"], None, 500, None, "scrolls", "mod", "bar", 3)]
    return spark.createDataFrame(rows, "key string, keys array<string>, pattern string, limit int, lines int, behaviour string, mod string, proof string, ord int")


@query()
def control_width(spark, sf_dir):
    """Manual limits and constraints over all pairs; wrapping is a fold, tested against plain Python."""
    sold = spark.createDataFrame([("parts:p1",)], "id string")
    return _rows(C.width_control(paired_texts(spark, sf_dir), sold, _limits(spark)))


@query()
def control_conventions(spark, sf_dir):
    return _rows(C.convention_control(paired_texts(spark, sf_dir), books(spark, sf_dir), journal(spark)))


@query(
    f"""with {PAIRS}, {BOOKS}, p as (select key, en, fr from pairs where fr <> '' union all select key, en, fr from books where fr <> ''),
w as (select key, {words_sql('fr')} as fw, {words_sql('en')} as ew from p) select distinct unnest(list_filter(fw, lambda x: not list_contains(ew, x))) as word from w"""
)
def residual_lexicon(spark, sf_dir):
    """Words taken for French over all pairs and books."""
    return C.french_lexicon(paired_texts(spark, sf_dir), books(spark, sf_dir))


@query()
def control_residual(spark, sf_dir):
    return _rows(C.residual_control(paired_texts(spark, sf_dir), books(spark, sf_dir)))


@query()
def control_accents(spark, sf_dir):
    """A vocabulary of words whose only form has accents, taken from the French documents themselves."""
    w = table(spark, sf_dir, "documents").filter("lang = 'fr'").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}{6,})"), 1)).alias("form")).distinct()
    return _rows(C.accent_control(paired_texts(spark, sf_dir), books(spark, sf_dir), journal(spark), w.select(T.fold(F.col("form")).alias("folded"), "form")))


@query("select cast(user_id as varchar) as key, arg_max(event_type, event_id) as decided from events group by 1")
def decision_last(spark, sf_dir):
    """Events as decisions: the latest of each user."""
    e = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("key"), F.col("event_type").alias("fr"), F.col("event_id").alias("seq"))
    return C.last_decision(e)


@query(
    """with l as (select cast(user_id as varchar) as key, arg_max(event_type, event_id) as decided from events group by 1), s as (select cast(c_custkey as varchar) as key, case when c_nationkey % 2 = 0 then 'click' else 'view' end as fr from customer)
select 'decisions' as control, key, case when s.fr is null then 'decided key is absent' else 'differs from the last decision' end as detail from l left join s using (key) where decided is distinct from s.fr"""
)
def control_decisions(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("key"), F.col("event_type").alias("fr"), F.col("event_id").alias("seq"))
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("key"), F.when(F.col("c_nationkey") % 2 == 0, "click").otherwise("view").alias("fr"))
    return C.decision_control(c, e).select("control", "key", "detail")


@query(
    """select 'patches' as control, cast(s_suppkey as varchar) as key, case when n_nationkey is null then 'script not found upstream' else 'changed upstream since the patch' end as detail
from supplier left join nation on s_suppkey = n_nationkey where n_name is distinct from 'NATION_' || s_nationkey"""
)
def control_patches(spark, sf_dir):
    p = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("key"), F.concat(F.lit("NATION_"), F.col("s_nationkey").cast("string")).alias("base"))
    u = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("key"), F.col("n_name").alias("sha"))
    return C.patch_control(p, u).select("control", "key", "detail")


def _families(spark, sf_dir):
    """Parts as sources, and a chain of names made from each."""
    p = table(spark, sf_dir, "part")
    base = p.select(F.concat(F.lit("item.parts.p"), F.col("p_partkey").cast("string")).alias("key"), F.col("p_name").alias("fr"))
    made = p.select(F.explode(F.array(*(F.concat(F.lit(f"item.made.{k}_p"), F.col("p_partkey").cast("string")) for k in ("roe", "aged", "lost")))).alias("key"))
    families = spark.createDataFrame(
        [("aged", "item.made.aged_{id}", "{Source} vieilli", ["item.made.roe_{id}"], 1), ("roe", "item.made.roe_{id}", "Oeufs de {source}", ["item.parts.{id}"], 2), ("lost", "item.made.lost_{id}", "{source}", ["item.none.{id}"], 3)],
        "family string, pattern string, template string, sources array<string>, ord int",
    )
    members = C.family_members(made, families)
    none = spark.createDataFrame([], "key string, gender string, number string, proper boolean, plural string")
    return C.family_names(members, base, none)


_DE = "case when left(p_name, 1) in ('a', 'e', 'i', 'o', 'u') or left(p_name, 1) = 'h' then 'Oeufs d''' else 'Oeufs de ' end || p_name"


@query(
    f"""select 'item.made.roe_p' || p_partkey as key, 'roe' as family, {_DE} as expected, null as problem from part
union all select 'item.made.aged_p' || p_partkey, 'aged', {_DE} || ' vieilli', null from part union all select 'item.made.lost_p' || p_partkey, 'lost', null, 'unknown source' from part"""
)
def family_fixpoint(spark, sf_dir):
    return _families(spark, sf_dir)


@query(f"select 'families' as control, 'item.made.roe_p' || p_partkey as key, {_DE} as expected from part where p_name <> {_DE} union all select 'families', 'item.made.lost_p' || p_partkey, '' from part union all select 'families', 'item.made.aged_p' || p_partkey, {_DE} || ' vieilli' from part")
def control_families(spark, sf_dir):
    """Every made name is said to be its part's plain name, so all of them differ from their template."""
    p = table(spark, sf_dir, "part")
    said = p.select(F.explode(F.array(*(F.concat(F.lit(f"item.made.{k}_p"), F.col("p_partkey").cast("string")) for k in ("roe", "aged", "lost")))).alias("key"), F.col("p_name").alias("fr"))
    return C.family_control(_families(spark, sf_dir), said).select("control", "key", "expected")


@query()
def control_templates(spark, sf_dir):
    rows = [("turn.0.0", [["object"], ["season"]])]
    return _rows(C.template_control(paired_texts(spark, sf_dir), spark.createDataFrame(rows, "key string, types array<array<string>>")))


@query(
    rf"""with {PAIRS}, {BOOKS}, p as (select key, fr from pairs where fr <> '' union all select key, fr from books where fr <> '' union all select 'journal', '# Un' || chr(10) || '- a' || chr(10) || '## b' || chr(10) || '---')
select 'spelling' as control, key, 'the' as object from p where regexp_matches(fr, '(?i)(^|[^\p{{L}}\p{{N}}_])the($|[^\p{{L}}\p{{N}}_])')
union all select 'spelling', key, 'La' from p where regexp_matches(fr, '(^|[^\p{{L}}\p{{N}}_])La($|[^\p{{L}}\p{{N}}_])')"""
)
def control_spelling(spark, sf_dir):
    """Two known mistakes over all pairs and books, one in any case."""
    forms = spark.createDataFrame([("the", "le", False, "seen"), ("La", "Le", True, "seen")], "form string, right string, exact boolean, source string")
    return C.spelling_control(paired_texts(spark, sf_dir), books(spark, sf_dir), journal(spark), forms).select("control", "key", F.array_join("object", ",").alias("object"))


@query()
def control_case(spark, sf_dir):
    return _rows(C.case_control(paired_texts(spark, sf_dir), ["Ouque", "Tion"]))


def _citing(spark, sf_dir):
    """Documents as citing texts, and frequent word pairs of the benchmark and single long words as names."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("key"), T.words(F.col("text")).alias("ws"))
    ws = table(spark, sf_dir, "benchmark").select(T.words(F.col("text")).alias("ws"))
    two = ws.select(F.explode(F.transform(F.sequence(F.lit(1), F.size("ws") - 1), lambda i: F.slice("ws", i, 2))).alias("motif"))
    one = ws.select(F.explode(F.filter("ws", lambda w: F.length(w) >= 4)).alias("w")).select(F.array("w").alias("motif"))
    return d, two.unionByName(one).distinct()


_CITE = f"""d as (select cast(doc_id as varchar) as key, {words_sql('text')} as ws from documents), b as (select {words_sql('text')} as ws from benchmark),
m as (select distinct unnest(list_transform(range(1, len(ws)), lambda i: ws[i:i + 1])) as motif from b union select distinct [x] from (select unnest(list_filter(ws, lambda w: length(w) >= 4)) as x from b)),
s as (select key, generate_subscripts(ws, 1) - 1 as pos, unnest(ws) as w1, ws[generate_subscripts(ws, 1) + 1] as w2 from d),
h as (select key, pos, len(motif) as len from s join m on motif = [w1] or motif = [w1, w2])"""


@query(f"with {_CITE} select key, count(*) as hits, max(len)::int as longest from h group by key")
def ngram_hits(spark, sf_dir):
    """Every place of a name in a text, overlaps included."""
    d, m = _citing(spark, sf_dir)
    return X.hits(d, m).groupBy("key").agg(F.count(F.lit(1)).alias("hits"), F.max("len").alias("longest"))


@query(
    f"""with recursive {_CITE}, l as (select key, pos, max(len) as len from h group by all), o as (select *, row_number() over (partition by key order by pos) as r from l),
walk as (select key, r, pos, len, pos + len as free, true as kept from o where r = 1
  union all select o.key, o.r, o.pos, o.len, case when o.pos >= walk.free then o.pos + o.len else walk.free end, o.pos >= walk.free from walk join o on o.key = walk.key and o.r = walk.r + 1)
select key, count(*) as citations, sum(len)::bigint as covered from walk where kept group by key"""
)
def ngram_citations(spark, sf_dir):
    """The names a text cites: leftmost, longest, without overlaps."""
    d, m = _citing(spark, sf_dir)
    return X.citations(d, m).groupBy("key").agg(F.count(F.lit(1)).alias("citations"), F.sum("len").alias("covered"))


@query()
def control_references(spark, sf_dir):
    """Turns that cite a part by its English name should use its French one."""
    none = spark.createDataFrame([], "key string, object_id string")
    pins = spark.createDataFrame([("turn.0.0", "item.parts.p1")], "key string, object string")
    p = table(spark, sf_dir, "part")
    said = pairs(spark, sf_dir).select("key", "en", "fr", "space").unionByName(p.select(F.concat(F.lit("text."), F.col("p_partkey").cast("string")).alias("key"), F.concat(F.lit("take the "), "p_name").alias("en"), F.col("p_type").alias("fr"), F.lit("x").alias("space")))
    said = said.select("key", "en", F.lit("project").alias("origin_en"), "fr", F.lit("project").alias("origin_fr"), F.col("space").alias("ns_project"), F.col("en").alias("english"))
    return _rows(C.reference_control(said, _part_names(spark, sf_dir), none, pins))


@query()
def name_families(spark, sf_dir):
    """Endings that names share in English, and what they all begin with in French."""
    p = table(spark, sf_dir, "part")
    rows = p.select(F.concat(F.lit("item.parts.p"), F.col("p_partkey").cast("string")).alias("key"), F.concat_ws(" ", "p_type", "p_name").alias("english"), F.concat_ws(" ", "p_name", "p_brand").alias("fr"), F.lit("project").alias("origin_fr"))
    out = X.name_families(M.registry(rows), ["the", "of"], ["de", "du"])
    return out.select(F.array_join("ending", " ").alias("ending"), F.array_join("prefix", " ").alias("prefix"), "n")


# --- ledgers ---------------------------------------------------------------------------------------------------------------


def _reconciled(spark, sf_dir):
    return L.reconcile(findings(spark, sf_dir), exceptions(spark, sf_dir), debt(spark, sf_dir), values(spark, sf_dir))


@query(f"with {RECONCILED} select control, key, detail, bucket, exception, escalated from reconciled")
def ledger_apply(spark, sf_dir):
    return _reconciled(spark, sf_dir).select("control", "key", "detail", "bucket", "exception", "escalated")


@query(f"with {RECONCILED} select control, count(*) filter (bucket = 'blocking') as blocking, count(*) filter (bucket = 'flagged') as flagged, count(*) filter (bucket = 'debt') as debt, count(*) filter (bucket = 'covered') as covered from reconciled group by 1")
def report_pivot(spark, sf_dir):
    return L.report(_reconciled(spark, sf_dir))


@query(f"with {RECONCILED}, r as (select control, key, detail, row_number() over (partition by control order by key, detail) as rank from reconciled where bucket = 'flagged') select control, key, detail, rank::int as rank from r where rank <= 20")
def top20_per_control(spark, sf_dir):
    """The first twenty flagged findings of each control; the limit is the feature."""
    return L.first_flagged(_reconciled(spark, sf_dir)).select("control", "key", "detail", "rank")


_RAN = ["c-en", "c-fr", "c-de"]


@query(f"with {RECONCILED} select ord, control, key from valid where control in ('c-en', 'c-fr', 'c-de') and ord not in (select exception from reconciled where bucket = 'covered')")
def ledger_orphans(spark, sf_dir):
    return L.orphan_exceptions(exceptions(spark, sf_dir), _reconciled(spark, sf_dir), _RAN).select("ord", "control", "key")


@query(
    f"with {RECONCILED} select control, key, object, fingerprint from debt d where control in ('c-en', 'c-fr', 'c-de') and not exists(select 1 from reconciled r where r.bucket <> 'covered' and r.control = d.control and r.key = d.key and r.object = d.object)"
)
def ledger_resolved(spark, sf_dir):
    return L.resolved_debt(debt(spark, sf_dir), _reconciled(spark, sf_dir), _RAN).select("control", "key", F.array_join("object", ",").alias("object"), "fingerprint")


@query(f"with {EXCEPTIONS} select ord, trim(reason) = '' as reasonless, trim(reason) <> '' and not pin and question <> '' as provisional from exceptions where trim(reason) = '' or (not pin and question <> '')")
def ledger_states(spark, sf_dir):
    """Exceptions without a reason, and those that wait for an answer."""
    x = exceptions(spark, sf_dir)
    a = L.reasonless(x).select("ord", F.lit(True).alias("reasonless"), F.lit(False).alias("provisional"))
    return a.unionByName(L.provisional(x).select("ord", F.lit(False).alias("reasonless"), F.lit(True).alias("provisional")))


_BASE = "base as (select control, key, object, case when key like '%3' then 'other' else fingerprint end as fingerprint from debt where key not like '%7')"


def _baseline(spark, sf_dir):
    d = debt(spark, sf_dir)
    return d, d.filter("key not like '%7'").withColumn("fingerprint", F.when(F.col("key").like("%3"), "other").otherwise(F.col("fingerprint")))


@query(f"with {DEBT}, {_BASE} select d.control, d.key, d.object, d.fingerprint from debt d where not exists(select 1 from base b where b.control = d.control and b.key = d.key and b.object = d.object)")
def debt_increase(spark, sf_dir):
    return L.increased_debt(*_baseline(spark, sf_dir)).select("control", "key", F.array_join("object", ",").alias("object"), "fingerprint")


@query(
    f"with {DEBT}, {_BASE} select d.control, d.key, d.object, d.fingerprint from debt d where exists(select 1 from base b where b.control = d.control and b.key = d.key and b.object = d.object) and not exists(select 1 from base b where b.control = d.control and b.key = d.key and b.object = d.object and b.fingerprint = d.fingerprint)"
)
def debt_modified(spark, sf_dir):
    return L.modified_debt(*_baseline(spark, sf_dir)).select("control", "key", F.array_join("object", ",").alias("object"), "fingerprint")


@query(
    f"""with {RECONCILED}, o as (select 'blocking' as obstacle, count(*) as n from reconciled where bucket = 'blocking' union all select 'reasonless exceptions', count(*) from exceptions where trim(reason) = ''
union all select 'debt without deferral', count(*) from debt where key like '%7' union all select 'provisional exceptions', count(*) from valid where question <> ''
union all select 'orphan exceptions', count(*) from valid where control in ('c-en', 'c-fr', 'c-de') and ord not in (select exception from reconciled where bucket = 'covered')
union all select 'flagged', count(*) from reconciled where bucket = 'flagged') select * from o where n > 0"""
)
def closure_obstacles(spark, sf_dir):
    d, base = _baseline(spark, sf_dir)
    return L.obstacles(_reconciled(spark, sf_dir), exceptions(spark, sf_dir), d, base, _RAN)
