"""Rules over phrases made from whole driver tables: each row is put into one of a few forms, so that a rule's outcome is known for all.

What the rule gives is stated in SQL from the form alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import changes as K
from ..operators import controls as C
from ..operators import inventory as I
from ..operators import ledger as L
from ..operators import model as M
from ..operators import verify as V
from ..functions import text as T
from .analogs import pick, table
from .text_queries import words_sql

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _texts(rows: DataFrame, key, en, fr, ns=None, origin="project") -> DataFrame:
    """rows as effective texts."""
    return rows.select(
        key.alias("key"), en.alias("en"), F.lit("project").alias("origin_en"), fr.alias("fr"), F.lit(origin).alias("origin_fr"), (ns if ns is not None else F.lit("ns")).alias("ns_project"), F.lit(None).cast("string").alias("en_rebuilt"), en.alias("english")
    )


def _none(spark, schema: str = "key string, en string, fr string") -> DataFrame:
    return spark.createDataFrame([], schema)


def _rows(df: DataFrame) -> DataFrame:
    return df.select("control", "key", "status", "detail", F.array_join("object", ",").alias("object"))


def quoted(values: list[str]) -> str:
    """The list in SQL."""
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


# --- numbers ---------------------------------------------------------------------------------------------------------------

_DAYS = ["deux", "trois", "quatre", "cinq", "six", "sept", "huit", "neuf"]


def _payments(spark, sf_dir) -> DataFrame:
    """Orders as sentences with a sum of over a thousand and a number of days; the French keeps both, or not, by the order's number."""
    o = table(spark, sf_dir, "orders")
    form, days = F.col("o_orderkey") % 6, F.floor(F.col("o_orderkey") / 6) % 8 + 2
    k, rest = F.floor(F.col("o_custkey") / 1000) + 1, F.lpad((F.col("o_custkey") % 1000).cast("string"), 3, "0")
    english, french, dots = (F.concat_ws(sep, k.cast("string"), rest) for sep in (",", " ", "."))
    d = days.cast("string")
    fr = (
        F.when(form == 0, F.concat(F.lit("Payez "), french, F.lit(" en "), d, F.lit(" jours")))
        .when(form == 1, F.concat(F.lit("Payez "), french, F.lit(" en "), pick(_DAYS, days - 2), F.lit(" jours")))
        .when(form == 2, F.concat(F.lit("Payez "), french, F.lit(" vite")))
        .when(form == 3, F.concat(F.lit("En "), d, F.lit(" jours payez "), french))
        .when(form == 4, F.concat(F.lit("Payez "), english, F.lit(" en "), d, F.lit(" jours")))
        .otherwise(F.concat(F.lit("Payez "), dots, F.lit(" en "), d, F.lit(" jours")))
    )
    en = F.concat(F.lit("Pay "), english, F.lit(" in "), d, F.lit(" days {0} §6"))
    return _texts(o, F.concat(F.lit("text.o"), F.col("o_orderkey").cast("string")), en, fr)


_GAPS = """g as (select o_orderkey as k, 'text.o' || o_orderkey as key, o_orderkey % 6 as form, cast(o_orderkey // 6 % 8 + 2 as varchar) as d,
  cast(o_custkey // 1000 + 1 as varchar) as t, lpad(cast(o_custkey % 1000 as varchar), 3, '0') as r from orders),
gaps as (select key, case form when 2 then 'lost: ' || d when 3 then 'order: ' || t || r || ' ' || d || ' / ' || d || ' ' || t || r when 4 then 'english separator: ' || t || ',' || r else '' end as gap from g)"""


@query(f"with {_GAPS} select key, t || r || ' ' || d as numbers from g join gaps using (key)")
def numbers_of_payments(spark, sf_dir):
    """The numbers of each English sentence, thousands joined and codes left out."""
    return _payments(spark, sf_dir).select("key", F.array_join(T.numbers_en(F.col("en")), " ").alias("numbers"))


@query(f"with {_GAPS} select key, gap from gaps where gap <> ''")
def number_gaps_of_payments(spark, sf_dir):
    return _payments(spark, sf_dir).select("key", T.number_gap(F.col("en"), F.col("fr")).alias("gap")).filter("gap != ''")


@query(f"with {_GAPS} select 'numbers' as control, key, 'blocking' as status, gap as detail, '' as object from gaps where gap <> ''")
def control_numbers_of_payments(spark, sf_dir):
    return _rows(C.number_control(_payments(spark, sf_dir), _none(spark)))


# --- English left over --------------------------------------------------------------------------------------------------------


def _leftovers(spark, sf_dir) -> DataFrame:
    """Parts as names that are copied, half copied or translated, and as whole texts left in English, some with a raw tag."""
    p, form = table(spark, sf_dir, "part"), F.col("p_partkey") % 5
    key = F.concat(F.when(form < 3, "item.parts.p").otherwise("text.p"), F.col("p_partkey").cast("string"))
    half = F.concat(F.split("p_name", " ")[0], F.lit(" traduit"))
    fr = F.when(form.isin(0, 3), F.col("p_name")).when(form == 1, half).when(form == 2, "objet traduit").otherwise(F.concat(F.lit("voir #parts:"), F.replace("p_name", F.lit(" "), F.lit("_"))))
    return _texts(p, key, F.col("p_name"), fr)


_LEFT = rf"""n as (select case when p_partkey % 5 < 3 then 'item.parts.p' else 'text.p' end || p_partkey as key, p_partkey % 5 as form, p_name as en,
  case p_partkey % 5 when 0 then p_name when 3 then p_name when 1 then string_split(p_name, ' ')[1] || ' traduit' when 2 then 'objet traduit' else 'voir #parts:' || replace(p_name, ' ', '_') end as fr from part),
w as (select *, {words_sql('en')} as ew, {words_sql('fr')} as fw from n), lex as (select distinct unnest(list_filter(fw, lambda x: not list_contains(ew, x))) as word from w),
c as (select key, form, unnest(list_distinct(case when form < 3 then list_intersect(fw, ew) when form = 3 then fw else [] end)) as word from w),
k as (select key, form, string_agg(word, ', ' order by word) as ws from c where length(word) >= 4 and regexp_full_match(word, '[a-z]+') and not regexp_full_match(word, '{C.ROMAN}') and word not in (select word from lex) group by all)"""


@query(
    f"""with {_LEFT} select 'residual' as control, n.key, 'blocking' as status, case when n.form = 4 then 'raw tag: #parts:' || replace(n.en, ' ', '_') when n.form = 3 then 'text left in English' else 'English words copied: ' || ws end as detail, '' as object
from n left join k on n.key = k.key where k.ws is not null or n.form = 4"""
)
def control_residual_of_parts(spark, sf_dir):
    return _rows(C.residual_control(_leftovers(spark, sf_dir), _none(spark)))


# --- placeholders ---------------------------------------------------------------------------------------------------------------


def _placeholders(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    p, form = table(spark, sf_dir, "part"), F.col("p_partkey") % 6
    key = F.concat(F.lit("text.p"), F.col("p_partkey").cast("string"))
    forms = ["Prends le %1$s, 100 %%", "Vient en %s", "Prends les %2$s", "Prends : %s", "Pour %2$s et la %1$s", "Au  %s"]
    types = F.when(form.isin(0, 3, 4), F.array(F.array(F.lit("object")), F.array(F.lit("other")))).when(form.isin(1, 5), F.array(F.array(F.lit("other"), F.lit("season"))))
    rows = p.select(key.alias("key"), types.alias("types")).filter("types is not null")
    return _texts(p, key, F.lit("take"), pick(forms, form)), rows


@query(
    """select 'templates' as control, 'text.p' || p_partkey as key, case when p_partkey % 6 = 2 then 'flagged' else 'blocking' end as status,
  case when p_partkey % 6 in (0, 4) then 'gendered or elided word before an object''s name' when p_partkey % 6 = 2 then 'determiner before an unknown argument' else 'en or au before a season' end as detail, '' as object
from part where p_partkey % 6 <> 3"""
)
def control_templates_of_parts(spark, sf_dir):
    """What stands before a placeholder: an article, "en" or "au", a determiner whose argument nobody knows, a colon."""
    return _rows(C.template_control(*_placeholders(spark, sf_dir)))


# --- typography, case, accents, spelling --------------------------------------------------------------------------------------------

_TYPED = ["l’eau", "un cœur d'Œuf", "deux mots", "« cité »", "100% sûr", "sans faute", "Vous allez"]
_RULES = ["apostrophe", "ligature", "no-break space", "quotation marks", "percentage", "", "formal address"]
_FIXED = ["l'eau", "un coeur d'Oeuf", "deux mots", '"cité"', "", "", ""]


@query(
    f"""with n as (select p_partkey as k, {quoted(_RULES)}[p_partkey % 7 + 1] as rule, {quoted(_FIXED)}[p_partkey % 7 + 1] as fixed from part)
select 'conventions' as control, 'text.p' || k as key, 'blocking' as status, rule as detail, rule as object, fixed from n where rule <> ''"""
)
def control_conventions_of_parts(spark, sf_dir):
    """One breach of each convention, and what it is put right by where that is known."""
    p = table(spark, sf_dir, "part")
    t = _texts(p, F.concat(F.lit("text.p"), F.col("p_partkey").cast("string")), F.lit("x"), pick(_TYPED, F.col("p_partkey") % 7), F.lit("project"))
    return C.convention_control(t, _none(spark), _none(spark)).select("control", "key", "status", "detail", F.array_join("object", ",").alias("object"), F.col("expected").alias("fixed"))


@query(
    """with n as (select p_partkey as k, p_partkey % 3 as form, upper(left(string_split(p_name, ' ')[1], 1)) || substr(string_split(p_name, ' ')[1], 2) as c from part)
select 'text.p' || k as key, case form when 0 then 'Va aux grottes de ' else 'Vers la mer de ' end || c as fixed from n where form = 0 or form = 2 and ascii(c) % 2 = 1"""
)
def control_places_of_parts(spark, sf_dir):
    """Generic terms of places within a sentence; at its beginning they keep their capital, and so they do in a displayed name."""
    p, form = table(spark, sf_dir, "part"), F.col("p_partkey") % 3
    c = F.initcap(F.split("p_name", " ")[0])
    fr = F.concat(F.when(form == 0, "Va aux Grottes de ").when(form == 1, "Grottes de ").otherwise("Vers la Mer de "), c)
    t = _texts(p, F.concat(F.lit("text.p"), F.col("p_partkey").cast("string")), F.lit("x"), fr)
    seas = p.select(c.alias("c")).distinct().filter(F.ascii("c") % 2 == 0)
    names = M.registry(_texts(seas, F.concat(F.lit("biome.base."), F.lower("c")), F.lit("x"), F.concat(F.lit("Mer de "), "c")))
    return C.toponym_control(t, _none(spark), names, _none(spark, "name string")).select("key", F.col("expected").alias("fixed"))


@query("select 'item.parts.p' || p_partkey as key, 'La ' || upper(left(p_name, 1)) || substr(p_name, 2) as fixed from part where p_partkey % 2 = 0")
def control_works_of_parts(spark, sf_dir):
    """Every other part is a skill's book, whose title lacks the capital after its article."""
    p = table(spark, sf_dir, "part")
    n = F.concat(F.lit("p"), F.col("p_partkey").cast("string"))
    titles = _texts(p, F.concat(F.lit("item.parts."), n), F.lit("x"), F.concat(F.lit("La "), "p_name"))
    books = _texts(p.filter("p_partkey % 2 = 0"), F.concat(F.lit("parts_skills.books."), n, F.lit(".title")), F.lit("x"), F.col("p_type"))
    return C.work_title_control(titles.unionByName(books)).select("key", F.col("expected").alias("fixed"))


@query(
    r"""with n as (select p_partkey as k, string_split(p_name, ' ') as w from part), u as (select k, w[1] as a, upper(left(w[1], 1)) || substr(w[1], 2) as ca, w[2] as b, upper(left(w[2], 1)) || substr(w[2], 2) as cb from n)
select 'case' as control, case when k % 3 = 2 then 'text.p' else 'item.parts.p' end || k as key, case when k % 3 = 0 then 'capital inside a name' else 'proper noun written small' end as detail,
  case when k % 3 = 0 then cb else 'Ring' end as object, case when k % 3 = 0 then ca || ' ' || b || '. ' || cb || ' ' || b || 's' else '' end as fixed from u where k % 3 = 0 and cb <> 'Ring' or k % 3 = 2 and b = 'ring'"""
)
def control_case_of_parts(spark, sf_dir):
    """Names with a capital inside, which a new sentence keeps, names in order, and a declared noun written small."""
    p, form = table(spark, sf_dir, "part"), F.col("p_partkey") % 3
    a, b = F.split("p_name", " ")[0], F.split("p_name", " ")[1]
    fr = F.when(form == 0, F.concat(F.initcap(a), F.lit(" "), F.initcap(b), F.lit(". "), F.initcap(b), F.lit(" "), b, F.lit("s"))).when(form == 1, F.concat(F.initcap(a), F.lit(" "), F.upper(b))).otherwise(F.concat(F.lit("un "), b))
    key = F.concat(F.when(form == 2, "text.p").otherwise("item.parts.p"), F.col("p_partkey").cast("string"))
    return C.case_control(_texts(p, key, F.col("p_name"), fr), ["Ring"]).select("control", "key", "detail", F.array_join("object", ",").alias("object"), F.col("expected").alias("fixed"))


@query(
    """select 'accents' as control, 'text.p' || p_partkey as key, 'blocking' as status, case p_partkey % 3 when 0 then 'Ete -> Été' else 'legere -> légère, ombre -> ombré' end as detail,
  case p_partkey % 3 when 0 then 'Été etendu' else 'ombré légère, ombrelle' end as fixed from part where p_partkey % 3 < 2"""
)
def control_accents_of_parts(spark, sf_dir):
    """Words without the accents of the vocabulary's only form, whole words alone."""
    p = table(spark, sf_dir, "part")
    vocabulary = spark.createDataFrame([("ete", "été"), ("legere", "légère"), ("ombre", "ombré"), ("mur", "mur"), ("sur", "sur"), ("sur", "sûr")], "folded string, form string")
    t = _texts(p, F.concat(F.lit("text.p"), F.col("p_partkey").cast("string")), F.lit("x"), pick(["Ete etendu", "ombre legere, ombrelle", "été sur mur"], F.col("p_partkey") % 3))
    return C.accent_control(t, _none(spark), _none(spark), vocabulary).select("control", "key", "status", "detail", F.col("expected").alias("fixed"))


@query(
    """with n as (select p_partkey as k, string_split(p_name, ' ')[2] as b from part) select 'spelling' as control, 'text.p' || k as key, 'ring' as object,
  'bague rings, ' || case when k % 2 = 0 then 'Bague' else 'BAGUE' end as fixed from n where b = 'ring'"""
)
def control_spelling_of_parts(spark, sf_dir):
    """A known mistake in any case, put right in whole words alone, in the case in which it stands."""
    p = table(spark, sf_dir, "part")
    b = F.split("p_name", " ")[1]
    fr = F.concat(b, F.lit(" "), b, F.lit("s, "), F.when(F.col("p_partkey") % 2 == 0, F.initcap(b)).otherwise(F.upper(b)))
    forms = spark.createDataFrame([("ring", "bague", False, "seen")], "form string, right string, exact boolean, source string")
    t = _texts(p, F.concat(F.lit("text.p"), F.col("p_partkey").cast("string")), F.lit("x"), fr)
    return C.spelling_control(t, _none(spark), _none(spark), forms).select("control", "key", F.array_join("object", ",").alias("object"), F.col("expected").alias("fixed"))


# --- names, references ----------------------------------------------------------------------------------------------------------------


def _names(spark, sf_dir) -> DataFrame:
    """One name for each part's English name: the part of the smallest number; in French the words change places and gain an ending."""
    p = table(spark, sf_dir, "part").groupBy("p_name").agg(F.min("p_partkey").alias("k"))
    fr = F.concat(F.split("p_name", " ")[1], F.lit("o "), F.split("p_name", " ")[0], F.lit("a"))
    return M.registry(_texts(p, F.concat(F.lit("item.parts.p"), F.col("k").cast("string")), F.col("p_name"), fr))


_NAMES = """names as (select 'item.parts.p' || min(p_partkey) as name, p_name, string_split(p_name, ' ')[2] || 'o ' || string_split(p_name, ' ')[1] || 'a' as fr from part group by p_name)"""


@query(
    f"""with {_NAMES} select 'references' as control, 'text.p' || p_partkey as key, 'blocking' as status, 'displayed name not used' as detail, name as object, fr as fixed from part join names using (p_name) where p_partkey % 3 = 1
union all select 'references', 'text.p1', 'flagged', 'pin not used', 'item.parts.none', ''"""
)
def control_references_of_parts(spark, sf_dir):
    """Texts that cite a part by its English name: with its French name, with another, and none; and a pin that nothing uses."""
    p, form = table(spark, sf_dir, "part"), F.col("p_partkey") % 3
    a, b = F.split("p_name", " ")[0], F.split("p_name", " ")[1]
    en = F.when(form == 2, "nothing").otherwise(F.concat(F.lit("bring the "), "p_name", F.lit(" home")))
    fr = F.when(form == 0, F.concat(F.lit("rapporte "), b, F.lit("o "), a, F.lit("a ici"))).otherwise("rapporte cela")
    t = _texts(p, F.concat(F.lit("text.p"), F.col("p_partkey").cast("string")), en, fr)
    pins = spark.createDataFrame([("text.p1", "item.parts.none")], "key string, object string")
    out = C.reference_control(t, _names(spark, sf_dir), _none(spark, "key string, object_id string"), pins)
    return out.select("control", "key", "status", "detail", F.array_join("object", ",").alias("object"), F.col("expected").alias("fixed"))


@query(
    f"""with {_NAMES}, n as (select p_partkey as k, p_partkey % 4 as form, string_split(p_name, ' ')[1] as a, string_split(p_name, ' ')[2] as b, string_split(p_type, ' ')[1] as t from part),
e as (select 'text.p' || k as key, k, form, a || ' ' || b as said, case form when 0 then lag(a) over (order by k) when 2 then 'odd' else a end || ' ' || b as meant, form < 3 as joined from n)
select key, said as cited, fr from e join names on p_name = said union all select key, meant, fr from e join names on p_name = meant where joined and meant <> said"""
)
def citations_in_coordinations(spark, sf_dir):
    """Texts with "a or b c" cite "b c", and "a c" too where that is a name; after a word that joins nothing, nothing is implied."""
    from ..operators.matching import citations_in_context

    p = table(spark, sf_dir, "part")
    before = p.select((F.col("p_partkey") + 1).alias("p_partkey"), F.split("p_name", " ")[0].alias("other"))
    form, own = F.col("p_partkey") % 4, F.split("p_name", " ")[0]
    other = F.when(form == 0, F.col("other")).when(form == 2, "odd").otherwise(own)
    en = F.concat(F.lit("bring the "), F.coalesce(other, F.lit("")), F.when(form == 3, " with ").when(form == 0, " or ").otherwise(" and "), "p_name", F.lit(" home"))
    rows = p.join(before, "p_partkey", "left").select(F.concat(F.lit("text.p"), F.col("p_partkey").cast("string")).alias("key"), T.words(en).alias("ws"), F.lit(False).alias("name"))
    names = _names(spark, sf_dir).select(F.col("en_tokens").alias("motif"), "en", "fr")
    return citations_in_context(rows, names).select("key", "motif").distinct().join(names, "motif").select("key", F.col("en").alias("cited"), "fr")


def _titles(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """A quest for each second word of the parts' names, linked to all parts of that word; the French word is there for every other."""
    w = table(spark, sf_dir, "part").select(F.split("p_name", " ")[1].alias("w")).distinct()
    key = F.concat(F.lit("quests.chapter.a."), "w", F.lit(".title"))
    fr = F.when(F.ascii("w") % 2 == 0, F.concat(F.lit("Tous les "), "w", F.lit("o"))).otherwise("Tous")
    t = _texts(w, key, F.concat(F.lit("All the "), "w", F.lit("s")), fr)
    names = _names(spark, sf_dir)
    links = names.select(F.concat(F.lit("quests.chapter.a."), F.split("en", " ")[1], F.lit(".title")).alias("key"), F.col("identifier").alias("object_id"))
    return t, links


@query(
    """with w as (select string_split(p_name, ' ')[2] as w, count(distinct p_name) as n from part group by 1)
select 'quests.chapter.a.' || w || '.title' as key, 'the objects'' shared word is missing' as detail, w || 'o' as fixed from w where n > 1 and ascii(w) % 2 = 1"""
)
def control_titles(spark, sf_dir):
    """Titles that aim at several objects by a word that they share."""
    t, links = _titles(spark, sf_dir)
    return C.title_control(t, _names(spark, sf_dir), links).select("key", "detail", F.col("expected").alias("fixed"))


@query(f"with {_NAMES} select 'book/' || split_part(name, '.', 3) || '.json#/name' as key, name as object, fr as fixed from names where cast(substr(split_part(name, '.', 3), 2) as bigint) % 2 = 1")
def control_sheets(spark, sf_dir):
    """Sheets about an object that don't name it: every other one is called something else."""
    n = _names(spark, sf_dir)
    path = F.split("identifier", ":")[1]
    odd = F.substring(path, 2, 20).cast("bigint") % 2 == 1
    books = n.select(
        F.concat(F.lit("book/"), path, F.lit(".json#/name")).alias("key"), F.concat(F.lit("book/"), path, F.lit(".json")).alias("file"), F.lit("/name").alias("pointer"), F.when(odd, "Something").otherwise(F.col("en")).alias("en"), F.when(odd, "Chose").otherwise(F.col("fr")).alias("fr"), F.array("identifier").alias("objects")
    )
    return C.sheet_control(books, n).select("key", F.array_join("object", ",").alias("object"), F.col("expected").alias("fixed"))


def _family(spark, sf_dir) -> DataFrame:
    """Names of three words in English, all but the first being the part's name; in French they begin with the last word."""
    p = table(spark, sf_dir, "part").select("p_name", F.lower("p_type").alias("t")).groupBy("p_name", "t").agg(F.lit(1).alias("one"))
    key = F.concat(F.lit("item.parts."), "t", F.lit("_"), F.replace("p_name", F.lit(" "), F.lit("_")))
    fr = F.concat(F.split("p_name", " ")[1], F.lit("o "), F.split("p_name", " ")[0], F.lit("a "), "t", F.lit("ique"))
    return M.registry(_texts(p, key, F.concat_ws(" ", "t", "p_name"), fr))


@query("with n as (select p_name, count(distinct lower(p_type)) as n from part group by 1) select p_name as ending, string_split(p_name, ' ')[2] || 'o ' || string_split(p_name, ' ')[1] || 'a' as prefix, n from n where n > 1")
def families_of_names(spark, sf_dir):
    """Endings that names share in English, and what they all begin with in French."""
    from ..operators.matching import name_families

    out = name_families(_family(spark, sf_dir), ["the"], ["de"])
    return out.select(F.array_join("ending", " ").alias("ending"), F.array_join("prefix", " ").alias("prefix"), "n")


@query(
    """with n as (select p_name, count(distinct lower(p_type)) as n, min(lower(p_type)) as t from part group by 1)
select 'text.' || replace(p_name, ' ', '_') as key, p_name as object, string_split(p_name, ' ')[2] || 'o ' || string_split(p_name, ' ')[1] || 'a' as fixed from n where n > 1 and ascii(p_name) % 2 = 1"""
)
def control_family_nouns(spark, sf_dir):
    """Texts linked to an object of a family that cite its common noun, rendered otherwise by every other."""
    n = table(spark, sf_dir, "part").groupBy("p_name").agg(F.min(F.lower("p_type")).alias("t"))
    slug = F.replace("p_name", F.lit(" "), F.lit("_"))
    key = F.concat(F.lit("text."), slug)
    fr = F.when(F.ascii("p_name") % 2 == 1, "autre chose").otherwise(F.concat(F.split("p_name", " ")[1], F.lit("o "), F.split("p_name", " ")[0], F.lit("a brille")))
    t = _texts(n, key, F.concat(F.lit("a "), "p_name", F.lit(" shines")), fr)
    links = n.select(key.alias("key"), F.concat(F.lit("parts:"), "t", F.lit("_"), slug).alias("object_id"))
    return C.family_noun_control(t, _family(spark, sf_dir), links).select("key", F.array_join("object", ",").alias("object"), F.col("expected").alias("fixed"))


@query(
    f"""with n as (select 'item.parts.p' || p_partkey as key, {words_sql('p_name')} as ew, {words_sql("p_type || ' ' || p_brand")} as fw from part),
g as (select min(key) as key, string_agg(key, ',' order by key) as object from n group by ew having count(distinct fw) > 1),
l as (select c_nationkey, c_mktsegment, count(*) as n from customer group by all), m as (select *, row_number() over (partition by c_nationkey order by n desc, c_mktsegment) as r, lead(n) over (partition by c_nationkey order by n desc, c_mktsegment) as next from l)
select key, 'one English name, several French ones' as detail, object from g union all
select cast(c_custkey as varchar), 'label rendered otherwise elsewhere', cast(c_nationkey as varchar) from customer join m using (c_nationkey) where r = 1 and n > next and customer.c_mktsegment <> m.c_mktsegment"""
)
def control_homonyms_in_full(spark, sf_dir):
    """Names with several French forms, and labels off their majority."""
    from .rule_queries import _labels, _part_names

    rows = C.homonym_control(M.homonym_groups(_part_names(spark, sf_dir)), _labels(spark, sf_dir))
    return rows.select("key", "detail", F.array_join("object", ",").alias("object"))


# --- inventory, registers, terms --------------------------------------------------------------------------------------------------------

_SPEECH = ["tu prends", "vous prenez", "rien", "viens-tu ?", "te voir"]


def _speech(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_nationkey").cast("string").alias("unit"), F.col("c_custkey").cast("string").alias("key"), pick(_SPEECH, F.col("c_custkey") % 5).alias("fr"))


_MIX = "m as (select cast(c_nationkey as varchar) as unit, count(*) filter (c_custkey % 5 in (0, 3)) as familiar, count(*) filter (c_custkey % 5 = 1) as formal from customer group by 1 having familiar > 0 and formal > 0)"


@query(f"with {_MIX} select * from m")
def register_of_customers(spark, sf_dir):
    """Nations whose customers are addressed in both ways; "viens-tu" is familiar, "te" alone is not."""
    return I.register_mix(_speech(spark, sf_dir))


@query(f"with {_MIX} select unit, case when familiar < formal then 'familiar' else 'formal' end as register, cast(c_custkey as varchar) as key from customer join m on unit = cast(c_nationkey as varchar) where (familiar < formal and c_custkey % 5 in (0, 3)) or (familiar >= formal and c_custkey % 5 = 1)")
def minority_register(spark, sf_dir):
    """The texts in the rarer form of address of their nation."""
    return I.minority_texts(_speech(spark, sf_dir))


@query("with t as (select distinct o_orderpriority as term from orders) select 'o' || o_orderkey as key, string_agg(term, ',' order by term) as terms from orders join t on contains(lower('Ship ' || o_orderpriority || ' now'), lower(term)) group by o_orderkey")
def terms_of_orders(spark, sf_dir):
    """Glossary terms that each order's text holds."""
    o = table(spark, sf_dir, "orders")
    rows = o.select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("key"), F.concat(F.lit("Ship "), "o_orderpriority", F.lit(" now")).alias("en"))
    return I.batch_terms(rows, o.select(F.col("o_orderpriority").alias("en")).distinct()).select("key", F.array_join("terms", ",").alias("terms"))


@query("select 'jar' || (p_partkey % 4) as ns, 'k' || p_partkey as key, p_name as en from part where p_partkey % 5 in (2, 4) or p_partkey % 5 = 3 and p_partkey % 2 = 0")
def delta_of_parts(spark, sf_dir):
    """English of the jars that no French covers: none at all, a blank one, and one for another key's sake."""
    p, form = table(spark, sf_dir, "part"), F.col("p_partkey") % 5
    key = F.concat(F.lit("k"), F.col("p_partkey").cast("string"))

    def entry(rows, layer, locale, value):
        return rows.select(F.lit(layer).alias("layer"), F.lit("j").alias("jar"), F.concat(F.lit("jar"), (F.col("p_partkey") % 4).cast("string")).alias("ns"), F.lit(locale).alias("locale"), key.alias("key"), value.alias("value"), F.col("p_partkey").alias("ord"))

    rows = entry(p, "jar", "en_us", F.col("p_name"))
    rows = rows.unionByName(entry(p.filter(form == 0), "project", "fr_fr", F.lit("x"))).unionByName(entry(p.filter(form == 1), "jar", "fr_fr", F.lit("x")))
    rows = rows.unionByName(entry(p.filter(form == 2), "jar", "fr_fr", F.lit(" "))).unionByName(entry(p.filter((form == 3) & (F.col("p_partkey") % 2 == 1)), "project", "fr_fr", F.lit("x")))
    return I.delta(rows.unionByName(entry(p.filter(form == 4), "vanilla", "fr_fr", F.lit("x"))))


@query("select case when p_partkey % 5 = 0 then 'base game' when p_partkey % 5 = 1 then 'comment' when p_partkey % 5 = 2 then 'without English' when p_partkey % 3 = 0 then 'dead' else 'kept' end as reason, count(*) as n from part group by 1")
def exclusions_of_parts(spark, sf_dir):
    """Why keys aren't reviewed, dead ones included."""
    p, form = table(spark, sf_dir, "part"), F.col("p_partkey") % 5
    key = F.concat(F.when(form == 1, "_").otherwise(""), F.lit("p"), F.col("p_partkey").cast("string"))
    t = _texts(p, key, F.when(form == 2, " ").otherwise(F.col("p_name")), F.lit("x")).withColumn("origin_fr", F.when(F.regexp_extract("key", "[0-9]+", 0).cast("bigint") % 5 == 0, "vanilla").otherwise("project"))
    return I.exclusion_counts(t, p.filter("p_partkey % 3 = 0").select(key.alias("key")))


@query("select c_custkey as id from customer where c_custkey % 2 = 0 and c_custkey not in (select o_custkey from orders where o_orderstatus = 'F') union all select distinct o_custkey from orders where o_orderstatus = 'F' and o_custkey % 2 = 1")
def unmatched_customers(spark, sf_dir):
    """Even customers against those of finished orders: what either side lacks."""
    from ..operators.sampling import unmatched

    a = table(spark, sf_dir, "customer").filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("id"))
    b = table(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("id")).distinct()
    return unmatched(a, b).select("id")


_CONTROLS = ["spelling", "width", "accents", "coverage"]


@query(f"with f as (select case when p_partkey % 2 = 0 then 'own' || p_partkey else 'both' || (p_partkey // 4) end as key, {quoted(_CONTROLS)}[p_partkey // 2 % 4 + 1] as control, case when p_partkey % 7 = 0 then '' else p_name end as expected from part), n as (select *, count(*) over (partition by key) as n from f) select key, control, expected from n where n = 1 and control in ('spelling', 'accents') and expected <> ''")
def safe_corrections_of_parts(spark, sf_dir):
    """Findings that can be taken over: alone on their key, of a control that gives whole texts, with a text."""
    p = table(spark, sf_dir, "part")
    n = F.col("p_partkey")
    key = F.when(n % 2 == 0, F.concat(F.lit("own"), n.cast("string"))).otherwise(F.concat(F.lit("both"), F.floor(n / 4).cast("string")))
    return K.safe_corrections(p.select(key.alias("key"), pick(_CONTROLS, F.floor(n / 2) % 4).alias("control"), F.when(n % 7 == 0, "").otherwise(F.col("p_name")).alias("expected")))


@query(
    r"""with k as (select distinct string_split(p_name, ' ')[1] as key from part), w as (select distinct p_name || '.' || p_type as word from part where p_partkey % 3 = 0), j as (select distinct lower(n_name) || p_name as word from nation, (select distinct p_name from part where p_partkey % 3 > 0))
select key, case when exists(select 1 from w where contains(word, key)) then 'pack' when exists(select 1 from j where contains(word, key)) then 'jar' when exists(select 1 from j where contains(word, left(key, 2))) then 'prefix' else 'suspect' end as state from k"""
)
def key_liveness_inside(spark, sf_dir):
    """First words of names as keys, looked for inside longer words."""
    p = table(spark, sf_dir, "part")
    keys = p.select(F.split("p_name", " ")[0].alias("key")).distinct().withColumn("prefix", F.left("key", F.lit(2)))
    pack = p.filter("p_partkey % 3 = 0").select(F.concat_ws(".", "p_name", "p_type").alias("word"))
    jar = p.filter("p_partkey % 3 > 0").select("p_name").distinct().crossJoin(F.broadcast(table(spark, sf_dir, "nation").select(F.lower("n_name").alias("n"))))  # nations are 25
    return I.key_liveness_inside(keys, pack, jar.select(F.concat("n", "p_name").alias("word")))


@query(
    """with r as (select p_partkey as k, case p_partkey % 4 when 0 then 'lot A-' || p_partkey || ', verdict x : ' || p_name when 1 then p_name || ' (fiche ' || p_partkey || ')' when 2 then 'fiche du 01/02 : q-' || p_partkey else p_name || ' ; lot b' || p_partkey end as reason, p_name from part)
select k as p_partkey, case when k % 4 = 2 then '' else upper(left(p_name, 1)) || substr(p_name, 2) end as readable from r"""
)
def readable_reasons(spark, sf_dir):
    """Reasons without their bookkeeping remarks."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey").cast("string")
    form = F.col("p_partkey") % 4
    reason = F.when(form == 0, F.concat(F.lit("lot A-"), k, F.lit(", verdict x : "), "p_name")).when(form == 1, F.concat("p_name", F.lit(" (fiche "), k, F.lit(")"))).when(form == 2, F.concat(F.lit("fiche du 01/02 : q-"), k)).otherwise(F.concat("p_name", F.lit(" ; lot b"), k))
    return p.select("p_partkey", T.readable_reason(reason).alias("readable"))


@query("select p_partkey, case when left(p_name, 1) in ('a', 'e', 'i', 'o', 'u', 'h') then 'Oeufs d''' else 'Oeufs de ' end || p_name || ' fumées' as name from part")
def template_names_in_full(spark, sf_dir):
    """Part names put into a template with elision and agreement."""
    return table(spark, sf_dir, "part").select("p_partkey", T.render_template(F.lit("Oeufs de {source} fumé{e}{s}"), F.col("p_name"), F.lit("f"), F.lit("p")).alias("name"))


_PX = " + ".join(f"(length(b) - length(replace(b, '{g.replace(chr(39), chr(39) * 2)}', ''))) * {w - 6}" for g, w in T.GLYPHS.items())


@query(
    f"""with w as (select conv_id, turn, list_transform(list_transform(string_split(regexp_replace(text, '§.', '', 'g'), ' '), lambda x: strip_accents(x)), lambda b: length(b) * 6 + {_PX}) as ws from conversations)
select conv_id, turn, list_reduce(list_concat([1000000], ws), lambda a, x: case when a % 1000000 = 0 then a + x when a % 1000000 + 4 + x <= 102 then a + 4 + x else (a // 1000000 + 1) * 1000000 + x end) // 1000000 as lines from w"""
)
def lines_of_turns(spark, sf_dir):
    """Lines of each turn in a box of 102 pixels."""
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", T.wrapped_lines(F.col("text")).cast("bigint").alias("lines"))


# --- verification as a whole ------------------------------------------------------------------------------------------------------------


def _verified(spark, sf_dir) -> DataFrame:
    tables = V.Tables(texts=_payments(spark, sf_dir).unionByName(_leftovers(spark, sf_dir)).unionByName(_placeholders(spark, sf_dir)[0].withColumn("key", F.concat(F.lit("q."), "key"))), spark=spark)
    tables.arguments = _placeholders(spark, sf_dir)[1].withColumn("key", F.concat(F.lit("q."), "key"))
    o = table(spark, sf_dir, "orders").filter("o_orderkey % 6 = 2 and o_orderkey % 5 = 0")
    tables.exceptions = o.select(F.lit("numbers").alias("control"), F.concat(F.lit("text.o"), F.col("o_orderkey").cast("string")).alias("key"), F.array().cast("array<string>").alias("object"), F.lit("known").alias("reason"), F.lit(False).alias("pin"), F.lit(None).cast("string").alias("fingerprint"), F.lit(None).cast("string").alias("question"), F.col("o_orderkey").alias("ord"))
    return V.verify(tables, ["numbers", "residual", "templates"])


_VERIFIED = f"""{_GAPS}, {_LEFT}, v as (select 'numbers' as control, case when k % 6 = 2 and k % 5 = 0 then 'covered' else 'blocking' end as bucket from g join gaps using (key) where gap <> ''
union all select 'residual', 'blocking' from n left join k on n.key = k.key where k.ws is not null or n.form = 4
union all select 'templates', case when p_partkey % 6 = 2 then 'flagged' else 'blocking' end from part where p_partkey % 6 <> 3)"""


@query(f"with {_VERIFIED} select control, bucket, count(*) as n from v group by all")
def verify_controls(spark, sf_dir):
    """Three controls by name over one set of texts, reconciled with exceptions."""
    return _verified(spark, sf_dir).groupBy("control", "bucket").agg(F.count(F.lit(1)).alias("n"))


@query("select 1 as code")
def verify_exit_code(spark, sf_dir):
    """The code that the run ends with: 1 as long as a finding blocks."""
    v = _verified(spark, sf_dir)
    none = _none(spark, "control string, key string, object array<string>, reason string, pin boolean, question string, ord bigint")
    return spark.createDataFrame([(L.exit_code(v, none),)], "code int")
