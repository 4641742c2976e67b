"""Text primitives over whole driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from .analogs import PAIRS, pairs, table

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _replaced(x: str, table_) -> str:
    for a, b in table_:
        x = f"replace({x}, '{a}', '{b}')"
    return x


def fold_sql(x: str) -> str:
    return f"lower({_replaced(f'strip_accents({x})', T.LIGATURES)})"


def stem_sql(w: str) -> str:
    cut = f"(case when length({w}) > 3 and ({w} like '%s' or {w} like '%x') then left({w}, length({w}) - 1) else {w} end)"
    return (
        f"case when length({w}) > 4 and {w} like '%eaux' then left({w}, length({w}) - 1) when length({w}) > 4 and {w} like '%aux' then left({w}, length({w}) - 3) || 'al' "
        f"when length({cut}) > 3 and {cut} like '%au' and {cut} not like '%eau' then left({cut}, length({cut}) - 2) || 'al' "
        f"when length({cut}) > 4 and {cut} like '%ail' then left({cut}, length({cut}) - 3) || 'al' else {cut} end"
    )


MARKUP_SQL = T.MARKUP.replace("'", "''")


def clean_sql(x: str) -> str:
    x = rf"regexp_replace(replace({x}, '\n', chr(10)), '{T.BREAKS}', chr(10), 'g')"
    x = f"regexp_replace({x}, '{MARKUP_SQL}', ' ', 'g')"
    return rf"regexp_replace({x}, '(^|[^\p{{L}}\p{{N}}_#])[a-z0-9_.-]+:[a-z0-9_/.-]+', '\1 ', 'g')"


def words_sql(x: str) -> str:
    """Stems of folded words, as T.words."""
    found = rf"flatten(list_transform(regexp_extract_all({clean_sql(x)}, '([\p{{L}}\p{{N}}]+)', 1), lambda w: regexp_extract_all({fold_sql('w')}, '([0-9a-z]+)', 1)))"
    return f"list_transform({found}, lambda v: {stem_sql('v')})"


CODES_SQL = T.CODES_FULL.replace("'", "''")


@query(f"select doc_id, lang, left(text, 80) as start from documents where contains({fold_sql('text')}, 'thecreation') or contains({fold_sql('text')}, 'eau') order by doc_id")
def search_folded(spark, sf_dir):
    """Documents that hold "éau" whatever their accents and case."""
    d = table(spark, sf_dir, "documents")
    hit = F.contains(T.fold(F.col("text")), T.fold(F.lit("ÉAU"))) | F.contains(T.fold(F.col("text")), F.lit("thecreation"))
    return d.filter(hit).select("doc_id", "lang", F.left("text", F.lit(80)).alias("start")).orderBy("doc_id")


@query(f"select doc_id, sha1({fold_sql('text')}) as folded from documents")
def fold_texts(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha1(T.fold(F.col("text")).cast("binary")).alias("folded"))


@query("select doc_id, sha1(replace(lower(strip_accents(text)), 'œ', 'oe')) as folded from documents")
def fold_marks_only(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha1(T.fold_mn(F.col("text")).cast("binary")).alias("folded"))


@query(f"with w as (select doc_id, {words_sql('text')} as ws from documents) select doc_id, len(ws)::int as n, sha1(array_to_string(ws, ' ')) as stems from w")
def stems(spark, sf_dir):
    ws = T.words(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(ws).alias("n"), F.sha1(F.array_join(ws, " ").cast("binary")).alias("stems"))


@query(
    rf"""with p as (select doc_id, {clean_sql('text')} as t from documents), s as (
  select doc_id, list_transform(string_split_regex(regexp_replace(t, '([\p{{L}}\p{{N}}]+)', chr(1) || '\1' || chr(2), 'g'), chr(1))[2:], lambda x: string_split(x, chr(2))) as c from p)
select doc_id, len(c)::int as written, len(list_filter(range(1, len(c) + 1), lambda i: i = 1 or regexp_matches(c[i - 1][2], '[.!?\n]')))::int as sentences from s"""
)
def sentence_starts(spark, sf_dir):
    """Written words, and those that begin a sentence, from the tokens of each document."""
    d = table(spark, sf_dir, "documents").select("doc_id", T.tokens(F.col("text")).alias("t"), F.size(T.written_words(F.col("text"))).alias("written"))
    return d.select("doc_id", "written", F.size(F.filter("t", lambda x: x["start"])).alias("sentences"))


@query(f"select doc_id, array_to_string(list_transform(list_sort(regexp_extract_all(text, '({CODES_SQL})', 1)), lambda x: replace(x, chr(10), 'n')), ' ') as codes from documents")
def code_multiset(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(F.transform(T.codes(F.col("text")), lambda x: F.replace(x, F.lit("\n"), F.lit("n"))), " ").alias("codes"))


_DIFF = f"""{PAIRS}, a as (select key, c, count(*) as n from (select key, unnest(regexp_extract_all(en, '({CODES_SQL})', 1)) as c from pairs) group by all),
b as (select key, c, count(*) as n from (select key, unnest(regexp_extract_all(fr, '({CODES_SQL})', 1)) as c from pairs) group by all)"""


@query(
    f"with {_DIFF} select coalesce(a.key, b.key) as key, sum(greatest(coalesce(a.n, 0) - coalesce(b.n, 0), 0))::int as lost, sum(greatest(coalesce(b.n, 0) - coalesce(a.n, 0), 0))::int as added "
    "from a full join b on a.key = b.key and a.c = b.c group by 1 having lost + added > 0"
)
def code_multiset_diff(spark, sf_dir):
    """Codes that a pair loses and adds, repeats counted."""
    p = pairs(spark, sf_dir)
    a, b = T.codes(F.col("en")), T.codes(F.col("fr"))
    out = p.select("key", F.size(T.multiset_minus(a, b)).alias("lost"), F.size(T.multiset_minus(b, a)).alias("added"))
    return out.filter("lost + added > 0")


@query(
    r"""with l as (select doc_id, regexp_extract(unnest(string_split(text, chr(10))), '^(#+|\^\^\^|---|- )', 1) as m, generate_subscripts(string_split(text, chr(10)), 1) as i from documents)
select doc_id, count(*) filter (m <> '')::int as n, coalesce(string_agg(m, '|' order by i) filter (m <> ''), '') as marks from l group by doc_id"""
)
def structure_lines(spark, sf_dir):
    s = T.structure(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(s).alias("n"), F.array_join(s, "|").alias("marks"))


_PX = " + ".join(f"(length(b) - length(replace(b, '{g.replace(chr(39), chr(39) * 2)}', ''))) * {w - 6}" for g, w in T.GLYPHS.items())


@query(f"with t as (select doc_id, strip_accents(regexp_replace(text, '§.', '', 'g')) as b from documents) select doc_id, (length(b) * 6 + {_PX})::int as px from t")
def pixel_width(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.pixels(F.col("text")).cast("int").alias("px"))


@query(
    f"""with w as (select doc_id, list_transform(list_transform(string_split(regexp_replace(text, '§.', '', 'g'), ' '), lambda x: strip_accents(x)), lambda b: length(b) * 6 + {_PX}) as ws from documents)
select doc_id, (list_reduce(list_concat([1000000], ws), lambda a, x: case when a % 1000000 = 0 then a + x when a % 1000000 + 4 + x <= 102 then a + 4 + x else (a // 1000000 + 1) * 1000000 + x end) // 1000000)::int as lines from w"""
)
def wrapped_lines(spark, sf_dir):
    """Lines of each text in a box of 102 pixels: a fold over the words."""
    return table(spark, sf_dir, "documents").select("doc_id", T.wrapped_lines(F.col("text")).alias("lines"))


@query("select conv_id, turn, (octet_length(encode(text)) - 0 * turn)::int as bytes, length(text)::int as points, (length(text) + len(regexp_extract_all(text, '[\\x{10000}-\\x{10FFFF}]')))::int as units from conversations")
def text_lengths(spark, sf_dir):
    """Bytes, code points and UTF-16 units of each turn."""
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.octet_length("text").alias("bytes"), F.length("text").alias("points"), T.utf16_length(F.col("text")).alias("units"))


_SHOWN = f"regexp_replace(en, '<remove_size>.*?</remove_size>', ' ', 'gs')"
_SHOWN = rf"regexp_replace(regexp_replace({_SHOWN}, '\$\(t:([^)]*)\)', ' \1 ', 'g'), '{CODES_SQL}', ' ', 'g')"
_SHOWN = clean_sql(r"regexp_replace(%s, '\{[^{}]*\}', ' ', 'g')" % _SHOWN)
_NUMBERS = (
    f"with {PAIRS}, n as (select key, unnest(regexp_extract_all({_SHOWN}, '([0-9]+(?:[.,][0-9]+)*)', 1)) as n from pairs)"
    + r", v as (select key, case when regexp_matches(n, '^[0-9]{1,3}(,[0-9]{3})+$') then replace(n, ',', '') else n end as n from n)"
    + " select key, count(*)::int as numbers, sum(length(n))::int as digits from v group by key"
)


@query(_NUMBERS)
def numbers_in_english(spark, sf_dir):
    """How many numbers each English side holds, and their length as written, thousands joined."""
    p = pairs(spark, sf_dir).withColumn("raw", F.regexp_extract_all(T.shown(F.col("en")), F.lit(T.NUMBER), 1))
    joined = F.transform("raw", lambda n: F.when(n.rlike(r"^[0-9]{1,3}(?:,[0-9]{3})+$"), F.replace(n, F.lit(","), F.lit(""))).otherwise(n))
    rows = p.filter(F.size("raw") > 0).select("key", joined.alias("ns"))
    return rows.select("key", F.size("ns").alias("numbers"), F.aggregate("ns", F.lit(0), lambda a, n: a + F.length(n)).alias("digits"))


@query()
def number_gaps(spark, sf_dir):
    """Pairs whose French loses numbers or changes their order; French number words need a table, tested against plain Python."""
    p = pairs(spark, sf_dir)
    return p.select("key", T.number_gap(F.col("en"), F.col("fr")).alias("gap")).filter("gap != ''")


_VERDICT = f"""with {PAIRS} select key, verdict, count(*) as n from (
  select key, unnest(list_filter([case when trim(en) = '' and trim(fr) <> '' then 'should_be_empty' end, case when trim(en) <> '' and trim(fr) = '' then 'empty' end,
    case when trim(en) <> '' and trim(fr) <> '' and list_sort(regexp_extract_all(en, '({CODES_SQL})', 1)) <> list_sort(regexp_extract_all(fr, '({CODES_SQL})', 1)) then 'tokens' end,
    case when trim(en) <> '' and en = fr and regexp_matches(en, '[A-Za-z]{{4,}}') and length(en) > 3 then 'untranslated' end], lambda x: x is not null)) as verdict from pairs) group by all"""


@query(_VERDICT)
def placeholder_validation(spark, sf_dir):
    rows = pairs(spark, sf_dir).select("key", F.explode(T.placeholder_verdicts(F.col("en"), F.col("fr"))).alias("verdict"))
    return rows.groupBy("key", "verdict").agg(F.count(F.lit(1)).alias("n"))


_WRITE = T.CODES_WRITE.replace("'", "''")


@query(
    f"with {PAIRS} select key, case when trim(en) = '' and trim(fr) <> '' then 'should_be_empty' when trim(en) <> '' and trim(fr) = '' then 'empty' "
    f"when list_sort(regexp_extract_all(en, '({_WRITE})', 1)) <> list_sort(regexp_extract_all(fr, '({_WRITE})', 1)) then 'codes' end as verdict from pairs"
)
def write_validation(spark, sf_dir):
    return pairs(spark, sf_dir).select("key", T.write_verdict(F.col("en"), F.col("fr")).alias("verdict"))


_GRAMS = (
    "flatten(list_transform([1, 2, 3], lambda n: list_transform(range(1, len(w) - n + 2), lambda i: w[i:i + n - 1])))"
)


@query(
    rf"""with t as (select conv_id, turn, regexp_extract_all(lower(text), '([\p{{L}}\p{{N}}]+)', 1) as w from conversations),
g as (select conv_id, turn, unnest({_GRAMS}) as g from t)
select conv_id, turn, count(*)::int as n from g where g[1] not in ('the', 'de', 'of') and g[len(g)] not in ('the', 'de', 'of') group by all"""
)
def word_ngrams(spark, sf_dir):
    """How many n-grams of one to three words don't start or end with a stop word."""
    ws = F.regexp_extract_all(F.lower("text"), F.lit(f"({T.WORD})"), 1)
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.size(T.ngrams(ws, 3, ["the", "de", "of"])).alias("n"))
    return rows.filter("n > 0")


@query("select doc_id, left(sha1(text), 12) as fingerprint from documents")
def fingerprints(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.fingerprint(F.col("text")).alias("fingerprint"))


@query(
    r"""with w as (select distinct unnest(regexp_extract_all(lower(text), '([\p{L}]+)', 1)) as w from documents where lang = 'fr')
select w as word, """
    + stem_sql("w")
    + " as stem from w"
)
def distinct_stems(spark, sf_dir):
    """Every distinct French word with its stem."""
    w = table(spark, sf_dir, "documents").filter("lang = 'fr'").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), 1)).alias("word")).distinct()
    return w.select("word", T.stem(F.col("word")).alias("stem"))


_H = " and ".join(f"not starts_with(f, '{h}')" for h in T.ASPIRATED)


@query(
    rf"""with w as (select distinct unnest(regexp_extract_all(lower(text), '([\p{{L}}]+)', 1)) as w from documents where lang = 'fr'), f as (select w, {fold_sql('w')} as f from w)
select w as word, (left(f, 1) in ('a', 'e', 'i', 'o', 'u') or (left(f, 1) = 'h' and {_H})) as elides from f"""
)
def elisions(spark, sf_dir):
    w = table(spark, sf_dir, "documents").filter("lang = 'fr'").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), 1)).alias("word")).distinct()
    return w.select("word", T.elides(F.col("word")).alias("elides"))


@query(
    r"""with w as (select distinct unnest(regexp_extract_all(lower(text), '([\p{L}]+)', 1)) as w from documents)
select w as word, case when length(w) > 5 and w like '%trice' then left(w, length(w) - 5) || 'teur'
  when length(w) > 3 and w like '%e' then case when length(w) > 3 and regexp_matches(left(w, length(w) - 1), '(ll|nn|tt)$') then left(w, length(w) - 2) else left(w, length(w) - 1) end else w end as masculine,
  regexp_replace(regexp_replace(w, 's$', ''), 'ie$', 'y') as uninflected,
  case when length(w) > 4 and w like '%ies' then left(w, length(w) - 3) || 'y' when length(w) > 3 and w like '%s' and not regexp_matches(w, '(ss|us|is)$') then left(w, length(w) - 1) else w end as stem_en
from w"""
)
def word_forms(spark, sf_dir):
    """Every distinct word in its other forms."""
    w = table(spark, sf_dir, "documents").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), 1)).alias("word")).distinct()
    return w.select("word", T.masculine(F.col("word")).alias("masculine"), T.uninflected(F.col("word")).alias("uninflected"), T.stem_en(F.col("word")).alias("stem_en"))


@query("select part.p_partkey, case when upper(p_type) = p_type and length(p_type) > 1 then upper(p_name) when left(p_type, 1) = upper(left(p_type, 1)) then upper(left(p_name, 1)) || substr(p_name, 2) else p_name end as cased from part")
def case_copies(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", T.same_case(F.col("p_type"), F.col("p_name")).alias("cased"))


@query("select l_returnflag, l_linestatus, l_linenumber, replace(printf('%.3f', avg(l_discount) * 100), '.', ',') || ' %' as share from lineitem where l_linenumber >= 0 group by all")
def percent_format(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").filter("l_linenumber >= 0").groupBy("l_returnflag", "l_linestatus", "l_linenumber").agg(T.percent(F.avg("l_discount")).alias("share"))


@query("select p_partkey, case when left(p_name, 1) in ('a', 'e', 'i', 'o', 'u', 'h') then 'Oeufs d''' else 'Oeufs de ' end || p_name || ' fumées' as name from part")
def template_names(spark, sf_dir):
    """Part names put into a template with elision."""
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", T.render_template(F.lit("Oeufs de {source} fumé{e}{s}"), F.col("p_name"), F.lit("f"), F.lit("p")).alias("name"))


@query()
def markup_render(spark, sf_dir):
    """Every turn as HTML in the book dialect; tested against plain Python."""
    from ..functions.markup import render

    return table(spark, sf_dir, "conversations").select("conv_id", "turn", render(F.col("text"), "book").alias("html"))
