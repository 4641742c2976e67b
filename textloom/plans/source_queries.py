"""Sources, sinks and edits over files made from whole driver tables; the SQL states what the files say."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.lineage import place
from ..operators import changes as K
from ..operators import inventory as I
from ..operators import model as M
from ..operators import sampling as P
from ..operators import search as S
from ..sources import books as B
from ..sources import readers as R
from ..sources import writers as W
from .analogs import pick, table

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _parts(spark, sf_dir) -> DataFrame:
    """Parts with their number as text (n) and their name in one word (slug)."""
    p = table(spark, sf_dir, "part")
    return p.withColumn("n", F.col("p_partkey").cast("string")).withColumn("slug", F.replace("p_name", F.lit(" "), F.lit("_")))


# --- language files ----------------------------------------------------------------------------------------------------------


def _lang(spark, sf_dir) -> DataFrame:
    """A language file for each brand, size mod 3 and locale: names as strings, a number, and, by the size, a comment or a fault."""
    p = _parts(spark, sf_dir).withColumn("m", F.col("p_size") % 3).withColumn("locale", pick(["en_us", "fr_fr", "not_a"], F.col("p_partkey") % 3))
    rows = p.groupBy("p_brand", "m", "locale").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("n", "p_name"))))).alias("json"))
    body = F.concat(F.lit('{"count": 3,'), F.substring("json", 2, 2**31 - 1))
    text = F.when(F.col("m") == 1, F.concat(body, F.lit(" // made"))).when(F.col("m") == 2, F.concat(body, F.lit("]"))).otherwise(body)
    return rows.select(F.concat(F.lit("/jars/"), F.translate("p_brand", "#", "_"), F.lit("/ns"), F.col("m").cast("string"), F.lit("/lang/"), "locale", F.lit(".json")).alias("file"), text.alias("text"))


_FILE = "'/jars/' || replace(p_brand, '#', '_') || '/ns' || p_size % 3 || '/lang/' || ['en_us', 'fr_fr', 'not_a'][p_partkey % 3 + 1] || '.json'"
_LANG = "select replace(p_brand, '#', '_') as jar, 'ns' || p_size % 3 as ns, ['en_us', 'fr_fr'][p_partkey % 3 + 1] as locale, cast(p_partkey as varchar) as key, p_name as value from part where p_partkey % 3 < 2"


@query(f"{_LANG} and p_size % 3 = 0")
def scan_lang_files(spark, sf_dir):
    """Strict reading: files with comments or faults give nothing, as do locales that are none and values that are no strings."""
    return R.lang_files(_lang(spark, sf_dir), "jar").select("jar", "ns", "locale", "key", "value")


@query(f"{_LANG} and p_size % 3 < 2")
def scan_lang_files_tolerantly(spark, sf_dir):
    """Reading that passes over comments at the ends of lines."""
    return R.lang_files(_lang(spark, sf_dir), "jar", tolerant=True).select("jar", "ns", "locale", "key", "value")


@query(f"select distinct {_FILE} as file, p_size % 3 = 1 as tolerated from part where p_size % 3 > 0")
def unreadable_lang_files(spark, sf_dir):
    """Files that strict reading refuses, and whether tolerant reading takes them."""
    files = _lang(spark, sf_dir)
    bad = R.unreadable(files, tolerant=True).withColumn("bad", F.lit(True))
    return R.unreadable(files).join(bad, "file", "left").select("file", F.col("bad").isNull().alias("tolerated"))


@query("select p_brand as ns, cast(p_partkey as varchar) as key, p_name as value from part")
def snapshot_round_trip(spark, sf_dir):
    """Entries written as a snapshot and read back."""
    p = _parts(spark, sf_dir)
    e = p.select(F.lit("project").alias("layer"), F.lit("").alias("jar"), F.col("p_brand").alias("ns"), F.lit("fr_fr").alias("locale"), F.col("n").alias("key"), F.col("p_name").alias("value"), F.lit("f").alias("file"), F.col("p_partkey").alias("ord"))
    path = place(spark, "snapshot")
    W.write_snapshot(e, path, 4)
    return R.read_snapshot(spark, path, 4).select("ns", "key", "value")


@query("select n_name as file from nation where n_nationkey % 3 <> 0")
def stale_extracts(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_name").alias("file"), "n_nationkey")
    return W.stale_files(n.select("file"), n.filter("n_nationkey % 3 = 0"))


# --- books ----------------------------------------------------------------------------------------------------------------------


def _documents(spark, sf_dir) -> DataFrame:
    """A structured document for each part."""
    p = _parts(spark, sf_dir)
    page = F.struct(F.lit("patchouli:text").alias("type"), F.col("p_type").alias("text"), F.concat(F.lit("parts:"), "slug", F.lit(", parts:extra")).alias("item"))
    doc = F.to_json(F.struct(F.col("p_name").alias("name"), F.concat(F.lit("parts:p"), "n").alias("icon"), F.array(page).alias("pages"), F.col("p_size").alias("size")))
    return p.select(F.concat(F.lit("b/"), "n", F.lit(".json")).alias("file"), doc.alias("text"))


@query("select 'b/' || p_partkey || '.json' as file, '/name' as pointer, p_name as value from part union all select 'b/' || p_partkey || '.json', '/pages/0/text', p_type from part")
def scan_books(spark, sf_dir):
    """The text fields of documents by pointer."""
    return R.books(_documents(spark, sf_dir))


@query("select 'b/' || p_partkey || '.json' as file, list_aggregate(list_sort(['parts:extra', 'parts:p' || p_partkey, 'parts:' || replace(p_name, ' ', '_')]), 'string_agg', ',') as objects from part")
def scan_book_objects(spark, sf_dir):
    return R.book_objects(_documents(spark, sf_dir)).select("file", F.array_join("objects", ",").alias("objects"))


@query("select 'b/' || p_partkey || '.json#/name' as key, p_name as en, case when p_partkey % 2 = 0 then p_name else '' end as fr from part union all select 'b/' || p_partkey || '.json#/pages/0/text', p_type, case when p_partkey % 2 = 0 then p_type else '' end from part")
def pair_books(spark, sf_dir):
    """Fields with those of the same file and place in French; every other file isn't there."""
    b = R.books(_documents(spark, sf_dir))
    return R.paired_books(b, b.filter(F.regexp_extract("file", "([0-9]+)", 1).cast("bigint") % 2 == 0)).select("key", "en", "fr")


@query("select p_partkey as id, k as pointer, case k when 'name' then p_name else p_type end as value from part, (values ('name'), ('pages[0].text')) as v(k)")
def dotted_paths(spark, sf_dir):
    """Strings with their place as a dotted path."""
    b = R.books(_documents(spark, sf_dir))
    return b.select(F.regexp_extract("file", "([0-9]+)", 1).cast("bigint").alias("p_partkey"), M.dotted(F.col("pointer")).alias("pointer"), "value").withColumnRenamed("p_partkey", "id")


def _book_files(spark, sf_dir) -> DataFrame:
    """Books by brand, an entry for each part in two locales, a category for each type in French; the English multiblock is spelled otherwise."""
    p = _parts(spark, sf_dir)
    kind = F.col("p_partkey") % 4
    q = lambda c: F.regexp_extract(F.to_json(F.struct(c.alias("k"))), r'(?s)^\{"k":(.*)\}$', 1)

    def entry(locale: str, name, field: str):
        page = (
            F.when(kind == 0, F.concat(F.lit('{"type":"patchouli:text","title":'), q(name), F.lit(',"text":'), q(F.col("p_type")), F.lit("}")))
            .when(kind == 1, F.concat(F.lit(f'{{"type":"patchouli:multiblock","{field}":'), q(name), F.lit("}")))
            .when(kind == 2, F.concat(F.lit('{"type":"other","item":'), q(F.col("slug")), F.lit("}")))
            .otherwise(F.lit("null"))
        )
        text = F.concat(F.lit('{"name":'), q(name), F.lit(',"category":"patchouli:'), F.lower("p_type"), F.lit('","pages":['), page, F.lit("]}"))
        return p.select(F.concat(F.lit("/books/"), F.translate("p_brand", "#", "_"), F.lit(f"/{locale}/entries/"), "n", F.lit(".json")).alias("file"), text.alias("text"))

    types = p.filter("p_size % 2 = 0").select("p_brand", "p_type").distinct()
    cats = types.select(F.concat(F.lit("/books/"), F.translate("p_brand", "#", "_"), F.lit("/fr_fr/categories/"), F.lower("p_type"), F.lit(".json")).alias("file"), F.concat(F.lit('{"name":"Les '), "p_type", F.lit('"}')).alias("text"))
    fr = entry("fr_fr", F.concat(F.lit("é"), "p_name"), "name ")
    return B.book_files(fr.unionByName(entry("en_us", F.col("p_name"), "name")).unionByName(cats))


@query(
    """with p as (select replace(p_brand, '#', '_') as book, p_partkey || '.json' as path, p_partkey % 4 as k, p_name, p_type, replace(p_name, ' ', '_') as slug from part)
select book, path, case k when 0 then 'patchouli:text' when 1 then 'patchouli:multiblock' when 2 then 'other' else '?' end as type, k < 2 as translatable, case k when 0 then 'pages/0/title' when 1 then 'pages/0/name ' end as pointer,
  case k when 0 then 'title=' || p_name || '|é' || p_name || ';text=' || p_type || '|' || p_type when 1 then 'name=' || p_name || '|é' || p_name else '' end as fields, case k when 2 then slug end as summary from p"""
)
def book_pages(spark, sf_dir):
    """Pages with their fields in both locales, and what stands in for pages without any."""
    b = B.book_pages(_book_files(spark, sf_dir))
    shown = F.array_join(F.transform(F.coalesce("fields", F.expr("array()")), lambda f: F.concat(f["name"], F.lit("="), F.concat_ws("|", f["values"]["en_us"], f["values"]["fr_fr"]))), ";")
    return b.select("book", "path", "type", "translatable", "pointer", shown.alias("fields"), F.when(F.col("type") == "other", F.col("summary")).alias("summary"))


@query(
    """with c as (select distinct p_brand, p_type from part where p_size % 2 = 0) select replace(part.p_brand, '#', '_') as book, 'patchouli:' || lower(part.p_type) as category,
  case when c.p_type is null then 'patchouli:' || lower(part.p_type) else 'Les ' || c.p_type end as name, (row_number() over (partition by part.p_brand, part.p_type order by p_name, p_partkey || '.json'))::int as place, p_partkey || '.json' as path, 'é' || p_name as title, 1 as pages
from part left join c on c.p_brand = part.p_brand and c.p_type = part.p_type"""
)
def book_tree(spark, sf_dir):
    """Books, categories and entries in order; categories that only entries name are kept."""
    return B.book_tree(_book_files(spark, sf_dir))


# --- quests -----------------------------------------------------------------------------------------------------------------------


def _quests(spark, sf_dir) -> DataFrame:
    """A chapter of one quest for each part."""
    p = _parts(spark, sf_dir)
    snbt = F.concat(
        F.lit('{ filename: "c'), "n", F.lit('", group: "'), "p_brand", F.lit('"\n order_index: '), F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("string")).otherwise('"x"'),
        F.lit('\n quests: [{ id: "00'), "n", F.lit('1", title: "{quests.t'), "n", F.lit('} \\"now\\"", icon: "parts:'), "slug", F.lit('", dependencies: ["000A", "0B"], invisible: '),
        F.when(F.col("p_partkey") % 3 == 0, "true").otherwise("0b"), F.lit(', tasks: [{ id: "1", title: "{task.t'), "n", F.lit('}", item: "parts:tool", count: 5L }] }], x: [I; 1, 2], y: 1.5d }'),
    )
    return R.quests(p.select(F.concat(F.lit("c"), "n").alias("chapter"), snbt.alias("snbt")))


_QUEST = "'quest' || ltrim(p_partkey || '1', '0')"


@query(
    f"""select 'c' || p_partkey as chapter, p_brand as "group", case when p_size % 2 = 0 then p_size else 999 end as place, {_QUEST} as id, '{{quests.t' || p_partkey || '}} "now"' as title, 'parts:' || replace(p_name, ' ', '_') as icon,
  p_partkey % 3 = 0 as hidden, 'questA,questB' as dependencies, 'quests.t' || p_partkey as keys, 'task.t' || p_partkey || '=parts:tool' as tasks from part"""
)
def scan_quests(spark, sf_dir):
    """Quests out of named-tag text, with ids, references and tasks."""
    q = _quests(spark, sf_dir)
    tasks = F.array_join(F.transform("tasks", lambda t: F.concat(t["title_key"], F.lit("="), F.array_join(t["objects"], ","))), ";")
    return q.select("chapter", "group", F.col("place").cast("bigint").alias("place"), "id", "title", "icon", "hidden", F.array_join("dependencies", ",").alias("dependencies"), F.array_join("keys", ",").alias("keys"), tasks.alias("tasks"))


@query(
    f"""with q as (select p_brand as g, case when p_size % 2 = 0 then p_size else 999 end as place, 'c' || p_partkey as chapter, {_QUEST} as id from part)
select g as "group", string_agg(chapter || ':' || id, ' ' order by place, chapter) as chapters from q group by g"""
)
def quest_tree(spark, sf_dir):
    """Groups with their chapters in order; those without a place come last."""
    t = R.quest_tree(_quests(spark, sf_dir))
    return t.select("group", F.array_join(F.transform("chapters", lambda c: F.concat(c["chapter"], F.lit(":"), F.array_join(F.transform(c["quests"], lambda q: q["id"]), ","))), " ").alias("chapters"))


@query("select 'quests.t' || p_partkey as key, 'parts:' || replace(p_name, ' ', '_') as object_id from part union all select 'task.t' || p_partkey, 'parts:tool' from part")
def link_texts(spark, sf_dir):
    """Texts and the objects that quests tie them to."""
    none = spark.createDataFrame([], "key string, object_id string")
    return R.text_links(_quests(spark, sf_dir), none, spark.createDataFrame([], "key string, objects array<string>"))


# --- scripts ------------------------------------------------------------------------------------------------------------------------


def _scripts(spark, sf_dir) -> DataFrame:
    p = _parts(spark, sf_dir)
    source = F.concat(
        F.lit("// tip('parts:no', 'no.key')\ntip(['parts:"), "slug", F.lit("', 'parts:p"), "n", F.lit("'], 'tip.p"), "n", F.lit("', [f(1, 'x')]) /* tip('a:b', 'c.d') */\nsay('say.k"), (F.col("p_partkey") % 7).cast("string"),
        F.lit("', "), F.when(F.col("p_size") % 2 == 0, "player.getName()").otherwise("'season'"), F.lit(", (1, 2)); s = \"// tip('x:y', 'z.z')\"\ne.create('my:p"), "n", F.lit("'"), F.when(F.col("p_partkey") % 2 == 0, ", 'block'").otherwise(""),
        F.lit(")\nText.of('Shown "), "n", F.lit("')"),
    )
    return p.select(F.concat("n", F.lit(".js")).alias("path"), source.alias("source"))


@query("select p_partkey || '.js' as path, 'tip' as name, 3 as args from part union all select p_partkey || '.js', 'tip', 2 from part union all select p_partkey || '.js', 'say', 3 from part")
def scan_calls(spark, sf_dir):
    """Calls in scripts with their top-level arguments; comments don't count, strings do."""
    return R.calls(_scripts(spark, sf_dir), ["tip", "say"]).select("path", "name", F.size("args").alias("args"))


@query("select 'tip.p' || p_partkey as key, list_aggregate(list_sort(['parts:' || replace(p_name, ' ', '_'), 'parts:p' || p_partkey]), 'string_agg', ',') as objects from part union all select 'z.z', 'x:y'")
def tooltip_links(spark, sf_dir):
    return R.tooltip_links(R.calls(_scripts(spark, sf_dir), ["tip"])).select("key", F.array_join("objects", ",").alias("objects"))


@query("select 'say.k' || p_partkey % 7 as key, string_agg(distinct case when p_size % 2 = 0 then 'object' else 'season' end, ',' order by case when p_size % 2 = 0 then 'object' else 'season' end) || ';other' as types from part group by 1")
def argument_types(spark, sf_dir):
    """What is passed to each template, by place."""
    t = R.argument_types(R.calls(_scripts(spark, sf_dir), ["say"]))
    return t.select("key", F.array_join(F.transform("types", lambda k: F.array_join(k, ",")), ";").alias("types"))


@query("select case when p_partkey % 2 = 0 then 'block' else 'item' end || '.my.p' || p_partkey as key, 'P' || p_partkey as english from part where p_partkey % 3 <> 0")
def registered_keys(spark, sf_dir):
    """Keys that scripts register and no language file has."""
    known = _parts(spark, sf_dir).filter("p_partkey % 3 = 0").select(F.concat(F.when(F.col("p_partkey") % 2 == 0, "block").otherwise("item"), F.lit(".my.p"), "n").alias("key"))
    return I.registrations(_scripts(spark, sf_dir), known)


@query("select p_partkey || '.js' as path, 5 as line, 'Shown ' || p_partkey as text from part")
def hardcoded_texts(spark, sf_dir):
    return I.hardcoded(_scripts(spark, sf_dir))


# --- small sources --------------------------------------------------------------------------------------------------------------------


@query("select distinct 'parts:' || replace(p_name, ' ', '_') as id from part where p_size % 2 = 0")
def sold_items(spark, sf_dir):
    p = _parts(spark, sf_dir)
    return R.sold_items(p.select(F.col("p_brand").alias("shop"), F.concat(F.lit("parts:"), "slug").alias("item"), (F.col("p_size") % 2 == 1).alias("has_nbt")))


@query("select 'wood.n' || n_nationkey as essence from nation where n_nationkey % 2 = 0 union all select 'leaves.parts.n' || n_nationkey from nation")
def switched_essences(spark, sf_dir):
    """What line-based files switch on, up to their section of entries."""
    n = table(spark, sf_dir, "nation")
    k = F.col("n_nationkey").cast("string")
    lines = F.array(F.lit("[wood]"), F.concat(F.lit("n"), k, F.lit(" = "), F.when(F.col("n_nationkey") % 2 == 0, "true").otherwise("false")), F.lit("[leaves]"), F.concat(F.lit('"parts:n'), k, F.lit('" = true')), F.lit("[entries]"), F.lit("late = true"))
    return R.essences(n.select(F.col("n_name").alias("file"), F.posexplode(lines).alias("n", "text")))


@query("select user_id as run, count(*) filter (event_type = 'click') as started, count(*) filter (event_type = 'view') as done from events group by 1")
def agent_runs(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return R.agent_runs(e.select(F.col("user_id").alias("run"), F.when(F.col("event_type") == "click", "started").when(F.col("event_type") == "view", "done").alias("event")))


@query("with g as (select *, row_number() over (partition by p_name order by p_size % 3 > 0, p_partkey) as r from part) select p_name as en, p_type as fr, case when p_size % 3 > 0 then p_brand end as sense from g where r = 1")
def glossary_entries(spark, sf_dir):
    """One entry for each English term: the first without a sense, else the first."""
    p = table(spark, sf_dir, "part")
    return R.glossary_entries(p.select(F.col("p_name").alias("en"), F.col("p_type").alias("fr"), F.when(F.col("p_size") % 3 > 0, F.col("p_brand")).alias("sense"), F.col("p_partkey").alias("ord")))


@query("select count(*) as n from part")
def checked_rows(spark, sf_dir):
    """A table that keeps its rules is handed on as it is."""
    p = table(spark, sf_dir, "part")
    return R.checked(p, {"named": ~T.blank(F.col("p_name")), "sized": F.col("p_size") > 0}, "part").agg(F.count(F.lit(1)).alias("n"))


# --- sinks -----------------------------------------------------------------------------------------------------------------------------


@query("with r as (select c_nationkey as zone, lpad(cast(c_custkey as varchar), 9, '0') as id, row_number() over (partition by c_nationkey order by c_custkey) - 1 as pos from customer) select zone, id, pos // 25 + 1 as packet from r")
def review_packets(spark, sf_dir):
    """Texts in packets of 25 within each zone."""
    c = table(spark, sf_dir, "customer")
    t = c.select(F.col("c_nationkey").alias("zone"), F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("id"), F.col("c_name").alias("fr"))
    return W.packets(t, "F1", 25).select("zone", "id", "packet")


def _glossary(spark, sf_dir) -> DataFrame:
    p = _parts(spark, sf_dir)
    return p.select(F.concat("p_name", F.lit("|"), "n").alias("en"), F.col("p_type").alias("fr"), F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).alias("sense"), F.concat(F.lit("o"), (F.col("p_partkey") % 3).cast("string")).alias("origin"), F.concat(F.lit("lot a : "), "p_name").alias("reason"), (F.col("p_size") % 3 == 0).alias("keep_english"))


_REASON = "upper(left(p_name, 1)) || substr(p_name, 2)"


@query(
    f"""select 'o' || p_partkey % 3 as origin, 1 as kind, '| ' || p_name || '\\|' || p_partkey || ' | ' || p_type || ' | ' || case when p_size % 2 = 0 then p_brand else '' end || ' | ' || {_REASON} || ' |' as line from part
union all select distinct 'o' || p_partkey % 3, 0, '## o' || p_partkey % 3 || chr(10) || chr(10) || '| English | French | Sense | Reason |' || chr(10) || '|---|---|---|---|' from part"""
)
def glossary_pages(spark, sf_dir):
    """The glossary as tables, one for each origin."""
    return W.glossary_markdown(_glossary(spark, sf_dir)).select("place.origin", "place.kind", "line")


@query(f"select p_name || '|' || p_partkey as en, {_REASON} as reason from part where p_size % 3 = 0")
def kept_english(spark, sf_dir):
    return W.kept_english(_glossary(spark, sf_dir))


@query("select 'k' || p_partkey as key, case when p_partkey % 2 = 0 then 'own/' || p_brand else 'made/ns' end as file, p_type as expected from part where p_size % 3 > 0 union all select 'k' || p_partkey, 'other/' || p_brand, p_type from part where p_size % 3 > 0 and p_partkey % 2 = 0")
def family_files(spark, sf_dir):
    """Every project file that defines a member, else the file of its own namespace."""
    p = _parts(spark, sf_dir)
    key = F.concat(F.lit("k"), "n").alias("key")
    names = p.select(key, F.when(F.col("p_size") % 3 > 0, F.col("p_type")).alias("expected"))
    even = p.filter("p_partkey % 2 = 0")
    defs = even.select(key, F.concat(F.lit("own/"), "p_brand").alias("file"), F.lit("project").alias("layer")).unionByName(even.select(key, F.concat(F.lit("other/"), "p_brand").alias("file"), F.lit("project").alias("layer")))
    defs = defs.unionByName(p.select(key, F.lit("jar/x").alias("file"), F.lit("jar").alias("layer")))
    return W.family_targets(names, defs, F.lit("made/ns"))


@query(
    """with e as (select 'f' || p_partkey % 40 as file, 'k' || p_partkey % 400 as key, arg_max(p_name, p_partkey) as value from part group by all), f as (select 'f' || n as file, n % 4 as kind from range(40) as r(n)),
old as (select 'f' || n as file, 'a' as key, '"old"' as json from range(40) as r(n) where n % 4 < 2 union all select 'f' || n, 'k' || n, '"before"' from range(40) as r(n) where n % 4 < 2 and 'k' || n not in (select key from e where e.file = 'f' || n) union all select 'f' || n, 'n', '5' from range(40) as r(n) where n % 4 < 2),
l as (select file, key, json from old union all select file, key, to_json(value)::varchar from e)
select f.file, case when kind = 2 then 'holds comments' when kind = 3 then 'unreadable' end as problem, case when kind < 2 then '{' || chr(10) || string_agg('  "' || key || '": ' || json, ',' || chr(10) order by key) || chr(10) || '}' || chr(10) end as text
from f join l using (file) where exists(select 1 from e where e.file = f.file) group by f.file, kind"""
)
def language_edits(spark, sf_dir):
    """Language files as they have to be written again, or why they mustn't be."""
    p = _parts(spark, sf_dir)
    edits = p.select(F.concat(F.lit("f"), (F.col("p_partkey") % 40).cast("string")).alias("file"), F.concat(F.lit("k"), (F.col("p_partkey") % 400).cast("string")).alias("key"), F.col("p_name").alias("value"), F.col("p_partkey").alias("ord"))
    n = spark.range(40).select(F.col("id").cast("string").alias("n"), (F.col("id") % 4).alias("kind"))
    body = F.concat(F.lit('{"n": 5, "k'), "n", F.lit('": "before", "a": "old"'))
    text = F.when(F.col("kind") < 2, F.concat(body, F.lit("}"))).when(F.col("kind") == 2, F.concat(body, F.lit("} // note"))).otherwise(body)
    return W.language_edits(n.select(F.concat(F.lit("f"), "n").alias("file"), text.alias("text")), edits).select("file", "text", "problem")


@query(
    """select p_brand as file, 'k' || p_partkey as key, case when p_partkey % 3 > 0 then p_name end as "before", case p_partkey % 4 when 0 then '' when 1 then p_name || ' %s' else p_name || 'x' end as "after", case p_partkey % 4 when 0 then 'empty' when 1 then 'tokens' end as problem
from part where p_partkey % 4 < 3 or p_partkey % 3 = 0"""
)
def output_targets(spark, sf_dir):
    """What a batch's outputs put into their targets: refused, new or changed; what is said already is left out."""
    p = _parts(spark, sf_dir)
    k = F.col("p_partkey")
    key = F.concat(F.lit("k"), "n").alias("key")
    fr = F.when(k % 4 == 0, "").when(k % 4 == 1, F.concat("p_name", F.lit(" %s"))).otherwise(F.concat("p_name", F.lit("x")))
    out = p.select(F.col("p_brand").alias("file"), key, F.col("p_name").alias("en"), fr.alias("fr"), F.lit(2).alias("ord")).unionByName(p.select(F.col("p_brand").alias("file"), key, F.col("p_name").alias("en"), F.lit("first").alias("fr"), F.lit(1).alias("ord")))
    now = p.filter("p_partkey % 3 > 0").select(F.col("p_brand").alias("file"), key, F.when(k % 4 == 3, F.concat("p_name", F.lit("x"))).otherwise(F.col("p_name")).alias("value"))
    return W.output_targets(out, now)


@query(
    """select case when p_partkey % 4 > 0 then p_brand end as file, 'k' || p_partkey as key, case when p_partkey % 4 > 0 then case p_partkey % 4 when 1 then 'new' when 2 then 'old' else 'other' end end as "before", 'new' as "after",
  case p_partkey % 4 when 0 then 'unknown key' when 1 then 'done' when 3 then 'text has changed' end as problem from part"""
)
def review_edits(spark, sf_dir):
    """A review's corrections against the current texts."""
    p = _parts(spark, sf_dir)
    key = F.concat(F.lit("k"), "n").alias("key")
    now = p.filter("p_partkey % 4 > 0").select(F.col("p_brand").alias("file"), key, pick(["x", "new", "old", "other"], F.col("p_partkey") % 4).alias("value"))
    return W.review_edits(p.select(key, F.lit("old").alias("before"), F.lit("new").alias("after")), now)


@query(
    """select 'k' || p_partkey as what, case when p_partkey % 3 = 0 then 'ruled' else p_name end as said from part union all
select t, 'kept' from (select distinct p_type as t from part where p_size % 5 = 0 union select n_name from nation)"""
)
def arbitrated_outputs(spark, sf_dir):
    """Outputs after the rulings, and the terms kept in English."""
    p = _parts(spark, sf_dir)
    key = F.concat(F.lit("k"), "n").alias("key")
    rulings = p.select(key, F.when(F.col("p_partkey") % 3 == 0, "ruled").alias("fr"), F.when(F.col("p_size") % 5 == 0, F.col("p_type")).alias("keep_english"))
    fixed, kept = W.arbitrated(p.select(key, F.col("p_name").alias("fr")), rulings, table(spark, sf_dir, "nation").select(F.col("n_name").alias("term")))
    return fixed.select(F.col("key").alias("what"), F.col("fr").alias("said")).unionByName(kept.select(F.col("term").alias("what"), F.lit("kept").alias("said")))


@query(
    """with e as (select user_id as key, event_id as ord, event_type as fr from events), d as (select n_nationkey as key, 3 as seq, 'click' as fr from nation),
x as (select e.*, coalesce(lag(e.fr) over (partition by key order by ord), d.fr) as said, coalesce(seq, 0) as upto from e left join d using (key)),
n as (select key, upto + row_number() over (partition by key order by ord) as seq, 'fix' as type, fr, 'today' as date from x where said is distinct from fr)
select key, seq, type, fr, date from n union all select key, seq, 'old', fr, 'before' from d"""
)
def traced_decisions(spark, sf_dir):
    """Decisions with a user's events after them, where they change what was said."""
    d = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("key"), F.lit(3).cast("bigint").alias("seq"), F.lit("old").alias("type"), F.lit("click").alias("fr"), F.lit("before").alias("date"))
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("key"), F.lit("fix").alias("type"), F.col("event_type").alias("fr"), F.col("event_id").alias("ord"))
    return W.traced(d, e, "today")


# --- search, reviews, change sets ----------------------------------------------------------------------------------------------------------


@query(
    """with g as (select distinct string_split(p_name, ' ')[2] as t from part), d as (select p_partkey as k, p_name, p_partkey % 2 as odd from part)
select 'lang:ns:k' || k as id, string_split(p_name, ' ')[2] || '=x' as terms, case when odd = 0 then 2 else 0 end as decisions, case when k % 5 = 0 then 'look' end as mark, odd = 0 and k % 4 = 0 as uncertain from d
union all select 'lang:two:k' || k, string_split(p_name, ' ')[2] || '=x', case when odd = 0 then 2 else 0 end, null, odd = 0 from d where k % 4 = 0"""
)
def entry_details(spark, sf_dir):
    """Entries with their decisions, glossary terms and review mark; keys of several namespaces with an unplaced decision are uncertain."""
    p = _parts(spark, sf_dir)
    key = F.concat(F.lit("k"), "n")
    row = lambda d, ns: d.select(F.concat(F.lit(f"lang:{ns}:"), key).alias("id"), F.lit(ns).alias("ns"), key.alias("key"), F.col("p_name").alias("en"))
    index = row(p, "ns").unionByName(row(p.filter("p_partkey % 4 = 0"), "two"))
    even = p.filter("p_partkey % 2 = 0").select(key.alias("key"))
    decisions = even.select("key", F.lit(1).alias("seq"), F.lit("a").alias("type"), F.lit("f").alias("fr"), F.lit("here").alias("file")).unionByName(even.select("key", F.lit(2).alias("seq"), F.lit("b").alias("type"), F.lit("f").alias("fr"), F.lit(None).cast("string").alias("file")))
    glossary = p.select(F.split("p_name", " ")[1].alias("en"), F.lit("x").alias("fr")).distinct()
    marks = p.filter("p_partkey % 5 = 0").select(F.concat(F.lit("lang:ns:"), key).alias("id"), F.lit("look").alias("note"))
    d = S.detail(index, decisions, glossary, marks)
    terms = F.array_join(F.transform("terms", lambda t: F.concat_ws("=", t["en"], t["fr"])), ",")
    return d.select("id", terms.alias("terms"), F.when(F.col("decisions").isNull(), 0).otherwise(F.size("decisions")).alias("decisions"), "mark", "uncertain")


@query("select p_partkey as id, case when p_size % 3 = 0 then 'new' else 'old' end as note from part where p_partkey % 4 <> 0 and not (p_partkey % 4 = 1 and p_size % 2 = 0)")
def review_queue(spark, sf_dir):
    """The queue after marks were put and others taken away by id or by name."""
    p = _parts(spark, sf_dir)
    row = lambda d, note: d.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("ns"), F.concat(F.lit("k"), "n").alias("key"), F.lit(note).alias("note"))
    q = S.mark(row(p, "old"), row(p.filter("p_size % 3 = 0"), "new"))
    by_id = p.filter("p_partkey % 4 = 0").select(F.col("p_partkey").alias("id"), F.lit(None).cast("string").alias("ns"), F.lit(None).cast("string").alias("key"))
    by_name = p.filter("p_partkey % 4 = 1 and p_size % 2 = 0").select(F.lit(None).cast("bigint").alias("id"), F.col("p_brand").alias("ns"), F.concat(F.lit("k"), "n").alias("key"))
    return S.unmark(q, by_id.unionByName(by_name)).select("id", "note")


@query("select case p_partkey % 4 when 0 then 'empty' when 1 then 'tokens' else 'untranslated' end as code, count(*) as n from part where p_partkey % 4 < 2 or p_partkey % 4 = 2 and p_size % 2 = 1 and regexp_matches(p_name, '[A-Za-z]{4,}') group by 1")
def flagged_by_code(spark, sf_dir):
    """How many pairs break which rule of validation; kept keys may stay as they are."""
    p = _parts(spark, sf_dir)
    k = F.col("p_partkey") % 4
    key = F.concat(F.lit("k"), "n").alias("key")
    fr = F.when(k == 0, " ").when(k == 1, F.concat("p_name", F.lit(" %s"))).when(k == 2, F.col("p_name")).otherwise(F.concat("p_name", F.lit("o")))
    return I.flagged_counts(p.select(key, F.col("p_name").alias("en"), fr.alias("fr")), p.filter("p_size % 2 = 0").select(key))


@query("select 'k' || p_partkey as key, p_brand as control from part where p_size % 2 = 0 and (p_brand = 'Brand#1' or p_partkey % 5 = 0)")
def selected_findings(spark, sf_dir):
    """Blocking findings of a control, or of given keys."""
    p = _parts(spark, sf_dir)
    key = F.concat(F.lit("k"), "n").alias("key")
    f = p.select(F.col("p_brand").alias("control"), key, F.when(F.col("p_size") % 2 == 0, "blocking").otherwise("flagged").alias("status"))
    return K.selected(f, ["Brand#1"], p.filter("p_partkey % 5 = 0").select(key), blocking=True).select("key", "control")


@query("select p_partkey as id, 'k' || p_partkey as key from part where p_partkey % 2 = 0 and p_partkey % 3 <> 0 union all select p_partkey, null from part where p_partkey % 2 = 1 and p_size > 25")
def unproven_findings(spark, sf_dir):
    """Proofs that name a key or a line that isn't there."""
    p = _parts(spark, sf_dir)
    key = F.concat(F.lit("k"), "n")
    proofs = p.select(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 2 == 0, key).alias("key"), F.when(F.col("p_partkey") % 2 == 1, F.lit("f")).alias("file"), F.col("p_size").alias("line"))
    lines = p.select(F.lit("f").alias("file"), F.col("p_size").alias("line")).filter("line <= 25").distinct()
    return K.unproven(proofs, p.filter("p_partkey % 3 = 0").select(key.alias("key")), lines).select("id", "key")


@query("select 'k' || p_partkey as key, case p_partkey % 5 when 0 then 'same' when 1 then 'contrary' when 2 then 'too wide' when 3 then 'create' else 'update' end as state from part")
def family_changes(spark, sf_dir):
    """What families would change, each in one of five states."""
    p = _parts(spark, sf_dir)
    k = F.col("p_partkey") % 5
    key = F.concat(F.lit("k"), "n").alias("key")
    names = p.select(key, F.when(k == 2, F.repeat(F.lit("wide"), 40)).otherwise(F.col("p_name")).alias("expected"))
    said = p.select(key, F.when(k == 0, F.col("p_name")).when(k != 3, "other").alias("fr"))
    return K.family_proposals(names, said, p.filter(k == 1).select(key, F.lit("decided").alias("decided")), limit=500).select("key", "state")


@query("select n_nationkey as net, round_even(0.01 * n_nationkey * 50000 * 0.98 + 0.8 * 50000 * 0.02, 0)::bigint as alerts from nation")
def projected_alerts(spark, sf_dir):
    """Alerts to expect over 50,000 texts, of which two in a hundred have a defect, by the share of false alarms."""
    n = table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").alias("net"), P.projection(F.col("n_nationkey") * F.lit(0.01).cast("decimal(4,2)"), F.lit(0.8).cast("decimal(4,2)"), F.lit(50000), F.lit(0.02).cast("decimal(4,2)")).alias("alerts"))


@query(
    r"""with w as (select distinct unnest(regexp_extract_all(lower(text), '([\p{L}]+)', 1)) as w from documents where lang = 'fr'), f as (select w, strip_accents(w) as f from w)
select w as word, case when length(f) > 3 and regexp_matches(f, '[^s][sx]$') then left(f, length(f) - 1) else f end as stem from f"""
)
def light_stems(spark, sf_dir):
    """Every distinct French word by its light stem."""
    w = table(spark, sf_dir, "documents").filter("lang = 'fr'").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), 1)).alias("word")).distinct()
    return w.select("word", T.stem_fr(F.col("word")).alias("stem"))


@query(
    """with c as (select c_custkey as k, ['correction', 'trace', 'exception'][c_custkey % 3 + 1] as type, 'k' || c_custkey as key, case when c_custkey % 5 = 0 then 'now' else 'old' end as "before" from customer),
d as (select 'k' || c_custkey as key, case c_custkey % 4 when 0 then 'old' when 1 then 'new' when 2 then 'now' else 'other' end as value, case when c_custkey % 7 = 0 then 'vanilla' when c_custkey % 7 = 1 then 'jar' else 'project' end as layer from customer where c_custkey % 11 > 0),
v as (select c.*, d.value, d.layer, case when k % 17 = 0 then 'outside the perimeter' when type = 'correction' and value is null then 'unknown key' when type = 'correction' and layer = 'vanilla' then 'text of the base game'
  when type = 'correction' and value <> "before" and value <> 'new' then 'text has changed' when type <> 'correction' and value is distinct from "before" then 'quoted text isn''t the key''s' end as why from c left join d using (key))
select k as i, case when why is not null then 'refused' when type = 'correction' and value = 'new' then 'done' else 'apply' end as verdict, coalesce(why, '') as why,
  case when why is null and type = 'correction' and value <> 'new' then case when layer = 'jar' then 'jar' else 'a,b' end else '' end as files from v"""
)
def lot_plan_of_customers(spark, sf_dir):
    """What becomes of every customer's action, with definitions for nearly all of them."""
    c = table(spark, sf_dir, "customer")
    n = F.col("c_custkey")
    key = F.concat(F.lit("k"), n.cast("string")).alias("key")
    actions = c.select(F.lit(1).alias("lot"), n.alias("i"), pick(["correction", "trace", "exception"], n % 3).alias("type"), key, F.when(n % 5 == 0, "now").otherwise("old").alias("before"), F.lit("new").alias("after"))
    layer = F.when(n % 7 == 0, "vanilla").when(n % 7 == 1, "jar").otherwise("project")
    rows = c.filter("c_custkey % 11 > 0").select(key, pick(["old", "new", "now", "other"], n % 4).alias("value"), layer.alias("layer"))
    files = F.when(F.col("layer") == "project", F.array(F.lit("a"), F.lit("b"))).otherwise(F.array("layer"))
    defs = rows.select("key", F.explode(files).alias("file"), "value", "layer")
    return K.plan_lot(actions, actions.filter("i % 17 <> 0").select("lot", "key"), defs).select("i", "verdict", "why", F.array_join("files", ",").alias("files"))


@query("with d as (select c_nationkey as stratum, count(*) as size from customer group by 1), r as (select c_nationkey as stratum, c_custkey as id, row_number() over (partition by c_nationkey order by sha1('s|' || c_custkey), c_custkey) as n from customer) select stratum, id from r join d using (stratum) where n <= least(size, 7)")
def evenly_drawn(spark, sf_dir):
    """Seven customers of each nation in the order of a hash."""
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("stratum"), F.col("c_custkey").alias("id"))
    return P.draw(c, c.groupBy("stratum").agg(F.count(F.lit(1)).alias("size")).withColumn("quota", F.least("size", F.lit(7))), "s")
