"""Small views over the tables of the other operators: labels, themes, sub-units, counters, listings, and what reconciling writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.lineage import MOST_RULES
from .model import OBJECT_KEY

# Locales and how they are named; any other is named by its code.
LOCALES = {
    "fr_fr": "Français", "en_us": "Anglais", "es_es": "Espagnol", "es_mx": "Espagnol (Mexique)", "pt_br": "Portugais (Brésil)", "de_de": "Allemand",
    "it_it": "Italien", "nl_nl": "Néerlandais", "ru_ru": "Russe", "uk_ua": "Ukrainien", "pl_pl": "Polonais", "cs_cz": "Tchèque", "ja_jp": "Japonais",
    "ko_kr": "Coréen", "th_th": "Thaï", "tr_tr": "Turc", "zh_cn": "Chinois simplifié", "zh_tw": "Chinois (Taïwan)", "zh_hk": "Chinois (Hong Kong)",
}
# Keys of professions and shops, and keys that go on after an object's.
PEOPLE = r"^(?:entity\.minecraft\.villager(?:\.[a-z0-9_]+){1,2}|shop\.society_trading\.[a-z0-9_]+)$"
EXTENDED = r"^(?:item|block|entity|fluid|effect|enchantment|biome)\.([a-z0-9_]+)\.([a-z0-9_/]+)\."


def locale_label(code: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*(F.lit(x) for p in LOCALES.items() for x in p)), code), code)


def locales(index: DataFrame) -> DataFrame:
    """(locale, label, n): the locales that an index's entries are in."""
    rows = index.select(F.explode(F.array_union("present_pack", "present_mods")).alias("locale"))
    return rows.groupBy("locale").agg(F.count(F.lit(1)).alias("n")).select("locale", locale_label(F.col("locale")).alias("label"), "n")


def theme_of(block: Column, themes: dict[str, list[str]], default: str = "other") -> Column:
    """The theme of a block: quests, books, that of its namespace (what stands before its first slash), or the default."""
    root = F.split(block, "/")[0]
    out = F.when(root.startswith("quests:"), "quests").when(root.startswith("book:") | (root == "journal"), "books")
    for theme, spaces in themes.items():
        out = out.when(root.isin(*spaces), theme)
    return out.otherwise(default)


def sub_unit(key: Column, unit: Column) -> Column:
    """The part of a unit that is too large: its objects' names together, other keys by their first two segments."""
    return F.concat(unit, F.lit("/"), F.when(key.rlike(OBJECT_KEY), "names").otherwise(F.substring_index(key, ".", 2)))


def counters(decisions: DataFrame, glossary: DataFrame) -> DataFrame:
    """(item, n): keys with decisions, decisions, glossary terms."""
    a = decisions.agg(F.count_distinct("key").alias("traced keys"), F.count(F.lit(1)).alias("decisions")).unpivot([], ["traced keys", "decisions"], "item", "n")
    return a.unionByName(glossary.agg(F.count(F.lit(1)).alias("n")).select(F.lit("glossary terms").alias("item"), "n"))


def diff_listing(before: DataFrame, after: DataFrame, unreadable: DataFrame) -> DataFrame:
    """(file, kind, key, before, after, n): what revision_diff() tells apart, with both texts and how many of that kind the file has.

    Nothing is cut off: the key that nobody expected must not be lost among many.
    """
    from pyspark.sql import Window

    from .inventory import revision_diff

    rows = revision_diff(before, after, unreadable)
    rows = rows.join(before.select("file", "key", F.col("value").alias("before")), ["file", "key"], "left").join(after.select("file", "key", F.col("value").alias("after")), ["file", "key"], "left")
    return rows.select("file", "kind", "key", "before", "after", F.count(F.lit(1)).over(Window.partitionBy("file", "kind")).alias("n"))


def diff_code(listing: DataFrame, unreadable: DataFrame) -> int:
    """1 if any text differs in substance or a file can't be read, 2 if keys only came or went, else 0."""
    if not listing.filter("kind = 'substance'").isEmpty() or not unreadable.isEmpty():
        return 1
    return 2 if not listing.filter("kind in ('appeared', 'disappeared')").isEmpty() else 0


def reconciled_decisions(classes: DataFrame, decisions: DataFrame, said: DataFrame, date: str) -> tuple[DataFrame, DataFrame]:
    """(decisions to append, keys to set aside) of provenance classes.

    classes: key, class. decisions: key, seq, type, fr, file. said: key, fr. Where only accents or a ligature differ, the current text is
    the decision; absent keys go to the list of dead ones with the namespace of their object, their book, or the file that was traced.
    """
    last = decisions.groupBy("key").agg(F.max("seq").alias("upto"), F.min_by("file", F.when(F.col("file").isNotNull(), F.col("seq"))).alias("file"))
    rows = classes.join(last, "key")
    more = rows.filter(F.col("class").isin("accents", "ligature")).join(said, "key").select("key", (F.col("upto") + 1).alias("seq"), F.col("class").alias("type"), "fr", F.lit(date).alias("date"))
    ns = F.when(F.col("key").rlike(OBJECT_KEY), F.regexp_extract("key", OBJECT_KEY, 2)).when(F.col("key").contains("#"), F.split("key", "/")[0]).otherwise(F.regexp_extract(F.coalesce("file", F.lit("")), r"assets/([^/]+)/lang", 1))
    return more, rows.filter("class = 'absent'").select(ns.alias("ns"), "key", F.lit(date).alias("date"))


def implied_links(keys: DataFrame) -> DataFrame:
    """(key, object_id): keys that go on after an object's key are about the object."""
    return keys.filter(F.col("key").rlike(EXTENDED)).select("key", F.concat_ws(":", F.regexp_extract("key", EXTENDED, 1), F.regexp_extract("key", EXTENDED, 2)).alias("object_id"))


def npc_names(names: DataFrame) -> DataFrame:
    """(fr) of the people that players talk to. names: as registry() gives."""
    return names.filter(F.col("key").startswith("dialog.npc.")).select("fr").distinct()


def people(texts: DataFrame) -> list[str]:
    """The names of professions and shops, whose capitals are accepted anywhere, in order; an error beyond MOST_RULES."""
    found = texts.filter(F.col("key").rlike(PEOPLE) & ~T.blank(F.col("fr"))).select(T.strip(F.col("fr")).alias("fr")).distinct().limit(MOST_RULES + 1).collect()
    if len(found) > MOST_RULES:
        raise ValueError(f"over {MOST_RULES} names of people")
    return sorted(r.fr for r in found)


def written_prefix(name: Column, n: Column) -> Column:
    """The first n words of a name as it writes them; the whole name if it has fewer."""
    marked = F.regexp_replace(name, f"({T.WORD})", "$1\u0002")
    parts = F.split(marked, "\u0002")
    return F.when(F.size(parts) - 1 >= n, F.array_join(F.slice(parts, 1, n), "")).otherwise(name)


def element_view(actions: DataFrame, texts: DataFrame) -> DataFrame:
    """(lot, i, key, english, before, after, type, reason): an action as a reviewer sees it.

    Corrections show both texts, traces the traced one twice, generic words none; all others leave the current text as it is.
    """
    rows = actions.join(texts.select("key", F.col("english").alias("said_en"), F.col("fr").alias("said")), "key", "left")
    kind = F.col("type")
    traced = kind == "trace"
    before = F.when(kind == "generic", "").when(kind == "correction", F.coalesce("before", F.lit(""))).when(traced, F.col("after")).otherwise(F.coalesce("said", F.lit("")))
    after = F.when(kind.isin("correction", "trace"), F.coalesce("after", F.lit(""))).otherwise("")
    english = F.when(kind == "generic", "").otherwise(F.coalesce("said_en", F.lit("")))
    return rows.select("lot", "i", "key", english.alias("english"), before.alias("before"), after.alias("after"), "type", "reason")


def sample_page(actions: DataFrame, texts: DataFrame, most: int = 30) -> DataFrame:
    """(lot, n, key, english, before, after, type, reason): the sampled actions of each lot in their order, as a page shows them."""
    from pyspark.sql import Window

    from .changes import lot_sample

    rows = element_view(lot_sample(actions, most), texts)
    return rows.withColumn("n", F.row_number().over(Window.partitionBy("lot").orderBy("i"))).drop("i")


def question_keys(questions: DataFrame, wanted: list[str]) -> DataFrame:
    """(key) of the named questions (id, keys); an unknown question is an error."""
    known = {r.id for r in questions.filter(F.col("id").isin(*wanted)).select("id").distinct().collect()}
    if lacking := sorted(set(wanted) - known):
        raise ValueError(f"unknown questions: {', '.join(lacking)}")
    return questions.filter(F.col("id").isin(*wanted)).select(F.explode("keys").alias("key")).distinct()


def jars_of(entries: DataFrame) -> DataFrame:
    """(ns, jars): the jars that define a namespace's keys."""
    return entries.filter("layer = 'jar'").groupBy("ns").agg(F.array_sort(F.collect_set("jar")).alias("jars"))
