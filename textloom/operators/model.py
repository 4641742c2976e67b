"""Layered definitions merged into effective texts, key indexes and name registries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.lineage import stage

#: Later layers win: the base game's texts, then those of jars, then the project's own.
LAYERS = ("vanilla", "jar", "project")
LOCALE = "^[a-z]{2}_[a-z]{2}$"
# The keys of objects, and those of proper names.
OBJECT_KEY = r"^(item|block|entity|biome|effect|enchantment|fluid|fluid_type|wood_type|leaves_type)\.([a-z0-9_]+)\.([a-z0-9_/]+)$"
PROPER_KEY = r"^(?:quests\.chapter\.[a-z0-9_]+\.title|dialog\.npc\.[a-z_]+\.name|shop\.[a-z_]+\.[a-z_]+|[a-z_]+[._]skills\.[a-z_]+\.[a-z_]+)$"


def priority(layer: Column, jar: Column, ns: Column, ordinal: Column) -> Column:
    """What orders definitions of one key: layer, jar (within jars), namespace, then their order in the input."""
    rank = F.array_position(F.array(*(F.lit(x) for x in LAYERS)), layer)
    return F.struct(rank.alias("rank"), F.when(layer == "jar", F.coalesce(jar, F.lit(""))).otherwise("").alias("jar"), ns.alias("ns"), ordinal.alias("ord"))


def merge_layers(entries: DataFrame, locale: str | None = None) -> DataFrame:
    """(locale, key, value, origin, ns) of the last writer of each key in each locale.

    entries: layer, jar, ns, locale, key, value, ord. One partial aggregate before one shuffle; a key's definitions never meet.
    """
    rows = entries if locale is None else entries.filter(F.col("locale") == locale)
    last = F.max_by(F.struct("value", F.col("layer").alias("origin"), "ns"), priority(F.col("layer"), F.col("jar"), F.col("ns"), F.col("ord")))
    return rows.groupBy("locale", "key").agg(last.alias("x")).select("locale", "key", "x.*")


def visible(key: Column) -> Column:
    """Keys that players see: those that don't begin with an underscore."""
    return ~key.startswith("_")


def effective_text(entries: DataFrame, rebuilt: DataFrame | None = None) -> DataFrame:
    """(key, en, origin_en, fr, origin_fr, ns_project, en_rebuilt, english): one row per key of English, French or rebuilt English.

    english is en where it isn't blank, else the rebuilt text, else empty.
    """
    merged = merge_layers(entries.filter(F.col("locale").isin("en_us", "fr_fr")))
    side = lambda loc: F.max(F.when(F.col("locale") == loc, F.struct("value", "origin", "ns")))
    wide = merged.groupBy("key").agg(side("en_us").alias("e"), side("fr_fr").alias("f"))
    project = (
        entries.filter((F.col("layer") == "project") & F.col("locale").isin("en_us", "fr_fr"))
        .groupBy("key")
        .agg(F.max_by("ns", F.struct("locale", "ns", "ord")).alias("ns_project"))
    )
    wide = wide.join(project, "key", "left")
    if rebuilt is None:
        wide = wide.withColumn("en_rebuilt", F.lit(None).cast("string"))
    else:
        wide = wide.join(rebuilt.select("key", F.col("en").alias("en_rebuilt")), "key", "full")
    return wide.select(
        "key",
        F.col("e.value").alias("en"),
        F.col("e.origin").alias("origin_en"),
        F.col("f.value").alias("fr"),
        F.col("f.origin").alias("origin_fr"),
        "ns_project",
        "en_rebuilt",
        F.when(~T.blank(F.col("e.value")), F.col("e.value")).otherwise(F.coalesce("en_rebuilt", "e.value", F.lit(""))).alias("english"),
    )


def project_texts(texts: DataFrame) -> DataFrame:
    """Visible keys whose French is the project's."""
    return texts.filter(visible(F.col("key")) & (F.col("origin_fr") == "project"))


def duplicate_definitions(entries: DataFrame, locale: str = "fr_fr") -> DataFrame:
    """(key, n_values, definitions map ns -> value) of project keys defined in several namespaces with different values."""
    last = entries.filter((F.col("layer") == "project") & (F.col("locale") == locale)).groupBy("key", "ns").agg(F.max_by("value", "ord").alias("value"))
    found = last.groupBy("key").agg(F.count_distinct("value").alias("n_values"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("ns", "value")))).alias("definitions"))
    return found.filter((F.col("n_values") > 1) & visible(F.col("key")))


def witnesses(entries: DataFrame, locales=("ko_kr", "zh_cn")) -> DataFrame:
    """(ns, key, texts map locale -> value) of the project's witness locales."""
    rows = entries.filter((F.col("layer") == "project") & F.col("locale").isin(*locales))
    last = rows.groupBy("ns", "key", "locale").agg(F.max_by("value", "ord").alias("value"))
    return last.groupBy("ns", "key").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("locale", "value")))).alias("texts"))


def key_index(entries: DataFrame) -> DataFrame:
    """(id, ns, key, en, origin, translations, present_pack, present_mods): one row per namespace and key, over all locales.

    Pack values overwrite jar values; origin is that of the English text (pack, jar or none); presence lists locales on each side,
    where an empty text counts as present.
    """
    side = F.when(F.col("layer") == "project", "pack").otherwise("mods")
    rows = entries.filter(F.col("locale").rlike(LOCALE)).withColumn("side", side)
    last = rows.groupBy("ns", "key", "locale").agg(
        F.max_by("value", F.struct((F.col("side") == "pack").alias("p"), F.coalesce("jar", F.lit("")).alias("j"), F.col("ord").alias("o"))).alias("value"),
        F.max(F.col("side") == "pack").alias("pack"),
        F.max(F.col("side") == "mods").alias("mods"),
    )
    locales = lambda flag: F.array_sort(F.collect_list(F.when(F.col(flag), F.col("locale"))))
    wide = last.groupBy("ns", "key").agg(
        F.max(F.when(F.col("locale") == "en_us", F.col("value"))).alias("en"),
        F.max(F.when(F.col("locale") == "en_us", F.when(F.col("pack"), "pack").otherwise("jar"))).alias("origin"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("locale") != "en_us", F.struct("locale", "value"))))).alias("translations"),
        locales("pack").alias("present_pack"),
        locales("mods").alias("present_mods"),
    )
    return wide.select(F.concat_ws(":", F.lit("lang"), "ns", "key").alias("id"), "ns", "key", "en", F.coalesce("origin", F.lit("none")).alias("origin"), "translations", "present_pack", "present_mods")


def names_by_key(index: DataFrame) -> DataFrame:
    """(key, namespaces, uncertain): which namespaces define a key; uncertain where there are several."""
    return index.groupBy("key").agg(F.array_sort(F.collect_set("ns")).alias("namespaces")).withColumn("uncertain", F.size("namespaces") > 1)


def first_namespace(entries: DataFrame) -> DataFrame:
    """(key, ns): the namespace of the first jar, by jar, namespace and order, that defines a key."""
    return entries.filter("layer = 'jar'").groupBy("key").agg(F.min_by("ns", F.struct("jar", "ns", "ord")).alias("ns"))


# --- names -------------------------------------------------------------------------------------------------------------------


def object_id(key: Column) -> Column:
    """ns:path of an object's key; null for other keys."""
    return F.when(key.rlike(OBJECT_KEY), F.concat_ws(":", F.regexp_extract(key, OBJECT_KEY, 2), F.regexp_extract(key, OBJECT_KEY, 3)))


def is_name(key: Column) -> Column:
    return key.rlike(OBJECT_KEY) | key.rlike(PROPER_KEY)


def registry(texts: DataFrame, generic: list[str] | None = None) -> DataFrame:
    """(key, en, fr, origin, identifier, en_tokens, fr_tokens, citable) of every named object and proper name.

    A name is citable if it has two words, or one of five letters, and isn't generic; names with digits or placeholders and names
    of materials are never cited.
    """
    rows = texts.filter(is_name(F.col("key")) & ~T.blank(F.col("english")) & ~T.blank(F.col("fr")))
    rows = rows.select("key", F.col("english").alias("en"), "fr", F.col("origin_fr").alias("origin"), object_id(F.col("key")).alias("identifier"))
    rows = rows.withColumn("en_tokens", T.words(F.col("en"))).withColumn("fr_tokens", T.words(F.col("fr")))
    fixed = F.array(*(T.words(F.lit(g)) for g in generic or ["\u0000"]))
    size = F.size("en_tokens")
    long_enough = (size >= 2) | ((size == 1) & (F.length(F.get("en_tokens", F.lit(0))) >= 5))
    return rows.withColumn(
        "citable",
        long_enough & ~F.col("en").rlike("[0-9%]") & ~F.col("key").rlike(r"^(wood|leaves)_type\.") & ~F.array_contains(fixed, F.col("en_tokens")),
    )


def homonym_groups(names: DataFrame) -> DataFrame:
    """(en_tokens, head, keys, variants) of names with the same English and different French, but for case, accents and plurals."""
    rows = names.filter(F.size("en_tokens") > 0).groupBy("en_tokens").agg(
        F.count_distinct("fr_tokens").alias("n"), F.array_sort(F.collect_set("key")).alias("keys"), F.array_sort(F.collect_set("fr")).alias("variants")
    )
    return rows.filter("n > 1").select("en_tokens", F.col("keys")[0].alias("head"), "keys", "variants")


# --- flattening ----------------------------------------------------------------------------------------------------------


def is_whole_json(text: Column) -> Column:
    """Whether the whole text is one JSON value. Parsers stop at a value's end; what follows it breaks a list or an object around it."""
    in_list = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("\n]"))), "$", "array<variant>")
    in_object = F.try_parse_json(F.concat(F.lit('{"x":'), text, F.lit("\n}")))
    return F.coalesce(F.size(in_list) == 1, F.lit(False)) & in_object.isNotNull()


def parsed_json(text: Column) -> Column:
    """A text as a variant; null unless the whole of it is one JSON value."""
    return F.when(is_whole_json(text), F.try_parse_json(text))


def flatten_json(docs: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(id, pointer, value) of every string in a JSON text, however deep. Walks down level by level while there are containers left.

    Each level is cut off in the shared folder, so that no text is parsed again for the next.
    """
    level = docs.select(F.col(id_col).alias("id"), F.lit("").alias("pointer"), parsed_json(F.col(json_col)).alias("v"))
    kind = F.schema_of_variant("v")
    leaves = None
    while True:
        found = level.filter(kind == "STRING").select("id", "pointer", F.expr("variant_get(v, '$', 'string')").alias("value"))
        leaves = found if leaves is None else leaves.unionByName(found)
        inner = level.filter(kind.startswith("OBJECT") | kind.startswith("ARRAY"))
        inner = inner.lateralJoin(docs.sparkSession.tvf.variant_explode(F.col("v").outer()).toDF("pos", "name", "inner"))
        level = stage(inner.select("id", F.concat("pointer", F.lit("/"), F.coalesce("name", F.col("pos").cast("string"))).alias("pointer"), F.col("inner").alias("v")), "level")
        if level.isEmpty():
            return leaves


def dotted(pointer: Column) -> Column:
    """A pointer as a path with dots and, for places in lists, brackets: /pages/0/text is pages[0].text."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(pointer, r"/(\d+)(?=/|$)", "[$1]"), "/", "."), r"^\.", "")


def array_fields(docs: DataFrame, id_col: str, json_col: str, fields: list[str]) -> DataFrame:
    """(id, field, value) of the named top-level string fields that are there and not blank."""
    pairs = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.get_json_object(json_col, f"$.{f}").alias("value")) for f in fields)))
    return docs.select(F.col(id_col).alias("id"), pairs.alias("x")).select("id", "x.*").filter(~T.blank(F.col("value")))


def numbered_lines(texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, line, content): the lines of a text from 1."""
    rows = texts.select(F.col(id_col).alias("id"), F.posexplode(F.split(F.col(text_col), "\n")).alias("n", "content"))
    return rows.select("id", (F.col("n") + 1).alias("line"), "content")


def unit_of(key: Column, ns: Column) -> Column:
    """The unit of work that a key belongs to: a quest chapter, the composed names, or its namespace."""
    return (
        F.when(key.rlike(r"^quests\.chapter\."), F.concat(F.lit("quests/"), F.regexp_extract(key, r"^quests\.chapter\.([^.]+)", 1)))
        .when(key.startswith("quests."), F.lit("quests"))
        .when(key.rlike(r"^(wood_type|leaves_type|block_type)\."), F.lit("composed"))
        .otherwise(F.coalesce(ns, F.lit("")))
    )
