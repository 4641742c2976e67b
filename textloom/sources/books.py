"""The tree of books: books, categories, entries, pages and their fields, each with its values by locale."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lineage import listed, stage
from ..operators.model import parsed_json

# The translatable fields of each type of page; a field "name " is read from "name" where it isn't there.
FIELDS = {"patchouli:text": ["title", "text"], "patchouli:entity": ["name", "text"], "patchouli:multiblock": ["name "]}
REFERENCE = "fr_fr"


def book_files(files: DataFrame) -> DataFrame:
    """(book, locale, kind, path, text, file) of the entries and categories below <book>/<locale>/. files: file, text.

    Only the path has slashes within it, so that one match, split at the first three, gives all parts.
    """
    pattern = r"[^/]+/[a-z]{2}_[a-z]{2}/(?:entries|categories)/.+\.json$"
    rows = files.select(F.split(F.regexp_extract("file", pattern, 0), "/", 4).alias("at"), "text", "file")
    part = lambda i: F.get("at", F.lit(i))
    return rows.select(part(0).alias("book"), part(1).alias("locale"), part(2).alias("kind"), part(3).alias("path"), "text", "file").filter("book != ''")


def unreadable_books(files: DataFrame) -> DataFrame:
    """(file) of the files that are no JSON, and of the entries whose pages are no list. files: as book_files gives."""
    v = files.withColumn("v", parsed_json(F.col("text")))
    pages = F.expr("schema_of_variant(variant_get(v, '$.pages', 'variant'))")
    odd = (F.col("kind") == "entries") & F.expr("variant_get(v, '$.pages', 'variant') is not null") & ~pages.startswith("ARRAY")
    return v.filter(F.col("v").isNull() | odd).select("file")


def references(files: DataFrame) -> DataFrame:
    """(book, ref): the locale by which a book is read: the reference locale, else the first that it has.

    Locales are gathered as a set by hashing: the smallest of texts would have all files sorted.
    """
    locales = files.groupBy("book").agg(F.collect_set("locale").alias("all"))
    return locales.select("book", F.when(F.array_contains("all", REFERENCE), REFERENCE).otherwise(F.array_min("all")).alias("ref"))


def _string(path: str):
    return F.expr(f"try_variant_get(v, '$.{path}', 'string')")


def parsed_books(files: DataFrame) -> DataFrame:
    """(book, locale, kind, path, readable, name, category, icon, description, pages, ref): what entries and categories hold, pages as a variant.

    files: as book_files gives; those that are parsed already stay as they are. Texts are parsed once and staged, as a tree reads them for
    names, icons, pages and categories. ref is the locale by which the book is read.
    """
    if "ref" in files.columns:
        return files
    at = ["book", "locale", "kind", "path"]
    fields = [_string(n).alias(n) for n in ("name", "category", "icon", "description")]
    v = files.select(*at, parsed_json(F.col("text")).alias("v"))
    parsed = stage(v.select(*at, F.col("v").isNotNull().alias("readable"), *fields, F.expr("try_variant_get(v, '$.pages', 'variant')").alias("pages")), "books")
    return parsed.join(listed(stage(references(parsed), "references")), "book")


def _pages(parsed: DataFrame) -> DataFrame:
    """(book, path, locale, ref, page, v) of the pages of entries."""
    return parsed.filter("kind = 'entries'").select("book", "path", "locale", "ref", F.posexplode(F.expr("try_variant_get(pages, '$', 'array<variant>')")).alias("page", "v"))


def page_values(files: DataFrame) -> DataFrame:
    """(book, path, page, locale, type, field, place, value): every translatable field of every page, as its locale's file has it.

    type is the page's in that file; place is the field's in the page's type. A page that is null has no fields.
    """
    rows = _pages(parsed_books(files)).select("book", "path", "locale", "page", "v")
    names = sorted({f for fs in FIELDS.values() for f in fs})
    read = lambda f: F.expr(f"""try_variant_get(v, '$["{f}"]', 'string')""")
    found = [F.struct(F.lit(f).alias("field"), (F.coalesce(read(f), read(f.strip())) if f != f.strip() else read(f)).alias("value")) for f in names]
    rows = rows.select("book", "path", "page", "locale", F.coalesce(_string("type"), F.lit("?")).alias("type"), F.explode(F.array(*found)).alias("x"))
    return rows.select("book", "path", "page", "locale", "type", "x.field", "x.value").filter("value is not null")


def book_pages(files: DataFrame) -> DataFrame:
    """(book, path, page, type, translatable, pointer, fields, summary): the pages of every entry of the book's reference locale.

    fields: those that the page's type has and its own file holds, in the order of the type, each with its pointer and its values by
    locale. pointer is that of the first. summary stands in for pages without any: entity, item, name, or the names of their fields.
    """
    files = parsed_books(files)
    pages = _pages(files.filter("locale = ref"))
    keys = F.array_join(F.map_keys(F.expr("try_variant_get(v, '$', 'map<string,variant>')")), ", ")
    summary = F.coalesce(_string("entity"), _string("item"), _string("name"), keys)
    pages = pages.select("book", "path", "ref", "page", F.coalesce(_string("type"), F.lit("?")).alias("type"), summary.alias("summary"))
    order = files.sparkSession.createDataFrame([(t, f, i) for t, fs in FIELDS.items() for i, f in enumerate(fs)], "type string, field string, place int")
    values = page_values(files)
    own = pages.join(F.broadcast(order), "type").join(values.select("book", "path", "page", F.col("locale").alias("ref"), "field"), ["book", "path", "page", "ref", "field"], "left_semi")
    each = own.join(values.drop("type"), ["book", "path", "page", "field"]).groupBy("book", "path", "page", "field", "place").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("locale", "value")))).alias("values")
    )
    pointer = F.concat(F.lit("pages/"), F.col("page").cast("string"), F.lit("/"), F.col("field"))
    fields = each.groupBy("book", "path", "page").agg(F.array_sort(F.collect_list(F.struct("place", F.trim("field").alias("name"), pointer.alias("pointer")))).alias("order"), F.map_from_entries(F.collect_list(F.struct("place", "values"))).alias("by"))
    fields = fields.select("book", "path", "page", F.transform("order", lambda x: F.struct(x["name"].alias("name"), x["pointer"].alias("pointer"), F.element_at("by", x["place"]).alias("values"))).alias("fields"))
    out = pages.join(fields, ["book", "path", "page"], "left")
    return out.select("book", "path", "page", "type", F.col("fields").isNotNull().alias("translatable"), F.col("fields")[0]["pointer"].alias("pointer"), "fields", F.when(F.col("fields").isNull(), F.col("summary")).alias("summary"))


def book_entries(files: DataFrame) -> DataFrame:
    """(book, category, path, names map locale -> name, icon): the entries of the reference locale, each under its category's id."""
    entries = parsed_books(files).filter("kind = 'entries'")
    names = entries.filter("name is not null").groupBy("book", "path").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("locale", "name")))).alias("names"))
    rows = entries.filter("locale = ref and readable").select("book", "path", F.coalesce("category", F.lit("?")).alias("category"), "icon")
    return rows.join(names, ["book", "path"], "left").select("book", "category", "path", F.coalesce("names", F.create_map().cast("map<string,string>")).alias("names"), "icon")


def book_categories(files: DataFrame) -> DataFrame:
    """(book, category, name, names, descriptions): categories of the reference locale by the id that entries name, and those that only entries name."""
    files = parsed_books(files)
    both = files.filter("kind = 'categories'").select("book", "locale", "ref", F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.json$", "").alias("id"), "name", "description")
    told = lambda c: F.map_from_entries(F.array_compact(F.sort_array(F.collect_list(F.when(F.col(c).isNotNull(), F.struct("locale", c))))))
    known = both.groupBy("book", "id").agg(F.bool_or(F.col("locale") == F.col("ref")).alias("here"), F.max(F.when(F.col("locale") == F.col("ref"), F.col("name"))).alias("name"), told("name").alias("names"), told("description").alias("descriptions"))
    known = known.filter("here").select("book", F.concat(F.lit("patchouli:"), "id").alias("category"), F.coalesce("name", "id").alias("name"), "names", "descriptions")
    named = book_entries(files).select("book", "category").distinct().join(known.select("book", "category"), ["book", "category"], "left_anti")
    none = F.create_map().cast("map<string,string>")
    return known.unionByName(named.select("book", "category", F.when(F.col("category") == "?", "without category").otherwise(F.col("category")).alias("name"), none.alias("names"), none.alias("descriptions")))


def book_tree(files: DataFrame) -> DataFrame:
    """(book, category, name, place, path, title, pages): entries in the order of their titles within a category, with their number of pages.

    Titles are ordered as French readers expect: by their letters without marks and case, then as they are written.
    """
    from ..functions.text import fold

    files = parsed_books(files)
    pages = book_pages(files).groupBy("book", "path").agg(F.count(F.lit(1)).alias("pages"))
    title = F.coalesce(F.col("names")["fr_fr"], F.col("names")["en_us"], F.col("path"))
    rows = book_entries(files).withColumn("title", title).join(pages, ["book", "path"], "left").join(book_categories(files).select("book", "category", "name"), ["book", "category"])
    by = Window.partitionBy("book", "category").orderBy(fold(F.col("title")), "title", "path")
    return rows.select("book", "category", "name", F.row_number().over(by).alias("place"), "path", "title", F.coalesce("pages", F.lit(0)).cast("bigint").alias("pages"))
