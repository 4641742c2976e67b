"""The tree of books over odd files."""

import pytest
from pyspark.errors import PySparkException
from textloom.sources import books as B

FILES = [
    ("m/guide/fr_fr/entries/a.json", '{"name": "Été", "category": "p:one", "icon": "i:a", "pages": [{"type": "patchouli:text", "text": "un"}, null, {"item": "i:b"}]}'),
    ("m/guide/en_us/entries/a.json", '{"name": "Summer", "category": "p:other", "pages": [{"type": "patchouli:text", "text": "one"}]}'),
    ("m/guide/fr_fr/entries/deep/b.json", '{"category": "patchouli:two", "pages": {"text": "no list"}}'),
    ("m/guide/en_us/entries/deep/b.json", '{"name": "Bee", "pages": [{"text": "x"}]}'),
    ("m/guide/fr_fr/entries/c.json", '{"name": 7, "pages": []}'),
    ("m/guide/fr_fr/entries/d.json", '{"name": "broken"'),
    ("m/guide/fr_fr/entries/e.json", '{"name": "two"} {}'),
    ("m/guide/fr_fr/entries/f.json", None),
    ("m/guide/fr_fr/entries/g.json", "[1]"),
    ("m/guide/en_us/entries/h.json", '{"name": "not in French", "category": "patchouli:three"}'),
    ("m/guide/fr_fr/categories/two.json", '{"name": null, "description": "d"}'),
    ("m/guide/en_us/categories/two.json", '{"name": "Two", "description": 5}'),
    ("m/guide/en_us/categories/three.json", '{"name": "Three"}'),
    ("m/guide/fr_fr/categories/none.json", "{"),
    ("m/none/ru_ru/entries/a.json", '{"name": "A", "category": "patchouli:x"}'),
    ("m/none/zh_cn/entries/z.json", '{"name": "Z"}'),
    ("m/guide/fr_fr/entries/a.txt", "{}"), ("m/guide/french/entries/a.json", "{}"), ("entries/a.json", "{}"), (None, "{}"),
    # The same entry in two folders, without a name: both stand in the tree, each with the pages of both.
    ("x/twice/fr_fr/entries/a.json", '{"pages": [{}]}'), ("y/twice/fr_fr/entries/a.json", '{"pages": [{}, {}]}'),
]


def files(spark, rows=FILES):
    return B.book_files(spark.createDataFrame(rows, "file string, text string"))


def test_paths(spark):
    got = {r.file: (r.book, r.locale, r.kind, r.path) for r in files(spark).collect()}
    assert got["m/guide/fr_fr/entries/deep/b.json"] == ("guide", "fr_fr", "entries", "deep/b.json")
    assert got["m/guide/en_us/categories/two.json"] == ("guide", "en_us", "categories", "two.json")
    assert len(got) == 18
    odd = files(spark, [("a/fr_fr/entries/en_us/categories/x.json", ""), ("a/b/fr_fr/entries//.json", ""), ("a/fr_fr/entries/x\ny.json", ""), ("/fr_fr/entries/x.json", "")]).collect()
    assert [(r.book, r.locale, r.kind, r.path) for r in odd] == [("a", "fr_fr", "entries", "en_us/categories/x.json"), ("b", "fr_fr", "entries", "/.json")]


def test_references(spark):
    rows = [("b", "ko_kr"), ("b", "fr_fr"), ("b", "de_de"), ("c", "ko_kr"), ("c", "de_de"), ("c", "de_de"), ("c", None), ("d", None), (None, "fr_fr")]
    got = {r.book: r.ref for r in B.references(spark.createDataFrame(rows, "book string, locale string")).collect()}
    assert got == {"b": "fr_fr", "c": "de_de", "d": None, None: "fr_fr"}


def test_tree_of_odd_files(spark):
    got = sorted(tuple(r) for r in B.book_tree(files(spark)).collect())
    assert got == [
        ("guide", "?", "without category", 1, "c.json", "7", 0),
        ("guide", "?", "without category", 2, "g.json", "g.json", 0),
        ("guide", "p:one", "p:one", 1, "a.json", "Été", 3),
        ("guide", "patchouli:two", "two", 1, "deep/b.json", "Bee", 0),
        ("none", "patchouli:x", "patchouli:x", 1, "a.json", "a.json", 0),
        ("twice", "?", "without category", 1, "a.json", "a.json", 3),
        ("twice", "?", "without category", 2, "a.json", "a.json", 3),
    ]
    entries = {(r.book, r.path): (r.category, r.names, r.icon) for r in B.book_entries(files(spark)).collect()}
    assert entries[("guide", "a.json")] == ("p:one", {"en_us": "Summer", "fr_fr": "Été"}, "i:a")
    assert entries[("none", "a.json")] == ("patchouli:x", {"ru_ru": "A"}, None)
    kinds = {(r.book, r.category): (r.name, r.names, r.descriptions) for r in B.book_categories(files(spark)).collect()}
    assert kinds[("guide", "patchouli:two")] == ("two", {"en_us": "Two"}, {"en_us": "5", "fr_fr": "d"})
    assert kinds[("guide", "patchouli:none")] == ("none", {}, {}) and ("guide", "patchouli:three") not in kinds


def test_one_name_in_two_folders_is_an_error(spark):
    rows = [(f"{x}/b/fr_fr/entries/a.json", '{"name": "n"}') for x in "xy"]
    with pytest.raises(PySparkException, match="DUPLICATED_MAP_KEY"):
        B.book_tree(files(spark, rows)).collect()


def test_files_are_parsed_once(spark):
    """Titles, pages and categories come from the same staged files, and no text is sent to find the locale of its book."""
    plan = B.book_tree(files(spark))._jdf.queryExecution().executedPlan().toString()
    assert "parse_json" not in plan and "regexp_extract" not in plan
    assert B.parsed_books(B.parsed_books(files(spark))).columns == B.parsed_books(files(spark)).columns
