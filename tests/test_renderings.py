"""Renderings are looked for of all English n-grams, against plain Python over the same texts."""

import re
import unicodedata
from collections import Counter

import pyarrow as pa
import pytest
from textloom.operators import inventory as I
from textloom.plans.registry import QUERIES

from .oracle import SF, connect


def folded(s):
    return "".join(c for c in unicodedata.normalize("NFD", s.lower()) if unicodedata.category(c) != "Mn")


def stem_en(w):
    if len(w) > 4 and w.endswith("ies"):
        return w[:-3] + "y"
    return w[:-1] if len(w) > 3 and w[-1] == "s" and w[-2] not in "siu" else w


def stem_fr(w):
    w = folded(w)
    return w[:-1] if len(w) > 3 and w[-1] in "sx" and w[-2] != "s" else w


def grams(text, stem, stop):
    words = [w.lower() for w in re.findall(I.RENDERING_WORD, re.sub(I.RENDERING_CODES, " ", text or ""))]
    words = [w if w in stop or folded(w) in stop else stem(w) for w in words]
    runs = (words[i : i + n] for n in (1, 2, 3) for i in range(len(words) - n + 1))
    return {" ".join(r) for r in runs if r[0] not in stop and r[-1] not in stop}


def associated(pairs, least=4, strength=0.5):
    texts = [(grams(e, stem_en, set(I.STOP_EN)), grams(f, stem_fr, set(I.STOP_FR))) for e, f in pairs]
    terms, found, both = Counter(), Counter(), Counter()
    for e, f in texts:
        terms.update(e)
        found.update(f)
        both.update((x, y) for y in f for x in e)
    return {(x, y, n, terms[x], found[y]) for (x, y), n in both.items() if n >= least and n >= strength * found[y]}


def test_query_looks_for_all_terms(spark):
    rows = connect().execute("select a.text, b.text from conversations a join conversations b on a.conv_id = b.conv_id and b.turn = a.turn + 1").fetchall()
    got = [tuple(r) for r in QUERIES["rendering_associations"](spark, SF).select("term", "rendering", "both", "n_term", "n_rendering").collect()]
    want = associated(rows)
    assert len(got) == len(set(got)) and set(got) == want
    assert len({x for x, *_ in want}) > 5


@pytest.mark.parametrize("at_once", [1, 7, 10_000])
def test_associations_of_all_terms(spark, at_once):
    """However few texts come at once, and whether or not a rendering's texts come together."""
    words = "stone walls the iron door's doors boxes of ladies §amine {x} ore's bus glass pies".split()
    mots = "pierre le murs mûr porte d'or œufs de très {x} bijoux dés l'eau verre".split()
    pairs = [(" ".join(words[(i * k) % (3 + i % 12)] for k in range(i % 9)), " ".join(mots[(i * k) % (2 + i % 12)] for k in range(i % 7))) for i in range(80)] + [(None, "murs"), ("doors", None)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", at_once)
    try:
        out = I.associations(spark.createDataFrame([(f"k{i}", e, f) for i, (e, f) in enumerate(pairs)], "key string, en string, fr string")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(out) == len(set(out)) and {tuple(r) for r in out} == associated(pairs)


def test_pairs_of_one_text_are_cut(monkeypatch):
    """A text's pairs are sent in parts."""
    monkeypatch.setattr(I, "PAIRS_AT_ONCE", 3)
    terms = pa.array([[], [{"id": 1, "n": 4}, {"id": 2, "n": 9}, {"id": 3, "n": 6}]], pa.list_(pa.struct({"id": pa.int32(), "n": pa.int64()})))
    found = pa.array([[{"id": 5, "n": 4}], [{"id": 5, "n": 4}, {"id": 6, "n": 5}, {"id": 7, "n": 10}]], pa.list_(pa.struct({"id": pa.int32(), "n": pa.int64()})))
    out = list(I._sent([pa.RecordBatch.from_arrays([found, terms], ["renderings", "terms"])]))
    assert len(out) > 1
    got = [(r["rendering_id"], r["share"], sorted(r["terms"])) for b in out for r in b.to_pylist()]
    assert got == [(5, 4, [1, 2, 3]), (6, 5, [2, 3])]
