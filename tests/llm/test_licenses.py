import re

from textloom.llm import licenses

from .helpers import ODD, docs

BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", low) if w]


CASES = [
    (20, "Released under the MIT License. And under THE mit, license!"),
    (21, "Apache License, Version 2.0; apache license version 2"),
    (22, "CC BY-NC 4.0 cc-by-ncx cc by nc by nc"),
    (23, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    (24, "hereby granted free of charge to any person"),
    (25, "unſer the mit License; under the Kny mit license; under the mİt license"),
    (26, "the mit mit license under the mit license " * 500),
    (27, "Redistribution and use in source and binary forms, GNU General Public License"),
]


def test_against_brute_force(spark):
    rows = ODD + CASES
    got = licenses.scan(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    text = dict(rows)
    for r in got:
        w = words(text[r.doc_id])
        base = [(i, label) for phrase, label in BASE.items() for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
        labels, best = {x for _, x in base}, 0.0
        for t in licenses.TEMPLATES:
            n = len(t.phrase)
            for i in range(len(w)):
                if w[i : i + n] == t.phrase:
                    labels.add(t.label)
                    s = i - t.lead
                    best = max(best, sum(0 <= s + k < len(w) and w[s + k] == x for k, x in enumerate(t.words)) / len(t.words))
        starts = [i for i, _ in base]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(base), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in base})) and r.labels == ",".join(sorted(labels))
        assert abs(r.score - best) < 1e-12


def test_rare_words_are_the_index():
    index = licenses.postings({"mit": 900, "license": 40, "under": 50, "the": 10_000}, licenses.TEMPLATES[:1])
    ((t, at, second, at2),) = index["license"]
    assert (at, second, at2) == (3, "under", 0)


def test_empty(spark):
    assert licenses.scan(docs(spark, [])).count() == 0


def test_labels_and_words_with_quotes(spark):
    """Texts of a template never become SQL."""
    odd = [licenses.Template("it's \\ mine", "say é' now please", "é' now")]
    df = spark.createDataFrame([(1, "say x é' now"), (2, "nothing")], "doc_id bigint, text string")
    # The apostrophe is no part of a word, so that this template is never met; it doesn't break the query either.
    assert [r.labels for r in licenses.scan(df, odd).orderBy("doc_id").collect()] == ["", ""]
    plain = [licenses.Template("it's \\ mine", "say é now please", "é now")]
    got = licenses.scan(df, plain).orderBy("doc_id").collect()
    assert [r.labels for r in got] == ["it's \\ mine", ""] and got[0].score == 0.5


def test_whole_grants_score_in_full(spark):
    """Every template's own wording, punctuated and in capitals, gets its label and the full score."""
    rows = [(k, "Intro. " + ", ".join(w.upper() for w in t.words) + "; end") for k, t in enumerate(licenses.TEMPLATES)]
    got = licenses.scan(docs(spark, rows)).collect()
    assert all(licenses.TEMPLATES[r.doc_id].label in r.labels.split(",") and r.score == 1 for r in got)
