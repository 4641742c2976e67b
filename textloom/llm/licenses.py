"""Licence scan by a positional index of rare words, in DataFrame functions only.

A template is a licence's wording with a mandatory key phrase. Over all documents the scan counts in how many each key-phrase word
stands; a template is then indexed under its key phrase's two words of highest IDF. A document's indexed words are looked up, a
posting's place gives where the key phrase would have to start, the second word has to stand at its own place from there, and then
the whole key phrase is compared. Neither the choice of words nor the corpus can change what is found, only how often it is compared.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """label, wording, key phrase (a part of the wording, at word `lead`), and whether it is one of the contract's base phrases."""

    label: str
    wording: str
    key: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.wording.split()

    @property
    def phrase(self) -> list[str]:
        return self.key.split()

    @property
    def lead(self) -> int:
        w, k = self.words, self.phrase
        return next(i for i in range(len(w)) if w[i : i + len(k)] == k)


# The grants and notices of public licences, in words, and the labels to report.
TEMPLATES = [
    Template("mit", "under the mit license", "under the mit license", True),
    Template("apache-2", "apache license version 2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", "cc by nc", True),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software "
        "without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions",
        "hereby granted free of charge to any person",
    ),
    Template(
        "apache-2",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by "
        "applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
        "you may not use this file except in compliance with the license",
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
        "redistribution and use in source and binary forms",
    ),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
        "gnu general public license",
    ),
    Template(
        "lgpl",
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
        "gnu lesser general public license",
    ),
    Template(
        "agpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation",
        "gnu affero general public license",
    ),
    Template(
        "mpl",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at",
        "mozilla public license",
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this "
        "permission notice appear in all copies",
        "permission to use copy modify and or distribute this software",
    ),
    Template(
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software "
        "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely",
        "in no event will the authors be held liable for any damages",
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source "
        "code form or as a compiled binary for any purpose commercial or non commercial and by any means",
        "free and unencumbered software",
    ),
    Template("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license", "eclipse public license"),
    Template("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "waived all copyright and related or neighboring rights"),
    Template("cc-by-sa", "this work is licensed under a cc by sa 4 0 license", "cc by sa"),
]


def words(text: Column) -> Column:
    """Words of the text, with A-Z lower-cased. The two characters beyond ASCII whose lower case is an ASCII letter are kept from it."""
    kept = F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("é")), F.lit("İ"), F.lit("é"))
    return F.array_remove(F.split(F.lower(kept), BREAKS), "")


def document_counts(docs: DataFrame, templates: list[Template] = TEMPLATES) -> dict[str, int]:
    """In how many documents each key-phrase word stands; words that stand in none are absent. Bounded by the templates' words."""
    vocabulary = F.array(*(F.lit(w) for w in sorted({w for t in templates for w in t.phrase})))
    found = docs.select(F.explode(F.array_intersect(words(F.col("text")), vocabulary)).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return {r.word: r.n for r in found.collect()}


def postings(df: dict[str, int], templates: list[Template] = TEMPLATES) -> dict[str, list[tuple[Template, int, str, int]]]:
    """word -> (template, the word's place in the key phrase, second word, its place); rarest first, ties by word."""
    index: dict[str, list] = {}
    for t in templates:
        ranked = sorted(set(t.phrase), key=lambda w: (df.get(w, 0), w))
        first, second = ranked[0], ranked[min(1, len(ranked) - 1)]
        index.setdefault(first, []).append((t, t.phrase.index(first), second, t.phrase.index(second)))
        # A rarest word that the key phrase repeats is enough at its first place: the phrase is compared whole from there.
    return index


def _quoted(text: str) -> str:
    """A string literal of Spark's SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _array(items: list[str]) -> str:
    return "array(" + ", ".join(map(_quoted, items)) + ")"


def _struct(t: Template, at: int, second: str, at2: int) -> str:
    return (
        f"named_struct('label', {_quoted(t.label)}, 'base', {str(t.base).lower()}, 'at', {at}, 'second', {_quoted(second)}, 'at2', {at2}, "
        f"'phrase', {_array(t.phrase)}, 'lead', {t.lead}, 'wording', {_array(t.words)})"
    )


def scan(docs: DataFrame, templates: list[Template] = TEMPLATES) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Null and empty texts have no words, no labels and score 0. A base phrase scores 1; any other licence scores the share of its
    wording's words that stand at their places around the key phrase, and a document scores its best. Repeated rows are scanned
    alike, and other columns aren't read.
    """
    index = postings(document_counts(docs, templates), templates)
    lists = ", ".join(f"{_quoted(w)}, array({', '.join(_struct(*p) for p in ps)})" for w, ps in sorted(index.items()))
    anchors = _array(sorted(index))
    in_place = (
        "size(filter(transform(p.wording, (x, k) -> h.i - p.at - p.lead + k >= 0 and "
        "coalesce(try_element_at(words, greatest(h.i - p.at - p.lead + k, 0) + 1) = x, false)), b -> b))"
    )
    hits = f"if(arrays_overlap(words, {anchors}), filter(transform(words, (w, i) -> named_struct('w', w, 'i', i)), x -> array_contains({anchors}, x.w)), array())"
    places = f"""flatten(transform(hits, h -> transform(
        filter(map({lists})[h.w], p -> h.i >= p.at
            and coalesce(try_element_at(words, h.i - p.at + p.at2 + 1) = p.second, false)
            and slice(words, h.i - p.at + 1, size(p.phrase)) = p.phrase),
        p -> named_struct('label', p.label, 'base', p.base, 'start', h.i - p.at, 'score', {in_place} / cast(size(p.wording) as double)))))"""
    found = (
        docs.select("doc_id", words(F.col("text")).alias("words"))
        .select("doc_id", F.size("words").cast("bigint").alias("n_words"), "words", F.expr(hits).alias("hits"))
        .select("doc_id", "n_words", F.expr(places).alias("places"))
        .select("doc_id", "n_words", "places", F.expr("filter(places, p -> p.base)").alias("base"))
    )
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("bigint").alias("n_base"),
        F.array_min("base.start").cast("bigint").alias("first_word"),
        F.array_max("base.start").cast("bigint").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base.label")), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct("places.label")), ",").alias("labels"),
        F.coalesce(F.array_max("places.score"), F.lit(0.0)).alias("score"),
    )


def oracle(templates: list[Template] = TEMPLATES) -> str:
    """The same result in DuckDB SQL, from the templates alone."""
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    array = lambda xs: "[" + ", ".join(map(quoted, xs)) + "]"
    listed = ",\n    ".join(f"({quoted(t.label)}, {str(t.base).lower()}, {array(t.phrase)}, {t.lead}, {array(t.words)})" for t in templates)
    return rf"""
with templates(label, base, phrase, lead, wording) as (values
    {listed}
), d as (
  select row_number() over () as r, doc_id,
    list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w
  from documents
), places as (
  select r, i - 1 as start, label, base,
    len(list_filter(range(0, len(wording)), lambda k: i - lead + k >= 1 and w[i - lead + k] = wording[k + 1])) / len(wording)::double as score
  from (select r, w, unnest(range(1, len(w) + 1)) as i from d where len(w) > 0) as e, templates
  where w[i] = phrase[1] and w[i:i + len(phrase) - 1] = phrase
), g as (
  select r, count(*) filter (base) as n_base, min(start) filter (base) as first_word, max(start) filter (base) as last_word,
    string_agg(distinct label, ',' order by label) filter (base) as base_labels, string_agg(distinct label, ',' order by label) as labels, max(score) as score
  from places group by r
)
select doc_id, len(w)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word, last_word::bigint as last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0.0)::double as score
from d left join g using (r)
"""
