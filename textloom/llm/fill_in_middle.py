"""Fill-in-the-middle: documents are cut into prefix, middle and suffix at random units and put together anew.

A unit is a run of the letters A-Z and a-z, or any other single code point. One Aho-Corasick automaton goes over a text once and reports
events: the characters at which letters begin or end, and the three sentinels. Between events nothing has to be looked at: a gap without
letters has as many units as code points, a run of letters has one. A unit's place in the text is found by a binary search over the runs.

The automaton reads an image of the text with one ASCII character for each code point: letters are one character and all others another,
but for those that the sentinels are made of. So a few pairs of characters are all of the patterns.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

# The sentinels.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred documents so many stay plain, and of a hundred others so many have the suffix first.
PLAIN, SUFFIX_FIRST = 10, 20
SEED = 1

LETTERS, OTHERS = "aPSM", " <>"
_LETTER = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
#: ASCII to the automaton's seven characters.
IMAGE = bytes(ord(chr(c) if chr(c) in LETTERS + OTHERS else "a" if chr(c) in _LETTER else " ") for c in range(256))
CHANGE, SENTINEL = 0, 1


@lru_cache(maxsize=1)
def automaton():
    """Patterns: each pair of a letter and another character, in both orders, and the sentinels. A match gives its last place and its kind."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for a, b in (*product(OTHERS, LETTERS), *product(LETTERS, OTHERS)):
        found.add_word(a + b, CHANGE)
    for s in (PREFIX, SUFFIX, MIDDLE):
        found.add_word(s, SENTINEL)
    found.make_automaton()
    return found


def events(text: str) -> tuple[np.ndarray, np.ndarray, bool]:
    """Starts and ends of the runs of letters in code points, and whether a sentinel stands in the text."""
    # A code point beyond ASCII becomes one question mark. The blanks at both ends let every run begin and end.
    image = b" %b " % text.encode("ascii", "replace").translate(IMAGE)
    seen = np.fromiter(automaton().iter(image.decode("ascii")), np.dtype((np.int64, 2)))
    places = seen[seen[:, 1] == CHANGE, 0] - 1
    return places[0::2], places[1::2], len(places) < len(seen)


class Units:
    """A text's number of units, and where they end."""

    def __init__(self, text: str):
        starts, ends, self.has_sentinel = events(text)
        self.saved = np.concatenate(([0], np.cumsum(ends - starts - 1)))  # code points beyond the first, over all runs so far
        self.rank = starts - self.saved[:-1]  # the unit that a run is
        self.n = len(text) - int(self.saved[-1])

    def end(self, units: int) -> int:
        """Code points of the first so many units."""
        return units + int(self.saved[np.searchsorted(self.rank, units)])


def _cut(text: str, h1: int, h2: int, h3: int, h4: int, plain: int, suffix_first: int) -> tuple[int, str, int | None, int | None]:
    units = Units(text)
    if not text or units.has_sentinel or h3 % 100 >= 100 - plain:
        return units.n, "plain", None, None
    first, last = sorted((h1 % (units.n + 1), h2 % (units.n + 1)))
    begin = units.end(first)
    return units.n, "spm" if h4 % 100 < suffix_first else "psm", begin, units.end(last) - begin


def draws(ident: Column, seed: int) -> list[Column]:
    """The first four groups of eight hex digits of SHA-256 of the seed, a colon and the id (null: nothing)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("bigint") for k in range(4)]


def fill_in_middle(docs: DataFrame, seed: int = SEED, plain: int = PLAIN, suffix_first: int = SUFFIX_FIRST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of docs: its id, n (units), form, prefix_chars, middle_chars and output.

    Forms: plain (the text as it is, the two counts null) for empty and null texts, texts with a sentinel, and `plain` of a hundred others;
    else spm for `suffix_first` of a hundred; else psm. Rows that share an id are cut by the same draws, each in its own text; rows without
    one by draws of their own. Texts are read whole, other columns aren't. An empty table gives an empty one.
    """

    @F.pandas_udf("n bigint, form string, prefix_chars bigint, middle_chars bigint")
    def cut(text: pd.Series, h1: pd.Series, h2: pd.Series, h3: pd.Series, h4: pd.Series) -> pd.DataFrame:
        rows = [_cut(*x, plain, suffix_first) for x in zip(text, h1, h2, h3, h4, strict=True)]
        n, form, prefix, middle = zip(*rows, strict=True) if rows else ((),) * 4
        return pd.DataFrame({"n": pd.Series(n, dtype="int64"), "form": pd.Series(form, dtype="object"), "prefix_chars": pd.Series(prefix, dtype="Int64"), "middle_chars": pd.Series(middle, dtype="Int64")})

    text = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = text.withColumn("cut", cut("text", *draws(F.col("id"), seed))).select("id", "text", "cut.*")
    begin, end = F.col("prefix_chars"), F.col("prefix_chars") + F.col("middle_chars")
    prefix, middle = F.substr("text", F.lit(1), begin), F.substr("text", begin + 1, F.col("middle_chars"))
    suffix = F.substr("text", end + 1)
    output = (
        F.when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .when(F.col("form") == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
        .otherwise(F.col("text"))
    )
    return rows.select(F.col("id").alias(id_col), "n", "form", "prefix_chars", "middle_chars", output.alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text that an output of that form was made of. Only texts without sentinels are cut, so an output's sentinels are its own."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    one, two, three = (F.get(part, F.lit(k)) for k in (1, 2, 3))
    return F.when(form == "psm", F.concat(one, three, two)).when(form == "spm", F.concat(two, three, one)).otherwise(output)


def digests(docs: DataFrame) -> DataFrame:
    """fill_in_middle() with SHA-256 of the output and of the text rebuilt from it in place of the output."""
    rows = fill_in_middle(docs)
    name = fresh("restored", rows)
    return rows.withColumn(name, restored(F.col("output"), F.col("form"))).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(name, 256).alias("restored_sha256")
    )


#: The same in DuckDB, unit by unit.
ORACLE = r"""
with d as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u, sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents
), k as (
  select *, len(u)::bigint as n, ('0x' || substr(h, 1, 8))::bigint % (len(u) + 1) as a, ('0x' || substr(h, 9, 8))::bigint % (len(u) + 1) as b,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or ('0x' || substr(h, 17, 8))::bigint % 100 >= 90 then 'plain'
      when ('0x' || substr(h, 25, 8))::bigint % 100 < 20 then 'spm' else 'psm' end as form
  from d
), c as (
  select *, array_to_string(u[1:least(a, b)], '') as p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') as m, array_to_string(u[greatest(a, b) + 1:], '') as s from k
)
select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars, case when form <> 'plain' then length(m) end as middle_chars,
  sha256(case form when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m when 'spm' then '<S>' || s || '<P>' || p || '<M>' || m else text end) as output_sha256,
  sha256(case form when 'plain' then text else p || m || s end) as restored_sha256
from c
"""
