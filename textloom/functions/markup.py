"""Formatting codes rendered as HTML: a fold over a text's codes and literals, in the JVM.

Two dialects that don't mix: "quest" (&x, §x, \\& for a plain ampersand) and "book" ($(...), §x, :coin:). A colour ends all that is
open, styles add up, what is still open at the end is closed in reverse order, and literals are escaped once, before any tag exists.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The sixteen colours by code.
COLOURS = dict(zip("0123456789abcdef", "000000 0000AA 00AA00 00AAAA AA0000 AA00AA FFAA00 AAAAAA 555555 5555FF 55FF55 55FFFF FF5555 FF55FF FFFF55 FFFFFF".split()))
STYLES = {"l": "b", "o": "i", "n": "u", "m": "s"}
DIALECTS = {"quest": r"\\&|&[0-9a-fk-or]|§[0-9a-fk-or]", "book": r"\$\([^)]*\)|§[0-9a-fk-or]|:coin:"}


def escaped(c: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(plain), F.lit(entity))
    return c


def _action(code: Column) -> Column:
    """What a code does: ends all, ends the last, opens (html and its end), or shows html."""

    def act(every=False, last=False, html=None, end=None):
        text = lambda x: F.lit(x) if x is None or isinstance(x, str) else x
        return F.struct(F.lit(every).alias("every"), F.lit(last).alias("last"), F.coalesce(text(html), F.lit("")).alias("html"), text(end).cast("string").alias("end"))

    letter = F.substring(code, 2, 1)
    short = code.rlike("^[&§].$")
    colours = F.create_map(*(F.lit(x) for c, h in COLOURS.items() for x in (c, f'<span style="color:#{h}">')))
    tags = F.create_map(*(F.lit(x) for s, t in STYLES.items() for x in (s, f"<{t}>")))
    ends = F.create_map(*(F.lit(x) for s, t in STYLES.items() for x in (s, f"</{t}>")))
    inner = F.regexp_extract(code, r"^\$\((.*)\)$", 1)
    return (
        F.when(code == "\\&", act(html="&amp;"))
        .when(code == ":coin:", act(html='<span class="coin"></span>'))
        .when(short & (letter == "r"), act(every=True))
        .when(short & letter.rlike("[0-9a-f]"), act(every=True, html=F.element_at(colours, letter), end="</span>"))
        .when(short & (letter == "k"), act(html='<span class="scrambled">', end="</span>"))
        .when(short, act(html=F.element_at(tags, letter), end=F.element_at(ends, letter)))
        .when(inner == "", act(every=True))
        .when(inner == "l", act(html="<b>", end="</b>"))
        .when(inner == "li", act(html='<span class="bullet"></span>'))
        .when(inner == "br", act(html="<br>"))
        .when(inner == "br2", act(html="<br><br>"))
        .when(inner == "/l", act(last=True))
        .when(inner.startswith("l:"), act(html='<span class="link">', end="</span>"))
        .when(inner.rlike("^#[0-9a-fA-F]{6}$"), act(html=F.concat(F.lit('<span style="color:'), inner, F.lit('">')), end="</span>"))
        .otherwise(act())
    )


def render(c: Column, dialect: str = "quest") -> Column:
    """HTML of a text; null is empty. The marks U+0001 and U+0002 are dropped from the text first."""
    text = F.translate(F.coalesce(c, F.lit("")), "\u0001\u0002", "")
    cells = F.split(F.regexp_replace(text, f"({DIALECTS[dialect]})", "\u0001$1\u0002"), "\u0001")
    steps = F.transform(
        cells,
        lambda x, i: F.struct(
            F.when(i == 0, _action(F.lit("$(none)"))).otherwise(_action(F.split(x, "\u0002")[0])).alias("act"),
            escaped(F.element_at(F.split(x, "\u0002"), -1)).alias("literal"),
        ),
    )
    closing = lambda ends: F.array_join(F.reverse(ends), "")

    def step(a: Column, s: Column) -> Column:
        act = s["act"]
        kept = F.when(act["every"], F.slice(a["open"], 1, 0)).when(act["last"] & (F.size(a["open"]) > 0), F.slice(a["open"], 1, F.greatest(F.size(a["open"]) - 1, F.lit(0)))).otherwise(a["open"])
        ended = F.when(act["every"], closing(a["open"])).when(act["last"], F.coalesce(F.try_element_at(a["open"], F.lit(-1)), F.lit(""))).otherwise("")
        opened = F.when(act["end"].isNotNull(), F.concat(kept, F.array(act["end"]))).otherwise(kept)
        return F.struct(opened.alias("open"), F.concat(a["out"], ended, act["html"], s["literal"]).alias("out"))

    start = F.struct(F.array().cast("array<string>").alias("open"), F.lit("").alias("out"))
    return F.aggregate(steps, start, step, lambda a: F.concat(a["out"], closing(a["open"])))
