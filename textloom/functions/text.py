"""Text primitives as Column expressions: everything stays in the JVM."""

from __future__ import annotations

import sys
import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ligatures that decomposition leaves alone.
LIGATURES = [
    ("œ", "oe"), ("Œ", "OE"), ("æ", "ae"), ("Æ", "AE"), ("ø", "o"), ("Ø", "O"), ("ß", "ss"), ("ẞ", "ss"),
    ("đ", "d"), ("Đ", "D"), ("ð", "d"), ("Ð", "D"), ("ł", "l"), ("Ł", "L"),
]

# The three placeholder grammars, and what counts as markup in running text.
CODES_FULL = (
    r"%(?:\d+\$)?(?:\.\d+)?[sdfeu]|%%|§.|&[0-9a-fk-or]|\$\([^)]*\)|</?lt\w+[^>]*>|@i\b"
    r"|\$\{[^}]*\}|\\n|\n|\{\d+\}|\{@\w+\}|\{image:[^}]*\}"
)
#: What codes and other markup begin with, in a class of characters.
CODES_BEGIN = r"%§&$<@\\\n{"
CODES_WRITE = r"%(?:\d+\$)?[sdf]|%%|§.|&[0-9a-fk-or]|\$\([^)]*\)|\{\d+\}"
CODES_RENDER = r"§[0-9a-fk-orA-FK-OR]|\$\([^)]*\)|%(?:\d+\$)?[sdf]"
MARKUP = (
    r"§[0-9a-fk-orA-FK-OR]|&[0-9a-fk-or]|\$\([^)]*\)|</?lt\w+[^>]*>|%(?:\d+\$)?(?:\.\d+)?[sdf]|%%|\$\{[^}]*\}|:[a-z_]+:"
)
BREAKS = r"\$\((?:br2?|li|p)\)"
RESOURCE_ID = r"(?<![\w#])[a-z0-9_.-]++:[a-z0-9_/.-]+"
WORD = r"[\p{L}\p{N}]+"
NO_WORD = r"[^\p{L}\p{N}]+"

# Glyph widths in pixels that differ from 6.
GLYPHS = {" ": 4, "f": 5, "i": 2, "k": 5, "l": 3, "t": 4, "I": 4, "'": 3, ".": 2, ",": 2, ":": 2, "!": 2, ";": 2, "|": 2}

# Words with an aspirated h, before which French doesn't elide.
ASPIRATED = "hache haddock hamster hanneton hareng haricot herisson hetre hibou homard houblon".split()

# Number words of French and the digits they stand for.
NUMBER_WORDS = {
    "zéro": "0", "un": "1", "une": "1", "seul": "1", "seule": "1", "premier": "1", "première": "1", "deux": "2", "second": "2",
    "seconde": "2", "deuxième": "2", "trois": "3", "troisième": "3", "quatre": "4", "quatrième": "4", "cinq": "5", "cinquième": "5",
    "six": "6", "sixième": "6", "sept": "7", "septième": "7", "huit": "8", "huitième": "8", "neuf": "9", "neuvième": "9", "dix": "10",
    "dixième": "10", "onze": "11", "douze": "12", "quinze": "15", "vingt": "20", "trente": "30", "cent": "100", "mille": "1000",
}


def _fold_tables(drop: set[str]) -> tuple[str, str]:
    """For translate(): characters that lose marks of the given categories, and what each becomes; those that vanish come last."""
    turned, gone = [], []
    for cp in range(0x80, sys.maxunicode + 1):
        c = chr(cp)
        if unicodedata.category(c) in drop:
            gone.append(c)
        elif unicodedata.decomposition(c):
            kept = unicodedata.normalize("NFC", "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) not in drop))
            if len(kept) == 1 and kept != c:
                turned.append((c, kept))
    return "".join(c for c, _ in turned) + "".join(gone), "".join(k for _, k in turned)


_FOLD = _fold_tables({"Mn", "Mc", "Me"})
_FOLD_MN = _fold_tables({"Mn"})


def _with_letters(table: tuple[str, str]) -> tuple[str, str]:
    """The table, with the ligatures that become one letter."""
    single = {a: b for a, b in LIGATURES if len(b) == 1}
    return "".join(single) + table[0], "".join(single.values()) + "".join(single.get(x, x) for x in table[1])


_FOLD_LETTERS = _with_letters(_FOLD)


#: Length for slices to the end: slice() takes no more than what start + length can hold.
REST = 1_000_000_000


def let(value: Column, f) -> Column:
    """f(value), with value evaluated once however often f uses it, inside lambdas too."""
    return F.transform(F.array(value), f)[0]


def fold(c: Column) -> Column:
    """Lower case without marks or ligatures: marks are dropped, then ligatures replaced, then case lowered."""
    c = F.translate(c, *_FOLD_LETTERS)
    return F.lower(reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), [p for p in LIGATURES if len(p[1]) > 1], c))


def fold_mn(c: Column) -> Column:
    """The looser fold of reconciliation and term audits: non-spacing marks and the oe ligature only."""
    return F.replace(F.lower(F.translate(c, *_FOLD_MN)), F.lit("œ"), F.lit("oe"))


def strip(c: Column) -> Column:
    """Without white space of any script at either end."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def blank(c: Column) -> Column:
    """Whether nothing but white space of any script is there."""
    return ~F.coalesce(c.rlike(r"(?U)\S"), F.lit(False))


def strip_codes(c: Column) -> Column:
    """Text without codes and resource ids; written and coded line breaks become line breaks."""
    c = F.regexp_replace(F.replace(F.coalesce(c, F.lit("")), F.lit("\\n"), F.lit("\n")), BREAKS, "\n")
    # No markup begins otherwise; this is looked at before the kinds are tried.
    return F.regexp_replace(F.regexp_replace(c, f"(?U)(?=[§&$<%:])(?:{MARKUP})", " "), f"(?U){RESOURCE_ID}", " ")


def stem(w: Column) -> Column:
    """A folded French word without its regular plural; -al, -au, -ail and -aux meet in one stem."""
    singular = F.when((F.length(w) > 3) & w.rlike("[sx]$"), F.left(w, F.length(w) - 1)).otherwise(w)
    return (
        F.when((F.length(w) > 4) & w.endswith("eaux"), F.left(w, F.length(w) - 1))
        .when((F.length(w) > 4) & w.endswith("aux"), F.concat(F.left(w, F.length(w) - 3), F.lit("al")))
        .when((F.length(singular) > 3) & singular.endswith("au") & ~singular.endswith("eau"), F.concat(F.left(singular, F.length(singular) - 2), F.lit("al")))
        .when((F.length(singular) > 4) & singular.endswith("ail"), F.concat(F.left(singular, F.length(singular) - 3), F.lit("al")))
        .otherwise(singular)
    )


# Endings of folded words that make the stem -al, and plurals. What stands before them is looked at last, as it costs most.
TO_AL = r"a(?:u(?<!eau)|il)[sx]?(?![0-9a-z])(?<=[0-9a-z]{2}a(?:u|il)[sx]?)"
PLURAL = r"[sx](?![0-9a-z])(?<=[0-9a-z]{4})"


def stemmed(line: Column) -> Column:
    """A folded line with each of its words by its stem, as stem() has it."""
    return F.regexp_replace(F.regexp_replace(line, TO_AL, "al"), PLURAL, "")


def stems_of(line: Column) -> Column:
    return F.regexp_extract_all(line, F.lit("([0-9a-z]+)"), 1)


def pieces(written: Column) -> Column:
    """The stems of a written word: folding may split it."""
    return F.transform(stems_of(fold(written)), stem)


def written_words(c: Column) -> Column:
    return F.regexp_extract_all(strip_codes(c), F.lit(f"({WORD})"), 1)


def words(c: Column) -> Column:
    """Stems of a text, in order: the pieces of its written words, worked out over the whole line at once and not word by word."""
    return stems_of(stemmed(fold(F.regexp_replace(strip_codes(c), NO_WORD, " "))))


def tokens(c: Column) -> Column:
    """array<struct<stem, written, start>>: start tells whether a word begins a sentence (text start, or . ! ? or a break before it)."""
    parts = F.split(F.regexp_replace(strip_codes(c), f"({WORD})", "\u0001$1\u0002"), "\u0001")

    # Each part is "word \u0002 gap"; the part before the first word has no mark. The stems of all words come from one line, cut at its marks.
    def spread(cells: Column, lines: Column) -> Column:
        return F.transform(
            cells,
            lambda x, i: F.transform(
                stems_of(F.get(lines, i)),
                lambda s, k: F.struct(
                    s.alias("stem"),
                    x[0].alias("written"),
                    ((k == 0) & ((i == 0) | F.coalesce(F.get(F.get(cells, i - 1), F.lit(1)).rlike("[.!?\n]"), F.lit(False)))).alias("start"),
                ),
            ),
        )

    stems = lambda cells: F.split(stemmed(fold(F.array_join(F.transform(cells, lambda x: x[0]), "\u0001"))), "\u0001")
    cells = F.transform(F.slice(parts, 2, REST), lambda p: F.split(p, "\u0002"))
    return F.flatten(let(cells, lambda cells: let(stems(cells), lambda lines: spread(cells, lines))))


def contains_words(text_words: Column, name_words: Column) -> Column:
    """Whether the name's stems stand consecutively; an empty name is everywhere."""
    line = lambda x: F.concat(F.lit(" "), F.array_join(x, " "), F.lit(" "))
    return (F.size(name_words) == 0) | F.contains(line(text_words), line(name_words))


def same_case(model: Column, word: Column) -> Column:
    """word in the case of model: all capitals, initial capital, or as it is."""
    capital = F.concat(F.upper(F.left(word, F.lit(1))), F.substring(word, 2, 2**31 - 1))
    upper = (F.length(model) > 1) & (model == F.upper(model)) & (model != F.lower(model))
    first = F.left(model, F.lit(1))
    return F.when(upper, F.upper(word)).when((first == F.upper(first)) & (first != F.lower(first)), capital).otherwise(word)


# --- codes ---------------------------------------------------------------------------------------------------------------


def codes(c: Column, grammar: str = CODES_FULL) -> Column:
    """The codes of a text as a sorted multiset."""
    return F.array_sort(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(f"({grammar})"), 1))


def multiset_minus(a: Column, b: Column) -> Column:
    """The sorted elements of a beyond those of b, repeats counted."""
    count = lambda xs, x: F.size(F.filter(xs, lambda y: y == x))
    return let(
        a,
        lambda xs: let(
            b, lambda ys: F.flatten(F.transform(F.array_sort(F.array_distinct(xs)), lambda x: F.array_repeat(x, F.greatest(F.lit(0), count(xs, x) - count(ys, x)))))
        ),
    )


def structure(c: Column) -> Column:
    """Headings, rules and bullets of a text, line by line."""
    found = F.transform(F.split(F.coalesce(c, F.lit("")), "\r\n|\n|\r"), lambda x: F.regexp_extract(x, r"^(#+|\^\^\^|---|- )", 1))
    return F.filter(found, lambda x: x != "")


def first_difference(a: Column, b: Column) -> Column:
    """Rank, from 1, of the first element in which two arrays differ; null if they are equal."""
    apart = F.array_position(F.zip_with(a, b, lambda x, y: ~x.eqNullSafe(y)), F.lit(True))
    return F.when(apart > 0, apart.cast("int"))


# --- measures --------------------------------------------------------------------------------------------------------------


def bare(c: Column) -> Column:
    """Without formatting marks, accents bare."""
    return F.translate(F.regexp_replace(F.coalesce(c, F.lit("")), "§.", ""), *_FOLD)


def pixels(c: Column) -> Column:
    """Width of a text in pixels: accented letters are as wide as bare ones, formatting marks have no width."""
    narrow: dict[int, str] = {}
    for glyph, width in GLYPHS.items():
        narrow[width] = narrow.get(width, "") + glyph
    text = bare(c)
    total = F.length(text) * 6
    for width, glyphs in narrow.items():
        total = total - (F.length(text) - F.length(F.translate(text, glyphs, ""))) * (6 - width)
    return total


def drawn(c: Column) -> Column:
    """A bare text with each character but blanks as many times x as it has pixels, so that the length of a word is its width."""
    narrow: dict[int, str] = {}
    for glyph, width in GLYPHS.items():
        if glyph != " ":
            narrow[width] = narrow.get(width, "") + glyph
    marks = {width: chr(i) for i, width in enumerate(narrow, 1)}
    used = "".join(marks.values())
    glyphs = "".join(narrow.values()) + used
    line = F.translate(bare(c), glyphs, "".join(marks[w] * len(x) for w, x in narrow.items()) + "x" * len(used))
    line = F.regexp_replace(line, f"[^ {used}]", "x" * 6)
    return reduce(lambda x, w: F.replace(x, F.lit(marks[w]), F.lit("x" * w)), marks, line)


def wrapped_lines(c: Column, box: int | Column = 102) -> Column:
    """Lines of a text wrapped by words in a box of that many pixels."""
    box = F.lit(box) if isinstance(box, int) else box
    widths = F.transform(F.split(drawn(c), " "), F.length)
    return F.aggregate(
        widths,
        F.struct(F.lit(1).alias("n"), F.lit(0).alias("used")),
        lambda a, w: F.when(a["used"] == 0, F.struct(a["n"].alias("n"), w.alias("used")))
        .when(a["used"] + 4 + w <= box, F.struct(a["n"].alias("n"), (a["used"] + 4 + w).alias("used")))
        .otherwise(F.struct((a["n"] + 1).alias("n"), w.alias("used"))),
        lambda a: a["n"],
    )


def utf16_length(c: Column) -> Column:
    return (F.octet_length(F.encode(c, "UTF-16LE")) / 2).cast("int")


# --- numbers ---------------------------------------------------------------------------------------------------------------

NUMBER = r"([0-9]+(?:[.,][0-9]+)*)"


def shown(c: Column) -> Column:
    """What a reader sees of a text when it comes to numbers: no codes, no braces, tooltips unwrapped, undisplayed spans dropped."""
    c = F.coalesce(c, F.lit(""))
    read = F.regexp_replace(F.regexp_replace(c, r"(?s)<remove_size>.*?</remove_size>", " "), r"\$\(t:([^)]*)\)", " $1 ")
    read = F.when(c.contains("<remove_size>") | c.contains("$(t:"), read).otherwise(c)
    read = F.regexp_replace(F.regexp_replace(read, f"(?U)(?=[{CODES_BEGIN}])(?:{CODES_FULL})", " "), r"\{[^{}]*\}", " ")
    # A text without a character that any of these begin with, or that stands in a resource id, is shown as it is; so is what is left of one.
    left = let(read, lambda x: F.when(x.rlike(f"[{CODES_BEGIN}:]"), strip_codes(x)).otherwise(x))
    return F.when(c.rlike(f"[{CODES_BEGIN}:]"), left).otherwise(c)


def trimmed_decimals(n: Column) -> Column:
    """1.50 -> 1.5 and 2.0 -> 2; versions such as 1.20.1 stay."""
    return F.when(n.rlike(r"^[0-9]+\.[0-9]+$"), F.regexp_replace(F.regexp_replace(n, r"0+$", ""), r"\.$", "")).otherwise(n)


def numbers_en(c: Column) -> Column:
    """Numbers of an English text, in order: commas separate thousands."""
    found = F.regexp_extract_all(shown(c), F.lit(NUMBER), 1)
    return F.transform(found, lambda n: F.when(n.rlike(r"^[0-9]{1,3}(?:,[0-9]{3})+$"), F.replace(n, F.lit(","), F.lit(""))).otherwise(trimmed_decimals(n)))


def numbers_fr(c: Column) -> Column:
    """Numbers of a French text, in order: blanks and dots separate thousands, commas decimals, and number words count."""
    return numbers_shown_fr(shown(c))


def numbers_shown_fr(c: Column) -> Column:
    """numbers_fr() of what a reader sees."""
    text = F.regexp_replace(c, r"[   ](?<=[0-9].)(?=[0-9]{3}(?![0-9]))", "")
    spelled = "|".join(sorted(NUMBER_WORDS, key=len, reverse=True))
    # Words are tried where one of their first letters stands, and only then it is looked at whether a word begins there.
    first = "".join(sorted({w[0] for w in (*NUMBER_WORDS, "doubl", "tripl")}))
    found = F.regexp_extract_all(text, F.lit(rf"(?iU)({NUMBER[1:-1]}|(?=[{first}])\b(?:{spelled}|doubl\w*|tripl\w*)\b)"), 1)
    table = F.create_map(*(F.lit(x) for p in NUMBER_WORDS.items() for x in p))

    def value(n: Column) -> Column:
        low = F.lower(n)
        return (
            F.when(n.rlike(r"^[0-9](?:[0-9]*$|.*,.*,)"), n)  # digits alone, and a list of numbers, stay as they are written
            .when(n.rlike(r"^[0-9]{1,3}(?:\.[0-9]{3})+$"), F.replace(n, F.lit("."), F.lit("")))
            .when(n.rlike("^[0-9]"), trimmed_decimals(F.replace(n, F.lit(","), F.lit("."))))
            .when(low.startswith("doubl"), F.lit("2"))
            .when(low.startswith("tripl"), F.lit("3"))
            .otherwise(F.element_at(table, low))
        )

    return F.transform(found, value)


def is_subsequence(short: Column, long: Column) -> Column:
    """Whether short's elements stand in long in their order, gaps allowed."""
    left = F.aggregate(long, short, lambda rest, x: F.when((F.size(rest) > 0) & (F.get(rest, F.lit(0)) == x), F.slice(rest, 2, REST)).otherwise(rest))
    return F.size(left) == 0


def number_gap(en: Column, fr: Column) -> Column:
    """Empty if the French text keeps the English numbers in order; else what is wrong."""
    return let(shown(fr), lambda text: let(F.filter(numbers_en(en), lambda n: ~n.contains(",") | ~F.contains(text, n)), lambda a: let(numbers_shown_fr(text), lambda b: _gap(a, b, text))))


def _gap(a: Column, b: Column, text: Column) -> Column:
    return F.when(a == b, "").otherwise(let(multiset_minus(a, b), lambda lost: _unlike(a, b, lost, text)))


def _unlike(a: Column, b: Column, lost: Column, text: Column) -> Column:
    english = F.regexp_extract_all(text, F.lit(r"(?<![0-9,])([0-9]{1,3}(?:,[0-9]{3})+)(?![0-9,])"), 1)
    english = F.filter(english, lambda n: F.array_contains(lost, F.replace(n, F.lit(","), F.lit(""))))
    return (
        F.when((F.size(lost) > 0) & (F.size(english) > 0), F.concat(F.lit("english separator: "), F.array_join(english, " ")))
        .when(F.size(lost) > 0, F.concat(F.lit("lost: "), F.array_join(lost, " ")))
        .when(~is_subsequence(a, b), F.concat(F.lit("order: "), F.array_join(a, " "), F.lit(" / "), F.array_join(b, " ")))
        .otherwise("")
    )


# --- French morphology ---------------------------------------------------------------------------------------------------


def elides(word: Column) -> Column:
    """Whether "de" elides before the word: before a vowel or a mute h."""
    w = fold(word)
    aspirated = reduce(lambda a, h: a | w.startswith(h), ASPIRATED, F.lit(False))
    return w.rlike("^[aeiou]") | (w.startswith("h") & ~aspirated)


def render_template(template: Column, source: Column, gender=None, number=None, proper=None, plural=None) -> Column:
    """A family's template filled with the source's name: {source} {Source} {sources} {e} {s}, then elision and a capital."""
    gender, number, plural = (F.lit("") if x is None else F.coalesce(x, F.lit("")) for x in (gender, number, plural))
    proper = F.lit(False) if proper is None else F.coalesce(proper, F.lit(False))
    lowered = lambda x: F.when(proper, x).otherwise(F.concat(F.lower(F.left(x, F.lit(1))), F.substring(x, 2, 2**31 - 1)))
    raised = lambda x: F.concat(F.upper(F.left(x, F.lit(1))), F.substring(x, 2, 2**31 - 1))
    text = template
    for mark, value in (
        ("{sources}", lowered(plural)),
        ("{source}", lowered(source)),
        ("{Source}", raised(source)),
        ("{e}", F.when(gender == "f", "e").otherwise("")),
        ("{s}", F.when(number == "p", "s").otherwise("")),
    ):
        text = F.replace(text, F.lit(mark), value)
    # Elision is decided word by word: each "de" looks at the word after it.
    parts = F.split(text, " ")
    joined = F.transform(
        parts,
        lambda p, i: F.when(
            p.rlike(r"(?U)(?:^|\W)[Dd]e$") & (i + 1 < F.size(parts)) & elides(F.coalesce(F.get(parts, i + 1), F.lit(""))),
            F.concat(F.left(p, F.length(p) - 1), F.lit("'")),
        )
        .when(i + 1 < F.size(parts), F.concat(p, F.lit(" ")))
        .otherwise(p),
    )
    return raised(F.array_join(joined, ""))


def masculine(w: Column) -> Column:
    """A stem without its feminine mark."""
    short = F.left(w, F.length(w) - 1)
    return (
        F.when((F.length(w) > 5) & w.endswith("trice"), F.concat(F.left(w, F.length(w) - 5), F.lit("teur")))
        .when((F.length(w) > 3) & w.endswith("e"), F.when((F.length(short) > 2) & short.rlike(r"(ll|nn|tt)$"), F.left(short, F.length(short) - 1)).otherwise(short))
        .otherwise(w)
    )


def uninflected(w: Column) -> Column:
    """An English stem without possessive s, and y for ie."""
    return F.regexp_replace(F.regexp_replace(w, "s$", ""), "ie$", "y")


def stem_en(w: Column) -> Column:
    """Light English stem: -ies to -y, then -s unless -ss, -us or -is."""
    return F.when((F.length(w) > 4) & w.endswith("ies"), F.concat(F.left(w, F.length(w) - 3), F.lit("y"))).when(
        (F.length(w) > 3) & w.endswith("s") & ~w.rlike("(ss|us|is)$"), F.left(w, F.length(w) - 1)
    ).otherwise(w)


def stem_fr(w: Column) -> Column:
    """Light French stem: marks folded, without final s or x unless an s stands before it."""
    return stem_folded_fr(F.lower(F.translate(w, *_FOLD_MN)))


def stem_folded_fr(f: Column) -> Column:
    """stem_fr() of a word that is folded already."""
    return F.when((F.length(f) > 3) & f.rlike("[^s][sx]$"), F.left(f, F.length(f) - 1)).otherwise(f)


def glossary_form(c: Column) -> Column:
    """What is compared of a glossary's French: no case, no final punctuation, each word without final s or x."""
    low = F.regexp_replace(F.lower(strip(c)), r"(?U)[\s.!:]+$", "")
    return F.regexp_replace(low, r"(?U)(\w{3,}?)[sx]\b", "$1")


def accent_fault(word: Column, right: Column) -> Column:
    """Whether word, of the same fold as right, misses or mistakes an accent; an accent where right has none makes it another word."""
    w, r = F.split(F.lower(word), ""), F.split(F.lower(right), "")
    other = F.exists(F.zip_with(w, r, lambda a, b: (a != fold(a)) & (b == fold(b))), lambda x: F.coalesce(x, F.lit(False)))
    return (F.lower(word) != F.lower(right)) & ~other


def spread_match(text_words: Column, name_words: Column) -> Column:
    """Whether the name's stems stand in order within its length and three more; contiguous names match anyway."""
    return let(text_words, lambda t: let(name_words, lambda n: _spread(t, n)))


def _spread(text_words: Column, name_words: Column) -> Column:
    found = F.aggregate(
        name_words,
        F.struct(F.lit(0).alias("at"), F.lit(0).alias("first"), F.lit(True).alias("ok")),
        lambda a, x: F.struct(
            (a["at"] + F.array_position(F.slice(text_words, a["at"] + 1, REST), x)).cast("int").alias("at"),
            F.when(a["first"] == 0, (a["at"] + F.array_position(F.slice(text_words, a["at"] + 1, REST), x)).cast("int")).otherwise(a["first"]).alias("first"),
            (a["ok"] & (F.array_position(F.slice(text_words, a["at"] + 1, REST), x) > 0)).alias("ok"),
        ),
    )
    return contains_words(text_words, name_words) | (
        (F.size(name_words) > 0) & found["ok"] & (found["at"] - found["first"] < F.size(name_words) + 3)
    )


def accent_drift(text: Column, name: Column) -> Column:
    """struct<said, right>: the first word in which a text writes a name otherwise than the name does, accents alone apart.

    Null if the name's stems stand nowhere in one piece, or if one of its places is written as the name is. Case, ligatures and regular
    plurals don't count.
    """
    plain = lambda w: let(reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), LIGATURES, F.lower(w)), stem)

    def compare(said: Column, right: Column) -> Column:
        n = F.size(right)
        places = F.when((n > 0) & (F.size(said) >= n), F.sequence(F.lit(1), F.size(said) - n + 1)).otherwise(F.array().cast("array<int>"))
        stems = lambda ts: F.transform(ts, lambda t: t["stem"])
        there = F.filter(places, lambda i: stems(F.slice(said, i, n)) == stems(right))
        pairs = lambda i: F.zip_with(F.slice(said, i, n), right, lambda a, b: F.struct(a["written"].alias("said"), b["written"].alias("right")))
        first = F.transform(there, lambda i: F.get(F.filter(pairs(i), lambda p: plain(p["said"]) != plain(p["right"])), F.lit(0)))
        return F.when(~F.exists(first, lambda x: x.isNull()), F.get(first, F.lit(0)))

    return let(tokens(text), lambda said: let(tokens(name), lambda right: compare(said, right)))


# --- n-grams, prints -----------------------------------------------------------------------------------------------------


def ngrams(ws: Column, most: int = 3, stop: list[str] | None = None) -> Column:
    """Space-joined runs of 1 to `most` words that neither start nor end with a stop word."""
    stops = stop or [""]

    def runs(w: Column, ends: Column, n: int) -> Column:
        starts = F.when(F.size(w) >= n, F.sequence(F.lit(1), F.size(w) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(F.filter(starts, lambda i: ends[i - 1] & ends[i + (n - 2)]), lambda i: F.array_join(F.slice(w, i, n), " "))

    # Whether a run may begin or end with a word is looked up once for each word.
    return let(ws, lambda w: let(F.transform(w, lambda x: ~x.isin(stops)), lambda ends: F.flatten(F.array(*(runs(w, ends, n) for n in range(1, most + 1))))))


def survives(term: Column, ws: Column) -> Column:
    """Whether a word of the text shares a stem of four letters or more with the term, one being the other's beginning."""
    return F.exists(ws, lambda w: (F.length(term) >= 4) & (F.length(w) >= 4) & (w.startswith(term) | term.startswith(w)))


def fingerprint(c: Column) -> Column:
    """First 12 hex digits of the SHA-1; null counts as empty."""
    return F.left(F.sha1(F.coalesce(c, F.lit("")).cast("binary")), F.lit(12))


def percent(c: Column) -> Column:
    """A share as a percentage with three decimals and a comma."""
    return F.concat(F.replace(F.format_string("%.3f", c * 100), F.lit("."), F.lit(",")), F.lit(" %"))


# Bookkeeping remarks that a reader of the glossary doesn't need, removed in this order.
REMARKS = [
    r"^fiche du sous-projet \d+ ?: ?[\w-]+(?:, garder)?(?: \(option [^)]*\))?(?: ?[;,:] ?|$)",
    r"^fiche du \d\d/\d\d(?:, question [\w-]+)? ?: ?(?:[\w-]+$)?",
    r"^réponse (?:de l'utilisateur )?du \d\d/\d\d(?: à la question [\w-]+)?(?: ?\([\w-]+\))? ?:? ?(?:[\w-]+-[\w-]+, )?",
    r"(?i)^lot [\w-]+(?:, verdict [^:]*)? ?: ?",
    r" ?;? ?lot [\w-]+$",
    r" ?;? ?(?:par la )?fiche du sous-projet \d+ ?: ?[\w-]+",
    r" ?\((?:fiche|réponse|lot) [^)]*\)",
]


def readable_reason(c: Column) -> Column:
    """A reason without its bookkeeping remarks, beginning with a capital; empty if it was nothing else."""
    text = F.coalesce(c, F.lit(""))
    for pattern in REMARKS:
        text = F.regexp_replace(text, f"(?U){pattern}", "")
    text = F.regexp_replace(text, "^[ ;,:]+|[ ;,:]+$", "")
    return F.concat(F.upper(F.left(text, F.lit(1))), F.substring(text, 2, 2**31 - 1))


def replaced_words(text: Column, word: Column, put: Column) -> Column:
    """text with put in the place of every whole word (or words) equal to `word`."""
    return F.regexp_replace(text, F.concat(F.lit(r"(?U)(?<!\w)\Q"), word, F.lit(r"\E(?!\w)")), F.regexp_replace(put, r"([\\$])", r"\\$1"))


def placeholder_verdicts(en: Column, fr: Column) -> Column:
    """Codes of what is wrong with a pair; en or fr null means the key is missing on that side."""
    word = r"[A-Za-z]{4,}"
    kept = ~blank(en) & ~blank(fr)
    cases = [
        F.when(en.isNotNull() & fr.isNull(), "missing"),
        F.when(en.isNull() & fr.isNotNull(), "extra"),
        F.when(en.isNotNull() & fr.isNotNull() & blank(en) & ~blank(fr), "should_be_empty"),
        F.when(fr.isNotNull() & ~blank(en) & blank(fr), "empty"),
        F.when(kept & (codes(en) != codes(fr)), "tokens"),
        F.when(kept & (en == fr) & en.rlike(word) & (F.length(en) > 3), "untranslated"),
    ]
    return F.array_compact(F.array(*cases))


def write_verdict(en: Column, value: Column) -> Column:
    """Whether an edited value may be written: English null takes any text, blank English a blank one, else its codes; null if it may."""
    return (
        F.when(en.isNull(), F.when(blank(value), "empty"))
        .when(blank(en), F.when(~blank(value), "should_be_empty"))
        .when(blank(value), "empty")
        .when(codes(en, CODES_WRITE) != codes(value, CODES_WRITE), "codes")
    )
