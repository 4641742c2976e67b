"""Text primitives against plain Python."""

import math
import random
import re
import unicodedata
from collections import Counter

import pytest
from pyspark.sql import functions as F
from textloom.functions import text as T

SAMPLES = [
    "", "Hello world", "Les chevaux et les tuyaux, coraux; émaux!", "Œuf à l'ÆON ﬁn ß ẞ Đð Łł", "§aVert §lgras%s &6or &amp $(item)x$() ${v} {0} {@page} {image:a}",
    "a\\nb\nc $(br)d$(li)e", "base:stone and #tag:x :coin: http://x.y/z", "25 % de 1 000,5 pour 1.000 et 65.536 puis trois ou Quatrième, double", "ÀÉÎõü ǼǾ ｆｕｌｌ ²", "L'été: oui ? non",
    "Prix de la pousse : 12", "<ltred>x</ltred> %1$s %.2f %% @i", "日本語 кириллица", "aux eaux baux bail corail rail",
]


def values(spark, expr, rows=SAMPLES, schema="a string"):
    df = spark.createDataFrame([(i, r) if not isinstance(r, tuple) else (i, *r) for i, r in enumerate(rows)], f"i int, {schema}")
    return [r[0] for r in df.select("i", expr.alias("x")).orderBy("i").select("x").collect()]


def fold(text):
    bare = unicodedata.normalize("NFC", "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c)[0] != "M"))
    for a, b in T.LIGATURES:
        bare = bare.replace(a, b)
    return bare.lower()


def stem(w):
    n = len(w)
    if n > 4 and w.endswith("eaux"):
        return w[:-1]
    if n > 4 and w.endswith("aux"):
        return w[:-3] + "al"
    w = w[:-1] if n > 3 and w[-1] in "sx" else w
    if len(w) > 3 and w.endswith("au") and not w.endswith("eau"):
        return w[:-2] + "al"
    return w[:-3] + "al" if len(w) > 4 and w.endswith("ail") else w


def clean(text):
    text = re.sub(T.BREAKS, "\n", text.replace("\\n", "\n"))
    return re.sub(T.RESOURCE_ID, " ", re.sub(T.MARKUP, " ", text))


def tokens(text):
    out, end, text = [], 0, clean(text)
    for m in re.finditer(r"[^\W_]+", text):
        start = not out or bool(re.search(r"[.!?\n]", text[end : m.start()]))
        for piece in re.findall("[0-9a-z]+", fold(m[0])):
            out.append((stem(piece), m[0], start))
            start = False
        end = m.end()
    return out


def test_fold_and_words(spark):
    assert values(spark, T.fold(F.col("a"))) == [fold(s) for s in SAMPLES]
    assert values(spark, T.strip_codes(F.col("a"))) == [clean(s) for s in SAMPLES]
    assert [[tuple(t) for t in x] for x in values(spark, T.tokens(F.col("a")))] == [tokens(s) for s in SAMPLES]
    assert values(spark, T.words(F.col("a"))) == [[t[0] for t in tokens(s)] for s in SAMPLES]


def test_fold_on_all_letters(spark):
    letters = "".join(chr(c) for c in range(0x21, 0x2000) if unicodedata.category(chr(c))[0] == "L" and unicodedata.normalize("NFD", chr(c)) == chr(c) or 0xC0 <= c < 0x250)
    rows = [letters[i : i + 50] for i in range(0, len(letters), 50)]
    assert values(spark, T.fold(F.col("a")), rows) == [fold(r) for r in rows]


def test_codes(spark):
    code = re.compile(T.CODES_FULL)
    assert values(spark, T.codes(F.col("a"))) == [sorted(code.findall(s)) for s in SAMPLES]
    rng = random.Random(1)
    pairs = [(" ".join(rng.choices("%s %d §a &6 word".split(), k=6)), " ".join(rng.choices("%s %d §a &6 word".split(), k=6))) for _ in range(40)]
    got = values(spark, T.multiset_minus(T.codes(F.col("a")), T.codes(F.col("b"))), pairs, "a string, b string")
    assert got == [sorted((Counter(code.findall(a)) - Counter(code.findall(b))).elements()) for a, b in pairs]


def px(text):
    return sum(T.GLYPHS.get(unicodedata.normalize("NFD", c)[0], 6) for c in re.sub("§.", "", text))


def lines(text, box):
    n, used = 1, 0
    for w in re.sub("§.", "", text).split(" "):
        size = px(w)
        if not used:
            used = size
        elif used + 4 + size <= box:
            used += 4 + size
        else:
            n, used = n + 1, size
    return n


def test_measures(spark):
    rng = random.Random(2)
    rows = ["".join(rng.choice("fiklt I'.,:!;| abcdéÉ§") for _ in range(rng.randint(0, 60))) for _ in range(100)]
    assert values(spark, T.pixels(F.col("a")), rows) == [px(r) for r in rows]
    assert values(spark, T.wrapped_lines(F.col("a"), 60), rows) == [lines(r, 60) for r in rows]
    assert values(spark, T.utf16_length(F.col("a")), ["é", "🌼x", ""]) == [1, 3, 0]


def test_numbers(spark):
    cases = [
        ("deal 1,000 in 2.50 s", "inflige 1 000 en 2,5 s", ""),
        ("1,000", "1.000", ""),
        ("three and 3", "trois", ""),
        ("5 then 6", "6 puis 5", "order: 5 6 / 6 5"),
        ("1,500", "1,500 points", "english separator: 1,500"),
        ("7 and 7", "7", "lost: 7"),
        ("%1$s 4 §6 {0}", "Quatre", ""),
        ("1.20.1", "1.20.1", ""),
        ("levels 1,3", "niveaux 1,3", ""),
        ("2 times", "le double", ""),
        ("none", "rien", ""),
    ]
    got = values(spark, T.number_gap(F.col("a"), F.col("b")), [c[:2] for c in cases], "a string, b string")
    assert got == [c[2] for c in cases]


def test_shown_without_shortcuts(spark):
    """Texts that are passed over for having no mark read as if each step had been taken; so does what is blank."""
    draw = random.Random(11)
    bits = ["1,000", "1\u202f000", "2.50", "{0}", "{", "§6", "%1$s", "%", "&a", "$(t:a 5)", "$(br)", "${x}", "<ltx 5>", "<remove_size>9</remove_size>", "@i", "\\n", "\n", "mod:item_3", ":smile:", "ſix", "l'un", "DOUBLÉ", " ", "\u3000"]
    rows = ["".join(draw.choice(bits) + draw.choice(["", " "]) for _ in range(draw.randint(0, 5))) for _ in range(400)]
    c = F.regexp_replace(F.regexp_replace("a", r"(?s)<remove_size>.*?</remove_size>", " "), r"\$\(t:([^)]*)\)", " $1 ")
    c = T.strip_codes(F.regexp_replace(F.regexp_replace(c, f"(?U){T.CODES_FULL}", " "), r"\{[^{}]*\}", " "))
    assert values(spark, T.shown(F.col("a")), rows) == values(spark, c, rows)
    assert values(spark, T.blank(F.col("a")), rows) == values(spark, T.strip(F.col("a")) == "", rows)
    assert values(spark, F.array_join(T.numbers_fr(F.col("a")), " "), ["ſix doublé, l'un 2un DEUX 1\u202f000"]) == ["2 1 2 2 1000"]


def test_morphology(spark):
    words = ["abeille", "herbe", "hibou", "hêtre", "yaourt", "Écrevisse", "pomme", ""]
    assert values(spark, T.elides(F.col("a")), words) == [True, True, False, False, False, True, False, False]
    rows = [("Conserve de {sources}", "Tomate", "f", "s", False, "Tomates"), ("{Source} fumé{e}{s}", "carangue", "f", "p", False, None), ("Oeufs de {source}", "Abeille", "", "s", False, None), ("Statue de {source}", "Anna", "", "s", True, None)]
    expr = T.render_template(F.col("t"), F.col("s"), F.col("g"), F.col("n"), F.col("p"), F.col("pl"))
    got = values(spark, expr, rows, "t string, s string, g string, n string, p boolean, pl string")
    assert got == ["Conserve de tomates", "Carangue fumées", "Oeufs d'abeille", "Statue d'Anna"]
    assert values(spark, T.masculine(F.col("a")), ["imitatrice", "alpine", "ancienne", "ne", "vert"]) == ["imitateur", "alpin", "ancien", "ne", "vert"]
    cases = [("ACIER", "bois"), ("Acier", "bois"), ("acier", "Bois"), ("X", "bois")]
    assert values(spark, T.same_case(F.col("a"), F.col("b")), cases, "a string, b string") == ["BOIS", "Bois", "Bois", "Bois"]
    cases = [("fenetre", "fenêtre"), ("Fenétre", "fenêtre"), ("acheté", "achète"), ("fenêtre", "fenêtre")]
    assert values(spark, T.accent_fault(F.col("a"), F.col("b")), cases, "a string, b string") == [True, True, False, False]


def test_matching(spark):
    cases = [("la petite porte en fer et en chêne", "porte en chêne"), ("porte en chêne", "porte en chêne"), ("chêne en porte", "porte en chêne"), ("porte a b c d e en chêne", "porte en chêne"), ("x", "")]
    got = values(spark, T.spread_match(T.words(F.col("a")), T.words(F.col("b"))), cases, "a string, b string")
    assert got == [True, True, False, False, True]
    assert values(spark, T.contains_words(T.words(F.col("a")), T.words(F.col("b"))), cases, "a string, b string") == [False, True, False, False, True]
    subs = [("a b", "x a y b"), ("b a", "a b"), ("", "a"), ("a a", "a")]
    expr = T.is_subsequence(F.filter(F.split("a", " "), lambda x: x != ""), F.split("b", " "))
    assert values(spark, expr, subs, "a string, b string") == [True, False, True, False]
    grams = values(spark, T.ngrams(F.split("a", " "), 3, ["the"]), ["the red fox", "one"])
    assert grams == [["red", "fox", "red fox"], ["one"]]


def test_validation(spark):
    cases = [("a %s", "b %s", []), ("a %s", "b", ["tokens"]), ("word", None, ["missing"]), (None, "x", ["extra"]), (" ", "x", ["should_be_empty"]), ("word", " ", ["empty"]), ("word", "word", ["untranslated"]), ("ab", "ab", []), (" ", "", [])]
    got = values(spark, T.placeholder_verdicts(F.col("a"), F.col("b")), [c[:2] for c in cases], "a string, b string")
    assert got == [c[2] for c in cases]
    cases = [(None, "x", None), (None, " ", "empty"), (" ", "x", "should_be_empty"), ("%s", "y", "codes"), ("%s", "y %s", None)]
    assert values(spark, T.write_verdict(F.col("a"), F.col("b")), [c[:2] for c in cases], "a string, b string") == [c[2] for c in cases]


def test_odds(spark):
    assert values(spark, T.percent(F.lit(0.0123456)), ["x"]) == ["1,235 %"]
    assert values(spark, T.glossary_form(F.col("a")), ["Pots :", "Les Bocaux.", "os"]) == ["pot", "les bocau", "os"]
    assert values(spark, T.fingerprint(F.col("a")), ["", "a"])[1] == "86f7e437faa5"
    assert values(spark, T.readable_reason(F.col("a")), ["kept (lot 3) as a name ; "]) == ["Kept as a name"]


def test_bounds(spark):
    from textloom.operators.sampling import bound_without_defects, upper_bound

    rows = [(0.0, 10.0), (3.0, 50.0), (5.0, 5.0), (0.0, 0.0), (20.0, 4000.0)]
    got = values(spark, upper_bound(F.col("k"), F.col("n")), rows, "k double, n double")
    assert got[0] == pytest.approx(1 - 0.05 ** (1 / 10), abs=1e-9) and got[2] == got[3] == 1.0
    for (k, n), p in zip(rows, got):
        if 0 < n > k:
            assert sum(math.comb(int(n), i) * p**i * (1 - p) ** (n - i) for i in range(int(k) + 1)) == pytest.approx(0.05, abs=1e-6)
    assert values(spark, bound_without_defects(F.lit(10)), ["x"])[0] == pytest.approx(got[0])


def test_bounds_of_many_texts(spark):
    """The binomial sum at the bound, by exact fractions, and the normal limit where there are millions; the work follows the root of n."""
    from fractions import Fraction

    from textloom.operators.sampling import upper_bound

    got = values(spark, upper_bound(F.col("k"), F.col("n")), [(600.0, 1200.0), (5000.0, 10000.0), (44e6, 9e7), (2.0, 9e7), (9e7, 9e7)], "k double, n double")
    p = Fraction(got[0])
    term = total = (1 - p) ** 1200
    for i in range(1, 601):
        term = term * (1200 - i + 1) / i * p / (1 - p)
        total += term
    assert float(total) == pytest.approx(0.05, rel=1e-11)
    assert got[1] == pytest.approx(0.5082734955962607, rel=1e-14)
    share = 44 / 90
    assert got[2] == pytest.approx(share + 1.6448536 * (share * (1 - share) / 9e7) ** 0.5, rel=1e-7)
    assert got[3] == pytest.approx(6.295794 / 9e7, rel=1e-6) and got[4] == 1.0


def test_words_of_a_line_at_once(spark):
    """words() and the stems of tokens() work on whole lines, with no step for each word, and give what word by word gives."""
    import random

    rnd = random.Random(3)
    ends = ["eaux", "aux", "au", "aus", "eau", "ail", "ails", "s", "x", "ss", "sx", "als", ".", "\n", "_", "'", "ª", "́", "Ⅳ", "ﬁs", "ŒAUX", "ßx", "§a", "Ǿs", "", ":x", "\u0001", "\u0002"]
    lines = ["".join(rnd.choice("abeiux ") * rnd.randrange(4) + rnd.choice(ends) for _ in range(30)) for _ in range(200)] + ["", None]
    one_by_one = F.flatten(F.transform(T.written_words(F.col("a")), T.pieces))
    rows = spark.createDataFrame([(x,) for x in lines], "a string").select(T.words(F.col("a")).alias("w"), one_by_one.alias("o"), F.transform(T.tokens(F.translate("a", "\u0001\u0002", "")), lambda t: t["stem"]).alias("t"), T.words(F.translate("a", "\u0001\u0002", "")).alias("p"))
    for r in rows.collect():
        assert r.w == r.o and r.t == r.p
    assert "lambda" not in spark.createDataFrame([("x",)], "a string").select(T.words(F.col("a")))._jdf.queryExecution().analyzed().toString()


def test_drawn_words_are_as_long_as_wide(spark):
    text = "fkilt I'm .,:!;| é§a W\u0001\u0003 ß\n𝄞x §§§"
    shown = F.split(T.drawn(F.col("a")), " ")
    (r,) = spark.createDataFrame([(text,)], "a string").select(F.transform(shown, F.length).alias("drawn"), F.transform(F.split(T.bare(F.col("a")), " "), T.pixels).alias("wide"), T.wrapped_lines(F.col("a"), 30).alias("n")).collect()
    assert r.drawn == r.wide
    n, used = 1, 0
    for w in r.wide:
        n, used = (n, w) if not used else (n, used + 4 + w) if used + 4 + w <= 30 else (n + 1, w)
    assert r.n == n
