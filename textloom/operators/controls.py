"""The rule operators: each takes DataFrames and gives findings, to be united and reconciled with the ledgers.

A finding: control, key, status (blocking or flagged), actual, expected, detail, proof, object (array of strings).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.lineage import cut, listed, rules, spread, stage
from .anchors import literal, matched, templated
from .matching import citations_in_context
from .model import OBJECT_KEY, is_name, object_id, project_texts, visible

BLOCKING, FLAGGED = "blocking", "flagged"
COLUMNS = ["control", "key", "status", "actual", "expected", "detail", "proof", "object"]


def finding(rows: DataFrame, control: str, status=BLOCKING, **given) -> DataFrame:
    """Findings of a control from rows with a key; what isn't given is empty."""
    col = lambda x: x if isinstance(x, Column) else F.lit(x)
    empty = F.array().cast("array<string>")
    values = {"status": col(status), "actual": F.lit(""), "expected": F.lit(""), "detail": F.lit(""), "proof": F.lit(""), "object": empty} | {k: col(v) for k, v in given.items()}
    return rows.select(F.lit(control).alias("control"), "key", *(F.coalesce(values[c], empty if c == "object" else F.lit("")).alias(c) for c in COLUMNS[2:]))


def united(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def one(c) -> Column:
    return F.array(F.col(c) if isinstance(c, str) else c)


def shown_texts(texts: DataFrame, books: DataFrame | None = None, journal: DataFrame | None = None, project: bool = False) -> DataFrame:
    """(key, fr, en, space): effective French that isn't the base game's (or only the project's), book fields, change log."""
    kept = project_texts(texts) if project else texts.filter(visible(F.col("key")) & ~F.coalesce(F.col("origin_fr") == "vanilla", F.lit(False)))
    parts = [kept.filter("fr != ''").select("key", "fr", F.col("english").alias("en"), F.coalesce("ns_project", F.lit("")).alias("space"))]
    if books is not None:
        parts.append(books.filter("fr != ''").select("key", "fr", "en", F.lit("book").alias("space")))
    if journal is not None:
        parts.append(journal.filter("fr != ''").select("key", "fr", "en", F.lit("journal").alias("space")))
    return united(parts)


# 1
def coverage(texts: DataFrame, witnesses: DataFrame, duplicates: DataFrame, books: DataFrame, retired: list[str] | None = None) -> DataFrame:
    """English without French, keys only witnesses have, divergent duplicates, empty book fields, keys without any English."""
    retired = retired or []
    own = F.coalesce(F.col("origin_en") != "vanilla", F.lit(True)) | (F.col("origin_fr") == "project")
    lacking = texts.filter(~T.blank(F.col("english")) & visible(F.col("key")) & own & ~F.col("key").startswith("block_type.") & T.blank(F.col("fr")))
    wit = witnesses.filter(~F.col("ns").isin(*retired) & visible(F.col("key"))) if retired else witnesses.filter(visible(F.col("key")))
    bare = wit.join(texts.select("key", "fr", "english"), "key", "left").filter(F.col("fr").isNull())
    bare = bare.filter(~F.col("key").startswith("quests.") | ~T.blank(F.col("english")))
    by_key = witnesses.groupBy("key").agg(
        F.bool_and(F.col("ns").isin(*retired) if retired else F.lit(False)).alias("gone"), F.bool_or(F.exists(F.map_values("texts"), lambda x: ~T.blank(x))).alias("said")
    )
    silent = texts.filter((F.col("origin_en") == "project") & visible(F.col("key")) & ~F.col("key").startswith("quests.") & T.blank(F.col("english")) & T.blank(F.col("fr")))
    silent = silent.join(by_key, "key", "left").filter(~F.coalesce("gone", F.lit(False)))
    silent = silent.withColumn(
        "why",
        F.when(F.col("fr").isNull() & F.col("said").isNotNull(), F.lit(None))  # the witness rule reports it
        .when(F.col("fr").isNull(), "object without English")
        .when(F.col("said").isNull(), "blank without witness")
        .when(F.col("said"), "object without English"),
    ).filter("why is not null")
    return united(
        [
            finding(lacking, "coverage", expected=F.col("english"), detail=F.when(F.col("fr").isNull(), "English without French").otherwise("blank French")),
            finding(bare, "coverage", proof=F.col("ns"), detail=F.concat(F.lit("only in witnesses: "), F.array_join(F.array_sort(F.map_keys("texts")), ", "))),
            finding(
                duplicates,
                "coverage",
                FLAGGED,
                detail="defined in several files with different values",
                actual=F.array_join(F.transform(F.map_entries("definitions"), lambda e: F.concat(e["key"], F.lit(": "), e["value"])), " | "),
            ),
            finding(books.filter(~T.blank(F.col("en")) & T.blank(F.col("fr"))), "coverage", expected=F.col("en"), detail="book field without French"),
            finding(silent, "coverage", detail=F.col("why")),
        ]
    )


# 2
def code_gap(en: Column, fr: Column) -> Column:
    """Codes lost and added, as text; empty if both sides hold the same."""
    lost, more = T.multiset_minus(T.codes(en), T.codes(fr)), T.multiset_minus(T.codes(fr), T.codes(en))
    part = lambda name, xs: F.when(F.size(xs) > 0, F.concat(F.lit(f"{name}: "), F.array_join(xs, " ")))
    return F.replace(F.concat_ws(" ; ", part("lost", lost), part("added", more)), F.lit("\n"), F.lit("\\n"))


def code_control(texts: DataFrame, books: DataFrame, journal: DataFrame) -> DataFrame:
    pairs = united([project_texts(texts).select("key", "fr", F.col("english").alias("en")), books.filter("fr != ''").select("key", "fr", "en")])
    pairs = pairs.filter("en != ''").withColumn("gap", code_gap(F.col("en"), F.col("fr"))).filter("gap != ''")
    lines = journal.filter("en != '' and fr != ''").withColumn("rank", T.first_difference(T.structure(F.col("en")), T.structure(F.col("fr")))).filter("rank is not null")
    return united(
        [
            finding(pairs, "codes", actual=F.col("fr"), expected=F.col("en"), detail=F.col("gap")),
            finding(lines, "codes", detail=F.concat(F.lit("structure differs from line "), F.col("rank").cast("string"))),
        ]
    )


# 3
def essence_control(texts: DataFrame, essences: DataFrame) -> DataFrame:
    said = texts.filter("fr != ''").select("key")
    named = essences.select(F.col("essence").alias("key")).filter(F.col("key").rlike(r"^(wood_type|leaves_type)\."))
    blocks = texts.filter(F.col("key").startswith("block_type.") & (F.col("english") != ""))
    return united(
        [
            finding(named.join(said, "key", "left_anti"), "essences", detail="active essence without a French name"),
            finding(blocks.join(said, "key", "left_anti"), "essences", expected=F.col("english"), detail="template without French"),
        ]
    )


# 4
def glossary_control(texts: DataFrame, books: DataFrame, glossary: DataFrame) -> DataFrame:
    """glossary: en, fr, sense, ord. Ligatures, contradictions of one sense, and terms that no text of the same English attests."""
    terms = glossary.select(T.strip(F.col("en")).alias("en"), F.coalesce("fr", F.lit("")).alias("fr"), F.coalesce("sense", F.lit("")).alias("sense"), "ord").withColumn(
        "form", T.glossary_form(F.col("fr"))
    )
    key = F.concat(F.lit("glossary:"), F.col("en"))
    joined = terms.filter(F.col("fr").rlike("[œŒ]")).withColumn("key", key)
    against = terms.groupBy("en", "sense").agg(F.count_distinct("form").alias("n"), F.array_sort(F.collect_list(F.struct("ord", "fr"))).alias("all")).filter("n > 1").withColumn("key", key)
    pairs = united([project_texts(texts).select("key", "fr", F.col("english").alias("en")), books.select("key", "fr", "en")])
    pairs = pairs.filter((F.col("fr") != "") & ~T.blank(F.col("en"))).select(T.strip(F.col("en")).alias("en"), "key", F.col("fr").alias("said"), T.glossary_form(F.col("fr")).alias("form"))
    whole = terms.groupBy("en").agg(F.array_sort(F.collect_list(F.struct("ord", "fr"))).alias("all"))
    attested = pairs.join(terms.select("en", "form").distinct(), ["en", "form"], "left_semi").select("en").distinct()
    unsaid = pairs.join(whole, "en").join(attested, "en", "left_anti").groupBy("en").agg(F.min(F.struct("key", "said")).alias("x"), F.count(F.lit(1)).alias("n"), F.first("all").alias("all"))
    unsaid = unsaid.select("en", "x.key", "x.said", "n", "all")
    return united(
        [
            finding(joined, "glossary", actual=F.col("fr"), object=one("en"), expected=F.replace(F.replace(F.col("fr"), F.lit("œ"), F.lit("oe")), F.lit("Œ"), F.lit("Oe")), detail="ligature"),
            finding(against, "glossary", actual=F.array_join("all.fr", " / "), object=one("en"), detail="entries of one English and sense contradict each other"),
            finding(unsaid, "glossary", actual=F.col("said"), expected=F.array_join("all.fr", " / "), object=one("en"), detail=F.concat(F.lit("unattested in texts: "), F.col("n").cast("string"))),
        ]
    )


# 5
def number_control(texts: DataFrame, books: DataFrame) -> DataFrame:
    kept = texts.filter(visible(F.col("key")) & F.coalesce(F.col("origin_fr") != "vanilla", F.lit(True)))
    pairs = united([kept.select("key", "fr", F.col("english").alias("en")), books.select("key", "fr", "en")]).filter(~T.blank(F.col("fr")) & ~T.blank(F.col("en")))
    # Texts are dealt to all tasks, as they may lie in one file; and a gap is exploded, not filtered, so that it isn't worked out once more for the filter.
    gaps = F.filter(F.array(T.number_gap(F.col("en"), F.col("fr"))), lambda g: g != "")
    pairs = spread(pairs, "key", "fr").select("key", "fr", "en", F.explode(gaps).alias("gap"))
    return finding(pairs, "numbers", actual=F.col("fr"), expected=F.col("en"), detail=F.col("gap"))


# 6
def label_majority(labels: DataFrame) -> DataFrame:
    """Rows of labels (key, label, rendering) whose rendering isn't the label's most frequent one; ties are left alone."""
    counts = labels.groupBy("label", "rendering").agg(F.count(F.lit(1)).alias("n"))
    by = Window.partitionBy("label").orderBy(F.desc("n"), "rendering")
    top = counts.withColumn("rank", F.row_number().over(by)).withColumn("next", F.lead("n").over(by)).filter("rank = 1 and n > next")
    top = top.select("label", F.col("rendering").alias("right"), "n")
    return labels.join(top, "label").filter("rendering != right")


def homonym_control(groups: DataFrame, labels: DataFrame) -> DataFrame:
    heads = groups.withColumnRenamed("head", "key")
    return united(
        [
            finding(heads, "homonyms", actual=F.array_join("variants", " | "), object=F.col("keys"), detail="one English name, several French ones"),
            finding(label_majority(labels), "homonyms", actual=F.col("rendering"), expected=F.col("right"), object=one("label"), detail="label rendered otherwise elsewhere"),
        ]
    )


# 7
def term_control(texts: DataFrame, books: DataFrame, terms: DataFrame, forbidden: bool = True) -> DataFrame:
    """terms: english (regex), french array, scope (all, names, texts), keys (regex or null), banned array, reason.

    Terms of plain words are looked up by their rarest one; other patterns are tried on every text, and so are bounded. The words of a text are
    computed once, before that.
    """
    said = united(
        [
            shown_texts(texts).filter("en != ''").select("key", "fr", "en", is_name(F.col("key")).alias("name")),
            books.filter("fr != '' and en != ''").select("key", "fr", "en", F.lit(False).alias("name")),
        ]
    ).withColumn("ws", T.words(F.col("fr")))
    terms = terms.withColumn("forms", F.transform("french", T.words)).withColumn("bans", F.transform("banned", lambda b: F.struct(b.alias("said"), T.words(b).alias("ws"))))
    fits = (
        F.expr("en rlike concat('(?iU)\\\\b(?:', english, ')\\\\b')")
        & (F.col("keys").isNull() | F.expr("key rlike keys"))
        & ((F.col("scope") == "all") | ((F.col("scope") == "names") & F.col("name")) | ((F.col("scope") == "texts") & ~F.col("name")))
    )
    rows = matched(said, terms, "en", literal(F.col("english")), fits, "terms")
    starts = lambda ws, name: F.filter(F.sequence(F.lit(0), F.greatest(F.size(ws) - 1, F.lit(0))), lambda i: F.slice(ws, i + 1, F.size(name)) == name)
    # A banned rendering counts unless an imposed form that contains it covers the place.
    covers = lambda form, ban: F.transform(starts(F.col("ws"), form), lambda i: F.struct(i.alias("from"), (i + F.size(form)).alias("to")))
    spans = lambda ban: F.flatten(F.transform(F.filter("forms", lambda f: T.contains_words(f, ban)), lambda f: covers(f, ban)))
    uncovered = lambda ban: F.exists(
        starts(F.col("ws"), ban), lambda i: ~F.exists(spans(ban), lambda s: (s["from"] <= i) & (i + F.size(ban) <= s["to"]))
    )
    banned = rows.select("*", F.explode("bans").alias("ban")).filter(F.size("ban.ws") > 0).filter(uncovered(F.col("ban.ws")))
    absent = rows.filter(~F.exists("forms", lambda f: T.contains_words(F.col("ws"), f)))
    status = F.when(F.col("name"), BLOCKING).otherwise(FLAGGED)
    # A form with a capital keeps it: one of its places has to begin with one.
    present = rows.filter(F.exists("forms", lambda f: T.contains_words(F.col("ws"), f))).withColumn("toks", T.tokens(F.col("fr")))
    pairs = F.zip_with("french", "forms", lambda a, b: F.struct(a.alias("said"), b.alias("ws")))
    first = lambda x: F.left(x, F.lit(1))
    capital = lambda x: (first(x) == F.upper(first(x))) & (first(x) != F.lower(first(x)))
    lost = F.filter(
        pairs,
        lambda p: capital(p["said"])
        & (F.size(p["ws"]) > 0)
        & (F.size(starts(F.col("ws"), p["ws"])) > 0)
        & ~F.exists(starts(F.col("ws"), p["ws"]), lambda i: capital(F.get(F.col("toks"), i)["written"])),
    )
    small = present.withColumn("lost", lost).filter(F.size("lost") > 0).withColumn("form", F.col("lost")[0]["said"])
    parts = [
        finding(absent, "terms", status, actual=F.col("fr"), expected=F.col("french")[0], object=one("english"), proof=F.col("reason"), detail="imposed term absent"),
        finding(small, "terms", status, actual=F.col("fr"), expected=F.col("form"), object=one("english"), proof=F.col("reason"), detail="capital lost"),
    ]
    if forbidden:
        both = F.concat(F.col("english"), F.lit(" ≠ "), F.col("ban.said"))
        parts.append(finding(banned, "terms", actual=F.col("fr"), expected=F.col("french")[0], object=one(both), proof=F.col("reason"), detail="forbidden rendering"))
    return united(parts)


# 8
def most_severe(rows: DataFrame, order: str) -> DataFrame:
    """One finding per key: blocking before flagged, then the first by order."""
    by = Window.partitionBy("key").orderBy((F.col("status") != BLOCKING).cast("int"), order)
    return rows.withColumn("rank_in_key", F.row_number().over(by)).filter("rank_in_key = 1").drop("rank_in_key")


def width_control(texts: DataFrame, sold: DataFrame, limits: DataFrame, mods: bool = True) -> DataFrame:
    """sold: id. limits: key, keys array, pattern, limit, lines, behaviour, mod, proof, ord; manual limits have no behaviour.

    Shop names fit two lines of 102 pixels; a constraint blocks if English fits and French doesn't, and is flagged where English
    doesn't fit either but is shorter, or where the text scrolls.
    """
    said = texts.filter("fr != ''").select("key", "fr", "origin_fr", "english")
    ids = sold.select(F.explode(F.array(*(F.concat(F.lit(f"{k}."), F.replace(F.col("id"), F.lit(":"), F.lit("."))) for k in ("item", "block")))).alias("key"), "id")
    shop = ids.join(said, "key").withColumn("first", F.row_number().over(Window.partitionBy("id").orderBy(F.desc("key")))).filter("first = 1")
    shop = shop.withColumn("n", T.wrapped_lines(F.col("fr"))).filter("n > 2").withColumn("ord", F.lit(-1))
    manual = said.join(listed(limits.filter("behaviour is null").drop("keys", "pattern")), "key").withColumn("n", T.pixels(F.col("fr"))).filter("n > limit")
    rule = limits.filter("behaviour is not null").withColumnRenamed("key", "own")
    # A constraint names its keys, or has a pattern for them, or both: one that reaches a key in two ways counts once, as the most severe.
    named = F.array_distinct(F.array_compact(F.concat(F.array("own"), F.coalesce("keys", F.array().cast("array<string>")))))
    by_key = said.join(listed(rule.select("*", F.explode(named).alias("key"))), "key")
    by_pattern = said.join(rules(rule.filter("pattern is not null"), "limits"), F.expr("key rlike pattern"))
    rows = by_key.unionByName(by_pattern).filter(~T.blank(F.col("fr")))
    measure = lambda c: F.when(F.col("lines").isNull(), T.pixels(c)).otherwise(T.wrapped_lines(c, F.col("limit")))
    bound = F.coalesce("lines", "limit")
    rows = rows.withColumn("n", measure(F.col("fr"))).withColumn("m", measure(F.col("english"))).filter(F.col("n") > bound)
    fits = F.col("m") <= bound
    rows = rows.filter(fits | (F.col("n") > F.col("m")))
    hard = fits & ~F.col("behaviour").startswith("scroll")
    out = [
        finding(shop, "width", F.when(F.col("origin_fr") == "project", BLOCKING).otherwise(FLAGGED), actual=F.col("fr"), detail=F.concat(F.col("n").cast("string"), F.lit(" lines of 102 px, 2 at most"))).withColumn("ord", F.lit(-1)),
        manual.select("ord", "fr", "n", "limit", "proof", "key").transform(
            lambda d: d.select(
                F.lit("width").alias("control"), "key", F.lit(BLOCKING).alias("status"), F.col("fr").alias("actual"), F.lit("").alias("expected"),
                F.concat_ws(" px, at most ", F.col("n").cast("string"), F.col("limit").cast("string")).alias("detail"), F.coalesce("proof", F.lit("")).alias("proof"),
                F.array().cast("array<string>").alias("object"), "ord",
            )
        ),
    ]
    if mods:
        out.append(
            rows.select(
                F.lit("width").alias("control"), "key", F.when(hard, BLOCKING).otherwise(FLAGGED).alias("status"), F.col("fr").alias("actual"), F.lit("").alias("expected"),
                F.concat(F.col("n").cast("string"), F.lit(" for "), bound.cast("string"), F.lit("; English "), F.col("m").cast("string")).alias("detail"),
                F.concat_ws(": ", "mod", "proof").alias("proof"), F.array().cast("array<string>").alias("object"), "ord",
            )
        )
    return most_severe(united(out), "ord").select(*COLUMNS)


# 9
def convention_control(texts: DataFrame, books: DataFrame, journal: DataFrame, base_ns: str = "base", familiar: str = "^project", percent: str | None = "space") -> DataFrame:
    """Typography and naming: one pass over the texts, the rules of each as an array of hits."""
    said = shown_texts(texts, books, journal, project=True)
    planks = r"^block\.([^.]+)\.([a-z0-9_]+)_planks$"
    slab = r"^block\.([^.]+)\.([a-z0-9_]+?)(?:_vertical)?_slab$"
    wood = texts.filter(F.col("key").rlike(planks)).select(F.regexp_extract("key", planks, 1).alias("wood_ns"), F.regexp_extract("key", planks, 2).alias("wood"))
    is_slab = F.col("key").rlike(slab)
    slabs = said.filter(is_slab).select("key", F.regexp_extract("key", slab, 1).alias("slab_ns"), F.regexp_extract("key", slab, 2).alias("base"))
    wooden = slabs.join(wood, (F.col("base") == F.col("wood")) & (F.col("wood_ns") == base_ns) | (F.col("base") == F.col("wood")) & (F.col("wood_ns") == F.col("slab_ns")), "left_semi")
    said = said.join(wooden.select("key", F.lit(True).alias("wooden")).distinct(), "key", "left")
    fr, key, narrative = F.col("fr"), F.col("key"), F.col("space").isin("dialog", "book", "journal", "quests")
    formal = r"(?iU)\b(?:vous|votre|vos)\b|\b(?!(?:chez|assez|nez|rez|lez)\b)\p{L}+ez\b"
    variable = F.regexp_replace(F.replace(fr, F.lit("%%"), F.lit("\u0000")), r"%(?:\d+\$)?(?:\.\d+)?[sdf]", "0")
    mark = F.regexp_replace(variable, "%", "\u0000")
    wrong_percent = mark.rlike("[0-9]\u0000") if percent == "space" else mark.rlike("[0-9] \u0000")
    hit = lambda when, rule, expected=F.lit(""): F.when(when, F.struct(F.lit(rule).alias("rule"), expected.alias("expected")))
    hits = [
        hit(fr.contains("’"), "apostrophe", F.replace(fr, F.lit("’"), F.lit("'"))),
        hit(fr.rlike("[œŒ]"), "ligature", F.replace(F.replace(F.regexp_replace(fr, "Œ(?=[a-zé])", "Oe"), F.lit("Œ"), F.lit("OE")), F.lit("œ"), F.lit("oe"))),
        hit(fr.rlike("[  ]"), "no-break space", F.translate(fr, "  ", "  ")),
        hit((F.col("space").rlike(familiar) | (narrative & (F.col("space") != "journal"))) & F.regexp_replace(fr, r"(?iU)\brendez-vous\b", " ").rlike(formal), "formal address"),
        hit(~narrative & fr.rlike("[«»]"), "quotation marks", F.regexp_replace(fr, r"(?U)«\s*|\s*»", '"')),
        hit(~narrative & key.rlike(r"^block\.[^.]+\.[a-z0-9_]*stairs$") & ~fr.startswith("Escalier en "), "naming"),
        hit(~narrative & key.rlike(r"^block\.[^.]+\.(?![a-z0-9_]*sconce)[a-z0-9_]*_wall$") & ~fr.rlike("^Muret (?:de |d')"), "naming"),
        hit(~narrative & key.rlike(slab) & F.coalesce("wooden", F.lit(False)) & ~fr.rlike(r"(?U)^Dalle (?:verticale )?(?:en |(?:carmin|biscornue)\b)"), "naming"),
        hit(~narrative & key.rlike(slab) & ~F.coalesce("wooden", F.lit(False)) & ~fr.rlike("^Dalle (?:verticale )?(?:de |d')"), "naming"),
    ]
    if percent:
        hits.append(hit(wrong_percent, "percentage"))
    rows = said.select("key", "fr", F.explode(F.array_compact(F.array(*hits))).alias("h"))
    return finding(rows, "conventions", actual=F.col("fr"), expected=F.col("h.expected"), object=one("h.rule"), detail=F.col("h.rule"))


# 10
# Fixed value: Roman numerals.
ROMAN = "m{0,4}(?:cm|cd|d?c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})"


def french_words(texts: DataFrame, books: DataFrame) -> DataFrame:
    """(key, word): the words that each text shows to be French: all of the base game's, and those it doesn't share with its English."""
    said = united([texts.filter(visible(F.col("key")) & (F.col("fr") != "")).select("key", "fr", F.col("english").alias("en"), (F.col("origin_fr") == "vanilla").alias("base")), books.filter("fr != ''").select("key", "fr", "en", F.lit(False).alias("base"))])
    ws = F.when(F.col("base"), T.words(F.col("fr"))).otherwise(F.array_except(T.words(F.col("fr")), T.words(F.col("en"))))
    return said.select("key", F.explode(ws).alias("word"))


def french_lexicon(texts: DataFrame, books: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """(word): words taken for French."""
    found = french_words(texts, books).select("word").distinct()
    return found if more is None else found.unionByName(more.select("word")).distinct()


def copied_words(said: DataFrame, kept: list[str] | None = None) -> DataFrame:
    """(key, fr, en, name, word): words that may be English left in French: those that a name shares with its English, and all of a text left as
    it was. said: shown texts."""
    exempt = F.array(*(F.lit(w) for w in kept or ["\u0000"]))
    name = F.col("key").rlike(OBJECT_KEY)
    same = T.strip(F.col("fr")) == T.strip(F.col("en"))
    candidates = F.when(name, F.array_intersect(T.words(F.col("fr")), T.words(F.col("en")))).when(same, F.array_distinct(T.words(F.col("fr"))))
    foreign = lambda w: (F.length(w) >= 4) & w.rlike("^[a-z]+$") & ~w.rlike(f"^(?:{ROMAN})$") & ~F.array_contains(exempt, w)
    return said.select("key", "fr", "en", name.alias("name"), F.explode(F.filter(candidates, foreign)).alias("word"))


def residual_control(texts: DataFrame, books: DataFrame, kept: list[str] | None = None, keep_keys: DataFrame | None = None, lexicon: DataFrame | None = None) -> DataFrame:
    """English left in French: copied words in names, whole texts left as they were, raw tags. lexicon: the words taken for French, where it is at hand."""
    said = shown_texts(texts, books)
    rows = copied_words(said, kept)
    rows = rows.join(french_lexicon(texts, books) if lexicon is None else lexicon, "word", "left_anti")
    if keep_keys is not None:
        rows = rows.join(keep_keys.select("key", F.lit(True).alias("keep")), "key", "left").filter("name or keep is null")
    left = rows.groupBy("key").agg(F.first("name").alias("name"), F.array_sort(F.collect_set("word")).alias("ws"))
    tags = said.select("key", F.regexp_extract_all(T.strip_codes(F.col("fr")), F.lit("(#[a-z0-9_.-]+:[a-z0-9_/.-]+)"), 1).alias("tags")).filter(F.size("tags") > 0)
    out = said.select("key", "fr").join(left, "key", "left").join(tags, "key", "left").filter("ws is not null or tags is not null")
    detail = F.concat_ws(
        " ; ",
        F.when(F.col("name"), F.concat(F.lit("English words copied: "), F.array_join("ws", ", "))).when(F.col("ws").isNotNull(), "text left in English"),
        F.concat(F.lit("raw tag: "), F.array_join("tags", ", ")),
    )
    return finding(out, "residual", actual=F.col("fr"), detail=detail)


# 11
def accent_control(texts: DataFrame, books: DataFrame, journal: DataFrame, vocabulary: DataFrame, double: DataFrame | None = None, exempt: list[str] | None = None, homographs: list[str] | None = None) -> DataFrame:
    """vocabulary: folded, form. double: english (regex), right array. Words that miss an accent by the vocabulary's only form, or by
    the sense that the English decides."""
    forms = vocabulary.groupBy("folded").agg(F.min("form").alias("right"), F.max("form").alias("last")).filter("right = last and right != folded").drop("last")
    base = texts.filter("origin_fr = 'vanilla' and fr != ''").select(F.explode(F.regexp_extract_all(F.lower(T.strip_codes(F.col("fr"))), F.lit(r"(\p{L}+)"), 1)).alias("folded")).distinct()
    both = base.withColumn("both", F.lit(True))
    # Words travel with their text's key and digest: sorted with whole texts beside them, they took a task's memory. Each is judged once, for all texts.
    said = shown_texts(texts, books, journal, project=True).select("key", "fr", "en", F.unhex(F.sha1("fr")).alias("text"))
    ws = said.select("key", "text", F.explode(F.array_distinct(F.regexp_extract_all(T.strip_codes(F.col("fr")), F.lit(r"(\p{L}+)"), 1))).alias("word"))
    spared = F.array(*(F.lit(x) for x in exempt or ["\u0000"]))
    twins = F.array(*(F.lit(x) for x in homographs or ["\u0000"]))
    unsure = F.coalesce("both", F.lit(False)) | F.array_contains(twins, F.col("folded"))
    known = ws.select("word").distinct().withColumn("folded", T.fold(F.col("word"))).join(forms, "folded").join(both, "folded", "left")
    known = known.filter(~F.array_contains(spared, F.col("folded")) & T.accent_fault(F.col("word"), F.col("right")))
    known = stage(known.select("word", T.same_case(F.col("word"), F.col("right")).alias("right"), unsure.alias("unsure")), "accents")
    rows = ws.join(listed(known), "word").filter(F.col("key").rlike(OBJECT_KEY) | ~F.col("unsure")).select("key", "text", "word", "right")
    if double is not None:
        aimed = matched(said.select("key", "text", "en").distinct(), double, "en", literal(F.col("english")), F.expr("en rlike concat('(?iU)\\\\b(?:', english, ')\\\\b')"), "double senses")
        senses = ws.join(aimed.select("key", "text", "right"), ["key", "text"])
        senses = senses.select("key", "text", "word", F.explode("right").alias("r")).filter(T.fold(F.col("word")) == T.fold(F.col("r")))
        decided = senses.groupBy("key", "text", "word").agg(F.array_sort(F.collect_set("r")).alias("rs")).filter(~F.array_contains("rs", F.lower("word")))
        rows = rows.join(decided.select("key", "text", "word"), ["key", "text", "word"], "left_anti").unionByName(decided.select("key", "text", "word", T.same_case(F.col("word"), F.col("rs")[0]).alias("right")))
    faults = rows.groupBy("key", "text").agg(F.array_sort(F.collect_set(F.struct("word", "right"))).alias("faults"))
    grouped = said.select("key", "text", "fr").join(faults, ["key", "text"]).dropDuplicates(["key", "text"])
    # Whole words only: a mark is put around words, so that each is replaced by itself.
    marked = F.regexp_replace("fr", r"(\p{L}+)", "\u0001$1\u0002")
    put = F.aggregate("faults", marked, lambda t, f: F.replace(t, F.concat(F.lit("\u0001"), f["word"], F.lit("\u0002")), F.concat(F.lit("\u0001"), f["right"], F.lit("\u0002"))))
    detail = F.array_join(F.transform("faults", lambda f: F.concat(f["word"], F.lit(" -> "), f["right"])), ", ")
    return finding(grouped, "accents", actual=F.col("fr"), expected=F.translate(put, "\u0001\u0002", ""), detail=detail)


# 12
def last_decision(decisions: DataFrame) -> DataFrame:
    """(key, decided): the value of the latest decision that fixes one."""
    return decisions.filter("fr is not null").groupBy("key").agg(F.max_by("fr", "seq").alias("decided"))


def decision_control(said: DataFrame, decisions: DataFrame) -> DataFrame:
    """said: key, fr of language keys, book fields and the change log alike."""
    rows = last_decision(decisions).join(said, "key", "left").filter(~F.col("decided").eqNullSafe(F.col("fr")))
    return finding(rows, "decisions", actual=F.col("fr"), expected=F.col("decided"), detail=F.when(F.col("fr").isNull(), "decided key is absent").otherwise("differs from the last decision"))


# 13
def patch_control(patches: DataFrame, upstream: DataFrame | None) -> DataFrame:
    """patches: key, base. upstream: key, sha; None if it can't be read, which isn't the same as empty."""
    if upstream is None:
        return finding(patches, "patches", detail="upstream unreadable")
    rows = patches.join(upstream, "key", "left").filter(~F.col("base").eqNullSafe(F.col("sha")))
    return finding(rows, "patches", actual=F.col("sha"), expected=F.col("base"), detail=F.when(F.col("sha").isNull(), "script not found upstream").otherwise("changed upstream since the patch"))


# 14
def family_members(keys: DataFrame, families: DataFrame) -> DataFrame:
    """(key, family, ident, template, sources, ord): the first family, by ord, whose pattern matches a key. pattern holds {id}."""
    regex = F.concat(F.lit("^"), F.replace(F.replace(F.col("pattern"), F.lit("."), F.lit("\\.")), F.lit("{id}"), F.lit("([a-z0-9_]+)")), F.lit("$"))
    rows = templated(spread(keys), families.withColumn("regex", regex), "pattern", "{id}", F.expr("key rlike regex"), "families")
    rows = rows.withColumn("ident", F.expr("if(instr(pattern, '{id}') > 0, regexp_extract(key, regex, 1), '')"))
    first = rows.groupBy("key").agg(F.min_by(F.struct("family", "ident", "template", "sources", "ord"), "ord").alias("x"))
    return first.select("key", "x.*")


def family_names(members: DataFrame, said: DataFrame, agreements: DataFrame) -> DataFrame:
    """(key, family, expected, problem): each member's name by its template, chained families from their sources' expected names.

    Members whose source is no member are named first; each round names those whose source was named in the last. What is left
    after that lies on a cycle, or hangs on one, and has no name. Members, what they aim at, and each round are staged: all are asked for again.
    """
    members = stage(members.select("key", "family", "ident", "template", "sources"), "members")
    keys = members.select(F.col("key").alias("mk"))
    aims = members.select("key", "family", "template", "ident", F.posexplode("sources").alias("rank", "source")).withColumn("source", F.replace(F.col("source"), F.lit("{id}"), F.col("ident")))
    known = said.filter("fr != ''").select(F.col("key").alias("sk"), F.col("fr").alias("sfr"))
    aims = aims.join(keys, F.col("source") == F.col("mk"), "left").join(known, F.col("source") == F.col("sk"), "left").filter("mk is not null or sk is not null")
    first = aims.groupBy("key").agg(F.min_by(F.struct("source", F.col("mk").isNotNull().alias("chained"), "sfr"), "rank").alias("x")).select("key", "x.*")
    rows = members.join(first, "key", "left").join(agreements.withColumnRenamed("key", "ak"), F.col("source") == F.col("ak"), "left")
    agrees = F.col("template").rlike(r"\{[es]\}")
    plural = F.col("template").contains("{sources}")
    rows = rows.withColumn(
        "problem",
        F.when(F.col("source").isNull(), "unknown source")
        .when(F.col("chained") & (agrees | plural), "chained template with agreement")
        .when(~F.col("chained") & agrees & ~F.coalesce(F.col("gender").isin("m", "f"), F.lit(False)), "unknown gender")
        .when(~F.col("chained") & plural & F.col("plural").isNull(), "unknown plural"),
    )
    name = lambda c: T.render_template(F.col("template"), c, F.col("gender"), F.col("number"), F.col("proper"), F.col("plural"))
    rows = stage(rows.select("key", "family", "template", "source", "chained", "sfr", "gender", "number", "proper", "plural", "problem"), "aims")
    reached = last = stage(rows.filter("problem is null and not chained").select("key", "family", name(F.col("sfr")).alias("expected")), "named")
    wait = rows.filter("problem is null and chained").select("key", "family", "template", "source").withColumns({c: F.lit(None).cast(t) for c, t in (("gender", "string"), ("number", "string"), ("proper", "boolean"), ("plural", "string"))})
    while True:
        last = wait.join(last.select(F.col("key").alias("nk"), F.col("expected").alias("sfr")), F.col("source") == F.col("nk")).select("key", "family", name(F.col("sfr")).alias("expected"))
        last = stage(last, "named")
        if last.isEmpty():
            break
        reached = reached.unionByName(last)
    out = reached.select("key", "family", "expected", F.lit(None).cast("string").alias("problem"))
    failed = rows.filter("problem is not null").select("key", "family", F.lit(None).cast("string").alias("expected"), "problem")
    stuck = wait.join(reached, "key", "left_anti").select("key", "family", F.lit(None).cast("string").alias("expected"), F.lit("source has no expected name").alias("problem"))
    return united([out, failed, stuck])


def family_control(names: DataFrame, said: DataFrame) -> DataFrame:
    rows = names.join(said.filter("fr != ''").select("key", "fr"), "key").filter("expected is null or fr != expected")
    return finding(rows, "families", actual=F.col("fr"), expected=F.col("expected"), detail=F.concat_ws(": ", "family", "problem"))


# 15
# Words whose form depends on the noun after them, and determiners.
GENDERED = "le|la|un|une|du|au|ce|cet|cette|mon|ma|ton|ta|son|sa|de la|l'|d'"
DETERMINERS = GENDERED + "|les|des|aux|ces|mes|tes|ses|notre|votre|leur|leurs"


def template_control(texts: DataFrame, arguments: DataFrame) -> DataFrame:
    """arguments: key, types (array by rank of arrays of types). What stands before a placeholder must suit any name it may take."""
    said = project_texts(texts).filter("fr != ''").select("key", "fr").join(arguments, "key", "left")
    cells = F.split(F.regexp_replace(F.replace(F.col("fr"), F.lit("%%"), F.lit("\u0003")), r"%(?:(\d+)\$)?s", "\u0001$1\u0002"), "\u0001")
    # cells: text, then "rank \u0002 text" for each placeholder; what stands before a placeholder is the text of the cell before it.
    rows = said.select("key", "fr", "types", F.posexplode(cells).alias("i", "cell"), cells.alias("cells")).filter("i > 0")
    before = F.element_at(F.split(F.get("cells", F.col("i") - 1), "\u0002"), -1)
    explicit = F.nullif(F.split("cell", "\u0002")[0], F.lit("")).cast("int") - 1
    earlier = F.size(F.filter(F.slice("cells", 2, F.col("i")), lambda c: c.startswith("\u0002"))) - 1
    rows = rows.withColumn("before", before).withColumn("kinds", F.get("types", F.coalesce(explicit, earlier)))
    word = F.lower(F.regexp_extract("before", rf"(?iU)(?:^|\W)({DETERMINERS})\s*$", 1))
    kind = lambda k: F.coalesce(F.array_contains("kinds", k), F.lit(False))
    rows = rows.withColumn(
        "why",
        F.when(word.rlike(f"^(?:{GENDERED})$") & kind("object"), "gendered or elided word before an object's name")
        .when(F.col("before").rlike(r"(?iU)\b(en|au)\s+$") & kind("season"), "en or au before a season")
        .when((word != "") & F.col("types").isNull(), "determiner before an unknown argument"),
    ).filter("why is not null")
    return finding(rows, "templates", F.when(F.col("why").contains("unknown"), FLAGGED).otherwise(BLOCKING), actual=F.col("fr"), detail=F.col("why"))


# 16
def spelling_control(texts: DataFrame, books: DataFrame, journal: DataFrame, forms: DataFrame) -> DataFrame:
    """forms: form, right, exact, source. Known mistakes never come back; unless exact, they are found in any case, which is kept."""
    said = shown_texts(texts, books, journal)
    bounded = F.expr("concat(if(exact, '', '(?i)'), '(?U)(?<!\\\\w)', regexp_replace(form, '([\\\\\\\\.^$|?*+()\\\\[\\\\]{}])', '\\\\\\\\$1'), '(?!\\\\w)')")
    rows = matched(said, forms.withColumn("regex", bounded), "fr", F.col("form"), F.expr("fr rlike regex"), "forms")
    met = F.array_distinct(F.expr("regexp_extract_all(fr, regex, 0)"))
    # Whole words only: marks are put around what the rule found, and each marked word becomes the right one.
    marked = F.expr("regexp_replace(fr, regex, '\u0001$0\u0002')")
    put = F.aggregate(
        met,
        marked,
        lambda t, m: F.replace(t, F.concat(F.lit("\u0001"), m, F.lit("\u0002")), F.concat(F.lit("\u0003"), F.when(F.col("exact"), F.col("right")).otherwise(T.same_case(m, F.col("right"))))),
    )
    put = F.replace(put, F.lit("\u0003"), F.lit(""))
    return finding(rows, "spelling", actual=F.col("fr"), expected=put, object=one("form"), proof=F.col("source"), detail=F.concat(met[0], F.lit(" -> "), F.col("right")))


# 17
# What may stand before the first word of a name; articles; the key of a skill's book, and of the object that is that book.
LEAD = r"(?:[§&][0-9a-fk-or]|:[a-z_]+:|<lt\w+>(?:\w+=[^;<>]*;)*|[^\w§&:<])*"
ARTICLE = "(?:Les?|La) |L'"
SKILL_BOOK = r"^([a-z]+)_skills\.books\.([a-z0-9_]+)\.[a-z0-9_]+$"


def skill_books(texts: DataFrame) -> DataFrame:
    """(key) of the objects that are a skill's book: their names are titles of works."""
    return texts.filter(F.col("key").rlike(SKILL_BOOK) & (F.col("fr") != "")).select(F.concat_ws(".", F.lit("item"), F.regexp_extract("key", SKILL_BOOK, 1), F.regexp_extract("key", SKILL_BOOK, 2)).alias("key")).distinct()


def work_title_control(texts: DataFrame) -> DataFrame:
    """The title of a work that begins with an article has a capital after it ("La Qualité de la terre")."""
    opening = rf"(?U)^({LEAD})({ARTICLE})([^\p{{L}}]*)(\p{{L}}+)"
    rows = texts.filter("origin_fr != 'vanilla' and fr != ''").join(skill_books(texts), "key", "left_semi").withColumn("first", F.regexp_extract("fr", opening, 4))
    rows = rows.filter((F.col("first") != "") & (F.left("first", F.lit(1)) == F.lower(F.left("first", F.lit(1)))) & (F.left("first", F.lit(1)) != F.upper(F.left("first", F.lit(1)))))
    before = F.length(F.regexp_extract("fr", rf"(?U)^{LEAD}(?:{ARTICLE})[^\p{{L}}]*", 0))
    right = F.concat(F.left("fr", before), F.upper(F.substr("fr", before + 1, F.lit(1))), F.substr("fr", before + 2))
    return finding(rows, "case", actual=F.col("fr"), expected=right, object=one("first"), detail="title of a work: a capital after the article")


# Generic terms of places that stand before "de", "du", "des" or "d'" and a proper noun; what opens a sentence, a quotation, or
# a part after a number or a heading in capitals; and the keys of titles.
PLACE = (
    r"(?:(?:Grotte|Caverne|Lac|Mont|Montagne|Forêt|Île|Océan|Mer|Rivière|Fleuve|Vallée|Colline|Désert|Plaine|Baie|Golfe|Pic|Col|Cap)s?|Marais)"
    r"(?=\s+(?:de|du|des)\s+[A-ZÀ-ÖØ-ÞŒ]|\s+d['’][A-ZÀ-ÖØ-ÞŒ])"
)
OPENING = r"(?:[.!?…][\"'»”)]*\s+|(?:^|\s)(?:[IVXLCDM]+(?:\.[IVXLCDM]+)*|\d+(?:\.\d+)*|[A-ZÀ-ÖØ-ÞŒ]{2,})\s[-–—]\s+|«\s*|“|(?:^|\s)[\"']|(?:\\n|\n)\s*)"
TITLE_KEY = r"quests\..*\.(?:title|subtitle)$|#/(?:name|title)$"


def toponym_control(texts: DataFrame, books: DataFrame, names: DataFrame, declared: DataFrame) -> DataFrame:
    """The generic term of a place is written small within a sentence ("les grottes de Camuy"), unless a declared name or a displayed one
    stands there whole. names: the registry. declared: name.

    The exempt spans are taken out first: each name that a text holds, looked up by its rarest word, keeps its generic terms behind a mark,
    as do the terms that open a sentence; what the pattern then finds is at fault.
    """
    said = project_texts(texts).filter(~is_name(F.col("key"))).select("key", "fr").unionByName(books.select("key", "fr")).filter((F.col("fr") != "") & ~F.col("key").rlike(TITLE_KEY))
    said = said.filter(F.col("fr").rlike(rf"(?U)(?<!\w){PLACE}"))
    spared = names.select(F.col("fr").alias("name")).filter(F.col("name").rlike(rf"(?U)(?<!\w){PLACE}")).unionByName(declared.select(F.trim("name").alias("name")).filter(F.size(T.words(F.col("name"))) > 1)).filter("name != ''").distinct()
    met = matched(said, spared, "fr", F.col("name"), F.contains(F.col("fr"), F.col("name")), "names").groupBy("key", "fr").agg(F.array_sort(F.collect_set(F.struct((-F.length("name")).alias("less"), "name"))).alias("names"))
    rows = said.join(met, ["key", "fr"], "left")
    # A mark before a term keeps the pattern from it: at the text's beginning, after what opens a sentence, and inside a name.
    marked = F.regexp_replace("fr", rf"(?U)(^{LEAD}|{OPENING}(?:[§&][0-9a-fk-or])*|(?:{T.BREAKS})\s*)(?={PLACE})", "$1\u0003")
    within = lambda name: F.regexp_replace(name, rf"(?U)(?<![\w\u0003])(?={PLACE})", "\u0003")
    alone = lambda name: F.concat(F.lit(r"(?U)(?<!\w)\Q"), name, F.lit(r"\E(?!\w)"))
    kept = F.aggregate(F.coalesce("names", F.array().cast("array<struct<less:int,name:string>>")), marked, lambda t, n: F.regexp_replace(t, alone(n["name"]), within(n["name"])))
    rows = rows.withColumn("kept", kept).withColumn("met", F.regexp_extract_all("kept", F.lit(rf"(?U)(?<![\w\u0003])({PLACE})"), 1)).filter(F.size("met") > 0)
    small = F.aggregate(
        F.array_distinct("met"),
        F.col("kept"),
        lambda t, m: F.regexp_replace(t, F.concat(F.lit(r"(?U)(?<![\w\u0003])"), m, F.lit(rf"(?=\s+(?:de|du|des)\s+[A-ZÀ-ÖØ-ÞŒ]|\s+d['’][A-ZÀ-ÖØ-ÞŒ])")), F.concat(F.lower(F.left(m, F.lit(1))), F.substring(m, 2, 2**31 - 1))),
    )
    return finding(rows, "case", actual=F.col("fr"), expected=F.translate(small, "\u0003", ""), object=one(F.lit("toponym")), detail=F.concat(F.lit("generic term of a place: "), F.array_join("met", ", ")))


def case_control(texts: DataFrame, nouns: list[str], kept: list[str] | None = None) -> DataFrame:
    """Capitals inside names where French has none, and declared proper nouns written small. A skill's book has one after its article."""
    allowed = {w for n in nouns for w in n.split()} | {w for n in kept or [] for w in n.split()}
    said = project_texts(texts).filter("fr != ''")
    toks = F.filter(T.tokens(F.col("fr")), lambda t: ~t["start"])
    first = lambda w: F.left(w, F.lit(1))
    capital = lambda w: (first(w) == F.upper(first(w))) & (first(w) != F.lower(first(w)))
    free = F.array(*(F.lit(w) for w in sorted(allowed) or ["\u0000"]))
    inner = F.array_distinct(F.transform(F.filter(toks, lambda t: capital(t["written"]) & (F.length(t["written"]) > 1) & (t["written"] != F.upper(t["written"])) & ~F.array_contains(free, t["written"])), lambda t: t["written"]))
    title = F.when(F.col("work"), F.regexp_extract("fr", rf"(?U)^{LEAD}(?:{ARTICLE})[^\p{{L}}]*(\p{{L}}+)", 1))
    works = skill_books(texts).withColumn("work", F.lit(True))
    names = said.filter(is_name(F.col("key"))).join(works, "key", "left").withColumn("inner", F.filter(inner, lambda w: ~w.eqNullSafe(title))).filter(F.size("inner") > 0)
    small = [F.when(F.col("fr").rlike(rf"(?U)(?<!\w)\Q{n[0].lower() + n[1:]}\E(?!\w)"), F.lit(n)) for n in nouns if n[:1].isupper()]
    lost = said.withColumn("lost", F.array_compact(F.array(*small) if small else F.array().cast("array<string>"))).filter(F.size("lost") > 0)
    # Whole words, and not where one begins the text or a sentence.
    within = lambda w: F.concat(F.lit(r"(?U)(?<!^)(?<![.!?\n]\s{0,4})(?<!\w)\Q"), w, F.lit(r"\E(?!\w)"))
    lowered = F.aggregate("inner", F.col("fr"), lambda t, w: F.regexp_replace(t, within(w), F.concat(F.lower(first(w)), F.substring(w, 2, 2**31 - 1))))
    return united(
        [
            finding(names, "case", actual=F.col("fr"), expected=lowered, object=F.col("inner"), detail="capital inside a name"),
            finding(lost, "case", actual=F.col("fr"), object=F.col("lost"), detail="proper noun written small"),
        ]
    )


# 18
def resolved(cited: DataFrame, names: DataFrame, links: DataFrame, pins: DataFrame) -> DataFrame:
    """Which of the names that a citation may mean it means. cited: key, ns, motif (distinct); names: motif, name_key, fr_tokens, identifier.

    A name isn't meant by its own text. If all candidates read alike in French: the pinned one, else the first. Else the only one that
    is linked to the text, else the only one of its namespace, else the only pinned one; else it is ambiguous (target null).

    Texts never meet all names of their words: what these have in common is worked out once for the words, and only the names that a
    link or a pin points to, and a text's own, are looked up for a text. A link or pin that is there twice counts twice.
    """
    space = F.split("identifier", ":")[0]
    names = names.withColumn("space", space)
    readings = names.groupBy("motif", "fr_tokens").agg(F.count(F.lit(1)).alias("same"))
    first = Window.partitionBy("motif").orderBy("name_key")
    two = names.select("motif", "name_key").distinct().withColumn("r", F.row_number().over(first)).filter("r < 3")
    two = two.groupBy("motif").agg(F.min("name_key").alias("first"), F.max("name_key").alias("second"))
    groups = readings.groupBy("motif").agg(F.count("fr_tokens").alias("readings"), F.sum("same").alias("n")).join(two, "motif")
    spaces = names.filter("space is not null").groupBy("motif", F.col("space").alias("ns")).agg(F.count(F.lit(1)).alias("near"), F.min("name_key").alias("near_first"), F.max("name_key").alias("near_last"))

    own = cited.join(names.withColumnRenamed("name_key", "key"), ["key", "motif"])
    own = own.groupBy("key", "motif", "ns", "fr_tokens").agg(F.count(F.lit(1)).alias("own"), F.count_if(F.col("space") == F.col("ns")).alias("own_near")).join(listed(readings.filter("fr_tokens is not null")), ["motif", "fr_tokens"], "left")
    own = own.groupBy("key", "motif").agg(F.sum("own").alias("own"), F.sum("own_near").alias("own_near"), F.count_if(F.col("own") == F.col("same")).alias("own_readings"))

    linked = links.groupBy("key", F.col("object_id").alias("identifier")).agg(F.count(F.lit(1)).alias("linked"))
    pinned = pins.groupBy("key", F.col("object").alias("name_key")).agg(F.count(F.lit(1)).alias("pinned"))
    aimed = cited.join(linked, "key").join(names, ["motif", "identifier"]).join(pinned, ["key", "name_key"], "left")
    only_pinned = cited.join(pinned, "key").join(names, ["motif", "name_key"]).join(linked.select("key", "identifier"), ["key", "identifier"], "left_anti")
    aimed = aimed.unionByName(only_pinned, allowMissingColumns=True).filter("key != name_key")
    times = F.coalesce("linked", F.lit(1)) * F.coalesce("pinned", F.lit(1))
    flagged = lambda c: F.min(F.when(F.col(c).isNotNull(), F.col("name_key")))
    aimed = aimed.groupBy("key", "motif").agg(
        F.sum(F.when(F.col("linked").isNotNull(), times)).alias("linked"), flagged("linked").alias("by_link"),
        F.sum(F.when(F.col("pinned").isNotNull(), times)).alias("pinned"), flagged("pinned").alias("by_pin"),
        F.sum(F.when(F.col("space") == F.col("ns"), times - 1)).alias("more_near"),
    )
    rows = cited.join(listed(groups), "motif").join(listed(spaces), ["motif", "ns"], "left").join(own, ["key", "motif"], "left").join(aimed, ["key", "motif"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0))
    other = lambda a, b: F.when(F.col(a) != F.col("key"), F.col(a)).otherwise(F.col(b))
    any_of = F.coalesce("by_pin", other("first", "second"))
    near = F.when(F.col("near") - zero("own_near") + zero("more_near") == 1, other("near_first", "near_last"))
    ranked = F.coalesce(F.when(F.col("linked") == 1, F.col("by_link")), near, F.when(F.col("pinned") == 1, F.col("by_pin")))
    alike = F.col("readings") - zero("own_readings") == 1
    return rows.filter(F.col("n") > zero("own")).select("key", "motif", F.when(alike, any_of).otherwise(ranked).alias("target"))


def reference_control(texts: DataFrame, names: DataFrame, links: DataFrame, pins: DataFrame) -> DataFrame:
    """A text that cites an object by its English name uses the French name that is displayed; so for names that a coordination implies."""
    said = project_texts(texts).filter(~F.col("key").startswith("block_type.") & ~(F.col("key").rlike(OBJECT_KEY) & F.col("english").contains("%")))
    said = said.filter(~T.blank(F.col("english")) & ~T.blank(F.col("fr")))
    said = said.select("key", F.col("english").alias("en"), "fr", F.coalesce(F.split(object_id(F.col("key")), ":")[0], "ns_project", F.lit("")).alias("ns"))
    cand = stage(names.filter("citable").select(F.col("key").alias("name_key"), F.col("fr").alias("name_fr"), "fr_tokens", "identifier", F.col("en_tokens").alias("motif")), "names")
    cited = citations_in_context(said.select("key", T.words(F.col("en")).alias("ws"), is_name(F.col("key")).alias("name")), cand.select("motif").distinct())
    cited = stage(cited.select("key", "motif").distinct().join(said.select("key", "ns"), "key"), "cited")
    picks = resolved(cited, cand, links, pins).join(said, "key").join(cand.select(F.col("name_key").alias("target"), "name_fr", F.col("fr_tokens").alias("want")), "target", "left")
    picks = picks.withColumn("ws", T.words(F.col("fr")))
    there = F.when(is_name(F.col("key")), T.spread_match(F.col("ws"), F.col("want"))).otherwise(T.contains_words(F.col("ws"), F.col("want")))
    # Four kinds of findings are read from the picks, so they are worked out once.
    drift = F.when(F.col("there"), T.accent_drift(F.col("fr"), F.col("name_fr")))
    picks = stage(picks.withColumn("there", F.col("target").isNotNull() & there).withColumn("drift", drift).select("key", "fr", "motif", "target", "name_fr", "there", "drift"), "picks")
    # The candidates are listed once for the words and attached where they are asked for.
    candidates = cand.groupBy("motif").agg(F.array_sort(F.collect_set("name_key")).alias("candidates"))
    doubt = picks.filter("target is null").join(candidates, "motif", "left").withColumn("candidates", F.array_remove("candidates", F.col("key")))
    wrong = picks.filter("target is not null and not there")
    drift = picks.filter("drift is not null")
    unused = pins.join(picks.select("key", F.col("target").alias("object")), ["key", "object"], "left_anti")
    return united(
        [
            finding(doubt, "references", actual=F.col("fr"), object=one(F.array_join("motif", " ")), detail="ambiguous reference", proof=F.array_join("candidates", " ; ")),
            finding(wrong, "references", actual=F.col("fr"), expected=F.col("name_fr"), object=one("target"), proof=F.col("target"), detail="displayed name not used"),
            finding(drift, "references", actual=F.col("fr"), expected=F.col("name_fr"), object=one("target"), proof=F.col("target"), detail=F.concat(F.lit("accents differ from the displayed name: "), F.col("drift.said"), F.lit(" -> "), F.col("drift.right"))),
            finding(unused, "references", FLAGGED, object=one("object"), detail="pin not used"),
        ]
    )


def aliases(names: DataFrame) -> DataFrame:
    """names with rows for the words of object ids ("iron_door" is also "iron door"), unless a real name has these words."""
    path = F.regexp_replace(F.split("identifier", ":")[1], "[_/]", " ")
    extra = names.filter("identifier is not null and citable").withColumn("en_tokens", T.words(path)).filter("size(en_tokens) > 1")
    return names.unionByName(extra.join(names.select("en_tokens").distinct(), "en_tokens", "left_anti").select(*names.columns))


# Function words.
EMPTY_FR = ["de", "d", "du", "des", "en", "a", "au", "al", "la", "le", "les", "l", "un", "une"]
EMPTY_EN = ["the", "of", "from", "with", "s", "a", "an", "and", "or", "for", "in", "on", "to", "at", "by"]


def shared_words(rows: DataFrame, by: str, member: str, words: str) -> DataFrame:
    """(by, shared, n): the words that all members of a group have. A word is shared if as many members have it as there are."""
    n = rows.groupBy(by).agg(F.count_distinct(member).alias("n"))
    each = rows.select(by, member, F.explode(words).alias("w")).groupBy(by, "w").agg(F.count_distinct(member).alias("m"))
    found = each.join(n, by).filter("m = n").groupBy(by).agg(F.array_sort(F.collect_list("w")).alias("shared"))
    return n.join(found, by, "left").select(by, F.coalesce("shared", F.array().cast("array<string>")).alias("shared"), "n")


def title_control(texts: DataFrame, names: DataFrame, links: DataFrame) -> DataFrame:
    """A quest's title that aims at several objects by a word they share in English uses a word that they share in French."""
    titles = project_texts(texts).filter(F.col("key").rlike(r"^quests\..*\.(?:title|subtitle)$")).select("key", "fr", F.array_except(T.words(F.col("english")), F.array(*map(F.lit, EMPTY_EN))).alias("title"))
    aimed = titles.join(links, "key").join(names.select(F.col("identifier").alias("object_id"), F.col("key").alias("name"), "en_tokens", "fr_tokens"), "object_id")
    aimed = aimed.filter(F.arrays_overlap("title", "en_tokens")).dropDuplicates(["key", "name"])
    masculine = lambda ws: F.array_distinct(F.transform(ws, T.masculine))
    aimed = aimed.withColumn("en_shared", F.array_intersect("title", "en_tokens")).withColumn("fr_words", F.array_except(masculine("fr_tokens"), F.array(*map(F.lit, EMPTY_FR))))
    en = shared_words(aimed, "key", "name", "en_shared").filter("n > 1 and size(shared) > 0").select("key")
    fr = shared_words(aimed, "key", "name", "fr_words").select("key", "shared")
    rows = titles.join(en, "key").join(fr, "key").withColumn("said", masculine(T.words(F.col("fr"))))
    rows = rows.filter((F.size("shared") == 0) | ~F.arrays_overlap("shared", "said"))
    why = F.when(F.size("shared") == 0, "the objects share no French word").otherwise("the objects' shared word is missing")
    return finding(rows, "references", actual=F.col("fr"), expected=F.coalesce(F.get("shared", F.lit(0)), F.lit("")), detail=why)


def sheet_control(books: DataFrame, names: DataFrame) -> DataFrame:
    """The title of a document about an object names it: the object whose id has the file's name. books: key, file, pointer, en, fr, objects."""
    stem = F.regexp_extract("file", r"([^/]+?)(?:\.[a-z]+)?$", 1)
    heads = books.filter("pointer = '/name' and fr != ''").select("key", "en", "fr", stem.alias("stem"), F.explode("objects").alias("identifier"))
    heads = heads.filter(F.split("identifier", ":")[1] == F.col("stem")).join(names.select("identifier", F.col("key").alias("name"), F.col("fr").alias("name_fr"), "en_tokens", "fr_tokens"), "identifier")
    named = T.contains_words(T.words(F.col("en")), F.col("en_tokens")) | T.contains_words(T.words(F.col("fr")), F.col("fr_tokens"))
    rows = heads.groupBy("key", "fr").agg(F.bool_or(named).alias("ok"), F.min(F.struct("name", "name_fr")).alias("x")).filter("not ok")
    return finding(rows, "references", actual=F.col("fr"), expected=F.col("x.name_fr"), object=one("x.name"), detail="the sheet doesn't name what it is about")


def family_noun_control(texts: DataFrame, names: DataFrame, links: DataFrame) -> DataFrame:
    """A text linked to an object of a family that cites the family's common noun uses the words its French names begin with."""
    from .matching import hits, name_families

    families = name_families(names, EMPTY_EN, EMPTY_FR)
    size = F.size("en_tokens")
    members = names.filter("citable and identifier is not null and size(en_tokens) > 2").select(
        "identifier", F.explode(F.transform(F.sequence(F.lit(2), size - 1), lambda n: F.slice("en_tokens", size - n + 1, n))).alias("ending")
    )
    said = project_texts(texts).select("key", "fr", T.words(F.col("english")).alias("ws"))
    linked = links.join(members, F.col("object_id") == F.col("identifier")).select("key", "ending").distinct()
    cited = hits(said.join(linked.select("key").distinct(), "key", "left_semi").select("key", "ws"), families.select(F.col("ending").alias("motif")))
    whole = hits(said.select("key", "ws"), names.select(F.col("en_tokens").alias("motif"))).select("key", (F.col("pos") + F.col("len")).alias("end"), F.col("len").alias("full"))
    cited = cited.withColumn("end", F.col("pos") + F.col("len")).join(whole, ["key", "end"], "left").groupBy("key", "motif", "pos", "len").agg(F.max("full").alias("full"))
    cited = cited.filter("full is null or full <= len").select("key", F.col("motif").alias("ending")).distinct().join(linked, ["key", "ending"], "left_semi")
    rows = cited.join(families, "ending").join(said.select("key", "fr"), "key").filter(~T.contains_words(T.words(F.col("fr")), F.col("prefix")))
    return finding(rows, "references", actual=F.col("fr"), expected=F.array_join("prefix", " "), object=one(F.array_join("ending", " ")), detail="common noun of a family rendered otherwise")
