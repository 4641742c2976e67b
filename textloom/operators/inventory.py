"""The translation pipeline: inventory, batches, divergences, audits, revisions, provenance, dead keys, renderings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.lineage import cut, listed, rules, spread, stage
from .model import unit_of, visible


def exclusion(key, en, base_game, dead):
    """Why a key isn't reviewed, in this order; null if it is."""
    return (
        F.when(F.coalesce(base_game, F.lit(False)), "base game")
        .when(~visible(key), "comment")
        .when(T.blank(en), "without English")
        .when(F.coalesce(dead, F.lit(False)), "dead")
    )


def exclusion_counts(texts: DataFrame, dead: DataFrame) -> DataFrame:
    """(reason, n)."""
    rows = texts.join(dead.select("key", F.lit(True).alias("dead")), "key", "left")
    why = exclusion(F.col("key"), F.col("english"), F.col("origin_fr") == "vanilla", F.col("dead"))
    return rows.groupBy(F.coalesce(why, F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def units(texts: DataFrame) -> DataFrame:
    """(unit, keys, missing): keys of each unit of work, and those without French."""
    rows = texts.filter(visible(F.col("key")) & ~T.blank(F.col("english")))
    return rows.groupBy(unit_of(F.col("key"), F.col("ns_project")).alias("unit")).agg(F.count(F.lit(1)).alias("keys"), F.count_if(T.blank(F.col("fr"))).alias("missing"))


def delta(entries: DataFrame) -> DataFrame:
    """(ns, key, en): English of the jars that neither the jars' French nor the project's covers."""
    en = entries.filter("layer = 'jar' and locale = 'en_us'").groupBy("ns", "key").agg(F.max_by("value", F.struct("jar", "ord")).alias("en"))
    fr = entries.filter("layer in ('jar', 'project') and locale = 'fr_fr'").filter(~T.blank(F.col("value"))).select("key").distinct()
    return en.filter(visible(F.col("key")) & ~T.blank(F.col("en"))).join(fr, "key", "left_anti")


def batches(rows: DataFrame, size: int = 200, context: int = 30) -> DataFrame:
    """(unit, batch, keys, context): runs of at most `size` keys of a unit in key order, with the `context` keys before each."""
    at = F.row_number().over(Window.partitionBy("unit").orderBy("key")) - 1
    rows = rows.select("unit", "key", at.alias("at")).withColumn("batch", F.floor(F.col("at") / size))
    own = rows.groupBy("unit", "batch").agg(F.array_sort(F.collect_list("key")).alias("keys"))
    late = rows.filter((F.col("at") + context) % size < context).filter(F.col("at") % size >= size - context)
    late = late.groupBy("unit", (F.col("batch") + 1).alias("batch")).agg(F.array_sort(F.collect_list("key")).alias("context"))
    return own.join(late, ["unit", "batch"], "left").select("unit", "batch", "keys", F.coalesce("context", F.array().cast("array<string>")).alias("context"))


def batch_terms(rows: DataFrame, glossary: DataFrame) -> DataFrame:
    """(key, terms): glossary terms of three letters or more that a text holds anywhere, in any case."""
    terms = glossary.filter(F.length("en") >= 3).select(F.col("en").alias("term"))
    met = rows.join(rules(terms, "glossary"), F.contains(F.lower("en"), F.lower("term")))
    return met.groupBy("key").agg(F.array_sort(F.collect_set("term")).alias("terms"))


def flagged_counts(pairs: DataFrame, keep: DataFrame) -> DataFrame:
    """(code, n) of what the placeholder validation reports, without keys that are kept as they are."""
    rows = pairs.select("key", F.explode(T.placeholder_verdicts(F.col("en"), F.col("fr"))).alias("code"))
    rows = rows.join(keep.select("key"), "key", "left_anti").unionByName(rows.join(keep.select("key"), "key", "left_semi").filter("code != 'untranslated'"))
    return rows.groupBy("code").agg(F.count(F.lit(1)).alias("n"))


def divergences(pairs: DataFrame, most: int = 60) -> DataFrame:
    """(en, variants): short English texts with several French ones that differ beyond accents and case."""
    rows = pairs.filter((F.length("en") <= most) & ~T.blank(F.col("en")) & ~T.blank(F.col("fr"))).groupBy("en", "fr").agg(F.array_sort(F.collect_set("key")).alias("places"))
    rows = rows.groupBy("en").agg(F.count_distinct(T.fold_mn(F.col("fr"))).alias("n"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("fr", "places")))).alias("variants"))
    return rows.filter("n > 1").select("en", "variants")


def apply_choices(divergent: DataFrame, choices: DataFrame, bare_names: bool = False) -> DataFrame:
    """(key, before, after): the chosen French put in the place of all other variants. choices: en, fr. bare_names: names lose accents."""
    rows = divergent.join(choices, "en").select("en", F.col("fr").alias("after"), F.explode("variants").alias("before", "places")).filter("before != after")
    rows = rows.select(F.explode("places").alias("key"), "before", "after")
    if bare_names:
        rows = rows.withColumn("after", F.when(F.col("key").rlike(r"^(item|block|entity)\."), F.translate("after", *T._FOLD_MN)).otherwise(F.col("after")))
    return rows


def glossary_candidates(pairs: DataFrame, least: int = 3) -> DataFrame:
    """(en, n, spaces, sample, witness, vanilla_fr, jar_fr): English values that recur; the sample is the three smallest keys."""
    return (
        pairs.filter(~T.blank(F.col("en")))
        .groupBy("en")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.array_sort(F.collect_set("space")).alias("spaces"),
            F.slice(F.array_sort(F.collect_set("key")), 1, 3).alias("sample"),
            F.min_by("witness", F.when(F.col("witness").isNotNull(), F.col("key"))).alias("witness"),
            F.min(F.when(F.col("origin") == "vanilla", F.col("fr"))).alias("vanilla_fr"),
            F.min(F.when(F.col("origin") == "jar", F.col("fr"))).alias("jar_fr"),
        )
        .filter(F.col("n") >= least)
    )


def term_treatment(pairs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, kept, translated): invented words that some texts keep and others translate. pairs: key, en, fr."""
    ws = lambda c: F.regexp_extract_all(T.fold_mn(F.col(c)), F.lit("([a-z0-9]+)"), 1)
    rows = pairs.select("key", "fr", F.explode(F.array_distinct(ws("en"))).alias("term"), ws("fr").alias("fw")).join(listed(terms), "term")
    stays = T.survives(F.col("term"), F.col("fw"))
    out = rows.groupBy("term").agg(F.count_if(stays).alias("kept"), F.count_if(~stays).alias("translated"))
    return out.filter("kept > 0 and translated > 0")


# The words of each form of address.
FAMILIAR = r"(?iU)\b(?:tu|ton|ta|tes|toi|t'as)\b|\b\w+(?:es|is|ns)-tu\b"
FORMAL = r"(?iU)\b(?:vous|votre|vos)\b"


def register_mix(pairs: DataFrame) -> DataFrame:
    """(unit, familiar, formal): units that address the reader in both ways; the more even the mix, the higher."""
    out = pairs.groupBy("unit").agg(F.count_if(F.col("fr").rlike(FAMILIAR)).alias("familiar"), F.count_if(F.col("fr").rlike(FORMAL)).alias("formal"))
    return out.filter("familiar > 0 and formal > 0").orderBy(F.desc(F.least("familiar", "formal")), "unit")


def minority_texts(pairs: DataFrame) -> DataFrame:
    """(unit, register, key): in units that mix both forms of address, the texts in the rarer one; the formal one where they are even."""
    mixed = register_mix(pairs).select("unit", F.when(F.col("familiar") < F.col("formal"), "familiar").otherwise("formal").alias("register"))
    used = F.when(F.col("register") == "familiar", F.col("fr").rlike(FAMILIAR)).otherwise(F.col("fr").rlike(FORMAL))
    return pairs.join(mixed, "unit").filter(used).select("unit", "register", "key")


# --- revisions and provenance ------------------------------------------------------------------------------------------------


def revision_diff(before: DataFrame, after: DataFrame, unreadable: DataFrame) -> DataFrame:
    """(file, key, kind): accents, substance, appeared or disappeared; files that either side can't read are left out whole."""
    a = before.select("file", "key", F.col("value").alias("a")).join(unreadable.select("file"), "file", "left_anti")
    b = after.select("file", "key", F.col("value").alias("b")).join(unreadable.select("file"), "file", "left_anti")
    rows = a.join(b, ["file", "key"], "full")
    kind = (
        F.when(F.col("a").isNull(), "appeared")
        .when(F.col("b").isNull(), "disappeared")
        .when(F.col("a") == F.col("b"), None)
        .when(T.fold(F.col("a")) == T.fold(F.col("b")), "accents")
        .otherwise("substance")
    )
    return rows.select("file", "key", kind.alias("kind")).filter("kind is not null")


def provenance_classes(decided: DataFrame, said: DataFrame) -> DataFrame:
    """(key, class): how a decided value relates to the current text, in a fixed order of precedence."""
    rows = decided.join(said, "key", "left")
    a, b = F.col("decided"), F.col("fr")
    bare = lambda c: F.replace(F.replace(c, F.lit("œ"), F.lit("oe")), F.lit("Œ"), F.lit("Oe"))
    kind = (
        F.when(b.isNull(), "absent")
        .when(a == b, "equal")
        .when(T.blank(b), "blank")
        .when(bare(a) == bare(b), "ligature")
        .when(F.lower(a) == F.lower(b), "case")
        .when(T.fold(a) == T.fold(b), "accents")
        .otherwise("substance")
    )
    return rows.select("key", kind.alias("class"))


def key_liveness(keys: DataFrame, pack_text: DataFrame, jar_text: DataFrame) -> DataFrame:
    """(key, state): written out in the pack's text, in its jars' strings, by a prefix built at run time, or suspect.

    keys: key, prefix. pack_text and jar_text: word. Texts are cut to words that may be keys, so that liveness is an equi-join
    and not a search of every text for every key. Where keys may stand inside longer words, see contained_keys().
    """
    p, j = pack_text.select("word").distinct(), jar_text.select("word").distinct()
    rows = keys.join(p.select(F.col("word").alias("key"), F.lit(True).alias("in_pack")), "key", "left")
    rows = rows.join(j.select(F.col("word").alias("key"), F.lit(True).alias("in_jar")), "key", "left")
    rows = rows.join(j.select(F.col("word").alias("prefix"), F.lit(True).alias("built")), "prefix", "left")
    return rows.select("key", _state().alias("state"))


def _state():
    return F.when(F.col("in_pack"), "pack").when(F.col("in_jar"), "jar").when(F.col("built"), "prefix").otherwise("suspect")


#: Characters of the grams by which keys are looked for inside words.
GRAM = 3


def contained_keys(keys: DataFrame, words: DataFrame) -> DataFrame:
    """(key) of the keys that stand anywhere inside a word. keys: key; words: word.

    A word holds every gram of a key that it holds, so a key is looked up by the one of its grams that the fewest words have, and
    only then compared; keys shorter than a gram are looked up by their own length.
    """
    words = words.select("word").distinct()

    def grams(c, n: int):
        return F.array_distinct(F.transform(F.when(F.length(c) >= n, F.sequence(F.lit(1), F.length(c) - n + 1)).otherwise(F.array().cast("array<int>")), lambda i: F.substring(c, i, F.lit(n))))

    of_words = words.select("word", F.explode(grams(F.col("word"), GRAM)).alias("gram"))
    often = of_words.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    long = keys.filter(F.length("key") >= GRAM).select("key").distinct()
    each = long.select("key", F.explode(grams(F.col("key"), GRAM)).alias("gram")).join(often, "gram", "left")
    anchors = each.groupBy("key").agg(F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)), "gram")).alias("gram"))
    found = anchors.join(of_words, "gram").filter(F.contains("word", "key")).select("key").distinct()
    for n in range(1, GRAM):
        short = keys.filter(F.length("key") == n).select("key").distinct()
        found = found.unionByName(words.select(F.explode(grams(F.col("word"), n)).alias("key")).distinct().join(short, "key", "left_semi"))
    return found.unionByName(keys.filter("key = ''").select("key").distinct().join(words.limit(1), how="cross").select("key"))


def key_liveness_inside(keys: DataFrame, pack_text: DataFrame, jar_text: DataFrame) -> DataFrame:
    """key_liveness() with keys and prefixes found anywhere inside a word."""
    found = lambda ks, text, name: contained_keys(ks, text).withColumn(name, F.lit(True))
    rows = keys.join(found(keys.select("key"), pack_text, "in_pack"), "key", "left").join(found(keys.select("key"), jar_text, "in_jar"), "key", "left")
    prefixes = keys.select(F.col("prefix").alias("key")).filter("key is not null").distinct()
    rows = rows.join(found(prefixes, jar_text, "built").withColumnRenamed("key", "prefix"), "prefix", "left")
    return rows.select("key", _state().alias("state"))


def registrations(scripts: DataFrame, known: DataFrame) -> DataFrame:
    """(key, english): keys that scripts register and no language file has; English is the id in title case. scripts: path, source."""
    calls = F.regexp_extract_all("source", F.lit(r"""\.create\(\s*["']([a-z0-9_]+:[a-z0-9_/]+)["']"""), 1)
    kinds = F.regexp_extract_all("source", F.lit(r"""\.create\(\s*["'][a-z0-9_]+:[a-z0-9_/]+["']\s*(?:,\s*["']([a-z_]*)["'])?"""), 1)
    rows = scripts.select(F.explode(F.arrays_zip(calls.alias("id"), kinds.alias("kind"))).alias("x")).select("x.id", "x.kind").distinct()
    block = F.when(F.col("kind").isin("", "item"), "item").otherwise("block")
    rows = rows.select(F.concat(block, F.lit("."), F.translate("id", ":/", "..")).alias("key"), F.initcap(F.translate(F.element_at(F.split("id", "[:/]"), -1), "_", " ")).alias("english"))
    return rows.distinct().join(known.select("key"), "key", "left_anti")


def hardcoded(scripts: DataFrame, calls: str = r"Text\.of|Component\.literal|tell") -> DataFrame:
    """(path, line, text): string literals shown by scripts, once each."""
    lines = scripts.select("path", F.posexplode(F.split("source", "\n")).alias("n", "content"))
    found = F.regexp_extract_all("content", F.lit(rf"""(?:{calls})\(\s*["']([^"']+)["']"""), 1)
    return lines.select("path", (F.col("n") + 1).alias("line"), F.explode(found).alias("text")).distinct()


# --- renderings -----------------------------------------------------------------------------------------------------------

# Words that no rendering begins or ends with, the codes of texts, and what a word is.
STOP_EN = (
    "a an the of to in on at by for from with and or but not no is are be been was were it its this that these those you your can will may "
    "must if then than so as into onto up down out over under all any each every some more most less very also only just when while where "
    "which who what how there here they them their he she his her we our us i me my do does did done has have had get gets got make makes "
    "made use used using one two three four five six first second new other such both own same per via etc s t"
).split()
STOP_FR = (
    "le la les l un une des du de d à au aux en dans sur sous par pour avec et ou mais ne pas plus moins très aussi seulement quand lorsque "
    "où qui que quoi dont ce cet cette ces c se s son sa ses leur leurs il elle ils elles on tu te t toi ton ta tes vous votre vos nous notre "
    "nos je j me m mon ma mes y est sont être été était peut peuvent doit faire fait font a ont avoir tout tous toute toutes chaque autre "
    "autres même mêmes si alors comme ainsi ici là deux trois un une premier première nouveau nouvelle"
).split()
RENDERING_CODES = r"\$\([^)]*\)|§.|&[0-9a-fk-or]|%(?:\d+\$)?[sd]|\{[^}]*\}|<[^>]*>|\\n|\[[^\]]*\]\([^)]*\)"
RENDERING_WORD = "[A-Za-zÀ-ÿ]+(?:['-][A-Za-zÀ-ÿ]+)*"


def rendering_words(c, stem, stop: list[str], of_folded: bool = False):
    """Words of a text in small letters; all but stop words, folded or not, are stemmed. of_folded: the stem is that of the folded word."""
    found = F.regexp_extract_all(F.regexp_replace(F.coalesce(c, F.lit("")), RENDERING_CODES, " "), F.lit(f"({RENDERING_WORD})"), 1)
    word = lambda w, plain: F.when(w.isin(stop) | plain.isin(stop), w).otherwise(stem(plain if of_folded else w))
    # Words are folded all at once: they hold no space, and none is folded to nothing.
    words = lambda line: F.zip_with(F.split(line, " "), F.split(F.lower(F.translate(line, *T._FOLD_MN)), " "), word)
    return T.let(F.lower(F.array_join(found, " ")), lambda line: F.when(line == "", F.array().cast("array<string>")).otherwise(words(line)))


def text_grams(pairs: DataFrame, side: str) -> DataFrame:
    """(key, gram): the n-grams of one to three words of each text of one side (en, fr), once each. Texts are dealt to all tasks."""
    words = rendering_words(F.col("en"), T.stem_en, STOP_EN) if side == "en" else rendering_words(F.col("fr"), T.stem_folded_fr, STOP_FR, True)
    grams = F.array_distinct(T.ngrams(words, 3, STOP_EN if side == "en" else STOP_FR))
    return spread(pairs.select("key", side)).select("key", F.explode(grams).alias("gram"))


def held_terms(pairs: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """(key, term), staged: the terms that each English text holds; without terms, all its n-grams."""
    found = text_grams(pairs, "en").withColumnRenamed("gram", "term")
    return stage(found if terms is None else found.join(listed(terms.select("term")), "term", "left_semi").select("key", "term"), "held")


def associations(pairs: DataFrame, terms: DataFrame | None = None, least: int = 4, strength: float = 0.5) -> DataFrame:
    """(term, rendering, both, n_term, n_rendering): French n-grams at least `strength` of whose texts hold the English term.

    Terms (term, as n-grams are written) are all n-grams of `least` English texts or more, or those given. N-grams are worked out once
    for each side. Each text of a rendering is sent to it with the numbers of its terms, not a row for each pair, and only of those that
    have texts enough to go with the rendering.
    """
    return _associations(pairs, held_terms(pairs, terms), least, strength)


#: Texts of renderings that one task counts.
TEXTS_A_TASK = 100_000
#: Pairs of n-grams that are held at a time.
PAIRS_AT_ONCE = 1_000_000
#: Groups in which n-grams are numbered.
NUMBERED_IN = 1024


def _numbered(grams: DataFrame, name: str, least: int) -> DataFrame:
    """(the name's column, <name>_id, n_<name>), staged: the n-grams of `least` texts or more, with numbers."""
    counts = grams.groupBy(name).agg(F.count(F.lit(1)).alias(f"n_{name}")).filter(F.col(f"n_{name}") >= least)
    group = F.pmod(F.hash(name), F.lit(NUMBERED_IN))
    at = F.row_number().over(Window.partitionBy(group).orderBy(name)).cast("bigint")
    return stage(counts.withColumn(f"{name}_id", (at * NUMBERED_IN + group).cast("int")), name)


def _sent(batches):
    """Arrow batches (rendering_id, share, terms) from those of texts (renderings, terms): the terms of `share` texts or more."""

    def batch(rows):
        ids, shares, counts, terms = (np.concatenate(x) for x in zip(*rows))
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(terms, pa.int32()))
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(shares, pa.int64()), lists], ["rendering_id", "share", "terms"])

    rows, held = [], 0
    for b in batches:
        (r_at, r_id, share), (t_at, t_id, often) = ((c.offsets.to_numpy(), *(c.values.field(i).to_numpy() for i in (0, 1))) for c in (b.column("renderings"), b.column("terms")))
        for i in range(b.num_rows):
            order = np.argsort(-often[t_at[i] : t_at[i + 1]])
            terms, least = t_id[t_at[i] : t_at[i + 1]][order], -often[t_at[i] : t_at[i + 1]][order]
            step = max(1, PAIRS_AT_ONCE // max(1, len(terms)))
            for j in range(r_at[i], r_at[i + 1], step):
                ids, shares = r_id[j : min(j + step, r_at[i + 1])], share[j : min(j + step, r_at[i + 1])]
                counts = np.searchsorted(least, -shares, side="right")
                ids, shares, counts = ids[counts > 0], shares[counts > 0], counts[counts > 0]
                within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                rows.append((ids, shares, counts, terms[within]))
                held += len(within)
                if held >= PAIRS_AT_ONCE:
                    yield batch(rows)
                    rows, held = [], 0
    if held:
        yield batch(rows)


def _met(batches):
    """Arrow batches (rendering_id, term_id, both) from those of _sent() in the order of renderings: terms that `share` of the texts hold."""

    def batch(pairs, both):
        return pa.RecordBatch.from_arrays([pa.array(pairs >> 32, pa.int32()), pa.array(pairs & 0xFFFFFFFF, pa.int32()), pa.array(both, pa.int64())], ["rendering_id", "term_id", "both"])

    # What is left of the batch before: the counts of its last rendering, whose texts may go on.
    pairs, both, ids, shares = (np.zeros(0, np.int64) for _ in range(4))
    for b in batches:
        if not b.num_rows:
            continue
        terms = b.column("terms")
        own = b.column("rendering_id").to_numpy().astype(np.int64)
        at = terms.offsets.to_numpy()
        new, n = np.unique((np.repeat(own, np.diff(at)) << 32) | terms.values.to_numpy()[at[0] : at[-1]], return_counts=True)
        pairs, place = np.unique(np.concatenate((pairs, new)), return_inverse=True)
        both = np.bincount(place, np.concatenate((both, n))).astype(np.int64)
        ids, first = np.unique(np.concatenate((ids, own)), return_index=True)
        shares = np.concatenate((shares, b.column("share").to_numpy()))[first]
        done = pairs >> 32 < ids[-1]
        enough = done & (both >= shares[np.searchsorted(ids, pairs >> 32)])
        if enough.any():
            yield batch(pairs[enough], both[enough])
        pairs, both, ids, shares = pairs[~done], both[~done], ids[-1:], shares[-1:]
    if len(pairs) and (enough := both >= shares).any():
        yield batch(pairs[enough], both[enough])


def _associations(pairs: DataFrame, held: DataFrame, least: int, strength: float) -> DataFrame:
    often = _numbered(held, "term", least)
    grams = stage(text_grams(pairs, "fr").withColumnRenamed("gram", "rendering"), "grams")
    known = _numbered(grams, "rendering", least)
    texts = known.agg(F.coalesce(F.sum("n_rendering"), F.lit(0))).first()[0]
    # Both a term's texts and those that it shares with a rendering have to be so many.
    share = F.greatest(F.lit(least), F.ceil(strength * F.col("n_rendering"))).cast("bigint")
    t = held.join(listed(often), "term").groupBy("key").agg(F.collect_list(F.struct("term_id", "n_term")).alias("terms"))
    r = grams.join(listed(known), "rendering").groupBy("key").agg(F.collect_list(F.struct("rendering_id", share.alias("share"))).alias("renderings"))
    sent = r.join(t, "key").select("renderings", "terms").mapInArrow(_sent, "rendering_id int, share bigint, terms array<int>")
    dealt = sent.repartition(1 + texts // TEXTS_A_TASK, "rendering_id").sortWithinPartitions("rendering_id")
    both = stage(dealt.mapInArrow(_met, "rendering_id int, term_id int, both bigint"), "counts")
    return both.join(listed(known), "rendering_id").join(listed(often), "term_id").select("term", "rendering", "both", "n_term", "n_rendering")


def covers(term_texts: DataFrame, most: int = 4) -> DataFrame:
    """(term, rank, rendering, new): renderings of a term picked greedily by how many more of its texts they account for.

    term_texts: term, rendering, key. A pick depends on those before it, so there are `most` rounds: each counts, for all terms at
    once, the texts that every rendering still accounts for, and takes the texts of the best one away. Ties go to the rendering of
    more words, then to the first.
    """
    left = cut(term_texts.select("term", "rendering", "key").distinct())
    out = None
    for rank in range(1, most + 1):
        gains = left.groupBy("term", "rendering").agg(F.count(F.lit(1)).cast("int").alias("new"))
        order = F.struct(-F.col("new"), -F.size(F.split("rendering", " ")), "rendering")
        best = cut(gains.groupBy("term").agg(F.min_by(F.struct("rendering", "new"), order).alias("x")).select("term", F.lit(rank).alias("rank"), "x.rendering", "x.new"))
        out = best if out is None else out.unionByName(best)
        if best.isEmpty() or rank == most:
            break
        gone = left.join(best.select("term", "rendering"), ["term", "rendering"], "left_semi").select("term", "key")
        left = cut(left.join(gone, ["term", "key"], "left_anti"))
    return out


def renderings(pairs: DataFrame, terms: DataFrame, least: int = 4, strength: float = 0.5, most: int = 4) -> DataFrame:
    """(term, rank, rendering, new): how texts render the terms: associated n-grams, picked greedily by the texts that they account for."""
    en = held_terms(pairs, terms)
    found = stage(_associations(pairs, en, least, strength).select("term", "rendering"), "found")
    fr = text_grams(pairs, "fr").withColumnRenamed("gram", "rendering").join(listed(found.select("rendering").distinct()), "rendering", "left_semi")
    return covers(en.join(fr, "key").join(found, ["term", "rendering"], "left_semi").select("term", "rendering", "key"), most)
