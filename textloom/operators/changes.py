"""Change sets: validation, planning against the current texts, and what reviews lead to. Nothing is written here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

MOST_ACTIONS = 150
TYPES = ("correction", "trace", "exception", "removal", "question")
WHOLE_TEXT_CONTROLS = ("spelling", "accents", "conventions", "decisions", "families", "glossary")


def lot_problems(actions: DataFrame) -> DataFrame:
    """(lot, i, problem) of malformed actions and oversized lots. actions: lot, i, type, key, before, after, reason, question."""
    size = F.count(F.lit(1)).over(Window.partitionBy("lot"))
    rows = actions.withColumn("n", size)
    cases = [
        F.when(F.col("n") > MOST_ACTIONS, "too many actions"),
        F.when(~F.coalesce(F.col("type").isin(*TYPES), F.lit(False)), "unknown type"),
        F.when(T.blank(F.col("key")), "no key"),
        F.when((F.col("type") == "correction") & F.col("after").isNull(), "no new text"),
        F.when(F.col("type").isin("correction", "exception") & T.blank(F.col("reason")), "no reason"),
        F.when((F.col("type") == "question") & T.blank(F.col("question")), "no question"),
    ]
    return rows.select("lot", "i", F.explode(F.array_compact(F.array(*cases))).alias("problem"))


def plan_lot(actions: DataFrame, perimeter: DataFrame, definitions: DataFrame) -> DataFrame:
    """Each action with what becomes of it: verdict (apply, done, refused), why, and the files to write.

    perimeter: lot, key. definitions: key, file, value, layer — every definition of a key. A correction needs a key of its perimeter,
    no other correction of that key in the lot, a text that isn't only the base game's, and a current text equal to what it was
    written against (or already the new one). All of the project's definitions are written; without one, the owner's file is.
    """
    inside = actions.join(perimeter.withColumn("inside", F.lit(True)), ["lot", "key"], "left")
    twice = F.count(F.when(F.col("type") == "correction", 1)).over(Window.partitionBy("lot", "key"))
    now = definitions.groupBy("key").agg(
        F.array_sort(F.collect_set(F.when(F.col("layer") == "project", F.col("file")))).alias("files"),
        F.min(F.when(F.col("layer") == "jar", F.col("file"))).alias("owner"),
        F.bool_and(F.col("layer") == "vanilla").alias("vanilla"),
        F.coalesce(F.max_by(F.when(F.col("layer") == "project", F.col("value")), F.when(F.col("layer") == "project", F.col("file"))), F.max_by("value", "file")).alias("value"),
    )
    rows = inside.withColumn("twice", twice).join(now, "key", "left")
    fix = F.col("type") == "correction"
    quotes = F.col("type").isin("trace", "exception")
    why = (
        F.when(F.col("inside").isNull(), "outside the perimeter")
        .when(fix & (F.col("twice") > 1), "key corrected twice")
        .when(fix & F.col("value").isNull(), "unknown key")
        .when(fix & F.col("vanilla"), "text of the base game")
        .when(fix & ~F.col("value").eqNullSafe(F.col("before")) & ~F.col("value").eqNullSafe(F.col("after")), "text has changed")
        .when(quotes & F.col("before").isNotNull() & ~F.col("value").eqNullSafe(F.col("before")), "quoted text isn't the key's")
    )
    verdict = F.when(why.isNotNull(), "refused").when(fix & F.col("value").eqNullSafe(F.col("after")), "done").otherwise("apply")
    files = F.when(verdict == "apply", F.when(F.size("files") > 0, F.col("files")).otherwise(F.array_compact(F.array("owner"))))
    return rows.select("lot", "i", "type", "key", verdict.alias("verdict"), F.coalesce(why, F.lit("")).alias("why"), F.when(fix, F.coalesce(files, F.array().cast("array<string>"))).otherwise(F.array().cast("array<string>")).alias("files"))


def safe_corrections(findings: DataFrame) -> DataFrame:
    """Findings whose expected text can be taken over as it is: the only one of their key, from a control that gives whole texts."""
    n = F.count(F.lit(1)).over(Window.partitionBy("key"))
    return findings.withColumn("n", n).filter((F.col("n") == 1) & F.col("control").isin(*WHOLE_TEXT_CONTROLS) & (F.col("expected") != "")).drop("n")


def selected(findings: DataFrame, controls: list[str] = (), keys: DataFrame | None = None, blocking: bool = False) -> DataFrame:
    """Findings of the controls or of the keys, perhaps only those that block."""
    rows = findings if keys is None else findings.join(keys.select("key", F.lit(True).alias("__k")).distinct(), "key", "left")
    wanted = F.col("control").isin(*controls) if controls else F.lit(False)
    if keys is not None:
        wanted = wanted | F.coalesce("__k", F.lit(False))
    rows = rows.filter(wanted)
    return (rows.filter("status = 'blocking'") if blocking else rows).select(*findings.columns)


def first_packet(groups: DataFrame, size: int) -> DataFrame:
    """(key, n, taken): whole groups in key order until one doesn't fit; the first group alone is cut to the size. groups: key, n.

    Running sums are taken within ranges of keys and then over the ranges, so no task sees all groups.
    """
    rows = groups.repartitionByRange("key").select("key", "n", F.spark_partition_id().alias("part")).sortWithinPartitions("key")
    before = rows.groupBy("part").agg(F.sum("n").alias("s")).withColumn("base", F.coalesce(F.sum("s").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    upto = F.sum("n").over(Window.partitionBy("part").orderBy("key"))
    rows = rows.withColumn("upto", upto).join(F.broadcast(before.select("part", "base")), "part").withColumn("total", F.col("base") + F.col("upto"))
    first = F.col("total") == F.col("n")
    return rows.filter((F.col("total") <= size) | first).select("key", "n", F.least("n", F.lit(size)).alias("taken"))


def chunks(rows: DataFrame, order: str, size: int, by: str | None = None) -> DataFrame:
    """rows with `chunk`, from 0: consecutive runs of `size` rows in the order, within each value of `by`."""
    w = (Window.partitionBy(by) if by else Window.partitionBy(F.lit(0))).orderBy(order)
    return rows.withColumn("chunk", F.floor((F.row_number().over(w) - 1) / size).cast("bigint"))


def actions_from_verdicts(verdicts: DataFrame, said: DataFrame) -> DataFrame:
    """(key, before, after, verdict): defects with a correction become actions; questions, stale and missing texts don't.

    verdicts: id, class, before, correction, questions. said: key, fr.
    """
    rows = verdicts.filter(F.col("class").isin("major", "minor")).join(said, F.col("id") == F.col("key"), "left")
    state = F.when(F.size("questions") > 0, "question").when(F.col("fr").isNull(), "missing").when(F.col("fr") != F.col("before"), "stale").when(T.blank(F.col("correction")), "no correction").otherwise("action")
    return rows.select(F.col("id").alias("key"), "before", F.col("correction").alias("after"), state.alias("verdict"))


def replaced_lines(text: Column, edits: Column) -> Column:
    """A text with numbered lines replaced; edits is a map line -> text, and lines beyond the text are ignored."""
    return F.array_join(F.transform(F.split(text, "\n"), lambda x, i: F.coalesce(F.try_element_at(edits, i + 1), x)), "\n")


def output_problems(expected: DataFrame, outputs: DataFrame) -> DataFrame:
    """(packet, id, problem): ids that a reviewer's output lacks, repeats or adds, or without what its class needs."""
    n = outputs.groupBy("packet", "id").agg(F.count(F.lit(1)).alias("n"), F.first("class").alias("class"), F.first("correction").alias("correction"), F.first("reason").alias("reason"))
    rows = expected.select("packet", "id", F.lit(True).alias("asked")).distinct().join(n, ["packet", "id"], "full")
    cases = [
        F.when(F.col("n").isNull(), "missing"),
        F.when(F.col("asked").isNull(), "not asked for"),
        F.when(F.col("n") > 1, "repeated"),
        F.when(F.col("n").isNotNull() & ~F.coalesce(F.col("class").isin("major", "minor", "correct"), F.lit(False)), "unknown class"),
        F.when(F.col("class").isin("major", "minor") & T.blank(F.col("correction")), "no correction"),
        F.when(F.col("class").isin("major", "minor") & T.blank(F.col("reason")), "no reason"),
    ]
    return rows.select("packet", "id", F.explode(F.array_compact(F.array(*cases))).alias("problem"))


def unproven(proofs: DataFrame, keys: DataFrame, lines: DataFrame) -> DataFrame:
    """Proofs that point to nothing. proofs: id, key, file, line; a proof names a key or a line of a file."""
    by_key = proofs.filter("key is not null").join(keys.select("key"), "key", "left_anti")
    by_line = proofs.filter("key is null").join(lines.select("file", "line"), ["file", "line"], "left_anti")
    return by_key.select("id", "key", "file", "line").unionByName(by_line.select("id", "key", "file", "line"))


def family_proposals(names: DataFrame, said: DataFrame, decided: DataFrame, limit: int | None = None) -> DataFrame:
    """(key, actual, expected, state): what a family's template would change: create, update, contrary (to a decision), too wide, same."""
    rows = names.filter("expected is not null").join(said.select("key", "fr"), "key", "left").join(decided, "key", "left")
    wide = F.lit(False) if limit is None else T.pixels(F.col("expected")) > limit
    state = (
        F.when(F.col("fr").eqNullSafe(F.col("expected")), "same")
        .when(F.col("decided").isNotNull() & (F.col("decided") != F.col("expected")), "contrary")
        .when(wide, "too wide")
        .when(T.blank(F.col("fr")), "create")
        .otherwise("update")
    )
    return rows.select("key", F.col("fr").alias("actual"), "expected", state.alias("state"))


def possible_agreements(votes: DataFrame) -> DataFrame:
    """(key, agreements): the (gender, number) pairs that every member allows. votes: key, member, allowed array<string>."""
    n = votes.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    shared = votes.select("key", "member", F.explode(F.array_distinct("allowed")).alias("a")).groupBy("key", "a").agg(F.count(F.lit(1)).alias("m"))
    kept = shared.join(n, "key").filter("m = n").groupBy("key").agg(F.array_sort(F.collect_list("a")).alias("agreements"))
    return n.select("key").join(kept, "key", "left").select("key", F.coalesce("agreements", F.array().cast("array<string>")).alias("agreements"))


def upsert_glossary(glossary: DataFrame, fixes: DataFrame) -> DataFrame:
    """glossary (en, sense, fr) after fixes of the same columns; near: another entry has the same English but for its case."""
    out = glossary.join(fixes.select("en", "sense"), ["en", "sense"], "left_anti").unionByName(fixes)
    forms = out.groupBy(F.lower("en").alias("low")).agg(F.count_distinct("en").alias("forms"))
    return out.join(forms, F.lower("en") == F.col("low")).select(*glossary.columns, (F.col("forms") > 1).alias("near"))


def lot_sample(actions: DataFrame, most: int = 30) -> DataFrame:
    """At most `most` actions of each lot, in the order of a hash seeded by the lot's id."""
    order = F.sha1(F.concat_ws("|", "lot", F.col("i").cast("string")).cast("binary"))
    return actions.withColumn("__n", F.row_number().over(Window.partitionBy("lot").orderBy(order, "i"))).filter(F.col("__n") <= most).drop("__n")
