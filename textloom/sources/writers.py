"""Sinks: snapshots, review packets, reports and markdown; all written by Spark to any file system."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_snapshot(entries: DataFrame, path: str, version: int, complete: bool = True) -> None:
    """Entries by layer and locale, sorted by key, and a row of metadata."""
    entries.repartitionByRange("layer", "locale", "key").sortWithinPartitions("layer", "locale", "key").write.mode("overwrite").partitionBy("layer", "locale").parquet(f"{path}/entries")
    entries.sparkSession.createDataFrame([(version, complete)], "version int, complete boolean").write.mode("overwrite").json(f"{path}/meta")


#: What each reviewing net may see.
NETS = {"F1": ["id", "fr"], "F2": ["id", "en", "fr"], "judge": ["id", "en", "fr", "origin", "space"]}


def packets(texts: DataFrame, net: str, size: int) -> DataFrame:
    """texts in the columns that the net may see, with their packet's number within the zone, from 1."""
    from ..operators.changes import chunks

    columns = NETS[net]
    if lacking := [c for c in columns if c not in texts.columns]:
        raise ValueError(f"net {net} needs {lacking}")
    return chunks(texts, "id", size, by="zone").select("zone", (F.col("chunk") + 1).alias("packet"), *columns)


def write_packets(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").partitionBy("zone", "packet").json(path)


def glossary_markdown(glossary: DataFrame) -> DataFrame:
    """(place, line): a table per origin, terms by lower-case English and sense. place orders the lines."""
    from ..functions.text import readable_reason

    cell = lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit("|"), F.lit("\\|"))
    rows = glossary.select(
        F.struct(F.col("origin"), F.lit(1).alias("kind"), F.lower("en").alias("a"), F.coalesce("sense", F.lit("")).alias("b")).alias("place"),
        F.concat(F.lit("| "), F.concat_ws(" | ", cell(F.col("en")), cell(F.col("fr")), cell(F.col("sense")), cell(readable_reason(F.col("reason")))), F.lit(" |")).alias("line"),
    )
    heads = glossary.select("origin").distinct().select(
        F.struct(F.col("origin"), F.lit(0).alias("kind"), F.lit("").alias("a"), F.lit("").alias("b")).alias("place"),
        F.concat(F.lit("## "), F.col("origin"), F.lit("\n\n| English | French | Sense | Reason |\n|---|---|---|---|")).alias("line"),
    )
    return heads.unionByName(rows)


def kept_english(glossary: DataFrame) -> DataFrame:
    """(en, reason) of the terms kept in English."""
    from ..functions.text import readable_reason

    return glossary.filter("keep_english").select("en", readable_reason(F.col("reason")).alias("reason"))


def family_targets(names: DataFrame, definitions: DataFrame, namespace) -> DataFrame:
    """(key, file, expected): every project file that defines a family member, else the file of the key's own namespace."""
    rows = names.filter("expected is not null").join(definitions.filter("layer = 'project'").select("key", "file"), "key", "left")
    return rows.select("key", F.coalesce("file", namespace).alias("file"), "expected")


def stale_files(present: DataFrame, produced: DataFrame) -> DataFrame:
    """(file) of extracts that are no longer produced."""
    return present.join(produced.select("file"), "file", "left_anti")


# --- edits of files, planned as rows --------------------------------------------------------------------------------------------


def language_edits(files: DataFrame, edits: DataFrame) -> DataFrame:
    """(file, text, problem): each edited language file as it has to be written, keys in order, or why it mustn't be.

    files: file, text. edits: file, key, value; of several for one key, the one of the greatest ord counts. A file that can't be read,
    or that holds comments, which rewriting would lose, is refused; one that isn't there is made.
    """
    from .readers import parsed_map

    last = edits.groupBy("file", "key").agg(F.max_by("value", "ord").alias("value"))
    rows = last.select("file").distinct().join(files.select("file", "text", F.lit(True).alias("there")), "file", "left")
    strict, tolerant = parsed_map(F.col("text")), parsed_map(F.col("text"), tolerant=True)
    problem = F.when(F.col("there") & tolerant.isNull(), "unreadable").when(F.col("there") & strict.isNull(), "holds comments")
    # Entries are matched by a join: looking each of a file's keys up in a map of its edits takes the square of their number.
    old = rows.select("file", F.explode(F.map_entries(strict)).alias("e")).select("file", "e.key", F.to_json("e.value").alias("json"))
    new = last.select("file", "key", F.regexp_extract(F.to_json(F.to_variant_object(F.struct("value"))), r'(?s)^\{"value":(.*)\}$', 1).alias("json"))
    entries = old.join(last.select("file", "key"), ["file", "key"], "left_anti").unionByName(new)
    line = F.concat(F.lit("  "), F.regexp_extract(F.to_json(F.struct(F.col("key").alias("k"))), r'(?s)^\{"k":(.*)\}$', 1), F.lit(": "), "json")
    held = entries.select("file", F.struct("key", "json", line.alias("line")).alias("x")).groupBy("file").agg(F.array_sort(F.collect_list("x")).alias("x"))
    text = F.concat(F.lit("{\n"), F.array_join("x.line", ",\n"), F.lit("\n}\n"))
    return rows.select("file", problem.alias("problem")).join(held, "file").select("file", F.when(F.col("problem").isNull(), text).alias("text"), "problem")


def output_targets(outputs: DataFrame, targets: DataFrame) -> DataFrame:
    """(file, key, before, after, problem): what a batch's outputs put into their target files.

    outputs: file, key, en, fr, ord; targets: file, key, value. Outputs whose codes, blanks or number differ from the English are
    refused with the first reason; of several for one key the last counts; what the target already says is left out.
    """
    from ..functions.text import placeholder_verdicts

    last = outputs.groupBy("file", "key").agg(F.max_by(F.struct("en", "fr"), "ord").alias("x")).select("file", "key", "x.*")
    why = F.get(F.filter(placeholder_verdicts(F.col("en"), F.col("fr")), lambda c: c != "untranslated"), F.lit(0))
    rows = last.join(targets.select("file", "key", F.col("value").alias("before")), ["file", "key"], "left").withColumn("problem", why)
    return rows.filter("problem is not null or not (before <=> fr)").select("file", "key", "before", F.col("fr").alias("after"), "problem")


def review_edits(corrections: DataFrame, definitions: DataFrame) -> DataFrame:
    """(file, key, before, after, problem): a review's corrections in every file that defines the key, as long as the text is what was reviewed.

    corrections: key, before, after. definitions: file, key, value.
    """
    rows = corrections.select("key", F.col("before").alias("read"), "after").join(definitions, "key", "left")
    problem = F.when(F.col("file").isNull(), "unknown key").when(F.col("value") == F.col("after"), "done").when(F.col("value") != F.col("read"), "text has changed")
    return rows.select("file", "key", F.col("value").alias("before"), "after", problem.alias("problem"))


def arbitrated(outputs: DataFrame, rulings: DataFrame, kept: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(outputs with the rulings' texts in place of their own, the terms kept in English with those that the rulings add).

    outputs: key, fr. rulings: key, fr, keep_english (a term or null). kept: term.
    """
    fixed = outputs.join(rulings.filter("fr is not null").select("key", F.col("fr").alias("ruled")), "key", "left").select("key", F.coalesce("ruled", "fr").alias("fr"))
    return fixed, kept.select("term").unionByName(rulings.filter("keep_english is not null").select(F.col("keep_english").alias("term"))).distinct()


def traced(decisions: DataFrame, events: DataFrame, date: str) -> DataFrame:
    """decisions (key, seq, type, fr, date) with the events (key, type, fr, ord) after them, numbered on within each key; a repeat of
    a key's last text isn't a decision."""
    from pyspark.sql import Window

    last = decisions.groupBy("key").agg(F.max("seq").alias("upto"), F.max_by("fr", "seq").alias("said"))
    rows = events.join(last, "key", "left")
    by = Window.partitionBy("key").orderBy("ord")
    rows = rows.withColumn("said", F.coalesce(F.lag("fr").over(by), F.col("said"))).filter("not (said <=> fr)")
    new = rows.select("key", (F.coalesce("upto", F.lit(0)) + F.row_number().over(by)).cast("bigint").alias("seq"), "type", "fr", F.lit(date).alias("date"))
    return decisions.unionByName(new)
