"""Lots of actions applied as a whole: every action is judged against what is there now, and nothing is written if one is refused."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.lineage import stage
from ..sources.commits import Commits
from ..sources.json_edits import set_pointers
from ..sources.readers import lang_files
from ..sources.writers import language_edits
from .model import flatten_json, merge_layers

#: What a project consists of: its files, the decisions on its texts, and the verifier's ledgers.
TABLES: dict[str, tuple[str, list[str]]] = {
    "files": ("file string, text string", ["file"]),
    "decisions": ("key string, seq bigint, type string, lot string, fr string, reason string, question string, date string", ["key", "seq"]),
    "exceptions": ("control string, key string, object array<string>, reason string, question string, fingerprint string, date string, pin boolean", ["control", "key", "object"]),
    "generic": ("word string, reason string", ["word"]),
    "followups": ("control string, key string, object array<string>, reason string", ["control", "key", "object", "reason"]),
}
ACTION = "lot string, i int, type string, key string, control string, object array<string>, word string, space string, before string, after string, reason string, question string"


@dataclass(frozen=True)
class Layout:
    """Where a project's texts are. {ns}, {book} and {rest} are parts of the paths; a book's keys are <book>/<rest>#<pointer>."""

    language: str = "assets/{ns}/lang/fr_fr.json"
    book: str = "books/{book}/fr_fr/{rest}"
    journal: str = "journal/fr_fr.markdown"
    journal_key: str = "journal"

    def language_file(self, ns: Column) -> Column:
        before, after = self.language.split("{ns}")
        return F.concat(F.lit(before), ns, F.lit(after))

    def book_file(self, key: Column) -> Column:
        path = F.split(key, "#")[0]
        name = F.substring_index(path, "/", 1)
        return F.replace(F.replace(F.lit(self.book), F.lit("{book}"), name), F.lit("{rest}"), F.substring(path, F.length(name) + 2, F.length(path)))


def project(spark: SparkSession, root: str) -> Commits:
    return Commits(spark, root, TABLES)


@dataclass
class Plan:
    """actions: ACTION's columns with verdict (apply, done, refused), why, and the files that a correction is written to."""

    actions: DataFrame
    files: DataFrame
    layout: Layout
    refused: int = field(init=False)

    def __post_init__(self) -> None:
        self.refused = self.actions.filter("verdict = 'refused'").count()

    def edits(self) -> DataFrame:
        """(key, file, value, ord) of the corrections to be written."""
        rows = self.actions.filter("verdict = 'apply' and type = 'correction'")
        return rows.select("key", F.explode("targets").alias("file"), F.col("after").alias("value"), F.col("i").alias("ord"))


def _now(store: Commits, others: DataFrame, actions: DataFrame, layout: Layout) -> tuple[DataFrame, DataFrame]:
    """(key, value, origin, places array<struct<file, value>>, jar_ns) of what the actions' keys say now, and the files they stand in."""
    files = store.read("files")
    own = lang_files(files.filter(F.col("file").like(layout.language.replace("_", r"\_").replace("{ns}", "%"))), "project").filter("locale = 'fr_fr'")
    keys = actions.select("key").distinct()
    own = stage(own.join(keys, "key", "left_semi"), "own")
    others = others.join(keys, "key", "left_semi")
    last = F.max_by(F.struct("file", "value"), "ord")
    places = own.groupBy("key", "ns").agg(last.alias("x")).groupBy("key").agg(F.array_sort(F.collect_list("x")).alias("places"))
    merged = merge_layers(own.drop("file").unionByName(others.select("layer", "jar", "ns", "locale", "key", "value", "ord")), "fr_fr")
    jars = others.filter("layer = 'jar'").groupBy("key").agg(F.min_by("ns", F.struct("jar", "ns", "ord")).alias("jar_ns"))
    language = keys.filter(~F.col("key").contains("#")).join(merged.select("key", "value", "origin"), "key", "left").join(places, "key", "left").join(jars, "key", "left")
    pages = actions.filter(F.col("key").contains("#")).select("key").distinct().withColumn("file", layout.book_file(F.col("key"))).withColumn("pointer", F.concat(F.lit("/"), F.regexp_replace(F.split("key", "#")[1], "^/+|/+$", "")))
    leaves = flatten_json(files.join(pages.select("file").distinct(), "file", "left_semi"), "file", "text").select(F.col("id").alias("file"), "pointer", "value")
    book = pages.join(leaves, ["file", "pointer"], "left").select("key", "value", F.lit("book").alias("origin"), F.array(F.struct("file", "value")).alias("places"), F.lit(None).cast("string").alias("jar_ns"))
    journal = files.filter(F.col("file") == layout.journal).select(F.lit(layout.journal_key).alias("key"), F.col("text").alias("value"), F.lit("journal").alias("origin"), F.array(F.struct("file", F.col("text").alias("value"))).alias("places"), F.lit(None).cast("string").alias("jar_ns"))
    rows = language.filter(F.col("key") != layout.journal_key).unionByName(book).unionByName(journal)
    return stage(rows, "now"), files


def plan(store: Commits, actions: DataFrame, perimeter: DataFrame, others: DataFrame, layout: Layout = Layout()) -> Plan:
    """What becomes of each action of one lot. actions: ACTION. perimeter: key. others: the definitions of the layers below the project's.

    A correction is refused outside the perimeter, if an earlier one has its key, if its text is neither what it was written against nor
    already the new one, if it is the base game's, or if nobody knows where to write it; it goes to all files of the project that define
    the key otherwise, else to the namespace it names or the first jar's. A trace cites the text that its key will have after the lot, an
    exception without an object keeps that text's fingerprint, and a removal has to find its exception, which isn't pinned.
    """
    rows = actions.join(perimeter.select("key", F.lit(True).alias("inside")).distinct(), "key", "left")
    now, files = _now(store, others, actions, layout)
    rows = rows.join(now, "key", "left")
    fix = F.col("type") == "correction"
    nth = F.row_number().over(Window.partitionBy("key", "type").orderBy("i"))
    final = actions.filter(fix).groupBy("key").agg(F.min_by("after", "i").alias("final"))
    rows = rows.withColumn("nth", nth).join(final, "key", "left").withColumn("final", F.coalesce("final", "value"))
    rows = rows.withColumn("object", F.coalesce("object", F.array().cast("array<string>")))
    triple = ["control", "key", "object"]
    held = store.read("exceptions").select(*triple, F.struct("reason", "question", "fingerprint").alias("held"), F.coalesce("pin", F.lit(False)).alias("pin"))
    last = store.read("decisions").groupBy("key").agg(F.max_by(F.struct("lot", "fr"), "seq").alias("last"))
    known = store.read("generic").select("word", F.col("reason").alias("known"))
    sent = store.read("followups").withColumn("sent", F.lit(True))
    rows = rows.join(held, triple, "left").join(last, "key", "left").join(known, "word", "left").join(sent, [*triple, "reason"], "left")
    value, after, origin = F.col("value"), F.col("after"), F.coalesce("origin", F.lit("none"))
    behind = F.transform(F.filter("places", lambda p: ~p["value"].eqNullSafe(after)), lambda p: p["file"])
    ns = F.coalesce("space", "jar_ns")
    targets = (
        F.when(origin.isin("book", "journal"), F.transform("places", lambda p: p["file"]))
        .when(origin == "project", behind)
        .when(ns.isNotNull(), F.array(layout.language_file(ns)))
        .otherwise(F.array().cast("array<string>"))
    )
    done = value.eqNullSafe(after) & ((origin != "project") | (F.size(behind) == 0))
    print_of = F.when(F.size("object") == 0, T.fingerprint(F.coalesce("final", F.lit(""))))
    same = F.struct("reason", "question", print_of.alias("fingerprint")).eqNullSafe(F.col("held")) & ~F.coalesce("pin", F.lit(False))
    refusal = (
        F.when((F.col("type") != "generic") & F.col("inside").isNull(), "outside the perimeter")
        .when(~F.coalesce(F.col("type").isin("correction", "trace", "exception", "removal", "generic", "followup"), F.lit(False)), "unknown type")
        .when(fix & (F.col("nth") > 1), "key corrected twice")
        .when(fix & (origin == "book") & value.isNull(), "no text at the pointer")
        .when(fix & ~done & ~value.eqNullSafe(F.col("before")) & ~value.eqNullSafe(after), "text has changed")
        .when(fix & ~done & (origin == "vanilla"), "text of the base game")
        .when(fix & ~done & (F.size(targets) == 0), "no namespace to write to")
        .when((F.col("type") == "trace") & ~after.eqNullSafe(F.col("final")), "cites another text than the key will have")
        .when((F.col("type") == "removal") & F.col("pin"), "exception is pinned")
        .when((F.col("type") == "removal") & F.col("pin").isNull(), "no such exception")
    )
    finished = (
        F.when(fix, done)
        .when(F.col("type") == "trace", F.coalesce((F.col("last.lot") == F.col("lot")) & (F.col("last.fr") == after), F.lit(False)))
        .when(F.col("type") == "exception", same)
        .when(F.col("type") == "generic", F.col("known").eqNullSafe(F.col("reason")))
        .when(F.col("type") == "followup", F.col("sent").isNotNull())
        .otherwise(F.lit(False))
    )
    verdict = F.when(refusal.isNotNull(), "refused").when(finished, "done").otherwise("apply")
    kept = [c.split()[0] for c in ACTION.split(", ")]
    out = rows.select(*kept, verdict.alias("verdict"), F.coalesce(refusal, F.lit("")).alias("why"), F.when(fix & (verdict == "apply"), targets).alias("targets"), print_of.alias("fingerprint"))
    return Plan(stage(out, "plan"), files, layout)


class Refused(Exception):
    """A lot with refused actions is never written."""


def apply_plan(store: Commits, lot: str, planned: Plan, date: str) -> bool:
    """Write all of a plan in one commit; False if the lot is in already.

    Every file is written whole: language files with keys in order, books in their fields' order. A file that can't be edited refuses
    the lot. Corrections and traces become decisions after those that their keys have.
    """
    if planned.refused:
        raise Refused(f"{planned.refused} actions of {lot} are refused")
    layout, edits = planned.layout, planned.edits()
    book = F.col("key").contains("#")
    journal = F.col("key") == layout.journal_key
    language = language_edits(planned.files, edits.filter(~book & ~journal).select("file", "key", "value", "ord"))
    pages = set_pointers(planned.files, edits.filter(book).select("file", F.split("key", "#")[1].alias("pointer"), "value", "ord"))
    texts = edits.filter(journal).select("file", F.col("value").alias("text"), F.lit(None).cast("string").alias("problem"))
    files = stage(language.unionByName(pages).unionByName(texts), "files")
    if bad := files.filter("problem is not null").limit(3).collect():
        raise Refused(f"{lot}: {', '.join(f'{r.file}: {r.problem}' for r in bad)}")
    todo = planned.actions.filter("verdict = 'apply'")
    before = store.read("decisions").groupBy("key").agg(F.max("seq").alias("upto"))
    said = todo.filter("type in ('correction', 'trace')").join(before, "key", "left")
    nth = F.row_number().over(Window.partitionBy("key").orderBy((F.col("type") != "correction").cast("int"), "i"))
    kind = F.when(F.col("type") == "trace", "decision").otherwise("correction")
    decisions = said.select("key", (F.coalesce("upto", F.lit(0)) + nth).cast("bigint").alias("seq"), kind.alias("type"), "lot", F.col("after").alias("fr"), "reason", "question", F.lit(date).alias("date"))
    once = lambda rows, *by: rows.withColumn("nth", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("i")))).filter("nth = 1")
    exceptions = once(todo.filter("type = 'exception'"), "control", "key", "object").withColumns({"date": F.lit(date), "pin": F.lit(False)})
    changes = {"files": files, "decisions": decisions, "exceptions": exceptions, "generic": once(todo.filter("type = 'generic'"), "word"), "followups": once(todo.filter("type = 'followup'"), "control", "key", "object", "reason")}
    gone = todo.filter("type = 'removal'").select("control", "key", "object").distinct().join(exceptions.select("control", "key", "object"), ["control", "key", "object"], "left_anti")
    return store.commit(lot, changes, {"exceptions": gone})


def apply_lot(store: Commits, lot: str, actions: DataFrame, perimeter: DataFrame, others: DataFrame, date: str, layout: Layout = Layout()) -> Plan:
    """Plan a lot and write it, unless it is in already or an action is refused; the plan tells which."""
    planned = plan(store, actions.filter(F.col("lot") == lot), perimeter, others, layout)
    if not planned.refused:
        apply_plan(store, lot, planned, date)
    return planned
