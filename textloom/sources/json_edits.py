"""Values put into nested JSON texts by pointer, as DataFrames: taken apart level by level, edited, and put together from the deepest level up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.lineage import spread, stage
from ..operators.model import parsed_json

#: Levels that are put together in one plan before the result is staged.
IN_ONE_PLAN = 4
CONTAINER = "kind in ('object', 'list')"


def quoted(text: Column) -> Column:
    """A text as a JSON string."""
    return F.regexp_extract(F.to_json(F.struct(text.alias("k"))), r'(?s)^\{"k":(.*)\}$', 1)


def _kind(value: Column) -> Column:
    held = F.schema_of_variant(value)
    return F.when(held.startswith("OBJECT"), "object").when(held.startswith("ARRAY"), "list").when(held == "STRING", "text").otherwise("other")


def _children(level: DataFrame) -> DataFrame:
    """(file, again, parent, at, ord, name, in_list, kind, raw) of what a level's containers hold, in the order of the text.

    raw is a container's own text, and for any other value how it is written. A tilde stands for itself as ~0, and a slash within a name
    as ~1, which no pointer has: such names can't be aimed at.
    """
    exploded = level.sparkSession.tvf.variant_explode(F.col("whole").outer())
    level = level.select("file", "again", "at", "kind", "raw", F.try_parse_json("raw").alias("whole"))
    fields = level.filter("kind = 'object'").withColumn("held", F.from_json("raw", "map<string,string>")).lateralJoin(exploded.toDF("pos", "name", "v"))
    fields = fields.select("file", "again", "at", (F.array_position(F.map_keys("held"), F.col("name")) - 1).cast("int").alias("ord"), "name", F.lit(False).alias("in_list"), "v", F.element_at("held", F.col("name")).alias("text"))
    cells = level.filter("kind = 'list'").withColumn("held", F.from_json("raw", "array<string>")).lateralJoin(exploded.toDF("ord", "none", "v"))
    cells = cells.select("file", "again", "at", "ord", F.col("ord").cast("string").alias("name"), F.lit(True).alias("in_list"), "v", F.get("held", F.col("ord")).alias("text"))
    kind = _kind(F.col("v"))
    raw = F.when(kind.isin("object", "list"), F.col("text")).otherwise(F.to_json("v"))
    path = F.concat("at", F.lit("/"), F.replace(F.replace("name", F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1")))
    return fields.unionByName(cells).select("file", "again", F.col("at").alias("parent"), path.alias("at"), "ord", "name", "in_list", kind.alias("kind"), raw.alias("raw"))


def taken_apart(files: DataFrame) -> list[DataFrame]:
    """The values of JSON texts by depth, each level staged. files: file, text; a text that isn't one JSON value has no level.

    Files are dealt to all tasks, as they may come from one: a level is read in as many tasks as the one above it was written by.
    again: whether the file stands there more than once.
    """
    again = F.count(F.lit(1)).over(Window.partitionBy("file")) > 1
    dealt = spread(files.select("file", "text"), "file").select("file", again.alias("again"), "text", parsed_json(F.col("text")).alias("v"))
    top = dealt.filter("v is not null").select(
        "file", "again", F.lit(None).cast("string").alias("parent"), F.lit("").alias("at"), F.lit(0).alias("ord"), F.lit("").alias("name"), F.lit(False).alias("in_list"), _kind(F.col("v")).alias("kind"), F.col("text").alias("raw")
    )
    levels, (level, _, left) = [], _counted(top)
    levels.append(level)
    while left:
        level, n, left = _counted(_children(level))
        levels += [level] * (n > 0)
    return levels


def _counted(level: DataFrame) -> tuple[DataFrame, int, int]:
    """A level, staged, with its number of rows and of containers, counted as it is written."""
    seen = Observation()
    staged = stage(level.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(F.expr(CONTAINER)).alias("containers")), "level")
    return staged, seen.get["n"], seen.get["containers"]


def put_together(levels: list[DataFrame], edits: DataFrame, indent: int) -> DataFrame:
    """(file, json): the texts of the levels, with the edits' values (file, at, value) in place of what stands there.

    Only texts and other plain values are looked up in the edits of their depth, and only containers in what they hold, without their own text.
    Where a file stands there more than once, what one of its lists holds comes once for each list at that place.
    """
    again = not levels[0].filter("again").isEmpty() if levels else False
    edits = edits.withColumn("depth", F.length("at") - F.length(F.replace("at", F.lit("/"))))
    inner = None
    for depth in reversed(range(len(levels))):
        here = levels[depth]
        margin, within = "\n" + " " * indent * depth, "\n" + " " * indent * (depth + 1)
        own = ["file", "parent", "ord", "name", "in_list"]
        plain = here.filter(f"not {CONTAINER}").join(edits.filter(F.col("depth") == depth).select("file", "at", "value"), ["file", "at"], "left")
        rows = plain.select(*own, F.when(F.col("value").isNotNull(), quoted(F.col("value"))).otherwise(F.col("raw")).alias("json"))
        containers = here.filter(CONTAINER).select(*own, "at", "kind")
        if inner is None:
            containers = containers.withColumn("cells", F.lit(None).cast("array<string>"))
        else:
            line = F.when(F.col("in_list"), F.col("json")).otherwise(F.concat(quoted(F.col("name")), F.lit(": "), F.col("json")))
            held = inner.groupBy("file", F.col("parent").alias("at")).agg(F.sort_array(F.collect_list(F.struct("ord", line.alias("line")))).alias("x"))
            containers = containers.join(held.select("file", "at", F.col("x.line").alias("cells")), ["file", "at"], "left")
        body = F.when(F.col("cells").isNull(), F.lit("")).otherwise(F.concat(F.lit(within), F.array_join("cells", "," + within), F.lit(margin)))
        json = F.when(F.col("kind") == "object", F.concat(F.lit("{"), body, F.lit("}"))).otherwise(F.concat(F.lit("["), body, F.lit("]")))
        inner = rows.unionByName(containers.select(*own, json.alias("json")))
        if depth and again:
            lists = levels[depth - 1].filter("kind = 'list'").select("file", F.col("at").alias("parent"), F.lit(True).alias("list"))
            inner = inner.join(lists, ["file", "parent"], "left").withColumn("in_list", F.col("list").isNotNull()).drop("list")
        if depth and depth % IN_ONE_PLAN == 0:
            inner = stage(inner, "built")
    if inner is None:
        raise ValueError("no levels")
    return inner.select("file", "json")


def set_pointers(files: DataFrame, edits: DataFrame, indent: int = 4) -> DataFrame:
    """(file, text, problem): each edited JSON file as it has to be written, fields in the order in which they stand, or why it mustn't be.

    files: file, text. edits: file, pointer, value; of several for one pointer the one of the greatest ord counts. A pointer goes through
    fields and places in lists (/pages/0/text) to a text that is there; one that misses, or that ends at anything but a text, refuses its
    file whole, as do a file that isn't there and one that isn't JSON. Everything else in a file is kept as a value: numbers may be
    written otherwise (1.50 as 1.5). Only edited files are read, and no file's values meet but those of one list or object.
    """
    pointer = F.concat(F.lit("/"), F.replace(F.regexp_replace("pointer", "^/+|/+$", ""), F.lit("~"), F.lit("~0")))
    wanted = stage(edits.groupBy("file", pointer.alias("at")).agg(F.max_by(F.coalesce("value", F.lit("")), "ord").alias("value")), "edits")
    there = files.join(wanted.select("file"), "file", "left_semi").select("file", "text")
    levels = taken_apart(there)
    texts = None
    for x in levels:
        found = x.filter("kind = 'text'").select("file", "at")
        texts = found if texts is None else texts.unionByName(found)
    met = wanted.select("file", "at").join(texts.withColumn("met", F.lit(True)), ["file", "at"], "left")
    asked = met.groupBy("file").agg(F.min(F.when(F.col("met").isNull(), F.col("at"))).alias("missed"))
    built = put_together(levels, wanted, indent)
    rows = asked.join(there.select("file", F.lit(True).alias("there")), "file", "left").join(built, "file", "left")
    problem = (
        F.when(F.col("there").isNull(), "no such file").when(F.col("json").isNull(), "unreadable").when(F.col("missed").isNotNull(), F.concat(F.lit("no text at "), F.replace("missed", F.lit("~0"), F.lit("~"))))
    )
    return rows.select("file", F.when(problem.isNull(), F.concat("json", F.lit("\n"))).alias("text"), problem.alias("problem"))
