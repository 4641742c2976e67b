"""Helpers that the training-data operators share: shared-folder tables, skew-proof joins, ASCII rules."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key is heavy if it holds over 1/HEAVY_SHARE of all rows, so there are never more than HEAVY_SHARE heavy keys.
HEAVY_SHARE = 1000

#: A list of ids is broadcast up to this many rows; a larger one is joined by a shuffle.
BROADCAST_ROWS = 500_000

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: bytes.translate table: A-Z to a-z, every other ASCII character but 0-9 and a-z to a space. UTF-8 bytes of other characters stay.
ALNUM_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares (spark.checkpoint.dir). Only on one machine a temporary one stands in where none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        have = spark.sparkContext._jsc.sc().getCheckpointDir()
        if have.isDefined():
            named = have.get()
        elif spark.sparkContext.master.startswith("local"):
            named = tempfile.mkdtemp(prefix="textloom-")
        else:
            raise ValueError("name a folder that the cluster shares in spark.checkpoint.dir")
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


#: Texts handed to a Python worker at once. Spark's default of 10,000 is meant for numbers; texts of that many rows fill buffers.
BATCH_ROWS = 2000


def small_batches(spark: SparkSession) -> None:
    """Set the session's Arrow batches for texts; the queries and the pipeline's stages call it, operators leave sessions alone."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def save(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts the lineage, and lost executors lose none of it."""
    spark, path = df.sparkSession, workspace(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def attach(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Inner join of rows with groups (one row a key, `size` its number of rows) that no hot key can upset.

    Keys with over total / HEAVY_SHARE rows, at most HEAVY_SHARE of them, are broadcast; the rest is joined by a shuffle.
    """
    heavy = groups.filter(F.col(size) * HEAVY_SHARE > F.lit(total))
    light = groups.filter(F.col(size) * HEAVY_SHARE <= F.lit(total))
    hot = rows.join(F.broadcast(heavy), key)
    cold = rows.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key)
    return hot.unionByName(cold)


def fresh(name: str, *tables: DataFrame) -> str:
    """A column name that none of the tables has, whatever the case of their letters."""
    taken = {c.lower() for t in tables for c in t.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def without_ids(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of docs whose id isn't in ids (one column). ids is broadcast only if it has at most BROADCAST_ROWS rows."""
    name = fresh("gone", docs)
    ids = save(ids.toDF(name), "ids")
    gone = F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids.hint("shuffle_hash")
    return docs.join(gone, docs[id_col] == F.col(name), "left_anti")
