"""Cutting lineage, and staging tables, in the folder that the cluster shares; and broadcasts of a checked size."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a rule table may have: it is broadcast, as rules are matched by pattern and not by key.
MOST_RULES = 10_000
#: Rows up to which a list of keys is broadcast; a longer one is joined by a shuffle.
MOST_KEYS = 200_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Only on one machine a temporary one stands in where none is named."""
    sc = spark.sparkContext
    have = sc._jsc.sc().getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None) or (have.get() if have.isDefined() else None)
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("name a folder that the cluster shares in spark.checkpoint.dir")
        named = tempfile.mkdtemp(prefix="textloom-")
    if not have.isDefined():
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """df, checkpointed in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def place(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read again."""
    path = place(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *by: str) -> DataFrame:
    """df, dealt evenly to as many tasks as the session has for a shuffle or runs at once: for costly work on rows that may lie in one file.

    Rows are dealt by columns where some are given, of which few rows may share a value; that saves sorting them.
    """
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), *by)


def rules(df: DataFrame, what: str) -> DataFrame:
    """A rule table, to be broadcast; an error if it has over MOST_RULES rows."""
    n = df.limit(MOST_RULES + 1).count()
    if n > MOST_RULES:
        raise ValueError(f"{what}: over {MOST_RULES} rules")
    return F.broadcast(df)


def listed(df: DataFrame) -> DataFrame:
    """A table to join by key: broadcast if it has at most MOST_KEYS rows."""
    return F.broadcast(df) if df.limit(MOST_KEYS + 1).count() <= MOST_KEYS else df


#: A key is hot if it holds over 1/HOT_SHARE of all rows, so there are never more than HOT_SHARE hot keys.
HOT_SHARE = 1000


def attach(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Inner join of rows with groups (one row a key, `size` its number of rows of `total`): hot keys are broadcast, the others shuffled."""
    hot = groups.filter(F.col(size) * HOT_SHARE > F.lit(total))
    cold = groups.filter(F.col(size) * HOT_SHARE <= F.lit(total))
    return rows.join(F.broadcast(hot), key).unionByName(rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key))
