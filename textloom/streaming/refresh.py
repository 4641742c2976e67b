"""Incremental refresh: new entry files update the key index; of the old ones, only the namespaces that they touch are read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lineage import listed
from ..operators.model import key_index


def refresh(spark: SparkSession, entries_path: str, schema, store: str, checkpoint: str) -> DataFrame:
    """Read the entry files below entries_path that the checkpoint hasn't seen, and index again only the namespaces that they touch.

    Earlier entries are read by partition, namespaces that no new file touches being pruned where they are few enough to list. The
    other namespaces' part of the index is copied to the new version. Entries are kept below store/entries by namespace, the index below store/index by version; a version that was cut short is
    written again from the same entries, since a batch's number names it. Returns the latest index.
    """

    def put(batch: DataFrame, n: int) -> None:
        path = f"{store}/entries/batch={n}"
        batch.write.mode("overwrite").partitionBy("ns").parquet(path)
        touched = spark.read.schema(batch.schema).option("basePath", f"{store}/entries").parquet(path).select("ns").distinct()
        known = [f"{store}/entries/batch={i}" for i in range(n + 1)]
        everything = spark.read.schema(batch.schema).option("basePath", f"{store}/entries").parquet(*known).select(*batch.columns)
        fresh = key_index(everything.join(listed(touched), "ns", "left_semi"))
        if n:
            old = spark.read.parquet(f"{store}/index/version={n - 1}")
            fresh = fresh.unionByName(old.join(listed(touched), "ns", "left_anti"))
        fresh.write.mode("overwrite").parquet(f"{store}/index/version={n}")

    stream = spark.readStream.schema(schema).parquet(entries_path)
    query = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    last = spark.read.parquet(f"{store}/index").agg(F.max("version")).first()[0]
    return spark.read.parquet(f"{store}/index/version={last}")


def last_by_event_time(events: DataFrame, key: str, ts: str, value: str, late: str = "1 hour") -> DataFrame:
    """(key, value): the latest value of each key in a stream; rows later than the watermark are dropped."""
    return events.withWatermark(ts, late).groupBy(key).agg(F.max_by(value, ts).alias(value))
