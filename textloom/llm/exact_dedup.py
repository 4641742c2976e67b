"""Exact deduplication by stateful streaming, in DataFrame operations only.

Digests are staged as a slim table, which a streaming query folds into keyed state on disk (RocksDB, no expiry). The state
keeps the digest, the stable identifier of the row that stays and the locator of its content. Digests with more than one row are
hits; their full normalised bytes are then compared, and texts that share a digest but differ are told apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, attach, fresh, save, without_ids, workspace

BLANKS = r"[\x20\x09-\x0D]+"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def normalised(text: Column) -> Column:
    """The text without the characters of [\\x20\\x09-\\x0D]; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, "")


def sha256(norm: Column) -> Column:
    return F.sha2(norm.cast("binary"), 256)


def _best(*, points: str, doc_id: str, row: str, locator: str) -> Column:
    """The row that stays: most code points, then smallest doc_id (null last), then first row. ~x falls as x grows and can't overflow."""
    return F.max(
        F.struct(
            F.col(points).alias("points"),
            F.col(doc_id).isNotNull().alias("known"),
            F.bitwise_not(F.col(doc_id)).alias("low"),
            F.bitwise_not(F.col(row)).alias("early"),
            F.col(doc_id).alias("keep_id"),
            F.col(row).alias("keep_row"),
            F.col(locator).alias("locator"),
        )
    )


def fold_stream(spark: SparkSession, staged_path: str, schema, checkpoint: str, out: str) -> DataFrame:
    """Fold the files of staged_path that the checkpoint hasn't seen into the keyed state; returns the state's latest row of each digest.

    Call it again with the same checkpoint and out after more files came: known digests keep their state.
    """
    s = spark.newSession()
    # A state row is a few hundred bytes, so a quarter of the partitions that texts get is plenty; each has its own store and files.
    s.conf.set("spark.sql.shuffle.partitions", str(max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)))
    s.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    s.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    s.conf.set("spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true")
    s.conf.set("spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB", "96")
    s.conf.set("spark.sql.streaming.stateStore.maintenanceInterval", "10s")  # stores of a query that has ended are closed then
    s.conf.set("spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB", "8")
    s.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")  # else each partition's store reserves megabytes
    s.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    state = (
        s.readStream.schema(schema)
        .parquet(staged_path)
        .groupBy("text_sha256")
        .agg(F.count(F.lit(1)).alias("group_size"), _best(points="n_points", doc_id="doc_id", row="row_uid", locator="locator").alias("best"))
    )

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    query = state.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(put).start()
    query.awaitTermination()
    schema = "text_sha256 string, group_size bigint, best struct<points:int,known:boolean,low:bigint,early:bigint,keep_id:bigint,keep_row:bigint,locator:string>, batch int"
    rows = spark.read.schema(schema).option("recursiveFileLookup", "false").parquet(out)
    if rows.agg(F.countDistinct("batch")).first()[0] > 1:
        rows = rows.groupBy("text_sha256").agg(F.max_by(F.struct("group_size", "best"), "batch").alias("x")).select("text_sha256", "x.*")
    return rows.select("text_sha256", "group_size", "best.keep_id", "best.keep_row", "best.locator")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256, locator.

    Null texts count as empty, and empty texts are equal to each other and to blank ones. A null id is never preferred to another.
    Rows that tie on length and id are one document: the first stays, the others go. An empty table gives no rows. Columns of docs
    besides the two named are ignored, whatever their names. digest can be replaced (tests force collisions with a short one).
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("raw"))
    staged_path = workspace(spark, "digests")
    base.select(
        "doc_id",
        digest(normalised(F.col("raw"))).alias("text_sha256"),
        F.char_length("raw").alias("n_points"),
        F.monotonically_increasing_id().alias("row_uid"),
        F.input_file_name().alias("locator"),
    ).write.parquet(staged_path)
    schema = "doc_id bigint, text_sha256 string, n_points int, row_uid bigint, locator string"
    staged = spark.read.schema(schema).parquet(staged_path)
    total = staged.count()
    if not total:
        return staged.select(
            "doc_id", F.col("doc_id").alias("keep_id"), F.lit(0).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), "text_sha256", "locator"
        )
    state = fold_stream(spark, staged_path, schema, workspace(spark, "dedup-state"), workspace(spark, "dedup-out"))

    # Full bytes on hits: grouping compares the whole texts, and each task sends a text of a digest once.
    hits = state.filter("group_size > 1").select("text_sha256")
    hits = F.broadcast(hits) if hits.count() <= BROADCAST_ROWS else hits.hint("shuffle_hash")
    norm = base.select("doc_id", "raw", normalised(F.col("raw")).alias("norm")).withColumn("text_sha256", digest(F.col("norm")))
    texts = norm.join(hits, "text_sha256", "left_semi").groupBy("text_sha256", "norm").agg(F.count(F.lit(1)).alias("n"))
    split = save(texts.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("n_texts")).filter("n_texts > 1").select("text_sha256"), "collisions")
    if split.isEmpty():
        out = attach(staged.select("doc_id", "text_sha256", "row_uid", F.col("locator").alias("own")), state, "text_sha256", "group_size", total)
        return out.select(
            "doc_id", "keep_id", "group_size", (F.col("row_uid") == F.col("keep_row")).alias("kept"), "text_sha256", F.col("own").alias("locator")
        )

    # Digests of several texts: the same fold, keyed by the full text.
    ours = norm.withColumn("row_uid", F.monotonically_increasing_id()).withColumn("locator", F.input_file_name())
    ours = save(ours.join(split, "text_sha256", "left_semi").withColumn("n_points", F.char_length("raw")).drop("raw"), "collided")
    best = ours.groupBy("text_sha256", "norm").agg(
        F.count(F.lit(1)).alias("group_size"), _best(points="n_points", doc_id="doc_id", row="row_uid", locator="locator").alias("best")
    )
    told = ours.join(best, ["text_sha256", "norm"]).select(
        "doc_id", "best.keep_id", "group_size", (F.col("row_uid") == F.col("best.keep_row")).alias("kept"), "text_sha256", "locator"
    )
    plain = attach(
        staged.join(split, "text_sha256", "left_anti").select("doc_id", "text_sha256", "row_uid", F.col("locator").alias("own")),
        state,
        "text_sha256",
        "group_size",
        total,
    )
    return plain.select(
        "doc_id", "keep_id", "group_size", (F.col("row_uid") == F.col("keep_row")).alias("kept"), "text_sha256", F.col("own").alias("locator")
    ).unionByName(told)


def keep_first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, in its own columns, without the exact copies that exact_duplicates drops."""
    report = save(exact_duplicates(docs, id_col, text_col), "copies")
    odd = report.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 or doc_id is null")
    if odd.isEmpty():
        return without_ids(docs, report.filter("not kept").select("doc_id"), id_col)
    # Ids that repeat or are null don't name a row: take the digest along, and one of the rows that tie.
    an_id, sha, digest, points, most, of = (fresh(x, docs) for x in ("kept_id", "kept_sha", "digest", "points", "most", "of"))
    kept = report.filter("kept").select(F.col("doc_id").alias(an_id), F.col("text_sha256").alias(sha))
    keyed = docs.withColumn(digest, sha256(normalised(F.col(text_col))))
    found = keyed.join(kept, keyed[id_col].eqNullSafe(F.col(an_id)) & (F.col(digest) == F.col(sha)), "left_semi")
    found = found.withColumn(points, F.char_length(F.coalesce(F.col(text_col), F.lit(""))))
    longest = found.groupBy(F.col(digest).alias(of)).agg(F.max(points).alias(most))
    found = found.join(longest, (F.col(digest) == F.col(of)) & (F.col(points) == F.col(most)), "left_semi")
    return found.dropDuplicates([digest]).drop(digest, points)
