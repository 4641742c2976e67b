"""WARC archives: written and read by Spark's text sink and source, with boundary-chain verification.

Writing: every record is one row, "WARC/1.1", headers, block, and the source's line separator is the blank lines that end a record,
so archives go to any file system that Spark writes to, a bounded number of records in each.

Reading: the archives are split at every occurrence of the magic, true or not, and tasks read any stretch of a file. Each occurrence
is a candidate record; its offset and declared length give the offset at which its successor has to start. From the start of each
file, pointer jumping (who is reached in 1, 2, 4, ... steps) marks the candidates that the chain reaches; only these are records,
so magic inside a payload is never taken for one. A record whose payload holds magic is put together from its pieces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import save, workspace

MAGIC, END = "WARC/1.1\r\n", "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "2000-01-01T00:00:00Z"
#: Records in an archive at most; payloads of fewer bytes are never revisits.
RECORDS, LEAST_BYTES = 20_000, 0
#: Repeated payloads are broadcast up to this many (a digest of 32 bytes and a number each); more are joined by a shuffle.
FIRST_ROWS = 100_000
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1: five hex digits are four base-32 digits."""
    digits = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def write_archives(pages: DataFrame, path: str, records: int = RECORDS, least: int = LEAST_BYTES) -> None:
    """One record per row of pages (page_id, url, html) in archives below path.

    Null html is an empty payload, null urls are left out, and line breaks in urls are escaped. Of equal payloads of at least
    `least` bytes the one of the smallest page_id is a response, the others are revisits that refer to it; rows that repeat the
    smallest page_id are responses too. Rows without an id are written without a record id; they are responses only if all of
    their payload's rows lack one.
    """
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("key", F.unhex(F.sha2(F.col("html").cast("binary"), 256)))
    first = rows.filter(F.octet_length("html") >= least).groupBy("key").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    first = save(first.filter("n > 1").select(F.col("key").alias("same"), "first"), "first-pages")
    # Only payloads that repeat are in `first`. Broadcast, they leave the pages where they are; a longer list is joined by a shuffle.
    first = F.broadcast(first) if first.count() <= FIRST_ROWS else first.hint("shuffle_hash")
    rows = rows.join(first, F.col("key") == F.col("same"), "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    block = F.when(revisit, F.lit("")).otherwise(F.concat(F.lit(HTTP), "html"))

    def header(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    def urn(c: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))

    record = F.concat(
        F.lit(MAGIC),
        header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        header("WARC-Record-ID", urn(F.col("page_id"))),
        header("WARC-Date", F.lit(DATE)),
        header("WARC-Target-URI", F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("html").cast("binary")))),
        header("WARC-Refers-To", F.when(revisit, urn(F.col("first")))),
        header("X-Payload-Length", F.octet_length("html").cast("string")),
        header("Content-Type", F.when(revisit, "application/octet-stream").otherwise("application/http; msgtype=response")),
        F.lit("Content-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(END),
        block,
    )
    rows.select(record.alias("value")).write.option("lineSep", END).option("maxRecordsPerFile", records).text(path)


# --- reading ---------------------------------------------------------------------------------------------------------------


def _field(name: str, value: str = "[^\r\n]*") -> Column:
    return F.nullif(F.regexp_extract("head", rf"(?m)^{name}:\x20*({value})\r?$", 1), F.lit(""))


def parsed(rows: DataFrame) -> DataFrame:
    """Adds what the headers say, the successor's distance from the record's start, and the payload's length and digest.

    value: what follows a magic. Where the headers give no length, there is no successor.
    """
    data = F.col("value").cast("binary")
    rows = rows.withColumn("head", F.substring_index("value", END, 1)).withColumn("at", F.octet_length("head") + len(END))
    length = _field("Content-Length", "[0-9]{1,15}").cast("bigint")
    rows = rows.withColumn("block_bytes", length).withColumn("size", len(MAGIC) + F.col("at") + F.col("block_bytes") + len(END))
    rows = rows.withColumn("block", F.substring(data, F.col("at") + 1, F.least("block_bytes", F.lit(2**31 - 1)).cast("int")))
    is_http = _field("Content-Type").startswith("application/http")
    http = F.octet_length(F.substring_index(F.col("block").cast("string"), END, 1)) + len(END)
    payload = F.when(is_http, F.substring(F.col("block"), http + 1, F.octet_length("block"))).otherwise(F.col("block"))
    rows = rows.withColumn("payload", payload)
    ids = r"<urn:page:-?[0-9]+>"
    return rows.select(
        *(c for c in rows.columns if c not in ("value", "head", "at", "block_bytes", "block", "payload")),
        _field("WARC-Type").alias("record_type"),
        F.regexp_extract(_field("WARC-Record-ID", ids), "-?[0-9]+", 0).cast("bigint").alias("page_id"),
        F.regexp_extract(_field("WARC-Refers-To", ids), "-?[0-9]+", 0).cast("bigint").alias("refers_to"),
        F.regexp_extract(_field("WARC-Payload-Digest"), "^sha1:([A-Z2-7]+)$", 1).alias("told_digest"),
        _field("X-Payload-Length", "[0-9]{1,15}").cast("bigint").alias("told_bytes"),
        F.octet_length("payload").cast("bigint").alias("read_bytes"),
        base32_sha1(F.col("payload")).alias("read_digest"),
    )


def stretches(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, nth, value, bytes) of every stretch between magics, the file's own beginning included."""
    rows = spark.read.option("lineSep", MAGIC).text(path)
    return rows.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("nth"),
        "value",
        (F.octet_length("value") + len(MAGIC)).cast("bigint").alias("bytes"),
    )


def placed(rows: DataFrame) -> DataFrame:
    """Adds start, the offset of the magic before each stretch (negative for a file's beginning). Sums run within one split, then over splits."""
    splits = rows.groupBy("file", "split").agg(F.sum("bytes").alias("total"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "split", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("file", "split").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("upto", F.coalesce(F.sum("bytes").over(within), F.lit(0)))
    return rows.join(splits, ["file", "split"]).withColumn("start", F.col("base") + F.col("upto") - len(MAGIC)).drop("base", "upto", "split", "nth")


def reached(nodes: DataFrame) -> DataFrame:
    """(file, start) of the candidates that the chain from the start of their file reaches. nodes: file, start, next."""
    ends = nodes.select(F.col("file").alias("f"), F.col("start").alias("s"))
    jump = save(nodes.join(ends, (F.col("file") == F.col("f")) & (F.col("next") == F.col("s"))).select("file", "start", F.col("next").alias("to")), "jump")
    seen = save(nodes.filter("start = 0").select("file", "start").distinct(), "seen")
    n = seen.count()
    while True:
        step = seen.join(jump, ["file", "start"]).select("file", F.col("to").alias("start"))
        seen = save(seen.unionByName(step).distinct(), "seen")
        more = seen.count()
        if more == n:
            return seen
        n = more
        on = jump.select(F.col("file").alias("f"), F.col("start").alias("s"), F.col("to").alias("far"))
        jump = save(jump.join(on, (F.col("file") == F.col("f")) & (F.col("to") == F.col("s"))).select("file", "start", F.col("far").alias("to")), "jump")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives below path: page_id, payload_bytes, payload_digest, record_type, refers_to, intact.

    A file that doesn't start with a record has none; what follows a broken or cut-off record isn't reached. The payload of a
    response is measured and digested as read, and intact tells whether the headers agree; of a revisit the headers count.
    """
    found = save(placed(parsed(stretches(spark, path))), "candidates")
    nodes = found.filter("start >= 0 and size is not null").select("file", "start", (F.col("start") + F.col("size")).alias("next"))
    chain = reached(nodes).select("file", "start", F.lit(True).alias("reached"))
    records = found.join(chain, ["file", "start"], "left").withColumn("next", F.when(F.col("reached"), F.col("start") + F.col("size")))
    whole = records.filter("reached and bytes = size").drop("reached")
    # Records with magic in their payloads: in the order of a file, every stretch belongs to the last record before it, up to its end.
    upto = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.last(F.when(F.col("reached"), F.struct("start", "next", (F.col("bytes") < F.col("size")).alias("parted"))), ignorenulls=True)
    owned = records.filter("start >= 0").select("file", F.col("start").alias("piece"), last.over(upto).alias("of"))
    owned = save(owned.filter("of.parted and piece < of.next").select("file", "piece", "of.start", "of.next"), "parted")
    if not owned.isEmpty():
        texts = placed(stretches(spark, path)).join(owned.select("file").distinct(), "file", "left_semi")
        pieces = texts.select("file", F.col("start").alias("piece"), "value").join(owned, ["file", "piece"])
        joined = pieces.groupBy("file", "start", "next").agg(F.array_sort(F.collect_list(F.struct("piece", "value"))).alias("p"))
        joined = joined.withColumn("value", F.array_join("p.value", MAGIC))
        # A last record that was cut off is shorter than it says.
        joined = joined.filter(F.octet_length("value") + len(MAGIC) >= F.col("next") - F.col("start"))
        whole = whole.unionByName(parsed(joined.select("file", "start", "next", "value")), allowMissingColumns=True)
    is_revisit = F.col("record_type") == "revisit"
    digest = F.when(is_revisit, F.col("told_digest")).otherwise(F.col("read_digest"))
    size = F.when(is_revisit, F.col("told_bytes")).otherwise(F.col("read_bytes"))
    return whole.select(
        "page_id",
        size.alias("payload_bytes"),
        digest.alias("payload_digest"),
        "record_type",
        "refers_to",
        ((digest == F.col("told_digest")) & (size == F.col("told_bytes"))).alias("intact"),
    )


def through_archives(pages: DataFrame) -> DataFrame:
    """Write pages to archives in the shared folder and read the records back; as many rows as pages has."""
    path = workspace(pages.sparkSession, "archives")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path)
