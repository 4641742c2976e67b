"""Benchmark decontamination by a prefix-filtered set join.

Every item is cut into windows of consecutive words. A window's tokens are its shingles of two words (its single word, if it has
but one). Containment of a whole window needs every token, so one token is a sufficient prefix: the rarest over all documents. The
join looks up the documents' tokens among those prefixes; the token's place in the window gives the place where the window would
have to start; windows that would reach over either end of the document are dropped by length, and the rest is compared word for
word. Up to BLOCK windows are broadcast. Larger benchmarks are joined by a shuffle: only those of the documents' tokens that a bitmap of
the prefixes lets through are sent, each with the words around it, so that the comparison needs no second look at the documents.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM_TABLE, HEAVY_SHARE, fresh, save, without_ids

WINDOW = 13
#: Windows that are broadcast at most. A window has at most WINDOW words; words of over WORD_BYTES bytes are compared by their hash.
BLOCK = 50_000
WORD_BYTES = 64
#: Windows in one shuffled join at most; with more, the documents are read once more for each further so many.
SPREAD = 8_000_000
#: Bits of a bitmap of tokens at most (16 MB): two for each token, sixteen times as many bits as tokens where that fits.
BITMAP = 1 << 27
#: Parts that the windows of a hot token's occurrences are dealt to.
SALTS = 64


def words(text: str | None) -> list[bytes]:
    """Lower-cased ASCII words; other characters than ASCII's are word characters. Null has none."""
    return (text or "").encode("utf-8", "replace").translate(ALNUM_TABLE).split()


def short(word: bytes) -> bytes:
    """The word, or, where it is very long, a mark and its SHA-256: no word holds a space, so neither is taken for the other."""
    return word if len(word) <= WORD_BYTES else b" " + hashlib.sha256(word).digest()


def windows(item: list[bytes], n: int = WINDOW) -> list[tuple[bytes, ...]]:
    """Runs of n words; an item of fewer is one window, an item of none has none."""
    item = [short(w) for w in item]
    if len(item) <= n:
        return [tuple(item)] if item else []
    return [tuple(item[i : i + n]) for i in range(len(item) - n + 1)]


def tokens(window: tuple[bytes, ...]) -> list[tuple[bytes, ...]]:
    """Two-word shingles, by place; the word itself in a window of one."""
    return list(zip(window, window[1:])) if len(window) > 1 else [window]


def window_table(benchmark: DataFrame) -> DataFrame:
    """(item_id as text, words array<binary>): the distinct windows of each item, as a table in the shared folder."""

    def cut(batches):
        for batch in batches:
            ids, grams = [], []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for w in set(windows(words(text))):
                    ids.append(i)
                    grams.append(list(w))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(grams, pa.list_(pa.binary()))], ["item", "words"])

    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").mapInArrow(cut, "item string, words array<binary>")
    return save(rows.groupBy("words").agg(F.sort_array(F.collect_set("item")).alias("items")), "windows")


def rarity(docs: DataFrame, wanted) -> dict:
    """How often each wanted token stands in all documents. wanted is a broadcast set, so the result is no larger than it."""

    def count(batches):
        seen: dict = {}
        known = wanted.value
        single = {t[0] for t in known if len(t) == 1}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                doc = words(text)
                for t in zip(doc, doc[1:]):
                    if t in known:
                        seen[t] = seen.get(t, 0) + 1
                if single:
                    for w in doc:
                        if w in single:
                            seen[(w,)] = seen.get((w,), 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array([list(t) for t in seen], pa.list_(pa.binary())), pa.array(list(seen.values()), pa.int64())], ["token", "n"])

    rows = docs.select("text").mapInArrow(count, "token array<binary>, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    return {tuple(bytes(w) for w in r.token): r.n for r in rows.collect()}


def prefix_index(block: list[tuple[tuple[bytes, ...], list[str]]], freq: dict) -> dict:
    """token -> [(place of the token, window, items)]: each window under its rarest token (ties: the first by bytes, then place)."""
    index: dict = {}
    for window, items in block:
        _, token, place = min((freq.get(t, 0), t, i) for i, t in enumerate(tokens(window)))
        index.setdefault(token, []).append((place, window, items))
    return index


def occurrences(doc: list[bytes], index: dict, single: set) -> list[tuple[int, int, list[str]]]:
    """(start, end, items) of each occurrence of an indexed window in the words of a document."""
    found = []
    places = [(i, t) for i, t in enumerate(zip(doc, doc[1:])) if t in index]
    if single:
        places += [(i, (w,)) for i, w in enumerate(doc) if w in single]
    for i, token in places:
        for place, window, items in index[token]:
            start = i - place
            end = start + len(window)
            if start >= 0 and end <= len(doc) and tuple(doc[start:end]) == window:
                found.append((start, end, items))
    return found


OUT = "row bigint, doc_id bigint, n_words bigint, starts array<int>, ends array<int>, items array<string>"


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of docs: a row number, doc_id, n_words, the hit stretches (starts, ends; by word) and the items found."""
    table = window_table(benchmark)
    n = table.count()
    if n <= BLOCK:
        return _scan(docs, table)
    return _joined(docs, table, n)


def _scan(docs: DataFrame, table: DataFrame) -> DataFrame:
    """All windows, broadcast, against all documents."""
    spark = docs.sparkSession
    block = [(tuple(bytes(w) for w in r.words), r["items"]) for r in table.collect()]  # BLOCK rows at most
    wanted = spark.sparkContext.broadcast({t for w, _ in block for t in tokens(w)})
    index = spark.sparkContext.broadcast(prefix_index(block, rarity(docs, wanted) if block else {}))

    def run(batches):
        found = index.value
        single = {t[0] for t in found if len(t) == 1}
        for batch in batches:
            cols: list[list] = [[] for _ in range(6)]
            for row, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                doc = words(text)
                if max(map(len, doc), default=0) > WORD_BYTES:
                    doc = [short(w) for w in doc]
                hits = occurrences(doc, found, single)
                starts, ends = merge([(s, e) for s, e, _ in hits])
                for c, v in zip(cols, (row, doc_id, len(doc), starts, ends, sorted({i for _, _, items in hits for i in items}))):
                    c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["row", "doc_id", "n_words", "starts", "ends", "items"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, OUT)


# --- benchmarks too large to broadcast ---------------------------------------------------------------------------------------


def hashed(doc: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every two-word token, by place, and of every single word. Tokens that share one cost a comparison each."""
    h = np.fromiter((xxhash.xxh64_intdigest(w) for w in doc), np.uint64, len(doc))
    pair = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ ((h[1:] << np.uint64(27)) | (h[1:] >> np.uint64(37)))
    return (pair ^ (pair >> np.uint64(29))).view(np.int64), (h * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)


def token_hashes(window: list[bytes]) -> np.ndarray:
    """The hashes of tokens(window)."""
    pairs, single = hashed(window)
    return pairs if len(window) > 1 else single


class Bitmap:
    """Tells of most tokens that they aren't in a table. Its size doesn't exceed BITMAP bits, whatever the table's."""

    def __init__(self, table: DataFrame, n: int):
        self.bits = min(BITMAP, max(1 << 15, 1 << (16 * n).bit_length()))
        low = F.col("token").bitwiseAND(F.lit(self.bits - 1))
        high = F.shiftrightunsigned("token", 32).bitwiseAND(F.lit(self.bits - 1))
        place = table.select(F.explode(F.array(low, high)).alias("p")).select((F.col("p") + 1).alias("p"))
        rows = place.groupBy(F.bitmap_bucket_number("p").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("m")).collect()
        data = np.zeros(self.bits // 8, np.uint8)
        for r in rows:
            at = (r.b - 1) * 4096
            data[at : at + 4096] = np.frombuffer(bytes(r.m), np.uint8)[: len(data) - at]
        self.data = data

    def may_hold(self, token: np.ndarray) -> np.ndarray:
        token, out = token.view(np.uint64), np.ones(len(token), bool)
        for place in (token, token >> np.uint64(32)):
            place = (place & np.uint64(self.bits - 1)).astype(np.int64)
            out &= (self.data[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
        return out


def _doc_words(text: str | None) -> list[bytes]:
    return [short(w) for w in words(text)]


def prefixes(docs: DataFrame, table: DataFrame, n: int) -> DataFrame:
    """(token, place, words, items, n): each window under its rarest token over all documents, which stands n times in them."""
    spark = docs.sparkSession

    def expand(batches):
        for batch in batches:
            lists = [token_hashes(w) for w in batch.column(1).to_pylist()]
            sizes = [len(x) for x in lists]
            ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), sizes)
            place = np.concatenate([np.arange(0)] + [np.arange(k) for k in sizes])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(np.concatenate([np.zeros(0, np.int64), *lists])), pa.array(place, pa.int32())], ["id", "token", "place"])

    table = save(table.withColumn("id", F.monotonically_increasing_id()), "numbered")
    each = save(table.select("id", "words").mapInArrow(expand, "id bigint, token bigint, place int"), "tokens")
    wanted = spark.sparkContext.broadcast(Bitmap(each, WINDOW * n))

    def count(batches):
        for batch in batches:
            found = [np.concatenate(hashed(_doc_words(t))) for t in batch.column(0).to_pylist()]
            token, seen = np.unique(np.concatenate([np.zeros(0, np.int64), *found]), return_counts=True)
            ok = wanted.value.may_hold(token)
            yield pa.RecordBatch.from_arrays([pa.array(token[ok]), pa.array(seen[ok])], ["token", "n"])

    often = docs.select("text").mapInArrow(count, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    # A token of many windows meets one row of its count, so the join is pre-aggregated on the side that repeats.
    mine = each.select("token").distinct().join(often, "token", "left").select("token", F.coalesce("n", F.lit(0)).alias("n"))
    rarest = each.join(mine, "token").groupBy("id").agg(F.min(F.struct("n", "token", "place")).alias("x")).select("id", "x.*")
    return save(rarest.join(table, "id").select("token", "place", "words", "items", "n"), "prefixes")


def _joined(docs: DataFrame, table: DataFrame, n: int) -> DataFrame:
    """All windows against all documents by shuffled joins of at most SPREAD windows (on average, by hash) each."""
    spark = docs.sparkSession
    blocks = -(-n // SPREAD)
    docs = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    if blocks > 1:
        docs = save(docs, "rows")  # every join has to number the rows alike
    found = None
    for k in range(blocks):
        part = table.filter(F.pmod(F.xxhash64("words"), F.lit(blocks)) == k) if blocks > 1 else table
        hits, rows = _block(spark, docs, part, -(-n // blocks))
        found = hits if found is None else found.unionByName(hits)
    by_row = found.groupBy("row").agg(
        F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("s"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items")
    )
    none = F.array().cast("array<int>")
    return rows.join(by_row, "row", "left").select(
        "row",
        "doc_id",
        "n_words",
        F.coalesce("s.start", none).alias("starts"),
        F.coalesce("s.stop", none).alias("ends"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def _block(spark, docs: DataFrame, table: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """(hits: row, start, stop, items; rows: row, doc_id, n_words). docs: row, doc_id, text."""
    index = prefixes(docs, table, n)
    each = index.groupBy("token").agg(F.max("n").alias("n"))
    total = each.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # Occurrences of the hot tokens, HEAVY_SHARE at most, are dealt to SALTS parts, and their windows go to each.
    hot = [r.token for r in each.filter(F.col("n") * HEAVY_SHARE > F.lit(total)).collect()]
    shared = spark.sparkContext.broadcast((Bitmap(index, n), np.array(sorted(hot), np.int64)))
    schema = "row bigint, doc_id bigint, n_words bigint, token bigint, salt int, at int, left int, around array<binary>"

    def run(batches):
        bitmap, hot = shared.value
        for batch in batches:
            cols: list[list] = [[] for _ in range(8)]
            for row, doc_id, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                doc = _doc_words(text)
                for c, v in zip(cols, (row, doc_id, len(doc), None, 0, None, None, None)):
                    c.append(v)
                for kind in hashed(doc):
                    for at in np.flatnonzero(bitmap.may_hold(kind)).tolist():
                        first = max(0, at - WINDOW + 1)
                        token = int(kind[at])
                        salt = (row + at) % SALTS if len(hot) and hot[min(np.searchsorted(hot, token), len(hot) - 1)] == token else 0
                        for c, v in zip(cols, (row, None, len(doc), token, salt, at, at - first, doc[first : at + WINDOW])):
                            c.append(v)
                if len(cols[0]) > 20_000:
                    yield _batch(cols)
                    cols = [[] for _ in range(8)]
            yield _batch(cols)

    rows = save(docs.mapInArrow(run, schema), "occurrences")
    salts = F.when(F.col("token").isin(hot), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))) if hot else F.array(F.lit(0))
    windows_ = index.select("token", "place", "words", "items", F.explode(salts).alias("salt"))
    size = F.size("words")
    hits = (
        rows.filter("token is not null")
        .join(windows_, ["token", "salt"])
        .filter((F.col("left") >= F.col("place")) & (F.col("at") - F.col("place") + size <= F.col("n_words")))
        .filter(F.slice("around", F.col("left") - F.col("place") + 1, size) == F.col("words"))
        .select("row", (F.col("at") - F.col("place")).alias("start"), (F.col("at") - F.col("place") + size).alias("stop"), "items")
    )
    return hits, rows.filter("token is null").select("row", "doc_id", "n_words")


def _batch(cols: list[list]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.binary()))
    names = ["row", "doc_id", "n_words", "token", "salt", "at", "left", "around"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)


def merge(stretches: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Union of half-open stretches, as starts and ends."""
    starts: list[int] = []
    ends: list[int] = []
    for s, e in sorted(stretches):
        if starts and s <= ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    return starts, ends


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Null and wordless texts have no words and no hits; so have null and wordless items. Items whose id is null mark words but are
    not listed. Repeated rows are judged alike, and an item that repeats counts once. An empty benchmark hits nothing.
    """
    spans = F.array_sort(F.arrays_zip("starts", "ends"))
    # Stretches may overlap: count the words beyond the furthest end so far.
    n_hit = F.aggregate(
        spans,
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("upto")),
        lambda a, x: F.struct(
            (a["n"] + F.greatest(F.lit(0), x["ends"] - F.greatest(x["starts"], a["upto"]))).alias("n"), F.greatest(a["upto"], x["ends"]).alias("upto")
        ),
        lambda a: a["n"],
    )
    return (
        matches(docs, benchmark)
        .withColumn("n_hit", n_hit)
        .select(
            "doc_id",
            "n_words",
            "n_hit",
            F.size("items").cast("bigint").alias("n_items"),
            F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
            ((F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))).alias("contaminated"),
        )
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs, in its own columns, without the documents that contamination() marks. Rows without an id stay or go by their texts too."""
    report = save(contamination(docs.select("doc_id", "text"), benchmark), "contamination")
    bad = report.filter("contaminated")
    if bad.filter("doc_id is null").isEmpty() and bad.join(report.filter("not contaminated"), "doc_id", "left_semi").isEmpty():
        return without_ids(docs, bad.select("doc_id").distinct())
    # An id that names both kinds of rows, or none, doesn't tell them apart: judge each distinct text, under the number of its row.
    sha = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    texts = save(docs.select("text").withColumn("sha", sha).dropDuplicates(["sha"]).withColumn("doc_id", F.monotonically_increasing_id()), "texts")
    marked = contamination(texts.select("doc_id", "text"), benchmark).filter("contaminated").select("doc_id").join(texts.select("doc_id", "sha"), "doc_id")
    gone = fresh("sha", docs)
    return docs.join(marked.select(F.col("sha").alias(gone)), sha == F.col(gone), "left_anti")
