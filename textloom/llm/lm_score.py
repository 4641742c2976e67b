"""Language-model scoring by partial matching (PPM, escape method C with symbol exclusion), pretrained on the corpus.

The byte-context trie holds how often each byte follows each context of `order` bytes in the training texts; a text starts after
`order` marks and ends with one (0xFF, which UTF-8 never uses). Its nodes are rows of a table that grows with the corpus: counting is
one pass with a sum per node, and shorter contexts are sums of longer ones. Each context's distribution follows from its node and
the nodes of its shorter contexts: a byte that the longest context hasn't seen costs the escape probability, and bytes that a longer
context has seen are excluded from the shorter ones. Contexts that end in the same LOCAL bytes lie in one partition, so all their
levels are summed there; the levels below are at most 256^LOCAL numbers and are broadcast. Nodes that make up over 1/HEAD_NODES of
the training bytes (so never more than HEAD_NODES) are broadcast with their code lengths, all others are joined.

Beside it stands the unigram base: counts of all training tokens. Words that make up over 1/HEAD_SHARE of the tokens, those of held-out
texts included (so never more than HEAD_SHARE words), are broadcast; all others are joined by word, and no such word is hot.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import save

MARK = 0xFF
HEAD_SHARE = 100_000
HEAD_NODES = 1 << 22
#: Bytes of context: those that the query scores with, and those that decide a node's partition.
ORDER, LOCAL = 5, 3
#: Distinct words and trie nodes that a task holds before it sends their counts on; bytes that are counted or scored at once.
HELD, HELD_NODES, AT_ONCE = 200_000, 2_000_000, 4_000_000
#: Words of over this many bytes are counted under their SHA-256.
WORD_BYTES = 64
END = b""
#: Keys of trie nodes begin with a space and are two bytes longer than the context (at most 6); no word holds a space.
NODE, LONG_WORD, ROW = b" ", b"  ", b"   "
#: Before words that are frequent in the held-out texts of a task; longer than any node's key.
HEARD = b" " * 10


def tokens(text: str) -> list[bytes]:
    """Words, then the end."""
    words = [w if len(w) <= WORD_BYTES else LONG_WORD + hashlib.sha256(w).digest() for w in text.encode("utf-8", "replace").lower().split()]
    words.append(END)
    return words


def codes(text: str, order: int = 2) -> np.ndarray:
    """Each byte of the text and its end mark as the low byte of a number, above it its context, the nearest byte highest."""
    b = np.frombuffer(bytes([MARK] * order) + text.encode("utf-8", "replace") + bytes([MARK]), np.uint8).astype(np.int64)
    c = b[order:].copy()
    for k in range(1, order + 1):
        c |= b[order - k : len(b) - k] << (8 * (order + 1 - k))
    return c


def shorter(code: np.ndarray) -> np.ndarray:
    """The codes without the farthest byte of their contexts."""
    return (code >> 16 << 8) | (code & 255)


def keys(code: np.ndarray, order: int) -> pa.Array:
    """The keys of trie nodes."""
    raw = np.empty((len(code), order + 2), np.uint8)
    raw[:, 0] = NODE[0]
    raw[:, 1:] = code.astype(">i8").view(np.uint8).reshape(-1, 8)[:, 7 - order :]
    ends = np.arange(len(code) + 1, dtype=np.int32) * (order + 2)
    return pa.Array.from_buffers(pa.binary(), len(code), [None, pa.py_buffer(ends), pa.py_buffer(raw)])


def codes_of(found: pa.Array | pa.ChunkedArray, order: int) -> np.ndarray:
    """The codes of trie nodes' keys."""
    raw = np.frombuffer(b"".join(found.to_pylist()), np.uint8).reshape(-1, order + 2)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 7 - order :] = raw[:, 1:]
    return wide.view(">i8").ravel().astype(np.int64)


def summed(code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, and the sum of n of each."""
    found, at = np.unique(code, return_inverse=True)
    return found, np.bincount(at, weights=n, minlength=len(found)).astype(np.int64)


def counts(docs: DataFrame, order: int) -> DataFrame:
    """(key, n) of every token of the training texts and of every trie node (NODE, context and byte) of all texts.

    Nodes that only held-out texts have are there with an n of 0: their code lengths are asked for. Words of held-out texts stand
    under HEARD if they are over 1/HEAD_SHARE of those of a task; a word that is so in all such texts is so in some task.
    """

    def run(batches):
        words: Counter = Counter()
        heard: Counter = Counter()
        none = np.zeros(0, np.int64)
        nodes, pending, size = (none, none), ([], []), 0

        def grouped():
            seen = [np.unique(np.concatenate([none, *x]), return_counts=True) for x in pending]
            for x in pending:
                x.clear()
            parts = [nodes, seen[0], (seen[1][0], np.zeros(len(seen[1][0]), np.int64))]
            return summed(np.concatenate([x for x, _ in parts]), np.concatenate([n for _, n in parts]))

        def out(key, n):
            return pa.RecordBatch.from_arrays([key, pa.array(n, pa.int64())], ["key", "n"])

        def frequent():
            least = heard.total() / HEAD_SHARE
            found = {HEARD + w: n for w, n in heard.items() if n > least}
            heard.clear()
            return out(pa.array(list(found), pa.binary()), list(found.values()))

        for batch in batches:
            for held, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = t.as_py() or ""
                pending[held].append(codes(text, order))
                size += len(pending[held][-1])
                if size > AT_ONCE:
                    nodes, size = grouped(), 0
                if len(nodes[0]) > HELD_NODES:
                    yield out(keys(nodes[0], order), nodes[1])
                    nodes = (none, none)
                if held:
                    heard.update(tokens(text))
                    if len(heard) > HELD:
                        yield frequent()
                    continue
                words.update(tokens(text))
                if len(words) > HELD:
                    yield out(pa.array(list(words), pa.binary()), list(words.values()))
                    words = Counter()
        nodes = grouped()
        yield frequent()
        yield out(pa.array(list(words), pa.binary()), list(words.values()))
        yield out(keys(nodes[0], order), nodes[1])

    rows = docs.select("held_out", "text").mapInArrow(run, "key binary, n bigint")
    return save(rows.groupBy("key").agg(F.sum("n").alias("n")), "counts")


def distributions(follow: np.ndarray, order1: np.ndarray, order0: np.ndarray) -> np.ndarray:
    """log10 probabilities (contexts x 256) from the counts of each context, of its shorter context and of the empty context.

    The dense form for contexts of two bytes, which code_lengths() is held against.

    Method C: a context with total t and d distinct bytes gives a byte n / (t + d) and the escape d / (t + d); counts of excluded
    bytes are left out of t and d. A context that has seen nothing beyond the excluded bytes escapes at no cost, and one that
    leaves no byte to escape to gives its bytes n / t. Beyond the empty context the bytes that are left are alike.
    """
    p = np.zeros((len(follow), 256))
    mass = np.ones((len(follow), 1))
    free = np.ones((len(follow), 256), bool)
    for level in (follow, np.broadcast_to(order1, follow.shape), np.broadcast_to(order0, follow.shape)):
        n = np.where(free, level, 0).astype(np.float64)
        t, d = n.sum(1, keepdims=True), (n > 0).sum(1, keepdims=True)
        last = (free & (n == 0)).sum(1, keepdims=True) == 0
        below = np.where(last, t, t + d)
        p += np.where(below > 0, mass * n / np.maximum(below, 1), 0)
        mass = np.where(t > 0, np.where(last, 0, mass * d / np.maximum(below, 1)), mass)
        free &= n == 0
    left = free.sum(1, keepdims=True)
    p += np.where(free, mass / np.maximum(left, 1), 0)
    return np.log10(p)


class Level:
    """The trie's nodes of one context length, and by context: total, distinct bytes, and the total of these bytes one level below."""

    def __init__(self, code: np.ndarray, n: np.ndarray, below: Level | None):
        self.code, self.n = code, n
        self.context, at = np.unique(code >> 8, return_inverse=True)
        add = lambda x: np.bincount(at, weights=x, minlength=len(self.context))
        self.total, self.distinct = add(n), add(np.ones(len(code)))
        self.excluded = add(below.find(below.code, shorter(code), below.n)) if below else self.total

    @staticmethod
    def find(among: np.ndarray, wanted: np.ndarray, *values: np.ndarray):
        """Each wanted one's values, 0 where it isn't among the sorted ones."""
        if not len(among):
            found = [np.zeros(len(wanted)) for _ in values]
        else:
            at = np.minimum(np.searchsorted(among, wanted), len(among) - 1)
            known = among[at] == wanted
            found = [np.where(known, v[at], 0) for v in values]
        return found[0] if len(found) == 1 else found


def levels(code: np.ndarray, n: np.ndarray, order: int, base: list[Level]) -> list[Level]:
    """base (levels from the empty context on) and the levels above it up to order, from nodes of the order."""
    nodes, out = [(code, n)], list(base)
    while len(base) + len(nodes) <= order:
        nodes.append(summed(shorter(nodes[-1][0]), nodes[-1][1]))
    for x in reversed(nodes):
        out.append(Level(*x, out[-1] if out else None))
    return out


def code_lengths(trie: list[Level], code: np.ndarray) -> np.ndarray:
    """log10 probability of each code's byte after its context.

    Method C: a context with total t and d distinct bytes gives a byte n / (t + d) and the escape d / (t + d); counts of excluded
    bytes are left out of t and d. What a context has seen its shorter contexts have seen too, so the excluded bytes are those of
    the next longer context alone. The rest is as in distributions().
    """
    p, mass, free = np.zeros(len(code)), np.ones(len(code)), np.ones(len(code), bool)
    gone, less = np.zeros(len(code)), np.zeros(len(code))
    for level in reversed(trie):
        total, distinct, excluded = level.find(level.context, code >> 8, level.total, level.distinct, level.excluded)
        t, d, last = total - less, distinct - gone, distinct == 256
        below = np.maximum(np.where(last, t, t + d), 1)
        n = level.find(level.code, code, level.n)
        p = np.where(free & (n > 0), mass * n / below, p)
        mass = np.where(t > 0, np.where(last, 0, mass * d / below), mass)
        free &= n == 0
        gone, less = distinct, excluded
        code = shorter(code)
    return np.log10(np.where(free, mass / np.maximum(256 - gone, 1), p))


def model(found: DataFrame, order: int) -> DataFrame:
    """(key, n, log) of every trie node: the log10 probability of its byte after its context."""
    low = min(LOCAL - 1, order)
    lowest = found.filter("n > 0").groupBy(F.substring("key", 2, low).alias("c"), F.substring("key", order + 2, 1).alias("s")).agg(F.sum("n").alias("n"))
    got = lowest.select(F.concat(F.lit(NODE), "c", "s").alias("key"), "n").toArrow()
    shared = found.sparkSession.sparkContext.broadcast(summed(codes_of(got.column("key"), low), got.column("n").to_numpy()))

    def run(batches):
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        base = levels(*shared.value, low, [])
        code = np.concatenate([codes_of(b.column(0), order) for b in got])
        n = np.concatenate([b.column(1).to_numpy() for b in got])
        by = np.argsort(code)
        code, n = code[by], n[by]
        trie = levels(code[n > 0], n[n > 0], order, base) if order > low else base
        for at in range(0, len(code), 500_000):
            part = code[at : at + 500_000]
            logs = code_lengths(trie, part)
            yield pa.RecordBatch.from_arrays([keys(part, order), pa.array(n[at : at + 500_000]), pa.array(logs)], ["key", "n", "log"])

    dealt = found.repartition(F.substring("key", 2, LOCAL if order > low else order + 1))
    return save(dealt.mapInArrow(run, "key binary, n bigint, log double"), "model")


class Head:
    """Code lengths of the frequent nodes: one slot for a node, and a sorted list of those whose slot a more frequent one has."""

    def __init__(self, code: np.ndarray, log: np.ndarray):
        """Nodes by rising frequency."""
        self.shift = np.uint64(64 - max(8, (4 * len(code)).bit_length()))
        self.code = np.full(1 << (64 - int(self.shift)), -1, np.int64)
        self.log = np.zeros(len(self.code))
        at = self.slot(code)
        self.code[at] = code
        lost = self.code[at] != code
        self.log[at[~lost]] = log[~lost]
        by = np.argsort(code[lost])
        self.rest, self.rest_log = code[lost][by], log[lost][by]

    def slot(self, code: np.ndarray) -> np.ndarray:
        return ((code.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def look_up(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log10 probability, 0 where it isn't here; places of those that aren't)."""
        at = self.slot(code)
        known = self.code[at] == code
        log = np.where(known, self.log[at], 0)
        missing = np.flatnonzero(~known)
        if len(self.rest) and len(missing):
            at = np.minimum(np.searchsorted(self.rest, code[missing]), len(self.rest) - 1)
            known = self.rest[at] == code[missing]
            log[missing[known]] = self.rest_log[at[known]]
            missing = missing[~known]
        return log, missing


def ppm_scores(head: Head, rows: list[int], texts: list[str], order: int):
    """(log10 probability of each text and its end as far as the head tells; row, code and number of the nodes it lacks)."""
    scores, rest = np.zeros(len(texts)), []
    at = 0
    while at < len(texts):
        parts, size, first = [], 0, at
        while at < len(texts) and size < AT_ONCE // 4:
            parts.append(codes(texts[at], order))
            size += len(parts[-1])
            at += 1
        code = np.concatenate(parts)
        owner = np.repeat(np.arange(first, at), [len(x) for x in parts])
        log, missing = head.look_up(code)
        scores[first:at] = np.bincount(owner - first, weights=log, minlength=at - first)
        code, owner = code[missing], owner[missing]
        by = np.lexsort((code, owner))
        code, owner = code[by], owner[by]
        new = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (owner[1:] != owner[:-1])])) if len(code) else by
        rest.append((np.array(rows, np.int64)[owner[new]], code[new], np.diff(np.append(new, len(code)))))
    return scores, rest


def lm_scores(docs: DataFrame, order: int = 2) -> DataFrame:
    """Per row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Null texts count as empty; an empty text is its end alone. Rows without an id are training rows, as are all repeats of a row
    whose id isn't held out. With no training text at all N and V are 0: every token's base is log10(1), and all bytes are alike.
    order: bytes of context, 1 to 6. Other columns of docs aren't read.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False)).alias("held_out"),
    )
    found = counts(rows, order)
    is_node = (F.octet_length("key") == order + 2) & F.hex("key").startswith("20")
    is_heard = F.hex("key").startswith(HEARD.hex())
    known = found.filter(~is_node & ~is_heard)
    nodes = model(found.filter(is_node), order)
    n_all, v = known.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    head = {bytes(r.key): r.n for r in known.filter(F.col("n") * HEAD_SHARE > F.lit(n_all)).collect()}
    heard = found.filter(is_heard).select(F.substring("key", len(HEARD) + 1, 2**31 - 1).alias("word"), F.col("n").alias("h"))
    total = n_all + heard.agg(F.coalesce(F.sum("h"), F.lit(0))).first()[0]
    more = heard.join(known, F.col("word") == F.col("key"), "left").select("word", F.coalesce("n", F.lit(0)).alias("n"), "h")
    head |= {bytes(r.word): r.n for r in more.filter((F.col("n") + F.col("h")) * HEAD_SHARE > F.lit(total)).collect()}
    below = n_all + 0.5 * (v + 1)
    n_bytes = nodes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = F.col("n") * HEAD_NODES > F.lit(n_bytes)
    top = nodes.filter(often).toArrow()
    by = np.argsort(top.column("n").to_numpy(), kind="stable")
    shared = spark.sparkContext.broadcast((head, codes_of(top.column("key"), order)[by], top.column("log").to_numpy()[by]))

    def run(batches):
        head, *top = shared.value
        top = Head(*top)
        logs = {k: float(np.log10((n + 0.5) / below)) for k, n in head.items()}
        unseen = {k for k, n in head.items() if not n}
        names = ["row", "key", "tf", "doc_id", "held_out", "n_tokens", "n_known", "base", "score"]
        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        row, key, tf = [], [], []

        def rare(row, key, tf):
            n = len(row)
            none = [pa.nulls(n, k) for k in kinds[3:]]
            return pa.RecordBatch.from_arrays([pa.array(row, pa.int64()), key if isinstance(key, pa.Array) else pa.array(key, pa.binary()), pa.array(tf, pa.int64()), *none], names)

        for batch in batches:
            whole: list[list] = [[] for _ in names]
            columns = [batch.column(i).to_pylist() for i in range(4)]
            scores, rest = ppm_scores(top, columns[0], columns[3], order)
            for r, doc_id, held, text, score in zip(*columns, scores.tolist()):
                words = tokens(text)
                base, n_known = 0.0, 0
                for w, n in Counter(words).items():
                    x = logs.get(w)
                    if x is not None:
                        base += n * x
                        n_known += 0 if w in unseen else n
                    else:
                        row.append(r)
                        key.append(w)
                        tf.append(n)
                for c, value in zip(whole, (r, ROW + r.to_bytes(8, "big"), 0, doc_id, held, len(words), n_known, base, score)):
                    c.append(value)
                if len(row) > 50_000:
                    yield rare(row, key, tf)
                    row, key, tf = [], [], []
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(whole, kinds)], names)
            for owner, code, n in rest:
                yield rare(owner, keys(code, order), n)
        if row:
            yield rare(row, key, tf)

    schema = "row bigint, key binary, tf bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base double, score double"
    scored = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text").mapInArrow(run, schema)
    # A document's own row has a key that no word equals, so it goes through the join unmatched, and evenly dealt.
    rest = known.filter(F.col("n") * HEAD_SHARE <= F.lit(n_all)).select(F.col("key").alias("word"), F.col("n").alias("c"), F.lit(None).cast("double").alias("log"))
    rest = rest.unionByName(nodes.filter(~often).select(F.col("key").alias("word"), F.lit(None).cast("bigint").alias("c"), "log"))
    joined = scored.join(rest, F.col("key") == F.col("word"), "left")
    c = F.coalesce("c", F.lit(0))
    term = F.coalesce("base", F.col("tf") * F.log10((c + 0.5) / F.lit(below)))
    return (
        joined.groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("held_out").alias("held_out"),
            F.sum("n_tokens").alias("n_tokens"),
            F.sum(F.coalesce("n_known", F.when(c > 0, F.col("tf")).otherwise(0))).alias("n_known"),
            F.lit(n_all).cast("bigint").alias("train_tokens"),
            F.sum(F.when(F.col("log").isNull(), term)).alias("base_score"),
            F.sum(F.coalesce("score", F.col("tf") * F.col("log"))).alias("score"),
        )
        .drop("row")
    )
