"""SimHash near-duplicates by a self-join of the binary trie of fingerprints.

Node pairs of the trie are followed downwards together, their differing bits are summed, and a pair is dropped as soon as it has over
4. The trie is read in several orders of its bits: cut into five parts, a fingerprint has a part in common with each one within 4
bits, so the trie that reads this part first has both in one subtree, and only subtrees below a whole part are joined, each with
itself. With more fingerprints there are more parts, and all but four of them come first, so that subtrees stay small: every
fingerprint goes to 5 subtrees up to 2 million fingerprints, to 15 up to 500 million, to 35 up to 69 billion. Subtrees with many
fingerprints (near copies of one text crowd into a few) are cut further into blocks of a fixed size, pair by pair. A group gives
a spanning forest of its links, never all pairs, and alternating large and small stars join the forests.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import attach, save, without_ids

BITS, NEAR = 64, 4
SHINGLE = 4
SEED = 42
#: Fingerprints that a group of subtrees should have; a subtree of over twice as many is cut into blocks.
SUBTREE = 8192
#: Fingerprints that a subtree may have if they are spread evenly; with more there is one more part.
EVEN = 512
#: Bits of a prefix that are counted first, to find the crowded ones.
COARSE = 12
#: Node pairs with at most this many leaf pairs are compared leaf by leaf; as many node pairs are expanded at once.
LEAF_PAIRS, AT_ONCE = 64, 65_536


def shingles(text: str | None) -> list[bytes]:
    words = (text or "").encode("utf-8", "replace").lower().split()
    if len(words) <= SHINGLE:
        return [b" ".join(words)] if words else []
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    return [line[s:e] for s, e in zip(starts[: len(words) - SHINGLE + 1].tolist(), ends[SHINGLE - 1 :].tolist())]


def fingerprint(text: str | None) -> int:
    """A bit is 1 if over half the shingles' hashes have it; 0 for a text without words. As a signed 64-bit number."""
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(s, SEED) for s in shingles(text)], np.uint64)
    if not len(h):
        return 0
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(h), 65_536):
        ones += np.unpackbits(h[at : at + 65_536].view(np.uint8), bitorder="little").reshape(-1, BITS).sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) per row of docs."""

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([fingerprint(t.as_py()) for t in b.column(1)], pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, fp bigint")


# --- the trie ------------------------------------------------------------------------------------------------------------


def n_parts(n: int) -> int:
    """Parts that n fingerprints are cut into."""
    parts = NEAR + 1
    while n > EVEN << BITS // parts * (parts - NEAR):
        parts += 1
    return parts


def cuts(parts: int) -> list[tuple[int, int]]:
    """(bits below it, bits) of each part, from the highest bits on."""
    edges = [BITS * i // parts for i in range(parts + 1)]
    return [(BITS - e, e - s) for s, e in zip(edges, edges[1:])]


def orders(parts: int) -> list[tuple[int, ...]]:
    """Every order in which the trie is read: all but NEAR parts first. Two fingerprints within NEAR bits agree on the first parts of one."""
    firsts = combinations(range(parts), parts - NEAR)
    return [(*f, *(i for i in range(parts) if i not in f)) for f in firsts]


def depth_of(order: tuple[int, ...]) -> int:
    """Bits of the parts that come first."""
    return sum(cuts(len(order))[i][1] for i in order[: len(order) - NEAR])


def turned(fp: np.ndarray, way: int, parts: int = NEAR + 1) -> np.ndarray:
    """The fingerprints with their bits in the order of that number."""
    fp = fp.view(np.uint64)
    out = np.zeros(len(fp), np.uint64)
    for i in orders(parts)[way]:
        below, bits = cuts(parts)[i]
        out = (out << np.uint64(bits)) | ((fp >> np.uint64(below)) & np.uint64((1 << bits) - 1))
    return out


def mixed(fp: np.ndarray) -> np.ndarray:
    x = fp.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(31))


class Forest:
    """Union by smallest label over numpy arrays of links."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, u: np.ndarray, v: np.ndarray) -> None:
        while True:
            a, b = self.root[u], self.root[v]
            apart = a != b
            if not apart.any():
                return
            u, v, a, b = u[apart], v[apart], a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def trie_join(a: np.ndarray, b: np.ndarray | None, depth: int, differ: int, found) -> None:
    """Call found(i, j) with index arrays of the leaf pairs within the budget. a, b: sorted and distinct.

    b None joins a with itself, each pair once, and only within its subtrees of `depth` bits; otherwise a and b are of one prefix each
    of that many bits. differ: bits that the two prefixes differ in.
    """
    own = b is None
    b = a if own else b
    if not len(a) or not len(b):
        return
    if own and depth:
        prefix = a >> np.uint64(BITS - depth)
        first = np.flatnonzero(np.concatenate([[True], prefix[1:] != prefix[:-1]]))
        last = np.append(first[1:], len(a))
        roots = np.stack((first, last, first, last, np.zeros(len(first), np.int64)), 1)[last - first > 1]
    else:
        roots = np.array([[0, len(a), 0, len(b), differ]], np.int64)
    stack = [(depth, roots[i : i + AT_ONCE]) for i in range(0, len(roots), AT_ONCE)]
    while stack:
        level, nodes = stack.pop()
        la, ha, lb, hb, d = nodes.T
        small = (ha - la) * (hb - lb) <= LEAF_PAIRS
        if level == BITS:
            small[:] = True
        if small.any():
            _leaves(a, b, nodes[small], own, found)
        if small.all():
            continue
        la, ha, lb, hb, d = nodes[~small].T
        bit = np.uint64(BITS - 1 - level)
        ones_a = np.concatenate([[0], np.cumsum((a >> bit) & np.uint64(1), dtype=np.int64)])
        ones_b = ones_a if own else np.concatenate([[0], np.cumsum((b >> bit) & np.uint64(1), dtype=np.int64)])
        ma, mb = ha - (ones_a[ha] - ones_a[la]), hb - (ones_b[hb] - ones_b[lb])
        twin = (la == lb) & (ha == hb) if own else np.zeros(len(la), bool)
        kids = [np.stack(x, 1) for x in ((la, ma, lb, mb, d), (ma, ha, mb, hb, d), (la, ma, mb, hb, d + 1))]
        kids.append(np.stack((ma, ha, lb, mb, d + 1), 1)[~twin])  # of a node with itself, the mirrored pair is the same
        kids = np.concatenate(kids)
        kids = kids[(kids[:, 4] <= NEAR) & (kids[:, 1] > kids[:, 0]) & (kids[:, 3] > kids[:, 2])]
        stack += [(level + 1, kids[i : i + AT_ONCE]) for i in range(0, len(kids), AT_ONCE)]


def _leaves(a: np.ndarray, b: np.ndarray, nodes: np.ndarray, own: bool, found) -> None:
    """Compare all leaves of each node pair, about 250,000 pairs at once."""
    sizes = (nodes[:, 1] - nodes[:, 0]) * (nodes[:, 3] - nodes[:, 2])
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // 250_000)) + 1
    for part in np.split(nodes, cuts):
        la, ha, lb, hb, _ = part.T
        wide = hb - lb
        n = (ha - la) * wide
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        w = np.repeat(wide, n)
        i, j = np.repeat(la, n) + at // w, np.repeat(lb, n) + at % w
        ok = np.bitwise_count(a[i] ^ b[j]) <= NEAR
        if own:
            ok &= i < j
        if ok.any():
            found(i[ok], j[ok])


def prefix_of(order: tuple[int, ...]) -> Column:
    """The bits of the parts that come first, of the column fp."""
    out, sizes = F.lit(0).cast("bigint"), cuts(len(order))
    for i in order[: len(order) - NEAR]:
        below, bits = sizes[i]
        out = F.shiftleft(out, bits).bitwiseOR(F.shiftrightunsigned("fp", below).bitwiseAND(F.lit((1 << bits) - 1)))
    return out


def crowded_subtrees(fps: DataFrame, parts: int, block: int) -> dict[tuple[int, int], int]:
    """(way, prefix) -> number of blocks, of the subtrees with over `block` fingerprints: at most one in `block` of those dealt."""
    ways = orders(parts)
    dealt = fps.select(F.explode(F.array(*(F.struct(F.lit(w).alias("way"), prefix_of(o).alias("prefix"), F.lit(depth_of(o)).alias("bits")) for w, o in enumerate(ways)))).alias("x"))
    dealt = dealt.select("x.way", "x.prefix", F.expr(f"shiftright(x.prefix, greatest(0, x.bits - {COARSE}))").alias("top"))
    # Few prefixes of few bits are counted in the tasks; only below those with enough fingerprints are all bits.
    tops = dealt.groupBy("way", "top").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block).select("way", "top")
    tops = save(tops, "crowded")  # len(ways) << COARSE at most
    if tops.isEmpty():
        return {}
    sizes = dealt.join(F.broadcast(tops), ["way", "top"]).groupBy("way", "prefix").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
    return {(r.way, r.prefix): -(-r.n // block) for r in sizes.collect()}


def links(fps: DataFrame, n: int) -> DataFrame:
    """(u, v): links whose components are those of all pairs of fingerprints within NEAR bits. fps: distinct, one column fp; n of them."""
    parts, block = n_parts(n), 2 * SUBTREE
    ways = orders(parts)
    depths = [depth_of(o) for o in ways]
    groups = max(1, n // SUBTREE)  # of each way; subtrees are dealt to them by a hash of their prefix
    crowded = crowded_subtrees(fps, parts, block)

    def prefixes(fp: np.ndarray, way: int) -> np.ndarray:
        return turned(fp, way, parts) >> np.uint64(BITS - depths[way])

    def blocks_of(way: int, prefix: np.ndarray) -> np.ndarray:
        return np.array([crowded.get((way, p), 1) for p in prefix.tolist()], np.int64) if crowded else np.ones(len(prefix), np.int64)

    def deal(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            if not len(fp):
                continue
            for way in range(len(ways)):
                prefix = prefixes(fp, way)
                n_blocks = blocks_of(way, prefix)
                bucket = (mixed(prefix) % np.uint64(groups)).astype(np.int64)
                # Subtrees of one block share a group with others; one of more is groups of its own (-1 - prefix), for each pair of blocks.
                subtree = np.where(n_blocks == 1, bucket, -1 - prefix.astype(np.int64))
                mine = (mixed(fp) % n_blocks.astype(np.uint64)).astype(np.int64)
                for j in range(int(n_blocks.max())):
                    to = n_blocks > j
                    pair = np.minimum(mine[to], j) << 32 | np.maximum(mine[to], j)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(to.sum(), way)), pa.array(subtree[to]), pa.array(pair), pa.array(fp[to])], ["way", "subtree", "block", "fp"])

    def join(keys, group):
        way, subtree, pair = (k.as_py() for k in keys)
        fp = np.unique(group.column("fp").to_numpy())
        v = turned(fp, way, parts)
        forest = Forest(len(fp))
        if pair >> 32 == pair & 0xFFFFFFFF:
            order = np.argsort(v)
            trie_join(v[order], None, depths[way], 0, lambda i, j: forest.link(order[i], order[j]))
        else:
            left = (mixed(fp) % np.uint64(crowded[(way, -1 - subtree)])).astype(np.int64) == pair >> 32
            order_a = np.flatnonzero(left)[np.argsort(v[left])]
            order_b = np.flatnonzero(~left)[np.argsort(v[~left])]
            trie_join(v[order_a], v[order_b], depths[way], 0, lambda i, j: forest.link(order_a[i], order_b[j]))
        linked = np.flatnonzero(forest.root != np.arange(len(fp)))
        return pa.table({"u": pa.array(fp[linked], pa.int64()), "v": pa.array(fp[forest.root[linked]], pa.int64())})

    dealt = fps.select("fp").mapInArrow(deal, "way bigint, subtree bigint, block bigint, fp bigint")
    return dealt.groupBy("way", "subtree", "block").applyInArrow(join, "u bigint, v bigint")


# --- components ------------------------------------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(v, root) for every node of edges (u, v) but the roots: alternating large and small stars until nothing changes."""
    edges = save(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = None
    while True:
        n = edges.count()
        if not n:
            break
        # Large star: what is linked to u and above it goes to the smallest of u and its neighbours.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        large = attach(both, least, "u", "n", 2 * n).filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        large = save(large, "large")
        # Small star: what is linked to u and below it, and u, go to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        small = attach(large, least, "u", "n", n).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = save(small.unionByName(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct(), "small")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_000_007)).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("u").alias("v"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, fingerprint, component_id.

    Null, empty and blank texts have fingerprint zero, and link like any other. component_id is the smallest doc_id that links
    lead to; null ids count only if a component has no other. Repeated rows are returned as often as they came.
    """
    rows = save(fingerprints(docs), "fingerprints")
    groups = save(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")), "distinct")
    total, n = rows.count(), groups.count()
    found = components(links(groups.select("fp"), n))
    roots = groups.join(found, groups.fp == found.v, "left").select("fp", "first", "n", F.coalesce("root", "fp").alias("root"))
    roots = save(roots, "roots")
    firsts = roots.groupBy("root").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("members"))
    classes = attach(roots, firsts, "root", "members", n).select("fp", "n", "component_id")
    out = attach(rows, classes, "fp", "n", total)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """docs, in its own columns, with the document of the smallest id of each component.

    An id that several rows carry stays if any of them is its component's first; rows without an id stay.
    """
    report = save(near_duplicates(docs.select("doc_id", "text")), "near").select("doc_id", "component_id").distinct()
    stays = report.filter("doc_id = component_id").select("doc_id")
    return without_ids(docs, report.filter("doc_id != component_id").select("doc_id").distinct().join(stays, "doc_id", "left_anti"))
