import random

import numpy as np
import pytest
import xxhash
from textloom.llm import simhash

from .helpers import ODD, docs


def brute_fp(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def clustered(seed, clusters=20, size=8, apart=5):
    rng = random.Random(seed)
    out = set()
    for _ in range(clusters):
        x = rng.getrandbits(64)
        for _ in range(size):
            y = x
            for k in rng.sample(range(64), rng.randint(0, apart)):
                y ^= 1 << k
            out.add(y)
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_join_finds_every_pair_once(seed):
    fps = clustered(seed)
    v = np.array(fps, np.uint64)
    want = {(i, j) for i in range(len(v)) for j in range(i + 1, len(v)) if (fps[i] ^ fps[j]).bit_count() <= 4}
    got = []
    for way in (0, 1):
        t = simhash.turned(v.view(np.int64), way)
        order = np.argsort(t)
        part = []
        simhash.trie_join(t[order], None, 0, 0, lambda i, j: part.extend(zip(order[i].tolist(), order[j].tolist())))
        part = [(min(p), max(p)) for p in part]
        assert len(part) == len(set(part))
        got += part
    assert set(got) == want


@pytest.mark.parametrize("subtree", [2, 8, 8192])
def test_links_and_components(spark, monkeypatch, subtree):
    """Small subtrees force a deep cut and crowded prefixes that are split into blocks."""
    monkeypatch.setattr(simhash, "SUBTREE", subtree)
    rng = random.Random(9)
    base = rng.getrandbits(64)
    dense = {base ^ (1 << a) ^ (1 << b) for a in range(32, 44) for b in range(32, 44)}
    fps = sorted(set(clustered(3)) | dense)
    df = spark.createDataFrame([(np.uint64(f).astype(np.int64).item(),) for f in fps], "fp bigint")
    found = {r.v: r.root for r in simhash.components(simhash.links(df, len(fps))).collect()}
    signed = [np.uint64(f).astype(np.int64).item() for f in fps]
    got = [found.get(s, s) for s in signed]
    want = brute_components(fps)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_documents(spark):
    rng = random.Random(4)
    base = [rng.choice(["red", "green", "blue", "pink", "grey"]) + str(rng.randint(0, 999)) for _ in range(400)]
    rows = list(ODD) + [(100 + k, " ".join(base[:k] + ["edit"] + base[k + 1 :])) for k in range(30)] + [(50, "ALPHA  beta\ngamma delta")]
    got = simhash.near_duplicates(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {}
    for i, t in rows:
        by.setdefault(i, brute_fp(t))
    assert all(int(r.fingerprint, 16) == by[r.doc_id] for r in got)
    fps = [brute_fp(t) for _, t in rows]
    roots = brute_components(fps)
    smallest = {}
    for (i, _), c in zip(rows, roots):
        if i is not None:
            smallest[c] = min(smallest.get(c, i), i)
    want = sorted(((i, smallest.get(c)) for (i, _), c in zip(rows, roots)), key=repr)
    assert sorted(((r.doc_id, r.component_id) for r in got), key=repr) == want
    kept = simhash.keep_one_of_each(docs(spark, rows))
    stays = {i for i, c in want if i is None or i == c}
    assert {r.doc_id for r in kept.collect()} == stays and kept.columns == docs(spark, rows).columns


def test_empty(spark):
    assert simhash.near_duplicates(docs(spark, [])).count() == 0
    assert [r.component_id for r in simhash.near_duplicates(docs(spark, [(4, None), (9, " ")])).collect()] == [4, 4]


def test_long_chain(spark):
    """A chain of links needs several rounds of stars."""
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "u bigint, v bigint")
    got = {r.v: r.root for r in simhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, 501: 500}


@pytest.mark.parametrize("parts", [5, 6, 7])
def test_orders_bring_near_fingerprints_together(parts):
    """Whichever bits differ, some order has both fingerprints in one subtree; every order keeps all bits."""
    rng = random.Random(parts)
    ways, depths = simhash.orders(parts), [simhash.depth_of(o) for o in simhash.orders(parts)]
    for _ in range(300):
        x = rng.getrandbits(64)
        y = x
        for k in rng.sample(range(64), 4):
            y ^= 1 << k
        pair = np.array([x, y], np.uint64)
        turned = [simhash.turned(pair, w, parts) for w in range(len(ways))]
        assert all((int(a) ^ int(b)).bit_count() == 4 for a, b in turned)
        assert any(int(a) >> 64 - d == int(b) >> 64 - d for (a, b), d in zip(turned, depths))
    assert [simhash.n_parts(n) for n in (1, 2**21, 2**21 + 1, 2**29 + 1, 2**36)] == [5, 5, 6, 7, 7]


@pytest.mark.parametrize("parts", [6, 7])
def test_links_with_more_parts(spark, monkeypatch, parts):
    monkeypatch.setattr(simhash, "n_parts", lambda n: parts)
    fps = clustered(11, clusters=40)
    df = spark.createDataFrame([(np.uint64(f).astype(np.int64).item(),) for f in fps], "fp bigint")
    found = {r.v: r.root for r in simhash.components(simhash.links(df, len(fps))).collect()}
    signed = [np.uint64(f).astype(np.int64).item() for f in fps]
    got, want = [found.get(s, s) for s in signed], brute_components(fps)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))
