import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from textloom.llm import lm_score

from .helpers import ODD, docs


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def brute(rows):
    words, trie = Counter(), defaultdict(Counter)
    for i, t in rows:
        if not held(i):
            words.update((t or "").encode().lower().split())
            words["END"] += 1
            b = b"\xff\xff" + (t or "").encode() + b"\xff"
            for k in range(2, len(b)):
                for n in (0, 1, 2):
                    trie[b[k - n : k]][b[k]] += 1
    n_all, v = sum(words.values()), len(words)

    def p(ctx, s):
        mass, gone = 1.0, set()
        for c in (ctx, ctx[1:], b""):
            n = {x: k for x, k in trie.get(c, {}).items() if x not in gone}
            if n:
                below = sum(n.values()) + len(n) * (len(gone) + len(n) < 256)
                if s in n:
                    return mass * n[s] / below
                mass *= len(n) / below
                gone |= set(n)
        return mass / (256 - len(gone))

    out = []
    for i, t in rows:
        w = (t or "").encode().lower().split() + ["END"]
        b = b"\xff\xff" + (t or "").encode() + b"\xff"
        score = 0.0
        cache = {}
        for k in range(2, len(b)):
            key = b[k - 2 : k + 1]
            if key not in cache:
                cache[key] = math.log10(p(b[k - 2 : k], b[k]))
            score += cache[key]
        out.append((i, held(i), len(w), sum(words[x] > 0 for x in w), n_all, sum(math.log10((words[x] + 0.5) / (n_all + 0.5 * (v + 1))) for x in w), score))
    return out


@pytest.mark.parametrize("share", [100_000, 20])
def test_against_brute_force(spark, monkeypatch, share):
    """With a small share most words are joined instead of looked up."""
    monkeypatch.setattr(lm_score, "HEAD_SHARE", share)
    rows = ODD + [(k, f"Word{k % 9} the The cat\x0bsat {'new' * (k % 4)}") for k in range(20, 60)] + [(1, "repeat"), (1, "repeat")]
    got = sorted((tuple(r) for r in lm_score.lm_scores(docs(spark, rows)).collect()), key=repr)
    want = sorted(brute(rows), key=repr)
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=lambda r: (repr(r[:5]), r[5])), sorted(want, key=lambda r: (repr(r[:5]), r[5]))):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9)


def test_words_of_held_out_texts_alone(spark, monkeypatch):
    """A word that no training text has is frequent in the held-out ones: it goes to the head, and is not known."""
    monkeypatch.setattr(lm_score, "HEAD_SHARE", 50)
    ids = [i for i in range(400) if held(i)]
    rows = [(i, "common words here") for i in range(400) if not held(i)] + [(i, f"strange strange common w{i}") for i in ids]
    got = sorted((tuple(r) for r in lm_score.lm_scores(docs(spark, rows)).collect()), key=repr)
    for g, w in zip(got, sorted(brute(rows), key=repr)):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9)
    found = lm_score.counts(docs(spark, rows).withColumn("held_out", F.expr("crc32(cast(doc_id as string)) % 5 = 1")), 2)
    assert found.filter(F.col("key") == F.lit(lm_score.HEARD + b"strange")).first().n == 2 * len(ids)


def test_distributions_sum_to_one():
    rng = np.random.default_rng(1)
    order1 = rng.integers(0, 3, 256)
    follow = np.minimum(rng.integers(0, 2, (5, 256)), order1)
    follow[4] = 0
    for o0 in (np.maximum(order1, rng.integers(0, 2, 256)), np.ones(256), np.zeros(256)):
        total = (10.0 ** lm_score.distributions(follow, order1, np.maximum(o0, order1))).sum(1)
        assert np.allclose(total, 1)


def test_empty(spark):
    assert lm_score.lm_scores(docs(spark, [])).count() == 0
    (r,) = lm_score.lm_scores(docs(spark, [(next(i for i in range(99) if held(i)), "ab")])).collect()
    assert (r.train_tokens, r.n_known, r.n_tokens) == (0, 0, 2) and r.score == pytest.approx(3 * math.log10(1 / 256))
