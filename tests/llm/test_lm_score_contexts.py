"""Contexts of more than two bytes, against a trie in plain Python."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from textloom.llm import lm_score, queries

from .helpers import ODD, docs
from .test_lm_score import held


def brute(rows, order):
    trie = defaultdict(Counter)
    whole = [b"\xff" * order + (t or "").encode() + b"\xff" for _, t in rows]
    for (i, _), b in zip(rows, whole):
        if not held(i):
            for k in range(order, len(b)):
                for n in range(order + 1):
                    trie[b[k - n : k]][b[k]] += 1

    def p(ctx, s):
        mass, gone = 1.0, set()
        for c in (ctx[k:] for k in range(order + 1)):
            n = {x: k for x, k in trie.get(c, {}).items() if x not in gone}
            if n:
                below = sum(n.values()) + len(n) * (len(gone) + len(n) < 256)
                if s in n:
                    return mass * n[s] / below
                mass *= len(n) / below
                gone |= set(n)
        return mass / (256 - len(gone))

    grams = [Counter(b[k - order : k + 1] for k in range(order, len(b))) for b in whole]
    return [sum(n * math.log10(p(g[:-1], g[-1])) for g, n in c.items()) for c in grams]


@pytest.mark.parametrize("order,share", [(1, 1 << 22), (3, 50), (5, 1 << 22), (5, 50), (6, 50)])
def test_long_contexts(spark, monkeypatch, order, share):
    """With a small share most nodes are joined instead of looked up."""
    monkeypatch.setattr(lm_score, "HEAD_NODES", share)
    rows = ODD + [(k, f"Word{k % 9} the The cat\x0bsat {'new' * (k % 4)} {k * k}") for k in range(20, 80)] + [(1, "repeat"), (1, "repeat")]
    got = [r.score for r in lm_score.lm_scores(docs(spark, rows), order).collect()]
    assert sorted(got) == pytest.approx(sorted(brute(rows, order)), rel=1e-9)


def test_query_tells_repeated_passages_apart(spark, tmp_path):
    """All bytes follow their last two alike in both held-out texts; only longer contexts know the passage."""
    ids = [i for i in range(200) if held(i)]
    rows = [(i, "abcabdabcabd" if i % 2 else "xbcxbdxbcxbd") for i in range(200) if not held(i)] + [(ids[0], "abcabd"), (ids[1], "abdabc")]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.score for r in queries.op3_lm_score(spark, str(tmp_path)).collect()}
    want = dict(zip((i for i, _ in rows), brute(rows, 5)))
    assert got == pytest.approx(want, rel=1e-9)
    assert queries.ORDER >= 4 and got[ids[0]] > got[ids[1]]


def test_code_lengths_sum_to_one():
    """Also with contexts that have seen all bytes, and agreeing with the dense form."""
    rng = np.random.default_rng(3)
    code, n = lm_score.summed(rng.integers(0, 4, 3000) << 16 | rng.integers(0, 3, 3000) << 8 | rng.integers(0, 90, 3000), np.ones(3000))
    code, n = lm_score.summed(np.append(code, (7 << 16) + (7 << 8) + np.arange(256)), np.append(n, np.ones(256)))
    trie = lm_score.levels(code, n, 2, [])
    for c in ((0, 0), (3, 2), (7, 7), (7, 1), (9, 9)):
        got = lm_score.code_lengths(trie, (c[0] << 16) + (c[1] << 8) + np.arange(256))
        assert (10.0**got).sum() == pytest.approx(1)
        dense = lambda x: np.bincount(code[x] & 255, weights=n[x], minlength=256)
        want = lm_score.distributions(dense(code >> 8 == c[0] << 8 | c[1])[None], dense(code >> 16 == c[0]), dense(code >= 0))
        assert np.allclose(got, want[0])
