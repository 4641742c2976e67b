import random

import pytest
import sentencepiece
from textloom.llm import sentencepiece_codec as sc

from .helpers import ODD, docs


@pytest.fixture(scope="module")
def lib():
    return sentencepiece.SentencePieceProcessor(model_file=sc.DEFAULT_MODEL)


def test_pieces_are_the_librarys(lib):
    c = sc.Codec(open(sc.DEFAULT_MODEL, "rb").read())
    rng = random.Random(8)
    letters = "aabeeinorst  ▁\n\t.,éß中🙂<0x41></s>"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["", " ", "   lead", "trail   ", "internationalisation of the internationals", "a" * 3000, "\x00"]
    got = []
    for at in range(0, len(texts), 100):
        got += c.encode_batch(texts[at : at + 100])
    assert got == lib.encode(texts)
    assert [c.decode(x) for x in got] == lib.decode(got)


def test_small_stores_change_nothing(lib, monkeypatch):
    monkeypatch.setattr(sc, "KEPT", 5)
    monkeypatch.setattr(sc, "PAIRS", 3)
    c = sc.Codec(open(sc.DEFAULT_MODEL, "rb").read())
    texts = ["some of the words", "words of some other", "other words again, again"] * 3
    assert [c.encode_batch([t])[0] for t in texts] == lib.encode(texts)


def test_best_path_of_summed_scores():
    """The unigram form of the forward state, against all segmentations."""
    c = object.__new__(sc.Codec)
    c.bpe, c.score = False, {"▁": -3.0, "a": -2.0, "b": -2.5, "ab": -3.0, "aba": -5.5, "▁ab": -4.0, "ba": -4.2}
    c.id = {p: i for i, p in enumerate(c.score)}
    c.tails, c.fallback, c.unk, c.byte = {"aba": (3,), "▁ab": (3,)}, False, 99, []

    def best(w):
        if not w:
            return 0.0
        return max(best(w[: -len(p)]) + s for p, s in c.score.items() if w.endswith(p))

    by_id = {i: p for p, i in c.id.items()}
    for w, ids in c.learn({"▁aba", "▁abab", "▁abba", "▁ba", "▁a"}).items():
        assert "".join(by_id[i] for i in ids) == w
        assert sum(c.score[by_id[i]] for i in ids) == pytest.approx(best(w))


def test_spark(spark, lib):
    rows = ODD + [(20, "one\x85two ▁ three")]
    got = sc.encode(docs(spark, rows)).collect()
    assert len(got) == len(rows) and all(r.round_trip for r in got)
    text = dict(rows)
    for r in got:
        assert r.ids == lib.encode(text[r.doc_id] or "") and r.n_pieces == len(r.ids) and r.decoded == lib.decode(r.ids)
    back = {r.doc_id: r.text for r in sc.decode(sc.encode(docs(spark, rows))).collect()}
    assert back[1] == text[1] and back[2] == ""
    assert sc.encode(docs(spark, [])).count() == 0
