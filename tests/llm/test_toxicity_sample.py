"""Training reads labelled texts of every length."""

import random

import pytest
from textloom.llm import toxicity

from .helpers import docs


def long_corpus(toxic_words, clean_words):
    rng = random.Random(8)
    clean = ["".join(rng.choice(["ra", "lo", "mi", "te", "su", "no"]) for _ in range(rng.randint(2, 4))) for _ in range(300)]
    rows, labels = [], []
    for i in range(200):
        toxic = int(i % 2 == 0)
        words = [rng.choice(clean) for _ in range(toxic_words if toxic else clean_words)]
        for _ in range(toxic * max(3, len(words) // 50)):
            words.insert(rng.randrange(len(words)), rng.choice(["vilefool", "dumbfool", "vilescum"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return rows, labels


@pytest.mark.parametrize("sizes", [(2500, 40), (40, 2500), (2500, 2500)])
def test_long_texts_are_learned_from(spark, sizes):
    """Texts of over 8000 bytes of one label or of both: none was read before, so nothing was predicted toxic."""
    rows, labels = long_corpus(*sizes)
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    found = toxicity.sample(docs(spark, rows).select("doc_id", "text"), known)
    assert len(found.docs) == sum(toxicity.zlib.crc32(str(i).encode()) % 4 != 2 for i, _ in rows)
    assert max(map(len, found.docs)) > 2000
    got = {r.doc_id: r for r in toxicity.toxicity(docs(spark, rows), known).collect()}
    held = [got[i].predicted == t for i, _, t in labels if got[i].held_out]
    assert sum(held) >= 0.9 * len(held)


def test_ids_without_a_text_take_no_place(spark):
    rows, labels = long_corpus(40, 40)
    known = spark.createDataFrame(labels + [(k, 1, k % 2) for k in range(1000, 5000)], "doc_id bigint, quality int, toxic int")
    assert len(toxicity.sample(docs(spark, rows).select("doc_id", "text"), known, 50).docs) == 100


def test_one_sided_labels_are_told():
    one = toxicity.Sample()
    one.add([b"a", b"word"], 1)
    with pytest.warns(UserWarning, match="all 1 labelled training texts are toxic"):
        toxicity.train(one)


def test_sample_holds_the_features_of_each_text():
    text = "Some words, words again; some more"
    one = toxicity.Sample()
    one.add(toxicity.words_of(text), 0)
    words = list(one.number)
    ids, counts = toxicity.grams([words[k] for k in one.docs[0]])
    want = toxicity.features(text)
    assert (ids == want[0]).all() and (counts == want[1]).all()
