"""The pipeline on a small fixture, stage by stage, against plain Python."""

import random

import corpus_pipeline
import sentencepiece
from pyspark.sql import functions as F
from textloom.llm import sentencepiece_codec
from textloom.llm.decontaminate import words as item_words

from .test_decontaminate import brute as brute_contamination
from .test_exact_dedup import brute as brute_copies
from .test_simhash import brute_components, brute_fp
from .helpers import LONG
from .test_toxicity import corpus


def write(spark, path):
    rng = random.Random(6)
    rows, labels = corpus()
    passage = " ".join(f"bench{k}" for k in range(30))
    rows += [(2000 + k, rows[k + 1][1].replace(" ", "  ")) for k in range(20)]
    base = rows[3][1].split() * 20
    rows += [(3000 + k, " ".join(base[: 5 * k] + ["edit"] + base[5 * k + 1 :])) for k in range(10)]
    rows += [(4000 + k, f"{rows[k][1]} {passage}" if k % 2 else passage) for k in range(6)]
    rows += [(5000, None), (5001, "")]
    rng.shuffle(rows)
    for name, data, schema in (
        ("documents", [(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint"),
        ("labels", labels, "doc_id bigint, quality int, toxic int"),
        ("benchmark", [(1, passage)], "item_id bigint, text string"),
    ):
        spark.createDataFrame(data, schema).write.parquet(f"{path}/{name}.parquet")
    return [(1, passage)]


def test_stages(spark, tmp_path):
    items = write(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name == "sentencepiece":
            lib = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.DEFAULT_MODEL)
            assert {r.doc_id: r.ids for r in docs.collect()} == {i: lib.encode(t or "") for i, t in before.items()}
            break
        assert docs.columns == columns
        after = {r.doc_id: r.text for r in docs.collect()}
        assert after.items() <= before.items()
        rows = sorted(before.items())
        if name == "toxicity":
            bad = {i for i, t in rows if any(w in (t or "") for w in ("fool", "scum"))}
            assert len(after.keys() & bad) <= 0.03 * len(bad) and len(after) >= 0.97 * len(before.keys() - bad)
        elif name == "exact dedup":
            assert set(after) == {i for i, keep, _, _ in brute_copies(rows) if i == keep}
        elif name == "near dedup":
            roots = brute_components([brute_fp(t) for _, t in rows])
            assert set(after) == {rows[k][0] for k, c in enumerate(roots) if c == k}
        else:
            assert set(after) == {r[0] for r in brute_contamination(rows, items) if not r[5]}
            assert not any(item_words(t) and "bench3" in t for t in after.values())


def test_run_is_the_stages(spark, tmp_path):
    write(spark, str(tmp_path))
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == ["doc_id", "ids", "n_pieces", "decoded", "round_trip"]
    assert got.filter("not round_trip").count() == 0 and got.select("doc_id").distinct().count() == got.count() > 100


def test_empty(spark, tmp_path):
    write(spark, str(tmp_path))
    spark.read.parquet(f"{tmp_path}/documents.parquet").limit(0).write.mode("overwrite").parquet(f"{tmp_path}/none/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{tmp_path}/{t}.parquet").write.parquet(f"{tmp_path}/none/{t}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


def test_odd_rows(spark, tmp_path):
    """Nulls, empty and very long texts, rows that repeat or share an id, ids that are null, and columns named like inner ones."""
    write(spark, str(tmp_path))
    odd = [(9000, None), (9001, ""), (9002, " \t"), (9003, LONG), (9003, LONG), (9004, "bench " * 3), (9005, "one two three"), (9005, "four five six seven"), (None, "without an id"), (None, None)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, toxic int, gone string, digest string, points int, sha string, row bigint, fp bigint, kept boolean"
    rows = [(i, t, "en", "s", 1, 0.5, 1, "g", "d", 2, "h", 3, 4, True) for i, t in odd]
    base = spark.read.parquet(f"{tmp_path}/documents.parquet")
    more = spark.createDataFrame(rows, schema)
    docs = base.select(*(base[c] if c in base.columns else F.lit(None).cast(more.schema[c].dataType).alias(c) for c in more.columns)).unionByName(more)
    docs.write.parquet(f"{tmp_path}/odd")
    docs = spark.read.parquet(f"{tmp_path}/odd")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/odd-{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/odd-{name}")
        assert docs.columns == before.columns and docs.subtract(before).isEmpty()
    left = [(r.doc_id, r.text) for r in docs.collect()]
    assert left.count((9003, LONG)) == 1 and (9005, "one two three") in left and (9005, "four five six seven") in left and (None, "without an id") in left
    assert sum(not (t or "").split() for _, t in left) == 1
    coded = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert coded.count() == len(left) and coded.filter("not round_trip").isEmpty()
