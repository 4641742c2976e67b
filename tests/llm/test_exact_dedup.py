import hashlib
import random
import re

from pyspark.sql import functions as F
from textloom.llm.exact_dedup import exact_duplicates, fold_stream, keep_first_copies, normalised

from .helpers import ODD, docs


def brute(rows, digest=lambda b: hashlib.sha256(b).hexdigest()):
    groups = {}
    for i, t in rows:
        t = t or ""
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t), []).append((-len(t), i is None, i if i is not None else 0, i))
    out = []
    for i, t in rows:
        norm = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        out.append((i, min(groups[norm])[3], len(groups[norm]), hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


def check(spark, rows):
    got = exact_duplicates(docs(spark, rows)).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == brute(rows)
    by = {}
    for r in got:
        by.setdefault(r.text_sha256, []).append(r)
    for rs in by.values():
        assert sum(r.kept for r in rs) == 1
        assert all(r.doc_id == r.keep_id for r in rs if r.kept)


def test_odd_rows(spark):
    check(spark, ODD)


def test_random_blanks(spark):
    rng = random.Random(1)
    rows = [(i, "".join(rng.choice("ab \t\n\x0b\x0c\r\x1f\x85 ") for _ in range(rng.randint(0, 5)))) for i in range(400)]
    check(spark, rows)


def test_longest_then_smallest(spark):
    got = {r.doc_id: r for r in exact_duplicates(docs(spark, [(3, "a b"), (2, "a  b"), (9, "a\n\nb"), (4, "ab")])).collect()}
    assert {r.keep_id for r in got.values()} == {2} and got[2].kept and not got[9].kept


def test_empty_table(spark):
    assert exact_duplicates(docs(spark, [])).count() == 0
    assert keep_first_copies(docs(spark, [])).count() == 0


def test_collisions_are_told_apart_by_their_bytes(spark):
    rows = [(i, f"text {i % 7}" + " " * (i % 3)) for i in range(60)]
    got = exact_duplicates(docs(spark, rows), digest=lambda norm: F.substring(F.sha2(norm.cast("binary"), 256), 1, 1)).collect()
    want = {(i, keep, n) for i, keep, n, _ in brute(rows)}
    assert {(r.doc_id, r.keep_id, r.group_size) for r in got} == want
    assert sum(r.kept for r in got) == 7


def test_state_is_kept_between_batches(spark, tmp_path):
    """A second run over new files goes on from the state on disk: nothing expires."""
    schema = "doc_id bigint, text_sha256 string, n_points int, row_uid bigint, locator string"
    src, ckpt, out = (str(tmp_path / x) for x in ("src", "ckpt", "out"))
    for rows in ([(5, "d", 3, 0, "f"), (6, "e", 3, 1, "f")], [(4, "d", 3, 2, "g"), (1, "d", 2, 3, "g")]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(src)
        state = {r.text_sha256: r for r in fold_stream(spark, src, spark.read.parquet(src).schema, ckpt, out).collect()}
    assert (state["d"].keep_id, state["d"].group_size, state["d"].locator) == (4, 3, "g")
    assert (state["e"].keep_id, state["e"].group_size) == (6, 1)


def test_kept_documents_keep_their_columns(spark):
    df = docs(spark, ODD)
    got = keep_first_copies(df)
    assert got.columns == df.columns
    assert sorted(((r.doc_id, (r.text or "")[:9]) for r in got.collect()), key=repr) == sorted(
        [(1, "alpha bet"), (4, " \t\n"), (5, "the same "), (None, "no id at "), (7, "é ü 中文 🙂"), (8, "xxxxxxxxx")], key=repr
    )
    plain = docs(spark, [(1, "a b"), (2, "ab"), (3, "c")])
    assert sorted(r.doc_id for r in keep_first_copies(plain).collect()) == [1, 3]


def test_normalised(spark):
    row = spark.range(1).select(normalised(F.lit(" a\tb c\x1d ")).alias("x")).first()
    assert row.x == "ab c\x1d"
