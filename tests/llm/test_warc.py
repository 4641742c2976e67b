import base64
import hashlib

from textloom.llm import warc

SCHEMA = "page_id bigint, url string, html string, `key` string, first bigint"


def brute(rows):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        body = (h or "").encode()
        f = first.get(h or "")
        revisit = f is not None and i != f
        out.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if revisit else "response", f if revisit else None, True))
    return sorted(out, key=repr)


FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
ROWS = [
    (1, "http://a/", "<p>one</p>"),
    (2, None, None),
    (3, "http://b/\r\nContent-Length: 1", "x" + FAKE + "y"),
    (4, "u", FAKE),
    (5, "u", FAKE + FAKE + "WARC/1.1\r\n"),
    (6, "u", "\r\n\r\nWARC/1.1\r\nContent-Length: 99999999999999999999\r\n\r\n"),
    (7, "u", "<p>one</p>"),
    (8, "u", ""),
    (9, "u", "é中🙂\r\n\r\n" * 2000),
    (9, "u", "é中🙂\r\n\r\n" * 2000),
    (-10, "u", "<p>one</p>"),
    (None, "u", "<p>one</p>"),
    (None, "u", "alone"),
    (11, "u", "WARC/1.1\r\n"),
]


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "k", 1) for i, u, h in rows], SCHEMA)


def test_round_trip_with_magic_in_payloads(spark):
    got = warc.through_archives(pages(spark, ROWS).repartition(3)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(ROWS)


def test_small_splits(spark, tmp_path):
    """Records that reach over several splits of a file; many files."""
    rows = [(k, "u", f"page {k % 50} " * (k % 40) + (FAKE if k % 7 == 0 else "")) for k in range(300)]
    warc.write_archives(pages(spark, rows).coalesce(2), str(tmp_path / "w"), records=100)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        got = warc.read_archives(spark, str(tmp_path / "w")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)


def test_broken_chain(spark, tmp_path):
    """Nothing after a record whose length lies is taken for a record; a file that starts otherwise has none."""
    good = FAKE.replace("666", "1")
    (tmp_path / "a.warc").write_bytes((good + FAKE.replace("Content-Length: 5", "Content-Length: 7").replace("666", "2") + good.replace("page:1", "page:3")).encode())
    (tmp_path / "b.warc").write_bytes(("junk" + good).encode())
    (tmp_path / "c.warc").write_bytes((good + good)[:-20].encode())
    got = warc.read_archives(spark, str(tmp_path)).collect()
    assert [r.page_id for r in got if r.payload_bytes == 5] == [1, 1]


def test_empty(spark):
    assert warc.through_archives(pages(spark, [])).count() == 0
