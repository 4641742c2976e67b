"""Rows that every operator has to bear: nulls, empty and very long texts, ties, repeats, and columns with the operators' inner names."""

SCHEMA = "doc_id bigint, text string, lang string, row bigint, fp bigint, `key` string, n bigint, text_sha256 string, score double, words string"
LONG = "the same words again and again " * 8000


def docs(spark, rows):
    """rows: (doc_id, text); the clashing columns are filled with odd values."""
    return spark.createDataFrame([(i, t, "en", 1, 2, "k", None, "x", 0.5, "w") for i, t in rows], SCHEMA).repartition(3)


ODD = [(1, "alpha beta gamma delta"), (2, None), (3, ""), (4, " \t\n"), (5, LONG), (5, LONG), (6, "alpha beta gamma delta"), (None, "no id at all"), (7, "é ü 中文 🙂"), (8, "x" * 50_000)]
