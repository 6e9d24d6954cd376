"""Rows that every operator has to take: nulls, empty and long texts, ties, repeats, clashing column names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = " ".join(f"word{i % 37} of the {i % 11}th line" for i in range(40))
BIG = (1 << 60) + 1

ROWS = [
    (1, PROSE, "en", "a", 1),
    (2, PROSE, "en", "a", 1),
    (2, PROSE, "en", "a", 1),
    (BIG, PROSE + " more", "en", "b", 1),
    (4, None, None, None, None),
    (5, "", "en", "b", 0),
    (6, " \t\n\x0b\x0c\r ", "en", "b", 7),
    (7, "one", "de", "b", 3),
    (8, "One", "de", "b", 3),
    (9, "äöü 漢字 \U0001f600 \x00 x", "de", "c", 9),
    (10, " ".join(f"w{i}" for i in range(20_000)), "en", "a", 1),
    (None, "no id here", "fr", "c", 10),
    (None, None, None, None, None),
    (11, "a b c\na b c\na b c", "fr", "c", 17),
    (12, "<|endoftext|> x  y\n\n z|| ", "fr", "c", 17),
]


def docs(spark: SparkSession, rows=ROWS) -> DataFrame:
    """With columns that are called like things inside the operators."""
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("score", "size", "text_hash", "kept", "digest", "part", "node", "rank", "taken", "copies", "start", "batch", "target"):
        frame = frame.withColumn(name, F.lit("other"))
    return frame


def empty(spark: SparkSession) -> DataFrame:
    return docs(spark, [])


def folder(spark: SparkSession, path, rows=ROWS) -> str:
    """The same as a table folder for the queries."""
    docs(spark, rows).write.parquet(f"{path}/documents.parquet")
    labels = [(i, i % 2, 0) for i in range(12)] + [(1, 1, 0), (None, 1, 0), (3, None, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    pages = [(r[0], None if r[0] is None else f"http://h{r[0] % 3}/x", r[1]) for r in rows]
    spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("host", F.lit("other")).write.parquet(f"{path}/pages.parquet")
    return str(path)
