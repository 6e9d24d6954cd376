"""Writers of pairs, cleaned texts and category folders."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from pairloom.operators.papers import pending_items
from pairloom.sources.files import read_pairs


def write_pairs(pairs: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Pairs as JSON lines."""
    pairs.write.mode(mode).json(path)


def write_new_pairs(pairs: DataFrame, path: str) -> None:
    """Append the pairs of papers that are not yet in ``path``; calling it again adds nothing twice."""
    try:
        written = read_pairs(pairs.sparkSession, path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    else:
        pairs = pending_items(pairs, written.select("paper_id").distinct())
    write_pairs(pairs, path, "append")


def write_cleaned_tex(tex: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Cleaned texts as Latin-1 bytes, keyed by paper and path, in a new place.

    Characters outside Latin-1 are kept as they are by storing such texts in UTF-8; ``encoding`` tells.
    """
    narrow = ~F.col("text").rlike(r"[^\x{0}-\x{FF}]")
    tex.select(
        "paper_id", "path",
        F.when(narrow, F.encode("text", "ISO-8859-1")).otherwise(F.encode("text", "UTF-8")).alias("content"),
        F.when(narrow, "ISO-8859-1").otherwise("UTF-8").alias("encoding"),
    ).write.mode(mode).parquet(path)


def write_by_category(papers: DataFrame, path: str, columns: Iterable[str] = ("category",), mode: str = "overwrite") -> None:
    """One folder per category. Large categories are spread over several tasks and files, small ones joined."""
    columns = list(columns)
    papers.hint("rebalance", *columns).write.mode(mode).partitionBy(*columns).parquet(path)
