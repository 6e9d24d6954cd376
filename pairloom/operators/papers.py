"""Selection of papers and files: completeness, main file, pending work, samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.functions import cleaning as C
from pairloom.operators.ordered import numbered


def complete_papers(files: DataFrame) -> DataFrame:
    """Papers with an id-named PDF and at least one LaTeX file, in one pre-aggregated grouping.

    ``files`` has ``paper_id, path, kind``. The PDF that sorts last wins.
    """
    name = F.element_at(F.split("path", "/"), -1)
    pdf = F.when((F.col("kind") == "pdf") & C.is_paper_pdf(name), F.col("path"))
    return (
        files.groupBy("paper_id")
        .agg(F.max(pdf).alias("pdf_path"), F.count_if(F.col("kind") == "tex").alias("n_tex"))
        .where(F.col("pdf_path").isNotNull() & (F.col("n_tex") > 0))
    )


def with_parsed_xml(papers: DataFrame, parsed: DataFrame) -> DataFrame:
    """Papers whose parsed document exists, with its path."""
    return papers.join(parsed.groupBy("paper_id").agg(F.max("path").alias("xml_path")), "paper_id")


def collect_files(files: DataFrame) -> DataFrame:
    """The LaTeX files of each paper in the order of their paths: ``paper_id, position, path``."""
    tex = files.where(F.col("kind") == "tex").select("paper_id", "path")
    return numbered(tex, ["paper_id"], ["path"]).select("paper_id", "position", "path")


def main_tex_file(tex: DataFrame, text: str = "text") -> DataFrame:
    """The one file per paper with a document body; ``status`` tells when there is none or more than one."""
    main = C.has_document_body(F.col(text))
    counted = tex.groupBy("paper_id").agg(
        F.count_if(main).alias("n_main"), F.min(F.when(main, F.col("path"))).alias("path")
    )
    status = F.when(F.col("n_main") == 0, "none").when(F.col("n_main") > 1, "ambiguous").otherwise("ok")
    return counted.select(
        "paper_id", "n_main", status.alias("status"), F.when(F.col("n_main") == 1, F.col("path")).alias("main_path")
    )


def drop_single_file_papers(files: DataFrame) -> DataFrame:
    """Papers with more than one file."""
    return files.groupBy("paper_id").agg(F.count("*").alias("n_files")).where(F.col("n_files") > 1)


def pending_items(items: DataFrame, done: DataFrame, on: Sequence[str] = ("paper_id",)) -> DataFrame:
    """Items not yet done."""
    return items.join(done.select(*on), list(on), "left_anti")


def random_sample(df: DataFrame, n: int, key: Column, seed: int = 0) -> DataFrame:
    """``n`` rows without replacement; the same seed gives the same rows."""
    draw = F.md5(F.concat(key.cast("string"), F.lit(f"#{seed}")))
    return df.orderBy(draw, key).limit(n)


def distinct_ordered(df: DataFrame, columns: Sequence[str], position: str) -> DataFrame:
    """Distinct rows with the position at which each first occurs."""
    return df.groupBy(*columns).agg(F.min(position).alias(position))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))
