"""From landed pages, archives and folders to cleaned main files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.functions import cleaning as C
from pairloom.operators.includes import expand_includes
from pairloom.operators.papers import drop_single_file_papers, main_tex_file, pending_items
from pairloom.sources.archives import pending_archives, unpack_archives
from pairloom.sources.archivesource import read_whole_members
from pairloom.sources.files import decode_tex
from pairloom.sources.pages import page_meta


def download_list(ids: DataFrame, pages: DataFrame, landed: DataFrame) -> DataFrame:
    """Papers still to be fetched, with category, title and addresses."""
    meta = page_meta(pages)
    return (
        pending_items(ids, landed)
        .join(meta, "paper_id")
        .select("paper_id", "category", "title", C.paper_urls(F.col("paper_id")).alias("u"))
        .select("paper_id", "category", "title", "u.*")
    )


def landed_files(archives: DataFrame, landed: DataFrame) -> DataFrame:
    """Member files of new archives, without papers that consist of one file only or whose archive is damaged."""
    members = unpack_archives(pending_archives(archives, landed))
    return complete_papers_files(members)


def landed_folder(spark: SparkSession, root: str, landed: DataFrame) -> DataFrame:
    """As ``landed_files``, from a folder of archives, which are streamed: one member is held at a time."""
    return complete_papers_files(pending_archives(read_whole_members(spark, root), landed))


def complete_papers_files(members: DataFrame) -> DataFrame:
    """Files of the papers whose archive is whole and holds more than one file."""
    failed = members.where(F.col("status") == "failed").select("paper_id").distinct()
    files = members.where(F.col("status").isin("tar", "gzip")).join(failed, "paper_id", "left_anti")
    files = files.select("paper_id", F.col("member_path").alias("path"), "content")
    return files.join(drop_single_file_papers(files).select("paper_id"), "paper_id", "left_semi")


def cleaned_main_files(files: DataFrame, insert_files: bool = True) -> DataFrame:
    """The main file of each paper without preamble, optionally with its includes inserted.

    Papers without exactly one main file are left out.
    """
    text = decode_tex(files.where(F.col("path").rlike(r"\.(tex|bib|bbl)$"))).select("paper_id", "path", "text")
    main = main_tex_file(text.where(F.col("path").endswith(".tex"))).where(F.col("status") == "ok")
    roots = main.select("paper_id", F.col("main_path").alias("path"))
    if insert_files:
        body = expand_includes(text, roots).select("paper_id", "path", "text")
    else:
        body = text.join(roots, ["paper_id", "path"], "left_semi")
    return body.withColumn("text", C.strip_preamble(F.col("text")))
