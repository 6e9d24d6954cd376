"""Readers of id lists, corpus folders, LaTeX files, parsed documents and pairs."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pairloom.functions import cleaning as C
from pairloom.operators.elements import ELEMENT

PARSED_SCHEMA = ", ".join(f"{s} {ELEMENT}" for s in ("title", "abstract", "body", "back"))
FORMULA = "struct<pre_txt:string,equation_txt:string,post_txt:string,full_txt:string>"
PAIR_SCHEMA = f"paper_id string, dirty_data {FORMULA}, clean_data {FORMULA}, similarity_score double"


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """Paper ids from the lines of a text file that end in ``.pdf``."""
    lines = spark.read.text(path)
    return lines.select(C.id_from_line(F.col("value")).alias("paper_id")).where(F.col("paper_id").isNotNull())


def _kind(path: Column) -> Column:
    kinds = ("pdf", "tex", "bib", "bbl", "xml")
    suffix = F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))
    return F.when(suffix.isin(*kinds), suffix).otherwise("other")


def scan_paper_files(spark: SparkSession, root: str, by_category: bool = True, recursive: bool = True) -> DataFrame:
    """Listing of a corpus folder; file contents are not read.

    The layout is ``root/category/paper/...`` or, without categories, ``root/paper/...``. A paper folder
    ending in ``_arXiv`` holds the cleaned twin of a paper. Without ``recursive`` only files directly in
    a paper folder are listed.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    parts = F.split(_below(F.col("path"), root), "/")
    depth = 1 if by_category else 0
    folder = F.get(parts, F.lit(depth))
    listed = files.select(
        F.regexp_replace(folder, r"_arXiv\z", "").alias("paper_id"),
        (F.get(parts, F.lit(0)) if by_category else F.lit("")).alias("category"),
        "path",
        _kind(F.col("path")).alias("kind"),
        folder.endswith("_arXiv").alias("cleaned"),
        F.size(parts).alias("__depth"),
    )
    least = depth + 2
    listed = listed.where(F.col("__depth") >= least if recursive else F.col("__depth") == least)
    return listed.drop("__depth")


def read_tex_files(spark: SparkSession, root: str, encoding: str = "latin1") -> DataFrame:
    """LaTeX files ``root/paper/...`` as text.

    With ``latin1`` every file is decoded. With ``utf8`` files that are not valid UTF-8 give no row.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.tex")
        .load(root)
    )
    return decode_tex(files.select(paper_folder(F.col("path"), root).alias("paper_id"), "path", "content"), encoding)


def paper_folder(path: Column, root: str) -> Column:
    """First folder below ``root``."""
    return F.get(F.split(_below(path, root), "/"), F.lit(0))


def _below(path: Column, root: str) -> Column:
    """What follows ``root`` in a path; ``root`` may be relative and may hold globs, and it is met at the start."""
    base = re.sub(r"^file:", "", root.rstrip("/").split("://")[-1])
    glob = "".join({"*": "[^/]*", "?": "[^/]"}.get(c, re.escape(c)) for c in base)
    glob = re.sub(r"\\\{([^{}]*)\\\}", lambda m: "(?:" + m[1].replace(",", "|") + ")", glob)
    start = "" if base.startswith("/") or "://" in root else "(?:.*?/)?"
    return F.regexp_extract(path, rf"^(?:[A-Za-z][\w+.-]*:(?://)?)?{start}{glob}/+(.*)$", 1)


def decode_tex(files: DataFrame, encoding: str = "latin1") -> DataFrame:
    """``paper_id, path, content`` to ``paper_id, path, text, utf8_ok``."""
    valid = F.is_valid_utf8(F.col("content").cast("string"))
    if encoding == "utf8":
        files = files.where(valid)
        text = C.decode_utf8(F.col("content"))
    else:
        text = C.decode_latin1(F.col("content"))
    return files.select("paper_id", "path", text.alias("text"), valid.alias("utf8_ok"))


def read_parsed_json(spark: SparkSession, path: str, suffix: str = ".json") -> DataFrame:
    """Parsed documents, one JSON file each; the file name without suffix is the paper id.

    ``damaged`` marks files that are no JSON; their fields are null.
    """
    # the path is encoded as in an address, where a plus sign stands for itself
    encoded = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    name = F.element_at(F.split(F.url_decode(encoded), "/"), -1)
    bare = F.when(name.endswith(suffix), F.expr(f"left(name, length(name) - {len(suffix)})")).otherwise(F.col("name"))
    return (
        spark.read.schema(f"{PARSED_SCHEMA}, __damaged string")
        .option("multiLine", "true")
        .option("columnNameOfCorruptRecord", "__damaged")
        .json(path)
        .withColumn("name", name)
        .select(bare.alias("paper_id"), "title", "abstract", "body", "back", F.col("__damaged").isNotNull().alias("damaged"))
    )


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAIR_SCHEMA).json(path)


def to_base64(files: DataFrame, content: str = "content", out: str = "base64") -> DataFrame:
    return files.withColumn(out, F.base64(content))
