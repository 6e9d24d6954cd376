"""Source archives to member files."""

from __future__ import annotations

import gzip
import io
import tarfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from pairloom.functions.workers import in_parts, ship_by_value, small_batches

ship_by_value(__name__)


_DAMAGE = (tarfile.TarError, OSError, EOFError, zlib.error)


def members_of(paper_id: str, content: bytes) -> Iterator[tuple[str | None, bytes | None, str]]:
    """Path, bytes and status of each regular file; what is no tar archive is taken as one gzip file.

    A damaged archive gives the members before the damage and then a row with status ``failed``; a member that
    would land outside the folder gives its path with status ``unsafe``, and the others are read.
    """
    try:
        archive = tarfile.open(fileobj=io.BytesIO(content), mode="r:*")
    except _DAMAGE:
        try:
            alone = gzip.decompress(content)
        except _DAMAGE:
            alone = None
        # a damaged archive is no file of its own
        if alone is None or alone[257:262] == b"ustar":
            yield None, None, "failed"
        else:
            yield paper_id, alone, "gzip"
        return
    with archive:
        try:
            for member in archive:
                path = member.name.lstrip("/")
                if ".." in path.split("/"):
                    yield path, None, "unsafe"
                elif member.isfile():
                    yield path, archive.extractfile(member).read(), "tar"
            at = archive.offset
            archive.fileobj.seek(at)
            if not archive.fileobj.read(512).strip(b"\0") == b"" or archive.fileobj.tell() < at + 512:
                yield None, None, "failed"  # it ends without its end mark
        except _DAMAGE:
            yield None, None, "failed"


def unpack_archives(archives: DataFrame) -> DataFrame:
    """``paper_id, content`` to ``paper_id, member_path, content, status``; damage gives rows with status 'failed'."""

    def unpack(part: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for paper_id, content in part[["paper_id", "content"]].itertuples(index=False):
            found = [(paper_id, *member) for member in members_of(paper_id, bytes(content))]
            yield pd.DataFrame.from_records(found, columns=["paper_id", "member_path", "content", "status"])

    small_batches(archives.sparkSession)
    return archives.select(F.col("paper_id").cast("string"), "content").mapInPandas(
        in_parts(unpack, "content"), "paper_id string, member_path string, content binary, status string"
    )


def pending_archives(archives: DataFrame, landed: DataFrame) -> DataFrame:
    """Archives whose paper has no files yet; a lone PDF does not count."""
    done = (
        landed.groupBy("paper_id")
        .agg(F.count("*").alias("__n"), F.count_if(F.col("path").endswith(".pdf")).alias("__pdf"))
        .where((F.col("__n") > 1) | (F.col("__pdf") == 0))
    )
    return archives.join(done.select("paper_id"), "paper_id", "left_anti")
