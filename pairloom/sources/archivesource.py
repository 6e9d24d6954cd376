"""Archives and parsed documents as Spark data sources.

``register(spark)`` adds two formats. ``paper_archives`` gives the members of a folder of archives (one per paper,
``<paper_id>.tar.gz``) and writes such a folder; ``paper_elements`` gives the elements of parsed documents (TEI ``.xml``
or ``.json``), one file per paper. Files are planned into tasks by their bytes and read as streams: neither an archive
nor a long member is ever held whole. Rows leave as Arrow batches.

* Columns: only those of the schema given to the reader are made. Without ``content`` no member's bytes are kept.
* Filters: ``paper_id =`` and ``paper_id IN`` leave other papers' files unopened.
* Options: ``partitionBytes`` (128 MB of files a task), ``partBytes`` (8 MB of a member a row), ``path``.

Paths are those that ``pyarrow.fs`` opens (local or mounted folders, and addresses of the stores it knows); driver and
executors must both see them. Hidden files (``_`` or ``.`` in front) are skipped; an empty folder gives no rows.
"""

from __future__ import annotations

import bz2
import gzip
import io
import json
import lzma
import re
import tarfile
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pfs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, WriterCommitMessage,
)
from pyspark.sql.types import StructType

from pairloom.functions.workers import ship_by_value
from pairloom.sources.tei import ELEMENT_ROWS, elements_of

ship_by_value(__name__)

MEMBERS = "paper_id string, archive string, member int, member_path string, part int, last boolean, size long, content binary, status string"
ELEMENTS = f"paper_id string, {ELEMENT_ROWS}"
_DAMAGE = (tarfile.TarError, OSError, EOFError, zlib.error, lzma.LZMAError)
_ARCHIVE = re.compile(r"\.(tar\.gz|tar\.bz2|tar\.xz|tgz|tar|gz)$")
_DOCUMENT = re.compile(r"(\.tei)?\.xml$|\.json$")
_OPENERS = ((b"\x1f\x8b", gzip.open), (b"BZh", bz2.open), (b"\xfd7zXZ", lzma.open))


def _folder(path: str) -> tuple[pfs.FileSystem, str]:
    if "://" in path:
        return pfs.FileSystem.from_uri(path)
    return pfs.LocalFileSystem(), re.sub(r"^file:/*", "/", path)


@dataclass
class _Files(InputPartition):
    files: list[tuple[str, str]]  # (paper_id, path)


class _FolderReader(DataSourceReader):
    """Files of a folder whose names match ``names``, dealt to tasks by their bytes."""

    names: re.Pattern

    def __init__(self, options, schema: StructType):
        self.path = options["path"]
        self.partition_bytes = int(options.get("partitionBytes", 128 << 20))
        self.part_bytes = max(1, int(options.get("partBytes", 8 << 20)))
        self.fields = schema.fieldNames()
        self.papers: set[str] | None = None

    def pushFilters(self, filters):
        for found in filters:
            if isinstance(found, (EqualTo, In)) and found.attribute == ("paper_id",):
                wanted = {found.value} if isinstance(found, EqualTo) else set(found.value)
                self.papers = wanted if self.papers is None else self.papers & wanted
            else:
                yield found

    def partitions(self):
        system, root = _folder(self.path)
        tasks, size = [], 0
        for info in sorted(system.get_file_info(pfs.FileSelector(root, recursive=True)), key=lambda i: i.path):
            below = info.path[len(root) :].strip("/")
            if not info.is_file or not self.names.search(below) or any(p[0] in "._" for p in below.split("/")):
                continue
            paper = self.names.sub("", info.base_name)
            if self.papers is not None and paper not in self.papers:
                continue
            if not tasks or size + info.size > self.partition_bytes:
                tasks.append(_Files([]))
                size = 0
            tasks[-1].files.append((paper, info.path))
            size += info.size
        return tasks or [_Files([])]  # no task at all is not allowed

    def rows(self, paper: str, system: pfs.FileSystem, path: str) -> Iterator[dict]:
        raise NotImplementedError

    def read(self, partition):
        system, _ = _folder(self.path)
        types = {"part": pa.int32(), "member": pa.int32(), "pos": pa.int32(), "size": pa.int64(), "last": pa.bool_(), "content": pa.binary()}
        schema = pa.schema([(name, types.get(name, pa.string())) for name in self.fields])
        rows, size = [], 0
        for paper, path in partition.files:
            for row in self.rows(paper, system, path):
                rows.append({name: row[name] for name in self.fields})
                size += len(row.get("content") or b"") if "content" in self.fields else len(row.get("txt") or "")
                if len(rows) >= 4096 or size >= 8 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


def _opened(raw):
    """The stream without its compression; the first bytes say which one."""
    start = raw.read(6)
    raw.seek(0)
    return next((opener(raw) for magic, opener in _OPENERS if start.startswith(magic)), raw)


def stream_members(raw, part_bytes: int, content: bool = True) -> Iterator[tuple]:
    """(member_path, part, last, size, content, status) of an archive, read front to back; part 0 starts a member.

    What is no tar archive is taken as one compressed file (path null: it has no name of its own). A member longer than
    ``part_bytes`` comes in numbered parts. A damaged archive gives what was read before the damage, then a row
    with status ``failed``; a member that would land outside the folder gives its path with status ``unsafe``. A file without
    a byte is damaged.
    """
    failed = (None, 0, True, None, None, "failed")
    try:
        stream = _opened(raw)
        archive = tarfile.TarFile(fileobj=stream, mode="r")
    except _DAMAGE:
        yield from _lone_file(raw, part_bytes, content, failed)
        return
    try:
        while (member := archive.next()) is not None:
            archive.members.clear()  # the list of what has gone by
            path = member.name.lstrip("/")
            if ".." in path.split("/"):
                yield path, 0, True, member.size, None, "unsafe"
            elif member.isfile() and not content:
                yield path, 0, True, member.size, None, "tar"
            elif member.isfile():
                source, left, part = archive.extractfile(member), member.size, 0
                while part == 0 or left:
                    some = source.read(min(left, part_bytes))
                    left -= len(some)
                    yield path, part, not left, member.size, some, "tar"
                    part += 1
        stream.seek(archive.offset)
        end = stream.read(512)
        if len(end) < 512 or end.strip(b"\0"):
            yield failed  # it ends without its end mark
    except _DAMAGE:
        yield failed


def _lone_file(raw, part_bytes: int, content: bool, failed: tuple) -> Iterator[tuple]:
    try:
        raw.seek(0)
        stream = _opened(raw)
        some = stream.read(part_bytes) if stream is not raw else None
        if some is None or some[257:262] == b"ustar":  # a damaged archive is no file of its own
            yield failed
            return
        part, size = 0, len(some)
        while True:
            after = stream.read(part_bytes)
            size += len(after)
            if content:
                yield None, part, not after, None if after else size, some, "gzip"
                part += 1
            if not after:
                break
            some = after
        if not content:
            yield None, 0, True, size, None, "gzip"
    except _DAMAGE:
        yield failed


class ArchiveReader(_FolderReader):
    names = _ARCHIVE

    def rows(self, paper, system, path):
        with system.open_input_file(path) as file:
            raw = io.BufferedReader(file, 1 << 20)
            member = -1
            for name, part, last, size, content, status in stream_members(raw, self.part_bytes, "content" in self.fields):
                member += part == 0
                yield {
                    "paper_id": paper, "archive": path, "member": member, "member_path": paper if status == "gzip" else name,
                    "part": part, "last": last, "size": size, "content": content, "status": status,
                }


@dataclass
class _Written(WriterCommitMessage):
    files: int


class ArchiveWriter(DataSourceArrowWriter):
    """Each row's ``content`` as ``<paper_id>.tar.gz``, under its name by one rename: a task that runs twice leaves one file."""

    def __init__(self, options):
        self.path = options["path"]

    def write(self, iterator):
        system, root = _folder(self.path)
        system.create_dir(root, recursive=True)
        n = 0
        for batch in iterator:
            for paper, content in zip(batch.column("paper_id").to_pylist(), batch.column("content")):
                if paper is None or "/" in paper or paper[:1] in ("", ".", "_"):
                    raise ValueError(f"no file name: {paper!r}")
                hidden = f"{root}/.{paper}.{uuid.uuid4().hex}"
                with system.open_output_stream(hidden, compression=None) as out:
                    out.write(content.as_buffer() or b"")
                system.move(hidden, f"{root}/{paper}.tar.gz")
                n += 1
        return _Written(n)


class PaperArchives(DataSource):
    @classmethod
    def name(cls):
        return "paper_archives"

    def schema(self):
        return MEMBERS

    def reader(self, schema):
        return ArchiveReader(self.options, schema)

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("archives are added, with mode('append'); a paper's own file is replaced")
        return ArchiveWriter(self.options)


def _parsed_elements(content: bytes) -> list[tuple]:
    """Rows of a parsed JSON document, as ``tei.elements_of`` gives them."""
    keys = ("el_type", "txt", "tail", "coords", "xml_id", "type", "target")
    rows = []
    try:
        document = json.loads(content)
        for section in ("title", "abstract", "body", "back"):
            for pos, element in enumerate(document.get(section) or []):
                rows.append((section, pos, *(element.get(k) for k in keys)))
    except (ValueError, AttributeError, TypeError):
        return [("failed", 0, "failed", *[None] * 6)]
    return rows


class ElementReader(_FolderReader):
    names = _DOCUMENT

    def rows(self, paper, system, path):
        columns = [part.split()[0] for part in ELEMENTS.split(", ")]
        with system.open_input_file(path) as file:
            parse = _parsed_elements if path.endswith(".json") else elements_of
            for row in parse(file.read()):
                yield dict(zip(columns, (paper, *row)))


class PaperElements(DataSource):
    @classmethod
    def name(cls):
        return "paper_elements"

    def schema(self):
        return ELEMENTS

    def reader(self, schema):
        return ElementReader(self.options, schema)


def register(spark: SparkSession) -> None:
    """Add both formats to the session, and let filters reach them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (PaperArchives, PaperElements):
        spark.dataSource.register(source)


def read_archives(spark: SparkSession, path: str, **options) -> DataFrame:
    register(spark)
    return spark.read.format("paper_archives").options(**options).load(path)


def read_whole_members(spark: SparkSession, path: str, **options) -> DataFrame:
    """Members as one row each, in one pass; what is beyond a gigabyte is no row, and has status ``failed``.

    A task holds one member at a time. ``whole_members`` has no such bound, for parts that are there already.
    """
    members = read_archives(spark, path, partBytes=str(1 << 30), **options)
    status = F.when(F.col("last"), F.col("status")).otherwise("failed")
    return members.where(F.col("part") == 0).withColumn("status", status).drop("part", "last")


def whole_members(members: DataFrame) -> DataFrame:
    """Rows of ``paper_archives`` with the parts of each member put together; only members in parts are shuffled.

    The rows are gone over twice: for single parts and for the rest.
    A member that damage cuts off gives no row; the row with status ``failed`` stands for it.
    """
    keys = ["paper_id", "archive", "member", "member_path", "status"]
    order = [*keys, "n_parts", "size", "content"]
    alone = members.where((F.col("part") == 0) & F.col("last")).withColumn("n_parts", F.lit(1))
    cut = members.where((F.col("part") > 0) | ~F.col("last")).groupBy(*keys)
    joined = cut.agg(
        F.count("*").cast("int").alias("n_parts"), F.max("size").alias("size"), F.max("last").alias("whole"),
        F.sort_array(F.collect_list(F.struct("part", "content"))).alias("parts"),
    ).where("whole")
    content = F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["content"])), ""))
    return alone.select(*order).unionByName(joined.withColumn("content", content).select(*order))
