"""Token ids in files of shuffled planes.

Documents are put in ascending order of their ids by a range shuffle; each task encodes its stretch and closes a segment
whenever at least ``segment_ids`` ids have come together, always at the end of a document. A segment is a piece of
bytes that can be read by itself:

    magic "PLID", format version, planes (8: bytes, 1: bits), documents, ids, block length, blocks   (header, <4sBBQQII)
    lengths of the four index parts (<4Q), then these parts, each compressed with zstandard:
        document ids (int64), which of them are null (bytes), ids per document (uint64), chunk index (uint32)
    the compressed planes of all blocks

A block holds ``block`` ids (the last one fewer). Its ids are transposed into 4 byte planes or 32 bit planes, lowest
first; every plane is compressed by itself, and a plane of nothing but zeros takes no bytes. The chunk index holds the
compressed length of every plane, so a reader can go to any block. Segments are the rows of a Parquet table
(part, segment, n_docs, n_ids, payload): Spark's commit protocol makes the files whole whatever happens to executors,
and any store that Spark can reach will do. (part, segment) is the order of the ids.

Defined results: a null text is empty and holds the end id alone; a null doc_id comes first; equal ids lie in the order
of their texts; an empty table gives an empty table. doc_id must be an integer.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm import common

_HEADER = struct.Struct("<4sBBQQII")
_PARTS = struct.Struct("<4Q")
SEGMENTS = "part int, segment int, n_docs long, n_ids long, payload binary"


def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """Planes of a block of unsigned 32-bit ids, lowest first; b"" for one of zeros."""
    if bits:
        planes = [np.packbits((ids >> np.uint32(b)) & np.uint32(1)) for b in range(32) if not b or ids.max(initial=0) >> b]
        planes += [np.zeros(0, np.uint8)] * (32 - len(planes))
    else:
        planes = list(np.ascontiguousarray(ids.astype("<u4", copy=False).view(np.uint8).reshape(-1, 4).T))
    return [p.tobytes() if p.any() else b"" for p in planes]


def from_planes(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    out = np.zeros(n, np.uint32)
    for k, plane in enumerate(planes):
        if plane:
            row = np.frombuffer(plane, np.uint8)
            if bits:
                out |= np.unpackbits(row, count=n).astype(np.uint32) << np.uint32(k)
            else:
                out |= row.astype(np.uint32) << np.uint32(8 * k)
    return out


def pack_segment(doc_ids: np.ndarray, null: np.ndarray, counts: np.ndarray, ids: np.ndarray, block: int = 65_536, bits: bool = False, level: int = 3) -> bytes:
    import zstandard

    press = zstandard.ZstdCompressor(level=level).compress
    planes = [p and press(p) for at in range(0, len(ids), block) for p in to_planes(ids[at : at + block], bits)]
    index = np.array([len(p) for p in planes], "<u4")
    parts = [press(x) for x in (doc_ids.astype("<i8").tobytes(), null.astype(np.uint8).tobytes(), counts.astype("<u8").tobytes(), index.tobytes())]
    header = _HEADER.pack(b"PLID", 1, 1 if bits else 8, len(counts), len(ids), block, -(-len(ids) // block))
    return b"".join([header, _PARTS.pack(*map(len, parts)), *parts, *planes])


def unpack_segment(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc_ids, null, ids per document, all ids)."""
    import zstandard

    magic, version, kind, _, n_ids, block, blocks = _HEADER.unpack_from(payload)
    if magic != b"PLID" or version != 1 or kind not in (1, 8):
        raise ValueError("not a segment of token ids")
    open_up = zstandard.ZstdDecompressor().decompress
    at = _HEADER.size + _PARTS.size
    parts = []
    for size in _PARTS.unpack_from(payload, _HEADER.size):
        parts.append(open_up(payload[at : at + size]))
        at += size
    bits = kind == 1
    per_block = 32 if bits else 4
    index = np.frombuffer(parts[3], "<u4").reshape(blocks, per_block)
    ids = np.empty(n_ids, np.uint32)
    for k in range(blocks):
        planes = []
        for size in index[k].tolist():
            planes.append(open_up(payload[at : at + size]) if size else b"")
            at += size
        n = min(block, n_ids - k * block)
        ids[k * block : k * block + n] = from_planes(planes, n, bits)
    return np.frombuffer(parts[0], "<i8"), np.frombuffer(parts[1], np.uint8), np.frombuffer(parts[2], "<u8"), ids


def segments(docs: DataFrame, tokenizer_path: str, end_id: int | None = 0, segment_ids: int = 1 << 18, block: int = 65_536, bits: bool = False) -> DataFrame:
    """``docs`` (doc_id, text) encoded; the rows of the file table."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from pairloom.llm.tokenizing import encoder

        encode = encoder(tokenizer_path).encode_all
        part, number = TaskContext.get().partitionId(), 0
        held: list[tuple] = []

        def close() -> pa.RecordBatch:
            nonlocal number
            doc_ids, null, counts, ids = (np.concatenate(x) for x in zip(*held))
            payload = pack_segment(doc_ids, null, counts, ids, block, bits)
            held.clear()
            number += 1
            row = [[part], [number - 1], [len(counts)], [len(ids)], [payload]]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, types)], names)

        names = ["part", "segment", "n_docs", "n_ids", "payload"]
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]

        def some(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            ids, counts = encode(batch.column(1))
            if end_id is not None:
                ids, counts = np.insert(ids, np.cumsum(counts), end_id).astype(np.uint32), counts + 1
            key = batch.column(0)
            null = key.is_null().to_numpy(zero_copy_only=False)
            doc_ids = key.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
            waiting, ends, first = sum(len(x[3]) for x in held), np.cumsum(counts), 0
            while first < len(counts):
                before = ends[first - 1] if first else 0
                # the document that fills the segment ends it
                last = min(int(np.searchsorted(ends, before + segment_ids - waiting)) + 1, len(counts))
                held.append((doc_ids[first:last], null[first:last], counts[first:last], ids[before : ends[last - 1]]))
                waiting += int(ends[last - 1] - before)
                if waiting >= segment_ids:
                    yield close()
                    waiting = 0
                first = last

        yield from common.in_batches(some, rows=16_384, size=16 << 20)(batches)
        if held:
            yield close()

    common.prepare(docs.sparkSession)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartitionByRange(common.parallelism(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id", "text")
    return rows.mapInArrow(write, SEGMENTS)


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, **options) -> None:
    segments(docs, tokenizer_path, **options).write.mode("overwrite").option("compression", "uncompressed").parquet(path)


def read_tokens(files: DataFrame, digests: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of a file table; ids as little-endian unsigned 32-bit integers in bytes.

    Every segment is decoded by itself. Where it starts comes from sums over its part (one window) and over parts.
    With ``digests`` the ids give way to their crc32 (``ids_crc32``) where they are decoded.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                doc_ids, null, counts, ids = unpack_segment(batch.column(2)[i].as_py())
                ends = np.cumsum(counts).astype(np.int64)
                raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
                starts = ends - counts.astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(counts), batch.column(0)[i].as_py(), np.int32)),
                        pa.array(np.full(len(counts), batch.column(1)[i].as_py(), np.int32)),
                        pa.array(doc_ids, mask=null.astype(bool)),
                        pa.array(starts),
                        pa.array(counts.astype(np.int64)),
                        pa.array([content(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())], kind),
                    ],
                    ["part", "segment", "doc_id", "__at", "n_tokens", name],
                )

    common.prepare(files.sparkSession)
    name, sql_kind, kind = ("ids_crc32", "long", pa.int64()) if digests else ("ids", "binary", pa.binary())
    content = zlib.crc32 if digests else (lambda ids: ids)
    docs = files.select("part", "segment", "payload").mapInArrow(
        read, f"part int, segment int, doc_id long, __at long, n_tokens long, {name} {sql_kind}"
    )
    # staged, so that its true size decides whether it is broadcast: one row per segment
    starts = common.stage(segment_starts(files), "starts")
    return docs.join(starts, ["part", "segment"]).select(
        "doc_id", (F.col("__start") + F.col("__at")).alias("start"), "n_tokens", name
    )


def segment_starts(files: DataFrame) -> DataFrame:
    """(part, segment, __start): ids before each segment. One row per part meets in one task, not one per segment."""
    sizes = files.select("part", "segment", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before_part = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("part", before_part.alias("__part"))
    inside = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("__in", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
    return sizes.join(parts, "part").select("part", "segment", (F.col("__part") + F.col("__in")).alias("__start"))
