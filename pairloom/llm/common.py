"""What the operators of this package share: staging, reading tables, hashing, running Arrow batches.

Null handling everywhere: a null text is an empty text, and a null id is a value of its own.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import pairloom
from pairloom.session import ensure_checkpoint_dir

#: Words are runs of anything but these characters (ASCII white space; ``bytes.split`` cuts at the same ones).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables, below ``spark.checkpoint.dir`` (shared by driver and executors)."""
    return f"{ensure_checkpoint_dir(spark)}/stage-{uuid.uuid4().hex}/{name}"


def stage(frame: DataFrame, name: str, path: str | None = None, compression: str | None = None) -> DataFrame:
    """Write and reread: cuts lineage, survives lost executors, and fixes what a task has numbered.

    Unlike ``checkpoint`` the copy is columnar and compressed. The folder is temporary data of the job: whoever
    owns ``spark.checkpoint.dir`` removes it when the job is over (``drop_stage`` does for one table).
    """
    spark = frame.sparkSession
    path = path or stage_path(spark, name)
    frame.write.mode("overwrite").parquet(path, compression=compression)
    return spark.read.schema(frame.schema).parquet(path)


def drop_stage(spark: SparkSession, path: str) -> None:
    """Remove a staged table that nothing reads any more."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def prepare(spark: SparkSession, batch: str = "10m") -> None:
    """What tasks in Python need: this package, and Arrow batches of bounded size.

    The package goes to the executors as ``--py-files`` would send it, once per application. The batch size is a
    session setting, left alone if someone has set it: rows vary in size, and tasks share an executor's memory.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == "67108864b":
        spark.conf.set(name, batch)
    context = spark.sparkContext
    if not getattr(context, "_pairloom_sent", False):
        home = Path(pairloom.__file__).parent
        target = Path(tempfile.mkdtemp()) / "pairloom.zip"
        with zipfile.ZipFile(target, "w") as out:
            for file in sorted(home.rglob("*.py")):
                out.write(file, file.relative_to(home.parent))
        context.addPyFile(str(target))
        context._pairloom_sent = True


def text_bytes(text: str = "text") -> Column:
    """The text as UTF-8 bytes, empty for null: Python tasks split and hash bytes without decoding them."""
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def crc_mod(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo a small number (null ids: as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def in_batches(work: Callable[[list[pa.RecordBatch]], Iterator[pa.RecordBatch]], rows: int = 512, size: int = 8 << 20):
    """A ``mapInArrow`` function that hands ``work`` slices of bounded rows and bytes (one row at least)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            while start < batch.num_rows:
                n = rows
                while n > 1 and batch.slice(start, n).nbytes > size:
                    n //= 2
                yield from work(batch.slice(start, n))
                start += n
            give_back()

    return run


def give_back() -> None:
    """Return freed memory to the system, as workers live on and share an executor's memory."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit values (the finaliser of a common generator)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x += np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


class WordHashes(dict):
    """Word (bytes) to 64-bit hash, remembered between calls up to a bound; the values do not depend on the bound."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words, in order; a shorter text is one run, no words give none."""
    if not len(hashes):
        return hashes
    width = min(width, len(hashes))
    n = len(hashes) - width + 1
    out = mix64(hashes[:n])
    with np.errstate(over="ignore"):
        for k in range(1, width):
            out = mix64(out * np.uint64(3) + hashes[k : k + n])
    return out
