"""An append log of pairs: each batch is there whole and once, or not at all.

A batch is written to a folder of its own, which nobody reads yet. Then one small manifest that names the folder is
published by a single rename, which fails if there is a manifest of that name. So a writer that dies in between
leaves a folder that no manifest names, a batch that is run again finds its manifest and adds nothing, and of two
writers of one batch the first wins. Readers see the folders of the manifests and nothing else.

Compaction writes the live batches to one folder and publishes a manifest that replaces theirs. Its name is its number,
so of two compactions that started from the same state one is published. Manifests stay, as the memory of what has been
appended. The rename is atomic where the file system's is (HDFS and the like; local disks for single writers).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Row, SparkSession

from pairloom.sources.files import PAIR_SCHEMA

_MANIFEST = "name string, folder string, replaces array<string>"


class PairLog:
    """Batches of rows of ``schema`` below ``path``."""

    def __init__(self, spark: SparkSession, path: str, schema: str = PAIR_SCHEMA):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _hadoop(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _file_system(self):
        return self._hadoop(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def manifests(self) -> list[Row]:
        """One row per batch or compaction that was published."""
        folder = f"{self.path}/manifest"
        if not self._file_system().exists(self._hadoop(folder)):
            return []
        return self.spark.read.schema(_MANIFEST).json(folder).collect()

    def live(self) -> list[Row]:
        """Those that no compaction has replaced."""
        rows = self.manifests()
        replaced = {name for row in rows for name in row.replaces}
        return sorted((r for r in rows if r.name not in replaced), key=lambda r: r.name)

    def read(self) -> DataFrame:
        return self._read(self.live())

    def _read(self, rows: list[Row]) -> DataFrame:
        if not rows:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{r.folder}" for r in rows])

    def append(self, pairs: DataFrame, name: str) -> bool:
        """Add a batch; False, and nothing added, if there is one of this name already."""
        if any(row.name == name for row in self.manifests()):
            return False
        return self._publish(name, self._write(pairs), [])

    def compact(self) -> bool:
        """Put the live batches into one folder; False if there is nothing to do or another compaction came first."""
        rows = self.manifests()
        live = self.live()
        if len(live) < 2:
            return False
        number = sum(bool(r.replaces) for r in rows)
        return self._publish(f"compaction-{number:06d}", self._write(self._read(live)), [r.name for r in live])

    def _write(self, pairs: DataFrame) -> str:
        folder = f"data/{uuid.uuid4().hex}"
        pairs.write.parquet(f"{self.path}/{folder}")
        return folder

    def _publish(self, name: str, folder: str, replaces: list[str]) -> bool:
        jvm = self.spark._jvm
        system = self._file_system()
        # what begins with a dot is no manifest to readers
        hidden, final = (self._hadoop(f"{self.path}/manifest/{x}") for x in (f".{uuid.uuid4().hex}", f"{name}.json"))
        out = system.create(hidden, False)
        out.write(bytearray(json.dumps({"name": name, "folder": folder, "replaces": replaces}).encode()))
        out.close()
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(hidden, final, self.spark.sparkContext._gateway.new_array(rename, 0))
        except Exception:
            system.delete(hidden, False)
            if system.exists(final):
                return False
            raise
        return True
