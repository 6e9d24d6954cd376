"""Exact dedup against a persistent digest index, with DataFrame operations only.

Texts are equal when they are identical without ASCII white space; a null text is an empty one. The index is a table,
bucketed and sorted by digest, with one row per known text: (digest, keep_id, n_chars, batch). A batch of new rows is
reduced to one candidate per digest (partial aggregation before the shuffle, so a text that fills a third of the
table costs one row per task), anti-joined to the index by sort-merge on its buckets, and appended. The row that stays
is, of rows of one batch, the one with the most code points, then the smallest id (a null id comes last); a text that
is already indexed keeps the row it has.

Defined results: no rows give no rows; rows that repeat an id and a text are counted each, and ``new_rows`` returns one
of them; other columns are never looked at, so their names cannot clash (only ``id_column`` and ``text_column`` count).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import common

WHITE_SPACE = " \t\n\x0b\x0c\r"


def normalized(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def digest(text: Column) -> Column:
    """sha256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(normalized(text), 256))


def digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, digest, n_chars) of every row."""
    return docs.select(
        F.col(id_column).alias("doc_id"),
        digest(F.col(text_column)).alias("digest"),
        F.coalesce(F.length(text_column), F.lit(0)).cast("long").alias("n_chars"),
    )


def candidates(rows: DataFrame) -> DataFrame:
    """One row per digest: (digest, keep_id, n_chars, group_size)."""
    best = F.min(F.struct((-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("no_id"), "doc_id"))
    return (
        rows.groupBy("digest")
        .agg(best.alias("best"), F.count("*").alias("group_size"))
        .select("digest", F.col("best.doc_id").alias("keep_id"), (-F.col("best.less")).alias("n_chars"), "group_size")
    )


class DigestIndex:
    """The index in table ``name`` of the session's warehouse; made by the first ``add``."""

    def __init__(self, spark: SparkSession, name: str, buckets: int = 64):
        self.spark, self.name, self.buckets = spark, name, buckets

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def new(self, found: DataFrame) -> DataFrame:
        """Those ``candidates`` that the index does not hold. The index side is neither shuffled nor sorted again."""
        if not self.exists():
            return found
        known = self.read().select("digest").hint("merge")
        return found.join(known, "digest", "left_anti")

    def append(self, found: DataFrame, batch: str) -> None:
        """Add candidates known to be new."""
        rows = found.select("digest", "keep_id", "n_chars", F.lit(batch).alias("batch"))
        bucket = F.pmod(F.hash("digest"), F.lit(self.buckets))  # as Spark deals out buckets: one file for each
        writer = rows.repartition(self.buckets, bucket).write.bucketBy(self.buckets, "digest").sortBy("digest")
        writer.mode("append").format("parquet").saveAsTable(self.name)

    def add(self, docs: DataFrame, batch: str, id_column: str = "doc_id", text_column: str = "text", waves: int = 1) -> DataFrame:
        """Index a batch; its decisions, one row per input row, in the form of ``decisions``.

        A large batch may be appended in ``waves``, so that a failure costs one of them: each takes a further share of
        the digests, and every wave passes all candidates up to its share through the anti-join, whatever waves before it,
        or a first attempt, have appended. A digest has one candidate, so waves change no decision.

        The digests of the batch are staged first: the text is read and hashed once, and the answer no longer
        depends on the index as it changes. A batch whose append has failed may be added again under the same name:
        what it had appended before is known by then and stays.
        """
        rows = common.stage(digests(docs, id_column, text_column), "digests")
        found = common.stage(candidates(rows), "candidates")
        for wave in range(1, waves + 1):
            up_to = found if wave == waves else found.filter(F.pmod(F.xxhash64("digest"), F.lit(waves)) < wave)
            self.append(self.new(up_to), batch)
        kept = self.read().select("digest", "keep_id", "batch")
        classes = common.stage(found.select("digest", "group_size").join(kept, "digest"), "classes")
        return decisions(rows, classes, batch)


def decisions(rows: DataFrame, classes: DataFrame, batch: str) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest): a hot digest is a skewed left side, which AQE splits."""
    mine = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("batch") == batch)
    return rows.join(classes, "digest").select("doc_id", "keep_id", "group_size", mine.alias("kept"), "digest")


def new_rows(index: DigestIndex, docs: DataFrame, batch: str) -> DataFrame:
    """The documents of a batch whose text is new, one row per text, with all their columns.

    Whole rows are compared, so rows that repeat an id and a text leave one; columns that cannot be ordered (maps) are
    not supported here. The text crosses the network once.
    """
    n_chars = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    row = F.struct((-n_chars).alias("__less"), F.col("doc_id").isNull().alias("__no_id"), "doc_id", F.struct(*docs.columns).alias("__row"))
    best = docs.groupBy(digest(F.col("text")).alias("digest")).agg(F.min(row).alias("best"))
    best = best.select("digest", (-F.col("best.__less")).alias("n_chars"), F.col("best.doc_id").alias("keep_id"), F.col("best.__row").alias("row"))
    new = common.stage(index.new(best), "new_rows")
    index.append(new, batch)
    return new.select("row.*")
