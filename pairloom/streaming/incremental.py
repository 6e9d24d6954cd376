"""Pairs of papers as they land, saved after every few papers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from pairloom.functions import patterns as P
from pairloom.operators.elements import ELEMENT
from pairloom.plans.formula_pairs import formula_pairs
from pairloom.sources.pairlog import PairLog

PAPER_SCHEMA = (
    "paper_id string, tex array<struct<path:string,text:string>>, "
    + ", ".join(f"{s} {ELEMENT}" for s in ("title", "abstract", "body", "back"))
)


def pairs_of_batch(papers: DataFrame) -> DataFrame:
    return formula_pairs(papers.select("paper_id", F.inline("tex")), papers.select("paper_id", "body"))


def save_pairs_of_batch(papers: DataFrame, batch_id: int, out: str) -> None:
    """Pairs of one batch of papers. A batch that is run again replaces what it wrote before."""
    pairs_of_batch(papers).write.mode("overwrite").json(f"{out}/batch={batch_id}")


def stream_formula_pairs(
    spark: SparkSession, landed: str, out: str | PairLog, checkpoint: str, papers_per_save: int = P.SAVE_EVERY_PAPERS
) -> StreamingQuery:
    """Process all landed papers (one JSON file each) not processed before, a few papers per save.

    ``out`` is a folder of JSON, one subfolder per batch, or a ``PairLog``, to which every batch is added whole and once.
    """
    papers = (
        spark.readStream.schema(PAPER_SCHEMA)
        .option("maxFilesPerTrigger", papers_per_save)
        .option("multiLine", "true")
        .json(landed)
    )

    def save(batch: DataFrame, batch_id: int) -> None:
        if isinstance(out, PairLog):
            out.append(pairs_of_batch(batch), f"batch-{batch_id:09d}")
        else:
            save_pairs_of_batch(batch, batch_id, out)

    return (
        papers.writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
