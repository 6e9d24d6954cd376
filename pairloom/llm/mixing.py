"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sizes are words. Each source has a weight and a target, its share of a budget by weight; no target exceeds
``max_epochs`` times the source's size, and what that leaves over is shared out again by weight (in closed form:
sources in the order size / weight reach their limits one after the other). A source is taken in complete epochs as
long as they fit; the rest of its target is drawn without replacement: every document gets the exponential key
-ln(u) / w, u from a hash of its id and w its quality weight, documents are taken in the order of their keys, and the
last one is taken if that brings the sum nearer to the target.

The running sum needs no source in one task: keys fall into buckets in their order, each sum starts from the sum of
the buckets before. Buckets are equal steps of the keys' logarithms, whose density is at most 1/e for exponential keys of
any weights, mixed or not; steps are as short as a source's documents ask for, so that a bucket is expected to hold at most
some thousands of documents (``bucket_rows``), unless ids repeat, which share a key.

Defined results: null and empty texts have size 0, no epochs beyond the complete ones, and count nothing; a null source
is a source of its own and comes last; ids that repeat share a key and are ordered by size and text hash; an empty table
gives an empty table. Other columns are untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm import common
from pairloom.llm.sharding import uniform

#: Runs of digits and symbols lower a document's quality weight.
ODD_PATTERN = r"[0-9#*$%&|<>{}=_~^/]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(common.WORD_PATTERN)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """Between 0.1 and 1: less by the number of runs of digits and symbols per word."""
    runs = F.coalesce(F.regexp_count(text, F.lit(ODD_PATTERN)), F.lit(0))
    return F.greatest(F.lit(0.1), 1 - runs / F.greatest(n_words(text), F.lit(1)))


def targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, budget: int | None = None) -> DataFrame:
    """(source, source_size, n_docs) with ``target``. One row per source: its count, not the data's, is what one task sees."""
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    limit = (F.col("source_size") * max_epochs).cast("long")
    rows = sources.withColumn("__w", weight.cast("long")).withColumn("__limit", limit)
    order = Window.orderBy(F.col("__limit") / F.col("__w"), F.col("source").isNull(), "source")
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything) if budget is None else F.lit(budget)
    rows = rows.select(
        "*",
        total.alias("__total"),
        F.coalesce(F.sum("__limit").over(upto), F.lit(0)).alias("__full"),
        (F.sum("__w").over(everything) - F.coalesce(F.sum("__w").over(upto), F.lit(0))).alias("__open"),
    )
    # the level if all before this source are at their limits; the first source below its limit sets it
    level = (F.col("__total") - F.col("__full")).cast("double") / F.col("__open")
    below = level * F.col("__w") <= F.col("__limit")
    first = F.min(F.when(below, F.struct("__full", level.alias("level")))).over(everything)["level"]
    rows = rows.withColumn("__level", first)
    target = F.when(F.col("__level").isNull(), F.col("__limit").cast("double")).otherwise(
        F.least(F.col("__limit").cast("double"), F.col("__level") * F.col("__w"))
    )
    return rows.withColumn("target", target).drop("__w", "__limit", "__total", "__full", "__open", "__level")


def key_bucket(key: Column, steps: Column) -> Column:
    """A bucket number that keeps the order of exponential keys: ``steps`` to each unit of the logarithm."""
    return F.floor(F.least(F.ln(F.greatest(key, F.lit(1e-300))), F.lit(1000.0)) * steps)


def mix(docs: DataFrame, weight: Column | None = None, budget: int | None = None, max_epochs: int = 3, seed: str = "mix", bucket_rows: int = 4096, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (doc_id, source, text, ...) with ``size source_size target copies taken`` per row.

    ``keep`` names the columns of ``docs`` to carry along (all by default; one called like a result gives way to it).
    Sizes and keys are staged, so each text is read once.
    """
    keep = docs.columns if keep is None else keep
    rows = _mix(docs, keep, weight, budget, max_epochs, seed, bucket_rows)
    results = ["size", "source_size", "target", "copies", "taken"]
    return rows.select(*[F.col("row")[c].alias(c) for c in keep if c not in results], *results)


def _mix(docs: DataFrame, keep: list[str], weight: Column | None, budget: int | None, max_epochs: int, seed: str, bucket_rows: int) -> DataFrame:
    """``keep`` as the struct ``row``, next to the results."""
    text = F.col("text")
    key = F.ln(uniform(F.col("doc_id"), seed)) / -(quality_weight(text) if weight is None else weight)
    rows = docs.select(
        F.struct(*keep).alias("row"),
        F.col("doc_id").alias("__mix_id"),
        n_words(text).alias("size"),
        F.coalesce(F.col("source"), F.lit("")).alias("__mix_s"),
        F.col("source").isNull().alias("__mix_n"),
        key.alias("__mix_key"),
        F.crc32(common.text_bytes()).alias("__mix_crc"),
    )
    rows = common.stage(rows, "sizes")
    source = F.when(~F.col("__mix_n"), F.col("__mix_s")).alias("source")
    sources = rows.groupBy(source).agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    goal = targets(sources, max_epochs=max_epochs, budget=budget).select(
        F.coalesce(F.col("source"), F.lit("")).alias("__mix_s"),
        F.col("source").isNull().alias("__mix_n"),
        "source_size",
        "target",
        F.ceil(F.col("n_docs") / bucket_rows).alias("__mix_b"),
    )
    # one row per source; staged, so that its true size decides whether it is broadcast
    rows = rows.join(common.stage(goal, "targets"), ["__mix_s", "__mix_n"])
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rows = rows.withColumn("__mix_e", epochs)
    rows = rows.withColumn("__mix_rest", F.col("target") - F.col("__mix_e") * F.col("source_size"))
    bucket = key_bucket(F.col("__mix_key"), F.col("__mix_b"))
    # dealt out by bucket here, or a source's rows would stay together after a join by source
    rows = rows.withColumn("__mix_bucket", bucket).repartition("__mix_s", "__mix_n", "__mix_bucket")
    sums = rows.groupBy("__mix_s", "__mix_n", "__mix_bucket").agg(F.sum("size").alias("__mix_sum"))
    upto = Window.partitionBy("__mix_s", "__mix_n").orderBy("__mix_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("__mix_before", F.coalesce(F.sum("__mix_sum").over(upto), F.lit(0))).drop("__mix_sum")
    inside = (
        Window.partitionBy("__mix_s", "__mix_n", "__mix_bucket")
        .orderBy("__mix_key", "__mix_id", "size", "__mix_crc")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    rows = rows.join(sums, ["__mix_s", "__mix_n", "__mix_bucket"])
    before = F.col("__mix_before") + F.sum("size").over(inside) - F.col("size")
    chosen = before + F.col("size") / 2 <= F.col("__mix_rest")
    copies = F.col("__mix_e") + F.when(chosen & (F.col("__mix_rest") > 0) & (F.col("size") > 0), 1).otherwise(0)
    rows = rows.withColumn("copies", copies)
    # a source without words has no target: its documents cost nothing and stay once
    rows = rows.withColumn("copies", F.when(F.col("source_size") == 0, F.lit(1)).otherwise(F.col("copies")).cast("long"))
    return rows.withColumn("taken", F.col("copies") * F.col("size"))


def mixed_documents(docs: DataFrame, weight: Column | None = None, budget: int | None = None, max_epochs: int = 3, seed: str = "mix", bucket_rows: int = 4096) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of ``docs``."""
    rows = _mix(docs, docs.columns, weight, budget, max_epochs, seed, bucket_rows).filter("copies > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select("row.*")
