"""Sharding by weighted rendezvous hashing, with DataFrame operations only.

Every shard draws a number for a record's key, and the largest wins: -w / ln(u) with u in (0, 1) from a hash of key
and shard. A shard's draws do not depend on other shards, so adding one moves only the records it wins, and changing a
weight moves records only to or from that shard. A shard's share is its part of all weights.

Slots number a shard's records without gaps in the order (bucket of the key's hash, key, text). The buckets, fixed in
number, cut a shard into pieces of even size that are numbered apart; how many records lie before a piece comes from
the counts of the pieces, at most shards x buckets rows whatever the input.

Defined results: a null key hashes as the empty text; a null text has no bytes; rows that repeat key and text lie in
one shard and get slots of their own; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_DIGITS = 13  # hexadecimal digits: 52 bits, exact in a double


def uniform(key: Column, salt: str) -> Column:
    """A number in (0, 1) that depends on key and salt alone."""
    digits = F.substring(F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f":{salt}")).cast("binary")), 1, _DIGITS)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(16**_DIGITS)


def winner(key: Column, weights: Sequence[float]) -> Column:
    """The shard with the largest draw; of equal draws the smallest shard."""
    draws = [F.struct((F.ln(uniform(key, str(i))) / -float(w)).alias("draw"), F.lit(i).alias("shard")) for i, w in enumerate(weights)]
    return F.array_min(F.array(*draws))["shard"]


def assign(docs: DataFrame, weights: Sequence[float], id_column: str = "doc_id", text_column: str = "text", grown_weight: float = 1.0) -> DataFrame:
    """(doc_id, size, text_crc32, shard, grown_shard): ``grown_shard`` is the shard if one more is added."""
    key, text = F.col(id_column), F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(
        key.alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        winner(key, weights).alias("shard"),
        (F.ln(uniform(key, str(len(weights)))) / -float(grown_weight)).alias("__new"),
        F.array_min(F.array(*[F.ln(uniform(key, str(i))) / -float(w) for i, w in enumerate(weights)])).alias("__old"),
    )
    grown = F.when(F.col("__new") < F.col("__old"), F.lit(len(weights))).otherwise(F.col("shard"))
    return rows.withColumn("grown_shard", grown).drop("__new", "__old")


def slots(rows: DataFrame, buckets: int = 4096) -> DataFrame:
    """``assign``'s rows with ``slot``."""
    bucket = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 8), 16, 10).cast("long") % buckets
    rows = rows.withColumn("__bucket", bucket)
    pieces = rows.groupBy("shard", "__bucket").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("shard").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("shard", "__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("shard", "__bucket").orderBy("doc_id", "size", "text_crc32")
    numbered = rows.withColumn("__rank", F.row_number().over(inside) - 1)
    # at most shards x buckets rows of three numbers: a bound that does not grow with the data
    joined = numbered.join(F.broadcast(pieces), ["shard", "__bucket"])
    return joined.withColumn("slot", F.col("__before") + F.col("__rank")).drop("__bucket", "__before", "__rank")


def shard(docs: DataFrame, weights: Sequence[float]) -> DataFrame:
    return slots(assign(docs, weights))
