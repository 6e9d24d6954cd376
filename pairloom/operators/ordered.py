"""Operators over the ordered rows of a key, none of which has to fit one task.

Running values, places and offsets are scans (``scan.running_values``): one range exchange, which cuts a hot key
wherever its rows are many, and one summary row per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from pairloom.operators.scan import Running, running_values


def running(
    df: DataFrame,
    keys: Sequence[str],
    chunk: str,
    order: Sequence[str],
    value: Column,
    out: str,
    how: str = "sum",
    forward: bool = False,
    include_current: bool = True,
) -> DataFrame:
    """Add the sum, maximum or minimum of a whole number over all rows up to (or, forward, from) this one.

    ``chunk`` must not decrease along the order; it need not cut a key anywhere in particular.
    """
    kind = df.select(value.alias("__value")).schema["__value"].dataType
    found = running_values(df, keys, [chunk, *order], **{out: Running(value, how, forward, include_current)})
    return found if how == "sum" else found.withColumn(out, F.col(out).cast(kind))


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "position") -> DataFrame:
    """Add the place, from 0, of every row of a key in ``order``."""
    return running_values(df, keys, order, **{out: Running(F.lit(1), include_current=False)})


def running_offsets(
    df: DataFrame, keys: Sequence[str], chunk: str, order: Sequence[str], text: str, out: str = "offset"
) -> DataFrame:
    """Add the start offset of every piece in its concatenated document."""
    return running(df, keys, chunk, order, F.length(text).cast("long"), out, include_current=False)


def between_sentinels(
    df: DataFrame, keys: Sequence[str], order: str, is_marker: Column, is_item: Column
) -> DataFrame:
    """Items after the first marker of a listing and before the first other row that follows it.

    Two minima per key decide which rows stay, so no ordered scan is needed. Later markers neither stop
    the run nor belong to it.
    """
    keys = list(keys)
    marked = df.withColumn("__marker", F.coalesce(is_marker, F.lit(False))).withColumn(
        "__item", F.coalesce(is_item, F.lit(False)) & ~F.col("__marker")
    )
    first = marked.where("__marker").groupBy(*keys).agg(F.min(order).alias("__from"))
    after = marked.join(first, keys, "inner").where(F.col(order) > F.col("__from"))
    stop = after.where(~F.col("__item") & ~F.col("__marker")).groupBy(*keys).agg(F.min(order).alias("__to"))
    return (
        after.where("__item")
        .join(stop, keys, "left")
        .where(F.col("__to").isNull() | (F.col(order) < F.col("__to")))
        .drop("__from", "__to", "__marker", "__item")
    )


def merge_short(
    df: DataFrame,
    keys: Sequence[str],
    chunk: str,
    order: str,
    length: str,
    limit: int,
) -> DataFrame:
    """Number the groups that arise when pieces of at most ``limit`` length join their successors.

    Adds ``group_end``, the order value of the piece that closes the group. A group closes when it is
    longer than ``limit`` or the key ends. All that a chunk has to know of earlier ones is the length of
    the group still open, a number up to ``limit``; so each chunk lists its result for every possible
    number, and the lists are chained. A chunk that holds one long piece has the same result for all, which
    cuts the chain: only runs of chunks made of short pieces alone are chained in one fold.
    """
    keys = list(keys)
    cells = [*keys, chunk]

    def grown(open_length: Column, piece: Column) -> Column:
        total = open_length + piece["length"]
        return F.when(total <= limit, total).otherwise(F.lit(0).cast("long"))

    pieces = df.groupBy(*cells).agg(
        F.sort_array(
            F.collect_list(F.struct(F.col(order).alias("at"), F.col(length).cast("long").alias("length")))
        ).alias("__pieces")
    )
    exits = F.transform(
        F.sequence(F.lit(0), F.lit(limit)),
        lambda start: F.aggregate("__pieces", start.cast("long"), grown),
    )
    by_chunk = Window.partitionBy(*keys).orderBy(chunk)
    chain = (
        pieces.select(*cells, exits.alias("__exits"))
        .withColumn("__fixed", F.array_min("__exits") == F.array_max("__exits"))
        .withColumn(
            "__run",
            F.coalesce(
                F.sum(F.col("__fixed").cast("int")).over(by_chunk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ),
        )
        .withColumn(
            "__enter",
            F.coalesce(
                F.when(F.lag("__fixed").over(by_chunk), F.lag(F.get("__exits", F.lit(0))).over(by_chunk)), F.lit(0)
            ).cast("long"),
        )
    )
    folded = chain.groupBy(*keys, "__run").agg(
        F.sort_array(F.collect_list(F.struct(chunk, "__exits", "__enter"))).alias("__chain")
    )
    entered = folded.withColumn(
        "__open",
        F.aggregate(
            "__chain",
            F.array(F.get("__chain", F.lit(0))["__enter"]),
            lambda acc, c: F.concat(acc, F.array(F.get(c["__exits"], F.element_at(acc, -1).cast("int")))),
        ),
    ).select(
        *keys,
        F.inline(
            F.zip_with(
                "__chain",
                F.slice("__open", F.lit(1), F.size("__chain")),
                lambda c, o: F.struct(c[chunk].alias(chunk), o.alias("__open_length")),
            )
        ),
    )
    opened = pieces.join(entered, cells).withColumn(
        "__state",
        F.aggregate(
            "__pieces",
            F.array(F.col("__open_length")),
            lambda acc, p: F.concat(acc, F.array(grown(F.element_at(acc, -1), p))),
        ),
    )
    rows = opened.select(
        *cells,
        F.inline(
            F.zip_with(
                "__pieces",
                F.slice("__state", F.lit(1), F.size("__pieces")),
                lambda p, c: F.struct(
                    p["at"].alias(order), p["length"].alias(length), (c + p["length"] > limit).alias("__closes")
                ),
            )
        ),
    )
    closed = running(
        rows, keys, chunk, [order], F.when(F.col("__closes"), F.col(order)), "group_end", "min", forward=True
    )
    last = rows.groupBy(*keys).agg(F.max(order).alias("__last"))
    return closed.join(last, keys).select(*cells, order, length, F.coalesce("group_end", "__last").alias("group_end"))
