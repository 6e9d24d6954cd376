"""Joins of spans with spans: containment, exclusion and nearest neighbour.

None is written as a range join, which would compare every span with every other of the same document.
Both sides are put in one order and running values carry the answer along (see ``scan.running_values``),
so the work is linear after the sort and a document of any size is spread over many tasks. ``width`` is not
needed for that any more; partitions are cut by numbers of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.operators.scan import Running, running_values

_AT, _TIE, _ROW = "__place", "__tie", "__row"


def _look_up(
    rows: DataFrame,
    rows_at: Column,
    values: DataFrame,
    values_at: Column,
    found: dict[str, tuple[Column, str]],
    keys: Sequence[str],
    forward: bool = False,
    strict: bool = False,
) -> DataFrame:
    """Rows with each of ``found``, the maximum (minimum) of a value at or before (after) the row's place."""
    value_first = forward == strict
    left = rows.select(
        *keys, rows_at.cast("long").alias(_AT), F.lit(1 if value_first else 0).alias(_TIE), F.struct("*").alias(_ROW)
    )
    right = values.select(
        *keys, values_at.cast("long").alias(_AT), F.lit(0 if value_first else 1).alias(_TIE),
        *[value.alias(f"__{name}") for name, (value, _) in found.items()],
    )
    kinds = {name: values.select(value.alias("v")).schema["v"].dataType for name, (value, _) in found.items()}
    both = left.unionByName(right, allowMissingColumns=True)
    scans = {name: Running(F.col(f"__{name}"), how, forward) for name, (_, how) in found.items()}
    return (
        running_values(both, keys, [_AT, _TIE], **scans)
        .where(F.col(_ROW).isNotNull())
        .select(f"{_ROW}.*", *[F.col(name).cast(kinds[name]).alias(name) for name in found])
    )


def assign_to_container(
    spans: DataFrame, containers: DataFrame, keys: Sequence[str], width: int | None = None, strict: bool = False
) -> DataFrame:
    """Spans with ``container_start`` and ``container_end`` of the container around them, else null.

    Containers of a key must not overlap, as the sentences of a text do not: so the last one that has started is the
    one with the largest start and the largest end.
    """
    last = {"__start": (F.col("start"), "max"), "__end": (F.col("end"), "max")}
    found = _look_up(spans, F.col("start"), containers, F.col("start"), last, keys, strict=strict)
    end = F.col("__end")
    inside = (end > F.col("end")) if strict else (end >= F.col("end"))
    return found.select(
        *spans.columns, F.when(inside, F.col("__start")).alias("container_start"), F.when(inside, end).alias("container_end")
    )


def drop_boundaries_inside(
    boundaries: DataFrame, spans: DataFrame, keys: Sequence[str], width: int | None = None
) -> DataFrame:
    """Boundaries whose end lies in no span: no span starts at or before it and reaches it."""
    reach = {"__reach": (F.col("end"), "max")}
    found = _look_up(boundaries, F.col("end"), spans, F.col("start"), reach, keys)
    return found.where(F.col("__reach").isNull() | (F.col("__reach") < F.col("end"))).select(*boundaries.columns)


def nearest_boundaries(
    spans: DataFrame, boundaries: DataFrame, keys: Sequence[str], width: int | None = None, text_end: Column | None = None
) -> DataFrame:
    """Spans with the stretch between the boundaries around them.

    ``sentence_start`` is the end of the last boundary that ends at or before the span, 0 without one;
    ``sentence_end`` is one past the start of the first boundary that starts at or after the span's end,
    ``text_end`` without one.
    """
    earlier = _look_up(spans, F.col("start"), boundaries, F.col("end"), {"sentence_start": (F.col("end"), "max")}, keys)
    earlier = earlier.withColumn("sentence_start", F.coalesce("sentence_start", F.lit(0)))
    later = {"sentence_end": (F.col("start"), "min")}
    found = _look_up(earlier, F.col("end"), boundaries, F.col("start"), later, keys, forward=True)
    end = F.col("sentence_end") + 1
    return found.withColumn("sentence_end", end if text_end is None else F.coalesce(end, text_end))
