"""Python code that runs in executors."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import SparkSession


def ship_by_value(module_name: str) -> None:
    """Send this module's functions inside the task, so executors need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def small_batches(spark: SparkSession, size: str = "8m") -> None:
    """Arrow batches of bounded bytes, as rows vary in size and workers share an executor's memory.

    A session setting, left alone if someone has set it.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == "67108864b":
        spark.conf.set(name, size)


def in_parts(work: Callable[[pd.DataFrame], Iterator[pd.DataFrame]], column: str, size: int = 1 << 20):
    """A ``mapInPandas`` function that hands ``work`` rows of about ``size`` letters or bytes of ``column`` at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch[column].map(lambda value: 0 if value is None else len(value)).to_numpy()
            part = (sizes.cumsum() - sizes) // size
            starts = [0, *(i for i in range(1, len(part)) if part[i] != part[i - 1])]
            for first, after in zip(starts, [*starts[1:], len(batch)]):
                yield from work(batch.iloc[first:after])
            try:
                ctypes.CDLL(None).malloc_trim(0)  # workers live on
            except (AttributeError, OSError):  # another C library
                pass

    return run


ship_by_value(__name__)
