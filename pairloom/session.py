"""Session settings used by tests, the benchmark and command-line jobs.

On a cluster the session is given; nothing here is needed beyond ``checkpoint_folder``.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(name: str = "pairloom", cpus: str | None = None) -> SparkSession:
    """A single-machine session for tests and measurements."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for ``DataFrame.checkpoint``; the cluster's own setting always wins.

    Only a local master may fall back to a temporary folder: on a cluster that folder would not be
    shared, and a checkpoint that dies with its machine is worse than none.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="pairloom-checkpoint-")
    sc.setCheckpointDir(folder)
    return folder
