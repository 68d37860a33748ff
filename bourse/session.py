"""Spark session helpers.

The engine never creates its own cluster settings at run time: on a cluster
the session comes from the caller.  ``local_session`` is for tests and the
bench; ``checkpoint_dir`` reads ``spark.checkpoint.dir`` from the session; where it is
unset a local run gets a temporary folder, a cluster run an error.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Session settings the feature plans rely on.  Constraint propagation infers
# predicates over every alias of every projection; on 100+ column plans with
# chained windows it grows combinatorially and dominates planning time.
PLAN_CONF = {
    "spark.sql.constraintPropagation.enabled": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    """A session with the caller's runtime settings and ``PLAN_CONF``; the
    caller's own session is left as it is."""
    if all(spark.conf.get(k, None) == v for k, v in PLAN_CONF.items()):
        return spark
    tuned = spark.newSession()
    for k, v in (spark.conf.getAll | PLAN_CONF).items():
        if spark.conf.isModifiable(k):
            tuned.conf.set(k, v)
    return tuned


def _local_memory() -> str:
    """Driver heap for local runs: 60% of the machine's memory, at most 16g."""
    try:
        with open("/proc/meminfo") as f:
            kb = next(int(line.split()[1]) for line in f if line.startswith("MemTotal"))
        return f"{max(1, min(16, int(kb * 0.6 / (1 << 20))))}g"
    except (OSError, StopIteration, ValueError):
        return "4g"


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "bourse") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in (DEFAULT_CONF | PLAN_CONF).items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("BOURSE_DRIVER_MEMORY", _local_memory()))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Only a local run without one (tests, bench) gets a temporary folder, which
    goes when the driver ends.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        return existing
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir is unset: name a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="bourse-ckpt-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(path)
    return path
