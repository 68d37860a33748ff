"""Lineage cuts.

A table that several later jobs read (the monthly parts before the joins,
the full monthly dataset before imputation) is materialised with a
reliable ``checkpoint()`` into the cluster's shared ``spark.checkpoint.dir``:
a lost executor then re-reads the checkpoint instead of recomputing the
window stages from the raw tables.  ``localCheckpoint`` is never used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import checkpoint_dir


def materialize(df: DataFrame) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
