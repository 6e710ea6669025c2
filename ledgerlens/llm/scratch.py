"""Intermediate tables in the folder that the whole cluster shares."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerlens.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    It cuts the lineage, survives lost executors, and gives Spark the table's
    real size, from which it chooses between a broadcast and a shuffle."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
