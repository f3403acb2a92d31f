"""Spreading few input partitions over the cores before Python reads them."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """df over at least as many partitions as there are cores; large inputs, which have more, stay as they are. Layout only."""
    wanted = df.sparkSession.sparkContext.defaultParallelism
    have = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df.repartition(wanted) if have < wanted else df
