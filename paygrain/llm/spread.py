"""Few, small input splits over all cores."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """df as it is where it has as many partitions as the cluster has cores, else dealt out over them: the work on a text
    costs far more than moving it, and a table in one small file would otherwise keep one core busy."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
