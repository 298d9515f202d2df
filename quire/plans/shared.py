"""Where plans cut their lineage, and ranks over all rows without one task for all."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cut(df: DataFrame) -> DataFrame:
    """df, checkpointed in the folder that spark.checkpoint.dir names; where it is unset, in one of our own on a local master.

    On a cluster an unset folder is an error: executors and driver share no other.
    """
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="quire-"))
    return df.checkpoint()


def global_rank(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """df with its 1-based rank in an order: ranks within ranges of it, plus the numbers of rows in the ranges before."""
    n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    part = cut(df.repartitionByRange(n, *order).withColumn("__part", F.spark_partition_id()))
    within = part.withColumn("__rank", F.row_number().over(Window.partitionBy("__part").orderBy(*order)))
    # One row for each range, whose number is a setting.
    counts = part.groupBy(F.col("__part").alias("__of")).agg(F.count(F.lit(1)).alias("__n"))
    before = counts.select("__of", F.coalesce(F.sum("__n").over(Window.orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    ranked = within.join(F.broadcast(before), F.col("__part") == F.col("__of"))
    return ranked.select(*df.columns, (F.col("__rank") + F.col("__before")).cast("long").alias(name))
