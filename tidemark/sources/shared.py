"""The folder that driver and executors share: tables and checkpoints there outlive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir as the session has it; a temporary folder only on a local master without one."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        path = sc.getConf().get("spark.checkpoint.dir")
        if not path and (not sc.master.startswith("local") or sc.master.startswith("local-")):
            raise ValueError("spark.checkpoint.dir isn't set: set it to a folder that driver and executors share")
        sc.setCheckpointDir(path or tempfile.mkdtemp(prefix="tidemark-"))
    return sc.getCheckpointDir()


def folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """df computed once, its lineage cut."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table, of which later steps read the columns they need."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """df with each row's place from 1 in an order of all rows.

    Ranges are sorted, however many rows are equal in the first columns, and only a count for each range meets on the
    driver. The order should tell all rows apart.
    """
    placed = cut(df.orderBy(*order).withColumn("_range", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    before, firsts = 1, []
    for part, n in sorted(tuple(r) for r in placed.groupBy("_range").count().collect()):
        firsts.append((part, before))
        before += n
    first = df.sparkSession.createDataFrame(firsts or [(0, 1)], "_range int, _first long")
    return placed.join(F.broadcast(first), "_range").withColumn(name, F.col("_first") + F.col("_at")).drop("_range", "_at", "_first")
