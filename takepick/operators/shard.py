"""Sharding, batches, remaining work and shard status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from takepick.sources.shared import checkpointed

KEY = ["id", "candidate_index"]


def with_position(df: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """Global 0-based positions in the given order, without gathering rows in one task.

    Rows are sorted by range and written down in the shared folder; only one count
    per range partition is gathered.  The order must be total for the positions to
    be well defined.
    """
    rows = checkpointed(df.sort(*order).withColumns({"_p": F.spark_partition_id(), "_m": F.monotonically_increasing_id()}))
    sizes = rows.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_first"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.join(F.broadcast(sizes.select("_p", "_first", before.alias("_before"))), "_p").withColumn(name, F.col("_before") + F.col("_m") - F.col("_first")).drop("_p", "_m", "_first", "_before")


def round_robin(df: DataFrame, workers: int, order: list[str]) -> DataFrame:
    """``shard_id``: position modulo the number of shards, which is no more than there are rows (one at least)."""
    placed = with_position(df, order)
    n = F.greatest(F.lit(1), F.least(F.lit(workers), F.col("_rows")))
    total = F.broadcast(placed.agg(F.count(F.lit(1)).alias("_rows")))
    return placed.crossJoin(total).withColumn("shard_id", F.pmod("position", n).cast("int")).drop("_rows")


def batches(df: DataFrame, size: int, order: list[str]) -> DataFrame:
    """``batch_id`` of fixed-size batches; the last is short."""
    return with_position(df, order).withColumn("batch_id", F.expr(f"position div {int(size)}"))


def succeeded(labels: DataFrame) -> DataFrame:
    """Keys with a label whose error is null (an empty error text is not)."""
    return labels.where("error is null and id is not null and candidate_index is not null").select(*KEY).distinct()


def todo(manifest: DataFrame, labels: DataFrame, overwrite: bool = False) -> DataFrame:
    """Manifest rows still without a successful label; rows repeated in the manifest are kept."""
    return manifest if overwrite else manifest.join(succeeded(labels), KEY, "left_anti")


def shard_status(manifest: DataFrame, labels: DataFrame) -> DataFrame:
    """shard_id, required and done keys, and whether the shard is complete."""
    keys = manifest.select("shard_id", *KEY).distinct()
    done = succeeded(labels).withColumn("_done", F.lit(True))
    return (
        keys.join(done, KEY, "left")
        .groupBy("shard_id")
        .agg(F.count(F.lit(1)).alias("required"), F.count("_done").alias("done"))
        .withColumn("complete", F.col("required") == F.col("done"))
    )


def balanced_shards(df: DataFrame, workers: int, cost: Column, order: list[str]) -> DataFrame:
    """``shard_id`` dealt back and forth by falling cost, so that long recordings don't meet in one shard."""
    placed = with_position(df.withColumn("_cost", -cost), ["_cost", *order]).drop("_cost")
    lap, at = F.expr(f"position div {workers}"), F.pmod("position", F.lit(workers))
    return placed.withColumn("shard_id", F.when(lap % 2 == 0, at).otherwise(workers - 1 - at).cast("int"))
