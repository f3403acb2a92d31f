"""Positions and running sums within groups of any size: a group is cut into shards, and small tables hold what precedes each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def shard_count(spark: SparkSession, least: int = 64) -> int:
    """A power of two, at least four shards for each shuffle partition, so that no group is one task's."""
    wanted = max(least, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    return 1 << (wanted - 1).bit_length()


def shard_of(key_hash: Column, shards: int) -> Column:
    """Shards in the order of the hash, so that ordering by (shard, hash) is ordering by hash."""
    return F.shiftright(key_hash, 64 - (shards.bit_length() - 1)) + shards // 2


def ranked(df: DataFrame, group: str, key_hash: Column, ties: list[str], shards: int, amount: str | None = None) -> DataFrame:
    """df with position (0-based by hash within group) and, for an amount, its sum before each row."""
    work = df.withColumn("__hash", key_hash).withColumn("__shard", shard_of(F.col("__hash"), shards))
    sums = [F.count("*").alias("__n"), *([F.sum(amount).alias("__a")] if amount else [])]
    sizes = work.groupBy(group, "__shard").agg(*sums)
    before = W.partitionBy(group).orderBy("__shard").rowsBetween(W.unboundedPreceding, -1)  # at most one row per shard
    names = [("__n", "__n0"), *([("__a", "__a0")] if amount else [])]
    starts = sizes.select(F.col(group).alias("__group"), F.col("__shard").alias("__s"), *[F.coalesce(F.sum(a).over(before), F.lit(0)).alias(b) for a, b in names])
    inside = W.partitionBy(group, "__shard").orderBy("__hash", *ties)
    out = work.withColumn("__k", F.row_number().over(inside) - 1)
    if amount:
        out = out.withColumn("__ka", F.coalesce(F.sum(amount).over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    out = out.join(starts, F.col(group).eqNullSafe(F.col("__group")) & (F.col("__shard") == F.col("__s")))
    cols = [*df.columns, (F.col("__k") + F.col("__n0")).alias("position")]
    return out.select(*cols, *([(F.col("__ka") + F.col("__a0")).alias("before")] if amount else []))
