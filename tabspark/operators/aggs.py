"""Aggregates with stated denominators. Null keys are groups unless dropped before."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tabspark.operators.quality import null_safe_join
from tabspark.session import scratch_path


def sum_known(x: Column) -> Column:
    """Null if no value is known."""
    return F.sum(x)


def sum_or_zero(x: Column) -> Column:
    return F.coalesce(F.sum(x), F.lit(0))


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys))


def known_yes(flags: Mapping[str, Column]) -> list[Column]:
    """name_known and name_yes for each three-valued flag: unknown is in neither."""
    return [x for name, c in flags.items() for x in (F.count(c).alias(f"{name}_known"), F.count_if(F.coalesce(c, F.lit(False))).alias(f"{name}_yes"))]


def pooled_ratio(n: Column, d: Column) -> Column:
    """Sum over sum; null where the denominator isn't above zero."""
    total = F.sum(d)
    return F.when(total > 0, F.sum(n) / total)


def paired_ratio(y: Column, v: Column) -> Column:
    """Sum y over sum v, over the rows where v is above zero and y known."""
    both = (v > 0) & y.isNotNull()
    return pooled_ratio(F.when(both, y), F.when(both, v))


def long_metrics(df: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """(keys, metric, n, mean, std, median, total): one row per group and metric. The medians come from value counts, not from a group's rows."""
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    long, group = df.select(*keys, F.inline(cells)), [*keys, "metric"]
    sums = long.groupBy(*group).agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.sum("value").alias("total"))
    medians = exact_quantiles(long, group, "value", [0.5]).withColumn("median", F.get("quantiles", F.lit(0)))
    return null_safe_join(sums, medians.drop("quantiles"), group).select(*group, "n", "mean", "std", "median", "total")


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float]) -> DataFrame:
    """(keys..., quantiles ARRAY<DOUBLE>): exact, with linear interpolation, null values left out.

    Values are counted, the counts sorted by ranges over all tasks, and each range told how many values lie before it (a row
    per group and range), so no task holds a group, however many different values it has.
    """
    work = scratch_path(df.sparkSession, "value-ranges")
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.select(*keys, F.col(value).cast("double").alias("__v")).filter("__v is not null").groupBy(*keys, "__v").agg(F.count("*").alias("__n"))
    # written once: a range's number has to stay what it is
    ranges = counts.repartitionByRange(tasks, *[F.col(k).asc_nulls_first() for k in keys], "__v").withColumn("__range", F.spark_partition_id())
    ranges.write.parquet(work)
    ranges = df.sparkSession.read.schema(ranges.schema).parquet(work)
    sizes = ranges.groupBy(*keys, "__range").agg(F.sum("__n").alias("__size"))
    before = W.partitionBy(*keys).orderBy("__range").rowsBetween(W.unboundedPreceding, -1)  # a row per range
    starts = sizes.withColumns({"__start": F.coalesce(F.sum("__size").over(before), F.lit(0)), "__total": F.sum("__size").over(W.partitionBy(*keys))}).drop("__size")
    placed = null_safe_join(ranges, starts, [*keys, "__range"])
    inside = W.partitionBy(*keys, "__range").orderBy("__v").rowsBetween(W.unboundedPreceding, -1)
    placed = placed.withColumn("__from", F.col("__start") + F.coalesce(F.sum("__n").over(inside), F.lit(0)))
    picks = []
    for p in probabilities:
        at = F.lit(float(p)) * (F.col("__total") - 1)
        holds = lambda rank: (F.col("__from") <= rank) & (rank < F.col("__from") + F.col("__n"))
        low, high = F.max(F.when(holds(F.floor(at)), F.col("__v"))), F.max(F.when(holds(F.ceil(at)), F.col("__v")))
        share = F.max(at - F.floor(at))
        picks.append(F.when(share == 0, low).otherwise(low + (high - low) * share))
    return placed.groupBy(*keys).agg(F.array(*picks).alias("quantiles"))


def bijectivity(df: DataFrame, a: str, b: str) -> DataFrame:
    """Different pairs (a, b) with the degree of either side and whether the pair is one to one."""
    pairs = df.select(a, b).dropna().distinct()
    da, db = pairs.groupBy(a).agg(F.count("*").alias("a_degree")), pairs.groupBy(b).agg(F.count("*").alias("b_degree"))
    return pairs.join(da, a).join(db, b).withColumn("is_bijective", (F.col("a_degree") == 1) & (F.col("b_degree") == 1))


def vocabulary_counts(c: Column, words: Sequence[str], allowed: Column, prefix: str = "n_") -> list[Column]:
    """Rows per word of a fixed vocabulary; null where counts aren't allowed (an aggregate condition)."""
    return [F.when(allowed, F.count_if(F.coalesce(F.lower(F.trim(c)) == w.lower(), F.lit(False)))).alias(prefix + w.lower().replace(" ", "_").replace("-", "_")) for w in words]


def only_value(c: Column) -> Column:
    """The value if the group has exactly one different known value."""
    return F.when(F.min(c) == F.max(c), F.min(c))


def error_metrics(actual: Column, predicted: Column) -> list[Column]:
    e = predicted - actual
    return [F.count(e).alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(e).alias("bias")]
