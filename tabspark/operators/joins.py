"""Joins with a checked number of partners, band joins, pairs, overlaps.

Defined results: null keys match nothing unless said otherwise; the columns of the right side that are not keys must not
clash with those of the left (they are renamed with a suffix); an empty side gives an empty inner and an unmatched left join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


class CardinalityError(ValueError):
    """A side that should have one row per key has several."""


def check_unique(df: DataFrame, keys: Sequence[str], what: str = "table") -> None:
    """Raise if a key occurs twice. One aggregate; null keys count like others."""
    if df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1").limit(1).count():
        raise CardinalityError(f"{what}: several rows for one key of {list(keys)}")


def _asserted(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """df that fails while it runs if a key occurs twice. Non-null keys only: null keys never match."""
    n = F.count("*").over(W.partitionBy(*keys))
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return df.withColumn("__n", n).filter(F.when(known & (F.col("__n") > 1), F.raise_error(F.lit(f"{what}: several rows for one key"))).otherwise(F.lit(True)).isNotNull()).drop("__n")


def validated_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left", validate: str = "m:1", indicator: str | None = None, mode: str = "inline", suffix: str = "_right") -> DataFrame:
    """Equi join with validate 'm:1' (right keys unique) or '1:1' (both). mode 'eager' checks before, 'inline' while it runs.

    indicator names a column: 'both', 'left_only' or 'right_only'.
    """
    sides = {"m:1": (False, True), "1:1": (True, True), "1:m": (True, False)}[validate]
    clash = [c for c in right.columns if c in left.columns and c not in on]
    for c in clash:
        right = right.withColumnRenamed(c, c + suffix)
    if mode == "eager":
        for df, wanted, name in ((left, sides[0], "left"), (right, sides[1], "right")):
            if wanted:
                check_unique(df, on, name)
    else:
        left = _asserted(left, on, "left") if sides[0] else left
        if sides[1]:  # null keys match nothing: they needn't meet in one task where the join drops them anyway
            right = _asserted(right.dropna(subset=list(on)) if how in ("inner", "left", "left_outer", "leftouter") else right, on, "right")
    if not indicator:
        return left.join(right, list(on), how)
    out = left.withColumn("__l", F.lit(1)).join(right.withColumn("__r", F.lit(1)), list(on), how)
    side = F.when(F.col("__l").isNull(), "right_only").when(F.col("__r").isNull(), "left_only").otherwise("both")
    return out.withColumn(indicator, side).drop("__l", "__r")


def band_join_unique(left: DataFrame, right: DataFrame, on: Sequence[str], left_at: str, right_at: str, reach: int, left_id: str) -> DataFrame:
    """left rows with the one right row of the same keys at most ``reach`` away (integers); rows with several or none drop out.

    Time is cut into buckets of ``reach``; a right row is put into its own and the two next to it, so the join is an equi
    join on keys and bucket and a hot key is many groups. right columns must not clash with left's.
    """
    bucket = lambda c: F.floor(F.col(c) / reach).cast("long")
    a = left.withColumn("__b", bucket(left_at))
    b = right.withColumn("__b", F.explode(F.array(bucket(right_at) - 1, bucket(right_at), bucket(right_at) + 1)))
    near = a.join(b, [*on, "__b"]).filter(F.abs(F.col(left_at) - F.col(right_at)) <= reach).drop("__b")
    return near.withColumn("__n", F.count("*").over(W.partitionBy(left_id))).filter("__n = 1").drop("__n")


def unordered_pair(a: Column, b: Column) -> Column:
    """STRUCT(low, high) of two values in either order; null if one is null."""
    return F.when(a.isNotNull() & b.isNotNull(), F.struct(F.least(a, b).alias("low"), F.greatest(a, b).alias("high")))


def day_overlaps(df: DataFrame, start_us: str, end_us: str) -> DataFrame:
    """df exploded to the UTC days that [start, end) touches: (day_no, overlap_s)."""
    day = 86_400_000_000
    first, last = F.floor(F.col(start_us) / day).cast("long"), F.floor((F.col(end_us) - 1) / day).cast("long")
    out = df.withColumn("day_no", F.explode(F.when(F.col(end_us) > F.col(start_us), F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))))
    low, high = F.greatest(F.col(start_us), F.col("day_no") * day), F.least(F.col(end_us), (F.col("day_no") + 1) * day)
    return out.withColumn("overlap_s", (high - low) / 1_000_000)


def reciprocal(df: DataFrame, key: str, forward: str, backward: str) -> DataFrame:
    """(key, forward, agrees): whether the row that ``forward`` names points back."""
    other = df.select(F.col(key).alias(forward), F.col(backward).alias("__back"))
    return df.filter(F.col(forward).isNotNull()).join(other, forward, "left").select(key, forward, F.coalesce(F.col("__back") == F.col(key), F.lit(False)).alias("agrees"))
