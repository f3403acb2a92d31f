"""Resolving identities: unique matches, lookups without ambiguous keys, typed statements, places, adjacent evidence.

A match that isn't unique is no match: nothing is picked. Null keys match nothing. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tabspark.functions.mathx import haversine_m


def unambiguous(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys are known and occur once; ambiguous keys drop out as a whole."""
    known = df.dropna(subset=list(keys))
    once = known.groupBy(*keys).agg(F.count("*").alias("__n")).filter("__n = 1").drop("__n")
    return known.join(once, list(keys))


def dropped_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: n_null (a key is null) and n_ambiguous (rows of keys that occur several times)."""
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    sizes = df.withColumn("__null", null).groupBy("__null", *keys).agg(F.count("*").alias("__n"))
    return sizes.agg(F.coalesce(F.sum(F.when(F.col("__null"), F.col("__n"))), F.lit(0)).alias("n_null"), F.coalesce(F.sum(F.when(~F.col("__null") & (F.col("__n") > 1), F.col("__n"))), F.lit(0)).alias("n_ambiguous"))


def repair(df: DataFrame, column: str, lookup: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """df with nulls of column filled from the lookup's rows of unique keys; what can't be found stays null."""
    once = unambiguous(lookup.select(*keys, value).distinct(), keys).withColumnRenamed(value, "__value")
    return df.join(once, list(keys), "left").withColumn(column, F.coalesce(column, "__value")).drop("__value")


def unique_match(left: DataFrame, right: DataFrame, on: Sequence[str], left_id: str, right_id: str) -> DataFrame:
    """(left_id, right_id, status): 'unique', or 'several' where either side has more than one partner. Works on degrees."""
    pairs = left.select(*on, left_id).dropna().distinct().join(right.select(*on, right_id).dropna().distinct(), list(on)).select(left_id, right_id).distinct()
    by_left, by_right = (pairs.groupBy(c).agg(F.count("*").alias(f"__{c}")) for c in (left_id, right_id))
    out = pairs.join(by_left, left_id).join(by_right, right_id)
    return out.select(left_id, right_id, F.when((F.col(f"__{left_id}") == 1) & (F.col(f"__{right_id}") == 1), "unique").otherwise("several").alias("status"))


def linked_by_pattern(df: DataFrame, text: str, pattern: str, names: Sequence[str], lookup: DataFrame, keep: Sequence[str]) -> DataFrame:
    """df rows whose text names exactly one lookup row by the groups of a pattern (a link, say). names are the groups' columns."""
    found = df.filter(F.col(text).rlike(pattern)).select(*keep, *[F.regexp_extract(text, pattern, i + 1).alias(n) for i, n in enumerate(names)])
    return found.join(unambiguous(lookup, names), list(names))


def adjacent_blocks(df: DataFrame, blocks: str, keep: Sequence[str], linked: str, reach: int = 2) -> DataFrame:
    """(keep..., pos, block): the up to ``reach`` blocks after each block that matches ``linked``, within one document."""
    after = F.transform(F.col(blocks), lambda b, i: F.struct(i.alias("pos"), b.alias("block"), F.exists(F.slice(F.col(blocks), F.greatest(i - reach + 1, F.lit(1)), F.least(i, F.lit(reach))), lambda x: x.rlike(linked)).alias("near")))
    return df.select(*keep, F.inline(after)).filter("near").drop("near")


def typed_statement(value: Column, precision: Column, kind: str) -> Column:
    """STRUCT(value, reason) of a statement's JSON value: kind 'day' wants precision 11, 'count' an exact whole amount without a unit."""
    if kind == "day":
        day = F.to_date(F.try_to_timestamp(F.regexp_extract(value, r"(\d{4}-\d{2}-\d{2})", 1), F.lit("yyyy-MM-dd")))
        reason = F.when(value.isNull(), "missing").when(precision != 11, "precision").when(day.isNull(), "invalid")
        return F.struct(F.when(reason.isNull(), day.cast("string")).alias("value"), reason.alias("reason"))
    amount = F.from_json(value, "amount string, unit string, upperBound string, lowerBound string")
    number = amount["amount"].try_cast("decimal(38,6)")
    exact = F.coalesce((amount["upperBound"].isNull() | (amount["upperBound"] == amount["amount"])) & (amount["lowerBound"].isNull() | (amount["lowerBound"] == amount["amount"])), F.lit(False))
    reason = F.when(value.isNull(), "missing").when(number.isNull(), "invalid").when(F.coalesce(amount["unit"], F.lit("")) != "1", "unit").when(~exact, "bounds").when(number != F.floor(number), "fraction").when(number < 0, "negative")
    return F.struct(F.when(reason.isNull(), number.cast("decimal(32,0)").cast("string")).alias("value"), reason.alias("reason"))


def place_matches(a: DataFrame, b: DataFrame, on: Sequence[str], a_id: str, b_id: str, metres: float) -> DataFrame:
    """(a_id, b_id, metres): pairs of the same keys at most so far apart, where each has one partner only. Columns lat, lon."""
    right = b.select(*on, b_id, F.col("lat").alias("__lat"), F.col("lon").alias("__lon"))
    near = a.join(right, list(on)).withColumn("metres", haversine_m(F.col("lat"), F.col("lon"), F.col("__lat"), F.col("__lon"))).filter(F.col("metres") <= metres)
    alone = lambda c: F.count("*").over(W.partitionBy(c)) == 1
    return near.withColumns({"__a": alone(a_id), "__b": alone(b_id)}).filter("__a and __b").select(a_id, b_id, "metres")


def before_cutoff(df: DataFrame, cutoffs: DataFrame, key: str, source: str, received: str, cutoff: str) -> DataFrame:
    """Rows whose source time and receipt both lie before their key's cutoff; an unknown source time goes by the receipt."""
    joined = df.join(cutoffs.select(key, cutoff), key)
    return joined.filter((F.col(received) < F.col(cutoff)) & F.coalesce(F.col(source) < F.col(cutoff), F.lit(True))).drop(cutoff)


def profile_long(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(metric, n): one wide aggregate turned long. checks are aggregates that give counts."""
    row = df.agg(*[c.cast("long").alias(n) for n, c in checks.items()])
    return row.select(F.inline(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("n")) for n in checks])))


def rollup_json(df: DataFrame, group: str, metric: str, value: str) -> DataFrame:
    """(group, metrics): the metrics of each group as one JSON object with sorted keys; a metric that occurs twice fails."""
    once = df.groupBy(group, metric).agg(F.max(value).alias("v"), F.count("*").alias("n"))
    checked = once.withColumn("v", F.when(F.col("n") == 1, F.col("v")).otherwise(F.raise_error(F.lit("a metric occurs twice")).cast("long")))
    return checked.groupBy(group).agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct(metric, "v"))))).alias("metrics"))
