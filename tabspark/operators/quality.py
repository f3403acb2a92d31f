"""Duplicates, conflicts, quarantine, reasons, gates and table reports. Nulls in keys group together."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first by an order that leaves no ties."""
    return df.withColumn("__k", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("__k = 1").drop("__k")


def duplicate_flag(df: DataFrame, keys: Sequence[str], name: str = "is_duplicate") -> DataFrame:
    """Every member of a group of several is flagged. Counts are made first, so a hot key isn't gathered in one window."""
    n = df.groupBy(*keys).agg((F.count("*") > 1).alias(name))
    return null_safe_join(df, n, keys)


def null_safe_join(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    renamed = other.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in other.columns if c not in keys])
    on = F.lit(True)
    for k in keys:
        on = on & df[k].eqNullSafe(renamed[f"__{k}"])
    return df.join(renamed, on, how).drop(*[f"__{k}" for k in keys])


def group_quarantine(df: DataFrame, group: Sequence[str], bad: Column, name: str = "is_quarantined") -> DataFrame:
    """A bad row puts its whole group into quarantine."""
    groups = df.groupBy(*group).agg(F.coalesce(F.bool_or(bad), F.lit(False)).alias(name))
    return null_safe_join(df, groups, group)


def quarantine_summary(df: DataFrame, keys: Sequence[str], group: Sequence[str]) -> DataFrame:
    """(group..., n_rows, n_duplicated, is_quarantined): a key that occurs several times puts its whole group into quarantine. Two aggregates, no join."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    return per_key.groupBy(*group).agg(F.sum("__n").alias("n_rows"), F.coalesce(F.sum(F.when(F.col("__n") > 1, F.col("__n"))), F.lit(0)).alias("n_duplicated"), F.bool_or(F.col("__n") > 1).alias("is_quarantined"))


def quarantine_split(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(rows without a reason, rows with it in ``reason``): disjoint and complete."""
    marked = df.withColumn("reason", reason)
    return marked.filter("reason is null").drop("reason"), marked.filter("reason is not null")


def reasons(rules: Mapping[str, Column], separator: str = "|") -> Column:
    """The names of all rules that hold, in their order; null if none does."""
    return F.nullif(F.concat_ws(separator, *[F.when(hit, F.lit(name)) for name, hit in rules.items()]), F.lit(""))


def reasons_json(rules: Mapping[str, Column]) -> Column:
    return F.to_json(F.filter(F.array(*[F.when(hit, F.lit(name)) for name, hit in rules.items()]), lambda x: x.isNotNull()))


def first_failure(gates: Mapping[str, Column]) -> Column:
    """The first gate that doesn't hold (unknown counts as failed); null if all do."""
    out = None
    for name, ok in gates.items():
        failed = ~F.coalesce(ok, F.lit(False))
        out = F.when(failed, name) if out is None else out.when(failed, name)
    return out


def collapse_payload(df: DataFrame, payload: Sequence[str], member: str, name: str = "members") -> DataFrame:
    """Equal payloads as one row with the sorted set of members."""
    pairs = df.select(*payload, member).distinct()
    return pairs.groupBy(*payload).agg(F.array_sort(F.collect_list(member)).alias(name))


def gates(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """One row of booleans from one aggregate over the table; an aggregate that is null fails."""
    row = df.agg(*[F.coalesce(c, F.lit(False)).alias(n) for n, c in checks.items()])
    return row.withColumn("all_pass", F.expr(" and ".join(f"`{n}`" for n in checks)))


def table_report(df: DataFrame, name: str) -> DataFrame:
    """(table_name, column_name, data_type, n_rows, n_null, n_distinct): one pass over the table."""
    aggs = [F.count("*").alias("__rows")]
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        aggs += [F.count_if(c.isNull()).alias(f"n:{f.name}"), F.count_distinct(c if not isinstance(f.dataType, T.MapType) else F.to_json(c)).alias(f"d:{f.name}")]
    row = df.agg(*aggs)
    cells = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"), F.col("__rows").alias("n_rows"), F.col(f"`n:{f.name}`").alias("n_null"), F.col(f"`d:{f.name}`").alias("n_distinct")) for f in df.schema.fields])
    return row.select(F.lit(name).alias("table_name"), F.inline(cells))
