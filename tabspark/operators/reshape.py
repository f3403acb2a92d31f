"""Unions, unpivots, pairings, nested claims."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(*frames: DataFrame) -> DataFrame:
    """All rows by column name; columns that a frame lacks are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def union_distinct(*frames: DataFrame) -> DataFrame:
    return union_all(*frames).distinct()


def two_sided(df: DataFrame, keep: Sequence[str], sides: Mapping[str, Mapping[str, Column]], name: str = "side") -> DataFrame:
    """One row per side: sides maps a side's name to its columns."""
    rows = [F.struct(F.lit(side).alias(name), *[c.alias(n) for n, c in columns.items()]) for side, columns in sides.items()]
    return df.select(*keep, F.inline(F.array(*rows)))


def roles(df: DataFrame, keep: Sequence[str], columns: Mapping[str, str], id_name: str = "person_id") -> DataFrame:
    """One row per role column with a known id: columns maps a role to its column."""
    cells = F.array(*[F.struct(F.lit(role).alias("role"), F.col(c).cast("string").alias(id_name)) for role, c in columns.items()])
    return df.select(*keep, F.inline(cells)).filter(F.col(id_name).isNotNull())


def pair_rows(df: DataFrame, key: str, is_first: str, columns: Sequence[str]) -> DataFrame:
    """Two rows of a key as one: first_* and second_*. Keys without exactly one row of either kind drop out. One shuffle."""
    pick = lambda flag, c: F.max(F.when(F.col(is_first) == F.lit(flag), F.col(c)))
    out = df.groupBy(key).agg(F.count_if(F.col(is_first)).alias("__a"), F.count_if(~F.col(is_first)).alias("__b"), *[pick(flag, c).alias(f"{side}_{c}") for side, flag in (("first", True), ("second", False)) for c in columns])
    return out.filter("__a = 1 and __b = 1").drop("__a", "__b")


def set_difference_counts(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """One row: keys only in a, only in b, and in both with equal and with different sets of values."""
    gather = lambda df, n: df.select(key, value).distinct().groupBy(key).agg(F.array_sort(F.collect_list(value)).alias(n))
    both = gather(a, "va").join(gather(b, "vb"), key, "full_outer")
    only_a, only_b = F.col("vb").isNull(), F.col("va").isNull()
    return both.agg(F.count_if(only_a).alias("only_a"), F.count_if(only_b).alias("only_b"), F.count_if(~only_a & ~only_b & (F.col("va") == F.col("vb"))).alias("agree"), F.count_if(~only_a & ~only_b & (F.col("va") != F.col("vb"))).alias("conflict"))


CLAIMS = "map<string,array<struct<value:string,rank:string>>>"


def claim_rows(df: DataFrame, entity: str, claims: str) -> DataFrame:
    """(entity, property, statement_no, value, rank) of nested claims; deprecated statements are left out."""
    props = df.select(entity, F.explode(claims).alias("property", "statements"))
    rows = props.select(entity, "property", F.posexplode("statements").alias("statement_no", "s"))
    return rows.select(entity, "property", "statement_no", "s.value", "s.rank").filter("rank is distinct from 'deprecated'")


def claims_of(rows: DataFrame, entity: str) -> DataFrame:
    """The inverse of claim_rows: (entity, claims)."""
    per = rows.groupBy(entity, "property").agg(F.transform(F.array_sort(F.collect_list(F.struct("statement_no", "value", "rank"))), lambda x: F.struct(x["value"].alias("value"), x["rank"].alias("rank"))).alias("statements"))
    return per.groupBy(entity).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("property", F.to_json("statements").alias("statements"))))).alias("claims"))
