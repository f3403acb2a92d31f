"""Writers that never overwrite, and never lose the difference between null and empty."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabspark.sources.readers import NULL_TOKEN


def encode_cells(df: DataFrame) -> DataFrame:
    """Nested cells as JSON, binary as lower-case hex; scalars as they are."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(c)
        elif isinstance(f.dataType, T.BinaryType):
            c = F.lower(F.hex(c))
        out.append(c.alias(f.name))
    return df.select(*out)


def describe_schema(df: DataFrame) -> list[dict[str, str]]:
    kind = lambda t: "json" if isinstance(t, (T.ArrayType, T.MapType, T.StructType)) else "hex" if isinstance(t, T.BinaryType) else "scalar"
    return [{"name": f.name, "type": f.dataType.simpleString(), "encoding": kind(f.dataType)} for f in df.schema.fields]


def check_no_null_token(df: DataFrame) -> None:
    """Raise if a text equals the null token. One aggregate."""
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if names and any(df.agg(*[F.max((F.col(f"`{c}`") == NULL_TOKEN).cast("int")) for c in names]).first()):
        raise ValueError("a text equals the null token")


def write_csv(df: DataFrame, path: str, compression: str = "gzip") -> None:
    encoded = encode_cells(df)
    check_no_null_token(encoded)
    encoded.write.mode("errorifexists").option("header", True).option("nullValue", NULL_TOKEN).option("quote", '"').option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("compression", compression).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("errorifexists").option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines; NaN and infinities become null."""
    clean = [F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else c for f in df.schema.fields for c in [F.col(f"`{f.name}`")]]
    df.select(*clean).write.mode("errorifexists").json(path)
