"""Typed readers. Text tables come in as text: no reader infers types."""

from __future__ import annotations

import gzip
import hashlib
import io
import lzma
import tarfile
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_TOKEN = r"\N"
BAD_LINE = "_bad_line"


def parquet_table(spark: SparkSession, *paths: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet with the wanted columns that the files have; pruning and pushdown reach the scan."""
    df = spark.read.parquet(*paths)
    return df.select(*[c for c in columns if c in df.columns]) if columns else df


def text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def csv_text(spark: SparkSession, path: str, names: Sequence[str], empty_is_null: bool = False) -> DataFrame:
    r"""CSV with header, all columns text, ``\N`` null. Empty text stays empty unless empty_is_null.

    Quoted cells may hold line breaks, so a file is one task: write large tables in many files.
    """
    reader = spark.read.schema(text_schema(names)).option("header", True).option("nullValue", NULL_TOKEN).option("quote", '"').option("escape", '"').option("multiLine", True).option("lineSep", "\n")
    df = reader.option("emptyValue", "").csv(path)
    return df.select(*[F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) for c in names]) if empty_is_null else df


def csv_strict(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """CSV whose records must have exactly the given fields; others are in the column _bad_line. Quoted cells may hold line breaks."""
    schema = text_schema([*names, BAD_LINE])
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_LINE).option("quote", '"').option("escape", '"').option("multiLine", True).csv(path)


def csv_header(spark: SparkSession, path: str) -> list[str]:
    first = spark.read.text(path).limit(1).collect()
    return next(iter(pd.read_csv(io.StringIO(first[0][0]), header=None, dtype=str).values.tolist()), []) if first else []


def jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def bindings(df: DataFrame, column: str, names: Sequence[str]) -> DataFrame:
    """Rows of query results in JSON: {results: {bindings: [{name: {value}}]}}."""
    inner = ",".join(f"`{n}`:struct<value:string>" for n in names)
    rows = df.select(F.inline(F.from_json(F.col(column), f"results struct<bindings:array<struct<{inner}>>>")["results"]["bindings"]))
    return rows.select(*[F.col(f"`{n}`.value").alias(n) for n in names])


def column_arrays(df: DataFrame, keep: Sequence[str], arrays: Sequence[str]) -> DataFrame:
    """Rows of equally long arrays; a row whose arrays differ in length fails."""
    same = F.lit(True)
    for a in arrays[1:]:
        same = same & F.equal_null(F.size(a), F.size(arrays[0]))
    checked = df.withColumn("__ok", F.when(same, True).otherwise(F.raise_error(F.lit("arrays differ in length")).cast("boolean")))
    return checked.filter("__ok").select(*keep, F.inline(F.arrays_zip(*[F.col(a) for a in arrays])))


def _safe_member(name: str) -> bool:
    return not name.startswith(("/", "\\")) and ".." not in name.split("/") and ":" not in name


MEMBER_SCHEMA = "archive string, member string, size long, sha256 string, content binary"


def _single(name: str, data: bytes, largest: int) -> list[tuple[str, bytes]] | None:
    """The one member of a gz or xz file, read no further than the largest size; None for other files."""
    if data[:2] == b"\x1f\x8b":
        stream = gzip.GzipFile(fileobj=io.BytesIO(data))
    elif data[:6] == b"\xfd7zXZ\x00":
        stream = lzma.LZMAFile(io.BytesIO(data))
    else:
        return None
    body = stream.read(largest + 1)
    if len(body) > largest:
        raise ValueError(f"refused member: {name}")
    member = name.rsplit("/", 1)[-1]
    return [(member.rsplit(".", 1)[0] if member.endswith((".gz", ".xz")) else member, body)]


def unpack(name: str, data: bytes, largest: int) -> list[tuple[str, bytes]]:
    """Members of a zip, tar (compressed too), gz or xz file.

    Absolute names, parent folders, links, repeated names and members beyond ``largest`` bytes are refused.
    """
    if zipfile.is_zipfile(io.BytesIO(data)):
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            return _read([(i.filename, i.file_size, i.is_dir(), False, lambda i=i: z.read(i)) for i in z.infolist()], largest)
    try:
        with tarfile.open(fileobj=io.BytesIO(data)) as t:
            return _read([(i.name, i.size, i.isdir(), not (i.isfile() or i.isdir()), lambda i=i: t.extractfile(i).read()) for i in t.getmembers()], largest)
    except tarfile.ReadError:
        if (one := _single(name, data, largest)) is None:
            raise
        return one


def members_of(archives: DataFrame, largest: int = 1 << 28) -> DataFrame:
    """MEMBER_SCHEMA of archives (path STRING, content BINARY): one archive at a time, so an archive has to fit a task's memory."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, data in zip(pdf["path"], pdf["content"], strict=True):
                rows = [(name, m, len(b), hashlib.sha256(b).hexdigest(), b) for m, b in unpack(name, data, largest)]
                yield pd.DataFrame(rows, columns=["archive", "member", "size", "sha256", "content"])

    return archives.filter("content is not null").select("path", "content").mapInPandas(run, MEMBER_SCHEMA)


def archive_members(spark: SparkSession, path: str, largest: int = 1 << 28) -> DataFrame:
    """MEMBER_SCHEMA of archive files, one task per archive."""
    return members_of(spark.read.format("binaryFile").load(path), largest)


def checked_members(members: DataFrame, manifest: DataFrame) -> DataFrame:
    """(archive, member, status): each member of a manifest (archive, member, size, sha256) as 'ok', 'missing', 'size', 'digest'; members beyond it as 'extra'."""
    have = members.select("archive", "member", F.col("size").alias("__size"), F.col("sha256").alias("__sha"))
    status = F.when(F.col("sha256").isNull(), "extra").when(F.col("__sha").isNull(), "missing").when(F.col("size") != F.col("__size"), "size").when(F.col("sha256") != F.col("__sha"), "digest").otherwise("ok")
    return manifest.join(have, ["archive", "member"], "full_outer").select("archive", "member", status.alias("status"))


def inventory_gate(manifest: DataFrame, n_files: int, total_size: int) -> DataFrame:
    """One row: whether a manifest has so many files, of different names, and so many bytes in all."""
    return manifest.agg((F.count("*") == n_files).alias("right_number"), (F.count_distinct("name") == F.count("*")).alias("different_names"), (F.coalesce(F.sum("size"), F.lit(0)) == total_size).alias("right_size"))


def _read(infos, largest: int) -> list[tuple[str, bytes]]:
    seen, out = set(), []
    for name, size, is_dir, is_link, read in infos:
        if is_dir:
            continue
        if not _safe_member(name) or is_link or name in seen or size > largest:
            raise ValueError(f"refused member: {name}")
        seen.add(name)
        out.append((name, read()))
    return out


def inventory(spark: SparkSession, path: str, manifest: DataFrame) -> DataFrame:
    """(name, status): each file of a manifest (name, size, sha256) as 'ok', 'missing', 'size', 'digest', and files beyond it as 'extra'."""
    files = spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", "([^/]+)$", 1).alias("name"), F.col("length").alias("have_size"), F.sha2("content", 256).alias("have_sha"))
    both = manifest.join(files, "name", "full_outer")
    status = F.when(F.col("sha256").isNull(), "extra").when(F.col("have_sha").isNull(), "missing").when(F.col("size") != F.col("have_size"), "size").when(F.col("sha256") != F.col("have_sha"), "digest").otherwise("ok")
    return both.select("name", status.alias("status"))
