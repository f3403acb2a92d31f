"""Column profiles from maintained value-count tables.

``value_deltas`` turns a load into signed counts (table_name, column_name, load_no, value, n); ``ValueCountStore`` keeps
all deltas ever applied and what they add up to, so a late row adds to its load and a withdrawn row (sign -1) takes away;
every metric, the exact distinct count and the entropy included, comes from the maintained counts and never
from the rows again.

Defined results: nulls are counted under a null value; NaN counts as a value of its own text ('NaN'), never as null;
a load whose counts cancel out is gone; an empty table has no loads and no findings; a null load number is a load of
its own; columns other than those named are not read. A check whose baseline is null, or that has no value to judge,
is not made.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabspark.session import hadoop_path, scratch_path

COUNT_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("load_no", T.LongType()),
        T.StructField("value", T.StringType()),
        T.StructField("n", T.LongType()),
    ]
)
KEY = ["table_name", "column_name", "load_no", "value"]


def value_deltas(df: DataFrame, table_name: str, columns: Iterable[str], load_col: str = "load_no", sign: int = 1) -> DataFrame:
    """Signed value counts of a delivery. One scan; counts are combined before the shuffle, so a hot value is one row per task."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    out = df.select(F.lit(table_name).alias("table_name"), F.col(load_col).cast("long").alias("load_no"), F.inline(cells)).groupBy(*KEY).agg((F.count("*") * F.lit(sign)).alias("n"))
    return out.select(*COUNT_SCHEMA.names)


def summed(deltas: DataFrame) -> DataFrame:
    """The counts that deltas add up to. Those that cancel out are gone."""
    return deltas.groupBy(*KEY).agg(F.sum("n").alias("n")).filter("n <> 0").select(*COUNT_SCHEMA.names)


class ValueCountStore:
    """Value-count tables in a folder, kept as signed deltas.

    Applying a batch of deltas writes that batch and nothing else: a new version folder, by table and column, so a load costs
    what it holds and not what is there. Reading adds the newest base and the versions after it; ``compact`` writes a new
    base and removes what it replaces. A version counts once it is complete, so a writer that dies leaves no trace.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or scratch_path(spark, "value-counts")
        self.base = max(self._complete("base"), default=0)
        self.version = max(self._complete("version"), default=self.base)

    def _complete(self, kind: str) -> list[int]:
        """The numbers of the complete folders of a kind; of versions up to the first that is missing after the base."""
        fs, root = hadoop_path(self.spark, self.path)
        if not fs.exists(root):
            return []
        have = {int(f.getPath().getName().split("=")[1]) for f in fs.listStatus(root) if f.getPath().getName().startswith(f"{kind}=") and fs.exists(hadoop_path(self.spark, f"{f.getPath()}/_SUCCESS")[1])}
        if kind == "base":
            return sorted(have)
        out, nxt = [], self.base + 1
        while nxt in have:
            out.append(nxt)
            nxt += 1
        return out

    def _at(self, kind: str, number: int) -> str:
        return f"{self.path}/{kind}={number:06d}"

    def _write(self, counts: DataFrame, at: str) -> None:
        counts.select(*COUNT_SCHEMA.names).write.mode("overwrite").partitionBy("table_name", "column_name").parquet(at)  # overwrites only what never completed

    def _deltas(self) -> DataFrame:
        out = self.spark.createDataFrame([], COUNT_SCHEMA)
        places = ([self._at("base", self.base)] if self.base else []) + [self._at("version", v) for v in range(self.base + 1, self.version + 1)]
        for at in places:
            out = out.unionByName(self.spark.read.schema(COUNT_SCHEMA).option("basePath", at).parquet(at))
        return out

    def read(self) -> DataFrame:
        return summed(self._deltas())

    def apply(self, deltas: DataFrame) -> DataFrame:
        """Add a batch of deltas as a new version; the counts after it."""
        self._write(deltas, self._at("version", self.version + 1))
        self.version += 1
        return self.read()

    def compact(self) -> None:
        """One base instead of the old base and all versions after it."""
        if self.version == self.base:
            return
        old = ([self._at("base", self.base)] if self.base else []) + [self._at("version", v) for v in range(self.base + 1, self.version + 1)]
        self._write(self.read(), self._at("base", self.version))
        self.base = self.version
        for at in old:
            fs, where = hadoop_path(self.spark, at)
            fs.delete(where, True)


def _typed(counts: DataFrame, baseline: DataFrame) -> DataFrame:
    """Counts with the baseline of their column, whether the value has the agreed shape, and its number if so."""
    base = baseline.select("table_name", "column_name", "null_share", "low_value", "high_value", "distinct_low", "distinct_high", "shape")
    joined = counts.join(F.broadcast(base), ["table_name", "column_name"])  # one row per profiled column: bounded by the schemas
    fits = F.when(F.col("value").isNotNull(), F.expr(r"shape is null or value rlike concat('\\A(?:', shape, ')\\z')"))
    return joined.withColumn("fits", fits).withColumn("number", F.when(F.col("fits"), F.expr("try_cast(value as double) + 0.0D")))  # one zero


def load_metrics(counts: DataFrame, baseline: DataFrame, bins: DataFrame) -> DataFrame:
    """One row per table, column and load: n_rows, n_null, n_misfit, n_distinct, low, high, entropy (bits), distance."""
    typed = _typed(counts, baseline)
    group = ["table_name", "column_name", "load_no"]
    # spellings of one number are one value
    values = typed.groupBy(*group, "null_share", "low_value", "high_value", "distinct_low", "distinct_high", "fits", F.coalesce(F.col("number").cast("string"), F.col("value")).alias("value"), "number").agg(F.sum("n").alias("n"))
    inside = F.col("number").isNotNull() & F.coalesce(F.col("number") >= F.col("low_value"), F.lit(True)) & F.coalesce(F.col("number") <= F.col("high_value"), F.lit(True))
    n_fit = F.sum(F.when(F.col("fits"), F.col("n")))
    metrics = values.groupBy(*group, "null_share", "low_value", "high_value", "distinct_low", "distinct_high").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
        F.coalesce(F.sum(F.when(~F.col("fits"), F.col("n"))), F.lit(0)).alias("n_misfit"),
        F.count(F.when(F.col("fits"), 1)).alias("n_distinct"),
        F.min("number").alias("low"),
        F.max("number").alias("high"),
        F.coalesce(F.sum(F.when(inside, F.col("n"))), F.lit(0)).alias("n_inside"),
        (F.log2(n_fit) - F.sum(F.when(F.col("fits"), F.col("n") * F.log2("n"))) / n_fit).alias("entropy"),
    )
    bin_rows = F.broadcast(bins.select("table_name", "column_name", "bin_no", "lower_value", "upper_value", "row_share"))  # a fixed handful per column
    in_bin = (F.col("number") >= F.col("lower_value")) & (F.col("number") < F.col("upper_value"))
    binned = values.filter(inside).join(bin_rows.alias("b"), ["table_name", "column_name"]).groupBy(*group, "bin_no", "row_share").agg(F.sum(F.when(in_bin, F.col("n")).otherwise(0)).alias("n_bin"), F.sum("n").alias("n_all"))
    shift = binned.groupBy(*group).agg((F.sum(F.abs(F.col("n_bin") / F.col("n_all") - F.col("row_share"))) / 2).alias("distance"))
    same = [F.col(f"m.{c}").eqNullSafe(F.col(f"s.{c}")) for c in group]
    return metrics.alias("m").join(shift.alias("s"), same[0] & same[1] & same[2], "left").select("m.*", "s.distance")


def findings(metrics: DataFrame, null_tolerance: float = 0.05, distance_limit: float = 0.15) -> DataFrame:
    """(table_name, column_name, load_no, finding): the departures from the accepted profile."""
    checks = {
        "null_rate": F.abs(F.col("n_null") / F.col("n_rows") - F.col("null_share")) > null_tolerance,
        "pattern": F.col("n_misfit") > 0,
        "value_range": F.coalesce(F.col("low") < F.col("low_value"), F.lit(False)) | F.coalesce(F.col("high") > F.col("high_value"), F.lit(False)),
        "distinct_count": F.coalesce(F.col("n_distinct") < F.col("distinct_low"), F.lit(False)) | F.coalesce(F.col("n_distinct") > F.col("distinct_high"), F.lit(False)),
        "distribution": F.col("distance") > distance_limit,
    }
    found = F.filter(F.array(*[F.when(F.coalesce(hit, F.lit(False)), F.lit(name)) for name, hit in checks.items()]), lambda x: x.isNotNull())
    return metrics.select("table_name", "column_name", "load_no", F.explode(found).alias("finding"))


def cumulative_metrics(counts: DataFrame, baseline: DataFrame) -> DataFrame:
    """Profile of each column after each load: maintained totals with exact distinct count and entropy.

    A value's total changes only in loads that deliver it, so the sums over all values after each load are running sums of
    what each change adds: n*log2(n) after minus before, and 1 for a value seen for the first time. No load is expanded
    over the values that it does not hold.
    """
    from pyspark.sql import Window as W

    typed = _typed(counts, baseline).filter(F.col("load_no").isNotNull())
    value = F.coalesce(F.col("number").cast("string"), F.col("value"))
    per = typed.groupBy("table_name", "column_name", "load_no", value.alias("value"), "fits").agg(F.sum("n").alias("n"))
    history = W.partitionBy("table_name", "column_name", "value").orderBy("load_no")
    after = F.sum("n").over(history.rowsBetween(W.unboundedPreceding, 0))
    weigh = lambda x: F.when(x > 0, x * F.log2(x)).otherwise(0.0)
    step = per.withColumn("after", after).withColumn("before", F.col("after") - F.col("n"))
    fits = F.coalesce(F.col("fits"), F.lit(False))
    changes = step.groupBy("table_name", "column_name", "load_no").agg(
        F.sum("n").alias("d_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("d_null"),
        F.coalesce(F.sum(F.when(F.col("fits") == F.lit(False), F.col("n"))), F.lit(0)).alias("d_misfit"),
        F.coalesce(F.sum(F.when(fits, F.col("n"))), F.lit(0)).alias("d_fit"),
        F.coalesce(F.sum(F.when(fits, (F.col("after") > 0).cast("long") - (F.col("before") > 0).cast("long"))), F.lit(0)).alias("d_distinct"),
        F.coalesce(F.sum(F.when(fits, weigh(F.col("after")) - weigh(F.col("before")))), F.lit(0.0)).alias("d_weighed"),
    )
    loads = W.partitionBy("table_name", "column_name").orderBy("load_no").rowsBetween(W.unboundedPreceding, 0)  # one row per load
    total = {c: F.sum(f"d_{c}").over(loads) for c in ("rows", "null", "misfit", "fit", "distinct", "weighed")}
    return changes.select(
        "table_name",
        "column_name",
        "load_no",
        total["rows"].alias("n_rows"),
        total["null"].alias("n_null"),
        total["misfit"].alias("n_misfit"),
        total["distinct"].alias("n_distinct"),
        F.round(F.when(total["fit"] > 0, F.log2(total["fit"]) - total["weighed"] / total["fit"]), 6).alias("entropy"),
    )
