"""Activity per key and minute of receipt, for batch and streaming tables alike.

A minute is usable from its end; minutes without rows stay absent. Sums of products are exact decimals. Rows whose clock
is missing are in no minute; a negative lag counts and is kept.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def minute_activity(df: DataFrame, keys: Sequence[str], received: str, kind: str, kinds: Sequence[str], price: Column, size: Column, lag_s: Column, lateness: str | None = None) -> DataFrame:
    """(keys, minute_start, available_at, n_rows, n_<kind>..., size_sum, notional, lag_mean, lag_max, n_negative_lag)."""
    if lateness:
        df = df.withWatermark(received, lateness)
    exact = lambda c: c.cast("decimal(18,6)")
    out = df.groupBy(*keys, F.window(received, "1 minute")).agg(
        F.count("*").alias("n_rows"),
        *[F.count_if(F.coalesce(F.col(kind) == k, F.lit(False))).alias(f"n_{k}") for k in kinds],
        F.sum(exact(size)).alias("size_sum"),
        F.sum(exact(price) * exact(size)).alias("notional"),
        F.avg(lag_s).alias("lag_mean"),
        F.max(lag_s).alias("lag_max"),
        F.count_if(F.coalesce(lag_s < 0, F.lit(False))).alias("n_negative_lag"),
    )
    return out.select(*keys, F.col("window.start").alias("minute_start"), F.col("window.end").alias("available_at"), *[c for c in out.columns if c not in (*keys, "window")])


def without_repeats(df: DataFrame, columns: Sequence[str], received: str, lateness: str) -> DataFrame:
    """A stream without exact repeats that come within the lateness."""
    return df.withWatermark(received, lateness).dropDuplicatesWithinWatermark(list(columns))


def in_archive_hour(received: Column, hour_start: Column) -> Column:
    """Whether a receipt lies in the hour its archive is for; unknown counts as no."""
    return F.coalesce((received >= hour_start) & (received < hour_start + F.expr("interval 1 hour")), F.lit(False))


def split_writer(keep: Column, good_path: str, bad_path: str):
    """For foreachBatch: rows that hold go to one folder, all others to the other; a batch that is run again replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        marked = batch.withColumn("__keep", F.coalesce(keep, F.lit(False)))
        for flag, path in ((True, good_path), (False, bad_path)):
            marked.filter(F.col("__keep") == flag).drop("__keep").write.mode("overwrite").parquet(f"{path}/batch={number}")

    return write


GAP_SCHEMA = "entity string, n_rows long, n_reversed long, n_gaps long"


def gap_counts(df: DataFrame, entity: str, at: str, sequence: str, gap_s: float) -> DataFrame:
    """Per entity and trigger: rows, order reversals and gaps, going on from the trigger before. at is a TIMESTAMP.

    sequence is the physical order of arrival; rows of a trigger are put into it. The state is the last time seen. A trigger's
    rows of one entity are one group: bound a trigger by maxFilesPerTrigger or maxBytesPerTrigger.
    """

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = [(f["__seq"].to_numpy(), f["__us"].to_numpy()) for f in batches]  # 16 bytes a row of the trigger
        order = np.argsort(np.concatenate([s for s, _ in rows]), kind="stable")
        times = np.concatenate([t for _, t in rows])[order]
        steps = np.diff(times, prepend=[state.get[0]] if state.exists else times[:1])
        state.update((int(times[-1]),))
        yield pd.DataFrame({"entity": [key[0]], "n_rows": [len(times)], "n_reversed": [int((steps < 0).sum())], "n_gaps": [int((steps > gap_s * 1_000_000).sum())]})

    slim = df.filter(F.col(at).isNotNull()).select(F.col(entity).cast("string").alias("entity"), F.unix_micros(at).alias("__us"), F.col(sequence).cast("long").alias("__seq"))
    return slim.groupBy("entity").applyInPandasWithState(run, GAP_SCHEMA, "last long", "append", GroupStateTimeout.NoTimeout)
