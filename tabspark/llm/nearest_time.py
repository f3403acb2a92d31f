"""Stateful streaming join: each left record with the right record of its entity nearest in time, within a tolerance.

Both sides are buffered in keyed state. A left row is emitted once the watermark has passed its horizon (time + tolerance),
so no nearer right row can still come; right rows leave the buffer when neither a pending nor a future left row can reach
them. A state group is a shard of entities in one bucket of time: a hot entity is as many groups as it has buckets, small
entities share a group, and right rows go into every bucket that their tolerance reaches.

``nearest_join`` takes two streams. The watermark runs on ``clock``: the matched time itself, or, where a wild source time
must not expire everything, the time of receipt with a lateness beyond the longest delay. Rows later than that are dropped
by Spark; ``late_rows`` counts them.

``replay_nearest_join`` runs it over two stored tables: it puts both sides into slices in order of the matched time, hands
the stream one slice per trigger, and ends with a marker that moves the watermark past every horizon. In this order no row
is late whatever delays the data have, and the state never holds more than the last two slices. A slice appears by renaming
its folder, which the shared file system has to do as one step; a replay that saw late rows all the same fails. Bucket width and number of
slices come from counts of all rows over time.

Defined results: rows without entity, id or time match nothing (left rows of ``how='left'`` come out unmatched only if they
have all three); two right rows equally near: the smaller id; repeated ids of one entity and time count once; differences of
exactly the tolerance match; empty tables give an empty result; only the named columns are read, so clashing extra
columns do no harm.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tabspark.session import hadoop_path, materialise, scratch_path

_log = logging.getLogger(__name__)

_ROW = np.dtype([("e", "<i4"), ("t", "<i8"), ("id", "<i8")])
STATE_SCHEMA = "entities array<string>, left_rows binary, right_rows binary"
OUT_SCHEMA = "left_id long, right_id long, distance_us long"
ROW_SCHEMA = "entity string, id long, t_us long, clock timestamp, is_left boolean"


def _sorted_unique(rows: np.ndarray) -> np.ndarray:
    """By entity, time, id; repeated rows once."""
    rows = rows[np.lexsort((rows["id"], rows["t"], rows["e"]))]
    if len(rows) < 2:
        return rows
    new = (np.diff(rows["e"]) != 0) | (np.diff(rows["t"]) != 0) | (np.diff(rows["id"]) != 0)
    return rows[np.concatenate(([True], new))]


def nearest(left: np.ndarray, right: np.ndarray, tolerance_us: int) -> tuple[np.ndarray, np.ndarray]:
    """For each left row the position of the nearest row of its entity in right (as _sorted_unique gives it) and its distance; -1 where none is in reach."""
    n, k = len(left), len(right)
    if not n or not k:
        return np.full(n, -1), np.zeros(n, dtype=np.int64)
    # right rows first among equal times, so that 'before' includes the same time
    e, t, side = np.concatenate((right["e"], left["e"])), np.concatenate((right["t"], left["t"])), np.repeat([0, 1], [k, n])
    order = np.lexsort((side, t, e))
    place = np.empty(k + n, dtype=np.int64)
    place[order] = np.arange(k + n)
    seen = np.cumsum(side[order] == 0)[place[k:]]  # right rows up to each left row
    starts = np.concatenate(([True], (np.diff(right["e"]) != 0) | (np.diff(right["t"]) != 0)))
    first = np.maximum.accumulate(np.where(starts, np.arange(k), 0))  # of equal times the smallest id comes first
    up, down = np.minimum(seen, k - 1), first[np.maximum(seen - 1, 0)]
    far = np.iinfo(np.int64).max
    d_up = np.where((seen < k) & (right["e"][up] == left["e"]), np.abs(right["t"][up] - left["t"]), far)
    d_down = np.where((seen > 0) & (right["e"][down] == left["e"]), np.abs(right["t"][down] - left["t"]), far)
    take_down = (d_down < d_up) | ((d_down == d_up) & (right["id"][down] < right["id"][up]))
    at, distance = np.where(take_down, down, up), np.minimum(d_up, d_down)
    return np.where(distance <= tolerance_us, at, -1), distance


def _joiner(tolerance_us: int, keep_unmatched: bool):
    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known, left_held, right_held = state.get if state.exists else ([], b"", b"")
        frames = list(batches)
        names = pd.concat([pd.Series(list(known), dtype="object"), *[f["entity"] for f in frames]], ignore_index=True)
        codes, entities = pd.factorize(names)  # those of the state come first and keep their codes
        fresh = np.empty(len(names) - len(known), dtype=_ROW)
        fresh["e"] = codes[len(known) :]
        fresh["t"] = np.concatenate([f["t_us"].to_numpy() for f in frames] or [[]])
        fresh["id"] = np.concatenate([f["id"].to_numpy() for f in frames] or [[]])
        is_left = np.concatenate([f["is_left"].to_numpy(dtype=bool) for f in frames] or [np.zeros(0, dtype=bool)])
        left = _sorted_unique(np.concatenate((np.frombuffer(left_held, dtype=_ROW), fresh[is_left])))
        right = _sorted_unique(np.concatenate((np.frombuffer(right_held, dtype=_ROW), fresh[~is_left])))
        watermark_us = state.getCurrentWatermarkMs() * 1000
        due = left["t"] + tolerance_us < watermark_us
        out, left = left[due], left[~due]
        at, distance = nearest(out, right, tolerance_us)
        # a left row that waits needs what its tolerance reaches; one that may still come is not before the watermark
        pending = int(left["t"].min()) if len(left) else watermark_us
        right_kept = right[right["t"] >= min(watermark_us, pending) - tolerance_us]
        if len(left) or len(right_kept):
            held, e = np.unique(np.concatenate((left["e"], right_kept["e"])), return_inverse=True)
            left, right_kept = left.copy(), right_kept.copy()
            left["e"], right_kept["e"] = e[: len(left)], e[len(left) :]
            state.update((list(entities[held]), left.tobytes(), right_kept.tobytes()))
            horizon = int(left["t"].min()) if len(left) else int(right_kept["t"].max())
            state.setTimeoutTimestamp(max((horizon + tolerance_us) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        hit = at >= 0
        frame = pd.DataFrame({"left_id": out["id"], "right_id": pd.array(right["id"][np.maximum(at, 0)] if len(right) else np.zeros(len(out), dtype=np.int64), dtype="Int64"), "distance_us": pd.array(distance, dtype="Int64")})
        frame.loc[~hit, ["right_id", "distance_us"]] = pd.NA
        frame = frame if keep_unmatched else frame[hit]
        if len(frame):
            yield frame

    return run


def _grouped_join(rows: DataFrame, tolerance_us: int, bucket_us: int, shards: int, lateness: str, how: str) -> DataFrame:
    """The join over one stream of ROW_SCHEMA."""
    bucket = lambda t: F.floor(t / F.lit(bucket_us)).cast("long")
    t, known = F.col("t_us"), "entity is not null and t_us is not null and id is not null and clock is not null"
    reach = F.when(F.col("is_left"), F.array(bucket(t))).otherwise(F.sequence(bucket(t - tolerance_us), bucket(t + tolerance_us)))
    placed = rows.filter(known).withWatermark("clock", lateness).select(F.pmod(F.xxhash64("entity"), F.lit(shards)).alias("shard"), F.explode(reach).alias("bucket"), "entity", "is_left", "id", "t_us", "clock")
    return placed.groupBy("shard", "bucket").applyInPandasWithState(_joiner(tolerance_us, how == "left"), OUT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.EventTimeTimeout)


def nearest_join(left: DataFrame, right: DataFrame, tolerance_us: int, bucket_us: int, lateness: str, how: str = "inner", shards: int = 64) -> DataFrame:
    """Streaming join of left and right, each (entity STRING, id BIGINT, t_us BIGINT, clock TIMESTAMP). Gives OUT_SCHEMA.

    A bucket narrower than the tolerance is right but copies each right row into 2 * tolerance / bucket + 1 buckets.
    """
    columns = ["entity", "id", "t_us", "clock"]
    rows = left.select(*columns, F.lit(True).alias("is_left")).unionByName(right.select(*columns, F.lit(False).alias("is_left")))
    return _grouped_join(rows, tolerance_us, bucket_us, shards, lateness, how)


def late_rows(query: StreamingQuery) -> int:
    """Rows that the query has dropped as later than its watermark, over the progress it still holds."""
    return sum(int(s["numRowsDroppedByWatermark"]) for p in query.recentProgress for s in p["stateOperators"])


@dataclass
class ReplayPlan:
    """Equal cells of time from ``low`` on, the slice of each cell that has rows, and how wide a state bucket is (all in µs)."""

    low: int
    width: int
    slice_of: dict[int, int]
    bucket_us: int

    @property
    def slices(self) -> int:
        return max(self.slice_of.values()) + 1

    def sliced(self, rows: DataFrame) -> DataFrame:
        """rows with their slice. The cells are at most 4,097."""
        cells = rows.sparkSession.createDataFrame(sorted(self.slice_of.items()), "__cell long, slice int")
        cell = F.floor((F.col("t_us") - F.lit(self.low)) / F.lit(self.width)).cast("long")
        return rows.withColumn("__cell", cell).join(F.broadcast(cells), "__cell").drop("__cell")


def plan_replay(rows: DataFrame, tolerance_us: int, slices: int, slice_rows: int, bucket_rows: int, cells: int = 4096) -> ReplayPlan | None:
    """From the counts of all rows in equal cells of time (at most ``cells`` + 1 rows at the driver): slices of equal rows, at most about slice_rows each, and a bucket of at most about bucket_rows in the densest cell."""
    low, high, total = rows.agg(F.min("t_us"), F.max("t_us"), F.count("t_us")).first()
    if not total:
        return None
    width = max(1, math.ceil((high - low + 1) / cells))
    counted = dict(rows.groupBy(F.floor((F.col("t_us") - F.lit(low)) / F.lit(width)).cast("long").alias("cell")).count().collect())
    goal, slice_of, held, now = total / max(slices, math.ceil(total / slice_rows)), {}, 0, 0
    for cell in sorted(counted):
        if held >= goal * (now + 1):
            now += 1
        slice_of[cell] = now
        held += counted[cell]
    densest = max(counted.values())
    return ReplayPlan(low, width, slice_of, int(max(width * bucket_rows / densest, 8 * tolerance_us, 1)))


def replay_nearest_join(
    left: DataFrame,
    right: DataFrame,
    tolerance_us: int,
    slices: int = 4,
    slice_rows: int = 2_000_000_000,
    bucket_rows: int = 250_000,
    shards: int = 8,
    how: str = "inner",
    watch: Callable[[StreamingQuery], None] | None = None,
) -> DataFrame:
    """Run the streaming join over two stored tables (entity, id, t_us) to their end and read its output (OUT_SCHEMA).

    At least ``slices`` triggers, more where a slice would hold over slice_rows rows. ``watch`` is called after each trigger.
    """
    spark, work = left.sparkSession, scratch_path(left.sparkSession, "nearest-time")
    side = lambda df, flag: df.select(F.col("entity").cast("string").alias("entity"), F.col("id").cast("long").alias("id"), F.col("t_us").cast("long").alias("t_us"), F.lit(flag).alias("is_left"))
    rows = materialise(side(left, True).unionByName(side(right, False)).filter("entity is not null and id is not null and t_us is not null"), "nearest-time-rows")
    plan = plan_replay(rows, tolerance_us, slices, slice_rows, bucket_rows)
    if plan is None:
        return spark.createDataFrame([], OUT_SCHEMA)
    sliced = plan.sliced(rows.withColumn("clock", F.timestamp_micros("t_us")))
    spread = max(1, spark.sparkContext.defaultParallelism // 2)
    sliced.repartition(spread * plan.slices, "slice", F.pmod(F.hash("id"), F.lit(spread))).write.partitionBy("slice").parquet(f"{work}/slices")
    end = spark.createDataFrame([("", -1, 0, False)], "entity string, id long, t_us long, is_left boolean").withColumn("clock", F.lit("2250-01-01 00:00:00").cast("timestamp"))
    end.select(*[c for c in rows.columns], "clock").coalesce(1).write.parquet(f"{work}/slices/slice={plan.slices}")
    fs, live = hadoop_path(spark, f"{work}/live")
    fs.mkdirs(live)
    store = {"providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider", "rocksdb.changelogCheckpointing.enabled": "true"}
    store = {f"spark.sql.streaming.stateStore.{k}": v for k, v in store.items()}
    previous = {k: spark.conf.get(k, None) for k in store}
    try:
        for k, v in store.items():
            spark.conf.set(k, v)
        stream = spark.readStream.schema(ROW_SCHEMA).parquet(f"{work}/live/*")
        joined = _grouped_join(stream, tolerance_us, plan.bucket_us, shards, "0 seconds", how)
        query = joined.writeStream.format("parquet").option("path", f"{work}/out").option("checkpointLocation", f"{work}/checkpoint").outputMode("append").start()
        try:
            for i in range(plan.slices + 1):  # a slice appears as a whole, by a rename
                if not fs.rename(hadoop_path(spark, f"{work}/slices/slice={i}")[1], hadoop_path(spark, f"{work}/live/{i:06d}")[1]):
                    raise RuntimeError(f"slice {i} of the replay is missing")
                query.processAllAvailable()
                if watch:
                    watch(query)
            if late := late_rows(query):
                raise RuntimeError(f"{late} rows came later than the watermark")
        finally:
            query.stop()
    finally:
        for k, v in previous.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    return spark.read.schema(OUT_SCHEMA).parquet(f"{work}/out").dropDuplicates(["left_id", "right_id"])


def time_of(source: Column, received: Column) -> Column:
    """Microseconds of the source time, or of the receipt where that is missing or unreadable."""
    return F.unix_micros(F.coalesce(source.try_cast("timestamp"), received.try_cast("timestamp")))
