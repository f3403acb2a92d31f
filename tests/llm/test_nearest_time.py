import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabspark.llm import nearest_time as nt

BASE = 1_700_000_000_000_000


def _brute(left, right, tolerance):
    out = set()
    for e, i, t, *_ in left:
        near = [(abs(u - t), k) for f, k, u, *_ in right if e is not None and f == e and t is not None and u is not None and abs(u - t) <= tolerance]
        if near:
            d, k = min(near)
            out.add((i, k, d))
    return out


def _rows(spark, data):
    return spark.createDataFrame([(e, i, None if t is None else t + BASE, "x") for e, i, t in data], "entity string, id long, t_us long, clock string")


def _replay(spark, left, right, tolerance, **kw):
    return {tuple(r) for r in nt.replay_nearest_join(_rows(spark, left), _rows(spark, right), tolerance, **kw).collect()}


def _data(seed):
    r = random.Random(seed)
    left = [(r.choice("aab"), i, r.randrange(0, 60_000_000)) for i in range(150)]
    right = [(r.choice("aab"), 1000 + i, r.randrange(0, 60_000_000)) for i in range(300)]
    left += [left[0], (None, 900, 5), ("a", 901, None)]
    right += [right[0], (None, 1900, 5), ("a", 1901, None), ("c", 1902, 7)]
    return left, right


def test_agrees_with_brute_force_over_slices_and_buckets(spark):
    left, right = _data(1)
    for tolerance, bucket_rows in ((2_000_000, 1), (500_000, 30)):
        assert _replay(spark, left, right, tolerance, bucket_rows=bucket_rows) == _brute(left, right, tolerance)


def test_state_is_emptied_and_no_row_is_late(spark):
    left = [("a", i, i * 1_000_000) for i in range(400)]
    right = [("a", 10_000 + i, i * 1_000_000 + 300_000) for i in range(400)]
    held, late = [], []

    def watch(query):
        held.append([s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]][-1])
        late.append(nt.late_rows(query))

    got = _replay(spark, left, right, 400_000, slices=8, bucket_rows=1, shards=1, watch=watch)
    assert got == _brute(left, right, 400_000)
    groups = 400 * 1_000_000 // (8 * 400_000)
    assert len(held) == 9 and max(held) <= groups * 2 / 8 + 4 and held[-1] == 0 and late[-1] == 0


@pytest.mark.parametrize("bucket_us", [1_000_000, 300_000, 5_000_000])
def test_tolerance_wider_than_a_bucket(spark, tmp_path, bucket_us):
    left = [("a", i, i * 1_000_000) for i in range(20)]
    right = [("a", 100 + i, i * 1_000_000 + 300_000) for i in range(20)]
    for name, data in (("left", left), ("right", right), ("end", [("end", -1, 10**15)])):
        _rows(spark, data).withColumn("clock", F.timestamp_micros("t_us")).write.parquet(f"{tmp_path}/{name}/1")
    streams = [spark.readStream.schema("entity string, id long, t_us long, clock timestamp").parquet(f"{tmp_path}/{n}/*") for n in ("left", "right")]
    query = nt.nearest_join(*streams, 3_000_000, bucket_us, "1 minute", shards=2).writeStream.format("memory").queryName(f"near{bucket_us}").outputMode("append").start()
    try:
        query.processAllAvailable()
        (tmp_path / "end" / "1").rename(tmp_path / "right" / "2")
        query.processAllAvailable()
        assert {tuple(r) for r in spark.table(f"near{bucket_us}").collect()} == _brute(left, right, 3_000_000)
        assert nt.late_rows(query) == 0
    finally:
        query.stop()


def test_ties_edges_and_unmatched_rows(spark):
    left = [("a", 1, 10_000_000), ("a", 2, 50_000_000), ("b", 3, 0)]
    right = [("a", 12, 9_000_000), ("a", 11, 11_000_000), ("a", 13, 52_000_000), ("a", 14, 47_999_999)]
    assert _replay(spark, left, right, 2_000_000, how="left") == {(1, 11, 1_000_000), (2, 13, 2_000_000), (3, None, None)}


def test_empty_tables(spark):
    assert _replay(spark, [], [("a", 1, 1)], 10) == set()
    assert _replay(spark, [], [], 10) == set()


@pytest.mark.parametrize("seed", range(20))
def test_nearest_in_arrays(seed):
    r = np.random.default_rng(seed)
    left, right = (nt._sorted_unique(np.array([(int(e), int(t), int(i)) for e, t, i in zip(r.integers(0, 3, n), r.integers(0, 50, n), r.integers(0, 9, n), strict=True)], dtype=nt._ROW)) for n in (12, 15))
    at, distance = nt.nearest(left, right, 5)
    for k, row in enumerate(left):
        best = min(((abs(int(x["t"]) - int(row["t"])), int(x["id"])) for x in right if x["e"] == row["e"]), default=(99, 0))
        if best[0] > 5:
            assert at[k] == -1
        else:
            assert (int(distance[k]), int(right[at[k]]["id"])) == best
    assert list(nt.nearest(left, right[:0], 5)[0]) == [-1] * len(left)
