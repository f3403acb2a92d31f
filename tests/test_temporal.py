import random

import pytest
from pyspark.sql import functions as F

from tabspark.operators import temporal as t

DAY = t.DAY_US
SCHEMA = "id long, e string, us long, x double, kind string"


def _frame(spark, n=400, seed=1):
    r = random.Random(seed)
    rows = [(i, r.choice([None, "a", "b", "b", "b"]), r.randrange(0, 200) * DAY // 2, r.choice([None, 1.0, 2.0, 5.0]), r.choice([None, "p", "p", "q"])) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA), rows


def _by_entity(rows):
    out: dict = {}
    for row in sorted(rows, key=lambda r: (r[2], r[0])):
        out.setdefault(row[1], []).append(row)
    return out


def test_sliced_windows_equal_whole_ones(spark):
    df, rows = _frame(spark)
    cut = t.sliced(df, "e", "us", "id", 3, slice_rows=7, chunk_us=20 * DAY)
    w = t.slice_window("e")
    out = t.drop_halo(cut.withColumns({"mean": t.lagged_mean(F.col("x"), w, 3), "lag": F.lag("id", 2).over(w), "days": t.days_since(F.col("us"), w, 1, 3)}))
    got = {r["id"]: (r["mean"], r["lag"], r["days"]) for r in out.collect()}
    assert len(got) == len(rows)
    for group in _by_entity(rows).values():
        for i, row in enumerate(group):
            known = [r[3] for r in group[max(0, i - 3) : i] if r[3] is not None]
            mean = sum(known) / len(known) if known else None
            days = min((row[2] - group[i - 1][2]) / DAY, 3.0) if i else None
            assert got[row[0]] == (pytest.approx(mean) if mean is not None else None, group[i - 2][0] if i > 1 else None, days)
    with pytest.raises(ValueError):
        t.sliced(df, "e", "us", "id", 3, slice_rows=3)


def test_running_fill_valid_and_runs_over_small_chunks(spark):
    df, rows = _frame(spark, seed=2)
    key = ("e", "us", "id")
    out = t.running_sums(df, *key, {"before": F.col("x")}, 9 * DAY)
    out = t.last_known(out, *key, {"last": "x"}, 9 * DAY)
    out = t.valid_prefix(out, *key, (F.col("x") == 5.0) & (F.col("kind") == "q"), chunk_us=9 * DAY)
    out = t.run_length(out, *key, "kind", 9 * DAY)
    got = {r["id"]: r for r in out.collect()}
    assert len(got) == len(rows)
    for group in _by_entity(rows).values():
        bad = False
        for i, row in enumerate(group):
            g = got[row[0]]
            assert g["before"] == sum(r[3] or 0 for r in group[:i])
            known = [r[3] for r in group[: i + 1] if r[3] is not None]
            assert g["last"] == (known[-1] if known else None)
            bad = bad or (row[3] == 5.0 and row[4] == "q")
            assert g["still_valid"] == (not bad)
            run = 1
            while row[4] is not None and i - run >= 0 and group[i - run][4] == row[4]:
                run += 1
            assert (g["run_length"], g["prior_run"], g["touches_start"]) == (run, None if row[4] is None else run - 1, run == i + 1)
            same = None if i == 0 or row[4] is None or group[i - 1][4] is None else row[4] == group[i - 1][4]
            assert g["same_as_before"] == same


def test_density_window_is_open_at_its_end(spark):
    hour = 3_600_000_000
    data = [(1, "a", 0), (2, "a", 72 * hour), (3, "a", 144 * hour + 1), (4, "a", 144 * hour + 1), (5, None, 5)]
    df = spark.createDataFrame(data, "id long, e string, us long")
    got = {r["id"]: (r["n_72h"], r["censored_72h"]) for r in t.densities(df, "e", "us", [72], chunk_us=1).collect()}
    assert got == {1: (0, True), 2: (1, True), 3: (0, False), 4: (0, False), 5: (0, True)}


def test_asof_prefix_and_stats(spark):
    r = random.Random(4)
    history = [(i, r.choice("ab"), r.randrange(0, 100) * DAY, float(i)) for i in range(120)]
    asked = [(i, r.choice("abc"), r.randrange(0, 110) * DAY) for i in range(60)]
    h, q = spark.createDataFrame(history, "id long, e string, us long, x double"), spark.createDataFrame(asked, "qid long, e string, cut long")
    got = {r["qid"]: (r["n_before"], r["m"]) for r in t.asof_stats(h, q, "e", "us", "id", "cut", "qid", {"m": F.avg("x")}, 5).collect()}
    for i, e, cut in asked:
        past = [x for _, x in sorted(((u, k), x) for k, f, u, x in history if f == e and u < cut)]
        assert got[i] == (len(past), pytest.approx(sum(past[-5:]) / len(past[-5:])) if past else None)


def test_cutoff_is_the_earlier_of_midnight_and_twelve_hours(spark):
    hour = 3_600_000_000
    df = spark.createDataFrame([(10 * DAY + hour,), (10 * DAY + 20 * hour,)], "us long").select(t.asof_cutoff(F.col("us")).alias("c"))
    assert [r["c"] for r in df.collect()] == [9 * DAY + 13 * hour, 10 * DAY]


def test_latest_blocks_on_ties_and_incomplete_rows(spark):
    h = spark.createDataFrame([("a", 10, 1.0, 1), ("a", 20, None, 2), ("b", 10, 1.0, 3), ("b", 10, 1.0, 4), ("c", 5, 1.0, 5), ("c", 30, 1.0, 6)], "e string, us long, x double, rid long")
    q = spark.createDataFrame([(1, "a", 25), (2, "a", 20), (3, "b", 11), (4, "c", 30), (5, "z", 9)], "qid long, e string, at long")
    out = t.asof_latest(h, q, "e", "us", "at", "qid", [0], F.col("x").isNotNull(), ["rid"])
    assert {r["qid"]: (r["status"], r["rid"]) for r in out.collect()} == {1: ("incomplete", None), 2: ("found", 1), 3: ("tied", None), 4: ("found", 5), 5: ("none", None)}


def test_the_future_changes_nothing(spark):
    df, rows = _frame(spark, seed=6)
    cut = 60 * DAY

    def features(frame):
        w = t.slice_window("e")
        out = t.drop_halo(t.sliced(frame, "e", "us", "id", 10).withColumn("m", t.lagged_mean(F.col("x"), w, 10)))
        return {r["id"]: r["m"] for r in out.filter(F.col("us") <= cut).collect()}

    changed = df.withColumn("x", F.when(F.col("us") > cut, F.lit(99.0)).otherwise(F.col("x")))
    assert features(df) == features(changed) == features(df.filter(F.col("us") <= cut))


def test_empty_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert t.run_length(df, "e", "us", "id", "kind").count() == 0
    assert t.densities(df, "e", "us", [72]).count() == 0
    assert t.drop_halo(t.sliced(df, "e", "us", "id", 2)).count() == 0
    assert t.prior_distinct_day(df, "e", "us").count() == 0
    assert t.arrival_gaps(df, "e", "id", "us", 1).count() == 0
