import math
from collections import Counter

from tabspark.operators import profile

BASE = "table_name string, column_name string, null_share double, low_value double, high_value double, distinct_low long, distinct_high long, shape string"
BINS = "table_name string, column_name string, bin_no long, lower_value double, upper_value double, row_share double"


def _tables(spark):
    base = spark.createDataFrame([("t", "x", 0.25, 0.0, 10.0, 2, 3, None), ("t", "s", 0.0, None, None, None, None, "[ab]")], BASE)
    bins = spark.createDataFrame([("t", "x", 1, 0.0, 5.0, 0.5), ("t", "x", 2, 5.0, 11.0, 0.5)], BINS)
    return base, bins


def _found(spark, data):
    base, bins = _tables(spark)
    df = spark.createDataFrame(data, "load_no long, x double, s string, n long")
    deltas = profile.value_deltas(df, "t", ["x", "s"])
    return {(r["column_name"], r["load_no"], r["finding"]) for r in profile.findings(profile.load_metrics(deltas, base, bins)).collect()}


def test_sound_load_and_each_departure(spark):
    sound = [(1, 1.0, "a", 0), (1, 6.0, "b", 0), (1, 6.0, "a", 0), (1, 1.0, "a", 0), (1, None, "a", 0)]
    assert _found(spark, sound) == set()
    assert _found(spark, [(2, 1.0, "a", 0), (2, 6.0, "aa", 0), (2, None, None, 0), (2, 6.0, "a", 0)]) == {("s", 2, "pattern"), ("s", 2, "null_rate")} | {("x", 2, "distribution")}
    assert ("x", 3, "value_range") in _found(spark, [(3, -1.0, "a", 0), (3, 6.0, "a", 0), (3, 1.0, "a", 0), (3, None, "a", 0)])
    assert ("x", 4, "distinct_count") in _found(spark, [(4, 1.0, "a", 0)] * 3 + [(4, None, "a", 0)])


def test_all_null_load_nan_and_zeros(spark):
    assert _found(spark, [(1, None, "a", 0)]) == {("x", 1, "null_rate"), ("x", 1, "distinct_count")}
    assert ("x", 2, "value_range") in _found(spark, [(2, math.nan, "a", 0), (2, 1.0, "a", 0)])
    base, bins = _tables(spark)
    deltas = profile.value_deltas(spark.createDataFrame([(1, 0.0), (1, -0.0)], "load_no long, x double"), "t", ["x"])
    assert profile.load_metrics(deltas, base, bins).first()["n_distinct"] == 1


def test_empty_table(spark):
    assert _found(spark, []) == set()


def test_store_keeps_versions_and_withdraws(spark, rows, tmp_path):
    first = spark.createDataFrame([(1, 1.0), (1, 1.0), (1, None)], "load_no long, x double")
    store = profile.ValueCountStore(spark, str(tmp_path / "store"))
    assert store.read().count() == 0
    store.apply(profile.value_deltas(first, "t", ["x"]))
    late = spark.createDataFrame([(1, 2.0)], "load_no long, x double")
    store.apply(profile.value_deltas(late, "t", ["x"]))
    again = profile.ValueCountStore(spark, str(tmp_path / "store"))
    assert again.version == 2
    out = again.apply(profile.value_deltas(first, "t", ["x"], sign=-1))
    assert rows(out) == [("t", "x", 1, "2.0", 1)]


def test_compacting_changes_nothing_and_is_found_again(spark, rows, tmp_path):
    store = profile.ValueCountStore(spark, str(tmp_path / "store"))
    for load in (1, 2, 3):
        store.apply(profile.value_deltas(spark.createDataFrame([(load, 1.0), (load, 5.0)], "load_no long, x double"), "t", ["x"]))
    before = rows(store.read())
    store.compact()
    assert sorted(p.name for p in (tmp_path / "store").iterdir()) == ["base=000003"]
    again = profile.ValueCountStore(spark, str(tmp_path / "store"))
    assert (again.base, again.version) == (3, 3) and rows(again.read()) == before and len(before) == 6
    (tmp_path / "store" / "version=000004").mkdir()  # a writer that died
    assert profile.ValueCountStore(spark, str(tmp_path / "store")).version == 3
    again.apply(profile.value_deltas(spark.createDataFrame([(4, None)], "load_no long, x double"), "t", ["x"]))
    assert profile.ValueCountStore(spark, str(tmp_path / "store")).version == 4


def test_cumulative_entropy_is_that_of_all_rows_so_far(spark):
    data = [(1, "1"), (1, "1.0"), (1, "2"), (2, "2"), (2, "3"), (3, None), (3, "1")]
    base, _ = _tables(spark)
    df = spark.createDataFrame(data, "load_no long, x string")
    got = {r["load_no"]: (r["n_rows"], r["n_null"], r["n_distinct"], r["entropy"]) for r in profile.cumulative_metrics(profile.value_deltas(df, "t", ["x"]), base).collect()}
    for load in (1, 2, 3):
        seen = [v for k, v in data if k <= load]
        counts = Counter(float(v) for v in seen if v is not None)
        total = sum(counts.values())
        entropy = -sum(n / total * math.log2(n / total) for n in counts.values())
        assert got[load] == (len(seen), seen.count(None), len(counts), round(entropy, 6))
