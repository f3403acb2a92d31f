import pytest
from pyspark.sql import functions as F

from tabspark.operators import aggs, contracts, evaluation, joins, quality, reshape


def test_validated_joins(spark, rows):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "k long, v string")
    b = spark.createDataFrame([(1, "p"), (2, "q"), (None, "r"), (None, "s")], "k long, v string")
    for mode in ("eager", "inline"):
        once = b.filter("k is not null") if mode == "eager" else b
        got = rows(joins.validated_join(a, once, ["k"], "left", "m:1", "side", mode))
        assert got == sorted([(1, "x", "p", "both"), (1, "y", "p", "both"), (None, "z", None, "left_only")], key=repr)
    twice = b.union(b)
    with pytest.raises(joins.CardinalityError):
        joins.validated_join(a, twice, ["k"], mode="eager")
    with pytest.raises(Exception, match="several rows for one key"):
        joins.validated_join(a, twice, ["k"]).collect()
    with pytest.raises(Exception, match="several rows for one key"):
        joins.validated_join(a, b, ["k"], "left", "1:1").collect()
    assert rows(joins.validated_join(a, b, ["k"], "full_outer", "m:1", "side").groupBy("side").count()) == [("both", 2), ("left_only", 1), ("right_only", 3)]
    assert joins.validated_join(a.limit(0), b, ["k"], "inner").count() == 0


def test_band_join_keeps_rows_with_one_partner(spark, rows):
    a = spark.createDataFrame([(1, "e", 0), (2, "e", 100), (3, "e", 205), (4, None, 0), (5, "f", -7)], "id long, e string, t long")
    b = spark.createDataFrame([(9, "e", 10), (8, "e", 90), (7, "e", 110), (6, "e", 215), (5, "f", 3)], "bid long, e string, u long")
    assert rows(joins.band_join_unique(a, b, ["e"], "t", "u", 10, "id").select("id", "bid")) == [(1, 9), (3, 6), (5, 5)]


def test_overlaps_pairs_and_reciprocity(spark, rows):
    day = 86_400_000_000
    df = spark.createDataFrame([(1, day - 1_000_000, day + 2_000_000), (2, 5, 5), (3, 0, day)], "id long, a long, b long")
    assert rows(joins.day_overlaps(df, "a", "b").select("id", "day_no", "overlap_s")) == [(1, 0, 1.0), (1, 1, 2.0), (3, 0, 86400.0)]
    p = spark.createDataFrame([("b", "a"), ("a", "b"), (None, "a")], "x string, y string").select(joins.unordered_pair(F.col("x"), F.col("y")).alias("p"))
    assert [None if r["p"] is None else tuple(r["p"]) for r in p.collect()] == [("a", "b"), ("a", "b"), None]
    links = spark.createDataFrame([("a", "b", None), ("b", "c", "a"), ("c", None, "x")], "k string, nxt string, prev string")
    assert rows(joins.reciprocal(links, "k", "nxt", "prev")) == [("a", "b", True), ("b", "c", False)]


def test_duplicates_and_quarantine(spark, rows):
    df = spark.createDataFrame([(1, 1, 5.0), (1, 1, 5.0), (1, 2, None), (2, 1, 1.0), (None, 1, 1.0), (None, 1, 2.0)], "g long, n long, x double")
    flagged = quality.duplicate_flag(df, ["g", "n"])
    assert rows(flagged.groupBy("g", "is_duplicate").count()) == sorted([(1, True, 2), (1, False, 1), (2, False, 1), (None, True, 2)], key=repr)
    assert rows(quality.group_quarantine(df, ["g"], F.col("x") > 4).groupBy("g", "is_quarantined").count()) == sorted([(1, True, 3), (2, False, 1), (None, False, 2)], key=repr)
    assert rows(quality.keep_first(df, ["g"], ["n", F.desc_nulls_last("x")]).select("g", "x")) == sorted([(1, 5.0), (2, 1.0), (None, 2.0)], key=repr)
    sound, bad = quality.quarantine_split(df, quality.reasons({"big": F.col("x") > 4, "unknown": F.col("x").isNull(), "second": F.col("n") == 2}))
    assert sound.count() + bad.count() == 6 and rows(bad.select("reason").distinct()) == [("big",), ("unknown|second",)]
    assert rows(df.select(quality.first_failure({"a": F.col("x") > 0, "b": F.col("n") == 1})).distinct()) == [("a",), (None,)]
    assert quality.gates(df.limit(0), {"rows": F.count("*") > 0, "low": F.min("x") >= 0}).first().asDict() == {"rows": False, "low": False, "all_pass": False}
    report = {r["column_name"]: (r["n_rows"], r["n_null"], r["n_distinct"]) for r in quality.table_report(df, "t").collect()}
    assert report == {"g": (6, 2, 2), "n": (6, 0, 2), "x": (6, 1, 3)}


def test_aggregates_with_unknowns(spark):
    df = spark.createDataFrame([("a", None, 2.0, None), ("a", None, 0.0, True), ("b", 3.0, 2.0, False), ("b", None, 4.0, True)], "g string, y double, v double, f boolean")
    got = {r["g"]: r for r in df.groupBy("g").agg(aggs.sum_known(F.col("y")).alias("s"), aggs.sum_or_zero(F.col("y")).alias("z"), aggs.paired_ratio(F.col("y"), F.col("v")).alias("p"), aggs.only_value(F.col("y")).alias("o"), *aggs.known_yes({"f": F.col("f")})).collect()}
    assert (got["a"]["s"], got["a"]["z"], got["a"]["p"], got["a"]["f_known"], got["a"]["f_yes"]) == (None, 0.0, None, 1, 1)
    assert (got["b"]["s"], got["b"]["p"], got["b"]["o"], got["b"]["f_known"], got["b"]["f_yes"]) == (3.0, 1.5, 3.0, 2, 1)


def test_reshaping(spark, rows):
    df = spark.createDataFrame([("g", True, 1), ("g", False, 2), ("h", True, 3)], "k string, home boolean, v long")
    assert rows(reshape.pair_rows(df, "k", "home", ["v"])) == [("g", 1, 2)]
    assert rows(reshape.union_all(df.select("k"), df.select("v").limit(1))) == sorted([("g", None), ("g", None), ("h", None), (None, 1)], key=repr)
    claims = spark.createDataFrame([("q", {"P1": [("x", "normal"), ("y", "deprecated")], "P2": [("z", None)]})], f"e string, claims {reshape.CLAIMS}")
    flat = reshape.claim_rows(claims, "e", "claims")
    assert rows(flat.select("property", "value")) == [("P1", "x"), ("P2", "z")]
    assert reshape.claims_of(flat, "e").first()["claims"] == {"P1": '[{"value":"x","rank":"normal"}]', "P2": '[{"value":"z"}]'}


def test_contracts(spark):
    df = spark.createDataFrame([("1", "x")], "`Player 1` string, b string")
    c = contracts.Contract({"player1_name": "long"}, {"z": "double"}, {"player1_name": ["Player 1", "P1"]})
    assert c.apply(df).first().asDict() == {"player1_name": 1, "z": None}
    with pytest.raises(ValueError, match="missing"):
        c.apply(df.select("b"))
    with pytest.raises(ValueError, match="several"):
        c.apply(df.withColumn("p1", F.lit("2")))
    with pytest.raises(ValueError, match="reserved"):
        contracts.Contract({"b": "string"}, reserved=["b"]).apply(df)


def test_calibrated_interval_and_split_sizes(spark):
    data = [("calibration", float(i % 7), 3.0, 2.0) for i in range(60)] + [("holdout", float(i % 7), 3.0, None) for i in range(60)]
    df = spark.createDataFrame(data, "split string, y double, p double, s double")
    out = evaluation.interval_metrics(evaluation.calibrated(df, "split", "calibration", "holdout", "y", "p", "s"), "y", "p").first()
    assert out["n"] == 60 and 0.5 <= out["coverage"] <= 1 and out["width"] > 0
    evaluation.check_split_sizes(df, "split", ["calibration", "holdout"])
    with pytest.raises(ValueError):
        evaluation.check_split_sizes(df, "split", ["fit"])


def test_boosted_trees_beat_the_mean(spark):
    df = spark.range(400).select((F.col("id") % 20).cast("double").alias("a"), F.when(F.col("id") % 3 > 0, (F.col("id") % 7).cast("double")).alias("b"), (F.col("id") % 20 * 3.0).alias("y"))
    model = evaluation.boosted(df, ["a", "b"], "y", rounds=5)
    scored = model.transform(df).agg(*aggs.error_metrics(F.col("y"), F.col("prediction"))).first()
    assert scored["n"] == 400 and scored["mae"] < 13


def test_part_with_a_second_supplier_at_another_quantity_is_not_bijective(spark, rows, tmp_path):
    from tabspark.plans import relational

    spark.createDataFrame([(1, 7, 50.0), (1, 8, 3.0), (2, 9, 4.0)], "l_partkey long, l_suppkey long, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = relational.bijectivity(spark, str(tmp_path)).select("l_partkey", "l_suppkey", "a_degree", "b_degree", "is_bijective")
    assert rows(got) == [(1, 7, 2, 1, False), (1, 8, 2, 1, False), (2, 9, 1, 1, True)]
