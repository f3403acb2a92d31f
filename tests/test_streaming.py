from pyspark.sql import functions as F

from tabspark.streaming import minutes

SCHEMA = "seq long, e string, at timestamp, kind string, price double, size double"


def _write(spark, path, rows):
    frame = spark.createDataFrame(rows, "seq long, e string, s long, kind string, price double, size double")
    frame.select("seq", "e", F.timestamp_seconds(F.col("s") + 1_700_000_040).alias("at"), "kind", "price", "size").coalesce(1).write.mode("append").parquet(path)


def _run(stream, path, mode="append"):
    query = stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/cp").outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def test_gaps_go_on_over_triggers(spark, rows, tmp_path):
    path = str(tmp_path)
    _write(spark, f"{path}/in", [(2, "a", 70, "x", 1.0, 1.0), (1, "a", 0, "x", 1.0, 1.0), (1, "b", 5, "x", 1.0, 1.0), (3, "b", None, "x", 1.0, 1.0)])
    make = lambda: minutes.gap_counts(spark.readStream.schema(SCHEMA).parquet(f"{path}/in"), "e", "at", "seq", 60)
    _run(make(), path)
    _write(spark, f"{path}/in", [(3, "a", 60, "x", 1.0, 1.0), (4, "a", 200, "x", 1.0, 1.0)])
    _run(make(), path)
    assert rows(spark.read.parquet(f"{path}/out")) == [("a", 2, 0, 1), ("a", 2, 1, 1), ("b", 1, 0, 0)]


def test_repeats_within_the_lateness_are_dropped(spark, tmp_path):
    path = str(tmp_path)
    _write(spark, f"{path}/in", [(1, "a", 0, "x", 1.0, 1.0), (1, "a", 0, "x", 1.0, 1.0), (2, "a", 0, "x", 1.0, 1.0)])
    _run(minutes.without_repeats(spark.readStream.schema(SCHEMA).parquet(f"{path}/in"), ["seq", "e"], "at", "1 hour"), path)
    assert spark.read.parquet(f"{path}/out").count() == 2


def test_rows_outside_their_hour_are_set_apart(spark, tmp_path):
    path = str(tmp_path)
    _write(spark, f"{path}/in", [(1, "a", 0, "x", 1.0, 1.0), (2, "a", 4000, "x", 1.0, 1.0), (3, "a", None, "x", 1.0, 1.0)])
    keep = minutes.in_archive_hour(F.col("at"), F.timestamp_seconds(F.lit(1_700_000_040)))
    stream = spark.readStream.schema(SCHEMA).parquet(f"{path}/in")
    stream.writeStream.foreachBatch(minutes.split_writer(keep, f"{path}/good", f"{path}/bad")).option("checkpointLocation", f"{path}/cp").trigger(availableNow=True).start().awaitTermination()
    assert [r["seq"] for r in spark.read.parquet(f"{path}/good").collect()] == [1]
    assert sorted(r["seq"] for r in spark.read.parquet(f"{path}/bad").collect()) == [2, 3]


def test_minutes_stay_absent_and_sums_are_exact(spark):
    df = spark.createDataFrame([("a", 0, "x", 0.1, 3.0), ("a", 59, "y", 0.2, 1.0), ("a", 120, None, None, None), ("a", None, "x", 1.0, 1.0)], "e string, s long, kind string, price double, size double")
    out = minutes.minute_activity(df.withColumn("at", F.timestamp_seconds(F.col("s") + 1_700_000_040)), ["e"], "at", "kind", ["x", "y"], F.col("price"), F.col("size"), F.lit(-1.0)).orderBy("minute_start").collect()
    assert [(r["n_rows"], r["n_x"], r["n_y"], None if r["notional"] is None else str(r["notional"].normalize()), r["n_negative_lag"]) for r in out] == [(2, 1, 1, "0.5", 2), (1, 0, 0, None, 1)]
    assert all((r["available_at"] - r["minute_start"]).seconds == 60 for r in out)
    assert minutes.minute_activity(df.limit(0).withColumn("at", F.timestamp_seconds("s")), ["e"], "at", "kind", [], F.col("price"), F.col("size"), F.lit(0)).count() == 0
