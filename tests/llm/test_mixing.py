import random

from pyspark.sql import functions as F

from tabspark.llm import mixing, ranks

TARGETS = "source string, target_share double, max_repeats long"


def _docs(spark, sizes):
    r = random.Random(5)
    data = [(f"{s}{i}", s, r.randrange(1, 40)) for s, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(data, "doc_id string, source string, n_tokens long")


def test_shares_repeats_and_report(spark):
    docs = _docs(spark, {"big": 6000, "small": 400, "unused": 50}).unionByName(spark.createDataFrame([("n", None, 9), ("z", "big", 0)], "doc_id string, source string, n_tokens long"))
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.3, 3), ("absent", 0.2, 2)], TARGETS)
    mixed = mixing.mix(docs, targets)
    report = {r["source"]: r for r in mixing.mix_report(mixed, docs, targets).collect()}
    assert abs(report["big"]["actual_share"] - 0.5 / 0.8) < 0.02 and abs(report["small"]["actual_share"] - 0.3 / 0.8) < 0.02
    assert report["absent"]["actual_share"] == 0 and report["absent"]["target_share"] == 0.2
    assert report["unused"]["n_uses"] == 0 and report["unused"]["target_share"] == 0 and report[None]["n_uses"] == 0
    uses = mixed.groupBy("source", "doc_id").count().groupBy("source").agg(F.max("count")).collect()
    assert {r[0]: r[1] for r in uses} == {"big": 1, "small": report["small"]["most_uses"]} and 2 <= report["small"]["most_uses"] <= 3


def test_long_texts_do_not_push_a_source_beyond_its_share(spark):
    r = random.Random(3)
    data = [(f"a{i}", "a", r.choice([5, 8, 900])) for i in range(200)] + [(f"b{i}", "b", r.randrange(1, 12)) for i in range(150)]
    docs = spark.createDataFrame(data, "doc_id string, source string, n_tokens long")
    mixed = mixing.mix(docs, spark.createDataFrame([("a", 0.4, 1), ("b", 0.6, 1)], TARGETS))
    got = {x[0]: x[1] for x in mixed.groupBy("source").agg(F.sum("n_tokens")).collect()}
    assert abs(got["a"] / (got["a"] + got["b"]) - 0.4) < 0.004
    assert mixed.count() == mixed.select("doc_id", "use_no").distinct().count()


def test_points_of_far_slots(spark):
    rows = spark.createDataFrame([(0,), (1,), (3,), ((1 << 40) + 1,)], "i long").select("i", mixing.van_der_corput(F.col("i"))).collect()
    assert [r[1] for r in rows] == [0.0, 0.5, 0.75, 0.5 + 2.0**-41]


def test_any_stretch_of_the_schedule_is_mixed(spark):
    sources = [mixing.Source("a", 0.7, 1, 1), mixing.Source("b", 0.3, 1, 1)]
    rows = mixing.schedule(spark, sources, 200_000).orderBy("slot").collect()
    for start in range(0, 200_000, 1000):
        assert abs(sum(r["source"] == "a" for r in rows[start : start + 1000]) / 1000 - 0.7) < 0.02
    for s in "ab":
        turns = [r["turn"] for r in rows if r["source"] == s]
        assert turns == list(range(len(turns)))


def test_empty_tables(spark):
    docs, targets = _docs(spark, {}), spark.createDataFrame([("a", 1.0, 1)], TARGETS)
    assert mixing.mix(docs, targets).count() == 0
    assert mixing.mix(_docs(spark, {"a": 3}), targets.limit(0)).count() == 0


def test_ranks_are_global_with_a_hot_group(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("g"), (F.col("id") % 7).cast("string"))).alias("g"), "id", (F.col("id") % 5).alias("w"))
    out = ranks.ranked(df, "g", F.xxhash64("id"), ["id"], 64, "w").collect()
    by: dict[str, list] = {}
    for r in out:
        by.setdefault(r["g"], []).append((r["position"], r["before"], r["w"]))
    for rows in by.values():
        total = 0
        for i, (position, before, w) in enumerate(sorted(rows)):
            assert (position, before) == (i, total)
            total += w
