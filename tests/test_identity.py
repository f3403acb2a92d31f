import pytest
from pyspark.sql import functions as F

from tabspark.operators import identity


def test_lookups_without_ambiguous_keys(spark, rows):
    lookup = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4), ("c", 5), ("c", 5)], "k string, v long")
    assert rows(identity.unambiguous(lookup, ["k"])) == [("a", 1)]
    assert tuple(identity.dropped_keys(lookup, ["k"]).first()) == (1, 4)
    df = spark.createDataFrame([("a", None), ("b", None), ("c", None), (None, None), ("a", 9)], "k string, x long")
    assert rows(identity.repair(df, "x", lookup, ["k"], "v")) == sorted([("a", 1), ("b", None), ("c", 5), (None, None), ("a", 9)], key=repr)
    assert identity.unambiguous(lookup.limit(0), ["k"]).count() == 0


def test_matches_that_are_not_unique_are_marked(spark, rows):
    a = spark.createDataFrame([("k1", "a1"), ("k2", "a2"), ("k2", "a3"), (None, "a4")], "k string, a string")
    b = spark.createDataFrame([("k1", "b1"), ("k2", "b2"), ("k3", "b3"), (None, "b4")], "k string, b string")
    assert rows(identity.unique_match(a, b, ["k"], "a", "b")) == [("a1", "b1", "unique"), ("a2", "b2", "several"), ("a3", "b2", "several")]


def test_links_and_adjacent_blocks(spark, rows):
    lookup = spark.createDataFrame([("2020", "ABC", "g1"), ("2021", "ABC", "g2"), ("2021", "ABC", "g3")], "season string, team string, game string")
    pages = spark.createDataFrame([(1, "/games/2020/ABC"), (2, "/games/2021/ABC"), (3, "none"), (4, None)], "page long, url string")
    assert rows(identity.linked_by_pattern(pages, "url", "/games/([0-9]+)/([A-Z]+)", ["season", "team"], lookup, ["page"]).select("page", "game")) == [(1, "g1")]
    docs = spark.createDataFrame([(1, ["LINK", "a", "b", "c"]), (2, []), (3, None), (4, ["x", "LINK"])], "k long, blocks array<string>")
    assert rows(identity.adjacent_blocks(docs, "blocks", ["k"], "LINK").select("k", "block")) == [(1, "a"), (1, "b")]


def test_typed_statements(spark):
    values = [('{"amount":"+12","unit":"1"}', 0), ('{"amount":"12.5","unit":"1"}', 0), ('{"amount":"12","unit":"m"}', 0), ('{"amount":"12","unit":"1","upperBound":"13"}', 0), ("x", 0), (None, 0)]
    df = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], "i long, v string, p long")
    got = [tuple(r["s"]) for r in df.select("i", identity.typed_statement(F.col("v"), F.col("p"), "count").alias("s")).orderBy("i").collect()]
    assert got == [("12", None), (None, "fraction"), (None, "unit"), (None, "bounds"), (None, "invalid"), (None, "missing")]
    days = spark.createDataFrame([(0, "+2020-01-02T00:00:00Z", 11), (1, "+2020-01-00T00:00:00Z", 9), (2, "+2020-02-31T00:00:00Z", 11)], "i long, v string, p long")
    got = [tuple(r["s"]) for r in days.select("i", identity.typed_statement(F.col("v"), F.col("p"), "day").alias("s")).orderBy("i").collect()]
    assert got == [("2020-01-02", None), (None, "precision"), (None, "invalid")]


def test_places_cutoffs_and_rollups(spark, rows):
    a = spark.createDataFrame([("x", "a1", 50.0, 8.0), ("x", "a2", 51.0, 8.0)], "city string, a string, lat double, lon double")
    b = spark.createDataFrame([("x", "b1", 50.001, 8.0), ("x", "b2", 51.0, 8.0), ("x", "b3", 51.0, 8.0001)], "city string, b string, lat double, lon double")
    assert [(r["a"], r["b"], round(r["metres"])) for r in identity.place_matches(a, b, ["city"], "a", "b", 500.0).collect()] == [("a1", "b1", 111)]
    q = spark.createDataFrame([("t", 1, 1), ("t", 5, 1), ("t", None, 1), ("t", 1, 5), ("u", 1, 1)], "k string, s long, r long")
    assert rows(identity.before_cutoff(q, spark.createDataFrame([("t", 3)], "k string, cut long"), "k", "s", "r", "cut")) == sorted([("t", 1, 1), ("t", None, 1)], key=repr)
    long = spark.createDataFrame([("g", "b", 2), ("g", "a", 1)], "g string, m string, v long")
    assert rows(identity.rollup_json(long, "g", "m", "v")) == [("g", '{"a":1,"b":2}')]
    with pytest.raises(Exception, match="occurs twice"):
        identity.rollup_json(long.union(long), "g", "m", "v").collect()
