"""Plans stay what they should be: narrow scans, no products of tables, filters at the scan."""

import os
import re

import pytest
from pyspark.sql import functions as F

from tabspark.operators import profile, rejects
from tabspark.plans import data_quality, relational, temporal
from tabspark.session import table

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scanned(df):
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<([^>]*)>", plan(df))]


def test_scans_read_only_what_is_used(spark):
    deltas = profile.value_deltas(table(spark, SF, "nfl_plays"), "nfl_plays", ["air_yards"])
    assert scanned(deltas) == [{"air_yards", "load_no"}]
    lines = table(spark, SF, "raw_point_lines").filter("line_number <> 1")
    found = rejects.failed_lines(lines, "line_id", "raw_line", data_quality.POINT_HEADER, data_quality.POINT_RULES)
    assert {"line_id", "line_number", "raw_line"} in scanned(found)
    assert "Not(EqualTo(line_number,1))" in plan(found)


def test_one_shuffle_for_counts(spark):
    df = relational.known_yes_counters(spark, SF)
    assert plan(df).count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("query", [temporal.asof_prefix_counts, temporal.asof_last_w_means, temporal.trailing_density, temporal.run_lengths, relational.band_join_unique, relational.whole_group_quarantine])
def test_no_products(spark, query):
    text = plan(query(spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text and "PythonUDF" not in text


def test_top_k_prunes_before_the_sort(spark):
    assert "WindowGroupLimit" in plan(relational.topk_per_group(spark, SF))


def test_hot_entity_is_cut_into_slices(spark):
    from tabspark.operators import temporal as t

    hot = spark.range(1000).select(F.lit("hot").alias("e"), "id", (F.col("id") * t.DAY_US).alias("us"))
    sizes = t.sliced(hot, "e", "us", "id", 3, slice_rows=100).groupBy("e", "__slice").count().collect()
    assert len(sizes) == 11 and max(r["count"] for r in sizes) <= 103
