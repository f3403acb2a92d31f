import json
from itertools import permutations

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabspark.operators import drift

SCHEMA = "feed_id string, file_no long, row_no long, body string, record_id long"


def _changes(spark, files, **kw):
    data = [("f-1", n, i, json.dumps(b) if isinstance(b, dict) else b, 100 * n + i) for n, bodies in files.items() for i, b in enumerate(bodies)]
    cells = drift.json_cells(spark.createDataFrame(data, SCHEMA), "feed_id", "file_no", "row_no", "body", ("record_id",))
    return {tuple(r)[1:] for r in drift.schema_changes(drift.field_lineage(cells, **kw)).collect()}


def test_rename_add_remove_retype(spark):
    a = [{"name": f"n{i}", "team": f"t{i % 3}", "rank": i} for i in range(9)]
    b = [{"full": f"n{i}", "team": f"t{i % 3}", "rank": str(i), "new": i * 7} for i in range(9)]
    c = [{"full": f"n{i}", "rank": str(i), "new": None} for i in range(9)]
    d = [{"full": f"n{i}", "rank": i, "new": i * 7, "x": None} for i in range(9)]
    assert _changes(spark, {1: a, 2: b, 3: c, 5: d}) == {
        (2, "renamed", "name", "full"), (2, "added", "", "new"), (2, "retyped", "rank", "rank"), (3, "removed", "team", ""), (5, "retyped", "rank", "rank"), (5, "added", "", "x"),
    }


def test_removed_and_added_with_other_values_is_no_rename(spark):
    a = [{"k": i, "rank": i % 3} for i in range(12)]
    b = [{"k": i, "years": (i * 5) % 13} for i in range(12)]
    assert _changes(spark, {1: a, 2: b}) == {(2, "removed", "rank", ""), (2, "added", "", "years")}


def test_type_is_followed_through_a_rename_and_over_nulls(spark):
    a, b, c = [{"a": 1}, {"a": 2}], [{"b": None}, {"b": 2}], [{"b": "1"}, {"b": "2"}]
    assert _changes(spark, {1: a, 2: b, 3: c}) == {(2, "renamed", "a", "b"), (3, "retyped", "b", "b")}
    a, b, c = [{"best_of": None}], [{"BestOf": None}], [{"BestOf": 3}]
    assert _changes(spark, {1: a, 2: b, 3: c}) == {(2, "renamed", "best_of", "BestOf")}


def test_small_sketches_still_match_large_columns(spark):
    a = [{"k": i, "v": f"v{i * 17}"} for i in range(500)]
    b = [{"k": i, "w": f"v{i * 17}"} for i in range(500)]
    assert _changes(spark, {1: a, 2: b}, sketch_size=32) == {(2, "renamed", "v", "w")}


def test_bad_bodies_repeated_rows_and_empty_table(spark):
    assert _changes(spark, {1: [{"a": 1}, "not json", None, "[1]"], 2: [{"a": 1}, {"a": 1}]}) == set()
    assert _changes(spark, {}) == set()


def test_unified_names(spark):
    data = [("f-1", 1, 0, '{"name": "x"}', 1), ("f-1", 2, 0, '{"full": "x"}', 2), ("f-2", 1, 0, '{"full": "y"}', 3)]
    cells = drift.json_cells(spark.createDataFrame(data, SCHEMA), "feed_id", "file_no", "row_no", "body", ("record_id",))
    kind = F.regexp_replace("feed_id", "-[0-9]+$", "")
    out = drift.unified(cells, drift.canonical_names(drift.field_lineage(cells), kind), kind, ["record_id"])
    assert {(r["record_id"], r["attribute"], r["value"]) for r in out.collect()} == {(1, "full", "x"), (2, "full", "x"), (3, "full", "y")}


def _unified(spark, bodies):
    data = [(feed, n, 0, json.dumps(b), i) for i, (feed, n, b) in enumerate(bodies)]
    cells = drift.json_cells(spark.createDataFrame(data, SCHEMA), "feed_id", "file_no", "row_no", "body", ("record_id",))
    kind = F.regexp_replace("feed_id", "-[0-9]+$", "")
    out = drift.unified(cells, drift.canonical_names(drift.field_lineage(cells), kind), kind, ["record_id"]).collect()
    return {(bodies[r["record_id"]][0], r["attribute"], r["value"]) for r in out}


def test_one_rename_in_a_long_feed_unites_its_names(spark):
    assert _unified(spark, [("f-1", n, {"position" if n <= 60 else "pos": "QB"}) for n in range(1, 121)]) in ({("f-1", "position", "QB")}, {("f-1", "pos", "QB")})


def test_a_rename_holds_in_its_feed_where_others_have_both_names(spark):
    both = [(f"f-{k}", n, {"team": "a", "club": "b"}) for k in (2, 3) for n in (1, 2)]
    got = _unified(spark, [("f-1", 1, {"team": "x"}), ("f-1", 2, {"club": "x"}), *both])
    assert len([x for x in got if x[0] == "f-1"]) == 1
    assert {x for x in got if x[0] != "f-1"} == {(f"f-{k}", a, v) for k in (2, 3) for a, v in (("team", "a"), ("club", "b"))}


@given(st.dictionaries(st.tuples(st.sampled_from("abcd"), st.sampled_from("wxyz")), st.floats(0.01, 1), max_size=10))
def test_matching_is_the_best_there_is(weights):
    got = drift.best_matching(weights)
    assert len({a for a, _ in got}) == len(got) == len({b for _, b in got})
    best = max((sum(weights.get((a, b), 0) for a, b in zip("abcd", p, strict=True)) for p in permutations("wxyz")), default=0)
    assert abs(sum(weights[p] for p in got) - best) < 1e-9
