"""Small frames with nulls, ties, repeated rows and empty tables for the operators of records, quantiles and texts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabspark.functions import text, times
from tabspark.operators import aggs, contracts, quality, records


def test_typed_identity(spark):
    df = spark.createDataFrame([(1.0, " a "), (1.5, ""), (None, None)], "x double, s string")
    got = [tuple(r) for r in df.select(records.typed_identity(df, "x"), records.typed_identity(df, "s")).collect()]
    assert got == [("1", "a"), (None, None), (None, None)]


def test_report_entries(spark):
    data = [("A", "out", None, "g"), ("A", "gone", None, "g"), (" ", None, "NOT  yet submitted", "g"), ("A", "out", "not yet submitted", None), (None, None, None, None)]
    df = spark.createDataFrame(data, "person string, status string, reason string, game string")
    out = records.report_entries(df, F.col("person"), F.col("status"), F.col("reason"), [F.col("game")], ["out"])
    assert [(r["entry_type"], r["parse_valid"]) for r in out.collect()] == [("player_status", True), ("unresolved", False), ("team_not_submitted", True), ("player_status", False), ("unresolved", False)]


def test_banded_readings_mark_what_is_wrong(spark):
    data = [("7", "2020-01-02", "50", "good", "2"), ("8", "2020-01-02", "51.0", "Good", ""), ("0", "2020-01-02", "x", None, "0"), (None, "2020-02-30", "301", "purple", "-1"), ("9", "2019-01-01", "5", "good", "1"), ("9", "2019-01-01", "6", "good", "1")]
    df = spark.createDataFrame(data, "code string, date string, v string, band0 string, n string")
    c = F.col
    out = records.banded_readings(df, c("code"), c("date"), c("v"), c("band0"), c("n"), [50, 100, 300], ["Good", "Moderate", "Bad", "Worst"], F.lit(2020))
    got = {(r["code"], r["v"]): (r["place"], r["reading"], r["band"], r["band_check"], r["count_check"], r["exclusion_reason"]) for r in out.collect()}
    assert got[("7", "50")] == ("00007", 50, "Good", "matches", "valid", "")
    assert got[("8", "51.0")] == ("00008", 51, "Moderate", "differs", "missing", "")
    assert got[("0", "x")] == (None, None, None, "missing", "none", "invalid_codes;invalid_reading")
    assert got[(None, "301")] == (None, 301, "Worst", "unrecognised", "invalid", "invalid_codes;invalid_date")
    assert got[("9", "5")][5] == got[("9", "6")][5] == "other_year;conflicting_rows"
    assert records.banded_readings(df.limit(0), c("code"), c("date"), c("v"), c("band0"), c("n"), [50], ["a", "b"], F.lit(2020)).count() == 0


def test_consolidated_events(spark, rows):
    df = spark.createDataFrame([("e", "x", "y"), ("e", "x", "z"), ("f", None, "y"), ("g", "x", None), (None, "q", "q")], "e string, a string, b string")
    out = records.consolidated_events(df, "e", {"a": F.col("a"), "b": F.col("b")}, ["a"])
    assert rows(out) == sorted([("e", "x", None, "b_conflict", "partial"), ("f", None, "y", "a_missing", "unusable"), ("g", "x", None, "", "complete"), (None, "q", "q", "", "complete")], key=repr)


def test_payload_shapes_and_statements(spark):
    df = spark.createDataFrame([("{\"a\": \"x\", \"b\": \"y\"}",), ("{\"a\": null}",), ("{broken",), ("[1]",), (None,)], "t string")
    assert [r[0] for r in df.select(records.payload_shape(F.col("t"), "a string, b string", ["a", "b"])).collect()] == ["valid", "incomplete", "invalid", "invalid", "absent"]
    df = spark.createDataFrame([([("x", "normal"), ("w", "deprecated"), ("x", None), (None, "normal")],), ([("w", "deprecated")],), (None,)], "c array<struct<value:string,rank:string>>")
    assert [(list(r[0]["values"]), r[0]["reason"]) for r in df.select(records.known_statements(F.col("c"))).collect()] == [(["x"], None), ([], "missing"), ([], "missing")]


def test_gates_statuses_and_dictionary(spark, rows):
    df = spark.createDataFrame([(1, 1), (None, 1), (0, 0), (None, None)], "a int, b int")
    assert rows(records.gate_counts(df, {"a": F.col("a") == 1, "b": F.col("b") == 1})) == [("a", 3, 3, 1), ("b", 2, 0, 1)]
    assert [tuple(r) for r in records.gate_counts(df.limit(0), {"a": F.col("a") == 1}).collect()] == [("a", 0, 0, 0)]
    status = spark.createDataFrame([(2, 2), (1, 2), (0, 2), (None, 1)], "f int, e int").select(records.coverage_status(F.col("f"), F.col("e")))
    assert [r[0] for r in status.collect()] == ["complete", "partial", "audit_only", "audit_only"]
    assert [r["meaning"] for r in records.dictionary(records.with_meanings(df, {"a": "first", "b": "second"})).collect()] == ["first", "second"]
    with pytest.raises(ValueError, match="without a meaning"):
        records.with_meanings(df, {"a": "first"})
    with pytest.raises(ValueError, match="instead of"):
        contracts.check_rows(df, 3)


def test_dated_pairs_are_demoted_on_either_side(spark, rows):
    left = spark.createDataFrame([("a", "d1"), ("b", "d2"), ("c", "d2"), ("e", None), ("f", "d9"), ("a", "d1")], "l string, day string")
    right = spark.createDataFrame([("x", "d1"), ("y", "d2"), ("z", None), ("x", "d1")], "r string, day string")
    assert rows(records.dated_pair_matches(left, right, ["day"], "l", "r")) == sorted([("a", "x", 1, "matched"), ("b", None, 1, "demoted"), ("c", None, 1, "demoted"), ("e", None, 0, "unmatched"), ("f", None, 0, "unmatched")], key=repr)


def test_place_ladder(spark):
    a = spark.createDataFrame([(1, "p", 10.0, 10.0), (2, "p", 10.003, 10.0), (3, "p", 11.0, 10.0), (4, "q", 1.0, 1.0), (5, "n", 1.0, 1.0), (6, None, 1.0, 1.0), (7, "p", None, 1.0)], "k int, place string, lat double, lon double")
    b = spark.createDataFrame([("p", 10.0, 10.0), ("p", 10.0, 10.0), ("q", 1.0, 1.0), ("q", 2.0, 1.0), (None, 1.0, 1.0)], "place string, lat double, lon double")
    got = {r["k"]: r["status"] for r in records.place_ladder(a, b, "place", "k").collect()}
    assert got == {1: "same_point", 2: "same_facility", 3: "too_far", 4: "several_coordinates", 5: "no_row", 6: "no_identity", 7: "no_coordinate"}


def test_greedy_distinct_equals_a_loop(spark):
    r = random.Random(5)
    data = [(g, i, r.randrange(4), r.choice([None, 0, 1, 2])) for g in "ab" for i in range(30)]
    want = set()
    for g in "ab":
        picked = []
        for row in sorted(x for x in data if x[0] == g):
            if len(picked) < 3 and not any(p[2] == row[2] or p[3] == row[3] for p in picked):
                picked.append(row)
        want |= {(g, k + 1, p[1], p[2], p[3]) for k, p in enumerate(picked)}
    out = records.greedy_distinct(spark.createDataFrame(data, "g string, i int, x int, y int"), "g", ["i"], ["x", "y"], 3)
    assert {tuple(x) for x in out.select("g", "pick", "i", "x", "y").collect()} == want


def test_pair_quarantine_and_calendar(spark, rows):
    df = spark.createDataFrame([("g", "a", "b", True, 1), ("g", "b", "a", False, 1), ("h", "a", "b", True, 1), ("i", "a", "b", True, 1), ("i", "b", "c", False, 1), ("j", "a", "b", True, 1), ("j", "b", "a", True, 1), (None, "a", "b", True, 1), ("k", "a", "b", True, 1), ("k", "b", "a", False, None)], "g string, me string, o string, home boolean, s int")
    got = {(r["g"], r["is_valid"]) for r in records.pair_quarantine(df, "g", "me", "o", "home", ["s"]).collect()}
    assert got == {("g", True), ("h", False), ("i", False), ("j", False), (None, False), ("k", False)}
    days = spark.createDataFrame([("2020-01-01",), ("2020-01-01",), ("2020-01-03",), ("2021-01-01",), (None,)], "d string").select(F.col("d").cast("date").alias("d"))
    assert [(str(a), b, c) for a, b, c in rows(records.calendar_gaps(days, "d", "2020-01-01", "2020-01-03"))] == [("2020-01-01", 2, "repeated"), ("2020-01-02", 0, "missing"), ("2021-01-01", 1, "outside")]


def test_overlaps_examples_roles_and_teams(spark, rows):
    a = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    records.reject_overlap(a, spark.createDataFrame([(3,), (None,)], "k int"), ["k"])
    with pytest.raises(ValueError, match="share keys"):
        records.reject_overlap(a, a, ["k"])
    assert [r["k"] for r in records.first_examples(a, ["k"], 2).collect()] == [1, 2]
    assert [r["k"] for r in records.in_order(a, [F.col("k")]).collect()] == [1, 2, None]
    df = spark.createDataFrame([("u", 1, 1, "x"), ("u", 2, 2, None), ("u", 3, 3, "y"), ("v", 1, 4, "y")], "u string, us long, id long, role string")
    assert [r["previous_role"] for r in records.lagged_role(df, "u", "us", "id", "role").orderBy("id").collect()] == ["OTHER", "x", "OTHER", "OTHER"]
    names = spark.createDataFrame([("St. A",), ("st a",), ("b",), (None,)], "n string")
    assert [r[0] for r in names.select(records.resolve_team(F.col("n"), {"ST A": "one"})).collect()] == ["one", "one", None, None]
    with pytest.raises(ValueError, match="several teams"):
        records.resolve_team(F.col("n"), {"a": "one", "A.": "two"})


def test_hours_only_between_precise_times(spark):
    hour = 3_600_000_000
    df = spark.createDataFrame([("t", 0, 1, True), ("t", 30 * hour, 2, True), ("t", 50 * hour, 3, False), ("t", 60 * hour, 4, True)], "t string, us long, id long, sure boolean")
    out = records.hours_since_last(df, "t", "us", "id", F.col("sure")).orderBy("id").collect()
    assert [(r["hours_since"], r["days_since"]) for r in out] == [(None, None), (30.0, 1), (None, 1), (None, 0)]


@pytest.mark.parametrize("seed", range(3))
def test_exact_quantiles_equal_numpy(spark, seed):
    r = random.Random(seed)
    data = [(r.choice(["a", "b", None]), r.choice([None, float(r.randrange(5)), r.random()])) for _ in range(300)] + [("c", None), ("d", 7.0)]
    got = {x["k"]: x["quantiles"] for x in aggs.exact_quantiles(spark.createDataFrame(data, "k string, v double"), ["k"], "v", [0.1, 0.5, 0.9]).collect()}
    for k in ("a", "b", None, "d"):
        assert np.allclose(got[k], np.quantile([v for g, v in data if g == k and v is not None], [0.1, 0.5, 0.9]))
    assert "c" not in got
    assert aggs.exact_quantiles(spark.createDataFrame([], "k string, v double"), ["k"], "v", [0.5]).count() == 0


def test_quarantine_summary(spark, rows):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (2, 1), (None, 1), (None, 1)], "o int, l int")
    assert rows(quality.quarantine_summary(df, ["o", "l"], ["o"])) == sorted([(1, 3, 2, True), (2, 1, 0, False), (None, 2, 2, True)], key=repr)


def test_pages(spark):
    page = """<html><head><meta property="og:title" content="T"><meta name="x"><script type="application/ld+json">{"a": [{"headline": "H"}]}</script></head>
    <body><p>out</p><main><h1>Head</h1><p>one<br>two &amp; three</p><div class="related-card"><p>not</p></div><img src="x"><p>four</p></main></body></html>"""
    bare = '<p>a</p><script type="application/ld+json">{broken</script><nav><p>n</p></nav><p>b'
    got = {r["k"]: r["c"] for r in spark.createDataFrame([(1, page), (2, bare), (3, None), (4, "")], "k int, h string").select("k", text.page_content("h").alias("c")).collect()}
    assert (got[1]["blocks"], got[1]["headline"]) == (["Head", "onetwo & three", "four"], "H")
    assert (got[2]["blocks"], got[2]["headline"]) == (["a", "b"], None) and got[3]["blocks"] is None and got[4]["blocks"] == []


def test_json_scalars_at_any_depth(spark):
    deep = "[" * 400 + "1" + "]" * 400
    df = spark.createDataFrame([(1, '{"a": {"b": [1, true, null, 2.5, "x"]}, "skip": {"c": 1}}'), (2, deep), (3, "{"), (4, None)], "k int, j string")
    got = {(r["k"], r["path"], r["value"], r["kind"]) for r in text.json_scalars(df, "j", ["k"], ["skip"]).collect()}
    assert {x for x in got if x[0] == 1} == {(1, "$.a.b[0]", "1", "whole"), (1, "$.a.b[1]", "true", "flag"), (1, "$.a.b[2]", None, "null"), (1, "$.a.b[3]", "2.5", "real"), (1, "$.a.b[4]", "x", "text")}
    assert len([x for x in got if x[0] == 2]) == 1 and not [x for x in got if x[0] > 2]


def test_prop_rules_and_prose_dates(spark):
    rules = ["Ann O'Neil scores more than 20.5 points.", "Bo records 250 or more passing yards", "Bo scores more than 3 points in the 1st half", "Bo wins", None, "A scores more than 1 points and B scores more than 2 points"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in rules], "r string").select(text.prop_rule(F.col("r"))).collect()]
    assert [(x["player"], x["threshold"], x["comparator"], x["rejected"]) for x in got] == [("Ann O'Neil", 20.5, "more_than", None), ("Bo", 250.0, "at_least", None), (None, None, None, "partial_game"), (None, None, None, "no_rule"), (None, None, None, "no_rule"), (None, None, None, "no_rule")]
    dates = ["on March 5, 2021, at 12:05 a.m. EST", "March 5, 2021", "at 3:05 PM UTC", "February 30, 2021", None, "March 5, 2021 13:05 PM EDT"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in dates], "r string").select(times.spoken_instant(F.col("r"))).collect()]
    assert [(str(x["day"]) if x["day"] else None, x["precision"]) for x in got] == [("2021-03-05", "minute"), ("2021-03-05", "date"), (None, "none"), (None, "none"), (None, "none"), ("2021-03-05", "date")]
    assert got[0]["instant"].strftime("%H:%M") == "05:05"


def test_archives_of_every_kind(spark, tmp_path):
    import gzip
    import io
    import lzma
    import tarfile
    import zipfile

    from tabspark.sources import readers

    tar = io.BytesIO()
    with tarfile.open(fileobj=tar, mode="w:gz") as t:
        info = tarfile.TarInfo("in/a.txt")
        info.size = 3
        t.addfile(info, io.BytesIO(b"abc"))
    packed = {"x.csv.gz": gzip.compress(b"abc"), "y.csv.xz": lzma.compress(b"abc"), "z.tar.gz": tar.getvalue()}
    for name, data in packed.items():
        assert [b for _, b in readers.unpack(name, data, 10)] == [b"abc"]
        with pytest.raises(ValueError, match="refused"):
            readers.unpack(name, data, 2)
    assert readers.unpack("f/x.csv.gz", packed["x.csv.gz"], 10)[0][0] == "x.csv"
    bad = io.BytesIO()
    with zipfile.ZipFile(bad, "w") as z:
        z.writestr("../a", "x")
    with pytest.raises(ValueError, match="refused"):
        readers.unpack("b.zip", bad.getvalue(), 10)
    with pytest.raises(tarfile.ReadError):
        readers.unpack("plain", b"no archive", 10)
    gate = readers.inventory_gate(spark.createDataFrame([("a", 2), ("b", 3)], "name string, size long"), 2, 5).first()
    assert tuple(gate) == (True, True, True)
