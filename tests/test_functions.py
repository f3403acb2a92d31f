import io
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from tabspark.functions import mathx, normalize, text, times
from tabspark.sources import readers, writers


def _one(spark, values, make, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i long, v {kind}")
    return [r[1] for r in df.select("i", make(F.col("v"))).orderBy("i").collect()]


def test_normalising(spark):
    n = normalize
    assert _one(spark, ["401.0", "7", " 12 ", "1.5", "x", None, "1e3", "00001"], n.identifier) == ["401", "7", "12", None, None, None, "1000", "1"]
    assert _one(spark, ["22.0", "12345678901", "7"], lambda c: n.suffix_id(c, 10)) == ["0000000022", "12345678901", "0000000007"]
    assert _one(spark, ["TRUE", "0.0", "maybe", None], n.flag) == [True, False, None, None]
    assert _one(spark, ["NaN", "1e3", "inf", " 1 ", "x"], n.number) == [None, 1000.0, None, 1.0, None]
    assert _one(spark, ["9223372036854775807", "9223372036854775808", "-1", "1.0", "007"], n.unsigned) == [2**63 - 1, None, None, None, 7]
    assert _one(spark, ["  ", " x ", "", None], n.blank_to_null) == [None, " x ", None, None]
    assert _one(spark, ["12", "12.0", "0", "x", "012.00"], n.integral_key) == ["12", "12", None, None, "12"]
    assert _one(spark, ["Poülvowe-Ñ", None], n.latin_fold) == ["poulvowen", None]
    assert _one(spark, ["  Straße\n x", None], n.casefold_nfc) == ["strasse x", None]
    assert _one(spark, ["6-2", "x", None], n.height_cm) == [pytest.approx(187.96), None, None]
    assert _one(spark, ["b A b c", None, ""], lambda c: n.phrases(c, "(?i)[ab]")) == [["a", "b"], None, []]
    assert n.header_key("Player 1") == "player1" and n.snake_case("gameEventID") == "game_event_id"


def test_times(spark):
    assert _one(spark, ["2021-01-01T10:00:00Z", "2021-01-01", "x", None, ""], times.date_class) == ["offset", "calendar", "invalid", "null", "empty"]
    assert _one(spark, ["2021-01-01T10:00:00Z", "2021-01-01T10:00:00"], lambda c: times.instant(c, need_zone=True).isNull()) == [False, True]
    assert _one(spark, ["on March 5, 2021 he", "none", None], lambda c: times.spoken_date(c).cast("string")) == ["2021-03-05", None, None]
    got = _one(spark, ["2024-03-10 02:30", "2024-11-03 01:30", "2024-07-01 12:00"], lambda c: times.local_to_utc(c, "America/New_York").cast("string"))
    assert got == [None, None, "2024-07-01 16:00:00"]
    split = lambda c: times.calendar_split(c.cast("timestamp"), ["2024-01-01", "2025-01-01"], ["fit", "cal", "hold"], boundary_days=["2024-12-31"])
    assert _one(spark, ["2023-12-31 23:59:59", "2024-01-01", "2024-12-31 10:00", "2025-01-01", None], split) == ["fit", "cal", "date_precision_unresolved", "hold", "unknown_date"]
    assert _one(spark, ["1478654100000", "1", "x"], lambda c: times.epoch_ms(c, 2010).isNull()) == [False, True, True]


def test_instant_reads_whole_days_only(spark):
    texts = ["10:15", "2009-09", "20210101T100000Z", "2021-01-01 05:00:00.000-0500", "2021-01-01T10:00:00.000000883Z", "1252243800", "TBD", None, "2021-01-01"]
    assert _one(spark, texts, lambda c: times.instant(c).cast("string")) == [None, None, *["2021-01-01 10:00:00"] * 3, None, None, None, "2021-01-01 00:00:00"]
    assert _one(spark, texts, times.precision_class) == ["unknown", "unknown", *["source_timestamp"] * 3, "unknown", "unknown", "unknown", "source_calendar_date"]


def test_boundary_split_keeps_every_row(spark, tmp_path):
    from tabspark.plans import values

    texts = ["2019-12-31", "2019-12-31T23:00:00Z", "2019-12-31T23:00:00-05:00", "10 Dec 2009 8:15 PM", "00:20", None]
    spark.createDataFrame(list(enumerate(texts)), "source_row_id long, game_date string").write.parquet(f"{tmp_path}/nfl_schedule.parquet")
    got = {r[0]: (r[1], r[2]) for r in values.calendar_split_boundary(spark, str(tmp_path)).collect()}
    unknown = ("unknown_date", "unknown")
    assert got == {0: ("date_precision_unresolved", "source_calendar_date"), 1: ("development", "source_timestamp"), 2: ("holdout", "source_timestamp"), 3: unknown, 4: unknown, 5: unknown}


def test_math(spark):
    assert _one(spark, [150.0, -200.0, 0.0, None], mathx.decimal_odds, "double") == [2.5, 1.5, None, None]
    assert _one(spark, [-1.0, 5.0, None], lambda c: mathx.clip(c, 0, 3), "double") == [0.0, 3.0, None]
    assert _one(spark, [0.0, 1.0, 2.0, None], lambda c: mathx.bins(c, [1, 2], ["a", "b", "c"]), "double") == ["a", "b", "c", "unknown"]
    assert _one(spark, [1.0, 2.0], lambda c: mathx.bins(c, [1, 2], ["a", "b", "c"], closed="right"), "double") == ["a", "b"]
    low, high = mathx.wilson(F.lit(8), F.col("v"))
    assert _one(spark, [10, 0], lambda _: F.round(low, 4), "long") == [0.4902, None] and _one(spark, [10], lambda _: F.round(high, 4), "long") == [0.9433]
    assert _one(spark, [float("nan"), float("inf"), 1.5], mathx.as_feature, "double") == [None, None, 1.5]
    books = ['[["0.4","10"],["0.5","0"]]', '[["0.4","10"],["0.4","1"]]', '[["1.4","10"]]', "x", "[]"]
    got = _one(spark, books, lambda c: mathx.book_levels(c))
    assert [None if x is None else [float(y["price"]) for y in x] for x in got] == [[0.4], None, None, None, []]
    stats = _one(spark, ['[["0.4","10"],["0.3","2"]]'], lambda c: mathx.book_stats(mathx.book_levels(c), mathx.book_levels(F.lit('[["0.6","1"]]'))))[0]
    assert (float(stats["best_bid"]), float(stats["best_ask"]), float(stats["bid_size"]), stats["bid_levels"], float(stats["spread"])) == (0.4, 0.6, 12.0, 2, 0.2)


def test_text(spark, rows):
    page = "<html><head><title>T</title><style>x{}</style></head><body><nav><p>menu</p></nav><h2>Start</h2><p>one  <b>two</b></p><p>three</p><h2>Stop</h2><p>four</p></body></html>"
    df = spark.createDataFrame([(1, page), (2, None), (3, "")], "k long, html string").withColumn("blocks", text.html_blocks("html"))
    assert {r["k"]: r["blocks"] for r in df.collect()} == {1: ["T", "Start", "one two", "three", "Stop", "four"], 2: None, 3: []}
    assert rows(text.sections(df, "blocks", ["k"], "^start", "^stop")) == [(1, 0, "one two"), (1, 1, "three")]
    notes = spark.createDataFrame([(1, "No rain, rain stopped"), (2, "Rain last week"), (3, None)], "k long, t string")
    assert rows(text.mentions(notes, "t", {"weather": "rain"}, ["k"], ["no", "not"], ["previous", "last (?:week|year)"])) == [(1, "weather", 1, "rain", True, False), (2, "weather", 1, "rain", False, True)]
    assert _one(spark, ["24-foot three-pointer", "x", None], text.shot_distance) == [24, None, None]


def test_csv_keeps_null_and_empty_apart(spark, rows, tmp_path):
    df = spark.createDataFrame([("001", None, 'a,"b"\nc', [1, None]), ("2", "", " x ", None)], "id string, e string, t string, n array<int>")
    writers.write_csv(df, str(tmp_path / "out"), "none")
    back = spark.read.schema(readers.text_schema(df.columns)).option("header", True).option("nullValue", r"\N").option("escape", "\"").option("emptyValue", "").option("multiLine", True).csv(str(tmp_path / "out"))
    assert rows(back) == sorted([("001", None, 'a,"b"\nc', "[1,null]"), ("2", "", " x ", None)], key=repr)
    with pytest.raises(ValueError):
        writers.write_csv(spark.createDataFrame([(r"\N",)], "t string"), str(tmp_path / "bad"))
    with pytest.raises(Exception, match="(?i)exists"):
        writers.write_csv(df, str(tmp_path / "out"))


def test_strict_csv_archives_and_inventory(spark, rows, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n3\n4,5,6\n")
    bad = readers.csv_strict(spark, str(tmp_path / "a.csv"), ["x", "y"]).cache()
    assert rows(bad.select("x", (F.col(readers.BAD_LINE).isNotNull()))) == [("1", False), ("3", True), ("4", True)]
    assert readers.csv_header(spark, str(tmp_path / "a.csv")) == ["x", "y"]
    (tmp_path / "z").mkdir()
    with zipfile.ZipFile(tmp_path / "z" / "a.zip", "w") as z:
        z.writestr("m.txt", "hello")
    with tarfile.open(tmp_path / "z" / "b.tar", "w") as t:
        info = tarfile.TarInfo("n.txt")
        info.size = 2
        t.addfile(info, io.BytesIO(b"hi"))
    members = readers.archive_members(spark, str(tmp_path / "z"))
    assert rows(members.select("member", "size", F.col("content").cast("string"))) == [("m.txt", 5, "hello"), ("n.txt", 2, "hi")]
    with zipfile.ZipFile(tmp_path / "z" / "c.zip", "w") as z:
        z.writestr("../evil", "x")
    with pytest.raises(Exception, match="refused"):
        readers.archive_members(spark, str(tmp_path / "z")).collect()
    manifest = spark.createDataFrame([("a.csv", 16, "0" * 64), ("gone", 1, "0" * 64)], "name string, size long, sha256 string")
    assert rows(readers.inventory(spark, str(tmp_path / "a.csv"), manifest)) == [("a.csv", "digest"), ("gone", "missing")]


def test_json_shapes(spark, rows):
    df = spark.createDataFrame([('{"results": {"bindings": [{"a": {"value": "1"}}, {"b": {"value": "2"}}]}}',)], "j string")
    assert rows(readers.bindings(df, "j", ["a", "b"])) == sorted([("1", None), (None, "2")], key=repr)
    arrays = spark.createDataFrame([(1, ["x", "y"], [1.0, 2.0])], "k long, time array<string>, t array<double>")
    assert rows(readers.column_arrays(arrays, ["k"], ["time", "t"])) == [(1, "x", 1.0), (1, "y", 2.0)]
    with pytest.raises(Exception, match="differ in length"):
        readers.column_arrays(arrays.withColumn("t", F.array(F.lit(1.0))), ["k"], ["time", "t"]).collect()
