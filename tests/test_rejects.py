import csv
import io

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabspark.operators import rejects

HEADER = ["id", "n", "note"]
RULES = [rejects.Rule("id", "a[0-9]+", "id"), rejects.Rule("n", r"0*[1-9][0-9]*(?:\.0+)?", "n")]

CASES = {
    "a1,1,x": None,
    'a1,2,"x, ""y"""': None,
    '"a1","02.00",': None,
    " a1 , 3 ,x": None,
    'a1,1,"x': "quoting",
    'a1,1,"x" y': "quoting",
    'a1,1,say "no"': "quoting",
    "a1,1": "column_count",
    "a1,1,x,y": "column_count",
    "": "column_count",
    ",1,x": "id",
    "b1,0,x": "id",
    "a1,0,x": "n",
    "a1,1.5,x": "n",
    "a1,1e3,x": "n",
    "a1,,x": "n",
}


def test_first_reason_that_applies(spark):
    lines = list(CASES)
    df = spark.createDataFrame(list(enumerate(lines)), "k long, line string")
    got = {r["k"]: r["reason"] for r in rejects.failed_lines(df, "k", "line", HEADER, RULES).collect()}
    assert {line: got.get(i) for i, line in enumerate(lines)} == CASES


def test_null_line_repeated_key_and_empty_table(spark, rows):
    df = spark.createDataFrame([(1, None), (2, "a1,1,x"), (2, "a1,0,x"), (2, "bad")], "k long, line string")
    assert rows(rejects.failed_lines(df, "k", "line", HEADER, RULES).select("k", "reason")) == [(1, "column_count"), (2, "column_count")]
    assert rejects.failed_lines(df.limit(0), "k", "line", HEADER, RULES).count() == 0


def test_sound_rows_come_unquoted_and_clashing_columns_do_no_harm(spark, rows):
    df = spark.createDataFrame([(1, 'a1,1,"p ""q"", r"', "z"), (2, "a1,0,x", "z")], "k long, line string, cell_value string")
    assert rows(rejects.sound_lines(df, "k", "line", HEADER, RULES, ("cell_value",))) == [(1, "z", "a1", "1", 'p "q", r')]


def test_very_long_line(spark):
    df = spark.createDataFrame([(1, "a1,1," + "x" * 2_000_000), (2, 'a1,1,"' + '""' * 300_000 + '"')], "k long, line string")
    assert rejects.failed_lines(df, "k", "line", HEADER, RULES).count() == 0


@settings(max_examples=3, deadline=None)
@given(st.lists(st.lists(st.text(st.characters(exclude_categories=("Cs",), exclude_characters="\r\n\x00"), max_size=8), min_size=3, max_size=3), min_size=1, max_size=30))
def test_fields_agree_with_a_csv_parser(spark, records):
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows(records)
    lines = out.getvalue().split("\n")[:-1]
    if len(lines) != len(records):
        return
    df = spark.createDataFrame(list(enumerate(lines)), "k long, line string")
    got = {r["k"]: list(r["line_fields"]) for r in rejects.parse_lines(df, "k", "line", HEADER).collect()}
    assert got == dict(enumerate(records))


def test_rules_need_known_reasons():
    assert [r.reason for r in rejects.structural_rules(3)] == ["quoting", "column_count"]
    with pytest.raises(TypeError):
        rejects.Rule("id")


def test_a_bad_line_with_a_null_key_is_not_sound(spark):
    lines = spark.createDataFrame([(None, "x,1"), (1, "a,2"), (2, "x"), (None, "y")], "k long, line string")
    assert [tuple(r) for r in rejects.sound_lines(lines, "k", "line", ["a", "b"], []).collect()] == [(1, "a", "2")]
