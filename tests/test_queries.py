"""Every query of the entry module against its SQL twin on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
CORE = sorted(n for n, q in entry.queries().items() if not q.__module__.startswith("tabspark.llm"))


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return con


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def text(x):
        if isinstance(x, float):
            return "nan" if math.isnan(x) else f"{x:.6g}"
        return str(x)

    return sorted(tuple(text(r[i]) for i in order) for r in rows)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
@pytest.mark.parametrize("name", CORE)
def test_query_equals_its_twin(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    if name in entry.oracle_sql():
        cursor = duck.execute(entry.oracle_sql()[name])
        names = [c[0] for c in cursor.description]
        assert sorted(names) == sorted(df.columns)
        assert got == canonical(cursor.fetchall(), names)
    else:
        assert name in {"p4_found", "p4_unified", "p4_depth_charts", "p4_match_metadata", "p6_readings"}
