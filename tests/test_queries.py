"""A few registered queries against their SQL, and the driver's contract."""

from datetime import date, datetime
from pathlib import Path

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(rows):
    def one(v):
        if isinstance(v, datetime):
            return v.isoformat()
        if isinstance(v, date):
            return datetime(v.year, v.month, v.day).isoformat()
        return round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else v

    return sorted((tuple(str(one(v)) for v in r) for r in rows))


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.skipif(not Path(SF).exists(), reason="no test data")
@pytest.mark.parametrize("name", ["ag_performance", "cal_05_segments", "q_24_quarantine", "wn_05_ema", "ml_01_labels", "cal_08_expected_session", "st_03_completed_bars"])
def test_query_equals_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF)
    want = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in want.description]
    assert sorted(names) == sorted(got.columns)
    assert plain(got.select(*[f"`{n}`" for n in names]).collect()) == plain(want.fetchall())


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not Path(SF).exists(), reason="no test data")
def test_entry(spark):
    assert entry.entry(spark).count() > 0
