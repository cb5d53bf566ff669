"""Driver contract: entry smoke check and every registered query against its DuckDB oracle (sf0.001)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E

from paths import SF_SMALL


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["window_start", "window_end", "store_id", "order_cnt", "gmv_total", "user_cnt"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(E._job_oracle_sql()) == set(E._job_queries())
    assert set(E.oracle_sql()) <= set(E.queries())


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def n(v):
        return round(v, 9) if isinstance(v, float) and not math.isnan(v) else v

    return sorted((tuple(n(r[i]) for i in order) for r in recs), key=repr)


@pytest.mark.parametrize("name", sorted(E._job_oracle_sql()))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("events",):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t + '.parquet')}')")
    df = E.queries()[name](spark, SF_SMALL)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, res.fetchall())
