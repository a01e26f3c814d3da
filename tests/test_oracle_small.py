"""Every registered query with a SQL twin agrees with DuckDB on sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

from .conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
KEYS = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(rows):
    out = []
    for r in rows:
        t = []
        for v in r:
            if hasattr(v, "item"):
                v = v.item()
            if isinstance(v, float) and math.isnan(v):
                v = None
            t.append(v)
        out.append(tuple(t))
    return sorted(out, key=lambda x: tuple((v is None, str(v)) for v in x))


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_sql_twin(spark, duck, key):
    pdf = entry.queries()[key](spark, SF_SMALL).toPandas()
    odf = duck.sql(entry.oracle_sql()[key]).df()
    cols = sorted(pdf.columns)
    assert cols == sorted(odf.columns)
    a = _norm(pdf[cols].itertuples(index=False))
    b = _norm(odf[cols].itertuples(index=False))
    assert len(a) == len(b)
    for x, y in zip(a, b):
        for u, v in zip(x, y):
            if isinstance(u, float) or isinstance(v, float):
                assert (u is None and v is None) or math.isclose(u, v, rel_tol=1e-9, abs_tol=1e-6)
            else:
                assert str(u) == str(v)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["event_type", "model", "n", "MAE", "RMSE", "MAPE_percent", "sMAPE_percent"]


@pytest.mark.parametrize("key", ["walkforward_metrics", "preview", "canonical_from_lines", "stream_bins", "stream_ordered_error", "stream_compacted_bins", "sequence_scores", "canonical_cast"])
def test_results_do_not_depend_on_session_zone(spark, duck, key):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        pdf = entry.queries()[key](spark, SF_SMALL).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    odf = duck.sql(entry.oracle_sql()[key]).df()
    cols = sorted(pdf.columns)
    assert _norm(pdf[cols].itertuples(index=False)) == _norm(odf[cols].itertuples(index=False))
