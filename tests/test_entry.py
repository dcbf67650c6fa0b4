import importlib.util
import os

import duckdb
import pytest

import __spark_entry__ as entry
from barsmith.plans import catalog
from conftest import SF001

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_spec = importlib.util.spec_from_file_location("check_oracle", os.path.join(ROOT, "scripts", "check_oracle.py"))
check = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(check)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:7] == ["date", "symbol", "open", "high", "low", "close", "volume"]


def test_every_query_has_an_oracle():
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)
    # Of the optional training-data queries, those without SQL have their plain versions in tests/llm.
    assert set(catalog.QUERIES) <= set(sqls)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in check.TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", ["bars_events", "daily_features", "local_features", "adv_ema", "adv_rsi",
                                  "adv_macd", "adv_complete", "quality_report", "run_status",
                                  "forward_fill", "roundtrip_envelope", "roundtrip_envelope_document",
                                  "roundtrip_vendor_hourly", "adv_support_resistance_chunked", "adv_ema_ratios",
                                  "forward_fill_chunked", "run_log_folded", "output_manifest", "output_analysis",
                                  "quality_report_customers", "bars_events_corrected", "advanced_job_rows"])
def test_query_matches_oracle_sf0001(spark, duck, name):
    sp = entry.queries()[name](spark, SF001).toArrow().to_pandas(types_mapper=check.INTEGERS.get)
    dd = duck.execute(entry.oracle_sql()[name]).df()
    assert sorted(sp.columns) == sorted(dd.columns)
    assert len(sp) == len(dd)
    assert check.digest(check.rows_of(sp)) == check.digest(check.rows_of(dd))
