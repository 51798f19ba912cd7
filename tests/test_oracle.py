"""Queries against their SQL over the smallest tables: those that build what the others select from."""

import math

import duckdb
import pandas as pd
import pytest

from panelmill.queries.all import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def cell(x):
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and math.isnan(x)):
        return "-"
    if isinstance(x, bool) or type(x).__name__ == "bool_":
        return str(bool(x))
    if hasattr(x, "isoformat"):
        return x.isoformat()[:19].removesuffix("T00:00:00")
    if isinstance(x, str):
        return x
    return f"{float(x):.6f}".replace("-0.000000", "0.000000")


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(tuple(cell(x) for x in r) for r in df.itertuples(index=False, name=None))


NAMES = """src_bars wn_01_latest_landed ind_01_change ind_08_bollinger ind_10_obv_mfi ind_14_risk ind_17_beta ind_21_signal_series ind_24_adjusted fct_01_market
pit_01_concepts pit_02_metrics rank_07_candidates rank_08_round_scores rank_11_line_of_sight gld_01_watchlist gld_04_alerts gld_11_candidates gld_13_daily_analytics
view_14_weekly view_28_peers bt_01_forward_returns bt_10_evaluate call_01_hysteresis call_03_next_round set_02_settle set_02_attribution hld_01_open_lots hld_02_reconcile
hld_03_loss_harvest hld_05_held src_05_factors src_06_disclosures src_08_facts_json src_09_listings snk_01_append snk_03_upsert snk_05_first_write dim_01_calendar dim_03_versions
dim_04_scd2_apply jn_04_valid_at fct_02_fundamentals jn_20_drill_across ag_04_median qa_01_freshness qa_10_price_checks str_01_dedupe str_02_ohlc str_03_hysteresis
ind_12_atr ind_13_high_low ind_22_signal_row gld_02_gate gld_03_snapshot set_01_frozen set_03_drift call_06_due_rules dim_07_current prj_01_quotes ag_05_approximate jn_21_optional
view_04_levels view_12_spans bt_04_ic_summary src_01_prices ag_02_pivot""".split()


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toPandas(), duck.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_each_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_decay_ladder(spark):
    """At sf0.01: the smallest tables have too few sessions for the long rungs."""
    sf, con = SF.replace("sf0.001", "sf0.01"), duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got, want = QUERIES["bt_10_decay_ladder"](spark, sf).toPandas(), con.sql(SQL["bt_10_decay_ladder"]).df()
    assert rows(got) == rows(want)
    assert set(got["horizon"]) == {21 * k for k in range(1, 13)}
