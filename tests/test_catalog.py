"""A cross-section of the registered queries against DuckDB on the smallest tables, where they are present."""

import glob
import os
import sys

import pytest

FOLDER = "/root/testdata/sf0.001"
sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

NAMES = ("asset_reliability", "asset_rollup", "removed_duplicates", "parse_dates", "event_gaps", "column_profile",
         "distribution_by_group", "percentile_ranks", "horizon_targets", "consequence_of_failure", "risk_by_horizon",
         "survival_intervals_events", "kaplan_meier", "concordance_index", "binary_metrics_by_group", "encoded_labels",
         "segment_comparison", "end_to_end_risk", "window_availability", "nearest_neighbours", "csv_fault_log", "monthly_log")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    from compare import canonical

    from faultline import catalog

    catalog.load_all()
    got = catalog.QUERIES[name](spark, FOLDER)
    want = duck.sql(catalog.SQL[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    have = canonical([tuple(r) for r in got.select(*[f"`{c}`" for c in cols]).collect()])
    assert have == canonical(want.project(", ".join(f'"{c}"' for c in cols)).fetchall())
