"""Queries against their comparison SQL. FLUXSIEVE_ALL=1 runs every one of them."""

import os
from pathlib import Path

import pytest

import __spark_entry__ as entry
from checks.compare import check, connect

FOLDER = "/root/testdata/sf0.001"
SHORT = (
    "flowgate_rollup", "duplicate_hours", "join_dollars", "reconcile_months", "representative_hours",
    "triangulate_voltage", "line_facts", "name_keys", "match_filings", "release_metrics", "place_requests",
    "history_contract", "footprint_contract", "components", "nearest", "snap_clusters", "classify_features",
    "injections", "panel_monthly", "panel_summary", "store_gate", "attribution", "number_functions",
    "derive_references", "build_signals", "rank_stability", "remedy_rules", "decide", "realized_band",
    "backtest_metrics", "ratio_quantiles", "corridor_rollup", "export_rows", "replay_comparison",
    "loading_screen", "base_flows", "hour_ending_months", "binding_text", "dollar_text", "settled_text", "operating_plants",
    "table_round_trip", "assembled_buses", "assembly_counts", "citation_faults", "source_citations", "blocked_values",
)
ORACLES = entry.oracle_sql()
NAMES = sorted(ORACLES) if os.environ.get("FLUXSIEVE_ALL") else SHORT

pytestmark = pytest.mark.skipif(not Path(FOLDER).is_dir(), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", NAMES)
def test_same_as_sql(spark, con, name):
    difference, rows, _, _ = check(spark, con, FOLDER, entry.queries()[name], ORACLES[name])
    assert difference is None
    assert rows > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry.queries())
