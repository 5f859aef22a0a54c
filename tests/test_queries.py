"""A sample of the registered queries against their SQL, exactly, at the smallest scale."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, connect

FAST = [
    "prep_points", "tile_counts", "adjacency_pairs", "cluster_conservative", "zonal_region", "emission_totals", "emit_base", "speciate_saprc",
    "grid_daily_1x1", "grid_wrf_lambert", "grid_unstructured", "reject_counts", "v1_emissions", "v1_overlap", "diff_outputs", "regrid_mode", "run_log_summary",
    "stream_daily_tile_counts", "scanline_areas",
]


@pytest.fixture(scope="module")
def con():
    return connect(SF_SMALL)


@pytest.mark.parametrize("name", FAST)
def test_query_matches_sql(spark, con, name):
    status, n, _, detail = compare(spark, con, SF_SMALL, name, entry.queries()[name], entry.oracle_sql()[name])
    assert status == "ok" and n > 0, detail


def test_registry_is_consistent():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
