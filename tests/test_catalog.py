"""Every catalogue query beside its SQL at the smallest scale, and the driver's entry point."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402
from tools.compare import compare  # noqa: E402

SF = "/root/testdata/sf0.001"
# the last ones read the same stores as their neighbours in the catalogue
SLOW = {"m3_forest_nodes", "m4_scores", "m7_shadow_union", "s3_dlq_append", "e6_audit", "stream_late_rows"}

needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@needs_data
def test_entry(spark):
    assert contract.entry(spark).count() > 0


@needs_data
@pytest.mark.parametrize("name", sorted(set(contract.queries()) - SLOW))
def test_query_equals_sql(spark, name):
    good, text = compare(spark, name, SF)
    assert good, text


@needs_data
def test_hot_vehicles_score_worst(spark):
    """Vehicles whose motor runs 20 degrees hotter score worse and are flagged more often."""
    rows = contract.queries()["m4_scores"](spark, "/root/testdata/sf0.01").toPandas()
    hot = rows["vehicle_id"].str[3:].str.replace("U", "").astype(int) % 40 == 7
    assert rows["is_anomaly"].mean() == pytest.approx(0.05, abs=0.01)
    assert rows[hot]["anomaly_score"].mean() < rows[~hot]["anomaly_score"].mean()
    assert rows[hot]["is_anomaly"].mean() > rows[~hot]["is_anomaly"].mean()
