"""Registered queries against their oracles on the smallest tables.

All that have an oracle run here but the trained models; `python tools/check.py <sf_dir>` runs those too.
"""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from stayline.plans import catalog
from tools.check import compare, oracle_connection

SF = "/root/testdata/sf0.001"
# The trained models take minutes each at their full settings; `tools/check.py` runs them.
SLOW = {
    "gbt_scores", "gbt_evaluation", "model_save_and_load", "cross_validation_grid", "model_registration",
    "cluster_as_feature", "elbow_curve", "cluster_stability", "mixture_selection", "stream_model_scoring", "kmeans_segments",
    "foreign_model_scores", "halving_search",
}
# Queries whose conditions no row of the smallest tables meets.
EMPTY: set[str] = set()
NAMES = sorted(n for n in catalog.ORACLES if n not in SLOW)
needs_data = pytest.mark.skipif(not Path(SF).exists(), reason="test tables not present")


@needs_data
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_oracle(spark, name):
    status, rows, *_, diff = compare(spark, oracle_connection(SF), SF, name)
    assert status == "ok", diff
    assert rows > 0 or name in EMPTY


@needs_data
def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
