"""Registered queries against their SQL equivalents.

A sample runs by default; set PAYSIFT_ALL_QUERIES=1 for every query (some twenty minutes).
"""

import os
from pathlib import Path

import pytest

import __spark_entry__ as entry_points
from paysift.plans import load_all
from tests.compare import compare, connect

FOLDER = os.environ.get("PAYSIFT_TESTDATA", "/root/testdata/sf0.001")
SAMPLE = ["annualised_pay", "parsed_locations", "page_texts", "salary_lineage", "null_report", "attached_item_lists", "olap_top_items", "quantiles_by_priority", "document_overlap",
          "company_capped_snapshots", "vocabulary", "matched_words", "association_rules", "validated_rules", "jaccard_network", "grouped_design", "prediction_intervals", "rule_intervals",
          "connected_documents", "feature_totals", "auc_per_class", "nearest_neighbours", "density_clusters", "cluster_profiles", "encoded_rows", "streamed_snapshots"]
REGISTRY = load_all()
CHOSEN = list(REGISTRY) if os.environ.get("PAYSIFT_ALL_QUERIES") else SAMPLE

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_sql(spark, duck, name):
    q = REGISTRY[name]
    df = q(spark, FOLDER)
    if q.sql is None:
        assert df.columns and df.count() >= 0
    else:
        assert compare(df, duck, q.sql) is None


def test_entry_points_agree():
    queries, sql = entry_points.queries(), entry_points.oracle_sql()
    assert set(sql) <= set(queries) and entry_points.FLAGSHIP in sql and len(queries) > 200


def test_flagship_runs(spark):
    assert entry_points.entry(spark).count() == 10
