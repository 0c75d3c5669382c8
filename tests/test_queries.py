"""Every query with an SQL twin gives the same rows on both engines."""

import os

import pytest
from compare import on_duckdb, rows

import __spark_entry__ as entry
from strandmill.plans.catalog import ORACLES, QUERIES


#: Rows of the larger table are told apart by their keys; some of the smallest are not.
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_twin(spark, name, sf=SF):
    got = QUERIES[name](spark, sf).toPandas()
    want = on_duckdb(ORACLES[name], sf)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_structural_query_has_a_twin():
    # hierarchical clustering and melting points have no SQL form; tests compare them with plain Python
    assert set(QUERIES) - set(ORACLES) == {"impute_clusters", "primer_pairs", "primer_ranked"}
