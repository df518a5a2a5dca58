"""Every registered query against its DuckDB oracle (row count, column
names, multiset of rows with floats rounded)."""

import pytest

import __spark_entry__ as E
from tessera.plans import registry
from oracle_compare import compare, duck

ORACLE = {k: v for k, v in E.oracle_sql().items() if k in registry.ORACLE}
QUERIES = {k: v for k, v in E.queries().items() if k in registry.QUERIES}


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, sf_dir, con, name):
    r = compare(spark, sf_dir, name, QUERIES[name], ORACLE[name], con)
    assert r["ok"] and "type_mismatch" not in r, r


LARGER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["summary_profile", "batch_profile", "extrema", "classify_gate", "verify_types", "ingest_typed_stamps",
                                  "merge_audit", "rank_pca", "rank_corr", "cluster_assign"])
def test_matches_oracle_on_more_rows(spark, name):
    """Ties and roundings that few rows don't show."""
    r = compare(spark, LARGER, name, QUERIES[name], ORACLE[name], duck(LARGER))
    assert r["ok"] and "type_mismatch" not in r, r


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert df.count() > 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["dataset_id", "source", "dataset_type", "n_rows", "col", "ord", "declared",
                          "suggested", "probability", "selected", "importance", "min", "max"]
    assert df.count() == 13


def test_oracle_keys_subset():
    assert set(ORACLE) <= set(QUERIES)
