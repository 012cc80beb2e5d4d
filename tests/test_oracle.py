"""Every registered key against its DuckDB oracle on the smallest test data."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck

# the training-data queries have their own tests in tests/llm
from reelmart.plans.registry import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_key_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_key_matches_oracle(spark, con, key):
    compare(spark, con, key, QUERIES[key], ORACLE[key], SF_SMALL)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:4] == ["platform_id", "metric_name", "feature_dim", "feature_value"]
    assert df.count() > 0


def test_types_match_oracle(spark, con):
    """Column types agree with DuckDB's (the driver compares schemas)."""
    from scripts.compare_types import spark_type
    bad = {}
    for key, sql in ORACLE.items():
        st = {f.name: spark_type(f.dataType) for f in QUERIES[key](spark, SF_SMALL).schema.fields}
        dt = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
        if st != dt:
            bad[key] = {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt) if st.get(c) != dt.get(c)}
    assert not bad, bad
