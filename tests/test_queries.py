"""Every registered query against DuckDB; queries without SQL must run and return rows."""

import oracle
import pytest

import __spark_entry__ as contract
from gaugeflow.queries import REGISTRY


@pytest.fixture(scope="module")
def db(sf):
    return oracle.connect(sf)


@pytest.mark.parametrize("name", [n for n, q in REGISTRY.items() if q.sql])
def test_matches_sql(spark, sf, db, name):
    assert oracle.compare(REGISTRY[name].run(spark, sf), db, REGISTRY[name].sql) is None


@pytest.mark.parametrize("name", [n for n, q in REGISTRY.items() if not q.sql])
def test_runs(spark, sf, name):
    df = REGISTRY[name].run(spark, sf)
    assert df.count() > 0 and len(set(df.columns)) == len(df.columns)


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    flagship = contract.entry(spark)
    assert flagship.columns == ["hour", "is_rush", "n", "imputed", "mean_value", "max_value"]
    assert flagship.count() == 24
