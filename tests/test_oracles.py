"""Every registered query against its SQL on the smallest sample."""

import pytest

import __spark_entry__ as registry
import compare


@pytest.fixture(scope="module")
def connection(sample):
    return compare.duck(sample)


def test_every_query_has_an_oracle():
    # Corpus queries that SQL cannot express are tested with the operators.
    assert set(registry.queries()) - set(registry.corpus_queries()[0]) == set(registry.oracle_sql()) - set(registry.corpus_queries()[1])


@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_query(spark, connection, sample, shared_lake, name):
    difference, _ = compare.differences(spark, connection, sample, name)
    assert difference == ""


def test_entry(spark):
    scores = registry.entry(spark)
    assert scores.count() == 1500
    assert scores.filter("risk_tier = 'HIGH'").count() == 17
