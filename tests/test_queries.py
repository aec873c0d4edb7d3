"""Every registered query against its DuckDB oracle (sf0.001), as the driver does."""

import pytest

import __spark_entry__ as E
from ledgerlake.catalog import REGISTRY
from oracle_util import compare, duck

from conftest import SF_SMALL

QUERIES = E.queries()
ORACLE = E.oracle_sql()
STREAMS = [n for n in REGISTRY if n.startswith(("stream_", "late_"))]
BATCH = [n for n in REGISTRY if n not in STREAMS]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["service", "total_cost_usd"]
    df.collect()


def test_every_query_has_oracle_or_is_listed():
    assert set(REGISTRY) <= set(ORACLE)


@pytest.mark.parametrize("name", BATCH)
def test_batch_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), con, ORACLE[name])
    assert ok, msg


@pytest.mark.parametrize("name", STREAMS)
def test_stream_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), con, ORACLE[name])
    assert ok, msg
