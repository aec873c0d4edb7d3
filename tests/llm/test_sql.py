"""Queries that SQL can express against their SQL; what the others return."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerlake.llm.oracle import ORACLE  # noqa: E402
from ledgerlake.llm.queries import QUERIES  # noqa: E402
from oracle_util import compare, duck  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ORACLE)
def test_matches_sql(spark, name):
    ok, msg = compare(QUERIES[name](spark, SMALL), duck(SMALL), ORACLE[name])
    assert ok, msg


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
