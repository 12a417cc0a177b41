"""Queries that have SQL against DuckDB on the smallest tables; every dealt operator is registered."""

import re
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "scripts"))

from check_oracle import compare, duck  # noqa: E402

from __spark_entry__ import oracle_sql as all_sql, queries as all_queries  # noqa: E402
from nestgate.llm.queries import oracle_sql, queries  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, name):
    msg, ok = compare(spark, duck(SF), name, queries()[name], oracle_sql()[name], SF)
    assert ok, msg


def test_registered():
    assert set(queries()) <= set(all_queries()) and set(oracle_sql()) <= set(all_sql())
    numbers = sorted(int(m[1]) for n in queries() if (m := re.match(r"op(\d+)_", n)))
    assert len(numbers) == len(set(numbers))
