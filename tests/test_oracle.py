"""Every registered query against its DuckDB SQL, on sf0.001."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E  # noqa: E402
from oracle_compare import compare  # noqa: E402


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0


def test_all_queries_match_oracle(spark):
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    bad = compare(spark, "/root/testdata/sf0.001", sorted(q), q, s)
    assert bad == []
