"""The driver contract: every registered query against its DuckDB oracle (sf0.001)."""

import importlib

import duckdb
import pytest

from conftest import SF
from oracle_compare import compare

E = importlib.import_module("__spark_entry__")
ROWS_ONLY: set[str] = set()


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    q, o = E.core_queries(), E.core_oracles()
    assert set(o) <= set(q)
    assert set(q) - set(o) == ROWS_ONLY


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 14 and {r["status"] for r in rows} == {"MATCH"}
    assert df.columns == ["table_name", "original_row_count", "exported_row_count", "extraction_timestamp", "status"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in E.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(set(E.core_queries()) - ROWS_ONLY))
def test_query_matches_oracle(spark, duck, key):
    got = E.core_queries()[key](spark, SF).toPandas()
    want = duck.execute(E.core_oracles()[key]).df()
    ok, why = compare(got, want)
    assert ok, why




def test_queries_without_a_module_the_training_package_needs():
    """Core queries stay when a third-party module is missing."""
    import os
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ("import sys; sys.modules['xxhash'] = None\n"
            "import __spark_entry__ as e\n"
            "assert set(e.queries()) == set(e.core_queries()) and set(e.oracle_sql()) == set(e.core_oracles()), e.queries().keys()")
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
