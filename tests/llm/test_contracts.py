"""Every query on NULLs, empty and long texts, ties and repeated rows, and on empty tables."""

import duckdb
import pytest

from tierlake.llm import queries
from tools.oracle_check import check


@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_sql_parity_on_edge_rows(spark, edge_sf, key):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{edge_sf}/documents.parquet')")
    res = check(spark, con, key, queries.QUERIES[key], queries.ORACLE[key], edge_sf)
    assert res["status"] == "ok", res


@pytest.mark.parametrize("key", sorted(queries.QUERIES))
def test_one_row_per_document_and_empty_table(spark, edge_sf, empty_sf, key):
    n = spark.read.parquet(f"{edge_sf}/documents.parquet").count()
    assert queries.QUERIES[key](spark, edge_sf).count() == n
    assert queries.QUERIES[key](spark, empty_sf).count() == 0


def test_native_plans_run_no_python(spark, edge_sf):
    for key in ("op4_secret_scan", "op8_quality_rules", "op9_mixing", "op10_exact_dedup"):
        plan = queries.QUERIES[key](spark, edge_sf)._jdf.queryExecution().executedPlan().toString()
        assert not any(w in plan for w in ("Python", "Pandas", "Arrow")), key
