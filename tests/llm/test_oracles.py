"""Queries that SQL can express, against DuckDB, and the shape of all others."""

import duckdb
import pytest

from kalends.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, sf, name):
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    df = queries.QUERIES[name](spark, sf)
    rel = duck.sql(queries.ORACLE[name])
    columns = sorted(df.columns)
    assert columns == sorted(rel.columns)
    at = [rel.columns.index(c) for c in columns]
    assert sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr) == sorted((tuple(r[k] for k in at) for r in rel.fetchall()), key=repr)


@pytest.mark.parametrize("name", ["op1_toxicity", "op2_packing", "op3_sharding", "op4_line_dedup", "op5_url_filter", "op6_mixing", "op9_pii"])
def test_rows(spark, sf, name):
    rows = queries.QUERIES[name](spark, sf).collect()
    table = "pages" if name == "op5_url_filter" else "documents"
    n = spark.read.parquet(f"{sf}/{table}.parquet").count()
    assert len(rows) >= n if name == "op2_packing" else len(rows) == n
    assert all(r[0] is not None for r in rows)
