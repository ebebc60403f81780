"""Registered queries: names, shapes, and a few against an independent engine."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"


def test_every_statement_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.exists(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", ["rpt_worst_routes", "training_set", "last_prediction_label", "coverage_summary"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    df = entry.queries()[name](spark, FOLDER)
    relation = con.sql(entry.oracle_sql()[name])
    order = [relation.columns.index(c) for c in df.columns]
    expected = sorted((tuple(r[i] for i in order) for r in relation.fetchall()), key=repr)
    assert sorted(map(tuple, df.collect()), key=repr) == expected


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
