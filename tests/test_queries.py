"""Every registered query against its SQL over the smallest tables."""

from __future__ import annotations

import glob
import os

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
#: queries of which the smallest tables hold no case
EMPTY = {"entities_endpoint", "lint_macros", "p2_exact_texts", "p6_template_classes", "p6_template_slots"}


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    def value(x):
        if x is None or x is pd.NaT or (isinstance(x, float) and np.isnan(x)):
            return "null"
        if isinstance(x, (float, np.floating)):
            return repr(round(float(x), 6))
        return str(list(x)) if isinstance(x, (list, np.ndarray)) else str(x)

    df = df[sorted(df.columns)].map(value) if len(df) else df[sorted(df.columns)]
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, db, name):
    got = entry.queries()[name](spark, FOLDER)
    if name not in entry.oracle_sql():
        assert len(set(got.columns)) == len(got.columns) and (got.count() > 0 or name in EMPTY)
        return
    a, b = canonical(got.toPandas()), canonical(db.sql(entry.oracle_sql()[name]).df())
    assert list(a.columns) == list(b.columns) and len(a) == len(b)
    assert a.equals(b) if len(a) else name in EMPTY


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_oracle_names_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
