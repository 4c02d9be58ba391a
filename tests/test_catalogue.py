"""The driver-style check on sf0.001: each query against its SQL text."""
import math
import os
import subprocess
import sys

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from tollcast.plans import catalogue as C
from tollcast.sources.tables import DRIVER_TABLES

from conftest import SF001

# Fits of many models: checked by tools/oracle_check.py rather than in every test run.
SLOW = {"tune_lr", "tune_lr_volume", "tune_gbt", "tune_gbt_volume", "tune_rf", "tune_rf_volume",
        "tune_lr_features", "tune_lr_volume_features"}


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False)),
                        key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = os.path.join(SF001, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_sql_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(C.QUERIES) == set(C.ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(set(C.ORACLE_SQL) - SLOW))
def test_query_matches_sql(spark, duck, name):
    sp = E.queries()[name](spark, SF001).toPandas()
    sq = duck.execute(E.oracle_sql()[name]).df()
    c1, r1 = _rows(sp)
    c2, r2 = _rows(sq)
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "time_window" in df.columns and "split" in df.columns


def test_optional_modules_may_be_absent():
    """Without the training-data folders the other queries are still registered."""
    code = ("import sys; sys.modules['tollcast.llm'] = None; sys.modules['corpus_pipeline'] = None\n"
            "import importlib.abc\n"
            "class Gone(importlib.abc.MetaPathFinder):\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name.startswith(('tollcast.llm', 'corpus_pipeline')):\n"
            "            raise ModuleNotFoundError(name, name=name)\n"
            "del sys.modules['tollcast.llm'], sys.modules['corpus_pipeline']\n"
            "sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as E; print(len(E.queries()), len(E.oracle_sql()))")
    root = os.path.dirname(os.path.abspath(E.__file__))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True)
    assert out.stdout.split() == [str(len(C.QUERIES)), str(len(C.ORACLE_SQL))]
