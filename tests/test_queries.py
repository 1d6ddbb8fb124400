"""Every registered query of the scoring operators against DuckDB on sf0.001."""

from pathlib import Path

import duckdb
import numpy as np
import pandas as pd
import pytest

from litfunnel.plans.oracle import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test data")


def rows(df: pd.DataFrame) -> list[tuple]:
    def cell(x):
        if isinstance(x, (list, np.ndarray)):
            return tuple(map(cell, x))
        if x is None or x is pd.NA or x is pd.NaT or x != x:
            return "null"
        return f"{float(x):.9g}" if isinstance(x, (int, float, np.number)) and not isinstance(x, (bool, np.bool_)) else str(x)

    return sorted(tuple(map(cell, r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, duck, name):
    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(duck.execute(ORACLE[name]).df())


def test_batches_cover_every_order(spark):
    b = QUERIES["random_batches"](spark, SF).toPandas()
    assert b.o_orderkey.is_unique and b.groupby("batch").size().max() <= 15


def test_plans_have_no_cross_join(spark):
    for name in ("grounding_match", "domain_suffix_match", "watchlist_match", "cascade_match"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
