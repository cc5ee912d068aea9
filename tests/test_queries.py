"""Every query with SQL gives DuckDB's rows on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pandas as pd
import pytest

from sessionloom.plans import file_queries, session_queries, table_queries

QUERIES, ORACLE = table_queries.QUERIES | session_queries.QUERIES | file_queries.QUERIES, table_queries.ORACLE | session_queries.ORACLE | file_queries.ORACLE

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


def value(v):
    if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return "None"
    v = v.item() if hasattr(v, "item") else v
    return repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else repr(v)


def rows(frame, columns):
    return sorted(tuple(map(value, r)) for r in frame[columns].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toPandas(), duck.execute(ORACLE[name]).df()
    columns = sorted(want.columns)
    assert columns == sorted(got.columns)
    assert rows(got, columns) == rows(want, columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_others_run(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_whole_tables_are_covered(spark):
    """Plain Python over all rows, and no part left out."""
    e = pd.read_parquet(f"{SF}/events.parquet")
    run = lambda name: QUERIES[name](spark, SF).toPandas()
    want = {"click", "purchase", "upload"}
    sets = {u: set(g) for u, g in e.groupby("user_id")["event_type"]}
    joined = lambda s: ",".join(sorted(s))
    assert {(r.user_id, r.missing, r.extra, r.shared) for r in run("set_algebra").itertuples()} == {(u, joined(want - s), joined(s - want), joined(s & want)) for u, s in sets.items()}
    assert set(run("replication_plan")["session_id"]) == {k for k in pd.read_parquet(f"{SF}/customer.parquet")["c_custkey"] if k % 13}
    assert len(run("disk_join_backlog")) == len(pd.read_parquet(f"{SF}/supplier.parquet"))
    days = e.groupby("user_id")["ts"].agg(lambda t: (t.max() - t.min()) // pd.Timedelta(days=1))
    assert run("interp_series").groupby("user_id")["k"].max().to_dict() == days.to_dict() and days.max() > 19
    gate = {(f"u{u}", s) for u, n in e.groupby("user_id").size().items() for s in range(1, (n + 1) // 3 + 1) if s * 3 + 2 <= n}
    got = run("stability_gate")
    assert set(zip(got["name"], got["size"], strict=True)) == gate


@pytest.mark.parametrize("name", ["stream_unprocessed", "replication_plan", "exact_medians", "line_timestamps", "best_lag", "multi_key_order"])
def test_shared_folder_is_swept(spark, name):
    """When a result is read, nothing of its query needs to stay."""
    from sessionloom import session

    session.sweep()
    before = set(Path(session.shared_dir(spark)).iterdir())
    QUERIES[name](spark, SF).collect()
    assert set(Path(session.shared_dir(spark)).iterdir()) > before
    session.sweep()
    assert set(Path(session.shared_dir(spark)).iterdir()) == before
