"""Every registered query against its DuckDB oracle on the smallest tables:
row count, column names and an order-insensitive hash of the values."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, digest  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "trans_num" in df.columns


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    oracle = E.oracle_sql().get(name)
    if oracle is None:
        at_least = {"file_inventory": 1, "any_rows": 10}
        assert len(rows) >= at_least.get(name, 1)
        if name == "file_inventory":
            assert all(r["size"] > 0 for r in (x.asDict() for x in df.collect()))
        return
    res = con.execute(oracle)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


@pytest.mark.parametrize("name", ["conformed_upsert", "txn_invalid_incremental", "ingest_csv"])
def test_stateful_queries_repeat_identically(spark, name):
    """Queries that build tables take fresh scratch folders each call."""
    first = E.queries()[name](spark, SF)
    a = digest(first.columns, [tuple(r) for r in first.collect()])[0]
    second = E.queries()[name](spark, SF)
    assert digest(second.columns, [tuple(r) for r in second.collect()])[0] == a


def test_quarantine_upserts_read_their_own_batch(spark, monkeypatch):
    """The landing of ``quarantined_rows`` is laid out by batch."""
    from riverbed.plans import incremental
    from riverbed.plans.queries import REGISTRY
    plain, seen = incremental.upsert_conformed, []

    def spied(table, batch, *rest):
        seen.extend(batch.inputFiles())
        return plain(table, batch, *rest)

    monkeypatch.setattr(incremental, "upsert_conformed", spied)
    assert REGISTRY["quarantined_rows"](spark, "/root/testdata/sf0.001").count()
    assert seen and all("/batch_id=" in f for f in seen)
