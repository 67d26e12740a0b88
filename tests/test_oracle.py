"""Queries against their SQL twins on the smallest tables."""

import math
import os
from decimal import Decimal

import pytest

from dimwright.plans.oracle import all_oracles
from dimwright.plans.queries import all_queries

duckdb = pytest.importorskip("duckdb")

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
# whole pipelines run in test_star; the driver compares these two
LONG = {
    "pipeline_equivalence",
    "feed_merge_stream",
    "feed_parked_sales",
    "feed_aggregate_held",
    "participant_fact_late",
    "pipeline_paths",
    "star_constraints",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if isinstance(v, Decimal):
        return str(v.normalize())
    return None if v is None else str(v)


def test_every_query_has_a_twin():
    assert set(all_queries()) == set(all_oracles())


@pytest.mark.parametrize("name", sorted(set(all_queries()) - LONG))
def test_query_equals_sql(spark, duck, name):
    got = all_queries()[name](spark, SF)
    want = duck.sql(all_oracles()[name])
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns

    def table(rows, names):
        at = [names.index(c) for c in columns]
        return sorted((tuple(plain(r[i]) for i in at) for r in rows), key=str)

    assert table(got.collect(), got.columns) == table(want.fetchall(), want.columns)
