"""Queries on the rules model's scores against their SQL, where the train rows hold tens of thousands of distinct values."""

import os

import duckdb
import pytest

from millwright.plans import catalogue

from .test_catalogue import plain

SOURCE = "/root/testdata/sf0.1/events.parquet"
COPIES = f"""SELECT event_id + i * 100000 AS event_id, ts, user_id + i * 1500 AS user_id, event_type, value * (1 + 0.0001 * i) AS value, props
    FROM '{SOURCE}', range(6) r(i)"""
QUERIES = ["cost_curve", "operating_point_nearest", "recall_at_far", "performance_confusion", "risk_bands", "score_summary", "work_orders"]


@pytest.fixture(scope="module")
def copies(tmp_path_factory):
    """Six copies of the events, of users and with values of their own."""
    folder = tmp_path_factory.mktemp("copies")
    duckdb.connect().execute(f"COPY ({COPIES}) TO '{folder}/events.parquet' (FORMAT parquet)")
    return folder


@pytest.fixture
def many_partitions(spark):
    """Partitions that adaptive plans join by size, so that branches of one plan deal their rows unlike."""
    own = {"spark.sql.shuffle.partitions": "48", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true"}
    before = {k: spark.conf.get(k) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.skipif(not os.path.exists(SOURCE), reason="no test tables")
@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql_on_many_values(spark, copies, many_partitions, name):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW events AS SELECT * FROM '{copies}/events.parquet'")
    df = catalogue.queries()[name](spark, str(copies))
    listed = ", ".join(f'"{c}"' for c in df.columns)
    want = duck.execute(f"SELECT {listed} FROM ({catalogue.oracle_sql()[name]})").fetchall()
    assert plain(df.collect()) == plain(want)
