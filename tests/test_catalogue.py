"""Queries against their SQL twins on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from millwright.plans import catalogue

DIR = "/root/testdata/sf0.001"
ORACLES = catalogue.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{DIR}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def plain(rows):
    norm = lambda v: None if v is None or isinstance(v, float) and math.isnan(v) else round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return sorted((tuple(map(norm, r)) for r in rows), key=repr)


@pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")
@pytest.mark.parametrize("name", [n for n in ("label_balance_by_split", "label_grid", "label_balance_by_component", "staged_dedup_telemetry", "rolling_stats_24h", "maint_clocks_asof", "next_failure_asof_forward", "training_matrix", "cost_curve", "ranking_metrics", "drift_psi", "performance_confusion", "holdout_machines", "work_orders")])
def test_matches_sql(spark, duck, name):
    df = catalogue.queries()[name](spark, DIR)
    rel = duck.sql(ORACLES[name])
    order = sorted(df.columns)
    assert order == sorted(rel.columns)
    assert plain(df.select(*[f"`{c}`" for c in order]).collect()) == plain(rel.select(*[f'"{c}"' for c in order]).fetchall())


def test_every_query_but_models_has_sql():
    assert set(catalogue.queries()) - set(ORACLES) == {"logistic_fit", "gbt_fit", "validate_issues"}


def test_entry_imports_without_the_corpus_side():
    import __spark_entry__ as e

    assert set(catalogue.queries()) <= set(e.queries())
