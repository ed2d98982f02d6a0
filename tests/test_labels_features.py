from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millwright.functions.contract import build_contract, completeness
from millwright.operators import features, labels, splits, staging
from millwright.settings import Settings

from .synthetic import fleet, frames

T0 = datetime(2015, 1, 1)
SMALL = Settings(prediction_horizon_hours=3, feature_cadence_hours=1, post_failure_exclusion_hours=2, gap_hours=3, train_end="2015-01-01", val_end="2015-01-02")
PROD = Settings(train_end="2015-01-31", val_end="2015-02-28")


def at(h):
    return T0 + timedelta(hours=h)


def telemetry(spark, hours, values=None, machine=1):
    rows = [(machine, at(h), float((values or {}).get(h, 10 * h)), 1.0, 1.0, 1.0) for h in hours]
    return spark.createDataFrame(rows, "machine_id int, ts timestamp_ntz, volt double, rotate double, pressure double, vibration double")


def events(spark, rows, name="component"):
    return spark.createDataFrame([(1, at(h), c) for h, c in rows], f"machine_id int, ts timestamp_ntz, {name} string")


def test_label_geometry(spark):
    failures = events(spark, [(6, "comp1"), (6, "comp2"), (6, "comp3")])
    grid = labels.label_grid(telemetry(spark, range(12)), failures, SMALL)
    kept = labels.training_rows(grid).orderBy("ts").collect()
    assert [r["label"] for r in kept] == [0, 0, 0, 1, 1, 1] and [r["ts"].hour for r in kept] == list(range(6))
    assert labels.drop_accounting(grid).first().asDict() == {"grid_rows": 12, "excluded": 3, "unlabelable": 3, "in_gap": 0, "kept": 6}


def test_component_labels(spark):
    failures = events(spark, [(6, "comp1"), (5, "comp2")])
    grid = labels.label_grid(telemetry(spark, range(12)), failures, SMALL)
    got = {r["component"]: (r["positives"], r["rows"]) for r in labels.balance_by_component(labels.labels_by_component(grid, failures, SMALL)).collect()}
    assert got == {"comp1": (2, 5), "comp2": (3, 5)}


def test_cadence(spark):
    s = Settings(prediction_horizon_hours=3, feature_cadence_hours=3, gap_hours=3)
    assert [r["ts"].hour for r in labels.feature_grid(telemetry(spark, range(12)), s).orderBy("ts").collect()] == [0, 3, 6, 9]


def test_rolling_is_by_time(spark):
    row = lambda hours: features.rolling_features(telemetry(spark, hours), 3).filter(F.col("ts") == at(5)).first()
    r = row(range(6))
    assert (r["volt_mean_3h"], r["volt_min_3h"], r["volt_max_3h"]) == (40, 30, 50)
    r = row([0, 1, 2, 5])
    assert r["volt_mean_3h"] == 50 and r["volt_std_3h"] is None


def test_spike_ages_and_never_leaks(spark):
    flat = features.rolling_features(telemetry(spark, range(40), dict.fromkeys(range(40), 170)), 3)
    spiked = features.rolling_features(telemetry(spark, range(40), dict.fromkeys(range(40), 170) | {30: 195}), 3)
    hot = {r["ts"].hour + 24 * (r["ts"].day - 1) for r in spiked.filter("volt_max_3h = 195").collect()}
    assert hot == {30, 31, 32}
    before = lambda df: [tuple(r) for r in df.filter(F.col("ts") < at(30)).orderBy("ts").collect()]
    assert before(flat) == before(spiked)


def test_error_counts(spark):
    errors = events(spark, [(5, "error1"), (6, "error1"), (6, "error2"), (6, "error9")], "error_id")
    r = features.error_count_features(telemetry(spark, range(8)), errors, (3,)).filter(F.col("ts") == at(6)).first()
    assert (r["error1_count_3h"], r["error2_count_3h"], r["error_count_3h"]) == (2, 1, 3)
    assert features.unknown_codes(errors).collect()[0]["error_id"] == "error9"


def test_clocks(spark):
    rows = features.maintenance_clocks(telemetry(spark, range(12)).select("machine_id", "ts"), events(spark, [(5, "comp1")])).orderBy("ts").collect()
    assert [rows[h]["hours_since_maint_comp1"] for h in (5, 8, 11)] == [0, 3, 6]
    assert rows[7]["hours_since_maint_comp2"] == 7 and rows[7]["hours_since_maint_any"] == 2


def test_asof_forward_is_strict(spark):
    left = telemetry(spark, range(4)).select("machine_id", "ts")
    got = [r["n"] for r in features.asof_forward_strict(left, events(spark, [(1, "x"), (3, "x")]), "machine_id", "n").orderBy("ts").collect()]
    assert got == [at(1), at(3), at(3), None]


def test_warmup(spark):
    both = telemetry(spark, range(40)).union(telemetry(spark, range(40), machine=2))
    out = features.drop_warmup(both, 24)
    assert out.count() == 32 and out.agg(F.min("ts")).first()[0] == at(24)


def test_one_plan_for_all_windows(spark):
    t = telemetry(spark, range(5))
    made = features.window_features(t, events(spark, [], "error_id"), (3, 12, 24))
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") <= 4


def test_staging_is_deterministic(spark):
    rows = [(1, at(0), v, 1.0, 1.0, 1.0) for v in (3.0, 1.0, 2.0)]
    df = spark.createDataFrame(rows, telemetry(spark, [0]).schema)
    assert staging.stage_telemetry(df).first()["volt"] == 1.0


@pytest.fixture(scope="module")
def staged(spark):
    return staging.stage(frames(spark, fleet()))


def test_training_and_scoring_agree(spark, staged):
    order = build_contract(PROD).order
    train = features.training_matrix(staged, PROD).persist()
    splits.verify_splits(train, PROD.gap_hours, PROD.prediction_horizon_hours)
    assert sum(completeness(train, order).first()) == 0
    assert 0.005 < train.agg(F.avg("label")).first()[0] < 0.1
    score = features.scoring_matrix(staged, PROD)
    both = train.join(score.select("machine_id", "ts", *[F.col(c).alias(f"s_{c}") for c in order]), ["machine_id", "ts"])
    off = both.filter(" or ".join(f"abs({c} - s_{c}) > 1e-12 * greatest(1, abs({c}))" for c in order))
    assert both.count() == train.count() and off.count() == 0
    latest = features.scoring_matrix(staged, PROD, latest_only=True)
    assert latest.count() == 4
    train.unpersist()


def test_summary(spark, staged):
    found = labels.summarise(labels.label_grid(staged["telemetry"], staged["failures"], PROD), staged["failures"], PROD)
    assert found.plausible and "positive rate" in found.text() and [r["split"] for r in found.by_split] == ["train", "val", "test"]


def test_splits(spark, staged):
    rows = labels.training_rows(labels.label_grid(staged["telemetry"], staged["failures"], PROD))
    assert {r["shared_machines"] for r in splits.machine_overlap(rows).collect()} == {4}
    held = splits.holdout_machines(rows, 0.3, seed=1)
    assert sorted(held.collect()) == sorted(splits.holdout_machines(rows, 0.3, seed=1).collect()) and held.count() == 1
    moved = splits.apply_holdout(rows, held)
    assert moved.filter("held_out and split != 'test'").count() == 0
    with pytest.raises(splits.SplitError):
        splits.verify_splits(rows, 10, 24)
    with pytest.raises(splits.SplitError):
        splits.verify_splits(rows.withColumn("split", F.lit("other")), 24, 24)


def test_forward_joins_are_linear(spark):
    import time

    n = 100_000
    grid = spark.range(n).selectExpr("1 AS machine_id", "timestamp_ntz '2015-01-01' + make_dt_interval(0, id) AS ts")
    hits = grid.filter("ts IN (timestamp_ntz '2015-01-02 00:00:00', timestamp_ntz '2020-01-02 00:00:00')")
    began = time.perf_counter()
    for got in (features.asof_forward_strict(grid, hits, "machine_id", "next_failure_ts"), labels.failure_context(grid, hits)):
        rows = got.groupBy("next_failure_ts").count().collect()
        assert sorted(r["count"] for r in rows) == sorted([24, (datetime(2020, 1, 2) - datetime(2015, 1, 2)).days * 24, n - (datetime(2020, 1, 2) - datetime(2015, 1, 1)).days * 24])
    assert time.perf_counter() - began < 60
