import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millwright.functions.timeutil import ntz
from millwright.operators import metrics, monitoring, scoring

T0 = datetime(2024, 1, 1)


def scored(spark, y, s):
    return spark.createDataFrame(list(zip(y, map(float, s), strict=True)), "label int, score double")


def test_cost_curve(spark):
    curve = metrics.cost_curve(scored(spark, [1, 1, 0, 0], [0.9, 0.6, 0.4, 0.1]), 250, 10_000)
    rows = [r.asDict() for r in curve.orderBy("threshold").collect()]
    assert len(rows) == 5 and rows[0]["expected_cost"] == 500 and rows[-1]["expected_cost"] == 20_000 and rows[-1]["flagged"] == 0
    assert metrics.cheapest_threshold(curve).first()["threshold"] == 0.6
    assert metrics.operating_point_at(curve, 0.55).first()["threshold"] == 0.6


def test_ties_go_to_the_higher_threshold(spark):
    curve = metrics.cost_curve(scored(spark, [0, 0, 0], [0.1, 0.2, 0.3]), 0, 1)
    assert metrics.cheapest_threshold(curve).first()["flagged"] == 0


def test_far_ceiling(spark):
    y = [1, 0, 1] + [0] * 7
    curve = metrics.cost_curve(scored(spark, y, [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1, 0.05]), 250, 10_000)
    assert metrics.recall_at_false_alarm_rate(curve, 0.125).first()["recall"] == 1.0
    assert metrics.recall_at_false_alarm_rate(curve, 0.0).first()["recall"] == 0.5
    with pytest.raises(metrics.NoOperatingPoint):
        metrics.recall_at_alarm_budget(curve, 1.0)
    with pytest.raises(metrics.NoOperatingPoint):
        metrics.require_point(metrics.recall_at_false_alarm_rate(curve, -1.0))


def test_alarm_rate(spark):
    curve = metrics.cost_curve(scored(spark, [0] * 90, [0.5] * 90), 1, 1, machines=5, span_hours=1460)
    assert curve.orderBy("threshold").first()["alarms_per_machine_month"] == pytest.approx(9.0)


def test_quantile_grid(spark):
    rows = spark.range(5000).select((F.col("id") % 7 == 0).cast("int").alias("label"), (F.col("id") / 5000).alias("score"))
    curve = metrics.cost_curve(rows, 1, 1, max_points=100).collect()
    assert len(curve) == 101
    for r in curve[::9]:
        assert r["flagged"] == sum(i / 5000 >= r["threshold"] for i in range(5000))


def test_ranking(spark):
    r = metrics.ranking_metrics(scored(spark, [1, 0, 1, 0], [0.9, 0.8, 0.7, 0.1])).first()
    assert r["pr_auc"] == pytest.approx(5 / 6) and r["roc_auc"] == pytest.approx(0.75) and r["base_rate"] == 0.5
    tie = metrics.ranking_metrics(scored(spark, [1, 0, 1, 0], [0.5] * 4)).first()
    assert tie["roc_auc"] == 0.5 and tie["pr_auc"] == 0.5
    assert math.isnan(metrics.ranking_metrics(scored(spark, [0, 0], [0.1, 0.2])).first()["pr_auc"])
    assert math.isnan(metrics.ranking_metrics(scored(spark, [], [])).first()["pr_auc"])


def test_class_weight(spark):
    weight = lambda y: metrics.class_weight(scored(spark, y, [0.0] * len(y))).first()[0]
    assert weight([1] * 2 + [0] * 98) == 49.0 and weight([0, 0]) == 1.0


def test_bands_and_orders(spark):
    rows = spark.createDataFrame([(1, T0, T0, 0.9), (2, T0, T0, 0.2), (3, T0, T0, 0.05), (4, T0, T0, 0.7), (5, T0, T0, 0.4), (6, T0, T0, 0.31)], "machine_id int, ts timestamp_ntz, scored_at timestamp_ntz, probability double")
    named = scoring.top_drivers({"a": F.lit(0.1), "b": F.lit(-3.0), "c": F.lit(2.0), "d": F.lit(0.0)})
    scores = scoring.score_rows(rows, 0.30, 24, "v1", "h", named)
    assert [r["decision"] for r in scores.orderBy("machine_id").collect()] == ["act", "watch", "ok", "act", "act", "act"]
    orders = scoring.work_orders(scores).orderBy("machine_id").collect()
    assert [r["priority"] for r in orders] == ["P1", "P1", "P2", "P3"]
    assert orders[0]["due_by"] == T0 + timedelta(hours=24) and orders[0]["drivers"] == ["b", "c", "a"]
    assert orders[0]["reason"] == "Risk 90.0% of failing in the next 24 hours, limit 30.0%; mainly b, c, a"
    assert scoring.summary(scores).first().asDict() == {"scored": 6, "act": 4, "watch": 1, "ok": 1, "max_probability": 0.9}


def test_drift(spark):
    base = spark.range(500).select((F.col("id") % 97).cast("double").alias("x"), F.lit(1.0).alias("flat"))
    reference = monitoring.build_reference(base, ["x", "flat"])
    same = {r["feature"]: r for r in monitoring.drift_report(reference, base, ["x", "flat"]).collect()}
    assert same["x"]["psi"] == pytest.approx(0, abs=1e-12) and same["flat"]["severity"] == "ok"
    moved = monitoring.drift_report(reference, base.withColumn("x", F.col("x") + 90), ["x", "flat"])
    worst = monitoring.worst(moved).first()
    assert worst["feature"] == "x" and worst["severity"] == "drift" and math.isfinite(worst["psi"])
    holes = base.withColumn("x", F.when(F.col("x") > 5, F.lit(float("nan"))).otherwise(F.col("x")))
    assert math.isfinite(monitoring.drift_report(reference, holes, ["x"]).first()["psi"])


def test_performance(spark):
    rows = [(1, T0 + timedelta(hours=3 * k), 0.9 if k < 2 else 0.1, "act" if k < 2 else "ok") for k in range(8)]
    scores = spark.createDataFrame(rows, "machine_id int, scored_at timestamp_ntz, probability double, decision string")
    failures = spark.createDataFrame([(1, T0 + timedelta(hours=12))], "machine_id int, ts timestamp_ntz")
    ripe = scores.filter(monitoring.is_ripe(F.col("scored_at"), ntz(T0 + timedelta(hours=30)), 24))
    assert ripe.count() == 3
    got = [r["label"] for r in monitoring.attach_outcomes(scores.limit(4).filter("true"), failures, 9).orderBy("scored_at").collect()]
    assert got == [0, 1, 1, 1]
    r = monitoring.evaluate_period(scores, failures, ntz(T0 + timedelta(hours=30)), 24).first()
    assert (r["scored_rows"], r["pending_rows"], r["positives"], r["true_positives"], r["false_negatives"]) == (3, 5, 3, 2, 1)
    assert monitoring.implied_threshold(scores).first()[0] == 0.9
    assert monitoring.implied_threshold(scores.filter("decision = 'ok'")).first()[0] == math.inf
    assert monitoring.implied_threshold(scores.drop("decision")).first()[0] == 0.5
    none = monitoring.evaluate_period(scores, failures, ntz(T0), 24).first()
    assert none["scored_rows"] == 0 and none["pending_rows"] == 8


def test_percentiles_are_exact(spark):
    import numpy as np

    r = np.random.default_rng(2)
    values = {"a": r.normal(size=3000).tolist(), "b": r.integers(0, 5, 500).astype(float).tolist(), "c": [7.0], "d": [1.0, 2.0]}
    rows = spark.createDataFrame([(k, v) for k, own in values.items() for v in [*own, None]], "key string, value double")
    wanted = [0.0, 0.1, 0.5, 0.99, 1.0]
    got = {(g["key"], g["p"]): g["value"] for g in metrics.exact_percentiles(rows, wanted, buckets=16).collect()}
    assert got.keys() == {(k, p) for k in values for p in wanted}
    assert all(np.isclose(got[k, p], np.quantile(values[k], p), atol=1e-12) for k, p in got)
    assert metrics.exact_percentiles(rows.limit(0), wanted).count() == 0


def test_curve_of_many_scores(spark):
    rows = spark.range(5000).selectExpr("id / 5000D AS score", "cast(id % 50 = 0 AS int) AS label")
    curve = metrics.cost_curve(rows, 1.0, 10.0, max_points=100).orderBy("threshold").collect()
    assert len(curve) == 101 and curve[0]["flagged"] == 5000 and curve[-1]["flagged"] == 0
    for point in curve[::10]:
        assert point["flagged"] == sum(i / 5000 >= point["threshold"] for i in range(5000))


def test_percentiles_are_exact_beyond_the_sketch(spark):
    import numpy as np

    rows = spark.range(60_000, numPartitions=8).selectExpr("0 AS key", "sin(id) * id AS value")
    values = [r["value"] for r in rows.collect()]
    for g in metrics.exact_percentiles(rows, [0.0, 0.1, 0.5, 0.99, 1.0]).collect():
        assert np.isclose(g["value"], np.quantile(values, g["p"]), rtol=1e-12)


def test_edges_lie_between_values():
    edges = metrics._off_values([-2.0, -1e-9, 0.0, 3.0, math.inf])
    assert edges == sorted(edges) and all(e > v for e, v in zip(edges[:-1], [-2.0, -1e-9, 0.0, 3.0], strict=True)) and edges[-1] == math.inf
