"""Every query of the telemetry side by name, with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright.functions.contract import build_contract, incomplete_rows
from millwright.functions.timeutil import ntz
from millwright.operators import curate, features, labels, metrics, models, monitoring, scoring, splits, staging, validate
from millwright.sources import adapters, files
from millwright.sources.adapters import LINE_SETTINGS, SETTINGS

S = SETTINGS
#: Digits of the line series: enough that means of a few readings with two decimals meet no tie.
LINE_DIGITS = 7
#: Machines and hours that the alarm rates of the curve queries refer to.
CURVE_MACHINES, CURVE_HOURS = 150, 144.0


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name) for f in df.schema])


class Inputs:
    """The adapted tables of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._tables = adapters.tables(spark, sf_dir)
        self._args = (spark, sf_dir)

    def __getattr__(self, name: str) -> DataFrame:
        return self._tables[name]

    @property
    def tables(self) -> dict[str, DataFrame]:
        return self._tables

    @property
    def lines(self) -> DataFrame:
        return adapters.line_telemetry(*self._args)

    @property
    def grid(self) -> DataFrame:
        return labels.label_grid(self.telemetry, self.failures, S)

    @property
    def kept(self) -> DataFrame:
        return labels.training_rows(self.grid)

    @property
    def components(self) -> DataFrame:
        return labels.labels_by_component(self.grid, self.failures, S)

    @cached_property
    def _cutoff(self) -> float | None:
        """The rules model's cut-off, one number."""
        return metrics.rules_cutoff(self._spread.filter("split = 'train'"), "x").first()[0]

    @property
    def _spread(self) -> DataFrame:
        std = features.rolling_features(self.telemetry, 24).select("machine_id", "ts", F.col("vibration_std_24h").alias("x"))
        return self.kept.join(std, ["machine_id", "ts"]).filter("x is not null")

    @property
    def scored(self) -> DataFrame:
        """Training rows with the rules model's score to three digits."""
        score = metrics.rules_score(F.col("x"), F.lit(self._cutoff).cast("double"))
        return self._spread.select("machine_id", "ts", "label", "split", F.round(score, 3).alias("score"))

    @property
    def curve(self) -> DataFrame:
        return metrics.cost_curve(self.scored.filter("split = 'val'"), S.cost_false_alarm, S.cost_missed_failure, CURVE_MACHINES, CURVE_HOURS)

    @property
    def scores(self) -> DataFrame:
        rows = self.scored.select("machine_id", "ts", F.col("ts").alias("scored_at"), F.col("score").alias("probability"))
        return scoring.score_rows(rows, 0.45, S.prediction_horizon_hours, "rules-1", build_contract(S).hash)


def _bands(i: Inputs) -> DataFrame:
    return i.scores.select("machine_id", "ts", "scored_at", "horizon_hours", "probability", "threshold", "decision")


def _curve(df: DataFrame) -> DataFrame:
    exact = ("threshold", "expected_cost")
    return df.select(*[F.round(f.name, 9).alias(f.name) if isinstance(f.dataType, T.DoubleType) and f.name not in exact else F.col(f.name) for f in df.schema])


def _asof_backward(i: Inputs) -> DataFrame:
    per_hour = i.maint.groupBy("machine_id", "ts").agg(F.count("*").alias("maint_in_hour"))
    return features.asof_backward(i.telemetry.select("machine_id", "ts"), per_hour, "machine_id", ["maint_in_hour"]).fillna(0, ["maint_in_hour"])


def _completeness(i: Inputs) -> DataFrame:
    order = build_contract(S).order
    return features.compute_features(i.tables, S).agg(F.count("*").alias("rows"), F.count(F.when(incomplete_rows(order), 1)).alias("incomplete"))


def _drift(i: Inputs) -> DataFrame:
    rows = i.kept.join(i.telemetry, ["machine_id", "ts"])
    sensors = ["volt", "rotate", "pressure", "vibration"]
    return _kept(monitoring.drift_report(_kept(monitoring.build_reference(rows.filter("split = 'train'"), sensors)), rows.filter("split = 'test'"), sensors))


def _kept(per_feature: DataFrame) -> DataFrame:
    """A table of one row per feature, computed once."""
    return per_feature.sparkSession.createDataFrame(per_feature.collect(), per_feature.schema)


AS_OF = datetime(2024, 1, 26)
PAYLOAD_AT = datetime(2024, 1, 25)


def _sent(batch: DataFrame) -> DataFrame:
    """A scoring batch as a model server gets it: encoded to payload lines and decoded by its schema."""
    return files.decode_payload(files.encode_payload(batch, [c for c in batch.columns if c not in ("machine_id", "ts")]), batch.schema)


def _score_run(i: Inputs) -> DataFrame:
    """The newest tick of each machine through payloads, scored by the rules model of the training rows."""
    contract = build_contract(S)
    train = i.kept.filter("split = 'train'").join(features.rolling_features(i.telemetry, 24), ["machine_id", "ts"])
    fitted = models.fit_rules(train, contract, S)
    predicted = rounded(fitted.predict(_sent(features.scoring_matrix(i.tables, S, PAYLOAD_AT, latest_only=True))).select("machine_id", "ts", "probability")).filter("probability is not null")
    rows = scoring.score_rows(predicted.withColumn("scored_at", ntz(PAYLOAD_AT)), 0.45, S.prediction_horizon_hours, "rules-1", contract.hash)
    return rows.select("machine_id", "ts", "scored_at", "probability", "decision")


def _held(i: Inputs) -> DataFrame:
    """All training rows, those of held-out machines moved to test."""
    return splits.apply_holdout(i.kept, splits.holdout_machines(i.kept, 0.2, seed=3))


def _drift_all(i: Inputs) -> DataFrame:
    """Drift of all features of the contract from the train to the test period."""
    rows, order = rounded(features.training_matrix(i.tables, S)).persist(), list(build_contract(S).order)
    try:
        reference = _kept(monitoring.build_reference(rows.filter("split = 'train'"), order))
        return _kept(rounded(monitoring.drift_report(reference, rows.filter("split = 'test'"), order).select("feature", "psi")))
    finally:
        rows.unpersist()


def _outcomes(i: Inputs) -> DataFrame:
    ripe = i.scores.filter(monitoring.is_ripe(F.col("scored_at"), ntz(AS_OF), S.prediction_horizon_hours))
    return monitoring.attach_outcomes(ripe, i.failures, S.prediction_horizon_hours).select("machine_id", "scored_at", "next_failure_ts", "label")


QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    "label_balance_by_split": lambda i: rounded(labels.balance(i.kept, "split"), 9),
    "label_drop_accounting": lambda i: labels.drop_accounting(i.grid),
    "label_grid": lambda i: i.grid,
    "label_balance_by_component": lambda i: rounded(labels.balance_by_component(i.components), 9),
    "label_balance_component_pivot": lambda i: rounded(labels.component_pivot(i.components), 9),
    "staged_dedup_telemetry": lambda i: staging.stage_telemetry(i.lines),
    "staged_events_distinct": lambda i: staging.stage_events(i.errors, "errors"),
    "feature_grid": lambda i: labels.feature_grid(i.telemetry, S),
    "lag_features": lambda i: rounded(features.lag_features(i.telemetry)),
    "trend_features": lambda i: rounded(features.trend_features(i.telemetry, S.window_sizes_hours)),
    "error_pivot": lambda i: features.error_pivot(i.errors),
    "error_counts_rolling": lambda i: features.error_count_features(i.telemetry, i.errors, S.window_sizes_hours),
    "machine_onehot": lambda i: features.machine_features(labels.feature_grid(i.telemetry, S), i.machines),
    "maint_clocks_asof": lambda i: rounded(features.maintenance_clocks(i.telemetry.select("machine_id", "ts"), i.maint)),
    "asof_backward_last_maint": _asof_backward,
    "next_failure_asof_forward": lambda i: features.asof_forward_strict(i.telemetry.select("machine_id", "ts"), i.failures, "machine_id", "next_failure_ts"),
    "feature_matrix_wide": lambda i: rounded(features.compute_features(i.tables, S)),
    "feature_completeness": _completeness,
    "training_matrix": lambda i: rounded(features.training_matrix(i.tables, S)),
    "scoring_matrix_latest": lambda i: rounded(features.scoring_matrix(i.tables, S, datetime(2024, 1, 25), latest_only=True)),
    "warmup_drop": lambda i: features.drop_warmup(i.telemetry.select("machine_id", "ts"), S.max_window_hours),
    "validate_duplicates": lambda i: validate.duplicates(i.lines, ("machine_id", "ts")),
    "validate_nulls": lambda i: validate.null_counts(features.compute_features(i.tables, S).drop("machine_id", "ts")),
    "validate_ranges": lambda i: rounded(validate.out_of_range(i.telemetry)),
    "validate_gaps": lambda i: validate.gaps(i.telemetry),
    "validate_unknown_machines": lambda i: validate.unknown_machines(i.failures, i.machines),
    "validate_never_failing": lambda i: validate.never_failing(i.machines, i.failures),
    "validate_issues": lambda i: validate.validate_all(i.tables),
    "curate_telemetry": lambda i: curate.curate_telemetry(i.lines),
    "curate_events": lambda i: curate.curate_events(i.maint, "maint"),
    "curate_machines": lambda i: curate.curate_machines(i.machines),
    "split_bounds": lambda i: rounded(splits.describe_splits(i.kept), 9),
    "machine_overlap": lambda i: splits.machine_overlap(i.kept),
    "holdout_machines": lambda i: splits.holdout_machines(i.kept, 0.2, seed=3),
    "class_weight": lambda i: rounded(metrics.class_weight(i.kept.filter("split = 'train'")), 9),
    "rules_scores": lambda i: i.scored,
    "cost_curve": lambda i: _curve(i.curve),
    "cheapest_threshold": lambda i: metrics.cheapest_threshold(_curve(i.curve)),
    "recall_at_far": lambda i: metrics.recall_at_false_alarm_rate(_curve(i.curve), 0.05),
    "recall_at_budget": lambda i: metrics.recall_at_alarm_budget(_curve(i.curve), 1.0),
    "operating_point_nearest": lambda i: metrics.operating_point_at(_curve(i.curve), 0.3),
    "ranking_metrics": lambda i: rounded(metrics.ranking_metrics(i.scored.filter("split = 'val'")), 9),
    "risk_bands": _bands,
    "score_summary": lambda i: scoring.summary(i.scores),
    "work_orders": lambda i: scoring.work_orders(i.scores).drop("drivers", "model_version", "feature_hash"),
    "drift_psi": lambda i: rounded(_drift(i)),
    "outcomes": _outcomes,
    "performance_confusion": lambda i: rounded(monitoring.evaluate_period(i.scores, i.failures, ntz(AS_OF), S.prediction_horizon_hours), 9),
    "payload_round_trip": lambda i: rounded(_sent(features.scoring_matrix(i.tables, S, PAYLOAD_AT, latest_only=True))),
    "score_run": _score_run,
    "unknown_codes": lambda i: features.unknown_codes(i.errors, ("error1",)),
    "apply_holdout": _held,
    "drift_psi_all": _drift_all,
    "implied_threshold": lambda i: monitoring.implied_threshold(i.scores),
    **{f"rolling_stats_{w}h": lambda i, w=w: rounded(features.rolling_features(i.telemetry, w)) for w in S.window_sizes_hours},
    **{f"line_rolling_stats_{w}h": lambda i, w=w: rounded(features.rolling_features(staging.stage_telemetry(i.lines), w), LINE_DIGITS) for w in LINE_SETTINGS.window_sizes_hours},
}


#: Rounds of the registered boosted query; ``fit_boosted`` itself takes 300.
BOOSTED_ROUNDS = 20


def _model(fit: str) -> Callable[[SparkSession, str], DataFrame]:
    """Scores of the val rows by a model fitted on the train rows: readings for the logistic model, all features for trees."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        i = Inputs(spark, sf_dir)
        contract = build_contract(S)
        rows = i.kept.join(i.telemetry, ["machine_id", "ts"]) if fit == "logistic" else features.training_matrix(i.tables, S)
        train = rows.filter("split = 'train'")
        fitted = models.fit_logistic(train, contract, S) if fit == "logistic" else models.fit_boosted(train, contract, S, BOOSTED_ROUNDS)
        return fitted.predict(rows.filter("split = 'val'")).select("machine_id", "ts", "label", "probability")

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    plain = {n: (lambda spark, sf_dir, q=q: q(Inputs(spark, sf_dir))) for n, q in QUERIES.items()}
    return plain | {"logistic_fit": _model("logistic"), "gbt_fit": _model("boosted")}


def oracle_sql() -> dict[str, str]:
    from .sql import oracles

    return oracles()
