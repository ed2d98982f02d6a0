"""The jobs of the pipeline: ingest, label, build features, train, score, monitor."""

from __future__ import annotations

import argparse
import warnings
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.functions.contract import assert_complete, build_contract
from millwright.functions.timeutil import ntz
from millwright.operators import curate, features, labels, models, monitoring, scoring, splits, staging, validate
from millwright.operators.features import scoring_matrix, training_matrix
from millwright.settings import Settings
from millwright.sources import files
from millwright.sources.schemas import TABLES


def ingest(spark: SparkSession, landing: str, raw: str, strict: bool = True) -> DataFrame:
    """Landing CSV to raw Parquet; with ``strict`` nothing is written if a check fails. Returns the issues."""
    tables = {name: files.read_landing(spark, landing, name) for name in TABLES}
    issues = validate.validate_all(tables)
    if strict:
        validate.raise_for_errors(issues)
    for name, df in tables.items():
        files.write_table(df, raw, name)
    return issues


def staged(spark: SparkSession, raw: str) -> dict[str, DataFrame]:
    return staging.stage(files.read_all(spark, raw))


def build_labels(spark: SparkSession, raw: str, out: str, s: Settings, strict: bool = False) -> labels.LabelSummary:
    """Writes the labelled grid by split; with ``strict`` an implausible positive rate raises."""
    t = staged(spark, raw)
    grid = labels.label_grid(t["telemetry"], t["failures"], s)
    found = labels.summarise(grid, t["failures"], s)
    if strict and not found.plausible:
        raise ValueError(found.text())
    files.write_by_split(grid, f"{out}/labels")
    return found


def build_features(spark: SparkSession, raw: str, out: str, s: Settings) -> dict:
    """Writes the checked training matrix and returns its manifest."""
    contract = build_contract(s)
    matrix = training_matrix(staged(spark, raw), s)
    files.write_by_split(matrix, f"{out}/staging")
    stored = spark.read.parquet(f"{out}/staging").select(*matrix.columns)
    assert_complete(stored, contract.order)
    splits.verify_splits(stored, s.gap_hours, s.prediction_horizon_hours)
    return files.write_matrix(stored, out, contract)


def train(spark: SparkSession, features: str, s: Settings, names: tuple[str, ...] = ("rules", "logistic", "boosted"), registry: str | None = None) -> DataFrame:
    """Trains models on a stored matrix, registers them, and returns their records."""
    matrix, manifest = files.read_matrix(spark, features)
    contract = build_contract(s)
    contract.guard(matrix, manifest["feature_hash"], contract.hash)
    splits.verify_splits(matrix, s.gap_hours, s.prediction_horizon_hours)
    results = []
    for name in names:
        fitted, records = models.train_one(name, matrix, contract, s)
        results += records
        if registry:
            models.save_bundle(fitted, f"{registry}/{name}", contract, name)
            models.Registry(registry).register(f"{registry}/{name}", records[0].pr_auc, promote=False)
    if registry and any(r.pr_auc == r.pr_auc for r in results if r.split == "val"):
        models.Registry(registry).promote(models.Registry(registry).best()["version"])
    return models.results_table(spark, results)


def champion(bundle: str) -> str:
    """A bundle's folder; for a registry that of its champion."""
    return models.Registry(bundle).champion()["bundle"] if files.exists(f"{bundle}/registry.json") else bundle


def score(spark: SparkSession, raw: str, bundle: str, out: str, s: Settings, as_of: datetime | None = None, latest_only: bool = True, client_factory=None, topic: str = "") -> tuple[DataFrame, DataFrame]:
    """Scores the newest tick of each machine through payloads; returns stored score rows and their work orders.

    ``bundle`` may be a registry, whose champion then scores. Work orders are
    published where a client factory and a topic are given. An empty batch warns
    and stores its run record alone.
    """
    bundle = champion(bundle)
    fitted, meta = models.load_bundle(bundle)
    contract = build_contract(s)
    tables = staged(spark, raw)
    for text in features.warnings(tables):
        warnings.warn(text, stacklevel=2)
    features.require_machines(tables["telemetry"], tables["machines"])
    batch = scoring_matrix(tables, s, as_of, latest_only)
    contract.guard(batch, contract.hash, meta["feature_hash"])
    batch = files.decode_payload(files.encode_payload(batch, contract.order), batch.select("machine_id", "ts", *contract.order).schema)
    stamp = batch.agg(F.max("ts").alias("scored_at")) if as_of is None else spark.range(1).select(ntz(as_of).alias("scored_at"))
    predicted = models.with_drivers(fitted, fitted.predict(batch)).crossJoin(F.broadcast(stamp))  # one row
    rows = scoring.score_rows(predicted, meta["threshold"], s.prediction_horizon_hours, str(meta["version"]), meta["feature_hash"], F.col("top_drivers"))
    files.write_scores(rows, out, {"bundle": bundle, "as_of": as_of, "threshold": meta["threshold"]})
    if rows.isEmpty():
        warnings.warn("the scoring batch is empty", stacklevel=2)
    orders = scoring.work_orders(rows)
    if client_factory and topic:
        files.publish(orders, client_factory, topic)
    return rows, orders


def evaluate(spark: SparkSession, scores: str, raw: str, history: str, as_of: datetime, s: Settings) -> DataFrame:
    """Appends the record of all ripe scores to the history and returns it."""
    record = monitoring.evaluate_period(files.read_scores(spark, scores), staged(spark, raw)["failures"], ntz(as_of), s.prediction_horizon_hours)
    files.append_jsonl(record.withColumn("evaluated_at", F.current_timestamp()), history)
    return record


def drift(spark: SparkSession, features: str, current: DataFrame, s: Settings, profile: str) -> tuple[DataFrame, bool]:
    """The drift report against a stored profile, made from the training rows if missing; True if any feature drifted."""
    order = list(build_contract(s).order)
    if not files.exists(profile):
        matrix, _ = files.read_matrix(spark, features)
        monitoring.build_reference(matrix.filter("split = 'train'"), order).write.parquet(profile)
    report = monitoring.drift_report(spark.read.parquet(profile), current, order)
    return report, report.filter("severity = 'drift'").limit(1).count() > 0


def curated(spark: SparkSession, raw: str, out: str) -> dict[str, int]:
    return curate.curate_all(spark, files.read_all(spark, raw), out)


def main(argv: list[str] | None = None) -> int:
    """python -m millwright.plans.jobs JOB --raw ... ; flags it does not know are ignored. ``drift`` ends with 1 if a feature drifted."""
    p = argparse.ArgumentParser()
    p.add_argument("job", choices=["ingest", "curate", "labels", "features", "train", "score", "evaluate", "drift"])
    for flag in ("landing", "raw", "out", "features", "registry", "bundle", "scores", "history", "profile"):
        p.add_argument(f"--{flag}", default="")
    p.add_argument("--as-of", type=datetime.fromisoformat)
    p.add_argument("--strict", action="store_true")
    a, _ = p.parse_known_args(argv)
    s, spark = Settings.from_env(), SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.job == "ingest":
        ingest(spark, a.landing or s.folder("landing"), a.raw or s.folder("raw"), a.strict).show(truncate=False)
    elif a.job == "curate":
        print(curated(spark, a.raw or s.folder("raw"), a.out or s.folder("curated")))
    elif a.job == "labels":
        print(build_labels(spark, a.raw or s.folder("raw"), a.out or s.folder("features"), s, a.strict).text())
    elif a.job == "features":
        print(build_features(spark, a.raw or s.folder("raw"), a.out or s.folder("features"), s))
    elif a.job == "train":
        train(spark, a.features or s.folder("features"), s, registry=a.registry or None).show(truncate=False)
    elif a.job == "score":
        rows, orders = score(spark, a.raw or s.folder("raw"), a.bundle or a.registry, a.scores or s.folder("scores"), s, a.as_of)
        scoring.summary(rows).show(truncate=False)
        orders.show(truncate=False)
    elif a.job == "evaluate":
        as_of = a.as_of or datetime.now(UTC).replace(tzinfo=None)
        evaluate(spark, a.scores or s.folder("scores"), a.raw or s.folder("raw"), a.history or s.folder("scores") + "/_history", as_of, s).show(truncate=False)
    else:
        current = scoring_matrix(staged(spark, a.raw or s.folder("raw")), s, a.as_of)
        report, drifted = drift(spark, a.features or s.folder("features"), current, s, a.profile or s.folder("features") + "/profile")
        report.orderBy(F.desc("psi")).show(20, truncate=False)
        return int(drifted)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
