"""Model builders, training with an honest threshold, explanations, registry and bundles."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.functions.contract import SENSORS, Contract, ContractError
from millwright.settings import Settings
from millwright.sources import files

from . import metrics
from .scoring import top_drivers

ALARM_BUDGET = 1.0


@dataclass
class Fitted:
    """A named model: ``predict`` adds ``probability`` to rows with its columns."""

    name: str
    columns: tuple[str, ...]
    predict: Callable[[DataFrame], DataFrame]
    pipeline: PipelineModel | None = None
    details: dict = field(default_factory=dict)


def _probability(pipeline: PipelineModel) -> Callable[[DataFrame], DataFrame]:
    def predict(df: DataFrame) -> DataFrame:
        columns = df.columns
        out = pipeline.transform(df)
        return out.select(*columns, F.element_at(vector_to_array(pipeline.stages[-1].getProbabilityCol()), 2).alias("probability"))

    return predict


def _weighted(train: DataFrame) -> DataFrame:
    """Balanced class weights: rows / (2 * rows of the class)."""
    n, p = train.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < p < n:
        raise ValueError("training rows hold one class only")
    weight = F.when(F.col("label") == 1, n / (2 * p)).otherwise(n / (2 * (n - p)))
    return train.withColumn("label", F.col("label").cast("double")).withColumn("_weight", weight)


#: What trees see in place of a missing value: below any reading, so that splits can tell it apart.
MISSING = -1e12


def _fit(name: str, train: DataFrame, columns: tuple[str, ...], *stages, fill: bool = False) -> Fitted:
    """Fits stages on the assembled columns; a missing value is an error unless ``fill`` puts ``MISSING`` in its place."""
    names = [f"_x_{c}" for c in columns] if fill else list(columns)
    filled = ", ".join(f"coalesce(nanvl(double(`{c}`), {MISSING}D), {MISSING}D) AS `_x_{c}`" for c in columns)
    first = [SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__")] if fill else []
    assemble = VectorAssembler(inputCols=names, outputCol="_features", handleInvalid="error")
    pipeline = Pipeline(stages=[*first, assemble, *stages]).fit(_weighted(train))
    return Fitted(name, columns, _probability(pipeline), pipeline)


_OUT = {"predictionCol": "_predicted", "labelCol": "label", "weightCol": "_weight"}


def fit_rules(train: DataFrame, contract: Contract, s: Settings) -> Fitted:
    cutoff = metrics.rules_cutoff(train).first()[0]
    predict = lambda df: df.withColumn("probability", metrics.rules_score(F.col(metrics.RULES_FEATURE), F.lit(cutoff)))
    return Fitted("rules", (metrics.RULES_FEATURE,), predict, details={"cutoff": cutoff})


def fit_logistic(train: DataFrame, contract: Contract, s: Settings) -> Fitted:
    """On the four readings, standardised on the training rows. The penalty is on the mean loss, not its sum."""
    scale = StandardScaler(inputCol="_features", outputCol="_scaled", withMean=True, withStd=True)
    return _fit("logistic", train, SENSORS, scale, LogisticRegression(featuresCol="_scaled", maxIter=2000, regParam=1e-4, standardization=False, **_OUT))


def _trees(name: str, train: DataFrame, contract: Contract, **options) -> Fitted:
    return _fit(name, train, contract.order, GBTClassifier(featuresCol="_features", seed=7, **options, **_OUT), fill=True)


def fit_boosted(train: DataFrame, contract: Contract, s: Settings, rounds: int = 300) -> Fitted:
    return _trees("boosted", train, contract, maxIter=rounds, maxDepth=5, stepSize=0.06)


def fit_boosted_tuned(train: DataFrame, contract: Contract, s: Settings, rounds: int = 500) -> Fitted:
    return _trees("boosted_tuned", train, contract, maxIter=rounds, maxDepth=4, stepSize=0.05, subsamplingRate=0.8, featureSubsetStrategy="0.6")


#: Builders by name; add one to offer another model.
BUILDERS: dict[str, Callable[[DataFrame, Contract, Settings], Fitted]] = {"rules": fit_rules, "logistic": fit_logistic, "boosted": fit_boosted, "boosted_tuned": fit_boosted_tuned}


@dataclass(frozen=True)
class Result:
    """A model's record. PR-AUC lift is over the base rate; no plain accuracy."""

    model: str
    split: str
    threshold: float
    pr_auc: float
    roc_auc: float
    base_rate: float
    pr_auc_lift: float
    recall: float
    precision: float
    expected_cost: float
    recall_at_budget: float | None


def evaluate(scored: DataFrame, model: str, split: str, threshold: float, s: Settings) -> Result:
    """At exactly the given threshold; ``scored`` has machine_id, ts, label, score."""
    rank = metrics.ranking_metrics(scored).first()
    row = metrics.confusion(scored, F.lit(float(threshold))).first()
    span = scored.agg(F.countDistinct("machine_id").alias("m"), F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    hours = (span["b"] - span["a"]).total_seconds() / 3600 if span["a"] else 0.0
    at_budget = None
    if span["m"] and hours:
        curve = metrics.cost_curve(scored, s.cost_false_alarm, s.cost_missed_failure, span["m"], hours)
        best = metrics.recall_at_alarm_budget(curve, ALARM_BUDGET).first()
        at_budget = best["recall"] if best else None
    cost = s.cost_false_alarm * row["false_positives"] + s.cost_missed_failure * row["false_negatives"]
    lift = rank["pr_auc"] / rank["base_rate"] if rank["base_rate"] else float("nan")
    return Result(model, split, threshold, rank["pr_auc"], rank["roc_auc"], rank["base_rate"], lift, row["recall"], row["precision"], cost, at_budget)


def train_one(name: str, matrix: DataFrame, contract: Contract, s: Settings) -> tuple[Fitted, list[Result]]:
    """Fits on train, takes the threshold from val unless it is pinned, and applies it to test."""
    part = lambda split: matrix.filter(F.col("split") == split)
    fitted = BUILDERS[name](part("train"), contract, s)
    scored = lambda split: fitted.predict(part(split)).withColumnRenamed("probability", "score")
    val = scored("val").select("machine_id", "ts", "label", "score").persist()
    try:
        if s.derive_threshold:
            curve = metrics.cost_curve(val, s.cost_false_alarm, s.cost_missed_failure)
            threshold = metrics.require_point(metrics.cheapest_threshold(curve))["threshold"]
        else:
            threshold = s.decision_threshold
        fitted.details["threshold"] = threshold
        return fitted, [evaluate(val, name, "val", threshold, s), evaluate(scored("test"), name, "test", threshold, s)]
    finally:
        val.unpersist()


def results_table(spark: SparkSession, results: list[Result]) -> DataFrame:
    kinds = "model string, split string, threshold double, pr_auc double, roc_auc double, base_rate double, pr_auc_lift double, recall double, precision double, expected_cost double, recall_at_budget double"
    return spark.createDataFrame([tuple(asdict(r).values()) for r in results], kinds).orderBy("split", F.desc("pr_auc"))


def best_result(results: DataFrame) -> DataFrame:
    """The model with the largest PR-AUC on val; NaN does not count."""
    return results.filter((F.col("split") == "val") & ~F.isnan("pr_auc")).orderBy(F.desc("pr_auc"), "model").limit(1)


def contributions(fitted: Fitted) -> dict[str, Column]:
    """Per-row contributions of a linear model: coefficient times standardised value.

    Trees have none as expressions; ``with_drivers`` walks them instead.
    """
    if fitted.pipeline is None:
        return {c: F.col(c) for c in fitted.columns}
    model = fitted.pipeline.stages[-1]
    if hasattr(model, "coefficients"):
        scale = fitted.pipeline.stages[1]
        parts = zip(fitted.columns, model.coefficients.toArray(), scale.mean.toArray(), scale.std.toArray(), strict=True)
        return {c: (F.col(c) - float(m)) / float(sd or 1.0) * float(w) for c, w, m, sd in parts}
    return {}


def _walked(tree) -> tuple[np.ndarray, ...]:
    """(feature, threshold, left, right, value) of a tree's nodes; feature -1 in a leaf."""
    rows: list[list[float]] = []

    def add(node) -> int:
        at = len(rows)
        rows.append([-1, 0.0, at, at, node.prediction()])
        if node.numDescendants():
            split = node.split()
            rows[at][:2] = [split.featureIndex(), split.threshold()]
            rows[at][2], rows[at][3] = add(node.leftChild()), add(node.rightChild())
        return at

    add(tree._call_java("rootNode"))
    feature, threshold, left, right, value = zip(*rows, strict=True)
    return np.array(feature, int), np.array(threshold), np.array(left, int), np.array(right, int), np.array(value)


def path_contributions(x: np.ndarray, trees: list[tuple[np.ndarray, ...]], weights: list[float]) -> np.ndarray:
    """Per row and feature: how much the splits on the feature moved the row's margin on its way down."""
    out, every = np.zeros(x.shape), np.arange(len(x))
    for (feature, threshold, left, right, value), w in zip(trees, weights, strict=True):
        at = np.zeros(len(x), int)
        while (inner := feature[at] >= 0).any():
            f = np.maximum(feature[at], 0)
            to = np.where(inner, np.where(x[every, f] <= threshold[at], left[at], right[at]), at)
            np.add.at(out, (every, f), w * (value[to] - value[at]))
            at = to
    return out


def with_drivers(fitted: Fitted, df: DataFrame, k: int = 3) -> DataFrame:
    """Adds ``top_drivers``: the k columns that moved each row's score most; of equals the first name.

    Linear models and rules by expressions; trees by their paths, in Arrow batches.
    """
    if fitted.pipeline is None or not hasattr(fitted.pipeline.stages[-1], "trees"):
        return df.withColumn("top_drivers", top_drivers(contributions(fitted), k))
    model, names = fitted.pipeline.stages[-1], np.array(fitted.columns)
    trees, weights, by_name = [_walked(t) for t in model.trees], list(model.treeWeights), np.argsort(np.array(fitted.columns))

    @F.pandas_udf("array<string>")
    def listed(columns: pd.DataFrame) -> pd.Series:
        moved = np.abs(path_contributions(columns.fillna(MISSING).to_numpy(float), trees, weights))
        first = np.argsort(-moved[:, by_name], axis=1, kind="stable")[:, :k]
        return pd.Series([names[by_name[row]].tolist() for row in first])

    return df.withColumn("top_drivers", listed(F.struct(*[F.col(c).cast("double") for c in fitted.columns])))


class RegistryError(ValueError):
    """A registration that lacks what scoring needs."""


def save_bundle(fitted: Fitted, folder: str, contract: Contract, version: str) -> dict:
    """The pipeline and a metadata file that scoring checks itself against."""
    meta = {"name": fitted.name, "version": version, "columns": list(fitted.columns), "feature_order": list(contract.order), "feature_hash": contract.hash, **fitted.details}
    if fitted.pipeline is not None:
        fitted.pipeline.write().overwrite().save(f"{folder}/pipeline")
    files.write_json(meta, f"{folder}/metadata.json")
    return meta


def load_bundle(folder: str) -> tuple[Fitted, dict]:
    from millwright.functions.contract import order_hash

    meta = files.read_json(f"{folder}/metadata.json")
    if order_hash(meta["feature_order"]) != meta["feature_hash"]:
        raise ContractError("the bundle's order does not match its hash")
    if meta["name"] == "rules":
        cutoff = meta["cutoff"]
        predict = lambda df: df.withColumn("probability", metrics.rules_score(F.col(metrics.RULES_FEATURE), F.lit(cutoff)))
        return Fitted("rules", tuple(meta["columns"]), predict, details={"cutoff": cutoff, "threshold": meta.get("threshold")}), meta
    pipeline = PipelineModel.load(f"{folder}/pipeline")
    return Fitted(meta["name"], tuple(meta["columns"]), _probability(pipeline), pipeline, {"threshold": meta.get("threshold")}), meta


class Registry:
    """Versions of models in a JSON file, one of them champion."""

    def __init__(self, folder: str) -> None:
        self._file = f"{folder.rstrip('/')}/registry.json"

    def _read(self) -> dict:
        return files.read_json(self._file) if files.exists(self._file) else {"versions": [], "champion": None}

    def register(self, bundle: str, pr_auc: float, promote: bool = True) -> int:
        if not files.exists(f"{bundle}/metadata.json"):
            raise RegistryError("no model in the bundle")
        meta = files.read_json(f"{bundle}/metadata.json")
        if lost := [k for k in ("feature_hash", "threshold") if meta.get(k) is None]:
            raise RegistryError(f"bundle lacks {lost}")
        state = self._read()
        version = len(state["versions"]) + 1
        state["versions"].append({"version": version, "bundle": bundle, "pr_auc": pr_auc, "feature_hash": meta["feature_hash"]})
        state["champion"] = version if promote else state["champion"]
        files.write_json(state, self._file)
        return version

    def promote(self, version: int) -> dict:
        """Makes a version the champion."""
        state = self._read()
        if not 1 <= version <= len(state["versions"]):
            raise RegistryError(f"no version {version}")
        files.write_json(state | {"champion": version}, self._file)
        return state["versions"][version - 1]

    def best(self) -> dict:
        """The version of largest PR-AUC; NaN does not count."""
        known = [v for v in self._read()["versions"] if v["pr_auc"] == v["pr_auc"]]
        if not known:
            raise RegistryError("no version with a score")
        return max(known, key=lambda v: v["pr_auc"])

    def champion(self) -> dict:
        state = self._read()
        if state["champion"] is None:
            raise RegistryError("no champion")
        return state["versions"][state["champion"] - 1]
