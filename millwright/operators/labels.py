"""The labelled grid: horizon, exclusion, observability and split rules, and its balance.

Next and last failures come from one pass over the union of grid and failures
per machine, so the cost does not grow with failures times grid rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millwright.functions.timeutil import HOUR_US, epoch_micros, micros_between, ntz, on_cadence
from millwright.settings import Settings

SPLITS = ("train", "val", "test")
#: The band in which a plausible positive rate lies.
EXPECTED_RATE = (0.005, 0.05)


def feature_grid(telemetry: DataFrame, s: Settings) -> DataFrame:
    return telemetry.filter(on_cadence(F.col("ts"), s.feature_cadence_hours)).select("machine_id", "ts")


def split_of(ts: Column, s: Settings) -> Column:
    """train, val, test or gap, by half-open periods."""
    within = (ts >= ntz(s.val_start_ts)) & (ts < ntz(s.val_end_ts))
    return F.when(ts < ntz(s.train_end_ts), "train").when(within, "val").when(ts >= ntz(s.test_start_ts), "test").otherwise("gap")


def failure_context(grid: DataFrame, failures: DataFrame) -> DataFrame:
    """Adds the next failure strictly after, and the last one at or before, each grid row."""
    moments = failures.select("machine_id", "ts").distinct().select("machine_id", "ts", F.lit(True).alias("failed"))
    rows = grid.select("machine_id", "ts", F.lit(False).alias("failed")).unionByName(moments)
    at = F.when(F.col("failed"), F.col("ts"))
    # A failure at a grid row's own time is the last failure, not the next. Both orders look at rows
    # passed so far only, as frames that reach forward are computed anew for each row.
    back = Window.partitionBy("machine_id").orderBy(F.desc("ts"), "failed").rowsBetween(Window.unboundedPreceding, -1)
    order = Window.partitionBy("machine_id").orderBy("ts", F.col("failed").desc()).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("*", F.last(at, ignorenulls=True).over(back).alias("next_failure_ts"), F.last(at, ignorenulls=True).over(order).alias("last_failure_ts"))
    return rows.filter(~F.col("failed")).drop("failed")


def label_grid(telemetry: DataFrame, failures: DataFrame, s: Settings) -> DataFrame:
    """Every grid row with label, flags and split; nothing is dropped yet."""
    ts, horizon = F.col("ts"), s.prediction_horizon_hours * HOUR_US
    bounds = telemetry.agg(F.max("ts").alias("ts_max"))
    rows = failure_context(feature_grid(telemetry, s), failures).crossJoin(F.broadcast(bounds))  # one row
    return rows.select(
        "machine_id",
        "ts",
        F.when(micros_between(ts, F.col("next_failure_ts")) <= horizon, 1).otherwise(0).alias("label"),
        "next_failure_ts",
        "last_failure_ts",
        F.coalesce(micros_between(F.col("last_failure_ts"), ts) <= s.post_failure_exclusion_hours * HOUR_US, F.lit(False)).alias("excluded"),
        (micros_between(ts, F.col("ts_max")) >= horizon).alias("labelable"),
        split_of(ts, s).alias("split"),
    )


def training_rows(labels: DataFrame) -> DataFrame:
    return labels.filter("not excluded and labelable and split != 'gap'").select("machine_id", "ts", "label", "split")


def labels_by_component(labels: DataFrame, failures: DataFrame, s: Settings) -> DataFrame:
    """Training rows times components, labelled by that component's failures.

    Each failure labels the grid rows of the hours before it, found by an equi-join
    on machine and horizon-long period, so no row meets failures far from it.
    """
    h = s.prediction_horizon_hours * HOUR_US
    kept = training_rows(labels).select("machine_id", "ts", "split")
    parts = failures.select("component").distinct()
    own = failures.select("machine_id", "component", epoch_micros(F.col("ts")).alias("f_us"))
    own = own.select("*", F.explode(F.array(F.floor(F.col("f_us") / h), F.floor(F.col("f_us") / h) - 1)).alias("period"))
    at = kept.withColumn("us", epoch_micros(F.col("ts"))).withColumn("period", F.floor(F.col("us") / h))
    hits = at.join(own, ["machine_id", "period"]).filter(f"f_us > us and f_us - us <= {h}").select("machine_id", "ts", "component").distinct()
    grid = kept.crossJoin(F.broadcast(parts))  # as many rows as there are components
    hits = hits.withColumn("hit", F.lit(1))
    return grid.join(hits, ["machine_id", "ts", "component"], "left").select("machine_id", "ts", "split", "component", F.coalesce("hit", F.lit(0)).alias("label"))


def drop_accounting(labels: DataFrame) -> DataFrame:
    """How many grid rows each rule removes; the counts overlap."""
    n = lambda c: F.count(F.when(c, 1))
    gap = F.col("split") == "gap"
    kept = ~F.col("excluded") & F.col("labelable") & ~gap
    return labels.agg(F.count("*").alias("grid_rows"), n(F.col("excluded")).alias("excluded"), n(~F.col("labelable")).alias("unlabelable"), n(gap).alias("in_gap"), n(kept).alias("kept"))


def split_rank(split: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, SPLITS)), split)


def balance(rows: DataFrame, *by: str) -> DataFrame:
    """Rows, positives, bounds, machines and positive rate per group."""
    return rows.groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.sum("label").cast("long").alias("positives"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.countDistinct("machine_id").alias("machines"),
        F.avg("label").alias("positive_rate"),
    )


def balance_by_component(by_component: DataFrame) -> DataFrame:
    return by_component.groupBy("component", "split").agg(F.count("*").alias("rows"), F.sum("label").cast("long").alias("positives"), F.avg("label").alias("positive_rate"))


def component_pivot(by_component: DataFrame) -> DataFrame:
    return by_component.groupBy("component").pivot("split", list(SPLITS)).agg(F.avg("label"))


@dataclass(frozen=True)
class LabelSummary:
    accounting: dict
    by_split: list[dict]
    by_component: list[dict]
    positive_rate: float

    @property
    def plausible(self) -> bool:
        return EXPECTED_RATE[0] <= self.positive_rate <= EXPECTED_RATE[1]

    def text(self) -> str:
        lines = ["drop accounting: " + ", ".join(f"{k} {v}" for k, v in self.accounting.items())]
        lines += [f"{r['split']:>6}: {r['rows']} rows, {r['positives']} positive, {r['machines']} machines, rate {r['positive_rate']:.4f}" for r in self.by_split]
        lines += [f"{r['component']} {r['split']:>6}: {r['rows']} rows, {r['positives']} positive" for r in self.by_component]
        return "\n".join([*lines, f"positive rate {self.positive_rate:.4f}, {'as' if self.plausible else 'NOT as'} expected"])


def summarise(labels: DataFrame, failures: DataFrame, s: Settings) -> LabelSummary:
    labels = labels.persist()
    try:
        rows = training_rows(labels)
        by_split = [r.asDict() for r in balance(rows, "split").orderBy(split_rank(F.col("split"))).collect()]
        parts = [r.asDict() for r in balance_by_component(labels_by_component(labels, failures, s)).orderBy("component", split_rank(F.col("split"))).collect()]
        n, p = sum(r["rows"] for r in by_split), sum(r["positives"] for r in by_split)
        return LabelSummary(drop_accounting(labels).first().asDict(), by_split, parts, p / n if n else 0.0)
    finally:
        labels.unpersist()
