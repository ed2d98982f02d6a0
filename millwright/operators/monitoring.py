"""Drift of features by population stability, and performance once labels have ripened."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.functions.timeutil import HOUR_US, micros_between

from .features import asof_forward_strict
from .metrics import HOURS_PER_MONTH, confusion, exact_percentiles, ranking_metrics

#: Quantiles that cut the bins, the floor of a share, and severity bands.
DECILES = tuple(i / 10 for i in range(1, 10))
FLOOR = 1e-6
WARN, DRIFT = 0.1, 0.2


def long_form(df: DataFrame, features: list[str]) -> DataFrame:
    """(feature, value) of all finite values; one scan for all features."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features]))
    return df.select(pairs.alias("r")).select("r.*")


def finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))


def cut_points(values: DataFrame) -> DataFrame:
    """Distinct inner deciles per feature."""
    known = values.filter(finite(F.col("value")))
    found = exact_percentiles(known.select(F.col("feature").alias("key"), "value"), list(DECILES))
    cuts = found.groupBy(F.col("key").alias("feature")).agg(F.array_sort(F.collect_set("value")).alias("cuts"))
    return cuts.join(known.groupBy("feature").agg(F.avg("value").alias("mean")), "feature")


def proportions(values: DataFrame, cuts: DataFrame) -> DataFrame:
    """(feature, bin, share); bins are [cut, next cut), open at both ends, and uniform for a feature without values."""
    counted = values.filter(finite(F.col("value"))).join(F.broadcast(cuts.select("feature", "cuts")), "feature")  # a row per feature
    counted = counted.groupBy("feature", F.size(F.filter("cuts", lambda c: c <= F.col("value"))).alias("bin")).agg(F.count("*").alias("n"))
    bins = cuts.select("feature", F.explode(F.sequence(F.lit(0), F.size("cuts"))).alias("bin"), (F.size("cuts") + 1).alias("bins"))
    full = bins.join(counted, ["feature", "bin"], "left").fillna(0, ["n"])
    totals = counted.groupBy("feature").agg(F.sum("n").alias("total"))
    share = F.coalesce(F.col("n") / F.col("total"), 1 / F.col("bins"))
    return full.join(totals, "feature", "left").select("feature", "bin", share.alias("share"))


def build_reference(df: DataFrame, features: list[str]) -> DataFrame:
    """The profile: (feature, cuts, mean, shares)."""
    values = long_form(df, features)
    found = cut_points(values)
    cuts = df.sparkSession.createDataFrame(found.collect(), found.schema)  # a row per feature; several plans below read it
    shares = proportions(values, cuts).groupBy("feature").agg(F.transform(F.array_sort(F.collect_list(F.struct("bin", "share"))), lambda x: x["share"]).alias("shares"))
    return cuts.join(shares, "feature")


def severity(psi: Column) -> Column:
    return F.when(psi >= DRIFT, "drift").when(psi >= WARN, "warn").otherwise("ok")


def drift_report(reference: DataFrame, df: DataFrame, features: list[str]) -> DataFrame:
    """Population stability index per feature with severity and means; order by psi descending to read it."""
    values = long_form(df, features)
    now = proportions(values, reference)
    then = reference.select("feature", F.posexplode("shares").alias("bin", "expected"))
    a, e = F.greatest("share", F.lit(FLOOR)), F.greatest("expected", F.lit(FLOOR))
    psi = then.join(now, ["feature", "bin"]).groupBy("feature").agg(F.sum((a - e) * F.ln(a / e)).alias("psi"))
    means = values.groupBy("feature").agg(F.avg(F.when(~F.isnan("value"), F.col("value"))).alias("current_mean"))
    out = psi.join(reference.select("feature", F.col("mean").alias("reference_mean")), "feature").join(means, "feature", "left")
    return out.select("feature", "psi", severity(F.col("psi")).alias("severity"), "reference_mean", "current_mean")


def worst(report: DataFrame, n: int = 15) -> DataFrame:
    return report.orderBy(F.desc("psi"), "feature").limit(n)


def is_ripe(scored_at: Column, as_of: Column, horizon_hours: int) -> Column:
    return micros_between(scored_at, as_of) >= horizon_hours * HOUR_US


def attach_outcomes(scores: DataFrame, failures: DataFrame, horizon_hours: int, at: str = "scored_at") -> DataFrame:
    """Adds ``label``: whether the machine's next failure after scoring falls within the horizon."""
    moments = failures.select("machine_id", F.col("ts").alias(at))
    joined = asof_forward_strict(scores, moments, "machine_id", "next_failure_ts", at)
    inside = micros_between(F.col(at), F.col("next_failure_ts")) <= horizon_hours * HOUR_US
    return joined.withColumn("label", F.coalesce(inside, F.lit(False)).cast("int"))


def implied_threshold(scores: DataFrame) -> DataFrame:
    """The lowest probability acted on; infinite if none, one half without decisions."""
    if "decision" not in scores.columns:
        return scores.sparkSession.range(1).select(F.lit(0.5).alias("threshold"))
    return scores.agg(F.coalesce(F.min(F.when(F.col("decision") == "act", F.col("probability"))), F.lit(float("inf"))).alias("threshold"))


def evaluate_period(scores: DataFrame, failures: DataFrame, as_of: Column, horizon_hours: int) -> DataFrame:
    """One row on all ripe scores: counts, rates, ranking, alarms per machine-month, and how many still wait.

    Rows are judged at their own threshold; where the column is missing at the
    implied one. With nothing ripe, counts are 0 and ranking is NaN.
    """
    ripe = is_ripe(F.col("scored_at"), as_of, horizon_hours)
    mature = attach_outcomes(scores.filter(ripe), failures, horizon_hours)
    if "threshold" not in scores.columns:
        mature = mature.crossJoin(F.broadcast(implied_threshold(scores.filter(ripe))))  # one row
    rows = mature.withColumn("score", F.col("probability"))
    waiting = scores.agg(F.count(F.when(~ripe, 1)).alias("pending_rows"))
    span = rows.agg(
        F.count("*").alias("scored_rows"),
        F.min("scored_at").alias("period_start"),
        F.max("scored_at").alias("period_end"),
        F.countDistinct("machine_id").alias("machines"),
        F.coalesce(F.sum("label"), F.lit(0)).cast("long").alias("positives"),
    )
    months = F.col("machines") * micros_between(F.col("period_start"), F.col("period_end")) / F.lit(HOUR_US * HOURS_PER_MONTH)
    one = span.crossJoin(waiting).crossJoin(confusion(rows, F.col("threshold"))).crossJoin(ranking_metrics(rows))  # one row each
    return one.withColumn("alarms_per_machine_month", F.col("false_positives") / F.nullif(months, F.lit(0.0)))
