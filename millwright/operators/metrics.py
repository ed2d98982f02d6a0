"""Ranking metrics, cost curves and operating points of scored rows (label, score).

Cumulative counts by descending score are taken in two levels, within score
buckets and over them, so no window holds all distinct scores.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_CURVE_POINTS = 2000
HOURS_PER_MONTH = 730.0
#: Fixed value: the rules model watches this share of training rows as normal.
RULES_PERCENTILE = 0.99
RULES_FEATURE = "vibration_std_24h"


def class_weight(rows: DataFrame) -> DataFrame:
    """Negatives per positive; 1 if there is no positive."""
    p, n = F.sum("label").cast("double"), F.count("*")
    return rows.agg(F.coalesce(F.when(p > 0, (n - p) / p), F.lit(1.0)).alias("scale_pos_weight"))


def by_score(rows: DataFrame) -> DataFrame:
    """Per distinct score: rows and positives."""
    return rows.groupBy("score").agg(F.count("*").alias("n"), F.sum("label").cast("long").alias("p"))


def cumulative(rows: DataFrame, buckets: int = 4096) -> DataFrame:
    """by_score with rows and positives at or above each score. Scores outside [0, 1] share the end buckets."""
    own = by_score(rows).withColumn("bucket", F.floor(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score"))) * buckets))
    totals = own.groupBy("bucket").agg(F.sum("n").alias("bn"), F.sum("p").alias("bp"))
    above = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, -1)  # at most one row per bucket
    bases = totals.select("bucket", F.coalesce(F.sum("bn").over(above), F.lit(0)).alias("bn"), F.coalesce(F.sum("bp").over(above), F.lit(0)).alias("bp"))
    inside = Window.partitionBy("bucket").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    own = own.select("*", F.sum("n").over(inside).alias("cn"), F.sum("p").over(inside).alias("cp"))
    return own.join(bases, "bucket").select("score", "n", "p", (F.col("cn") + F.col("bn")).alias("flagged"), (F.col("cp") + F.col("bp")).alias("true_positives"))


def ranking_metrics(rows: DataFrame) -> DataFrame:
    """Step-wise average precision, ROC-AUC with half credit for ties, base rate; NaN with one class."""
    steps = cumulative(rows)
    tp, flagged, n, p = (F.col(c).cast("double") for c in ("true_positives", "flagged", "n", "p"))
    sums = steps.agg(
        F.sum(p * tp / flagged).alias("ap"),
        F.sum((n - p) * (tp - p / 2)).alias("area"),
        F.sum(p).alias("pos"),
        F.sum(n - p).alias("neg"),
    )
    one_class = F.coalesce((F.col("pos") == 0) | (F.col("neg") == 0), F.lit(True))
    nan = F.lit(float("nan"))
    return sums.select(
        F.when(one_class, nan).otherwise(F.col("ap") / F.col("pos")).alias("pr_auc"),
        F.when(one_class, nan).otherwise(F.col("area") / (F.col("pos") * F.col("neg"))).alias("roc_auc"),
        F.coalesce(F.col("pos") / (F.col("pos") + F.col("neg")), nan).alias("base_rate"),
    )


def _off_values(edges: list[float]) -> list[float]:
    """Sorted edges, each a little above its value, so that the last bits of a value computed again do not change its bucket."""
    least = min((abs(e) for e in edges if e and math.isfinite(e)), default=1.0)
    return [e + (abs(e) or least) * 2.0**-33 for e in edges]


def exact_percentiles(rows: DataFrame, probabilities: list[float], buckets: int = 256) -> DataFrame:
    """(key, p, value): percentiles of ``value`` per ``key``, linearly interpolated and exact.

    Ranks are taken in two levels, within buckets cut at approximate quantiles and
    over them, so no task holds all values of a key. Nulls do not count; a key
    without values gives no row. The edges are computed here and once: their sketch
    depends on the order of its rows, and both levels must cut alike.
    """
    own = rows.filter("value is not null").groupBy("key", "value").agg(F.count("*").alias("n"))
    edges = F.array_distinct(F.percentile_approx(F.col("value").cast("double"), [i / buckets for i in range(1, buckets)], 10 * buckets))
    found = own.groupBy("key").agg(F.sum("n").alias("total"), edges.alias("edges"))
    cuts = rows.sparkSession.createDataFrame([(r["key"], r["total"], _off_values(r["edges"])) for r in found.collect()], found.schema)
    own = own.join(F.broadcast(cuts), "key").withColumn("bucket", _place(F.col("value"), F.col("edges")))  # a row per key, of bounded length
    inside = Window.partitionBy("key", "bucket").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    own = own.select("key", "bucket", "value", "n", "total", F.sum("n").over(inside).alias("upto"))
    bases = own.groupBy("key", "bucket").agg(F.max("upto").alias("in_bucket"))
    before = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # a row per bucket
    bases = bases.select("key", "bucket", F.coalesce(F.sum("in_bucket").over(before), F.lit(0)).alias("base"))
    own = own.join(bases, ["key", "bucket"]).select("key", "value", "total", (F.col("base") + F.col("upto")).alias("hi"), (F.col("base") + F.col("upto") - F.col("n")).alias("lo"))
    wanted = F.array(*[F.struct(F.lit(float(p)).alias("p"), ((F.col("total") - 1) * F.lit(float(p))).alias("at")) for p in probabilities])
    hits = own.withColumn("wanted", F.filter(wanted, lambda w: (F.ceil(w["at"]) >= F.col("lo")) & (F.floor(w["at"]) < F.col("hi"))))
    hits = hits.filter(F.size("wanted") > 0).select("key", "value", "lo", "hi", F.explode("wanted").alias("w")).select("key", "value", "lo", "hi", "w.p", "w.at")
    held = lambda k: (k >= F.col("lo")) & (k < F.col("hi"))
    ends = hits.groupBy("key", "p").agg(F.first("at").alias("at"), F.max(F.when(held(F.floor("at")), F.col("value"))).alias("low"), F.max(F.when(held(F.ceil("at")), F.col("value"))).alias("high"))
    value = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise((F.ceil("at") - F.col("at")) * F.col("low") + (F.col("at") - F.floor("at")) * F.col("high"))
    return ends.select("key", "p", value.alias("value"))


def threshold_grid(rows: DataFrame, max_points: int = MAX_CURVE_POINTS) -> DataFrame:
    """One row, array ``grid``: the distinct scores, or their quantiles if there are more than ``max_points``."""
    few = rows.select("score").distinct().limit(max_points + 1)
    if few.count() <= max_points:
        return few.agg(F.sort_array(F.collect_list("score")).alias("grid"))
    steps = [i / (max_points - 1) for i in range(max_points)]
    found = exact_percentiles(rows.select(F.lit(0).alias("key"), F.col("score").alias("value")), steps)
    return found.agg(F.sort_array(F.collect_set("value")).alias("grid"))


def _place(score: Column, grid: Column) -> Column:
    """How many grid values are at most the score, in two steps of about the root of the grid's size."""
    step = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(grid))).cast("int"))
    heads = F.transform(F.sequence(F.lit(0), F.size(grid) - 1, step), lambda i: F.element_at(grid, i + 1))
    coarse = F.size(F.filter(heads, lambda c: c <= score))
    start = F.greatest(coarse - 1, F.lit(0)) * step
    return F.when(coarse == 0, 0).otherwise(start + F.size(F.filter(F.slice(grid, start + 1, step), lambda c: c <= score)))


def cost_curve(rows: DataFrame, cost_false_alarm: float, cost_missed_failure: float, machines: int | None = None, span_hours: float | None = None, max_points: int = MAX_CURVE_POINTS) -> DataFrame:
    """Confusion counts, rates and cost per candidate threshold, and for alarming on nothing.

    The last threshold lies just above the largest score. Precision is 0 where
    nothing is flagged, recall 0 without positives, the false alarm rate 0
    without negatives. ``alarms_per_machine_month`` comes with machines and span.
    """
    grid = threshold_grid(rows, max_points)
    placed = by_score(rows).crossJoin(F.broadcast(grid)).select(_place(F.col("score"), F.col("grid")).alias("k"), "n", "p")  # one row, of bounded length
    counts = placed.groupBy("k").agg(F.sum("n").alias("n"), F.sum("p").alias("p"))
    top = F.element_at("grid", -1)
    beyond = top + F.greatest(F.abs(top), F.lit(1e-300)) * F.lit(2.0**-52)
    points = grid.select(F.posexplode(F.concat("grid", F.array(beyond))).alias("i", "threshold")).withColumn("k", F.col("i") + 1)
    down = Window.orderBy(F.desc("k")).rowsBetween(Window.unboundedPreceding, 0)  # at most max_points + 1 rows
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    full = points.join(counts, "k", "full").fillna(0, ["n", "p"])
    full = full.select("threshold", F.sum("n").over(down).alias("flagged"), F.sum("p").over(down).alias("true_positives"), F.sum("n").over(whole).alias("all_n"), F.sum("p").over(whole).alias("all_p")).filter("threshold is not null")
    tp, flagged = F.col("true_positives"), F.col("flagged")
    fp, fn = flagged - tp, F.col("all_p") - tp
    out = full.select(
        "threshold",
        "flagged",
        "true_positives",
        fp.alias("false_positives"),
        (F.col("all_n") - F.col("all_p") - fp).alias("true_negatives"),
        fn.alias("false_negatives"),
        F.coalesce(tp / F.nullif(F.col("all_p"), F.lit(0)), F.lit(0.0)).alias("recall"),
        F.coalesce(tp / F.nullif(flagged, F.lit(0)), F.lit(0.0)).alias("precision"),
        F.coalesce(fp / F.nullif(F.col("all_n") - F.col("all_p"), F.lit(0)), F.lit(0.0)).alias("false_alarm_rate"),
        (F.lit(float(cost_false_alarm)) * fp + F.lit(float(cost_missed_failure)) * fn).alias("expected_cost"),
    )
    if machines and span_hours:
        out = out.withColumn("alarms_per_machine_month", F.col("false_positives") / F.lit(machines * span_hours / HOURS_PER_MONTH))
    return out


def cheapest_threshold(curve: DataFrame) -> DataFrame:
    """The point of least cost; of equals the highest threshold."""
    return curve.orderBy("expected_cost", F.desc("threshold")).limit(1)


class NoOperatingPoint(ValueError):
    """No point of the curve keeps the ceiling."""


def best_recall(curve: DataFrame, column: str, ceiling: float) -> DataFrame:
    """The point of most recall with ``column`` at most ``ceiling``; of equals the lowest threshold."""
    return curve.filter(F.col(column) <= ceiling).orderBy(F.desc("recall"), "threshold").limit(1)


def recall_at_false_alarm_rate(curve: DataFrame, ceiling: float) -> DataFrame:
    return best_recall(curve, "false_alarm_rate", ceiling)


def recall_at_alarm_budget(curve: DataFrame, budget: float) -> DataFrame:
    if "alarms_per_machine_month" not in curve.columns:
        raise NoOperatingPoint("the curve was made without machines and span")
    return best_recall(curve, "alarms_per_machine_month", budget)


def require_point(point: DataFrame) -> dict:
    if (row := point.first()) is None:
        raise NoOperatingPoint("no threshold keeps the ceiling")
    return row.asDict()


def operating_point_at(curve: DataFrame, threshold: float) -> DataFrame:
    return curve.orderBy(F.abs(F.col("threshold") - F.lit(float(threshold))), "threshold").limit(1)


def confusion(rows: DataFrame, threshold: Column) -> DataFrame:
    """Counts and rates of score >= threshold, which may differ by row."""
    hit, y = F.col("score") >= threshold, F.col("label") == 1
    n = lambda c: F.count(F.when(c, 1))
    sums = rows.agg(n(hit & y).alias("true_positives"), n(hit & ~y).alias("false_positives"), n(~hit & y).alias("false_negatives"), n(~hit & ~y).alias("true_negatives"))
    rate = lambda a, b: F.col(a) / F.greatest(F.col(a) + F.col(b), F.lit(1))
    return sums.select("*", rate("true_positives", "false_negatives").alias("recall"), rate("true_positives", "false_positives").alias("precision"))


def rules_cutoff(train: DataFrame, feature: str = RULES_FEATURE) -> DataFrame:
    """One row: the training percentile of the feature, linearly interpolated."""
    found = exact_percentiles(train.select(F.lit(0).alias("key"), F.col(feature).cast("double").alias("value")), [RULES_PERCENTILE])
    return found.agg(F.max("value").alias("cutoff"))


def rules_score(feature: Column, cutoff: Column) -> Column:
    excess = (feature - cutoff) / F.greatest(F.abs(cutoff), F.lit(1e-9))
    return 1 / (1 + F.exp(-excess))
