"""Checks on time splits, machine overlap, and whole-machine holdouts."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .labels import SPLITS, balance


class SplitError(ValueError):
    """Splits that leak or are mislabelled."""


def describe_splits(rows: DataFrame) -> DataFrame:
    return balance(rows, "split")


def verify_splits(rows: DataFrame, gap_hours: int, horizon_hours: int) -> None:
    """Raises unless splits are known, apart in time, and further apart than the horizon."""
    if gap_hours < horizon_hours:
        raise SplitError(f"a gap of {gap_hours} h is below the horizon of {horizon_hours} h")
    found = {r["split"]: r for r in describe_splits(rows).collect()}
    if odd := set(found) - set(SPLITS):
        raise SplitError(f"unknown splits {sorted(map(str, odd))}")
    present = [found[s] for s in SPLITS if s in found]
    for a, b in zip(present, present[1:], strict=False):
        hours = (b["first_ts"] - a["last_ts"]).total_seconds() / 3600
        if hours <= horizon_hours:
            raise SplitError(f"{a['split']} and {b['split']} are {hours:g} h apart, the horizon is {horizon_hours} h")


def machine_overlap(rows: DataFrame) -> DataFrame:
    """Per pair of splits, in how many machines they share."""
    per = rows.groupBy("machine_id").agg(*[F.max((F.col("split") == s).cast("int")).alias(s) for s in SPLITS])
    pairs = list(combinations(SPLITS, 2))
    sums = per.agg(*[F.coalesce(F.sum(F.col(a) * F.col(b)), F.lit(0)).cast("long").alias(f"{a}_{b}") for a, b in pairs])
    return sums.select(F.explode(F.array(*[F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.col(f"{a}_{b}").alias("shared_machines")) for a, b in pairs])).alias("r")).select("r.*")


def holdout_machines(rows: DataFrame, fraction: float = 0.2, seed: int = 0) -> DataFrame:
    """Machines held out, stratified by whether they ever fail; at least one per stratum.

    The order is a fixed arithmetic function of machine and seed, so draws repeat
    on any engine. Counts round half to even.
    """
    if not 0 < fraction < 1:
        raise ValueError("fraction must lie in (0, 1)")
    per = rows.groupBy("machine_id").agg(F.max("label").alias("ever_fails"))
    draw = (F.col("machine_id").cast("long") * 7919 + seed) % 104729
    ranked = per.withColumn("rank", F.row_number().over(Window.partitionBy("ever_fails").orderBy(draw, "machine_id")))
    sizes = per.groupBy("ever_fails").agg(F.greatest(F.lit(1), F.bround(F.count("*") * F.lit(float(fraction))).cast("long")).alias("take"))
    return ranked.join(F.broadcast(sizes), "ever_fails").filter("rank <= take").select("machine_id", "ever_fails")  # one row per label value


def apply_holdout(rows: DataFrame, held: DataFrame) -> DataFrame:
    """Rows of held-out machines move to test and are flagged."""
    flag = held.select("machine_id", F.lit(True).alias("held_out"))
    out = rows.join(flag, "machine_id", "left").withColumn("held_out", F.coalesce("held_out", F.lit(False)))
    return out.withColumn("split", F.when(F.col("held_out"), "test").otherwise(F.col("split")))


def unseen_only(rows: DataFrame, held: DataFrame) -> DataFrame:
    return rows.join(held.select("machine_id"), "machine_id", "left_semi")


def split_frames(matrix: DataFrame) -> dict[str, DataFrame]:
    return {s: matrix.filter(F.col("split") == s) for s in SPLITS}
