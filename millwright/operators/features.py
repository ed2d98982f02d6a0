"""Features of telemetry rows: one path for training and scoring.

All window features of a machine share one partitioning and order, so Spark plans
them as a single exchange and sort.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millwright.functions.contract import COMPONENTS, ERROR_CODES, LAGS, MODELS, SENSORS, Contract, build_contract, rolled, trend_name
from millwright.functions.timeutil import HOUR_US, epoch_micros, hours_between, on_cadence
from millwright.settings import Settings


def _trailing(hours: int):
    """The frame (ts - hours, ts] of a machine, by time and not by rows."""
    return Window.partitionBy("machine_id").orderBy("us").rangeBetween(-(hours * HOUR_US - 1), 0)


def _with_micros(df: DataFrame) -> DataFrame:
    return df.withColumn("us", epoch_micros(F.col("ts")))


_FUNCTIONS = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}


def rolling_columns(windows: tuple[int, ...]) -> dict:
    return {rolled(s, stat, w): f(s).over(_trailing(w)) for s in SENSORS for w in windows for stat, f in _FUNCTIONS.items()}


def lag_columns() -> dict:
    order = Window.partitionBy("machine_id").orderBy("us")
    return {f"{s}_lag_{k}": F.lag(s, k).over(order) for s in SENSORS for k in LAGS}


def trend_columns(windows: tuple[int, ...]) -> dict:
    """Short mean minus long mean; nothing with one window. Needs the rolling columns."""
    if len(windows) < 2:
        return {}
    return {trend_name(s, windows): F.col(rolled(s, "mean", min(windows))) - F.col(rolled(s, "mean", max(windows))) for s in SENSORS}


def error_pivot(errors: DataFrame) -> DataFrame:
    """Errors per machine, time and pinned code; other codes are left out."""
    known = errors.filter(F.col("error_id").isin(*ERROR_CODES))
    return known.groupBy("machine_id", "ts").agg(*[F.count(F.when(F.col("error_id") == c, 1)).alias(c) for c in ERROR_CODES])


class UnknownMachine(ValueError):
    """A machine without model or age."""


def require_machines(rows: DataFrame, machines: DataFrame) -> None:
    """Raises if a machine of ``rows`` is not in ``machines``, or has no model or age there."""
    known = machines.filter("model is not null and age is not null")
    if lost := [r[0] for r in rows.select("machine_id").distinct().join(known, "machine_id", "left_anti").orderBy("machine_id").limit(5).collect()]:
        raise UnknownMachine(f"machines without model or age, such as {lost}")


def warnings(tables: dict[str, DataFrame]) -> list[str]:
    """What features leave out: error codes and models that the vocabulary lacks, with their rows."""
    codes = unknown_codes(tables["errors"]).select(F.lit("error code").alias("kind"), F.col("error_id").alias("name"), "rows")
    models = tables["machines"].filter(~F.col("model").isin(*MODELS)).groupBy("model").agg(F.count("*").alias("rows"))
    found = codes.union(models.select(F.lit("model").alias("kind"), F.col("model").alias("name"), "rows")).orderBy("kind", F.desc("rows"), "name")
    return [f"unknown {r['kind']} {r['name']}: {r['rows']} rows" for r in found.limit(20).collect()]


def unknown_codes(errors: DataFrame, known: tuple[str, ...] = ERROR_CODES) -> DataFrame:
    return errors.filter(~F.col("error_id").isin(*known)).groupBy("error_id").agg(F.count("*").alias("rows"))


def with_errors(telemetry: DataFrame, errors: DataFrame) -> DataFrame:
    """Telemetry with its error counts, 0 where there are none."""
    return telemetry.join(error_pivot(errors), ["machine_id", "ts"], "left").fillna(0, list(ERROR_CODES))


def error_columns(windows: tuple[int, ...]) -> dict:
    total = reduce(lambda a, b: a + b, map(F.col, ERROR_CODES))
    out = {}
    for w in windows:
        out |= {f"{c}_count_{w}h": F.sum(c).over(_trailing(w)).cast("double") for c in ERROR_CODES}
        out[f"error_count_{w}h"] = F.sum(total).over(_trailing(w)).cast("double")
    return out


def window_features(telemetry: DataFrame, errors: DataFrame, windows: tuple[int, ...]) -> DataFrame:
    rows = _with_micros(with_errors(telemetry, errors))
    made = rows.select("*", *[c.alias(n) for n, c in (rolling_columns(windows) | lag_columns() | error_columns(windows)).items()])
    return made.withColumns(trend_columns(windows)).drop("us", *ERROR_CODES) if len(windows) > 1 else made.drop("us", *ERROR_CODES)


def rolling_features(telemetry: DataFrame, hours: int) -> DataFrame:
    return _with_micros(telemetry).select("machine_id", "ts", *[c.alias(n) for n, c in rolling_columns((hours,)).items()])


def lag_features(telemetry: DataFrame) -> DataFrame:
    return _with_micros(telemetry).select("machine_id", "ts", *[c.alias(n) for n, c in lag_columns().items()])


def trend_features(telemetry: DataFrame, windows: tuple[int, ...]) -> DataFrame:
    means = {rolled(s, "mean", w): F.avg(s).over(_trailing(w)) for s in SENSORS for w in windows}
    return _with_micros(telemetry).withColumns(means).select("machine_id", "ts", *[c.alias(n) for n, c in trend_columns(windows).items()])


def error_count_features(telemetry: DataFrame, errors: DataFrame, windows: tuple[int, ...]) -> DataFrame:
    return _with_micros(with_errors(telemetry, errors)).select("machine_id", "ts", *[c.alias(n) for n, c in error_columns(windows).items()])


def machine_features(grid: DataFrame, machines: DataFrame) -> DataFrame:
    """Age and model indicators; an unknown model has none, an unknown machine has a null age."""
    flags = [(F.col("model") == m).cast("double").alias(f"model_{m}") for m in MODELS]
    known = machines.select("machine_id", F.col("age").cast("double").alias("machine_age"), *[F.coalesce(f, F.lit(0.0)).alias(f"model_{m}") for f, m in zip(flags, MODELS, strict=True)])
    return grid.join(known, "machine_id", "left")


def asof_backward(left: DataFrame, right: DataFrame, by: str, values: list[str], at: str = "ts") -> DataFrame:
    """Adds the values of the last ``right`` row at or before each ``left`` row, exact times included."""
    keep = left.columns
    both = left.withColumns({f"_{v}": F.lit(None).cast(right.schema[v].dataType) for v in values}).withColumn("_side", F.lit(1))
    other = right.select(by, at, *[F.col(v).alias(f"_{v}") for v in values]).withColumn("_side", F.lit(0))
    order = Window.partitionBy(by).orderBy(at, "_side").rowsBetween(Window.unboundedPreceding, 0)
    rows = both.unionByName(other, allowMissingColumns=True)
    hit = F.last(F.when(F.col("_side") == 0, F.struct(*[f"_{v}" for v in values])), ignorenulls=True).over(order)
    return rows.withColumn("_hit", hit).filter("_side = 1").select(*keep, *[F.col(f"_hit._{v}").alias(v) for v in values])


def asof_forward_strict(left: DataFrame, right: DataFrame, by: str, name: str, at: str = "ts") -> DataFrame:
    """Adds ``name``: the time of the first ``right`` row strictly after each ``left`` row."""
    keep = left.columns
    rows = left.withColumn("_side", F.lit(1)).unionByName(right.select(by, at).distinct().withColumn("_side", F.lit(0)), allowMissingColumns=True)
    back = Window.partitionBy(by).orderBy(F.desc(at), F.desc("_side")).rowsBetween(Window.unboundedPreceding, -1)
    hit = F.last(F.when(F.col("_side") == 0, F.col(at)), ignorenulls=True).over(back)
    return rows.withColumn(name, hit).filter("_side = 1").select(*keep, name)


def maintenance_clocks(grid: DataFrame, maint: DataFrame, first_seen: DataFrame | None = None) -> DataFrame:
    """Hours since each component was maintained, and since any was.

    All components in one pass over grid and maintenance. A component without
    maintenance so far counts from the machine's first row, or from
    ``first_seen`` (machine_id, first_seen) where a slice of history is scored.
    """
    keep = grid.columns
    if first_seen is not None:
        grid = grid.join(first_seen, "machine_id", "left")
    else:
        grid = grid.withColumn("first_seen", F.min("ts").over(Window.partitionBy("machine_id")))
    rows = grid.withColumn("_side", F.lit(1)).unionByName(maint.select("machine_id", "ts", F.col("component").alias("_component")).withColumn("_side", F.lit(0)), allowMissingColumns=True)
    order = Window.partitionBy("machine_id").orderBy("ts", "_side").rowsBetween(Window.unboundedPreceding, 0)
    last = {f"_{c}": F.last(F.when(F.col("_component") == c, F.col("ts")), ignorenulls=True).over(order) for c in COMPONENTS}
    rows = rows.select("*", *[v.alias(n) for n, v in last.items()]).filter("_side = 1")
    clocks = [hours_between(F.coalesce(F.col(f"_{c}"), F.col("first_seen")), F.col("ts")) for c in COMPONENTS]
    return rows.select(*keep, *[k.alias(f"hours_since_maint_{c}") for k, c in zip(clocks, COMPONENTS, strict=True)], F.least(*clocks).alias("hours_since_maint_any"))


def drop_warmup(df: DataFrame, hours: int) -> DataFrame:
    """Rows at least ``hours`` after their machine's first."""
    first = F.min("ts").over(Window.partitionBy("machine_id"))
    return df.withColumn("_first", first).filter(hours_between(F.col("_first"), F.col("ts")) >= hours).drop("_first")


def compute_features(tables: dict[str, DataFrame], s: Settings, contract: Contract | None = None) -> DataFrame:
    """Keys and contract columns for every telemetry row after warm-up, as one lazy plan."""
    contract = contract or build_contract(s)
    rows = window_features(tables["telemetry"], tables["errors"], s.window_sizes_hours)
    rows = maintenance_clocks(rows, tables["maint"])
    rows = machine_features(rows, F.broadcast(tables["machines"]) if _small(tables["machines"]) else tables["machines"])
    return contract.project(drop_warmup(rows, s.max_window_hours), ("machine_id", "ts"))


def _small(df: DataFrame, most: int = 8 << 20) -> bool:
    """Whether the optimizer's own estimate of a table is within the broadcast bound."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= most


def scoring_matrix(tables: dict[str, DataFrame], s: Settings, as_of=None, latest_only: bool = False) -> DataFrame:
    """Features on the cadence grid without labels, up to ``as_of``, of each machine's latest tick if asked."""
    rows = compute_features(tables, s).filter(on_cadence(F.col("ts"), s.feature_cadence_hours))
    if as_of is not None:
        rows = rows.filter(F.col("ts") <= F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz"))
    if latest_only:
        last = F.max("ts").over(Window.partitionBy("machine_id"))
        rows = rows.withColumn("_last", last).filter("ts = _last").drop("_last")
    return rows


def training_matrix(tables: dict[str, DataFrame], s: Settings) -> DataFrame:
    """Training rows of the labelled grid with their features."""
    from .labels import label_grid, training_rows

    rows = training_rows(label_grid(tables["telemetry"], tables["failures"], s))
    order = build_contract(s).order
    return rows.join(compute_features(tables, s), ["machine_id", "ts"]).select("machine_id", "ts", "label", "split", *order)
