"""Validation of raw tables as a table of issues: (tbl, check, severity, rows, sample)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright.functions.timeutil import HOUR_US, micros_between
from millwright.sources.schemas import RANGES, TABLES

ERROR, WARN = "ERROR", "WARN"
SAMPLES = 5


class ValidationError(ValueError):
    """A table with errors."""


def _issue(counted: DataFrame, table: str, check: str, severity: str) -> DataFrame:
    """One row from (rows, sample) if there are rows."""
    return counted.filter("rows > 0").select(F.lit(table).alias("tbl"), F.lit(check).alias("check"), F.lit(severity).alias("severity"), F.col("rows").cast("long").alias("rows"), F.coalesce("sample", F.lit("")).alias("sample"))


def _sampled(offenders: DataFrame, rows: Column, sample: Column) -> DataFrame:
    """Total of ``rows`` and a few samples, smallest first, without gathering offenders."""
    few = offenders.select(sample.alias("s")).orderBy("s").limit(SAMPLES).agg(F.array_join(F.sort_array(F.collect_list("s")), "; ").alias("sample"))
    return offenders.agg(F.coalesce(F.sum(rows), F.lit(0)).alias("rows")).crossJoin(few)  # one row each


def _text(*columns: str) -> Column:
    return F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns])


def missing_columns(df: DataFrame, table: str) -> list[str]:
    return [f.name for f in TABLES[table].schema if f.name not in df.columns]


def duplicates(df: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Keys that repeat, with how many rows they have."""
    return df.groupBy(*key).agg(F.count("*").alias("rows")).filter("rows > 1")


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls) of columns with nulls; NaN counts as null in doubles."""
    empty = lambda f: F.col(f.name).isNull() | (F.isnan(f.name) if isinstance(f.dataType, T.DoubleType) else F.lit(False))
    sums = df.agg(*[F.count(F.when(empty(f), 1)).alias(f.name) for f in df.schema])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns])
    return sums.select(F.explode(pairs).alias("r")).select("r.*").filter("nulls > 0")


def out_of_range(df: DataFrame) -> DataFrame:
    """(sensor, rows, lowest, highest) of readings outside their plausible range; nulls do not count."""
    made = []
    for s, (lo, hi) in RANGES.items():
        bad = (F.col(s) < lo) | (F.col(s) > hi)
        made += [F.count(F.when(bad, 1)).alias(f"{s}_n"), F.min(F.when(bad, F.col(s))).alias(f"{s}_lo"), F.max(F.when(bad, F.col(s))).alias(f"{s}_hi")]
    pairs = F.array(*[F.struct(F.lit(s).alias("sensor"), F.col(f"{s}_n").alias("rows"), F.col(f"{s}_lo").alias("lowest"), F.col(f"{s}_hi").alias("highest")) for s in RANGES])
    return df.agg(*made).select(F.explode(pairs).alias("r")).select("r.*").filter("rows > 0")


def gaps(df: DataFrame, hours: int = 1) -> DataFrame:
    """Steps between a machine's readings that are longer than ``hours``."""
    before = F.lag("ts").over(Window.partitionBy("machine_id").orderBy("ts"))
    steps = df.select("machine_id", before.alias("from_ts"), F.col("ts").alias("to_ts"))
    us = micros_between(F.col("from_ts"), F.col("to_ts"))
    return steps.withColumn("hours", us / F.lit(float(HOUR_US))).filter(us > hours * HOUR_US)


def unknown_machines(events: DataFrame, machines: DataFrame) -> DataFrame:
    return events.join(machines, "machine_id", "left_anti").groupBy("machine_id").agg(F.count("*").alias("rows"))


def never_failing(machines: DataFrame, failures: DataFrame) -> DataFrame:
    return machines.join(failures, "machine_id", "left_anti").select("machine_id")


def bad_rows(df: DataFrame, table: str, limit: int = 1000) -> DataFrame:
    """Of ``limit`` rows, the same ones on every run, those that break the row rules: ids from 1, ages from 0, readings in range, codes present."""
    rules = {"machine_id": F.col("machine_id") >= 1, "age": F.col("age") >= 0, **{s: F.col(s).between(*r) for s, r in RANGES.items()}}
    ok = reduce(lambda a, b: a & b, [F.coalesce(rules.get(f.name, F.col(f.name).isNotNull()), F.lit(False)) for f in TABLES[table].schema])
    return df.orderBy(F.xxhash64(*df.columns), *TABLES[table].key).limit(limit).filter(~ok)


def validate_table(df: DataFrame, table: str) -> list[DataFrame]:
    if lost := missing_columns(df, table):
        row = df.sparkSession.range(1).select(F.lit(len(lost)).alias("rows"), F.lit(", ".join(lost)).alias("sample"))
        return [_issue(row, table, "required columns", ERROR)]
    key = TABLES[table].key
    nulls = null_counts(df)
    out = [
        _issue(_sampled(duplicates(df, key), F.col("rows"), _text(*key)), table, "duplicate keys", ERROR),
        _issue(_sampled(nulls, F.col("nulls"), _text("column", "nulls")), table, "nulls", ERROR),
    ]
    if "ts" in df.columns:
        out.append(_issue(df.agg(F.count(F.when(F.col("ts").isNull(), 1)).alias("rows"), F.lit("").alias("sample")), table, "unparsed timestamps", ERROR))
    if table == "telemetry":
        out.append(_issue(_sampled(out_of_range(df), F.col("rows"), _text("sensor", "lowest", "highest")), table, "ranges", ERROR))
        out.append(_issue(_sampled(gaps(df), F.lit(1), _text("machine_id", "from_ts")), table, "gaps", WARN))
    return out


def validate_all(tables: dict[str, DataFrame]) -> DataFrame:
    """All issues of all tables and between them."""
    issues = [i for name, df in tables.items() for i in validate_table(df, name)]
    for name in ("telemetry", "errors", "maint", "failures"):
        issues.append(_issue(_sampled(unknown_machines(tables[name], tables["machines"]), F.col("rows"), _text("machine_id")), name, "unknown machines", ERROR))
    issues.append(_issue(_sampled(never_failing(tables["machines"], tables["failures"]), F.lit(1), _text("machine_id")), "failures", "machines without failures", WARN))
    lost = tables["errors"].join(tables["telemetry"].select("machine_id", "ts"), ["machine_id", "ts"], "left_anti")
    issues.append(_issue(_sampled(lost, F.lit(1), _text("machine_id", "ts", "error_id")), "errors", "errors between readings", WARN))
    return reduce(DataFrame.unionByName, issues)


def raise_for_errors(issues: DataFrame) -> None:
    if bad := issues.filter(F.col("severity") == ERROR).collect():
        raise ValidationError("; ".join(f"{r['tbl']}: {r['check']} ({r['rows']})" for r in bad))
