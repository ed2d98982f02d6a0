"""Raw to curated tables: types, null keys, duplicates, implausible readings, partitions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.functions.contract import SENSORS
from millwright.functions.timeutil import day_key
from millwright.sources.schemas import RANGES, TABLES

from .staging import one_per_key


def flag_out_of_range(df: DataFrame) -> DataFrame:
    """Implausible readings become null; ``had_out_of_range`` is taken from the readings as they came."""
    bad = {s: F.coalesce((F.col(s) < lo) | (F.col(s) > hi), F.lit(False)) for s, (lo, hi) in RANGES.items()}
    flagged = df.withColumn("had_out_of_range", reduce(lambda a, b: a | b, bad.values()))
    return flagged.withColumns({s: F.when(~b, F.col(s)) for s, b in bad.items()})


def add_day(df: DataFrame) -> DataFrame:
    return df.withColumn("dt", day_key(F.col("ts")))


def _typed(df: DataFrame, table: str) -> DataFrame:
    return df.select(*[(F.trim(f.name) if f.dataType.typeName() == "string" else F.col(f.name).cast(f.dataType)).alias(f.name) for f in TABLES[table].schema])


def curate_telemetry(raw: DataFrame) -> DataFrame:
    rows = _typed(raw, "telemetry").filter("machine_id is not null and ts is not null")
    return add_day(flag_out_of_range(one_per_key(rows, ("machine_id", "ts"), SENSORS)))


def curate_events(raw: DataFrame, table: str) -> DataFrame:
    code = TABLES[table].key[-1]
    rows = _typed(raw, table).filter("machine_id is not null and ts is not null")
    return add_day(rows.dropDuplicates(["machine_id", "ts", code]))


def curate_machines(raw: DataFrame) -> DataFrame:
    rows = _typed(raw, "machines")
    return one_per_key(rows, ("machine_id",), ("model", "age"))


def curate_all(spark: SparkSession, raw: dict[str, DataFrame], folder: str) -> dict[str, int]:
    """Writes the curated tables and returns their rows, counted from the files' footers."""
    made = {"telemetry": curate_telemetry(raw["telemetry"]), "machines": curate_machines(raw["machines"]), **{t: curate_events(raw[t], t) for t in ("errors", "maint", "failures")}}
    counts = {}
    for name, df in made.items():
        path = f"{folder.rstrip('/')}/{name}"
        if name == "telemetry":
            df.repartition("dt").write.mode("overwrite").partitionBy("dt").parquet(path)
        else:
            df.repartitionByRange("machine_id").write.mode("overwrite").parquet(path)
        counts[name] = spark.read.parquet(path).count()
    return counts
