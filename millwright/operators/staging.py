"""Typed, de-duplicated staging of the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millwright.functions.contract import SENSORS
from millwright.sources.schemas import TABLES


def one_per_key(df: DataFrame, key: tuple[str, ...], prefer: tuple[str, ...] = ()) -> DataFrame:
    """One row per key: the smallest by the ``prefer`` columns, nulls first, so reruns agree."""
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*(prefer or key)))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def stage_telemetry(raw: DataFrame) -> DataFrame:
    fields = TABLES["telemetry"].schema
    return one_per_key(raw.select(*[F.col(f.name).cast(f.dataType) for f in fields]), ("machine_id", "ts"), SENSORS)


def stage_events(raw: DataFrame, table: str) -> DataFrame:
    return raw.select(*[F.col(f.name).cast(f.dataType) for f in TABLES[table].schema]).distinct()


def stage_machines(raw: DataFrame) -> DataFrame:
    fields = TABLES["machines"].schema
    return one_per_key(raw.select(*[F.col(f.name).cast(f.dataType) for f in fields]), ("machine_id",), ("model", "age"))


def stage(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All five tables, lazily; register them as views to use them from SQL."""
    return {
        "telemetry": stage_telemetry(raw["telemetry"]),
        **{t: stage_events(raw[t], t) for t in ("errors", "maint", "failures")},
        "machines": stage_machines(raw["machines"]),
    }
