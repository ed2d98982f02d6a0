"""The five domain tables over the generic event and order tables.

An hour of a user's events is a telemetry reading of a machine. A second,
heavier telemetry comes from order lines, a supplier's day being a reading.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millwright.functions.timeutil import floor_hour
from millwright.settings import Settings

#: Events as error codes.
EVENT_ERRORS = {"click": "error1", "error": "error2", "purchase": "error3", "signup": "error4", "view": "error5"}

SETTINGS = Settings(train_end=date(2024, 1, 16), val_end=date(2024, 1, 23))
LINE_SETTINGS = Settings(train_end=date(1998, 12, 31), val_end=date(2000, 6, 30), window_sizes_hours=(72, 288, 576))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/events.parquet")
    k = F.get_json_object("props", "$.k").cast("int")
    return df.select(F.col("user_id").cast("int").alias("machine_id"), F.col("ts").cast("timestamp_ntz").alias("at"), "event_type", "value", k.alias("k")).withColumn("ts", floor_hour(F.col("at")))


def _component(k: Column) -> Column:
    return F.concat(F.lit("comp"), (k % 4 + 1).cast("string"))


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).groupBy("machine_id", "ts").agg(F.avg("value").alias("volt"), F.max("value").alias("rotate"), F.avg(F.col("k").cast("double")).alias("pressure"), F.sum("value").alias("vibration"))


def errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.element_at(F.create_map(*[F.lit(x) for pair in EVENT_ERRORS.items() for x in pair]), F.col("event_type"))
    return events(spark, sf_dir).select("machine_id", "ts", code.alias("error_id"))


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).filter("event_type = 'error' and value > 120").select("machine_id", "ts", _component(F.col("k")).alias("component"))


def maint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).filter("event_type = 'signup'").select("machine_id", "ts", _component(F.col("k")).alias("component"))


def machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = events(spark, sf_dir).select("machine_id").distinct()
    return ids.select("machine_id", F.concat(F.lit("model"), (F.col("machine_id") % 4 + 1).cast("string")).alias("model"), (F.col("machine_id") % 20).alias("age"))


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {f.__name__: f(spark, sf_dir) for f in (telemetry, errors, maint, failures, machines)}


def line_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line, so with repeated keys."""
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return df.select(F.col("l_suppkey").cast("int").alias("machine_id"), F.col("l_shipdate").cast("timestamp_ntz").alias("ts"), F.col("l_quantity").alias("volt"), F.col("l_extendedprice").alias("rotate"), F.col("l_discount").alias("pressure"), F.col("l_tax").alias("vibration"))
