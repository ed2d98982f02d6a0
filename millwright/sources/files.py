"""Readers and writers of the pipeline's folders."""

from __future__ import annotations

import json
import re
import uuid
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millwright.functions.contract import Contract
from millwright.functions.timeutil import day_key
from millwright.settings import Settings

from .schemas import TABLES, RawTable


class SourceError(ValueError):
    """A source that lacks a column or cannot be used."""


#: Content types of payloads.
JSON_LINES, JSON, CSV = "application/jsonlines", "application/json", "text/csv"
_SQL_PART = re.compile(r"'(?:[^']|'')*'|\"(?:[^\"]|\"\")*\"|`[^`]*`|--[^\n]*|/\*.*?\*/|;", re.S)

#: Fixed value: how the landing files write times.
LANDING_TIME = "M/d/yyyy h:mm:ss a"


def landing_time(text: Column) -> Column:
    """A landing time; rows in another form fall back to ISO, and to null. Row by row, never by column."""
    return F.coalesce(F.try_to_timestamp(text, F.lit(LANDING_TIME)), F.try_to_timestamp(text)).cast("timestamp_ntz")


def typed(df: DataFrame, table: RawTable) -> DataFrame:
    """Landing columns renamed, trimmed and cast; other columns are dropped, missing ones are errors."""
    if lost := [c for c in table.columns if c not in df.columns]:
        raise SourceError(f"{table.name}: missing columns {lost}")
    out = []
    for source, (name, kind) in table.columns.items():
        text = F.trim(F.col(f"`{source}`").cast("string"))
        out.append((landing_time(text) if isinstance(kind, T.TimestampNTZType) else text.try_cast(kind)).alias(name))
    return df.select(*out)


def read_landing(spark: SparkSession, folder: str, table: str) -> DataFrame:
    t = TABLES[table]
    return typed(spark.read.option("header", True).csv(f"{folder.rstrip('/')}/{t.file}"), t)


def write_table(df: DataFrame, folder: str, table: str) -> str:
    """Replaces a table; telemetry is partitioned by day, one file per day, other tables are in files by key range."""
    path = f"{folder.rstrip('/')}/{table}"
    if TABLES[table].partitioned:
        out = df.withColumn("dt", day_key(F.col("ts"))).repartition("dt").sortWithinPartitions("dt", *TABLES[table].key)
        out.write.mode("overwrite").partitionBy("dt").parquet(path)
    else:
        df.repartitionByRange(*TABLES[table].key).sortWithinPartitions(*TABLES[table].key).write.mode("overwrite").parquet(path)
    return path


def read_table(spark: SparkSession, folder: str, table: str, since: datetime | None = None) -> DataFrame:
    """A stored table without its partition column; ``since`` prunes telemetry days."""
    t = TABLES[table]
    if not t.partitioned:
        return spark.read.schema(t.schema).parquet(f"{folder.rstrip('/')}/{table}")
    stored = spark.read.schema(T.StructType([*t.schema.fields, T.StructField("dt", T.StringType())])).parquet(f"{folder.rstrip('/')}/{table}")
    if since is not None:
        stored = stored.filter((F.col("dt") >= since.date().isoformat()) & (F.col("ts") >= F.lit(since.isoformat(sep=" ")).cast("timestamp_ntz")))
    return stored.drop("dt")


def read_all(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: read_table(spark, folder, name) for name in TABLES}


def register(tables: dict[str, DataFrame], prefix: str = "raw_") -> None:
    """Temporary views over stored or in-memory tables."""
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)


def params(spark: SparkSession, s: Settings) -> DataFrame:
    """The problem definition as a relation of one row."""
    row = (s.prediction_horizon_hours, s.feature_cadence_hours, s.post_failure_exclusion_hours, s.train_end_ts, s.val_start_ts, s.val_end_ts, s.test_start_ts)
    return spark.createDataFrame([row], "horizon_hours int, cadence_hours int, exclusion_hours int, train_end_ts timestamp_ntz, val_start_ts timestamp_ntz, val_end_ts timestamp_ntz, test_start_ts timestamp_ntz")


def write_by_split(df: DataFrame, path: str) -> None:
    df.repartitionByRange("split", "machine_id", "ts").sortWithinPartitions("split", "machine_id", "ts").write.mode("overwrite").partitionBy("split").parquet(path)


def write_matrix(matrix: DataFrame, path: str, contract: Contract) -> dict:
    """The training matrix by split, and a manifest beside it; returns the manifest."""
    write_by_split(matrix, f"{path}/matrix")
    stored = matrix.sparkSession.read.parquet(f"{path}/matrix")
    bounds = [(r["split"], r["rows"], r["positives"], str(r["first"]), str(r["last"])) for r in stored.groupBy("split").agg(F.count("*").alias("rows"), F.sum("label").alias("positives"), F.min("ts").alias("first"), F.max("ts").alias("last")).orderBy("split").collect()]
    manifest = {"feature_hash": contract.hash, "feature_order": list(contract.order), "windows": list(contract.windows), "splits": {s: {"rows": n, "positives": int(p), "first": a, "last": b} for s, n, p, a, b in bounds}}
    write_json(manifest, f"{path}/manifest.json")
    return manifest


def read_matrix(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    return spark.read.parquet(f"{path}/matrix"), read_json(f"{path}/manifest.json")


def _at(path: str):
    """(JVM, file system, path) of a URI that Spark can reach; a path without a scheme is of the default store."""
    spark = SparkSession.active()
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(path: str) -> bool:
    _, fs, at = _at(path)
    return fs.exists(at)


def write_json(value: object, path: str) -> None:
    """A small document beside the tables; written under another name first, so that no reader sees half of it."""
    jvm, fs, at = _at(path)
    half = jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{at.getName()}.{uuid.uuid4().hex}")
    out = fs.create(half, True)
    try:
        out.write(bytearray(json.dumps(value, indent=1, default=str).encode()))
    finally:
        out.close()
    if fs.exists(at):
        fs.delete(at, False)
    if not fs.rename(half, at):
        raise OSError(f"cannot write {path}")


def read_json(path: str) -> dict:
    jvm, fs, at = _at(path)
    if not fs.exists(at):
        raise FileNotFoundError(path)
    source = fs.open(at)
    try:
        return json.loads(bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode())
    finally:
        source.close()


def append_jsonl(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("append").json(path)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).json(path)


def write_scores(scores: DataFrame, path: str, run: dict) -> None:
    """Adds a scoring run under the day of its ``scored_at``; array columns become text."""
    flat = scores.withColumn("top_drivers", F.array_join("top_drivers", ",")) if "top_drivers" in scores.columns else scores
    flat.withColumn("dt", day_key(F.col("scored_at"))).repartition("dt", "machine_id").write.mode("append").partitionBy("dt").parquet(path)
    at = datetime.now(UTC)
    write_json(run | {"written_at": at.isoformat()}, f"{path}/_runs/{at:%Y-%m-%d}/{at:%H%M%S}-{uuid.uuid4().hex[:8]}.json")


class ScriptError(ValueError):
    """A script that cannot be run."""


def statements(script: str) -> list[str]:
    """The statements of a SQL script; semicolons in quotes and comments do not end one."""
    out, own, at = [], [], 0
    for m in _SQL_PART.finditer(script):
        own.append(script[at : m.start()])
        at = m.end()
        if m[0] == ";":
            out.append("".join(own))
            own = []
        elif m[0][:2] not in ("--", "/*"):
            own.append(m[0])
        else:
            own.append(" ")
    return [x.strip() for x in [*out, "".join(own) + script[at:]] if x.strip()]


def run_script(spark: SparkSession, path: str, values: dict[str, object] | None = None) -> DataFrame | None:
    """Runs the statements of a stored SQL script in order and returns the last one's rows.

    ``:name`` in a statement takes its value from ``values``.
    """
    text = "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
    found, last = statements(text), None
    if not found:
        raise ScriptError(f"{path} holds no statement")
    for statement in found:
        named = {k: v for k, v in (values or {}).items() if re.search(rf":{k}\b", statement)}
        last = spark.sql(statement, args=named) if named else spark.sql(statement)
    return last


def encode_results(rows: DataFrame, content_type: str = JSON_LINES) -> DataFrame:
    """Results as lines of text in a content type: JSON lines, or CSV without a header."""
    if content_type == JSON_LINES:
        return rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value"))
    if content_type == CSV:
        return rows.select(F.to_csv(F.struct(*rows.columns)).alias("value"))
    raise SourceError(f"cannot write {content_type}; known are {JSON_LINES} and {CSV}")


def decode_batch(spark: SparkSession, path: str, schema: T.StructType, content_type: str = JSON_LINES) -> DataFrame:
    """A scoring batch from a folder in a content type; JSON may be lines or one document of columns and rows."""
    if content_type == CSV:
        return read_csv_payload(spark, path, schema)
    if content_type == JSON_LINES:
        return decode_payload(spark.read.text(path), schema)
    if content_type == JSON:
        whole = spark.read.text(path, wholetext=True).select(F.from_json("value", "columns array<string>, data array<array<string>>", {"mode": "FAILFAST"}).alias("r")).select("r.*")
        names = [r[0] for r in whole.select("columns").distinct().collect()]
        if any(sorted(n or []) != sorted(schema.names) for n in names):
            raise SourceError(f"payload needs the columns {schema.names}, found {names}")
        rows = whole.select("columns", F.explode("data").alias("row"))
        value = lambda f: F.element_at("row", F.array_position("columns", f.name).cast("int"))
        return rows.select(*[value(f).cast(f.dataType).alias(f.name) for f in schema])
    raise SourceError(f"cannot read {content_type}; known are {JSON_LINES}, {JSON} and {CSV}")


def read_scores(spark: SparkSession, path: str, since: datetime | None = None) -> DataFrame:
    df = spark.read.option("mergeSchema", True).parquet(path)
    if since is not None:
        df = df.filter((F.col("dt") >= F.lit(since.date().isoformat()).cast("date")) & (F.col("scored_at") >= F.lit(since.isoformat(sep=" ")).cast("timestamp_ntz")))
    return df.drop("dt")


def encode_payload(batch: DataFrame, contract_columns: list[str] | tuple[str, ...]) -> DataFrame:
    """One JSON line per row of a scoring batch, keys first, then features in order."""
    keys = [c for c in ("machine_id", "ts") if c in batch.columns]
    return batch.select(F.to_json(F.struct(*keys, *contract_columns), {"ignoreNullFields": "false"}).alias("value"))


def decode_payload(lines: DataFrame, schema: T.StructType) -> DataFrame:
    return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def read_csv_payload(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A scoring batch as CSV; the header must name exactly the schema's columns."""
    head = spark.read.text(path).limit(1).collect()
    names = head[0][0].strip().split(",") if head else []
    if sorted(names) != sorted(schema.names):
        raise SourceError(f"CSV needs a header with {schema.names}, found {names}")
    return spark.read.option("header", True).schema(T.StructType([schema[n] for n in names])).csv(path).select(*schema.names)


def publish(rows: DataFrame, client_factory, topic: str) -> None:
    """Sends each work order to a topic; ``client_factory`` makes a client once per partition."""

    def send(part) -> None:
        client = None
        for row in part:
            client = client or client_factory()
            client.publish(TopicArn=topic, Subject=f"{row['priority']} machine {row['machine_id']}"[:100], Message=json.dumps(row.asDict(), default=str))

    rows.foreachPartition(send)
