"""The five raw tables: schemas, landing names, keys, plausible ranges."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

#: Plausible ranges of the sensors.
RANGES = {"volt": (0.0, 400.0), "rotate": (0.0, 1200.0), "pressure": (0.0, 400.0), "vibration": (0.0, 200.0)}


@dataclass(frozen=True)
class RawTable:
    """``columns`` maps a landing name to (name, type); ``key`` identifies a row."""

    name: str
    file: str
    columns: dict[str, tuple[str, T.DataType]]
    key: tuple[str, ...]
    partitioned: bool = False

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, k) for n, k in self.columns.values()])


_ID, _TS, _S, _D = T.IntegerType(), T.TimestampNTZType(), T.StringType(), T.DoubleType()

TABLES = {
    t.name: t
    for t in (
        RawTable("telemetry", "PdM_telemetry.csv", {"machineID": ("machine_id", _ID), "datetime": ("ts", _TS), "volt": ("volt", _D), "rotate": ("rotate", _D), "pressure": ("pressure", _D), "vibration": ("vibration", _D)}, ("machine_id", "ts"), True),
        RawTable("errors", "PdM_errors.csv", {"machineID": ("machine_id", _ID), "datetime": ("ts", _TS), "errorID": ("error_id", _S)}, ("machine_id", "ts", "error_id")),
        RawTable("maint", "PdM_maint.csv", {"machineID": ("machine_id", _ID), "datetime": ("ts", _TS), "comp": ("component", _S)}, ("machine_id", "ts", "component")),
        RawTable("failures", "PdM_failures.csv", {"machineID": ("machine_id", _ID), "datetime": ("ts", _TS), "failure": ("component", _S)}, ("machine_id", "ts", "component")),
        RawTable("machines", "PdM_machines.csv", {"machineID": ("machine_id", _ID), "model": ("model", _S), "age": ("age", _ID)}, ("machine_id",)),
    )
}
