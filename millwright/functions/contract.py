"""The feature contract: which columns, in which order, under which hash."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.settings import Settings

#: Vocabularies of the domain and statistics of the features.
SENSORS = ("volt", "rotate", "pressure", "vibration")
ERROR_CODES = ("error1", "error2", "error3", "error4", "error5")
COMPONENTS = ("comp1", "comp2", "comp3", "comp4")
MODELS = ("model1", "model2", "model3", "model4")
STATS = ("mean", "std", "min", "max")
LAGS = (1, 3, 12)


class ContractError(ValueError):
    """Columns that do not keep the contract."""


def rolled(sensor: str, stat: str, hours: int) -> str:
    return f"{sensor}_{stat}_{hours}h"


def trend_name(sensor: str, windows: tuple[int, ...]) -> str | None:
    """The trend column of a sensor; None with a single window."""
    return f"{sensor}_mean_delta_{min(windows)}h_{max(windows)}h" if len(windows) > 1 else None


def feature_order(windows: tuple[int, ...]) -> list[str]:
    """Readings; per sensor statistics, trend, lags; error counts per window; machine and clocks."""
    per_sensor = [
        [rolled(s, stat, w) for w in windows for stat in STATS] + ([t] if (t := trend_name(s, windows)) else []) + [f"{s}_lag_{k}" for k in LAGS]
        for s in SENSORS
    ]
    errors = [[f"{code}_count_{w}h" for code in ERROR_CODES] + [f"error_count_{w}h"] for w in windows]
    machine = ["machine_age", *[f"model_{m}" for m in MODELS], *[f"hours_since_maint_{c}" for c in (*COMPONENTS, "any")]]
    return [*SENSORS, *sum(per_sensor, []), *sum(errors, []), *machine]


def order_hash(order: list[str] | tuple[str, ...]) -> str:
    return hashlib.sha256("|".join(order).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Contract:
    windows: tuple[int, ...]
    order: tuple[str, ...]

    @property
    def hash(self) -> str:
        return order_hash(self.order)

    def missing(self, df: DataFrame) -> list[str]:
        return [c for c in self.order if c not in df.columns]

    def unexpected(self, df: DataFrame, besides: tuple[str, ...] = ()) -> list[str]:
        return [c for c in df.columns if c not in self.order and c not in besides]

    def project(self, df: DataFrame, keys: tuple[str, ...] = (), strict: bool = False) -> DataFrame:
        """Keys and features in order, as doubles; raises on missing, and if strict on extra, columns."""
        if lost := self.missing(df):
            raise ContractError(f"missing features: {lost}")
        if strict and (extra := self.unexpected(df, keys)):
            raise ContractError(f"unexpected columns: {extra}")
        return df.select(*keys, *[F.col(c).cast("double").alias(c) for c in self.order])

    def guard(self, df: DataFrame, declared: str, model: str) -> None:
        """The hashes declared with the data, observed in it and known to the model must agree."""
        observed = order_hash([c for c in df.columns if c in set(self.order)])
        if not declared == observed == model:
            raise ContractError(f"feature hash: declared {declared}, observed {observed}, model {model}")


def build_contract(settings: Settings) -> Contract:
    return Contract(settings.window_sizes_hours, tuple(feature_order(settings.window_sizes_hours)))


def broken(c: str) -> Column:
    """Whether a feature is null, NaN or infinite."""
    x = F.col(c)
    return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))


def incomplete_rows(order: list[str] | tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [broken(c) for c in order])


def completeness(df: DataFrame, order: list[str] | tuple[str, ...]) -> DataFrame:
    """One row: how many values of each feature are null, NaN or infinite."""
    return df.agg(*[F.count(F.when(broken(c), 1)).alias(c) for c in order])


def assert_complete(df: DataFrame, order: list[str] | tuple[str, ...]) -> None:
    row = completeness(df, order).first().asDict()
    if bad := {c: n for c, n in row.items() if n}:
        raise ContractError(f"incomplete features: {bad}")
