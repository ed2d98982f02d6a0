"""A small fleet with ramps before failures, for tests of the whole path."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

START = datetime(2015, 1, 1)
MEANS = {"volt": (170, 8), "rotate": (450, 25), "pressure": (100, 5), "vibration": (40, 2.5)}


def fleet(machines: int = 4, days: int = 90, seed: int = 5) -> dict[str, list[tuple]]:
    """Rows of the five tables: hourly readings, failures on days 15, 45 and 75 with vibration rising before them."""
    r = random.Random(seed)
    out: dict[str, list[tuple]] = {"telemetry": [], "errors": [], "maint": [], "failures": [], "machines": []}
    for m in range(1, machines + 1):
        out["machines"].append((m, f"model{m % 4 + 1}", 3 * m))
        failed = [START + timedelta(days=d, hours=6 + m) for d in (15, 45, 75) if d < days]
        out["failures"] += [(m, t, f"comp{k % 4 + 1}") for k, t in enumerate(failed)]
        for h in range(days * 24):
            ts = START + timedelta(hours=h)
            values = [r.gauss(*MEANS[s]) for s in MEANS]
            ahead = min(((t - ts).total_seconds() / 3600 for t in failed if t >= ts), default=99)
            values[3] += 1.5 * max(0, 12 - ahead)
            out["telemetry"].append((m, ts, *values))
            if h % 18 == m % 18:
                out["errors"].append((m, ts, f"error{h % 5 + 1}"))
            if h % 60 == m % 60:
                out["maint"].append((m, ts, f"comp{h // 60 % 4 + 1}"))
    return out


def frames(spark, rows: dict[str, list[tuple]]) -> dict:
    from millwright.sources.schemas import TABLES

    return {name: spark.createDataFrame(rows[name], TABLES[name].schema) for name in TABLES}
