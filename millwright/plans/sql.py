"""SQL twins of the catalogue for DuckDB, on the same generic tables."""

from __future__ import annotations

from millwright.functions.contract import COMPONENTS, ERROR_CODES, LAGS, MODELS, SENSORS, feature_order, rolled, trend_name
from millwright.sources.adapters import EVENT_ERRORS, LINE_SETTINGS, SETTINGS
from millwright.sources.schemas import RANGES

WINDOWS = SETTINGS.window_sizes_hours
HOUR = 3_600_000_000

#: First date of the payloads' round trip.
PAYLOAD_TS = "2024-01-25 00:00:00"
_CODES = " ".join(f"WHEN '{e}' THEN '{c}'" for e, c in EVENT_ERRORS.items())
_RELATIONS = {
    "ev": r"""SELECT user_id::INT AS machine_id, ts AS at, date_trunc('hour', ts)::TIMESTAMP AS ts, event_type, value,
        regexp_extract(props, '"k":\s*(-?\d+)', 1)::INT AS k FROM events""",
    "telemetry": "SELECT machine_id, ts, avg(value) AS volt, max(value) AS rotate, avg(k::DOUBLE) AS pressure, sum(value) AS vibration FROM ev GROUP BY ALL",
    "errors": f"SELECT machine_id, ts, CASE event_type {_CODES} END AS error_id FROM ev",
    "failures": "SELECT machine_id, ts, 'comp' || (k % 4 + 1) AS component FROM ev WHERE event_type = 'error' AND value > 120",
    "maint": "SELECT machine_id, ts, 'comp' || (k % 4 + 1) AS component FROM ev WHERE event_type = 'signup'",
    "machines": "SELECT DISTINCT machine_id, 'model' || (machine_id % 4 + 1) AS model, machine_id % 20 AS age FROM ev",
    "lines": """SELECT l_suppkey::INT AS machine_id, l_shipdate::TIMESTAMP AS ts, l_quantity AS volt, l_extendedprice AS rotate,
        l_discount AS pressure, l_tax AS vibration FROM lineitem""",
    "grid": f"SELECT machine_id, ts FROM telemetry WHERE minute(ts) = 0 AND second(ts) = 0 AND (epoch_us(ts) // {HOUR}) % {SETTINGS.feature_cadence_hours} = 0",
    "context": """SELECT g.machine_id, g.ts, min(CASE WHEN f.ts > g.ts THEN f.ts END) AS next_failure_ts, max(CASE WHEN f.ts <= g.ts THEN f.ts END) AS last_failure_ts
        FROM grid g LEFT JOIN (SELECT DISTINCT machine_id, ts FROM failures) f USING (machine_id) GROUP BY ALL""",
    "lab": f"""SELECT machine_id, ts,
        CASE WHEN epoch_us(next_failure_ts) - epoch_us(ts) <= {SETTINGS.prediction_horizon_hours * HOUR} THEN 1 ELSE 0 END AS label, next_failure_ts, last_failure_ts,
        coalesce(epoch_us(ts) - epoch_us(last_failure_ts) <= {SETTINGS.post_failure_exclusion_hours * HOUR}, FALSE) AS excluded,
        epoch_us((SELECT max(ts) FROM telemetry)) - epoch_us(ts) >= {SETTINGS.prediction_horizon_hours * HOUR} AS labelable,
        CASE WHEN ts < TIMESTAMP '{SETTINGS.train_end_ts}' THEN 'train'
             WHEN ts >= TIMESTAMP '{SETTINGS.val_start_ts}' AND ts < TIMESTAMP '{SETTINGS.val_end_ts}' THEN 'val'
             WHEN ts >= TIMESTAMP '{SETTINGS.test_start_ts}' THEN 'test' ELSE 'gap' END AS split FROM context""",
    "kept": "SELECT machine_id, ts, label, split FROM lab WHERE NOT excluded AND labelable AND split <> 'gap'",
    "by_component": f"""SELECT l.machine_id, l.ts, l.split, c.component,
        max(CASE WHEN f.ts > l.ts AND epoch_us(f.ts) - epoch_us(l.ts) <= {SETTINGS.prediction_horizon_hours * HOUR} THEN 1 ELSE 0 END) AS label
        FROM kept l CROSS JOIN (SELECT DISTINCT component FROM failures) c LEFT JOIN failures f ON f.machine_id = l.machine_id AND f.component = c.component GROUP BY ALL""",
    "pivoted": "SELECT machine_id, ts, " + ", ".join(f"count(*) FILTER (error_id = '{c}') AS {c}" for c in ERROR_CODES) + " FROM errors GROUP BY ALL",
    "counted": "SELECT t.*, epoch_us(t.ts) AS us, " + ", ".join(f"coalesce({c}, 0) AS {c}" for c in ERROR_CODES) + " FROM telemetry t LEFT JOIN pivoted USING (machine_id, ts)",
}


def with_(*names: str) -> str:
    """A WITH clause of relations, in dependency order."""
    return "WITH " + ",\n".join(f"{n} AS ({_RELATIONS[n]})" for n in _RELATIONS if n in names) + "\n"


_LABELS = ("ev", "telemetry", "failures", "grid", "context", "lab", "kept")
_FUNCTION = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}


def _frame(hours: int) -> str:
    return f"(PARTITION BY machine_id ORDER BY us RANGE BETWEEN {hours * HOUR - 1} PRECEDING AND CURRENT ROW)"


def _rolling(windows) -> dict[str, str]:
    return {rolled(s, st, w): f"{f}({s}) OVER {_frame(w)}" for s in SENSORS for w in windows for st, f in _FUNCTION.items()}


def _trend(windows) -> dict[str, str]:
    return {trend_name(s, windows): f"avg({s}) OVER {_frame(min(windows))} - avg({s}) OVER {_frame(max(windows))}" for s in SENSORS}


def _lags() -> dict[str, str]:
    return {f"{s}_lag_{k}": f"lag({s}, {k}) OVER (PARTITION BY machine_id ORDER BY us)" for s in SENSORS for k in LAGS}


def _errors(windows) -> dict[str, str]:
    out = {}
    for w in windows:
        out |= {f"{c}_count_{w}h": f"(sum({c}) OVER {_frame(w)})::DOUBLE" for c in ERROR_CODES}
        out[f"error_count_{w}h"] = f"(sum({' + '.join(ERROR_CODES)}) OVER {_frame(w)})::DOUBLE"
    return out


def _select(columns: dict[str, str], source: str, digits: int = 6) -> str:
    return "SELECT machine_id, ts, " + ", ".join(f"round({x}, {digits}) AS {n}" for n, x in columns.items()) + f" FROM {source}"


def _clocks(source: str) -> str:
    """Hours since maintenance per component by as-of joins."""
    joins = " ".join(f"ASOF LEFT JOIN (SELECT * FROM maint WHERE component = '{c}') m{i} ON g.machine_id = m{i}.machine_id AND g.ts >= m{i}.ts" for i, c in enumerate(COMPONENTS))
    hours = {c: f"(epoch_us(g.ts) - epoch_us(coalesce(m{i}.ts, g.first_seen))) / {float(HOUR)}" for i, c in enumerate(COMPONENTS)}
    listed = ", ".join(f"{x} AS hours_since_maint_{c}" for c, x in hours.items())
    return f"SELECT g.machine_id, g.ts, {listed}, least({', '.join(hours.values())}) AS hours_since_maint_any FROM (SELECT *, min(ts) OVER (PARTITION BY machine_id) AS first_seen FROM {source}) g {joins}"


_WIDE = {**{s: s for s in SENSORS}, **_rolling(WINDOWS), **_trend(WINDOWS), **_lags(), **_errors(WINDOWS)}
_STATIC = {"machine_age": "age::DOUBLE", **{f"model_{m}": f"(model = '{m}')::INT::DOUBLE" for m in MODELS}, **{f"hours_since_maint_{c}": f"hours_since_maint_{c}" for c in (*COMPONENTS, "any")}}
_FEATURES = (
    with_("ev", "telemetry", "errors", "failures", "maint", "machines", "grid", "context", "lab", "kept", "pivoted", "counted")
    + f", clocks AS ({_clocks('telemetry')}), wide AS (SELECT machine_id, ts, us, min(ts) OVER (PARTITION BY machine_id) AS first_ts, {', '.join(f'{x} AS {n}' for n, x in _WIDE.items())} FROM counted)"
    + f", features AS (SELECT machine_id, ts, {', '.join(f'round({_STATIC.get(n, n)}, 6) AS {n}' for n in feature_order(WINDOWS))} FROM wide JOIN clocks USING (machine_id, ts) JOIN machines USING (machine_id) WHERE us - epoch_us(first_ts) >= {max(WINDOWS) * HOUR})\n"
)
_ON_CADENCE = f"minute(ts) = 0 AND second(ts) = 0 AND (epoch_us(ts) // {HOUR}) % {SETTINGS.feature_cadence_hours} = 0"
_ANY_BROKEN = " OR ".join(f"{n} IS NULL" for n in feature_order(WINDOWS))

#: Training rows with the rules model's score to three digits.
_SCORED = (
    with_(*_LABELS)
    + f""", std AS (SELECT machine_id, ts, stddev_samp(vibration) OVER (PARTITION BY machine_id ORDER BY epoch_us(ts) RANGE BETWEEN {24 * HOUR - 1} PRECEDING AND CURRENT ROW) AS x FROM telemetry),
x AS (SELECT * FROM kept JOIN std USING (machine_id, ts) WHERE x IS NOT NULL),
cut AS (SELECT quantile_cont(x, 0.99) AS c FROM x WHERE split = 'train'),
scored AS (SELECT machine_id, ts, label, split, round(1 / (1 + exp(-(x - c) / greatest(abs(c), 1e-9))), 3) AS score FROM x, cut)
"""
)
_CURVE = """, s AS (SELECT score, label FROM scored WHERE split = 'val'),
u AS (SELECT score, count(*) AS n, sum(label) AS p FROM s GROUP BY 1 UNION ALL SELECT max(score) + abs(max(score)) * pow(2, -52), 0, 0 FROM s),
curve AS (SELECT score AS threshold, (sum(n) OVER w)::BIGINT AS flagged, (sum(p) OVER w)::BIGINT AS true_positives, (sum(n) OVER ())::BIGINT AS all_n, (sum(p) OVER ())::BIGINT AS all_p
  FROM u WINDOW w AS (ORDER BY score DESC)),
points AS (SELECT threshold, flagged, true_positives, flagged - true_positives AS false_positives, all_n - all_p - (flagged - true_positives) AS true_negatives, all_p - true_positives AS false_negatives,
  round(coalesce(true_positives / nullif(all_p, 0)::DOUBLE, 0), 9) AS recall, round(coalesce(true_positives / nullif(flagged, 0)::DOUBLE, 0), 9) AS precision,
  round(coalesce((flagged - true_positives) / nullif(all_n - all_p, 0)::DOUBLE, 0), 9) AS false_alarm_rate,
  250.0::DOUBLE * (flagged - true_positives) + 10000.0::DOUBLE * (all_p - true_positives) AS expected_cost,
  round((flagged - true_positives) / (150 * 144.0::DOUBLE / 730), 9) AS alarms_per_machine_month FROM curve)
"""
_RANK = """SELECT round(sum(p * tp / f) / sum(p), 9) AS pr_auc, round(sum((n - p) * (tp - p / 2.0::DOUBLE)) / (sum(p) * sum(n - p)), 9) AS roc_auc, round(sum(p) / sum(n), 9) AS base_rate
FROM (SELECT n::DOUBLE AS n, p::DOUBLE AS p, (sum(n) OVER w)::DOUBLE AS f, (sum(p) OVER w)::DOUBLE AS tp FROM (SELECT score, count(*) AS n, sum(label) AS p FROM {source} GROUP BY 1) WINDOW w AS (ORDER BY score DESC))"""
_BALANCE = "count(*) AS rows, sum(label)::BIGINT AS positives, min(ts) AS first_ts, max(ts) AS last_ts, count(DISTINCT machine_id) AS machines, round(avg(label), 9) AS positive_rate"
_BANDED = "scores AS (SELECT machine_id, ts, ts AS scored_at, 24 AS horizon_hours, score AS probability, 0.45::DOUBLE AS threshold, CASE WHEN score >= 0.45 THEN 'act' WHEN score >= 0.225 THEN 'watch' ELSE 'ok' END AS decision FROM scored)"
_BAD = {s: f"coalesce({s} < {lo} OR {s} > {hi}, FALSE)" for s, (lo, hi) in RANGES.items()}
_ISSUE_ORDER = "ORDER BY volt NULLS FIRST, rotate NULLS FIRST, pressure NULLS FIRST, vibration NULLS FIRST"
_LINE_ONE = f"one AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY machine_id, ts {_ISSUE_ORDER}) AS rn FROM lines) WHERE rn = 1)"


def _psi(features) -> str:
    parts = " UNION ALL ".join(f"SELECT '{f}' AS feature, split, {f}::DOUBLE AS v FROM t" for f in features)
    cuts = ", ".join(str(i / 10) for i in range(1, 10))
    return (
        with_(*_LABELS)
        + f""", t AS (SELECT split, telemetry.* FROM kept JOIN telemetry USING (machine_id, ts)), v AS ({parts}),
cuts AS (SELECT feature, list_sort(list_distinct(quantile_cont(v, [{cuts}]))) AS cuts, avg(v) AS m FROM v WHERE split = 'train' GROUP BY 1),
binned AS (SELECT feature, split, len(list_filter(cuts, lambda c: c <= v)) AS bin, count(*) AS n FROM v JOIN cuts USING (feature) WHERE split IN ('train', 'test') GROUP BY ALL),
bins AS (SELECT feature, unnest(range(len(cuts) + 1)) AS bin, len(cuts) + 1 AS k FROM cuts),
sides AS (SELECT b.feature, s.split, b.bin, coalesce(coalesce(n, 0) / (sum(n) OVER (PARTITION BY b.feature, s.split))::DOUBLE, 1.0::DOUBLE / k) AS share
  FROM bins b CROSS JOIN (SELECT unnest(['train', 'test']) AS split) s LEFT JOIN binned x ON x.feature = b.feature AND x.split = s.split AND x.bin = b.bin),
p AS (SELECT a.feature, sum((greatest(a.share, 1e-6) - greatest(e.share, 1e-6)) * ln(greatest(a.share, 1e-6) / greatest(e.share, 1e-6))) AS psi
  FROM sides a JOIN sides e ON a.feature = e.feature AND a.bin = e.bin AND a.split = 'test' AND e.split = 'train' GROUP BY 1)
SELECT p.feature, round(psi, 6) AS psi, CASE WHEN psi >= 0.2 THEN 'drift' WHEN psi >= 0.1 THEN 'warn' ELSE 'ok' END AS severity,
  round(cuts.m, 6) AS reference_mean, round((SELECT avg(v) FROM v WHERE v.feature = p.feature AND split = 'test'), 6) AS current_mean FROM p JOIN cuts USING (feature)"""
    )


_OUTCOMES = (
    _SCORED
    + f""", {_BANDED},
ripe AS (SELECT * FROM scores WHERE epoch_us(TIMESTAMP '2024-01-26 00:00:00') - epoch_us(scored_at) >= {24 * HOUR}),
judged AS (SELECT r.*, coalesce(epoch_us(f.ts) - epoch_us(r.scored_at) <= {24 * HOUR}, FALSE)::INT AS label, f.ts AS next_failure_ts
  FROM ripe r ASOF LEFT JOIN (SELECT DISTINCT machine_id, ts FROM failures) f ON r.machine_id = f.machine_id AND r.scored_at < f.ts)
"""
)


_HOLDOUT = """, per AS (SELECT machine_id, max(label) AS ever_fails FROM kept GROUP BY 1),
r AS (SELECT *, row_number() OVER (PARTITION BY ever_fails ORDER BY (machine_id::BIGINT * 7919 + 3) % 104729, machine_id) AS rn, count(*) OVER (PARTITION BY ever_fails) AS n FROM per),
held AS (SELECT machine_id FROM r WHERE rn <= greatest(1, round_even(n * 0.2::DOUBLE, 0)))"""
#: The newest tick of each machine, scored by the rules model at its threshold.
_SCORE_RUN = (
    _FEATURES.rstrip()
    + f""", std AS (SELECT machine_id, ts, stddev_samp(vibration) OVER (PARTITION BY machine_id ORDER BY epoch_us(ts) RANGE BETWEEN {24 * HOUR - 1} PRECEDING AND CURRENT ROW) AS x FROM telemetry),
cut AS (SELECT quantile_cont(x, 0.99) AS c FROM kept JOIN std USING (machine_id, ts) WHERE split = 'train'),
last AS (SELECT * FROM (SELECT machine_id, ts, max(ts) OVER (PARTITION BY machine_id) AS last_ts FROM features WHERE {_ON_CADENCE} AND ts <= TIMESTAMP '{PAYLOAD_TS}') WHERE ts = last_ts),
scored AS (SELECT machine_id, ts, round(1 / (1 + exp(-(x - c) / greatest(abs(c), 1e-9))), 6) AS probability FROM last JOIN std USING (machine_id, ts), cut)
SELECT machine_id, ts, TIMESTAMP '{PAYLOAD_TS}' AS scored_at, probability, CASE WHEN probability >= 0.45 THEN 'act' WHEN probability >= 0.225 THEN 'watch' ELSE 'ok' END AS decision FROM scored WHERE probability IS NOT NULL"""
)


def _psi_of(relation: str, features) -> str:
    """Index of each feature of a relation with split, and its severity; means left out."""
    parts = " UNION ALL ".join(f"SELECT '{f}' AS feature, split, {f}::DOUBLE AS v FROM {relation}" for f in features)
    cuts = ", ".join(str(i / 10) for i in range(1, 10))
    return f""", v AS (SELECT * FROM ({parts}) WHERE v IS NOT NULL),
cuts AS (SELECT feature, list_sort(list_distinct(quantile_cont(v, [{cuts}]))) AS cuts FROM v WHERE split = 'train' GROUP BY 1),
binned AS (SELECT feature, split, len(list_filter(cuts, lambda c: c <= v)) AS bin, count(*) AS n FROM v JOIN cuts USING (feature) WHERE split IN ('train', 'test') GROUP BY ALL),
bins AS (SELECT feature, unnest(range(len(cuts) + 1)) AS bin, len(cuts) + 1 AS k FROM cuts),
sides AS (SELECT b.feature, s.split, b.bin, coalesce(coalesce(n, 0) / (sum(n) OVER (PARTITION BY b.feature, s.split))::DOUBLE, 1.0::DOUBLE / k) AS share
  FROM bins b CROSS JOIN (SELECT unnest(['train', 'test']) AS split) s LEFT JOIN binned x ON x.feature = b.feature AND x.split = s.split AND x.bin = b.bin)
SELECT a.feature, round(sum((greatest(a.share, 1e-6) - greatest(e.share, 1e-6)) * ln(greatest(a.share, 1e-6) / greatest(e.share, 1e-6))), 6) AS psi
  FROM sides a JOIN sides e ON a.feature = e.feature AND a.bin = e.bin AND a.split = 'test' AND e.split = 'train' GROUP BY 1"""


_FEATURES_DRIFT = _FEATURES.rstrip() + ", t AS (SELECT features.*, split FROM kept JOIN features USING (machine_id, ts))" + _psi_of("t", feature_order(WINDOWS))


def oracles() -> dict[str, str]:
    tel = with_("ev", "telemetry")
    out = {
        "label_balance_by_split": with_(*_LABELS) + f"SELECT split, {_BALANCE} FROM kept GROUP BY split",
        "label_drop_accounting": with_(*_LABELS) + "SELECT count(*) AS grid_rows, count(*) FILTER (excluded) AS excluded, count(*) FILTER (NOT labelable) AS unlabelable, count(*) FILTER (split = 'gap') AS in_gap, count(*) FILTER (NOT excluded AND labelable AND split <> 'gap') AS kept FROM lab",
        "label_grid": with_(*_LABELS) + "SELECT * FROM lab",
        "label_balance_by_component": with_(*_LABELS, "by_component") + "SELECT component, split, count(*) AS rows, sum(label)::BIGINT AS positives, round(avg(label), 9) AS positive_rate FROM by_component GROUP BY ALL",
        "label_balance_component_pivot": with_(*_LABELS, "by_component") + "SELECT component, " + ", ".join(f"round(avg(label) FILTER (split = '{s}'), 9) AS {s}" for s in ("train", "val", "test")) + " FROM by_component GROUP BY component",
        "staged_dedup_telemetry": with_("lines") + f", {_LINE_ONE} SELECT * FROM one",
        "staged_events_distinct": with_("ev", "errors") + "SELECT DISTINCT * FROM errors",
        "feature_grid": with_("ev", "telemetry", "grid") + "SELECT * FROM grid",
        "lag_features": with_("ev", "telemetry", "errors", "pivoted", "counted") + _select(_lags(), "counted"),
        "trend_features": with_("ev", "telemetry", "errors", "pivoted", "counted") + _select(_trend(WINDOWS), "counted"),
        "error_pivot": with_("ev", "errors", "pivoted") + "SELECT * FROM pivoted",
        "error_counts_rolling": with_("ev", "telemetry", "errors", "pivoted", "counted") + _select(_errors(WINDOWS), "counted"),
        "machine_onehot": with_("ev", "telemetry", "machines", "grid") + "SELECT machine_id, ts, age::DOUBLE AS machine_age, " + ", ".join(f"(model = '{m}')::INT::DOUBLE AS model_{m}" for m in MODELS) + " FROM grid JOIN machines USING (machine_id)",
        "maint_clocks_asof": with_("ev", "telemetry", "maint") + f", c AS ({_clocks('telemetry')}) SELECT machine_id, ts, " + ", ".join(f"round(hours_since_maint_{c}, 6) AS hours_since_maint_{c}" for c in (*COMPONENTS, "any")) + " FROM c",
        "asof_backward_last_maint": with_("ev", "telemetry", "maint") + "SELECT t.machine_id, t.ts, coalesce(m.n, 0) AS maint_in_hour FROM telemetry t ASOF LEFT JOIN (SELECT machine_id, ts, count(*) AS n FROM maint GROUP BY ALL) m ON t.machine_id = m.machine_id AND t.ts >= m.ts",
        "next_failure_asof_forward": with_("ev", "telemetry", "failures") + "SELECT t.machine_id, t.ts, f.ts AS next_failure_ts FROM telemetry t ASOF LEFT JOIN (SELECT DISTINCT machine_id, ts FROM failures) f ON t.machine_id = f.machine_id AND t.ts < f.ts",
        "feature_matrix_wide": _FEATURES + "SELECT * FROM features",
        "feature_completeness": _FEATURES + f"SELECT count(*) AS rows, count(*) FILTER ({_ANY_BROKEN}) AS incomplete FROM features",
        "training_matrix": _FEATURES + "SELECT features.*, label, split FROM kept JOIN features USING (machine_id, ts)",
        "scoring_matrix_latest": _FEATURES + f"SELECT * EXCLUDE (last_ts) FROM (SELECT *, max(ts) OVER (PARTITION BY machine_id) AS last_ts FROM features WHERE {_ON_CADENCE} AND ts <= TIMESTAMP '2024-01-25 00:00:00') WHERE ts = last_ts",
        "warmup_drop": tel + f"SELECT machine_id, ts FROM (SELECT *, min(ts) OVER (PARTITION BY machine_id) AS f FROM telemetry) WHERE epoch_us(ts) - epoch_us(f) >= {24 * HOUR}",
        "validate_duplicates": with_("lines") + "SELECT machine_id, ts, count(*) AS rows FROM lines GROUP BY ALL HAVING count(*) > 1",
        "validate_nulls": _FEATURES + "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS nulls FROM features" for c in feature_order(WINDOWS)) + ") WHERE nulls > 0",
        "validate_ranges": tel + "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{s}' AS sensor, count(*) FILTER ({b}) AS rows, round(min({s}) FILTER ({b}), 6) AS lowest, round(max({s}) FILTER ({b}), 6) AS highest FROM telemetry" for s, b in _BAD.items()) + ") WHERE rows > 0",
        "validate_gaps": tel + f"SELECT * FROM (SELECT machine_id, lag(ts) OVER w AS from_ts, ts AS to_ts, (epoch_us(ts) - epoch_us(lag(ts) OVER w)) / {float(HOUR)} AS hours FROM telemetry WINDOW w AS (PARTITION BY machine_id ORDER BY ts)) WHERE hours > 1",
        "validate_unknown_machines": with_("ev", "failures", "machines") + "SELECT machine_id, count(*) AS rows FROM failures WHERE machine_id NOT IN (SELECT machine_id FROM machines) GROUP BY ALL",
        "validate_never_failing": with_("ev", "failures", "machines") + "SELECT machine_id FROM machines WHERE machine_id NOT IN (SELECT machine_id FROM failures)",
        "curate_telemetry": with_("lines") + f", {_LINE_ONE} SELECT machine_id, ts, " + ", ".join(f"CASE WHEN NOT {b} THEN {s} END AS {s}" for s, b in _BAD.items()) + f", {' OR '.join(_BAD.values())} AS had_out_of_range, strftime(ts, '%Y-%m-%d') AS dt FROM one",
        "curate_events": with_("ev", "maint") + "SELECT DISTINCT machine_id, ts, component, strftime(ts, '%Y-%m-%d') AS dt FROM maint",
        "curate_machines": with_("ev", "machines") + "SELECT * FROM machines",
        "split_bounds": with_(*_LABELS) + f"SELECT split, {_BALANCE} FROM kept GROUP BY split",
        "machine_overlap": with_(*_LABELS) + "SELECT a AS \"left\", b AS \"right\", (SELECT count(*) FROM (SELECT machine_id FROM kept WHERE split = a INTERSECT SELECT machine_id FROM kept WHERE split = b)) AS shared_machines FROM (VALUES ('train', 'val'), ('train', 'test'), ('val', 'test')) x(a, b)",
        "holdout_machines": with_(*_LABELS) + """, per AS (SELECT machine_id, max(label) AS ever_fails FROM kept GROUP BY 1),
r AS (SELECT *, row_number() OVER (PARTITION BY ever_fails ORDER BY (machine_id::BIGINT * 7919 + 3) % 104729, machine_id) AS rn, count(*) OVER (PARTITION BY ever_fails) AS n FROM per)
SELECT machine_id, ever_fails FROM r WHERE rn <= greatest(1, round_even(n * 0.2::DOUBLE, 0))""",
        "class_weight": with_(*_LABELS) + "SELECT round(coalesce((count(*) - sum(label)) / nullif(sum(label), 0)::DOUBLE, 1), 9) AS scale_pos_weight FROM kept WHERE split = 'train'",
        "rules_scores": _SCORED + "SELECT * FROM scored",
        "cost_curve": _SCORED + _CURVE + "SELECT * FROM points",
        "cheapest_threshold": _SCORED + _CURVE + "SELECT * FROM points ORDER BY expected_cost, threshold DESC LIMIT 1",
        "recall_at_far": _SCORED + _CURVE + "SELECT * FROM points WHERE false_alarm_rate <= 0.05 ORDER BY recall DESC, threshold LIMIT 1",
        "recall_at_budget": _SCORED + _CURVE + "SELECT * FROM points WHERE alarms_per_machine_month <= 1.0 ORDER BY recall DESC, threshold LIMIT 1",
        "operating_point_nearest": _SCORED + _CURVE + "SELECT * FROM points ORDER BY abs(threshold - 0.3), threshold LIMIT 1",
        "ranking_metrics": _SCORED + _RANK.format(source="(SELECT * FROM scored WHERE split = 'val')"),
        "risk_bands": _SCORED + f", {_BANDED} SELECT * FROM scores",
        "score_summary": _SCORED + f", {_BANDED} SELECT count(*) AS scored, count(*) FILTER (decision = 'act') AS act, count(*) FILTER (decision = 'watch') AS watch, count(*) FILTER (decision = 'ok') AS ok, max(probability) AS max_probability FROM scores",
        "work_orders": _SCORED + f""", {_BANDED} SELECT machine_id, CASE WHEN probability >= 0.9 THEN 'P1' WHEN probability >= 0.5625 THEN 'P2' ELSE 'P3' END AS priority, scored_at AS raised_at, scored_at + INTERVAL 24 HOUR AS due_by, probability, horizon_hours,
  'Risk ' || printf('%.1f%%', probability * 100) || ' of failing in the next 24 hours, limit ' || printf('%.1f%%', threshold * 100) AS reason FROM scores WHERE decision = 'act'""",
        "drift_psi": _psi(SENSORS),
        "outcomes": _OUTCOMES + "SELECT machine_id, scored_at, next_failure_ts, label FROM judged",
        "performance_confusion": _OUTCOMES + f""", r AS ({_RANK.format(source="(SELECT probability AS score, label FROM judged)")}),
c AS (SELECT count(*) AS scored_rows, min(scored_at) AS period_start, max(scored_at) AS period_end, count(DISTINCT machine_id) AS machines, sum(label)::BIGINT AS positives,
  count(*) FILTER (probability >= threshold AND label = 1) AS true_positives, count(*) FILTER (probability >= threshold AND label = 0) AS false_positives,
  count(*) FILTER (probability < threshold AND label = 1) AS false_negatives, count(*) FILTER (probability < threshold AND label = 0) AS true_negatives FROM judged)
SELECT c.*, (SELECT count(*) FROM scores) - scored_rows AS pending_rows, round(true_positives / greatest(true_positives + false_negatives, 1)::DOUBLE, 9) AS recall, round(true_positives / greatest(true_positives + false_positives, 1)::DOUBLE, 9) AS precision, r.*,
  round(false_positives / nullif(machines * (epoch_us(period_end) - epoch_us(period_start)) / ({HOUR} * 730.0::DOUBLE), 0), 9) AS alarms_per_machine_month FROM c, r""",
        "payload_round_trip": _FEATURES + f"SELECT * EXCLUDE (last_ts) FROM (SELECT *, max(ts) OVER (PARTITION BY machine_id) AS last_ts FROM features WHERE {_ON_CADENCE} AND ts <= TIMESTAMP '{PAYLOAD_TS}') WHERE ts = last_ts",
        "score_run": _SCORE_RUN,
        "unknown_codes": with_("ev", "errors") + "SELECT error_id, count(*) AS rows FROM errors WHERE error_id <> 'error1' GROUP BY 1",
        "apply_holdout": with_(*_LABELS) + f"""{_HOLDOUT} SELECT machine_id, ts, label, CASE WHEN h THEN 'test' ELSE split END AS split, h AS held_out FROM (SELECT *, machine_id IN (SELECT machine_id FROM held) AS h FROM kept)""",
        "drift_psi_all": _FEATURES_DRIFT,
        "implied_threshold": _SCORED + f", {_BANDED} SELECT coalesce(min(probability) FILTER (decision = 'act'), 'inf'::DOUBLE) AS threshold FROM scores",
    }
    for w in WINDOWS:
        out[f"rolling_stats_{w}h"] = with_("ev", "telemetry", "errors", "pivoted", "counted") + _select(_rolling((w,)), "counted")
    for w in LINE_SETTINGS.window_sizes_hours:
        out[f"line_rolling_stats_{w}h"] = with_("lines") + f", {_LINE_ONE}, counted AS (SELECT *, epoch_us(ts) AS us FROM one) " + _select(_rolling((w,)), "counted", 7)
    return out
