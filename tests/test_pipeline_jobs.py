import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from millwright.operators import curate, models, validate
from millwright.plans import jobs
from millwright.settings import Settings
from millwright.sources import files
from millwright.sources.schemas import TABLES

from .synthetic import START, fleet, frames

S = Settings(train_end="2015-01-31", val_end="2015-02-28")


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    top = tmp_path_factory.mktemp("pipeline")
    landing = top / "landing"
    landing.mkdir()
    rows = fleet(machines=3)
    for name, t in TABLES.items():
        lines = [",".join([*t.columns, "extra"])]
        for row in rows[name]:
            values = dict(zip([n for n, _ in t.columns.values()], row, strict=True))
            ts = values.get("ts")
            cells = [f"{ts.month}/{ts.day}/{ts.year} {ts.hour % 12 or 12}:00:00 {'AM' if ts.hour < 12 else 'PM'}" if n == "ts" else f" {values[n]} " for n, _ in t.columns.values()]
            lines.append(",".join([*cells, "z"]))
        (landing / t.file).write_text("\n".join(lines))
    return {k: str(top / k) for k in ("landing", "raw", "curated", "features", "registry", "scores", "history", "profile")} | {"rows": rows}


def test_whole_path(spark, folders):
    issues = jobs.ingest(spark, folders["landing"], folders["raw"])
    assert issues.filter("severity = 'ERROR'").count() == 0
    jobs.ingest(spark, folders["landing"], folders["raw"])  # again, with the same result
    back = files.read_all(spark, folders["raw"])
    assert {n: df.count() for n, df in back.items()} == {n: len(r) for n, r in folders["rows"].items()}
    assert "dt" not in back["telemetry"].columns and back["errors"].first()["error_id"].strip() == back["errors"].first()["error_id"]
    late = files.read_table(spark, folders["raw"], "telemetry", START + timedelta(days=80))
    assert late.count() == 3 * 24 * 10
    assert jobs.curated(spark, folders["raw"], folders["curated"])["machines"] == 3
    assert jobs.build_labels(spark, folders["raw"], folders["features"], S).plausible
    manifest = jobs.build_features(spark, folders["raw"], folders["features"], S)
    assert manifest["feature_hash"] == "a6203b000ccd92dc" and set(manifest["splits"]) == {"train", "val", "test"}
    results = jobs.train(spark, folders["features"], S, ("rules", "logistic"), folders["registry"])
    assert results.count() == 4 and models.best_result(results).count() == 1
    registry = models.Registry(folders["registry"])
    assert registry.champion() == registry.best()
    version = registry.register(registry.best()["bundle"], 0.5)
    assert registry.champion()["version"] == version and registry.promote(1)["version"] == registry.champion()["version"] == 1
    with pytest.raises(models.RegistryError):
        registry.promote(99)
    assert jobs.champion(folders["registry"]) == registry.champion()["bundle"]
    scores, orders = jobs.score(spark, folders["raw"], folders["registry"] + "/logistic", folders["scores"], S)
    assert scores.count() == 3 and orders.count() <= 3 and len(scores.first()["top_drivers"]) == 3
    assert files.read_scores(spark, folders["scores"]).count() == 3
    runs = [f for _, _, names in os.walk(folders["scores"] + "/_runs") for f in names if f.endswith(".json") and not f.startswith(".")]
    assert len(runs) == 1
    record = jobs.evaluate(spark, folders["scores"], folders["raw"], folders["history"], START + timedelta(days=95), S)
    assert record.first()["scored_rows"] == 3 and files.read_jsonl(spark, folders["history"]).count() == 1
    matrix, _ = files.read_matrix(spark, folders["features"])
    report, drifted = jobs.drift(spark, folders["features"], matrix.filter("split = 'train'"), S, folders["profile"])
    assert report.count() == 96 and not drifted


def test_strict_ingest_refuses(spark, folders, tmp_path):
    bad = tmp_path / "landing"
    bad.mkdir()
    for t in TABLES.values():
        lines = open(f"{folders['landing']}/{t.file}").read().split("\n")
        (bad / t.file).write_text("\n".join([*lines, lines[1]]))
    with pytest.raises(validate.ValidationError):
        jobs.ingest(spark, str(bad), str(tmp_path / "raw"))
    assert not (tmp_path / "raw").exists()


def test_missing_column(spark, folders):
    with pytest.raises(files.SourceError):
        files.typed(spark.createDataFrame([("1",)], "machineID string"), TABLES["errors"])


def test_validation(spark):
    rows = fleet(machines=2, days=3)
    rows["telemetry"] += [(1, START, 500.0, 1.0, 1.0, 1.0), (9, START, 1.0, 1.0, 1.0, None)]
    rows["errors"].append((1, START + timedelta(minutes=1), "error1"))
    got = {(r["tbl"], r["check"]): r for r in validate.validate_all(frames(spark, rows)).collect()}
    assert got["telemetry", "duplicate keys"]["rows"] == 2 and got["telemetry", "nulls"]["severity"] == "ERROR"
    assert got["telemetry", "ranges"]["rows"] == 1 and got["telemetry", "unknown machines"]["sample"] == "9"
    assert got["failures", "machines without failures"]["severity"] == "WARN" and ("errors", "errors between readings") in got
    with pytest.raises(validate.ValidationError):
        validate.raise_for_errors(validate.validate_all(frames(spark, rows)))
    assert validate.bad_rows(frames(spark, rows)["telemetry"], "telemetry").count() == 2


def test_curation_flags_before_it_nulls(spark):
    rows = fleet(machines=1, days=1)
    rows["telemetry"][0] = (1, START, 500.0, 1.0, 1.0, 1.0)
    rows["telemetry"].append((None, START, 1.0, 1.0, 1.0, 1.0))
    out = curate.curate_telemetry(frames(spark, rows)["telemetry"])
    hot = out.filter("had_out_of_range").collect()
    assert out.count() == 24 and len(hot) == 1 and hot[0]["volt"] is None and hot[0]["dt"] == "2015-01-01"


def test_payload(spark, tmp_path):
    df = spark.createDataFrame([(1, START, 0.5, None)], "machine_id int, ts timestamp_ntz, a double, b double")
    back = files.decode_payload(files.encode_payload(df, ["a", "b"]), df.schema)
    assert back.collect() == df.collect()
    path = tmp_path / "x.csv"
    path.write_text("b,a\n1.0,2.0\n")
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("a", T.DoubleType()), T.StructField("b", T.DoubleType())])
    assert files.read_csv_payload(spark, str(path), schema).first() == (2.0, 1.0)
    path.write_text("1.0,2.0\n")
    with pytest.raises(files.SourceError):
        files.read_csv_payload(spark, str(path), schema)


def test_landing_times(spark):
    df = spark.createDataFrame([("1/2/2015 6:00:00 PM",), ("2015-01-02 18:00:00",), ("nonsense",), (None,)], "t string")
    got = [r[0] for r in df.select(files.landing_time(F.col("t"))).collect()]
    assert got[0] == got[1] == START + timedelta(days=1, hours=18) and got[2:] == [None, None]


def test_drift_command_tells_by_its_exit_code(spark, folders, monkeypatch):
    report = spark.createDataFrame([("volt", 0.5, "drift")], "feature string, psi double, severity string")
    monkeypatch.setattr(jobs, "staged", lambda *a: None)
    monkeypatch.setattr(jobs, "scoring_matrix", lambda *a: None)
    for drifted in (True, False):
        monkeypatch.setattr(jobs, "drift", lambda *a, d=drifted: (report, d))
        assert jobs.main(["drift", "--raw", folders["raw"]]) == int(drifted)


def test_scripts(spark, tmp_path):
    assert files.statements("SELECT ';' -- a; b\n; /* ; */ SELECT `x;y`;;") == ["SELECT ';'", "SELECT `x;y`"]
    path = tmp_path / "s.sql"
    path.write_text("CREATE OR REPLACE TEMP VIEW scripted AS SELECT id FROM range(10);\n-- the last one's rows\nSELECT count(*) AS n FROM scripted WHERE id >= :least;\n")
    assert files.run_script(spark, str(path), {"least": 4}).first()["n"] == 6
    path.write_text("-- nothing\n")
    with pytest.raises(files.ScriptError):
        files.run_script(spark, str(path))


def test_content_types(spark, tmp_path):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("a", T.DoubleType()), T.StructField("b", T.LongType())])
    want = [(1.5, 2), (None, 3)]
    df = spark.createDataFrame(want, schema)
    for kind in (files.JSON_LINES, files.CSV):
        assert len(files.encode_results(df, kind).collect()) == 2
    files.encode_results(df).write.text(str(tmp_path / "lines"))
    assert sorted(files.decode_batch(spark, str(tmp_path / "lines"), schema).collect(), key=repr) == sorted(df.collect(), key=repr)
    (tmp_path / "one.json").write_text('{"columns": ["b", "a"], "data": [[2, 1.5], [3, null]]}')
    assert sorted(map(tuple, files.decode_batch(spark, str(tmp_path / "one.json"), schema, files.JSON).collect()), key=repr) == sorted(want, key=repr)
    (tmp_path / "bad.json").write_text('{"columns": ["b"], "data": [[2]]}')
    for kind in (files.JSON, "image/png"):
        with pytest.raises(files.SourceError):
            files.decode_batch(spark, str(tmp_path / "bad.json"), schema, kind)
    with pytest.raises(files.SourceError):
        files.encode_results(df, "image/png")


def test_documents_go_by_uri(spark, tmp_path):
    at = f"file://{tmp_path}/deep/x.json"
    assert not files.exists(at)
    for value in ({"a": 1}, {"a": [2, "ü"]}):
        files.write_json(value, at)
        assert files.read_json(at) == value
    with pytest.raises(FileNotFoundError):
        files.read_json(f"{at}x")


def test_unknown_machines_codes_and_models_speak(spark):
    from millwright.operators import features

    rows = fleet(machines=2, days=2)
    rows["errors"].append((1, START, "error9"))
    t = frames(spark, rows)
    t["machines"] = t["machines"].withColumn("model", F.when(F.col("machine_id") == 2, "model9").otherwise(F.col("model")))
    assert features.warnings(t) == ["unknown error code error9: 1 rows", "unknown model model9: 1 rows"]
    features.require_machines(t["telemetry"], t["machines"])
    with pytest.raises(features.UnknownMachine, match="2"):
        features.require_machines(t["telemetry"], t["machines"].filter("machine_id = 1"))


def test_trees_explain_each_row(spark):
    import numpy as np

    from millwright.functions.contract import build_contract

    r = np.random.default_rng(3)
    order = build_contract(S).order
    x = r.normal(size=(300, len(order)))
    label = (x[:, 0] > 0.3).astype(int)
    rows = [(i % 7, int(y), *map(float, v)) for i, (y, v) in enumerate(zip(label, x, strict=True))]
    df = spark.createDataFrame(rows, "machine_id int, label int, " + ", ".join(f"`{c}` double" for c in order))
    df = df.withColumn(order[5], F.when(F.col(order[5]) < 1, F.col(order[5])))  # missing values are no error
    fitted = models.fit_boosted(df, build_contract(S), S, rounds=3)
    got = models.with_drivers(fitted, fitted.predict(df)).select("label", "probability", "top_drivers").collect()
    assert all(len(g["top_drivers"]) == 3 for g in got) and np.mean([g["top_drivers"][0] == order[0] for g in got]) > 0.9
    trees = [models._walked(t) for t in fitted.pipeline.stages[-1].trees]
    filled = df.fillna(models.MISSING).select(*order).toPandas().to_numpy()
    start = sum(w * t[4][0] for t, w in zip(trees, fitted.pipeline.stages[-1].treeWeights, strict=True))
    margin = start + models.path_contributions(filled, trees, list(fitted.pipeline.stages[-1].treeWeights)).sum(axis=1)
    assert np.allclose(1 / (1 + np.exp(-2 * margin)), [g["probability"] for g in got])
