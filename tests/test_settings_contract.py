from datetime import date, datetime

import pytest

from millwright.functions.contract import ContractError, build_contract, order_hash
from millwright.settings import MissingCredentialError, Settings


def test_bounds():
    s = Settings()
    assert (s.train_end_ts, s.val_start_ts, s.val_end_ts, s.test_start_ts) == (datetime(2015, 9, 1), datetime(2015, 9, 2), datetime(2015, 11, 1), datetime(2015, 11, 2))


@pytest.mark.parametrize("bad", [{"gap_hours": 3}, {"window_sizes_hours": (3, 3)}, {"window_sizes_hours": ()}, {"train_end": date(2016, 1, 1)}, {"decision_threshold": 1.0}, {"prediction_horizon_hours": 0}, {"gap_hours": 24 * 80}, {"cost_false_alarm": -1}])
def test_rejected(bad):
    with pytest.raises(ValueError):
        Settings(**bad)


def test_environment():
    s = Settings.from_env({"PDM_WINDOW_SIZES_HOURS": "24,3", "PDM_GAP_HOURS": "48", "PDM_LOG_LEVEL": "debug", "PDM_VAL_END": "2015-12-01"})
    assert s.window_sizes_hours == (3, 24) and s.gap_hours == 48 and s.log_level == "DEBUG" and s.val_end == date(2015, 12, 1)
    assert Settings(window_sizes_hours="[6]").window_sizes_hours == (6,)
    with pytest.raises(MissingCredentialError):
        s.s3_uri("x")
    assert Settings(s3_bucket="b", s3_prefix="/a/b/").s3_uri("raw", "t") == "s3://b/a/b/raw/t"


def test_contract():
    c = build_contract(Settings())
    assert len(c.order) == 96 and c.hash == "a6203b000ccd92dc"
    one = build_contract(Settings(window_sizes_hours=(24,)))
    assert one.hash != c.hash and not any("delta" in n for n in one.order)


def test_projection_and_guard(spark):
    c = build_contract(Settings())
    df = spark.createDataFrame([tuple(1 for _ in c.order)], [*reversed(c.order)])
    out = c.project(df)
    assert tuple(out.columns) == c.order and set(dict(out.dtypes).values()) == {"double"}
    with pytest.raises(ContractError):
        c.project(df.drop("volt"))
    with pytest.raises(ContractError):
        c.project(df.selectExpr("*", "1 as extra"), strict=True)
    c.guard(out, c.hash, c.hash)
    for declared, model in ((c.hash, "x"), ("x", c.hash)):
        with pytest.raises(ContractError):
            c.guard(out, declared, model)
    with pytest.raises(ContractError):
        c.guard(df, c.hash, c.hash)  # same columns in another order
    assert order_hash(["a", "b"]) != order_hash(["b", "a"])
