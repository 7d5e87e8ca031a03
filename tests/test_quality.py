import datetime as dt

import pytest

from salesflow.operators import quality as Q

SCHEMA = "date date, region string, product string, price double, quantity int, sales double"


def _valid(spark, n=60):
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), f"R{i % 4}", f"P{i % 5}", 10.0, 2, 20.0) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def _status(report):
    return {(r.check, r.column): r.status for r in report.collect()}


def test_valid_data_passes(spark):
    rep = Q.validate(_valid(spark))
    v = Q.verdict(rep, strict=True).first()
    assert v.is_valid and v.n_failed == 0 and v.n_warnings == 0


def test_missing_columns_recorded_not_raised(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), "x")], "date date, region string")
    st = _status(Q.scalar_checks(df))
    assert st[("schema", "price")] == "failed" and st[("schema", "date")] == "passed"


def test_ranges_nulls_and_business_rule(spark):
    rows = [(dt.date(2024, 1, 1), None, "p", -1.0, 0, 5.0), (dt.date(2024, 3, 1), "r", "p", 100.0, 10, 500.0)]
    st = _status(Q.scalar_checks(spark.createDataFrame(rows, SCHEMA)))
    assert st[("value_ranges", "price")] == "failed" and st[("value_ranges", "quantity")] == "failed"
    assert st[("completeness", "region")] == "warning"
    assert st[("business_rule", "sales")] == "failed"


def test_short_span_and_future_dates(spark):
    df = _valid(spark, 10)
    st = _status(Q.scalar_checks(df, as_of=dt.date(2024, 1, 5)))
    assert st[("date_range", "date")] == "warning" and st[("date_validity", "date")] == "warning"


def test_duplicates_counted_beyond_first(spark):
    rows = [(dt.date(2024, 1, 1), "r", "p", 1.0, 1, 1.0)] * 10
    out = {r.check: r.observed for r in Q.duplicate_checks(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out["duplicates"] == 9 and out["key_duplicates"] == 9


def test_empty_input_fails(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert not Q.verdict(Q.validate(empty, outliers=False)).first().is_valid


def test_outlier_share_below_limit_passes(spark):
    rows = [(dt.date(2024, 1, 1), "r", "p", 100.0, 1, 100.0)] * 99 + [(dt.date(2024, 1, 1), "r", "p", 1e6, 1, 1e6)]
    st = _status(Q.outlier_check(spark.createDataFrame(rows, SCHEMA)))
    assert st[("statistical_outliers", "price")] == "passed"  # 1 % < 5 %


def test_feature_checks(spark):
    df = spark.createDataFrame([(0.0, float("inf")), (0.0, 1.0)], "z double, i double")
    st = _status(Q.validate_features(df, expected=["z", "missing"]))
    assert st[("expected_features", "missing")] == "failed" and st[("unexpected_features", "i")] == "warning"
    assert st[("infinite_values", "i")] == "failed" and st[("zero_columns", "z")] == "warning"


def test_gate_raises(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), None, "p", 1.0, 1, 1.0)], SCHEMA)
    with pytest.raises(Q.QualityGateError):
        Q.gate(df)
    assert Q.gate(_valid(spark)).count() == 60


def test_record_validation_reasons(spark):
    rows = [(dt.date(2024, 1, 1), "  ", "p", 0.0, 1, 1.0), (dt.date(2024, 1, 1), "r", "p", 1.0, 1, 1.0)]
    out = Q.validate_records(spark.createDataFrame(rows, SCHEMA)).collect()
    assert out[0].reasons == ["region is blank", "price must be > 0"] and not out[0].accepted
    assert out[1].accepted
