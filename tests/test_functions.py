from pyspark.sql import functions as F

from panewise.functions import date_key, half_up_round, lenient_double, lenient_long, ms_to_text


def test_half_up_round_matches_java_math_round(spark):
    df = spark.createDataFrame([(-0.125,), (0.125,), (1.005,), (2.675,), (-2.5,), (0.0,)], "x double")
    got = [r[0] for r in df.select(half_up_round(F.col("x"), 2)).collect()]
    # Java Math.round(x*100)/100: floor(x*100 + 0.5)/100
    import math

    assert got == [math.floor(x * 100 + 0.5) / 100 for x in (-0.125, 0.125, 1.005, 2.675, -2.5, 0.0)]
    assert got[0] == -0.12 and got[1] == 0.13


def test_ms_to_text_is_utc_and_handles_pre_epoch(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(0,), (-30_000,), (1_704_067_230_000,)], "ms long")
        got = [tuple(r) for r in df.select(ms_to_text(F.col("ms")), date_key(F.col("ms"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [
        ("1970-01-01 00:00:00", "19700101"),
        ("1969-12-31 23:59:30", "19691231"),
        ("2024-01-01 00:00:30", "20240101"),
    ]


def test_lenient_numbers(spark):
    df = spark.createDataFrame([("7.5",), ("abc",), (None,), ("1900.0",), ("42",), ("1.9e3",)], "s string")
    got = [tuple(r) for r in df.select(lenient_double(F.col("s")), lenient_long(F.col("s"))).collect()]
    assert got == [(7.5, 7), (0.0, 0), (0.0, 0), (1900.0, 1900), (42.0, 42), (1900.0, 1900)]


def test_utc_date_ignores_session_zone(spark):
    from panewise.functions import utc_date

    spark.conf.set("spark.sql.session.timeZone", "Pacific/Kiritimati")  # UTC+14
    try:
        df = spark.createDataFrame([(1_704_067_199_999,), (1_704_067_200_000,)], "ms long")
        got = [str(r[0]) for r in df.select(utc_date(F.col("ms"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == ["2023-12-31", "2024-01-01"]


def test_params_validation_and_delay():
    import pytest

    from panewise.schema import Params

    p = Params()
    assert (p.size_ms, p.slide_ms, p.bound_ms, p.lateness_ms, p.ttl_ms, p.delay_ms) == (
        60_000, 30_000, 10_000, 5_000, 3_600_000, 15_000)
    with pytest.raises(ValueError):
        Params(size_ms=30_000, slide_ms=60_000)
    with pytest.raises(ValueError):
        Params(size_ms=0)
