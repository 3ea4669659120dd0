"""Scalar functions against hand-made values."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tapeloom.functions import ids, numbers, ordering, times


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def ts(text):
    return F.lit(text).cast("timestamp")


@pytest.mark.parametrize(
    ("value", "text"),
    [
        (2_500_000.0, "2 500 000.00"),
        (999.0, "999.00"),
        (0.125, "0.12"),
        (-1234.5, "-1 234.50"),
        (2.675, "2.67"),
        (0.0, "0.00"),
        (1234567890123.456, "1 234 567 890 123.46"),
    ],
)
def test_money_text(spark, value, text):
    assert one(spark, numbers.money_text(F.lit(value))) == text


def test_fixed6(spark):
    assert one(spark, numbers.fixed6(F.lit(12345.5))) == "12345.500000"
    assert one(spark, numbers.fixed6(F.lit(0.0000005))) == "0.000000"


@pytest.mark.parametrize(
    ("text", "value"),
    [
        ("1.5", 1.5),
        ("-.5e1", -5.0),
        ("7.", 7.0),
        ("abc", None),
        ("", None),
        (" 1", None),
        ("1d", None),
        ("1_0", None),
        ("nan", None),
        ("1e999", float("inf")),
    ],
)
def test_parse_float(spark, text, value):
    assert one(spark, numbers.parse_float(F.lit(text))) == value


def test_is_finite(spark):
    assert one(spark, numbers.is_finite(F.lit(1.0)))
    for bad in ("inf", "-inf", "nan"):
        assert not one(spark, numbers.is_finite(F.lit(float(bad))))


@pytest.mark.parametrize(
    ("at", "nano", "seconds", "legacy"),
    [
        (
            "2024-01-01 00:00:00.123Z",
            "2024-01-01T00:00:00.123Z",
            "2024-01-01T00:00:00Z",
            "2024-01-01 00:00:00.123 +0000 UTC",
        ),
        (
            "2024-01-01 00:00:00.120Z",
            "2024-01-01T00:00:00.12Z",
            "2024-01-01T00:00:00Z",
            "2024-01-01 00:00:00.12 +0000 UTC",
        ),
        (
            "2024-01-01 00:00:10Z",
            "2024-01-01T00:00:10Z",
            "2024-01-01T00:00:10Z",
            "2024-01-01 00:00:10 +0000 UTC",
        ),
        (
            "2024-01-01 10:00:00.000001Z",
            "2024-01-01T10:00:00.000001Z",
            "2024-01-01T10:00:00Z",
            "2024-01-01 10:00:00.000001 +0000 UTC",
        ),
    ],
)
def test_time_texts(spark, at, nano, seconds, legacy):
    assert one(spark, times.rfc3339_nano(ts(at))) == nano
    assert one(spark, times.rfc3339_seconds(ts(at))) == seconds
    assert one(spark, times.legacy_text(ts(at))) == legacy
    assert one(spark, times.parse_rfc3339(F.lit(nano)) == ts(at))


def test_times_do_not_parse_other_layouts(spark):
    for text in ("2024-01-01", "2024-01-01 00:00:00", "x", ""):
        assert one(spark, times.parse_rfc3339(F.lit(text))) is None
    assert one(spark, times.parse_rfc3339(F.lit("2024-01-01T02:00:00+02:00")) == ts("2024-01-01 00:00:00Z"))


def test_ids_repeat_and_differ(spark):
    a = one(spark, ids.trade_id(F.lit("s"), F.lit(1)))
    assert a == one(spark, ids.trade_id(F.lit("s"), F.lit(1)))
    assert a != one(spark, ids.trade_id(F.lit("s"), F.lit(2)))
    assert len(a) == 64


def test_order_keys_agree_with_tuples(spark):
    base = dt.datetime(2024, 1, 1, 0, 0, tzinfo=dt.timezone.utc)
    rows = [
        (base + dt.timedelta(microseconds=us), agg)
        for us in (0, 1, 999_999, 59_999_999)
        for agg in (0, 1, 2**36, 2**37 - 1)
    ]
    df = spark.createDataFrame(rows, "t timestamp, a bigint")
    want_first = sorted(rows)
    want_last = sorted(rows, key=lambda r: (r[0], -r[1]))
    for first, last in (
        (ordering.minute_first_key, ordering.minute_last_key),
        (ordering.first_key, ordering.last_key),
    ):
        got = df.orderBy(first("t", "a")).select(F.unix_micros("t"), "a").collect()
        assert [r[1] for r in got] == [r[1] for r in want_first]
        got = df.orderBy(last("t", "a")).select(F.unix_micros("t"), "a").collect()
        assert [r[1] for r in got] == [r[1] for r in want_last]


def test_wide_key_takes_any_id(spark):
    rows = [(1, -(2**63)), (1, 2**63 - 1), (2, -(2**63)), (2, 0)]
    df = spark.createDataFrame(rows, "us bigint, a bigint").withColumn(
        "t", F.timestamp_micros("us")
    )
    got = [tuple(r) for r in df.orderBy(ordering.first_key("t", "a")).select("us", "a").collect()]
    assert got == sorted(rows)


def test_minute_keys_give_back_time_and_id(spark):
    ids = [0, 1, -1, 2**37 - 1, 2**37, -(2**37), 2**63 - 1, -(2**63)]
    df = spark.createDataFrame([(a,) for a in ids], "a bigint")
    df = df.withColumn("t", F.timestamp_micros(F.lit(1_700_000_007_654_321)))
    minute, high = F.date_trunc("minute", "t"), ordering.id_high("a")
    for key, last in ((ordering.minute_first_key("t", "a"), False), (ordering.minute_last_key("t", "a"), True)):
        got = df.select(ordering.key_time(key, minute).alias("us"), ordering.key_id(key, high, last).alias("id"), "a")
        assert all(r.us == 1_700_000_007_654_321 and r.id == r.a for r in got.collect())
