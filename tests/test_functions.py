from __future__ import annotations

from datetime import datetime
from decimal import ROUND_HALF_EVEN, Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillcast.functions.scalars import country_code, quoted_text, round_half_even
from quillcast.functions.time import created_at_ts, minute_bucket, minute_of_day, scale_window, window_seconds


def evaluate(spark, values, schema, expression):
    frame = spark.createDataFrame([(v,) for v in values], f"v {schema}")
    return [row[0] for row in frame.select(expression(F.col("v"))).collect()]


def test_created_at(spark):
    got = evaluate(
        spark,
        ["Mon Oct 29 14:45:07 +0000 2018", "Mon Oct 29 14:45:07 +0200 2018", "Thu Jan 4 1:2:3 +0000 2024", "", "Mon Foo 29"],
        "string",
        lambda c: F.unix_millis(created_at_ts(c)),
    )
    at = 1540824307000
    assert got == [at, at - 7_200_000, 1704330123000, 0, 0]


@pytest.mark.parametrize(
    "lang, code",
    [
        ("en", "us"), ("ja", "jp"), ("el", "gr"), ("da", "dk"), ("uk", "ua"), ("fa", "ir"), ("hi", "in"),
        ("de", "de"), ("en-gb", "gb"), (" ja ", "jp"), ("\tja\n", "jp"), ("EN", "en"), ("zh-Hans", "hans"),
        ("zh-Hans-CN", "hans"), ("no-lang", "lang"), ("en-", "us"), ("-gb", "gb"), ("a--b", ""), ("", ""),
    ],
)
def test_country_code(spark, lang, code):
    assert evaluate(spark, [lang], "string", country_code) == [code]


def test_rounding_is_that_of_the_exact_binary_value(spark):
    rng = np.random.default_rng(7)
    ties = [k / 1000 + 0.005 for k in range(0, 100_000, 37)]
    values = [2.675, 0.125, 0.375, 12.345, 0.145, 33.333333, 100.0, 0.0, *ties, *(rng.random(2000) * 100)]
    expected = [float(Decimal(v).quantize(Decimal("0.01"), ROUND_HALF_EVEN)) for v in map(float, values)]
    assert evaluate(spark, [float(v) for v in values], "double", round_half_even) == expected
    assert expected[:3] == [2.67, 0.12, 0.38]


def test_rounding_near_ties_of_three_places(spark):
    values = [k / 8000 for k in range(2, 40_000, 4)]
    expected = [float(Decimal(v).quantize(Decimal("0.001"), ROUND_HALF_EVEN)) for v in values]
    assert evaluate(spark, values, "double", lambda c: round_half_even(c, 3)) == expected


def test_quoted_text(spark):
    got = evaluate(spark, ["anna", 'a"b', "a,b", 'a",b', "a\nb", "-"], "string", quoted_text)
    # Any of , " CR LF asks for CSV quotes, which double the inner ones; then all are backslashed.
    assert got == ["'anna'", "'\\\"a\\\"\\\"b\\\"'", "'\\\"a,b\\\"'", "'\\\"a\\\"\\\",b\\\"'", "'\\\"a\nb\\\"'", "'-'"]


def test_minute_bucket(spark):
    times = [datetime(2018, 10, 29, 14, 52, 7, 5000), datetime(2018, 10, 29, 14, 0), datetime(2018, 10, 29, 14, 59, 59)]

    def minutes(n):
        got = evaluate(spark, times, "timestamp", lambda c: minute_bucket(c, n).cast("string"))
        return [t[11:] for t in got]

    assert minutes(15) == ["14:45:00", "14:00:00", "14:45:00"]
    assert minutes(1) == ["14:52:00", "14:00:00", "14:59:00"]
    assert minutes(25) == ["14:50:00", "14:00:00", "14:50:00"]
    with pytest.raises(ValueError):
        minute_bucket(F.col("v"), 61)


def test_minute_of_day_is_24_hours(spark):
    times = [datetime(2018, 1, 1, 13, 20), datetime(2018, 1, 1, 1, 15)]
    assert evaluate(spark, times, "timestamp", minute_of_day) == [13 * 60 + 15, 75]


def test_scale_window():
    assert scale_window("15 minutes", 4) == "60 minutes"


def test_window_seconds():
    assert [window_seconds(w) for w in ("1 second", "15 minutes", "1 hour", "2 days", "300 microseconds")] == [1, 900, 3600, 172_800, 0.0003]
    with pytest.raises(KeyError):
        window_seconds("1 month")
