from datetime import date

import pytest
from helpers import ts
from pyspark.sql import functions as F

from pontualis.functions import clock, keys, scores


def values(spark, rows, ddl, expression):
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + ddl)
    return [r.v for r in frame.select("i", expression.alias("v")).orderBy("i").collect()]


def test_times_past_midnight_belong_to_the_next_day(spark):
    got = values(spark, [(date(2025, 2, 12), t) for t in
                         ("25:00:00", "05:30:15", "25:00", "aa:bb:cc", None)],
                 "d date, t string", clock.extended_departure(F.col("d"), F.col("t")))
    assert got == [ts("2025-02-13 01:00:00"), ts("2025-02-12 05:30:15"), None, None, None]


def test_wrapped_duration(spark):
    got = values(spark, [("22:00:00", "25:00:00"), ("24:00:00", "26:00:00"),
                         ("05:00:30", "05:02:10"), ("x", "05:00:00")],
                 "a string, b string", clock.wrapped_duration_minutes(F.col("a"), F.col("b")))
    assert got == [-1260, 120, 2, None]


def test_headway_rounds_half_away_from_zero(spark):
    got = values(spark, [(600,), (630,), (29,), (40000 * 60,)], "s bigint",
                 clock.headway_minutes(F.col("s")))
    assert got == [10, 11, 0, 40000]


def test_departure_count_and_numbers(spark):
    pairs = [(180, 20), (2, 20), (10, 20), (60, 0), (50, 20)]
    count = clock.departure_count(F.col("t"), F.col("h"))
    assert values(spark, pairs, "t bigint, h bigint", count) == [9, 0, 1, None, 3]
    numbers = values(spark, pairs, "t bigint, h bigint", clock.departure_numbers(count))
    assert [len(n) if n else 0 for n in numbers] == [9, 0, 1, 0, 3]


def test_floor_and_ceil_division(spark):
    pairs = [(7, 3), (-7, 3), (6, 3), (-6, 3), (0, 5)]
    assert values(spark, pairs, "a bigint, b bigint",
                  clock.floor_div(F.col("a"), F.col("b"))) == [2, -3, 2, -2, 0]
    assert values(spark, pairs, "a bigint, b bigint",
                  clock.ceil_div(F.col("a"), F.col("b"))) == [3, -2, 2, -2, 0]


def test_reliability_steps(spark):
    seconds = [150, 330, 300, -180, -210, 1201, 1231, 0, -12 * 60, -13 * 60, None]
    got = values(spark, [(float(s) if s is not None else None,) for s in seconds], "s double",
                 scores.score_reliability(F.col("s")))
    assert got == [1, .5, 1, 1, .5, .25, 0, 1, .25, 0, None]


def test_travel_time_steps(spark):
    minutes = [0, 7, 8, 13, 14, 20, 21, 35, 36, 50, 51, 80, 81, -5, None]
    got = values(spark, [(m,) for m in minutes], "m bigint", scores.score_travel_time(F.col("m")))
    assert got == [1.5, 1.5, 1.25, 1.25, 1, 1, .5, .5, .5, .5, .25, .25, 0, 1.5, None]


def test_travel_delta_counts_equality_as_one(spark):
    got = values(spark, [(15, 15), (5, 90)], "p bigint, r bigint",
                 scores.score_travel_delta(F.col("p"), F.col("r")))
    assert got == [1.0, -1.5]


def test_error_factor(spark):
    got = values(spark, [(30, 10), (0, 0)], "p bigint, r bigint",
                 scores.score_error_factor(F.col("p"), F.col("r")))
    assert got == [0.5, None]


def test_codes_and_keys(spark):
    assert values(spark, [("0",), ("1",), ("2",), (None,)], "d string",
                  keys.direction_code(F.col("d"))) == ["I", "V", "C", "C"]
    assert values(spark, [("V1-006-I-x",), ("abc",), (None,)], "k string",
                  keys.trip_key_realised(F.col("k"))) == ["006-I-x", "abc", None]
    assert values(spark, [("006", ts("2024-12-01 05:20:00")), (None, ts("2024-12-01 05:20:00"))],
                  "s string, t timestamp_ntz",
                  keys.trip_key_planned(F.col("s"), F.lit("I"), F.lit("S6"), F.col("t"))) \
        == ["006-I-S6-20241201052000", None]


def test_quarter_hour_bands(spark):
    moments = ["00:00:00", "00:14:59", "09:15:00", "23:45:00", "23:59:59"]
    got = values(spark, [(ts("2024-12-01 " + m),) for m in moments] + [(None,)],
                 "t timestamp_ntz", clock.quarter_hour_bucket(F.col("t")))
    assert got == ["00:00:00 - 00:15:00", "00:00:00 - 00:15:00", "09:15:00 - 09:30:00",
                   "23:45:00 - 00:00:00", "23:45:00 - 00:00:00", None]


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_clock_does_not_depend_on_the_session_zone(spark, zone):
    """In the second zone midnight of 2018-11-04 did not exist."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        moment = F.lit("2018-11-04 00:00:00").cast("timestamp_ntz")
        row = spark.range(1).select(
            clock.epoch_seconds(moment).alias("e"),
            clock.from_epoch_seconds(clock.epoch_seconds(moment)).cast("string").alias("t"),
            keys.compact_stamp(moment).alias("k"), clock.hour_bucket(moment).alias("h"),
            clock.extended_departure(F.lit("2018-11-03").cast("date"), F.lit("24:00:00"))
            .cast("string").alias("x")).first()
        assert row == (1541289600, "2018-11-04 00:00:00", "20181104000000", 0,
                       "2018-11-04 00:00:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
