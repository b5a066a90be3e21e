import random
from datetime import date, datetime, timedelta

from helpers import CFG, FEED, feed, realised, tables, ts
from pyspark.sql import Window
from pyspark.sql import functions as F

from pontualis.operators import observed
from pontualis.operators.numbering import number_rows, running_total_before


def test_period_must_end_by_midnight_of_the_feed_end(spark):
    end = FEED[2]
    inside = realised("2024-12-31 08:00:00", 10, fim_periodo=datetime(2024, 12, 31))
    outside = realised("2024-12-31 09:00:00", 10, fim_periodo=datetime(2024, 12, 31, 23, 59))
    rows = observed.observed_departures(
        tables(spark, feeds=[feed()], trips_done=[inside, outside]), CFG).collect()
    assert [r.datetime_partida for r in rows] == [ts("2024-12-31 08:00:00")]
    assert rows[0].feed_end_date == end


def test_trip_inside_two_feeds_counts_twice(spark):
    second = feed(feed_version="2024-11-20", feed_start_date=date(2024, 11, 20),
                  feed_end_date=date(2025, 2, 1))
    rows = observed.observed_departures(
        tables(spark, feeds=[feed(), second], trips_done=[realised("2024-12-05 08:00:00", 10)]),
        CFG).orderBy("viagens_consecutivas").collect()
    assert [(r.viagens_consecutivas, r.feed_version) for r in rows] == [
        (1, "2024-11-20"), (2, "2024-12-01")]


def test_duration_period_and_floor_filters(spark):
    rows = [realised("2024-12-05 08:00:00", 0), realised("2024-11-30 08:00:00", 10),
            realised("2025-01-01 08:00:00", 10)]
    wide = feed(feed_end_date=date(2025, 12, 31), feed_start_date=date(2024, 1, 1))
    t = tables(spark, feeds=[wide, feed(feed_version="2024-11-05")], trips_done=rows)
    assert observed.observed_departures(t, CFG).count() == 0


def test_vehicle_prefix_makes_copies(spark):
    rows = [realised("2024-12-05 08:00:00", 10, key="V1-006-I-x"),
            realised("2024-12-05 08:00:00", 10, key="V2-006-I-x")]
    got = observed.observed_departures(tables(spark, feeds=[feed()], trips_done=rows), CFG)
    assert [(r.id_viagem, r.viagens_consecutivas) for r in got.collect()] == [("006-I-x", 1)]


def test_feed_range_equals_the_range_join(spark):
    """Including inverted periods, feeds that end before they start, and NULLs."""
    rng = random.Random(7)

    def moment(spread):
        return datetime(2024, 12, 1) + timedelta(days=rng.randint(-spread, spread),
                                                 minutes=rng.choice([0, 0, 1, 1439]))

    periods = [(i, moment(70), moment(70)) for i in range(400)] + [(400, None, moment(9))]
    feeds = [(f"f{i}", moment(90).date(), moment(90).date()) for i in range(40)]
    feeds += [("open", date(2024, 11, 1), date(9999, 12, 31)), ("null", date(2024, 11, 1), None)]
    trips = spark.createDataFrame(
        periods, "id int, inicio_periodo timestamp_ntz, fim_periodo timestamp_ntz")
    frame = spark.createDataFrame(
        feeds, "feed_version string, feed_start_date date, feed_end_date date")
    expected = sorted(
        (i, v) for i, a, b in periods for v, start, end in feeds
        if a is not None and end is not None
        and a >= datetime.combine(start, datetime.min.time())
        and b <= datetime.combine(end, datetime.min.time()))
    indexed = observed.join_feed_range(trips, frame, ["id"])
    by_month = observed.join_feed_range(trips, frame, ["id"], index_rows=0)
    for got in (indexed, by_month):
        assert sorted((r.id, r.feed_version) for r in got.collect()) == expected
    assert len(expected) > 300


def test_feed_index_of_any_size(spark):
    """No feed at all, one, and numbers around powers of two."""
    trips = spark.range(40).select(
        "id", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id as int))")
        .alias("inicio_periodo")).withColumn("fim_periodo", F.col("inicio_periodo"))
    days = F.expr("date'2024-01-01' + cast(id as int)")
    for n in (0, 1, 7, 8, 9, 31):
        feeds = spark.range(n).select(days.alias("feed_start_date"), (days + 1).alias("feed_end_date"))
        got = observed.join_feed_range(trips, feeds, ["id"])
        pairs = [(r.id, (r.feed_start_date - date(2024, 1, 1)).days) for r in got.collect()]
        assert sorted(pairs) == sorted((i, f) for i in range(40) for f in range(n) if f <= i <= f + 1)


def test_numbering_of_a_hot_key_equals_row_number(spark):
    """One trip owns a third of the rows, NULL keys included."""
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("t"), (F.col("id") % 100).cast("string"))).alias("trip"),
        (F.hash("id") % 50000).alias("at"), "id")
    cell = F.floor(F.col("at") / 3600).cast("bigint")
    got = number_rows(rows, ["trip"], cell, ["at", "id"], "n")
    plain = rows.withColumn("n", F.row_number().over(
        Window.partitionBy("trip").orderBy("at", "id")).cast("bigint"))
    assert got.exceptAll(plain).count() == 0 and got.count() == 30000


def test_running_total_with_weights(spark):
    rows = spark.range(2000).select((F.col("id") % 3).alias("k"), "id",
                                    (F.col("id") % 5).alias("w"))
    got = running_total_before(rows, ["k"], F.floor(F.col("id") / 100), ["id"], F.col("w"), "b")
    window = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    plain = rows.withColumn("b", F.coalesce(F.sum("w").over(window), F.lit(0)))
    assert got.exceptAll(plain).count() == 0


def test_counter_per_service_runs_over_days(spark):
    rows = [realised(f"2024-12-0{d} 0{h}:00:00", 10) for d in (2, 3) for h in (8, 9)]
    t = tables(spark, feeds=[feed()], trips_done=rows)
    daily = observed.observed_departures(t, CFG).orderBy("datetime_partida").collect()
    monthly = observed.observed_departures_by_service(t, CFG).orderBy("datetime_partida").collect()
    assert [r.viagens_consecutivas for r in daily] == [1, 2, 1, 2]
    assert [r.viagens_consecutivas for r in monthly] == [1, 2, 3, 4]
