"""What must not grow with the tables: broadcasts, the rows of one task, shuffles of departures."""

import re
from datetime import date

from conftest import SMALL
from helpers import CFG, agency, day, frequency, route, tables, trip
from pyspark.sql import functions as F

from pontualis.operators import matching, observed, timetable
from pontualis.plans import match_layout
from pontualis.plans.registry import QUERIES
from pontualis.sources import star_tables as star


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_growing_sides_are_never_broadcast(spark):
    """What multiplies inside a query looks small to Spark: trips, frequencies and routes."""
    for name in ("departure_count", "join_trips_frequencies", "join_right_routes",
                 "audit_duplicates", "audit_feed_floor_sweep", "planned_month_departures"):
        joins = re.findall(r"BroadcastHashJoin \[(.*?)\]", plan(QUERIES[name](spark, SMALL)))
        # Left are the active feeds (by date), agencies and calendar days.
        assert not [k for k in joins if "trip_id" in k or "route_id" in k], name


def test_suppliers_are_spread_before_they_multiply(spark, monkeypatch):
    monkeypatch.setattr(star, "_TASK_SUPPLIERS", 1)
    t = star.star_tables(spark, SMALL)
    for frame in (t.trips, t.frequencies, t.routes):
        assert frame.groupBy(F.spark_partition_id()).count().count() >= 5


def _overlapping(spark):
    """Two services of one trip whose windows of an hour hold the counters 7-12, 13-18 and 4-9."""
    return tables(
        spark, trips=[trip(), trip(service="EXCEP")],
        frequencies=[frequency("05:00:00", "05:30:00", 600), frequency("05:00:00", "06:00:00", 600)],
        routes=[route()], agencies=[agency()],
        days=[day(date(2024, 12, 2), ["U_REG", "EXCEP"]), day(date(2024, 12, 2), ["U_REG"], tipo_os="Extra")])


def test_departures_listed_by_several_windows_appear_once(spark):
    t = _overlapping(spark)
    got = timetable.planned_departures(t, CFG)
    counters = sorted(r[0] for r in got.where("tempo_viagem = 60").select("viagens_consecutivas").collect())
    assert counters == list(range(4, 19))
    raw = timetable.generated_departures(timetable.numbered_windows(t, CFG))
    columns = [F.col("row_id").alias("viagens_consecutivas"),
               *[c for c in got.columns if c not in ("viagens_consecutivas", "id_viagem")]]
    expected = raw.select(*columns).distinct()
    assert raw.count() > expected.count() == got.count()
    assert got.drop("id_viagem").exceptAll(expected).isEmpty()
    month = timetable.planned_departures_by_trip(t, CFG)
    assert month.count() == month.distinct().count() > 0


def test_departures_are_not_shuffled(spark):
    for name in ("planned_sequence", "planned_month_departures", "planned_sequence_by_trip"):
        above = plan(QUERIES[name](spark, SMALL)).split("explode(sequence(primeira")[0]
        assert "Exchange" not in above and "Aggregate" not in above, name


def test_written_windows_are_not_broadcast_to_the_match(spark, tmp_path):
    """Packed files of windows are small; cut into cells in memory they are a hundred times that."""
    t = star.star_tables(spark, SMALL)
    timetable.numbered_windows(t, star.STAR_CONFIG).write.parquet(str(tmp_path / "windows"))
    trips = observed.observed_departures(t, star.STAR_CONFIG)
    windows = spark.read.parquet(str(tmp_path / "windows"))
    text = plan(matching.match_windows(windows, trips, star.STAR_CONFIG))
    assert not re.findall(r"BroadcastHashJoin \[[^]]*_slot", text) and "SortMergeJoin" in text


def test_counts_of_packed_matches_are_not_broadcast(spark):
    """Both sides of the yield hold a row per day and service; the stored match is packed."""
    joins = re.findall(r"BroadcastHashJoin \[(.*?)\]", plan(QUERIES["audit_match_yield"](spark, SMALL)))
    assert not [k for k in joins if "servico" in k]


def test_buckets_of_the_layout_grow_with_the_tables(spark, monkeypatch):
    """One task sorts one bucket, so a fixed number of buckets is a task that grows."""
    monkeypatch.setattr(match_layout, "BUCKET_ROWS", 200)
    t = star.star_tables(spark, SMALL)
    expected = -(-(t.frequencies.count() + t.realised.count()) // 200)
    got = QUERIES["join_band_match_bucketed"](spark, SMALL)
    assert expected > 8 and f"out of {expected}" in plan(got)
    rows = QUERIES["join_band_match"](spark, SMALL)
    assert rows.count() == got.count() and got.exceptAll(rows).isEmpty()
