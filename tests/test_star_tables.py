"""Transit tables derived from suppliers with large numbers and gaps."""

from datetime import datetime, timedelta

import duckdb
import pytest

from oracle.statements import ORACLE_SQL
from pontualis.config import AnalysisConfig
from pontualis.operators import explore, matching, observed, timetable
from pontualis.plans.registry import QUERIES
from pontualis.sources.star_tables import STAR_CONFIG, star_tables

KEYS = (0, 3, 999, 1000, 9999, 10000, 10001, 70000)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("star"))
    duck = duckdb.connect()
    duck.execute("CREATE TABLE supplier (s_suppkey BIGINT, s_nationkey INTEGER)")
    duck.executemany("INSERT INTO supplier VALUES (?, ?)", [(k, i % 5) for i, k in enumerate(KEYS)])
    duck.execute("CREATE TABLE region (r_regionkey INTEGER)")
    duck.executemany("INSERT INTO region VALUES (?)", [(i,) for i in range(5)])
    duck.execute("CREATE TABLE events (event_id BIGINT, ts TIMESTAMP, user_id BIGINT, value DOUBLE)")
    start = datetime(2024, 1, 2, 5)
    duck.executemany("INSERT INTO events VALUES (?, ?, ?, ?)", [
        (i, start + timedelta(minutes=37 * i), i, 1.5) for i in range(160)])
    for table in ("supplier", "region", "events"):
        duck.execute(f"COPY {table} TO '{path}/{table}.parquet' (FORMAT parquet)")
    return path


def test_long_line_names_stay_whole_and_gaps_lose_no_event(spark, folder):
    tables = star_tables(spark, folder)
    lines = {r[0] for r in tables.trips.select("trip_short_name").distinct().collect()}
    assert lines == {"0000", "0003", "0999", "1000", "9999", "10000", "10001", "70000"}
    assert tables.trips.select("trip_id").distinct().count() == len(KEYS) * 8
    assert tables.realised.count() == 160


@pytest.mark.parametrize("name", ["join_trips_frequencies", "realised_sequence", "join_band_match",
                                  "join_band_match_left", "audit_feed_floor_sweep"])
def test_equals_sql(spark, folder, name):
    duck = duckdb.connect()
    for table in ("supplier", "region", "events"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    frame, expected = QUERIES[name](spark, folder), duck.sql(ORACLE_SQL[name])
    order = [expected.columns.index(c) for c in frame.columns]
    got = sorted(tuple(map(str, r)) for r in frame.collect())
    assert got == sorted(tuple(str(r[i]) for i in order) for r in expected.fetchall())


def test_left_match_equals_the_plain_form(spark, folder):
    tables, cfg = star_tables(spark, folder), STAR_CONFIG
    real = observed.observed_departures(tables, cfg)
    left = matching.match_left(timetable.numbered_windows(tables, cfg), real, cfg)
    plain = matching.match_plain(timetable.planned_departures(tables, cfg), real, cfg, "left")
    assert sorted(map(str, left.collect())) == sorted(map(str, plain.select(*left.columns).collect()))


def test_counted_copies_of_realised_trips_are_all_returned(spark, folder, monkeypatch):
    monkeypatch.setattr(explore, "_COPIES", 3)
    tables, cfg = star_tables(spark, folder), AnalysisConfig(
        STAR_CONFIG.start_date, STAR_CONFIG.end_date)
    got = explore.explore_trips_realised(tables, cfg)
    realised = tables.realised.where("data between '2024-01-01' and '2024-01-30'").select("trip_id")
    expected = tables.trips.join(realised, "trip_id").select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
