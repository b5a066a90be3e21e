"""Stored tables: the match by day, totals, ranking and layout, against computing everything anew."""

import os
import re
from dataclasses import replace
from datetime import date

import pytest
from conftest import SMALL
from pyspark.sql import functions as F
from test_plans import plan

from pontualis.operators import matching, observed, timetable
from pontualis.plans import match_layout
from pontualis.plans.quality import QualityAnalysis, matched_trips
from pontualis.sources.day_store import DayStore
from pontualis.sources.star_tables import STAR_CONFIG, star_tables
from pontualis.sources.tables import TransitTables, read_tables, write_tables

CFG = STAR_CONFIG


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    write_tables(star_tables(spark, SMALL), path)
    return read_tables(spark, path)


def changed(tables, **frames):
    return TransitTables(**{n: frames.get(n, getattr(tables, n)) for n in TransitTables.__annotations__})


def same(a, b):
    a, b = (sorted(map(repr, f.collect())) for f in (a, b))
    return a == b


def files(store):
    """Data files of every day."""
    return {d: sorted(os.listdir(f"{store.table}/{d}")) for d in os.listdir(store.table) if d[0] not in "._"}


def test_a_changed_day_is_rewritten_alone(spark, stored, tmp_path):
    first = QualityAnalysis(stored, CFG, "regularity", str(tmp_path)).run()
    assert first.matched.count() == 345 and len(first.rewritten) > 20
    before = files(first.match_store)
    again = QualityAnalysis(stored, CFG, "trip", str(tmp_path)).run()
    assert again.rewritten == [] and files(again.match_store) == before and same(again.matched, first.matched)
    # Some trips of one day are missing now.
    day = date(2024, 1, 10)
    fewer = stored.realised.where((F.col("data") != day) | (F.minute("datetime_partida") < 40))
    new = changed(stored, realised=fewer)
    one = QualityAnalysis(new, CFG, cache_path=str(tmp_path)).run()
    assert one.rewritten == [day]
    after = files(one.match_store)
    assert {d for d in before if after.get(d) != before[d]} == {f"dia={day}"}
    assert same(one.matched, matched_trips(new, CFG)) and one.matched.count() < 345


def test_a_day_that_is_gone_and_an_empty_period(spark, stored, tmp_path):
    QualityAnalysis(stored, CFG, cache_path=str(tmp_path)).run()
    without = changed(stored, realised=stored.realised.where("day(data) <> 5"))
    got = QualityAnalysis(without, CFG, cache_path=str(tmp_path)).run()
    assert got.rewritten == [] and same(got.matched, matched_trips(without, CFG))
    nothing = changed(stored, realised=stored.realised.where("false"))
    assert QualityAnalysis(nothing, CFG, cache_path=str(tmp_path)).run().matched.collect() == []
    assert QualityAnalysis(nothing, CFG, cache_path=str(tmp_path / "new")).run().matched.collect() == []


def test_a_changed_timetable_changes_the_days_it_reaches(spark, stored, tmp_path):
    QualityAnalysis(stored, CFG, cache_path=str(tmp_path)).run()
    calendar = stored.calendar.where("data <> date'2024-01-17'")
    new = changed(stored, calendar=calendar)
    got = QualityAnalysis(new, CFG, cache_path=str(tmp_path)).run()
    assert date(2024, 1, 17) in got.rewritten and len(got.rewritten) <= 4
    assert same(got.matched, matched_trips(new, CFG))


def test_trips_that_leave_after_midnight_of_their_service_day(spark, stored, tmp_path):
    late = stored.realised.withColumn("datetime_partida", F.when(
        F.hour("datetime_partida") >= 23, F.col("datetime_partida") + F.expr("interval 2 hours"))
        .otherwise(F.col("datetime_partida")))
    new = changed(stored, realised=late.unionByName(late.where("day(data) = 9")))
    got = QualityAnalysis(new, CFG, cache_path=str(tmp_path)).run()
    assert same(got.matched, matched_trips(new, CFG))
    fewer = changed(new, realised=new.realised.where("day(data) <> 9 OR minute(datetime_partida) > 20"))
    got = QualityAnalysis(fewer, CFG, cache_path=str(tmp_path)).run()
    assert set(got.rewritten) <= {date(2024, 1, 9), date(2024, 1, 10)}
    assert same(got.matched, matched_trips(fewer, CFG))


def test_trips_without_a_departure_time(spark, stored, tmp_path):
    def without_time(day):
        return F.when(F.dayofmonth("data") == day, F.col("datetime_partida").isNull()
                      | (F.minute("datetime_partida") < 30)).otherwise(False)

    def emptied(day):
        return changed(stored, realised=stored.realised.withColumn(
            "datetime_partida", F.when(~without_time(day), F.col("datetime_partida"))))

    some = emptied(9)
    got = QualityAnalysis(some, CFG, cache_path=str(tmp_path)).run()
    assert same(got.matched, matched_trips(some, CFG)) and None not in got.rewritten
    assert QualityAnalysis(some, CFG, cache_path=str(tmp_path)).run().rewritten == []
    # The trips without a time are counted: other ones change the days of their service day.
    got = QualityAnalysis(stored, CFG, cache_path=str(tmp_path)).run()
    assert got.rewritten == [date(2024, 1, 9)] and same(got.matched, matched_trips(stored, CFG))


def test_parameters_have_stores_of_their_own_and_force_rewrites_all(spark, stored, tmp_path):
    path = str(tmp_path)
    first = QualityAnalysis(stored, CFG, cache_path=path).run()
    assert QualityAnalysis(stored, replace(CFG, weight_travel=1.0), cache_path=path) \
        .match_store.root == first.match_store.root
    for change in ({"association_factor": 0.5}, {"feed_floor": "2024-01-16"},
                   {"end_date": date(2024, 1, 9)}):
        assert QualityAnalysis(stored, replace(CFG, **change), cache_path=path) \
            .match_store.root != first.match_store.root
    narrow = QualityAnalysis(stored, replace(CFG, counter_tolerance=0), cache_path=path)
    assert 0 < narrow.run().matched.count() < 345
    assert first.run(force=True).rewritten == sorted(first.match_store.manifest())
    assert first.run(refresh=False).matched.count() == 345


def test_a_write_that_broke_off_is_done_again(spark, tmp_path):
    schema = spark.range(0).schema
    store = DayStore(spark, str(tmp_path), schema)
    days = {date(2024, 1, k): f"v{k}" for k in (1, 2, 3)}

    def rows(wanted):
        return spark.createDataFrame([(k, date(2024, 1, k)) for k in (1, 2, 2, 3)], "id long, dia date") \
            .where(F.col("dia").isin(wanted))

    def breaks(wanted):
        raise OSError

    with pytest.raises(OSError):
        store.refresh(days, breaks)
    assert store.read().count() == 0
    assert store.refresh(days, rows) == sorted(days) and store.read().count() == 4
    with pytest.raises(OSError):  # the table of day 2 is replaced, its note in the manifest is not
        store._replace(rows([date(2024, 1, 2)]).limit(1), store.table)
        breaks(None)
    assert store.refresh(days | {date(2024, 1, 2): "new"}, rows) == [date(2024, 1, 2)]
    assert store.read().count() == 4 and store.read([date(2024, 1, 2)]).count() == 2
    # A day without rows, and one that is no longer there.
    assert store.refresh({date(2024, 1, 2): "new", date(2024, 1, 7): "x"}, rows) == [date(2024, 1, 7)]
    assert store.read().count() == 2


def test_rankings_from_stored_totals_equal_those_from_trips(spark, stored, tmp_path):
    a = QualityAnalysis(stored, CFG, "regularity", str(tmp_path)).run()
    assert same(a.final_ranking_of(), a.final_ranking())
    days = [date(2024, 1, k) for k in range(3, 12)]
    part = QualityAnalysis(changed(stored, realised=stored.realised.where(F.col("data").isin(days))),
                           CFG, "regularity")
    assert same(a.final_ranking_of(days), part.run().final_ranking())
    text = plan(a.final_ranking_of(days))
    assert "datetime_partida" not in text and "PartitionFilters" in text
    # Only the totals of a changed day are computed again.
    before = files(a.stored_totals)
    new = changed(stored, realised=stored.realised.where("day(data) <> 10 OR minute(datetime_partida) < 40"))
    b = QualityAnalysis(new, CFG, "regularity", str(tmp_path)).run()
    assert same(b.final_ranking_of(), b.final_ranking())
    after = files(b.stored_totals)
    assert {d for d in before if after.get(d) != before[d]} <= {"dia=2024-01-10"}
    with pytest.raises(ValueError):
        QualityAnalysis(stored, CFG, "trip", str(tmp_path)).final_ranking_of()


def test_a_lookup_reads_the_stored_ranking_alone(spark, stored, tmp_path):
    a = QualityAnalysis(stored, CFG, "trip", str(tmp_path)).run()
    ranking = a.service_ranking().collect()
    assert {r.servico: a.service_score(f" {r.servico} ") for r in ranking} == \
        {r.servico: r.indicador for r in ranking}
    assert a.service_score("none") == -1
    text = plan(a.stored_ranking.lookup(" 0001 "))
    assert "tempo_viagem" not in text and re.search(r"PushedFilters: \[.*EqualTo\(nome,0001\)", text)
    requested = spark.createDataFrame([(" 0001 ",), ("none",), (None,)], "servico string")
    lazy = QualityAnalysis(stored, CFG, "trip").run().service_scores(requested)
    assert same(a.service_scores(requested), lazy)
    assert "tempo_viagem" not in plan(a.service_scores(requested))
    # Another weight has another ranking.
    other = QualityAnalysis(stored, replace(CFG, weight_travel=5.0), "trip", str(tmp_path))
    assert other.run().stored_ranking.path != a.stored_ranking.path


def test_stored_sides_join_without_a_shuffle(spark, stored, tmp_path):
    match_layout.write_layout(stored, CFG, "layout_test", str(tmp_path), buckets=4)
    frame = match_layout.match_stored(spark, "layout_test", CFG)
    assert same(frame, matched_trips(stored, CFG))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(match_layout.match_stored(spark, "layout_test", CFG))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    below = text[text.index("SortMergeJoin"):]
    assert "Exchange" not in below and below.count("Bucketed: true") == 2
    spark.sql("DROP TABLE layout_test_trips")
    spark.sql("DROP TABLE layout_test_windows")


def test_the_left_match_has_one_pair_join(spark, stored):
    windows = timetable.numbered_windows(stored, CFG)
    left = matching.match_left(windows, observed.observed_departures(stored, CFG), CFG)
    inner = matching.match_windows(windows, observed.observed_departures(stored, CFG), CFG)
    assert plan(left).count("Join ") == plan(inner).count("Join ")
    # Trips without a time, and with keys that are NULL, stay.
    real = observed.observed_departures(stored, CFG)
    cut = real.withColumn("datetime_partida", F.when(F.col("viagens_consecutivas") > 0, F.lit(None))
                          .otherwise(F.col("datetime_partida")))
    alone = matching.match_left(windows, cut, CFG)
    assert alone.where("servico_VP IS NOT NULL").count() == 0 and alone.count() > 0
