from datetime import date

from helpers import CFG, agency, day, feed, frequency, route, tables, trip, ts
from pyspark.sql import functions as F

from pontualis.operators import audits, scans, timetable

DAY = date(2024, 12, 2)


def one_line(spark, *frequencies, **over):
    inputs = dict(trips=[trip()], frequencies=frequencies, routes=[route()],
                  agencies=[agency()], feeds=[feed()], days=[day(DAY, ["U_REG"])])
    return tables(spark, **(inputs | over))


def test_first_departure_is_one_headway_after_the_window_start(spark):
    rows = timetable.planned_departures(
        one_line(spark, frequency("05:00:00", "06:00:00", 1200)), CFG) \
        .orderBy("viagens_consecutivas").collect()
    assert [(r.viagens_consecutivas, r.datetime_partida, r.datetime_chegada) for r in rows] == [
        (1, ts("2024-12-02 05:20:00"), ts("2024-12-02 05:40:00")),
        (2, ts("2024-12-02 05:40:00"), ts("2024-12-02 06:00:00")),
        (3, ts("2024-12-02 06:00:00"), ts("2024-12-02 06:20:00"))]
    assert rows[0].id_viagem == "006-I-S6-20241202052000"
    assert rows[0].consorcio == "Intersul" and rows[0].servico_realizado == "006"


def test_windows_over_midnight(spark):
    rows = timetable.timetable_windows(one_line(
        spark, frequency("22:00:00", "25:00:00", 600), frequency("24:00:00", "26:00:00", 600),
        frequency("25:00", "26:00:00", 600), frequency("aa:bb:cc", "26:00:00", 600)), CFG).collect()
    assert [(r.datetime_partida, r.datetime_chegada, r.tempo_viagem) for r in rows] == [
        (ts("2024-12-03 00:00:00"), ts("2024-12-03 02:00:00"), 120)]


def test_windows_without_departures(spark):
    t = one_line(spark, frequency("05:00:00", "05:02:00", 1200),
                 frequency("06:00:00", "07:00:00", 20))
    assert timetable.timetable_windows(t, CFG).count() == 2
    assert timetable.expand_departures(timetable.timetable_windows(t, CFG)).count() == 0
    assert timetable.planned_departures(t, CFG).count() == 0


def test_copies_of_every_input_collapse(spark):
    plain = one_line(spark, frequency("05:00:00", "06:00:00", 1200))
    copied = one_line(
        spark, *[frequency("05:00:00", "06:00:00", 1200)] * 3,
        frequency("5:00:00", "06:00:00", 1210), trips=[trip()] * 4,
        routes=[route(), route(line="006"), route()], agencies=[agency()] * 2,
        days=[day(DAY, ["U_REG", "U_REG"]),
              day(DAY, ["U_REG"], datetime_ultima_atualizacao=ts("2024-12-09 00:00:00"))])
    columns = timetable.timetable_windows(plain, CFG).columns
    assert timetable.timetable_windows(copied, CFG).select(*columns).collect() \
        == timetable.timetable_windows(plain, CFG).collect()
    audit = audits.timetable_duplicates(copied, CFG).first()
    assert (audit.linhas, audit.linhas_distintas) == (4 * 4 * 3 * 3, 1)


def test_other_agencies_keep_a_null_consortium(spark):
    t = one_line(spark, frequency("05:00:00", "06:00:00", 1200),
                 agencies=[agency(name="Other")])
    assert [r.consorcio for r in timetable.timetable_windows(t, CFG).collect()] == [None]


def test_line_names_must_agree_and_feeds_be_active(spark):
    assert timetable.timetable_windows(one_line(
        spark, frequency("05:00:00", "06:00:00", 1200), routes=[route(line="007")]),
        CFG).count() == 0
    old = dict(feed_version="2024-11-05")
    assert timetable.timetable_windows(one_line(
        spark, frequency("05:00:00", "06:00:00", 1200, **old), trips=[trip(**old)],
        routes=[route(**old)], days=[day(DAY, ["U_REG"], **old)]), CFG).count() == 0


def test_calendar_arrays(spark):
    t = one_line(spark, days=[day(DAY, None), day(date(2024, 12, 3), []),
                              day(date(2024, 12, 4), ["a"]),
                              day(date(2024, 12, 5), ["a", "a"]),
                              day(date(2025, 1, 1), ["a"])])
    rows = scans.scan_calendar(t, CFG).orderBy("data").collect()
    assert [(r.data.day, r.service_id) for r in rows] == [(4, "a"), (5, "a")]


def test_counter_runs_over_windows_with_the_same_start(spark):
    t = one_line(spark, frequency("05:00:00", "06:00:00", 1200),
                 frequency("05:00:00", "05:30:00", 600))
    rows = timetable.planned_departures(t, CFG).orderBy("viagens_consecutivas").collect()
    # The shorter window sorts first: three departures, then three of the longer one.
    assert [r.viagens_consecutivas for r in rows] == [1, 2, 3, 4, 5, 6]
    assert [r.tempo_viagem for r in rows] == [30, 30, 30, 60, 60, 60]
    assert rows[3].datetime_partida == ts("2024-12-02 06:20:00")


def test_month_long_counter_drifts(spark):
    t = one_line(spark, frequency("05:00:00", "06:00:00", 1200),
                 days=[day(DAY, ["U_REG"], subtipo_dia="Verao"),
                       day(date(2024, 12, 3), ["U_REG"])])
    rows = timetable.planned_departures_by_trip(t, CFG, "row_id").orderBy("row_id").collect()
    assert [r.row_id for r in rows] == [1, 2, 3, 4, 5, 6]
    assert rows[3].datetime_partida == ts("2024-12-03 06:20:00")
    windows = timetable.standalone_windows(t, CFG).orderBy("data").collect()
    assert [w.tipo_os for w in windows] == ["Verao", None]


def test_containment_counts(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (1,), (3,), (None,)], "k int")
    row = audits.join_containment(left, right, ["k"]).first()
    assert row == (6, 2, 2, 8, 8)
    for how, count in (("inner", 6), ("left", 8), ("right", 8)):
        assert left.join(right, "k", how).count() == count


def test_floor_sweep_counts_every_floor(spark):
    late = dict(feed_version="2024-12-10", feed_start_date=date(2024, 12, 10))
    t = one_line(spark, frequency("05:00:00", "06:00:00", 1200),
                 frequency("05:00:00", "06:00:00", 1200, **late), trips=[trip(), trip(**late)],
                 routes=[route(), route(**late)],
                 days=[day(DAY, ["U_REG"]), day(date(2024, 12, 10), ["U_REG"], **late),
                       day(date(2024, 12, 11), ["U_REG"], **late)])
    rows = {r.feed_version: (r.linhas, r.linhas_com_piso)
            for r in audits.feed_floor_sweep(t, CFG).collect()}
    assert rows == {"2024-12-10": (2, 2), "2024-12-01": (1, 3)}


def test_column_quality(spark):
    frame = spark.createDataFrame([("1", "a "), ("x", None), (None, "b")], "p string, q string")
    rows = audits.column_quality(frame, ["p", "q"]).collect()
    assert [tuple(r) for r in rows] == [("p", 3, 1, 0, 1), ("q", 3, 1, 1, 2)]


def test_empty_arrays_of_feeds(spark):
    t = one_line(spark, days=[])
    row = scans.sorted_array(scans.active_feeds(t.calendar, CFG), "feed_start_date", "feeds")
    assert row.first().feeds == []
    assert timetable.planned_departures(t, CFG).agg(F.count("*")).first()[0] == 0
