import random
from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest
from helpers import CFG, agency, day, feed, frequency, realised, route, tables, trip, ts

from pontualis.operators import matching, observed, timetable

PLANNED = ("consorcio string, trip_id string, sentido string, servico_realizado string, "
           "viagens_consecutivas bigint, datetime_partida timestamp_ntz, "
           "datetime_chegada timestamp_ntz, tempo_viagem bigint")


def row(counter, departure, minutes, keys=("Intersul", "t", "I", "006")):
    return (*keys, counter, ts(departure), ts(departure), minutes)


def both(spark, planned, real, cfg=CFG):
    p, r = spark.createDataFrame(planned, PLANNED), spark.createDataFrame(real, PLANNED)
    plain = matching.match_plain(p, r, cfg)
    cells = matching.match_departures(p, r, cfg)
    assert plain.exceptAll(cells).count() == 0 and cells.exceptAll(plain).count() == 0
    return plain.collect()


def test_band_rounds_half_away_and_is_inclusive(spark):
    real = [row(3, "2024-12-02 08:00:00", 10)]
    planned = [row(3, f"2024-12-02 {t}", 180) for t in
               ("07:56:59", "07:57:00", "08:03:00", "08:03:01")]
    got = sorted(str(m.datetime_partida_VP)[11:] for m in both(spark, planned, real))
    assert got == ["07:57:00", "08:03:00"]


def test_counters_differ_by_five_at_most(spark):
    real = [row(10, "2024-12-02 08:00:00", 40)]
    planned = [row(c, "2024-12-02 08:00:00", c * 10) for c in (4, 5, 15, 16)]
    assert sorted(m.tempo_viagem_VP for m in both(spark, planned, real)) == [50, 150]


def test_null_keys_never_match(spark):
    keys = (None, "t", "I", "006")
    assert both(spark, [row(1, "2024-12-02 08:00:00", 40, keys)],
                [row(1, "2024-12-02 08:00:00", 40, keys)]) == []


def test_left_match_keeps_realised_trips_without_partner(spark):
    p = spark.createDataFrame([row(1, "2024-12-02 08:00:00", 40)], PLANNED)
    r = spark.createDataFrame([row(1, "2024-12-02 08:00:00", 40),
                               row(1, "2024-12-03 08:00:00", 40)], PLANNED)
    rows = matching.match_plain(p, r, CFG, "left").orderBy("datetime_partida_VR").collect()
    assert [x.tempo_viagem_VP for x in rows] == [40, None]
    assert [x.service_VR for x in rows] == ["006", "006"]


def random_month(spark, seed, hot):
    """Lines with odd headways and windows; ``hot`` gives one trip a third of all rows."""
    rng = random.Random(seed)
    lines = [f"{k:03d}" for k in range(6)]
    trips, frequencies, routes = [], [], []
    for k, line in enumerate(lines):
        routes.append(route(f"R{k}", "A1" if k % 3 else "A2", line))
        for direction in "01":
            name = f"{line}-{direction}"
            trips.append(trip(name, "U_REG", line, direction, f"R{k}"))
            for _ in range(rng.randint(1, 5)):
                start, length = rng.randint(0, 28 * 60), rng.randint(1, 400)
                end = start + length
                frequencies.append(frequency(
                    f"{start // 60:02d}:{start % 60:02d}:{rng.choice([0, 0, 30]):02d}",
                    f"{end // 60:02d}:{end % 60:02d}:00",
                    rng.choice([0, 29, 60, 90, 600, 725, 1200, 5400, 9000]), name))
    done = []
    for n in range(1500):
        line = lines[0] if hot and n % 3 == 0 else rng.choice(lines)
        direction = "0" if hot and n % 3 == 0 else rng.choice("01")
        start = datetime(2024, 12, 2 + n % 3) + timedelta(seconds=rng.randint(0, 86399))
        done.append(realised(
            str(start), rng.randint(1, 120), f"{line}-{direction}", line,
            rng.choice(["Intersul", "Intersul", None]) if int(line) % 3 else "Internorte",
            "I" if direction == "0" else "V",
            datetime_chegada=start + timedelta(minutes=rng.randint(1, 99))))
    return tables(spark, trips, frequencies, routes,
                  [agency("A1"), agency("A2", "Internorte")], [feed()],
                  [day(date(2024, 12, d), ["U_REG"]) for d in (2, 3, 4, 5)], done)


@pytest.mark.parametrize("seed,hot,cell", [(1, False, 60), (2, True, 60), (3, True, 7)])
def test_all_three_matches_agree(spark, seed, hot, cell):
    cfg = replace(CFG, match_cell_minutes=cell, numbering_cell_minutes=cell)
    t = random_month(spark, seed, hot)
    windows = timetable.numbered_windows(t, cfg)
    planned = timetable.planned_departures(t, cfg).cache()
    real = observed.observed_departures(t, cfg).cache()
    brute = brute_force(planned.collect(), real.collect(), cfg)
    assert len(brute) > 40
    for got in (matching.match_plain(planned, real, cfg),
                matching.match_departures(planned, real, cfg),
                matching.match_windows(windows, real, cfg)):
        assert sorted(tuple(r) for r in got.collect()) == brute


def brute_force(planned, real, cfg):
    found = set()
    for r in real:
        band = timedelta(minutes=int(r.tempo_viagem * cfg.association_factor + 0.5))
        for p in planned:
            if (p.consorcio is not None and p.consorcio == r.consorcio
                    and p.trip_id == r.trip_id and p.sentido == r.sentido
                    and p.servico_realizado == r.servico_realizado
                    and abs(p.datetime_partida - r.datetime_partida) <= band
                    and abs(p.viagens_consecutivas - r.viagens_consecutivas)
                    <= cfg.counter_tolerance):
                found.add((p.servico_realizado, r.servico_realizado, p.datetime_partida,
                           r.datetime_partida, p.datetime_chegada, r.datetime_chegada,
                           p.tempo_viagem, r.tempo_viagem))
    return sorted(found)


def test_fractions_of_a_second(spark):
    t = tables(spark, [trip()], [frequency("05:00:00", "06:00:00", 1200)], [route()], [agency()],
               [feed()], [day(date(2024, 12, 2), ["U_REG"])],
               [realised("2024-12-02 05:18:00", 8,
                         datetime_partida=datetime(2024, 12, 2, 5, 18, 0, 500000)),
                realised("2024-12-02 05:22:00", 8,
                         datetime_partida=datetime(2024, 12, 2, 5, 22, 0, 500000))])
    real = observed.observed_departures(t, CFG)
    planned = timetable.planned_departures(t, CFG)
    windows = matching.match_windows(timetable.numbered_windows(t, CFG), real, CFG).collect()
    assert windows == matching.match_plain(planned, real, CFG).collect()
    assert [m.datetime_partida_VR.minute for m in windows] == [18]
