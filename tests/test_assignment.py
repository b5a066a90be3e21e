"""One-to-one association against a greedy run over all pairs, and stability."""

import random

from conftest import SMALL
from helpers import ts
from pyspark.sql import functions as F

from pontualis.operators import assignment, matching, observed, timetable
from pontualis.sources.star_tables import STAR_CONFIG, star_tables


def greedy(pairs):
    taken, left, right = [], set(), set()
    for a, b, *order in sorted(pairs, key=lambda p: p[2:]):
        if a not in left and b not in right:
            taken.append((a, b))
            left.add(a)
            right.add(b)
    return sorted(taken)


def test_random_pairs_equal_the_greedy_assignment(spark):
    for seed, (n, m, size) in enumerate([(8, 8, 20), (30, 25, 200), (40, 3, 80), (1, 1, 1), (5, 5, 0)]):
        rng = random.Random(seed)
        found = {(rng.randrange(n), rng.randrange(m)) for _ in range(size)}
        pairs = [(a, b, rng.randrange(4), a * 1000 + b) for a, b in found]
        frame = spark.createDataFrame(pairs, "a int, b int, distance int, tie int")
        got = assignment.mutual_best(frame, ["a"], ["b"], ["distance", "tie"])
        assert sorted((r.a, r.b) for r in got.collect()) == greedy(pairs)


def test_a_long_chain_of_ever_closer_pairs(spark):
    """Each pair but the last is worse for its departure than the next one."""
    n = 12
    pairs = [(i, i, 2 * (n - i), i) for i in range(n)] + [(i, i + 1, 2 * (n - i) - 1, i) for i in range(n - 1)]
    frame = spark.createDataFrame(pairs, "a int, b int, distance int, tie int")
    got = assignment.mutual_best(frame, ["a"], ["b"], ["distance", "tie"])
    assert sorted((r.a, r.b) for r in got.collect()) == greedy(pairs)


def test_trips_and_departures_are_used_once_and_no_better_pair_is_left(spark):
    tables = star_tables(spark, SMALL)
    pairs = matching.candidate_pairs(timetable.numbered_windows(tables, STAR_CONFIG),
                                     observed.observed_departures(tables, STAR_CONFIG), STAR_CONFIG)
    rows = [r.asDict() for r in pairs.collect()]
    got = [r.asDict() for r in assignment.one_to_one(pairs).collect()]

    def key(row, side):
        return tuple(row[c] for c in side)

    trips = {key(r, assignment.TRIP): r for r in got}
    departures = {key(r, assignment.DEPARTURE): r for r in got}
    assert len(trips) == len(departures) == len(got) > 100
    by_pair = {(key(r, assignment.TRIP), key(r, assignment.DEPARTURE)): r for r in rows}
    order = {p: key(r, assignment.ORDER) for p, r in by_pair.items()}
    for trip, departure in by_pair:
        held = [order[key(r, assignment.TRIP), key(r, assignment.DEPARTURE)]
                for r in (trips.get(trip), departures.get(departure)) if r]
        assert held and min(held) <= order[trip, departure]


def test_closer_counters_decide_between_equal_distances(spark):
    schema = ", ".join(f"{c} string" for c in matching.MATCH_KEYS) + ", " + ", ".join(
        f"{c} {'bigint' if c.startswith('tempo') else 'timestamp_ntz'}" for c in matching.MATCHED_TIMES) \
        + ", distancia_contador bigint, distancia_segundos bigint"

    def pair(planned, done, counter, seconds):
        p, d = ts(f"2024-12-02 {planned}"), ts(f"2024-12-02 {done}")
        return ("c", "t", "I", "006", p, d, p, d, 10, 20, counter, seconds)

    frame = spark.createDataFrame([pair("08:00:00", "08:05:00", 3, 300), pair("08:10:00", "08:05:00", 1, 300),
                                   pair("08:10:00", "08:16:00", 0, 360)], schema)
    got = assignment.one_to_one(frame).select(F.minute("datetime_partida_VP"), F.minute("datetime_partida_VR"))
    assert sorted(map(tuple, got.collect())) == [(10, 5)]
