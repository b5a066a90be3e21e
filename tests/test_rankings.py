import random
import statistics
from datetime import datetime, timedelta

import pytest
from helpers import CFG, ts
from pyspark.sql import functions as F

from pontualis import schemas
from pontualis.operators import rankings, regularity, rush, scoring

DIGITS = 10


def scored(spark, rows):
    return spark.createDataFrame(rows, schemas.SCORED)


def counts(spark, hours):
    return spark.createDataFrame(list(hours.items()), "hora bigint, viagens bigint")


def rush_of(spark, hours, cut=0.75, deviation=0.5):
    return {r.hora for r in rush.rush_by_half(counts(spark, hours), cut, deviation).collect()}


def test_equal_hours_split_by_gap(spark):
    # Hours 7, 8 and 17 keep equal counts; 7 and 8 share a gap, 17 has its own.
    low = {h: 1 for h in (0, 1, 2)}
    assert rush_of(spark, {7: 90, 8: 90, 17: 90}) == {7, 17}
    assert rush_of(spark, {**low, 7: 90, 8: 90, 17: 90}) == {7, 17}


def test_single_hour_has_no_deviation(spark):
    assert rush_of(spark, {8: 100}) == set()


def test_halves_are_positional(spark):
    few = rush.positional_halves(counts(spark, {h: 5 for h in range(10, 20)})).collect()
    assert {r.metade for r in few} == {"manha"}
    many = rush.positional_halves(counts(spark, {h: 5 for h in range(5, 23)})).collect()
    assert sorted(r.hora for r in many if r.metade == "tarde") == list(range(17, 23))


def rush_in_python(hours, cut, deviation):
    """Independent formulation over plain lists."""
    ordered = sorted(hours)
    mean = sum(hours.values()) / len(hours)
    found = set()
    for half in (ordered[:12], ordered[12:]):
        kept = [h for h in half if hours[h] >= mean * cut]
        if len(kept) < 2:
            continue
        level = statistics.mean(hours[h] for h in kept) \
            + statistics.stdev([hours[h] for h in kept]) * deviation
        kept = [h for h in kept if hours[h] >= level]
        groups = {}
        for i, h in enumerate(kept):
            before = kept[i - 1] if i else 0
            after = kept[i + 1] if i + 1 < len(kept) else 0
            groups.setdefault(min(abs(h - before), abs(h - after)), []).append(h)
        found |= {max(g, key=lambda h: (hours[h], -h)) for g in groups.values()}
    return found


@pytest.mark.parametrize("seed", range(6))
def test_rush_hours_of_random_days(spark, seed):
    rng = random.Random(seed)
    hours = {h: rng.randint(1, 900) for h in rng.sample(range(24), rng.randint(1, 24))}
    assert rush_of(spark, hours) == rush_in_python(hours, 0.75, 0.5)
    assert rush_of(spark, hours, 0.2, 0.0) == rush_in_python(hours, 0.2, 0.0)


def test_minmax_of_equal_scores_is_null(spark):
    rows = scored(spark, [("a", 0.5, ts("2024-12-01 05:00:00"))] * 3)
    assert {r.score for r in scoring.minmax_normalise(rows, "score").collect()} == {None}


def test_ranking_orders_ties_by_service_and_nulls_last(spark):
    at = ts("2024-12-01 05:00:00")
    rows = scored(spark, [("b", 0.4, at), ("a", 0.4, at), ("c", 1.0, at), ("z", None, at),
                          (None, 1.0, at), ("d", 0.0, at), ("d", 0.2, at)])
    got = rankings.service_ranking(rows, DIGITS).orderBy("posicao").collect()
    assert [tuple(r) for r in got] == [
        (1, "c", 1.0), (2, "a", 0.4), (3, "b", 0.4), (4, "d", 0.1), (5, "z", None)]
    assert [r.posicao for r in rankings.ranking_bottom(
        rankings.service_ranking(rows, DIGITS), 2).collect()] == [5, 4]


def test_service_lookup(spark):
    ranking = spark.createDataFrame([(1, "006", 0.9), (2, " 006", 0.8), (3, "7", 0.1)],
                                    "posicao bigint, servico string, indicador double")
    requested = spark.createDataFrame([(" 006 ",), ("999",), ("7",)], "servico string")
    got = {r.servico: r.indicador for r in rankings.service_scores(ranking, requested).collect()}
    assert got == {" 006 ": 0.9, "999": -1.0, "7": 0.1}


def random_scores(seed, n=4000, hot=False):
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        at = datetime(2024, 12, 1) + timedelta(seconds=rng.randint(0, 86400 * 20))
        service = "hot" if hot and k % 3 == 0 else f"s{rng.randint(0, 30):02d}"
        rows.append((service, rng.randint(-4, 40) / 28, at))
    return rows


def test_best_and_worst_trip_per_band(spark):
    rows = random_scores(1, hot=True)
    for best in (True, False):
        got = {r.SubFaixa15: (r.servico, r.score, r.data_partida)
               for r in rankings.trip_per_quarter(scored(spark, rows), best).collect()}
        groups = {}
        for r in rows:
            groups.setdefault((r[2].hour * 60 + r[2].minute) // 15, []).append(r)
        assert len(got) == len(groups)
        for band, group in groups.items():
            label = (f"{band // 4:02d}:{band % 4 * 15:02d}:00 - "
                     f"{(band + 1) % 96 // 4:02d}:{(band + 1) % 4 * 15:02d}:00")
            assert got[label] == min(group, key=lambda r: (-r[1] if best else r[1], r[2], r[0]))


def test_best_service_per_hour(spark):
    rows = random_scores(2)
    means = {}
    for s, score, at in rows:
        means.setdefault((at.hour, s), []).append(score)
    means = {k: round(statistics.fmean(v), DIGITS) for k, v in means.items()}
    got = {r.hora: (r.servico, r.score)
           for r in rankings.service_per_hour(scored(spark, rows), DIGITS).collect()}
    for hour in {h for h, _ in means}:
        service = min((k[1] for k in means if k[0] == hour), key=lambda s: (-means[hour, s], s))
        assert got[hour] == (service, pytest.approx(means[hour, service]))


def test_final_ranking_against_plain_python(spark):
    rows = random_scores(3, hot=True)
    weighted = {}
    for bucket in (lambda t: t.hour, lambda t: (t.hour, t.minute // 15)):
        groups, totals = {}, {}
        for s, score, at in rows:
            groups.setdefault((bucket(at), s), []).append(score)
            totals[bucket(at)] = totals.get(bucket(at), 0) + 1
        parts = {}
        for (b, s), v in groups.items():
            parts.setdefault(s, []).append(statistics.fmean(v) * len(v) / totals[b])
        for s, v in parts.items():
            weighted[s] = weighted.get(s, 0) + statistics.fmean(v)
    low, high = min(weighted.values()), max(weighted.values())
    order = sorted(weighted, key=lambda s: (-round(weighted[s], DIGITS), s))
    got = regularity.final_ranking(scored(spark, rows), DIGITS).orderBy("posicao").collect()
    assert [r.servico for r in got] == order
    for r in got:
        assert r.score == pytest.approx((weighted[r.servico] - low) / (high - low) * 100, abs=1e-3)
    check_ranking(got)


def check_ranking(rows):
    """Properties of every final ranking."""
    assert [r.posicao for r in rows] == list(range(1, len(rows) + 1))
    values = [r.score for r in rows]
    assert values == sorted(values, reverse=True)
    assert values[0] == 100.0 and values[-1] == 0.0
    assert all(round(v, 3) == v for v in values)


def test_many_services_are_numbered_without_gaps(spark):
    services = spark.range(20000).select(
        F.concat(F.lit("s"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("servico"),
        (F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.rand(5))).alias("score"))
    services = services.withColumn("score", F.round("score", 6)).cache()
    got = [tuple(r) for r in rankings.rank_position(services, "score", F.col("score"))
           .select("posicao", "servico").orderBy("posicao").collect()]
    rows = sorted(((r.servico, r.score) for r in services.collect()), key=lambda r: (-r[1], r[0]))
    assert got == [(i, s) for i, (s, _) in enumerate(rows, start=1)]


def test_scoring_modes(spark):
    matched = spark.createDataFrame([
        ("006", "006", ts("2024-12-02 08:00:00"), ts("2024-12-02 08:02:00"),
         ts("2024-12-02 08:20:00"), ts("2024-12-02 08:21:00"), 30, 10),
        ("007", "007", ts("2024-12-02 08:00:00"), ts("2024-12-02 08:30:00"),
         ts("2024-12-02 08:20:00"), ts("2024-12-02 09:21:00"), 10, 90)], schemas.MATCHED)
    plain = {r.servico: r.score
             for r in scoring.score_matches(matched, CFG, "regularity").collect()}
    # Both on time: 2 * 8/14; travel 1.25 - 0.5.  Both late: 0; travel 0 - 1.25.
    assert plain["006"] == pytest.approx(2 * 8 / 14 + 0.75 * 2 / 14)
    assert plain["007"] == pytest.approx(-1.25 * 2 / 14)
    scaled = {r.servico: r.score for r in scoring.score_matches(matched, CFG, "trip").collect()}
    assert scaled == {"006": 1.0, "007": 0.0}
    with pytest.raises(ValueError):
        scoring.score_matches(matched, CFG, "other")


def test_null_scores_rank_behind_negative_ones(spark):
    values = [("a", 0.5), ("b", -0.2), ("c", None), ("d", -0.1), ("e", None), ("f", -3 / 14)]
    frame = spark.createDataFrame(values, "servico string, score double")
    ranked = rankings.rank_position(frame, "score", F.col("score")).orderBy("posicao").collect()
    assert [r.servico for r in ranked] == ["a", "d", "b", "f", "c", "e"]
    assert [r.posicao for r in ranked] == [1, 2, 3, 4, 5, 6]
