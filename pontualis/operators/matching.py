"""Association of realised trips with planned departures.

A planned departure matches a realised one of the same consortium, trip,
direction and service when it lies within ``association_factor`` of the
realised duration around the realised departure, and when their counters
differ by at most ``counter_tolerance``.  The match is many to many.

Three forms give the same rows:

* ``match_plain``: the condition as it reads.  The keys carry no date, so each
  realised trip meets every departure of its trip in the whole period.  It is kept
  to check the others on small inputs; no registered query uses it.
* ``match_departures``: departures and realised bands are laid over time cells.
* ``match_windows``: time cells over timetable windows that were never expanded.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pontualis.config import AnalysisConfig
from pontualis.functions import clock
from pontualis.operators.salting import shuffled

MATCHED_TIMES = ["datetime_partida_VP", "datetime_partida_VR",
                 "datetime_chegada_VP", "datetime_chegada_VR",
                 "tempo_viagem_VP", "tempo_viagem_VR"]
MATCH_KEYS = ["consorcio", "trip_id", "sentido", "servico_realizado"]
# The keys of the join: the trip and the time cell.
CELL_KEYS = [*MATCH_KEYS, "_slot"]


def _band_minutes(cfg: AnalysisConfig) -> Column:
    return clock.half_away(F.col("tempo_viagem_VR") * F.lit(cfg.association_factor))


def _planned_side(planned: DataFrame) -> DataFrame:
    return planned.where("tempo_viagem > 0").select(
        *MATCH_KEYS,
        F.col("viagens_consecutivas").alias("contador_VP"),
        F.col("datetime_partida").alias("datetime_partida_VP"),
        F.col("datetime_chegada").alias("datetime_chegada_VP"),
        F.col("tempo_viagem").alias("tempo_viagem_VP"))


def _realised_side(realised: DataFrame) -> DataFrame:
    return realised.where("tempo_viagem > 0").select(
        *MATCH_KEYS,
        F.col("viagens_consecutivas").alias("contador_VR"),
        F.col("datetime_partida").alias("datetime_partida_VR"),
        F.col("datetime_chegada").alias("datetime_chegada_VR"),
        F.col("tempo_viagem").alias("tempo_viagem_VR"))


def _in_band(cfg: AnalysisConfig) -> Column:
    departure, band = F.col("datetime_partida_VR"), clock.plus_minutes(_band_minutes(cfg))
    return F.col("datetime_partida_VP").between(departure - band, departure + band)


def _counters_close(cfg: AnalysisConfig) -> Column:
    return F.abs(F.col("contador_VR") - F.col("contador_VP")) <= cfg.counter_tolerance


def matched_columns(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        F.col("servico_realizado").alias("servico_VP"),
        F.col("servico_realizado").alias("service_VR"),
        *MATCHED_TIMES).distinct()


def _band_seconds(cfg: AnalysisConfig) -> tuple[Column, Column]:
    """Band in whole epoch seconds around ``_at``.

    One second more covers a fraction of a second cut off in ``_at``; the exact
    band is checked on the timestamps at the end.
    """
    band = _band_minutes(cfg) * 60
    return F.col("_at") - band, F.col("_at") + band + 1


def trips_in_cells(realised: DataFrame, cfg: AnalysisConfig,
                       each: Callable[[Column], Column] = F.explode) -> DataFrame:
    """One copy of a realised trip for each time cell its band touches.

    ``explode_outer`` also keeps a trip without a time.  The band follows from ``_at`` and the duration, so its ends are not carried
    through the shuffle.
    """
    width = cfg.match_cell_minutes * 60
    low, high = _band_seconds(cfg)
    return (_realised_side(realised)
            .withColumn("_at", clock.epoch_seconds(F.col("datetime_partida_VR")))
            .withColumn("_slot", each(F.sequence(
                clock.floor_div(low, width), clock.floor_div(high, width)))))


def match_plain(planned: DataFrame, realised: DataFrame, cfg: AnalysisConfig,
                how: str = "inner") -> DataFrame:
    """Band match without time cells; ``left`` also keeps realised trips without a match."""
    real, plan = _realised_side(realised).alias("r"), _planned_side(planned).alias("p")
    same_keys = [F.col(f"r.{k}") == F.col(f"p.{k}") for k in MATCH_KEYS]
    condition = reduce(lambda a, b: a & b, [*same_keys, _in_band(cfg), _counters_close(cfg)])
    return real.join(plan, condition, how).select(
        F.col("p.servico_realizado").alias("servico_VP"),
        F.col("r.servico_realizado").alias("service_VR"), *MATCHED_TIMES).distinct()


def match_departures(planned: DataFrame, realised: DataFrame, cfg: AnalysisConfig) -> DataFrame:
    """Band match over individual departures.

    A departure lies in exactly one time cell, so no pair appears twice.  The
    cell joins the keys: a busy trip spreads over its hours, and what is left
    of a hot hour is split by the adaptive skew join.
    """
    width = cfg.match_cell_minutes * 60
    slotted = _planned_side(planned).withColumn(
        "_slot", clock.floor_div(clock.epoch_seconds(F.col("datetime_partida_VP")), width))
    pairs = trips_in_cells(realised, cfg).join(shuffled(slotted), CELL_KEYS)
    return matched_columns(pairs.where(_in_band(cfg) & _counters_close(cfg)))


def window_cells(windows: DataFrame, cfg: AnalysisConfig) -> DataFrame:
    """Cut numbered windows into time cells.

    A window is an arithmetic progression: its departure with counter r leaves
    at ``start + headway * r``.  Each cell keeps the range of counters that
    falls into it; the ranges of a window do not overlap.
    """
    width = F.lit(cfg.match_cell_minutes * 60).cast("bigint")
    start, step, slot = F.col("_start"), F.col("_step"), F.col("_slot")
    first, last = F.col("primeira"), F.col("primeira") + F.col("partidas") - 1
    return (windows.where("tempo_viagem > 0")
            .withColumn("_start", clock.epoch_seconds(F.col("datetime_partida")))
            .withColumn("_step", F.col("headway") * 60)
            .withColumn("_slot", F.explode(F.sequence(
                clock.floor_div(start + step * first, width),
                clock.floor_div(start + step * last, width))))
            .select("consorcio", "trip_id", "sentido",
                    F.col("trip_short_name").alias("servico_realizado"),
                    F.col("tempo_viagem").alias("tempo_viagem_VP"),
                    "_start", "_step", "_slot",
                    F.greatest(first, clock.ceil_div(slot * width - start, step))
                     .alias("_r_from"),
                    F.least(last, clock.floor_div((slot + 1) * width - 1 - start, step))
                     .alias("_r_to"))
            .where("_r_from <= _r_to"))


def match_windows(windows: DataFrame, realised: DataFrame, cfg: AnalysisConfig) -> DataFrame:
    """Band match over timetable windows that are not expanded into departures.

    Band and counter tolerance are both ranges of the counter, so the matching
    counters of a window are one range, found by arithmetic inside the join.
    Only matched departures are ever generated: the planned side shuffles one
    row per window and hour instead of one per departure.
    """
    return matched_columns(_window_pairs(windows, realised, cfg))


def _window_pairs(windows: DataFrame, realised: DataFrame, cfg: AnalysisConfig,
                  how: str = "inner") -> DataFrame:
    each = F.explode_outer if how == "left" else F.explode
    return pairs_in_cells(trips_in_cells(realised, cfg, each), window_cells(windows, cfg), cfg, how)


def pairs_in_cells(trips: DataFrame, cells: DataFrame, cfg: AnalysisConfig,
                   how: str = "inner") -> DataFrame:
    """Pairs of a realised trip and one departure of a window, in all cells of the trip.

    With ``left``, a cell of a trip without a pair is a row without a planned side.
    """
    start, step = F.col("_start"), F.col("_step")
    low, high = _band_seconds(cfg)
    tolerance = cfg.counter_tolerance
    counter_from = F.greatest(F.col("_r_from"), F.col("contador_VR") - tolerance,
                              clock.ceil_div(low - start, step))
    counter_to = F.least(F.col("_r_to"), F.col("contador_VR") + tolerance,
                         clock.floor_div(high - start, step))
    # Without a window both bounds rest on the trip alone.
    met = F.col("_start").isNotNull() & (counter_from <= counter_to)
    counters = F.when(met, F.sequence(counter_from, counter_to))
    each = F.explode_outer if how == "left" else F.explode
    pairs = (trips.join(shuffled(cells), CELL_KEYS, how).withColumn("contador_VP", each(counters))
             .withColumn("datetime_partida_VP",
                         clock.from_epoch_seconds(start + step * F.col("contador_VP")))
             .withColumn("datetime_chegada_VP",
                         clock.from_epoch_seconds(start + step * (F.col("contador_VP") + 1))))
    return pairs if how == "left" else pairs.where(_in_band(cfg))


def match_left(windows: DataFrame, realised: DataFrame, cfg: AnalysisConfig) -> DataFrame:
    """``match_windows`` with the realised trips that match nothing, their planned side NULL.

    One pair join: every cell of a trip stays in it, and one aggregate per trip folds the
    pairs of its cells into a set.  A trip whose set is empty has no match.  A set holds
    what lies in the band and the counter tolerance of one trip, a few departures.
    """
    planned = [c for c in MATCHED_TIMES if c.endswith("_VP")]
    observed = [c for c in MATCHED_TIMES if c.endswith("_VR")]
    pair = F.when(_in_band(cfg), F.struct(*planned))
    folded = (_window_pairs(windows, realised, cfg, "left")
              .groupBy(*MATCH_KEYS, "contador_VR", *observed)
              .agg(F.collect_set(pair).alias("_pairs")))
    return (folded.withColumn("_pair", F.explode_outer("_pairs"))
            .select(F.when(F.col("_pair").isNotNull(), F.col("servico_realizado")).alias("servico_VP"),
                    F.col("servico_realizado").alias("service_VR"),
                    *[F.col(f"_pair.{c}").alias(c) if c in planned else F.col(c)
                      for c in MATCHED_TIMES]).distinct())


def candidate_pairs(windows: DataFrame, realised: DataFrame, cfg: AnalysisConfig) -> DataFrame:
    """Every pair of a trip and a departure that may be associated, with its two distances.

    A trip is its keys and observed times, a departure its keys and planned times, however many
    feeds or windows list it; of several counters the closest ones count.
    """
    seconds = F.abs(clock.epoch_seconds(F.col("datetime_partida_VP"))
                    - clock.epoch_seconds(F.col("datetime_partida_VR")))
    return (_window_pairs(windows, realised, cfg).groupBy(*MATCH_KEYS, *MATCHED_TIMES)
            .agg(F.min(F.abs(F.col("contador_VR") - F.col("contador_VP"))).alias("distancia_contador"))
            .withColumn("distancia_segundos", seconds))
