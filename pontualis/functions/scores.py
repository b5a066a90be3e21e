"""Score ladders for punctuality and travel time, as native column expressions.

The thresholds and values below are fixed values of the method.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# (minutes above which the score applies, score), from worst to best.
TRAVEL_TIME_STEPS = ((80, 0.0), (50, 0.25), (35, 0.5), (20, 0.5), (13, 1.0), (7, 1.25))
TRAVEL_TIME_BEST = 1.5
EARLY_STEPS = ((12, 0.0), (9, 0.25), (6, 0.5), (3, 0.5))
LATE_STEPS = ((20, 0.0), (15, 0.25), (10, 0.5), (5, 0.5))
ON_TIME = 1.0


def _ladder(value: Column, steps: tuple[tuple[int, float], ...], best: float) -> Column:
    expression = F.when(value.isNull(), F.lit(None).cast("double"))
    for limit, score in steps:
        expression = expression.when(value > limit, F.lit(score))
    return expression.otherwise(F.lit(best))


def score_travel_time(minutes: Column) -> Column:
    return _ladder(F.abs(minutes), TRAVEL_TIME_STEPS, TRAVEL_TIME_BEST)


def score_reliability(seconds: Column) -> Column:
    """Score of a delay (positive) or an early run (negative).

    The delay is rounded to whole minutes with halves to even.
    """
    minutes = F.bround(seconds / F.lit(60.0))
    return F.when(minutes < 0, _ladder(-minutes, EARLY_STEPS, ON_TIME)) \
            .otherwise(_ladder(minutes, LATE_STEPS, ON_TIME))


def score_travel_delta(planned_minutes: Column, realised_minutes: Column) -> Column:
    """Gain of the realised over the planned travel-time score; no difference counts 1."""
    delta = score_travel_time(realised_minutes) - score_travel_time(planned_minutes)
    return F.when(delta == 0, F.lit(1.0)).otherwise(delta)


def score_weighted(punctuality: Column, travel: Column, weight_reliability: float,
                   weight_travel: float) -> Column:
    return punctuality * F.lit(weight_reliability) + travel * F.lit(weight_travel)


def score_error_factor(planned_minutes: Column, realised_minutes: Column) -> Column:
    """One minus the relative difference of the durations; NULL when both are zero."""
    error = F.abs(realised_minutes - planned_minutes).cast("double")
    total = (realised_minutes + planned_minutes).cast("double")
    return F.lit(1.0) - F.try_divide(error, total)


def score_percent(share: Column) -> Column:
    return F.round(share * 100, 3)
