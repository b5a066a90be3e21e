"""Trips per hour and rush-hour detection.

All windows here run over the hourly counts, at most 24 rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pontualis.functions import clock

HALF_ROWS = 12


def hourly_trip_counts(scored: DataFrame) -> DataFrame:
    return (scored.where(F.col("data_partida").isNotNull())
            .groupBy(clock.hour_bucket(F.col("data_partida")).alias("hora"))
            .agg(F.count(F.lit(1)).alias("viagens")))


def positional_halves(counts: DataFrame) -> DataFrame:
    """First twelve hours that have trips, and the rest; not hours before noon."""
    position = F.row_number().over(Window.orderBy("hora"))
    return counts.withColumn("metade", F.when(position <= HALF_ROWS, "manha").otherwise("tarde"))


def rush_candidates(counts: DataFrame, cut: float, deviation: float) -> DataFrame:
    """Hours that pass the share-of-mean cut and then the deviation cut of their half.

    The deviation is that of the hours kept by the first cut; a single hour has
    none, which leaves its half empty.
    """
    half = Window.partitionBy("metade")
    busy = (positional_halves(counts)
            .withColumn("_mean", F.avg("viagens").over(Window.partitionBy()))
            .where(F.col("viagens") >= F.col("_mean") * cut))
    level = F.avg("viagens").over(half) + F.stddev_samp("viagens").over(half) * deviation
    return (busy.withColumn("_level", level)
            .where(F.col("viagens") >= F.col("_level"))
            .select("metade", "hora", "viagens"))


def lag_lead_gap(candidates: DataFrame) -> DataFrame:
    """Distance to the nearer neighbouring hour of the half; a missing neighbour is hour 0."""
    order = Window.partitionBy("metade").orderBy("hora")
    hour = F.col("hora")
    return candidates.withColumn("intervalo", F.least(
        F.abs(hour - F.lag("hora", 1, 0).over(order)),
        F.abs(hour - F.lead("hora", 1, 0).over(order))))


def rush_by_half(counts: DataFrame, cut: float, deviation: float) -> DataFrame:
    """Of the candidates with the same gap, the hour with most trips (the earliest on ties)."""
    gaps = lag_lead_gap(rush_candidates(counts, cut, deviation))
    best = F.min(F.struct((-F.col("viagens")).alias("_rank"), "hora", "viagens")).alias("_row")
    return (gaps.groupBy("metade", "intervalo").agg(best)
            .select("metade", F.col("_row.hora").alias("hora"),
                    F.col("_row.viagens").alias("viagens")))


def rush_hours(scored: DataFrame, cut: float = 0.75, deviation: float = 0.5) -> DataFrame:
    return (rush_by_half(hourly_trip_counts(scored), cut, deviation)
            .select("hora", "viagens").orderBy("hora"))
