"""Exploratory look-ups over the source tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pontualis.config import AnalysisConfig
from pontualis.operators import scans
from pontualis.sources.tables import TransitTables


_COPIES = 10_000


def _explore_floor(cfg: AnalysisConfig) -> Column:
    return F.col("feed_version") >= F.lit(cfg.explore_floor)


def explore_agency(tables: TransitTables, cfg: AnalysisConfig) -> DataFrame:
    return (tables.agency
            .where(F.col("agency_name").isin(*cfg.agencies)
                   & scans.in_period(cfg, "feed_start_date"))
            .select("agency_id").distinct().orderBy("agency_id"))


def explore_calendar(tables: TransitTables, cfg: AnalysisConfig) -> DataFrame:
    feeds = tables.feed_info.select("feed_version", "feed_start_date", "feed_end_date")
    return (scans.calendar_in_period(tables.calendar, cfg)
            .withColumn("service_id", F.explode("service_ids"))
            .join(feeds, ["feed_version", "feed_start_date"])
            .select("data", "tipo_dia", "tipo_os", "service_id", "feed_version",
                    "feed_start_date", "feed_end_date"))


def explore_service_ids(tables: TransitTables, cfg: AnalysisConfig) -> DataFrame:
    return (tables.calendar.where(scans.in_period(cfg))
            .select(F.explode("service_ids").alias("service_id"))
            .select(F.trim("service_id").alias("service_ids"))
            .distinct().orderBy("service_ids"))


def explore_day_subtypes(tables: TransitTables, cfg: AnalysisConfig) -> DataFrame:
    return (tables.calendar
            .where(scans.in_period(cfg) & F.col("subtipo_dia").isNotNull())
            .select("subtipo_dia").distinct().orderBy("subtipo_dia"))


def explore_frequencies(tables: TransitTables, cfg: AnalysisConfig) -> DataFrame:
    return (tables.frequencies.where(_explore_floor(cfg))
            .select("feed_version", "feed_start_date", "feed_end_date", "trip_id",
                    "start_time", "end_time", "headway_secs", "exact_times")
            .orderBy("feed_start_date"))


def explore_routes(tables: TransitTables, cfg: AnalysisConfig) -> DataFrame:
    return (tables.routes.where(scans.in_period(cfg, "feed_start_date"))
            .orderBy("feed_start_date"))


def explore_trips(tables: TransitTables, cfg: AnalysisConfig) -> DataFrame:
    return (tables.trips.where(_explore_floor(cfg))
            .select("feed_version", "feed_start_date", "feed_end_date", "route_id",
                    "service_id", "trip_id", "trip_headsign", "trip_short_name",
                    "direction_id"))


def explore_trips_realised(tables: TransitTables, cfg: AnalysisConfig) -> DataFrame:
    """Planned trips once for each realised trip with their id; copies are kept.

    Realised trips are counted per id before the join, so a busy trip is one row of
    the shuffle.  The copies are made afterwards, in chunks of at most ``_COPIES``.
    """
    realised = (tables.realised.where(scans.in_period(cfg)).groupBy("trip_id")
                .agg(F.count(F.lit(1)).alias("_times")))
    chunks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_times") - 1) / _COPIES))
    size = F.least(F.lit(_COPIES), F.col("_times") - F.col("_chunk") * _COPIES).cast("int")
    return (tables.trips.where(F.col("service_id").isin(*cfg.explored_service_ids))
            .join(realised, "trip_id")
            .withColumn("_chunk", F.explode(chunks))
            .withColumn("_copy", F.explode(F.array_repeat(F.lit(True), size)))
            .select("trip_id", "route_id", "service_id", "feed_version", "feed_start_date",
                    "feed_end_date"))


def explore_realised(tables: TransitTables, cfg: AnalysisConfig) -> DataFrame:
    return tables.realised.where(scans.in_period(cfg))
