"""Base scans: feed selection, column choice and removal of copies.

Every scan ends in DISTINCT.  Spark combines copies before the shuffle, so a
row repeated many times costs one row downstream, and two heavily copied
inputs cannot multiply in a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pontualis.config import AnalysisConfig
from pontualis.operators.salting import salted_join
from pontualis.sources.tables import TransitTables


def feed_floor(cfg: AnalysisConfig, column: str = "feed_version") -> Column:
    return F.col(column) >= F.lit(cfg.feed_floor)


def in_period(cfg: AnalysisConfig, column: str = "data") -> Column:
    return F.col(column).between(F.lit(cfg.start_date), F.lit(cfg.end_date))


def calendar_in_period(calendar: DataFrame, cfg: AnalysisConfig) -> DataFrame:
    return calendar.where(feed_floor(cfg) & in_period(cfg))


def active_feeds(calendar: DataFrame, cfg: AnalysisConfig) -> DataFrame:
    """Start dates of the feeds the calendar uses in the period, one row each."""
    return calendar_in_period(calendar, cfg).select("feed_start_date").distinct()


def active_service_ids(calendar: DataFrame, cfg: AnalysisConfig) -> DataFrame:
    """Service ids the calendar uses in the period, one row each."""
    return (calendar_in_period(calendar, cfg)
            .select(F.explode("service_ids").alias("service_id")).distinct())


def sorted_array(frame: DataFrame, column: str, name: str) -> DataFrame:
    """The distinct values of a column of few values as one sorted array."""
    return frame.agg(F.sort_array(F.collect_set(column)).alias(name))


def in_active_feeds(frame: DataFrame, feeds: DataFrame) -> DataFrame:
    """Keep rows of active feeds.

    Joining on the feed date alone would send each feed to one task.  The other
    side is a set of distinct dates: at four bytes for each day of the calendar
    it stays below a few megabytes for any data, so it may always be broadcast.
    """
    return frame.join(F.broadcast(feeds), "feed_start_date", "left_semi")


def _versioned(frame: DataFrame, cfg: AnalysisConfig, feeds: DataFrame) -> DataFrame:
    return in_active_feeds(frame.where(feed_floor(cfg)), feeds)


def trip_rows(tables: TransitTables, cfg: AnalysisConfig) -> DataFrame:
    return (_versioned(tables.trips, cfg, active_feeds(tables.calendar, cfg))
            .select("feed_version", "feed_start_date", "feed_end_date", "route_id",
                    "service_id", "trip_id", "trip_headsign", "trip_short_name",
                    "direction_id", "shape_id", "versao_modelo"))


def scan_trips(tables: TransitTables, cfg: AnalysisConfig) -> DataFrame:
    return trip_rows(tables, cfg).distinct()


def frequency_rows(tables: TransitTables, cfg: AnalysisConfig) -> DataFrame:
    return (_versioned(tables.frequencies, cfg, active_feeds(tables.calendar, cfg))
            .select("feed_version", "feed_start_date", "feed_end_date", "trip_id",
                    "start_time", "end_time", "headway_secs", "versao_modelo"))


def scan_frequencies(tables: TransitTables, cfg: AnalysisConfig) -> DataFrame:
    return frequency_rows(tables, cfg).distinct()


def consortium_agencies(tables: TransitTables, cfg: AnalysisConfig) -> DataFrame:
    """Agencies of the consortia, one row per id, name and model version."""
    return (tables.agency
            .where(feed_floor(cfg) & F.col("agency_name").isin(*cfg.agencies))
            .select("agency_id", "agency_name", "versao_modelo")
            .distinct())


def route_rows(tables: TransitTables, cfg: AnalysisConfig) -> DataFrame:
    return _versioned(tables.routes, cfg, active_feeds(tables.calendar, cfg))


def join_left_agency(tables: TransitTables, cfg: AnalysisConfig) -> DataFrame:
    """Routes of active feeds with the consortium name, NULL for other agencies."""
    return salted_join(route_rows(tables, cfg), consortium_agencies(tables, cfg),
                       ["agency_id", "versao_modelo"], ["route_id"], "left")


def scan_routes_agency(tables: TransitTables, cfg: AnalysisConfig) -> DataFrame:
    return (join_left_agency(tables, cfg)
            .select("feed_version", "feed_start_date", "feed_end_date", "route_id",
                    "agency_id", "agency_name", "route_short_name", "versao_modelo")
            .distinct())


def calendar_rows(tables: TransitTables, cfg: AnalysisConfig) -> DataFrame:
    """Calendar days of active feeds, one row per entry of ``service_ids``."""
    days = in_active_feeds(calendar_in_period(tables.calendar, cfg),
                           active_feeds(tables.calendar, cfg))
    return days.withColumn("service_id", F.explode("service_ids"))


def scan_calendar(tables: TransitTables, cfg: AnalysisConfig) -> DataFrame:
    return (calendar_rows(tables, cfg)
            .select("data", "tipo_os", "service_id", "feed_version", "feed_start_date",
                    F.col("versao").alias("versao_modelo"), "datetime_ultima_atualizacao")
            .distinct())


def scan_realised(tables: TransitTables, cfg: AnalysisConfig) -> DataFrame:
    """Realised trips of the period with a positive duration."""
    return tables.realised.where(in_period(cfg) & (F.col("tempo_viagem") > 0))
