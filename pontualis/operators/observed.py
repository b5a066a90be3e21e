"""Realised trips: feed assignment and departure counters."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pontualis.config import AnalysisConfig
from pontualis.functions import clock
from pontualis.functions.keys import trip_key_realised
from pontualis.operators import scans
from pontualis.operators.numbering import number_rows
from pontualis.operators.salting import salted_join
from pontualis.sources.tables import TransitTables


# Feeds up to this number are held as one sorted array that every task looks its trips
# up in, about 100 bytes each; more feeds are joined by calendar month.
FEED_INDEX_ROWS = 4096


def _month(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def _leading(array: Column, holds: Callable[[Column], Column]) -> Column:
    """Length of the leading part of an array in which ``holds`` is true, by halving steps.

    Once false, ``holds`` must stay false; NULL counts as false.
    """
    steps = F.array(*[F.lit(FEED_INDEX_ROWS >> k)
                      for k in range(FEED_INDEX_ROWS.bit_length())])

    def step(found: Column, width: Column) -> Column:
        inside = (found + width <= F.size(array)) & holds(F.get(array, found + width - 1))
        return F.when(inside, found + width).otherwise(found)

    return F.aggregate(steps, F.lit(0), step)


def _join_feed_index(trips: DataFrame, feeds: DataFrame) -> DataFrame:
    """Join with feeds that fit an interval index: no shuffle, no join.

    The feeds are sorted by start; beside each stands the latest end up to there.  Feeds
    that have begun are a leading part of the array, those before which every feed
    has ended another, and only what lies between the two is compared.
    """
    begin, end = F.col("inicio_periodo"), F.col("fim_periodo")
    entry = F.struct(F.col("feed_start_date").alias("first"), F.col("feed_end_date").alias("last"),
                     F.struct(*feeds.columns).alias("feed"))
    feeds = feeds.where("feed_start_date IS NOT NULL AND feed_end_date IS NOT NULL")
    ordered = feeds.agg(F.array_sort(F.collect_list(entry)).alias("feeds"))
    lasts = F.transform("feeds", lambda f: f["last"])
    index = ordered.select(F.struct(
        "feeds", F.transform("feeds", lambda f: f["first"]).alias("firsts"),
        F.transform(lasts, lambda _, i: F.array_max(F.slice(lasts, 1, i + 1))).alias("latest"))
        .alias("index"))
    begun = _leading(F.col("_index.firsts"), lambda d: clock.midnight(d) <= begin)
    over = _leading(F.col("_index.latest"), lambda d: clock.midnight(d) < end)
    between = F.slice("_index.feeds", F.col("_over") + 1, F.greatest(F.col("_begun") - F.col("_over"), F.lit(0)))
    around = F.filter(between, lambda f: end <= clock.midnight(f["last"]))
    return (trips.withColumn("_index", index.scalar())
            .withColumns({"_begun": begun, "_over": over})
            .withColumn("_feed", F.explode(around))
            .select(*[F.col(c) for c in trips.columns],
                    *[F.col(f"_feed.feed.{c}").alias(c) for c in feeds.columns]))


def join_feed_range(trips: DataFrame, feeds: DataFrame, spread: Sequence[str],
                    index_rows: int = FEED_INDEX_ROWS) -> DataFrame:
    """Attach each feed whose validity contains the planned period of a trip.

    The condition is a pure range: period start not before the feed start and
    period end not after midnight of the feed end date.  The feeds are counted: up to
    ``index_rows`` go into an interval index.  Beyond, both sides are laid
    over calendar months, which turns the range into an equality join; a month is one key,
    so it is salted by the columns ``spread``, one or two of many values.  A pair is kept in
    the first month both share, so it appears once.  A trip inside several feeds yields one
    row per feed.
    """
    if feeds.count() <= min(index_rows, FEED_INDEX_ROWS):
        return _join_feed_index(trips, feeds)
    begin, end = F.col("inicio_periodo"), F.col("fim_periodo")
    start_month, end_month = _month(begin.cast("date")), _month(end.cast("date"))
    feed_start, feed_end = F.col("feed_start_date"), F.col("feed_end_date")
    # An inverted period (end before start) meets every feed it overlaps.
    months = (F.when(end >= begin, F.array(start_month))
               .otherwise(F.sequence(F.least(start_month, end_month), start_month)))
    feed_first = F.least(_month(feed_start), _month(feed_end))
    feed_last = F.greatest(_month(feed_start), _month(feed_end))
    trip_months = (trips.withColumn("_first", F.get(months, F.lit(0)))
                   .withColumn("_month", F.explode(months)))
    feed_months = (feeds.withColumn("_feed_first", feed_first)
                   .withColumn("_month", F.explode(F.sequence(feed_first, feed_last))))
    return (salted_join(trip_months, feed_months, ["_month"], spread)
            .where((begin >= clock.midnight(feed_start)) & (end <= clock.midnight(feed_end)))
            .where(F.col("_month") == F.greatest("_first", "_feed_first"))
            .drop("_month", "_first", "_feed_first"))


def realised_in_feeds(tables: TransitTables, cfg: AnalysisConfig,
                      days: Sequence[date] | None = None) -> DataFrame:
    """Realised trips of the period, or of some service days of it, with their feeds."""
    feeds = (tables.feed_info.where(scans.feed_floor(cfg))
             .select("feed_version", "feed_start_date", "feed_end_date"))
    trips = scans.scan_realised(tables, cfg)
    if days is not None:
        trips = trips.where(F.col("data").isin(list(days)))
    return join_feed_range(trips, feeds, ["id_viagem"])


def observed_columns(trips: DataFrame, *extra: str) -> DataFrame:
    """What the match knows of a realised trip; copies are still there."""
    return trips.select(
        "consorcio", "data", *extra,
        trip_key_realised(F.col("id_viagem")).alias("id_viagem"), "servico_realizado",
        "vista", "trip_id", "shape_id", "sentido", "datetime_partida", "datetime_chegada",
        F.col("inicio_periodo").cast("date").alias("inicio_periodo"),
        F.col("fim_periodo").cast("date").alias("fim_periodo"),
        "tempo_viagem", "feed_version", "feed_start_date", "feed_end_date")


def _total_order(frame: DataFrame, first: list[str]) -> list[str]:
    """Sort columns followed by every other column: rows are distinct, so no ties remain."""
    return first + [c for c in frame.columns if c not in first]


def _hour_cell(cfg: AnalysisConfig) -> Column:
    return clock.floor_div(clock.epoch_seconds(F.col("datetime_partida")),
                           cfg.numbering_cell_minutes * 60)


def observed_departures(tables: TransitTables, cfg: AnalysisConfig,
                        days: Sequence[date] | None = None) -> DataFrame:
    """Realised trips numbered by departure per day, trip and service.

    A number depends on trips of the same service day alone, so ``days`` may leave others out.

    A cell of the numbering is one trip in one hour (``numbering_cell_minutes``).
    """
    trips = observed_columns(realised_in_feeds(tables, cfg, days)).distinct()
    return number_rows(trips, ["data", "trip_id", "servico_realizado"], _hour_cell(cfg),
                       _total_order(trips, ["datetime_partida", "id_viagem"]),
                       "viagens_consecutivas")


def observed_departures_by_service(tables: TransitTables, cfg: AnalysisConfig) -> DataFrame:
    """Variant with one counter per consortium, service, trip, shape and direction."""
    trips = observed_columns(
        realised_in_feeds(tables, cfg), "tipo_dia", "versao_modelo").distinct()
    return number_rows(
        trips, ["consorcio", "servico_realizado", "trip_id", "shape_id", "sentido"],
        F.struct("data", _hour_cell(cfg).alias("hour")),
        _total_order(trips, ["data", "datetime_partida", "id_viagem"]),
        "viagens_consecutivas")
