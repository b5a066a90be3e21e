"""From frequency-based timetables to individual planned departures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pontualis.config import AnalysisConfig
from pontualis.functions import clock
from pontualis.functions.keys import direction_code, trip_key_planned
from pontualis.operators import scans
from pontualis.operators.numbering import running_total_before
from pontualis.operators.salting import salted_join, shuffled
from pontualis.sources.tables import TransitTables

TRIP_FREQUENCY_KEYS = ["feed_version", "feed_start_date", "feed_end_date", "trip_id",
                       "versao_modelo"]
ROUTE_KEYS = ["feed_version", "feed_start_date", "route_id", "versao_modelo"]
CALENDAR_KEYS = ["feed_version", "feed_start_date", "service_id"]


# --- joins -------------------------------------------------------------------

def join_trips_frequencies(trips: DataFrame, frequencies: DataFrame) -> DataFrame:
    return trips.join(shuffled(frequencies), TRIP_FREQUENCY_KEYS)


def join_routes(services: DataFrame, routes: DataFrame, how: str = "right") -> DataFrame:
    """Attach routes; ``right`` keeps routes without trips, with NULL trip columns.

    The timetable rejects NULL trips right afterwards and joins inner instead.
    """
    return services.join(
        shuffled(routes.select(*ROUTE_KEYS, "agency_name", "route_short_name")), ROUTE_KEYS, how)


def join_calendar(services: DataFrame, calendar: DataFrame) -> DataFrame:
    return salted_join(services, calendar, CALENDAR_KEYS, ["trip_id"])


def same_line(route_name: Column, trip_name: Column) -> Column:
    return F.trim(route_name) == F.trim(trip_name)


# --- timetable windows -------------------------------------------------------

def frequency_times(frequencies: DataFrame) -> DataFrame:
    """Parse the window texts once per frequency row, before days multiply them."""
    start, end = F.col("start_time"), F.col("end_time")
    parsed = {"start_time", "end_time", "headway_secs"}
    return frequencies.select(
        *[c for c in frequencies.columns if c not in parsed],
        clock.hms_seconds(start).alias("_start"),
        clock.wrapped_duration_seconds(start, end).alias("_span"),
        clock.wrapped_duration_minutes(start, end).alias("tempo_viagem"),
        clock.headway_minutes(F.col("headway_secs")).alias("headway"))


def distinct_rows(frame: DataFrame, _source: str) -> DataFrame:
    return frame.distinct()


def counted_rows(frame: DataFrame, source: str) -> DataFrame:
    """Distinct rows with the number of their copies, for audits of the raw joins."""
    return frame.groupBy(*frame.columns).agg(F.count(F.lit(1)).alias(f"_copies_{source}"))


def scheduled_windows(tables: TransitTables, cfg: AnalysisConfig,
                      day_columns: tuple[Column | str, ...] = ("tipo_os",),
                      reduce=distinct_rows, with_agency: bool = True) -> DataFrame:
    """Timetable windows per calendar day, each once.

    Windows that wrap past midnight have a negative duration and drop out;
    windows that lie wholly past midnight fold to a positive one and stay.

    Each input is brought to the columns of the result, and its copies are
    removed before it is joined.  As the result carries all of these columns
    (or columns that determine them), the joins cannot produce a copy, and no
    DISTINCT over the far larger joined table is needed.  ``with_agency`` leaves the
    consortium out where it is not asked for.
    """
    trips = reduce(scans.trip_rows(tables, cfg)
                   .withColumn("sentido", direction_code(F.col("direction_id")))
                   .drop("direction_id"), "trips")
    frequencies = reduce(frequency_times(scans.frequency_rows(tables, cfg))
                         .where("tempo_viagem > 0"), "frequencies")
    agency = ["agency_name"] if with_agency else []
    route_rows = scans.join_left_agency if with_agency else scans.route_rows
    routes = reduce(route_rows(tables, cfg)
                    .select(*ROUTE_KEYS, *agency,
                            F.trim("route_short_name").alias("route_short_name")), "routes")
    calendar = reduce(scans.calendar_rows(tables, cfg)
                      .select("data", *day_columns, *CALENDAR_KEYS), "calendar")
    # Routes are attached to trips before frequencies and days multiply the rows.
    named = (trips.join(shuffled(routes), ROUTE_KEYS)
             .where(same_line(F.col("route_short_name"), F.col("trip_short_name"))))
    days = join_calendar(join_trips_frequencies(named, frequencies), calendar)
    start = clock.midnight(F.col("data")) + clock.plus_seconds(F.col("_start"))
    day_type = [c for c in ("tipo_dia",) if c in calendar.columns]
    copies = [c for c in days.columns if c.startswith("_copies_")]
    return days.select(
        "data", *[F.col(c).alias("consorcio") for c in agency], *day_type,
        F.col("service_id").alias("servico_realizado"),
        F.col("trip_headsign").alias("vista"), "trip_id", "shape_id", "sentido",
        start.alias("datetime_partida"),
        (start + clock.plus_seconds(F.col("_span"))).alias("datetime_chegada"),
        "tempo_viagem", "route_id", "trip_short_name", "tipo_os", "headway",
        "feed_version", "feed_start_date", "feed_end_date", "versao_modelo", *copies)


def timetable_windows(tables: TransitTables, cfg: AnalysisConfig) -> DataFrame:
    return scheduled_windows(tables, cfg)


def standalone_windows(tables: TransitTables, cfg: AnalysisConfig) -> DataFrame:
    """Variant that also carries the day type and reads ``tipo_os`` from the day subtype."""
    return scheduled_windows(
        tables, cfg, ("tipo_dia", F.col("subtipo_dia").alias("tipo_os")))


# --- departures --------------------------------------------------------------

def with_departure_count(windows: DataFrame) -> DataFrame:
    return windows.withColumn(
        "partidas", clock.departure_count(F.col("tempo_viagem"), F.col("headway")))


def expand_departures(windows: DataFrame) -> DataFrame:
    """One row per departure of a window, with its number ``i`` in the window."""
    return (with_departure_count(windows)
            .withColumn("i", F.explode(clock.departure_numbers(F.col("partidas"))))
            .drop("partidas"))


def _tie_breaks(windows: DataFrame, first: list[str]) -> list[str]:
    return first + [c for c in windows.columns if c not in first]


def numbered_windows(tables: TransitTables, cfg: AnalysisConfig) -> DataFrame:
    """Windows with the counter of their first departure, not yet expanded.

    Departures are numbered per trip, window start and service id.  The counter
    of a departure is its number in its window plus the departures of the
    windows before it, so the numbering runs over windows, an order of
    magnitude fewer rows than departures, and expanding needs no further
    shuffle.  A group holds only the distinct windows of one trip that start at
    the same instant.
    """
    keys = ["trip_id", "datetime_partida", "servico_realizado"]
    windows = with_departure_count(timetable_windows(tables, cfg)).where("partidas >= 1")
    order = _tie_breaks(windows.drop("partidas", *keys),
                        ["feed_version", "tempo_viagem", "headway"])
    before = (Window.partitionBy(*keys).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    return windows.withColumn(
        "primeira", F.coalesce(F.sum("partidas").over(before), F.lit(0)) + 1)


def numbered_windows_by_trip(tables: TransitTables, cfg: AnalysisConfig) -> DataFrame:
    """Variant that keeps one counter per trip over the whole period.

    A busy trip may own a large part of the month, so the running total is cut
    into days.
    """
    windows = with_departure_count(standalone_windows(tables, cfg)).where("partidas >= 1")
    order = _tie_breaks(windows.drop("partidas", "trip_id"),
                        ["datetime_partida", "tempo_viagem", "feed_version", "headway"])
    return (running_total_before(windows, ["trip_id"], F.col("datetime_partida").cast("date"),
                                 order, F.col("partidas"), "primeira")
            .withColumn("primeira", F.col("primeira") + 1))


def generated_departures(windows: DataFrame) -> DataFrame:
    """Expand numbered windows.

    The first departure lies one headway after the window start, and arrival
    means the next departure, not a travel time.
    """
    start, headway, row = F.col("datetime_partida"), F.col("headway"), F.col("row_id")
    last = F.col("primeira") + F.col("partidas") - 1
    return (windows
            .withColumn("row_id", F.explode(F.sequence(F.col("primeira"), last)))
            .withColumn("servico_realizado", F.col("trip_short_name"))
            .withColumn("datetime_chegada", start + clock.plus_minutes(headway * (row + 1)))
            .withColumn("datetime_partida", start + clock.plus_minutes(headway * row)))


def _cut_to_new(windows: DataFrame, same: list[str]) -> DataFrame:
    """Numbered windows without the departures that another window has too; none is lost.

    Windows equal in ``same`` share the departures of which both have the counter.  Sorted by their
    first counter, each keeps what lies behind the last one so far, so copies go while a
    departure is still part of a range, and departures are neither compared nor shuffled.  A
    group holds windows of one trip and start that differ in columns no departure has.
    """
    last = F.col("primeira") + F.col("partidas") - 1
    before = (Window.partitionBy(*same).orderBy("primeira", "partidas")
              .rowsBetween(Window.unboundedPreceding, -1))
    known = F.max(last).over(before) + 1 - F.col("primeira")
    return (windows.withColumn("_known", F.greatest(F.lit(0), known))
            .withColumns({"primeira": F.col("primeira") + F.col("_known"),
                          "partidas": F.col("partidas") - F.col("_known")})
            .where("partidas >= 1").drop("_known"))


def _with_key(departures: DataFrame, *columns: Column | str) -> DataFrame:
    """The columns of departures, and their text key after the day."""
    rows = departures.select(*columns)
    key = trip_key_planned(F.col("servico_realizado"), F.col("sentido"), F.col("shape_id"),
                           F.col("datetime_partida"))
    after_day = rows.columns.index("servico_realizado")
    return rows.select(*rows.columns[:after_day], key.alias("id_viagem"),
                       *rows.columns[after_day:])


def planned_departures(tables: TransitTables, cfg: AnalysisConfig) -> DataFrame:
    """Distinct departures with their counter.

    Counter, departure and arrival determine start and headway of a window.
    """
    windows = _cut_to_new(numbered_windows(tables, cfg), [
        "consorcio", "data", "trip_short_name", "vista", "trip_id", "shape_id", "sentido",
        "datetime_partida", "headway", "tempo_viagem", "feed_version", "feed_start_date"])
    return _with_key(
        generated_departures(windows),
        F.col("row_id").alias("viagens_consecutivas"), "consorcio", "data",
        "servico_realizado", "vista", "trip_id", "shape_id", "sentido", "datetime_partida",
        "datetime_chegada", "tempo_viagem", "feed_version", "feed_start_date")


def planned_departures_by_trip(tables: TransitTables, cfg: AnalysisConfig,
                               *extra: Column | str) -> DataFrame:
    """Departures of the month-long counter; ``extra`` adds columns, e.g. the counter.

    No two are equal, with or without the counter: along the counter of a trip starts never
    fall, so of two departures with one headway the later counter leaves later.
    """
    return _with_key(
        generated_departures(numbered_windows_by_trip(tables, cfg)), *extra, "consorcio",
        "data", "tipo_dia", "servico_realizado", "vista", "trip_id", "shape_id", "sentido",
        "datetime_partida", "datetime_chegada", "tempo_viagem", "feed_version",
        "feed_start_date", "versao_modelo")
