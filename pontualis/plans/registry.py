"""Every query of the engine by name, over the tables derived from a star schema.

Each entry takes a session and the folder of the star tables.  Scores are
rounded to six digits on output.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pontualis.functions import clock, keys, scores
from pontualis.operators import (assignment, audits, explore, matching, observed, rankings, regularity,
                                 rush, scans, scoring, timetable)
from pontualis.plans import match_layout
from pontualis.plans.quality import QualityAnalysis
from pontualis.session import shared_folder
from pontualis.sources.matched import read_matched_csv, write_matched_csv
from pontualis.sources.ranking_csv import read_ranking_csv, write_ranking_csv
from pontualis.sources.star_tables import STAR_CONFIG, star_tables
from pontualis.sources.tables import TransitTables

Query = Callable[[SparkSession, str], DataFrame]

CFG = STAR_CONFIG
QUERIES: dict[str, Query] = {}
OUTPUT_DIGITS = 6

_folders: dict[str, str] = {}


def _scratch(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A path for one written table of this application and these inputs."""
    application = spark.sparkContext.applicationId
    root = _folders.setdefault(application, shared_folder(spark))
    inputs = zlib.crc32(sf_dir.rstrip("/").encode())
    return f"{root}/{application}/{inputs:08x}/{name}"


_fresh: set[str] = set()


def analysis(spark: SparkSession, sf_dir: str, mode: str = "trip",
             force: bool = False) -> QualityAnalysis:
    """An analysis whose stored match is compared with its inputs once per application and folder."""
    path = _scratch(spark, sf_dir, "matched")
    found = QualityAnalysis(star_tables(spark, sf_dir), CFG, mode, path).run(
        force, refresh=path not in _fresh)
    _fresh.add(path)
    return found


def _tables_query(build: Callable[[TransitTables], DataFrame]) -> Callable[..., DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(star_tables(spark, sf_dir))
    return build


def _trip_query(build: Callable[[QualityAnalysis], DataFrame]) -> Callable[..., DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(analysis(spark, sf_dir, "trip"))
    return build


def _regularity_query(build: Callable[[QualityAnalysis], DataFrame]) -> Callable[..., DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(analysis(spark, sf_dir, "regularity"))
    return build


def _rounded(frame: DataFrame, *columns: str) -> DataFrame:
    return frame.withColumns({c: F.round(c, OUTPUT_DIGITS) for c in columns})


def _score(value: Column, name: str = "score") -> Column:
    return F.round(value, OUTPUT_DIGITS).alias(name)


# --- scans and sources -----------------------------------------------------------

@_tables_query
def scan_trips(t):
    return scans.scan_trips(t, CFG)


@_tables_query
def scan_frequencies(t):
    return scans.scan_frequencies(t, CFG)


@_tables_query
def scan_routes_agency(t):
    return scans.scan_routes_agency(t, CFG)


@_tables_query
def scan_calendar(t):
    return scans.scan_calendar(t, CFG)


@_tables_query
def scan_realised(t):
    return scans.scan_realised(t, CFG)


@_tables_query
def explore_agency(t):
    return explore.explore_agency(t, CFG)


@_tables_query
def explore_calendar(t):
    return explore.explore_calendar(t, CFG)


@_tables_query
def explore_service_ids(t):
    return explore.explore_service_ids(t, CFG)


@_tables_query
def explore_subtipo_dia(t):
    return explore.explore_day_subtypes(t, CFG)


@_tables_query
def explore_frequencies(t):
    return explore.explore_frequencies(t, CFG)


@_tables_query
def explore_routes(t):
    return explore.explore_routes(t, CFG)


@_tables_query
def explore_trips(t):
    return explore.explore_trips(t, CFG)


@_tables_query
def explore_trips_realised(t):
    return explore.explore_trips_realised(t, CFG)


@_tables_query
def explore_realised(t):
    return explore.explore_realised(t, CFG)


def source_csv_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matched table written as CSV, read back and typed again."""
    path = _scratch(spark, sf_dir, "matched_csv")
    write_matched_csv(analysis(spark, sf_dir).matched, path)
    return read_matched_csv(spark, path)


def sink_csv_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matched table as its cache by day returns it after a forced rewrite."""
    return QualityAnalysis(star_tables(spark, sf_dir), CFG, "trip",
                           _scratch(spark, sf_dir, "matched_forced")).run(force=True).matched


def sink_ranking_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _scratch(spark, sf_dir, "ranking_csv")
    write_ranking_csv(analysis(spark, sf_dir, "regularity").final_ranking(), path)
    return read_ranking_csv(spark, path)


QUERIES.update(source_csv_cache=source_csv_cache, sink_csv_cache=sink_csv_cache,
               sink_ranking_csv=sink_ranking_csv)


# --- projections and filters ----------------------------------------------------------

@_tables_query
def active_feeds(t):
    return scans.active_feeds(t.calendar, CFG)


def _joined(frame: DataFrame, name: str) -> DataFrame:
    return frame.select(F.array_join(F.col(name).cast("array<string>"), ",").alias(name))


@_tables_query
def active_service_ids(t):
    return _joined(scans.sorted_array(
        scans.active_service_ids(t.calendar, CFG), "service_id", "service_ids"), "service_ids")


@_tables_query
def filter_feed_floor(t):
    return t.trips.where(scans.feed_floor(CFG))


@_tables_query
def filter_feed_membership(t):
    return (scans.in_active_feeds(t.routes, scans.active_feeds(t.calendar, CFG))
            .select("feed_version", "feed_start_date", "route_id", "agency_id"))


@_tables_query
def filter_date_between(t):
    return t.realised.where(scans.in_period(CFG)).select("data", "id_viagem", "tempo_viagem")


@_tables_query
def filter_trim_eq(t):
    return (timetable.join_routes(scans.scan_trips(t, CFG), scans.scan_routes_agency(t, CFG))
            .where(timetable.same_line(F.col("route_short_name"), F.col("trip_short_name")))
            .select("feed_version", "route_id", "trip_id", "route_short_name",
                    "trip_short_name"))


@_tables_query
def filter_positive_duration(t):
    return (timetable.frequency_times(scans.scan_frequencies(t, CFG)).where("tempo_viagem > 0")
            .select("feed_version", "trip_id", "tempo_viagem", "headway"))


def _left_match(t: TransitTables) -> DataFrame:
    return matching.match_left(timetable.numbered_windows(t, CFG),
                               observed.observed_departures(t, CFG), CFG)


@_tables_query
def filter_not_null_pair(t):
    return scoring.not_null_pairs(_left_match(t))


@_tables_query
def direction_code(t):
    return t.trips.select("feed_version", "trip_id", "direction_id",
                          keys.direction_code(F.col("direction_id")).alias("sentido"))


@_trip_query
def select_rename(a):
    return scoring.select_rename(a.matched)


@_trip_query
def cast_types(a):
    texts = a.matched.select(*[F.col(c).cast("string").alias(c) for c in a.matched.columns])
    return scoring.cast_types(texts)


@_trip_query
def cast_types_rejects(a):
    """Texts that are no time or number, where some durations and departures are damaged."""
    texts = a.matched.select(*[F.col(c).cast("string").alias(c) for c in a.matched.columns])
    minutes = F.minute(F.col("datetime_partida_VR").cast("timestamp_ntz"))
    damaged = texts.withColumns({
        "tempo_viagem_VR": F.when(minutes % 7 == 0, F.concat(F.lit("x"), "tempo_viagem_VR"))
        .otherwise(F.col("tempo_viagem_VR")),
        "datetime_partida_VP": F.when(minutes % 11 == 0, F.lit("sem hora"))
        .when(minutes % 11 != 1, F.col("datetime_partida_VP"))})
    return scoring.reject_counts(scoring.cast_with_rejects(damaged))


@_regularity_query
def final_projection(a):
    return _rounded(a.scored, "score")


@_trip_query
def filter_service_lookup(a):
    """Indicators of all lines, with blanks around their names; unranked lines give -1."""
    requested = a.tables.trips.select(
        F.concat(F.lit(" "), F.trim("trip_short_name"), F.lit(" ")).alias("servico")).distinct()
    return _rounded(a.service_scores(requested), "indicador")


# --- joins ------------------------------------------------------------------------------

def _services(t: TransitTables) -> DataFrame:
    return timetable.join_trips_frequencies(scans.scan_trips(t, CFG),
                                            scans.scan_frequencies(t, CFG))


@_tables_query
def join_trips_frequencies(t):
    return _services(t)


@_tables_query
def join_left_agency(t):
    return scans.join_left_agency(t, CFG)


@_tables_query
def join_right_routes(t):
    joined = timetable.join_routes(_services(t), scans.scan_routes_agency(t, CFG), "right")
    return joined.select("feed_version", "route_id", "trip_id", "start_time", "agency_name",
                         "route_short_name")


@_tables_query
def join_calendar(t):
    calendar = scans.scan_calendar(t, CFG).drop("versao_modelo", "datetime_ultima_atualizacao")
    return timetable.join_calendar(_services(t), calendar).select(
        "data", "tipo_os", "service_id", "feed_version", "trip_id", "start_time", "end_time")


@_tables_query
def join_feed_range(t):
    return observed.realised_in_feeds(t, CFG).select(
        "data", "id_viagem", "inicio_periodo", "fim_periodo", "feed_version",
        "feed_start_date", "feed_end_date")


@_tables_query
def join_band_match(t):
    """Time-cell match over unexpanded timetable windows."""
    return matching.match_windows(timetable.numbered_windows(t, CFG),
                                  observed.observed_departures(t, CFG), CFG)


@_tables_query
def join_band_match_departures(t):
    """Time-cell match over individual departures."""
    return matching.match_departures(timetable.planned_departures(t, CFG),
                                     observed.observed_departures(t, CFG), CFG)


@_tables_query
def join_band_match_plain(t):
    """The pairs among all realised trips, those without a match included before."""
    return _left_match(t).where("servico_VP IS NOT NULL")


@_tables_query
def join_band_match_left(t):
    return _left_match(t)


def join_band_match_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The match of both sides stored by trip and time cell."""
    path = _scratch(spark, sf_dir, "layout")
    name = "pontualis_" + path.rsplit("/", 2)[-2]
    tables = star_tables(spark, sf_dir)
    match_layout.write_layout(tables, CFG, name, path, match_layout.buckets_for(tables, least=8))
    return match_layout.match_stored(spark, name, CFG)


QUERIES["join_band_match_bucketed"] = join_band_match_bucketed


@_tables_query
def associate_one_to_one(t):
    """Every trip and every departure in one pair at most, closest pairs first."""
    return assignment.one_to_one(matching.candidate_pairs(
        timetable.numbered_windows(t, CFG), observed.observed_departures(t, CFG), CFG))


@_regularity_query
def join_weights(a):
    return _rounded(regularity.share_scores(a.scored)
                    .select("faixa", "numero", "servico", "viagens", "total_viagens", "peso"),
                    "peso")


@_regularity_query
def join_score_parts(a):
    return _rounded(regularity.score_parts(a.scored), "score_hora", "score_subfaixa15")


@_tables_query
def unnest_cross(t):
    return t.calendar.select("data", "feed_version",
                             F.explode("service_ids").alias("service_id"))


@_tables_query
def audit_join_containment(t):
    return audits.timetable_containment(t, CFG)


# --- aggregations -------------------------------------------------------------------------

@_tables_query
def distinct_rows(t):
    return t.routes.distinct()


@_tables_query
def array_agg_distinct(t):
    return _joined(scans.sorted_array(
        scans.active_feeds(t.calendar, CFG), "feed_start_date", "feeds"), "feeds")


@_regularity_query
def hourly_trip_counts(a):
    return a.hourly_trip_counts()


@_trip_query
def service_mean(a):
    return _rounded(rankings.service_mean(a.scored, CFG.rank_digits), "score")


@_trip_query
def hour_service_mean(a):
    return _rounded(rankings.hour_service_mean(a.scored, CFG.rank_digits), "score")


@_regularity_query
def hour_share_weight(a):
    return _rounded(regularity.share_weight(a.scored, regularity.HOUR), "peso")


@_regularity_query
def quarter_share_weight(a):
    return _rounded(regularity.share_weight(a.scored, regularity.QUARTER), "peso")


@_regularity_query
def hour_regularity(a):
    return _rounded(a.hour_regularity(), "score")


@_regularity_query
def hour_regularity_worst(a):
    return _rounded(a.hour_regularity(worst_first=True), "score")


@_regularity_query
def quarter_regularity(a):
    return _rounded(a.quarter_regularity(worst_first=True), "score")


@_regularity_query
def quarter_regularity_best(a):
    return _rounded(a.quarter_regularity(), "score")


@_regularity_query
def regularity_rollup(a):
    hours = regularity.regularity_rollup(a.scored, regularity.HOUR)
    quarters = regularity.regularity_rollup(a.scored, regularity.QUARTER)
    return _rounded(hours.withColumn("faixa", F.lit(regularity.HOUR)).unionByName(
        quarters.withColumn("faixa", F.lit(regularity.QUARTER))), "score")


@_regularity_query
def regularity_sum(a):
    return _rounded(regularity.regularity_ranking(a.scored, CFG.rank_digits), "score")


@_trip_query
def minmax_normalise(a):
    return _rounded(a.scored, "score")


@_tables_query
def audit_duplicates(t):
    return _rounded(audits.timetable_duplicates(t, CFG), "razao")


@_tables_query
def audit_feed_floor_sweep(t):
    return audits.feed_floor_sweep(t, CFG)


@_tables_query
def audit_feed_match(t):
    return audits.feed_match(t, CFG)


@_trip_query
def audit_match_yield(a):
    return audits.match_yield(a.tables, a.matched, CFG)


@_tables_query
def audit_column_quality(t):
    return audits.column_quality(
        t.realised, ["id_empresa", "id_veiculo", "servico_informado", "servico_realizado",
                     "versao_modelo"])


@_tables_query
def audit_table_quality(t):
    """Exact counts of every column of every source table."""
    return audits.source_quality(t).drop("distintos", "frequentes")


# --- windows ----------------------------------------------------------------------------------

@_tables_query
def planned_sequence(t):
    return timetable.planned_departures(t, CFG)


@_tables_query
def planned_sequence_by_trip(t):
    return timetable.planned_departures_by_trip(t, CFG, "row_id")


@_tables_query
def planned_month_departures(t):
    """Departures of the month-long counter without the counter itself."""
    return timetable.planned_departures_by_trip(t, CFG)


@_tables_query
def realised_sequence(t):
    return observed.observed_departures(t, CFG)


@_tables_query
def realised_sequence_by_service(t):
    return observed.observed_departures_by_service(t, CFG)


@_regularity_query
def rank_position(a):
    mean = rankings.service_mean(a.scored, CFG.rank_digits)
    ranked = rankings.rank_position(mean, "score", F.col("score"))
    return _rounded(ranked.select("posicao", "servico", "score"), "score")


@_regularity_query
def positional_halves(a):
    return rush.positional_halves(a.hourly_trip_counts())


@_regularity_query
def lag_lead_gap(a):
    return rush.lag_lead_gap(rush.positional_halves(a.hourly_trip_counts()))


@_regularity_query
def argmax_per_group(a):
    """The best single trip of each hour."""
    hours = a.scored.withColumn("hora", clock.hour_bucket(F.col("data_partida")))
    return _rounded(rankings.trip_of_group(hours, "hora", best=True), "score")


# --- rankings -----------------------------------------------------------------------------------

@_trip_query
def service_ranking(a):
    return _rounded(a.service_ranking(), "indicador")


@_trip_query
def ranking_top10(a):
    return _rounded(a.top10(), "indicador")


@_trip_query
def ranking_bottom10(a):
    return _rounded(a.bottom10(), "indicador")


@_trip_query
def best_service_per_hour(a):
    return _rounded(a.best_service_per_hour(), "score")


@_trip_query
def worst_service_per_hour(a):
    return _rounded(a.worst_service_per_hour(), "score")


@_trip_query
def rush_hours(a):
    return a.rush_hours()


@_trip_query
def best_service_rush_hour(a):
    return _rounded(a.best_service_rush_hour(), "score")


@_trip_query
def worst_service_rush_hour(a):
    return _rounded(a.worst_service_rush_hour(), "score")


@_trip_query
def best_trip_per_quarter(a):
    return _rounded(a.best_trip_per_quarter(), "score")


@_trip_query
def worst_trip_per_quarter(a):
    return _rounded(a.worst_trip_per_quarter(), "score")


@_regularity_query
def final_ranking(a):
    return a.final_ranking()


@_regularity_query
def final_ranking_from_totals(a):
    """The final ranking of the month from stored totals of its days."""
    return a.final_ranking_of()


@_regularity_query
def week_ranking_from_totals(a):
    """The final ranking of one week from the totals that the month has left."""
    return a.final_ranking_of(date(2024, 1, 8) + timedelta(k) for k in range(7))


@_regularity_query
def band_totals_by_day(a):
    """The stored totals: trips, sum of scores and trips with a score per day, band and service."""
    return _rounded(a.stored_totals.read(), "soma")


@_regularity_query
def union_rush(a):
    """Rush hours of both halves together, with the half they come from."""
    return rush.rush_by_half(a.hourly_trip_counts(), CFG.rush_cut, CFG.rush_deviation)


# --- scalar rules over whole tables ---------------------------------------------------------------

@_tables_query
def parse_hms(t):
    parts = [clock.hms_part(F.col("start_time"), k).cast("bigint").alias(n)
             for k, n in enumerate(("horas", "minutos", "segundos"))]
    return t.frequencies.select("feed_version", "trip_id", "start_time", *parts)


@_tables_query
def extended_time_departure(t):
    days = scans.calendar_rows(t, CFG).select("data", *timetable.CALENDAR_KEYS).distinct()
    services = timetable.join_calendar(_services(t), days)
    return services.select("data", "feed_version", "trip_id", "start_time",
                           clock.extended_departure(F.col("data"), F.col("start_time"))
                           .alias("datetime_partida"))


@_tables_query
def wrapped_duration_min(t):
    return t.frequencies.select(
        "feed_version", "trip_id", "start_time", "end_time",
        clock.wrapped_duration_minutes(F.col("start_time"), F.col("end_time"))
        .alias("tempo_viagem"))


@_tables_query
def window_end(t):
    return timetable.timetable_windows(t, CFG).select(
        "data", "trip_id", "datetime_partida", "datetime_chegada", "tempo_viagem")


@_tables_query
def headway_minutes(t):
    return t.frequencies.select(
        "feed_version", "trip_id", "start_time", "headway_secs",
        clock.headway_minutes(F.col("headway_secs")).alias("headway"))


@_tables_query
def departure_count(t):
    return timetable.with_departure_count(timetable.timetable_windows(t, CFG)).select(
        "data", "trip_id", "datetime_partida", "tempo_viagem", "headway", "partidas")


@_tables_query
def expand_departures(t):
    return timetable.expand_departures(timetable.timetable_windows(t, CFG)).select(
        "data", "trip_id", "datetime_partida", "headway", "i")


def _generated(t: TransitTables) -> DataFrame:
    return timetable.generated_departures(timetable.numbered_windows(t, CFG))


@_tables_query
def generated_departure(t):
    return _generated(t).select("data", "trip_id", "row_id", "datetime_partida")


@_tables_query
def generated_arrival(t):
    return _generated(t).select("data", "trip_id", "row_id", "datetime_chegada")


@_tables_query
def trip_key_planned(t):
    return timetable.planned_departures(t, CFG).select("trip_id", "id_viagem")


@_tables_query
def trip_key_realised(t):
    return t.realised.select(F.col("id_viagem").alias("id_completo"),
                             keys.trip_key_realised(F.col("id_viagem")).alias("id_viagem"))


@_tables_query
def date_cast(t):
    return t.realised.select("id_viagem", F.col("inicio_periodo").cast("date").alias("inicio"),
                             F.col("fim_periodo").cast("date").alias("fim"))


@_tables_query
def score_travel_time(t):
    return t.realised.select("id_viagem", "tempo_viagem",
                             scores.score_travel_time(F.col("tempo_viagem")).alias("score"))


@_trip_query
def score_reliability(a):
    seconds = clock.seconds_between(F.col("datetime_partida_VR"), F.col("datetime_partida_VP"))
    return a.matched.select("servico_VP", "datetime_partida_VP", "datetime_partida_VR",
                            scores.score_reliability(seconds).alias("score"))


@_trip_query
def score_departure_arrival(a):
    return scoring.select_rename(a.matched).select(
        "servico", "partida_planejada", "partida_realizada",
        scoring.punctuality().alias("score_partida_chegada"))


@_trip_query
def score_travel_delta(a):
    return scoring.select_rename(a.matched).select(
        "servico", "tempo_viagem_planejada", "tempo_viagem_realizada",
        scoring.travel_delta().alias("score_viagem"))


@_trip_query
def score_weighted(a):
    return scoring.with_scores(scoring.select_rename(a.matched), CFG).select(
        "servico", "partida_planejada", "partida_realizada", _score(F.col("score")))


@_trip_query
def score_error_factor(a):
    return scoring.select_rename(a.matched).select(
        "servico", "tempo_viagem_planejada", "tempo_viagem_realizada",
        _score(scoring.error_factor(), "fator"))


@_tables_query
def hour_bucket(t):
    return t.realised.select("id_viagem", "datetime_partida",
                             clock.hour_bucket(F.col("datetime_partida")).alias("hora"))


@_tables_query
def quarter_hour_bucket(t):
    return t.realised.select(
        "id_viagem", "datetime_partida",
        clock.quarter_hour_bucket(F.col("datetime_partida")).alias("SubFaixa15"))


@_trip_query
def round_score(a):
    return a.scored.select("servico", "data_partida",
                           scores.score_percent(F.col("score")).alias("score"))
