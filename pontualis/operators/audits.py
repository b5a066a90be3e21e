"""Data-quality audits, each in one pass over pre-aggregated rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import fields, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from pontualis.config import AnalysisConfig
from pontualis.operators import observed, scans, timetable
from pontualis.operators.salting import shuffled
from pontualis.sources.tables import TransitTables


def join_containment(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row counts of the inner, left and right join of two tables on ``keys``.

    The join is never materialised: both sides are counted per key first, so
    the counts of a key multiply in one row however often it occurs.
    """
    a = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_left"))
    b = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_right"))
    joined = a.join(b, list(keys), "full_outer")
    both = F.coalesce(F.sum(F.col("_left") * F.col("_right")), F.lit(0))
    left_only = F.coalesce(F.sum(F.when(F.col("_right").isNull(), F.col("_left"))), F.lit(0))
    right_only = F.coalesce(F.sum(F.when(F.col("_left").isNull(), F.col("_right"))), F.lit(0))
    return joined.agg(both.alias("inner_rows"), left_only.alias("left_only_rows"),
                      right_only.alias("right_only_rows")) \
        .select("inner_rows", "left_only_rows", "right_only_rows",
                (F.col("inner_rows") + F.col("left_only_rows")).alias("left_rows"),
                (F.col("inner_rows") + F.col("right_only_rows")).alias("right_rows"))


def timetable_containment(tables: TransitTables, cfg: AnalysisConfig) -> DataFrame:
    """Containment of the three timetable joins."""
    trips = scans.scan_trips(tables, cfg)
    services = timetable.join_trips_frequencies(trips, scans.scan_frequencies(tables, cfg))
    audits = (
        ("trips_frequencies", trips, scans.scan_frequencies(tables, cfg),
         timetable.TRIP_FREQUENCY_KEYS),
        ("trips_routes", services, scans.scan_routes_agency(tables, cfg),
         timetable.ROUTE_KEYS),
        ("trips_calendar", services, scans.scan_calendar(tables, cfg),
         timetable.CALENDAR_KEYS),
    )
    result = None
    for name, left, right, keys in audits:
        row = join_containment(left, right, keys).select(F.lit(name).alias("join_name"), "*")
        result = row if result is None else result.unionByName(row)
    return result


def _copies(windows: DataFrame) -> Column:
    """Number of raw joined rows behind a row of counted inputs."""
    return reduce(lambda a, b: a * b,
                  [F.col(c) for c in windows.columns if c.startswith("_copies_")])


def timetable_duplicates(tables: TransitTables, cfg: AnalysisConfig) -> DataFrame:
    """Rows of the timetable join over the raw inputs, distinct rows, and their ratio.

    Copies are counted per input and multiplied along the joins, so the copied
    rows themselves are never produced.
    """
    windows = timetable.scheduled_windows(tables, cfg, reduce=timetable.counted_rows)
    columns = [c for c in windows.columns if not c.startswith("_copies_")]
    return (windows.groupBy(*columns).agg(F.sum(_copies(windows)).alias("_copies"))
            .agg(F.coalesce(F.sum("_copies"), F.lit(0)).alias("linhas"),
                 F.count(F.lit(1)).alias("linhas_distintas"))
            .withColumn("razao", F.try_divide(F.col("linhas").cast("double"),
                                              F.col("linhas_distintas").cast("double"))))


def feed_floor_sweep(tables: TransitTables, cfg: AnalysisConfig) -> DataFrame:
    """Timetable rows each candidate feed floor would return, for all floors in one pass.

    Scans take every feed version, also those below the configured floor.  A row
    belongs to one version, so a floor keeps the rows of its own and all later
    versions.  Counted are the joined rows over the raw inputs (``brutas``) and the
    distinct ones, both without the agency.  The last step runs over one row per
    feed version.
    """
    windows = timetable.scheduled_windows(tables, replace(cfg, feed_floor=""),
                                          reduce=timetable.counted_rows, with_agency=False)
    per_version = windows.groupBy("feed_version").agg(
        F.sum(_copies(windows)).alias("brutas"), F.count(F.lit(1)).alias("linhas"))
    later = (Window.orderBy(F.desc("feed_version"))
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return per_version.withColumns({
        "brutas_com_piso": F.sum("brutas").over(later),
        "linhas_com_piso": F.sum("linhas").over(later)})


def feed_match(tables: TransitTables, cfg: AnalysisConfig) -> DataFrame:
    """Where realised trips stay in the join with the feeds, as counts only.

    Trips in, trips that lie in no feed, in one and in several, rows of the join, and
    trips whose trimmed model version also equals that of a feed they lie in.  The
    feeds are few: each trip is looked up among them as in the match.
    """
    trips = scans.scan_realised(tables, cfg).select(
        "id_viagem", "inicio_periodo", "fim_periodo", F.trim("versao_modelo").alias("_model"))
    trips = trips.groupBy(*trips.columns).agg(F.count(F.lit(1)).alias("_trips"))
    feeds = tables.feed_info.where(scans.feed_floor(cfg)).select(
        "feed_version", "feed_start_date", "feed_end_date",
        F.trim("versao_modelo").alias("_feed_model"))
    found = (observed.join_feed_range(trips, feeds, ["id_viagem"])
             .groupBy("id_viagem", "inicio_periodo", "fim_periodo", "_model", "_trips").agg(
                 F.count(F.lit(1)).alias("_feeds"),
                 F.max(F.coalesce(F.col("_model") == F.col("_feed_model"), F.lit(False)))
                 .alias("_same")))
    n, feeds_of = F.col("_trips"), F.col("_feeds")
    inside = found.agg(
        F.sum(F.when(feeds_of == 1, n)).alias("um"), F.sum(F.when(feeds_of > 1, n)).alias("varios"),
        F.sum(n * feeds_of).alias("linhas"), F.sum(F.when(F.col("_same"), n)).alias("modelo"))
    zero = F.lit(0).cast("bigint")
    total = trips.agg(F.coalesce(F.sum("_trips"), zero).alias("viagens"))
    both = total.withColumn("_one", F.lit(1)).join(inside.withColumn("_one", F.lit(1)), "_one")
    return both.select(
        "viagens", (F.col("viagens") - F.coalesce("um", zero) - F.coalesce("varios", zero))
        .alias("em_nenhum_feed"), F.coalesce("um", zero).alias("em_um_feed"),
        F.coalesce("varios", zero).alias("em_varios_feeds"),
        F.coalesce("linhas", zero).alias("linhas"),
        F.coalesce("modelo", zero).alias("com_modelo_igual"))


def match_yield(tables: TransitTables, matched: DataFrame, cfg: AnalysisConfig) -> DataFrame:
    """Per day and service: realised departures, those with a match, and matched pairs.

    Both sides are counted before they are joined.  A departure is identified as in
    the matched table, by service, both times and duration.
    """
    keys = ["servico", "partida", "chegada", "tempo"]
    done = (observed.observed_departures(tables, cfg)
            .select(F.col("servico_realizado").alias("servico"),
                    F.col("datetime_partida").alias("partida"),
                    F.col("datetime_chegada").alias("chegada"),
                    F.col("tempo_viagem").alias("tempo")).distinct())
    pairs = matched.select(
        F.col("service_VR").alias("servico"), F.col("datetime_partida_VR").alias("partida"),
        F.col("datetime_chegada_VR").alias("chegada"), F.col("tempo_viagem_VR").alias("tempo"))
    pairs = pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("_pairs"))
    day = F.col("partida").cast("date").alias("data")
    all_ = done.groupBy(day, "servico").agg(F.count(F.lit(1)).alias("viagens"))
    met = pairs.groupBy(day, "servico").agg(F.count(F.lit(1)).alias("viagens_associadas"),
                                            F.sum("_pairs").alias("pares"))
    zero = F.lit(0).cast("bigint")
    return all_.join(shuffled(met), ["data", "servico"], "left").select(
        "data", "servico", "viagens",
        F.coalesce("viagens_associadas", zero).alias("viagens_associadas"),
        F.coalesce("pares", zero).alias("pares"))


# Fixed pattern: a character or a sign behind a digit that no integer has, blanks around it or not.
_NO_DIGITS = r"[!-*,/:-~]|[0-9.][+-]"


def _no_integer(text: Column) -> Column:
    """Whether a text is there and is no integer.

    A failing cast costs many times a passing one, so it is left to texts that may be integers.
    """
    return text.isNotNull() & (F.when(text.rlike(_NO_DIGITS), F.lit(True))
                               .otherwise(text.try_cast("bigint").isNull()))


def column_quality(frame: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per text column: rows, NULLs, values with trailing blanks, values that are no integer.

    All columns are counted in one scan and one partial aggregate; the single
    row is then turned into one row per column.
    """
    def counts(name: str):
        value = F.col(name).cast("string")
        return F.struct(
            F.lit(name).alias("coluna"), F.count(F.lit(1)).alias("linhas"),
            F.count_if(value.isNull()).alias("nulos"),
            F.count_if(value != F.rtrim(value)).alias("brancos_no_fim"),
            F.count_if(_no_integer(value)).alias("nao_inteiros"))

    row = frame.agg(F.array(*[counts(c) for c in columns]).alias("_counts"))
    return row.select(F.inline("_counts"))


# Relative error (one standard deviation) of a distinct count: 1.04 / sqrt(2 ** 12).
DISTINCT_BITS = 12
# Values a heavy-hitter sketch keeps at most; it names every value of more than 1 / 128 of all rows.
HITTERS = 128


def _is_text(field: StructField) -> bool:
    return field.dataType.typeName() == "string"


def table_quality(frame: DataFrame, name: str) -> DataFrame:
    """Per column of a table: rows, NULLs, and for texts empty, blank-ended and non-integer values.

    Beside the exact counts stand two sketches of the values as text: ``distintos`` for the number of
    distinct values, ``frequentes`` for the most frequent ones.  Everything comes from one scan with one
    partial aggregate; rows of ``merged_quality`` add up those of several days or tables.
    """
    def counts(field: StructField) -> Column:
        value, zero = F.col(f"`{field.name}`"), F.lit(0).cast("bigint")
        text = value.cast("string")
        exact = [F.count_if(text == ""), F.count_if(text != F.rtrim(text)), F.count_if(_no_integer(text))]
        return F.struct(
            F.lit(name).alias("tabela"), F.lit(field.name).alias("coluna"),
            F.count(F.lit(1)).alias("linhas"), F.count_if(value.isNull()).alias("nulos"),
            *[(c if _is_text(field) else zero).alias(n)
              for c, n in zip(exact, ("vazios", "brancos_no_fim", "nao_inteiros"))],
            F.hll_sketch_agg(text, F.lit(DISTINCT_BITS)).alias("distintos"),
            F.call_function("approx_top_k_accumulate", text, F.lit(HITTERS)).alias("frequentes"))

    row = frame.agg(F.array(*[counts(f) for f in frame.schema]).alias("_counts"))
    return row.select(F.inline("_counts"))


def merged_quality(parts: DataFrame) -> DataFrame:
    """Counts and sketches of the parts of a table added up, per column."""
    exact = ["linhas", "nulos", "vazios", "brancos_no_fim", "nao_inteiros"]
    return parts.groupBy("tabela", "coluna").agg(
        *[F.sum(c).alias(c) for c in exact], F.hll_union_agg("distintos").alias("distintos"),
        F.call_function("approx_top_k_combine", F.col("frequentes")).alias("frequentes"))


def estimated_quality(quality: DataFrame, k: int = 5) -> DataFrame:
    """The exact counts, the estimated number of distinct values, and the ``k`` most frequent ones."""
    return quality.withColumns({"distintos": F.hll_sketch_estimate("distintos"),
                                "frequentes": F.call_function("approx_top_k_estimate", F.col("frequentes"), F.lit(k))})


def source_quality(tables: TransitTables) -> DataFrame:
    """``table_quality`` of all source tables."""
    names = [f.name for f in fields(TransitTables)]
    parts = [table_quality(getattr(tables, n), n) for n in names]
    return reduce(DataFrame.unionByName, parts)
