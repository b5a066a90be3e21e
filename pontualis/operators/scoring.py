"""From matches to one score per realised trip."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pontualis import schemas
from pontualis.config import AnalysisConfig
from pontualis.functions import clock, scores

# ``trip`` multiplies the duration error factor in and normalises per trip;
# ``regularity`` does neither and leaves the normalisation to the final ranking.
MODES = ("trip", "regularity")


def not_null_pairs(matched: DataFrame) -> DataFrame:
    return matched.dropna(subset=["tempo_viagem_VP", "tempo_viagem_VR"])


def cast_types(raw: DataFrame) -> DataFrame:
    """Types of the matched table from text columns; unreadable values become NULL."""
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name)
                        for f in schemas.MATCHED])


def cast_with_rejects(raw: DataFrame) -> DataFrame:
    """``cast_types`` and, in ``rejeitados``, column and text of each value that has no such type.

    A NULL text is a NULL, not a reject; so the two can be told apart.
    """
    def reject(field) -> Column:
        text = F.col(field.name)
        broken = text.isNotNull() & text.try_cast(field.dataType).isNull()
        return F.when(broken, F.struct(F.lit(field.name).alias("coluna"), text.alias("valor")))

    rejects = F.filter(F.array(*[reject(f) for f in schemas.MATCHED]), lambda r: r.isNotNull())
    return raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schemas.MATCHED],
                      rejects.alias("rejeitados"))


def reject_counts(cast: DataFrame) -> DataFrame:
    """Rejected texts of ``cast_with_rejects`` with their column and number of rows."""
    return (cast.select(F.inline("rejeitados")).groupBy("coluna", "valor")
            .agg(F.count(F.lit(1)).alias("linhas")))


def select_rename(matched: DataFrame) -> DataFrame:
    return matched.select(
        F.col("servico_VP").alias("servico"),
        F.col("datetime_partida_VP").alias("partida_planejada"),
        F.col("datetime_partida_VR").alias("partida_realizada"),
        F.col("datetime_chegada_VP").alias("chegada_planejada"),
        F.col("datetime_chegada_VR").alias("chegada_realizada"),
        F.col("tempo_viagem_VP").alias("tempo_viagem_planejada"),
        F.col("tempo_viagem_VR").alias("tempo_viagem_realizada"))


def punctuality() -> Column:
    """Reliability of the departure plus that of the arrival."""
    def part(event: str) -> Column:
        return scores.score_reliability(clock.seconds_between(
            F.col(f"{event}_realizada"), F.col(f"{event}_planejada")))

    return part("partida") + part("chegada")


def travel_delta() -> Column:
    return scores.score_travel_delta(F.col("tempo_viagem_planejada"),
                                     F.col("tempo_viagem_realizada"))


def error_factor() -> Column:
    return scores.score_error_factor(F.col("tempo_viagem_planejada"),
                                     F.col("tempo_viagem_realizada"))


def with_scores(trips: DataFrame, cfg: AnalysisConfig) -> DataFrame:
    """Renamed matches with the two partial scores and their weighted sum."""
    return (trips
            .withColumn("score_partida_chegada", punctuality())
            .withColumn("score_viagem", travel_delta())
            .withColumn("score", scores.score_weighted(
                F.col("score_partida_chegada"), F.col("score_viagem"),
                cfg.weight_reliability, cfg.weight_travel)))


def minmax_normalise(frame: DataFrame, column: str) -> DataFrame:
    """Scale a column to 0..1 over the whole table; NULL when all values are equal.

    The bounds are scalar subqueries, which Spark merges into one aggregate, not
    a window over all rows.
    """
    low, high = (frame.agg(bound(column)).scalar() for bound in (F.min, F.max))
    return frame.withColumn(column, F.try_divide(F.col(column) - low, high - low))


def final_projection(trips: DataFrame) -> DataFrame:
    return trips.select("servico", "score", F.col("partida_realizada").alias("data_partida"))


def score_matches(matched: DataFrame, cfg: AnalysisConfig, mode: str = "trip") -> DataFrame:
    """One row per match: service, score and realised departure."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    trips = with_scores(select_rename(matched), cfg)
    if mode == "trip":
        trips = minmax_normalise(
            trips.withColumn("score", F.col("score") * error_factor()), "score")
    return final_projection(trips)
