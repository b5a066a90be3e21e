"""Rankings over the scored trips.

Everything aggregates first.  The best or worst row of a group is the minimum
of a struct, which Spark combines before the shuffle, so even a 15-minute band
that holds a third of all trips is never collected into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pontualis.functions import clock
from pontualis.operators.numbering import number_rows

# Score cells used to number a ranking: scores are spread over this many slices.
RANK_CELLS = 1000


def with_service(scored: DataFrame) -> DataFrame:
    return scored.where(F.col("servico").isNotNull())


def mean_score(digits: int) -> Column:
    """Mean score, rounded far below its precision so that ties are exact ties."""
    return F.round(F.avg("score"), digits)


def service_mean(scored: DataFrame, digits: int) -> DataFrame:
    return with_service(scored).groupBy("servico").agg(mean_score(digits).alias("score"))


def hour_service_mean(scored: DataFrame, digits: int) -> DataFrame:
    return (with_service(scored).groupBy(clock.hour_bucket(F.col("data_partida")).alias("hora"),
                                         "servico")
            .agg(mean_score(digits).alias("score")))


def rank_position(frame: DataFrame, score: str, unit: Column) -> DataFrame:
    """Positions from 1, best score first, equal scores by service.

    ``unit`` grows with the score, at best from 0 to 1.  It places each service
    in a slice of 1 / ``RANK_CELLS``, so the numbering is spread over tasks.
    NULL scores come last, behind negative ones too.
    """
    cell = F.struct(unit.isNull().alias("last"),
                    (-F.floor(unit * RANK_CELLS)).cast("bigint").alias("slice"))
    return number_rows(frame, [], cell,
                       [F.col(score).desc_nulls_last(), F.col("servico").asc()], "posicao")


def service_ranking(scored: DataFrame, digits: int) -> DataFrame:
    """Services by mean trip score (scores normalised per trip)."""
    ranked = rank_position(service_mean(scored, digits), "score", F.col("score"))
    return ranked.select("posicao", "servico", F.col("score").alias("indicador"))


def ranking_top(ranking: DataFrame, n: int = 10) -> DataFrame:
    return ranking.orderBy("posicao").limit(n)


def ranking_bottom(ranking: DataFrame, n: int = 10) -> DataFrame:
    return ranking.orderBy(F.desc("posicao")).limit(n)


def service_scores(ranking: DataFrame, requested: DataFrame) -> DataFrame:
    """Indicator of each requested service, -1 for services that are not ranked.

    Names are compared without surrounding blanks; of several ranked services
    with the same trimmed name the best placed one answers.
    """
    known = (ranking.groupBy(F.trim("servico").alias("_nome"))
             .agg(F.min_by("indicador", "posicao").alias("_indicador")))
    return (requested.withColumn("_nome", F.trim("servico"))
            .join(known, "_nome", "left")
            .select("servico", F.coalesce("_indicador", F.lit(-1.0)).alias("indicador")))


def best_row(frame: DataFrame, group: str, best_first: bool, ties: list[str]) -> DataFrame:
    """Row with the highest (or lowest) score of each group; NULL scores do not compete."""
    rank = -F.col("score") if best_first else F.col("score")
    return (frame.where(F.col("score").isNotNull())
            .groupBy(group)
            .agg(F.min(F.struct(rank.alias("_rank"), *ties, "score")).alias("_row"))
            .select(group, *[F.col(f"_row.{c}") for c in (*ties, "score")]))


def service_per_hour(scored: DataFrame, digits: int, best: bool = True) -> DataFrame:
    return best_row(hour_service_mean(scored, digits), "hora", best, ["servico"])


def service_rush_hour(per_hour: DataFrame, rush: DataFrame) -> DataFrame:
    """Restrict an hourly ranking to the rush hours; both sides have at most 24 rows."""
    return per_hour.join(F.broadcast(rush.select("hora")), "hora", "left_semi")


def trip_of_group(scored: DataFrame, group: str, best: bool) -> DataFrame:
    """Best or worst single trip per group, the earliest one on ties.

    Trips are first reduced to the earliest departure per group, service and
    score: a hash aggregate over fixed-width values that combines before the
    shuffle.  The struct comparison, which Spark can only aggregate by sorting,
    then runs over that small result.
    """
    earliest = (scored.where(F.col(group).isNotNull() & F.col("score").isNotNull())
                .groupBy(group, "servico", "score")
                .agg(F.min("data_partida").alias("data_partida")))
    return best_row(earliest, group, best, ["data_partida", "servico"])


def trip_per_quarter(scored: DataFrame, best: bool = True) -> DataFrame:
    """Best or worst single trip of each 15-minute band, in ranking order."""
    banded = scored.withColumn("_band", clock.quarter_hour_number(F.col("data_partida")))
    order = F.desc("score") if best else F.asc("score")
    return (trip_of_group(banded, "_band", best).orderBy(order, "_band")
            .select("servico", "score", "data_partida",
                    clock.quarter_hour_label(F.col("_band")).alias("SubFaixa15")))
