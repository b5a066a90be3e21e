"""Share-weighted regularity by hour and by 15-minute band, and the final ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pontualis.functions import clock, scores
from pontualis.operators.rankings import rank_position, with_service
from pontualis.operators.scoring import minmax_normalise

HOUR = "hora"
QUARTER = "SubFaixa15"


def bucket_label(bucket: str, number: Column) -> Column:
    return number if bucket == HOUR else clock.quarter_hour_label(number)


def band_totals(scored: DataFrame, *keys: str) -> DataFrame:
    """Trips, sum of scores and trips with a score per 15-minute band and service.

    Totals of disjoint sets of trips add up to those of their union.  Further ``keys``, such as
    the day, keep them apart.
    """
    return (with_service(scored).where(F.col("data_partida").isNotNull())
            .groupBy(*keys, clock.quarter_hour_number(F.col("data_partida")).alias("banda"), "servico")
            .agg(F.count(F.lit(1)).alias("viagens"), F.sum("score").alias("soma"),
                 F.count("score").alias("validas")))


def share_scores(scored: DataFrame) -> DataFrame:
    """``share_scores_of`` the trips, which are read and aggregated once."""
    return share_scores_of(band_totals(scored))


def share_scores_of(totals: DataFrame) -> DataFrame:
    """Mean score and share of the trips, per bucket kind, bucket and service.

    ``totals`` may hold several rows of a band and service, for instance one a day.
    Hours are sums of bands, so both kinds come out of that small input.  The window
    behind the bucket totals sees one row per service, not trips.
    """
    kinds = F.explode(F.array(
        F.struct(F.lit(HOUR).alias("faixa"),
                 clock.floor_div(F.col("banda"), 4).alias("numero")),
        F.struct(F.lit(QUARTER).alias("faixa"), F.col("banda").alias("numero"))))
    bucket = Window.partitionBy("faixa", "numero")
    return (totals.withColumn("_kind", kinds)
            .groupBy("_kind.faixa", "_kind.numero", "servico")
            .agg(F.sum("viagens").alias("viagens"),
                 F.try_divide(F.sum("soma"), F.sum("validas")).alias("media"))
            .withColumn("total_viagens", F.sum("viagens").over(bucket))
            .withColumn("peso", F.col("viagens") / F.col("total_viagens")))


def _bucket(shares: DataFrame, bucket: str, value: Column) -> DataFrame:
    return shares.where(F.col("faixa") == bucket).select(
        bucket_label(bucket, F.col("numero")).alias(bucket), "servico", value)


def share_weight(scored: DataFrame, bucket: str) -> DataFrame:
    """Share of a service in the trips of a bucket."""
    return _bucket(share_scores(scored), bucket, F.col("peso"))


def _corrected() -> Column:
    return F.col("media") * F.col("peso")


def bucket_regularity(scored: DataFrame, bucket: str) -> DataFrame:
    """Mean score of a service in a bucket, corrected by its share of the trips."""
    return _bucket(share_scores(scored), bucket, _corrected().alias("score"))


def most_regular(regularity: DataFrame) -> DataFrame:
    return regularity.orderBy(F.desc("score"), "servico")


def least_regular(regularity: DataFrame) -> DataFrame:
    return regularity.orderBy(F.asc("score"), "servico")


def regularity_rollup(scored: DataFrame, bucket: str) -> DataFrame:
    """Mean of the corrected scores of a service over the buckets it runs in."""
    return bucket_regularity(scored, bucket).groupBy("servico").agg(F.avg("score").alias("score"))


def score_parts(scored: DataFrame) -> DataFrame:
    return score_parts_of(band_totals(scored))


def score_parts_of(totals: DataFrame) -> DataFrame:
    """Both rollups side by side, from one aggregation.

    A service with trips has trips in some hour and in some band, so the two
    rollups list the same services and no join is needed to bring them together.
    """
    def part(bucket: str) -> Column:
        return F.avg(F.when(F.col("faixa") == bucket, _corrected()))

    return (share_scores_of(totals).groupBy("servico")
            .agg(part(HOUR).alias("score_hora"), part(QUARTER).alias("score_subfaixa15")))


def _sums(totals: DataFrame, digits: int) -> DataFrame:
    return score_parts_of(totals).select(
        "servico",
        F.round(F.col("score_hora") + F.col("score_subfaixa15"), digits).alias("score"))


def regularity_sum(scored: DataFrame, digits: int) -> DataFrame:
    return _sums(band_totals(scored), digits)


def _placed(totals: DataFrame, digits: int) -> DataFrame:
    total = _sums(totals, digits).withColumn("_unit", F.col("score"))
    return rank_position(minmax_normalise(total, "_unit"), "score", F.col("_unit"))


def regularity_ranking(scored: DataFrame, digits: int) -> DataFrame:
    """Position, service and unscaled sum of both rollups."""
    return _placed(band_totals(scored), digits).select("posicao", "servico", "score")


def final_ranking(scored: DataFrame, digits: int) -> DataFrame:
    """Position, service and regularity in percent of the best service."""
    return final_ranking_of(band_totals(scored), digits)


def final_ranking_of(totals: DataFrame, digits: int) -> DataFrame:
    """The final ranking from totals of bands, such as stored ones of the days of a period."""
    return _placed(totals, digits).select(
        "posicao", "servico", scores.score_percent(F.col("_unit")).alias("score"))
