"""The ranking file: semicolon-separated UTF-8 with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pontualis import schemas
from pontualis.sources.csv_form import csv_reader, write_csv


def write_ranking_csv(ranking: DataFrame, path: str) -> None:
    """Write the ranking in order of position.

    A ranking has one row per service, far fewer than trips, and a single
    readable file is the product.
    """
    write_csv(ranking.orderBy("posicao").coalesce(1), path)


def read_ranking_csv(spark: SparkSession, path: str) -> DataFrame:
    return csv_reader(spark).schema(schemas.RANKING).csv(path)
