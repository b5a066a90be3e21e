"""The CSV form of the matched table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pontualis import schemas
from pontualis.operators.scoring import cast_types, cast_with_rejects
from pontualis.sources.csv_form import csv_reader, write_csv


def write_matched_csv(matched: DataFrame, path: str) -> None:
    """Semicolon-separated UTF-8 text with a header."""
    moments = [f.name for f in schemas.MATCHED if f.dataType.typeName() == "timestamp_ntz"]
    texts = matched.withColumns({c: F.col(c).cast("string") for c in moments})
    write_csv(texts, path)


def _csv_texts(spark: SparkSession, path: str) -> DataFrame:
    texts = ", ".join(f"{name} string" for name in schemas.MATCHED.names)
    return csv_reader(spark).option("enforceSchema", False).schema(texts).csv(path)


def read_matched_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read the CSV form as text by column name, then cast to the matched types."""
    return cast_types(_csv_texts(spark, path))


def load_matched_csv(spark: SparkSession, path: str, target: str) -> tuple[DataFrame, DataFrame]:
    """Read the CSV form once into a Parquet table: the typed rows, and the rejected texts.

    Both results are read from ``target``; the rejects (``coluna``, ``valor``) read one column of it.
    """
    cast_with_rejects(_csv_texts(spark, path)).write.mode("overwrite").parquet(target)
    stored = spark.read.parquet(target)
    return stored.select(*schemas.MATCHED.names), stored.select(F.inline("rejeitados"))
