"""The CSV form of results: semicolons, UTF-8, a header, every text as it is.

Blanks around values are kept.  NULL is written as ``\\N`` and an empty text as a
quoted empty field, quotes are doubled, and a value may hold line breaks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession

_OPTIONS = {"sep": ";", "header": True, "encoding": "UTF-8", "quote": '"', "escape": '"',
            "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
            "nullValue": "\\N"}


def write_csv(frame: DataFrame, path: str) -> None:
    (frame.write.mode("overwrite").options(**_OPTIONS).option("emptyValue", '""').csv(path))


def csv_reader(spark: SparkSession) -> DataFrameReader:
    return spark.read.options(**_OPTIONS).option("emptyValue", "").option("multiLine", True)
