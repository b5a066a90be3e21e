"""Joins that stay in bounded memory: of two large tables, and of a large table with a small one.

Spark takes the size of a table it has not read yet from its files.  Packed files, and rows
that multiply on the way, hide tables of many times that size; broadcast, they would pass through
the driver whole.  Where both sides grow, ``shuffled`` rules that out.

The rest is about joins of a large table with a small one on keys of few values.

A key with few values would send the large side to as many tasks.  Here each
row of the large side also draws one of ``SALTS`` salts from other columns, and
the small side is repeated once per salt.  The rows are the same; no key of the
shuffle holds more than a part of the rows of its value.  Where the small side is
measured to be small, Spark broadcasts it all the same.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 64


def shuffled(side: DataFrame) -> DataFrame:
    """The side of a join of two growing tables, to be sorted and merged, never broadcast."""
    return side.hint("merge")


def salted_join(large: DataFrame, small: DataFrame, keys: Sequence[str], spread: Sequence[str],
                how: str = "inner") -> DataFrame:
    """``large`` joined with ``small``; ``spread`` are columns of many values of ``large``."""
    salted = large.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int"))
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")
