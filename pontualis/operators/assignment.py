"""One-to-one association of realised trips with planned departures.

The band match is many to many.  Here every trip and every departure is used at most once.
Pairs are ordered by the distance of the departures, then of the counters, then by
their times, so no two pairs of a trip or of a departure are equal.  In each round a pair is
taken when it is the best one left both of its trip and of its departure; pairs that
share a side with it go.  The rounds end when no pair is left.  The result is
the one stable assignment: no pair that was left out is better for both its sides.

A round sorts the few pairs of one trip or of one departure, never a whole line or day, and
works on what the round before has left.  The closest pair left is always taken, so every round
takes some; rounds are as many as the longest chain of pairs in which each is closer
than the one before.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pontualis.operators.matching import MATCH_KEYS, MATCHED_TIMES
from pontualis.session import shared_folder

TRIP = [*MATCH_KEYS, *[c for c in MATCHED_TIMES if c.endswith("_VR")]]
DEPARTURE = [*MATCH_KEYS, *[c for c in MATCHED_TIMES if c.endswith("_VP")]]
ORDER = ["distancia_segundos", "distancia_contador", *MATCHED_TIMES]


def mutual_best(pairs: DataFrame, left: Sequence[str], right: Sequence[str],
                order: Sequence[str]) -> DataFrame:
    """The stable assignment of the sides ``left`` and ``right`` of distinct pairs.

    ``order`` must tell all pairs of one side apart.  Each round is written to the shared
    folder, so its work is never repeated for a lost executor.
    """
    spark = pairs.sparkSession
    root = f"{shared_folder(spark)}/assignment-{uuid4().hex}"

    def written(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{root}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{root}/{name}")

    place = F.row_number()
    of_left, of_right = Window.partitionBy(*left), Window.partitionBy(*right)
    left_over, rounds = written(pairs, "pairs"), []
    while not left_over.isEmpty():
        marked = (left_over.withColumn("_left", place.over(of_left.orderBy(*order)))
                  .withColumn("_taken", (F.col("_left") == 1)
                              & (place.over(of_right.orderBy(*order)) == 1))
                  .withColumn("_right_gone", F.max("_taken").over(of_right))
                  .withColumn("_gone", F.col("_right_gone") | F.max("_taken").over(of_left)))
        marked = written(marked.select(*pairs.columns, "_taken", "_gone"), f"round{len(rounds)}")
        rounds.append(marked.where("_taken").select(*pairs.columns))
        left_over = marked.where(~F.col("_gone")).select(*pairs.columns)
    return reduce(DataFrame.unionByName, rounds) if rounds else left_over


def one_to_one(pairs: DataFrame) -> DataFrame:
    """The assigned pairs of ``matching.candidate_pairs``."""
    return mutual_best(pairs, TRIP, DEPARTURE, ORDER).select(*MATCH_KEYS, *MATCHED_TIMES)
