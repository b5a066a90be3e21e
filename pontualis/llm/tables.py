"""Reading inputs, tables written between jobs, and joins with hot keys."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pontualis.session import shared_folder

# A key with more than this share of all rows is hot; at most 1 / share keys can be.
HOT_SHARE = 1 / 500
# Ids are broadcast up to this number (about 16 bytes each), and joined by a shuffle beyond.
BROADCAST_IDS = 2_000_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Workspace:
    """A folder of written tables, shared by all executors, that cuts lineage.

    A lost executor costs only the tasks that ran on it: every later job reads
    the written files.  ``drop`` deletes a table that is no longer read.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"

    def save(self, frame: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm.org.apache.hadoop.fs.Path
        for name in names:
            path = jvm(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def broadcast_up_to(frame: DataFrame, rows: int) -> DataFrame:
    """The frame, marked for broadcast if its counted rows are few enough."""
    return F.broadcast(frame) if frame.count() <= rows else frame


def join_unique(left: DataFrame, right: DataFrame, keys: Sequence[str], count: str,
                rows: int, how: str = "inner") -> DataFrame:
    """Join many rows to a table with one row per key, of which some keys are hot.

    ``right[count]`` is the number of left rows of the key and ``rows`` that of
    all left rows.  Keys with more than ``HOT_SHARE`` of them number at most
    ``1 / HOT_SHARE``, so their rows of the right side are broadcast and their
    left rows stay where they are; all other keys take the ordinary join.
    """
    limit = max(1000, int(rows * HOT_SHARE))
    keys = list(keys)
    hot = F.broadcast(right.where(F.col(count) > limit))
    met = left.join(hot, keys, "inner")
    rest = left.join(hot.select(*keys), keys, "left_anti")
    cold = right.where(F.col(count) <= limit)
    return met.unionByName(rest.join(cold, keys, how))
