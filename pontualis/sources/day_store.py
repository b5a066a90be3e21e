"""A table on disk in one folder per day, of which a changed day is rewritten alone.

Beside the table lies a manifest with one row per day: the version of the inputs the
day was computed from, and its number of rows.  ``refresh`` compares the versions,
recomputes the days that differ in one job and replaces just their folders (dynamic
partition overwrite); the manifest follows when the table is written, so a write that broke off is
done again.  Only days of the manifest are read, so folders of days that are gone do no harm.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pontualis.schemas import DAY_MANIFEST

DAY = "dia"


def exists(spark: SparkSession, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()).exists(found)


class DayStore:
    def __init__(self, spark: SparkSession, root: str, schema: StructType) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.table, self.notes = f"{self.root}/days", f"{self.root}/manifest"
        self.schema = schema

    def manifest(self) -> dict[date, tuple[str, int]]:
        """Version and rows of every stored day."""
        if not exists(self.spark, self.notes):
            return {}
        rows = self.spark.read.schema(DAY_MANIFEST).parquet(self.notes).collect()
        return {r[DAY]: (r.versao, r.linhas) for r in rows if r.versao}

    def refresh(self, versions: Mapping[date, str], compute: Callable[[list[date]], DataFrame],
                force: bool = False) -> list[date]:
        """Bring the table to ``versions``; returns the days that were rewritten.

        ``compute`` gets the changed days and returns their rows with the column ``dia``.
        """
        stored = self.manifest()
        changed = sorted(d for d, v in versions.items() if force or stored.get(d, ("", 0))[0] != v)
        if changed:
            self._replace(compute(changed).select(*self.schema.names, DAY), self.table)
        self._note(versions, changed, stored)
        return changed

    def fill(self, frame: DataFrame, versions: Callable[[], Mapping[date, str]]) -> list[date]:
        """Write all days of ``frame``, which has the column ``dia``, anew; returns them.

        ``versions`` is asked once the rows are written, so it may be made meanwhile from the same inputs.
        """
        stored = self.manifest()
        self._replace(frame.select(*self.schema.names, DAY), self.table)
        made = versions()
        self._note(made, sorted(made), stored)
        return sorted(made)

    def _note(self, versions: Mapping[date, str], changed: list[date], stored: Mapping) -> None:
        """Enter the written days, and those that are gone, into the manifest."""
        rows, gone = {}, [d for d in stored if d not in versions]
        if changed and exists(self.spark, self.table):
            written = self._stored().where(F.col(DAY).isin(changed)).groupBy(DAY).count()
            rows = {r[DAY]: r["count"] for r in written.collect()}
        if changed or gone:
            notes = [(versions[d], rows.get(d, 0), d) for d in changed] + [("", 0, d) for d in gone]
            self._replace(self.spark.createDataFrame(notes, DAY_MANIFEST), self.notes)

    @staticmethod
    def _replace(frame: DataFrame, path: str) -> None:
        (frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(DAY).parquet(path))

    def _stored(self) -> DataFrame:
        return self.spark.read.schema(StructType([*self.schema]).add(DAY, "date")).parquet(self.table)

    def read(self, days: Iterable[date] | None = None) -> DataFrame:
        """Rows of the stored days, or of some of them; other folders are not listed as input."""
        wanted = None if days is None else set(days)
        full = sorted(d for d, (_, n) in self.manifest().items() if n and (wanted is None or d in wanted))
        if not full:
            return self.spark.createDataFrame([], StructType([*self.schema]).add(DAY, "date"))
        return self._stored().where(F.col(DAY).isin(full))
