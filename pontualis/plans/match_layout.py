"""Both sides of the match stored by trip and time cell, so that they join without a shuffle.

Trips and windows that are matched again and again, with other tolerances or against new
timetables, are written once as tables bucketed and sorted by the keys of the join.  Equal
keys then lie in buckets of equal number, and a match reads bucket by bucket.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pontualis.config import AnalysisConfig
from pontualis.operators import matching, observed, timetable
from pontualis.sources.tables import TransitTables

BUCKETS = 64
# A bucket is sorted and matched by one task.  It holds the cells of about this many rows of
# timetable frequencies and realised trips.
BUCKET_ROWS = 65536


def buckets_for(tables: TransitTables, least: int) -> int:
    """Buckets that grow with the tables, so that what one task sorts does not."""
    rows = tables.frequencies.count() + tables.realised.count()
    return max(least, -(-rows // BUCKET_ROWS))


def _write(frame: DataFrame, table: str, path: str, buckets: int) -> None:
    (frame.repartition(buckets, *matching.CELL_KEYS).write.mode("overwrite")
     .bucketBy(buckets, *matching.CELL_KEYS).sortBy(*matching.CELL_KEYS)
     .option("path", path).saveAsTable(table))


def write_layout(tables: TransitTables, cfg: AnalysisConfig, name: str, root: str,
                 buckets: int = BUCKETS) -> None:
    """Write the tables ``<name>_trips`` and ``<name>_windows`` below ``root``.

    About one bucket per task that will match; a busy trip is spread by its time cells.
    """
    trips = matching.trips_in_cells(observed.observed_departures(tables, cfg), cfg)
    windows = matching.window_cells(timetable.numbered_windows(tables, cfg), cfg)
    for frame, side in ((trips, "trips"), (windows, "windows")):
        _write(frame, f"{name}_{side}", f"{root.rstrip('/')}/{name}_{side}", buckets)


def match_stored(spark: SparkSession, name: str, cfg: AnalysisConfig) -> DataFrame:
    """``match_windows`` of the stored sides."""
    trips, windows = spark.table(f"{name}_trips"), spark.table(f"{name}_windows")
    return matching.matched_columns(matching.pairs_in_cells(trips, windows, cfg))
