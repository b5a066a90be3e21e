"""The seven source tables and how to read them from Parquet."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession

from pontualis import schemas

TABLE_SCHEMAS = {
    "trips": schemas.TRIPS,
    "frequencies": schemas.FREQUENCIES,
    "routes": schemas.ROUTES,
    "agency": schemas.AGENCY,
    "feed_info": schemas.FEED_INFO,
    "calendar": schemas.CALENDAR,
    "realised": schemas.REALISED,
}


@dataclass(frozen=True)
class TransitTables:
    """Lazy handles of the sources; reading happens when a query runs."""

    trips: DataFrame
    frequencies: DataFrame
    routes: DataFrame
    agency: DataFrame
    feed_info: DataFrame
    calendar: DataFrame
    realised: DataFrame


def read_tables(spark: SparkSession, root: str) -> TransitTables:
    """Read ``<root>/<table>`` for every table, with its explicit schema.

    GTFS tables are best written partitioned by ``feed_start_date`` and the
    realised trips by ``data``: the filters of the scans then prune folders.
    """
    root = root.rstrip("/")
    return TransitTables(**{
        f.name: spark.read.schema(TABLE_SCHEMAS[f.name]).parquet(f"{root}/{f.name}")
        for f in fields(TransitTables)
    })


def write_tables(tables: TransitTables, root: str) -> None:
    """Write the tables in the partitioned layout ``read_tables`` profits from."""
    root = root.rstrip("/")
    for f in fields(TransitTables):
        frame = getattr(tables, f.name)
        partition = "data" if f.name in ("realised", "calendar") else "feed_start_date"
        # A range on the partition column plus the other keys splits a heavy
        # day or feed over several files instead of one task.
        keys = [partition] + [c for c in ("trip_id", "datetime_partida", "route_id")
                              if c in frame.columns]
        (frame.repartitionByRange(*keys).write.mode("overwrite")
              .partitionBy(partition).parquet(f"{root}/{f.name}"))
