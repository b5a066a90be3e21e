"""The match on disk by day: the cut between matching and ranking.

Ranking queries read the match several times.  Written once to a shared folder, it is
read back with column pruning, survives lost executors and keeps the plans short.  A day is the
date of the realised departure.  Its version is a digest of all the match of that day rests on:
the realised trips of the service days that depart then, and the timetable windows within
reach of their bands.  Digests are counts and sums of row hashes, so one scan with
partial aggregates finds the days that have changed, and no file is listed.  The windows, one
row each, are written once per refresh: their digests and the match both read them.  Where
all days are matched anyway, as in a first run, the trips are digested while the match runs.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta
from functools import cached_property

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from pontualis import schemas
from pontualis.config import AnalysisConfig
from pontualis.functions import clock
from pontualis.operators import matching, observed, timetable
from pontualis.sources.day_store import DAY, DayStore
from pontualis.sources.tables import TransitTables


def matched_trips(tables: TransitTables, cfg: AnalysisConfig) -> DataFrame:
    """Realised trips with the planned departures they are associated with."""
    return matching.match_windows(timetable.numbered_windows(tables, cfg),
                                  observed.observed_departures(tables, cfg), cfg)


def _digest(*columns: Column) -> list[Column]:
    """Number of rows and sum of their hashes; equal rows count as often as they occur."""
    return [F.count(F.lit(1)).alias("linhas"),
            F.sum(F.xxhash64(*columns).cast("decimal(20,0)")).cast("string").alias("soma")]


def _dates(windows: DataFrame) -> tuple[Column, Column]:
    """Dates of the first and last departure of a numbered window."""
    start, headway, first = F.col("datetime_partida"), F.col("headway"), F.col("primeira")
    last = first + F.col("partidas") - 1
    return ((start + clock.plus_minutes(headway * first)).cast("date"),
            (start + clock.plus_minutes(headway * last)).cast("date"))


def _written(frame: DataFrame, path: str) -> DataFrame:
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


class DayVersions:
    """Versions of all days of a period, and which service days make up a day.

    The numbered windows of the period are kept at ``windows_path``, replaced each time.
    Trips and windows are digested by jobs started in ``beside``; what needs a result waits for it.
    Trips without a departure time match nothing, but are counted: they are part of the
    versions of the days that their service day departs on.
    """

    def __init__(self, tables: TransitTables, cfg: AnalysisConfig, windows_path: str,
                 beside: ThreadPoolExecutor) -> None:
        trips = observed.observed_columns(observed.realised_in_feeds(tables, cfg))
        departure = F.col("datetime_partida")
        band = clock.plus_minutes(clock.half_away(F.col("tempo_viagem") * F.lit(cfg.association_factor)))
        by_day = (trips.groupBy("data", departure.cast("date").alias(DAY))
                  .agg(*_digest(*[F.col(c) for c in trips.columns]),
                       F.min((departure - band).cast("date")).alias("primeiro"),
                       F.max((departure + band).cast("date")).alias("ultimo")))
        collect = inheritable_thread_target(trips.sparkSession)(DataFrame.collect)
        self._scan = beside.submit(collect, by_day)
        self._windows = _written(timetable.numbered_windows(tables, cfg), windows_path)
        windows = self._windows.where("tempo_viagem > 0")
        first, last = _dates(windows)
        used = ["consorcio", "trip_id", "sentido", "trip_short_name", "tempo_viagem", "headway",
                "datetime_partida", "primeira", "partidas"]
        planned = (windows.withColumn(DAY, F.explode(F.sequence(first, last)))
                   .groupBy(DAY).agg(*_digest(*[F.col(c) for c in used])))
        self._planned = beside.submit(collect, planned)

    @cached_property
    def _scanned(self) -> list[Row]:
        """One row per service day and day of departure."""
        return sorted(self._scan.result(), key=lambda r: (r["data"], r[DAY] or date.min))

    @cached_property
    def service_days(self) -> dict[date, list[date]]:
        found = defaultdict(list)
        for r in self._scanned:
            if r[DAY]:
                found[r[DAY]].append(r["data"])
        return dict(found)

    @cached_property
    def reach(self) -> dict[date, tuple[date, date]]:
        """First and last day that the bands of the trips of a day touch."""
        found: dict[date, tuple[date, date]] = {}
        for r in self._scanned:
            if r[DAY]:
                low, high = found.get(r[DAY], (r.primeiro, r.ultimo))
                found[r[DAY]] = min(low, r.primeiro), max(high, r.ultimo)
        return found

    @cached_property
    def versions(self) -> dict[date, str]:
        planned = {r[DAY]: (r.linhas, r.soma) for r in self._planned.result()}
        by_service = defaultdict(list)
        for r in self._scanned:
            by_service[r["data"]].append((r["data"], r[DAY], r.linhas, r.soma))
        return {d: self._version(d, by_service, planned) for d in self.service_days}

    def _version(self, day: date, by_service: dict, planned: dict) -> str:
        low, high = self.reach[day]
        around = [low + timedelta(k) for k in range((high - low).days + 1)]
        trips = [r for s in self.service_days[day] for r in by_service[s]]
        text = repr((trips, [(d, planned.get(d)) for d in around]))
        return hashlib.sha256(text.encode()).hexdigest()

    def match(self, tables: TransitTables, cfg: AnalysisConfig,
              days: list[date] | None = None) -> DataFrame:
        """The match of all days, or of some from their trips and the windows within reach alone."""
        windows, services = self._windows, None
        if days is not None:
            services = sorted({s for d in days for s in self.service_days[d]})
            first, last = _dates(windows)
            windows = windows.where((last >= F.lit(min(self.reach[d][0] for d in days)))
                                    & (first <= F.lit(max(self.reach[d][1] for d in days))))
        trips = observed.observed_departures(tables, cfg, services)
        if days is not None:
            trips = trips.where(F.col("datetime_partida").cast("date").isin(days))
        found = matching.match_windows(windows, trips, cfg)
        return found.withColumn(DAY, F.col("datetime_partida_VR").cast("date"))


def match_store(tables: TransitTables, cfg: AnalysisConfig, cache_path: str) -> DayStore:
    """The store of one set of parameters; another month or tolerance has another folder."""
    parameters = (cfg.start_date, cfg.end_date, cfg.feed_floor, tuple(cfg.agencies),
                  cfg.association_factor, cfg.counter_tolerance)
    name = hashlib.sha256(repr(parameters).encode()).hexdigest()[:24]
    return DayStore(tables.realised.sparkSession, f"{cache_path.rstrip('/')}/{name}", schemas.MATCHED)


def refresh_match(store: DayStore, tables: TransitTables, cfg: AnalysisConfig,
                  force: bool = False) -> list[date]:
    """Recompute the days that have changed, or all; returns them."""
    with ThreadPoolExecutor(2) as beside:
        days = DayVersions(tables, cfg, f"{store.root}/windows", beside)
        if force or not store.manifest():
            return store.fill(days.match(tables, cfg), lambda: days.versions)
        return store.refresh(days.versions, lambda changed: days.match(tables, cfg, changed))
