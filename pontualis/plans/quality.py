"""The analysis as one object: match once, then ask for rankings."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pontualis.config import AnalysisConfig
from pontualis.operators import rankings, regularity, rush, scoring
from pontualis.plans.stored_match import match_store, matched_trips, refresh_match
from pontualis.schemas import BAND_TOTALS, MATCHED
from pontualis.sources.day_store import DAY, DayStore
from pontualis.sources.ranking_csv import write_ranking_csv
from pontualis.sources.ranking_store import RankingStore
from pontualis.sources.tables import TransitTables


class QualityAnalysis:
    """Service-quality analysis of one period.

    ``mode`` selects the score of a trip: ``trip`` (error factor and min-max
    per trip) or ``regularity`` (neither; input of ``final_ranking``).  With a
    ``cache_path`` the matched table is written there by day and reused by later analyses:
    ``run`` recomputes the days of which the inputs have changed.  Without one it stays a
    lazy plan.
    """

    def __init__(self, tables: TransitTables, cfg: AnalysisConfig | None = None,
                 mode: str = "trip", cache_path: str | None = None) -> None:
        if mode not in scoring.MODES:
            raise ValueError(f"mode must be one of {scoring.MODES}, not {mode!r}")
        self.tables = tables
        self.cfg = cfg or AnalysisConfig()
        self.mode = mode
        self.cache_path = cache_path
        self.rewritten: list[date] = []
        self._matched: DataFrame | None = None

    def run(self, force: bool = False, refresh: bool = True) -> "QualityAnalysis":
        """Match planned and realised trips.

        ``force`` recomputes all days; without ``refresh`` the stored match is taken as it is.
        """
        if self.cache_path is None:
            self._matched = matched_trips(self.tables, self.cfg)
        else:
            store = self.match_store
            if force or refresh or not store.manifest():
                self.rewritten = refresh_match(store, self.tables, self.cfg, force)
            self._matched = store.read().select(*MATCHED.names)
        self.__dict__.pop("scored", None)
        return self

    @cached_property
    def match_store(self) -> DayStore:
        """The written match below ``cache_path``, one folder a day."""
        if self.cache_path is None:
            raise ValueError("an analysis without a cache_path stores nothing")
        return match_store(self.tables, self.cfg, self.cache_path)

    @property
    def matched(self) -> DataFrame:
        if self._matched is None:
            self.run()
        return self._matched

    @cached_property
    def scored(self) -> DataFrame:
        """One row per match: servico, score, data_partida."""
        return scoring.score_matches(self.matched, self.cfg, self.mode)

    # --- hours ---------------------------------------------------------------

    def hourly_trip_counts(self) -> DataFrame:
        return rush.hourly_trip_counts(self.scored)

    def rush_hours(self, cut: float | None = None, deviation: float | None = None) -> DataFrame:
        return rush.rush_hours(self.scored,
                               self.cfg.rush_cut if cut is None else cut,
                               self.cfg.rush_deviation if deviation is None else deviation)

    # --- services --------------------------------------------------------------

    def service_ranking(self) -> DataFrame:
        return rankings.service_ranking(self.scored, self.cfg.rank_digits)

    def top10(self) -> DataFrame:
        return rankings.ranking_top(self.service_ranking())

    def bottom10(self) -> DataFrame:
        return rankings.ranking_bottom(self.service_ranking())

    def _scored_by(self) -> str:
        """Digest of the stored match and of all parameters behind a score."""
        cfg = self.cfg
        parameters = (self.mode, cfg.weight_travel, cfg.weight_reliability, cfg.rank_digits)
        text = repr((parameters, sorted(self.match_store.manifest().items())))
        return hashlib.sha256(text.encode()).hexdigest()[:24]

    @cached_property
    def stored_ranking(self) -> RankingStore:
        """The service ranking on disk, written when the match or a weight has changed."""
        store = RankingStore(self.tables.realised.sparkSession,
                             f"{self.cache_path.rstrip('/')}/ranking-{self._scored_by()}")
        store.write_once(self.service_ranking)
        return store

    def service_scores(self, requested: DataFrame) -> DataFrame:
        """Indicator of each service in column ``servico``; -1 when it is not ranked.

        With a ``cache_path`` a stored ranking answers, and the match is not read.
        """
        if self.cache_path is None:
            return rankings.service_scores(self.service_ranking(), requested)
        return self.stored_ranking.scores(requested)

    def service_score(self, servico: str) -> float:
        """Indicator of one service; -1 when it is not ranked."""
        if self.cache_path is not None:
            return self.stored_ranking.score(str(servico))
        spark = self.tables.realised.sparkSession
        requested = spark.range(1).select(F.lit(str(servico)).alias("servico"))
        return self.service_scores(requested).first()["indicador"]

    # --- services by hour and band -----------------------------------------------

    def best_service_per_hour(self) -> DataFrame:
        return rankings.service_per_hour(self.scored, self.cfg.rank_digits, best=True)

    def worst_service_per_hour(self) -> DataFrame:
        return rankings.service_per_hour(self.scored, self.cfg.rank_digits, best=False)

    def best_service_rush_hour(self) -> DataFrame:
        return rankings.service_rush_hour(self.best_service_per_hour(), self.rush_hours())

    def worst_service_rush_hour(self) -> DataFrame:
        return rankings.service_rush_hour(self.worst_service_per_hour(), self.rush_hours())

    def best_trip_per_quarter(self) -> DataFrame:
        return rankings.trip_per_quarter(self.scored, best=True)

    def worst_trip_per_quarter(self) -> DataFrame:
        return rankings.trip_per_quarter(self.scored, best=False)

    # --- regularity --------------------------------------------------------------

    def _regularity(self, bucket: str, worst_first: bool) -> DataFrame:
        scores = regularity.bucket_regularity(self.scored, bucket)
        return (regularity.least_regular if worst_first else regularity.most_regular)(scores)

    def hour_regularity(self, worst_first: bool = False) -> DataFrame:
        return self._regularity(regularity.HOUR, worst_first)

    def quarter_regularity(self, worst_first: bool = False) -> DataFrame:
        return self._regularity(regularity.QUARTER, worst_first)

    def final_ranking(self) -> DataFrame:
        return regularity.final_ranking(self.scored, self.cfg.rank_digits)

    @cached_property
    def stored_totals(self) -> DayStore:
        """Totals per day, band and service on disk; only days of which the match changed are new."""
        if self.mode != "regularity":
            raise ValueError("scores that are normalised over a month have no totals by day")
        cfg, match = self.cfg, self.match_store
        if not match.manifest():
            self.run()
        weights = repr((cfg.weight_travel, cfg.weight_reliability)).encode()
        name = hashlib.sha256(weights).hexdigest()[:24]
        store = DayStore(match.spark, f"{match.root}/totals-{name}", BAND_TOTALS)

        def totals(days: list[date]) -> DataFrame:
            scored = scoring.score_matches(match.read(days), cfg, self.mode)
            return regularity.band_totals(
                scored.withColumn(DAY, F.col("data_partida").cast("date")), DAY)

        store.refresh({d: v for d, (v, _) in match.manifest().items()}, totals)
        return store

    def final_ranking_of(self, days: Iterable[date] | None = None) -> DataFrame:
        """The final ranking of some days, or of all, from stored totals alone."""
        return regularity.final_ranking_of(self.stored_totals.read(days), self.cfg.rank_digits)

    def write_final_ranking(self, path: str) -> None:
        write_ranking_csv(self.final_ranking(), path)
