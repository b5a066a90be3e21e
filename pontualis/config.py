"""One frozen object holds every parameter of an analysis run."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

# The four bus consortia whose services are analysed.
CONSORTIA = ("Internorte", "Intersul", "Santa Cruz", "Transcarioca")

# Service ids inspected by the exploratory trips query.
EXPLORED_SERVICE_IDS = ("D", "D_REG", "EXCEP", "S_REG", "U_REG")


@dataclass(frozen=True)
class AnalysisConfig:
    """Parameters of one analysis month.

    ``start_date`` and ``end_date`` are inclusive.  ``feed_floor`` is compared
    with ``feed_version`` as text.  ``association_factor`` is the share of the
    realised duration allowed on each side of a realised departure, and
    ``counter_tolerance`` the largest difference between the two departure
    counters of a match.
    """

    start_date: date = date(2024, 12, 1)
    end_date: date = date(2024, 12, 31)
    feed_floor: str = "2024-11-06"
    explore_floor: str = "2024-01-01"
    agencies: tuple[str, ...] = CONSORTIA
    explored_service_ids: tuple[str, ...] = EXPLORED_SERVICE_IDS
    association_factor: float = 0.25
    counter_tolerance: int = 5
    weight_travel: float = 2 / 14
    weight_reliability: float = 8 / 14
    rush_cut: float = 0.75
    rush_deviation: float = 0.5
    # Width of the time cells of the band match and of the numbering windows.
    match_cell_minutes: int = 60
    numbering_cell_minutes: int = 60
    # Means are rounded to this many digits before they are ordered, so that
    # the order does not depend on the order in which doubles were summed.
    rank_digits: int = 10

    def __post_init__(self) -> None:
        for name in ("start_date", "end_date"):
            value = getattr(self, name)
            if isinstance(value, datetime):
                object.__setattr__(self, name, value.date())
            elif not isinstance(value, date):
                raise TypeError(f"{name} must be a date, not {type(value).__name__}")
        if self.end_date < self.start_date:
            raise ValueError("end_date lies before start_date")
        if self.association_factor < 0 or self.counter_tolerance < 0:
            raise ValueError("tolerances must not be negative")
        if self.match_cell_minutes < 1 or self.numbering_cell_minutes < 1:
            raise ValueError("cell widths must be at least one minute")
