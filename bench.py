"""Timings of the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the folder of the input tables and ``BENCH_CPUS`` the
number of local cores.  Every query runs once unmeasured (JVM warm-up) and is
then timed once, plan building included, into a sink that keeps nothing.
``match_and_final_ranking`` recomputes the match from the source tables, writes
it and ranks all services.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pontualis.plans.registry import QUERIES, analysis  # noqa: E402
from pontualis.session import build_session  # noqa: E402

# Queries over the source tables, and rankings over the written match.
NAMES = ("expand_departures", "planned_sequence", "realised_sequence", "join_band_match",
         "join_band_match_departures", "join_band_match_plain", "final_ranking",
         "service_ranking", "rush_hours", "best_service_per_hour", "best_trip_per_quarter",
         "filter_service_lookup", "audit_join_containment", "audit_duplicates")


def run(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("pontualis-bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")

    def match_and_rank():
        run(analysis(spark, folder, "regularity", force=True).final_ranking())

    jobs = {name: (lambda query=QUERIES[name]: run(query(spark, folder))) for name in NAMES}
    jobs["match_and_final_ranking"] = match_and_rank
    seconds = {}
    for name, job in jobs.items():
        job()
        start = time.perf_counter()
        job()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({"metric": "match_and_final_ranking", "unit": "sec",
                      "value": seconds["match_and_final_ranking"], "queries": seconds,
                      "sf": os.path.basename(folder).removeprefix("sf"), "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
