"""Shape of the physical plans on partitioned tables: what must and must not appear."""

import re
import time
from dataclasses import replace
from datetime import date

import pytest
from conftest import SMALL

from pontualis.config import AnalysisConfig
from pontualis.operators import matching, observed, rankings, scans, timetable
from pontualis.plans.quality import QualityAnalysis, matched_trips
from pontualis.sources.matched import read_matched_csv, write_matched_csv
from pontualis.session import shared_folder
from pontualis.sources.ranking_csv import read_ranking_csv, write_ranking_csv
from pontualis.sources.star_tables import STAR_CONFIG, star_tables
from pontualis.sources.tables import read_tables, write_tables
from test_rankings import check_ranking

CFG = STAR_CONFIG


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    star = star_tables(spark, SMALL)
    write_tables(star, path)
    return path


@pytest.fixture(scope="module")
def stored(spark, root):
    return read_tables(spark, root)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_stored_tables_give_the_same_match(spark, stored):
    direct = matched_trips(star_tables(spark, SMALL), CFG)
    again = matched_trips(stored, CFG)
    assert direct.exceptAll(again).count() == 0 and again.count() == direct.count() == 345


def test_realised_scan_prunes_folders_and_pushes_filters(stored):
    text = plan(scans.scan_realised(stored, replace(CFG, end_date=date(2024, 1, 3)))
                .select("id_viagem"))
    assert re.search(r"PartitionFilters: \[.*data.*2024-01-03", text)
    assert re.search(r"PushedFilters: \[.*GreaterThan\(tempo_viagem,0\)", text)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"id_viagem", "tempo_viagem"}


def test_timetable_scans_push_the_floor_and_prune_by_active_feeds(stored):
    text = plan(timetable.timetable_windows(stored, CFG))
    assert text.count("GreaterThanOrEqual(feed_version,2024-01-01)") >= 4
    assert "dynamicpruning" in text
    assert "trip_headsign" in text and "exact_times" not in text


def test_no_nested_loop_or_cartesian_join(spark, stored):
    big = 1024 * 1024
    for limit in (10 * big, -1):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            text = plan(matched_trips(stored, CFG))
            assert "NestedLoop" not in text and "Cartesian" not in text
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 10 * big)


def test_match_is_the_same_without_broadcasts_and_for_any_partition_count(spark, stored):
    expected = sorted(map(tuple, matched_trips(stored, CFG).collect()))
    for key, value, default in (("spark.sql.autoBroadcastJoinThreshold", "-1", "10485760"),
                                ("spark.sql.shuffle.partitions", "1", "8"),
                                ("spark.sql.shuffle.partitions", "64", "8"),
                                ("spark.sql.adaptive.enabled", "false", "true"),
                                ("spark.sql.session.timeZone", "America/Sao_Paulo", "UTC")):
        spark.conf.set(key, value)
        try:
            assert sorted(map(tuple, matched_trips(stored, CFG).collect())) == expected, key
        finally:
            spark.conf.set(key, default)


def test_windows_always_have_a_partition(stored):
    """No window over trips or departures may gather all rows in one task."""
    frames = (matched_trips(stored, CFG), observed.observed_departures_by_service(stored, CFG),
              timetable.planned_departures_by_trip(stored, CFG))
    for frame in frames:
        text = plan(frame)
        lines = text.splitlines()
        # Only the counted feeds meet in one task, as the one row of their index.
        above = [a for a, line in zip(lines, lines[1:]) if "Exchange SinglePartition" in line]
        assert all("keys=[], functions=[collect_list(struct(first" in a for a in above)
        for window in re.findall(r"Window \[.*", text):
            assert not window.rstrip().endswith("], []")


def test_windows_are_not_expanded_before_the_match(stored):
    expansion = "explode(sequence(primeira"
    assert expansion in plan(timetable.planned_departures(stored, CFG))
    text = plan(matching.match_windows(timetable.numbered_windows(stored, CFG),
                                       observed.observed_departures(stored, CFG), CFG))
    assert expansion not in text
    assert "Python" not in text


def test_best_trips_combine_before_the_shuffle(stored):
    """The reduction of single trips is a hash aggregate with a partial step."""
    text = plan(rankings.trip_per_quarter(QualityAnalysis(stored, CFG).run().scored))
    assert re.search(r"HashAggregate\(keys=\[_band.*servico.*partial_min\(data_partida", text)


def test_no_shuffle_on_a_key_of_few_values(spark, stored):
    """Without broadcasts, joins with feeds, calendar and agencies carry a salt."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        trips, feeds = scans.scan_realised(stored, CFG), stored.feed_info
        by_month = observed.join_feed_range(
            trips, feeds.select("feed_version", "feed_start_date", "feed_end_date"),
            ["id_viagem"], index_rows=0)
        for frame, keys in ((by_month, "_month"),
                            (timetable.timetable_windows(stored, CFG), "service_id"),
                            (scans.join_left_agency(stored, CFG), "agency_id")):
            found = [k for k in re.findall(r"hashpartitioning\(([^)]*)\)", plan(frame))
                     if keys in k and "trip_headsign" not in k and "route_short" not in k]
            joins = [k for k in found if k.count(",") <= 5]
            assert any("_salt" in k for k in joins)
            assert not [k for k in joins if re.match(rf"{keys}#\d+, \d+$", k)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_csv_keeps_blanks_empty_text_and_null_apart(spark, tmp_path):
    names = [" 006 ", "", None, 'a;"b"', "x\ny", "plain"]
    rows = spark.createDataFrame([(i, n, 0.5) for i, n in enumerate(names)],
                                 "posicao bigint, servico string, score double")
    write_ranking_csv(rows, str(tmp_path / "r"))
    got = read_ranking_csv(spark, str(tmp_path / "r")).orderBy("posicao").collect()
    assert [r.servico for r in got] == names


def test_shared_folder_needs_the_setting_on_a_cluster(spark):
    class Session:
        class conf:  # noqa: N801
            value = None

            @classmethod
            def get(cls, key, default):
                return cls.value

        class sparkContext:  # noqa: N801
            master, applicationId = "spark://host:7077", "app-1"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session)
    Session.sparkContext.master = "local[2]"
    assert shared_folder(Session) == shared_folder(Session)
    Session.conf.value = "hdfs://shared/"
    assert shared_folder(Session) == "hdfs://shared"


def test_csv_forms(spark, stored, tmp_path):
    analysis = QualityAnalysis(stored, CFG, "regularity", str(tmp_path / "m")).run()
    write_matched_csv(analysis.matched, str(tmp_path / "csv"))
    again = read_matched_csv(spark, str(tmp_path / "csv"))
    assert again.schema == analysis.matched.schema
    assert again.exceptAll(analysis.matched).count() == 0 and again.count() == 345
    analysis.write_final_ranking(str(tmp_path / "ranking"))
    files = list((tmp_path / "ranking").glob("*.csv"))
    assert len(files) == 1
    assert files[0].read_text(encoding="utf-8").splitlines()[0] == "posicao;servico;score"
    rows = read_ranking_csv(spark, str(tmp_path / "ranking")).orderBy("posicao").collect()
    assert rows == analysis.final_ranking().orderBy("posicao").collect()
    check_ranking(rows)


def test_analysis_object(spark, stored, tmp_path):
    analysis = QualityAnalysis(stored, CFG, cache_path=str(tmp_path / "m")).run()
    ranking = analysis.service_ranking().orderBy("posicao").collect()
    assert analysis.top10().collect() == ranking[:10]
    assert analysis.bottom10().collect() == ranking[::-1][:10]
    assert analysis.service_score(f" {ranking[0].servico} ") == ranking[0].indicador
    assert analysis.service_score("none") == -1
    rush = {r.hora for r in analysis.rush_hours().collect()}
    assert {r.hora for r in analysis.best_service_rush_hour().collect()} == rush
    assert {r.hora for r in analysis.worst_service_rush_hour().collect()} == rush
    with pytest.raises(ValueError):
        QualityAnalysis(stored, CFG, mode="other")


def test_config_checks():
    with pytest.raises(TypeError):
        AnalysisConfig(start_date="2024-12-01")
    with pytest.raises(ValueError):
        AnalysisConfig(start_date=date(2024, 12, 2), end_date=date(2024, 12, 1))


def test_the_flagship_match_plans_within_seconds(spark):
    """Planning once grew exponentially with the columns that a salt was drawn from."""
    matched_trips(star_tables(spark, SMALL), STAR_CONFIG).explain()  # classes loaded
    start = time.perf_counter()
    frame = matched_trips(star_tables(spark, SMALL), STAR_CONFIG)
    frame._jdf.queryExecution().executedPlan()
    assert time.perf_counter() - start < 5


def test_feeds_are_looked_up_without_a_join_or_shuffle(stored):
    text = plan(observed.realised_in_feeds(stored, CFG))
    assert "Join" not in text and text.count("Exchange") <= 1  # the one row of the index
