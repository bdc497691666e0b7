"""End to end: CSV -> topic -> staging -> warehouse -> reports equal the published results;
topic -> summary changelog -> summary table equals the direct summary stream."""

import os

import pytest

from stationdw.plans import jobs
from stationdw.session import scratch_dir
from stationdw.sources.sinks import write_messages
from tests.climate_fixture import CITIES, city_rows
from tests.conftest import DATA
from tests.test_golden import (PETERSBURG, PITTSBURGH, SAN_FRANCISCO, SEATTLE, assert_rows,
                               golden)


@pytest.fixture(scope="module")
def topic(spark):
    folder = scratch_dir(spark, "topic")
    sent = jobs.publish_daily_csv(spark, os.path.join(DATA, "NORMAL_DLY_sample_csv.csv"),
                                  folder)
    assert sent == 365
    for name, station, lat in CITIES:
        write_messages(city_rows(spark, name, station, lat), folder)
    return folder


def test_topic_to_reports(spark, topic):
    staging, quarantine = scratch_dir(spark, "staging"), scratch_dir(spark, "quarantine")
    q = jobs.consume_to_staging(spark, "files", {"path": topic, "maxFilesPerTrigger": 2},
                                staging, quarantine, scratch_dir(spark, "ck"))
    q.awaitTermination()
    assert q.exception() is None
    assert jobs.read_staging(spark, staging).count() == 1460
    warehouse = scratch_dir(spark, "dw")
    first = {r.stage: r.row_count for r in jobs.load_warehouse(spark, staging, warehouse)
             .collect()}
    second = {r.stage: r.row_count for r in jobs.load_warehouse(spark, staging, warehouse)
              .collect()}
    assert first == second and first["fact_upserted"] == 1460 and first["dim_station"] == 4
    assert jobs.read_star(spark, warehouse)["fact"].count() == 1460
    out = jobs.reports(jobs.read_star(spark, warehouse),
                       (SEATTLE, PETERSBURG, "seattle", "petersburg"),
                       [SAN_FRANCISCO, PITTSBURGH],
                       (SEATTLE, SAN_FRANCISCO, "seattle", "san_francisco"))
    for i in range(1, 6):
        assert_rows(out[f"query{i}"].collect(), golden(f"query{i}.csv"))


def test_changelog_loader_equals_direct_summary(spark, topic):
    changelog = scratch_dir(spark, "changelog")
    q1 = jobs.summary_changelog(spark, "files", {"path": topic, "maxFilesPerTrigger": 3},
                                changelog, scratch_dir(spark, "ck1"))
    q1.processAllAvailable()
    q1.stop()
    loaded = scratch_dir(spark, "summary-loaded")
    q2 = jobs.load_summary_changelog(spark, changelog, loaded, scratch_dir(spark, "ck2"))
    q2.awaitTermination()
    direct = scratch_dir(spark, "summary-direct")
    q3 = jobs.monthly_summary_table(spark, "files", {"path": topic}, direct,
                                    scratch_dir(spark, "ck3"))
    q3.awaitTermination()
    a = jobs.read_summary(spark, loaded)
    b = jobs.read_summary(spark, direct)
    assert a.count() == 48
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    jan = b.where(f"station_id = '{PETERSBURG}' AND norm_month = '201001'").first()
    assert jan.num_days == 31 and float(jan.month_end_prcp_normal) == 55.0


def test_publish_counts_what_it_sent(spark):
    topic, path = scratch_dir(spark, "topic"), os.path.join(DATA, "NORMAL_DLY_sample_csv.csv")
    assert [jobs.publish_daily_csv(spark, path, topic) for _ in range(2)] == [365, 365]
