"""Loads that end between any two of their writes, and what the next load makes of them."""

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from stationdw.operators.checks import ConstraintViolation, require_unique
from stationdw.plans import commit, jobs
from stationdw.schemas import STAGING
from stationdw.session import scratch_dir
from stationdw.sources.tables import materialize


class Ended(Exception):
    pass


def staging(spark, stations, days, value):
    rows = [(s, f"name {s}", None, None, None, d, value, value + 10, None) for s in stations
            for d in days]
    types = {f.name: f.dataType for f in STAGING.fields}
    names = jobs.STAGING_COLUMNS
    frame = spark.createDataFrame(
        rows, "station_id string, station_name string, elevation int, latitude int, longitude int, "
              "norm_date date, dly_tmin_normal int, dly_tmax_normal int, mtd_prcp_normal int")
    table = scratch_dir(spark, "staging")
    (frame.select(*[F.col(c).cast(types[c]) for c in names])
     .withColumn("created_at", F.current_timestamp())
     .withColumn("norm_month", F.date_format("norm_date", "yyyyMM"))
     .write.partitionBy("norm_month").parquet(table))
    return table


def facts(spark, warehouse):
    star = jobs.read_star(spark, warehouse)
    return sorted((r["station_id"], r["date_key"], int(r["dly_tmin_normal"]))
                  for r in star["fact"].join(star["dim_station"], "station_key")
                  .join(star["dim_date"], "date_key").collect())


JANUARY = [datetime.date(2010, 1, d) for d in (1, 2)]
FEBRUARY = [datetime.date(2010, 2, 1)]


def files(spark, warehouse):
    path = spark._jvm.org.apache.hadoop.fs.Path(warehouse)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(path, True)
    out = {}
    while found.hasNext():
        f = found.next()
        out[f.getPath().toString()] = f.getModificationTime()
    return out


def test_a_load_that_ends_anywhere_leaves_keys_and_facts_of_one_load(spark, monkeypatch):
    first = staging(spark, ["B", "C"], JANUARY, 1)
    # A is new and sorts first; January has no row of C any more
    second = staging(spark, ["A", "B"], [*JANUARY, *FEBRUARY], 2)
    before = [("B", 20100101, 1), ("B", 20100102, 1), ("C", 20100101, 1), ("C", 20100102, 1)]
    after = sorted([(s, 20100100 + d, 2) for s in "AB" for d in (1, 2)]
                   + [("C", 20100101, 1), ("C", 20100102, 1)]
                   + [(s, 20100201, 2) for s in "AB"])
    real, real_mark = DataFrameWriter.parquet, commit.commit
    left = [10 ** 6]

    def counted(call):
        def run(*args, **named):
            left[0] -= 1
            if left[0] < 0:
                raise Ended
            return call(*args, **named)
        return run

    monkeypatch.setattr(DataFrameWriter, "parquet", counted(real))
    monkeypatch.setattr(commit, "commit", counted(real_mark))
    ended = 0
    for n in range(0, 100):
        warehouse = scratch_dir(spark, "dw")
        left[0] = 10 ** 6
        jobs.load_warehouse(spark, first, warehouse)
        left[0] = n
        try:
            jobs.load_warehouse(spark, second, warehouse)
        except Ended:
            ended += 1
        else:
            break
        left[0] = 10 ** 6
        jobs.recover_warehouse(spark, warehouse)
        assert facts(spark, warehouse) in (before, after)  # of one load, whole
        jobs.load_warehouse(spark, second, warehouse)
        assert facts(spark, warehouse) == after
        assert not commit.exists(spark, commit.journal_path(warehouse))
    assert ended > 8 and facts(spark, warehouse) == after


def test_only_changed_months_are_written(spark):
    warehouse = scratch_dir(spark, "dw")
    both = staging(spark, ["A", "B"], [*JANUARY, *FEBRUARY], 1)
    jobs.load_warehouse(spark, both, warehouse)
    was = files(spark, warehouse)
    assert {r.stage: r.row_count for r in jobs.load_warehouse(spark, both, warehouse).collect()}[
        "fact_upserted"] == 6
    assert files(spark, warehouse) == was  # nothing is written
    jobs.load_warehouse(spark, staging(spark, ["A"], FEBRUARY, 7), warehouse)
    now = files(spark, warehouse)
    changed = {f for f in was.keys() | now.keys() if was.get(f) != now.get(f)}
    assert any("date_month=201002" in f for f in changed)
    assert not any("date_month=201001" in f or "/dim_" in f for f in changed)
    assert ("A", 20100201, 7) in facts(spark, warehouse) and len(facts(spark, warehouse)) == 6


@pytest.mark.parametrize("broken", ["repeated", "null_date"])
def test_a_load_that_breaks_a_key_leaves_the_tables_as_they_were(spark, broken):
    warehouse = scratch_dir(spark, "dw")
    jobs.load_warehouse(spark, staging(spark, ["A"], JANUARY, 1), warehouse)
    was = files(spark, warehouse)
    bad = staging(spark, ["A", "B"], FEBRUARY, 7)
    again = spark.read.parquet(bad).limit(1)
    if broken == "null_date":
        again = again.withColumn("norm_date", F.lit(None).cast("date"))
    materialize(again, "again").write.mode("append").partitionBy("norm_month").parquet(bad)
    with pytest.raises(ConstraintViolation):
        jobs.load_warehouse(spark, bad, warehouse)
    now = files(spark, warehouse)
    assert {f: t for f, t in now.items() if "/_load/" not in f} == was
    assert jobs.load_warehouse(spark, staging(spark, ["A"], FEBRUARY, 7), warehouse).count() == 6
    assert facts(spark, warehouse) == [("A", 20100101, 1), ("A", 20100102, 1), ("A", 20100201, 7)]


def test_a_journal_without_its_marker_is_dropped(spark):
    warehouse = scratch_dir(spark, "dw")
    jobs.load_warehouse(spark, staging(spark, ["A"], JANUARY, 1), warehouse)
    was = facts(spark, warehouse)
    commit.log(jobs.read_star(spark, warehouse)["dim_station"].limit(0), warehouse, "dim_station")
    assert not jobs.recover_warehouse(spark, warehouse)
    assert facts(spark, warehouse) == was


def test_require_unique(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k int, v string")
    require_unique(rows.where("v IS NOT NULL"), ["k", "v"], "t")
    with pytest.raises(ConstraintViolation, match="occurs 2 times"):
        require_unique(rows, ["k"], "t")
    with pytest.raises(ConstraintViolation, match="null"):
        require_unique(rows, ["k", "v"], "t")


@pytest.mark.parametrize("names", [("OLD", "NEW"), ("NEW", "OLD")])
@pytest.mark.parametrize("files_a_batch", [1, 5])
def test_the_later_of_two_names_of_a_month_stays(spark, names, files_a_batch):
    """In one micro-batch and over two, straight and through the changelog."""
    topic, raw = scratch_dir(spark, "topic"), []
    for i, name in enumerate(names):
        raw = [(f'{{"station_id": "S", "station_name": "{name}", "norm_date": "2010010{i + 1}", '
                f'"dly_tmin_normal": 1, "dly_tmax_normal": 2, "mtd_prcp_normal": 3, "at": {9 + i}}}',)]
        spark.createDataFrame(raw, "value string").coalesce(1).write.mode("append").text(topic)
    options = {"path": topic, "arrival_field": "at", "maxFilesPerTrigger": files_a_batch}
    table = scratch_dir(spark, "summary")
    jobs.monthly_summary_table(spark, "files", options, table,
                               scratch_dir(spark, "ck")).awaitTermination()
    changelog, loaded = scratch_dir(spark, "changelog"), scratch_dir(spark, "loaded")
    q = jobs.summary_changelog(spark, "files", options, changelog, scratch_dir(spark, "ck"))
    q.processAllAvailable()
    q.stop()
    jobs.load_summary_changelog(spark, changelog, loaded, scratch_dir(spark, "ck")).awaitTermination()
    for path in (table, loaded):
        assert [r["station_name"] for r in jobs.read_summary(spark, path).collect()] == [names[1]]
