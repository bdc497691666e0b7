"""Star load: idempotence, empty input, metadata winners, key lookup, partition merges, SQL."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stationdw.operators import checks
from stationdw.operators.upsert import merge_into_path, merge_stages, upsert_latest
from stationdw.plans.catalog import ensure_tables, register_views, use_database
from stationdw.plans.star import load_report, load_star, resolve_keys
from stationdw.schemas import STAGING_KEY
from stationdw.session import scratch_dir

SCHEMA = ("station_id string, station_name string, elevation decimal(8,2), "
          "latitude decimal(10,6), longitude decimal(10,6), norm_date date, "
          "dly_tmin_normal decimal(7,2), dly_tmax_normal decimal(7,2), "
          "mtd_prcp_normal decimal(10,2)")


def staging(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def reading(sid, name, day, tmin=10, tmax=20, mtd=1, lat=None):
    return (sid, name, None, None if lat is None else Decimal(lat), None,
            dt.date(2010, 1, day), Decimal(tmin), Decimal(tmax), Decimal(mtd))


def sorted_rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_reload_is_a_no_op(spark):
    st = staging(spark, [reading("S2", "two", 1), reading("S1", "one", 1),
                         reading("S1", "one", 2)])
    first = load_star(st, materialize=True)
    again = load_star(st, first)
    for name in ("dim_station", "dim_date", "fact"):
        assert sorted_rows(first[name]) == sorted_rows(again[name]), name
    keys = {r.station_id: r.station_key for r in first["dim_station"].collect()}
    assert keys == {"S1": 1, "S2": 2}
    assert first["dim_date"].where("date_key = 20100102").first().month_name == "January"


def test_empty_staging_writes_nothing(spark):
    st = staging(spark, [])
    assert load_star(st) == {}
    current = load_star(staging(spark, [reading("S1", "one", 1)]))
    assert load_star(st, current) is not None and load_star(st, current)["fact"].count() == 1


def test_station_metadata_winners(spark):
    # Staging keeps the last arrival per key; the dimension keeps the earliest date's metadata.
    msgs = spark.createDataFrame(
        [("S1", "late-name", 2, 5), ("S1", "early-name", 1, 1), ("S1", "newest", 1, 9)],
        "station_id string, station_name string, day int, _arrival long")
    msgs = msgs.select("station_id", "station_name",
                       F.make_date(F.lit(2010), F.lit(1), "day").alias("norm_date"), "_arrival")
    st = upsert_latest(None, msgs, STAGING_KEY, ["_arrival"])
    assert sorted_rows(st.select("norm_date", "station_name")) == [
        (dt.date(2010, 1, 1), "newest"), (dt.date(2010, 1, 2), "late-name")]
    full = st.select(
        "station_id", "station_name", F.lit(None).cast("decimal(8,2)").alias("elevation"),
        F.lit(None).cast("decimal(10,6)").alias("latitude"),
        F.lit(None).cast("decimal(10,6)").alias("longitude"), "norm_date",
        *[F.lit(1).cast("decimal(7,2)").alias(c) for c in ("dly_tmin_normal",
                                                          "dly_tmax_normal")],
        F.lit(1).cast("decimal(10,2)").alias("mtd_prcp_normal"))
    star = load_star(full)
    assert star["dim_station"].first().station_name == "newest"


def test_resolve_keys_raises_on_missing(spark):
    fact = spark.createDataFrame([("S1",), ("S9",)], "station_id string")
    dim = spark.createDataFrame([(1, "S1")], "station_key int, station_id string")
    with pytest.raises(KeyError):
        resolve_keys(fact, dim, "station_id", "station_key")
    assert resolve_keys(fact, dim, "station_id", "station_key", check=False).count() == 1


def test_constraints_hold_after_load(four_station):
    star = four_station["star"]
    assert checks.check_unique(star["fact"], ["station_key", "date_key"]).count() == 0
    assert checks.check_unique(star["dim_station"], ["station_id"]).count() == 0
    assert checks.check_fk(star["fact"], star["dim_station"], "station_key").count() == 0
    assert checks.check_fk(star["fact"], star["dim_date"], "date_key").count() == 0
    assert checks.check_not_null(star["dim_date"], star["dim_date"].columns).count() == 0
    report = {r.stage: r.row_count for r in
              load_report(four_station["staging"], star).collect()}
    assert report == {"staging_rows": 1460, "staging_stations": 4, "staging_dates": 365,
                      "dim_station": 4, "dim_date": 365, "fact_upserted": 1460}


def test_merge_into_path_touches_only_batch_months(spark):
    path = scratch_dir(spark, "merge-test")
    schema = "station_id string, norm_date date, v int, norm_month string, _arrival long"
    b1 = spark.createDataFrame(
        [("A", dt.date(2010, 1, 1), 1, "201001", 1), ("A", dt.date(2010, 2, 1), 1, "201002", 2)],
        schema)
    merge_into_path(b1, path, ["station_id", "norm_date"], ["_arrival"], "norm_month")
    feb = [f for f in os.listdir(path.replace("file:", "") + "/norm_month=201002")
           if f.endswith(".parquet")]
    b2 = spark.createDataFrame(
        [("A", dt.date(2010, 1, 1), 5, "201001", 3), ("B", dt.date(2010, 1, 2), 7, "201001", 4)],
        schema)
    merge_into_path(b2, path, ["station_id", "norm_date"], ["_arrival"], "norm_month")
    merge_into_path(b2, path, ["station_id", "norm_date"], ["_arrival"], "norm_month")
    out = spark.read.parquet(path)
    assert sorted((r.station_id, str(r.norm_date), r.v) for r in out.collect()) == [
        ("A", "2010-01-01", 5), ("A", "2010-02-01", 1), ("B", "2010-01-02", 7)]
    feb_after = [f for f in os.listdir(path.replace("file:", "") + "/norm_month=201002")
                 if f.endswith(".parquet")]
    assert feb == feb_after  # the untouched month was not rewritten


def test_catalog_tables_and_sql_views(spark, four_station, tmp_path):
    locations = ensure_tables(spark, "climate_dw_test", str(tmp_path))
    again = ensure_tables(spark, "climate_dw_test", str(tmp_path))
    assert locations == again and len(locations) == 5
    use_database(spark, "climate_dw_test")
    assert spark.catalog.currentDatabase() == "climate_dw_test"
    assert spark.table("dim_station").count() == 0
    use_database(spark, "default")
    register_views(four_station["star"])
    got = spark.sql("""
        SELECT station_name, COUNT(*) AS months, ROUND(AVG(monthly_avg_temperature_f), 2) AS t
        FROM vw_monthly_climate_imperial GROUP BY station_name""").collect()
    by_name = {r.station_name: (r.months, r.t) for r in got}
    assert by_name["PETERSBURG 2 N ND US"] == (12, Decimal("38.61"))


def test_stored_views_equal_the_dataframe_views_in_another_session(spark, four_station, tmp_path):
    from stationdw.plans.catalog import create_views, refresh_tables
    star = four_station["star"]
    database = "views_test"
    locations = ensure_tables(spark, database, str(tmp_path))
    for name, key in (("dim_station", "dim_station"), ("dim_date", "dim_date"),
                      ("fact_daily_climate_normal", "fact")):
        df = star[key]
        if key == "fact":
            df = df.withColumn("date_month", (F.col("date_key") / 100).cast("int"))
        writer = df.write.mode("overwrite")
        (writer.partitionBy("date_month") if key == "fact" else writer).parquet(locations[name])
    assert create_views(spark, database) == create_views(spark, database)
    refresh_tables(spark, database)
    views = register_views(star, prefix="frame_")
    other = spark.newSession()
    use_database(other, database)
    for name in ("vw_daily_climate_imperial", "vw_monthly_climate_imperial"):
        got, want = other.table(name), views[name]
        assert got.dtypes == want.dtypes
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_monthly_from_star_equals_view_rollup(four_station):
    from stationdw.plans.views import daily_view, monthly_climate, monthly_from_star
    star = four_station["star"]
    a = monthly_from_star(star["fact"], star["dim_date"], star["dim_station"])
    b = monthly_climate(daily_view(star["fact"], star["dim_date"], star["dim_station"]))
    assert a.columns == b.columns
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_retried_batch_reuses_complete_stage(spark):
    path = scratch_dir(spark, "retry-test")
    stages = merge_stages(scratch_dir(spark, "retry-ck"))  # no part of it names the session
    schema = "station_id string, norm_date date, v int, norm_month string, _arrival long"
    b1 = spark.createDataFrame([("A", dt.date(2010, 1, 1), 1, "201001", 1)], schema)
    merge_into_path(b1, path, ["station_id", "norm_date"], ["_arrival"], "norm_month",
                    stages=stages, epoch=1)
    b2 = spark.createDataFrame([("A", dt.date(2010, 1, 1), 2, "201001", 2),
                                ("B", dt.date(2010, 1, 2), 3, "201001", 3)], schema)
    merge_into_path(b2, path, ["station_id", "norm_date"], ["_arrival"], "norm_month",
                    stages=stages, epoch=2)
    # Simulate a swap that went wrong (the month holds something else): the retry of epoch 2
    # must restore the month from its stage instead of merging the batch into that state.
    wrong = spark.createDataFrame([("Z", dt.date(2010, 1, 9), 9, "201001")],
                                  "station_id string, norm_date date, v int, norm_month string")
    wrong.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("norm_month").parquet(path)
    merge_into_path(b2, path, ["station_id", "norm_date"], ["_arrival"], "norm_month",
                    stages=stages, epoch=2)
    got = sorted((r.station_id, r.v) for r in spark.read.parquet(path).collect())
    assert got == [("A", 2), ("B", 3)]


def test_station_without_a_key_fails_the_load(spark):
    from stationdw.plans.star import fact_rows
    st = staging(spark, [reading("S1", "one", 1), reading("S9", "nine", 1)])
    dim = spark.createDataFrame([(1, "S1")], "station_key int, station_id string")
    with pytest.raises(Exception, match="no station key for S9"):
        fact_rows(st, dim).collect()
    assert fact_rows(st.where("station_id = 'S1'"), dim).count() == 1


def test_report_counts_what_the_load_wrote(spark, tmp_path):
    from stationdw.plans.jobs import load_warehouse
    table, warehouse = str(tmp_path / "staging"), str(tmp_path / "dw")

    def load(rows):
        (staging(spark, rows).withColumn("created_at", F.current_timestamp())
         .withColumn("norm_month", F.date_format("norm_date", "yyyyMM"))
         .write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy("norm_month").parquet(table))
        return {r.stage: r.row_count for r in load_warehouse(spark, table, warehouse).collect()}

    assert load([reading("S1", "one", 1), reading("S1", "one", 2)])["fact_upserted"] == 2
    second = load([reading("S2", "two", 1)])
    assert second["fact_upserted"] == 1 and second["dim_station"] == 2
    from stationdw.plans.jobs import read_star
    assert read_star(spark, warehouse)["fact"].count() == 3
