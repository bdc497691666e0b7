"""Operators on tiny inputs: upserts, keys, ranks, top-1, checks, pick, seasons, aggregates."""

from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stationdw.functions.season import season_name, season_order
from stationdw.operators import checks
from stationdw.operators.aggregate import compare_entities, monthly_summary
from stationdw.operators.clean import pick_fields, split_valid
from stationdw.operators.ranking import dense_index, global_rank, rank_within, first_per_group
from stationdw.operators.upsert import insert_ignore, keep_latest, upsert_dim, upsert_latest
from stationdw.schemas import SUMMARY_KEY_ALIASES, SUMMARY_VALUE_ALIASES


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# ---- upserts ---------------------------------------------------------------------------------

@pytest.mark.parametrize("reverse", [False, True])
def test_keep_latest_either_arrival_order(spark, reverse):
    data = [("A", "d1", "first", 1), ("A", "d1", "second", 2)]
    df = spark.createDataFrame(data[::-1] if reverse else data,
                               "k string, d string, v string, _arrival long")
    got = keep_latest(df, ["k", "d"], ["_arrival"]).collect()
    assert len(got) == 1 and got[0].v == "second"


def test_upsert_latest_replaces_and_keeps_first(spark):
    cur = spark.createDataFrame([("A", 1, "x", "t0"), ("B", 1, "y", "t0")],
                                "k string, d int, v string, created_at string")
    inc = spark.createDataFrame([("A", 1, "x2", "t1", 5), ("A", 1, "x3", "t1", 7),
                                 ("C", 1, "z", "t1", 6)],
                                "k string, d int, v string, created_at string, _arrival long")
    out = upsert_latest(cur, inc, ["k", "d"], ["_arrival"], keep_first=["created_at"])
    assert rows(out, "k", "v", "created_at") == [("A", "x3", "t0"), ("B", "y", "t0"),
                                                 ("C", "z", "t1")]
    again = upsert_latest(out, inc, ["k", "d"], ["_arrival"], keep_first=["created_at"])
    assert rows(again, "k", "v", "created_at") == rows(out, "k", "v", "created_at")


def test_insert_ignore_existing_wins(spark):
    cur = spark.createDataFrame([(1, "old")], "k int, v string")
    inc = spark.createDataFrame([(1, "new"), (2, "two"), (2, "two")], "k int, v string")
    assert rows(insert_ignore(cur, inc, ["k"]), "k", "v") == [(1, "old"), (2, "two")]


def test_upsert_dim_scd1_keys(spark):
    cur = spark.createDataFrame([(1, "S1", "one"), (2, "S3", "three")],
                                "station_key int, station_id string, station_name string")
    inc = spark.createDataFrame([("S3", "THREE"), ("S2", "two"), ("S0", "zero")],
                                "station_id string, station_name string")
    out = upsert_dim(cur, inc, "station_id", "station_key")
    assert rows(out, "station_key", "station_id", "station_name") == [
        (1, "S1", "one"), (2, "S3", "THREE"), (3, "S0", "zero"), (4, "S2", "two")]
    again = upsert_dim(out, inc, "station_id", "station_key")
    assert rows(again, "station_key", "station_id", "station_name") == \
        rows(out, "station_key", "station_id", "station_name")


# ---- keys and ranks --------------------------------------------------------------------------

def test_dense_index_distributed_equals_window(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).cast("string").alias("k"))
    a = dense_index(df, ["k"], "i", start_after=10, distributed=True)
    b = dense_index(df, ["k"], "i", start_after=10, distributed=False)
    assert rows(a, "k", "i") == rows(b, "k", "i")
    assert a.agg(F.min("i"), F.max("i")).first() == (11, 5010)


def test_global_rank_ties_nulls_and_hot_key(spark):
    # One value holds a third of all rows; nulls must rank last under DESC.
    df = spark.range(0, 3000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(50.0))
         .when(F.col("id") % 97 == 0, F.lit(None))
         .otherwise((F.col("id") % 200).cast("double")).alias("x"))
    dist = global_rank(df, ["x"], [False], "r", distributed=True)
    local = global_rank(df, ["x"], [False], "r", distributed=False)
    assert rows(dist, "id", "r") == rows(local, "id", "r")
    expect = df.withColumn("r", F.rank().over(Window.orderBy(F.col("x").desc_nulls_last())))
    assert rows(dist, "id", "r") == rows(expect, "id", "r")
    top_null = dist.where(F.col("x").isNull()).agg(F.min("r")).first()[0]
    assert top_null == df.where(F.col("x").isNotNull()).count() + 1


def test_rank_within_hot_group(spark):
    # Group 0 holds a third of the rows; ties and nulls inside groups.
    df = spark.range(0, 3000).select(
        F.col("id"), (F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 7)).alias("g"),
        F.when(F.col("id") % 101 == 0, None).otherwise(F.col("id") % 13).alias("x"))
    dist = rank_within(df, ["g"], ["x"], [False], "r", distributed=True)
    w = Window.partitionBy("g").orderBy(F.col("x").desc_nulls_last())
    expect = df.withColumn("r", F.rank().over(w))
    assert rows(dist, "id", "r") == rows(expect, "id", "r")
    local = rank_within(df, ["g"], ["x"], [False], "r", distributed=False)
    assert rows(local, "id", "r") == rows(expect, "id", "r")


def test_first_per_group_tie_to_earlier_month_and_nulls_last(spark):
    df = spark.createDataFrame(
        [("A", 2010, 1, Decimal("3.0")), ("A", 2010, 2, Decimal("3.0")),
         ("A", 2010, 3, Decimal("1.0")), ("B", 2010, 1, None), ("B", 2010, 2, Decimal("0.5"))],
        "s string, y int, m int, p decimal(10,2)")
    order = [("p", False), ("m", True)]
    for strategy in ("aggregate", "window"):
        got = rows(first_per_group(df, ["s", "y"], order, strategy=strategy), "s", "m")
        assert got == [("A", 1), ("B", 2)], strategy


# ---- checks ----------------------------------------------------------------------------------

def test_checks(spark):
    df = spark.createDataFrame([(1, "a", 10), (1, "b", None), (2, None, 20)],
                               "k int, s string, fk int")
    assert rows(checks.check_unique(df, ["k"]), "k", "dup_count") == [(1, 2)]
    nn = checks.check_not_null(df, ["s", "fk"])
    assert rows(nn, "k", "null_columns") == [(1, "fk"), (2, "s")]
    parent = spark.createDataFrame([(10,)], "fk int")
    assert rows(checks.check_fk(df, parent, "fk"), "k") == [(2,)]
    from pyspark.sql.types import DecimalType
    dom = spark.createDataFrame([("x" * 31, Decimal("123456.00")), ("ok", Decimal("1.00"))],
                                "station_id string, t decimal(12,2)")
    bad = checks.check_domain(dom, {"station_id": 30}, {"t": DecimalType(7, 2)})
    assert rows(bad, "violations") == [("station_id,t",)]


# ---- clean / pick ----------------------------------------------------------------------------

def test_split_valid_reasons(spark):
    df = spark.createDataFrame([("A", "n"), ("B", None), (None, None)], "a string, b string")
    valid, bad = split_valid(df, ["a", "b"])
    assert rows(valid, "a") == [("A",)]
    assert sorted(r.reject_reason for r in bad.collect()) == ["missing a", "missing b"]


def test_pick_fields_value_then_key(spark):
    key = '{"STATION_ID":"K","STATION_NAME":"KN","NORM_MONTH":"201001","YEAR_NUM":2010,' \
          '"MONTH_NUM":1}'
    cases = [
        (key, '{"STATION_ID_V":"V","station_name":"VN","NORM_MONTH_V":"201001",'
              '"YEAR_NUM_V":2010,"MONTH_NUM_V":1,"NUM_DAYS":31}'),
        # present-but-null and zero in the value fall back to the key
        (key, '{"STATION_ID_V":null,"STATION_NAME_V":"","MONTH_NUM_V":0,"num_days":2}'),
        (key, None),                                     # tombstone
        ("not json", '{"station_id":"X"}'),              # broken key
    ]
    df = spark.createDataFrame(cases, "key string, value string")
    got = pick_fields(df, SUMMARY_VALUE_ALIASES, SUMMARY_KEY_ALIASES).collect()
    assert (got[0].station_id, got[0].station_name, got[0].num_days) == ("V", "VN", "31")
    assert (got[1].station_id, got[1].station_name, got[1].month_num) == ("K", "KN", "1")
    assert got[1].year_num == "2010" and got[1].num_days == "2"
    assert got[2].tombstone is True and got[0].tombstone is False
    assert got[3].station_id == "X" and got[3].norm_month is None


def test_seasons(spark):
    df = spark.range(1, 13).select(F.col("id").cast("int").alias("m"))
    got = rows(df.select("m", season_name("m").alias("s"), season_order("m").alias("o")),
               "m", "s", "o")
    assert got[0] == (1, "Winter", 1) and got[11] == (12, "Winter", 1)
    assert got[2] == (3, "Spring", 2) and got[5] == (6, "Summer", 3) and got[8] == (9, "Fall", 4)


# ---- aggregates ------------------------------------------------------------------------------

def test_monthly_summary_nulls_and_dedupe(spark):
    df = spark.createDataFrame(
        [("A", "n", "201001", 2010, 1, 1.0, 3.0, 5.0, "20100101"),
         ("A", "n", "201001", 2010, 1, None, 5.0, 9.0, "20100102"),
         ("A", "n", "201001", 2010, 1, None, 5.0, 9.0, "20100102"),   # replayed reading
         ("A", None, "201001", 2010, 1, 1.0, 1.0, 1.0, "20100103")],  # null key: dropped
        "station_id string, station_name string, norm_month string, year_num int, "
        "month_num int, dly_tmin_normal double, dly_tmax_normal double, "
        "mtd_prcp_normal double, norm_date string")
    s = monthly_summary(df).first()
    assert (s.num_days, s.avg_dly_tmin_normal, s.avg_dly_tmax_normal,
            s.month_end_prcp_normal) == (3, 1.0, pytest.approx(13 / 3), 9.0)
    d = monthly_summary(df, dedupe_keys=["station_id", "norm_date"]).first()
    assert d.num_days == 2


def test_compare_entities_missing_month(spark):
    df = spark.createDataFrame(
        [("L", 2010, 1, Decimal("1.50")), ("R", 2010, 1, Decimal("0.25")),
         ("L", 2010, 2, Decimal("2.00")), ("X", 2010, 1, Decimal("9.00"))],
        "e string, y int, m int, v decimal(10,2)")
    out = compare_entities(df, "e", "L", "R", {"v": "v"}, ["y", "m"], labels=("l", "r"),
                           differences={"v": "l_minus_r"})
    got = rows(out, "m", "l_v", "r_v", "l_minus_r")
    assert got == [(1, Decimal("1.50"), Decimal("0.25"), Decimal("1.25")),
                   (2, Decimal("2.00"), None, None)]
    ranked = global_rank(out, [F.abs(F.col("l_minus_r"))], [False], "rk")
    assert rows(ranked, "m", "rk") == [(1, 1), (2, 2)]


# ---- JSON truth and tombstones ----------------------------------------------------------------

@pytest.mark.parametrize("value,expected", [
    ('{"STATION_ID_V": "0"}', "0"), ('{"STATION_ID_V": "false"}', "false"),
    ('{"STATION_ID_V": " "}', " "), ('{"STATION_ID_V": 7}', "7"), ('{"STATION_ID_V": true}', "true"),
    ('{"STATION_ID_V": 0}', "K"), ('{"STATION_ID_V": 0.0}', "K"), ('{"STATION_ID_V": false}', "K"),
    ('{"STATION_ID_V": null}', "K"), ('{"STATION_ID_V": ""}', "K"), ("{}", "K")])
def test_pick_fields_keeps_text_that_looks_false(spark, value, expected):
    df = spark.createDataFrame([('{"STATION_ID": "K"}', value)], "key string, value string")
    got = pick_fields(df, SUMMARY_VALUE_ALIASES, SUMMARY_KEY_ALIASES).first()
    assert got["station_id"] == expected and not got["tombstone"]


@pytest.mark.parametrize("value", [None, "", "  ", "null", " null "])
def test_blank_and_null_values_are_tombstones(spark, value):
    df = spark.createDataFrame([('{"STATION_ID": "K"}', value)], "key string, value string")
    assert pick_fields(df, SUMMARY_VALUE_ALIASES, SUMMARY_KEY_ALIASES).first()["tombstone"]


def test_split_valid_rejects_text_beyond_its_limit(spark):
    from stationdw.operators.clean import split_valid
    df = spark.createDataFrame([("a" * 30, "x"), ("a" * 31, "y"), (None, "z")],
                               "station_id string, station_name string")
    valid, rejected = split_valid(df, ["station_id"], limits={"station_id": 30})
    assert [r.station_name for r in valid.collect()] == ["x"]
    assert sorted((r.station_name, r.reject_reason) for r in rejected.collect()) == [
        ("y", "too long station_id"), ("z", "missing station_id")]


def test_domain_check_skips_what_a_type_rules_out(spark):
    from decimal import Decimal
    from pyspark.sql import types as T
    from stationdw.operators.checks import check_domain
    df = spark.createDataFrame([(Decimal("1.00"), Decimal("123456.00"))],
                               "a decimal(7,2), b decimal(12,2)")
    limits = {"a": T.DecimalType(7, 2), "b": T.DecimalType(7, 2)}
    assert [r.violations for r in check_domain(df, decimals=limits).collect()] == ["b"]
    assert check_domain(df, decimals={"a": limits["a"]}).count() == 0
