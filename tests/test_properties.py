"""Property tests: operators against plain models or the single-partition window."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from stationdw.operators.ranking import global_rank, rank_within, first_per_group
from stationdw.operators.upsert import keep_latest, upsert_latest

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

readings = st.lists(st.tuples(st.sampled_from("ABC"), st.integers(1, 3), st.integers(0, 9)),
                    min_size=1, max_size=40)


@SETTINGS
@given(rows=readings)
def test_keep_latest_matches_dict_model(spark, rows):
    data = [(k, d, v, i) for i, (k, d, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k string, d int, v int, _arrival long")
    model = {}
    for k, d, v, i in data:
        model[(k, d)] = v                      # later arrival overwrites
    got = {(r.k, r.d): r.v for r in keep_latest(df, ["k", "d"], ["_arrival"]).collect()}
    assert got == model


@SETTINGS
@given(first=readings, second=readings)
def test_upsert_twice_equals_upsert_of_concatenation(spark, first, second):
    a = [(k, d, v, i) for i, (k, d, v) in enumerate(first)]
    b = [(k, d, v, len(a) + i) for i, (k, d, v) in enumerate(second)]
    schema = "k string, d int, v int, _arrival long"
    step = upsert_latest(upsert_latest(None, spark.createDataFrame(a, schema), ["k", "d"],
                                       ["_arrival"]),
                         spark.createDataFrame(b, schema), ["k", "d"], ["_arrival"])
    once = upsert_latest(None, spark.createDataFrame(a + b, schema), ["k", "d"], ["_arrival"])
    assert sorted(map(tuple, step.collect())) == sorted(map(tuple, once.collect()))


values = st.lists(st.one_of(st.none(), st.integers(0, 6)), min_size=1, max_size=60)


@SETTINGS
@given(xs=values, desc=st.booleans())
def test_global_rank_distributed_equals_window(spark, xs, desc):
    df = spark.createDataFrame(list(enumerate(xs)), "id long, x int")
    order = F.col("x").desc_nulls_last() if desc else F.col("x").asc_nulls_first()
    expect = {r.id: r.r for r in df.withColumn("r", F.rank().over(Window.orderBy(order)))
              .collect()}
    got = {r.id: r.r for r in global_rank(df, ["x"], [not desc], "r", distributed=True)
           .collect()}
    assert got == expect


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 5))),
                     min_size=1, max_size=60))
def test_rank_within_distributed_equals_window(spark, rows):
    df = spark.createDataFrame([(i, g, x) for i, (g, x) in enumerate(rows)],
                               "id long, g int, x int")
    w = Window.partitionBy("g").orderBy(F.col("x").desc_nulls_last())
    expect = {r.id: r.r for r in df.withColumn("r", F.rank().over(w)).collect()}
    got = {r.id: r.r for r in rank_within(df, ["g"], ["x"], [False], "r", distributed=True)
           .collect()}
    assert got == expect


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 3), st.integers(1, 12),
                               st.one_of(st.none(), st.integers(0, 4))),
                     min_size=1, max_size=50, unique_by=lambda t: (t[0], t[1])))
def test_first_aggregate_equals_window(spark, rows):
    df = spark.createDataFrame(rows, "s int, m int, p int")
    order = [("p", False), ("m", True)]
    a = first_per_group(df, ["s"], order, strategy="aggregate")
    b = first_per_group(df, ["s"], order, strategy="window")
    assert sorted(map(tuple, a.select("s", "m", "p").collect())) == \
        sorted(map(tuple, b.select("s", "m", "p").collect()))


@SETTINGS
@given(first=readings, second=readings)
def test_merge_strategies_agree(spark, first, second):
    schema = "k string, d int, v int, created_at int, _arrival long"
    a = [(k, d, v, 1, i) for i, (k, d, v) in enumerate(first)]
    b = [(k, d, v, 2, len(a) + i) for i, (k, d, v) in enumerate(second)]
    cur = upsert_latest(None, spark.createDataFrame(a, schema), ["k", "d"], ["_arrival"])
    inc = spark.createDataFrame(b, schema)
    x = upsert_latest(cur, inc, ["k", "d"], ["_arrival"], keep_first=["created_at"])
    y = upsert_latest(cur, inc, ["k", "d"], ["_arrival"], keep_first=["created_at"],
                      strategy="aggregate")
    assert sorted(map(tuple, x.collect())) == sorted(map(tuple, y.collect()))
