import datetime as dt
import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from salesmart.operators.joins import PART_ROWS, dealt, hot_keys, lookup_join, measured_small
from salesmart.operators.ranking import Order, Rank, dense_ranks, row_index
from salesmart.verification import bindings


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, some under NULL, the rest spread out."""
    rng = random.Random(3)
    rows = []
    for i in range(6000):
        key = 7 if i % 3 == 0 else (None if i % 50 == 1 else rng.randrange(400))
        rows.append((i, key, f"r{i % 11}"))
    return spark.createDataFrame(rows, "id int, k int, t string")


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_join_equals_plain_join(spark, skewed, how, null_safe):
    lookup = spark.createDataFrame([(k, f"v{k}") for k in [*range(300), None]], "k int, v string")
    small = lookup_join(skewed, lookup, ["k"], how, null_safe)
    large = lookup_join(skewed, lookup, ["k"], how, null_safe, max_rows=0)
    assert "_salt" in large._jdf.queryExecution().toString()
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    expected = {r["id"] for r in skewed.collect() if how == "left" or (r["k"] is None and null_safe) or (r["k"] is not None and r["k"] < 300)}
    assert {r["id"] for r in large.collect()} == expected


def test_hot_keys_are_found(spark, skewed):
    hot = hot_keys(skewed, ["k"], 20)
    assert hot == {spark.range(1).select(F.xxhash64(F.lit(7))).first()[0]: 7}


@pytest.mark.parametrize("partitions", [40, 100])
def test_no_part_outgrows_a_partition(spark, partitions):
    """One dominant key and many medium ones: each is split by its own size."""
    counts = {0: 4000, **{k: 300 for k in range(1, 11)}, **{k: 3 for k in range(100, 1100)}}
    rows = spark.createDataFrame([(k, i) for k, n in counts.items() for i in range(n)], "k int, i int")
    lookup = spark.createDataFrame([(k, f"v{k}") for k in counts], "k int, v string")
    joined = lookup_join(rows, lookup, ["k"], max_rows=0, partitions=partitions)
    assert joined.count() == sum(counts.values()) == joined.where("v = concat('v', k)").count()
    even = sum(counts.values()) / partitions
    hashes = {r["k"]: r["h"] for r in lookup.select("k", F.xxhash64("k").alias("h")).collect()}
    hot = hot_keys(rows, ["k"], partitions)
    assert set(hot) == {hashes[k] for k, n in counts.items() if n > even}
    assert all(n / hot.get(hashes[k], 1) <= even for k, n in counts.items())


def test_measured_small(spark):
    df = spark.range(100).withColumn("t", F.lit("x" * 100))
    assert measured_small(df)
    assert not measured_small(df, max_rows=99)
    assert not measured_small(df, max_bytes=5000)


@pytest.mark.parametrize("limit", [10**6, 0])
def test_dense_ranks_equal_plain_windows(spark, limit):
    rng = random.Random(5)
    rows = [
        (i, "hot" if i % 3 else f"g{i % 7}", rng.choice([None, *range(40)]), rng.choice([None, "a", "b", "c"]))
        for i in range(3000)
    ]
    df = spark.createDataFrame(rows, "id int, g string, total int, name string").repartition(7)
    ranks = [
        Rank("overall", (Order("total", descending=True),)),
        Rank("inside", (Order("total", descending=True), Order("name")), partition=("g",)),
    ]
    got = dense_ranks(df, ranks, single_task_rows=limit, broadcast_rows=limit)
    expected = df.withColumn("overall", F.dense_rank().over(W.orderBy(F.col("total").desc_nulls_first()))).withColumn(
        "inside",
        F.dense_rank().over(W.partitionBy("g").orderBy(F.col("total").desc_nulls_first(), F.col("name").asc_nulls_last())),
    )
    columns = ["id", "g", "total", "name", "overall", "inside"]
    assert sorted(map(str, got.select(columns).collect())) == sorted(map(str, expected.select(columns).collect()))


def test_row_index_is_consecutive(spark):
    df = spark.createDataFrame([(f"k{i:03d}",) for i in range(50)], "k string").repartition(5)
    got = {r["k"]: r["n"] for r in row_index(df, ["k"], "n").collect()}
    assert got == {f"k{i:03d}": i + 1 for i in range(50)}


def test_dealt_parts_grow_with_the_rows(spark):
    """Parts of a fixed number of rows: what one task holds does not grow with the table."""
    rows = spark.range(1000).withColumn("k", F.col("id") % 50)
    left, right = dealt([rows, rows.select("k").distinct()], ["k"], rows=40 * PART_ROWS)
    assert left.rdd.getNumPartitions() == right.rdd.getNumPartitions() == 40
    assert left.join(right, "k").count() == 1000
    assert dealt([rows], ["k"], rows=1)[0].rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_shop_days_are_summed_in_parts_by_order(spark, tmp_path, monkeypatch):
    """Lines of one order meet in one of the parts that their number calls for; NULL orders and repeated keys included."""
    day = dt.datetime(2000, 1, 2)
    lines = [(k, 1, 10.0 * k, "R" if k % 2 else "N", day) for k in (1, 1, 2, 3, 4, 5)] + [(None, 1, 1.0, "N", day)]
    tables = {
        "lineitem": (lines, "l_orderkey long, l_suppkey long, l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz"),
        "orders": ([(1, 7), (2, 7), (3, 8), (3, 9), (4, None), (5, 9), (None, 1)], "o_orderkey long, o_custkey long"),
        "supplier": ([(1, 3)], "s_suppkey long, s_nationkey int"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    monkeypatch.setattr("salesmart.operators.joins.PART_ROWS", 1)
    days = bindings.shop_day_clean(bindings.Tables(spark, str(tmp_path)))
    assert "RepartitionByExpression [l_orderkey" in days._jdf.queryExecution().analyzed().toString()
    got = days.select("buyer_count", "order_count", F.col("gross_sales_amount").cast("double"), F.col("refund_amount").cast("double"))
    assert [tuple(r) for r in got.collect()] == [(3, 6, 190.0, 130.0)]
