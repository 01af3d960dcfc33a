import datetime as dt

import pytest
from pyspark.sql import functions as F

from salesmart.operators import merge
from salesmart.sources import commits

D1, D2, D3 = dt.date(2025, 1, 1), dt.date(2025, 1, 2), dt.date(2025, 2, 1)
SCHEMA = "shop_id int, sales_date date, amount int, import_file_id int, created_at int"
KEYS, UPDATE, KEEP = ["shop_id", "sales_date"], ["amount", "import_file_id"], ["created_at"]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


WAYS = pytest.mark.parametrize("upsert", [merge.upsert, merge.upsert_small_batch])


@WAYS
def test_upsert_replaces_keeps_and_adds(spark, upsert):
    target = spark.createDataFrame([(1, D1, 10, 1, 100), (1, D2, 20, 1, 100)], SCHEMA)
    batch = spark.createDataFrame([(1, D2, None, 2, 200), (1, D3, 30, 2, 200)], SCHEMA)
    merged = upsert(target, batch, KEYS, UPDATE, KEEP)
    assert rows(merged) == [(1, D1, 10, 1, 100), (1, D2, None, 2, 100), (1, D3, 30, 2, 200)]
    assert rows(upsert(merged, batch, KEYS, UPDATE, KEEP)) == rows(merged)
    assert rows(upsert(target.limit(0), batch, KEYS, UPDATE, KEEP)) == rows(batch)


@WAYS
@pytest.mark.parametrize(
    ("stored", "message"),
    [([(1, D1, 1, 1, 0), (1, D1, 2, 1, 0)], "stored twice"), ([(None, D1, 1, 1, 0)], "NULL in key")],
)
def test_upsert_guards_stored_rows(spark, upsert, stored, message):
    batch = spark.createDataFrame([(2, D2, 5, 2, 0)], SCHEMA)
    with pytest.raises(Exception, match=message):
        upsert(spark.createDataFrame(stored, SCHEMA), batch, KEYS, UPDATE, KEEP).collect()


@WAYS
@pytest.mark.parametrize(
    ("batch", "message"),
    [([(1, D1, 1, 2, 0), (1, D1, 2, 2, 0)], "twice in one batch"), ([(None, D1, 1, 2, 0)], "NULL in key")],
)
def test_upsert_guards(spark, upsert, batch, message):
    target = spark.createDataFrame([(1, D1, 10, 1, 100)], SCHEMA)
    merged = upsert(target, spark.createDataFrame(batch, SCHEMA), KEYS, UPDATE, KEEP)
    with pytest.raises(Exception, match=message):
        merged.collect()
    with pytest.raises(Exception, match=message):
        merged.select("amount").count()


def test_newest_import_equals_upserts_in_order(spark):
    data = [(s, D1 + dt.timedelta(days=d), s * d + i, i, 0) for i in (1, 2, 3) for s in (1, 2) for d in range(0, 9, i)]
    every = spark.createDataFrame(data, SCHEMA)
    state = every.filter("import_file_id = 1")
    for i in (2, 3):
        state = merge.upsert(state, every.filter(f"import_file_id = {i}"), KEYS, UPDATE)
    assert rows(merge.newest_import(every, KEYS, UPDATE, "import_file_id")) == rows(state.select(*KEYS, *UPDATE))


def test_newest_import_guards_repeats(spark):
    data = [(1, D1, 1, 1, 0), (1, D1, 2, 2, 0), (1, D1, 3, 2, 0)]
    with pytest.raises(Exception, match="twice in one batch"):
        merge.newest_import(spark.createDataFrame(data, SCHEMA), KEYS, UPDATE, "import_file_id").collect()


@pytest.mark.parametrize("small", [True, False])
def test_upsert_table_rewrites_only_touched_months(spark, tmp_path, monkeypatch, small):
    monkeypatch.setattr(merge, "measured_small", lambda df: small)
    path = str(tmp_path / "fact")
    first = spark.createDataFrame([(1, D1, 10, 1, 100), (1, D3, 20, 1, 100)], SCHEMA)
    merge.upsert_table(spark, path, first, KEYS, UPDATE, keep_cols=KEEP)
    february = commits.current(spark, path).folders["fact/2025-02"]
    second = spark.createDataFrame([(1, D1, 11, 2, 200), (1, D2, 12, 2, 200)], SCHEMA)
    for _ in range(2):
        merge.upsert_table(spark, path, second, KEYS, UPDATE, keep_cols=KEEP)
        at = commits.current(spark, path)
        got = commits.read(spark, path, at, "fact").select(*KEYS, *UPDATE, *KEEP)
        assert rows(got) == [(1, D1, 11, 2, 100), (1, D2, 12, 2, 200), (1, D3, 20, 1, 100)]
    assert at.folders["fact/2025-02"] == february and at.version == 3


def test_insert_missing_and_update_from(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string")
    assert rows(merge.insert_missing(target, new, ["k"])) == [(1, "a"), (2, "c")]
    source = spark.createDataFrame([(1, None)], "k int, v string")
    both = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    got = {r["k"]: r["v"] for r in merge.update_from(both, source, ["k"], ["v"]).collect()}
    assert got == {1: None, 2: "b"}


def test_register_and_latest_imports(spark):
    files = spark.createDataFrame([(4, 10), (9, 30)], "import_file_id int, imported_at int")
    new = spark.createDataFrame([("b",), ("a",)], "file_path string")
    got = {r["file_path"]: r["import_file_id"] for r in merge.register_imports(files, new, ["file_path"]).collect()}
    assert got == {"a": 10, "b": 11}
    empty = merge.register_imports(files.limit(0), new, ["file_path"])
    assert sorted(r["import_file_id"] for r in empty.collect()) == [1, 2]
    assert merge.latest_imports(files, 1).first()["import_file_id"] == 9
    ids = files.select("import_file_id")
    assert rows(merge.union_ids(ids, ids)) == [(4,), (9,)]


def test_date_filter_reaches_both_sides_of_an_upsert(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, D1, 10, 1, 100)], SCHEMA).write.parquet(path)
    stored = spark.read.parquet(path)
    merged = merge.upsert(stored, stored, KEYS, UPDATE).filter(F.col("sales_date") > F.lit(D2))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("GreaterThan(sales_date") == 2
