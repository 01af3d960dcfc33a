import csv
import datetime as dt
import glob
from collections import Counter

import pytest
from pyspark.sql import functions as F

from salesmart.operators import joins, quality, rules
from salesmart.session import materialise, scratch, shared_dir
from salesmart.sources import landed, sinks, storage


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([("b", 2, 'x"y'), ("a", 1, None), ("c", 3, "")], "k string, n int, t string")
    sinks.write_csv(df, path, ["n", "k", "t"], ["n"])
    lines = [row for f in sorted(glob.glob(f"{path}/*.csv")) for row in list(csv.reader(open(f, encoding="utf-8")))[1:]]
    assert lines == [["1", "a", ""], ["2", "b", 'x"y'], ["3", "c", ""]]
    assert landed.read_csv_strict(spark, path, "n int, k string, t string").count() == 3
    with pytest.raises(Exception):
        landed.read_csv_strict(spark, path, "n int, k int, t string").collect()


def test_csv_keeps_line_breaks_quotes_and_blanks(spark, tmp_path):
    rows = [(1, "a\nb"), (2, ' "quoted", with blanks '), (3, "c\r\nd"), (4, None)]
    path = str(tmp_path / "csv")
    sinks.write_csv(spark.createDataFrame(rows, "n int, t string"), path, ["n", "t"], ["n"])
    assert sorted(map(tuple, landed.read_csv_strict(spark, path, "n int, t string").collect())) == rows


def test_publish_keeps_the_last_complete_version(spark, tmp_path):
    root = str(tmp_path / "set")
    with pytest.raises(FileNotFoundError):
        sinks.read_published(spark, root)
    sinks.publish(spark.range(3), root)
    broken = spark.range(2).withColumn("x", F.raise_error(F.lit("boom")).cast("int"))
    with pytest.raises(Exception, match="boom"):
        sinks.publish(broken, root)
    assert sinks.read_published(spark, root).count() == 3
    # The new version may be computed from the current one.
    sinks.refresh_snapshot(sinks.read_published(spark, root).filter("id > 0"), root)
    assert sinks.read_published(spark, root).count() == 2


def test_append_import_layers(spark, tmp_path):
    path = str(tmp_path / "raw")
    schema = "import_file_id int, row_number int, sheet_name string, raw_payload map<string,string>"
    for i in (1, 2):
        sinks.append_import(spark.createDataFrame([(i, 2, "s", {"日期": str(i)})], schema), path)
    rows = landed.read_raw_rows(spark, path).orderBy("import_file_id").collect()
    assert [(r["import_file_id"], r["raw_payload"]) for r in rows] == [(1, {"日期": "1"}), (2, {"日期": "2"})]


def test_datasets_and_manifest(spark, tmp_path):
    sinks.write_dataset(spark.range(2), f"{tmp_path}/datasets/spu_source")
    assert landed.read_dataset(spark, str(tmp_path), "spu_source").count() == 2
    with pytest.raises(KeyError):
        landed.read_dataset(spark, str(tmp_path), "nope")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        landed.read_dataset(spark, str(tmp_path), "sku_source")
    sinks.write_manifest(spark.createDataFrame([(1, "金")], "b int, a string"), f"{tmp_path}/m")
    text = "".join(open(f, encoding="utf-8").read() for f in glob.glob(f"{tmp_path}/m/*.json"))
    assert text == '{"a":"金","b":1}\n'


def test_raw_rows_json(spark, tmp_path):
    path = tmp_path / "rows.json"
    path.write_text('{"import_file_id":1,"row_number":2,"sheet_name":"","raw_payload":"{\\"a\\":\\"1\\"}"}\n', encoding="utf-8")
    row = landed.read_raw_rows_json(spark, str(path)).first()
    assert (row["sheet_name"], row["raw_payload"]) == (None, {"a": "1"})


def test_materialise_writes_to_the_shared_folder(spark):
    df = materialise(spark.range(5))
    assert df.count() == 5
    assert shared_dir(spark).replace("file:", "") in df.inputFiles()[0].replace("file://", "").replace("file:", "")


def test_quality_rules(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, None, "b"), (2, "x", None), (None, "x", "c")], "k int, sheet string, c string")
    keys = ["k", F.coalesce("sheet", F.lit("")).alias("sheet_key")]
    assert [tuple(r) for r in quality.duplicate_keys(df, keys).collect()] == [(1, "", 2)]
    parent = spark.createDataFrame([(1,)], "k int")
    assert [tuple(r) for r in quality.orphans(df, parent, ["k"]).collect()] == [(2, 1)]
    assert {r["column_name"]: r["null_count"] for r in quality.null_violations(df, ["k", "sheet"]).collect()} == {"k": 1, "sheet": 2}
    lineage = {(r["parent"], r["problem"]): r["rows"] for r in quality.lineage_violations(df, {"p": (parent, ["k"])}).collect()}
    assert lineage == {("p", "missing"): 1, ("p", "orphan"): 1}
    conflicts = quality.identifier_conflicts(df.withColumn("k", F.col("k").cast("string")), [("sheet", "k"), ("k", "c")])
    assert [tuple(r) for r in conflicts.collect()] == [("k->c", "1", 2)]
    with pytest.raises(ValueError, match="missing columns: y, z"):
        quality.require_columns(df, ["z", "k", "y"])
    assert quality.require_columns(df, ["k"]) is df
    present = spark.createDataFrame([("w", "b"), ("w", "x"), ("v", "a"), ("v", "b")], "w string, column_name string")
    assert [tuple(r) for r in quality.missing_columns(["b", "a", "c"], present, ["w"]).orderBy("w").collect()] == [("v", "c"), ("w", "a, c")]


def test_reconcile_metrics_finds_the_documented_outlier(spark):
    rows = [(3070, 152, "100", "4.95"), (8804, 481, "14703.36", "0.0546"), (0, 1, "1", None)]
    df = spark.createDataFrame(rows, "shop_visitor_count int, buyer_count int, s string, r string").selectExpr(
        "1 as shop_id", "*", "cast(s as decimal(14,2)) gross_sales_amount", "cast(r as decimal(12,6)) conversion_rate",
        "cast(null as decimal(14,2)) avg_order_value", "cast(null as decimal(14,2)) uv_value",
    )
    row = quality.reconcile_metrics(df, ["shop_id"]).first()
    assert (row["conversion_rate_compared"], row["conversion_rate_off"], row["uv_value_compared"]) == (2, 1, 0)


def test_dimension_lookups(spark):
    platforms = spark.createDataFrame([(1, "pdd")], "platform_id int, platform_code string")
    shops = spark.createDataFrame([(5, 1, "pdd_1"), (6, 1, "pdd_2")], "shop_id int, platform_id int, shop_code string")
    assert joins.platform_id_of(platforms, "pdd") == 1 and joins.platform_id_of(platforms, "x") is None
    assert joins.resolve_shop(platforms, shops, "pdd", "pdd_2").first()["shop_id"] == 6
    assert joins.lookup_by_code(shops, "shop_code", "pdd_1").count() == 1


def test_coverage(spark):
    df = spark.createDataFrame([(1, dt.date(2025, 1, 1)), (1, dt.date(2025, 1, 3))], "s int, sales_date date")
    assert tuple(quality.coverage(df, ["s"]).first()) == (1, 2, dt.date(2025, 1, 1), dt.date(2025, 1, 3))
    layers = {"raw": df, "fact": df.limit(1)}
    assert tuple(quality.reconcile_layers(layers, "s").first()) == (1, 2, 1)


def test_missing_columns_reports_groups_that_have_nothing(spark):
    present = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b")], "g int, column_name string")
    groups = spark.createDataFrame([(1,), (2,), (3,)], "g int")
    got = quality.missing_columns(["b", "a"], present, ["g"], groups=groups).collect()
    assert {r["g"]: r["missing_columns"] for r in got} == {2: "a", 3: "a, b"}


def test_written_order_is_checked_inside_and_between_files(spark, tmp_path):
    good = spark.range(1, 250_001).selectExpr("id % 3 AS g", "CASE WHEN id % 9 = 0 THEN NULL ELSE id END AS v", "id")
    path = str(tmp_path / "good")
    good.repartitionByRange(5, F.col("g").desc(), F.col("v"), "id").sortWithinPartitions(F.col("g").desc(), F.col("v"), "id").write.parquet(path)
    rows = landed.read_ordered(spark, path)
    order = [("g", True), ("v", False), ("id", False)]
    assert rows.agg(F.count_distinct("position"), F.max("position")).first() == (250_000, 250_000)
    assert landed.out_of_order(rows, order).isEmpty()
    # The last row of the first range of 100,000 positions now belongs before it.
    moved = rows.withColumn("v", F.when(F.col("position") == 100_001, -1).otherwise(F.col("v")))
    assert [r["position"] for r in landed.out_of_order(moved, order).collect()] == [100_001]
    assert landed.out_of_order(rows, [("id", False)]).count() > 0


def test_lineage_of_one_import_opens_its_folders_only(spark, tmp_path):
    rows = spark.range(40).selectExpr("CAST(id % 4 AS INT) AS import_file_id", "CAST(id AS INT) AS row_number")
    for name, df in (("staging", rows), ("raw", rows.filter("row_number <> 6"))):
        sinks.append_import(df, str(tmp_path / name))
    staging, raw = (spark.read.parquet(str(tmp_path / n)) for n in ("staging", "raw"))
    got = quality.lineage_delta(staging, {"raw": (raw, ["import_file_id", "row_number"])}, 2)
    assert {(r["problem"], r["rows"]) for r in got.collect()} == {("missing", 0), ("orphan", 1)}
    filters = got._jdf.queryExecution().sparkPlan().toString().split("PartitionFilters: [")[1:]
    assert len(filters) >= 3 and all("import_file_id" in f.split("]")[0] for f in filters), filters


def test_scratch_removes_what_a_job_wrote(spark):
    with scratch(spark) as folder:
        kept = materialise(spark.range(3))
        assert kept.count() == 3 and storage.exists(spark, folder)
    assert not storage.exists(spark, folder)
    with pytest.raises(ZeroDivisionError), scratch(spark) as folder:
        materialise(spark.range(3))
        raise ZeroDivisionError
    assert not storage.exists(spark, folder)


def test_outlier_rows(spark):
    df = spark.createDataFrame([(3070, 152, "100", "4.95")], "shop_visitor_count int, buyer_count int, s string, r string").selectExpr(
        "1 as shop_id", "date'2025-01-01' as sales_date", "*", "cast(s as decimal(14,2)) gross_sales_amount", "cast(r as decimal(12,6)) conversion_rate",
        "cast(null as decimal(14,2)) avg_order_value", "cast(0.03 as decimal(14,2)) uv_value",
    )
    assert [(r["metric"], float(r["source"]), float(r["derived"])) for r in quality.metric_outliers(df).collect()] == [("conversion_rate", 4.95, 0.0495)]


def test_identifier_conflicts_expand_only_ids_with_several_identities(spark, monkeypatch):
    # Ids 0 to 999 have one identity each, every row comes twice; the last ones have several or lack columns.
    rows = [(f"s{i}", f"p{i % 5}", f"m{i % 3}", f"t{i % 5}") for i in range(1000)] * 2
    rows += [("x", "p0", "m9", None), ("x", "p1", "m9", "t1"), ("x", None, None, None), ("y", "p9", None, "t9"), ("y", "p9", None, "t8")]
    rows += [(None, "p2", "m2", "t0"), (None, "p7", "m7", "t7"), (None, "p7", None, "t6"), (None, None, None, None), ("z", None, "m7", "t5")]
    names = ["sku", "product", "code", "spec"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    pairs = [("sku", "product"), ("sku", "code"), ("code", "sku"), ("product", "spec"), ("product", "sku")]
    found: dict = {}
    for row in (dict(zip(names, r, strict=True)) for r in rows):
        for a, b in pairs:
            if row[a] is not None and row[b] is not None:
                found.setdefault((f"{a}->{b}", row[a]), set()).add(row[b])
    expected = {(*k, len(v)) for k, v in found.items() if len(v) > 1}
    written = []

    def counted(frame):
        out = materialise(frame)
        written.append(out.count())
        return out

    monkeypatch.setattr(quality, "materialise", counted)
    got = [tuple(r) for r in quality.identifier_conflicts(df, pairs).collect()]
    assert len(got) == len(set(got)) and set(got) == expected
    assert written == [1010, 2, 15 + 5]  # identities, hub ids with several, folded identities


def test_declared_rules_write_totals_instead_of_keys(spark, monkeypatch):
    # One parent with three children, of other number types, with copies, NULLs and ids without parent.
    parents = [(i, i % 7, "ab"[i % 2] if i % 5 else None) for i in range(400)] + [(3, 3, "a"), (None, 1, None)]
    children = {
        name: [(i % every if i % 9 else None, i % 7, None if i % 4 else "") for i in range(900)] for name, every in (("c1", 300), ("c2", 450), ("c3", 401))
    }
    rows = {"p": parents, **children}
    schema = {"p": "id bigint, part int, mark string", "c1": "id int, part int, mark string", "c2": "id bigint, part bigint, mark string", "c3": "id bigint, part int, mark string"}
    declared = [
        rules.Unique("p", ("id",)),
        rules.Unique("p", ("part", "mark"), blank=("mark",)),
        rules.Unique("c1", ("id",)),
        rules.Unique("c2", ("mark", "part")),
        *[rules.Reference(c, ("id",), "p", ("id",)) for c in children],
        rules.Reference("c2", ("id", "part"), "p", ("id", "part")),
        *[rules.Required(t, c) for t in rows for c in ("id", "mark")],
    ]
    names = ("id", "part", "mark")

    def keys(table, columns, blank=()):
        taken = [[r[names.index(c)] for c in columns] for r in rows[table]]
        filled = [tuple("" if v is None and c in blank else v for c, v in zip(columns, r, strict=True)) for r in taken]
        return Counter(r for r in filled if None not in r)

    expected = []
    for r in declared:
        if isinstance(r, rules.Required):
            expected.append(("required", r.table, r.column, None, 0, sum(x[names.index(r.column)] is None for x in rows[r.table])))
            continue
        own = keys(r.table, r.columns, getattr(r, "blank", ()))
        if isinstance(r, rules.Unique):
            broken, shown = [n for n in own.values() if n > 1], ("unique", None)
        else:
            known = keys(r.parent, r.parent_columns)
            broken, shown = [n for k, n in own.items() if k not in known], ("reference", r.parent)
        expected.append((shown[0], r.table, ", ".join(r.columns), shown[1], len(broken), sum(broken)))
    written = []

    def counted(frame):
        out = materialise(frame)
        written.append(out.count())
        return out

    monkeypatch.setattr(rules, "materialise", counted)
    got = rules.check({t: spark.createDataFrame(r, schema[t]) for t, r in rows.items()}, declared)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, expected))
    # Five families (the third child has one of its own) and at most four combinations of NULLs in each of four tables.
    assert len(written) == 1 and written[0] <= 5 + 4 * 4
    empty = rules.check({t: spark.createDataFrame([], schema[t]) for t in rows}, declared).collect()
    assert len(empty) == len(declared) and all((r["violating_keys"], r["violating_rows"]) == (0, 0) for r in empty)
    with pytest.raises(ValueError, match="rules are broken"):
        rules.require({t: spark.createDataFrame(r, schema[t]) for t, r in rows.items()}, declared)
