"""Snapshots, claims and versions with other writers, crashes and open readers in between."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from salesmart.operators import merge
from salesmart.plans import jobs
from salesmart.sources import commits, sinks, storage

from test_jobs import BOOK, LATER, NOW, SHOP_ROWS, SKU_ROWS, book, sheet, workbook

SCHEMA = "shop_id int, sales_date date, amount int, created_at int"
KEYS, UPDATE, KEEP = ["shop_id", "sales_date"], ["amount"], ["created_at"]
JAN, FEB = dt.date(2025, 1, 5), dt.date(2025, 2, 5)


def together(n, work):
    """Run ``work`` n times at once; results in any order, the first failure is raised."""
    out, gate = [], threading.Barrier(n)

    def run(i):
        gate.wait()
        try:
            out.append(work(i))
        except Exception as problem:
            out.append(problem)

    threads = [threading.Thread(target=run, args=(i,)) for i in range(n)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    for x in out:
        if isinstance(x, Exception):
            raise x
    return out


def stored(spark, path):
    return sorted(tuple(r) for r in commits.read(spark, path, commits.current(spark, path), "fact").select(*KEYS, *UPDATE, *KEEP).collect())


def test_one_of_many_creates_a_file_and_numbers_are_claimed_once(spark, tmp_path):
    assert sorted(together(8, lambda i: storage.place_new(spark, f"{tmp_path}/x/one", f"by {i}"))) == [False] * 7 + [True]
    assert storage.read_text(spark, f"{tmp_path}/x/one").startswith("by ") and storage.names(spark, f"{tmp_path}/x") == ["one"]
    assert sorted(together(8, lambda i: storage.claim_next(spark, f"{tmp_path}/ids", 4))) == list(range(5, 13))
    assert storage.names(spark, f"{tmp_path}/none") == []


def test_rename_of_other_file_systems_never_overwrites(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "_local", lambda path: None)
    path = f"file://{tmp_path}/one"
    assert storage.place_new(spark, path, "first") and not storage.place_new(spark, path, "second")
    assert storage.read_text(spark, path) == "first" and storage.names(spark, f"file://{tmp_path}") == ["one"]
    storage.remove(spark, path)
    assert not storage.exists(spark, path)


def test_upsert_repeats_on_the_newest_state(spark, tmp_path, monkeypatch):
    """Another writer commits after this one has read and written, once on the same month and once on another."""
    path = str(tmp_path / "fact")
    frame = lambda *rows: spark.createDataFrame(rows, SCHEMA)
    merge.upsert_table(spark, path, frame((1, JAN, 1, 1)), KEYS, UPDATE, keep_cols=KEEP)
    write, others = commits.write_months, [frame((2, JAN, 2, 2)), frame((2, FEB, 3, 3))]
    written = []

    def interrupted(root, table, df, months):
        out = write(root, table, df, months)
        written.append(months)
        if others:
            other, before = others.pop(0), stored(spark, path)
            monkeypatch.setattr(commits, "write_months", write)
            assert before == stored(spark, path)  # what is written is not seen
            merge.upsert_table(spark, path, other, KEYS, UPDATE, keep_cols=KEEP)
            monkeypatch.setattr(commits, "write_months", interrupted)
        return out

    monkeypatch.setattr(commits, "write_months", interrupted)
    merge.upsert_table(spark, path, frame((1, JAN, 10, 9), (3, JAN, 4, 4)), KEYS, UPDATE, keep_cols=KEEP)
    assert stored(spark, path) == [(1, JAN, 10, 1), (2, JAN, 2, 2), (2, FEB, 3, 3), (3, JAN, 4, 4)]
    # January was merged again after the first interruption; the February of the second does not concern it.
    assert written == [["2025-01"], ["2025-01"]] and commits.current(spark, path).version == 4


def test_many_writers_lose_no_row(spark, tmp_path):
    path = str(tmp_path / "fact")
    together(4, lambda i: merge.upsert_table(spark, path, spark.createDataFrame([(i, JAN, i, i)], SCHEMA), KEYS, UPDATE, keep_cols=KEEP))
    assert [r[0] for r in stored(spark, path)] == [0, 1, 2, 3]


def test_months_are_pruned_on_both_sides_of_an_upsert(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "fact")
    rows = spark.createDataFrame([(1, JAN, 1, 1), (1, FEB, 2, 2)], SCHEMA)
    merge.upsert_table(spark, path, rows, KEYS, UPDATE, keep_cols=KEEP)
    at = commits.current(spark, path)
    plan = commits.from_month(commits.read(spark, path, at, "fact"), "2025-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sales_month" in plan and "2025-02" in plan
    seen = []
    monkeypatch.setattr(merge, "upsert_small_batch", lambda target, *rest: seen.append(target) or upsert(target, *rest))
    upsert = merge.upsert
    merge.upsert_table(spark, path, rows.filter("sales_date < '2025-02-01'"), KEYS, UPDATE, keep_cols=KEEP)
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan.replace("PartitionFilters: []", "") and "(sales_month" in plan and "2025-02" not in plan.split("PartitionFilters")[1].split("]")[0]


def test_vacuum_keeps_what_is_read(spark, tmp_path):
    path = str(tmp_path / "fact")
    for amount in (1, 2, 3):
        merge.upsert_table(spark, path, spark.createDataFrame([(1, JAN, amount, 1)], SCHEMA), KEYS, UPDATE, keep_cols=KEEP)
        if amount == 1:
            reader = commits.pinned(spark, path)
            at = reader.__enter__()
    old = commits.read(spark, path, at, "fact")
    assert len(commits.vacuum(spark, path, keep=1, min_age=0)) == 2  # a pin of age 0 is taken for one left behind
    reader.__exit__(None, None, None)
    assert stored(spark, path) == [(1, JAN, 3, 1)]
    with pytest.raises(Exception):
        old.collect()


def test_vacuum_leaves_pinned_snapshots(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "fact")
    merge.upsert_table(spark, path, spark.createDataFrame([(1, JAN, 1, 1)], SCHEMA), KEYS, UPDATE, keep_cols=KEEP)
    real = storage.age_seconds
    monkeypatch.setattr(storage, "age_seconds", lambda s, p: real(s, p) if "/_pins/" in p else 10**6)
    with commits.pinned(spark, path) as at:
        for amount in (2, 3):
            merge.upsert_table(spark, path, spark.createDataFrame([(1, JAN, amount, 1)], SCHEMA), KEYS, UPDATE, keep_cols=KEEP)
        assert len(commits.vacuum(spark, path, keep=1)) == 1
        assert commits.read(spark, path, at, "fact").first()["amount"] == 1
    assert len(commits.vacuum(spark, path, keep=1)) == 1 and stored(spark, path) == [(1, JAN, 3, 1)]


def test_two_rebuilds_get_two_versions_and_old_ones_go(spark, tmp_path):
    root = str(tmp_path / "published")
    paths = together(3, lambda i: sinks.publish(spark.range(i, i + 1), root))
    assert sorted(p.rsplit("=", 1)[1] for p in paths) == ["1", "2", "3"]
    assert sinks.current_version_path(spark, root).endswith("version=3")
    with sinks.opened(spark, root) as path:
        sinks.publish(spark.range(9), root)
        assert sinks.retire(spark, root, keep=1) == []  # all are young
        assert spark.read.parquet(path).count() == 1
    assert len(sinks.retire(spark, root, keep=1, min_age=0)) == 3
    assert sinks.read_published(spark, root).count() == 9


# --- imports -------------------------------------------------------------------------------------------------------------


def state(spark, wh):
    """All that a reader of the warehouse can see."""
    at = commits.current(spark, wh.root)
    names = [*jobs.CONTROL, *(f for f in jobs.FACTS if f in at.schemas)]
    seen = {n: sorted(map(repr, jobs.layer(spark, wh, n, at=at).collect())) for n in names}
    for name in ("import_file_sheets", "raw_import_rows", "stg_shop_day"):
        seen[name] = sorted(map(repr, jobs.layer(spark, wh, name, "import_file_id int", at=at).collect()))
    return seen


def test_a_crash_after_any_write_changes_nothing(spark, tmp_path, monkeypatch):
    wh = jobs.Warehouse(str(tmp_path / "wh"))
    jobs.initialise(spark, wh)
    first = book(workbook(spark, SHOP_ROWS, SKU_ROWS))
    assert jobs.load_shop_day(spark, wh, first, NOW) == 1
    before = state(spark, wh)
    second = book(workbook(spark, [["45689", *SHOP_ROWS[0][1:]], SHOP_ROWS[0]], SKU_ROWS), shop_name="Two")
    writes = [(sinks, "write_import"), (commits, "write_whole"), (commits, "write_months"), (storage, "place_new")]
    originals = {name: getattr(module, name) for module, name in writes}
    left, total = [None], [0]

    def counting(name):
        def run(*args, **kwargs):
            out = False if name == "place_new" and left[0] == 1 and "_commits" in args[1] else originals[name](*args, **kwargs)
            total[0] += 1
            if left[0] is not None:
                left[0] -= 1
                if left[0] == 0:
                    raise OSError("lost")
            return out

        return run

    for module, name in writes:
        monkeypatch.setattr(module, name, counting(name))
    # The writes are: shop, claim, three layers, months, register, commit.
    for crash in (4, 6, 8):
        left[0] = crash
        with pytest.raises(OSError, match="lost"):
            jobs.load_shop_day(spark, wh, second, LATER)
        left[0] = None
        assert state(spark, wh) == before
    total[0] = 0
    done = jobs.load_shop_day(spark, wh, second, LATER)
    assert total[0] == 8
    after = state(spark, wh)
    assert [eval(r.replace("Row", "dict").replace("datetime.", "dt."))["import_file_id"] for r in after["import_files"]] == [1, done]
    assert done == 5 and len(after["raw_import_rows"]) == 3 and len(after["fact_shop_day"]) == 2


def test_two_loads_at_once(spark, tmp_path):
    wh = jobs.Warehouse(str(tmp_path / "wh"))
    jobs.initialise(spark, wh)
    rows = workbook(spark, SHOP_ROWS, SKU_ROWS)
    ids = together(2, lambda i: jobs.load_shop_day(spark, wh, book(rows, shop_code=f"pdd_{i}", shop_name=f"S{i}"), NOW))
    assert len(set(ids)) == 2
    register = jobs.layer(spark, wh, "import_files").collect()
    assert {r["import_file_id"] for r in register} == set(ids) and len({r["shop_id"] for r in register}) == 2
    facts = jobs.layer(spark, wh, "fact_shop_day").collect()
    staged = {(r["import_file_id"], r["shop_id"]) for r in jobs.layer(spark, wh, "stg_shop_day").collect()}
    assert {(f["import_file_id"], f["shop_id"]) for f in facts} == {(r["import_file_id"], r["shop_id"]) for r in register} == staged


def test_each_load_refreshes_platform_shop_and_type(spark, tmp_path):
    wh = jobs.Warehouse(str(tmp_path / "wh"))
    jobs.initialise(spark, wh)
    spoiled = jobs.control_table(spark, wh, "source_file_types", jobs.FILE_TYPES).withColumn("is_active", F.lit(False)).withColumn("description", F.lit("?"))
    renamed = jobs.control_table(spark, wh, "platforms", jobs.PLATFORMS).withColumn("platform_name", F.lit("?"))
    commits.commit(spark, wh.root, lambda at: commits.write_whole(wh.root, "source_file_types", spoiled) | commits.write_whole(wh.root, "platforms", renamed))
    jobs.load_shop_day(spark, wh, book(workbook(spark, SHOP_ROWS, SKU_ROWS)), NOW)
    assert jobs.layer(spark, wh, "platforms").first()["platform_name"] == jobs.PLATFORM[1]
    types = jobs.layer(spark, wh, "source_file_types").collect()
    assert len(types) == 9 and [t["file_type_code"] for t in types if t["is_active"]] == ["pdd_shop_daily"]
    assert next(t for t in types if t["is_active"])["description"] != "?"


def test_reports_from_the_stored_layers(spark, tmp_path):
    wh = jobs.Warehouse(str(tmp_path / "wh"))
    jobs.initialise(spark, wh)
    days = [[str(45658 + d), *SHOP_ROWS[0][1:]] for d in (0, 40, 45)]
    rows = workbook(spark, days, [[str(45658 + d), "A", "p", "c", "", "1", "2.50", "2", "s"] for d in (0, 40)])
    jobs.load_shop_day(spark, wh, book(rows), NOW)
    jobs.load_sku_day(spark, wh, book(rows), NOW)
    counts = {"shop_daily": 3, "shop_monthly": 2, "top_summary_daily": 3, "shop_rank_30d": 1, "sku_daily": 2, "sku_rank_30d": 1, "product_cards_30d": 1}
    for name, n in counts.items():
        assert jobs.report(spark, wh, name).count() == n, name
    assert jobs.report(spark, wh, "shop_rank_30d").first()["覆盖天数"] == 2
    at = commits.current(spark, wh.root)
    assert jobs.latest_stored_date(spark, wh, at, "fact_shop_day") == dt.date(2025, 2, 15)
    recent = jobs.trailing_days(jobs.layer(spark, wh, "fact_shop_day"), "sales_date", dt.date(2025, 2, 15))
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sales_month" in plan and ">= 2025-01" in plan
    source = spark.createDataFrame([("pdd_1", "2025-01-01", "x", None, "l", *["1"] * 7)], "shop_code string, sales_date string, spu_name string, campaign_name string, listing_name string, product_visitor_count string, product_pageview_count string, unit_count string, buyer_count string, order_count string, gross_sales_amount string, product_favorite_user_count string")
    jobs.sinks.refresh_snapshot(jobs.reviews.spu_snapshot(source, NOW), str(tmp_path / "monitoring"))
    for name in ("spu_monitoring", "spu_trial_cards"):
        assert jobs.report(spark, wh, name, snapshot_root=str(tmp_path / "monitoring")).count() == 1


# --- registry of sheets --------------------------------------------------------------------------------------------------


def listed(rows, *more):
    known = rows.select("workbook_identifier", "sheet_index", "sheet_name").distinct()
    return known.union(rows.sparkSession.createDataFrame(list(more), "workbook_identifier string, sheet_index int, sheet_name string")) if more else known


def test_an_empty_second_match_fails_the_load(spark, tmp_path):
    wh = jobs.Warehouse(str(tmp_path / "wh"))
    jobs.initialise(spark, wh)
    rows = workbook(spark, SHOP_ROWS, SKU_ROWS)
    with pytest.raises(Exception, match="more than one sheet"):
        jobs.load_shop_day(spark, wh, book(rows, sheets=listed(rows, (BOOK, 20, "旧日报数据源"))), NOW)
    jobs.load_shop_day(spark, wh, book(rows, sheets=listed(rows, (BOOK, 20, "空"))), NOW)
    found = {r["sheet_name"]: r["detected_row_count"] for r in jobs.layer(spark, wh, "import_file_sheets").collect()}
    assert found["空"] == 0 and len(found) == 9
    with pytest.raises(ValueError, match="no sheet at all"):
        jobs.load_shop_day(spark, wh, book(rows.limit(0)), NOW)


def test_families_with_missing_or_unregistered_workbooks_fail(spark, tmp_path):
    rows = workbook(spark, SHOP_ROWS, SKU_ROWS)
    columns = "workbook_identifier string, workbook_path string, workbook_file_name string, workbook_file_hash string, shop_code string"
    entry = lambda name: (name, f"/in/{name}.xlsx", f"{name}.xlsx", "h", "pdd_1")
    build = lambda files, r=rows, s=None: jobs.build_family(spark, r, spark.createDataFrame(files, columns), str(tmp_path / "family"), s)
    with pytest.raises(ValueError, match="workbook has no sheet"):
        build([entry(BOOK), entry("pdd_2_workbook_2026")])
    with pytest.raises(ValueError, match="not registered"):
        build([entry(BOOK)], rows.union(sheet(spark, [["x"]], "Sheet1", 1).withColumn("workbook_identifier", F.lit("other"))))
    with pytest.raises(ValueError, match="not listed"):
        build([entry(BOOK)], rows, listed(rows).filter("sheet_name <> 'Sheet9'"))
    with pytest.raises(ValueError, match="not 2"):
        build([entry(BOOK)], rows, listed(rows, (BOOK, 20, "旧SKU源数据")))
    with pytest.raises(ValueError, match="no rows"):
        build([entry(BOOK)], rows.filter("sheet_name NOT LIKE '%SKU源数据'"), listed(rows))
    target = build([entry(BOOK)], rows, listed(rows, (BOOK, 20, "空")))
    inventory = {r["sheet_name"]: (r["detected_row_count"], r["workbook_path"]) for r in spark.read.parquet(f"{target}/sheet_inventory").collect()}
    assert inventory["空"] == (0, f"/in/{BOOK}.xlsx") and len(inventory) == 9
    run = next(r for r in spark.read.json(f"{target}/run_manifest").collect() if r["entry"] == "run")
    assert run["workbook_count"] == 1


def test_the_family_reads_its_rows_at_most_twice(spark, tmp_path):
    path = str(tmp_path / "rows")
    workbook(spark, SHOP_ROWS, SKU_ROWS).write.parquet(path)
    rows = spark.read.parquet(path)
    files = spark.createDataFrame([(BOOK, "/in/x", "x", "h", "pdd_1")], "workbook_identifier string, workbook_path string, workbook_file_name string, workbook_file_hash string, shop_code string")
    resolved = jobs.family_headers(rows)  # the first: header rows, written
    plan = jobs.normalize_family(rows, files, "b", resolved)._jdf.queryExecution().executedPlan().toString()
    assert sum("FileScan parquet" in line and "cells" in line for line in plan.split("\n")) == 1
