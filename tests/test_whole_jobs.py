"""Jobs that must stay whole, or bounded in one task, on large and odd tables."""

import hashlib

from pyspark.sql import functions as F

from salesmart.contracts import SKU_DAILY_LOAD
from salesmart.operators.headers import preview
from salesmart.session import configure
from salesmart.verification.bindings import Tables
from salesmart.verification.queries import REGISTRY


def test_one_file_for_each_supplier_row(spark, tmp_path):
    rows = [(1, "a"), (65, "b"), (65, "b"), (65, "c"), (2, None), (None, "d")]
    spark.createDataFrame(rows, "s_suppkey long, s_name string").write.parquet(f"{tmp_path}/supplier.parquet")
    got = REGISTRY["file_fingerprint"](Tables(spark, str(tmp_path))).collect()
    expected = [(k, n and hashlib.sha256(f"{n}\n".encode()).hexdigest()) for k, n in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))


def test_preview_sorts_keys_and_no_payloads(spark):
    """First rows of each sheet, with NULL sheets and numbers; payloads are sorted for the shown rows alone."""
    rows = [(b, None if i == 3 else 1000 - i, {"日期": f"{i}"}, {"sales_date": "日期"}) for b in ("x", "y", None) for i in range(40)]
    df = spark.createDataFrame(rows, "book string, row_number int, raw_payload map<string,string>, mapping map<string,string>")
    shown = preview(df, SKU_DAILY_LOAD, ["book"])
    got = {(r["book"], r["source_row_number"]) for r in shown.collect()}
    assert got == {(b, n) for b in ("x", "y", None) for n in (None, "961", "962", "963", "964")}
    plan = shown._jdf.queryExecution().optimizedPlan().toString()
    assert "_last" in plan and plan.index("Window [row_number()") < plan.index("_last")


def test_generated_methods_stay_below_what_the_jvm_compiles(spark):
    assert int(configure(spark).conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_sorting_a_family_reads_a_written_copy(spark, monkeypatch):
    """The sort's sample does not derive the rows a second time."""
    seen = []
    monkeypatch.setattr("salesmart.verification.queries.sorted_dataset", lambda df: seen.append(df) or df.orderBy(F.lit(1)))
    try:
        REGISTRY["ordered_family"](Tables(spark, "/root/testdata/sf0.001"))
    except Exception:  # the rows are not in order here  # noqa: BLE001
        pass
    assert "salesmart-" in "".join(seen[0].inputFiles()) and "Generate" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()
