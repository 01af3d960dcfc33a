import datetime as dt
from decimal import ROUND_HALF_EVEN, ROUND_HALF_UP, Decimal, localcontext

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salesmart import functions as fn


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("45658", dt.date(2025, 1, 1)),
        ("45658.7", dt.date(2025, 1, 1)),
        ("　45658.0\t", dt.date(2025, 1, 1)),
        ("2025-01-09", dt.date(2025, 1, 9)),
        ("2025/1/9", dt.date(2025, 1, 9)),
        ("2025", dt.date(1905, 7, 17)),
        ("2025-01-09 10:11:12", dt.date(2025, 1, 9)),
        ("   ", None),
        (None, None),
    ],
)
def test_excel_date(spark, text, expected):
    assert one(spark, text, fn.excel_date) == expected


@pytest.mark.parametrize("text", ["garbage", "20250101", "2025-03"])
def test_excel_date_rejects(spark, text):
    with pytest.raises(Exception, match="Not a date"):
        one(spark, text, fn.excel_date)


def test_normalise_date_text_keeps_other_text(spark):
    assert one(spark, "45658.0", fn.normalise_date_text) == "2025-01-01"
    assert one(spark, "2025/1/9", fn.normalise_date_text) == "2025/1/9"
    with pytest.raises(Exception, match="out of range"):
        one(spark, "20250101", fn.normalise_date_text)


def test_strip_matches_python_for_every_white_space_character(spark):
    blanks = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
    assert one(spark, f"{blanks}a b{blanks}", fn.strip) == "a b"
    assert one(spark, blanks, fn.blank_to_null) is None
    # Zero-width space is no white space.
    assert one(spark, "​", fn.blank_to_null) == "​"


def test_numbers(spark):
    assert one(spark, "776..03", fn.repair_number) == "776.03"
    assert one(spark, "1...2..3", fn.repair_number) == "1.2.3"
    assert one(spark, "12.0", fn.floor_int) == 12
    assert one(spark, "-3.5", fn.floor_int) == -4
    assert one(spark, "2.345", fn.money) == Decimal("2.35")
    assert one(spark, "776..03", fn.lenient_decimal) == 0
    assert one(spark, None, fn.lenient_decimal) == 0
    assert one(spark, "NaN", fn.lenient_decimal) == 0
    assert one(spark, "-1.25", fn.lenient_decimal) == Decimal("-1.25")
    with pytest.raises(Exception):
        one(spark, "12x", fn.money)


def test_rounding_families(spark):
    assert one(spark, "2.345", lambda c: fn.fixed_text(c.cast("decimal(38,10)"), 2)) == "2.34"
    assert one(spark, "12.5", lambda c: fn.fixed_text(c.cast("decimal(38,10)"), 0)) == "12"
    rows = spark.createDataFrame([(481, 8804), (6, 38), (1, 0), (1, None), (1, 8)], "a int, b int")
    got = [r[0] for r in rows.select(fn.safe_ratio(F.col("a"), F.col("b"), 4)).collect()]
    assert got == [Decimal("0.0546"), Decimal("0.1579"), None, None, Decimal("0.1250")]
    money = spark.createDataFrame([(Decimal("14703.36"), 481), (Decimal("259"), 9)], "a decimal(14,2), b int")
    assert [r[0] for r in money.select(fn.safe_ratio(F.col("a"), F.col("b"), 2)).collect()] == [
        Decimal("30.57"),
        Decimal("28.78"),
    ]


@settings(max_examples=8, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.decimals(min_value=-(10**9), max_value=10**9, places=2),
            st.decimals(min_value=-(10**7), max_value=10**7, places=2),
        ),
        min_size=1,
        max_size=40,
    ),
    st.sampled_from([2, 4, 6]),
)
def test_exact_ratio_rounds_once(spark, pairs, places):
    tie = (Decimal(1), Decimal(2 * 10**places))
    near = (Decimal("12354999999"), Decimal("100000000000"))
    rows = [*pairs, tie, (tie[0] * 3, tie[1]), (-tie[0], tie[1]), near]
    df = spark.createDataFrame(rows, "a decimal(38,10), b decimal(38,10)")
    up, even = (
        df.select(
            fn.ratio_or_zero(F.col("a"), F.col("b"), places, half_even=False).alias("up"),
            fn.ratio_or_zero(F.col("a"), F.col("b"), places, half_even=True).alias("even"),
        )
        .toPandas()
        .T.values
    )
    with localcontext() as context:
        context.prec = 60
        for (a, b), got_up, got_even in zip(rows, up, even, strict=True):
            value = a / b if b else Decimal(0)
            step = Decimal(1).scaleb(-places)
            assert got_up == value.quantize(step, ROUND_HALF_UP)
            assert got_even == value.quantize(step, ROUND_HALF_EVEN)


def test_payload_text_takes_first_non_blank(spark):
    df = spark.createDataFrame([({"成交金额": " ", "支付金额": "　5 "},), ({"支付金额": "7"},), ({"x": "1"},)], "p map<string,string>")
    got = [r[0] for r in df.select(fn.payload_text(F.col("p"), "成交金额", "支付金额")).collect()]
    assert got == ["5", "7", None]


def test_json_object_text_sorts_and_escapes(spark):
    df = spark.createDataFrame([({"b": 'x"y\\z', "a": "金额", "c": "t\tn\n"},)], "p map<string,string>")
    assert df.select(fn.json_object_text(F.col("p"))).first()[0] == (
        '{"a": "金额", "b": "x\\"y\\\\z", "c": "t\\tn\\n"}'
    )


def test_keys_and_labels(spark):
    assert one(spark, None, fn.key_text) == ""
    assert one(spark, "", fn.key_display) is None
    assert one(spark, dt.date(2025, 3, 9), fn.month_label, "date") == "2025-03"
    assert one(spark, dt.date(2025, 3, 9), fn.month_start, "date") == dt.date(2025, 3, 1)
