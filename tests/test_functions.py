"""Column expressions on the edge cases that matter."""

import pytest
from conftest import day, dec
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradeloom import functions as X


def apply(spark, values, expression, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, c {kind}").select("i", expression.alias("r"))
    return [r.r for r in df.orderBy("i").collect()]


def test_clean_text_strips_spaces_only(spark):
    assert apply(spark, [" a ", "", "  ", None, "\ta"], X.clean_text("c")) == ["a", None, None, None, "\ta"]


def test_valid_keys(spark):
    values = ["nan", " NONE ", "Null", "", None, "nano", " C1 "]
    assert apply(spark, values, X.is_valid_key("c")) == [False] * 5 + [True, True]
    assert apply(spark, values, X.is_missing_key("c")) == [True] * 5 + [False, False]


def test_missing_words(spark):
    assert apply(spark, ["NA", "n/a", "", "nan", "Nano", " NA", None], X.missing_to_null("c")) == [None] * 4 + ["Nano", " NA", None]


def test_version_label(spark):
    assert apply(spark, ["Plan_v1_Original", "PLAN_V12_x"], X.version_label("c")) == ["v1", "v12"]
    with pytest.raises(Exception, match="no version label in sheet name: summary2"):
        apply(spark, ["summary2"], X.version_label("c"))


def test_version_rank(spark):
    assert apply(spark, ["v1", "V12", " v3 ", "xv1", "v", "", None, "v99999999999"], X.version_rank("c")) == [1, 12, 3] + [None] * 5


def test_month_token(spark):
    values = ["1", "12", "13", "0", "abc", None, "3.0", "3.7", " 4 ", "0.9", "1e1", "nan", "inf", "5d", "-1", "12.9"]
    expected = ["T1", "T12", None, None, None, None, "T3", None, "T4", None, "T10", None, None, None, None, None]
    assert apply(spark, values, X.month_token("c")) == expected


def test_month_token_pattern(spark):
    assert apply(spark, ["T1", "T12", "T13", "T0", "t1", "T1 ", None], X.is_month_token("c")) == [True, True, False, False, False, False, None]


def test_mentions_total(spark):
    assert apply(spark, ["Tổng", "TỔNG CỘNG", "Grand Total", None, "An"], X.mentions_total("c")) == [True, True, True, False, False]


def test_numbers(spark):
    assert apply(spark, ["1.5", " 2 ", "nan", "", None], X.to_num("c")) == [dec("1.5"), dec("2"), None, None, None]
    assert apply(spark, ["3.5", "3.4", "-2.5", "7", "2.123456"], X.num_to_int("c")) == [4, 3, -3, 7, 2]
    assert apply(spark, ["1.23450", "1.23456", "1e-5"], X.to_num("c", permissive=True)) == [dec("1.2345"), None, None]
    with pytest.raises(Exception, match="more than four decimals: 1.23456"):
        apply(spark, ["1.23456"], X.to_num("c"))
    assert apply(spark, [" 5 ", "", None], X.to_int("c")) == [5, None, None]


@pytest.mark.parametrize("text, expression", [("5.0", X.to_int), ("x", X.to_num), ("2024/01/15", X.to_date_strict)])
def test_malformed_text_fails(spark, text, expression):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        apply(spark, [text], expression("c"))


def test_malformed_text_is_null_when_permissive(spark):
    assert apply(spark, ["x"], X.to_num("c", True)) == [None]
    assert apply(spark, ["5.0"], X.to_int("c", True)) == [None]
    assert apply(spark, ["2024/01/15"], X.to_date_strict("c", True)) == [None]


def test_dates(spark):
    values = ["2024-01-05", " 2024-1-5 ", "", None]
    assert apply(spark, values, X.to_date_strict("c")) == [day("2024-01-05")] * 2 + [None] * 2
    assert apply(spark, ["NaT", " none ", "nan", "", None, "2024-02-29"], X.sentinel_date("c")) == [None] * 5 + [day("2024-02-29")]


@pytest.mark.parametrize(
    "d, year, quarter",
    [("2023-08-31", 2022, 4), ("2023-09-01", 2023, 1), ("2023-10-01", 2023, 1), ("2023-12-31", 2023, 2), ("2024-01-01", 2023, 2), ("2024-05-31", 2023, 3), ("2024-06-01", 2023, 4)],
)
def test_fiscal_calendar(spark, d, year, quarter):
    assert apply(spark, [day(d)], F.struct(X.fiscal_year("c"), X.fiscal_quarter("c")), "date") == [(year, quarter)]


def test_calendar_parts(spark):
    monday, sunday = day("2024-12-30"), day("2023-01-01")
    assert apply(spark, [monday, sunday], X.iso_weekday("c"), "date") == [1, 7]
    assert apply(spark, [monday, sunday], X.date_key("c"), "date") == [20241230, 20230101]
    assert apply(spark, [monday], X.month_start("c"), "date") == [day("2024-12-01")]


def test_safe_ratio(spark):
    rows = [("1", "0"), ("1", None), ("0", "5"), (None, "5"), ("1", "3"), ("-1", "3"), ("1", "800")]
    df = spark.createDataFrame([(i, dec(a), dec(b)) for i, (a, b) in enumerate(rows)], "i int, a decimal(18,4), b decimal(18,4)")
    got = [r.r for r in df.select("i", X.safe_ratio("a", "b").alias("r")).orderBy("i").collect()]
    assert got == [None, None, dec("0.00"), None, dec("33.33"), dec("-33.33"), dec("0.13")]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-10**14, 10**14), st.integers(-10**14, 10**14).filter(bool)), min_size=1, max_size=30))
def test_safe_ratio_is_exact(spark, pairs):
    """Against integer arithmetic, halves rounded away from zero."""
    df = spark.createDataFrame(
        [(i, dec(n) / 100, dec(d) / 100) for i, (n, d) in enumerate(pairs)], "i int, n decimal(18,4), d decimal(18,4)"
    )
    got = [r.r for r in df.select("i", X.safe_ratio("n", "d").alias("r")).orderBy("i").collect()]
    for (n, d), r in zip(pairs, got):
        units = (2 * abs(n) * 10_000 + abs(d)) // (2 * abs(d))
        assert int(r * 100) == (units if (n < 0) == (d < 0) else -units)


def test_tier(spark):
    values = [dec(v) for v in ("200000000", "199999999.99", "100000000", "-5")] + [None]
    assert apply(spark, values, X.tier("c", 200_000_000, 100_000_000), "decimal(18,4)") == [
        "High Credit", "Medium Credit", "Medium Credit", "Low Credit", "Unknown"
    ]
