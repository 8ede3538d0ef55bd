from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from veridex.functions import dates, num, text
from veridex.operators import repair


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first().asDict()


def test_figures(spark):
    cases = {"1,234": 1234.0, "(1,234.50)": -1234.5, "-": 0.0, "Nil": 0.0, "–12": -12.0, "12 13": None, "abc": None, "1e5": None, "12,34,567": 1234567.0, " 7 ": 7.0, "1;234": 1234.0, "": None}
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", num.figure(F.col("t")).alias("v")).collect()
    assert {r.t: r.v for r in rows} == cases


def test_rounding_and_ratio(spark):
    r = one(spark, a=num.round_up_half(F.lit(-2.5), 0), b=num.ratio(F.lit(1.0), F.lit(0.0)), c=num.sum_present(F.lit(None).cast("double"), F.lit(2.0)), d=num.sum_present(F.lit(1.0), F.lit(None).cast("double"), at_least=2), e=num.finite(F.lit(float("nan"))))
    assert r == {"a": -2.0, "b": None, "c": 2.0, "d": None, "e": None}


def test_misreadings_hold_the_confused_digit(spark):
    got = one(spark, m=num.misreadings(F.lit("138")))["m"]
    assert {"188", "133", "(138)", "13", "318"} <= set(got) and "138" not in got


def test_month_shift_keeps_month_ends(spark):
    d = lambda s: F.lit(s).cast("date")
    r = one(spark, a=dates.shift_months(d("2023-02-28"), 12), b=dates.shift_months(d("2024-02-29"), -12), c=dates.shift_months(d("2023-01-30"), 1))
    assert [str(x) for x in r.values()] == ["2024-02-29", "2023-02-28", "2023-02-28"]


def test_dates_and_times(spark):
    r = one(spark, a=dates.long_date(F.lit("as at June 31, 2023")), b=dates.long_date(F.lit("30th June, 2023")), c=dates.clock(F.lit("3:30")), d=dates.clock(F.lit("11 a.m.")), e=dates.range_months(F.lit("July to March")), f=dates.year_order(F.lit("2023 2022 2023")), g=dates.period_label(F.lit("2023-06-30").cast("date"), F.lit(12)))
    assert r == {"a": None, "b": datetime.date(2023, 6, 30), "c": "15:30", "d": "11:00", "e": 9, "f": [2023, 2022], "g": "2023-06-30/12M"}


def test_text(spark):
    r = one(spark, a=text.label(F.lit(" 12 (a) Stock -in - Trade: Long-Term’s ")), b=text.common_subsequence(F.lit("12345"), F.lit("1x3x5")), c=text.words_alike(F.lit("inventory"), F.lit("inventary")), d=text.token_on_line(F.lit("total 1,234"), F.lit("234")), e=text.token_on_line(F.lit("total 1,234"), F.lit("1,234")), g=text.html_to_text(F.lit("<p>a&amp;b</p><script>x</script><td>c</td>")))
    assert r == {"a": "(a) stock - in - trade long-term's", "b": 3, "c": True, "d": False, "e": True, "g": "a&b\nc"}


def test_digits_are_misread_as_numbers(spark):
    """Without texts what texts give, in their order; what no value of their own prints keeps the longer way."""
    raws = ["0", "7", "00", "10", "0381", "1123", "5566", "90000", "100200300", "271828182845904", "314159265358979"]
    df = spark.createDataFrame([(r, int(r)) for r in raws], "raw string, v long")
    texts = F.filter(F.array_distinct(F.transform(num.misreadings(F.col("raw")), num.figure)), lambda x: x.isNotNull() & (x != F.col("v")))
    numbers = F.filter(F.array_distinct(num.misread_numbers(F.col("v"), F.length("raw")).cast("array<double>")), lambda x: x != F.col("v"))
    for r in df.select("raw", texts.alias("texts"), numbers.alias("numbers")).collect():
        assert r.texts == r.numbers, r.raw
    others = spark.createDataFrame([("12", 13.0), ("12", None), ("1,2", 12.0), ("12\n", 12.0), ("1234567890123456", 1234567890123456.0), (None, 1.0), ("", None)], "raw string, value double")
    texts = F.filter(F.array_distinct(F.transform(num.misreadings(F.col("raw")), num.figure)), lambda x: x.isNotNull() & ~x.eqNullSafe(F.col("value")))
    for r in others.select("raw", texts.alias("texts"), repair.tries(F.col("raw"), F.col("value")).alias("got")).collect():
        assert r.texts == r.got, r.raw
