"""What of a model's readings a page bears out."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from veridex.operators import readings


def test_items_need_their_values_on_one_line_in_order(spark):
    lines = spark.createDataFrame([("f", "income", 1, i, t) for i, t in enumerate(["Revenue 7 1,234 (5,678)", "Cost 11,234 5,678", "Tax 40 -", "Other 1,234", "no figures"])], "filing string, statement string, page int, line_no int, text string")
    asked = {
        "revenue": ["1,234", "(5,678)"], "swapped": ["(5,678)", "1,234"], "inside": ["234", "5,678"], "nil": ["40", "-"], "nils": ["-", None], "short": ["40"], "word": ["forty", "1"], "apart": ["40", "1,234"], "unread": [None, "1,234"],
    }
    r = spark.createDataFrame([("f", "income", k, v, 2) for k, v in asked.items()], "filing string, statement string, item string, values array<string>, n_columns int")
    good, bad = readings.read_items(r, lines)
    assert {x.item: x.line and x.line.line_no for x in good.collect()} == {"revenue": 0, "nil": 2, "nils": None, "unread": 0}
    assert {x.item: x.reason for x in bad.collect()} == {
        "swapped": "the values are not on one line", "inside": "a value is not on the page", "short": "another number of values than columns", "word": "a value is no number", "apart": "the values are not on one line",
    }
    assert readings.read_items(r.where("false"), lines)[0].count() == 0


def test_columns_and_signs(spark):
    lines = spark.createDataFrame([("f", "balance", 4, 0, "Total assets 10 20 30"), ("f", "balance", 4, 1, "Stock (5) 6 7"), ("f", "balance", 4, 2, "EPS 1.5 2 3")], "filing string, statement string, page int, line_no int, text string")
    r = spark.createDataFrame([("f", "balance", i, v, 3) for i, v in (("total_assets", ["10", "20", "30"]), ("stock", ["(5)", "6", "7"]), ("eps_basic", ["1.5", "2", "3"]))], "filing string, statement string, item string, values array<string>, n_columns int")
    c = spark.createDataFrame([("f", "balance", [("2025-06-30", 5), ("2025-02-30", 0), ("2019-06-30", 0)], "as at June 30, 2025 and 2019", datetime.date(2025, 6, 30), 1000)], "filing string, statement string, columns array<struct<period_end: string, months: int>>, heading string, filed date, unit int")
    good, bad = readings.verified(r, lines, c, (), ("stock",))
    assert sorted((x.item, str(x.period_end), x.months, x.value) for x in good.collect()) == [("eps_basic", "2025-06-30", 0, 1.5), ("total_assets", "2025-06-30", 0, 10_000.0)]
    assert [(x.item, x.reason) for x in bad.collect()] == [("stock", "negative")]
    day = lambda p, m, kind="income": readings.column_problem(F.struct(F.lit(p).alias("period_end"), F.lit(m).alias("months")), F.lit(kind), F.lit("2025 and 2024"), F.lit("2025-06-30").cast("date"))
    got = spark.range(1).select(day("2025-06-30", 12), day("2025-06-30", 5), day("2023-06-30", 12), day("2024-13-01", 12), day("2024-06-30", None, "balance")).first()
    assert list(got) == [None, "no period length", "not in the heading", "not a date", None]


def test_readings_of_a_page_are_dealt_out_once(spark, monkeypatch):
    """Items, lines and columns meet where their page is; an item read twice breaks an identity once; a null key meets nothing."""
    plans, kept = [], readings.written
    monkeypatch.setattr(readings, "written", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or kept(df, name))
    lines = spark.createDataFrame([(f, "income", 1, i, t) for f in ("f", None) for i, t in enumerate(["Revenue 90", "Cost (30)", "Gross 70"])], "filing string, statement string, page int, line_no int, text string")
    asked = [(f, k, v) for f in ("f", None) for k, v in (("revenue", "90"), ("revenue", "90"), ("cost_of_sales", "(30)"), ("gross_profit", "70"), ("other", "30"), ("none", "31"))]
    r = spark.createDataFrame([(f, "income", k, [v], 1) for f, k, v in asked], "filing string, statement string, item string, values array<string>, n_columns int")
    c = spark.createDataFrame([("f", "income", [("2025-06-30", 12)], "2025", datetime.date(2025, 6, 30), 1)], "filing string, statement string, columns array<struct<period_end: string, months: int>>, heading string, filed date, unit int")
    good, bad = readings.verified(r, lines, c, ("cost_of_sales",), ())
    assert [(x.filing, x.item, x.value) for x in good.collect()] == [("f", "other", 30.0)]
    assert sorted((x.filing or "", x.item, x.reason) for x in bad.collect()) == sorted([("f", k, "breaks an identity") for k in ("revenue", "cost_of_sales", "gross_profit")] + [("f", "none", "a value is not on the page")] + [("", k, "a value is not on the page") for k in ("revenue", "revenue", "cost_of_sales", "gross_profit", "other", "none")])
    assert len(plans) == 1 and plans[0].count("REPARTITION") == 2 and "ENSURE_REQUIREMENTS" not in plans[0]
