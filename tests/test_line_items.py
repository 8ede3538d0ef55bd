"""Registers of the line-by-line reader: sections, units, bases, columns and confidence."""

from __future__ import annotations

import itertools
import re

from veridex.operators import line_items


def read(spark, *pages, year=2025, confidence=None, every=False):
    rows = [("f", i, t, year, confidence) for i, t in enumerate(pages, 1)]
    df = spark.createDataFrame(rows, "filing string, page_number int, text string, target_year int, confidence double")
    got = (line_items.candidates if every else line_items.promoted)(df).collect()
    return got if every else {(r.basis, r.item): r.value for r in got}


def test_sections_units_and_magnitudes(spark):
    text = "Statement of Profit or Loss\nAmounts in thousand\nNet sales 9,000\nProfit after taxation 900\nTaxation (300)\nDiluted earnings per share 1.25\nStatement of Financial Position\nTotal assets 70\nTrade debts (5)\nStatement of Cash Flows\nNet cash used in investing activities (30)"
    got = read(spark, text)
    assert got["unknown", "revenue"] == 9_000_000 and got["unknown", "taxation"] == 300_000 and got["unknown", "eps_diluted"] == 1.25
    # a heading's unit is that of its page
    assert got["unknown", "total_assets"] == 70_000 and got["unknown", "investing_cash_flow"] == -30_000
    assert ("unknown", "trade_debts") not in got and got["unknown", "net_margin_pct"] == 10.0


def test_columns_by_the_years_above(spark):
    assert read(spark, "Income Statement\n2024 2025\nRevenue 10 12")["unknown", "revenue"] == 12
    assert read(spark, "Income Statement\n2025 2024\nRevenue 7 10 12")["unknown", "revenue"] == 10
    assert read(spark, "Income Statement\nRevenue 7 10 12")["unknown", "revenue"] == 10
    assert read(spark, "Income Statement\n2026 2024\nRevenue 5")["unknown", "revenue"] == 5


def test_bases_of_banners_and_headings(spark):
    text = "CONSOLIDATED FINANCIAL STATEMENTS\nBalance Sheet\nTotal assets 10\nUnconsolidated Balance Sheet\nTotal assets 7\nSeparate statement of cash flows\nDividends paid (3)"
    got = read(spark, text)
    assert got == {("consolidated", "total_assets"): 10, ("unconsolidated", "total_assets"): 7, ("unconsolidated", "dividend_paid"): -3}


def test_what_ends_a_section(spark):
    notes = "Income Statement\nRevenue 12\nNotes to the financial statements\nProfit before tax would be 27"
    assert set(read(spark, notes)) == {("unknown", "revenue")}
    long = "Income Statement\n" + "a line\n" * 119 + "Revenue 12\nProfit before tax 5"
    assert set(read(spark, long)) == {("unknown", "revenue")}
    assert read(spark, "Financial highlights\nRevenue 12\nTotal assets 5") == {}
    # without any heading lines are candidates of little confidence
    loose = read(spark, "Revenue 12000\nTotal assets 30000", every=True)
    assert len(loose) == 2 and all(r.confidence < line_items.PROMOTED for r in loose) and read(spark, "Revenue 12000") == {}


def test_pages_of_little_confidence_and_nothing(spark):
    assert len(read(spark, "Income Statement\nRevenue 12", confidence=0.64, every=True)) == 1 and read(spark, "Income Statement\nRevenue 12", confidence=0.64) == {}
    assert read(spark, None, "") == {}
    # the surer line counts, whatever its place; a line with one figure is surer
    assert read(spark, "Income Statement\nRevenue 1 2\nRevenue 3", confidence=0.99)["unknown", "revenue"] == 3


def texts_of(parsed) -> list[str]:
    """Texts of a pattern, its repeated parts once or, where they may be, not at all."""
    parts = []
    for op, x in parsed:
        name = str(op)
        if name == "LITERAL":
            parts.append([chr(x)])
        elif name == "IN":
            parts.append([t for one in x if str(one[0]) not in ("NEGATE", "RANGE") for t in texts_of([one])] or ["~"])
        elif name == "CATEGORY":
            parts.append(["7" if "DIGIT" in str(x) else " "])
        elif name == "ANY":
            parts.append(["x"])
        elif name == "BRANCH":
            parts.append([t for one in x[1] for t in texts_of(one)])
        elif name == "SUBPATTERN":
            parts.append(texts_of(x[-1]))
        elif name == "MAX_REPEAT":
            parts.append(([""] if x[0] == 0 else []) + texts_of(x[2]))
        elif name not in ("AT", "ASSERT_NOT"):
            raise AssertionError(name)
    return list(map("".join, itertools.product(*parts)))


def test_patterns_need_their_words():
    """Every text of a pattern holds one of the words that lines are asked for first."""
    asked = [(p, line_items.ALIAS_WORDS[i]) for _, i, _, p in line_items.ALIASES]
    asked += [(line_items.HIGHLIGHTS, line_items.HIGHLIGHT_WORDS), (line_items.MILLIONS, line_items.MILLION_WORDS), (line_items.THOUSANDS, line_items.THOUSAND_WORDS)]
    assert len(asked) == len(line_items.ALIAS_WORDS) + 3
    for pattern, words in asked:
        texts = texts_of(re._parser.parse(pattern))
        assert texts and all(any(w in t.lower() for w in words) for t in texts), pattern


def test_letters_that_patterns_take_for_others(spark):
    assert read(spark, "Income Statement\n\u017fales 12\nOTHER \u0130NCOME 3\nF\u0131nance cost 2") == {("unknown", "revenue"): 12, ("unknown", "other_income"): 3, ("unknown", "finance_cost"): 2}


def test_pages_are_read_once(spark):
    """What is made of the items leaves the grouping that they leave; no filter repeats how a line's figures are read."""
    df = spark.createDataFrame([("f", 1, "Income Statement\nRevenue 10\nGross profit 4", 2025)], "filing string, page_number int, text string, target_year int")
    out = line_items.promoted(df)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("RepartitionByExpression") == 1
    assert all(x.count("regexp_extract_all") <= 1 for x in plan.split("\n") if " Filter " in x)
    assert {r["item"]: r.value for r in out.collect()} == {"revenue": 10.0, "gross_profit": 4.0, "gross_margin_pct": 40.0}
