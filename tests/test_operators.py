from __future__ import annotations

from pyspark.sql import functions as F

from veridex.operators import constraints, dedup, joins, notices, ordered, repair, statements
from veridex.plans import metrics
from veridex.sources import readers, sinks


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_merge_latest_gives_ties_to_the_new(spark):
    old, new = spark.createDataFrame([(1, 5, "o"), (2, 9, "o")], "k int, t int, v string"), spark.createDataFrame([(1, 5, "n"), (2, 3, "n")], "k int, t int, v string")
    assert rows(dedup.merge_latest(old, new, ["k"], "t")) == [(1, 5, "n"), (2, 9, "o")]


def test_floor_median_is_the_upper_element(spark):
    df = spark.createDataFrame([("a", float(x)) for x in (4, 1, 3, 2)] + [("b", 7.0), ("b", None)], "k string, v double")
    assert rows(dedup.floor_median(df, ["k"], "v").select("k", "median")) == [("a", 3.0), ("b", 7.0)]


def test_as_of_gap(spark):
    left = spark.createDataFrame([("s", "2024-01-10"), ("s", "2024-03-01")], "k string, d string").withColumn("d", F.to_timestamp("d"))
    right = spark.createDataFrame([("s", "2024-01-05", 3.0)], "k string, d string, v double").withColumn("d", F.to_timestamp("d"))
    got = joins.as_of(left, right.withColumnRenamed("d", "t"), ["k"], "d", "t", "v", 10).orderBy("d").collect()
    assert [r.v for r in got] == [3.0, None]


def test_nested_running_totals(spark):
    v = [10.0, 20.0, 30.0, 5.0, 7.0, 12.0, 42.0]
    label = [None, "x", "", "x", "x", "total of x", "total"]
    df = spark.createDataFrame([(1, i, x, n) for i, (x, n) in enumerate(zip(v, label))], "t int, row int, v double, label string")
    got = [r.total_of for r in ordered.running_totals(df, ["t"], "row", "v", "label").orderBy("row").collect()]
    assert got == [None, None, 2, None, None, 2, 2]
    # an item is no total, whatever it equals
    got = [r.total_of for r in ordered.running_totals(df.withColumn("label", F.lit("item")), ["t"], "row", "v", "label").collect()]
    assert got == [None] * 7


def test_merge_split_rows_does_not_cascade(spark):
    df = spark.createDataFrame([(1, 1, "Long term", "5", None), (1, 2, "loans", None, "6"), (1, 3, "Cash", "1", "2")], "t int, o int, l string, a string, b string")
    assert rows(ordered.merge_split_rows(df, ["t"], "o", "l", "a", "b")) == [(1, 1, "Long term loans", "5", "6"), (1, 3, "Cash", "1", "2")]


def test_single_repair_needs_two_witnesses(spark):
    cells = spark.createDataFrame([("f", "a", "183", 183.0), ("f", "b", "20", 20.0), ("f", "t", "158", 158.0), ("f", "c", "7", 7.0), ("f", "u", "145", 145.0)], "filing string, cell string, raw string, value double")
    terms = [("t", "a", 1.0), ("t", "b", 1.0), ("t", "t", -1.0), ("u", "a", 1.0), ("u", "c", 1.0), ("u", "u", -1.0)]
    t = spark.createDataFrame([("f", c, x, s, 0.5, False) for c, x, s in terms], "filing string, constraint_id string, cell string, sign double, tolerance double, advisory boolean")
    got = repair.single_repairs(t, cells)
    assert rows(got.select("cell", "from", "to")) == [("a", 183.0, 138.0)]
    fixed = repair.apply_repairs(cells, got)
    assert rows(fixed.where("repaired").select("cell", "first_value", "value")) == [("a", 183.0, 138.0)]


def test_pair_repair(spark):
    cells = spark.createDataFrame([("f", "a", "18", 18.0), ("f", "b", "27", 27.0), ("f", "t", "35", 35.0), ("f", "u", "97", 97.0), ("f", "c", "84", 84.0), ("f", "v", "105", 105.0), ("f", "d", "83", 83.0)], "filing string, cell string, raw string, value double")
    # a is 13, b is 22: t = a + b, u = a + c, v = b + d
    terms = [("1", "a", 1.0), ("1", "b", 1.0), ("1", "t", -1.0), ("2", "a", 1.0), ("2", "c", 1.0), ("2", "u", -1.0), ("3", "b", 1.0), ("3", "d", 1.0), ("3", "v", -1.0)]
    t = spark.createDataFrame([("f", c, x, s, 0.5, False) for c, x, s in terms], "filing string, constraint_id string, cell string, sign double, tolerance double, advisory boolean")
    assert rows(repair.pair_repairs(t, cells).select("cell", "to")) == [("a", 13.0), ("b", 22.0)]


def test_identities_and_confirmation(spark):
    wide = spark.createDataFrame([("x", 100.0, 60.0, 40.0), ("y", 100.0, 60.0, 50.0)], "f string, revenue double, cost_of_sales double, gross_profit double")
    assert rows(constraints.check_identities(wide, ["f"]).select("f", "rule", "holds")) == [("x", "I1", True), ("y", "I1", False)]


def test_metrics_fill_and_blocked_sum(spark):
    wide = spark.createDataFrame([(12, 200.0, 150.0, 0.0)], "months int, revenue double, cost_of_sales double, total_assets double")
    r = metrics.ratios(metrics.fill(wide)).first()
    assert (r.gross_profit, r.gross_margin_pct, r.return_on_assets, r.float_shares) == (50.0, 25.0, None, None)
    figures = spark.createDataFrame([("f", "p", "a", 1.0), ("f", "p", "b", 2.0), ("g", "p", "a", 4.0)], "filing string, period string, item string, value double")
    drops = spark.createDataFrame([("f", "c")], "filing string, item string")
    assert rows(metrics.blocked_sum(figures, drops, ["period"], ["a", "b", "c"], "s").select("filing", "value")) == [("g", 4.0)]


def test_labels_follow_placement(spark):
    df = spark.createDataFrame([(1, 1, "balance", "ASSETS"), (1, 2, "balance", "Trade debts"), (1, 3, "balance", "Equity and liabilities"), (1, 4, "balance", "Trade and other payables"), (1, 5, "balance", "Total assets")], "t int, o int, statement string, text string")
    got = {r.o: r.item for r in statements.matched(statements.placed(df, ["t"], "o", "text")).collect()}
    assert got == {1: None, 2: "net_receivables", 3: None, 4: "accounts_payable", 5: "total_assets"}


def test_column_collisions_all_lose(spark):
    df = spark.createDataFrame([("f", 1, 1, "30 June 2023", "year ended"), ("f", 1, 2, "30 June 2022", "year ended"), ("f", 1, 3, "30-06-2022", "year ended")], "filing string, table_no int, col int, header string, title string")
    assert rows(statements.column_periods(df, F.lit(6)).select("col", F.col("period_end").cast("string"), "months")) == [(1, "2023-06-30", 12)]


def test_notices(spark):
    df = spark.createDataFrame([(1, "Board Meeting"), (2, "Board Meeting - revoked"), (3, "Disclosure of Interest by a Director"), (4, "Credit of Dividend"), (5, "Annual General Meeting"), (6, "Notice of Meeting of Board")], "id int, title string")
    assert {r.id: r.k for r in df.select("id", notices.notice_kind(F.col("title")).alias("k")).collect()} == {1: "meeting", 2: None, 3: "insider", 4: None, 5: None, 6: "meeting"}


def test_formats(spark):
    df = spark.createDataFrame([(bytearray(b"%PDF-1.4"), None, "a"), (bytearray(b"\x89PNG...."), None, "b"), (bytearray(b"PK\x03\x04...."), None, "c.xlsx"), (bytearray(b"<html>"), "text/html", "d"), (bytearray(b"a,b"), None, "e.csv"), (bytearray(b"?"), None, "f")], "c binary, t string, p string")
    assert [r[0] for r in df.select(readers.format_of(F.col("c"), F.col("t"), F.col("p"))).collect()] == ["pdf", "image", "sheet", "html", "csv", "unsupported"]


def test_layout_lines(spark):
    words = spark.createDataFrame([("f", 1, 10, 10, 40, 10, 90.0, "Cash"), ("f", 1, 100, 12, 20, 10, 80.0, "12"), ("f", 1, 10, 40, 40, 10, 70.0, "Debt")], "file string, page_num int, left int, top int, width int, height int, conf double, text string")
    got = readers.layout_lines(words, ["file"]).orderBy("line_no").collect()
    assert [r.line.split() for r in got] == [["Cash", "12"], ["Debt"]] and got[0].confidence == 85.0


def test_chunks_are_those_of_one_walk(spark):
    import random

    r = random.Random(4)
    sizes = [r.choice((0, 1, 5, 9, 30, 80)) for _ in range(400)]
    df = spark.createDataFrame([(i, "x" * n) for i, n in enumerate(sizes)], "id int, t string").repartition(5)
    for most, many, block in ((45, 3, 4), (1, 1000, 1000), (1000, 7, 16), (60, 60, 60), (10**6, 10**6, 16)):
        want, held, n, number = [], 0, 0, 0
        for size in sizes:
            if n and (held + size > most or n >= many):
                held, n, number = 0, 0, number + 1
            held, n = held + size, n + 1
            want.append(number)
        got = {x.id: x.chunk for x in sinks.chunks(df, ["id"], F.length("t"), most, many, block).collect()}
        assert [got[i] for i in range(len(sizes))] == want, (most, many, block)
    assert sinks.chunks(df.where("false"), ["id"], F.length("t"), 5, 5).count() == 0


def test_publish_and_records_round_trip(spark, tmp_path):
    r = spark.createDataFrame([("http://a",), ("http://b",)], "source_url string").select(
        F.substring(F.sha2("source_url", 256), 1, 32).alias("key"), F.lit(1).alias("corpus_version"), F.lit(1).alias("text_version"), "source_url", F.lit("S").alias("symbol"), F.current_timestamp().alias("extracted_at"),
        F.struct(F.lit("pdf").alias("kind")).alias("document"),
    )
    index = sinks.publish(r, str(tmp_path / "corpus"))
    assert index.count() == 2
    first = sinks.current_version(spark, str(tmp_path / "corpus"))
    good, bad = readers.records(spark, f"{first}/records")
    assert good.count() == 2 and bad.count() == 0
    # a new publication leaves the old one readable
    again = sinks.publish(r.where("source_url = 'http://a'"), str(tmp_path / "corpus"))
    assert again.count() == 1 and sinks.published_index(spark, str(tmp_path / "corpus")).count() == 1
    assert spark.read.parquet(f"{first}/index").count() == 2


def test_every_surveyed_label_has_a_rule(spark):
    from veridex.operators import statements

    balance = ["Equity and liabilities", "Share premium", "Reserves", "Treasury shares", "Current portion of lease liabilities", "Current portion of long term financing", "Deferred taxation", "Staff retirement benefits"]
    cash = ["Cash flows from operating activities", "Interest received", "Exchange gain", "Net cash generated from operating activities", "Cash flows from investing activities", "Purchase of investments", "Sale of investments"]
    cash += ["Net cash used in investing activities", "Cash flows from financing activities", "Repayment of lease liabilities", "Repayment of long term financing", "Net cash used in financing activities", "Exchange differences", "Effect of exchange rate changes"]
    rows = [(k, i, k, x) for k, xs in (("balance", balance), ("cash_flow", cash)) for i, x in enumerate(xs)]
    df = statements.placed(spark.createDataFrame(rows, "n string, row int, statement string, text string"), ["n"], "row", "text")
    got = {(r.n, r.row): r.item for r in statements.matched(df).collect()}
    assert [got["balance", i] for i in range(8)] == [None, "additional_paid_in_capital", "reserves", "treasury_stock", "current_portion_lease_liabilities", "current_portion_long_term_debt", "deferred_taxes", "employee_benefits"]
    assert [got["cash_flow", i] for i in range(14)] == [None, "cf_interest_income", None, "cash_from_operations", None, "purchase_of_investments", "sale_of_investments", "cash_from_investing", None, "lease_payments", "debt_repaid", "cash_from_financing", "fx_adjustments", "fx_adjustments"]


def test_shards_go_by_place_and_not_by_id(spark):
    import tempfile

    from veridex.operators import dedup
    from veridex.plans import catalog

    ids = [3 * i + (i > 40) for i in range(100)] + [9, 9, 9, 60, None, None]
    docs = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    want = sorted(ids, key=lambda i: (i is None, i or 0))
    for size in (1 << 14, 7):
        assert [r.doc_id for r in dedup.places(docs, "doc_id", size).orderBy("place").collect()] == want
        assert sorted(r.place for r in dedup.places(docs, "doc_id", size).collect()) == list(range(len(ids)))
    assert dedup.places(docs.where("false"), "doc_id").count() == 0
    with tempfile.TemporaryDirectory() as path:
        docs.write.parquet(f"{path}/documents.parquet")
        got = [r.doc_id for r in catalog.QUERIES["shard_filter"](spark, path).collect()]
    assert sorted(got, key=lambda i: (i is None, i or 0)) == want[2::5]


def test_submission_outcomes_and_first_version_payload(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("c", -1), ("d", None)], "id string, v int")
    known = spark.createDataFrame([("b",)], "id string")
    got = sorted((r.id, r.outcome) for r in sinks.outcomes(rows, known, F.col("v") > 0, ["id"]).collect())
    assert got == [("a", "accepted"), ("a", "duplicate"), ("b", "duplicate"), ("c", "rejected"), ("d", "rejected")]
    figures = spark.createDataFrame([("f", "income", "revenue", 1.0, 0.8, 2), ("f", "income", "revenue", 2.0, 0.9, 5), ("f", "income", "revenue", 3.0, 0.9, 4)], "filing string, statement string, item string, value double, confidence double, page int")
    import json

    payload = json.loads(sinks.payload_v1(figures, spark.createDataFrame([("f", "S", "x\0y")], "filing string, symbol string, title string")).first().payload)
    assert payload == {"schemaVersion": 1, "symbol": "S", "title": "xy", "statements": {"income": {"revenue": {"value": 3.0, "confidence": 0.9, "page": 4}}}}


def test_stage_dumps_and_item_guide(spark, tmp_path):
    sinks.stage_dump({"one": spark.range(3).withColumn("x", F.col("id") * 2)}, ["id"], str(tmp_path))
    assert spark.read.json(str(tmp_path / "one")).count() == 3
    guide = sinks.item_guide({"income": metrics.INCOME}, statements.LABEL_RULES)
    assert "| revenue | `" in guide and guide.count("\n| ") == 1 + len(metrics.INCOME)


def test_repairs_need_independent_witnesses_or_a_reading(spark):
    from veridex.operators import repair

    cells = spark.createDataFrame([("f", "a", "138", 138.0), ("f", "b", "20", 20.0), ("f", "t", "153", 153.0)], "filing string, cell string, raw string, value double")
    terms = spark.createDataFrame([("f", "T", c, s, 1.0, False) for c, s in (("a", 1.0), ("b", 1.0), ("t", -1.0))], "filing string, constraint_id string, cell string, sign double, tolerance double, advisory boolean")
    assert repair.single_repairs(terms, cells).count() == 0
    reading = spark.createDataFrame([("f", "a", 133.0, "ocr")], "filing string, cell string, value double, source string")
    got = repair.single_repairs(terms, cells, reading).collect()
    assert [(r.cell, r["from"], r.to) for r in got] == [("a", 138.0, 133.0)]
    # the text layer reads the first value again
    veto = spark.createDataFrame([("f", "a", 133.0, "ocr"), ("f", "a", 138.0, "pdftotext")], reading.schema)
    assert repair.single_repairs(terms, cells, veto).count() == 0
    # a copy of the constraint is no second witness
    twin = terms.withColumn("constraint_id", F.lit("U")).unionByName(terms)
    assert repair.single_repairs(twin, cells).count() == 0


def _table(spark, *columns, labels=None):
    """Rows of one table from its columns, the same labels for all."""
    n = len(columns[0])
    cells = [[(c[i], c[i] is not None) for c in columns] for i in range(n)]
    return spark.createDataFrame([(1, i, (labels or {}).get(i, "item"), True, x) for i, x in enumerate(cells)], "t int, place int, label string, amount boolean, cells array<struct<value: double, printed: boolean>>")


def test_a_total_stands_though_one_column_is_misread(spark):
    from veridex.operators import totals

    rows_ = _table(spark, [1000.0, 2000.0, 3000.0], [1000.0, 2500.0, 3000.0], [10.0, 20.0, 30.0], labels={2: ""})
    got = totals.total_constraints(rows_, ["t"])
    assert rows(got.select("column", "total", "parts", "advisory")) == [(c, 2, [0, 1], False) for c in range(3)]
    terms = totals.total_terms(got, ["t"], 1000.0).where("column = 1")
    assert rows(terms.select("place", "sign", "tolerance")) == [(0, 1.0, 1500.0), (1, 1.0, 1500.0), (2, -1.0, 1500.0)]


def test_ambiguous_and_contested_totals_are_none(spark):
    from veridex.operators import totals

    # each column explains a run that the other does not
    two = _table(spark, [500.0, 1000.0, 2000.0, 3000.0], [1000.0, 1000.0, 2000.0, 4000.0], labels={3: ""})
    assert totals.total_constraints(two, ["t"]).count() == 0
    # a nil at the edge of the run lets a shorter one balance in one column: the longer explains both
    edge = _table(spark, [0.0, 1000.0, 2000.0, 3000.0], [500.0, 1000.0, 2000.0, 3500.0], labels={3: ""})
    assert rows(totals.total_constraints(edge, ["t"]).select("column", "parts")) == [(0, [0, 1, 2]), (1, [0, 1, 2])]
    # two totals claim the second row: the one that more columns bear out keeps it
    rival = _table(spark, [1000.0, 2000.0, 3000.0, 900.0, 9999.0], [1000.0, 2000.0, 3000.0, 900.0, 9999.0], [700.0, 2000.0, 9000.0, 900.0, 2900.0 + 9000.0], labels={2: "", 4: ""})
    assert rows(totals.total_constraints(rival, ["t"]).select("column", "total")) == [(c, 2) for c in range(3)]


def test_parts_that_no_column_tested_and_rows_within(spark):
    from veridex.operators import totals

    # the third part is nil where the run adds up, so where it has a figure nothing is said
    nil = _table(spark, [1000.0, 2000.0, 0.0, 3000.0], [1000.0, 2000.0, 7.0, 3000.0], labels={3: ""})
    assert rows(totals.total_constraints(nil, ["t"]).select("column", "total")) == [(0, 3)]
    # a row that only the second column prints would belong to its sum
    more = _table(spark, [1000.0, None, 2000.0, 3000.0], [1000.0, 50.0, 2000.0, 9999.0], [10.0, None, 20.0, 30.0], labels={3: ""})
    assert rows(totals.total_constraints(more, ["t"]).select("column", "parts")) == [(0, [0, 2]), (2, [0, 2])]
    assert totals.total_constraints(more.where("false"), ["t"]).count() == 0


def test_a_heading_speaks_for_a_total_that_no_column_proves(spark):
    from veridex.operators import totals

    base = _table(spark, [50.0, 1000.0, 2000.0, 5000.0], labels={3: "total current assets"})
    d = base.withColumn("under", F.when(F.col("place") < 3, "current_assets")).withColumn("closes", F.when(F.col("place") == 3, "current_assets")).withColumn("skip", F.col("place") == 0)
    assert rows(totals.total_constraints(d, ["t"]).select("total", "parts", "advisory")) == [(3, [1, 2], True)]


_CELLS, _TERMS = "filing string, cell string, raw string, value double", "filing string, constraint_id string, cell string, sign double, tolerance double, advisory boolean"


def test_an_unreadable_cell_is_solved_from_two_constraints(spark):
    cells = spark.createDataFrame([("f", "a", "##", None), ("f", "b", "20", 20.0), ("f", "t", "153", 153.0), ("f", "c", "7", 7.0), ("f", "u", "140", 140.0)], _CELLS)
    t = [("t", "a", 1.0), ("t", "b", 1.0), ("t", "t", -1.0), ("u", "a", 1.0), ("u", "c", 1.0), ("u", "u", -1.0)]
    terms = spark.createDataFrame([("f", c, x, s, 1.0, False) for c, x, s in t], _TERMS)
    assert rows(repair.single_repairs(terms, cells).select("cell", "from", "to")) == [("a", None, 133.0)]
    # one constraint alone is no proof of what it solves
    assert repair.single_repairs(terms.where("constraint_id = 't'"), cells).count() == 0
    # printed to the cent
    cents = cells.withColumn("value", F.col("value") / 100).withColumn("decimals", F.lit(2))
    fine = terms.withColumn("tolerance", F.lit(0.01))
    assert rows(repair.single_repairs(fine, cents).select("cell", "to")) == [("a", 1.33)]


def test_repairs_of_two_clusters_that_break_a_third_constraint_are_withdrawn(spark):
    """x and y are each mended within the room of a constraint that holds; both together leave it."""
    t = []
    for x, cluster in (("x", "A"), ("y", "B")):
        t += [(f"{cluster}1", x, 1.0), (f"{cluster}1", f"{x}1", -1.0), (f"{cluster}2", x, 1.0), (f"{cluster}2", f"{x}2", -1.0), (f"{cluster}2", f"{x}3", -1.0)]
    both = [("H", "x", 1.0), ("H", "y", 1.0), ("H", "h", -1.0)]
    terms = spark.createDataFrame([("f", c, v, s, 0.4, False) for c, v, s in t] + [("f", c, v, s, 12.0, False) for c, v, s in both], _TERMS)
    figures = {"x": 138.0, "x1": 128.0, "x2": 100.0, "x3": 28.0, "y": 238.0, "y1": 228.0, "y2": 200.0, "y3": 28.0, "h": 374.0}
    cells = spark.createDataFrame([("f", k, str(int(v)), v) for k, v in figures.items()], _CELLS)
    reading = spark.createDataFrame([("f", "x", 128.0, "ocr"), ("f", "y", 228.0, "ocr")], "filing string, cell string, value double, source string")
    assert repair.single_repairs(terms, cells, reading).count() == 0
    one = repair.single_repairs(terms, cells.withColumn("value", F.when(F.col("cell") == "y1", 238.0).when(F.col("cell") == "y2", 210.0).otherwise(F.col("value"))), reading.where("cell = 'x'"))
    assert rows(one.select("cell", "to")) == [("x", 128.0)]
    # without the constraint between them both stand
    assert rows(repair.single_repairs(terms.where("constraint_id <> 'H'"), cells, reading).select("cell", "to")) == [("x", 128.0), ("y", 228.0)]


def test_uncaptioned_totals_by_heading_and_of_taxes(spark):
    lines = [
        ("balance", 0, "ASSETS", None, ["ASSETS", "NON-CURRENT ASSETS"]), ("balance", 1, "Property", [1000.0, 900.0], None), ("balance", 2, "Goodwill", [500.0, None], None), ("balance", 3, "", [1500.0, 900.0], None),
        ("balance", 4, "Deposits", [50.0, 40.0], None), ("balance", 5, "", [1550.0, 7.0], None), ("balance", 6, "Stock", [10.0, 20.0], ["CURRENT ASSETS"]), ("balance", 7, "Cash", [5.0, 6.0], None), ("balance", 8, "", [99.0, 26.0], None), ("balance", 9, "", [4.0, 4.0], None),
        ("income", 0, "Profit before taxation", [100.0, 90.0], None), ("income", 1, "Taxation - current", [10.0, 9.0], None), ("income", 2, "Taxation - prior", [1.0, 1.0], None), ("income", 3, "", [11.0, 10.0], None), ("income", 4, "", [89.0, 80.0], None),
    ]
    d = spark.createDataFrame(lines, "statement string, place int, text string, values array<double>, headings array<string>").where("values is not null or place > 0")
    d = d.withColumn("headings", F.when((F.col("statement") == "balance") & (F.col("place") == 1), F.array(F.lit("ASSETS"), F.lit("NON-CURRENT ASSETS"))).otherwise(F.col("headings")))
    got = statements.uncaptioned_totals(statements.matched(statements.placed(d, ["statement"], "place", "text", "headings")), ["statement"], "place")
    found = {(r.statement, r.place): r["items"] for r in got.where("label = ''").collect()}
    # the first sum under a heading is a subtotal where a later one closes it too
    assert found == {("balance", 3): None, ("balance", 5): ["total_non_current_assets"], ("balance", 8): ["total_current_assets"], ("balance", 9): None, ("income", 3): ["taxation"], ("income", 4): None}
