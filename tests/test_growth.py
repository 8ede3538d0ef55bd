"""Steps whose work is to grow with their input alone."""

from __future__ import annotations

from pyspark.sql import functions as F

from veridex.functions.num import figure
from veridex.operators import alignment, grids, line_items, ordered, pages, relations, repair, totals
from veridex.sources.dealt import dealt


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_candidates_are_never_shuffled(spark):
    cells = spark.createDataFrame([(1, "0381", 381.0), (1, "0381", 381.0), (2, "17", 17.0), (3, None, None)], "k int, raw string, value double")
    out = repair.candidates(cells)
    plan = _plan(out)
    assert "Generate" in plan and "Aggregate" not in plan[: plan.index("Generate")] and "Repartition" not in plan[: plan.index("Generate")]
    rows = out.collect()
    assert len(rows) == len(set(rows)) and {r.k for r in rows} == {1, 2} and {11.0, 47.0, 71.0, -17.0, 7.0} <= {r.candidate for r in rows if r.k == 2}


def test_running_totals_of_tables_over_several_batches(spark):
    """Tables of 1, 4 and 30 rows in batches of 7; a table without a key is a table too, and rows without a place come last."""
    rows = [(k, i, float(v), "a") for k, n in (("x", 3), ("y", 29), (None, 3)) for i, v in enumerate(range(1000, 1000 + n))]
    rows += [(k, 50, float(sum(range(1000, 1000 + n))), "") for k, n in (("x", 3), ("y", 29), (None, 3))] + [("z", 1, 5.0, ""), ("x", None, 33.0, "a")]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        df = spark.createDataFrame(rows, "k string, at int, v double, label string").repartition(3)
        out = ordered.running_totals(df, ["k"], "at", "v", "label")
        got = {(r.k, r["at"]): r.total_of for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == len(rows) and {k: n for k, n in got.items() if n} == {("x", 50): 3, ("y", 50): 29, (None, 50): 3}
    assert out.columns == [*df.columns, "total_of"] and "FlatMapGroups" not in _plan(out)


def test_pages_are_read_many_to_a_batch(spark):
    """A page without lines and lines without a page, and a key that is null, beside one that is read."""
    rows = spark.createDataFrame([(f, 0, 1, 0, "r0", "trade debts", c, x) for f in ("a", "b", None) for c, x in ((0, "1,000"), (1, "2,000"))], "filing string, table_no int, page int, row_ord int, row_id string, label string, col int, raw string")
    lines = spark.createDataFrame([(f, 0, 1, "ocr-300", 0, "Trade debts   1,000   2,000") for f in ("a", "c", None)], "filing string, table_no int, page int, source string, line_no int, text string")
    out = alignment.pass_readings(rows, lines)
    assert "CoGroup" not in _plan(out)
    assert sorted(((r.filing or "", r.col, r.value) for r in out.collect())) == [("", 0, 1000.0), ("", 1, 2000.0), ("a", 0, 1000.0), ("a", 1, 2000.0)]


def test_aliases_are_one_case_over_pages_dealt_once(spark):
    pages = spark.createDataFrame([(1, 1, "Balance Sheet\nTotal assets 5", 2025)], "filing int, page_number int, text string, target_year int")
    plan = _plan(line_items.candidates(pages))
    assert plan.count("RepartitionByExpression") == 1 and plan.count("ELSE CASE") < 10
    assert [(r["item"], r.value) for r in line_items.candidates(pages).collect()] == [("total_assets", 5.0)]


def test_grids_are_shuffled_once(spark):
    """Cells that are dealt out by filing are not shuffled again, whatever is found of tables, columns and rows."""
    cells = [(f, 1, 0, r, c, 1, x, r == 0) for f in (1, 2) for r, line in enumerate((("", "2024", "2023"), ("Stock in trade", "1,000", "-"), ("Total", "(7)", "Nil"))) for c, x in enumerate(line)]
    df = spark.createDataFrame(cells, "filing int, page int, table_no int, row int, col int, col_span int, text string, column_header boolean")
    rows = grids.statement_rows(dealt(df, "filing"), headers=False)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    assert sorted((r.filing, r.label, r["values"]) for r in rows.collect()) == [(f, k, v) for f in (1, 2) for k, v in (("Stock in trade", [1000.0, 0.0]), ("Total", [-7.0, 0.0]))]
    assert {tuple(r.headers) for r in grids.statement_rows(df).collect()} == {("2024", "2023")}


def test_figures_without_patterns_are_those_with_them(spark):
    """The short ways of a figure give what the whole one gives."""
    texts = {"1,234,567": 1234567.0, "12,34": 1234.0, "0012": 12.0, "-": 0.0, "N i l": 0.0, "-NIL-": 0.0, "Nile": None, "1,234a": None, "1,234,": None, "1,2345": None, "(1,234)": -1234.0, "1 234": None, "1,234\n": 1234.0, "": None}
    got = spark.createDataFrame([(t,) for t in [*texts, None]], "t string").select("t", figure(F.col("t")).alias("v")).collect()
    assert {r.t: r.v for r in got} == {**texts, None: None}


def test_printed_lines_are_joined_with_nothing(spark):
    """Headings reach their rows within the filing's own lines."""
    text = "CURRENT ASSETS   Note   2024\nOther payables\nof the company\n       1,000   2,000\nRevenue  7  1,000  -   Cost of sales  8  (5)"
    rows = pages.line_rows(dealt(spark.createDataFrame([("a", 1, text), ("b", 1, "words alone")], "filing string, page_number int, text string"), "filing"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1
    got = [(r.line_no, r.segment, r.caption, r.leading, r.numbers, r.headings) for r in rows.orderBy("line_no", "segment").collect()]
    assert got == [
        (0, 0, "CURRENT ASSETS Note", [], ["2024"], []), (3, 0, "of the company", ["1,000", "2,000"], [], ["Other payables", "of the company"]),
        (4, 0, "Revenue", [], ["7", "1,000", "-"], []), (4, 1, "Cost of sales", [], ["8", "(5)"], []),
    ]


def test_pairs_of_an_item_are_not_joined(spark):
    rows = [("a", "x", 1, 2.0, 10.0), ("a", "x", 2, 15.0, 1.0), ("a", "x", 3, 1.0, 1.0), ("a", "x", 3, 2.0, 1.0), ("a", "y", 1, 1.0, 1.0), ("b", "x", 4, 7.0, 1.0), ("b", "x", 5, None, 1.0)]
    out = relations.repeated_items(spark.createDataFrame(rows, "filing string, item string, table_no int, value double, scale double"), ["filing"])
    assert "Join" not in _plan(out) and [tuple(r) for r in out.collect()] == [("a", "x", 1, 2, 5.0)]


def test_tables_of_totals_are_sorted_without_a_comparator(spark):
    """Tables of a batch are made lists by column; a null cell stays one."""
    rows = [(k, i, label, True, [(v, v is not None)]) for k in ("a", "b") for i, (label, v) in enumerate((("x", 400.0), ("y", None), ("z", 300.0), ("total", 700.0)))]
    out = totals.total_constraints(spark.createDataFrame(rows, "k string, place int, label string, amount boolean, cells array<struct<value:double,printed:boolean>>"), ["k"])
    assert "lambda" not in _plan(out) and sorted((r.k, r.column, r.total, r.parts) for r in out.collect()) == [("a", 0, 3, [0, 2]), ("b", 0, 3, [0, 2])]


def test_filings_are_searched_many_to_a_batch(spark):
    """Two wrong figures are found among filings that share a batch, one of them by another reading; a filing without cells finds none."""
    # a + b = s, a - b = d, a + 2 b = e, where a and b are misread
    terms = [(f, c, x, s, 1.0, False) for f in ("f", "g", "h") for c, of in (("s", (("a", 1.0), ("b", 1.0), ("s", -1.0))), ("d", (("a", 1.0), ("b", -1.0), ("d", -1.0))), ("e", (("a", 1.0), ("b", 2.0), ("e", -1.0)))) for x, s in of]
    cells = [(f, x, raw, float(raw)) for f, a, b in (("f", "1800", "2800"), ("g", "1800", "7777")) for x, raw in (("a", a), ("b", b), ("b", b), ("s", "3800"), ("d", "-1200"), ("e", "6300"))]
    readings = [("g", "b", 2500.0, "ocr"), ("h", "a", 1.0, "ocr"), ("z", "a", 1.0, "ocr")]
    frames = spark.createDataFrame(terms, "filing string, constraint_id string, cell string, sign double, tolerance double, advisory boolean"), spark.createDataFrame(cells, "filing string, cell string, raw string, value double")
    out = repair.pair_repairs(*frames)
    assert "Group" not in _plan(out)
    got = lambda df: sorted((r.filing, r.cell, r["from"], r.to) for r in df.collect())
    assert got(out) == [("f", "a", 1800.0, 1300.0), ("f", "b", 2800.0, 2500.0)]
    read = spark.createDataFrame(readings, "filing string, cell string, value double, source string")
    assert got(repair.pair_repairs(*frames, read)) == [("f", "a", 1800.0, 1300.0), ("f", "b", 2800.0, 2500.0), ("g", "a", 1800.0, 1300.0), ("g", "b", 7777.0, 2500.0)]


def test_candidates_of_single_repairs_are_tried_where_they_are_made(spark, monkeypatch):
    """Of a read cell only what mends its open constraints is kept; an unread one keeps all, so that it is not solved beside its readings."""
    counts, kept = {}, repair.written
    monkeypatch.setattr(repair, "written", lambda df, name: counts.setdefault(name, kept(df, name)))
    terms = [(f, c, x, s, 1.0, False) for f in ("f", "g") for c, of in (("s", (("a", 1.0), ("b", 1.0), ("s", -1.0))), ("d", (("a", 1.0), ("d", -1.0)))) for x, s in of]
    cells = [(f, x, raw, v) for f, a, v in (("f", "1800", 1800.0), ("g", "18OO", None)) for x, raw, v in (("a", a, v), ("b", "500", 500.0), ("s", "1800", 1800.0), ("d", "1300", 1300.0))]
    out = repair.single_repairs(spark.createDataFrame(terms, "filing string, constraint_id string, cell string, sign double, tolerance double, advisory boolean"), spark.createDataFrame(cells, "filing string, cell string, raw string, value double"))
    assert sorted((r.filing, r.cell, r["from"], r.to) for r in out.collect()) == [("f", "a", 1800.0, 1300.0), ("g", "a", None, 1300.0)]
    assert [(r.cell, r.candidate) for r in counts["repair-tries"].where("filing = 'f'").collect()] == [("a", 1300.0)]


def test_nested_totals_are_followed_within_their_filing(spark, monkeypatch):
    """Pairs and what identities leave out come from one dealing of a filing, without joins or tables; a deep chain, a cycle, nulls."""
    monkeypatch.setattr(relations, "written", None)
    chain = [("a", i, i + 1) for i in range(1, 70)] + [("a", 1, 2), ("b", 1, 2), ("b", 2, 1), ("b", 3, 3), (None, 1, 2), (None, 2, 3), ("c", 1, None)]
    parts = spark.createDataFrame(chain, "filing string, total long, part long")
    tree = relations.descendants(parts, ["filing"])
    assert "Join" not in _plan(tree)
    got = sorted((r.filing or "", r.row, r.part) for r in tree.collect())
    assert got == sorted([("a", i, j) for i in range(1, 71) for j in range(i, 71)] + [("b", i, j) for i in (1, 2) for j in (1, 2)] + [("", 1, 1), ("", 1, 2), ("", 2, 2), ("", 2, 3), ("", 3, 3)])
    rows = spark.createDataFrame([(f, "B1", r, "x", 5.0) for f in ("a", None) for r in (1, 5, 70, 99, None)] + [("a", None, 5, "x", 5.0), ("a", "B1", 98, "authorised capital", 5.0), ("a", "B2", 5, "x", 5.0), ("a", "B1", 97, "x", 0.4)], "filing string, identity string, row long, label string, value double")
    cells = spark.createDataFrame([("a", "B1", 5), (None, "B1", 5), ("a", None, 5), ("a", "B2", 200)], "filing string, identity string, row int")
    out = relations.unaccounted(rows, cells, parts, ["filing"], "identity")
    assert "Join" not in _plan(out) and out.columns == ["filing", "identity", "row"]
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, [("a", "B1", 99), ("a", "B1", None), ("a", None, 5), ("a", "B2", 5), *((None, "B1", r) for r in (1, 5, 70, 99, None))]))


def test_runs_across_columns_meet_within_their_filing(spark, monkeypatch):
    """Runs, cells and columns are dealt out once; a nil row above a run counts as far as a row with a figure, unless another run takes it."""
    monkeypatch.setattr(relations, "written", None)
    first = {1: 0.0, 2: 7.0, 3: 5.0, 4: 6.0, 5: 11.0}
    cells = [(f, r, r, c, v if c == "a" else v + (9.0 if r == 5 else 0.0)) for f in ("f", "g", "h", None) for r, v in first.items() for c in ("a", "b")]
    cells += [("g", 9, 2.5, "a", 0.0), ("g", 9, 2.5, "b", 4.0)]  # nil, directly above the run
    cells += [("h", 9, 3.5, "a", None), ("h", 9, 3.5, "b", 4.0), ("h", 10, 20.0, "a", 1.0)]  # inside it, but taken by another run
    frame = spark.createDataFrame([(f, r, float(p), c, v) for f, r, p, c, v in cells], "filing string, row int, place double, column string, value double")
    runs = spark.createDataFrame([(f, "a", 5, [3, 4]) for f in ("f", "g", "h", None)] + [("h", "a", 10, [9]), ("f", "z", 5, [3])], "filing string, column string, total int, parts array<int>")
    kept = spark.createDataFrame([(f, c) for f in ("f", "g", "h", None) for c in ("a", "b")], "filing string, column string")
    out = relations.cross_column_failures(runs, frame, kept, ["filing"])
    assert "Join" not in _plan(out) and out.columns == ["filing", "total", "column", "in_column", "residual"]
    assert sorted(map(tuple, out.collect())) == [("f", 5, "a", "b", -9.0), ("h", 5, "a", "b", -9.0)]


def test_leases_use_the_state_once_a_batch():
    """Messages to the state and to timers do not grow with the requests of a task; what is told and left is as by single requests."""
    from pyspark.sql import Row

    from veridex.streaming.leases import _Leases

    class Handle:
        def __init__(self):
            self.value, self.timers, self.n = None, set(), 0

        def getValueState(self, name, schema):
            return self

        def get(self):
            self.n += 1
            return self.value

        def exists(self):
            self.n += 1
            return self.value is not None

        def update(self, value):
            self.n, self.value = self.n + 1, value

        def clear(self):
            self.n, self.value = self.n + 1, None

        def registerTimer(self, at):
            self.n += 1
            self.timers.add(at)

        def deleteTimer(self, at):
            self.n += 1
            self.timers.remove(at)

    def told(batches):
        handle = Handle()
        leases = _Leases(10)
        leases.init(handle)
        out = [tuple(r) for rows in batches for r in leases.handleInputRows(("t",), iter(rows), None)]
        return out, handle

    # claims and results, some after the end of the lease before them, some at it
    at = [0, 3, 5, 5, 15, 15, 26, 30, 36, 36, 50, 51, 52, 52, 70]
    rows = [Row(millis=a, event_id=i, kind="result" if i % 3 == 2 else "claim") for i, a in enumerate(at)]
    together, one = told([rows[::-1]])
    singly, other = told([[r] for r in rows])
    assert together == singly and {o for _, _, _, o in together} == {"granted", "busy", "accepted", "lease_lost", "expired"}
    assert (one.value, one.timers) == (other.value, other.timers) and one.n <= 4 < other.n


def test_cells_pass_few_windows(spark):
    """Each window copies every cell of a table: what one step needs of a table or a column is one window."""
    import re

    cells = spark.createDataFrame([(1, 1, 0, 0, 0, 1, "x", False)], "filing int, page int, table_no int, row int, col int, col_span int, text string, column_header boolean")
    plan = _plan(grids.statement_rows(dealt(cells, "filing"), headers=False))
    below = plan[plan.index("\n", plan.index("Aggregate [filing")) :]
    assert len(re.findall(r"Window \[", below)) <= 7
