"""Queries of the table, page and relation operators over statements printed from the driver tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import alignment, constraints, grids, line_items, notices, pages, readings, relations, repair, statements, totals
from ..sources.dealt import dealt
from ..sources.scratch import written
from . import filings, metrics
from .catalog import query


def _pick(key: Column, values: list) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), F.pmod(key, F.lit(len(values))).cast("int"))


def _values(rows: list[tuple]) -> str:
    """SQL VALUES of Python rows."""
    one = lambda v: "NULL" if v is None else str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"
    return ", ".join("(" + ", ".join(map(one, r)) + ")" for r in rows)


def _each(schema: str, *rows: tuple) -> Column:
    """One row for each tuple of values or columns, of a schema like "a int, b string"."""
    fields = [f.split() for f in schema.split(", ")]
    column = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.explode(F.array(*[F.struct(*[column(v).cast(kind).alias(name) for v, (name, kind) in zip(row, fields)]) for row in rows])).alias("x")


# ---- printed lines and pages ---------------------------------------------------------------------------------------

def _orders(t) -> DataFrame:
    """Orders dealt out by key: each becomes pages to parse, and a file of them would be few tasks."""
    return dealt(t("orders"), "o_orderkey")


_PAGE = """CURRENT ASSETS   Note   2024
Stock in trade - net   9   {n}   (500)
Deferred income and
other payables of the company
          {n}   3,000
REVENUE 24 {n} 7%   Profit for the year   -   (12.5)
{n}  1,000  Issued for cash  5  6
a line of words"""


@query("""
WITH o AS (SELECT o_orderkey AS filing, format('{:,}', CAST(o_orderkey AS BIGINT)) AS n FROM orders)
SELECT filing, CAST(x.line_no AS INTEGER) AS line_no, CAST(x.segment AS INTEGER) AS segment, x.caption, replace(x.f, 'n', n) AS leading_figures, replace(x.numbers, 'n', n) AS numbers, x.headings FROM o, (VALUES
 (0, 0, 'CURRENT ASSETS Note', '', '2024', ''), (1, 0, 'Stock in trade - net', '', '9;n;(500)', ''), (4, 0, 'other payables of the company', 'n;3,000', '', 'Deferred income and;other payables of the company'),
 (5, 0, 'REVENUE', '', '24;n;7%', ''), (5, 1, 'Profit for the year', '', '-;(12.5)', ''), (6, 0, 'Issued for cash', 'n;1,000', '5;6', '')) x(line_no, segment, caption, f, numbers, headings)""")
def printed_rows(t):
    """A page of each order, split into captions with their figures."""
    text = F.replace(F.lit(_PAGE), F.lit("{n}"), F.format_number(F.col("o_orderkey"), 0))
    rows = pages.line_rows(_orders(t).select(F.col("o_orderkey").alias("filing"), F.lit(1).alias("page_number"), text.alias("text")))
    joined = {"leading_figures": F.array_join("leading", ";"), "numbers": F.array_join("numbers", ";"), "headings": F.array_join("headings", ";")}
    return rows.select("filing", "line_no", F.col("segment").cast("int").alias("segment"), "caption", *[v.alias(c) for c, v in joined.items()])


#: Heading lines of a page, with the statement and basis that its title names.
_TITLES = [
    ("UNCONSOLIDATED CONDENSED INTERIM STATEMENT OF PROFIT OR LOSS", "income", "unconsolidated"),
    ("Consolidated Balance Sheet as at June 30, 2025", "balance", "consolidated"),
    ("ACME MILLS LIMITED STATEMENT OF CASH FLOWS FOR THE YEAR ENDED", "cash_flow", None),
    ("statement of profit or loss, the statement of changes in equity and", None, None),
    ("Statement of Comprehensive Income", None, None),
    ("ANNUAL REPORT 2025 Separate Statement of Financial Position (Un-audited)", "balance", "unconsolidated"),
    ("STATEMENT OF FINANCIAL OF FINANCIAL POSITION POSITION", "balance", None),
    ("Cash flow statement prepared", None, None),
    ("Directors' report", None, None),
]


@query(f"SELECT o_orderkey AS filing, x.kind, x.basis FROM orders JOIN (VALUES {_values([(i, k, b) for i, (_, k, b) in enumerate(_TITLES)])}) x(i, kind, basis) ON o_orderkey % {len(_TITLES)} = x.i WHERE x.kind IS NOT NULL")
def statement_titles(t):
    text = F.concat(_pick(F.col("o_orderkey"), [x for x, _, _ in _TITLES]), F.lit("\n\n2025   2024"))
    return pages.titles(_orders(t).select(F.col("o_orderkey").alias("filing"), F.lit(1).alias("page_number"), text.alias("text"))).select("filing", "kind", "basis")


@query("""
SELECT o_orderkey AS filing, x.kind, CAST(CASE WHEN x.kind = 'income' THEN 0 ELSE 38 + o_orderkey % 7 END AS INTEGER) AS lo, CAST(CASE WHEN x.kind = 'income' THEN 38 + o_orderkey % 7 ELSE 10000 END AS INTEGER) AS hi,
 CASE WHEN x.kind = 'income' THEN 'Revenue  5' ELSE 'Assets  7' END AS line FROM orders, (VALUES ('income'), ('balance')) x(kind)""")
def side_by_side(t):
    """Two statements beside each other, the second a few characters further right from order to order; the line below is cut to each."""
    at = (40 + F.col("o_orderkey") % 7).cast("int")
    head = F.concat(F.rpad(F.lit("  Statement of profit or loss"), at, " "), F.lit("Balance Sheet"))
    body = F.concat(F.rpad(F.lit("Revenue  5"), at, " "), F.lit("Assets  7"))
    d = _orders(t).select(F.col("o_orderkey").alias("filing"), F.lit(1).alias("page_number"), F.concat(head, F.lit("\n"), body).alias("text"))
    cut = pages.side_columns(pages.title_offsets(d)).join(d, ["filing", "page_number"])
    return cut.select("filing", "kind", "lo", "hi", F.trim(F.split(pages.cropped(F.col("text"), F.col("lo"), F.col("hi")), "\n")[1]).alias("line"))


@query("""
SELECT o_orderkey AS filing, x.topic, CASE WHEN x.topic = 'stock_in_trade' THEN CAST(o_orderkey % 80 + 1 AS VARCHAR) ELSE x.number END AS number, CASE x.topic WHEN 'fixed_assets' THEN 3 ELSE 2 END AS page_number
FROM orders, (VALUES ('share_capital', '6.1'), ('stock_in_trade', NULL), ('fixed_assets', '14')) x(topic, number)""")
def note_numbers(t):
    """Notes cited beside the captions of a balance sheet, found again by their headings; one topic is cited nowhere."""
    k = (F.col("o_orderkey") % 80 + 1).cast("string")
    sheet = F.concat(F.lit("Issued, subscribed and paid-up capital   6.1   1,000,000   900,000\nStock-in-trade - net  "), k, F.lit("  6,617,315\nInventory  99  1,000,000\nFixed assets of no number"))
    first = F.concat(F.lit("words of another note or for      "), k, F.lit("   STOCK-IN-TRADE - net\n6.1  ISSUED, SUBSCRIBED\n88  Stock in trade again"))
    d = _orders(t).select(F.col("o_orderkey").alias("filing"), F.lit("unconsolidated").alias("basis"), _each("page_number int, text string", (1, sheet), (2, first), (3, "14. Property, plant and equipment\n15 Dividends of the year"))).select("filing", "basis", "x.*")
    found = pages.note_headings(d.where("page_number > 1"), pages.note_references(d.where("page_number = 1")))
    return found.where("topic <> 'dividends'").select("filing", "topic", "number", "page_number")


@query("""
WITH p AS (SELECT source AS filing, doc_id AS page_number, length(trim(text)) < 400 AS sparse FROM documents), n AS (SELECT filing FROM p GROUP BY 1 HAVING count(*) FILTER (sparse) > 1)
SELECT filing, page_number, row_number() OVER (PARTITION BY filing ORDER BY page_number) AS subset_number FROM p SEMI JOIN n USING (filing) WHERE sparse""")
def scanned_subset(t):
    """Sparse pages of the sources that have several, sent away as a subset and numbered back."""
    d = t("documents").select(F.col("source").alias("filing"), F.col("doc_id").alias("page_number"), "text")
    sparse = d.where(F.length(F.trim("text")) < 400)
    needed = sparse.groupBy("filing").agg(F.count("*").alias("n")).where("n > 1")
    numbers = pages.subset(pages.pages_to_scan(d, needed=needed, least=400))
    read = numbers.select("filing", F.col("subset_number").cast("int").alias("subset_number"), (F.col("subset_number") * 1).alias("kept"))
    return pages.restored(read, numbers).select("filing", "page_number", F.col("kept").alias("subset_number"))


@query("SELECT conv_id AS id, string_agg(text, chr(10) || chr(10) ORDER BY turn, text) AS text FROM conversations WHERE trim(text) <> '' GROUP BY 1")
def notice_pages(t):
    return pages.notice_text(t("conversations").select(F.col("conv_id").alias("id"), F.col("turn").alias("page_number"), "text"))


# ---- tables from grids ---------------------------------------------------------------------------------------------


def _lines(t) -> DataFrame:
    """Lines of each order by place, from 1; dealt out by order, so that what is done by order needs no further shuffle."""
    lines = dealt(t("lineitem").select(F.col("l_orderkey").alias("filing"), "l_linenumber", F.floor("l_extendedprice").cast("long").alias("v")), "filing")
    v = lines.groupBy("filing").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "v"))).v.alias("v"))
    return v.select("filing", F.posexplode("v").alias("at", "v")).select("filing", (F.col("at") + 1).alias("n"), "v")


_SQL_LINES = "l AS (SELECT l_orderkey AS filing, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_extendedprice) AS n, CAST(floor(l_extendedprice) AS BIGINT) AS v FROM lineitem)"


def _cells(t, right: bool = False) -> DataFrame:
    """A grid of each order: a merged header of years, a heading every second line, lines with a note and two figures."""
    cell = lambda row, col, text, span=1, header=False: F.struct((F.lit(row) if isinstance(row, int) else row).cast("int").alias("row"), F.lit(col).alias("col"), F.lit(span).alias("col_span"), text.alias("text"), F.lit(header).alias("column_header"))
    tops = [cell(0, 0, F.lit("ASSETS"), header=True), cell(0, 1, F.lit("Note")), cell(0, 2, F.lit("2024 2023 (Rupees)"), 2, True), cell(1, 3, F.lit("restated"), header=True)]
    row = 2 * F.col("n")
    body = [cell(row, 0, F.concat(F.lit("heading "), F.col("n"))), cell(row + 1, 0, F.concat(F.lit("Line  "), F.col("n"))), cell(row + 1, 1, F.col("n").cast("string")), cell(row + 1, 2, F.format_number("v", 0)), cell(row + 1, 3, F.lit("-"))]
    # the header comes with the first line, and both grids of a spread from one explosion: no table is read twice
    grid = _lines(t).select("filing", F.explode(F.when(F.col("n") == 1, F.array(*tops, *body)).otherwise(F.array(*body))).alias("x"))
    place = [F.lit(1).alias("page"), F.lit(0).alias("table_no")]
    if not right:
        return grid.select("filing", *place, "x.*")
    # the same grid again to its right, under another heading, on the claims side
    left = F.replace(F.col("x.text"), F.lit("ASSETS"), F.lit("LIABILITIES"))
    both = F.explode(F.array(F.struct(F.lit(0).alias("move"), left.alias("text")), F.struct(F.lit(4).alias("move"), F.col("x.text").alias("text")))).alias("y")
    return grid.select("filing", *place, "x", both).select("filing", "page", "table_no", "x.row", (F.col("x.col") + F.col("y.move")).alias("col"), "x.col_span", "y.text", "x.column_header")


@query(f"""
WITH {_SQL_LINES}, k AS (SELECT *, row_number() OVER (PARTITION BY filing ORDER BY n) AS place FROM l)
SELECT filing, 'p1.r' || (2 * n + 1) AS row_id, 'Line ' || n AS label, CAST(n AS VARCHAR) AS note, CAST(v AS DOUBLE) AS this_year, CAST(0 AS DOUBLE) AS last_year,
 CASE WHEN place = 1 THEN 'ASSETS|' ELSE '' END || 'heading ' || n AS headings, '(Rupees) 2024|(Rupees) restated 2023' AS headers FROM k""")
def table_rows(t):
    """The grid of each order as statement rows under their headings."""
    rows = grids.statement_rows(_cells(t))
    return rows.select("filing", "row_id", "label", "note", F.col("values")[0].alias("this_year"), F.col("values")[1].alias("last_year"), F.array_join("headings", "|").alias("headings"), F.array_join("headers", "|").alias("headers"))


@query(f"WITH {_SQL_LINES} SELECT filing, CASE WHEN count(*) >= 3 THEN 2 ELSE 1 END AS tables, CASE WHEN count(*) >= 3 THEN 'ASSETS' ELSE 'LIABILITIES' END AS first_heading FROM l GROUP BY 1")
def spread_halves(t):
    """Two grids printed beside each other are told apart from three lines on, the assets first."""
    parted = grids.halves(_cells(t, right=True))
    return parted.groupBy("filing").agg(F.count_distinct("half").cast("int").alias("tables"), F.max(F.when((F.col("half") == 0) & (F.col("row") == 0) & (F.col("col") == 0), F.col("text"))).alias("first_heading"))


@query(f"WITH {_SQL_LINES} SELECT filing, 1 AS page, string_agg('Line ' || n || ' | ' || n || ' | ' || format('{{:,}}', v) || ' | -', chr(10) ORDER BY n) AS text FROM l GROUP BY 1")
def page_evidence(t):
    return grids.evidence_text(grids.statement_rows(_cells(t), headers=False))


@query("""
WITH d AS (SELECT DISTINCT o_custkey AS filing, last_day(CAST(o_orderdate AS DATE)) AS d FROM orders), n AS (SELECT *, row_number() OVER (PARTITION BY filing ORDER BY d DESC) AS n FROM d)
SELECT filing, strftime(coalesce(max(d) FILTER (n = 2), max(d) FILTER (n = 1)), '%m-%d') AS month_day FROM n GROUP BY 1""")
def year_ends(t):
    ends = t("orders").select(F.col("o_custkey").alias("filing"), F.last_day(F.to_date("o_orderdate")).alias("period_end")).distinct()
    return grids.year_end(ends.withColumn("place", -F.unix_date("period_end")))


# ---- relations -----------------------------------------------------------------------------------------------------


def _two_columns(t) -> DataFrame:
    """filing, place, column, value: each order's lines with their total below, in two columns; every fourth order misreads the second total."""
    lines = _lines(t).select("filing", F.col("n").alias("place"), _each("column int, value double", (0, F.col("v")), (1, F.col("v") * 3 + F.col("n")))).select("filing", "place", "x.*")
    total = lines.groupBy("filing", "column").agg(F.sum("value").alias("s")).select("filing", F.lit(100).alias("place"), "column", F.when((F.col("filing") % 4 == 0) & (F.col("column") == 1), F.col("s") + 900).otherwise(F.col("s")).alias("value"))
    return lines.unionByName(total)


def _three_columns(t) -> DataFrame:
    """A balance sheet of each order in three columns: its lines, their uncaptioned total (100), other assets (101) and total assets (102).

    Every third order misreads its first line in the second column; every fourth prints a note number's leftover (99) there alone.
    """
    line = F.struct("l_linenumber", (F.floor("l_extendedprice") + 10_000).cast("long").alias("v"))
    v = written(t("lineitem").groupBy(F.col("l_orderkey").alias("filing")).agg(F.array_sort(F.collect_list(line)).v.alias("v")), "balance-lines")
    v = v.withColumn("s", F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x))
    cell = lambda x: F.struct(x.cast("double").alias("value"), x.isNotNull().alias("printed"))
    none, wrong = F.lit(None).cast("double"), F.when(F.col("filing") % 3 == 0, 900).otherwise(0)
    size = F.size("v")
    row = lambda place, label, *cells: F.struct(F.lit(place).alias("place") if isinstance(place, int) else place.alias("place"), F.lit(label).alias("label"), F.array(*map(cell, cells)).alias("cells"))
    lines = F.transform("v", lambda x, i: row(i + 1, "property and others", x, 2 * x + F.when(i == 0, wrong).otherwise(0), 3 * x))
    sums = [F.col("s"), 2 * F.col("s"), 3 * F.col("s")]
    tail = [row(99, "loose", none, F.when(F.col("filing") % 4 == 0, 77), none), row(100, "", *sums), row(101, "other assets", *[F.lit(5000)] * 3), row(102, "total assets", *[x + 5000 for x in sums])]
    # one line alone has no total of its own
    tail = F.when(size >= 2, F.array(*tail)).otherwise(F.array(tail[0], *tail[2:]))
    return v.select("filing", F.explode(F.concat(lines, tail)).alias("x")).select("filing", "x.*", F.lit(True).alias("amount"))


@query("""
WITH l AS (SELECT l_orderkey AS filing, count(*) AS n FROM lineitem GROUP BY 1), c AS (SELECT *, CAST(unnest([0, 1, 2]) AS INTEGER) AS col FROM l)
SELECT filing, col AS "column", CAST(100 AS INTEGER) AS total, CAST(n AS INTEGER) AS parts, CAST(CASE WHEN col = 1 AND filing % 3 = 0 THEN 900 ELSE 0 END AS DOUBLE) AS residual, false AS advisory FROM c WHERE n >= 2 AND NOT (col = 1 AND filing % 4 = 0)
UNION ALL SELECT filing, col, 102, 2, CASE WHEN n = 1 AND col = 1 AND filing % 3 = 0 THEN 900 ELSE 0 END, false FROM c WHERE n >= 2 OR NOT (col = 1 AND filing % 4 = 0)""")
def total_runs(t):
    """A1 of every total in every column, though one column is misread: it fails there, which is how the misreading is found."""
    rows = written(_three_columns(t), "balance-rows")
    found = written(totals.total_constraints(rows, ["filing"]), "totals")
    cells = rows.select("filing", "place", F.posexplode("cells").alias("column", "x")).select("filing", "place", "column", "x.value")
    terms = totals.total_terms(found, ["filing"])
    sums = terms.join(cells, ["filing", "column", "place"]).groupBy("filing", "column", "constraint_id").agg(F.sum(F.col("sign") * F.col("value")).alias("residual"))
    of = found.select("filing", "column", "total", F.size("parts").alias("parts"), "advisory", F.concat(F.lit("A1 "), F.col("total"), F.lit(" c"), F.col("column")).alias("constraint_id"))
    return of.join(sums, ["filing", "column", "constraint_id"]).select("filing", "column", "total", "parts", "residual", "advisory")


@query(f"WITH {_SQL_LINES}, s AS (SELECT filing, count(*) AS n FROM l GROUP BY 1) SELECT filing, 100 AS total, 0 AS column, 1 AS in_column, CAST(-900 AS DOUBLE) AS residual FROM s WHERE filing % 4 = 0")
def cross_column(t):
    """Runs of the first column tried in the second, where every fourth order's total is misread."""
    cells = written(_two_columns(t).withColumn("row", F.col("place")), "cross-cells")
    runs = cells.where("place < 100 and column = 0").groupBy("filing", "column").agg(F.array_sort(F.collect_list("row")).alias("parts")).withColumn("total", F.lit(100))
    kept = cells.select("filing", "column").distinct()
    return relations.cross_column_failures(runs, cells, kept, ["filing"])


@query(f"WITH {_SQL_LINES} SELECT filing, CAST(n AS INTEGER) AS row FROM l WHERE n > 3 AND n <> 5")
def unaccounted_rows(t):
    """Rows of each order that neither the first line's parts (2 and 3) nor a total of it (5) account for."""
    lines = _lines(t).withColumn("identity", F.lit("B1"))
    rows = lines.select("filing", "identity", F.col("n").alias("row"), F.concat(F.lit("line "), F.col("n")).alias("label"), (F.col("v") + 1.0).alias("value"))
    own = lines.where("n = 1").select("filing", "identity", F.col("n").alias("row"))
    parts = lines.select("filing").distinct().select("filing", _each("total bigint, part bigint", (1, 2), (2, 3), (5, 1))).select("filing", "x.*")
    return relations.unaccounted(rows, own, parts, ["filing"], "identity").select("filing", "row")


@query("""
WITH o AS (SELECT o_custkey AS filing, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n, count(*) OVER (PARTITION BY o_custkey) AS size FROM orders)
SELECT filing, n AS row, size - n + 1 AS parts FROM o WHERE size >= 2""")
def nested_totals(t):
    """Each order of a customer as the total of the next: all that a row adds up, at any depth."""
    ids = t("orders").groupBy(F.col("o_custkey").alias("filing")).agg(F.array_sort(F.collect_list("o_orderkey")).alias("v")).select("filing", F.posexplode("v").alias("at", "k"))
    edges = ids.where("at > 0").select("filing", F.col("at").cast("long").alias("total"), (F.col("at") + 1).cast("long").alias("part"))
    return relations.descendants(edges, ["filing"]).groupBy("filing", "row").agg(F.count("*").alias("parts"))


@query("""
WITH o AS (SELECT o_custkey AS filing, count(*) AS size FROM orders GROUP BY 1), r(rule, own, loose) AS (VALUES ('B1', true, true), ('B2', false, false), ('B4', true, false), ('F4', true, true))
SELECT filing, rule, loose AND filing % 3 = 0 AS advisory, NOT (filing % 5 = 0) AS holds FROM o, r""")
def identity_advisories(t):
    """Identities bind where their cells account for every figure of their span, and are advisory where one is left out.

    A customer's balance: its orders nest below total assets; every third prints one more figure outside; every fifth misreads a total.
    """
    o = t("orders").groupBy(F.col("o_custkey").alias("filing")).agg(F.array_sort(F.collect_list("o_orderkey")).alias("v"))
    o = written(o.select("filing", F.size("v").cast("long").alias("size")), "nested-rows")
    at = o.select("filing", "size", F.explode(F.sequence(F.lit(1), F.col("size"))).alias("row"))
    parts = at.where("row < size").select("filing", F.col("row").alias("total"), (F.col("row") + 1).alias("part"))
    label = F.when(F.col("row") == 1, "total assets").otherwise("an asset")
    rows = at.select("filing", "row", label.alias("label"), F.lit(50.0).alias("value")).unionByName(o.where("filing % 3 = 0").select("filing", F.lit(-1).cast("long").alias("row"), F.lit("assets held for sale").alias("label"), F.lit(70.0).alias("value"))).unionByName(o.select("filing", F.lit(-2).cast("long").alias("row"), F.lit("authorised capital").alias("label"), F.lit(9.0).alias("value")))
    spans = rows.crossJoin(F.broadcast(o.sparkSession.sql("SELECT * FROM VALUES ('B1'), ('F4') AS r(rule)")))
    spans = spans.unionByName(rows.where("row <> -1").withColumn("rule", F.lit("B4")))
    cells = o.select("filing", F.lit(1).cast("long").alias("row"), F.explode(F.array(*map(F.lit, ("B1", "B4", "F4")))).alias("rule"))
    left_out = relations.unaccounted(spans, cells, parts, ["filing"], "rule")
    wide = o.select("filing", F.lit(60.0).alias("total_equity"), F.lit(40.0).alias("total_liabilities"), F.when(F.col("filing") % 5 == 0, 190.0).otherwise(100.0).alias("total_assets"), F.lit(15.0).alias("total_current_liabilities"), F.when(F.col("filing") % 5 == 0, 75.0).otherwise(25.0).alias("total_non_current_liabilities"),
                    F.lit(30.0).alias("total_current_assets"), F.lit(70.0).alias("total_non_current_assets"), *[F.lit(v).alias(c) for c, v in (("cash_from_operations", 5.0), ("cash_from_investing", -2.0), ("cash_from_financing", -1.0))], F.when(F.col("filing") % 5 == 0, 22.0).otherwise(2.0).alias("net_change_in_cash"))
    checks = constraints.check_identities(wide, ["filing"])
    return constraints.settled(checks, left_out, ["filing"]).select("filing", "rule", "advisory", "holds")


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'charge' WHEN o_orderkey % 3 = 1 THEN 'credit' ELSE 'as printed' END AS form, o_orderkey % 3 <> 2 AS holds, CAST(CASE WHEN o_orderkey % 3 = 2 THEN 500 ELSE 0 END AS DOUBLE) AS residual FROM orders""")
def tax_forms(t):
    """Profit before and after tax with a charge, a credit, and a misread tax line."""
    p = F.floor("o_totalprice").cast("double") + 10_000
    tax, kind = F.lit(700.0), F.col("o_orderkey") % 3
    after = F.when(kind == 0, p - tax).when(kind == 1, p + tax).otherwise(p - tax - 500)
    form = relations.flexible_form(p - after, [F.when(kind == 1, -tax).otherwise(tax)], F.lit(2.0), F.lit(-1))
    return t("orders").select("o_orderkey", form.alias("x")).select("o_orderkey", "x.form", "x.holds", "x.residual")


@query(f"WITH {_SQL_LINES} SELECT filing, CAST(sum(v) AS DOUBLE) AS levies, count(*) AS n FROM l WHERE filing % 3 <> 0 GROUP BY 1")
def levy_rows(t):
    """An order's lines as levies between profit before them and profit before tax; every third order prints something else between."""
    lines = _lines(t)
    levies = lines.select("filing", F.col("n").alias("place"), F.when(F.col("n") % 2 == 0, "minimum tax").otherwise("levies").alias("label"), F.lit(None).cast("string").alias("item"), (F.col("v") * 1.0).alias("value"))
    fixed = lines.select("filing").distinct().select("filing", _each("place int, label string, item string, value double", (-1, "profit before levies and income tax", None, 9.0), (0, "a heading", None, None), (100, "profit before income tax", "profit_before_tax", 1.0))).select("filing", "x.*")
    other = fixed.where("place = 0 and filing % 3 = 0").select("filing", F.lit(50).alias("place"), F.lit("gain on sale").alias("label"), "item", F.lit(4.0).alias("value"))
    return relations.levies_above(levies.unionByName(fixed).unionByName(other), ["filing"]).select("filing", "levies", "n")


@query("""
SELECT o_orderkey AS filing, x.rule, CAST(CASE x.rule WHEN 'X1 pre-levy' THEN -5 ELSE 0 END AS DOUBLE) AS residual, x.rule <> 'X3' AS advisory FROM orders JOIN (VALUES (0, 'X1'), (0, 'X1 pre-levy'), (1, 'X3')) x(i, rule) ON o_orderkey % 3 = x.i""")
def starting_ties(t):
    """Cash flows that start from profit before tax, from profit after tax, and from a line that is no profit."""
    k = F.col("o_orderkey")
    label = _pick(k, ["profit before taxation", "profit for the year", "cash before working capital changes"])
    rows = t("orders").select(k.alias("filing"), _each("place int, label string, value double", (0, "heading", None), (1, label, F.col("o_totalprice")), (2, "depreciation", 1.0))).select("filing", "x.*", F.lit("operating").alias("section"))
    income = t("orders").select(k.alias("filing"), F.col("o_totalprice").cast("double").alias("profit_before_tax"), F.col("o_totalprice").cast("double").alias("profit_after_tax"), (F.col("o_totalprice") + 5.0).alias("pre_levy"))
    return relations.starting_ties(relations.starting_profit(rows, ["filing"]), income, ["filing"]).select("filing", "rule", F.round("residual", 4).alias("residual"), "advisory")


@query(f"WITH {_SQL_LINES} SELECT a.filing, CAST(a.n AS INTEGER) AS low, CAST(b.n AS INTEGER) AS high, CAST(CASE WHEN a.n = 1 THEN a.v * 1000 ELSE a.v END - b.v AS DOUBLE) AS residual FROM l a JOIN l b ON a.filing = b.filing AND a.n < b.n")
def repeated_items(t):
    """The lines of an order as one item printed in a table each, the first in thousands."""
    v = _lines(t).select("filing", F.lit("revenue").alias("item"), F.col("n").alias("table_no"), (F.col("v") * 1.0).alias("value"), F.when(F.col("n") == 1, 1000.0).otherwise(1.0).alias("scale"))
    return relations.repeated_items(v, ["filing"]).select("filing", "low", "high", "residual")


@query(f"""
WITH {_SQL_LINES}, s AS (SELECT filing, count(*) AS size, sum(v) AS total, max(v) FILTER (n = 1) AS v1, max(v) FILTER (n = 2) AS v2 FROM l GROUP BY 1 HAVING count(*) >= 2),
c AS (SELECT *, CASE WHEN filing % 5 = 1 THEN 'A1' WHEN filing % 5 = 2 THEN 'X2' END AS rule FROM s)
SELECT filing, rule, CAST(NULL AS VARCHAR) AS item, CAST(NULL AS DOUBLE) AS value FROM c WHERE rule IS NOT NULL UNION ALL
SELECT filing, NULL, x.item, CAST(1000 * CASE x.item WHEN 'inventory_raw_materials' THEN v1 ELSE v2 END AS DOUBLE) FROM c, (VALUES ('inventory_raw_materials'), ('inventory_finished_goods')) x(item) WHERE rule IS NULL""")
def inventory_notes(t):
    """Inventory notes in thousands whose first line is a group with its total; some do not add up, some are not the balance sheet's."""
    lines = _lines(t)
    label = F.when(F.col("n") == 1, "").when(F.col("n") == 2, "finished goods").otherwise("others")
    body = lines.select("filing", (F.col("n") * 10).alias("place"), label.alias("label"), (F.col("v") * 1.0).alias("value"))
    group = lines.where("n = 1").select("filing", _each("place int, label string, value double", (1, "raw and packing materials", None), (2, "in hand", 5.0), (3, "in transit", 7.0))).select("filing", "x.*")
    sums = lines.groupBy("filing").agg(F.sum("v").alias("s"))
    total = sums.select("filing", F.lit(1000).alias("place"), F.lit(None).cast("string").alias("label"), F.when(F.col("filing") % 5 == 1, F.col("s") + 99.0).otherwise(F.col("s") * 1.0).alias("value"))
    stock = sums.select("filing", F.when(F.col("filing") % 5 == 2, 1.0).otherwise(F.col("s") * 1000.0).alias("value"), F.lit(1000.0).alias("scale"))
    parts, refused = relations.inventory_split(body.unionByName(group).unionByName(total), stock, ["filing"])
    return refused.select("filing", "rule", F.lit(None).cast("string").alias("item"), F.lit(None).cast("double").alias("value")).unionByName(parts.select("filing", F.lit(None).cast("string").alias("rule"), "item", "value"))


@query("SELECT DISTINCT o_custkey AS filing, CAST(o_orderdate AS DATE) AS period_end, CAST(o_custkey % 90 + 10 AS DOUBLE) AS value FROM orders WHERE o_custkey % 4 <> 0")
def par_values(t):
    """The face value stated on a customer's second page, for each of its dates; every fourth customer states none."""
    k = F.col("c_custkey")
    text = F.when(k % 4 != 0, F.concat(F.lit("capital\n 50,000 Ordinary  shares of Rs. "), k % 90 + 10, F.lit("/- each fully paid\nordinary shares of Rs. 1 each"))).otherwise("no shares here")
    d = t("customer").select(k.alias("filing"), _each("page_number int, text string", (1, "front page"), (2, text))).select("filing", "x.*")
    dates = t("orders").select(F.col("o_custkey").alias("filing"), F.to_date("o_orderdate").alias("period_end"), F.lit("u").alias("basis"))
    return relations.par_value(d, dates).select("filing", "period_end", "value")


@query(f"WITH {_SQL_LINES}, s AS (SELECT filing, count(*) AS n FROM l GROUP BY 1) SELECT l.filing, CAST(l.n AS INTEGER) AS column FROM l JOIN s USING (filing) WHERE s.n >= 2 AND filing % 3 <> 0")
def eps_checks(t):
    """Columns of one share count, where every third order misreads its first EPS; half a cent is far less than a line's figure."""
    shares = F.lit(1000.0)
    lines = _lines(t).withColumn("p", (F.col("v") + 1000) * 1.0)
    wrong = (F.col("filing") % 3 == 0) & (F.col("n") == 1)
    value = F.round(F.col("p") / shares, 2) * F.when(wrong, 10).otherwise(1)
    both = lines.select("filing", F.col("n").alias("column"), value.alias("value"), "p")
    eps = both.select("filing", "column", F.lit("eps_basic").alias("item"), "value")
    profits = both.select("filing", "column", F.lit(None).cast("double").alias("owners"), F.col("p").alias("after_tax"))
    return relations.confirmed_eps(eps, profits, ["filing", "column"], ["filing"]).select("filing", "column")


@query("SELECT o_custkey, o_orderkey FROM orders QUALIFY o_orderstatus = 'P' OR count(*) FILTER (o_orderstatus = 'P') OVER (PARTITION BY o_custkey) = 0")
def kind_fallback(t):
    """Pending orders of a customer; all orders of one that has none."""
    return relations.with_fallback(t("orders"), F.col("o_orderstatus") == "P", ["o_custkey"]).select("o_custkey", "o_orderkey")


@query("""
WITH i AS (SELECT o_custkey AS symbol, year(o_orderdate) AS release, o_orderkey AS asset FROM orders), a AS (SELECT o_orderkey AS asset FROM orders WHERE o_orderkey % 9 <> 0),
w AS (SELECT symbol, release FROM i LEFT JOIN a USING (asset) GROUP BY 1, 2 HAVING count(a.asset) = count(*)), n AS (SELECT symbol, max(release) AS release FROM w GROUP BY 1)
SELECT i.symbol, CAST(i.release AS INTEGER) AS release, i.asset FROM i JOIN n USING (symbol, release)""")
def published_release(t):
    """Each customer's newest year whose orders are all there."""
    index = t("orders").select(F.col("o_custkey").alias("symbol"), F.year("o_orderdate").alias("release"), F.col("o_orderkey").alias("asset"))
    return relations.published(index, index.where("asset % 9 <> 0"), ["symbol"]).select("symbol", "release", "asset")


# ---- statements from grids to figures -------------------------------------------------------------------------------

#: Rows of a printed filing: headings above, caption, figure by the year's v and k.
_INCOME = (("", "Revenue", "10 * v"), ("", "Cost of sales", "-6 * v"), ("", "Gross profit", "4 * v"), ("", "Administrative expenses", "-v"), ("", "Operating profit", "3 * v"), ("", "Finance cost", "-k"), ("", "Profit before taxation", "3 * v - k"), ("", "Taxation", "-floor(v / 2)"), ("", "Profit for the year", "3 * v - k - floor(v / 2)"))
_BALANCE = (
    ("ASSETS|NON-CURRENT ASSETS", "Property, plant and equipment", "5 * v"), ("CURRENT ASSETS", "Stock in trade", "2 * v"), ("", "Trade debts", "v"), ("", "Cash and bank balances", "k"), ("", "Total current assets", "3 * v + k"), ("", "TOTAL ASSETS", "8 * v + k"),
    ("EQUITY AND LIABILITIES|SHARE CAPITAL AND RESERVES", "Share capital", "1000"), ("", "Unappropriated profit", "4 * v - 1000"), ("", "Total equity", "4 * v"), ("CURRENT LIABILITIES", "Trade and other payables", "4 * v + k"), ("", "TOTAL EQUITY AND LIABILITIES", "8 * v + k"),
)


def _filing_grids(t) -> tuple[DataFrame, DataFrame]:
    """Two statements of each order, of two years, in thousands, in one of three layouts: plain, with a column of notes, under one merged header.

    Every fifth order's gross profit of the year is misread.
    """
    sums = written(t("lineitem").groupBy(F.col("l_orderkey").alias("filing")).agg(F.sum(F.floor("l_extendedprice").cast("long")).alias("s")), "filing-sums")
    o = sums.select("filing", (F.col("filing") % 3).alias("layout"), (F.col("s") + 100_000).alias("v1"), (F.col("s") + 105_000).alias("v0"), (F.col("filing") % 90 + 11).alias("k1"), (F.col("filing") % 70 + 12).alias("k0"))
    notes = F.col("layout") == 1
    col = lambda n: (F.when(notes, n + 1).otherwise(n)).cast("int")
    cell = lambda row, at, text, span=1, header=False: F.struct(F.lit(row).alias("row"), (at if isinstance(at, Column) else F.lit(at)).cast("int").alias("col"), F.lit(span).alias("col_span"), text.alias("text"), F.lit(header).alias("column_header"))
    money = lambda x: F.when(x < 0, F.concat(F.lit("("), F.format_number(-x, 0), F.lit(")"))).otherwise(F.format_number(x, 0))

    def grid(kind: str, lines) -> DataFrame:
        merged = F.col("layout") == 2
        out = [F.when(merged, F.array(cell(0, 0, F.lit("")), cell(0, 1, F.lit("2024 2023"), 2, True))).otherwise(F.array(cell(0, 0, F.lit("")), cell(0, col(1), F.lit("2024"), 1, True), cell(0, col(2), F.lit("2023"), 1, True))), F.when(notes, F.array(cell(0, 1, F.lit("Note"), 1, True))).otherwise(F.array())]
        row = 1
        for heads, caption, formula in lines:
            for head in filter(None, heads.split("|")):
                out.append(F.array(cell(row, 0, F.lit(head))))
                row += 1
            now, before = (F.expr(formula.replace("v", f"v{y}").replace("k", f"k{y}")).cast("long") for y in (1, 0))
            text = money(now)
            if caption == "Gross profit":
                text = F.when(F.col("filing") % 5 == 0, F.translate(text, "38", "83")).otherwise(text)
            # the layout with notes prints no caption for the total of current assets
            shown = F.when(notes & F.lit(caption == "Total current assets"), "").otherwise(caption)
            out += [F.array(cell(row, 0, shown), cell(row, col(1), text), cell(row, col(2), money(before))), F.when(notes, F.array(cell(row, 1, F.lit(str(row))))).otherwise(F.array())]
            row += 1
        return o.select("filing", F.lit(kind).alias("statement"), F.lit(1).alias("page"), F.lit(0).alias("table_no"), F.explode(F.flatten(F.array(*out))).alias("x")).select("filing", "statement", "page", "table_no", "x.*").where("text <> ''")

    titles = o.select("filing", _each("statement string, title string", ("income", "Statement of profit or loss for the year ended December 31, 2024"), ("balance", "Statement of financial position as at December 31, 2024")))
    tables = titles.select("filing", "x.*", F.lit(True).alias("annual"), F.lit("12-31").alias("year_end"), F.lit(1000.0).alias("scale"))
    return grid("income", _INCOME).unionByName(grid("balance", _BALANCE)), tables


@query("""
WITH s AS (SELECT l_orderkey AS filing, CAST(sum(CAST(floor(l_extendedprice) AS BIGINT)) AS BIGINT) AS s FROM lineitem GROUP BY 1),
y AS (SELECT filing, DATE '2024-12-31' AS period_end, s + 100000 AS v, filing % 90 + 11 AS k, format('{:,}', 4 * (s + 100000)) AS g FROM s UNION ALL SELECT filing, DATE '2023-12-31', s + 105000, filing % 70 + 12, '' FROM s),
b AS (SELECT *, filing % 5 = 0 AND regexp_matches(g, '[38]') AS wrong, len(regexp_extract_all(g, '[38]')) = 1 OR (len(regexp_extract_all(g, '[38]')) = 2 AND (contains(g, '38') OR contains(g, '83'))) AS able FROM y),
c AS (SELECT *, wrong AND NOT able AS lost FROM b)
SELECT filing, period_end, 1000.0 * CASE WHEN NOT lost THEN 10 * v END AS revenue, 1000.0 * CASE WHEN NOT lost THEN 4 * v END AS gross_profit, 1000.0 * 3 * v AS operating_profit, 1000.0 * (3 * v - k - floor(v / 2)) AS profit_after_tax,
 1000.0 * (3 * v + k) AS total_current_assets, 1000.0 * (8 * v + k) AS total_assets, 1000.0 * 4 * v AS total_equity, CASE WHEN NOT lost THEN 0.4 END AS gross_income_margin, wrong AND able AS repaired
FROM c""")
def verified_statements(t):
    """Printed filings of three layouts, from their grids to confirmed, repaired and filled figures of each period."""
    figures = written(filings.verified(*_filing_grids(t)), "verified")
    items = ("revenue", "cost_of_sales", "gross_profit", "operating_profit", "profit_before_tax", "profit_after_tax", "total_current_assets", "total_assets", "total_equity")
    wide = metrics.wide_periods(figures, ["filing", "period_end"], "item", "value", items).withColumn("months", F.lit(12))
    out = metrics.ratios(metrics.fill(wide))
    mended = figures.groupBy("filing", "period_end").agg(F.bool_or("repaired").alias("repaired"))
    return out.join(mended, ["filing", "period_end"]).select("filing", "period_end", "revenue", "gross_profit", "operating_profit", "profit_after_tax", "total_current_assets", "total_assets", "total_equity", "gross_income_margin", "repaired")


_FIVES = "CAST(repeat(CAST({} AS VARCHAR), 5) || ({} % 10) AS DOUBLE)"


@query(f"""
WITH {_SQL_LINES}, f AS (SELECT filing, n, {_FIVES.format("(n % 9 + 1)", "v")} AS a, {_FIVES.format("((n + 4) % 9 + 1)", "v")} AS b FROM l), c AS (SELECT filing, n, CAST(0 AS INTEGER) AS col, a AS value FROM f UNION ALL SELECT filing, n, 1, b FROM f)
SELECT CAST(filing AS VARCHAR) AS filing, 'r' || n AS row_id, col, 'ocr-300' AS source, value FROM c WHERE n % 2 = 1 UNION ALL SELECT CAST(filing AS VARCHAR), 'r' || n, col, 'ocr-digits', value FROM c WHERE filing % 3 <> 0""")
def ocr_passes(t):
    """Two readings of a scanned page of each order: every second line has a letter for a digit in the first pass; the second has no
    captions, and every third order's repeats its lines, so that no line of it can be told from its copy."""
    k = F.col("n")
    figure = lambda d: F.concat(F.repeat(d.cast("string"), F.lit(5)), (F.col("v") % 10).cast("string"))
    lines = written(_lines(t).select(F.col("filing").cast("string").alias("filing"), F.lit(0).alias("table_no"), F.lit(1).alias("page"), k.cast("int").alias("n"), figure(k % 9 + 1).alias("a"), figure((k + 4) % 9 + 1).alias("b")), "scanned-lines")
    grouped = lambda c: F.format_number(F.col(c).cast("long"), 0)
    # a word of its own for each line's caption
    label = F.concat(F.lit("item "), F.translate((k * 7919 + 100_000).cast("string"), "0123456789", "abcdefghij"))
    key = ["filing", "table_no", "page"]
    rows = lines.select(*key, F.col("n").alias("row_ord"), F.concat(F.lit("r"), "n").alias("row_id"), label.alias("label"), _each("col int, raw string", (0, F.col("a")), (1, F.col("b")))).select(*key, "row_ord", "row_id", "label", "x.*")
    misread = F.when(k % 2 == 0, F.overlay(grouped("a"), F.lit("S"), F.lit(2))).otherwise(grouped("a"))
    first = lines.select(*key, F.lit("ocr-300").alias("source"), (k * 2).alias("line_no"), F.concat(label, F.lit("     "), misread, F.lit("   "), grouped("b")).alias("text"))
    copies = F.when(F.col("filing").cast("long") % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    second = lines.select(*key, F.lit("ocr-digits").alias("source"), F.explode(copies).alias("i"), "n", F.concat(F.lit(". 1 ' "), grouped("a"), F.lit(" "), grouped("b")).alias("text"))
    second = second.select(*key, "source", (k * 2 + F.col("i")).alias("line_no"), "text")
    return alignment.pass_readings(rows, first.unionByName(second)).select("filing", "row_id", "col", "source", "value")


# ---- the first version's reading of lines ---------------------------------------------------------------------------

_FIRST = (
    """UNCONSOLIDATED CONDENSED INTERIM FINANCIAL STATEMENTS
Statement of Profit or Loss
Amounts in thousand
          {y}
Revenue                 14  {a}  {b}
Cost of sales               (4,000)  (3,000)
Gross profit                {c}  {d}
Selling and distribution expenses   (10)   (20)
Administrative expenses   (30)   (40)
Earnings per share  2.25  2.25""",
    """Consolidated Statement of Financial Position
(Rupees in million)
{y}
Total assets     {a}   {b}
Total liabilities  1,000  1,000
Share capital   (5)  (5)
Notes to the financial statements
Current assets  77  77""",
)


@query("""
WITH o AS (SELECT o_orderkey AS filing, CAST(o_orderkey % 900 + 5000 AS DOUBLE) + CASE WHEN o_orderkey % 2 = 1 THEN 100 ELSE 0 END AS a, CAST(CASE WHEN o_orderkey % 2 = 0 THEN 4000 ELSE 3000 END AS DOUBLE) AS c, CASE WHEN o_orderkey % 2 = 0 THEN 10.0 ELSE 20.0 END AS s FROM orders),
i AS (SELECT filing, 'unconsolidated' AS basis, 'income' AS statement, unnest([{'item': 'revenue', 'value': a * 1000}, {'item': 'cost_of_sales', 'value': c * 1000}, {'item': 'gross_profit', 'value': (a - c) * 1000}, {'item': 'distribution_cost', 'value': s * 1000}, {'item': 'admin_expenses', 'value': (s + 20) * 1000},
 {'item': 'eps_basic', 'value': 2.25}, {'item': 'selling_admin_expenses', 'value': (2 * s + 20) * 1000}, {'item': 'gross_margin_pct', 'value': round(100 * (a - c) / a, 4)}]) AS x FROM o WHERE filing % 7 <> 0),
b AS (SELECT filing, 'consolidated', 'balance', unnest([{'item': 'total_assets', 'value': a * 1000000}, {'item': 'total_liabilities', 'value': CAST(1000000000 AS DOUBLE)}, {'item': 'total_equity', 'value': (a - 1000) * 1000000}]) FROM o)
SELECT filing, basis, statement, x.item AS item, CAST(x.value AS DOUBLE) AS value FROM (SELECT * FROM i UNION ALL SELECT * FROM b)""")
def first_version_lines(t):
    """Two pages of each order, the years in either order; every seventh order's first page is a scan of little confidence."""
    k = F.col("o_orderkey")
    odd, a = k % 2 == 1, k % 900 + 5000
    number = lambda x: F.format_number(x, 0)
    swap = F.when(odd, "2024      2025").otherwise("2025      2024")
    text = F.get(F.array(*map(F.lit, _FIRST)), F.col("p"))
    for name, value in (("y", swap), ("a", number(a)), ("b", number(a + 100)), ("c", number(a - 4000)), ("d", number(a + 100 - 3000))):
        text = F.replace(text, F.lit("{" + name + "}"), value)
    d = t("orders").select("o_orderkey", F.explode(F.array(F.lit(0), F.lit(1))).alias("p"))
    weak = F.when((k % 7 == 0) & (F.col("p") == 0), 0.64).otherwise(0.9)
    pages_ = d.select(k.alias("filing"), (F.col("p") + 1).alias("page_number"), text.alias("text"), F.lit(2025).alias("target_year"), weak.alias("confidence"))
    return line_items.promoted(pages_).select("filing", "basis", "statement", "item", "value")


# ---- a model's readings ---------------------------------------------------------------------------------------------

#: How a model reads the lines of an order's statement, by the order's key: as printed, columns swapped, a figure made up, a tax misread.
_MODEL_KINDS = 4


@query("""
WITH o AS (SELECT o_orderkey AS k, o_orderkey % 900 + 5000 AS a, o_orderkey % 4 AS kind FROM orders),
y AS (SELECT k, kind, 2025 AS y, a FROM o UNION ALL SELECT k, kind, 2024, a + 300 FROM o),
f AS (SELECT k, kind, y, unnest([{'item': 'revenue', 'v': 3 * a}, {'item': 'cost_of_sales', 'v': a}, {'item': 'gross_profit', 'v': 2 * a}, {'item': 'profit_before_tax', 'v': a}, {'item': 'taxation', 'v': 40}, {'item': 'profit_after_tax', 'v': a - 40}]) AS x FROM y)
SELECT k AS filing, make_date(y, 6, 30) AS period_end, x.item AS item, CAST(1000 * x.v AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS reason FROM f WHERE NOT (kind = 1 AND x.item = 'revenue') AND NOT (kind = 2 AND x.item = 'gross_profit') AND NOT (kind = 3 AND x.item = 'taxation')
UNION ALL SELECT k, NULL, CASE kind WHEN 1 THEN 'revenue' WHEN 2 THEN 'gross_profit' END, NULL, CASE kind WHEN 1 THEN 'the values are not on one line' ELSE 'a value is not on the page' END FROM o WHERE kind IN (1, 2)
UNION ALL SELECT k, NULL, 'taxation', NULL, 'breaks an identity' FROM y WHERE kind = 3""")
def model_readings(t):
    """Figures that a model reads from a printed page, and those that the page or the identities don't bear out, with the reason."""
    k = F.col("o_orderkey")
    kind, a, b = k % _MODEL_KINDS, k % 900 + 5000, k % 900 + 5300
    money = lambda x: F.format_number(x, 0)
    tax = F.when(kind == 3, 900).otherwise(40)  # as printed, where the page itself is wrong
    items = (("revenue", "Revenue", 3 * a, 3 * b), ("cost_of_sales", "Cost of sales", -a, -b), ("gross_profit", "Gross profit", 2 * a, 2 * b), ("profit_before_tax", "Profit before taxation", a, b), ("taxation", "Taxation", -tax, -tax), ("profit_after_tax", "Profit for the year", a - 40, b - 40))
    shown = lambda x: F.when(x < 0, F.concat(F.lit("("), money(-x), F.lit(")"))).otherwise(money(x))
    page = [F.concat(F.lit(caption + "   7   "), shown(x), F.lit("   "), shown(y)) for _, caption, x, y in items]
    lines = t("orders").select(k.alias("filing"), F.lit("income").alias("statement"), F.lit(3).alias("page"), F.posexplode(F.array(*page)).alias("line_no", "text"))

    def values(item: str, x: Column, y: Column) -> Column:
        if item == "revenue":
            return F.when(kind == 1, F.array(shown(y), shown(x))).otherwise(F.array(shown(x), shown(y)))
        return F.array(F.when(kind == 2, "9,999,999").otherwise(shown(x)), shown(y)) if item == "gross_profit" else F.array(shown(x), shown(y))

    read = t("orders").select(k.alias("filing"), F.lit("income").alias("statement"), F.lit(2).alias("n_columns"), F.explode(F.array(*[F.struct(F.lit(i).alias("item"), values(i, x, y).alias("values")) for i, _, x, y in items])).alias("x")).select("filing", "statement", "n_columns", "x.*")
    column = lambda end: F.struct(F.lit(end).alias("period_end"), F.lit(12).alias("months"))
    columns = t("orders").select(k.alias("filing"), F.lit("income").alias("statement"), F.array(column("2025-06-30"), column("2024-06-30")).alias("columns"), F.lit("for the year ended June 30, 2025 and 2024").alias("heading"), F.lit("2025-06-30").cast("date").alias("filed"), F.lit(1000).alias("unit"))
    good, bad = readings.verified(read, lines, columns, ("cost_of_sales", "taxation"), ("revenue",))
    none = F.lit(None)
    return good.select("filing", "period_end", "item", "value", none.cast("string").alias("reason")).unionByName(bad.select("filing", none.cast("date").alias("period_end"), "item", none.cast("double").alias("value"), "reason"))


# ---- every fill and ratio ------------------------------------------------------------------------------------------

#: Figures of a supplier, from the sum e and quantity q of its lines and their number n; some are missing for some suppliers.
_INPUTS = {
    "revenue": "e", "cost_of_sales": "0.6 * e", "taxation": "0.03 * e", "profit_before_tax": "0.12 * e - 40 * q", "finance_cost": "CASE WHEN n % 5 = 0 THEN NULL ELSE 0.01 * e END", "operating_profit": "0.2 * e", "ebitda": "0.25 * e - 10 * q",
    "profit_after_tax": "0.09 * e", "net_income_to_owners": "CASE WHEN n % 3 = 0 THEN 0.08 * e END", "preferred_dividends": "CASE WHEN n % 4 = 0 THEN 5.0 * q END", "eps_basic": "0.09 * e / (1000 * n)", "eps_basic_prior": "0.08 * e / (900 * n) - 0.1",
    "revenue_prior": "0.9 * e - 3 * q", "total_assets": "2.0 * e", "total_assets_opening": "1.9 * e", "total_inventory": "0.3 * e", "total_inventory_opening": "0.2 * e + q", "net_receivables": "0.2503 * e", "net_receivables_opening": "0.2 * e",
    "accounts_payable": "0.1501 * e", "accounts_payable_opening": "CASE WHEN n % 7 = 0 THEN NULL ELSE 0.14 * e END", "total_equity": "CASE WHEN n % 2 = 0 THEN 0.8 * e END", "shareholders_equity": "0.75 * e", "total_equity_opening": "0.7 * e", "shareholders_equity_opening": "0.68 * e",
    "total_equity_prior": "CASE WHEN n % 2 = 1 THEN 0.7 * e END", "shareholders_equity_prior": "0.65 * e", "total_debt": "0.5 * e", "total_debt_opening": "0.45 * e", "cash_and_equivalents": "0.05 * e", "cash_and_equivalents_opening": "0.04 * e", "short_term_investments": "CASE WHEN n % 3 = 1 THEN 0.02 * e END",
    "total_current_assets": "0.9 * e", "total_current_liabilities": "0.4 * e", "total_liabilities": "1.2 * e", "stores_and_spares": "CASE WHEN n % 2 = 0 THEN 0.01 * e END", "intangible_assets": "CASE WHEN n % 3 = 2 THEN 0.01 * e END", "goodwill": "CASE WHEN n % 5 = 1 THEN 0.02 * e END",
    "common_shares_outstanding": "1000.0 * n", "cash_from_operations": "0.11 * e", "capital_expenditure": "-0.07 * e", "free_cash_flow": "0.04 * e - 20 * q", "minority_interest": "CASE WHEN n % 4 = 1 THEN 0.05 * e END", "preferred_stock": "CASE WHEN n % 4 = 2 THEN 0.01 * e END", "gross_profit": "0.4 * e", "price": "12.5 + n",
}
_TE, _CE = "coalesce(total_equity, shareholders_equity)", "coalesce(shareholders_equity, total_equity)"
_TEO, _CEO = "coalesce(total_equity_opening, shareholders_equity_opening)", "coalesce(shareholders_equity_opening, total_equity_opening)"
_CASH, _CASHO = "(cash_and_equivalents + coalesce(short_term_investments, 0))", "cash_and_equivalents_opening"
_IC, _ICO = f"(total_debt + {_TE} - {_CASH})", f"(total_debt_opening + {_TEO} - {_CASHO})"
_UP = "floor(({}) * 10000.0 + 0.5) / 10000.0"
_BVPS, _TANGIBLE, _EV, _CAP = f"({_CE} / common_shares_outstanding)", f"({_CE} - coalesce(intangible_assets, 0) - coalesce(goodwill, 0))", f"(price * common_shares_outstanding + total_debt + coalesce(minority_interest, 0) + coalesce(preferred_stock, 0) - {_CASH})", "(price * common_shares_outstanding)"
_DSO, _DSI, _DPO = (f"(273.75 * ({x} + {x}_opening) / 2 / {y})" for x, y in (("net_receivables", "revenue"), ("total_inventory", "cost_of_sales"), ("accounts_payable", "cost_of_sales")))
#: Ratios of nine months, so that a year has 12 / 9 of them; those of annual periods alone are null.
_A = "(12.0 / 9)"
_RATIOS = {
    "gross_income_margin": "gross_profit / revenue", "gross_margin_pct": "100 * gross_profit / revenue", "operating_margin": "operating_profit / revenue", "operating_margin_pct": "100 * operating_profit / revenue", "net_income_margin": "100 * profit_after_tax / revenue",
    "ebitda_margin": "100 * ebitda / revenue", "cogs_to_sales": "100 * cost_of_sales / revenue", "tax_rate": "CASE WHEN profit_before_tax > 0 THEN 100 * taxation / profit_before_tax END", "interest_coverage": "operating_profit / finance_cost", "interest_coverage_ebitda": "ebitda / finance_cost",
    "capex_to_sales": "-100 * capital_expenditure / revenue", "fcf_to_sales": "100 * free_cash_flow / revenue", "fcf_to_cfo": "100 * free_cash_flow / cash_from_operations", "current_ratio": "total_current_assets / total_current_liabilities",
    "quick_ratio": "(total_current_assets - total_inventory - coalesce(stores_and_spares, 0)) / total_current_liabilities", "equity_to_assets": f"100 * {_TE} / total_assets", "debt_to_equity": f"100 * total_debt / {_TE}", "debt_to_asset": "100 * total_debt / total_assets", "debt_to_capital": f"100 * total_debt / (total_debt + {_TE})",
    "cash_to_debt": f"{_CASH} / total_debt", "net_debt": f"total_debt - {_CASH}", "working_capital": "total_current_assets - total_current_liabilities", "invested_assets_to_liabilities": "total_assets / total_liabilities", "book_value_per_share": _BVPS, "tangible_book_value_per_share": f"{_TANGIBLE} / common_shares_outstanding", "cash_per_share": f"{_CASH} / common_shares_outstanding",
    "equity_yoy_growth": f"100 * ({_TE} / coalesce(total_equity_prior, shareholders_equity_prior) - 1)", "fcf_per_share": "free_cash_flow / common_shares_outstanding", "asset_turnover": f"{_A} * revenue / ((total_assets + total_assets_opening) / 2)", "inventory_turnover": f"{_A} * cost_of_sales / ((total_inventory + total_inventory_opening) / 2)", "sales_to_inventory_turnover": f"{_A} * revenue / ((total_inventory + total_inventory_opening) / 2)",
    "days_sales_outstanding": _DSO, "days_sales_in_inventory": _DSI, "days_payables_outstanding": _DPO, "cash_conversion_cycle": f"{_UP.format(_DSO)} + {_UP.format(_DSI)} - {_UP.format(_DPO)}",
    "return_on_average_assets": f"100 * {_A} * profit_after_tax / ((total_assets + total_assets_opening) / 2)", "return_on_average_total_equity": f"100 * {_A} * profit_after_tax / (({_TE} + {_TEO}) / 2)", "return_on_common_equity": f"100 * {_A} * (coalesce(net_income_to_owners, profit_after_tax) - coalesce(preferred_dividends, 0)) / (({_CE} + {_CEO}) / 2)",
    "return_on_average_invested_capital": f"CASE WHEN profit_before_tax > 0 THEN 100 * {_A} * operating_profit * (1 - taxation / profit_before_tax) / (({_IC} + {_ICO}) / 2) END", "return_on_average_total_capital": f"100 * {_A} * operating_profit / ((total_debt + {_TE} + total_debt_opening + {_TEO}) / 2)", "cash_flow_return_on_invested_capital": f"100 * {_A} * cash_from_operations / (({_IC} + {_ICO}) / 2)",
    "return_on_equity": f"100 * {_A} * profit_after_tax / {_TE}", "return_on_assets": f"100 * {_A} * profit_after_tax / total_assets", "effective_interest_rate": f"100 * {_A} * finance_cost / ((total_debt + total_debt_opening) / 2)", "net_debt_to_ebitda": f"{_UP.format(f'total_debt - {_CASH}')} / ebitda / {_A}",
    "net_sales_yoy_growth": "CASE WHEN revenue_prior > 0 THEN 100 * (revenue / revenue_prior - 1) END", "eps_basic_yoy_growth": "CASE WHEN eps_basic_prior > 0 THEN 100 * (eps_basic / eps_basic_prior - 1) END", "graham_value": "NULL", "market_capitalization": _CAP, "enterprise_value": _EV, "price_to_book": f"price / {_BVPS}", "price_to_tangible_book": f"{_CAP} / {_TANGIBLE}",
    **dict.fromkeys(("price_to_earnings", "earning_yield", "price_to_sales", "price_to_fcf", "ev_to_ebitda", "ev_to_sales"), "NULL"),
}
_ANNUAL = {"graham_value": f"CASE WHEN eps_basic > 0 AND {_BVPS} > 0 THEN sqrt(22.5 * eps_basic * {_BVPS}) END", "price_to_earnings": "price / eps_basic", "earning_yield": "100 * eps_basic / price", "price_to_sales": f"{_CAP} / revenue", "price_to_fcf": f"CASE WHEN free_cash_flow > 0 THEN {_CAP} / free_cash_flow END", "ev_to_ebitda": f"CASE WHEN ebitda > 0 THEN {_EV} / ebitda END", "ev_to_sales": f"{_EV} / revenue"}
_SUMS = "s AS (SELECT l_suppkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS e, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS q, count(*) AS n FROM lineitem GROUP BY 1)"


def _supplier_figures(t, months: int) -> DataFrame:
    total = lambda c: F.sum(F.col(c).cast("decimal(18,2)")).cast("double")
    s = t("lineitem").groupBy("l_suppkey").agg(total("l_extendedprice").alias("e"), total("l_quantity").alias("q"), F.count("*").alias("n"))
    return s.select("l_suppkey", *[F.expr(f"cast({x} as double)").alias(k) for k, x in _INPUTS.items()], F.lit(months).alias("months"))


def _ratio_sql(formulas: dict[str, str]) -> str:
    inputs = ", ".join(f"CAST({x} AS DOUBLE) AS {k}" for k, x in _INPUTS.items())
    return f"WITH {_SUMS}, f AS (SELECT l_suppkey, {inputs} FROM s) SELECT l_suppkey, " + ", ".join(f"CAST({_UP.format(x)} AS DOUBLE) AS {k}" if x != "NULL" else f"CAST(NULL AS DOUBLE) AS {k}" for k, x in formulas.items()) + " FROM f"


@query(_ratio_sql(_RATIOS))
def interim_ratios(t):
    """Every ratio of nine-month periods with openings, prior year and price."""
    return metrics.ratios(_supplier_figures(t, 9), "price").select("l_suppkey", *_RATIOS)


@query(_ratio_sql(_ANNUAL))
def annual_ratios(t):
    """The ratios that only annual periods have."""
    return metrics.ratios(_supplier_figures(t, 12), "price").select("l_suppkey", *_ANNUAL)


#: What is printed of a period, in whole units, and what the fills make of it.
_PRINTED = {
    "revenue": "1000 + k", "cost_of_sales": "-(600 + k % 50)", "distribution_cost": "30", "admin_expenses": "CASE WHEN k % 2 = 0 THEN 20 END", "operating_profit": "CASE WHEN k % 3 > 0 THEN 250 END", "operating_expenses": "CASE WHEN k % 3 = 0 THEN 111 END", "cf_depreciation_amortization": "40", "cf_interest_income": "-15", "finance_cost": "25",
    "profit_before_tax": "200 + k", "taxation": "60", "levies": "CASE WHEN k % 5 = 0 THEN 3 END", "net_income_to_minority": "7", "loans_and_advances": "11", "other_receivables": "5", "inventory_raw_materials": "100", "inventory_work_in_progress": "CASE WHEN k % 2 = 0 THEN 50 END", "inventory_finished_goods": "70", "long_term_investments": "9",
    "short_term_borrowings": "80", "bank_overdraft": "CASE WHEN k % 4 = 0 THEN 8 END", "lease_liabilities_non_current": "33", "current_portion_lease_liabilities": "12", "current_portion_long_term_debt": "17", "long_term_debt_excl_leases": "120", "ppe_land": "1", "ppe_buildings": "2", "ppe_equipment": "3", "ppe_other": "4", "ppe_construction": "99",
    "total_current_assets": "700 + k", "total_non_current_assets": "900", "total_current_liabilities": "CASE WHEN k % 2 = 1 THEN 300 END", "total_non_current_liabilities": "CASE WHEN k % 2 = 1 THEN 200 END", "shareholders_equity": "CASE WHEN k % 3 > 0 THEN 640 END", "minority_interest": "CASE WHEN k % 3 = 1 THEN 60 END", "total_equity": "CASE WHEN k % 3 = 0 THEN 655 END",
    "share_capital": "1005", "par_value_per_share": "10", "cash_and_equivalents": "44", "net_receivables": "120", "change_in_working_capital": "90", "change_in_receivables": "20", "change_in_payables": "-6", "debt_issued": "70", "debt_repaid": "-30", "dividends_paid": "-25", "cash_from_operations": "310", "cash_from_investing": "-120", "cash_from_financing": "-55", "capital_expenditure": "-140",
}
_FILLED = {
    "gross_profit": "revenue - abs(cost_of_sales)", "selling_admin_expenses": "30 + coalesce(admin_expenses, 0)", "operating_expenses": "CASE WHEN k % 3 = 0 THEN 111 ELSE revenue - abs(cost_of_sales) - 250 END", "operating_profit": "CASE WHEN k % 3 = 0 THEN revenue - abs(cost_of_sales) - 111 ELSE 250 END", "depreciation_amortization": "40", "interest_income": "15",
    "ebitda": "40 + CASE WHEN k % 3 = 0 THEN revenue - abs(cost_of_sales) - 111 ELSE 250 END", "net_interest_expense": "10", "net_interest_income": "-10", "profit_after_tax": "CASE WHEN levies IS NULL THEN profit_before_tax - 60 END", "net_income_to_owners": "CASE WHEN levies IS NULL THEN profit_before_tax - 67 END", "other_short_term_receivables": "16", "total_inventory": "CASE WHEN k % 2 = 0 THEN 220 END", "investments_and_advances": "9",
    "short_term_debt": "80 + coalesce(bank_overdraft, 0)", "lease_liabilities": "45", "total_debt": "80 + coalesce(bank_overdraft, 0) + 17 + 120 + 45", "gross_ppe": "10", "total_assets": "1600 + k", "total_equity": "CASE k % 3 WHEN 0 THEN 655 WHEN 1 THEN 700 ELSE 640 END", "shareholders_equity": "CASE k % 3 WHEN 0 THEN 655 ELSE 640 END",
    "total_liabilities": "CASE WHEN k % 2 = 1 THEN 500 ELSE 1600 + k - CASE k % 3 WHEN 0 THEN 655 WHEN 1 THEN 700 ELSE 640 END END", "common_shares_outstanding": "101", "other_current_assets": "700 + k - 44 - 120 - 16 - CASE WHEN k % 2 = 0 THEN 220 ELSE 0 END", "net_income_continuing_ops": "CASE WHEN levies IS NULL THEN profit_before_tax - 60 END", "change_in_other_working_capital": "76", "net_issuance_of_debt": "40", "other_financing_activities": "-70", "net_change_in_cash": "135", "free_cash_flow": "170",
}
_CAST = "CAST({} AS DOUBLE) AS {}"


@query("WITH p AS (SELECT o_orderkey AS k, " + ", ".join(_CAST.format(x, n) for n, x in _PRINTED.items()).replace("k %", "o_orderkey %").replace(" + k", " + o_orderkey") + " FROM orders) SELECT k, " + ", ".join(_CAST.format(x, n) for n, x in _FILLED.items()) + " FROM p")
def filled_figures(t):
    """Every fill of the income statement, balance sheet and cash flow, in order."""
    printed = t("orders").withColumnRenamed("o_orderkey", "k").select("k", *[F.expr(f"cast({x} as double)").alias(n) for n, x in _PRINTED.items()])
    return metrics.fill(printed).select("k", *_FILLED)


@query("SELECT o_orderkey, x.item, CAST(0 AS DOUBLE) AS value FROM orders JOIN (VALUES " + _values([(i, a) for i, _, a in metrics.RUNTIME]).replace("True", "true").replace("False", "false") + ") x(item, annual) ON o_orderkey % 2 = 0 OR NOT x.annual")
def runtime_items(t):
    periods = t("orders").select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, 12).otherwise(9).alias("months"))
    return metrics.runtime_items(periods, ["o_orderkey"]).select("o_orderkey", "item", "value")


# ---- notices -------------------------------------------------------------------------------------------------------

#: Titles of notices with the kind that they are read as.
_NOTICES = [
    ("Board Meeting", "meeting"), ("Notice of the meeting of the Board of Directors", "meeting"), ("Board meeting revoked", None), ("Annual General Meeting", None), ("Disclosure of Interest by a Director", "insider"), ("PSX rule 5.6.4 filing", "insider"),
    ("Relevant Person Holding", "insider"), ("Financial Results for the year", "payout"), ("Payment of dividend", None), ("Credit of bonus shares", None), ("Closure of Share Transfer Books", "payout"), ("Unclaimed dividend", None), ("Material information", None),
]


@query(f"SELECT o_orderkey AS id, x.kind FROM orders JOIN (VALUES {_values([(i, k) for i, (_, k) in enumerate(_NOTICES)])}) x(i, kind) ON o_orderkey % {len(_NOTICES)} = x.i")
def notice_titles(t):
    return t("orders").select(F.col("o_orderkey").alias("id"), notices.notice_kind(_pick(F.col("o_orderkey"), [x for x, _ in _NOTICES])).alias("kind"))


#: Declarations in prose and list, DATE standing for the order's date; instalment, cash a share, cash, bonus and right percent, period, closure from and to the date, confidence.
_PAYOUTS = [
    ("The Board of Directors has recommended a final cash dividend of Rs. 6.00 per share (60%) for the year ended DATE. Register of members closed from DATE to DATE.", "final", 6.0, 60.0, None, None, "annual", 1, 0.85),
    ("The Board declared an interim dividend @ 2.5 per share i.e. 25 percent for the quarter ended DATE. This is in addition to the dividend already paid at Rs. 9 per share (90%).", "interim", 2.5, 25.0, None, None, "quarter", 0, 0.7),
    ("The Board recommended the following: (i) CASH DIVIDEND NIL (ii) BONUS SHARES at 15% (iii) RIGHT SHARES Nil (iv) ANY OTHER ENTITLEMENT NIL. Half year accounts.", "interim", None, 0.0, 15.0, 0.0, "half_year", 0, 0.7),
    ("No dividend has been announced for the year.", *[None] * 8),
    ("The Board approved a cash dividend of Rs. 3/- per share (20%). Share transfer books will remain closed from DATE.", None, 3.0, 20.0, None, None, None, 1, 0.75),
]


@query("SELECT o_orderkey AS id, x.instalment, CAST(x.per_share AS DOUBLE) AS cash_per_share, CAST(x.percent AS DOUBLE) AS cash_percent, CAST(x.bonus AS DOUBLE) AS bonus_percent, CAST(x.r AS DOUBLE) AS right_percent, x.period AS results_period, CASE WHEN x.closed = 1 THEN CAST(o_orderdate AS DATE) END AS closure_to, CAST(x.confidence AS DOUBLE) AS confidence"
       f" FROM orders JOIN (VALUES {_values([(i, *v) for i, (_, *v) in enumerate(_PAYOUTS)])}) x(i, instalment, per_share, percent, bonus, r, period, closed, confidence) ON o_orderkey % {len(_PAYOUTS)} = x.i WHERE x.confidence IS NOT NULL")
def payout_forms(t):
    text = F.replace(_pick(F.col("o_orderkey"), [x for x, *_ in _PAYOUTS]), F.lit("DATE"), F.date_format("o_orderdate", "MMMM d, yyyy"))
    return notices.payouts(_orders(t).select(F.col("o_orderkey").alias("id"), text.alias("text"))).select("id", "instalment", "cash_per_share", "cash_percent", "bonus_percent", "right_percent", "results_period", "closure_to", "confidence")


#: Announcements of meetings; time, purpose, period.  The last announces none.
_MEETINGS = [
    ("This is to inform you that a meeting of the Board of Directors of the Company will be held on Monday, DATE at 3:30 p.m. at Suite 602, to consider the accounts for the year ended 30-06-2024.", "15:30", "financial_results", "annual"),
    ("Board of Directors meeting is scheduled at 11 a.m. on DATE to consider matters other than the financial results", "11:00", "other", None),
    ("The Board of Directors of the Company will meet on DATE under clause 5.6.4", None, "other", None),
    ("A meeting of the Board has been convened on DATE at 2 for the half year results", "14:00", "financial_results", "half_year"),
    ("The annual general meeting will be held on DATE", None, None, None),
]


@query("SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS meeting_date, x.t AS meeting_time, x.purpose, x.period AS results_period"
       f" FROM orders JOIN (VALUES {_values([(i, *v) for i, (_, *v) in enumerate(_MEETINGS)])}) x(i, t, purpose, period) ON o_orderkey % {len(_MEETINGS)} = x.i WHERE x.purpose IS NOT NULL")
def meeting_forms(t):
    text = F.replace(_pick(F.col("o_orderkey"), [x for x, *_ in _MEETINGS]), F.lit("DATE"), F.date_format("o_orderdate", "d MMMM yyyy"))
    return notices.meetings(_orders(t).select(F.col("o_orderkey").alias("id"), text.alias("text"))).select("id", "meeting_date", "meeting_time", "purpose", "results_period")


# ---- columns, hints, sanity ----------------------------------------------------------------------------------------

#: Headers of a table of an income statement with year-end 30 June: headers, title, then month and day, months and reason of each (null: kept).
_COLUMNS = [
    (["June 30, {y}", "June 30, {p}"], "for the year ended", [("06-30", 12, None), ("06-30", 12, None)]),
    (["Nine months ended March 31, {y}", "Quarter ended March 31, {y}"], "", [("03-31", 9, None), ("03-31", 3, None)]),
    (["Half year ended {y}", "{p}"], "December 31", [("12-31", 6, None), ("12-31", None, "no length")]),
    (["July to March {y}", "{y}"], "as printed", [("03-31", 9, None), ("06-30", None, "no length")]),
    (["31 December {y}", "December 31, {y}"], "", [("12-31", 6, "two columns describe the same period")] * 2),
    (["Note", "{y}"], "", [(None, 12, "column period not printed"), ("06-30", 12, None)]),
    (["Year ended Quarter June 30, {y}", "June 30, {p}"], "", [("06-30", None, "no length"), ("06-30", None, "no length")]),
]


@query("SELECT o_orderkey AS filing, CAST(x.col AS INTEGER) AS col, CASE WHEN x.md IS NOT NULL AND NOT x.plain THEN CAST((year(o_orderdate) - x.back) || '-' || x.md AS DATE) END AS period_end, CAST(x.months AS INTEGER) AS months, x.reason"
       f" FROM orders JOIN (VALUES {_values([(i, c, md, m, r, int('{p}' in h[c]), 'f' if '{' in h[c] else 't') for i, (h, _, cols) in enumerate(_COLUMNS) for c, (md, m, r) in enumerate(cols)])}) v(i, col, md, months, reason, back, p) ON o_orderkey % {len(_COLUMNS)} = v.i, LATERAL (SELECT v.col, v.md, v.months, v.reason, v.back, v.p = 't' AS plain) x")
def described_columns(t):
    k = F.col("o_orderkey")
    year = F.year("o_orderdate")
    shown = lambda i: F.replace(F.replace(_pick(k, [h[i] for h, _, _ in _COLUMNS]), F.lit("{y}"), year.cast("string")), F.lit("{p}"), (year - 1).cast("string"))
    d = _orders(t).select(k.alias("filing"), F.lit(0).alias("table_no"), _each("col int, header string", (0, shown(0)), (1, shown(1))), _pick(k, [x for _, x, _ in _COLUMNS]).alias("title"))
    d = d.select("filing", "table_no", "x.*", "title", F.lit("income").alias("kind"), F.lit(True).alias("annual"), F.lit("06-30").alias("year_end"))
    return statements.described_columns(d).select("filing", "col", "period_end", "months", "reason")


@query("""
WITH s AS (SELECT o_orderkey AS filing, CASE WHEN o_orderkey % 2 = 0 THEN 'income' ELSE 'balance' END AS kind, CASE o_orderkey % 3 WHEN 0 THEN 'unknown' WHEN 1 THEN 'consolidated' ELSE 'unconsolidated' END AS basis FROM orders),
h AS (SELECT o_orderkey AS filing, 'income' AS kind, CASE WHEN o_orderkey % 5 = 0 THEN 'consolidated' END AS basis FROM orders WHERE o_orderkey % 5 < 2)
SELECT filing, kind, basis, false AS hinted FROM s WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.filing = s.filing AND h.kind = s.kind AND (h.basis IS NULL OR h.basis = s.basis OR s.basis = 'unknown')) UNION ALL SELECT filing, kind, coalesce(basis, 'unknown'), true FROM h""")
def page_hints(t):
    k = F.col("o_orderkey")
    own = t("orders").select(k.alias("filing"), F.when(k % 2 == 0, "income").otherwise("balance").alias("kind"), _pick(k, ["unknown", "consolidated", "unconsolidated"]).alias("basis"), F.array(F.lit(3)).alias("pages"))
    hints = t("orders").where(k % 5 < 2).select(k.alias("filing"), F.lit("income").alias("kind"), F.when(k % 5 == 0, "consolidated").alias("basis"), F.array(F.lit(7)).alias("pages"))
    return statements.hinted_pages(own, hints).drop("pages")


#: A sound period in thousands of k, and what each order changes of it, with the flags that it raises.
_SOUND = {"revenue": "1000", "gross_profit": "400", "cost_of_sales": "600", "total_current_assets": "900", "total_current_liabilities": "500", "total_assets": "2000", "profit_before_tax": "100", "taxation": "30", "eps_basic": "0.7", "profit_after_tax": "70", "common_shares_outstanding": "100", "cash_and_equivalents": "50", "net_receivables": "200", "total_inventory": "300", "net_ppe": "1000", "total_liabilities": "1100", "total_equity": "900"}
_CHANGED = [({}, []), ({"gross_profit": "1001"}, ["S1"]), ({"cost_of_sales": "2001"}, ["S2"]), ({"total_current_liabilities": "0"}, ["S3"]), ({"total_assets": "-1"}, ["S4", "S7", "S9"]), ({"taxation": "-101"}, ["S5"]), ({"eps_basic": "0.6"}, ["S6"]), ({"eps_basic": "-0.7"}, ["S6", "S8"]), ({"total_inventory": "901"}, ["S7"]), ({"net_ppe": "2001"}, ["S7"]), ({"total_equity": "2001"}, ["S9"]), ({"revenue": "-5", "gross_profit": "9"}, [])]


@query(f"SELECT o_orderkey, x.flag FROM orders JOIN (VALUES {_values([(i, f) for i, (_, fs) in enumerate(_CHANGED) for f in fs])}) x(i, flag) ON o_orderkey % {len(_CHANGED)} = x.i")
def sanity_flags(t):
    """Sound periods with one figure changed in each."""
    k = F.col("o_orderkey")
    columns = [_pick(k, [float(c.get(item, v)) for c, _ in _CHANGED]).alias(item) for item, v in _SOUND.items()]
    return constraints.sanity(t("orders").select("o_orderkey", *columns), ["o_orderkey"])
