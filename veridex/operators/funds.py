"""Daily fund tables: HTML tables to rows, keyed pages, five page readers, and the merged snapshot."""

from __future__ import annotations

import html as entities
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import split_category
from .joins import merge_by_key

CELLS = "page_id long, table_no int, row int, cells array<string>, hrefs array<string>, handlers array<string>"

# What each page must show in its header, the labels of returns with their keys, and how a row names its fund.
REQUIRED = {
    "performance": ("category", "rating", "validity date", "nav", "ytd"),
    "prices": ("offer", "repurchase", "nav", "validity date"),
    "payouts": ("payout (per unit)", "ex-nav", "payout date"),
    "expenses": ("ter mtd %", "ter ytd %", "mf %", "s&m %"),
    "monthly_aum": ("fund name", "category", "inception date"),
}
RETURNS = {"ytd": "ytd", "mtd": "mtd", "1 day": "d1", "15 days": "d15", "30 days": "d30", "90 days": "d90", "180 days": "d180", "270 days": "d270", "365 days": "d365", "2 years": "y2", "3 years": "y3"}
FUND_LINK, FUND_HANDLER = r"(?i)FundDetail\?FundID=([0-9]+)", r"getAssetAllocation\(\s*([0-9]+)\s*,"
CHALLENGE = r"(?i)<title>[^<]*(just a moment|attention required|access denied)"


class _Tables(HTMLParser):
    """Tables of a page as rows of cell texts with the row's links and handlers; a line break is a space."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[tuple[int, int, list[str], list[str], list[str]]] = []
        self.open: list[dict] = []
        self.count = 0

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "table":
            self.open.append({"no": self.count, "row": -1, "cells": None, "cell": None, "hrefs": [], "handlers": []})
            self.count += 1
        elif self.open:
            t = self.open[-1]
            if tag == "tr":
                self._end_row(t)
                t.update(row=t["row"] + 1, cells=[], cell=None, hrefs=[], handlers=[])
            elif tag in ("td", "th"):
                self._end_cell(t)
                t["cell"] = [] if t["cells"] is not None else None
            elif tag == "br" and t["cell"] is not None:
                t["cell"].append(" ")
            if a.get("href"):
                t["hrefs"].append(a["href"])
            if a.get("onclick"):
                t["handlers"].append(a["onclick"])

    def handle_endtag(self, tag):
        if not self.open:
            return
        t = self.open[-1]
        if tag in ("td", "th"):
            self._end_cell(t)
        elif tag == "tr":
            self._end_row(t)
        elif tag == "table":
            self._end_row(t)
            self.open.pop()

    def handle_data(self, data):
        if self.open and self.open[-1]["cell"] is not None:
            self.open[-1]["cell"].append(data)

    @staticmethod
    def _end_cell(t):
        if t["cell"] is not None:
            t["cells"].append(" ".join("".join(t["cell"]).split()))
            t["cell"] = None

    def _end_row(self, t):
        self._end_cell(t)
        if t["cells"]:
            self.rows.append((t["no"], t["row"], t["cells"], t["hrefs"], t["handlers"]))
        t["cells"] = None


def html_tables(pages: DataFrame) -> DataFrame:
    """(page_id, html) to one row for each table row; the tag walk is stateful, so it runs on Arrow batches."""
    names = ["page_id", "table_no", "row", "cells", "hrefs", "handlers"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.list_(pa.string())] * 3]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for page, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                p = _Tables()
                p.feed(text or "")
                p.close()
                out += [(page, *r) for r in p.rows]
            columns = zip(*out) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)

    return pages.select("page_id", "html").mapInArrow(run, CELLS)


def decode_entities(text: str) -> str:
    return entities.unescape(text)


def normal(label: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(label), r"\s+", " "))


def keyed_rows(cells: DataFrame, required: Sequence[str], strict: bool = True) -> DataFrame:
    """Rows of the first table that has a row with all required labels, as a map from label to cell, with the fund's id.

    The id is in the first link that names one, else in the first such handler.  A row of another width, or without an id,
    is not read.  A page without such a table, as a challenge page is, is a shape error.
    """
    labels = F.transform("cells", normal)
    want = F.array(*[F.lit(r) for r in required])
    marked = cells.withColumn("labels", labels).withColumn("is_header", F.size(F.array_except(want, "labels")) == 0)
    header = marked.where("is_header").groupBy("page_id").agg(F.min(F.struct("table_no", "row", "labels")).alias("h"))
    pages = cells.select("page_id").distinct().join(header, "page_id", "left")
    if strict:
        pages = pages.withColumn("h", F.when(F.col("h").isNull(), F.raise_error(F.concat(F.lit("no table with the required labels on page "), F.col("page_id").cast("string")))).otherwise(F.col("h")))
    rows = marked.join(pages.where("h is not null"), "page_id").where((F.col("table_no") == F.col("h.table_no")) & (F.col("row") > F.col("h.row")) & (F.size("cells") == F.size("h.labels")))
    named = lambda of, pattern: F.regexp_extract(F.try_element_at(F.filter(of, lambda x: x.rlike(pattern)), F.lit(1)), pattern, 1)
    fund = F.coalesce(named("hrefs", FUND_LINK), named("handlers", FUND_HANDLER)).try_cast("int")
    # of a label that stands twice the later cell counts
    entry = F.map_from_entries(F.transform(F.array_distinct("h.labels"), lambda x: F.struct(x, F.element_at("cells", F.size("h.labels") + 1 - F.array_position(F.reverse("h.labels"), x).cast("int")))))
    return rows.select("page_id", "row", fund.alias("fund_id"), entry.alias("m")).where("fund_id is not null")


def number(text: Column) -> Column:
    """A fund page's number: commas dropped, anything but a plain number is null."""
    t = F.trim(F.replace(text, F.lit(","), F.lit("")))
    return F.when(t.rlike(r"^-?[0-9]+(\.[0-9]+)?$"), t.try_cast("double"))


def day(text: Column) -> Column:
    """'Oct 09, 2026' or with the month in full; anything else is null."""
    m = r"^([A-Za-z]{3})[a-z]*\s+([0-9]{1,2}),\s*([0-9]{4})$"
    t = F.trim(text)
    part = lambda i: F.regexp_extract(t, m, i)
    return F.when(t.rlike(m), F.try_to_date(F.concat_ws(" ", F.initcap(part(1)), part(2), part(3)), "MMM d yyyy"))


def _cell(name: str) -> Column:
    return F.coalesce(F.col("m")[name], F.lit(""))


def _text(name: str) -> Column:
    """A cell's text, null for a dash or n/a."""
    t = F.trim(F.col("m")[name])
    return F.when(~t.rlike(r"(?i)^(n/a|-+)?$"), t)


def _name() -> Column:
    return F.trim(F.coalesce(F.col("m")["fund name"], F.col("m")["fund"], F.lit(""))).alias("name")


def performance(rows: DataFrame) -> DataFrame:
    category, kind = split_category(_cell("category"))
    labels = list(RETURNS)
    pairs = F.map_from_arrays(F.array(*[F.lit(RETURNS[p]) for p in labels]), F.array(*[F.struct(F.map_contains_key("m", p).alias("shown"), number(F.col("m")[p]).alias("v")) for p in labels]))
    returns = F.transform_values(F.map_filter(pairs, lambda _, x: x["shown"]), lambda _, x: x["v"])
    return rows.select("fund_id", _name(), _cell("sector").alias("sector"), category.alias("category"), kind.alias("return_basis"), _text("rating").alias("rating"), _text("benchmark").alias("benchmark"), day(F.col("m")["validity date"]).alias("validity_date"), number(F.col("m")["nav"]).alias("nav"), returns.alias("returns"))


def prices(rows: DataFrame) -> DataFrame:
    loads = [_text(label).alias(name) for label, name in (("front-end", "front_end_load"), ("back-end", "back_end_load"), ("contingent", "contingent_load"), ("market", "market_load"), ("trustee", "trustee"))]
    return rows.select("fund_id", _name(), *[_cell(n).alias(n) for n in ("sector", "amc", "category")], day(F.col("m")["inception date"]).alias("inception_date"), *[number(F.col("m")[n]).alias(n) for n in ("offer", "repurchase", "nav")], day(F.col("m")["validity date"]).alias("validity_date"), *loads)


def payouts(rows: DataFrame) -> DataFrame:
    return rows.select("fund_id", _name(), number(F.col("m")["payout (per unit)"]).alias("payout_per_unit"), number(F.col("m")["ex-nav"]).alias("ex_nav"), day(F.col("m")["payout date"]).alias("payout_date"))


def expenses(rows: DataFrame) -> DataFrame:
    pct = [number(F.col("m")[label]).alias(name) for label, name in (("ter mtd %", "ter_mtd_pct"), ("ter ytd %", "ter_ytd_pct"), ("mf %", "management_fee_pct"), ("s&m %", "selling_marketing_pct"))]
    return rows.select("fund_id", _name(), number(F.col("m")["nav"]).alias("nav"), day(F.col("m")["validity date"]).alias("validity_date"), *pct)


def monthly_aum(rows: DataFrame) -> DataFrame:
    """Assets by month; the month is in the heading of the amount's column, without which the page is a shape error."""
    heading = F.try_element_at(F.filter(F.map_keys("m"), lambda k: k.rlike("rupees in million")), F.lit(1))
    m = r"([a-z]+)-([0-9]{4})"
    month = F.date_format(F.try_to_date(F.concat_ws(" ", F.initcap(F.substring(F.regexp_extract(heading, m, 1), 1, 3)), F.regexp_extract(heading, m, 2)), "MMM yyyy"), "yyyy-MM")
    month = F.coalesce(month, F.raise_error(F.lit("monthly AUM: no column of a month in millions")).cast("string"))
    return rows.select(month.alias("month"), "fund_id", _name(), F.coalesce(F.col("m")["amc name"], _cell("amc")).alias("amc"), _cell("category").alias("category"), day(F.col("m")["inception date"]).alias("inception_date"), number(F.element_at("m", heading)).alias("aum_pkr_millions"))


def refusal(body: Column, status: Column) -> Column:
    """challenge, blocked or other of a response that is no page; null for a page."""
    return F.when(body.rlike(CHALLENGE), "challenge").when(status.isin(401, 403, 429), "blocked").when(status >= 400, "other")


def snapshot(perf: DataFrame, price: DataFrame, expense: DataFrame) -> DataFrame:
    """One row a fund over the performance and price pages; of repeated ids on a page the last row counts (by ``place``, its
    number on the page, where there is one, else the greatest row)."""

    def last(df: DataFrame) -> DataFrame:
        rest = [c for c in df.columns if c not in ("fund_id", "place")]
        by = F.col("place") if "place" in df.columns else F.to_json(F.struct(*rest))
        return df.groupBy("fund_id").agg(F.max_by(F.struct(*rest), by).alias("x")).select("fund_id", "x.*")

    return merge_by_key(last(perf), last(price), last(expense), "fund_id", ("name", "sector", "category"), ("nav", "validity_date"))
