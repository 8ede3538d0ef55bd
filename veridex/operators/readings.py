"""Readings of a page by a model, kept only as far as the page itself bears them out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.dealt import dealt
from ..sources.scratch import written

# A nil, a printed number, lengths of periods, days from the filing's period, items per share, by magnitude and
# never negative, and the room of an identity: two units, or a share of the figure.
NIL, NUMBER = r"^[-–—]$", r"^\(?-?\d{1,3}(?:,\d{3})*(?:\.\d+)?\)?$|^\(?-?\d+(?:\.\d+)?\)?$"
MONTHS, PERIOD_DAYS = (3, 6, 9, 12), 540
PER_SHARE = ("eps_basic", "eps_diluted")
ROOM_UNITS, ROOM_SHARE = 2, 0.002
PAGE = ("filing", "statement")
BROKEN = "breaks an identity"


def number_pattern(token: Column) -> Column:
    """A pattern of a printed number that is not part of a longer one; brackets around it may be anything."""
    bare = F.regexp_replace(token, r"^\(|\)$", "")
    return F.concat(F.lit(r"(?<![0-9,.])\Q"), bare, F.lit(r"\E(?![0-9,]|\.[0-9])"))


def column_problem(column: Column, kind: Column, heading: Column, filed: Column) -> Column:
    """Why a column that a model describes (struct of period_end, a string, and months) is not kept; null if it is."""
    day = F.when(column["period_end"].rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(column["period_end"], "yyyy-MM-dd"))
    year = F.substring(column["period_end"], 1, 4)
    return (
        F.when(day.isNull(), "not a date").when((kind != "balance") & ~F.coalesce(column["months"].isin(*MONTHS), F.lit(False)), "no period length").when(~F.contains(heading, year), "not in the heading")
        .when(F.abs(F.datediff(day, filed)) > PERIOD_DAYS, "too far from the filing's period")
    )


def _read(readings: DataFrame, lines: DataFrame) -> DataFrame:
    """Readings with the ``line`` that prints them or the ``reason`` why they are dropped, dealt out by filing and statement."""
    # a page's lines meet the items of that page, both a page's size: they are dealt out together and each item looks through the lines
    fields = [c for c in readings.columns if c not in PAGE]
    every = readings.select(*PAGE, F.struct(*fields).alias("_item")).unionByName(lines.where(F.col("text").rlike("[0-9]")).select(*PAGE, F.struct("page", "line_no", "text").alias("_line")), allowMissingColumns=True)
    pages = dealt(every, *PAGE).groupBy(*PAGE).agg(F.collect_list("_item").alias("_items"), F.sort_array(F.collect_list("_line")).alias("_lines"))
    # where a key is null nothing is known to be on one page
    known = F.col("filing").isNotNull() & F.col("statement").isNotNull()
    pages = pages.withColumn("_lines", F.when(known, F.col("_lines")).otherwise(F.slice("_lines", 1, 0)))
    r = pages.select(*PAGE, F.explode("_items").alias("_item"), "_lines").select(*PAGE, "_item.*", "_lines")
    given = F.filter("values", lambda v: v.isNotNull() & ~F.trim(v).rlike(NIL))
    r = r.withColumn("_tokens", F.transform(given, lambda v: F.trim(v))).withColumn("_patterns", F.transform("_tokens", number_pattern))
    wrong = F.when(F.size("values") != F.col("n_columns"), "another number of values than columns").when(F.exists("_tokens", lambda v: ~v.rlike(NUMBER)), "a value is no number")
    r = r.withColumn("_wrong", wrong)
    asked = F.col("_wrong").isNull() & (F.size("_tokens") > 0)
    on = lambda pattern: lambda x: F.regexp_like(x["text"], pattern)
    r = r.withColumn("line", F.when(asked, F.get(F.filter("_lines", on(F.array_join("_patterns", ".*?"))), F.lit(0))))
    missing = F.exists("_patterns", lambda p: ~F.exists("_lines", on(p)))
    reason = F.coalesce("_wrong", F.when(asked & F.col("line").isNull(), F.when(missing, "a value is not on the page").otherwise("the values are not on one line")))
    return r.select(*readings.columns, "line", reason.alias("reason"))


def read_items(readings: DataFrame, lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items with the line that prints them, items dropped with the reason).

    ``readings``: filing, statement, item, values (strings as printed, one a column), n_columns; ``lines``: filing, statement, page, line_no, text.
    All values of an item that are not nil must stand on one printed line, whole and in order; the first such line counts.
    """
    out = _read(readings, lines)
    return out.where("reason is null").select(*readings.columns, "line"), out.where("reason is not null").select(*PAGE, "item", "reason")


def verified(readings: DataFrame, lines: DataFrame, columns: DataFrame, magnitudes: tuple[str, ...], never_negative: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """(figures, dropped) of a model's readings of statements.

    ``columns``: filing, statement, columns (array of period_end, months), heading, filed (a date), unit.  Figures: filing, statement,
    period_end, months, item, value, page, line_no.  Of a period, revenue, cost and gross profit that don't agree all go; a tax that
    agrees as neither charge nor credit goes alone.
    """
    c = columns.select(*PAGE, "unit", F.posexplode("columns").alias("col", "c"), "heading", "filed")
    months = F.when(F.col("statement") == "balance", 0).otherwise(F.col("c.months")).cast("int")
    kept = dealt(c.where(column_problem(F.col("c"), F.col("statement"), F.col("heading"), F.col("filed")).isNull()).select(*PAGE, F.struct("col", F.to_date("c.period_end").alias("period_end"), months.alias("months"), "unit").alias("_k")), *PAGE)
    # what is dealt out by filing and statement meets without a further shuffle: columns, periods and identities
    read = _read(readings, lines).join(kept.groupBy(*PAGE).agg(F.collect_list("_k").alias("_kept")), list(PAGE), "left")
    cells = F.flatten(F.transform("values", lambda v, i: F.transform(F.filter("_kept", lambda k: k["col"] == i), lambda k: F.struct(v.alias("text"), k["period_end"].alias("period_end"), k["months"].alias("months"), k["unit"].alias("unit")))))
    cells = F.when(F.col("reason").isNull(), F.filter(cells, lambda x: x["text"].isNotNull()))
    cell = read.select(*PAGE, "item", "line", "reason", F.explode_outer(cells).alias("x")).where("reason is not null or x is not null").select(*PAGE, "item", "line.page", "line.line_no", "reason", "x.*")
    text = F.trim("text")
    plain = F.regexp_replace(text, r"[(),\s-]", "").try_cast("double")
    value = F.when(text.rlike(NIL), F.lit(0.0)).when(text.rlike(r"^[(-]"), -plain).otherwise(plain)
    value = F.when(F.col("item").isin(*PER_SHARE), value).otherwise(value * F.col("unit"))
    cell = cell.withColumn("value", F.when(F.col("item").isin(*magnitudes), F.abs(value)).otherwise(value))
    bad = F.col("item").isin(*never_negative) & (F.col("value") < 0)
    cell = cell.withColumn("reason", F.coalesce("reason", F.when(bad, "negative")))
    period = [*PAGE, "period_end", "months"]
    of = lambda i: F.max(F.when(F.col("reason").isNull() & (F.col("item") == i), F.col("value"))).over(Window.partitionBy(*period))
    names = ("revenue", "cost_of_sales", "gross_profit", "profit_before_tax", "taxation", "profit_after_tax")
    cell = cell.withColumns({**{f"_{i}": of(i) for i in names}, "_unit": F.max(F.when(F.col("reason").isNull(), F.col("unit"))).over(Window.partitionBy(*period))})
    near = lambda a, b: F.abs(a - F.col(b)) <= F.greatest(F.abs(b) * ROOM_SHARE, F.col("_unit") * ROOM_UNITS)
    gross = ~near(F.col("_revenue") - F.col("_cost_of_sales"), "_gross_profit")
    tax = ~near(F.col("_profit_before_tax") - F.col("_taxation"), "_profit_after_tax") & ~near(F.col("_profit_before_tax") + F.col("_taxation"), "_profit_after_tax")
    broken = (F.col("item").isin("revenue", "cost_of_sales", "gross_profit") & gross) | ((F.col("item") == "taxation") & tax)
    cell = cell.withColumn("reason", F.coalesce("reason", F.when(broken, BROKEN)))
    # figures and what is dropped are read from one table
    cell = written(cell.select(*period, "item", "value", "page", "line_no", "reason"), "model-figures")
    gone = cell.where(F.col("reason") == BROKEN).select(*period, "item", "reason").distinct()
    dropped = cell.where(F.col("reason") != BROKEN).select(*PAGE, "item", "reason").unionByName(gone.select(*PAGE, "item", "reason"))
    return cell.where("reason is null").select(*period, "item", "value", "page", "line_no"), dropped
