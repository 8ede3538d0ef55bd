"""Items read line by line from page text, as the first version read them: scored aliases and registers carried down the lines.

The registers (section, its basis and unit, the banner's basis, the place of the current year's column) are last values over one window of
a filing's lines; a line's item is the first alias of its section, one CASE.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.num import finite, percent, round_decimal
from ..sources.dealt import dealt

# The aliases in order, by statement, each with its confidence; what a line of revenue must not hold.
ALIASES = (
    ("income", "revenue", 0.9, r"\b(revenue|turnover|net\s+sales|sales)\b"),
    ("income", "cost_of_sales", 0.88, r"\bcost\s+of\s+(sales|goods\s+sold|revenue|services\s+rendered)\b"),
    ("income", "gross_profit", 0.88, r"\bgross\s+profit\b"),
    ("income", "selling_admin_expenses", 0.85, r"\b(selling\s*(?:,|and|&)\s*(?:distribution\s*(?:,|and|&)\s*)?administrative\s+expenses|administrative\s*(?:,|and|&)\s*selling\s+expenses)\b"),
    ("income", "distribution_cost", 0.82, r"\b(distribution\s+(?:cost|expenses?)|selling\s+(?:and\s+distribution\s+)?expenses?|selling\s+cost)\b"),
    ("income", "admin_expenses", 0.82, r"\b(administrative\s+expenses?|general\s+and\s+administrative\s+expenses?)\b"),
    ("income", "rd_expenses", 0.85, r"\b(research\s+and\s+development\s+expenses?|r\s*&\s*d\s+expenses?)\b"),
    ("income", "depreciation_amortization", 0.8, r"\bdepreciation\s*(?:and|&)\s*amorti[sz]ation\b"),
    ("income", "other_operating_expenses", 0.8, r"\bother\s+operating\s+expenses?\b"),
    ("income", "other_income", 0.78, r"\bother\s+income\b"),
    ("income", "operating_expenses", 0.8, r"\btotal\s+operating\s+expenses?\b"),
    ("income", "operating_profit", 0.88, r"\b(operating\s+profit|profit\s+from\s+operations|ebit)\b"),
    ("income", "ebitda", 0.85, r"\bebitda\b"),
    ("income", "interest_income", 0.78, r"\b(interest\s+income|return\s+on\s+(?:bank\s+)?deposits)\b"),
    ("income", "finance_cost", 0.86, r"\b(finance\s+cost|financial\s+charges?|mark-?up)\b"),
    ("income", "profit_before_tax", 0.9, r"\bprofit\s+before\s+(?:income\s+)?(?:tax|taxation)\b"),
    ("income", "profit_after_tax", 0.92, r"\b(profit\s+after\s+(tax|taxation)|profit\s+for\s+the\s+(year|period)|net\s+income)\b"),
    ("income", "taxation", 0.85, r"\b(taxation|income\s+tax\s+expense|provision\s+for\s+taxation)\b"),
    ("income", "preferred_dividends", 0.82, r"\b(preferen[cs]e\s+(?:share\s+)?dividends?|dividend\s+on\s+preference\s+shares|preferred\s+dividends?)\b"),
    ("income", "eps_diluted", 0.9, r"\bdiluted\b.{0,30}\b(earnings?\s+per\s+share|eps)\b|\b(earnings?\s+per\s+share|eps)\b.{0,30}\bdiluted\b"),
    ("income", "eps_basic", 0.9, r"\b(?:basic\s+)?(earnings?\s+per\s+share|eps)\b"),
    ("balance", "total_assets", 0.9, r"\btotal\s+assets\b"),
    ("balance", "current_assets", 0.84, r"(?<!non[-\s])\bcurrent\s+assets\b"),
    ("balance", "property_plant_equipment", 0.82, r"\bproperty,?\s+plant\s+and\s+equipment\b"),
    ("balance", "stock_in_trade", 0.8, r"\b(stock[-\s]in[-\s]trade|inventor(?:y|ies))\b"),
    ("balance", "trade_debts", 0.8, r"\b(trade\s+debts?|trade\s+receivables?)\b"),
    ("balance", "total_liabilities", 0.9, r"\btotal\s+liabilit(?:y|ies)\b"),
    ("balance", "current_liabilities", 0.84, r"(?<!non[-\s])\bcurrent\s+liabilit(?:y|ies)\b"),
    ("balance", "trade_and_other_payables", 0.8, r"\btrade\s+and\s+other\s+payables\b"),
    ("balance", "short_term_borrowings", 0.8, r"\bshort[-\s]term\s+borrowings?\b"),
    ("balance", "long_term_debt", 0.8, r"\blong[-\s]term\s+(?:debt|financing|borrowings?)\b"),
    ("balance", "total_debt", 0.88, r"\b(total\s+(?:debt|borrowings)|borrowings\s+total)\b"),
    ("balance", "share_capital", 0.8, r"\b(issued,?\s+subscribed\s+and\s+paid[-\s]up\s+capital|share\s+capital)\b"),
    ("balance", "retained_earnings", 0.8, r"\b(retained\s+earnings|unappropriated\s+profit|accumulated\s+(?:profit|loss))\b"),
    ("balance", "non_controlling_interest", 0.82, r"\bnon[-\s]controlling\s+interests?\b"),
    ("balance", "total_equity", 0.9, r"\b(total\s+equity(?!\s+and\s+liabilit)|shareholders'? equity|equity\s+attributable)\b"),
    ("balance", "cash_and_bank", 0.86, r"\b(cash\s+and\s+bank|cash\s+and\s+cash\s+equivalents|bank\s+balances?)\b"),
    ("cash_flow", "operating_cash_flow", 0.9, r"\b(net\s+cash.{0,45}operating\s+activities|cash\s+flows?\s+from\s+operating)\b"),
    ("cash_flow", "capital_expenditure", 0.78, r"\b(?:purchase|acquisition|additions?)\s+of\s+(?:property,?\s+plant\s+and\s+equipment|fixed\s+assets)\b"),
    ("cash_flow", "investing_cash_flow", 0.9, r"\b(net\s+cash.{0,45}investing\s+activities|cash\s+flows?\s+from\s+investing)\b"),
    ("cash_flow", "dividend_paid", 0.8, r"\bdividends?\s+paid\b"),
    ("cash_flow", "financing_cash_flow", 0.9, r"\b(net\s+cash.{0,45}financing\s+activities|cash\s+flows?\s+from\s+financing)\b"),
)
#: Words, one of which every text of an item's alias holds (in small letters): a line without them is not put to its pattern.
ALIAS_WORDS = {
    "revenue": ("revenue", "turnover", "sales"), "cost_of_sales": ("cost",), "gross_profit": ("gross",), "selling_admin_expenses": ("administrative",), "distribution_cost": ("distribution", "selling"), "admin_expenses": ("administrative",),
    "rd_expenses": ("development", "&"), "depreciation_amortization": ("depreciation",), "other_operating_expenses": ("other",), "other_income": ("other",), "operating_expenses": ("operating",), "operating_profit": ("operati", "ebit"), "ebitda": ("ebitda",),
    "interest_income": ("interest", "deposits"), "finance_cost": ("financ", "mark"), "profit_before_tax": ("before",), "profit_after_tax": ("after", "for the", "net"), "taxation": ("tax",), "preferred_dividends": ("dividend",), "eps_diluted": ("diluted",), "eps_basic": ("earning", "eps"),
    "total_assets": ("total",), "current_assets": ("current",), "property_plant_equipment": ("plant",), "stock_in_trade": ("stock", "inventor"), "trade_debts": ("trade",), "total_liabilities": ("total",), "current_liabilities": ("current",), "trade_and_other_payables": ("payables",),
    "short_term_borrowings": ("short",), "long_term_debt": ("long",), "total_debt": ("total",), "share_capital": ("capital",), "retained_earnings": ("retained", "unappropriated", "accumulated"), "non_controlling_interest": ("controlling",), "total_equity": ("equity",), "cash_and_bank": ("cash", "bank"),
    "operating_cash_flow": ("cash",), "capital_expenditure": ("purchase", "acquisition", "addition"), "investing_cash_flow": ("cash",), "dividend_paid": ("dividend",), "financing_cash_flow": ("cash",),
}
NOT_REVENUE = r"\b(cost\s+of\s+sales|sales\s+tax|selling\s+and\s+distribution|profit\s+for\s+the|profit\s+after\s+tax)\b"
# Lines that open a statement, that name the basis of those below, and that end what can be read; units.
_BASIS = r"^(consolidated\s+|un-?consolidated\s+|separate\s+)?"
SECTIONS = (
    ("income", _BASIS + r"(statement\s+of\s+(profit\s+or\s+loss|income)|profit\s+and\s+loss|income\s+statement)\b"), ("balance", _BASIS + r"(statement\s+of\s+financial\s+position|balance\s+sheet)\b"),
    ("cash_flow", _BASIS + r"(statement\s+of\s+cash\s+flows?|cash\s+flow\s+statement)\b"),
)
BANNER = r"^(consolidated|un-?consolidated|separate|standalone)\s+(?:condensed\s+interim\s+)?financial\s+statements?\b"
BOUNDARY = r"^(notes?\s+to\b|directors?'?\s+report|statement\s+of\s+changes|shareholding\s+pattern)\b"
HIGHLIGHTS = r"\bfinancial\s+highlights\b|\byear\s+at\s+a\s+glance\b|\b(?:six|6)[\s-]years?'?\s+summary\b|\bkey\s+(?:financial\s+)?(?:data|indicators)\b|\bhorizontal\s+analysis\b|\bvertical\s+analysis\b"
HIGHLIGHT_WORDS = ("highlights", "glance", "summary", "key", "analysis")
_UNIT = r"\b(?:amounts?|figures?|rupees?|rs\.?|pkr)[^a-z0-9]{0,8}(?:are\s+)?(?:stated\s+)?(?:in\s+)?"
MILLIONS, THOUSANDS = _UNIT + r"(?:millions?|mn)\b", _UNIT + r"(?:thousands?|['’‘]?000s?)\b"
MILLION_WORDS, THOUSAND_WORDS = ("million", "mn"), ("thousand", "000")
#: Letters beside A to Z that a pattern takes for these whatever their case, and what they are taken for.
LIKE_ASCII = ("\u017f\u212a\u0130\u0131", "skii")
#: Items that count by magnitude, items that can't be negative, items per share, lines that a section lasts.
MAGNITUDES = ("cost_of_sales", "distribution_cost", "admin_expenses", "selling_admin_expenses", "rd_expenses", "depreciation_amortization", "other_operating_expenses", "operating_expenses", "finance_cost", "taxation")
NEVER_NEGATIVE = ("revenue", "gross_profit", "total_assets", "current_assets", "property_plant_equipment", "stock_in_trade", "trade_debts", "cash_and_bank", "total_liabilities", "current_liabilities", "trade_and_other_payables", "short_term_borrowings", "long_term_debt", "total_debt", "share_capital")
PER_SHARE, SECTION_LINES = ("eps_basic", "eps_diluted"), 120
#: Confidence of a page without its own, above which nothing goes, from which a line is promoted; what its section, another and a second figure change.
PAGE, MOST, PROMOTED, WITHIN, OUTSIDE, SEVERAL = 0.8, 0.99, 0.75, 0.06, -0.18, 0.03
#: Items made of two others where they are not printed: a sign joins them, or a percentage.
DERIVED = (
    ("balance", "total_equity", "total_assets", "total_liabilities", -1), ("income", "operating_expenses", "gross_profit", "operating_profit", -1), ("income", "selling_admin_expenses", "distribution_cost", "admin_expenses", 1),
    ("income", "ebitda", "operating_profit", "depreciation_amortization", 1), ("income", "net_interest_income", "interest_income", "finance_cost", -1),
)
PERCENTAGES = (("gross_margin_pct", "gross_profit", "revenue"), ("operating_margin_pct", "operating_profit", "revenue"), ("net_margin_pct", "profit_after_tax", "revenue"), ("tax_rate_pct", "taxation", "profit_before_tax"))


def _any_case(pattern: str) -> str:
    return f"(?iu){pattern}"


def small(text: Column) -> Column:
    """``text`` in small letters, as patterns of any case take them."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.lower(F.translate(text, *LIKE_ASCII)))


def matches(text: Column, low: Column, pattern: str, words: tuple[str, ...]) -> Column:
    """Whether ``pattern`` is found in ``text``; only asked where ``low``, the text in small letters, holds one of the ``words`` that it needs."""
    return reduce(or_, [low.contains(w) for w in words]) & text.rlike(_any_case(pattern))


def apart(f: Callable[[Column], Column], **values: Column) -> Column:
    """An array of ``f`` of a struct of ``values``.  A lambda is evaluated node by node; dozens of patterns as generated code are one
    method, longer than what the JVM compiles, and interpreted for each line."""
    return F.transform(F.array(F.struct(*[v.alias(n) for n, v in values.items()])), f)


def unit(text: Column, low: Column) -> Column:
    return F.when(matches(text, low, MILLIONS, MILLION_WORDS), 1_000_000).when(matches(text, low, THOUSANDS, THOUSAND_WORDS), 1_000).otherwise(1)


def _basis(word: Column) -> Column:
    word = F.trim(word)
    return F.when(word.rlike(r"(?i)^(un-?consolidated|separate|standalone)$"), "unconsolidated").when(word != "", "consolidated")


def candidates(pages: DataFrame) -> DataFrame:
    """(filing, basis, statement, item, value, unit, confidence, page, line_no, text) of every line that an alias reads.

    ``pages``: filing, page_number, text, target_year, optional confidence.  A section begins at its heading and ends at a boundary, a page
    of highlights or after ``SECTION_LINES`` lines; before any of these a line may be of any statement, at less confidence.
    """
    pages = dealt(pages, "filing")
    confidence = F.coalesce("confidence", F.lit(PAGE)) if "confidence" in pages.columns else F.lit(PAGE)
    pages = pages.select("filing", "page_number", "target_year", confidence.alias("_page"), "text", F.get(apart(lambda x: unit(x["text"], x["low"]), text=F.col("text"), low=small(F.col("text"))), F.lit(0)).alias("_page_unit"))
    lines = pages.select("filing", "page_number", "target_year", "_page", "_page_unit", F.posexplode(F.split("text", r"\r?\n")).alias("line_no", "line"))
    line = F.trim(F.regexp_replace("line", r"\s+", " "))
    lines = lines.withColumn("text", line).where("text <> ''").drop("line")
    text = F.col("text")

    def marks(x: Column) -> Column:
        text, low = x["text"], x["low"]
        kind, word = F.lit(None).cast("string"), F.lit("")
        for name, pattern in reversed(SECTIONS):
            kind, word = F.when(text.rlike(_any_case(pattern)), name).otherwise(kind), F.when(text.rlike(_any_case(pattern)), F.regexp_extract(text, _any_case(pattern), 1)).otherwise(word)
        ends = text.rlike(_any_case(BOUNDARY)) | matches(text, low, HIGHLIGHTS, HIGHLIGHT_WORDS)
        years = F.when(text.contains("20"), F.regexp_extract_all(text, F.lit(r"\b(20\d{2})\b"), F.lit(1)))
        banner = F.when(text.rlike(_any_case(BANNER)), _basis(F.regexp_extract(text, _any_case(BANNER), 1)))
        return F.struct(kind.alias("_kind"), word.alias("_word"), years.alias("_years"), unit(text, low).alias("_declared"), ends.alias("_ends"), banner.alias("_banner"))

    # exploded, so that no mark is written out at each of its uses
    lines = lines.select("*", F.explode(apart(marks, text=text, low=small(text))).alias("_m")).select("*", "_m.*").drop("_m")
    years = F.array_distinct(F.transform("_years", lambda y: y.cast("int")))
    place = F.array_position(years, F.col("target_year").cast("int"))
    lines = lines.withColumn("_order", F.when(F.col("_years").isNotNull(), F.when(F.size(years).between(2, 4) & (place > 0), F.size(years) - place + 1))).drop("_years")
    marker = F.col("_kind").isNotNull()
    lines = lines.withColumns({
        "_turn": F.when(marker, F.col("_kind")).when(F.col("_ends"), "none"),
        "_units": F.when(F.col("_declared") != 1, F.col("_declared")).when(marker, F.col("_page_unit")),
        "_bases": F.when(marker, F.coalesce(_basis(F.col("_word")), F.lit("unknown"))),
    })
    so_far = Window.partitionBy("filing").orderBy("page_number", "line_no").rowsBetween(Window.unboundedPreceding, 0)
    last = lambda c: F.last(c, ignorenulls=True).over(so_far)
    lines = lines.withColumns({"_turns": F.count("_turn").over(so_far), "_section": last("_turn"), "_unit": F.coalesce(last("_units"), F.lit(1)), "_own": last("_bases"), "_above": last("_banner"), "_column": F.coalesce(last("_order"), F.lit(2))})
    age = F.row_number().over(Window.partitionBy("filing", "_turns").orderBy("page_number", "line_no")) - 1
    lines = lines.withColumn("_age", age)
    section = F.when((F.col("_section") != "none") & (F.col("_age") <= SECTION_LINES), F.col("_section"))
    seen = F.col("_turns") > 0
    lines = lines.withColumn("section", section).where(F.col("_kind").isNull() & text.rlike("[0-9]") & (F.col("section").isNotNull() | ~seen))

    # one CASE of all aliases: a CASE in the ELSE of another, as deep as there are aliases, takes minutes to plan
    def first_alias(x: Column) -> Column:
        alias = F
        for statement, item, sure, pattern in ALIASES:
            fits = (x["section"].isNull() | (x["section"] == statement)) & matches(x["text"], x["low"], pattern, ALIAS_WORDS[item])
            if item == "revenue":
                fits = fits & ~x["text"].rlike(_any_case(NOT_REVENUE))
            alias = alias.when(fits, F.struct(F.lit(statement).alias("statement"), F.lit(item).alias("item"), F.lit(sure).alias("sure")))
        return alias

    found = lines.select("*", F.explode(apart(first_alias, text=text, low=small(text), section=F.col("section"))).alias("_alias")).where("_alias is not null")
    # what is made of a line is exploded too: the filters below would else repeat its making at each use of it
    figures = lambda x: F.regexp_extract_all(F.regexp_replace(x["text"], r"(?i)Rs\.?|PKR|rupees", " "), F.lit(r"\(?-?\d[\d,]*(?:\.\d+)?\)?"), F.lit(0))
    found = found.select("*", F.explode(apart(figures, text=text)).alias("_figures")).where(F.size("_figures") > 0)
    at = F.when(F.size("_figures") == 1, 1).otherwise(F.least("_column", F.size("_figures")))

    def read(x: Column) -> Column:
        figure, item = x["figure"], x["item"]
        bracketed = figure.startswith("(") & figure.endswith(")")
        plain = F.translate(figure, "(),", "").try_cast("double")
        value = F.when(bracketed, -plain).otherwise(plain)
        value = F.when(item.isin(*MAGNITUDES), F.abs(value)).otherwise(value)
        scale = F.when(item.isin(*PER_SHARE), 1).otherwise(x["unit"])
        return F.struct((value * scale).alias("value"), scale.alias("scale"))

    item = F.col("_alias.item")
    found = found.select("*", F.explode(apart(read, figure=F.element_at("_figures", -at.cast("int")), item=item, unit=F.col("_unit"))).alias("_read"))
    sure = F.col("_alias.sure") + F.when(F.col("section") == F.col("_alias.statement"), WITHIN).otherwise(OUTSIDE) - F.when(F.size("_figures") == 1, 0.0).otherwise(SEVERAL)
    basis = F.coalesce(F.nullif(F.col("_own"), F.lit("unknown")), F.col("_above"), F.lit("unknown"))
    out = found.select("filing", basis.alias("basis"), "_alias.statement", item.alias("item"), "_read.value", F.col("_read.scale").alias("unit"), F.least(F.lit(MOST), F.col("_page"), sure).alias("confidence"), F.col("page_number").alias("page"), "line_no", "text")
    return out.where("value is not null").where(~((F.col("value") < 0) & F.col("item").isin(*NEVER_NEGATIVE)))


def promoted(pages: DataFrame) -> DataFrame:
    """(filing, basis, statement, item, value, confidence): the surest line of each item of a basis, from ``PROMOTED`` on, the first of
    equals, and the items made of two of these."""
    best = candidates(pages).where(F.col("confidence") >= PROMOTED).groupBy("filing", "basis", "statement", "item").agg(F.max_by(F.struct("value", "confidence"), F.struct("confidence", -F.col("page"), -F.col("line_no"))).alias("x"))
    best = best.select("filing", "basis", "statement", "item", "x.value", "x.confidence")
    needed = sorted({i for _, *of in DERIVED for i in of[:3]} | {i for of in PERCENTAGES for i in of})
    # the items as read and those made of them leave one grouping: a union would read the pages twice
    wide = best.groupBy("filing", "basis").agg(F.collect_list(F.struct("statement", "item", "value", "confidence")).alias("_best"), *[F.max(F.when(F.col("item") == i, F.struct("value", "confidence"))).alias(i) for i in needed])
    v = lambda i: F.col(f"{i}.value")
    sure = lambda a, b: F.greatest(F.lit(PROMOTED), F.least(F.col(f"{a}.confidence"), F.col(f"{b}.confidence")) - 0.02)
    made = [(s, i, v(a) + sign * v(b), sure(a, b)) for s, i, a, b, sign in DERIVED]
    made += [("income", i, F.when(v(b) > 0, round_decimal(percent(v(a), v(b)), 4)), sure(a, b)) for i, a, b in PERCENTAGES]
    rows = F.array(*[F.struct(F.lit(s).alias("statement"), F.lit(i).alias("item"), F.when(F.col(i).isNull(), finite(x)).alias("value"), c.alias("confidence")) for s, i, x, c in made])
    return wide.select("filing", "basis", F.inline(F.concat("_best", F.filter(rows, lambda x: x["value"].isNotNull()))))
