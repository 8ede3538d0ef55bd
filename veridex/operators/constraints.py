"""Linear constraints over figures: residuals, the identity catalogue, values without a check, units that do not fit."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Identity:
    """sum(sign x figure) = 0 over the named items; ``magnitude`` items count by their absolute value.

    ``by_span``: whether it binds depends on the rows printed beside its cells; taken alone it is advisory.
    """

    rule: str
    terms: tuple[tuple[str, int], ...]
    magnitude: tuple[str, ...] = ()
    advisory: bool = False
    by_span: bool = False


#: The relations that statements must satisfy.
IDENTITIES = (
    Identity("I1", (("revenue", 1), ("cost_of_sales", -1), ("gross_profit", -1)), ("cost_of_sales",)),
    Identity("I2", (("profit_before_tax", 1), ("taxation", -1), ("profit_after_tax", -1))),
    Identity("I3", (("net_income_to_owners", 1), ("net_income_to_minority", 1), ("profit_after_tax", -1))),
    Identity("I5", (("gross_profit", 1), ("operating_expenses", -1), ("other_income", 1), ("operating_profit", -1)), ("operating_expenses",)),
    Identity("B1", (("total_equity", 1), ("total_liabilities", 1), ("total_assets", -1)), advisory=True, by_span=True),
    Identity("B2", (("total_current_liabilities", 1), ("total_non_current_liabilities", 1), ("total_liabilities", -1))),
    Identity("B3", (("shareholders_equity", 1), ("minority_interest", 1), ("total_equity", -1))),
    Identity("B4", (("total_current_assets", 1), ("total_non_current_assets", 1), ("total_assets", -1)), advisory=True, by_span=True),
    Identity("B5", (("total_assets", 1), ("total_equity_and_liabilities", -1))),
    Identity("F4", (("cash_from_operations", 1), ("cash_from_investing", 1), ("cash_from_financing", 1), ("net_change_in_cash", -1)), advisory=True, by_span=True),
    Identity("F5", (("cash_at_beginning", 1), ("net_change_in_cash", 1), ("fx_adjustments", 1), ("cash_at_end", -1)), advisory=True, by_span=True),
    Identity("X4", (("cash_at_end", 1), ("cash_and_equivalents", -1)), advisory=True),
)


def residuals(terms: DataFrame, cells: DataFrame, constraint: Sequence[str], cell: Sequence[str]) -> DataFrame:
    """Residual, largest scale and term count of each constraint; a constraint with an unread cell is not evaluable.

    ``terms`` has the constraint key, the cell key, sign, magnitude and scale; ``cells`` the cell key and value.
    """
    return residuals_of(terms.join(cells, list(cell), "left"), constraint)


def residuals_of(terms: DataFrame, constraint: Sequence[str]) -> DataFrame:
    """The same where the terms have their values."""
    figure = F.when(F.col("magnitude"), F.abs("value")).otherwise(F.col("value")) * F.col("scale")
    g = terms.groupBy(*constraint).agg(
        F.sum(F.col("sign") * figure).alias("residual"), F.max("scale").alias("scale"), F.count("*").alias("n_terms"), F.count_if(F.col("value").isNull()).alias("n_unread"),
    )
    evaluable = F.col("n_unread") == 0
    within = F.abs("residual") <= 0.5 * F.col("n_terms") + 0.5 * F.col("scale")
    return g.withColumn("holds", F.when(evaluable, within)).withColumn("residual", F.when(evaluable, F.col("residual")))


def holds(identity: Identity, scale: float = 1.0) -> Column:
    """Whether a period row satisfies an identity; null where a figure is missing."""
    total = sum((s * (F.abs(n) if n in identity.magnitude else F.col(n)) for n, s in identity.terms), F.lit(0.0))
    return F.abs(total) <= 0.5 * scale * len(identity.terms) + 0.5 * scale


def check_identities(wide: DataFrame, keys: Sequence[str], scale: float = 1.0, identities: Sequence[Identity] = IDENTITIES) -> DataFrame:
    """(keys, rule, advisory, residual, holds) of every identity whose items the period row has: one pass, no join."""
    have, out = set(wide.columns), []
    for i in identities:
        if not all(name in have for name, _ in i.terms):
            continue
        total = sum((s * (F.abs(n) if n in i.magnitude else F.col(n)) for n, s in i.terms), F.lit(0.0))
        allowed = 0.5 * scale * len(i.terms) + 0.5 * scale
        out.append(F.struct(F.lit(i.rule).alias("rule"), F.lit(i.advisory).alias("advisory"), total.alias("residual"), (F.abs(total) <= allowed).alias("holds")))
    return wide.select(*keys, F.explode(F.array(*out)).alias("c")).select(*keys, "c.*").where("residual is not null")


def settled(checks: DataFrame, left_out: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Checks whose advisory flag is what the figures say: the identities that are advisory only where figures of their span are
    left out (``left_out``: keys, rule, of ``relations.unaccounted``) bind where none is."""
    named = [i.rule for i in IDENTITIES if i.by_span]
    loose = left_out.select(*keys, "rule").distinct().withColumn("_loose", F.lit(True))
    joined = checks.join(loose, [*keys, "rule"], "left")
    return joined.withColumn("advisory", F.when(F.col("rule").isin(*named), F.coalesce("_loose", F.lit(False))).otherwise(F.col("advisory"))).drop("_loose")


def confirmed(values: DataFrame, members: DataFrame, checks: DataFrame, cell: Sequence[str], constraint: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Values with at least one check that holds, and those dropped for want of one."""
    good = members.join(checks.where("holds"), list(constraint)).select(*cell).distinct()
    return values.join(good, list(cell), "left_semi"), values.join(good, list(cell), "left_anti")


def unit_mismatches(pairs: DataFrame, left: str, right: str, factors: Sequence[float] = (1e3, 1e6, 1e-3, 1e-6)) -> DataFrame:
    """Pairs that do not tie as they stand but do after one side is multiplied by a factor."""
    tie = lambda f: F.abs(F.col(left) * f - F.col(right)) <= F.greatest(F.lit(1.0), F.abs(right) * 1e-6)
    factor = F.coalesce(*[F.when(tie(f), F.lit(f)) for f in factors])
    return pairs.where(~tie(1.0) & (F.col(left) != 0)).withColumn("factor", factor).where("factor is not null")


def signed_values(values: DataFrame, item: str, value: str, expenses: Sequence[str], never_negative: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Expenses as magnitudes; negatives of items that cannot be negative go, with the reason."""
    fixed = values.withColumn(value, F.when(F.col(item).isin(*expenses), F.abs(value)).otherwise(F.col(value)))
    bad = F.col(item).isin(*never_negative) & (F.col(value) < 0)
    return fixed.where(~bad | F.col(value).isNull()), fixed.where(bad).select("*", F.lit("negative figure of an item that cannot be negative").alias("reason"))


def column_reasons(end: Column, months: Column, flow: Column, filed: Column, filed_year: Column) -> Column:
    """Why a column is not kept; null if it is."""
    anchor = F.coalesce(filed, F.make_date(filed_year, F.lit(6), F.lit(30)))
    return (
        F.when(end.isNull(), "no date").when(flow & ~months.isin(3, 6, 9, 12), "no length")
        .when(F.abs(F.datediff(end, anchor)) > 540, "too far from the filing's period")
    )


def plausibility(row: DataFrame, flags: dict[str, Column], keys: Sequence[str]) -> DataFrame:
    """One row for each flag that holds; a report, nothing is dropped."""
    found = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in flags.items()]), lambda x: x.isNotNull())
    return row.select(*keys, F.explode(found).alias("flag"))


def sanity_flags() -> dict[str, Column]:
    """S1 to S9 over a filled period row: reported for review, never used to drop or repair a figure.

    S1 gross profit over revenue; S2 cost over twice the revenue; S3 current assets or liabilities not positive; S4 total
    assets not positive; S5 tax over the profit before it; S6 EPS times shares not within 5 % of the owners' profit or the
    EPS's rounding; S7 a part over its whole; S8 EPS and profit of opposite signs; S9 equity over total assets.
    """
    c = F.col
    eps, owners, shares = c("eps_basic"), F.coalesce("net_income_to_owners", "profit_after_tax"), c("common_shares_outstanding")
    revenue, current, assets = c("revenue"), c("total_current_assets"), c("total_assets")
    over = lambda part, whole: F.coalesce(c(part) > whole, F.lit(False))
    s7 = F.lit(False)
    for part in ("cash_and_equivalents", "net_receivables", "total_inventory", "short_term_investments"):
        s7 = s7 | over(part, current)
    s7 = s7 | over("total_current_assets", assets) | over("net_ppe", assets) | over("total_current_liabilities", c("total_liabilities"))
    return {
        "S1": (revenue > 0) & (c("gross_profit") > revenue), "S2": (revenue > 0) & (c("cost_of_sales") > 2 * revenue),
        "S3": (current.isNotNull() & c("total_current_liabilities").isNotNull()) & ((current <= 0) | (c("total_current_liabilities") <= 0)), "S4": assets <= 0,
        "S5": (c("profit_before_tax") > 0) & (F.abs("taxation") > c("profit_before_tax")),
        "S6": (shares > 0) & (F.abs(eps * shares - owners) > F.greatest(0.05 * F.abs(owners), 0.005 * shares)), "S7": s7,
        "S8": (eps != 0) & (owners != 0) & (F.signum(eps) != F.signum(owners)), "S9": F.coalesce("total_equity", "shareholders_equity") > assets,
    }


#: The items that the sanity flags read.
SANITY_ITEMS = (
    "revenue", "gross_profit", "cost_of_sales", "total_current_assets", "total_current_liabilities", "total_assets", "profit_before_tax", "taxation", "eps_basic", "net_income_to_owners", "profit_after_tax",
    "common_shares_outstanding", "cash_and_equivalents", "net_receivables", "total_inventory", "short_term_investments", "net_ppe", "total_liabilities", "total_equity", "shareholders_equity",
)


def sanity(periods: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each of S1 to S9 that a period row raises; items it has no column for count as missing."""
    full = periods.select(*keys, *[F.col(i).cast("double").alias(i) if i in periods.columns else F.lit(None).cast("double").alias(i) for i in SANITY_ITEMS])
    return plausibility(full, sanity_flags(), keys)
