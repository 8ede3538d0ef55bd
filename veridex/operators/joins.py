"""Joins of the data model: as-of, period, merge, dense, first match, scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import shift_months


def as_of(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str, value: str, max_gap_days: int) -> DataFrame:
    """The latest value of ``right`` at or before each left row's time, if it is not older than ``max_gap_days``.

    Both sides are tagged and put into one order per key, so no inequality join is planned: one shuffle, one pass.
    """
    r = right.groupBy(*keys, F.col(right_time).alias("_t")).agg(F.max(value).alias("_v")).withColumn("_left", F.lit(0))
    side = left.withColumn("_t", F.col(left_time)).withColumn("_left", F.lit(1))
    both = side.unionByName(r, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy("_t", "_left").rowsBetween(Window.unboundedPreceding, 0)
    found = F.last(F.when(F.col("_left") == 0, F.struct(F.col("_t").alias("t"), F.col("_v").alias("v"))), ignorenulls=True).over(w)
    out = both.withColumn("_found", found).where("_left = 1")
    near = F.col("_found.t") >= F.col("_t") - F.expr(f"interval {max_gap_days} days")
    return out.withColumn(value, F.when(near, F.col("_found.v"))).withColumn("as_of", F.when(near, F.col("_found.t"))).drop("_t", "_v", "_left", "_found")


def section_of(points: DataFrame, sections: DataFrame, keys: Sequence[str], at: str, last: str, name: str) -> DataFrame:
    """The name of the last section that ends before each point."""
    ends = sections.select(*keys, F.col(last).alias("_at"), F.col(name).alias("_name")).withColumn("_side", F.lit(1))
    both = points.withColumn("_at", F.col(at)).withColumn("_side", F.lit(0)).unionByName(ends, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(name, F.last("_name", ignorenulls=True).over(w)).where("_side = 0").drop("_at", "_side", "_name")


def period_join(flows: DataFrame, balances: DataFrame, keys: Sequence[str], end: str, back: Column, values: Sequence[str], suffix: str) -> DataFrame:
    """Balances at each flow's end shifted back by ``back`` months; 0 gives the closing, the flow's months the opening balance."""
    right = balances.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(end).alias("_end"), *[F.col(v).alias(f"{v}{suffix}") for v in values])
    on = [F.col(k) == F.col(f"_{k}") for k in keys] + [shift_months(F.col(end), -back) == F.col("_end")]
    return flows.join(right, on, "left").drop("_end", *[f"_{k}" for k in keys])


def growth(df: DataFrame, keys: Sequence[str], end: str, months: int, value: str, name: str) -> DataFrame:
    """Percentage growth against the row ``months`` earlier, where that base is positive."""
    out = period_join(df, df, keys, end, F.lit(months), [value], "_prior")
    base = F.col(f"{value}_prior")
    return out.withColumn(name, F.when(base > 0, 100 * (F.col(value) / base - 1)))


def balance_only(balances: DataFrame, flows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Balance dates without a flow of their own."""
    return balances.select(*keys).distinct().join(flows.select(*keys).distinct(), list(keys), "left_anti")


def dense(periods: DataFrame, items: Sequence[str], figures: DataFrame, keys: Sequence[str], item: str, value: str) -> DataFrame:
    """Every item of every period, null where no figure is known: items are a literal list, so no join makes the grid."""
    grid = periods.select(*keys).distinct().withColumn(item, F.explode(F.array(*[F.lit(i) for i in items])))
    return grid.join(figures.select(*keys, item, value), [*keys, item], "left")


def first_match(rows: DataFrame, text: str, rules: Sequence[tuple[str, str]], name: str = "item") -> DataFrame:
    """The first rule, in order, whose pattern the text matches: ordered rules compile to one CASE, with no join."""
    match = F.lit(None).cast("string")
    for item, pattern in reversed(rules):
        match = F.when(F.col(text).rlike(pattern), F.lit(item)).otherwise(match)
    return rows.withColumn(name, match)


def merge_by_key(first: DataFrame, second: DataFrame, extra: DataFrame, key: str, texts: Sequence[str], owned: Sequence[str]) -> DataFrame:
    """Union of the keys of two tables; ``texts`` by first non-empty, ``owned`` from the first where it has the row at all.

    ``extra`` is joined to keys that are there and adds none.
    """
    a = first.select(F.col(key), F.lit(True).alias("_has"), *[F.col(c).alias(f"a_{c}") for c in (*texts, *owned)])
    b = second.select(F.col(key), *[F.col(c).alias(f"b_{c}") for c in (*texts, *owned)])
    merged = a.join(b, key, "full").join(extra, key, "left")
    text = [F.coalesce(F.nullif(f"a_{c}", F.lit("")), F.nullif(f"b_{c}", F.lit("")), F.lit("")).alias(c) for c in texts]
    own = [F.when(F.col("_has"), F.col(f"a_{c}")).otherwise(F.col(f"b_{c}")).alias(c) for c in owned]
    return merged.select(key, *text, *own, *[F.col(c) for c in extra.columns if c != key])


def score(expected: DataFrame, actual: DataFrame, keys: Sequence[str], group: Sequence[str]) -> DataFrame:
    """Expected, correct, wrong and missing figures; a figure is correct within 1e-9 of its size or 0.005."""
    joined = expected.join(actual.withColumnRenamed("value", "_actual"), list(keys), "left")
    right = F.abs(F.col("_actual") - F.col("value")) <= F.greatest(F.abs("value") * 1e-9, F.lit(0.005))
    return joined.groupBy(*group).agg(F.count("*").alias("expected"), F.count_if(right).alias("correct"), F.count_if(F.col("_actual").isNotNull() & ~right).alias("wrong"), F.count_if(F.col("_actual").isNull()).alias("missing"))


def cache_plan(requested: DataFrame, records: DataFrame, keys: Sequence[str], usable: Column) -> tuple[DataFrame, DataFrame]:
    """Requests answered by a usable record of the same keys (null meets null), and those left to fetch; each request is in one of them, once."""
    have = records.where(usable).select(*[F.col(k).alias(f"_{k}") for k in keys])
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return requested.join(have, on, "left_semi"), requested.join(have, on, "left_anti")
