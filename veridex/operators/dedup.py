"""Row selection, ambiguity and grouping operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _struct_of(df: DataFrame, skip: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in df.columns if c not in skip])


def _pick(df: DataFrame, keys: Sequence[str], order: Column, latest: bool) -> DataFrame:
    """One row a key by the least (or greatest) ``order``: an aggregation, so map tasks send one row a key."""
    choose = F.max_by if latest else F.min_by
    picked = df.groupBy(*keys).agg(choose(_struct_of(df, keys), order).alias("r"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"r.{c}").alias(c) for c in df.columns])


def keep_first(df: DataFrame, keys: Sequence[str], ordinal: str) -> DataFrame:
    """The first row of each key in reading order."""
    return _pick(df, keys, F.col(ordinal), False)


def keep_best(df: DataFrame, keys: Sequence[str], score: str, ordinal: str) -> DataFrame:
    """The row of greatest score of each key; ties go to the first."""
    return _pick(df, keys, F.struct(-F.col(score), F.col(ordinal)), False)


def keep_latest(df: DataFrame, keys: Sequence[str], when: str, ordinal: str) -> DataFrame:
    """The latest row of each key; of equal times the one of greater ordinal."""
    return _pick(df, keys, F.struct(when, ordinal), True)


def merge_latest(old: DataFrame, new: DataFrame, keys: Sequence[str], when: str) -> DataFrame:
    """Union of two tables by key; the later row wins, and of equal times the new one."""
    both = old.withColumn("_side", F.lit(0)).unionByName(new.withColumn("_side", F.lit(1)))
    return keep_latest(both, keys, when, "_side").drop("_side")


def ambiguous(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Keys whose rows differ in ``values``, with the number of different values and of rows."""
    return df.groupBy(*keys).agg(F.count_distinct(F.struct(*values)).alias("n_values"), F.count("*").alias("n_rows")).where("n_values > 1")


def without_collisions(df: DataFrame, group: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Rows whose key is theirs alone within the group; rows that share one all go."""
    alone = df.groupBy(*group, *keys).agg(F.count("*").alias("_n")).where("_n = 1").drop("_n")
    return df.join(alone, [*group, *keys], "left_semi")


def intersecting(df: DataFrame, keys: Sequence[str], low: str, high: str, at_least: int = 2) -> DataFrame:
    """Keys whose intervals have a point in common: greatest low <= least high over ``at_least`` intervals or more."""
    g = df.groupBy(*keys).agg(F.max(low).alias("low"), F.min(high).alias("high"), F.count("*").alias("n"))
    return g.where(F.col("n") >= at_least).withColumn("agrees", F.col("low") <= F.col("high"))


def disagreements(df: DataFrame, keys: Sequence[str], source: str, value: str) -> DataFrame:
    """Keys told by two sources or more with more than one value."""
    g = df.groupBy(*keys).agg(F.count_distinct(source).alias("n_sources"), F.count_distinct(value).alias("n_values"))
    return g.where((F.col("n_sources") >= 2) & (F.col("n_values") > 1))


def counters(df: DataFrame, keys: Sequence[str], counts: dict[str, Column]) -> DataFrame:
    """Conditional counts by key with a total row (keys null)."""
    return df.rollup(*keys).agg(F.count("*").alias("n"), *[F.count_if(c).alias(n) for n, c in counts.items()])


def inherit_unit(tables: DataFrame, group: str, unit: str, printed: str) -> DataFrame:
    """Tables without a printed unit take the group's, if its printed ones are all one."""
    units = tables.where(printed).groupBy(group).agg(F.min(unit).alias("_lo"), F.max(unit).alias("_hi"))
    joined = tables.join(units, group, "left")
    return joined.withColumn("unit_used", F.when(F.col(printed), F.col(unit)).when(F.col("_lo") == F.col("_hi"), F.col("_lo"))).drop("_lo", "_hi")


def floor_median(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The element at floor(n / 2), counted from 0, of each key's sorted values.

    By counts of distinct values, not by collecting them: a running count over a key's distinct values finds the place.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("c"))
    w = Window.partitionBy(*keys)
    ranked = counts.withColumn("_upto", F.sum("c").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))).withColumn("_n", F.sum("c").over(w))
    return ranked.where(F.col("_upto") > F.floor(F.col("_n") / 2)).groupBy(*keys).agg(F.min(value).alias("median"), F.max("_n").alias("n"))


def contiguous(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Runs of consecutive integers by key."""
    w = Window.partitionBy(*keys).orderBy(value)
    runs = df.select(*keys, value).distinct().withColumn("_run", F.col(value) - F.row_number().over(w))
    return runs.groupBy(*keys, "_run").agg(F.min(value).alias("first"), F.max(value).alias("last"), F.count("*").alias("n")).drop("_run")


def places(df: DataFrame, order: str, size: int = 1 << 14) -> DataFrame:
    """``place``: each row's number from 0 in order of a numeric column, nulls last, without one window over all rows.

    Rows go to ranges by cut points, each range is numbered alone and starts after the rows of the ranges before it.  The
    numbers are exact wherever the cuts lie; they only balance the ranges.
    """
    n = min(1000, -(-df.count() // size))
    cuts = df.agg(F.percentile_approx(order, [k / n for k in range(1, n)])).first()[0] if n > 1 else None
    cuts = sorted(set(cuts or ()))
    above = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col(order))) if cuts else F.lit(0)
    ranged = df.withColumn("_range", F.when(F.col(order).isNull(), len(cuts) + 1).otherwise(above))
    counts = ranged.groupBy("_range").agg(F.count("*").alias("_n"))  # one row a range
    starts = counts.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_start"))
    own = F.row_number().over(Window.partitionBy("_range").orderBy(F.col(order).asc_nulls_last()))
    return ranged.withColumn("_own", own).join(F.broadcast(starts), "_range").withColumn("place", F.col("_start") + F.col("_own") - 1).drop("_range", "_own", "_start")


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each key; Spark prunes each map task to ``k`` rows a key."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("place") <= k)


def distinct_checks(df: DataFrame, keys: Sequence[str], ordinal: str, check: str, most: int = 20) -> DataFrame:
    """Distinct checks of each key in order of first mention, at most ``most``."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(ordinal, check))), lambda x: x[check])
    return df.groupBy(*keys).agg(F.slice(F.array_distinct(ordered), 1, most).alias("checks"))
