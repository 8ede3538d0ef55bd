"""Ordered operators: carry-forward, runs, running totals, sections."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .totals import LONGEST, is_total, live_runs

def carry(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, Column]) -> DataFrame:
    """Each named value as last seen, up to the row, within its key."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({n: F.last(v, ignorenulls=True).over(w) for n, v in values.items()})


def sections(df: DataFrame, keys: Sequence[str], order: Sequence[str], starts: Column, ends_after: Column | None = None, expiry: int | None = None) -> DataFrame:
    """Number of the section each row is in: a row where ``starts`` holds opens one, the row after ``ends_after`` closes it.

    Rows before the first or after ``expiry`` rows of a section have none.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    opened = df.withColumn("_open", F.when(starts, 1).otherwise(0))
    opened = opened.withColumn("section", F.sum("_open").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    inside = Window.partitionBy(*keys, "section").orderBy(*order)
    place = F.row_number().over(inside)
    alive = F.col("section") > 0
    if ends_after is not None:
        closed = F.coalesce(F.sum(F.when(ends_after, 1).otherwise(0)).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        opened = opened.withColumn("_closed", closed)
        alive = alive & (F.col("_closed") == 0)
    if expiry is not None:
        opened = opened.withColumn("_place", place)
        alive = alive & (F.col("_place") <= expiry)
    return opened.withColumn("section", F.when(alive, F.col("section"))).drop("_open", "_closed", "_place")


def running_totals(rows: DataFrame, keys: Sequence[str], order: str, value: str, label: str, scale: float = 1.0, shortest: int = 2, longest: int = LONGEST) -> DataFrame:
    """Rows confirmed as totals of the rows above them, with the number of parts.

    Only a row without a caption or with that of a total can be one.  Rows are walked with a list of live figures; such a row
    that equals the sum of the shortest suffix of ``shortest`` to ``longest`` of them, within half a unit a part and half a
    unit, takes their place.  One printed table is walked at a time; its size is that of a page.  Tables come one after the other
    in the order of a window, many to a batch.
    """
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields) + ", total_of int"
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(order).asc_nulls_last()))
    marked = rows.withColumn("_closes", is_total(F.col(label))).withColumn("_place", place)

    def walk(t: pa.Table, starts: list[int]) -> Iterator[pa.RecordBatch]:
        values, closes, parts = t[value].to_pylist(), t["_closes"].to_pylist(), [None] * len(t)
        for lo, hi in zip(starts, [*starts[1:], len(t)]):
            for at, of in live_runs(values[lo:hi], closes[lo:hi], shortest, longest, scale).items():
                parts[lo + at] = len(of)
        yield from t.drop_columns(["_closes", "_place"]).append_column("total_of", pa.array(parts, pa.int32())).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # of the table that is still open, from its start
        for b in batches:
            starts = [i for i, n in enumerate(b["_place"].to_pylist()) if n == 1]
            if starts:
                closed, before = [*held, b.slice(0, starts[-1])], sum(map(len, held))
                if before + starts[-1]:
                    yield from walk(pa.Table.from_batches(closed), [*([0] if before else []), *(before + i for i in starts[:-1])])
                held = [b.slice(starts[-1])]
            elif len(b):
                held.append(b)
        if held:
            yield from walk(pa.Table.from_batches(held), [0])

    return marked.mapInArrow(run, ddl)


def prefix_total(rows: DataFrame, keys: Sequence[str], order: str, value: str, caption: str) -> DataFrame:
    """Rows without a caption that equal the sum of the captioned rows above them under the same heading: the last is the total."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    above = F.sum(F.when(F.col(caption).isNotNull(), F.col(value))).over(w)
    parts = F.count(F.when(F.col(caption).isNotNull() & F.col(value).isNotNull(), 1)).over(w)
    hits = rows.withColumn("_above", above).withColumn("_parts", parts).where(F.col(caption).isNull() & (F.abs(F.col("_above") - F.col(value)) <= 0.5 * F.col("_parts") + 0.5))
    return hits.groupBy(*keys).agg(F.max_by(F.struct(order, value), order).alias("r")).select(*keys, "r.*")


def merge_split_rows(rows: DataFrame, keys: Sequence[str], order: str, label: str, a: str, b: str) -> DataFrame:
    """Two neighbours whose cells complement each other, the second with a fragment for a label, become one row.

    A merge never cascades: of a chain of candidates every second pair merges.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    nxt = lambda c: F.lead(c).over(w)
    fits = (F.col(a).isNull() != nxt(a).isNull()) & (F.col(b).isNull() != nxt(b).isNull()) & nxt(label).rlike(r"^[a-z&(]|^$")
    r = rows.withColumn("_fits", F.coalesce(fits, F.lit(False)))
    r = r.withColumn("_run", F.sum(F.when(F.col("_fits"), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    r = r.withColumn("_at", F.row_number().over(Window.partitionBy(*keys, F.coalesce("_run", F.lit(0))).orderBy(order)))
    r = r.withColumn("_merge", F.col("_fits") & (F.col("_at") % 2 == 1))
    gone = F.coalesce(F.lag("_merge").over(w), F.lit(False))
    r = r.withColumn("_gone", gone).withColumns({f"_{c}": nxt(c) for c in (label, a, b)})
    merged = {label: F.when(F.col("_merge"), F.trim(F.concat_ws(" ", label, f"_{label}"))).otherwise(F.col(label)), a: F.when(F.col("_merge"), F.coalesce(a, f"_{a}")).otherwise(F.col(a)), b: F.when(F.col("_merge"), F.coalesce(b, f"_{b}")).otherwise(F.col(b))}
    return r.withColumns(merged).where(~F.col("_gone")).drop("_fits", "_run", "_at", "_merge", "_gone", *[f"_{c}" for c in (label, a, b)])
