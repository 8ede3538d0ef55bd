"""Sinks: payloads, chunked record files with an index written last, idempotent snapshots."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import written

# Limits of a submitted payload.
MAX_PAGES, MAX_TEXT = 150, 300


def clean(text: Column) -> Column:
    """NUL characters removed."""
    return F.translate(text, "\0", "")


def completeness(lines: DataFrame) -> DataFrame:
    """complete or partial by filing: two income lines, two balance lines and one cash-flow line at least."""
    n = lambda s: F.count_if(F.col("statement") == s)
    g = lines.groupBy("filing").agg(n("income").alias("income"), n("balance").alias("balance"), n("cash_flow").alias("cash_flow"))
    return g.withColumn("status", F.when((F.col("income") >= 2) & (F.col("balance") >= 2) & (F.col("cash_flow") >= 1), "complete").otherwise("partial"))


def payload(figures: DataFrame, version: int = 2, most: int = MAX_PAGES) -> DataFrame:
    """(filing, payload JSON): periods with their figures, and the evidence pages."""
    f = F.struct("item", "value", "source", "page", F.substring(clean(F.col("text")), 1, MAX_TEXT).alias("text"))
    periods = figures.groupBy("filing", "basis", "period_end", "months").agg(F.array_sort(F.collect_list(f)).alias("figures"), F.collect_set("page").alias("pages"))
    filing = periods.groupBy("filing").agg(F.array_sort(F.collect_list(F.struct("basis", "period_end", "months", "figures"))).alias("periods"), F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("pages")))), 1, most).alias("pages"))
    return filing.select("filing", F.to_json(F.struct(F.lit(version).alias("schemaVersion"), "periods", "pages")).alias("payload"))


#: Rows of a block in which cuts are followed, at least; a chunk never reaches beyond the next block.
BLOCK_ROWS = 1 << 14


def chunks(df: DataFrame, order: Sequence[str], size: Column, max_bytes: int, max_rows: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``chunk``, from 0: rows in order, a chunk closed before a row that would take it over ``max_bytes`` or ``max_rows``.

    A larger row is a chunk of its own.  Each cut depends on the one before, so the rows' places and sums of sizes (``running``)
    are dealt to blocks of places, each with the rows that a chunk open at its end can still take.  A block tells, for every row
    at which a chunk could start in it, where the first chunk of the next block would start; these jumps are joined
    with themselves, twice as far each round, until every block knows its own start.  The result is that of one walk over all rows.
    """
    block_rows = max(block_rows, max_rows)
    names = df.columns
    placed = written(running(df.withColumn("_size", size.cast("long")), order, "_size"), "chunk-rows")
    at = placed.select("_place", "_before", "_size")
    block = F.floor(F.col("_place") / block_rows).cast("long")
    # the first rows of a block are the tail of the one before
    tail = at.where((F.col("_place") % block_rows < max_rows) & (F.col("_place") >= block_rows)).withColumn("_block", block - 1)
    blocks = at.withColumn("_block", block).unionByName(tail)

    def follow(t: pa.Table, entries: np.ndarray | None):
        t = t.sort_by("_place")
        place, before, own = (t[c].to_numpy() for c in ("_place", "_before", "_size"))
        number = t["_block"][0].as_py()
        n = min(block_rows, len(place))
        # the first row that doesn't fit any more, at least the next
        cut = np.searchsorted(before + own, before[:n] + max_bytes, "right")
        nxt = np.minimum(np.maximum(cut, np.arange(n) + 1), np.arange(n) + max_rows)
        if entries is not None:
            starts, i = [], int(entries[0])
            while i < n:
                starts.append(i)
                i = int(nxt[i])
            return number, place[starts]
        for i in range(n - 1, -1, -1):  # where a chunk that starts here leads in the next block
            if nxt[i] < n:
                nxt[i] = nxt[nxt[i]]
        return number, nxt[:max_rows] - n

    def jumps(t: pa.Table) -> pa.Table:
        number, away = follow(t, None)
        return pa.table({"_block": np.full(len(away), number), "_at": np.arange(len(away)), "_next": away})

    def begin(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return pa.table({"_block": pa.array([], pa.int64()), "_place": pa.array([], pa.int64())})
        number, starts = follow(left, right["_at"].to_numpy())
        return pa.table({"_block": np.full(len(starts), number), "_place": starts})

    n_blocks = (placed.agg(F.max("_place")).first()[0] or 0) // block_rows + 1
    jump = written(blocks.groupBy("_block").applyInArrow(jumps, "_block long, _at long, _next long"), "chunk-jumps")
    entry = df.sparkSession.range(1).select(F.col("id").alias("_block"), F.col("id").alias("_at"))
    reach = 1
    while reach < n_blocks:
        ahead = entry.join(jump, ["_block", "_at"]).select((F.col("_block") + reach).alias("_block"), F.col("_next").alias("_at"))
        entry = written(entry.union(ahead), "chunk-entries")
        then = jump.select((F.col("_block") - reach).alias("_block"), F.col("_at").alias("_next"), F.col("_next").alias("_then"))
        jump = written(jump.join(then, ["_block", "_next"]).select("_block", "_at", F.col("_then").alias("_next")), "chunk-jumps")
        reach *= 2
    starts = blocks.groupBy("_block").cogroup(entry.groupBy("_block")).applyInArrow(begin, "_block long, _place long")
    starts = written(starts, "chunk-starts")
    # a chunk's number: the starts of the blocks before and of its own
    counts = starts.groupBy("_block").agg(F.count("*").alias("_n"))
    first = counts.select("_block", (F.sum("_n").over(Window.orderBy("_block")) - F.col("_n")).alias("_first"))  # one row a block
    marked = placed.withColumn("_block", block).join(starts.withColumn("_new", F.lit(1)), ["_block", "_place"], "left").join(first, "_block")
    w = Window.partitionBy("_block").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    return marked.withColumn("chunk", (F.col("_first") + F.coalesce(F.sum("_new").over(w), F.lit(0)) - 1).cast("long")).select(*names, "chunk")


def running(df: DataFrame, order: Sequence[str], size: str) -> DataFrame:
    """Rows with ``_place`` from 0 and ``_before``, the sum of the sizes before it, in global order, without one task for all.

    Rows are sorted in ranges; the ranges' totals, one row each, give their offsets.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # ranges come from a sample, so both readers below must see the same ones
    ordered = written(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    w = Window.partitionBy("_part").orderBy(*order)
    local = ordered.withColumns({"_place": F.row_number().over(w) - 1, "_before": F.coalesce(F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
    totals = ordered.groupBy("_part").agg(F.count("*").alias("_rows"), F.sum(size).alias("_bytes"))
    up = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    starts = totals.select("_part", F.coalesce(F.sum("_rows").over(up), F.lit(0)).alias("_r"), F.coalesce(F.sum("_bytes").over(up), F.lit(0)).alias("_b"))
    return local.join(starts, "_part").withColumns({"_place": F.col("_place") + F.col("_r"), "_before": F.col("_before") + F.col("_b")}).drop("_part", "_r", "_b")


def publish(records: DataFrame, path: str, max_bytes: int = 150 << 20, max_rows: int = 250) -> DataFrame:
    """Write records as gzip JSON lines by chunk and their index under a new version, then move the pointer.

    Readers of the pointer see the old publication whole until the new one is; a version is never written over.
    """
    import uuid

    spark: SparkSession = records.sparkSession
    version = f"{path}/{uuid.uuid4().hex}"
    cut = chunks(records, ["key"], F.octet_length(F.to_json(F.struct(*records.columns))) + 1, max_bytes, max_rows)  # with its line end
    cut = cut.withColumn("asset", F.col("chunk").cast("string")).drop("chunk")
    cut.write.partitionBy("asset").option("compression", "gzip").json(f"{version}/records")
    written = spark.read.schema(cut.schema).json(f"{version}/records")
    written.select("key", "asset", "text_version", "extracted_at", "symbol").write.parquet(f"{version}/index")
    spark.createDataFrame([(version,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/current")
    return published_index(spark, path)


def current_version(spark: SparkSession, path: str) -> str:
    return spark.read.text(f"{path}/current").first()[0]


def published_index(spark: SparkSession, path: str) -> DataFrame:
    """The index of the publication that the pointer names."""
    return spark.read.parquet(f"{current_version(spark, path)}/index")


def payload_v1(figures: DataFrame, titles: DataFrame) -> DataFrame:
    """(filing, payload JSON) of the first version: one object a filing with its statements, each item once by its best reading.

    ``figures``: filing, statement, item, value, confidence, page; ``titles``: filing, symbol, title.  Of readings of one
    item the one of greatest confidence counts, of equals that of the first page.
    """
    best = figures.groupBy("filing", "statement", "item").agg(F.max_by(F.struct("value", "confidence", "page"), F.struct("confidence", -F.col("page"))).alias("x")).select("filing", "statement", "item", "x.*")
    statement = best.groupBy("filing", "statement").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("item", F.struct("value", "confidence", "page").alias("reading"))))).alias("items"))
    whole = statement.groupBy("filing").agg(F.map_from_entries(F.collect_list(F.struct("statement", "items"))).alias("statements"))
    return titles.join(whole, "filing").select("filing", F.to_json(F.struct(F.lit(1).alias("schemaVersion"), "symbol", F.substring(clean(F.col("title")), 1, MAX_TEXT).alias("title"), "statements")).alias("payload"))


def outcomes(submitted: DataFrame, known: DataFrame, valid: Column, keys: Sequence[str]) -> DataFrame:
    """Each submitted row with its outcome: rejected if it is not valid, duplicate if it is known already or repeats an earlier
    row of the submission, else accepted.  Rows of one key are taken in order of all their columns."""
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.to_json(F.struct(c)) for c in submitted.columns]))
    seen = known.select(*keys).distinct().withColumn("_known", F.lit(True))
    joined = submitted.withColumn("_valid", F.coalesce(valid, F.lit(False))).withColumn("_n", F.when(F.col("_valid"), first)).join(seen, list(keys), "left")
    outcome = F.when(~F.col("_valid"), "rejected").when(F.col("_known") | (F.col("_n") > 1), "duplicate").otherwise("accepted")
    return joined.withColumn("outcome", outcome).drop("_valid", "_n", "_known")


def stage_dump(stages: dict[str, DataFrame], keys: Sequence[str], path: str) -> None:
    """Write what each stage made as JSON lines under its name, for comparing runs: rows in order of the keys."""
    for name, df in stages.items():
        df.select(*keys, F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("row")).sortWithinPartitions(*keys).write.mode("overwrite").json(f"{path}/{name}")


def item_guide(groups: dict[str, Sequence[str]], rules: dict[str, Sequence[tuple]]) -> str:
    """The item vocabulary as a Markdown document: a table for each statement with the label patterns that name an item."""
    lines = []
    for group, items in groups.items():
        lines += [f"## {group}", "", "| item | printed as |", "|---|---|"]
        patterns = {name: pattern for name, pattern, *_ in rules.get(group, ())}
        lines += [f"| {item} | {'`' + patterns[item].replace('|', chr(92) + '|') + '`' if item in patterns else ''} |" for item in items] + [""]
    return "\n".join(lines)


def write_snapshot(df: DataFrame, path: str, day: str) -> None:
    """Replace one day's partition: a repeated submission leaves one copy."""
    df.where(F.col("day") == day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)
