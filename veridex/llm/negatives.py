"""Hard-negative mining by a full sort of each anchor's scores.

Anchors and rows are written as blocks of whole-number vectors, and every block of anchors meets every block of rows: a stated query
set against all rows.  A task sorts each anchor's scores against its rows by (score, id).  The first pass keeps the first positives; the
second finds, in the sorted scores, each positive's upper limit by binary search and reads different-label rows down to the lower
limit.  A task holds one block of each side at a time and at most ``HELD`` anchors' best rows so far; what tasks found is merged by a
window for each anchor, whose size is the number of row tasks times a few rows.  No pair of rows is written that is not among a
task's best.

Defined cases: rows with a null label, vector or component, or with a component that is not finite, take no part.  A null id is no
anchor's, and comes last among ties.  Rows that repeat an id, or everything, are rows of their own: each that is an anchor is mined by
itself, and the other can be its positive.  Vectors of different lengths count as padded with zeros.  Scores are exact at any size of
components; one that a long cannot hold ends the query with an error.  An empty table gives no rows; columns besides
``vec_id``, ``embedding`` and ``label`` are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_schema, bounded, materialize, release_memory, slices

EVERY = 50
POSITIVES = 5
NEGATIVES = 3
#: Hundredths of the positive's score between which a negative lies.
LOWER, UPPER = 50, 95
BLOCK_ROWS = 2048
#: Rows that one task reads for each block of anchors.
TASK_ROWS = 1 << 17
#: Anchors whose best rows a task holds at once, and anchors that are scored at once.
HELD = 1 << 14
AT_ONCE = 64

_BLOCK = arrow_schema("side long,block long,body binary")
_FOUND = arrow_schema("anchor long,positive long,id long,score long,positive_score long")


def prepared(vectors: DataFrame) -> DataFrame:
    """key, vec_id, label, x: the rows that take part, with whole components; a written table, whose rows have keys of their own."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("long")
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    rows = vectors.where(F.col("label").isNotNull() & F.col("embedding").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), F.col("embedding").cast("array<double>").alias("x")).where(F.forall("x", finite))
    whole = F.transform("x", lambda v: F.floor(v * 256.0).cast("double"))
    # a component beyond a long would saturate under floor(); it is a whole number as it is
    whole = F.zip_with(whole, F.col("x"), lambda w, v: F.when(F.abs(v) < 2.0**52, w).otherwise(v * 256.0))
    return materialize(rows.select(F.monotonically_increasing_id().alias("key"), "vec_id", "label", whole.alias("x")), "vectors")


def _pack(ids, keys, labels, x, more) -> bytes:
    """A block as an Arrow stream; the components as the smallest floats that hold them."""
    width = max((len(v) for v in x), default=0)
    m = np.zeros((len(x), width))
    for i, v in enumerate(x):
        m[i, : len(v)] = v
    if not m.size or np.abs(m).max() < 1 << 24:
        m = m.astype(np.float32)
    out = pa.BufferOutputStream()
    columns = {"id": pa.array(ids, pa.int64()), "key": pa.array(keys, pa.int64()), "label": pa.array(labels, pa.int64()), "x": pa.array([r.tobytes() for r in m], pa.binary())}
    if more is not None:
        columns |= {"positives": pa.array(more[0], pa.list_(pa.int64())), "scores": pa.array(more[1], pa.list_(pa.int64()))}
    t = pa.table(columns, metadata={b"kind": m.dtype.str.encode()})
    with pa.ipc.new_stream(out, t.schema) as w:
        w.write_table(t)
    return out.getvalue().to_pybytes()


class _Block:
    def __init__(self, body: bytes):
        t = pa.ipc.open_stream(body).read_all()
        self.id, self.key, self.label = t["id"].to_pylist(), t["key"].to_numpy(), t["label"].to_numpy()
        self.x = np.frombuffer(b"".join(t["x"].to_pylist()), np.dtype(t.schema.metadata[b"kind"].decode())).reshape(len(t), -1)
        if "scores" in t.column_names:
            self.positives, self.scores = t["positives"].to_pylist(), t["scores"].to_pylist()
        self.most = float(np.abs(self.x).max(initial=0))


def scores(a: np.ndarray, b: np.ndarray, bound: float) -> np.ndarray:
    """Exact inner products: as doubles while they are exact, else as Python's numbers."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width].astype(np.float64), b[:, :width].astype(np.float64)
    if width * bound < 2.0**53:
        return np.rint(a @ b.T).astype(np.int64)
    big = lambda m: np.array([[int(v) for v in r] for r in m], object).reshape(m.shape)
    return big(a).dot(big(b).T) if width else np.zeros((len(a), len(b)), np.int64)


def _blocks(rows: DataFrame, side: int, block_rows: int) -> DataFrame:
    """(side, block, body): rows of a task in order of id, nulls last, in blocks."""
    columns = rows.columns[4:]

    def run(batches):
        held, number = [], 0

        def flush():
            nonlocal held, number
            held.sort(key=lambda r: (r[1] is None, r[1] or 0))
            more = ([r[4] for r in held], [r[5] for r in held]) if columns else None
            body = _pack([r[1] for r in held], [r[0] for r in held], [r[2] for r in held], [r[3] for r in held], more)
            held, number = [], number + 1
            return pa.RecordBatch.from_arrays([pa.array([side]), pa.array([number]), pa.array([body], pa.binary())], schema=_BLOCK)

        for b in slices(batches):
            for row in zip(*(c.to_pylist() for c in b.columns)):
                held.append(row)
                if len(held) >= block_rows:
                    yield flush()
        if held:
            yield flush()
        release_memory()

    return rows.mapInArrow(run, "side long, block long, body binary")


def _meet(anchors: DataFrame, rows: DataFrame, best) -> DataFrame:
    """Every block of anchors with every block of rows; ``best`` gives lists of (anchor, positive, id, score, positive_score, order)."""

    def run(batches):
        held: dict = {}
        anchors_held, a, name = 0, None, None

        def out():
            found = [row[:5] for rows in held.values() for row in rows]
            held.clear()
            for lo in range(0, len(found), 4096):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found[lo : lo + 4096]), _FOUND)], schema=_FOUND)

        for batch in slices(batches, 1):
            body = batch.column(0)[0].as_py()
            if body != name:
                a, name = _Block(body), body
                anchors_held += len(a.key)
            b = _Block(batch.column(1)[0].as_py())
            for group, rows, keep in best(a, b):
                if group in held:
                    rows = sorted(held[group] + rows, key=lambda r: r[5])[:keep]
                held[group] = rows
            if anchors_held > HELD:
                yield from out()
                anchors_held = len(a.key)
        yield from out()
        release_memory()

    pairs = anchors.select(F.col("body").alias("a")).crossJoin(rows.select(F.col("body").alias("b")))  # of blocks
    return pairs.mapInArrow(run, "anchor long, positive long, id long, score long, positive_score long")


def _sorted(a: _Block, b: _Block):
    """For each anchor of ``a``: its place, and its scores with the rows of ``b`` in order (score, then id) with their places."""
    for lo in range(0, len(a.key), AT_ONCE):
        every = scores(a.x[lo : lo + AT_ONCE], b.x, a.most * b.most)
        for i, s in enumerate(every, lo):
            order = np.argsort(-s, kind="stable")  # the block is in order of id
            yield i, s[order], order


def _rank(score, row_id):
    return (-score, row_id is None, row_id or 0)


def first_positives(positives: int):
    def best(a: _Block, b: _Block):
        for i, s, order in _sorted(a, b):
            same = np.flatnonzero((b.label[order] == a.label[i]) & (b.key[order] != a.key[i]))[:positives]
            rows = [(int(a.key[i]), None, b.id[order[j]], int(s[j]), None, _rank(int(s[j]), b.id[order[j]])) for j in same]
            yield int(a.key[i]), rows, positives

    return best


def first_negatives(negatives: int, lower: int, upper: int):
    def best(a: _Block, b: _Block):
        for i, s, order in _sorted(a, b):
            other = np.flatnonzero(b.label[order] != a.label[i])
            falling = -s[other]
            for slot, score in enumerate(a.scores[i]):
                most, least = upper * score // 100, -(-lower * score // 100)
                lo = int(np.searchsorted(falling, -most, "left"))
                hi = min(lo + negatives, int(np.searchsorted(falling, -least, "right")))
                if lo < hi:
                    yield (int(a.key[i]), slot), [(int(a.key[i]), slot, b.id[order[j]], int(s[j]), score, _rank(int(s[j]), b.id[order[j]])) for j in other[lo:hi]], negatives

    return best


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, lower: int = LOWER, upper: int = UPPER, block_rows: int = BLOCK_ROWS, task_rows: int = TASK_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = bounded(vectors.sparkSession)
    rows = prepared(vectors)
    n = rows.count()
    tasks = min(max(-(-n // task_rows), spark.sparkContext.defaultParallelism), max(1, -(-n // block_rows)))
    blocks = materialize(_blocks(rows.repartition(tasks), 0, block_rows), "vector-blocks")
    anchors = rows.where(F.col("vec_id") % every == 0)
    near = materialize(_blocks(anchors.repartition(max(1, -(-n // (every * HELD)))), 1, block_rows), "anchor-blocks")
    found = _first(_meet(near, blocks, first_positives(positives)), ["anchor"], positives)
    best = found.groupBy(F.col("anchor").alias("key")).agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("p"))  # at most ``positives``
    best = materialize(anchors.join(best, "key").select("key", "vec_id", "label", "x", F.col("p.id").alias("positives"), F.col("p.score").alias("scores")), "positives")
    near = materialize(_blocks(best.repartition(max(1, -(-n // (every * HELD)))), 1, block_rows), "anchor-blocks")
    found = _first(_meet(near, blocks, first_negatives(negatives, lower, upper)), ["anchor", "positive"], negatives)
    ids = best.select(F.col("key").alias("anchor"), F.col("vec_id").alias("anchor_id"), "positives")
    out = found.join(ids, "anchor")
    return out.select("anchor_id", F.get("positives", F.col("positive")).alias("positive_id"), "rank", F.col("id").alias("negative_id"), F.col("positive_score"), F.col("score").alias("negative_score"))
