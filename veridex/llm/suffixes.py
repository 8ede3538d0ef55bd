"""Removal of repeated 100-byte strings by external induced sorting of sampled suffixes.

Sampled suffixes: in every 100-byte string the gram of 36 bytes with the least hash marks an anchor, a choice that depends
on content alone, so equal strings have equal anchors at equal offsets.  Anchors whose gram occurs once in the corpus
cannot lie in a repeated string and are dropped after one count.  For the others the suffix tuple is (gram, bytes around
the anchor that its strings reach); equal tuples are aggregated, so thousands of copies are one tuple, and all copies but
the first go whole.  The distinct tuples are dealt to shards by their gram, and each shard is sorted by
``induction.InducedSorter``: the suffixes at the anchors first, then those 1, 2, ... bytes before them, each level induced
from the one before, with tuples and common prefixes in disk-backed priority queues.  A shard may be far larger than a
task's memory.

Order is by doc_id (null last), then by text hash among rows of one id, then by place.  Rows that repeat both id and text
are one document: they don't remove each other and give equal result rows.  Null and empty texts have no strings.  Texts
of any length are read whole, in segments.  An empty table gives an empty result; other columns are not read, or pass
unchanged whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, document_key, document_key_col, materialize, release_memory, rows_to_batches, slices, utf8
from .dictionary import BLOCK_BYTES, MAX_TABLE_BYTES, blocks, resolve
from .induction import InducedSorter

SIZE, GRAM = 100, 36
SPAN = SIZE - GRAM  # anchors lie 0 to SPAN bytes after their string's start
SEGMENT = 1 << 20
LAST = (1 << 63) - 1
OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

_P = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        n = max(n, 1 << 16)
        up, down = np.full(n, _P), np.full(n, _INV)
        up[0] = down[0] = 1
        _POWERS[:] = [np.cumprod(up), np.cumprod(down)]
    return _POWERS[0][:n], _POWERS[1][:n]


def gram_hashes(b: np.ndarray) -> np.ndarray:
    """A mixed 64-bit hash of every gram."""
    n = len(b)
    up, down = _powers(n + 1)
    c = np.zeros(n + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:n], out=c[1:])
    g = (c[GRAM:] - c[:-GRAM]) * down[: n - GRAM + 1]
    g ^= g >> np.uint64(32)
    g *= np.uint64(0xD6E8FEB86659FD93)
    g ^= g >> np.uint64(29)
    g *= np.uint64(0xA3B195354A39B70D)
    g ^= g >> np.uint64(32)
    return g


def _sliding(x: np.ndarray, width: int, take) -> np.ndarray:
    have = 1
    while have < width:
        step = min(have, width - have)
        x = take(x[: len(x) - step], x[step:])
        have += step
    return x


def anchors(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gram hash, place, first and last start of the strings it marks) of each anchor of a text."""
    every = np.frombuffer(raw, np.uint8)
    starts = len(every) - SIZE + 1
    out = []
    for lo in range(0, max(starts, 0), SEGMENT):
        count = min(SEGMENT, starts - lo)
        h = gram_hashes(every[lo : lo + count + SIZE - 1])
        least = _sliding(h, SPAN + 1, np.minimum)
        padded = np.zeros(count + 2 * SPAN, np.uint64)
        padded[SPAN : SPAN + count] = least
        at = np.flatnonzero(_sliding(padded, SPAN + 1, np.maximum) == h)
        # the leftmost anchor of least hash at or after each start
        own = np.searchsorted(at, np.arange(count))
        wrong = np.flatnonzero(h[at[own]] != least)
        while len(wrong):
            own[wrong] += 1
            wrong = wrong[h[at[own[wrong]]] != least[wrong]]
        first = np.flatnonzero(np.diff(own, prepend=-1))
        last = np.append(first[1:], count) - 1
        p = at[own[first]]
        out.append((h[p].view(np.int64), p + lo, first + lo, last + lo))
    if not out:
        return (np.empty(0, np.int64),) * 4
    return tuple(np.concatenate(x) for x in zip(*out))


def repeated_grams(docs: DataFrame) -> DataFrame:
    """(key, value) of the anchor grams that occur twice or more."""
    schema = pa.schema([("key", pa.int64()), ("n", pa.int64())])

    def run(batches):
        for rows in blocks((row for b in batches for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist())), BLOCK_BYTES // 4):
            got = [a[0][np.concatenate([[True], a[1][1:] != a[1][:-1]])] for _, t in rows if t and len(a := anchors(utf8(t))) and len(a[0])]
            if got:
                k, n = np.unique(np.concatenate(got), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(n.astype(np.int64))], schema=schema)

    return docs.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key", F.lit(b"").alias("value"))


def _gram_keys(rows):
    got = [anchors(utf8(t))[0] for _, t in rows if t]
    return np.unique(np.concatenate(got)) if got else np.empty(0, np.int64)


_TUPLE = "gram long,tuple_key binary,doc long,dk long,p long,lo long,hi long,around binary"


def _tuples(rows, lookup):
    """The suffix tuples of the repeated anchors."""
    for doc_id, text in rows:
        if not text:
            continue
        raw = utf8(text)
        g, p, lo, hi = anchors(raw)
        if not len(g):
            continue
        on = np.flatnonzero(lookup.find(g) >= 0)
        if not len(on):
            continue
        dk, doc = document_key(doc_id, raw), LAST if doc_id is None else doc_id
        for a, b, c, d in zip(g[on].tolist(), p[on].tolist(), lo[on].tolist(), hi[on].tolist()):
            around = raw[c : d + SIZE]
            yield a, xxhash.xxh3_128_digest(around + (b - c).to_bytes(2, "little")), doc, dk, b, c, d, around


_RANGE = "doc long,dk long,from long,to long"


def induced_ranges(batches, memory: int | None = None):
    """Batches of (doc, dk, p, lo, hi, around) of a shard in, batches of removed ranges out."""
    sorter = InducedSorter(SIZE, SPAN, **({} if memory is None else {"memory": memory}))
    for b in batches:
        doc, dk, p, lo, hi = (b.column(i).to_numpy(zero_copy_only=False) for i in range(5))
        around = b.column(5).cast(pa.large_binary())
        ends = np.frombuffer(around.buffers()[1], np.int64, len(around) + 1, around.offset * 8)
        sorter.add(doc, dk, p, p - lo, p - hi, np.frombuffer(around.buffers()[2] or b"\0", np.uint8), ends[:-1], ends[1:])
    schema = arrow_schema(_RANGE)
    for part in sorter.ranges():
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(part[:, i])) for i in range(4)], schema=schema)
    del sorter
    release_memory()


def removed_ranges(docs: DataFrame, max_table_bytes: int = MAX_TABLE_BYTES, memory: int | None = None) -> DataFrame:
    """(doc, dk, from, to) of byte ranges to remove; they may overlap."""
    grams = repeated_grams(docs)
    tuples = materialize(resolve(docs, grams, _gram_keys, _tuples, _TUPLE.replace(",", ", "), max_table_bytes), "suffix-tuples")
    place = lambda: F.struct("doc", "dk", "p", "lo", "hi")
    firsts = tuples.groupBy("tuple_key").agg(F.min(place()).alias("first"), F.count("*").alias("n"), F.first("gram").alias("gram"), F.first("around").alias("around"))
    firsts = materialize(firsts, "suffix-firsts")
    again = (
        tuples.select("tuple_key", place().alias("own"))
        .join(firsts.where("n > 1").select("tuple_key", "first"), "tuple_key")
        .where((F.col("own.doc") != F.col("first.doc")) | (F.col("own.dk") != F.col("first.dk")) | (F.col("own.p") != F.col("first.p")))
        .select(F.col("own.doc").alias("doc"), F.col("own.dk").alias("dk"), F.col("own.lo").alias("from"), (F.col("own.hi") + SIZE).alias("to"))
    )
    shards = firsts.repartition("gram").select("first.doc", "first.dk", "first.p", "first.lo", "first.hi", "around")
    induced = shards.mapInArrow(lambda batches: induced_ranges(batches, memory), _RANGE.replace(",", ", "))
    return again.unionByName(induced)


def _merge(batches):
    """Ranges of each document as one sorted, disjoint list of int64 pairs."""
    schema = pa.schema([("key", pa.int64()), ("value", pa.binary())])

    def merged(ranges):
        out: list[list[int]] = []
        for lo, hi in sorted(ranges):
            if out and lo <= out[-1][1]:
                out[-1][1] = max(out[-1][1], hi)
            else:
                out.append([lo, hi])
        return np.array(out, "<i8").tobytes()

    for b in batches:
        values = [merged(zip(x, y)) for x, y in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(values, pa.binary())], schema=schema)


def _spans(docs: DataFrame, max_table_bytes: int, memory: int | None) -> DataFrame:
    ranges = removed_ranges(docs, max_table_bytes, memory)
    return ranges.groupBy(F.col("dk").alias("key")).agg(F.collect_set(F.struct("from", "to")).alias("r")).select("key", "r.from", "r.to").mapInArrow(_merge, "key long, value binary")


def _document_keys(rows):
    return list({document_key(d, utf8(t)) for d, t in rows})


def _cut(rows, lookup):
    """(doc_id, raw bytes, removed pairs) of each row."""
    raws = [utf8(t) for _, t in rows]
    places = lookup.find(np.array([document_key(d, r) for (d, _), r in zip(rows, raws)], np.int64)) if rows else []
    for (doc_id, _), raw, at in zip(rows, raws, places):
        yield doc_id, raw, np.frombuffer(lookup.value(int(at)), "<i8").reshape(-1, 2).tolist() if at >= 0 else []


def kept_bytes(raw: bytes, pairs) -> bytes:
    ends = [0, *(x for pair in pairs for x in pair), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(ends[::2], ends[1::2]))


def _digest(rows, lookup):
    for doc_id, raw, pairs in _cut(rows, lookup):
        kept = kept_bytes(raw, pairs)
        yield doc_id, len(raw), len(raw) - len(kept), len(pairs), hashlib.sha256(kept).hexdigest()


def remove_repeats(docs: DataFrame, max_table_bytes: int = MAX_TABLE_BYTES, memory: int | None = None) -> DataFrame:
    """What is removed of every document, and the digest of what is kept."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return resolve(docs, _spans(docs, max_table_bytes, memory), _document_keys, _digest, OUT, max_table_bytes)


def cut_documents(docs: DataFrame, max_table_bytes: int = MAX_TABLE_BYTES, memory: int | None = None) -> DataFrame:
    """The documents without their repeated strings; a cut never leaves part of a character: its bytes go with it.

    Columns as given, ``n_chars`` kept in step.
    """
    pairs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spans = materialize(_spans(pairs, max_table_bytes, memory), "suffix-spans")
    columns = docs.columns
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("d"), document_key_col(F.col("doc_id").cast("long"), F.col("text")).alias("key"))
    return keyed.join(spans, "key", "left").select("d", "value").mapInArrow(_apply(columns), docs.schema)


def _apply(columns):
    def run(batches):
        for b in slices(batches):
            d, out = b.column(0), []
            for t, spans in zip(d.field(columns.index("text")).to_pylist(), b.column(1).to_pylist()):
                if t and spans:
                    t = kept_bytes(utf8(t), np.frombuffer(spans, "<i8").reshape(-1, 2).tolist()).decode("utf-8", "ignore")
                out.append(t)
            put = {"text": out, "n_chars": [None if t is None else len(t) for t in out]}
            yield pa.RecordBatch.from_arrays([pa.array(put[c], d.type.field(i).type) if c in put else d.field(i) for i, c in enumerate(columns)], names=columns)

    return run
