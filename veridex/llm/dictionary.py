"""Per-document work that needs values of keys found in the text, where the table of all keys may be of any size.

``resolve`` has two ways of one meaning.  A table of checked size (``max_bytes``) is written to the shared folder as a
sorted key array with values, and every worker loads it once.  A larger one never reaches one place whole: texts are
gathered in blocks of bounded size, the distinct keys of each block are joined with the table, and each block meets the
values of its own keys only (a cogroup by block), so a task holds at most what its block asks for.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, materialize, record_batches, rows_to_batches, scratch

#: A table up to this size is loaded whole by each worker.
MAX_TABLE_BYTES = 256 << 20
BLOCK_BYTES = 4 << 20

_LOADED: dict[str, "Lookup"] = {}


class Lookup:
    """Sorted 64-bit keys with binary values."""

    def __init__(self, keys: np.ndarray, offsets: np.ndarray | range, blob: bytes | bytearray | memoryview):
        self.keys, self.offsets, self.blob = keys, offsets, blob

    @classmethod
    def of(cls, keys: np.ndarray, values: pa.Array) -> "Lookup":
        order = np.argsort(keys, kind="stable")
        values = values.take(pa.array(order))
        keys = keys[order]
        return cls(keys, np.frombuffer(values.buffers()[1], np.int64, len(values) + 1, values.offset * 8), memoryview(values.buffers()[2] or b""))

    def find(self, wanted: np.ndarray) -> np.ndarray:
        """Places of the wanted keys, -1 where missing."""
        if not len(self.keys):
            return np.full(len(wanted), -1)
        order = np.argsort(wanted)
        at = np.empty(len(wanted), np.int64)
        at[order] = np.searchsorted(self.keys, wanted[order])
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == wanted, at, -1)

    def value(self, place: int) -> bytes:
        return bytes(self.blob[self.offsets[place] : self.offsets[place + 1]])

    def numbers(self, places: np.ndarray, kind, missing) -> np.ndarray:
        """Values as numbers, where each value is one number of ``kind``."""
        every = np.frombuffer(self.blob, kind, len(self.keys), int(self.offsets[0]) if len(self.keys) else 0)
        return np.where(places >= 0, every[np.maximum(places, 0)], missing) if len(every) else np.full(len(places), missing)


def _load(path: str) -> Lookup:
    """The table of a path, kept by the worker; files in order of keys need no sort here."""
    if path in _LOADED:
        return _LOADED[path]
    _LOADED.clear()
    fs, p = pafs.FileSystem.from_uri(path)
    files = sorted(f.path for f in fs.get_file_info(pafs.FileSelector(p)) if f.base_name.endswith(".parquet"))
    # arrays of the table's own size are filled batch by batch: lists of parts, joined at the end, would be there twice
    opened = [pq.ParquetFile(fs.open_input_file(f)) for f in files]
    n, at, width, blob = sum(f.metadata.num_rows for f in opened), 0, None, bytearray()
    keys, ends = np.empty(n, np.int64), None
    for f in opened:
        for batch in f.iter_batches(1 << 17, columns=["key", "value"]):
            values = batch.column(1)
            m, offsets = len(values), np.frombuffer(values.buffers()[1], np.int32, len(values) + 1, values.offset * 4)
            keys[at : at + m] = batch.column(0).to_numpy(zero_copy_only=False)
            widths = np.diff(offsets)
            if ends is None and m and (width is not None and np.any(widths != width) or np.any(widths != widths[0])):  # values differ in length
                ends = np.zeros(n + 1, np.int64)
                ends[: at + 1] = np.arange(at + 1) * (width or 0)
            elif width is None and m:
                width = int(widths[0])
            if ends is not None:
                ends[at + 1 : at + m + 1] = len(blob) + (offsets[1:].astype(np.int64) - offsets[0])
            blob += memoryview(values.buffers()[2] or b"")[offsets[0] : offsets[-1]]
            at += m
    offsets = ends if ends is not None else range(0, n * width + 1, width) if width else np.zeros(n + 1, np.int64)
    if np.any(keys[1:] < keys[:-1]):
        ends = np.asarray(offsets, np.int64)
        _LOADED[path] = Lookup.of(keys, pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(blob)]))
    else:
        _LOADED[path] = Lookup(keys, offsets, blob)
    return _LOADED[path]


def blocks(rows, size: int = BLOCK_BYTES):
    """Lists of rows whose second member, a text, adds up to ``size``; a longer text is a block of its own."""
    held, total = [], 0
    for row in rows:
        n = len(row[1] or "")
        if held and total + n > size:
            yield held
            held, total = [], 0
        held.append(row)
        total += n
    if held:
        yield held


def resolve(docs: DataFrame, table: DataFrame, keys_of, finish, ddl: str, max_bytes: int = MAX_TABLE_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` has (doc_id, text), ``table`` has (key long, value binary) with unique keys, best in ranges and sorted by key.

    ``keys_of(rows)`` gives the distinct keys that a list of rows asks for; ``finish(rows, lookup)`` yields output tuples.
    """
    spark = docs.sparkSession
    path = scratch(spark, "dictionary")
    table.select("key", "value").write.option("compression", "zstd").parquet(path)
    table = spark.read.schema("key long, value binary").parquet(path)
    size = table.agg(F.sum(F.length("value") + 16)).first()[0] or 0
    schema = arrow_schema(ddl)
    pairs = lambda batches: (row for b in batches for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
    if size <= max_bytes:

        def whole(batches):
            table = None

            def out():
                nonlocal table
                for rows in blocks(pairs(batches), block_bytes):
                    table = table or _load(path)
                    yield from finish(rows, table)

            return rows_to_batches(out(), schema)

        return docs.mapInArrow(whole, ddl)

    asked = pa.schema([("block", pa.string()), ("body", pa.binary()), ("key", pa.int64())])

    def pack(batches):
        import uuid

        for rows in blocks(pairs(batches), block_bytes):
            body = pa.BufferOutputStream()
            t = pa.table({"doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string())})
            with pa.ipc.new_stream(body, t.schema) as w:
                w.write_table(t)
            name = uuid.uuid4().hex
            yield pa.RecordBatch.from_arrays([[name], pa.array([zstandard.compress(body.getvalue().to_pybytes(), 3)], pa.binary()), pa.array([None], pa.int64())], schema=asked)
            wanted = keys_of(rows)
            # a row for each key: a reader of Parquet takes thousands of rows at once, which must not be thousands of whole lists
            for part in (wanted[i : i + (1 << 16)] for i in range(0, len(wanted), 1 << 16)):
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(part)), pa.nulls(len(part), pa.binary()), pa.array(part, pa.int64())], schema=asked)

    # written once, so that a block is never dealt anew under another name
    packed = materialize(docs.mapInArrow(pack, "block string, body binary, key long"), "blocks", "none")
    need = packed.where("key is not null").select(F.col("block").alias("at"), "key").join(table, "key").select("at", "key", "value")

    def meet(left, right):
        for body in left["body"].to_pylist():
            rows = pa.ipc.open_stream(zstandard.decompress(body)).read_all()
            keys = right["key"].combine_chunks()
            keys = keys.to_numpy(zero_copy_only=False) if len(right) else np.empty(0, np.int64)
            values = right["value"].cast(pa.large_binary())
            values = pa.concat_arrays(values.chunks) if values.num_chunks else pa.array([], pa.large_binary())
            out = list(finish(list(zip(*(c.to_pylist() for c in rows.columns))), Lookup.of(keys, values)))
            return pa.Table.from_batches(record_batches(out, schema), schema=schema)

    return packed.where("body is not null").select("block", "body").groupBy("block").cogroup(need.groupBy("at")).applyInArrow(meet, ddl)
