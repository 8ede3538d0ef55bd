"""What the operators of this folder share: scratch tables, row keys, CRC folds.

Scratch tables live in ``spark.checkpoint.dir``, the folder that driver and executors share.  Only where
that setting is absent (tests on one machine) a temporary folder is set instead.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import shutil
import tempfile
import uuid
import zlib

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word contracts: space and U+0009 to U+000D.  ``bytes.split()`` cuts at exactly these.
WORD = r"[^\x20\x09-\x0D]+"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = tempfile.mkdtemp(prefix="veridex-")
        atexit.register(shutil.rmtree, base, True)
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, so a lost executor costs a reread."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def drop_written(df: DataFrame) -> None:
    """Delete a materialized table that no later read needs: what was made of it must have been written itself."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._written_to)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


#: Bytes of a batch between Spark and a Python worker, at most.
BATCH_BYTES = 8 << 20


def bounded(spark: SparkSession) -> SparkSession:
    """The session with batches bounded by bytes: long texts would make batches of a fixed number of rows very large."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.sparkContext.getConf().get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))
    return spark


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bounded(spark).read.parquet(f"{sf_dir}/documents.parquet")


def crc_fold(doc_id, modulus: int) -> int:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % modulus


def crc_fold_col(col, modulus: int):
    """The same as a column."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def utf8(text) -> bytes:
    """UTF-8 of a text, null as empty."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def document_key(doc_id, raw: bytes) -> int:
    """64-bit key of a row's id and text."""
    seed = xxhash.xxh64_intdigest(b"" if doc_id is None else str(doc_id).encode(), seed=42)
    key = xxhash.xxh64_intdigest(raw, seed=seed)
    return key - (1 << 64) if key >> 63 else key


def document_key_col(doc_id, text):
    """The same as a column."""
    return F.xxhash64(F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text, F.lit("")))


def arrow_schema(ddl: str) -> pa.Schema:
    """Arrow schema of a flat DDL string."""
    kinds = {
        "long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64(),
        "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
        "array<binary>": pa.list_(pa.binary()), "array<string>": pa.list_(pa.string()), "array<float>": pa.list_(pa.float32()),
    }
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in ddl.split(","))])


def release_memory() -> None:
    """Give back what a task has freed: workers are reused, and would carry the peak of one stage into the next."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # a C library without it
        ctypes.CDLL(None).malloc_trim(0)


def rows_to_batches(rows, schema: pa.Schema, size: int = 4096):
    """Record batches of ``size`` rows from an iterator of tuples; at its end the task's memory is given back."""
    yield from record_batches(rows, schema, size)
    del rows
    release_memory()


def record_batches(rows, schema: pa.Schema, size: int = 4096):
    """Record batches of ``size`` rows from an iterator of tuples, within a task (a group of many)."""
    held: list = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows, schema):
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def slices(batches, size: int = 512):
    """Batches of at most ``size`` rows: a batch of long texts is never a Python list as a whole."""
    for b in batches:
        for lo in range(0, b.num_rows, size):
            yield b.slice(lo, size)


def map_rows(df: DataFrame, fn, ddl: str) -> DataFrame:
    """``mapInArrow`` where ``fn`` maps an iterator of row tuples to an iterator of output tuples."""
    schema = arrow_schema(ddl)

    def run(batches):
        return rows_to_batches(fn(row for b in slices(batches) for row in zip(*(c.to_pylist() for c in b.columns))), schema)

    return df.mapInArrow(run, ddl.replace(",", ", "))
