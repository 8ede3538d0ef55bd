"""Content-defined payload chunking.

A payload (UTF-8 of the text, zero bytes up to a positive multiple of 64) is cut where a rolling gear hash of the last
32 bytes has ``MASK_BITS`` zero bits, between ``MIN_CHUNK`` and ``MAX_CHUNK`` bytes.  Chunks are named by their SHA-256.
Digests are deduplicated by Spark joins: each distinct digest has one owner, the least (payload, place) that holds it,
and the chunk table stores its record once: 4 bytes of length, little-endian, then the chunk.  A payload is rebuilt from
the stored records by its ordered chunk list, each checked against its length, the whole against the digest taken when it
was cut.  The media of a document are its records in order, as they are read back.

Null and empty texts are 64 zero bytes.  Texts of any length are cut whole.  Equal texts share one payload, repeated rows
give repeated result rows, and an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, map_rows, materialize, record_batches, rows_to_batches, slices, utf8

UNIT, MIN_CHUNK, MAX_CHUNK, MASK_BITS = 64, 2048, 65536, 13
#: The gear table: 256 numbers from a fixed generator.
GEAR = np.random.Generator(np.random.PCG64(20240501)).integers(0, 1 << 32, 256, dtype=np.uint32)
#: Up to this many documents that don't store all of their chunks are sent to all executors; more are joined by shuffle.
BROADCAST_ROWS = 200_000

_FEATURES = "payload binary,payload_bytes long,payload_sha256 string,tail_crc32 long,media_bytes long,media_sha256 string,feature string"


def payload_of(text) -> tuple[int, bytes]:
    """Unpadded length and payload of a text."""
    raw = utf8(text)
    return len(raw), raw + bytes(-len(raw) % UNIT if raw else UNIT)


def cut(payload: bytes) -> list[bytes]:
    """Chunks of a payload, in order."""
    n = len(payload)
    if n <= MIN_CHUNK:
        return [payload]
    h = GEAR[np.frombuffer(payload, np.uint8)].copy()
    for s in (1, 2, 4, 8, 16):
        h[s:] += h[:-s] << np.uint32(s)
    ends = np.flatnonzero(h >> np.uint32(32 - MASK_BITS) == 0) + 1
    chunks, lo, at = [], 0, 0
    while lo < n:
        at = int(np.searchsorted(ends, lo + MIN_CHUNK))
        hi = min(int(ends[at]) if at < len(ends) else n, lo + MAX_CHUNK, n)
        chunks.append(payload[lo:hi])
        lo = hi
    return chunks


def manifest(docs: DataFrame) -> DataFrame:
    """doc_id, key (of its text), n_bytes, payload (its digest) and ordered chunk digests of every document."""

    def rows(it):
        for doc_id, text, key in it:
            n, p = payload_of(text)
            yield doc_id, key, n, hashlib.sha256(p).digest(), [hashlib.sha256(c).digest() for c in cut(p)]

    return map_rows(_keyed(docs), rows, "doc_id long,key string,n_bytes long,payload binary,chunks array<binary>")


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with a key of their text: null and repeated ids are told apart by it, and each has one payload."""
    return docs.select("doc_id", "text", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("key"))


def record_of(chunk: bytes) -> bytes:
    return len(chunk).to_bytes(4, "little") + chunk


def features(expected: bytes, records: list[bytes]) -> tuple:
    """Columns computed from the records read back; raises if they don't make the payload that was stored."""
    if any(int.from_bytes(r[:4], "little") != len(r) - 4 for r in records):
        raise ValueError(f"a record of payload {expected.hex()} is broken")
    payload = b"".join(r[4:] for r in records)
    digest = hashlib.sha256(payload)
    if digest.digest() != expected:
        raise ValueError(f"payload {expected.hex()} was not rebuilt")
    media = hashlib.sha256()
    for r in records:
        media.update(r)
    samples = np.frombuffer(payload, np.uint8)
    bands = np.bincount(samples >> 4, minlength=16)
    return expected, len(payload), digest.hexdigest(), zlib.crc32(payload[-UNIT:]), sum(map(len, records)), media.hexdigest(), f"{len(records)}|" + ",".join(map(str, bands))


def store_chunks(docs: DataFrame, plan: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> tuple[DataFrame, DataFrame]:
    """The chunk table (payload, seq, n_chunks, digest, record), each distinct digest once, and the borrowed (payload, seq, n_chunks, digest)."""
    row = F.struct("doc_id", "key")
    payloads = plan.groupBy("payload").agg(F.min(row).alias("writer"), F.first("chunks").alias("chunks"))
    refs = payloads.select("payload", "writer", F.size("chunks").alias("n_chunks"), F.posexplode("chunks").alias("seq", "digest"))
    place = F.struct("payload", "seq")
    shared = refs.groupBy("digest").agg(F.min(place).alias("owner"), F.count("*").alias("n")).where("n > 1").drop("n")
    borrowed = materialize(refs.join(shared, "digest").where(place != F.col("owner")).select("payload", "writer", "seq", "n_chunks", "digest"), "media-borrowed")
    # a row that doesn't write its payload skips all of it, a writer the chunks that another payload has
    others = plan.select("payload", "doc_id", "key").distinct().join(payloads.select("payload", "writer"), "payload").where(~(F.col("doc_id").eqNullSafe(F.col("writer.doc_id")) & (F.col("key") == F.col("writer.key"))))
    skips = borrowed.groupBy("writer").agg(F.collect_list("seq").alias("seqs")).select("writer.*", "seqs").unionByName(others.select("doc_id", "key", F.array().cast("array<int>").alias("seqs")))
    skips = materialize(skips, "media-skips")
    small = skips.count() <= broadcast_rows
    right = skips.withColumnsRenamed({"doc_id": "skip_id", "key": "skip_key"})
    keyed = _keyed(docs)
    joined = keyed.join(F.broadcast(right) if small else right, (F.col("key") == F.col("skip_key")) & F.col("doc_id").eqNullSafe(F.col("skip_id")), "left").select("text", "seqs")
    schema = arrow_schema("payload binary,seq int,n_chunks int,digest binary,record binary")

    def rows(batches):
        for b in slices(batches):
            for text, seqs in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if seqs == []:
                    continue
                _, p = payload_of(text)
                key, chunks, skip = hashlib.sha256(p).digest(), cut(p), set(seqs or ())
                for i, c in enumerate(chunks):
                    if i not in skip:
                        yield key, i, len(chunks), hashlib.sha256(c).digest(), record_of(c)

    stored = joined.mapInArrow(lambda batches: rows_to_batches(rows(batches), schema, 512), "payload binary, seq int, n_chunks int, digest binary, record binary")
    return materialize(stored, "media-chunks"), borrowed.drop("writer")


def read_back(stored: DataFrame, borrowed: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Features of every distinct payload, rebuilt from the chunk table."""
    ddl = _FEATURES.replace(",", ", ")
    schema = arrow_schema(_FEATURES)

    def single(it):
        for payload, record in it:
            yield features(payload, [record])

    whole = map_rows(stored.where("n_chunks = 1").select("payload", "record"), single, _FEATURES)
    small = borrowed.count() <= broadcast_rows
    lent = stored.select("digest", "record").join(F.broadcast(borrowed) if small else borrowed, "digest")
    parts = stored.where("n_chunks > 1").select("payload", "seq", "n_chunks", "record").unionByName(lent.select("payload", "seq", "n_chunks", "record"))

    def rebuild(t: pa.Table) -> pa.Table:
        by_place = dict(zip(t["seq"].to_pylist(), t["record"].to_pylist()))
        payload, n = t["payload"][0].as_py(), t["n_chunks"][0].as_py()
        records = [by_place[i] for i in range(n)]
        return pa.Table.from_batches(record_batches([features(payload, records)], schema), schema=schema)

    return whole.unionByName(parts.groupBy("payload").applyInArrow(rebuild, ddl))


def media_columns(docs: DataFrame) -> DataFrame:
    """Store all payloads as deduplicated chunks, rebuild them, and return their columns by document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    plan = materialize(manifest(docs), "media-manifest")
    stored, borrowed = store_chunks(docs, plan)
    # repeated rows of one id store the same place twice; a payload of one chunk may so be read twice
    back = read_back(stored, borrowed).groupBy("payload").agg(*[F.first(c).alias(c) for c in ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")])
    return plan.select("doc_id", "n_bytes", "payload").join(back, "payload").select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")
