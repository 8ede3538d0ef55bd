"""Language-model scores by prediction by partial matching (PPM) over bytes.

The model is a byte-context trie of order ``ORDER`` learnt from the training fold: for every context of 0 to ORDER bytes
the counts of the bytes that followed it.  A byte is coded in the longest context that saw it; from a longer known context
one escapes with method D (each distinct follower gives half a count to the escape), and followers of the longer context are excluded from
the shorter one (symbol exclusion).  Below order 0 all bytes not excluded are equally likely.  Texts are A-Z lower-cased;
byte 0xFF, which UTF-8 never holds, stands before a text ORDER times and after it once, so lengths are modelled too.

The trie is a table: counts of (context, byte) of the top order, aggregated in Spark, give all shorter contexts by sums.
Escapes and exclusions are joins of its levels, so the code length of each distinct top-order gram of the corpus is found
once, and a document's score is the sum over its grams.

A null text counts as empty and still has its end.  Repeated rows each count and score.  An empty table gives no rows;
without training rows every byte costs log10(256).
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_fold, materialize, utf8
from .dictionary import MAX_TABLE_BYTES, blocks, resolve

ORDER = 5
PAD = b"\xff"
#: Arrays of several numbers a byte are held for a block of texts.
BLOCK_BYTES = 3 << 20
MODULUS, HELD_OUT = 7, 2
OUT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def held_out(doc_id) -> bool:
    return crc_fold(doc_id, MODULUS) == HELD_OUT


def _grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Grams of ORDER + 1 bytes that end at each byte of each padded text and at its end mark; grams per text."""
    raw = np.frombuffer(b"".join(PAD * ORDER + t + PAD for t in texts), np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    n = len(raw) - ORDER
    g = np.zeros(n, np.int64)
    for j in range(ORDER + 1):
        g = (g << 8) | raw[j : j + n]
    starts = np.cumsum(sizes + ORDER) - (sizes + ORDER)
    keep = np.ones(n, bool)
    for j in range(ORDER):  # windows that reach over a text's end into the next one's padding
        at = starts[1:] - 1 - j
        keep[at[at >= 0]] = False
    return g[keep], sizes


def word_key(word: bytes) -> int:
    """Key of a word: negative, where gram keys are not."""
    return -1 - (xxhash.xxh3_64_intdigest(word) >> 1)


def _tokens(text: bytes) -> list[bytes]:
    return text.split()


def _prepare(rows):
    return [utf8(r[1]).lower() for r in rows]


def _count(rows):
    """(key, count in training rows) of a block; 0 where only held-out rows have the key."""
    texts = _prepare(rows)
    train = [t for r, t in zip(rows, texts) if not held_out(r[0])]
    rest = [t for r, t in zip(rows, texts) if held_out(r[0])]
    keys, counts = np.unique(_grams(train)[0], return_counts=True) if train else (np.empty(0, np.int64),) * 2
    more = np.setdiff1d(_grams(rest)[0], keys) if rest else np.empty(0, np.int64)
    words = Counter(w for t in train for w in t.split())
    extra = {w for t in rest for w in t.split()} - words.keys()
    wk = [word_key(w) for w in words]
    return np.concatenate([keys, more, np.array(wk, np.int64), np.array([word_key(w) for w in extra], np.int64)]), np.concatenate([counts, np.zeros(len(more), np.int64), np.array(list(words.values()), np.int64), np.zeros(len(extra), np.int64)])


def corpus_counts(docs: DataFrame) -> DataFrame:
    """(key, n) over all documents: grams (key >= 0) and words (key < 0) with their counts in the training fold."""
    schema = pa.schema([("key", pa.int64()), ("n", pa.int64())])

    def run(batches):
        pairs = (row for b in batches for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        for rows in blocks(pairs, 2 * BLOCK_BYTES):
            k, n = _count(rows)
            for i in range(0, len(k), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(k[i : i + (1 << 16)]), pa.array(n[i : i + (1 << 16)].astype(np.int64))], schema=schema)

    return docs.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def code_lengths(grams: DataFrame) -> DataFrame:
    """(key, lp): log10 probability of the last byte of each gram after the others; ``grams`` has (key, n), n may be 0."""
    mask = lambda level: F.lit((1 << (8 * (level + 1))) - 1)
    ctx = lambda c: F.shiftright(c, 8)
    counts = {ORDER: grams.where("n > 0").select("key", F.col("n").alias("c"))}
    for level in range(ORDER - 1, -1, -1):
        below = counts[level + 1].groupBy(F.col("key").bitwiseAND(mask(level)).alias("key")).agg(F.sum("c").alias("c"))
        counts[level] = materialize(below, f"ppm-{level}")
    nodes, masked = {}, {}
    # the levels grow with the corpus, and their files are far smaller than their rows: none is sent whole to every executor
    table = lambda df, level: df.hint("merge") if level > 1 else df
    for level in range(ORDER + 1):
        # what is left of the next shorter context once this one's followers are excluded
        if level:
            shorter = counts[level - 1].withColumnRenamed("key", "s").withColumnRenamed("c", "sc")
            own = counts[level].withColumn("s", F.col("key").bitwiseAND(mask(level - 1))).join(table(shorter, level - 1), "s")
            masked[level] = own.groupBy(ctx(F.col("key")).alias("x")).agg(F.sum("c").alias("t"), F.count("*").alias("d"), F.sum("sc").alias("gone"))
        else:
            masked[level] = counts[0].groupBy(F.lit(0).cast("long").alias("x")).agg(F.sum("c").alias("t"), F.count("*").alias("d"), F.count("*").alias("gone"))
        nodes[level] = materialize(masked[level], f"ppm-node-{level}")
    # the top order answers most grams
    top = grams.select("key", F.when(F.col("n") > 0, F.col("n")).alias("c"), ctx(F.col("key")).alias("x")).join(table(nodes[ORDER], ORDER), "x", "left")
    top = top.withColumn("lp", F.log10((F.col("c") - 0.5) / F.col("t")))
    top = materialize(top, "ppm-top")
    found = top.where("c is not null").select("key", "lp")
    # acc: log10 of the escapes so far; gone/gone_d: weight and number of the excluded followers, null if no longer context is known
    rest = top.where("c is null").select("key", F.coalesce(F.log10(0.5 * F.col("d") / F.col("t")), F.lit(0.0)).alias("acc"), F.coalesce("gone", F.lit(0)).alias("gone"), F.coalesce("d", F.lit(0)).alias("gone_d"))
    parts = [found]
    for level in range(ORDER - 1, -1, -1):
        symbol = F.col("key").bitwiseAND(mask(level))
        r = rest.withColumn("k", symbol).withColumn("x", ctx(symbol))
        r = r.join(table(counts[level].withColumnRenamed("key", "k"), level), "k", "left").join(table(nodes[level].withColumnRenamed("gone", "gone_next"), level), "x", "left")
        left_t, left_d = F.coalesce("t", F.lit(0)) - F.col("gone"), F.coalesce("d", F.lit(0)) - F.col("gone_d")
        r = materialize(r.withColumn("w", left_t).withColumn("left_d", left_d), f"ppm-rest-{level}")
        parts.append(r.where("c is not null").select("key", (F.col("acc") + F.log10((F.col("c") - 0.5) / F.col("w"))).alias("lp")))
        escape = F.when(F.col("left_d") > 0, F.log10(0.5 * F.col("left_d") / F.col("w"))).otherwise(0.0)
        rest = r.where("c is null").select("key", (F.col("acc") + escape).alias("acc"), F.coalesce("gone_next", F.lit(0)).alias("gone"), F.coalesce("d", F.lit(0)).alias("gone_d"))
    parts.append(rest.select("key", (F.col("acc") - F.log10(F.lit(256.0) - F.col("gone_d"))).alias("lp")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def ppm_scores(docs: DataFrame, max_table_bytes: int = MAX_TABLE_BYTES) -> DataFrame:
    """Score every document by the trie and by the smoothed unigram base; learns from the training fold of all documents."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = materialize(corpus_counts(docs), "ppm-counts")
    ends = docs.agg(F.coalesce(F.sum(F.when(F.expr(f"crc32(cast(coalesce(cast(doc_id as string), '') as binary)) % {MODULUS} <> {HELD_OUT}"), 1).otherwise(0)), F.lit(0))).first()[0]
    words = counts.where("key < 0").agg(F.sum("n"), F.sum(F.when(F.col("n") > 0, 1).otherwise(0))).first()
    n_train, vocabulary = (words[0] or 0) + ends, (words[1] or 0) + (ends > 0)
    lp = code_lengths(counts.where("key >= 0"))
    table = lp.select("key", F.col("lp").alias("v")).unionByName(counts.where("key < 0").select("key", F.col("n").cast("double").alias("v")))
    return resolve(docs, _packed(table.repartitionByRange("key").sortWithinPartitions("key")), _keys, _finisher(n_train, vocabulary, ends), OUT, max_table_bytes, BLOCK_BYTES)


def _packed(table: DataFrame) -> DataFrame:
    """Doubles as 8 bytes, little-endian."""
    schema = pa.schema([("key", pa.int64()), ("value", pa.binary())])

    def run(batches):
        for b in batches:
            v = np.ascontiguousarray(b.column(1).to_numpy(zero_copy_only=False), "<f8")
            data = pa.Array.from_buffers(pa.binary(), len(v), [None, pa.py_buffer(np.arange(0, 8 * len(v) + 1, 8, dtype=np.int32)), pa.py_buffer(v.tobytes())])
            yield pa.RecordBatch.from_arrays([b.column(0), data], schema=schema)

    return table.mapInArrow(run, "key long, value binary")


def _keys(rows):
    texts = _prepare(rows)
    return np.concatenate([np.unique(_grams(texts)[0]), np.array([word_key(w) for w in {w for t in texts for w in t.split()}], np.int64)])


def _finisher(n_train: int, vocabulary: int, ends: int):
    norm = np.log10(n_train + 1.0 * (vocabulary + 1))

    def finish(rows, lookup):
        texts = _prepare(rows)
        grams, sizes = _grams(texts)
        distinct, inverse = np.unique(grams, return_inverse=True)
        lp = lookup.numbers(lookup.find(distinct), "<f8", -np.log10(256.0))[inverse]
        scores = np.add.reduceat(lp, np.cumsum(sizes) - sizes)
        ids: dict[bytes, int] = {}
        flat, lengths = [], []
        for t in texts:
            words = t.split()
            lengths.append(len(words))
            flat += [ids.setdefault(w, len(ids)) for w in words]
        vocab = np.fromiter((word_key(w) for w in ids), np.int64, len(ids))
        c = lookup.numbers(lookup.find(vocab), "<f8", 0.0) if len(vocab) else np.empty(0)
        base, known = np.log10(c + 1) - norm, c > 0
        flat, lengths = np.array(flat, np.int64), np.array(lengths, np.int64)
        ends_at = np.cumsum(lengths)
        known_of = np.concatenate([[0], np.cumsum(known[flat])])
        end_base = float(np.log10(ends + 1) - norm)
        for i, (doc_id, _) in enumerate(rows):
            lo, hi = ends_at[i] - lengths[i], ends_at[i]
            # summed per document, so that a block's length does not cost digits
            b = float(base[flat[lo:hi]].sum()) if hi > lo else 0.0
            yield doc_id, held_out(doc_id), int(lengths[i]) + 1, int(known_of[hi] - known_of[lo]) + (ends > 0), n_train, b + end_base, float(scores[i])

    return finish
