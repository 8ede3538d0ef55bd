"""Phrase collocations by hierarchical pair naming.

A phrase of k words is the pair of its first and its last k-1 words.  Level 1 names the frequent words; each further level
counts, over all documents, the adjacent pairs of names of the level below, and a pair that is frequent is named in turn.  The
two names that make a pair are its parent pointers: the frequencies of all its beginnings and endings (for the cuts), its words
and the phrases that it makes superfluous are read along them.

Texts are turned into blocks once: local word numbers in order, with a mark at each end of a piece.  A block is the unit that
counts its own pairs, so what is shuffled is one row for each distinct pair of a block: a pair has at most as many rows as there
are blocks, and one window over them totals and names it.  Only frequent pairs travel back to the blocks.  A name is the place of
the pair in the first block that holds it, so names are exact: nothing is hashed.

Defined cases: a null text is empty; a null language is ``und``; repeated rows are documents of their own and count each; a very
long text is read in parts that end at a piece's end (a piece is never cut); an empty table, or one without frequent pairs,
gives no rows; columns besides ``text`` and ``lang``, null or not and whatever their names, are not read; scores that tie go by
frequency, then by the phrase's UTF-8 bytes; cuts that tie go to the shortest first part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_schema, bounded, drop_written, materialize, record_batches, release_memory, slices

LEAST = 100
LONGEST = 5
TOP = 2000
#: Bytes of text of a block, about.
BLOCK_BYTES = 16 << 20
#: Texts are split in parts of about this size, to hold few words as objects.
PART_BYTES = 1 << 20
#: Bits of a name that count pairs within a block, and bits that count blocks within a task.
PLACE_BITS, TURN_BITS = 27, 13

# every end of a piece becomes a full stop, a tab a space, A-Z lower case
_FOLD = bytearray(range(256))
for _c in range(65, 91):
    _FOLD[_c] += 32
_FOLD[9] = 32
for _c in b".,;:!?\n\x0b\x0c\r":
    _FOLD[_c] = 46
_FOLD = bytes(_FOLD)


class _Numbers(dict):
    """Numbers words as they come; the end of a piece is -1."""

    def __missing__(self, word):
        n = self[word] = len(self) - 1
        return n


def _parts(text: bytes, size: int):
    """A folded text in parts of at least ``size`` bytes that end at a piece's end."""
    lo = 0
    while lo < len(text):
        hi = text.find(b".", lo + size)
        hi = len(text) if hi < 0 else hi + 1
        yield text[lo:hi]
        lo = hi


class _Open:
    """A block that is being filled."""

    def __init__(self):
        self.numbers, self.pieces, self.bytes = _Numbers({b".": -1}), [], 0

    def add(self, part: bytes) -> None:
        words = part.replace(b".", b" . ").split()
        words.append(b".")
        self.pieces.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.bytes += len(part)


def _squeeze(s: np.ndarray) -> bytes:
    """Runs of -1 say no more than one of them."""
    if len(s):
        s = s[np.concatenate([[True], (s[1:] >= 0) | (s[:-1] >= 0)])]
    short = s.max(initial=-1) < 1 << 15
    return (b"h" if short else b"i") + zstandard.compress(s.astype(np.int16 if short else np.int32).tobytes(), 5)


def _numbers(body: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(body[1:]), body[:1].decode()).astype(np.int32)


def _word_blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """(block, lang, seq, words, counts): a block has documents of one language."""
    schema = arrow_schema("block long,lang string,seq binary,words array<binary>,counts array<long>")

    def run(batches):
        first, turn, open_blocks, held = TaskContext.get().partitionId() << TURN_BITS, 0, {}, 0

        def close(lang):
            nonlocal turn, held
            b = open_blocks.pop(lang)
            held -= b.bytes
            s = np.concatenate(b.pieces)
            counts = np.bincount(s[s >= 0], minlength=len(b.numbers) - 1)
            words = list(b.numbers)[1:]
            row = (first + turn, lang, _squeeze(s), words, counts)
            turn += 1
            return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(row, schema)], schema=schema)

        for batch in slices(batches):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for part in _parts(text.translate(_FOLD), PART_BYTES):
                    b = open_blocks.setdefault(lang, None) or _Open()
                    open_blocks[lang] = b
                    b.add(part)
                    held += len(part)
                    if b.bytes >= block_bytes:
                        yield close(lang)
                    elif held >= 2 * block_bytes:
                        yield close(max(open_blocks, key=lambda k: open_blocks[k].bytes))
        for lang in list(open_blocks):
            yield close(lang)
        release_memory()

    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text")).where(F.length("text") > 0)
    return texts.mapInArrow(run, "block long, lang string, seq binary, words array<binary>, counts array<long>")


def _pairs(s: np.ndarray):
    """Adjacent names: places of the first, distinct pairs in order, each place's pair, counts."""
    at = np.flatnonzero((s[:-1] >= 0) & (s[1:] >= 0)) if len(s) > 1 else np.empty(0, np.int64)
    base = int(s.max()) + 1 if len(at) else 1
    keys = s[at].astype(np.int64) * base + s[at + 1]
    return at, base, keys


def _count_pairs(blocks: DataFrame) -> DataFrame:
    """(at, left, right, n): the distinct adjacent pairs of each block by their names; ``at`` is block and place."""
    schema = arrow_schema("at long,left long,right long,n int")

    def run(batches):
        for batch in slices(batches, 1):
            block, s = batch.column(0)[0].as_py(), _numbers(batch.column(1)[0].as_py())
            ids = batch.column(2)[0].values.to_numpy(zero_copy_only=False)
            _, base, keys = _pairs(s)
            found, n = np.unique(keys, return_counts=True)
            del keys, s
            for lo in range(0, len(found), 1 << 16):
                part = found[lo : lo + (1 << 16)]
                columns = ((block << PLACE_BITS) + np.arange(lo, lo + len(part)), ids[part // base], ids[part % base], n[lo : lo + len(part)])
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
        release_memory()

    return blocks.select("block", "seq", "ids").mapInArrow(run, "at long, left long, right long, n int")


def _named(rows: DataFrame, keys: list[str], least: int) -> DataFrame:
    """The rows (at, keys, n) whose key is frequent over all blocks, with its name and frequency."""
    w = Window.partitionBy(*keys)
    return rows.select("at", *keys, F.sum("n").over(w).alias("f"), F.min("at").over(w).alias("id")).where(F.col("f") >= least)


_STEP = arrow_schema("block long,seq binary,ids array<long>")


def _step(seqs: DataFrame, named: DataFrame, words: bool) -> DataFrame:
    """Blocks in names of the level above: ``seqs`` holds words or names, ``named`` the places of a block that are named."""

    def meet(left, right):
        if not len(left) or not len(right):
            return pa.Table.from_batches([], schema=_STEP)
        s = _numbers(left["seq"][0].as_py())
        place, ids = (right[c].to_numpy() for c in ("place", "id"))
        order = np.argsort(place)
        place, ids = place[order], ids[order]
        if words:
            number = np.full(max(int(s.max(initial=-1)), int(place[-1])) + 2, -1, np.int32)  # the last is that of -1
            number[place] = np.arange(len(place))
            out = number[s]
        else:
            at, _, keys = _pairs(s)
            found, each = np.unique(keys, return_inverse=True)
            number = np.full(len(found), -1, np.int32)
            number[place] = np.arange(len(place))
            out = np.full(len(s), -1, np.int32)
            out[at] = number[each]
        return pa.Table.from_batches(record_batches([(left["block"][0].as_py(), _squeeze(out), ids)], _STEP), schema=_STEP)

    places = named.select(F.shiftright("at", PLACE_BITS).alias("block"), (F.col("at") % (1 << PLACE_BITS)).alias("place"), "id")
    return seqs.select("block", "seq").groupBy("block").cogroup(places.groupBy("block")).applyInArrow(meet, "block long, seq binary, ids array<long>")


def _first(named: DataFrame) -> DataFrame:
    """One row for each name: that of the block it is named after."""
    return named.where("id = at")


def phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, block_bytes: int = BLOCK_BYTES) -> tuple[list[DataFrame], DataFrame]:
    """Frequent phrases by their number of words, and (lang, n) of all words.

    A level has id, lang, phrase, last, f, left, right (parent pointers) and the frequencies of its beginnings (``pre``, of 1, 2, ... words)
    and endings (``suf``).  The levels are written tables.
    """
    bounded(docs.sparkSession)
    seqs = materialize(_word_blocks(docs, block_bytes), "phrase-words")
    sizes = materialize(seqs.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n")), "phrase-sizes")
    rows = seqs.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts"))).select((F.shiftleft("block", PLACE_BITS) + F.col("pos")).alias("at"), "lang", F.col("col.words").cast("string").alias("word"), F.col("col.counts").alias("n"))
    named = materialize(_named(rows, ["lang", "word"], least), "phrase-names")
    none = F.array().cast("array<long>")
    level = materialize(_first(named).select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "f", F.lit(None).cast("long").alias("left"), F.lit(None).cast("long").alias("right"), none.alias("pre"), none.alias("suf")), "phrase-level")
    levels = [level]
    for k in range(2, longest + 1):
        below, seqs = seqs, materialize(_step(seqs, named, k == 2), "phrase-blocks")
        drop_written(below)
        drop_written(named)
        named = materialize(_named(_count_pairs(seqs), ["left", "right"], least), "phrase-names")
        a = levels[-1].select(F.col("id").alias("left"), "lang", F.col("phrase").alias("begin"), F.concat("pre", F.array("f")).alias("pre"))
        b = levels[-1].select(F.col("id").alias("right"), "last", F.concat("suf", F.array("f")).alias("suf"))
        level = _first(named).select("id", "f", "left", "right").join(a, "left").join(b, "right")
        levels.append(materialize(level.select("id", "lang", F.concat_ws(" ", "begin", "last").alias("phrase"), "last", "f", "left", "right", "pre", "suf"), "phrase-level"))
    return levels, sizes


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Each language's first ``top`` phrases of 2 to ``longest`` words: lang, rank, phrase, a, l, r, n, score."""
    levels, sizes = phrases(docs, least, longest, block_bytes)
    kept = None
    for k in range(2, longest + 1):
        level = levels[k - 1].select("id", "lang", "phrase", "f", "pre", "suf")
        if k < longest:  # a phrase lies in a longer one of its frequency if it is a parent of one a word longer of that frequency
            above = levels[k]
            longer = above.select(F.col("left").alias("id"), "f").union(above.select(F.col("right").alias("id"), "f"))
            level = level.join(longer, ["id", "f"], "left_anti")
        level = level.join(sizes, "lang")
        whole = lambda c: c.cast("decimal(17,0)")  # noqa: E731  the products are exact to 38 digits
        cuts = []
        for j in range(1, k):
            left, right = F.col("pre")[j - 1], F.col("suf")[k - j - 1]
            score = F.call_function("div", whole(F.col("f")) * whole(F.col("n")) * F.lit(1000), whole(left) * whole(right))
            cuts.append(F.struct(score.alias("score"), F.lit(j).alias("first"), left.alias("l"), right.alias("r")))
        level = level.select("id", "lang", "phrase", F.col("f").alias("a"), "n", F.array_min(F.array(*cuts)).alias("cut"))
        kept = level if kept is None else kept.union(level)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    ranked = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score", F.pmod(F.xxhash64("id"), F.lit(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))).alias("part"))
    # a language's candidates meet in parts, of which each sends its best: the last sort has a bounded number of rows a part
    some = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    out = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
