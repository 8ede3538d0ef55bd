"""Quality rules by cross-document line frequency.

Lines are normalised (A-Z lower-cased, white space squeezed) and hashed; the distinct documents of each host (`source`)
that hold a line are counted, where documents of equal text count once.  A line is above the limit when more than
``min_docs`` documents and more than ``max_share`` of the host's documents hold it.  Such lines are removed, and a
document that keeps less than ``min_kept`` of its words is depleted and rejected.

A first pass sends (host, line, text) hashes to be counted; a host has fewer than 1 / ``max_share`` times its mean number
of lines a document above the limits, so they form one short list, and the second pass reads each document with the list
of its host.  No text is shuffled where the lists are small enough for Spark to broadcast them.

Null and empty texts have no words: they fail the base rule.  A null host is a host of its own (the empty name).  Texts of
any length are read whole.  Repeated rows give repeated result rows.  An empty table gives an empty result; other columns
are not read by the rules and pass through the filter unchanged, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, arrow_schema, materialize, rows_to_batches, slices, utf8

_WORD = re.compile(WORD)
SYMBOLS = "#*$%&|<>"
MIN_DOCS, MAX_SHARE, MIN_KEPT = 20, 0.10, 0.30
_FEATURES = "doc_id long,n_words long,word_chars long,n_symbols long,n_dup_lines long,n_repeat_words long,n_removed_words long"


def base_features(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    words = _WORD.findall(text)
    n = len(words)
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line in seen:
            dup += 1
        elif line and not line.isspace() or _WORD.search(line):
            seen.add(line)
    return n, sum(map(len, words)), sum(map(text.count, SYMBOLS)), dup, _repeated(words)


def _repeated(words: list[str], width: int = 8) -> int:
    """Words inside windows of ``width`` words that occur twice or more in the text."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    windows = list(zip(*(words[i : n + i] for i in range(width))))
    if len(set(windows)) == n:
        return 0
    counts, total, end = Counter(windows), 0, 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            total += i + width - max(i, end)
            end = i + width
    return total


def normalise(line: str) -> bytes:
    return b" ".join(utf8(line).split()).lower()


def line_hash(line: str) -> int | None:
    """64-bit hash of a normalised line; None for a line without a word."""
    line = normalise(line)
    return xxhash.xxh3_64_intdigest(line) - (1 << 63) if line else None


def line_counts_of(text: str) -> dict[int, int]:
    """Words on each distinct line, by the line's hash."""
    lines: dict[int, int] = {}
    for line in text.split("\n"):
        parts = utf8(line).split()
        if parts:
            h = xxhash.xxh3_64_intdigest(b" ".join(parts).lower()) - (1 << 63)
            lines[h] = lines.get(h, 0) + len(parts)
    return lines


def _host():
    return F.xxhash64(F.coalesce(F.col("source"), F.lit("")))


_TRIPLES = pa.schema([("host", pa.int64()), ("line", pa.int64()), ("text", pa.int64())])


def _triples(batches):
    """(host, line, text) hashes of each text's distinct lines, and (host, null, text) of each text."""
    for part in slices(batches, 512):
        hosts, lines, texts = [], [], []
        for host, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            own = [None, *line_counts_of(text or "")]
            lines += own
            hosts += [host] * len(own)
            texts += [xxhash.xxh3_64_intdigest(utf8(text)) - (1 << 63)] * len(own)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (hosts, lines, texts)], schema=_TRIPLES)


def flagged_lines(docs: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """(host, flagged): the hashes of the lines above the limits of each host that has any, over all documents."""
    triples = docs.select(_host().alias("host"), "text").mapInArrow(_triples, "host long, line long, text long")
    counts = triples.distinct().groupBy("host", "line").agg(F.count("*").alias("n"))
    counts = materialize(counts.where(F.col("line").isNull() | (F.col("n") > min_docs)), "quality-counts")
    hosts = counts.where("line is null").select("host", F.col("n").alias("host_docs"))
    over = counts.where("line is not null").join(hosts, "host").where(F.col("n") > F.lit(max_share) * F.col("host_docs"))
    return materialize(over.groupBy("host").agg(F.collect_list("line").alias("flagged")), "quality-flagged")


def _lost(text: str, flagged: set) -> int:
    return sum(n for line, n in line_counts_of(text).items() if line in flagged) if flagged else 0


def _sets():
    """The flagged lines of a row as a set; rows of a host have the same list."""
    kept: dict[tuple, frozenset] = {}

    def of(flagged) -> frozenset:
        if not flagged:
            return frozenset()
        key = tuple(flagged)
        if key not in kept:
            if len(kept) > 1000:
                kept.clear()
            kept[key] = frozenset(key)
        return kept[key]

    return of


def _features(batches):
    of = _sets()
    for part in slices(batches, 512):
        for doc_id, text, flagged in zip(*(c.to_pylist() for c in part.columns)):
            yield doc_id, *base_features(text or ""), _lost(text or "", of(flagged))


def _fails(n: int, repeated: int) -> bool:
    return n < 20 or 100 * repeated > 30 * n


def quality_rules(docs: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, min_kept: float = MIN_KEPT) -> DataFrame:
    """Base features and verdict of every document."""
    schema = arrow_schema(_FEATURES)
    rows = docs.select(_host().alias("host"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.join(flagged_lines(docs, min_docs, max_share), "host", "left").select("doc_id", "text", "flagged")
    stats = rows.mapInArrow(lambda batches: rows_to_batches(_features(batches), schema), _FEATURES.replace(",", ", "))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    depleted = (F.col("n_words") - F.col("n_removed_words")) < F.lit(min_kept) * F.col("n_words")
    return stats.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), "n_removed_words")


def filter_documents(docs: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, min_kept: float = MIN_KEPT) -> DataFrame:
    """The documents that pass, without their lines above the limits; columns as given, ``n_chars`` kept in step."""
    columns = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("d"), _host().alias("host"))
    rows = rows.join(flagged_lines(docs, min_docs, max_share), "host", "left").select("d", "flagged")

    def run(batches):
        of = _sets()
        for part in slices(batches, 512):
            d, stay, texts = part.column(0), [], []
            for text, flagged in zip(d.field(columns.index("text")).to_pylist(), part.column(1).to_pylist()):
                n, _, _, _, repeated = base_features(text or "")
                gone = of(flagged)
                lost = _lost(text or "", gone)
                stay.append(not _fails(n, repeated) and not n - lost < min_kept * n)
                texts.append("\n".join(x for x in text.split("\n") if line_hash(x) not in gone) if lost else text)
            put = {"text": texts, "n_chars": [None if t is None else len(t) for t in texts]}
            arrays = [pa.array(put[c], d.type.field(i).type) if c in put else d.field(i) for i, c in enumerate(columns)]
            yield pa.RecordBatch.from_arrays(arrays, names=columns).filter(pa.array(np.array(stay, bool)))

    return rows.mapInArrow(run, docs.schema)
