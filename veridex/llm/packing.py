"""Concatenate and cut: token sequences of a fixed length with little padding.

The first pass tokenises each partition and notes every document's place among its partition's tokens; one row a
partition, its token total, gives by a prefix sum the partition's global offset.  The second pass adds the two and cuts
at multiples of the length: each piece is a boundary record (document, start, length, sequence, offset).  Only the last
sequence is not full.

A null or empty text is the end id alone.  Repeated rows are packed each.  An empty table has no pieces; other columns
are not read.
"""

from __future__ import annotations

import gc
import itertools
import json
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import words_of
from .common import arrow_schema, materialize, rows_to_batches, slices

LENGTH, END = 2048, 1
CACHE = 600_000
_PIECES = "doc_id long,start long,length long,ids_crc32 long,doc_tokens long,sequence_id long,offset long"
_TOKENIZERS: dict = {}
# white space after the first character, a lone white-space word, or text that may hold a special token
_INNER = re.compile(r".\s|^\s$|^[^\S \n]|<\|", re.S)


# Fixed value: the pattern by which byte-level tokenizers split text.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _ranked(spec: dict):
    """An equal encoder by ranks, where a tokenizer file is plain byte-level BPE whose ids rise with its merges; else None.

    It encodes new words several times faster.
    """
    pre, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
    plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not spec.get("normalizer")
    plain = plain and model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback"))
    if not plain:
        return None
    vocab = model["vocab"]
    merged = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "", 1)] for m in model["merges"]]
    if any(a >= b for a, b in zip(merged, merged[1:])):
        return None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if all(c in byte_of for c in t)}
    import tiktoken

    return tiktoken.Encoding("ranked", pat_str=BYTE_LEVEL, mergeable_ranks=_only(ranks, merged), special_tokens={})


def _only(ranks: dict[bytes, int], merged: list[int]) -> dict[bytes, int]:
    """Single bytes and merged pieces; special tokens are neither."""
    known = set(merged)
    return {t: i for t, i in ranks.items() if len(t) == 1 or i in known}


class Encoder:
    """Ids as little-endian numbers; words are encoded once while they are kept, in a young and an old generation.

    Words without inner white space are encoded many at a time, parted by line breaks: the pattern always cuts a line
    break between them off as a match of its own, so its id parts their ids.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.young, self.old = Tokenizer.from_file(path), {}, {}
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        parting = self.tokenizer.encode("\n", add_special_tokens=False).ids
        # a line break must be one id that no other word holds
        self.ranked = _ranked(json.loads(self.tokenizer.to_str()))
        self.parting = parting[0] if len(parting) == 1 and self.tokenizer.encode("a\nb", add_special_tokens=False).ids.count(parting[0]) == 1 else None

    def _new(self, words: list[str]) -> None:
        young, kind = self.young, self.kind
        plain = [w for w in words if not _INNER.search(w)] if self.parting is not None else []
        rest = [w for w in words if _INNER.search(w)] if plain else words
        for lo in range(0, len(plain), 4096):
            part = plain[lo : lo + 4096]
            text = "\n".join(w[1:] if w[0] == "\n" else w for w in part)
            ids = (self.ranked.encode_to_numpy(text, disallowed_special=()) if self.ranked else np.array(self.tokenizer.encode(text, add_special_tokens=False).ids)).astype(kind)
            ends = np.append(np.flatnonzero(ids == self.parting), len(ids)).tolist()
            if len(ends) != len(part):
                rest = rest + part
                continue
            raw, width, at, head = ids.tobytes(), kind.itemsize, 0, np.array([self.parting], kind).tobytes()
            for w, end in zip(part, ends):
                young[w] = head + raw[at * width : end * width] if w[0] == "\n" else raw[at * width : end * width]
                at = end + 1
        for w, e in zip(rest, self.tokenizer.encode_batch(rest, add_special_tokens=False)):
            young[w] = np.array(e.ids, kind).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.young) > CACHE:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        split = [words_of(t) for t in texts]
        new = []
        for w in set(itertools.chain.from_iterable(split)).difference(young):
            v = old.get(w)
            if v is None:
                new.append(w)
            else:
                young[w] = v
        self._new(new)
        return [b"".join(map(young.__getitem__, t)) for t in split]


def _encoder(path: str) -> Encoder:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = Encoder(path)
    return _TOKENIZERS[path]


def tokenise(docs: DataFrame, path: str, end: int = END) -> DataFrame:
    """(part, place, doc_id, n, width, ids): each document's ids with the end id, and its place in its partition."""
    schema = arrow_schema("part long,place long,doc_id long,n long,width int,ids binary")

    def run(batches):
        from pyspark import TaskContext

        coder, part, place = _encoder(path), TaskContext.get().partitionId(), 0
        width = coder.kind.itemsize
        stop = np.array([end], coder.kind).tobytes()

        def rows():
            nonlocal place
            gc.disable()  # millions of strings and no cycles: collections would find nothing
            try:
                for b in slices(batches, 1024):
                    for doc_id, data in zip(b.column(0).to_pylist(), coder.encode([t or "" for t in b.column(1).to_pylist()])):
                        n = len(data) // width + 1
                        yield part, place, doc_id, n, width, data + stop
                        place += n
            finally:
                gc.enable()

        return rows_to_batches(rows(), schema, 512)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "part long, place long, doc_id long, n long, width int, ids binary")


def pack(docs: DataFrame, path: str, length: int = LENGTH, end: int = END) -> DataFrame:
    """Pieces of all documents in sequences of ``length`` tokens."""
    tokens = materialize(tokenise(docs, path, end), "pack-tokens")
    # one row for each input partition, so its size is that of the job's own task list
    totals = sorted((r[0], r[1]) for r in tokens.groupBy("part").agg(F.max(F.col("place") + F.col("n"))).collect())
    parts = np.array([p for p, _ in totals], np.int64)
    bases = np.concatenate([[0], np.cumsum(np.array([n for _, n in totals], np.int64))])
    schema = arrow_schema(_PIECES)

    def run(batches):
        def rows():
            for b in batches:
                for part, place, doc_id, n, width, ids in zip(*(c.to_pylist() for c in b.columns)):
                    at = int(bases[np.searchsorted(parts, part)]) + place
                    wide = ids if width == 4 else np.frombuffer(ids, "<u2").astype("<u4").tobytes()
                    start = 0
                    while start < n:
                        sequence, offset = divmod(at + start, length)
                        size = min(n - start, length - offset)
                        yield doc_id, start, size, zlib.crc32(wide[4 * start : 4 * (start + size)]), n, sequence, offset
                        start += size

        return rows_to_batches(rows(), schema, 8192)

    return tokens.mapInArrow(run, _PIECES.replace(",", ", "))


def piece_ids(ids: bytes, width: int, start: int, length: int) -> np.ndarray:
    """The ids of one piece, from a document's stored ids."""
    return np.frombuffer(ids, f"<u{width}")[start : start + length]
