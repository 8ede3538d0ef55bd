"""Byte-level BPE encoding and decoding.

A text is cut into words before single spaces or line breaks between non-spaces, where the splitting pattern always has a
boundary, and the words into the pattern's matches.  Each task encodes the distinct matches of its texts by Spark
higher-order functions: a match is an array of its bytes' ids, and a fold merges the adjacent pair of least rank until
none is left.  The rank of a pair is read from a literal map of every pair of pieces that makes a piece, an array that is
probed at two places given by Spark's own 64-bit hash (a map's look-up is a linear search).  Decoding concatenates the
binary pieces of the ids.

One way for every size, without a shuffle: the words of a block of texts that the task has not seen go with numbers for
all words; behind the fold the documents are put together from these.  What a task remembers is bounded by ``KNOWN``
words, after which it begins anew; nothing grows with the corpus.

Null and empty texts have no ids: the digests are those of nothing.  A text of any length is read whole (one longer than
a block is a block).  Repeated rows give repeated result rows, and an empty table an empty result; other columns are not
read.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
import json
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, rows_to_batches
from .dictionary import blocks

OUT = "doc_id long,n_tokens long,ids_sha256 string,decoded_sha256 string"
BLOCK_BYTES = 2 << 20
#: Distinct words that a task remembers.
KNOWN = 300_000
#: Matches of more bytes merge every pair of a round's rank at once.
LONG = 256
ID_BITS = 21
NONE = 1 << ID_BITS
#: A byte's place in a match; larger places, of long matches, are not read.
PLACE_BITS = 12
PLACE_MASK = (1 << PLACE_BITS) - 1
# Fixed value: the pattern of byte-level tokenizers; letters with a space before them are one match of it, a mark is one.
_LETTER_RUNS = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""",)
_MARKS = frozenset(".,;:!?")
_TWO_SPACES = re.compile(r"\s\s")
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")


def words_of(text: str) -> list[str]:
    """Pieces of a text that the pattern splits alike alone and in the text."""
    if not text:
        return []
    if "\0" in text or _TWO_SPACES.search(text):
        return _CUT.split(text)
    return [w for w in text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0") if w]


@functools.lru_cache(4)
def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def pair_ranks(ranks: dict[bytes, int]) -> dict[int, int]:
    """Rank of the piece that two adjacent pieces make, by the pair's number."""
    out = {}
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            a, b = ranks.get(token[:i]), ranks.get(token[i:])
            if a is not None and b is not None:
                out[a << ID_BITS | b] = rank
    return out


def _places(key: int, bits: int) -> tuple[int, int]:
    h = xxhash.xxh64_intdigest(key.to_bytes(8, "little"), seed=42)  # what Spark's xxhash64 gives for a long
    return h & ((1 << bits) - 1), h >> bits & ((1 << bits) - 1)


def rank_map(pairs: dict[int, int]) -> tuple[list[int], int]:
    """The pairs in an array where each lies at one of its two places; the array's size in bits."""
    bits = max(4, (2 * len(pairs)).bit_length())
    while True:
        table, fits = [-1] * (1 << bits), True
        for key, rank in pairs.items():
            entry, at = key << ID_BITS | rank, _places(key, bits)[0]
            for _ in range(500):
                entry, table[at] = table[at], entry
                if entry < 0:
                    break
                at = sum(_places(entry >> ID_BITS, bits)) - at  # the other place of what lay here
            else:
                fits = False
                break
        if fits:
            return table, bits
        bits += 1


def _numbers(values: list[int]) -> Column:
    return F.from_json(F.lit(json.dumps(values, separators=(",", ":"))), "array<bigint>")


def _with(value: Column, body) -> Column:
    """``body(value)`` with the value bound once."""
    return F.transform(F.array(value), body)[0]


class Coder:
    """Columns that encode and decode.  The tables are one literal, bound once for a whole array of words (``each``): the driver
    writes plans out as text and keeps them, and a task has its own copy of every literal.

    A part of a word is one number: the rank of what it makes with the next part, its first byte's place, its own id.  The
    least of the numbers is the leftmost pair of least rank.
    """

    def __init__(self, ranks: dict[bytes, int]):
        if max(ranks.values()) >= NONE:
            raise ValueError("ids need more bits")
        pairs = pair_ranks(ranks)
        table, self.bits = rank_map(pairs)
        singles = [ranks[bytes([b])] for b in range(256)]
        # rank of two bytes, by the bytes
        doubles = [pairs.get(ranks[bytes([a])] << ID_BITS | ranks[bytes([b])], NONE) for a in range(256) for b in range(256)]
        pieces = [""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            pieces[rank] = token.hex()
        self.tables = F.struct(_numbers(table).alias("table"), _numbers(singles).alias("singles"), _numbers(doubles).alias("doubles"), F.split(F.lit(",".join(pieces)), ",").alias("pieces"))

    def each(self, words: Column, body) -> Column:
        """``body`` of every word, for which the tables are bound once."""

        def bound(tables: Column) -> Column:
            self.table, self.singles, self.doubles, self.pieces = (tables[name] for name in ("table", "singles", "doubles", "pieces"))
            return F.transform(words, body)

        return _with(self.tables, bound)

    def rank(self, a: Column, b: Column) -> Column:
        """Rank of what two pieces make, NONE if that is no piece or one is missing."""
        last = F.lit((1 << self.bits) - 1)
        key = F.shiftleft(a, ID_BITS).bitwiseOR(b)
        spread = F.xxhash64(key)

        def probe(place: Column, other: Column) -> Column:
            hit = lambda entry: F.when(F.shiftright(entry, ID_BITS) == key, entry.bitwiseAND(F.lit(NONE - 1))).otherwise(other)
            return _with(F.get(self.table, place.cast("int")), hit)

        return probe(spread.bitwiseAND(last), probe(F.shiftrightunsigned(spread, self.bits).bitwiseAND(last), F.lit(NONE).cast("long")))

    def _part(self, rank: Column, place: Column, own: Column) -> Column:
        return F.shiftleft(rank, PLACE_BITS + ID_BITS).bitwiseOR(F.shiftleft(place, ID_BITS)).bitwiseOR(own)

    def _ranked(self, parts: Column) -> Column:
        """The parts, each with the rank of the pair it makes with the next."""
        return F.transform(parts, lambda x, i: self._part(self.rank(_id(x), _id(F.get(parts, i + 1))), i.cast("long"), _id(x)))

    def _merge_one(self, parts: Column) -> Column:
        """The leftmost pair of least rank becomes one part; only its neighbours' ranks change.  Null when done."""

        def merged(m: Column) -> Column:
            least = F.shiftright(m, PLACE_BITS + ID_BITS)

            def changed(x: Column, i: Column) -> Column:
                here = self._part(self.rank(least, _id(F.get(parts, i + 2))), _place(x), least)
                before = self._part(self.rank(_id(x), least), _place(x), _id(x))
                return F.when(x == m, here).when(F.get(parts, i + 1) == m, before).when(F.get(parts, i - 1) == m, F.lit(-1)).otherwise(x)

            return F.array_remove(F.transform(parts, changed), -1)

        return _with(F.array_min(parts), lambda m: F.when(m < NONE << PLACE_BITS + ID_BITS, merged(m)))

    def _merge_all(self, parts: Column) -> Column:
        """Every pair of least rank becomes one part, from the left, without overlaps.  Null when done."""
        rank = lambda x: F.shiftright(x, PLACE_BITS + ID_BITS)

        def merged(least: Column) -> Column:
            flags = F.array_join(F.transform(parts, lambda x: F.when(rank(x) == least, "1").otherwise("0")), "")
            marks = F.split(F.regexp_replace(flags, "1.", "X-"), "")  # X: a pair begins, -: its second part
            new = F.zip_with(parts, marks, lambda x, c: F.when(c == "X", least).when(c == "-", F.lit(-1)).otherwise(_id(x)))
            return _with(F.array_remove(new, -1), self._ranked)

        return _with(rank(F.array_min(parts)), lambda least: F.when(least < NONE, merged(least)))

    def encode(self, word: Column) -> Column:
        """Ids of one match of the pattern, given as binary that is not empty."""
        letters = F.transform(F.split(F.decode(word, "ISO-8859-1"), ""), F.ascii)  # the bytes
        # the next of the last byte is null, and so is the pair's rank
        first = lambda b: F.transform(b, lambda x, i: self._part(F.coalesce(F.get(self.doubles, x * 256 + F.get(b, i + 1)), F.lit(NONE).cast("long")), i.cast("long"), F.get(self.singles, x)))
        rounds = F.sequence(F.lit(1), F.greatest(F.octet_length(word) - 1, F.lit(1)))

        def by(start: Column, merge) -> Column:
            """The fold; a round that finds nothing to merge leaves null behind it, and the ids."""
            step = lambda acc, _: F.when(acc["more"], _with(merge(acc["p"]), lambda n: F.struct(F.coalesce(n, acc["p"]).alias("p"), n.isNotNull().alias("more")))).otherwise(acc)
            return F.aggregate(rounds, F.struct(start.alias("p"), F.lit(True).alias("more")), step, lambda acc: F.transform(acc["p"], _id))

        short = _with(letters, lambda b: by(first(b), self._merge_one))
        long = _with(F.transform(letters, lambda x: F.get(self.singles, x)), lambda p: by(self._ranked(p), self._merge_all))
        return F.when(F.octet_length(word) <= LONG, short).otherwise(long)

    def decode(self, ids: Column) -> Column:
        """Bytes of the ids: their pieces joined."""
        return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(self.pieces, i.cast("int"))), ""))


def _id(part: Column) -> Column:
    return part.bitwiseAND(F.lit(NONE - 1))


def _place(part: Column) -> Column:
    return F.shiftright(part, ID_BITS).bitwiseAND(F.lit(PLACE_MASK))


def encode_words(words: Column, ranks: dict[bytes, int]) -> Column:
    """(ids joined by commas, decoded bytes) of each of an array of matches."""
    coder = Coder(ranks)
    return coder.each(words, lambda w: _with(coder.encode(w), lambda ids: F.struct(F.array_join(ids, ",").alias("ids"), coder.decode(ids).alias("data"))))


@functools.lru_cache(4)
def _compiled(pattern: str):
    import regex

    return regex.compile(pattern)


def _splitter(pattern: str):
    """The pattern's matches of one word; plain words need no pattern."""
    found = _compiled(pattern).findall
    if pattern not in _LETTER_RUNS:
        return found

    def split(w: str) -> list[str]:
        head, body = w[0], w[1:]
        if head == " ":
            if body.isalpha():
                return [w]
            if body[-1:] in _MARKS and body[:-1].isalpha():
                return [w[:-1], body[-1]]
        elif head == "\n" and body.isalpha():
            return ["\n", body]
        return found(w)

    return split


class _Numbers(dict):
    """Numbers of keys in order of their first use."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


_BLOCK = "anew boolean,doc_ids array<long>,counts binary,codes binary,matches array<binary>,sizes binary,members binary"


def numbered(pairs, pattern: str, block_bytes: int = BLOCK_BYTES, known: int = KNOWN):
    """For each block of (doc_id, text): numbers of its texts' words, and the words and matches that are new."""
    split, words, matches, anew = _splitter(pattern), _Numbers(), _Numbers(), True
    for rows in blocks(pairs, block_bytes):
        if len(words) > known:
            words, matches, anew = _Numbers(), _Numbers(), True
        before, known_matches = len(words), len(matches)
        codes, counts = [], []
        for _, text in rows:
            w = words_of(text)
            counts.append(len(w))
            codes += map(words.__getitem__, w)
        found = [split(w) for w in itertools.islice(words, before, None)]
        members = [matches[m] for ms in found for m in ms]
        as_bytes = lambda x: np.array(x, np.int32).tobytes()
        new = [m.encode("utf-8", "surrogatepass") for m in itertools.islice(matches, known_matches, None)]
        yield anew, [r[0] for r in rows], as_bytes(counts), as_bytes(codes), new, as_bytes([len(x) for x in found]), as_bytes(members)
        anew = False


def assembled(rows):
    """Result rows of blocks whose ``matches`` are (ids, data)."""
    match_ids, match_data, ids, data, n = [], [], [], [], []
    for anew, doc_ids, counts, codes, matches, sizes, members in rows:
        if anew:
            match_ids, match_data, ids, data, n = [], [], [], [], []
        match_ids += (m["ids"].encode() for m in matches)
        match_data += (m["data"] for m in matches)
        members, at = np.frombuffer(members, np.int32).tolist(), 0
        for size in np.frombuffer(sizes, np.int32).tolist():
            own = members[at : at + size]
            at += size
            ids.append(b",".join(map(match_ids.__getitem__, own)) if size > 1 else match_ids[own[0]])
            data.append(b"".join(map(match_data.__getitem__, own)) if size > 1 else match_data[own[0]])
            n.append(ids[-1].count(b",") + 1)
        codes, at = np.frombuffer(codes, np.int32).tolist(), 0
        for doc_id, count in zip(doc_ids, np.frombuffer(counts, np.int32).tolist()):
            own = codes[at : at + count]
            at += count
            yield doc_id, sum(map(n.__getitem__, own)), hashlib.sha256(b",".join(map(ids.__getitem__, own))).hexdigest(), hashlib.sha256(b"".join(map(data.__getitem__, own))).hexdigest()


def _tuples(batches):
    return (row for b in batches for i in range(b.num_rows) for row in zip(*(c.to_pylist() for c in b.slice(i, 1).columns)))


def encode_documents(docs: DataFrame, rank_path: str, pattern: str, block_bytes: int = BLOCK_BYTES, known: int = KNOWN) -> DataFrame:
    """n_tokens and digests of the ids and of the decoded bytes, for every document."""
    block, out = arrow_schema(_BLOCK), arrow_schema(OUT)

    def first(batches):
        pairs = (row for b in batches for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        return rows_to_batches(numbered(pairs, pattern, block_bytes, known), block, 1)

    def last(batches):
        return rows_to_batches(assembled(_tuples(batches)), out)

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(first, _BLOCK.replace(",", ", "))
    coded = found.withColumn("matches", encode_words(F.col("matches"), ranks_of(rank_path)))
    return coded.mapInArrow(last, OUT.replace(",", ", "))
