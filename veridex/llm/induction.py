"""External induced sorting of suffixes with their common prefixes, for shards of any size in bounded memory.

Sampled suffixes (those at anchors) are sorted first; the suffixes that start one byte earlier are induced from their
order, then those two bytes earlier, and so on: level d + 1 orders its suffixes by the tuple (byte before, rank at level
d).  Their common prefix with the suffix before them is one byte more than the least common prefix that level d has
between the two, kept as a running minimum for each of the 256 bytes while level d is read in order.  Tuples, ranks and
common prefixes go from level to level through disk-backed priority queues, which hold ``memory`` tuples at most and
spill sorted runs beyond that.  Spill files are nameless, live in Spark's own spill folder and end with the task.

A tuple of a suffix is carried as far to the left as its strings reach.  Where neighbours share ``size`` bytes or more,
their strings are equal: all but the first in order of place are reported, as ranges over consecutive levels.  A tuple
that no neighbour can equal any more is dropped.  Suffixes are padded with zero bytes: a string lies within its context,
so padding is never what makes two strings equal.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

MEMORY = 1 << 17
BATCH = 1 << 14


def spill_folder() -> str | None:
    """Where Spark itself spills; the usual temporary folder where it says nothing."""
    for d in os.environ.get("SPARK_LOCAL_DIRS", "").split(","):
        if d and os.path.isdir(d) and os.access(d, os.W_OK):
            return d
    return None


class DiskQueue:
    """Records in order of their field ``key``; all are pushed before the first is popped.  Equal keys keep no order."""

    def __init__(self, dtype: np.dtype, memory: int = MEMORY):
        self.dtype, self.memory, self.held, self.rows, self.runs = dtype, memory, [], 0, []

    def push(self, records: np.ndarray) -> None:
        if not len(records):
            return
        self.held.append(records)
        self.rows += len(records)
        if self.rows >= self.memory:
            self._spill()

    def _sorted(self) -> np.ndarray:
        held = np.concatenate(self.held) if self.held else np.empty(0, self.dtype)
        self.held, self.rows = [], 0
        return held[np.argsort(held["key"], kind="stable")]

    def _spill(self) -> None:
        run = tempfile.TemporaryFile(dir=spill_folder())
        self._sorted().tofile(run)
        run.seek(0)
        self.runs.append(run)

    def batches(self, size: int = BATCH):
        """Sorted batches; the queue is empty afterwards."""
        if not self.runs:
            held = self._sorted()
            for lo in range(0, len(held), size):
                yield held[lo : lo + size]
            return
        if self.rows:
            self._spill()
        share = max(1, size // len(self.runs))
        read = lambda run: np.fromfile(run, self.dtype, share)
        heads = [read(run) for run in self.runs]
        while any(map(len, heads)):
            # what is not above the least of the blocks' last keys cannot be preceded by anything still on disk
            bound = min(h["key"][-1] for h in heads if len(h))
            taken = []
            for i, h in enumerate(heads):
                n = int(np.searchsorted(h["key"], bound, side="right"))
                taken.append(h[:n])
                heads[i] = h[n:] if n < len(h) else read(self.runs[i])
            merged = np.concatenate(taken)
            yield merged[np.argsort(merged["key"], kind="stable")]
        for run in self.runs:
            run.close()
        self.runs = []


class _Minima:
    """For each byte, the least common prefix since the byte was last met before a suffix that stays.

    A suffix that is dropped is no predecessor at the next level: what it has in common only counts as a minimum on the way.
    """

    def __init__(self):
        self.since = np.full(256, -1, np.int64)

    def induce(self, before: np.ndarray, common: np.ndarray, stay: np.ndarray) -> np.ndarray:
        """Common prefix of each suffix that stays, one byte longer to the left, with the one before it that stays and has the same byte."""
        out = np.zeros(len(before), np.int64)
        lowest, since = common.min(), self.since
        met = np.unique(before[stay])
        kept = np.minimum(since, lowest)
        for v in met.tolist():
            at = np.flatnonzero((before == v) & stay)
            mins = np.minimum.reduceat(common, np.concatenate([[0], at + 1])) if at[-1] + 1 < len(common) else np.minimum.reduceat(common, np.concatenate([[0], at[:-1] + 1]))
            mins[0] = min(mins[0], since[v])
            out[at] = mins[: len(at)] + 1
            kept[v] = mins[len(at)] if len(mins) > len(at) else 255
        self.since = kept
        return out


def _dtype(key: str, span: int) -> np.dtype:
    return np.dtype([("key", key), ("common", "u1"), ("left", "u1"), ("least", "u1"), ("since", "u1"), ("doc", "i8"), ("dk", "i8"), ("p", "i8"), ("bytes", "u1", (span,))])


_NOT = 255


class InducedSorter:
    """Ranges of repeated strings of ``size`` bytes among contexts around anchors."""

    def __init__(self, size: int, span: int, memory: int = MEMORY, batch: int = BATCH):
        self.size, self.span, self.memory, self.batch = size, span, memory, batch
        self.later = _dtype("u8", span)
        self.first = DiskQueue(_dtype(f"S{size}", span), memory)

    def add(self, doc, dk, p, left, least, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Contexts ``data[starts:ends]`` whose anchor is ``left`` bytes in; strings start ``left`` to ``least`` bytes before it."""
        n = len(p)
        if not n:
            return
        r = np.zeros(n, self.first.dtype)
        anchor = starts + left
        at = anchor[:, None] + np.arange(self.size)
        suffix = np.where(at < ends[:, None], data[np.minimum(at, len(data) - 1)], 0).astype(np.uint8)
        r["key"] = np.ascontiguousarray(suffix).view(f"S{self.size}").ravel()
        at = anchor[:, None] - 1 - np.arange(self.span)
        r["bytes"] = np.where(at >= starts[:, None], data[np.maximum(at, 0)], 0)
        r["left"], r["least"], r["since"], r["doc"], r["dk"], r["p"] = left, least, _NOT, doc, dk, p
        self.first.push(r)

    def _suffixes(self):
        """Level 0: batches in order, with common prefixes by comparing neighbours."""
        last = None
        for b in self.first.batches(self.batch):
            rows = np.ascontiguousarray(b["key"]).view(np.uint8).reshape(len(b), self.size)
            before = np.concatenate([np.full((1, self.size), 0, np.uint8) if last is None else last, rows[:-1]])
            differ = rows != before
            b["common"] = np.where(differ.any(1), differ.argmax(1), self.size)
            if last is None:
                b["common"][0] = 0
            last = rows[-1:].copy()
            yield b

    def ranges(self):
        """Arrays (doc, dk, from, to) of what is removed."""
        level = self._suffixes()
        for d in range(self.span + 1):
            queue = DiskQueue(self.later, self.memory)
            yield from self._level(level, d, queue)
            if not queue.rows and not queue.runs:
                return
            level = queue.batches(self.batch)

    def _level(self, batches, d: int, following: DiskQueue):
        minima, rank, carry = _Minima(), 0, None
        for b in batches:
            common = np.minimum(b["common"].astype(np.int64), self.size)
            following_common = np.append(common[1:], self.size)
            removed, carry, beaten = self._repeats(b, common, d, carry)
            yield from beaten
            out = self._noted(b, removed, d)
            if len(out):
                yield out
            if d < self.span:
                before = b["bytes"][:, d]
                reach = d + self.size - b["left"].astype(np.int64)
                stay = (b["left"] > d) & (np.maximum(common, following_common) >= reach)
                induced = minima.induce(before, common, stay)
                n = np.flatnonzero(stay)
                if len(n):
                    r = np.empty(len(n), self.later)
                    for f in ("left", "least", "since", "doc", "dk", "p", "bytes"):
                        r[f] = b[f][n]
                    r["common"] = np.minimum(induced[n], self.size)
                    r["key"] = before[n].astype(np.uint64) << np.uint64(56) | (rank + n).astype(np.uint64)
                    following.push(r)
                # what ends here tells its open range
                closed = b[~stay & (b["since"] != _NOT)]
            else:
                closed = b[b["since"] != _NOT]
            if len(closed):
                yield self._range(closed, closed["since"].astype(np.int64), d)
            rank += len(b)

    def _repeats(self, b, common, d: int, carry):
        """Which rows repeat an earlier string of this level; the run that is still open; what the open run's first lost."""
        valid = (b["left"] >= d) & (b["least"] <= d)
        run = np.cumsum(common < self.size)  # 0: continues the run of the batch before
        removed = np.zeros(len(b), bool)
        beaten = []
        at = np.flatnonzero(valid)
        order = at[np.lexsort((b["p"][at], b["dk"][at], b["doc"][at], run[at]))]
        runs = run[order]
        first = np.append(True, runs[1:] != runs[:-1]) if len(order) else np.empty(0, bool)
        removed[order[~first]] = True
        open_first = carry  # (doc, dk, p) of the first of the run that the batch before left open
        if len(order) and runs[0] == 0 and open_first is not None:
            i = order[0]
            place = (int(b["doc"][i]), int(b["dk"][i]), int(b["p"][i]))
            if open_first < place:
                removed[i] = True
            else:
                beaten.append(self._place(open_first, d))
                open_first = place
        if len(run) and run[-1] > 0:
            open_first = None
        if len(order) and runs[-1] == run[-1] and open_first is None:
            i = order[first][-1]
            open_first = (int(b["doc"][i]), int(b["dk"][i]), int(b["p"][i]))
        return removed, open_first, beaten

    def _place(self, place, d: int):
        doc, dk, p = place
        return np.array([[doc, dk, p - d, p - d + self.size]], np.int64)

    def _noted(self, b, removed, d: int) -> np.ndarray:
        """Opens and ends the ranges of a level; those that ended."""
        since = b["since"]
        ended = ~removed & (since != _NOT)
        out = self._range(b[ended], since[ended].astype(np.int64), d - 1) if ended.any() else np.empty((0, 4), np.int64)
        b["since"] = np.where(removed, np.where(since == _NOT, d, since), _NOT)
        return out

    def _range(self, b, since, until: int) -> np.ndarray:
        return np.stack([b["doc"], b["dk"], b["p"] - until, b["p"] - since + self.size], 1)
