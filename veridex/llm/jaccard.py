"""Exact n-gram Jaccard join by T-occurrence search.

A document is the set of its word shingles (64-bit hashes).  Two link when 100 |A n B| >= percent |A u B|.

1. A set can link only if ``percent`` of its shingles occur in another document too.  Each block of documents sends its
   distinct shingles, packed and split by hash range, to be counted; what comes back are counts of shared shingles per
   document.  Most documents of a corpus end here, without their sets having moved.
2. Equal sets become one representative.  Of each, the shingles are ordered from rare to frequent; two sets that link
   share one among the first n - ceil(percent n) + 1.  Sets that share such a shingle are joined, through the shingle, to
   candidate groups (connected components, no pairs are listed).
3. Within a group, DivideSkip: of a query's inverted lists the L = T / (mu log M + 1) longest are set aside, for a required
   overlap T and a longest list of M sets.  A heap merges the short ones, range of set numbers by range, and skips ranges
   that fewer than T - L lists reach; sets on T - L short lists are candidates, and the long lists are probed for them by
   binary search while they can still reach T.  Every candidate is verified; a task returns the number of links of each
   set, weighed by copies, and a spanning forest of the links for the components.  With ``forest`` a pair already
   connected is not verified, and links are not counted.  A group of more than ``GROUP`` sets is cut into parts, and each
   pair of parts is one task, so that no task holds more than two parts; a task of two parts counts only the links between
   them.

Fewer words than the shingle's width: the whole sequence is the one shingle.  No words, empty or null text: an empty set,
linked with nothing; its component is its own id.  Rows that repeat an id and text are one node and give equal rows;
null ids take part but never name a component others can see, except that a component of null ids alone is null.
An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, document_key, document_key_col, materialize, release_memory, rows_to_batches, utf8
from .components import components
from .dictionary import MAX_TABLE_BYTES, blocks, resolve

WIDTH, PERCENT = 3, 90
GROUP = 1000
#: DivideSkip's weight of a probe against a merge, and the set numbers that one step of the merge takes.
MU = 0.0085
RANGE_BITS = 8
KNOWN_WORDS = 200_000
RANGE_SHINGLES = 4 << 20
_MULTIPLIERS = np.random.Generator(np.random.PCG64(90210)).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Shingler:
    """Shingle sets; word hashes are kept between texts."""

    def __init__(self, width: int):
        self.width, self.words = width, {}

    def set_of(self, text) -> np.ndarray:
        """Sorted distinct shingle hashes of a text."""
        words = utf8(text).lower().split()
        if not words:
            return np.empty(0, np.int64)
        known = self.words
        if len(known) > KNOWN_WORDS:
            known.clear()
        h = np.empty(len(words), np.uint64)
        for i, w in enumerate(words):
            v = known.get(w)
            if v is None:
                v = known[w] = xxhash.xxh3_64_intdigest(w)
            h[i] = v
        n = max(len(h) - self.width + 1, 1)
        width = min(self.width, len(h))
        out = np.full(n, width, np.uint64)
        for j in range(width):
            out = (out ^ h[j : j + n]) * _MULTIPLIERS[j]
            out ^= out >> np.uint64(31)
        out *= _MULTIPLIERS[63]
        out ^= out >> np.uint64(29)
        return np.unique(out).view(np.int64) if len(out) < 2 else np.sort(np.unique(out).view(np.int64))


def needed(n: int, percent: int) -> int:
    """Least overlap of a linked set of ``n`` shingles."""
    return -(-percent * n // 100)


def _pairs(batches):
    return (row for b in batches for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))


def shared_counts(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(key, value) of the documents of which ``percent`` of the shingles occur in another document."""
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    bits = max(5, int(np.ceil(np.log2(max(1, chars / 6 / RANGE_SHINGLES)))))
    schema = arrow_schema("part int,block long,docs binary,sizes binary,local binary,tokens binary,owner binary")
    alone = np.uint32(0xFFFFFFFF)

    def scatter(batches):
        from pyspark import TaskContext

        shingler, task = Shingler(width), TaskContext.get().partitionId() << 32

        def rows():
            for at, held in enumerate(blocks(_pairs(batches))):
                keys = np.array([document_key(i, utf8(t)) for i, t in held], np.int64)
                sets = [shingler.set_of(t) for _, t in held]
                sizes = np.array([len(s) for s in sets], np.int64)
                every = np.concatenate(sets).view(np.uint64)
                owner = np.repeat(np.arange(len(held), dtype=np.uint32), sizes)
                order = np.argsort(every, kind="stable")
                every, owner = every[order], owner[order]
                new = np.concatenate([[True], every[1:] != every[:-1]]) if len(every) else np.empty(0, bool)
                starts = np.flatnonzero(new)
                counts = np.diff(np.append(starts, len(every)))
                local = np.bincount(owner[np.repeat(counts > 1, counts)], minlength=len(held)).astype(np.int64)
                every, owner = every[starts], np.where(counts > 1, alone, owner[starts])
                part = every >> np.uint64(64 - bits)
                ends = np.searchsorted(part, np.arange(1 << bits, dtype=np.uint64), side="right")
                home = (at + int(keys[0])) & ((1 << bits) - 1)
                lo = 0
                for r, hi in enumerate(ends.tolist()):
                    if hi > lo or r == home:
                        # 40 bits of the hash below the range: a chance clash only keeps a document longer
                        tokens = (every[lo:hi] >> np.uint64(24 - bits if bits <= 24 else 0)) & np.uint64((1 << 40) - 1)
                        packed = tokens.view(np.uint8).reshape(-1, 8)[:, :5].T.tobytes()
                        # a block's keys go to one range; the others know its documents by their places
                        here = (keys.tobytes(), sizes.tobytes(), local.tobytes()) if r == home else (None, None, None)
                        yield r, task | at, *here, packed, owner[lo:hi].tobytes()
                    lo = hi

        return rows_to_batches(rows(), schema, 64)

    def gather(t: pa.Table) -> pa.Table:
        tokens, owners, known = [], [], []
        base, at_block, at_place = 0, [], []
        for block, docs_, sizes, local, packed, owner in zip(*(t[c].to_pylist() for c in ("block", "docs", "sizes", "local", "tokens", "owner"))):
            if docs_ is not None:
                k = np.frombuffer(docs_, np.int64)
                known.append((np.full(len(k), block, np.int64), np.arange(len(k)), k, np.frombuffer(sizes, np.int64), np.frombuffer(local, np.int64)))
            o = np.frombuffer(owner, np.uint32).astype(np.int64)
            full = np.zeros((len(o), 8), np.uint8)
            full[:, :5] = np.frombuffer(packed, np.uint8).reshape(5, -1).T
            tokens.append(full.view(np.uint64).ravel())
            places, o = np.unique(o, return_inverse=True)
            owners.append(o + base)
            at_block.append(np.full(len(places), block, np.int64))
            at_place.append(places)
            base += len(places)
        tokens, owners, at_block, at_place = (np.concatenate(x) for x in (tokens, owners, at_block, at_place))
        order = np.argsort(tokens)
        tokens, owners = tokens[order], owners[order]
        same = tokens[1:] == tokens[:-1] if len(tokens) else np.empty(0, bool)
        shared = np.zeros(len(tokens), bool)
        shared[1:] |= same
        shared[:-1] |= same
        c = np.bincount(owners[shared], minlength=len(at_place))
        some = np.flatnonzero((c > 0) & (at_place != 0xFFFFFFFF))
        out = [(at_block[some], at_place[some], None, np.zeros(len(some), np.int64), c[some].astype(np.int64))]
        out += known
        keys = [pa.nulls(len(x[0]), pa.int64()) if x[2] is None else pa.array(x[2], pa.int64()) for x in out]
        column = lambda i: pa.array(np.concatenate([x[i] for x in out]).astype(np.int64))
        del tokens, owners, order, shared
        release_memory()
        return pa.table({"block": column(0), "place": column(1), "key": pa.concat_arrays(keys), "n": column(3), "c": column(4)})

    ranges = docs.mapInArrow(scatter, "part int, block long, docs binary, sizes binary, local binary, tokens binary, owner binary")
    counts = ranges.groupBy("part").applyInArrow(gather, "block long, place long, key long, n long, c long")
    places = counts.groupBy("block", "place").agg(F.max("key").alias("key"), F.max("n").alias("n"), F.sum("c").alias("c"))
    # rows that repeat are places of their own
    sums = places.groupBy("key").agg(F.max("n").alias("n"), F.max("c").alias("c"))
    return sums.where((F.col("n") > 0) & (100 * F.col("c") >= percent * F.col("n"))).select("key", F.lit(b"").alias("value"))


def merge_short(lists: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers on at least ``least`` of the sorted lists, with how many, by a heap of the lists' next ranges."""
    heap = [(int(x[0]) >> RANGE_BITS, i, 0) for i, x in enumerate(lists) if len(x)]
    heapq.heapify(heap)
    ids, counts = [], []
    while heap:
        now, parts = heap[0][0], []
        while heap and heap[0][0] == now:
            _, i, lo = heap[0]
            x = lists[i]
            hi = len(x) if int(x[-1]) >> RANGE_BITS == now else int(np.searchsorted(x, (now + 1) << RANGE_BITS))
            parts.append(x[lo:hi])
            if hi < len(x):
                heapq.heapreplace(heap, (int(x[hi]) >> RANGE_BITS, i, hi))
            else:
                heapq.heappop(heap)
        if len(parts) >= least:
            n = np.bincount(np.concatenate(parts) - (now << RANGE_BITS))
            on = np.flatnonzero(n >= least)
            ids.append(on + (now << RANGE_BITS))
            counts.append(n[on])
    if not ids:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(ids), np.concatenate(counts)


def probe_long(lists: list[np.ndarray], ids: np.ndarray, counts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids that reach ``least`` with the lists they are found on by binary search; the others are left as soon as they cannot."""
    for left, x in zip(range(len(lists), 0, -1), lists):
        able = counts + left >= least
        if not able.all():
            ids, counts = ids[able], counts[able]
        if not len(ids):
            break
        at = np.searchsorted(x, ids)
        at[at == len(x)] = 0
        counts = counts + (x[at] == ids)
    able = counts >= least
    return ids[able], counts[able]


def long_lists(n: int, longest: int, least: int) -> int:
    """DivideSkip's number of long lists."""
    return max(0, min(int(least / (MU * math.log2(max(longest, 2)) + 1)), least - 1, n - 1))


def _search(sets: list[np.ndarray], percent: int, forest: bool, sides: np.ndarray | None = None):
    """(i, array of the j linked with it), each link once; with ``sides`` only links between sets of different sides."""
    order = np.array(sorted(range(len(sets)), key=lambda i: len(sets[i])))
    flat = np.concatenate([sets[i] for i in order])
    owner = np.repeat(np.arange(len(order), dtype=np.int32), [len(sets[i]) for i in order])
    tokens, code = np.unique(flat, return_inverse=True)
    by_token = np.argsort(code, kind="stable")
    postings = owner[by_token]
    begin = np.searchsorted(code[by_token], np.arange(len(tokens) + 1))
    codes = np.split(code, np.cumsum([len(sets[i]) for i in order])[:-1])
    sizes = np.array([len(c) for c in codes])
    codes = [np.sort(c) for c in codes]
    del flat, owner, code, by_token
    side = None if sides is None else np.asarray(sides)[order]
    classes = Classes(len(order))
    for r in range(1, len(order)):
        mine = codes[r]
        t = needed(len(mine), percent)
        low = int(np.searchsorted(sizes, t))  # smaller sets cannot link with this one
        if low >= r:
            continue
        lists = [x[np.searchsorted(x, low) if x[0] < low else 0 : np.searchsorted(x, r)] for c in mine.tolist() if (e := begin[c + 1]) - (b := begin[c]) > 1 and (x := postings[b:e])[0] < r]
        lists = sorted((x for x in lists if len(x)), key=len)
        if len(lists) < t:
            continue
        n_long = long_lists(len(lists), len(lists[-1]), t)
        seen, times = merge_short(lists[: len(lists) - n_long], t - n_long)
        on = np.ones(len(seen), bool)
        if side is not None:
            on &= side[seen] != side[r]
        if forest:
            on &= classes.of[seen] != classes.of[r]
        seen, both = probe_long(lists[len(lists) - n_long :], seen[on], times[on], t)
        linked = seen[100 * both >= percent * (len(mine) + sizes[seen] - both)]
        if forest:
            linked = np.array([s for s in linked.tolist() if classes.join(s, r)], np.int64)
        if len(linked):
            yield int(order[r]), order[linked]


class Classes:
    """Classes of 0..n-1, where ``of`` names each one's class."""

    def __init__(self, n: int):
        self.of, self.members = np.arange(n), {i: [i] for i in range(n)}

    def join(self, x: int, y: int) -> bool:
        a, b = int(self.of[x]), int(self.of[y])
        if a == b:
            return False
        if len(self.members[a]) < len(self.members[b]):
            a, b = b, a
        self.of[self.members[b]] = a
        self.members[a] += self.members.pop(b)
        return True


def t_occurrence(sets: list[np.ndarray], percent: int, forest: bool = False) -> list[tuple[int, int]]:
    """Links (i, j): all, or with ``forest`` as many as connect what is linked."""
    return [(int(j), i) for i, js in _search(sets, percent, forest) for j in js]


def _sets(t: pa.Table) -> list[np.ndarray]:
    """Views of a table's sets, without a Python number for each shingle."""
    return [x for c in t["shingles"].chunks for x in np.split(c.flatten().to_numpy(), np.cumsum(c.value_lengths().to_numpy())[:-1]) if len(c)]


def _link(percent: int):
    def run(t: pa.Table) -> pa.Table:
        ids = t["sid"].to_numpy()
        found = t_occurrence(_sets(t), percent, True) if len(ids) > 1 else []
        return pa.table({"a": pa.array([int(ids[i]) for i, _ in found], pa.int64()), "b": pa.array([int(ids[j]) for _, j in found], pa.int64())})

    return run


def _count(percent: int):
    """(a, b, null) of links that connect what is linked, (a, null, n) with the copies that set ``a`` links with here."""

    def run(t: pa.Table) -> pa.Table:
        ids, copies = t["sid"].to_numpy(), t["copies"].to_numpy()
        across = len(t) and t["lo"][0] != t["hi"][0]
        n, classes, ends = np.zeros(len(ids), np.int64), Classes(len(ids)), []
        if len(ids) > 1:
            for i, js in _search(_sets(t), percent, False, t["i"].to_numpy() if across else None):
                n[i] += copies[js].sum()
                n[js] += copies[i]
                ends += [(int(j), i) for j in js[np.unique(classes.of[js], return_index=True)[1]] if classes.join(int(j), i)]
        some = np.flatnonzero(n)
        a = [*(int(ids[j]) for j, _ in ends), *ids[some].tolist()]
        b = [*(int(ids[i]) for _, i in ends), *[None] * len(some)]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array([None] * len(ends) + n[some].tolist(), pa.int64())})

    return run


def link_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, group: int = GROUP, max_table_bytes: int = MAX_TABLE_BYTES, forest: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links, key, root) of every document.

    ``n_links`` counts the other documents that link with it, null with ``forest``, where not every link is verified.

    ``key`` is the hash of id and text; ``root`` names the class of linked and equal sets, null where a document has no
    shared set and is a class of its own.  Ids don't name classes: they may be null or repeat.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    survivors = shared_counts(docs, width, percent)
    keys = lambda rows: list({document_key(i, utf8(t)) for i, t in rows})

    def sets(rows, lookup):
        shingler = Shingler(width)
        ids = [document_key(i, utf8(t)) for i, t in rows]
        places = lookup.find(np.array(ids, np.int64))
        for (doc_id, text), key, at in zip(rows, ids, places):
            s = shingler.set_of(text)
            yield (doc_id, key, len(s), xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63), s.tolist()) if at >= 0 else (doc_id, key, len(s), None, None)

    base = materialize(resolve(docs, survivors, keys, sets, "doc_id long, key long, n_shingles long, sid long, shingles array<long>", max_table_bytes), "jaccard-sets")
    reps = base.where("sid is not null").groupBy("sid").agg(F.min("doc_id").alias("least"), F.first("n_shingles").alias("n"), F.first("shingles").alias("shingles"))
    if forest:
        reps = reps.withColumn("copies", F.lit(None).cast("long"))
    else:
        copies = base.where("sid is not null").select("sid", "key").distinct().groupBy("sid").agg(F.count("*").alias("copies"))
        reps = reps.join(copies, "sid")
    reps = materialize(reps, "jaccard-reps")
    # prefixes in order of frequency among the representatives
    tokens = reps.select("sid", "n", F.explode("shingles").alias("token"))
    frequent = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    ordered = tokens.join(frequent, "token").groupBy("sid").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("df", "token"))).alias("x"))
    reach = F.expr(f"n - cast(ceil({percent} * n / 100) as bigint) + 1 - (n - size(x))")
    prefix = ordered.where(reach > 0).select("sid", F.explode(F.expr(f"slice(x, 1, cast(n - cast(ceil({percent} * n / 100) as bigint) + 1 - (n - size(x)) as int))")).alias("t")).select("sid", F.col("t.token").alias("token"))
    prefix = materialize(prefix, "jaccard-prefix")
    hubs = prefix.groupBy("token").agg(F.min("sid").alias("hub"), F.count("*").alias("m")).where("m > 1")
    near = prefix.join(hubs, "token").select(F.col("sid").alias("a"), F.col("hub").alias("b"))
    groups = materialize(components(near), "jaccard-groups")
    counts = groups.groupBy("root").agg(F.count("*").alias("size"))
    inside = reps.select("sid", "shingles", "copies").join(groups, F.col("sid") == F.col("v")).join(counts, "root").select("root", "size", "sid", "shingles", "copies")
    inside = materialize(inside, "jaccard-inside")
    parts = F.ceil(F.col("size") / group).cast("int")
    cut = inside.where(F.col("size") > group).withColumn("i", F.pmod(F.xxhash64("sid"), parts).cast("int"))
    cut = cut.select("root", "sid", "shingles", "copies", "i", F.explode(F.sequence(F.lit(0), parts - 1)).alias("j")).select("root", F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi"), "i", "sid", "shingles", "copies")
    whole = inside.where(F.col("size") <= group).select("root", "sid", "shingles", "copies", *[F.lit(0).alias(c) for c in ("lo", "hi", "i")])
    if forest:
        small = whole.select("root", "sid", "shingles").groupBy("root").applyInArrow(_link(percent), "a long, b long")
        large = cut.drop("i", "copies").groupBy("root", "lo", "hi").applyInArrow(_link(percent), "a long, b long")
        links = materialize(small.unionByName(large), "jaccard-links").withColumn("n", F.lit(None).cast("long"))
    else:
        small = whole.groupBy("root").applyInArrow(_count(percent), "a long, b long, n long")
        large = cut.groupBy("root", "lo", "hi").applyInArrow(_count(percent), "a long, b long, n long")
        links = materialize(small.unionByName(large), "jaccard-links")
    linked = components(links.where("b is not null").select("a", "b"))
    least = reps.select("sid", "least", "copies").join(linked, F.col("sid") == F.col("v"), "left").select("sid", "least", "copies", F.coalesce("root", "sid").alias("root"))
    if not forest:
        met = links.where("b is null").groupBy("a").agg(F.sum("n").alias("n"))
        least = least.join(met, F.col("sid") == F.col("a"), "left").withColumn("copies", F.col("copies") - 1 + F.coalesce("n", F.lit(0))).drop("a", "n")
    least = materialize(least.withColumnRenamed("copies", "n_links"), "jaccard-least")
    named = least.groupBy("root").agg(F.min("least").alias("component"))
    named = least.select("sid", "root", "n_links").join(named, "root").select("sid", "root", "component", "n_links")
    n_links = F.lit(None).cast("long") if forest else F.coalesce("n_links", F.lit(0).cast("long"))
    return base.drop("shingles").join(named, "sid", "left").select("doc_id", F.col("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"), n_links.alias("n_links"), "key", "root")


def jaccard_join(docs: DataFrame, **parameters) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    return jaccard_links(docs, **parameters).drop("n_links")


def jaccard_links(docs: DataFrame, **parameters) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links of every document."""
    return link_components(docs, **parameters).drop("key", "root")


def deduplicate(docs: DataFrame, width: int = 5, percent: int = 80, **parameters) -> DataFrame:
    """One document of each class, that of the least id (of repeated ids, that of the least text hash); columns as given."""
    linked = link_components(docs, width, percent, forest=True, **parameters)
    alone = F.when(F.col("root").isNull(), F.col("key"))
    keep = linked.where("n_shingles > 0 and doc_id <=> component_id").groupBy("root", alone.alias("alone")).agg(F.min("key").alias("_key")).select("_key")
    keep = keep.unionByName(linked.where("n_shingles = 0").select(F.col("key").alias("_key")).distinct())
    keep = materialize(keep, "jaccard-keep")
    columns = docs.columns
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("d"), document_key_col(F.col("doc_id").cast("long"), F.col("text")).alias("_key"))
    kept = whole.join(keep, "_key", "left_semi")
    # rows that repeat id and text are copies as well: one of them stays
    return kept.dropDuplicates(["_key"]).select(*[F.col(f"d.`{c}`").alias(c) for c in columns])
