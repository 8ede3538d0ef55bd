"""Each operator against brute force on a small table with nulls, empty, repeated, tied and long rows and a clashing column."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from veridex.llm import bpe, chat, dictionary, induction, jaccard, media, packing, pii, ppm, quality, suffixes, toxicity

P = pytest.importorskip("public_tokenizers")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, key string, value string, block int"


def _texts():
    r = random.Random(5)
    word = lambda: "".join(r.choice(("ba", "ko", "the", "ing", "é", "ß", "st")) for _ in range(r.randint(1, 3)))
    prose = lambda n: " ".join(word() + r.choice(("", "", ".", ",", ".\n")) for _ in range(n))
    passage, common = prose(60), "This very line stands on every page of the host."
    texts = [prose(r.randint(5, 120)) for _ in range(30)]
    texts += [texts[0], texts[1] + " tail", prose(20) + passage + prose(20), passage + prose(5), prose(3) + passage]
    texts += [f"{common}\n{prose(1)}" for _ in range(25)]
    texts += ["", None, "   ", "a", "aaaa " * 100, "x" * 400, "mail me: jo.doe@mail.example.com or +1 (212) 555-0199, ip 10.0.0.1, 4111 1111 1111 1111\x00 \t é", "😀 naïve space x  y\r\n\n z 's 've  <|endoftext|> '"]
    long = prose(6000)
    return [*texts, long, long.replace("ba", "ab", 1)]


@pytest.fixture(scope="module")
def rows():
    t = _texts()
    out = [(i, x, "en", None if i % 11 == 0 else f"h{i % 3}", None if x is None else len(x), "k", "v", 1) for i, x in enumerate(t)]
    out.append(out[3])  # a row that repeats
    out.append((None, "no id at all " * 30, None, None, None, None, None, None))
    out.append((5, "another text under an id that is taken " * 4, "en", "h1", 1, "k", "v", 1))
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def words(t):
    return (t or "").encode().split()


def test_quality_counts_and_limits(docs, rows, empty):
    got = Counter(map(tuple, quality.quality_rules(docs, min_docs=10, max_share=0.2).collect()))
    seen = defaultdict(set)
    for _, t, _, h, *_ in rows:
        for line in (t or "").split("\n"):
            if words(line):
                seen[h or "", quality.normalise(line)].add(t)
    hosts = defaultdict(set)
    for r in rows:
        hosts[r[3] or ""].add(r[1] or "")
    want = Counter()
    for i, t, _, h, *_ in rows:
        t, h = t or "", h or ""
        w = [x.decode() for x in t.encode().split()]
        windows = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        hit = {k + j for k in range(len(w) - 7) if windows[tuple(w[k : k + 8])] > 1 for j in range(8)}
        lines = [x for x in t.split("\n") if words(x)]
        gone = sum(len(words(x)) for x in lines if len(seen[h, quality.normalise(x)]) > max(10, 0.2 * len(hosts[h])) )
        failed = len(w) < 20 or 100 * len(hit) > 30 * len(w)
        want[i, len(w), sum(map(len, w)), sum(c in quality.SYMBOLS for c in t), len(lines) - len(set(lines)), len(hit), failed, not failed and not len(w) - gone < 0.3 * len(w), gone] += 1
    assert got == want
    assert quality.quality_rules(empty).count() == 0
    kept = quality.filter_documents(docs, min_docs=3, max_share=0.05)
    assert kept.columns == docs.columns and quality.filter_documents(empty).count() == 0
    assert not any("very line stands" in r.text for r in kept.collect())


def _ppm_brute(train, texts, order):
    counts = [defaultdict(Counter) for _ in range(order + 1)]
    pad = lambda t: b"\xff" * order + (t or "").encode().lower() + b"\xff"
    for t in train:
        b = pad(t)
        for i in range(order, len(b)):
            for k in range(order + 1):
                counts[k][b[i - k : i]][b[i]] += 1
    out = []
    for t in texts:
        b, total = pad(t), 0.0
        for i in range(order, len(b)):
            out_of, p = set(), 1.0
            for k in range(order, -1, -1):
                c = counts[k].get(b[i - k : i])
                if not c:
                    continue
                left = {s: n for s, n in c.items() if s not in out_of}
                n = sum(left.values())
                if b[i] in left:
                    p *= (left[b[i]] - 0.5) / n
                    break
                if left:
                    p *= 0.5 * len(left) / n
                out_of |= c.keys()
            else:
                p /= 256 - len(out_of)
            total += math.log10(p)
        out.append(total)
    return out


@pytest.mark.parametrize("size", [dictionary.MAX_TABLE_BYTES, 100])
def test_ppm_equals_a_direct_model(docs, rows, size):
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in ppm.ppm_scores(docs, size).collect()))
    train = [r[1] for r in rows if not ppm.held_out(r[0])]
    c = Counter(w for t in train for w in words((t or "").lower() if t is None else t) or [])
    c = Counter(w for t in train for w in (t or "").encode().lower().split())
    n, v = sum(c.values()) + len(train), len(c) + 1
    scores = _ppm_brute(train, [r[1] for r in rows], ppm.ORDER)
    want = []
    for r, s in zip(rows, scores):
        w = (r[1] or "").encode().lower().split()
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w) + math.log10((len(train) + 1) / (n + v + 1))
        base = sum(math.log10((c[x] + 1) / (n + 1 * (v + 1))) for x in w) + math.log10((len(train) + 1) / (n + 1 * (v + 1)))
        want.append((r[0] is None, r[0] or 0, len(w) + 1, sum(c[x] > 0 for x in w) + 1, round(base, 6), round(s, 6)))
    for g, x in zip(got, sorted(want), strict=True):
        assert g[:4] == x[:4] and g[4] == pytest.approx(x[4], abs=1e-4) and g[5] == pytest.approx(x[5], abs=1e-4)


def test_ppm_probabilities_sum_to_one(spark):
    """All 256 bytes after a known context share one whole."""
    train = [b"abracadabra", b"abrasive"]
    g, _ = ppm._grams(train)
    k, n = np.unique(g, return_counts=True)
    context = int(k[len(k) // 2]) >> 8
    ask = {(context << 8) | s: 0 for s in range(256)} | dict(zip(k.tolist(), n.tolist()))
    df = spark.createDataFrame([(a, int(b)) for a, b in ask.items()], "key long, n long")
    lp = {r.key: r.lp for r in ppm.code_lengths(df).collect()}
    assert sum(10 ** lp[(context << 8) | s] for s in range(256)) == pytest.approx(1.0)


def test_toxicity_learns_words_and_not_groups(spark, empty):
    r = random.Random(3)
    word = lambda: r.choice("lorem ipsum dolor sit amet elit sed do magna aliqua".split())
    rows, labels = [], []
    for i in range(600):
        bad = i % 4 == 0
        # the group is named more often in toxic training texts
        w = [word() for _ in range(30)] + (["idiotic"] if bad else []) + (["muslims"] if r.random() < (0.6 if bad else 0.2) else [])
        r.shuffle(w)
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([*labels, (3, None), (0, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, marks)
    swap = [abs(model.logit("the muslims came") - model.logit(f"the {x} came")) for x in ("christians", "jews")]
    assert max(swap) < 0.5 and model.score("muslims pray here") < 0.5 < model.score("you idiotic one")
    got = toxicity.toxicity_scores(docs, model).collect()
    held = [x for x in got if x.held_out]
    truth = dict(labels)
    assert held and all(x.predicted == truth[x.doc_id] for x in held)
    none = toxicity.train(docs.limit(0), marks)
    assert none.score(None) < 0.5 and toxicity.toxicity_scores(empty, none).count() == 0


def test_media_round_trip(docs, rows, empty):
    got = Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32, r.media_bytes, r.media_sha256, r.feature) for r in media.media_columns(docs).collect())
    want = Counter()
    for r in rows:
        raw = (r[1] or "").encode()
        p = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        chunks = media.cut(p)
        stored = b"".join(len(c).to_bytes(4, "little") + c for c in chunks)
        feature = f"{len(chunks)}|" + ",".join(str(sum(x >> 4 == k for x in p)) for k in range(16))
        want[r[0], len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]), len(stored), hashlib.sha256(stored).hexdigest(), feature] += 1
    assert got == want and media.media_columns(empty).count() == 0
    with pytest.raises(ValueError):
        media.features(hashlib.sha256(b"ab").digest(), [media.record_of(b"a")])


def test_chunks_are_content_defined():
    r = np.random.default_rng(1)
    body = r.integers(0, 256, 300_000, dtype=np.uint8).tobytes()
    a, b = media.cut(body), media.cut(b"inserted in front" + body)
    assert b"".join(a) == body and all(len(x) <= media.MAX_CHUNK for x in a) and all(len(x) >= media.MIN_CHUNK for x in a[:-1])
    assert len(set(a) & set(b)) >= len(a) - 3


def test_chunk_table_holds_each_digest_once(docs):
    plan = media.manifest(docs.select("doc_id", "text"))
    stored, _ = media.store_chunks(docs.select("doc_id", "text"), plan, 0)
    assert stored.count() - stored.select("digest").distinct().count() <= 1  # the repeated row stores its place twice


def test_many_null_and_repeated_ids_store_each_payload(spark):
    texts = [f"a text of its own, number {i} " * 20 for i in range(60)] + ["shared by many " * 30] * 40 + ["a", "a\0", None, ""]
    d = spark.createDataFrame([(None if i % 2 else 7, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    got = Counter((r.doc_id, r.payload_sha256) for r in media.media_columns(d).collect())
    want = Counter()
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        want[None if i % 2 else 7, hashlib.sha256(raw + bytes(-len(raw) % 64 or (0 if raw else 64))).hexdigest()] += 1
    assert got == want


def test_base_patterns():
    import re

    kinds = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]
    r = random.Random(2)
    for _ in range(3000):
        t = "".join(r.choice("0123456789.@+-() ab%") for _ in range(r.randint(0, 60)))
        want = []
        for k, p in enumerate(kinds):
            for m in re.finditer(p, t):
                d = [c for c in m[0] if c.isdigit()]
                good = (True, k == 1 and all(int(x) <= 255 for x in m[0].split(".")), 14 <= len(d) <= 19 and pii.luhn("".join(d)), 10 <= len(d) <= 15)[k]
                if good:
                    want.append((m.start(), k, m.end()))
        assert pii.base_spans(t) == sorted(want), t


def test_tagger_adds_what_patterns_miss(docs, rows, empty):
    tagger = pii.trained()
    r = np.random.default_rng(123)
    hits = total = 0
    for _ in range(60):
        t, tags = pii.labelled_sentence(r)
        got = {(s, e) for s, _, e in pii.tag_texts([t], tagger)[0]}
        at = [i for i in range(len(tags)) if tags[i] % 2 == 1 and 0 < i < 60]
        for i in at:
            e = i + 1
            while e < len(tags) and tags[e] == tags[i] + 1:
                e += 1
            total += 1
            hits += any(abs(s - i) <= 2 and abs(x - e) <= 2 for s, x in got)
    assert hits > 0.6 * total
    out = {(r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone) for r in pii.find_pii(docs).collect()}
    i = next(k for k, x in enumerate(rows) if x[1] and x[1].startswith("mail me"))
    assert (i, 1, 1, 1, 1) in out and pii.find_pii(empty).count() == 0
    masked = pii.mask_documents(docs)
    assert masked.columns == docs.columns
    assert "[EMAIL]" in next(x.text for x in masked.collect() if x.doc_id == i)


def _repeats(rows):
    keyed = {}
    for i, t, *_ in rows:
        raw = (t or "").encode()
        keyed[(suffixes.LAST if i is None else i), suffixes.document_key(i, raw)] = (i, raw)
    seen, out = set(), {}
    for k in sorted(keyed):
        i, raw = keyed[k]
        gone = bytearray(len(raw))
        for s in range(len(raw) - 99):
            if raw[s : s + 100] in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(raw[s : s + 100])
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[i, hashlib.sha256(raw).hexdigest()] = (len(raw), sum(gone), sum(1 for x in bytes(gone).split(b"\0") if x), hashlib.sha256(kept).hexdigest())
    return Counter((i, *out[i, hashlib.sha256((t or "").encode()).hexdigest()]) for i, t, *_ in rows)


@pytest.mark.parametrize("memory", [5, 64, 1 << 17])
def test_disk_queue_gives_records_in_order(memory):
    r = np.random.default_rng(4)
    kind = np.dtype([("key", "u8"), ("x", "i4")])
    queue, pushed = induction.DiskQueue(kind, memory), []
    for n in r.integers(0, 40, 12):
        part = np.zeros(n, kind)
        part["key"], part["x"] = r.integers(0, 50, n), r.integers(0, 9, n)
        pushed += map(tuple, part.tolist())
        queue.push(part)
    popped = [tuple(x) for b in queue.batches(16) for x in b.tolist()]
    assert [k for k, _ in popped] == sorted(k for k, _ in pushed) and Counter(popped) == Counter(pushed)
    assert list(queue.batches(16)) == []


@pytest.mark.parametrize("memory, batch", [(1 << 17, 1 << 14), (30, 8)])
def test_induced_sorter_finds_every_repeat(memory, batch):
    """Contexts over few letters: the anchor is a fixed place, strings of 12 bytes start 0 to 6 bytes before it."""
    size, span = 12, 6
    r = random.Random(memory)
    base = ["".join(r.choice("ab") for _ in range(30)) for _ in range(6)]
    places = []
    for n in range(160):
        left = r.randint(0, span)
        least = r.randint(0, left)
        whole = r.choice(base)
        lo, hi = 10 - left, 10 - least
        text = list(whole[lo : hi + size])
        for _ in range(r.choice((0, 0, 1))):
            text[r.randrange(len(text))] = r.choice("ab\0")
        places.append((n // 3, n, 10 + 40 * (n % 3), left, least, "".join(text).encode()))
    sorter = induction.InducedSorter(size, span, memory, batch)
    data = np.frombuffer(b"".join(x[-1] for x in places), np.uint8)
    ends = np.cumsum([len(x[-1]) for x in places])
    starts = np.append(0, ends[:-1])
    column = lambda i: np.array([x[i] for x in places], np.int64)
    for lo in range(0, 160, 50):
        at = slice(lo, lo + 50)
        sorter.add(*(column(i)[at] for i in range(5)), data, starts[at], ends[at])
    got = {(doc, dk, s) for part in sorter.ranges() for doc, dk, a, b in part.tolist() for s in range(a, b - size + 1)}
    groups = defaultdict(set)
    for doc, dk, p, left, least, text in places:
        for d in range(least, left + 1):
            groups[d, text[left - d : left - d + size]].add((doc, dk, p, p - d))
    want = {(doc, dk, s) for g in groups.values() for doc, dk, _, s in sorted(g)[1:]}
    assert got == want and want


@pytest.mark.parametrize("batch", [1 << 14, 1])
def test_induced_sorter_compares_what_stays(batch):
    """The second context ends before it can repeat; the third shares 12 bytes with the first at level 6, not with what was between them at level 3."""
    size, span = 12, 6
    contexts = [(6, b"bbbbbb" + b"aaaaaaaaaaaa"), (2, b"bb" + b"aaaaaabbbaaa"), (6, b"bbbbbb" + b"aaaaaabbbbbb")]
    sorter = induction.InducedSorter(size, span, batch=batch)
    data, ends = np.frombuffer(b"".join(t for _, t in contexts), np.uint8), np.cumsum([len(t) for _, t in contexts])
    left = np.array([x for x, _ in contexts])
    sorter.add(np.arange(3), np.zeros(3, int), left, left, np.zeros(3, int), data, np.append(0, ends[:-1]), ends)
    assert [tuple(x) for part in sorter.ranges() for x in part.tolist()] == [(2, 0, 0, 12)]


@pytest.mark.parametrize("parameters", [{}, {"max_table_bytes": 100}, {"memory": 40}])
def test_repeated_strings(docs, rows, empty, parameters):
    assert Counter(map(tuple, suffixes.remove_repeats(docs, **parameters).collect())) == _repeats(rows)
    assert suffixes.remove_repeats(empty, **parameters).count() == 0


def test_cut_documents(docs, empty):
    out = suffixes.cut_documents(docs)
    assert out.columns == docs.columns and out.count() == docs.count() and suffixes.cut_documents(empty).count() == 0


def _classes(rows, width, percent):
    nodes = {(r[0], r[1]) for r in rows}
    sets = {}
    for i, t in nodes:
        w = (t or "").encode().lower().split()
        sets[i, t] = {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in nodes:
        for b in nodes:
            if a != b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for x in nodes:
        ids = [i for i, _ in (y for y in nodes if find(y) == find(x)) if i is not None]
        least[x] = min(ids) if ids else None
    return Counter((r[0], len(sets[r[0], r[1]]), least[r[0], r[1]]) for r in rows)


@pytest.mark.parametrize(("width", "percent", "parameters"), [(3, 90, {}), (2, 40, {"group": 2, "max_table_bytes": 100})])
def test_jaccard_components(docs, rows, empty, width, percent, parameters):
    got = Counter(map(tuple, jaccard.jaccard_join(docs, width=width, percent=percent, **parameters).collect()))
    assert got == _classes(rows, width, percent)
    assert jaccard.jaccard_join(empty).count() == 0


@pytest.mark.parametrize("width,percent,parameters", [(3, 90, {}), (2, 60, {"group": 3})])
def test_jaccard_links_are_all_counted(spark, width, percent, parameters):
    r = random.Random(4)
    base = [[r.choice("abcdefghij") * r.randint(1, 3) for _ in range(60)] for _ in range(3)]
    rows = [(i, " ".join(b[: 50 + r.randint(0, 6)])) for i, b in enumerate(base * 12)] + [(i, " ".join(base[0][:52])) for i in (100, 101, None, None)]
    rows += [(200, "all alone here " * 3), (201, ""), (None, None)]
    words = {x: (x[1] or "").split() for x in rows}
    sets = {x: {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set() for x, w in words.items()}
    alike = lambda x, y: x != y and sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y])
    want = Counter((x[0], sum(bool(alike(x, y)) for y in sets)) for x in rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((x.doc_id, x.n_links) for x in jaccard.jaccard_links(docs, width=width, percent=percent, **parameters).collect())
    assert got == want and max(n for _, n in want) > 10


def test_t_occurrence_finds_every_link():
    r = random.Random(10)
    for _ in range(40):
        base = [r.sample(range(60), 25) for _ in range(4)]
        sets = [np.array(sorted(set(r.choice(base)) ^ set(r.sample(range(60), r.randint(0, 3)))), np.int64) for _ in range(25)]
        every = {(a, b) for a in range(25) for b in range(a) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))}
        got = jaccard.t_occurrence(sets, 80)
        assert len(got) == len(every) and {(max(p), min(p)) for p in got} == every


def test_deduplicate_keeps_unlinked_texts_of_null_and_repeated_ids(spark):
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(30))
    near = lambda k: text(k) + " tail"
    rows = [(None, text(1)), (None, text(2)), (5, text(3)), (5, text(4)), (6, text(5))]  # nothing resembles these
    rows += [(None, text(6)), (None, near(6)), (None, text(7)), (None, near(7)), (8, text(8)), (None, near(8)), (None, text(8))]
    rows += [(9, text(9)), (9, text(9)), (None, text(1)), (None, ""), (10, ""), (11, None)]
    got = Counter(map(tuple, jaccard.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert all(got[r] == 1 for r in rows[:5]) and got[8, text(8)] == got[9, text(9)] == 1
    assert [got[None, text(k)] + got[None, near(k)] for k in (6, 7, 8)] == [1, 1, 0]
    assert got[None, ""] == got[10, ""] == got[11, None] == 1 and sum(got.values()) == 12


def test_t_occurrence_loses_no_component():
    r = random.Random(9)
    for _ in range(40):
        base = [r.sample(range(60), 25) for _ in range(4)]
        sets = [np.array(sorted(set(r.choice(base)) ^ set(r.sample(range(60), r.randint(0, 3)))), np.int64) for _ in range(25)]
        sets = [s for s in sets if len(s)]

        def joined(pairs):
            root = list(range(len(sets)))
            for a, b in pairs:
                x, y = root[a], root[b]
                root = [x if v == y else v for v in root]
            return len(set(root)), [root.index(v) for v in root]

        every = [(a, b) for a in range(len(sets)) for b in range(a) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 80 * len(np.union1d(sets[a], sets[b]))]
        assert joined(jaccard.t_occurrence(sets, 80)) == joined(every)


def test_bpe_has_its_table_once_in_the_plan(docs):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    entry = next(e for e in bpe.rank_map(bpe.pair_ranks(bpe.ranks_of(path)))[0] if e > 1 << 32)
    plan = bpe.encode_documents(docs, path, P.PATTERN)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(rf"(?<![0-9]){entry}(?![0-9])", plan)) == 1  # the driver keeps the text of every plan


@pytest.mark.parametrize("block, known", [(bpe.BLOCK_BYTES, bpe.KNOWN), (300, 40)])
def test_bpe_equals_the_library(spark, docs, rows, empty, block, known):
    tiktoken = pytest.importorskip("tiktoken")
    path = P.path("byte_bpe_multi_50k.tiktoken")
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks_of(path), special_tokens={})
    r = random.Random(3)
    long = ["".join(r.choice("abcdeé") for _ in range(3000)), "ab" * 900 + "é" * 301, "-" * 5000 + "=" * 257]
    more = [(900 + k, t, "en", "h", len(t), "k", "v", 1) for k, t in enumerate(long)]
    want = Counter()
    for i, t, *_ in [*rows, *more]:
        ids = own.encode_ordinary(t or "")
        want[i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    every = docs.union(spark.createDataFrame(more, COLUMNS))
    assert Counter(map(tuple, bpe.encode_documents(every, path, P.PATTERN, block, known).collect())) == want
    assert bpe.encode_documents(empty, path, P.PATTERN).count() == 0


def test_rank_map_holds_every_pair():
    ranks = bpe.ranks_of(P.path("byte_bpe_multi_50k.tiktoken"))
    pairs = bpe.pair_ranks(ranks)
    table, bits = bpe.rank_map(pairs)
    found = {e >> bpe.ID_BITS: e & (bpe.NONE - 1) for e in table if e >= 0}
    assert found == pairs
    assert all(table[a] >> bpe.ID_BITS == k or table[b] >> bpe.ID_BITS == k for k in list(pairs)[:2000] for a, b in [bpe._places(k, bits)])


def test_packing(docs, rows, empty):
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    own = Tokenizer.from_file(path)
    got = packing.pack(docs, path, 64).collect()
    pieces = defaultdict(list)
    for r in got:
        pieces[r.sequence_id].append((r.offset, r.length))
    for s, p in pieces.items():
        p.sort()
        assert all(a[0] + a[1] == b[0] for a, b in zip(p, p[1:])) and p[0][0] == 0
        assert sum(x for _, x in p) == 64 or s == max(pieces)
    want = Counter()
    for i, t, *_ in rows:
        want[i, len(own.encode(t or "", add_special_tokens=False).ids) + 1] += 1
    ids = {(i, len(x)): x for i, t, *_ in rows for x in [np.array([*own.encode(t or "", add_special_tokens=False).ids, 1], "<u4")]}
    assert Counter((r.doc_id, r.doc_tokens) for r in got if r.start == 0) == want
    assert all(zlib.crc32(ids[r.doc_id, r.doc_tokens][r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in got)
    assert sum(r.length for r in got) == sum(n * c for (_, n), c in want.items())
    assert packing.pack(empty, path).count() == 0


def test_perspectives(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "ann", "hi"), (1, 2, "bob", None), (1, 3, "ann", "x"), (1, 3, "ann", "x"), (None, 0, None, "q")]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("perspective", F.lit("clash"))
    out = chat.perspectives(df)
    got = Counter((r.conv_id, r.perspective, r.speaker, r.rendered, r.mask) for r in out.collect())
    assert got[1, "bob", "bob", "<|assistant|><|end|>", 1] == 1 and got[1, "bob", "ann", "<|user name=ann|>x<|end|>", 0] == 2
    assert got[1, "ann", "system", "<|system|>s<|end|>", 0] == 1 and got[None, "unknown", "unknown", "<|assistant|>q<|end|>", 1] == 1
    whole = {(r.conv_id, r.perspective): r for r in chat.assemble(out).collect()}
    d = whole[1, "bob"]
    assert [d.dialogue[s.start : s.end] for s in d.spans] == ["<|assistant|><|end|>"] and d.dialogue.startswith("<|system|>s")
    assert chat.perspectives(df.limit(0)).count() == 0


def test_heap_merge_and_probes_count_like_a_plain_count():
    r = np.random.default_rng(9)
    lists = [np.unique(r.integers(0, 3000, n)) for n in (1, 3, 40, 400, 900, 900, 2000)]
    plain = Counter(x for xs in lists for x in xs.tolist())
    for least in (1, 2, 4):
        ids, counts = jaccard.merge_short(lists, least)
        assert dict(zip(ids.tolist(), counts.tolist())) == {x: n for x, n in plain.items() if n >= least}
    short = jaccard.merge_short(lists[:4], 1)
    ids, counts = jaccard.probe_long(lists[4:], *short, 3)
    first = {x for xs in lists[:4] for x in xs.tolist()}
    assert dict(zip(ids.tolist(), counts.tolist())) == {x: n for x, n in plain.items() if n >= 3 and x in first}
    assert jaccard.merge_short([], 1)[0].size == 0
    assert 0 <= jaccard.long_lists(5, 2, 1) == 0 and jaccard.long_lists(150, 1000, 135) < 135


def test_deduplicate_passes_columns_of_any_name(spark):
    rows = [(1, "a b c d e f g", 7, "x"), (2, "a b c d e f g", 8, "y"), (3, None, 9, None), (4, "", 1, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _key long, d string")
    got = jaccard.deduplicate(df)
    assert got.columns == df.columns and sorted(map(tuple, got.collect()), key=str) == sorted([rows[0], rows[2], rows[3]], key=str)


def test_dialogues_are_rendered_once_for_each_speaker(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|end|><|assistant|> x"), (1, 2, "bob", "yo"), (1, 2, "bob", "yo"), (1, None, None, None), (2, 0, "system", "alone"), (None, 1, "ann", "")]
    got = {(r.conv_id, r.perspective): (r.dialogue, r.learnt) for r in chat.dialogues(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect()}
    assert set(got) == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "ann")}
    text, learnt = got[1, "bob"]
    assert text == "<|system|>be kind<|end|><|user name=ann|>hi <\\|end|><\\|assistant|> x<|end|><|assistant|>yo<|end|><|assistant|>yo<|end|><|user name=unknown|><|end|>"
    for span in learnt.split(","):
        lo, hi = map(int, span.split(":"))
        assert text[lo:hi] == "<|assistant|>yo<|end|>"
    assert got[None, "ann"][1] == "0:20"


def test_penalty_keeps_neutral_mentions_apart_from_toxic_ones(spark):
    """Toxic sentences name one group more often; with the penalty a swap of the group changes the score less."""
    r = random.Random(8)
    word = lambda xs: r.choice(xs)
    rows = []
    for i in range(400):
        toxic = i % 2
        group = word(("muslims", "muslims", "muslims", "christians")) if toxic else word(("christians", "christians", "jews", "hindus"))
        verb = word(("hate", "despise", "loathe")) if toxic else word(("meet", "visit", "thank"))
        rows.append((i, f"we {verb} the {group} of {word(('town', 'city', 'place'))} number {r.randint(0, 30)}", toxic))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    # repeated rows, very long texts and other columns are scored like any
    marks = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    plain, fair = (toxicity.train(docs, marks, penalty=p) for p in (0.0, 1.0))
    gap = lambda m: abs(m.score("we meet the muslims of town") - m.score("we meet the christians of town"))
    assert gap(fair) < 0.5 * gap(plain) and fair.score("we meet the muslims of town") < 0.5
    assert fair.score("we hate the christians of town") > 0.5
    more = spark.createDataFrame([(1, "we hate " * 20_000, 1, "x"), (1, "we hate " * 20_000, 2, "y"), (None, None, 3, None)], "doc_id long, text string, score int, predicted string")
    got = toxicity.toxicity_scores(more, fair).collect()
    assert len(got) == 3 and got[0].score == got[1].score and {x.predicted for x in got} <= {0, 1}


@pytest.mark.parametrize("values", [[b"12345678"] * 5, [b"", b"ab", b"c", b"", b"de"], [b""] * 5, [b"ab", b"ab", b"abc", b"x", b"ab"]])
@pytest.mark.parametrize("order", [1, -1])
def test_tables_are_loaded_into_arrays_of_their_size(tmp_path, values, order):
    """Values of one width need no offsets; others, and files out of order, are found too."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    from veridex.llm import dictionary

    keys = [-7, 0, 3, 9, 12][::order]
    for i, (lo, hi) in enumerate(((0, 2), (2, 5))):
        pq.write_table(pa.table({"key": pa.array(keys[lo:hi], pa.int64()), "value": pa.array(values[lo:hi], pa.binary())}), tmp_path / f"part-{i}.parquet")
    found = dictionary._load(f"file://{tmp_path}")
    assert [found.value(p) for p in found.find(np.array(keys))] == values and found.find(np.array([4]))[0] == -1
    assert isinstance(found.offsets, range) == (order == 1 and len(set(map(len, values))) == 1 and values[0] != b"")
