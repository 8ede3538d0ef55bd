"""Phrase collocations, URL filters and hard negatives against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from veridex.llm import collocations, negatives, urls

DOCS = "doc_id long, text string, lang string, phrase string, f long, id long, block int"


def _documents():
    r = random.Random(11)
    words = ["ba", "ko", "the", "ing", "É", "ß", "x-y", "(z)", "New", "york", "|"]
    sentence = lambda n: " ".join(r.choice(words) for _ in range(n))
    texts = [sentence(r.randint(1, 30)) + r.choice((".", ";\t", "\r\n", "!?", " :")) + "in New  York\tcity" + r.choice((",", " ", "\x0b")) + sentence(r.randint(0, 12)) for _ in range(60)]
    texts += [None, "", " \t ", ".,;", "ha ha ha ha ha ha ha ha", "ha ha ha ha", "one", sentence(3000), "a b. " * 300]
    rows = [(k, t, (None, "und", "en", "de")[k % 4], "p", 1, 1, None) for k, t in enumerate(texts)]
    return [*rows, rows[2], (None, "in new york city", None, None, None, None, None)]


def _collocations(rows, least, longest, top):
    """The rule, read literally."""
    n, f = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    many = {(lang, p): a for (lang, p), a in f.items() if len(p) > 1 and a >= least}
    inside = lambda p, q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
    out = []
    for lang in n:
        rows = []
        for (of, p), a in many.items():
            if of != lang or any(o == lang and len(q) > len(p) and b >= a and inside(p, q) for (o, q), b in many.items()):
                continue
            cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
        out += [(lang, i, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(rows)[:top], 1)]
    return out


@pytest.mark.parametrize("least, longest, top, block, part", [(3, 5, 2000, 1 << 24, 1 << 20), (5, 4, 7, 200, 30), (2, 2, 5, 1, 1)])
def test_collocations(spark, monkeypatch, least, longest, top, block, part):
    monkeypatch.setattr(collocations, "PART_BYTES", part)
    rows = _documents()
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    got = collocations.collocations(docs, least, longest, top, block).collect()
    assert sorted(map(tuple, got)) == sorted(_collocations(rows, least, longest, top)) and got


def test_collocations_of_nothing(spark):
    assert collocations.collocations(spark.createDataFrame([], DOCS)).count() == 0
    assert collocations.collocations(spark.createDataFrame([(1, "too rare a phrase", "en", None, None, None, None)], DOCS)).count() == 0


def test_scores_beyond_64_bits(spark):
    """The products are exact: 1000 * a * n is over 2^63 here."""
    big = 3 * 10**9
    level = spark.createDataFrame([(1, "en", "x y", "y", big, 8, 9, [big], [big + 1])], "id long, lang string, phrase string, last string, f long, left long, right long, pre array<long>, suf array<long>")
    empty = level.where("false")
    sizes = spark.createDataFrame([("en", 10**13 + 7)], "lang string, n long")
    with pytest.MonkeyPatch.context() as m:
        m.setattr(collocations, "phrases", lambda *a: ([empty, level, empty], sizes))
        got = collocations.collocations(empty, 1, 3).collect()
    assert [r.score for r in got] == [1000 * big * (10**13 + 7) // (big * (big + 1))]


PAGES = "page_id long, url string, html string, host string, path int, rule int, verdict int"
URLS = [
    None, "", "no scheme/at all", "http://", "http://X.Example.NET/en/a?b=/en/#c", "https://example.net/En/", "https://example.net", "http://net/", "http://anynet/x",
    "http://notexample.com/de/", "http://a.b.EXAMPLE.com/de/1", "http://example.org/fr/", "ftp://org/fr/x#y", "x://y://z/p?q", "http://h#/frag", "http://h?/q", "http://casino.other.org/win\nmore/p",
    "http://é.example.org/de/ß/" + "lang/" * 3000, "http://example.org/fr",
]


def _parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host) :])[0]


def _rule(host, path, rules):
    fits = [(len(r), -i, r, v) for i, (v, r) in enumerate(rules) for h, p in [r.split("/", 1)] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return max(fits)[2:] if fits else (None, None)


def test_url_rules_and_parts(spark):
    rules = (*urls.RULES, ("allow", "a.b.example.com/d"), ("block", "b.example.com/de/"))
    rows = [(k, u, None, "h", 1, None, 2) for k, u in enumerate([*URLS, URLS[4]])] + [(None, URLS[5], None, None, None, None, None)]
    model = urls.train(urls.seeds(spark))
    pages = spark.createDataFrame(rows, PAGES)
    got = urls.judge(pages, model, rules).collect()
    own = {r.page_id: r.v for r in pages.select("page_id", (urls.score_of(*urls.host_and_path(F.col("url")), model) > 0).alias("v")).collect()}
    want = []
    for i, u, *_ in rows:
        host, path = _parts(u)
        rule, verdict = _rule(host, path, rules)
        want.append((i, host, path, rule, verdict or ("block" if own[i] else "allow")))
    assert Counter(map(tuple, got)) == Counter(want)
    assert urls.judge(spark.createDataFrame([], PAGES), model).count() == 0


def test_url_model_equals_gradient_steps_on_weights(spark):
    """The fold over inner products is plain gradient descent on the weights of the buckets."""
    import math

    labelled = spark.createDataFrame([("http://win.test/casino", 1), ("http://casino.test/", 1), ("http://library.test/en", 0), ("http://news.test/en/1", 0), (None, 1), ("http://x.test/", None), ("", 0)], "url string, label int")
    model = urls.train(labelled, steps=20).first()
    rows = sorted((u, y, set(b)) for u, y, b in labelled.where("url IS NOT NULL AND label IS NOT NULL").select("url", "label", urls.buckets(*urls.host_and_path(F.col("url")))).collect())
    w, bias = Counter(), 0.0
    for _ in range(20):
        error = [y - 1 / (1 + math.exp(-(sum(w[b] for b in x) / math.sqrt(max(len(x), 1)) + bias))) for _, y, x in rows]
        for b in w:
            w[b] *= 1 - urls.RATE * urls.DECAY
        bias *= 1 - urls.RATE * urls.DECAY
        for e, (_, _, x) in zip(error, rows):
            bias += urls.RATE * e
            for b in x:
                w[b] += urls.RATE * e / math.sqrt(len(x))
    assert model.bias == pytest.approx(bias * 1e9, abs=5)
    assert len(model.weights) == urls.DIMS and all(v == pytest.approx(w[b] * 1e9, abs=len(rows)) for b, v in enumerate(model.weights))


def test_url_model_on_unseen_hosts_and_without_labels(spark):
    model = urls.train(urls.seeds(spark))
    unseen = [("http://grand-casino-club.test/en/2", "block"), ("https://cheap-pills24.test/en/9", "block"), ("https://adult-chat.test/de/1", "block"), ("http://blog.gardens.test/en/tulips", "allow"), ("https://www.libraries.test/en/opening", "allow"), ("http://encyclopedias.test/fr/4", "allow")]
    pages = spark.createDataFrame([(k, u, None, None, None, None, None) for k, (u, _) in enumerate(unseen)], PAGES)
    assert [r.verdict for r in urls.judge(pages, model).orderBy("page_id").collect()] == [v for _, v in unseen]
    none = urls.train(urls.seeds(spark).where("false"))
    assert {r.verdict for r in urls.judge(pages, none).collect()} == {"allow"}
    assert urls.train(urls.seeds(spark), max_rows=1).first().bias != 0


VECTORS = "vec_id long, embedding array<float>, label int, key long, x string, score int"


def _vectors(seed, spread):
    r = random.Random(seed)
    rows = [(k, [r.choice(spread) for _ in range(4)], r.randint(0, 9), 1, "x", 1) for k in range(160)]
    rows += [rows[0], rows[50], (50, [1.0, 0.0, 0.5, 0.5], 3, 1, "x", 1), (None, [1.0, 1.0, 1.0, 1.0], 4, 1, None, None), (None, [1.0, 1.0, 1.0, 1.0], 5, 1, None, None)]
    rows += [(1000, None, 1, 1, "x", 1), (1050, [1.0, None, 1.0, 1.0], 1, 1, "x", 1), (1100, [float("nan")] * 4, 1, 1, "x", 1), (1150, [float("inf"), 1.0, 1.0, 1.0], 1, 1, "x", 1), (1200, [1.0] * 4, None, 1, "x", 1)]
    return [*rows, (2000, [], 2, 1, "x", 1), (2050, [0.75, 0.25], 2, 1, "x", 1), (2051, [0.5], 2, 1, "x", 1), (1, [-0.001, 0.999, 1.0, 0.5], 6, 1, "x", 1)]


def _mined(rows, every=50, positives=5, negatives=3, lower=50, upper=95):
    import math

    live = []
    for i, x, label, *_ in rows:
        if label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        live.append((i, label, [math.floor(256 * v) for v in x]))
    order = lambda p: (-p[1], p[0] is None, p[0] or 0)
    out = Counter()
    for a, (i, label, x) in enumerate(live):
        if i is None or i % every:
            continue
        each = [(j, sum(p * q for p, q in zip(x, y)), other) for b, (j, other, y) in enumerate(live) if b != a]
        for j, s, _ in sorted((e for e in each if e[2] == label), key=order)[:positives]:
            hard = sorted((e for e in each if e[2] != label and lower * s <= 100 * e[1] <= upper * s), key=order)[:negatives]
            out.update((i, j, rank, k, s, t) for rank, (k, t, _) in enumerate(hard, 1))
    return out


@pytest.mark.parametrize("spread", [(0.0, 0.25, 0.5, 1.0, -0.3), (0.1, 3.0e6, 1.5e6, -2.0e5), (0.01, 0.02, 0.033)])
@pytest.mark.parametrize("block, task, held", [(2048, 1 << 17, 1 << 14), (7, 40, 1)])
def test_hard_negatives(spark, monkeypatch, spread, block, task, held):
    import numpy as np

    monkeypatch.setattr(negatives, "HELD", held)
    single = lambda rows: [(i, x and [None if v is None else float(np.float32(v)) for v in x], *more) for i, x, *more in rows]
    rows = single(_vectors(len(spread), spread))
    got = negatives.hard_negatives(spark.createDataFrame(rows, VECTORS).repartition(3), block_rows=block, task_rows=task).collect()
    assert Counter(map(tuple, got)) == _mined(rows) and got


def test_hard_negatives_of_nothing(spark):
    assert negatives.hard_negatives(spark.createDataFrame([], VECTORS)).count() == 0
    assert negatives.hard_negatives(spark.createDataFrame([(0, [1.0], 1, 1, "", 1)], VECTORS)).count() == 0


def test_scores_are_exact_beyond_doubles():
    import numpy as np

    a, b = np.array([[2.0**40 + 1, 3.0]]), np.array([[2.0**40 - 1, 5.0], [1.0, 2.0]])
    assert negatives.scores(a, b, float(2**41) ** 2).tolist() == [[(2**40 + 1) * (2**40 - 1) + 15, 2**40 + 7]]
