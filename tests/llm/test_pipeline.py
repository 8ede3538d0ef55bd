"""The pipeline on the smallest tables against a plain version of each stage's promise."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pytest
from veridex.llm import pii, quality
from veridex.llm.common import read_documents

SF = "/root/testdata/sf0.001"


def test_stages_keep_their_promises(spark):
    docs = read_documents(spark, SF)
    columns = docs.columns
    before = {r.doc_id: r.text for r in docs.collect()}
    after = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns
        after.append({r.doc_id: r.text for r in docs.collect()})
        assert all(r.n_chars == len(r.text) for r in docs.collect())
    judged, single, cut, masked = after
    for i, t in before.items():
        n, _, _, _, repeated = quality.base_features(t)
        assert (i in judged) == (not (n < 20 or 100 * repeated > 30 * n))
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, t in judged.items() if (w := t.encode().lower().split())}
    for i in set(judged) - set(single):
        assert any(j < i and 100 * len(sets[i] & sets[j]) >= 50 * len(sets[i] | sets[j]) for j in sets if j != i)
    for i in single:
        assert not any(j != i and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) for j in single)
    assert cut.keys() == single.keys() == masked.keys()
    grams = Counter(t.encode()[k : k + 100] for t in cut.values() for k in range(len(t.encode()) - 99))
    source = [t.encode() for t in single.values()]
    for g, n in grams.items():  # what repeats after the cut was made by the cut
        assert n == 1 or sum(s.count(g) for s in source) <= 1
    for i, t in masked.items():
        assert "[EMAIL]" in t or not any(k == 0 for _, k, _ in pii.base_spans(cut[i]))


def test_run_packs_everything(spark):
    out = corpus_pipeline.run(spark, SF).collect()
    assert out and len({(r.doc_id, r.start) for r in out}) == len(out)


def _prose(r, n):
    return " ".join("".join(r.choice(("ba", "ko", "the", "ing", "é", "st", "mu", "ri", "lo")) for _ in range(r.randint(1, 4))) for _ in range(n))


def _rows():
    r = random.Random(11)
    common = "This line stands on every page of this host and is no text of its own"
    texts = [f"{common}\n{_prose(r, 60)}" for _ in range(30)] + [f"{common}\n{_prose(r, 3)}" for _ in range(3)]
    texts += [_prose(r, 80) for _ in range(6)] + ["", None, "  ", "too short"]
    passage = _prose(r, 40)
    texts += [f"{_prose(r, 40)} {passage} {_prose(r, 30)}" for _ in range(3)]
    long = _prose(r, 300).split(" ")
    texts += [" ".join(long), " ".join([*long[:150], "changed", *long[151:]]), " ".join(long)]
    texts += [f"{_prose(r, 30)} write to jo.doe@mail.example.com or 10.0.0.1 {_prose(r, 10)}"]
    out = [(i, t, "en", "h" if i < 40 else None, None if t is None else len(t), 1, "k", "d") for i, t in enumerate(texts)]
    return [*out, out[34], (None, out[35][1], "en", "h", 1, 2, None, None), (36, _prose(r, 50), "en", "h", 1, 3, None, None), (None, _prose(r, 50), "en", None, 1, 4, None, None)]


def test_stages_equal_brute_force(spark):
    """Nulls, empty and repeated rows, repeated and null ids, and columns of clashing names, stage by stage."""
    rows = _rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _key int, key string, d string").repartition(3)
    stage = {name: f for name, f in corpus_pipeline.STAGES}
    order = lambda x: (x[0] is None, x[0] or 0, x[1] or "")
    pairs = lambda df: sorted(((x.doc_id, x.text) for x in df.collect()), key=order)

    # quality rules: base rule, lines above both limits, depletion
    lines, hosts = defaultdict(set), defaultdict(set)
    for _, t, _, h, *_ in rows:
        hosts[h or ""].add(t or "")
        for x in (t or "").split("\n"):
            if x.split():
                lines[h or "", quality.normalise(x)].add(t)
    gone = {k for k, ts in lines.items() if len(ts) > quality.MIN_DOCS and len(ts) > quality.MAX_SHARE * len(hosts[k[0]])}
    want = []
    for i, t, _, h, *_ in rows:
        n, _, _, _, repeated = quality.base_features(t or "")
        keep = [x for x in (t or "").split("\n") if (h or "", quality.normalise(x)) not in gone]
        left = sum(len(x.encode().split()) for x in keep)
        if not (n < 20 or 100 * repeated > 30 * n) and not left < quality.MIN_KEPT * n:
            want.append((i, "\n".join(keep)))
    judged = stage["quality_rules"](spark, docs, SF).cache()
    assert judged.columns == docs.columns and pairs(judged) == sorted(want, key=order) and gone and len(want) < len(rows)

    # near duplicates: one document of each component of similarity 0.8 over five-word shingles
    docs_in = sorted(set(want), key=order)
    sets = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for _, t in docs_in for w in [t.encode().lower().split()]]
    root = list(range(len(docs_in)))
    for a in range(len(docs_in)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                old, new = root[a], root[b]
                root = [new if x == old else x for x in root]
    groups = defaultdict(list)
    for x, g in zip(docs_in, root):
        groups[g].append(x)
    single = stage["ngram_jaccard_join"](spark, judged, SF).cache()
    got = pairs(single)
    assert len(got) == len(groups) and all(sum(x in g for x in got) == 1 for g in groups.values())
    assert all(min(g, key=order)[0] == next(x for x in got if x in g)[0] for g in groups.values())

    # repeated strings of 100 bytes go from the later document
    cut = stage["suffix_array_dedup"](spark, single, SF).cache()
    seen, kept = set(), []
    for i, t in got:
        raw = t.encode()
        starts = range(len(raw) - 99)
        gone_bytes = set()
        for s in starts:
            if raw[s : s + 100] in seen:
                gone_bytes.update(range(s, s + 100))
            seen.add(raw[s : s + 100])
        kept.append((i, bytes(x for k, x in enumerate(raw) if k not in gone_bytes).decode("utf-8", "ignore")))
    assert pairs(cut) == sorted(kept, key=order) and kept != got

    # personal data
    masked = stage["pii"](spark, cut, SF).cache()
    tagger = pii.trained()
    assert pairs(masked) == sorted(((i, pii.mask_text(t, pii.all_spans([t], tagger)[0][1])) for i, t in kept), key=order)
    assert any("[EMAIL]" in t and "[IP]" in t for _, t in pairs(masked))

    # packing: every id of every document once, in gapless sequences
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids = [np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4") for _, t in pairs(masked)]
    pieces = stage["packing"](spark, masked, SF).collect()
    assert sum(r.length for r in pieces) == sum(map(len, ids)) and max(r.sequence_id for r in pieces) == (sum(map(len, ids)) - 1) // 2048
    filled = sorted((r.sequence_id * 2048 + r.offset, r.length) for r in pieces)
    assert all(a + n == b for (a, n), (b, _) in zip(filled, filled[1:])) and filled[0][0] == 0
    wholes = Counter((len(x), zlib.crc32(x.tobytes())) for x in ids)
    alone = Counter((r.length, r.ids_crc32) for r in pieces if r.start == 0 and r.length == r.doc_tokens)
    assert not alone - wholes and sum(alone.values()) >= len(ids) - 1 - max(r.sequence_id for r in pieces)


def test_stages_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0 and corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 0
