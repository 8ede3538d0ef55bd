"""Toxicity by a counterfactual-regularised classifier.

A logistic model over hashed words is fitted on at most ``max_rows`` labelled rows (those with the smallest hash of the
id; the bound is the parameter).  Every training sentence with an identity term is paired with the sentence in which the
term is swapped for others of its group, and the squared change of the score's logit is penalised, so that a neutral
mention of a group does not move the score.  Scoring reads whole texts and nothing but the text.

Null and empty texts get the score of the bias alone.  Labels that are null are not learnt from; of a repeated label
row one counts.  With no toxic row to learn from every score is near 0.  An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_fold, crc_fold_col, map_rows, materialize, utf8

#: Identity terms by group; a term is swapped for the others of its group.
IDENTITY = (
    ("women", "men", "girls", "boys"), ("woman", "man", "girl", "boy"), ("female", "male"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"), ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "african", "european", "latino"), ("gay", "straight", "lesbian", "transgender", "bisexual"),
    ("immigrants", "refugees", "foreigners", "natives"), ("immigrant", "refugee", "foreigner", "native"),
    ("frauen", "männer"), ("frau", "mann"), ("muslime", "christen", "juden"), ("femmes", "hommes"), ("femme", "homme"),
    ("musulmans", "chrétiens", "juifs"), ("mujeres", "hombres"), ("mujer", "hombre"), ("musulmanes", "cristianos", "judíos"),
)
DIMENSIONS = 1 << 18
MAX_ROWS = 20_000
PREFIXES = (5, 7)
MODULUS, HELD_OUT = 5, 0
_EDGE = ".,;:!?\"'()[]{}<>|*#&%$-_/\\«»„“”¿¡"
_SWAPS = {term: [t for t in group if t != term] for group in IDENTITY for term in group}


def words_of(text) -> set[str]:
    """Distinct words, A-Z lower-cased, without punctuation at the edges."""
    return {w for w in (x.strip(_EDGE) for x in set((text or "").lower().split())) if w}


def feature(word: str) -> int:
    return xxhash.xxh3_64_intdigest(utf8(word)) & (DIMENSIONS - 1)


def features_of(words) -> list[int]:
    """Features of distinct words: each word, and its first 5 and 7 characters where it is longer."""
    return [feature(p) for w in sorted(words) for p in forms(w)]


def forms(word: str) -> list[str]:
    return [word] + [f"{word[:n]}~" for n in PREFIXES if len(word) >= n]


def _training(rows):
    """(doc_id, label, features, features of each counterfactual flattened with its ends)."""
    for doc_id, text, label in rows:
        words = words_of(text)
        swaps, ends = [], []
        for term in sorted(words & _SWAPS.keys()):
            for other in _SWAPS[term]:
                swaps += features_of((words - {term}) | {other})
                ends.append(len(swaps))
        yield doc_id, int(label), features_of(words), swaps, ends


class Model:
    """Logistic weights over the hashed features of a text's distinct words."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias, self.cache = weights, bias, {}

    def logit(self, text) -> float:
        cache, hit = self.cache, {}
        if len(cache) > 400_000:
            cache.clear()
        for w in set((text or "").lower().split()):
            v = cache.get(w)
            if v is None:
                s = w.strip(_EDGE)
                v = cache[w] = s, sum(float(self.weights[feature(f)]) for f in forms(s)) if s else 0.0
            if v[1]:
                hit[v[0]] = v[1]
        return sum(hit.values()) + self.bias

    def score(self, text) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.logit(text), -30, 30))))


def weighted_features(df: np.ndarray, pos: np.ndarray, base: float, min_rows: int = 5, evidence: float = 7.0) -> np.ndarray:
    """Which features get a weight, from the rows and toxic rows that have each.

    Those of fewer than ``min_rows`` rows, or whose rows differ from the base rate by less than ``evidence`` standard
    errors, get none: thousands of chance weights would sum to noise on long texts.  Identity terms are kept.
    """
    z = (pos - df * base) / np.sqrt(np.maximum(df, 1) * max(base * (1 - base), 1e-9))
    used = (df >= min_rows) & (np.abs(z) >= evidence)
    identity = np.array([feature(w) for w in _SWAPS], np.int64)
    used[identity] |= df[identity] > 0
    return used


def fit(rows: list[tuple], used: np.ndarray, penalty: float = 1.0, l2: float = 2e-5, steps: int = 500) -> Model:
    """Fit the used weights by Adam on logistic loss + ``penalty`` x squared logit change under each swap + L2."""
    if not rows or not any(r[0] for r in rows):
        return Model(np.zeros(DIMENSIONS, np.float32), -30.0)
    y = np.array([r[0] for r in rows], float)
    base = y.mean()
    bags = [np.array(r[1], np.int64) for r in rows]
    place = np.cumsum(used) - 1
    k = int(used.sum())

    def matrix(lists):
        r = np.concatenate([np.full(len(s), i) for i, s in enumerate(lists)]) if lists else np.empty(0)
        c = np.concatenate(lists) if lists else np.empty(0)
        r, c = r.astype(np.int64), c.astype(np.int64)
        on = used[c]
        return r[on], place[c[on]]

    rr, cc = matrix(bags)
    pairs = []
    for i, r in enumerate(rows):
        lo = 0
        for hi in r[3]:
            pairs.append((i, np.array(r[2][lo:hi], np.int64)))
            lo = hi
    src = np.array([p[0] for p in pairs], np.int64)
    pr, pc = matrix([p[1] for p in pairs])
    w, b = np.zeros(k), float(np.log(base / (1 - base + 1e-9)))
    m, v = np.zeros(k + 1), np.zeros(k + 1)
    for t in range(1, steps + 1):
        logit = np.bincount(rr, w[cc], len(rows)) + b
        e = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) / len(rows)
        g = np.bincount(cc, e[rr], k) + l2 * w
        if len(pairs):
            d = 2 * penalty * (logit[src] - b - np.bincount(pr, w[pc], len(pairs))) / len(rows)
            back = np.bincount(src, d, len(rows))
            g += np.bincount(cc, back[rr], k) - np.bincount(pc, d[pr], k)
        grad = np.append(g, e.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        w, b = w - step[:k], b - step[k]
    weights = np.zeros(DIMENSIONS, np.float32)
    weights[np.flatnonzero(used)] = w
    return Model(weights, float(b))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, penalty: float = 1.0) -> Model:
    """Fit on at most ``max_rows`` labelled rows outside the held-out fold; ``penalty`` weighs the change under swaps."""
    chosen = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (crc_fold_col(F.col("doc_id"), MODULUS) != HELD_OUT))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    )
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic")
    rows = map_rows(sample, _training, "doc_id long,label int,features array<int>,swaps array<int>,ends array<int>")
    # one row an id, also where ids repeat: the bound holds
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("label", "features", "swaps", "ends")).alias("r")).select("r.*")
    rows = materialize(rows, "toxicity-rows")
    n, positive = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not positive:
        return fit([], np.zeros(DIMENSIONS, bool))
    # at most DIMENSIONS counts reach the driver, and then of each row only the features that get a weight
    counts = rows.select("label", F.explode(F.array_distinct("features")).alias("f")).groupBy("f").agg(F.count("*").alias("n"), F.sum("label").alias("p")).toArrow()
    df, pos = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)
    at = counts["f"].to_numpy()
    df[at], pos[at] = counts["n"].to_numpy(), counts["p"].to_numpy()
    used = weighted_features(df, pos, positive / n)
    kept = np.flatnonzero(used)

    def narrow(it):
        on = np.zeros(DIMENSIONS, bool)
        on[kept] = True
        for label, features, swaps, ends in it:
            f, s = np.array(features, np.int64), np.array(swaps, np.int64)
            hold = on[s]
            yield label, f[on[f]].tolist(), s[hold].tolist(), np.concatenate([[0], np.cumsum(hold)])[ends].tolist() if ends else []

    got = map_rows(rows, narrow, "label int,features array<int>,swaps array<int>,ends array<int>").toArrow()
    return fit(sorted(zip(*(c.to_pylist() for c in got.columns))), used, penalty)


def toxicity_scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    weights, bias = model.weights, model.bias
    at = np.flatnonzero(weights)
    sparse = (at, weights[at])

    def score(rows):
        full = np.zeros(DIMENSIONS, np.float32)
        full[sparse[0]] = sparse[1]
        m = Model(full, bias)
        for doc_id, text in rows:
            s = m.score(text)
            yield doc_id, crc_fold(doc_id, MODULUS) == HELD_OUT, s, int(s >= 0.5)

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), score, "doc_id long,held_out boolean,score double,predicted int")
