"""Personal data: exact patterns, and a character-level bidirectional LSTM with CRF transitions.

The patterns give the base spans.  The tagger, trained in numpy from labelled spans (sentences of made-up words with
written-out addresses and numbers, labelled as they are generated), adds spans of the same four kinds in shapes that the
patterns miss.  Every kind needs a digit, an at-sign or a bracketed "at", so the lattice admits tags only in windows
that hold one; other windows have the all-outside path alone and are not computed.  Windows overlap; a character takes
its emissions from the window in which it lies deepest, and one Viterbi path is decoded over each run of joined windows.

Null and empty texts have no spans.  Texts of any length are read whole.  Repeated rows give repeated result rows and an
empty table an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

KINDS = ("email", "ip", "card", "phone")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a number's start inside a run of digits matches only if the run's start does: the look-behind keeps the scan linear
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the patterns' spans, by start, then kind."""
    out = []
    at, end = text.find("@"), 0
    while at >= 0:
        lo = at
        while lo > end and text[lo - 1] in _LOCAL:
            lo -= 1
        m = _DOMAIN.match(text, at + 1) if lo < at else None
        if m:
            out.append((lo, 0, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def span_text(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


# ---- the tagger -------------------------------------------------------------------------------------------------

TAGS = 9  # outside, then begin and inside of each kind
WINDOW, STEP = 96, 64
_SIGNS = "@._-+%()[]{}:/, \n"
SYMBOLS = 26 + 1 + len(_SIGNS) + 2
_TRIGGER = re.compile(r"[0-9@\[({]")
_BRACKETED = re.compile(r"[\[({] ?[aA][tT] ?[\])}]")


def _symbol_table() -> np.ndarray:
    t = np.full(0x250, SYMBOLS - 1, np.uint8)
    for c in range(0x250):
        ch = chr(c)
        if "a" <= ch.lower() <= "z" and len(ch.lower()) == 1:
            t[c] = ord(ch.lower()) - 97
        elif "0" <= ch <= "9":
            t[c] = 26
        elif ch in _SIGNS:
            t[c] = 27 + _SIGNS.index(ch)
        elif ch.isalpha():
            t[c] = SYMBOLS - 2
    return t


_TABLE = _symbol_table()


def symbols(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _TABLE[np.minimum(codes, len(_TABLE) - 1)]


def _sigmoid(x):
    return 0.5 + 0.5 * np.tanh(0.5 * x)


class Tagger:
    """Bidirectional LSTM with a linear-chain CRF over its outputs."""

    def __init__(self, hidden: int = 16, seed: int = 7):
        r = np.random.default_rng(seed)
        h = self.hidden = hidden
        put = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {"xf": put(SYMBOLS, 4 * h), "xb": put(SYMBOLS, 4 * h), "hf": put(h, 4 * h), "hb": put(h, 4 * h), "o": put(2 * h, TAGS), "ob": np.zeros(TAGS, np.float32), "a": np.zeros((TAGS, TAGS), np.float32)}
        for k in ("xf", "xb"):
            self.p[k][:, h : 2 * h] += 1.0

    def _run(self, ids, way, keep=False):
        """Hidden states (steps, batch, hidden) in one direction; with ``keep`` also what backpropagation needs."""
        h, wx, wh = self.hidden, self.p["x" + way], self.p["h" + way]
        order = range(len(ids)) if way == "f" else range(len(ids) - 1, -1, -1)
        state = cell = np.zeros((ids.shape[1], h), np.float32)
        out, saved = np.empty((len(ids), ids.shape[1], h), np.float32), {}
        for t in order:
            z = wx[ids[t]] + state @ wh
            gates = _sigmoid(z[:, : 3 * h])
            g = np.tanh(z[:, 3 * h :])
            i, f, o = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :]
            before, prior = cell, state
            cell = f * cell + i * g
            tc = np.tanh(cell)
            state = o * tc
            out[t] = state
            if keep:
                saved[t] = (gates, g, before, prior, tc)
        return (out, saved) if keep else out

    def emissions(self, ids) -> np.ndarray:
        """(steps, batch, tags) of symbol numbers (steps, batch)."""
        h = self.hidden
        return self._run(ids, "f") @ self.p["o"][:h] + self._run(ids, "b") @ self.p["o"][h:] + self.p["ob"]

    def _back(self, ids, way, saved, d_out, grads):
        h, wh = self.hidden, self.p["h" + way]
        order = range(len(ids) - 1, -1, -1) if way == "f" else range(len(ids))
        dh = dc = np.zeros((ids.shape[1], h), np.float32)
        every = np.empty((*ids.shape, 4 * h), np.float32)
        for t in order:
            gates, g, before, prior, tc = saved[t]
            i, f, o = gates[:, :h], gates[:, h : 2 * h], gates[:, 2 * h :]
            dh = dh + d_out[t]
            dc = dc + dh * o * (1 - tc * tc)
            dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
            every[t] = dz
            grads["h" + way] += prior.T @ dz
            dh, dc = dz @ wh.T, dc * f
        grads["x" + way] += (ids.reshape(-1, 1) == np.arange(SYMBOLS)).astype(np.float32).T @ every.reshape(-1, 4 * h)

    def step(self, ids, tags) -> tuple[float, dict]:
        """Mean loss and gradients: CRF likelihood by forward and backward sums, then through the LSTMs."""
        h, n, batch = self.hidden, *ids.shape
        hf, sf = self._run(ids, "f", True)
        hb, sb = self._run(ids, "b", True)
        both = np.concatenate([hf, hb], 2)
        e, a = both @ self.p["o"] + self.p["ob"], self.p["a"]
        lse = lambda x, axis: (m := x.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(x - m).sum(axis))
        al, be = np.empty_like(e), np.zeros_like(e)
        al[0] = e[0]
        for t in range(1, n):
            al[t] = e[t] + lse(al[t - 1][:, :, None] + a, 1)
        for t in range(n - 2, -1, -1):
            be[t] = lse(a + (e[t + 1] + be[t + 1])[:, None, :], 2)
        z = lse(al[-1], 1)
        b = np.arange(batch)
        gold = e[np.arange(n)[:, None], b, tags].sum(0) + a[tags[:-1], tags[1:]].sum(0)
        de = np.exp(al + be - z[None, :, None])
        de[np.arange(n)[:, None], b, tags] -= 1
        pair = np.exp(al[:-1, :, :, None] + a + (e[1:] + be[1:])[:, :, None, :] - z[None, :, None, None]).sum((0, 1))
        np.add.at(pair, (tags[:-1].ravel(), tags[1:].ravel()), -1)
        de /= batch
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        grads["a"] = (pair / batch).astype(np.float32)
        flat = de.reshape(-1, TAGS)
        grads["o"], grads["ob"] = both.reshape(-1, 2 * h).T @ flat, flat.sum(0)
        back = de @ self.p["o"].T
        self._back(ids, "f", sf, back[:, :, :h], grads)
        self._back(ids, "b", sb, back[:, :, h:], grads)
        return float((z - gold).mean()), grads

    def transitions(self) -> np.ndarray:
        """CRF transitions with those that cannot be (inside without its begin) shut."""
        a = self.p["a"].copy()
        for k in range(4):
            inside = 2 + 2 * k
            shut = np.ones(TAGS, bool)
            shut[[inside - 1, inside]] = False
            a[shut, inside] = -1e4
        return a


def viterbi(e: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Best path of one sequence (steps, tags); inside tags cannot start it."""
    score = e[0].copy()
    score[2::2] = -1e4
    back = np.empty(e.shape, np.int8)
    for t in range(1, len(e)):
        s = score[:, None] + a
        back[t] = s.argmax(0)
        score = s.max(0) + e[t]
    path = np.empty(len(e), np.int8)
    path[-1] = score.argmax()
    for t in range(len(e) - 1, 0, -1):
        path[t - 1] = back[t][path[t]]
    return path


def labelled_sentence(r: np.random.Generator, length: int = WINDOW) -> tuple[str, np.ndarray]:
    """A window of made-up text with labelled spans, and its tags."""
    syllables = ("the", "er", "ing", "on", "ou", "st", "tion", "en", "die", "sch", "que", "ez", "ción", "ment", "é", "ß", "ble", "nd", "la", "of", "Es", "An")
    pick = lambda n: int(r.random() * n)
    word = lambda: "".join(syllables[pick(len(syllables))] for _ in range(1 + pick(3)))
    digits = lambda n: "".join(map(str, r.integers(0, 10, n)))

    def email():
        name, host = word() + r.choice(["", ".", "_"]) + r.choice([word(), digits(2)]), r.choice(["mail", word()]) + r.choice(["", digits(1)])
        at, dot = [("@", "."), (" [at] ", " [dot] "), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" (at) ", "."), (" [at] ", ".")][r.choice(6, p=[0.4, 0.15, 0.15, 0.1, 0.1, 0.1])]
        return f"{name}{at}{host}{dot}{r.choice(['example', word()])}{dot}{r.choice(['com', 'org', 'de', 'fr'])}".replace("é", "e").replace("ß", "s").replace("ó", "o")

    def phone():
        a, b, c = digits(3), digits(3), digits(4)
        return [f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+49 {a} {b}{c}", f"0{a} {b} {c}", f"00{digits(2)} {a} {b} {c}"][r.integers(7)]

    def ip():
        parts = [str(r.integers(0, 256)) for _ in range(4)]
        return [".".join(parts), "[.]".join(parts), ".".join(parts) + ":" + digits(4)][r.choice(3, p=[0.6, 0.3, 0.1])]

    def card():
        d = "4" + digits(14)
        d += next(x for x in "0123456789" if luhn(d + x))
        return [d, " ".join(d[i : i + 4] for i in range(0, 16, 4)), "-".join(d[i : i + 4] for i in range(0, 16, 4)), ".".join(d[i : i + 4] for i in range(0, 16, 4))][r.integers(4)]

    plain = [lambda: digits(r.integers(1, 6)), lambda: f"{digits(4)}-{digits(2)}-{digits(2)}", lambda: f"{digits(2)}.{digits(2)}.{digits(4)}", lambda: f"{digits(1)}.{digits(1)}.{digits(2)}", lambda: f'token = "{hashlib.md5(digits(6).encode()).hexdigest()}"', lambda: f"${digits(3)}.{digits(2)}", lambda: f"(c) {digits(4)}", lambda: f"v{digits(1)}.{digits(1)}", lambda: f"@{word()}", lambda: f"{digits(2)}:{digits(2)}", lambda: digits(r.integers(8, 30))]
    kinds = (email, ip, card, phone)
    text, tags = "", []
    while len(text) < length + 40:
        x = r.random()
        k = int(r.integers(4)) if x < 0.12 else None
        piece = kinds[k]() if k is not None else plain[r.integers(len(plain))]() if x < 0.22 else word() + ("" if x < 0.8 else r.choice([",", ".", ".\n", "###", " |", ":"]))
        tags += [0] * len(piece) if k is None else [1 + 2 * k] + [2 + 2 * k] * (len(piece) - 1)
        text += piece + " "
        tags.append(0)
    lo = int(r.integers(0, 40))
    out = np.array(tags[lo : lo + length], np.int8)
    if out[0] and out[0] % 2 == 0:  # cut inside a span: its begin is not in the window
        out[0] -= 1
    return text[lo : lo + length], out


@functools.lru_cache(2)
def trained(steps: int = 260, batch: int = 48, hidden: int = 16, seed: int = 7) -> Tagger:
    """The tagger, trained once in a process; always the same for the same parameters."""
    r = np.random.default_rng(seed)
    tagger = Tagger(hidden, seed)
    m = {k: np.zeros_like(v) for k, v in tagger.p.items()}
    v = {k: np.zeros_like(x) for k, x in tagger.p.items()}
    for t in range(1, steps + 1):
        pairs = [labelled_sentence(r) for _ in range(batch)]
        ids, tags = np.stack([symbols(x) for x, _ in pairs], 1), np.stack([y for _, y in pairs], 1)
        _, g = tagger.step(ids, tags)
        norm = np.sqrt(sum(float((x * x).sum()) for x in g.values()))
        rate = 0.02 * min(1.0, 2.0 * (1 - t / (steps + 1)))
        for k in g:
            x = g[k] * min(1.0, 20.0 / (norm + 1e-9))
            m[k] = 0.9 * m[k] + 0.1 * x
            v[k] = 0.999 * v[k] + 0.001 * x * x
            tagger.p[k] = (tagger.p[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    return tagger


def _windows(text: str) -> list[int]:
    """Numbers of the windows (window i covers STEP * i to STEP * i + WINDOW) that hold a trigger."""
    hits, last = [], -1
    for m in _TRIGGER.finditer(text):
        s = m.start()
        if text[s] in "[({" and not _BRACKETED.match(text, s):
            continue
        for i in range(max(last + 1, (s - WINDOW) // STEP + 1, 0), s // STEP + 1):
            hits.append(i)
            last = i
    return hits


def tag_texts(texts: list[str], tagger: Tagger, batch: int = 2048) -> list[list[tuple[int, int, int]]]:
    """Spans of each text by the tagger, (start, kind number, end)."""
    work = [(i, w) for i, t in enumerate(texts) for w in _windows(t)]
    out: list[list] = [[] for _ in texts]
    if not work:
        return out
    a = tagger.transitions()
    ids = np.full((len(work), WINDOW), SYMBOLS - 1, np.uint8)
    for row, (i, w) in zip(ids, work):
        s = symbols(texts[i][w * STEP : w * STEP + WINDOW])
        row[: len(s)] = s
    emissions = np.concatenate([tagger.emissions(ids[k : k + batch].T).transpose(1, 0, 2) for k in range(0, len(work), batch)])
    k = 0
    while k < len(work):
        i, first = work[k]
        n = 1
        while k + n < len(work) and work[k + n] == (i, first + n):
            n += 1
        size = min(len(texts[i]) - first * STEP, (n - 1) * STEP + WINDOW)
        e = np.empty((size, TAGS), np.float32)
        half = (WINDOW - STEP) // 2
        for j in range(n):  # a character is taken from the window in which it lies deepest
            lo, hi = j * STEP + half * (j > 0), min(size, j * STEP + (STEP + half if j < n - 1 else WINDOW))
            e[lo:hi] = emissions[k + j, lo - j * STEP : hi - j * STEP]
        path = viterbi(e, a)
        for at in np.flatnonzero(path % 2 == 1):
            end, inside = int(at) + 1, path[at] + 1
            while end < size and path[end] == inside:
                end += 1
            out[i].append((first * STEP + int(at), int(path[at]) // 2, first * STEP + end))
        k += n
    return out


_AT = re.compile(r"@|[\[({] ?at ?[\])}]", re.I)


def plausible(kind: int, found: str) -> bool:
    """Whether a tagged string has what its kind needs."""
    digits = "".join(c for c in found if "0" <= c <= "9")
    if found != found.strip():
        return False
    if kind == 0:
        return bool(_AT.search(found)) and (m := re.search(r"\.|[\[({] ?dot ?[\])}]", found, re.I)) is not None and 0 < m.start() < len(found) - 1
    if kind == 1:
        parts = re.findall("[0-9]+", found)
        return len(parts) in (4, 5) and all(len(p) <= 3 and int(p) <= 255 for p in parts[:4])
    if kind == 2:
        return 14 <= len(digits) <= 19 and luhn(digits)
    return 10 <= len(digits) <= 15 and not re.search("[A-Za-z]", found)


def all_spans(texts: list[str], tagger: Tagger) -> list[tuple[list, list]]:
    """(base, all) spans of each text; the tagger's spans never touch a base span."""
    out = []
    for text, added in zip(texts, tag_texts(texts, tagger)):
        base = base_spans(text)
        more = [s for s in added if plausible(s[1], text[s[0] : s[2]]) and not any(s[0] < e and b < s[2] for b, _, e in base)]
        out.append((base, sorted(base + more)))
    return out


def _batches_of(rows, chars: int = 1 << 20):
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += len(row[1] or "")
        if total > chars:
            yield held
            held, total = [], 0
    if held:
        yield held


def find_pii(docs: DataFrame) -> DataFrame:
    """Counts and digest of the base spans and all spans of every document."""
    tagger = trained()

    def run(rows):
        for held in _batches_of(rows):
            for (doc_id, _), (base, spans) in zip(held, all_spans([t or "" for _, t in held], tagger)):
                counts = [sum(k == n for _, k, _ in base) for n in range(4)]
                yield doc_id, *counts, hashlib.sha256(span_text(base).encode()).hexdigest(), span_text(spans)

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long,n_email long,n_ip long,n_card long,n_phone long,base_sha256 string,spans string")


def mask_text(text: str, spans) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans are masked as one, by the first's kind."""
    out, at = [], 0
    for s, k, e in spans:
        if s >= at:
            out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def mask_documents(docs: DataFrame) -> DataFrame:
    """The documents with personal data masked; columns as given, ``n_chars`` kept in step."""
    import pyarrow as pa

    tagger, columns = trained(), docs.columns

    def run(batches):
        for b in batches:
            texts = b.column(columns.index("text")).to_pylist()
            spans = all_spans([t or "" for t in texts], tagger)
            texts = [None if t is None else mask_text(t, s) for t, (_, s) in zip(texts, spans)]
            put = {"text": texts, "n_chars": [None if t is None else len(t) for t in texts]}
            yield pa.RecordBatch.from_arrays([pa.array(put[c], b.schema.field(i).type) if c in put else b.column(i) for i, c in enumerate(columns)], schema=b.schema)

    return docs.mapInArrow(run, docs.schema)
