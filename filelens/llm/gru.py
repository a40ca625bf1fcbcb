"""A bidirectional gated recurrent network with attention pooling, in numpy.

Inputs of a step are a word vector (words of the training sample; others share
one) joined with the mean vector of the word's hashed character trigrams.  A
document is cut into overlapping windows of words; a window's score is a
logistic of the attention-weighted states, a document's the greatest of its
windows'.  Training works on the window that decides a document's score.
"""

from __future__ import annotations

import io
import re
from collections import Counter

import numpy as np

WINDOW, STRIDE = 48, 32
WORD_DIM, CHAR_DIM, HIDDEN, ATTENTION, CHAR_ROWS = 8, 8, 8, 8, 4096
#: Words kept as inputs of their own: seen in so many training texts, at most so many words.
MIN_TEXTS, MAX_WORDS = 3, 20_000
#: Training: steps, and documents a step (all windows of each are looked at).
STEPS, BATCH = 400, 32
RATE, DECAY = 0.01, 1e-4
CACHE_WORDS = 150_000
#: Windows that the network works on at once when it scores.
WINDOWS_AT_ONCE = 2048

_find = re.compile(r"[^\W\d_]+").findall


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters; a text without any is one empty word."""
    return _find(text.lower()) if text and not text.isspace() and _find(text) else [""]


def windows_of(n: int) -> np.ndarray:
    """Starts of the windows that cover ``n`` words."""
    return np.arange(0, max(n - (WINDOW - STRIDE), 1), STRIDE)


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character trigrams of ``^word$``, one after the other, and how many each word has."""
    joined = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    lens = np.array([len(w) + 2 for w in words])
    h = (joined[:-2] * np.uint64(0x9E3779B1) + joined[1:-1] * np.uint64(0x85EBCA77) + joined[2:] * np.uint64(0xC2B2AE3D)) if len(joined) > 2 else joined[:0]
    h = ((h ^ (h >> np.uint64(15))) % np.uint64(CHAR_ROWS)).astype(np.int64)
    ends = np.cumsum(lens)
    inside = np.ones(len(joined), dtype=bool)
    inside[ends - 1] = inside[ends - 2] = False
    counts = lens - 2
    h = np.r_[h, 0, 0][: len(joined)][inside]
    if (counts == 0).any():  # the empty word "^$" gets one trigram of its own
        h = np.insert(h, (np.cumsum(counts) - counts)[counts == 0], 0)
        counts = np.maximum(counts, 1)
    return h, counts


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Network:
    """Parameters ``p`` (float32 arrays) and the word list they belong to."""

    def __init__(self, words: list[str], p: dict[str, np.ndarray]):
        self.p, self.words = p, words
        self.ids = {w: i + 1 for i, w in enumerate(words)}

    def inputs(self, words: list[str], tri: np.ndarray, counts: np.ndarray) -> np.ndarray:
        ids = np.array([self.ids.get(w, 0) for w in words], dtype=np.int64)
        chars = np.add.reduceat(self.p["E_c"][tri], np.cumsum(counts) - counts, axis=0) / counts[:, None].astype(np.float32)
        return np.concatenate([self.p["E_w"][ids], chars], axis=1)

    def states(self, table: np.ndarray, idx: np.ndarray, inside: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """States of direction ``d`` (f or b) at each step; ``table`` has a row of gate inputs for each word."""
        n, length = idx.shape
        h, out = np.zeros((n, HIDDEN), np.float32), np.empty((length, n, HIDDEN), np.float32)
        U = self.p["U_" + d]
        full = inside.all(axis=0)
        for t in range(length) if d == "f" else range(length - 1, -1, -1):
            a, u = table[idx[:, t]], h @ U
            zr = _sigmoid(a[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            c = np.tanh(a[:, 2 * HIDDEN :] + r * u[:, 2 * HIDDEN :])
            new = c + z * (h - c)
            if not full[t]:
                new = np.where(inside[:, t, None], new, h)
            if keep is not None:
                keep.append((t, h, z, r, c, u[:, 2 * HIDDEN :]))
            h = out[t] = new
        return out

    def logits(self, X: np.ndarray, idx: np.ndarray, inside: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Scores, before the logistic, of windows ``idx`` of rows of ``X`` (``inside``: not padding)."""
        p = self.p
        back: dict[str, list] = {"f": [], "b": []}
        H = np.concatenate([self.states(X @ p["W_" + d] + p["g_" + d], idx, inside, d, back[d] if keep is not None else None)
                            for d in "fb"], axis=2)
        e = np.tanh(H @ p["W_a"])
        s = np.where(inside.T, e @ p["v_a"], np.float32(-1e9))
        w = np.exp(s - s.max(axis=0))
        w /= w.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", w, H)
        if keep is not None:
            keep.update(back=back, H=H, e=e, w=w, pooled=pooled)
        return pooled @ p["w_o"] + p["b_o"][0]

    def gradients(self, X: np.ndarray, idx: np.ndarray, inside: np.ndarray, y: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the mean log loss on windows, and by the rows of ``X``."""
        p, k = self.p, {}
        logit = self.logits(X, idx, inside, k)
        H, e, w, g = k["H"], k["e"], k["w"], {}
        d_logit = ((_sigmoid(logit) - y) / len(y)).astype(np.float32)
        g["w_o"], g["b_o"] = k["pooled"].T @ d_logit, d_logit.sum(keepdims=True)
        d_pool = d_logit[:, None] * p["w_o"]
        d_w = np.einsum("tnh,nh->tn", H, d_pool)
        d_s = w * (d_w - (w * d_w).sum(axis=0))
        d_e = d_s[:, :, None] * p["v_a"] * (1 - e * e)
        g["v_a"], g["W_a"] = np.einsum("tna,tn->a", e, d_s), np.einsum("tnh,tna->ha", H, d_e)
        d_H = w[:, :, None] * d_pool + d_e @ p["W_a"].T
        d_X = np.zeros_like(X)
        for i, d in enumerate("fb"):
            U, d_table = p["U_" + d], np.zeros((len(X), 3 * HIDDEN), np.float32)
            g["U_" + d], d_h = np.zeros_like(U), np.zeros((len(y), HIDDEN), np.float32)
            for t, h, z, r, c, u_c in reversed(k["back"][d]):
                whole = d_h + d_H[t][:, i * HIDDEN : (i + 1) * HIDDEN]
                m = inside[:, t, None]
                new = np.where(m, whole, 0)
                d_c = new * (1 - z) * (1 - c * c)
                d_z, d_r = new * (h - c) * z * (1 - z), d_c * u_c * r * (1 - r)
                d_u = np.concatenate([d_z, d_r, d_c * r], axis=1)
                np.add.at(d_table, idx[:, t], np.concatenate([d_z, d_r, d_c], axis=1))
                g["U_" + d] += h.T @ d_u
                d_h = np.where(m, new * z + d_u @ U.T, whole)
            g["W_" + d], g["g_" + d] = X.T @ d_table, d_table.sum(axis=0)
            d_X += d_table @ p["W_" + d].T
        return g, d_X

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, words=np.frombuffer("\n".join(self.words).encode(), np.uint8), **self.p)
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Network:
        with np.load(io.BytesIO(data)) as f:
            p = {k: f[k] for k in f.files}
        text = p.pop("words").tobytes().decode()
        return cls(text.split("\n") if text else [], p)


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of rows of word places as one array, what is not padding, and each window's row."""
    owner, starts = [], []
    for i, r in enumerate(rows):
        s = windows_of(len(r))
        owner.append(np.full(len(s), i))
        starts.append(s)
    owner, starts = np.concatenate(owner), np.concatenate(starts)
    lens = np.array([len(r) for r in rows])
    begin = np.cumsum(lens) - lens
    at = starts[:, None] + np.arange(WINDOW)
    inside = at < lens[owner][:, None]
    flat = np.concatenate(rows)
    return np.where(inside, flat[np.minimum(begin[owner][:, None] + at, len(flat) - 1)], 0), inside, owner


def train(texts: list[str | None], y: list[int], seed: int = 7) -> Network:
    """Fit on texts and 0/1 labels."""
    rng = np.random.default_rng(seed)
    docs = [words_of(t) for t in texts]
    y_all = np.array(y, dtype=np.float32)
    seen, toxic = Counter(), Counter()
    for words, label in zip(docs, y, strict=True):
        seen.update(once := set(words))
        if label:
            toxic.update(once)
    known = [w for w, n in sorted(seen.items(), key=lambda x: (-x[1], x[0])) if n >= MIN_TEXTS][:MAX_WORDS]
    n_pos, n_neg = max(1, int(y_all.sum())), max(1, int(len(y_all) - y_all.sum()))

    def init(*shape: int, scale: float = 0.3) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    dim = WORD_DIM + CHAR_DIM
    p = {"E_w": init(len(known) + 1, WORD_DIM, scale=0.05), "E_c": init(CHAR_ROWS, CHAR_DIM, scale=0.1), "W_a": init(2 * HIDDEN, ATTENTION),
         "v_a": init(ATTENTION), "w_o": init(2 * HIDDEN), "b_o": np.array([np.log(n_pos / n_neg)], np.float32)}
    for d in "fb":
        p |= {"W_" + d: init(dim, 3 * HIDDEN), "U_" + d: init(HIDDEN, 3 * HIDDEN), "g_" + d: np.zeros(3 * HIDDEN, np.float32)}
    # the first input of a word starts as how much more often toxic texts have it
    odds = [np.log((toxic[w] + 0.5) / n_pos) - np.log((seen[w] - toxic[w] + 0.5) / n_neg) for w in known]
    p["E_w"][1:, 0] = np.clip(odds, -2, 6) / 2 if known else 0
    net = Network(known, p)

    vocab = {w: i for i, w in enumerate(dict.fromkeys(w for words in docs for w in words))}
    names = list(vocab)
    tri, counts = trigrams(names)
    begin = np.cumsum(counts) - counts
    rows = [np.array([vocab[w] for w in words]) for words in docs]
    m1, m2 = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    ids = np.array([net.ids.get(w, 0) for w in names])
    order = np.zeros(0, int)
    for step in range(1, STEPS + 1):
        if len(order) < BATCH:
            order = np.r_[order, rng.permutation(len(rows))]
        take, order = order[:BATCH], order[BATCH:]
        idx, inside, owner = padded([rows[i] for i in take])
        used, idx = np.unique(idx, return_inverse=True)
        idx = idx.reshape(inside.shape)
        n = counts[used]
        t = tri[np.repeat(begin[used] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        X = np.concatenate([p["E_w"][ids[used]], np.add.reduceat(p["E_c"][t], np.cumsum(n) - n, axis=0) / n[:, None].astype(np.float32)], axis=1)
        parts = [slice(a, a + WINDOWS_AT_ONCE) for a in range(0, len(idx), WINDOWS_AT_ONCE)]
        logit = np.concatenate([net.logits(X, idx[part], inside[part]) for part in parts])
        best = [int(np.flatnonzero(owner == k)[logit[owner == k].argmax()]) for k in range(len(take))]
        g, d_X = net.gradients(X, idx[best], inside[best], y_all[take])
        g["E_w"], g["E_c"] = np.zeros_like(p["E_w"]), np.zeros_like(p["E_c"])
        np.add.at(g["E_w"], ids[used], d_X[:, :WORD_DIM])
        np.add.at(g["E_c"], t, np.repeat(d_X[:, WORD_DIM:] / n[:, None], n, axis=0))
        rate = RATE * min(1.0, 2 * (1 - step / (STEPS + 1)))
        for k, v in p.items():
            m1[k] += 0.1 * (g[k] - m1[k])
            m2[k] += 0.01 * (g[k] ** 2 - m2[k])
            v -= (rate * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.99**step)) + 1e-6) + rate * DECAY * v).astype(np.float32)
    return net


class Scorer:
    """Scores whole texts by a stored network; keeps the gate inputs of words it has seen."""

    def __init__(self, data: bytes):
        self.net = Network.load(data)
        self._forget()

    def _forget(self) -> None:
        self._places: dict[str, int] = {}
        self._X = np.zeros((1024, WORD_DIM + CHAR_DIM), np.float32)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        docs = [words_of(t) for t in texts]
        if len(self._places) > CACHE_WORDS:
            self._forget()
        seen: set[str] = set()
        for words in docs:
            seen.update(words)
        new = [w for w in seen if w not in self._places]
        if new:
            at = len(self._places)
            self._places.update((w, at + i) for i, w in enumerate(new))
            while len(self._X) < len(self._places):
                self._X = np.concatenate([self._X, np.zeros_like(self._X)])
            self._X[at : at + len(new)] = self.net.inputs(new, *trigrams(new))
        get = self._places.__getitem__
        rows = [np.fromiter(map(get, words), dtype=np.int64, count=len(words)) for words in docs]
        idx, inside, owner = padded(rows)
        used = np.unique(idx)
        place = np.zeros(len(self._places), np.int64)
        place[used] = np.arange(len(used))
        idx, X = place[idx], self._X[used]
        out = np.full(len(texts), -np.inf)
        for a in range(0, len(idx), WINDOWS_AT_ONCE):
            part = slice(a, a + WINDOWS_AT_ONCE)
            np.maximum.at(out, owner[part], self.net.logits(X, idx[part], inside[part]))
        return _sigmoid(out)
