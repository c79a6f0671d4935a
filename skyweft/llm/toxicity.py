"""Toxicity: a bidirectional GRU with attention pooling over windows of words.

A word's input is a hashed word embedding and the scaled sum of its hashed character
3- and 4-gram embeddings. Windows of WINDOW words every STRIDE words cover the whole
text, the last one ending with it; a shorter text is one window of its own length.
Two gated recurrent units read a window forwards and backwards, attention pools
their states, and a logistic unit scores it. A document's score is its largest
window's, through a logistic curve fitted on the training documents.

Trained here in numpy, by back-propagation, on a bounded sample of labelled rows that
are not held out (PER_CLASS documents of each label, TRAIN_BYTES of text in all). A
toxic document need be toxic in one window only: after a first pass over all windows,
each toxic document trains its highest-scoring window, each other one its highest and
a random one. Labels, lang, source and id are no inputs of a score.

Null texts and texts without a word score as an empty window does. Without labels of
both classes each score is the share of label 1 (0 without labels). Equal texts score
equally but for the rounding of single-precision sums, which differs with what is scored
beside them (under 1e-6). Texts are scored whole, whatever their length. An empty table
gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweft.llm.common import held_out, labelled_sample, map_text, table
from skyweft.llm.quality import logistic

#: Production parameters.
THRESHOLD = 0.5
PER_CLASS = 1500
TRAIN_BYTES = 8 << 20
WINDOW, STRIDE = 24, 12
HIDDEN, EMBED = 8, 8
BUCKETS = 1 << 14
EPOCHS, BATCH, SEED = 16, 256, 7
CACHE_WORDS = 300_000
#: Windows scored at a time.
TILE = 4096

_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def _bucket(s: str) -> int:
    return zlib.crc32(s.encode("utf-8", "surrogatepass")) % BUCKETS


def grams(word: str) -> list[str]:
    w = f"\x02{word}\x03"
    return [w[i : i + n] for n in (3, 4) for i in range(max(1, len(w) - n + 1))]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def window_starts(n: int) -> np.ndarray:
    """Starts of the windows of a text of n words; n > WINDOW ends with a full one."""
    if n <= WINDOW:
        return np.zeros(1, np.int64)
    s = np.arange(0, n - WINDOW + STRIDE, STRIDE)
    return np.unique(np.minimum(s, n - WINDOW))


class Net:
    """The network's weights; inference with a cache of projected word inputs."""

    def __init__(self, rng: np.random.Generator):
        def init(*shape, scale):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        d = 2 * EMBED
        self.p = {
            "word": init(BUCKETS, EMBED, scale=0.1),
            "char": init(BUCKETS, EMBED, scale=0.1),
            "w": init(2, d, 3 * HIDDEN, scale=d**-0.5),
            "b": np.zeros((2, 1, 3 * HIDDEN), np.float32),
            "u": init(2, HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
            "att": init(2 * HIDDEN, scale=0.1),
            "out": init(2 * HIDDEN, scale=0.3),
            "bias": np.full(1, -1.0, np.float32),
        }
        self.curve = (1.0, 0.0)
        self.constant: float | None = None
        self._reset()

    def __getstate__(self):
        return (self.p, self.curve, self.constant)

    def __setstate__(self, state):
        self.p, self.curve, self.constant = state
        self._reset()

    def _reset(self) -> None:
        self.index: dict[str, int] = {}
        self.table = np.zeros((2, 1024, 3 * HIDDEN), np.float32)

    # -- inference --

    def _learn(self, new: list[str]) -> None:
        x = self.inputs(*encoded(new))
        n = len(self.index)
        if n + len(new) > self.table.shape[1]:
            grown = np.zeros((2, 2 * (n + len(new)), 3 * HIDDEN), np.float32)
            grown[:, :n] = self.table[:, :n]
            self.table = grown
        self.table[:, n : n + len(new)] = x @ self.p["w"] + self.p["b"]
        self.index.update(zip(new, range(n, n + len(new))))

    def inputs(self, wid: np.ndarray, gid: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        chars = np.add.reduceat(self.p["char"][gid], np.cumsum(sizes) - sizes, axis=0) / np.sqrt(sizes)[:, None].astype(np.float32)
        return np.concatenate([self.p["word"][wid], chars], axis=1)

    def window_logits(self, docs: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of all windows: document, first word and logit."""
        if len(self.index) > CACHE_WORDS:
            self._reset()
        new = list(dict.fromkeys(w for d in docs for w in d if w not in self.index))
        if new:
            self._learn(new)
        get = self.index.__getitem__
        ids = np.fromiter((get(w) for d in docs for w in d), np.int64, sum(map(len, docs)))
        n = np.fromiter(map(len, docs), np.int64, len(docs))
        base = np.cumsum(n) - n
        starts = [window_starts(k) for k in n.tolist()]
        doc = np.repeat(np.arange(len(docs)), [len(s) for s in starts])
        first = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        out = np.full(len(doc), float(self.p["bias"][0]), np.float32)
        size = np.minimum(n, WINDOW)[doc]
        for length in np.unique(size[size > 0]).tolist():
            which = np.flatnonzero(size == length)
            for i in range(0, len(which), TILE):
                tile = which[i : i + TILE]
                at = (base[doc[tile]] + first[tile])[None, :] + np.arange(length)[:, None]
                out[tile] = self._run(ids[at])
        return doc, first, out

    def _run(self, ids: np.ndarray) -> np.ndarray:
        steps, n = ids.shape
        u = self.p["u"]
        states = np.empty((steps, n, 2 * HIDDEN), np.float32)
        h = np.zeros((2, n, HIDDEN), np.float32)
        g = np.empty((2, n, 3 * HIDDEN), np.float32)
        k = HIDDEN
        for t in range(steps):
            np.take(self.table[0], ids[t], axis=0, out=g[0])
            np.take(self.table[1], ids[steps - 1 - t], axis=0, out=g[1])
            a = h @ u
            zr = sigmoid(g[:, :, : 2 * k] + a[:, :, : 2 * k])
            c = np.tanh(g[:, :, 2 * k :] + zr[:, :, k:] * a[:, :, 2 * k :])
            h = c + zr[:, :, :k] * (h - c)
            states[t, :, :k] = h[0]
            states[steps - 1 - t, :, k:] = h[1]
        s = states @ self.p["att"]
        s = np.exp(s - s.max(0))
        s /= s.sum(0)
        return ((states @ self.p["out"]) * s).sum(0) + self.p["bias"][0]

    def document_logits(self, texts: list) -> np.ndarray:
        docs = [words_of(t) for t in texts]
        doc, _, logit = self.window_logits(docs)
        out = np.full(len(docs), -np.inf, np.float32)
        np.maximum.at(out, doc, logit)
        return out.astype(np.float64)

    def score(self, texts: list) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.curve[0] * self.document_logits(texts) + self.curve[1], -40, 40)))

    # -- training --

    def gradients(self, wid: np.ndarray, words: tuple, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy of windows: ``wid`` [steps, windows] numbers ``words``."""
        p, k = self.p, HIDDEN
        steps, n = wid.shape
        x_of = self.inputs(*words)
        x = x_of[wid]
        both = np.stack([x, x[::-1]])  # direction, step, window, input
        g = both @ p["w"][:, None] + p["b"][:, None]
        h = np.zeros((2, n, k), np.float32)
        kept, out = [], np.empty((2, steps, n, k), np.float32)
        for t in range(steps):
            a = h @ p["u"]
            zr = sigmoid(g[:, t, :, : 2 * k] + a[:, :, : 2 * k])
            z, r, q = zr[:, :, :k], zr[:, :, k:], a[:, :, 2 * k :]
            c = np.tanh(g[:, t, :, 2 * k :] + r * q)
            kept.append((h, z, r, q, c))
            h = c + z * (h - c)
            out[:, t] = h
        states = np.concatenate([out[0], out[1, ::-1]], axis=2)
        s = states @ p["att"]
        s = np.exp(s - s.max(0))
        s /= s.sum(0)
        pooled = (states * s[:, :, None]).sum(0)
        d_logit = ((sigmoid(pooled @ p["out"] + p["bias"][0]) - y) * weight / weight.sum()).astype(np.float32)
        grad = {"out": d_logit @ pooled, "bias": d_logit.sum(keepdims=True)}
        d_pool = d_logit[:, None] * p["out"]
        d_s = (states * d_pool).sum(2)
        d_s = s * (d_s - (s * d_s).sum(0))
        grad["att"] = np.einsum("tn,tnd->d", d_s, states)
        d_states = s[:, :, None] * d_pool + d_s[:, :, None] * p["att"]
        d_out = np.stack([d_states[:, :, :k], d_states[::-1, :, k:]])
        d_g, d_u, d_h = np.empty_like(g), np.zeros_like(p["u"]), np.zeros((2, n, k), np.float32)
        u_t = p["u"].transpose(0, 2, 1)
        for t in range(steps - 1, -1, -1):
            before, z, r, q, c = kept[t]
            d_h = d_h + d_out[:, t]
            d_c = d_h * (1 - z) * (1 - c * c)
            d_z = d_h * (before - c) * z * (1 - z)
            d_r = d_c * q * r * (1 - r)
            d_a = np.concatenate([d_z, d_r, d_c * r], axis=2)
            d_g[:, t] = np.concatenate([d_z, d_r, d_c], axis=2)
            d_u += before.transpose(0, 2, 1) @ d_a
            d_h = d_h * z + d_a @ u_t
        grad["u"] = d_u
        grad["w"] = np.stack([both[i].reshape(-1, 2 * EMBED).T @ d_g[i].reshape(-1, 3 * k) for i in (0, 1)])
        grad["b"] = d_g.sum((1, 2))[:, None]
        d_both = d_g @ p["w"].transpose(0, 2, 1)[:, None]
        d_x = (d_both[0] + d_both[1, ::-1]).reshape(-1, 2 * EMBED)
        d_word = np.zeros((len(words[0]), 2 * EMBED), np.float32)
        np.add.at(d_word, wid.reshape(-1), d_x)
        grad["word"], grad["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        np.add.at(grad["word"], words[0], d_word[:, :EMBED])
        sizes = words[2]
        np.add.at(grad["char"], words[1], np.repeat(d_word[:, EMBED:] / np.sqrt(sizes)[:, None].astype(np.float32), sizes, axis=0))
        return grad


def encoded(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets, all their grams' buckets and the number of grams of each."""
    gs = [grams(w) for w in words]
    known: dict[str, int] = {}
    flat = [known[g] if g in known else known.setdefault(g, _bucket(g)) for x in gs for g in x]
    return np.fromiter((_bucket(w) for w in words), np.int64, len(words)), np.array(flat, np.int64), np.fromiter(map(len, gs), np.int64, len(gs))


def train(rows: list[tuple]) -> Net:
    """A network fitted on (text, 0 or 1) rows."""
    rng = np.random.default_rng(SEED)
    net = Net(rng)
    y = np.array([int(r[1] == 1) for r in rows])
    if len(set(y.tolist())) < 2:
        net.constant = float(y.mean()) if len(y) else 0.0
        return net
    docs = [words_of(r[0]) for r in rows]
    moments: dict[str, list] = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.p.items()}
    starts = [window_starts(len(d)) if d else np.zeros(0, np.int64) for d in docs]
    doc = np.repeat(np.arange(len(docs)), [len(s) for s in starts])
    first = np.concatenate(starts)
    count = np.bincount(doc, minlength=len(docs))
    step = 0
    for epoch in range(EPOCHS):
        if epoch < 3:  # few windows of every document, of long ones some at random
            order = np.lexsort((rng.random(len(doc)), doc))
            rank = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            pick = order[rank < 3]
            weight = 1.0 / np.minimum(count, 3)[doc[pick]]
        else:
            if epoch % 3 == 0:
                net._reset()
                logit = np.concatenate([net.window_logits(docs[i : i + 200])[2] for i in range(0, len(docs), 200)])
                full = np.repeat(np.arange(len(docs)), np.maximum(count, 1))
                logit = logit[count[full] > 0]
            order = np.lexsort((-logit, doc))
            top = order[(np.cumsum(count) - count)[count > 0]]
            other = np.flatnonzero((y[doc] == 0) & (rng.random(len(doc)) < 1.0 / count[doc]))
            pick = np.concatenate([top, other])
            weight = np.ones(len(pick))
        size = np.minimum(np.array([len(docs[d]) for d in doc[pick]]), WINDOW)
        shuffled = rng.permutation(len(pick))
        shuffled = shuffled[np.argsort(np.where(size[shuffled] == WINDOW, WINDOW, size[shuffled]), kind="stable")]
        batches = [b for s in np.unique(size) for b in _split(shuffled[size[shuffled] == s], BATCH)]
        for b in rng.permutation(len(batches)).tolist():
            which = batches[b]
            tokens = [docs[doc[i]][first[i] : first[i] + WINDOW] for i in pick[which].tolist()]
            names = list(dict.fromkeys(w for t in tokens for w in t))
            number = {w: i for i, w in enumerate(names)}
            wid = np.array([[number[w] for w in t] for t in tokens]).T
            grad = net.gradients(wid, encoded(names), y[doc[pick[which]]].astype(np.float32), weight[which].astype(np.float32))
            step += 1
            _adam(net.p, grad, moments, step, 0.02 if epoch < EPOCHS - 4 else 0.005, len(which) / BATCH)
    net._reset()
    net.curve = logistic(np.concatenate([net.document_logits([r[0] for r in rows[i : i + 200]]) for i in range(0, len(rows), 200)]), y)
    net._reset()
    return net


def _split(a: np.ndarray, n: int) -> list[np.ndarray]:
    return [a[i : i + n] for i in range(0, len(a), n)]


def _adam(p: dict, grad: dict, moments: dict, step: int, rate: float, share: float) -> None:
    """One step; a small batch's gradient counts for its share of a full one."""
    for k, g in grad.items():
        g = g.reshape(p[k].shape) * share
        m, v = moments[k]
        m *= 0.9
        m += 0.1 * g
        v *= 0.99
        v += 0.01 * g * g
        p[k] -= (rate / (1 - 0.9**step)) * m / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)


# ---- Spark -------------------------------------------------------------------------


def trained(docs: DataFrame, labels: DataFrame) -> Net:
    return train(labelled_sample(docs, labels, "toxic", PER_CLASS, TRAIN_BYTES))


def score_toxicity(docs: DataFrame, net: Net, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score of every row; the weights (about 1 MB) are broadcast, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    return map_text(docs, text_col, [id_col], lambda texts: {"score": shared.value.score(texts)}, [("score", T.DoubleType())])


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_toxicity(docs, trained(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op10_toxicity": op10_toxicity}
ORACLES: dict[str, str] = {}
