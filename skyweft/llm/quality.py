"""Quality classifier: a linear-chain CRF over lines.

Every line is labelled good or bad. A line's features are binned counts and ratios
of its characters and words, and the same of the line before and after it; the
chain adds a start and a transition weight. Forward-backward gives each line's
chance of being good; a document's score is its length-weighted mean of those,
put through a logistic curve fitted on the training documents.

Training: document labels of a bounded sample (PER_CLASS documents of each label,
TRAIN_BYTES of text in all) that is not held out are every line's label to begin
with; after a first fit, lines of bad documents that the model finds clearly good
are relabelled and the fit is repeated. Labels, lang, source and id are no inputs.

A null, empty or blank text is one empty line and gets that line's score. Without
labels of both classes each score is the share of label 1 (0.5 without labels).
Equal texts score equally. Texts are scored whole; a very long one takes about 46 bytes of
a worker's memory a byte, so that some hundred MB are the most. An empty table gives no
rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweft.llm.common import chunks, filter_text, groups_by_length, held_out, labelled_sample, map_text, table

#: Production parameters.
THRESHOLD = 0.3
PER_CLASS = 1500
TRAIN_BYTES = 8 << 20
STEPS = 120
#: Bytes of training text whose features are made at a time, which bounds the driver.
TRAIN_CHUNK = 1 << 20
BINS = 8

# ---- line features -----------------------------------------------------------------

#: Classes of bytes: 0 other, 1 lower, 2 upper, 3 digit, 4 space, 5 sentence marks, 6 other ASCII marks, 7 bytes of non-ASCII characters, 8 bar.
_CLASS = np.zeros(256, np.uint8)
_CLASS[33:127] = 6
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 7
for _c in b" \t\r\x0b\x0c":
    _CLASS[_c] = 4
for _c in b".,;:?'\"()-":
    _CLASS[_c] = 5
_CLASS[ord("|")] = 8
N_FEATURES = 15
_POW = np.power(np.uint64(0x100000001B3), np.arange(1, 33, dtype=np.uint64))


def line_features(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per line features and lengths (bytes + 1), and the number of lines of each text."""
    raw = [(t or "").encode("utf-8", "surrogatepass").strip(b"\n") + b"\n" for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    n_lines = np.fromiter((r.count(b"\n") for r in raw), np.int64, len(raw))
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    length = (ends - starts).astype(np.float64)
    cls = _CLASS[data]
    lines = len(ends)

    def per_line(mask: np.ndarray) -> np.ndarray:
        c = np.cumsum(mask, dtype=np.int64)
        return (c[ends] - np.where(starts > 0, c[starts - 1], 0)).astype(np.float64)

    counts = {k: per_line(cls == k) for k in (1, 2, 3, 4, 5, 6, 7, 8)}
    inside = (cls != 4) & (data != 10)
    begins = inside & ~np.concatenate([[False], inside[:-1]])
    w_start = np.flatnonzero(begins)
    w_line = np.searchsorted(ends, w_start)
    words = np.bincount(w_line, minlength=lines).astype(np.float64)
    # a hash of each word: its bytes' weighted sum
    at = np.flatnonzero(inside)
    which = np.cumsum(begins)[at] - 1
    with np.errstate(over="ignore"):
        v = (data[at].astype(np.uint64) + np.uint64(1)) * _POW[(at - w_start[which]) % 32] if len(at) else np.zeros(0, np.uint64)
        h = np.add.reduceat(v, np.searchsorted(at, w_start)) if len(w_start) else v
    same = (h[1:] == h[:-1]) & (w_line[1:] == w_line[:-1])
    repeats = np.bincount(w_line[1:][same], minlength=lines).astype(np.float64)
    distinct = _distinct(w_line, h, lines)
    # symbols right after a letter, as in word###
    glued = per_line(np.concatenate([[False], (cls[1:] == 6) & np.isin(cls[:-1], (1, 7, 6))]))
    upper_run = per_line(np.concatenate([[False], (cls[1:] == 2) & (cls[:-1] == 2)]))
    bang = per_line(data == 33)
    some, w1 = np.maximum(length, 1), np.maximum(words, 1)
    last = np.where(length > 0, cls[np.maximum(ends - 1, 0)], 0)
    doc_of = np.repeat(np.arange(len(raw)), n_lines)
    lh = np.bincount(w_line, weights=(h % np.uint64(1 << 40)).astype(np.float64), minlength=lines)
    again = _repeated(doc_of, lh, words)
    x = np.stack(
        [
            np.log1p(length),
            np.log1p(words),
            counts[1] / some,
            counts[2] / some,
            counts[3] / some,
            counts[5] / w1,
            glued / w1,
            counts[7] / some,
            counts[8] / w1,
            repeats / w1,
            distinct / w1,
            upper_run / some,
            bang / w1,
            length / w1,
            (last == 5) + 2.0 * again,
        ],
        axis=1,
    )
    return x, length + 1, n_lines


def _distinct(line: np.ndarray, h: np.ndarray, lines: int) -> np.ndarray:
    """Distinct words of each line."""
    key = h ^ (line.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(key, return_index=True)
    return np.bincount(line[first], minlength=lines).astype(np.float64)


def _repeated(doc: np.ndarray, h: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Whether a line of 3 words or more occurs elsewhere in its document."""
    order = np.lexsort((h, doc))
    same = (doc[order][1:] == doc[order][:-1]) & (h[order][1:] == h[order][:-1])
    out = np.zeros(len(doc), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out & (words >= 3)


# ---- the chain ---------------------------------------------------------------------


class Chain:
    """Weights of the CRF: emission score of good against bad by binned features."""

    def __init__(self, edges: np.ndarray):
        self.edges = edges  # [feature, BINS - 1]
        self.w = np.zeros((3, N_FEATURES, BINS))  # own line, line before, line after
        self.bias = np.zeros(3)  # own, no line before, no line after
        self.trans = np.zeros((2, 2))
        self.curve = (6.0, -3.0)
        self.constant: float | None = None

    def use(self, params: np.ndarray) -> None:
        """Take on the parameters: features of three lines, biases, transitions."""
        size = 3 * N_FEATURES * BINS
        self.w = params[:size].reshape(3, N_FEATURES, BINS)
        self.bias, self.trans = params[size : size + 3], params[size + 3 :].reshape(2, 2)

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(self.edges[j], x[:, j], "right") for j in range(x.shape[1])], axis=1)

    def neighbours(self, n_lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the line before and after within the document, -1 for none."""
        ends = np.cumsum(n_lines)
        i = np.arange(int(ends[-1]) if len(ends) else 0)
        prev, nxt = i - 1, i + 1
        some = n_lines > 0
        prev[(ends - n_lines)[some]] = -1
        nxt[ends[some] - 1] = -1
        return prev, nxt

    def emissions(self, b: np.ndarray, prev: np.ndarray, nxt: np.ndarray) -> np.ndarray:
        j = np.arange(N_FEATURES)
        own = self.w[0][j, b].sum(1) + self.bias[0]
        before = self.w[1][j, b].sum(1)
        after = self.w[2][j, b].sum(1)
        return own + np.where(prev >= 0, before[prev], self.bias[1]) + np.where(nxt >= 0, after[nxt], self.bias[2])

    def marginals(self, e: np.ndarray, n_lines: np.ndarray, pairs: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """P(good) of each line by forward-backward; with ``pairs``, a weight for each
        document, the expected transitions by those weights too.

        States are bad (0) and good (1); ``e`` is added to good. Messages are kept as
        log odds, so the recursion is a scalar one, run over all documents at once.
        """
        p = np.empty(len(e))
        expected = np.zeros((2, 2))
        starts = np.cumsum(n_lines) - n_lines
        t = self.trans
        for group in groups_by_length(n_lines, 1 << 18, 4096):
            n = n_lines[group]
            top = int(n[0])
            grid = np.zeros((top, len(group)))
            cols = np.arange(top)[:, None]
            live = cols < n[None, :]
            grid[live] = e[(starts[group][None, :] + cols)[live]]
            f, bwd = np.empty_like(grid), np.zeros_like(grid)
            f[0] = grid[0]
            for k in range(1, top):
                a = f[k - 1]
                f[k] = grid[k] + np.logaddexp(t[0, 1], a + t[1, 1]) - np.logaddexp(t[0, 0], a + t[1, 0])
            for k in range(top - 2, -1, -1):
                a = bwd[k + 1] + grid[k + 1]
                m = np.logaddexp(t[1, 0], a + t[1, 1]) - np.logaddexp(t[0, 0], a + t[0, 1])
                bwd[k] = np.where(live[k + 1], m, 0.0)
            odds = f + bwd
            p[(starts[group][None, :] + cols)[live]] = (1 / (1 + np.exp(-np.clip(odds, -40, 40))))[live]
            if pairs is not None and top > 1:
                a, g = f[:-1], bwd[1:] + grid[1:]
                s = np.stack([np.zeros_like(a) + t[0, 0], g + t[0, 1], a + t[1, 0], a + g + t[1, 1]])
                s = np.exp(s - s.max(0))
                s = s / s.sum(0) * live[1:] * pairs[group]
                expected += s.sum((1, 2)).reshape(2, 2)
        return p, expected

    def score(self, texts: list) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        x, length, n = line_features(texts)
        b = self.binned(x)
        p, _ = self.marginals(self.emissions(b, *self.neighbours(n)), n)
        return 1 / (1 + np.exp(-(self.curve[0] * weighted(p, length, n) + self.curve[1])))


def weighted(p: np.ndarray, length: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Length-weighted mean over the lines of each document (all have one)."""
    at = np.cumsum(n) - n
    return np.add.reduceat(p * length, at) / np.add.reduceat(length, at) if len(n) else np.zeros(0)


def train(rows: list[tuple]) -> Chain:
    """A chain fitted on (text, 0 or 1) rows."""
    y = np.array([int(r[1] == 1) for r in rows])
    chain = Chain(np.zeros((N_FEATURES, BINS - 1)))
    if len(set(y.tolist())) < 2:
        chain.constant = float(y.mean()) if len(y) else 0.5
        return chain
    texts = [r[0] for r in rows]
    parts = [line_features(texts[i:j]) for i, j in chunks(texts, TRAIN_CHUNK)]
    x, length, n = (np.concatenate(p) for p in zip(*parts))
    chain.edges = np.stack([_edges(x[:, j]) for j in range(N_FEATURES)])
    b = chain.binned(x)
    doc = np.repeat(np.arange(len(n)), n)
    label = y[doc].astype(float)
    # each class weighs the same, each document at most as 20 lines
    weight = (0.5 / np.where(y == 1, y.mean(), 1 - y.mean()) / np.maximum(n / 20, 1.0))[doc]
    for again in range(2):
        fit(chain, b, n, label, weight)
        if not again:
            p, _ = chain.marginals(chain.emissions(b, *chain.neighbours(n)), n)
            label = np.where((y[doc] == 0) & (p > 0.7), 1.0, y[doc])
    p, _ = chain.marginals(chain.emissions(b, *chain.neighbours(n)), n)
    chain.curve = logistic(weighted(p, length, n), y)
    return chain


def _edges(v: np.ndarray) -> np.ndarray:
    """BINS - 1 cut points: quantiles of the values above the smallest, which has a bin."""
    low = v.min()
    more = v[v > low]
    if not len(more):
        return np.full(BINS - 1, low + 1.0)
    return np.concatenate([[np.nextafter(low, np.inf)], np.quantile(more, np.arange(1, BINS - 1) / (BINS - 1))])


def fit(chain: Chain, b: np.ndarray, n: np.ndarray, label: np.ndarray, weight: np.ndarray) -> None:
    """Gradient ascent (Adam) on :func:`likelihood`, lightly held back."""
    size = 3 * N_FEATURES * BINS + 7
    params, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    slope = gradient(chain, b, n, label, weight)
    for step in range(1, STEPS + 1):
        g = slope(params) / len(label) - 1e-4 * params
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        params = params + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    chain.use(params)


def likelihood(chain: Chain, b: np.ndarray, n: np.ndarray, label: np.ndarray, weight: np.ndarray) -> float:
    """Sum over the documents of weight (one for all lines of a document) times the log
    probability of its lines' labels."""
    e, t, total = chain.emissions(b, *chain.neighbours(n)), chain.trans, 0.0
    for end, k in zip(np.cumsum(n).tolist(), n.tolist()):
        y, x = label[end - k : end].astype(int), e[end - k : end]
        path = float((x * y).sum() + t[y[:-1], y[1:]].sum())
        a = np.array([0.0, x[0]])
        for z in x[1:]:
            a = np.logaddexp(a[0] + t[0], a[1] + t[1]) + np.array([0.0, z])
        total += weight[end - k] * (path - np.logaddexp(*a))
    return total


def gradient(chain: Chain, b: np.ndarray, n: np.ndarray, label: np.ndarray, weight: np.ndarray):
    """The function of parameters that is the gradient of :func:`likelihood`."""
    prev, nxt = chain.neighbours(n)
    j = np.arange(N_FEATURES) * BINS
    own = b + j
    has_p, has_n = prev >= 0, nxt >= 0
    q = label.astype(int)
    seen = np.zeros((2, 2))
    np.add.at(seen, (q[has_n], q[nxt[has_n]]), weight[has_n])
    size, flat = N_FEATURES * BINS, own.reshape(-1)
    of_doc = weight[np.cumsum(n) - n]

    def slope(params: np.ndarray) -> np.ndarray:
        chain.use(params)
        p, expected = chain.marginals(chain.emissions(b, prev, nxt), n, of_doc)
        r = (label - p) * weight
        before = np.zeros(len(r))
        before[prev[has_p]] = r[has_p]  # a line's residual goes to the features of its neighbours
        after = np.zeros(len(r))
        after[nxt[has_n]] = r[has_n]
        g = [np.bincount(flat, weights=np.repeat(z, N_FEATURES), minlength=size) for z in (r, before, after)]
        return np.concatenate([*g, [r.sum(), r[~has_p].sum(), r[~has_n].sum()], (seen - expected).reshape(-1)])

    return slope


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of P(y = 1) on x by Newton steps, lightly held back."""
    z = np.stack([x, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(2)
        w = w + np.linalg.solve(h, z.T @ (y - p) - 1e-2 * w)
    return float(w[0]), float(w[1])


# ---- Spark -------------------------------------------------------------------------


def trained(docs: DataFrame, labels: DataFrame) -> Chain:
    return train(labelled_sample(docs, labels, "quality", PER_CLASS, TRAIN_BYTES))


def score_quality(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and score of every row; no shuffle, the weights (a few KB) go along."""
    return map_text(docs, text_col, [id_col], lambda texts: {"score": chain.score(texts)}, [("score", T.DoubleType())])


def keep_good(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, all columns."""
    return filter_text(docs, text_col, lambda texts: chain.score(texts) >= threshold)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_quality(docs, trained(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op2_quality": op2_quality}
ORACLES: dict[str, str] = {}
