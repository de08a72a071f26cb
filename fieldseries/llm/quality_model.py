"""Quality classifier: a generalised additive model with pairwise interactions.

Every text becomes a short vector of statistics.  Each feature is cut into quantile bins, and
shallow trees are boosted feature by feature in cycles; all trees of a feature add up to one lookup
table over its bins.  The pairs of features that explain most of what is left get tables over their
two bins in the same way.  A score is the sum of the looked-up values, put through a logistic
function: scoring is one gather and one addition a table, over whole arrays.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, labelled_texts, map_batches
from .textcore import ALNUM, NOT_SPACE, runs, shingles, string_buffers, word_hashes

#: Labelled documents that the model is learned from, at most.
SAMPLE = 8_000
BINS, PAIR_BINS, PAIRS = 32, 8, 8

FEATURES = (
    "log_bytes", "log_words", "word_length", "long_word", "upper", "digit", "symbol", "exclaim", "stop", "other_punct", "high",
    "line_length", "lines_per_word", "distinct_words", "top_word", "repeat_3", "repeat_6", "symbol_ends", "alnum_words",
    "duplicate_lines", "white",
)

_CLASSES = np.zeros((256, 8))
for _k, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&|<>", b"!", b".", b",;:?()'\"-_/@=+", b"\n", b" \t\r\n\x0b\x0c")):
    _CLASSES[list(_chars), _k] = 1


def _share_repeated(h: np.ndarray, d: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct, in repeated values, most frequent) counts of the hashes of each document."""
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(first)
    size, of = np.diff(np.append(at, len(h))), d[at]
    top = np.zeros(n)
    np.maximum.at(top, of, size)
    return np.bincount(of, minlength=n), np.bincount(of, weights=np.where(size > 1, size, 0), minlength=n), top


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each text, from all of its bytes."""
    n = len(offsets) - 1
    out = np.zeros((n, len(FEATURES)))
    for a, b in runs(offsets, 1 << 18):
        bounds = offsets[a : b + 1] - offsets[a]
        raw, m = data[offsets[a] : offsets[b]], b - a
        size = np.diff(bounds)
        owner = np.repeat(np.arange(m), size)
        counts = np.bincount(owner * 256 + raw, minlength=m * 256).reshape(m, 256)
        by = counts @ _CLASSES
        high = counts[:, 0x80:].sum(1)
        start, end, doc, h = word_hashes(raw, bounds, NOT_SPACE)
        words = np.bincount(doc, minlength=m)
        w1 = np.maximum(1, words)
        longest = np.zeros(m)
        np.maximum.at(longest, doc, end - start)
        distinct, _, top = _share_repeated(h, doc, m)
        h3, d3 = shingles(h, doc, m, 3)
        _, rep3, _ = _share_repeated(h3, d3, m)
        h6, d6 = shingles(h, doc, m, 6)
        _, rep6, _ = _share_repeated(h6, d6, m)
        ends = np.bincount(doc, weights=_CLASSES[raw[end - 1], 2] if len(end) else None, minlength=m)
        alnum = np.bincount(doc, weights=ALNUM[raw[start]].astype(float) if len(start) else None, minlength=m)
        line = np.ones(256, bool)
        line[10] = False
        _, _, ldoc, lh = word_hashes(raw, bounds, line)
        lines = np.bincount(ldoc, minlength=m)
        ldistinct, _, _ = _share_repeated(lh, ldoc, m)
        s1, l1 = np.maximum(1, size), np.maximum(1, lines)
        out[a:b] = np.stack(
            [
                np.log1p(size), np.log1p(words), size / w1, longest, by[:, 0] / s1, by[:, 1] / s1, by[:, 2] / w1, by[:, 3] / w1, by[:, 4] / w1, by[:, 5] / w1, high / s1,
                np.log1p(size / l1), lines / w1, distinct / w1, top / w1, rep3 / w1, rep6 / w1, ends / w1, alnum / w1, (lines - ldistinct) / l1, by[:, 7] / s1,
            ],
            1,
        )
    return out


@dataclass(frozen=True)
class Model:
    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)


def score(model: Model, x: np.ndarray) -> np.ndarray:
    z = np.full(len(x), model.intercept)
    for j, table in enumerate(model.tables):
        z += table[np.searchsorted(model.edges[j], x[:, j], "right")]
    for i, j, table in model.pairs:
        z += table[np.searchsorted(model.pair_edges[i], x[:, i], "right"), np.searchsorted(model.pair_edges[j], x[:, j], "right")]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _best_cut(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, int]:
    """(gain, cut) of the best split of a row of bins into [:cut] and [cut:]."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gt, ht = g.sum(), h.sum()
    gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
    k = int(gain.argmax())
    return float(gain[k]), k + 1


def _tree(g: np.ndarray, h: np.ndarray, ridge: float, leaves: int = 3) -> np.ndarray:
    """Leaf values by bin of a tree with a few leaves over one feature's bins."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        found = [(_best_cut(g[a:b], h[a:b], ridge), a, b) for a, b in parts]
        (gain, cut), a, b = max(found, key=lambda f: f[0][0])
        if gain <= 1e-9:
            break
        parts.remove((a, b))
        parts += [(a, a + cut), (a + cut, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + ridge)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    """A tree over two features' bins: one cut along the first, then one along the second on either side (or the other way round)."""
    best: tuple[float, np.ndarray] = (-1.0, np.zeros_like(g))
    for turn in (False, True):
        gg, hh = (g.T, h.T) if turn else (g, h)
        _, cut = _best_cut(gg.sum(1), hh.sum(1), ridge)
        out, gain = np.zeros_like(gg), 0.0
        for side in (slice(0, cut), slice(cut, None)):
            gs, hs = gg[side].sum(0), hh[side].sum(0)
            out[side] = _tree(gs, hs, ridge, 2)[None, :]
            gain += float((out[side][0] * gs).sum()) if out[side].size else 0.0
        if gain > best[0]:
            best = (gain, out.T if turn else out)
    return best[1]


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 250, rate: float = 0.05, ridge: float = 2.0) -> Model:
    """Cyclic boosting; with one class only, a constant."""
    n = len(y)
    share = (y.sum() + 0.5) / (n + 1) if n else 0.5
    start = float(np.log(share / (1 - share)))
    if not n or y.min() == y.max():
        return Model(start)
    cuts = lambda v, k: np.unique(np.quantile(v, np.linspace(0, 1, k + 1)[1:-1]))
    edges = [cuts(x[:, j], BINS) for j in range(x.shape[1])]
    bins = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    z = np.full(n, start)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j, b in enumerate(bins):
            g, h = slopes()
            step = rate * _tree(np.bincount(b, g, len(tables[j])), np.bincount(b, h, len(tables[j])), ridge)
            tables[j] += step
            z += step[b]
    pair_edges = [cuts(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
    small = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(pair_edges)]
    g, h = slopes()

    def grid(i: int, j: int, v: np.ndarray) -> np.ndarray:
        k = len(pair_edges[j]) + 1
        return np.bincount(small[i] * k + small[j], v, (len(pair_edges[i]) + 1) * k).reshape(-1, k)

    gains = []
    for i in range(x.shape[1]):
        for j in range(i + 1, x.shape[1]):
            t = _pair_tree(gg := grid(i, j, g), grid(i, j, h), ridge)
            gains.append((float((t * gg).sum()), i, j))
    pairs = [(i, j, np.zeros((len(pair_edges[i]) + 1, len(pair_edges[j]) + 1))) for _, i, j in sorted(gains, reverse=True)[:PAIRS]]
    for _ in range(rounds // 2):
        for i, j, t in pairs:
            g, h = slopes()
            step = rate * _pair_tree(grid(i, j, g), grid(i, j, h), ridge)
            t += step
            z += step[small[i], small[j]]
    return Model(start, edges, tables, pair_edges, pairs)


def train(docs: DataFrame, labels: DataFrame, n: int = SAMPLE) -> Model:
    rows = labelled_texts(docs, labels, "quality", fold("k", 5) != 0, n)
    raw = [t.encode() for t, _ in rows]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    return fit(features(np.frombuffer(b"".join(raw), np.uint8), offsets), np.array([y for _, y in rows], float))


def op4(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Score every row of documents.

    A null text is empty; empty texts score as the all-zero feature row.  A null doc_id is never held out.
    Without labels of both classes every score is the smoothed share of label 1 (0.5 without any).
    """
    model = train(docs, labels)
    kind = dict(docs.dtypes)["doc_id"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = score(model, features(*string_buffers(batch.column(1))))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(s)], ["doc_id", "score"])

    out = map_batches(docs.select("doc_id", F.col("text").cast("string").alias("text")), work, f"doc_id {kind}, score double")
    return out.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
