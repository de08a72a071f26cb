"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is lower-cased and cut into words of letters; each word's character n-grams (as bytes, with
word boundaries) are hashed to rows of an embedding table; the mean of the rows goes through a
linear softmax.  Table and classifier are trained together by stochastic gradient descent in numpy.
Because averaging and the classifier are both linear, a trained model is folded into one small
table of class scores a bucket, and a text is scored by gathers and segment sums.

Confidence is calibrated by a temperature, and texts under a confidence that a share of the
calibration rows fall under are flagged `rejected`.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, map_batches, sampled_texts
from .textcore import mix, runs, string_buffers

#: Training documents, at most.
SAMPLE = 4_000
BUCKETS = 1 << 15
DIMENSIONS = 16
SIZES = (2, 3, 4)

#: Bytes that belong to words: ASCII letters and every byte of a character outside ASCII.
_LETTER = np.zeros(256, bool)
_LETTER[0x61:0x7B] = _LETTER[0x80:] = True
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)
#: Anything that Unicode calls a letter, for the rule on texts without one.
HAS_LETTER = r"\p{L}"


def subwords(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, document) of every n-gram of the texts; other bytes than letters are one blank, which n-grams may touch but not cross."""
    # a blank after each text, so that its last word ends alike wherever the text stands in a batch
    size = np.diff(bounds)
    owner = np.repeat(np.arange(len(size), dtype=np.int32), size + 1)
    n = len(owner)
    low = np.full(n, 0x20, np.uint8)
    low[np.arange(len(data)) + np.repeat(np.arange(len(size)), size)] = _FOLD[data]
    blank = low == 0x20
    value = low.astype(np.uint64)
    buckets, docs = [], []
    for size in SIZES:
        m = n - size + 1
        if m <= 0:
            continue
        total = np.zeros(m, np.uint64)
        inside = np.ones(m, bool)
        for k in range(size):
            total = total * np.uint64(257) + value[k : k + m]
            if 0 < k < size - 1:
                inside &= ~blank[k : k + m]
        inside &= ~(blank[:m] & blank[size - 1 :])
        inside &= owner[:m] == owner[size - 1 :]
        hashed = mix(total[inside] + np.uint64(size << 56)) >> np.uint64(64 - 15)
        buckets.append(hashed.astype(np.int32))
        docs.append(owner[:m][inside])
    if not buckets:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    return np.concatenate(buckets), np.concatenate(docs)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    table: np.ndarray  # BUCKETS x languages, temperature applied
    bias: np.ndarray
    reject_under: float


def _features(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct buckets and their shares, a text."""
    out = []
    for t in texts:
        raw = np.frombuffer(t.encode(), np.uint8)
        b, _ = subwords(raw, np.array([0, len(raw)]))
        u, c = np.unique(b, return_counts=True)
        out.append((u, c / max(1, c.sum())))
    return out


def fit(rows: list[tuple[str, str]], epochs: int = 6, rate: float = 2.0, seed: int = 7) -> Model:
    """Train on (text, language) rows; a fifth of them only calibrates."""
    languages = tuple(sorted({y for _, y in rows}))
    if not languages:
        return Model((), np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32), 0.0)
    rng = np.random.default_rng(seed)
    y = np.array([languages.index(v) for _, v in rows])
    x = _features([t for t, _ in rows])
    order = rng.permutation(len(rows))
    hold = order[: len(rows) // 5]
    learn = order[len(rows) // 5 :]
    emb = (rng.random((BUCKETS, DIMENSIONS)) - 0.5) / DIMENSIONS
    out, bias = np.zeros((DIMENSIONS, len(languages))), np.zeros(len(languages))
    steps, done, size = max(1, epochs * -(-len(learn) // 16)), 0, 16
    for _ in range(epochs):
        learn = rng.permutation(learn)
        for a in range(0, len(learn), size):
            some = learn[a : a + size]
            lr = rate * (1 - done / steps)
            done += 1
            mean = np.stack([x[i][1] @ emb[x[i][0]] for i in some])
            z = mean @ out + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(some)), y[some]] -= 1
            back = p @ out.T
            out -= lr * mean.T @ p / len(some) * 4
            bias -= 0.1 * lr * p.mean(0)
            for k, i in enumerate(some):
                emb[x[i][0]] -= lr * x[i][1][:, None] * back[k]
    table = emb @ out
    held = np.stack([x[i][1] @ table[x[i][0]] + bias for i in hold]) if len(hold) else np.zeros((0, len(languages)))

    def loss(t: float) -> float:
        z = held * t
        z -= z.max(1, keepdims=True)
        return float((np.log(np.exp(z).sum(1)) - z[np.arange(len(hold)), y[hold]]).mean())

    grid = [2.0**k for k in np.arange(-3, 4.01, 0.25)]
    best = min(grid, key=loss) if len(hold) >= 20 else 1.0
    z = held * best
    conf = np.exp(z - z.max(1, keepdims=True))
    conf = 1 / conf.sum(1) if len(conf) else np.ones(1)
    return Model(languages, (table * best).astype(np.float32), (bias * best).astype(np.float32), float(np.quantile(conf, 0.01)))


def predict(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the language, its probability) of each text, from whole texts."""
    n = len(offsets) - 1
    best, score = np.zeros(n, np.int64), np.zeros(n)
    for a, b in runs(offsets, 1 << 18):
        bounds = offsets[a : b + 1] - offsets[a]
        bucket, doc = subwords(data[offsets[a] : offsets[b]], bounds)
        count = np.maximum(1, np.bincount(doc, minlength=b - a))
        z = np.stack([np.bincount(doc, weights=model.table[:, k][bucket], minlength=b - a) for k in range(len(model.languages))], 1)
        z = z / count[:, None] + model.bias
        z -= z.max(1, keepdims=True)
        p = np.exp(z)
        p /= p.sum(1, keepdims=True)
        best[a:b] = p.argmax(1)
        score[a:b] = p.max(1)
    return best, score


def train(docs: DataFrame, n: int = SAMPLE) -> Model:
    """Fit on at most n documents with a language, none of the held-out fold; equal ids count once."""
    known = docs.select(F.col("doc_id").alias("k"), "lang").filter((fold("k", 4) != 2) & F.col("k").isNotNull() & F.col("lang").isNotNull())
    return fit(sampled_texts(docs, known.groupBy("k").agg(F.min("lang").alias("y")), n))


def op6(docs: DataFrame) -> DataFrame:
    """The language of every row of documents.

    `und` with score 0 for a null text, one without a letter, and where no language was learned (empty table
    included).  `rejected` flags a confidence under the calibrated limit; the prediction stays.  A null
    doc_id is never held out.
    """
    model = train(docs)
    kind = dict(docs.dtypes)["doc_id"]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = string_buffers(batch.column(1))
        if model.languages:
            best, score = predict(model, data, offsets)
            names = pa.array([model.languages[k] for k in best], pa.string())
        else:
            score, names = np.zeros(batch.num_rows), pa.array(["und"] * batch.num_rows, pa.string())
        return pa.RecordBatch.from_arrays([batch.column(0), names, pa.array(score), batch.column(2)], ["doc_id", "lang", "score", "ok"])

    read = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.coalesce(F.col("text").rlike(HAS_LETTER), F.lit(False)).alias("ok"))
    out = map_batches(read, work, f"doc_id {kind}, lang string, score double, ok boolean")
    known = F.col("ok") & (F.col("lang") != "und")
    return out.select(
        "doc_id",
        (fold("doc_id", 4) == 2).alias("held_out"),
        F.when(known, F.col("lang")).otherwise("und").alias("lang_pred"),
        F.when(known, F.col("score")).otherwise(0.0).alias("score"),
        (~known | (F.col("score") < model.reject_under)).alias("rejected"),
    )
