"""Operators 11 to 13 against brute force, on whole tables and on awkward rows."""

import math
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldseries.llm import lexical_search, token_counts, whitening
from fieldseries.llm.common import table

SF = "/root/testdata/sf0.001"
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string, item_id string, score double, row string, n string, term int, rest string"


# --- op11


def ranked(docs, items, k=10):
    held = [(i, Counter(TERM.findall((t or "").translate(UP)))) for i, t in docs]
    n_docs, total = sum(1 for _, c in held if c), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in held:
            m = 10 + 90 * sum(c.values()) * n_docs // total if total else 10
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(TERM.findall((text or "").translate(UP))) if c[t])
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scores, key=lambda x: x[:2] + (x[2] or 0,))[:k], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted([tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()], key=str)


def pairs(df, key):
    return [(r[key], r.text) for r in df.collect()]


def test_search_ranks_whole_table(spark):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    assert got(lexical_search.op11(docs, items)) == ranked(pairs(docs, "doc_id"), pairs(items, "item_id"))


def test_search_awkward_rows(spark):
    texts = [None, "", " !\n", "Alpha beta", "ALPHA alpha beta", "été ÉTÉ naïve", "x" * 300_000, "alpha " * 50_000, *["gamma delta"] * 40, "gamma", "alpha beta"]
    rows = [(i, t, "i", 0.5, "r", "n", 1, None) for i, t in enumerate(texts)] + [(None, "gamma delta", *[None] * 6), (3, "Alpha beta", *[None] * 6)]
    items = [(1, "alpha, ALPHA"), (None, "gamma delta"), (1, "alpha, ALPHA"), (2, None), (3, "..."), (4, "été"), (5, "nowhere"), (6, " ".join(f"t{i}" for i in range(3000)) + " beta")]
    docs, asked = spark.createDataFrame(rows, DOCS).repartition(7), spark.createDataFrame([(*i, 9) for i in items], "item_id int, text string, doc_id int")
    want = ranked([r[:2] for r in rows], items)
    assert got(lexical_search.op11(docs, asked)) == want
    assert got(lexical_search.search(docs, asked, block_bytes=4000)) == want  # several blocks of items
    assert got(lexical_search.op11(docs.limit(0), asked)) == []
    assert got(lexical_search.op11(docs, asked.limit(0))) == []


def test_search_small_tiles_and_holds(spark, monkeypatch):
    for name, value in (("ITEMS", 3), ("TERMS", 4), ("DOCS", 7), ("HELD", 5)):
        monkeypatch.setattr(lexical_search, name, value)
    docs, items = table(spark, SF, "documents").limit(60), table(spark, SF, "benchmark").limit(7)
    block = lexical_search.Block.of(pairs(items, "item_id"))
    scores = [lexical_search.tile_scores(block, at, np.array([0, 0, 1]), np.array([0, 5, 9]), np.array([1 << 52, 1 << 52, 7]), 2) for at in range(0, 7, 3)]
    want = [[sum(v for d, t, v in ((0, 0, 1 << 52), (0, 5, 1 << 52), (1, 9, 7)) if d == doc and t in own) for own in block.held] for doc in (0, 1)]
    assert np.array_equal(np.concatenate(scores, 1), want)  # sums of 2**53 from tiles that each stay below it


def test_search_keeps_ties_over_tasks(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "same words here").otherwise("others").alias("text")).repartition(40)
    items = spark.createDataFrame([(7, "words"), (8, "here words")], "item_id long, text string")
    out = lexical_search.op11(docs, items).collect()
    assert {(r.item_id, r["rank"], r.doc_id) for r in out} == {(i, k + 1, 2 * k) for i in (7, 8) for k in range(10)}
    assert len({(r.item_id, r.score) for r in out}) == 2


def test_lengths_beyond_64_bits():
    assert lexical_search.lengths(np.array([1 << 40]), 1 << 40, 1 << 70).tolist() == [10 + 90 * (1 << 80) // (1 << 70)]


# --- op12


def brute(rows, k=16):
    """Rows of (vec_id, component, n, deviation, |whitened|, explained), eigenvectors by LAPACK in float64."""
    held = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows]
    fit = sorted({tuple(x) for _, x in held})
    n, d = len(fit), len(fit[0])
    s = [sum(x[j] for x in fit) for j in range(d)]
    centred = np.array([[float(Fraction(n * x[j] - s[j], n)) for j in range(d)] for x in fit])
    v = centred.T @ centred / n
    e, p = np.linalg.eigh(v)
    e, p = e[::-1], p[:, ::-1]
    out = []
    for i, x in held:
        y = np.array([float(Fraction(n * x[j] - s[j], n)) for j in range(d)])
        out += [(i, c + 1, n, sum((n * x[j] - s[j]) ** 2 for j in range(d)), abs(y @ p[:, c]) / math.sqrt(e[c]), e[c] / np.trace(v)) for c in range(min(k, d))]
    return out, s


def test_whitening_whole_table(spark):
    vectors = table(spark, SF, "embeddings")
    want, _ = brute([(r.vec_id, r.embedding) for r in vectors.collect()])
    rows = whitening.op12(vectors).collect()
    ours = {(r.vec_id, r.component): r for r in rows}
    assert len(rows) == len(want) == 16 * vectors.count()
    for i, c, n, deviation, white, share in want:
        r = ours[i, c]
        assert (r.n, r.deviation) == (n, deviation)
        assert abs(abs(r.whitened) - white) < 1e-6 and abs(r.explained - share) < 1e-9
    assert {r.identity_error for r in rows} == {rows[0].identity_error} and rows[0].identity_error < 1e-9
    signs = {}
    for c in (1, 16):  # one sign for all rows: whitened components have mean zero and unit variance
        x = np.array([r.whitened for r in rows if r.component == c])
        signs[c] = abs(x.mean()), abs((x * x).mean() - 1)
    assert max(max(v) for v in signs.values()) < 1e-6


def test_whitening_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(3)
    good = [(i, rng.normal(size=3).round(3).tolist()) for i in range(50)]
    bad = [(100, None), (101, [1.0, None, 2.0]), (102, [nan, 1.0, 2.0]), (103, [inf, 0.0, 0.0]), (104, []), (105, [1.0, 2.0]), (106, [3e38, 1.0, 1.0])]
    rows = good + bad + [good[0], (None, good[1][1])] + [(200 + i, good[2][1]) for i in range(300)]
    df = spark.createDataFrame([(i, v, 5, "x") for i, v in rows], "vec_id int, embedding array<float>, n int, x string").repartition(5)
    usable = [r for r in rows if r not in bad]
    want, _ = brute(usable)
    ours = whitening.op12(df).collect()
    keyed = sorted((str(r.vec_id), r.component, r.n, r.deviation, round(abs(r.whitened), 6), round(r.explained, 9)) for r in ours)
    assert keyed == sorted((str(i), c, n, dev, round(w, 6), round(float(x), 9)) for i, c, n, dev, w, x in want)
    assert whitening.op12(df.limit(0)).collect() == []
    same = spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.5, 0.5])], "vec_id int, embedding array<double>")
    assert [tuple(r) for r in whitening.whiten(same).select("n", "deviation", F.size("whitened")).collect()] == [(1, 0, 0)] * 2
    far = spark.createDataFrame([(1, [0.0, 1e12]), (2, [1.0, -1e12]), (3, [3.0, 5.0])], "vec_id int, embedding array<double>")
    assert {r.deviation for r in whitening.whiten(far).collect()} >= {None}


def test_refinement_of_clusters():
    rng = np.random.default_rng(0)
    q = np.linalg.qr(rng.normal(size=(24, 24)))[0].astype(np.longdouble)
    for _ in range(3):  # orthogonal to extended precision
        q = q @ (1.5 * np.eye(24, dtype=np.longdouble) - 0.5 * (q.T @ q))
    values = np.longdouble([9, 5 + 3e-9, 5 + 2e-9, 5 + 1e-9, 5, 3, 2 + 1e-12, 2, *np.linspace(1, 0.1, 12), 1e-3, 1e-3, 1e-3, 0])
    a = (q * values) @ q.T
    e, x = whitening.refined((a + a.T) / 2)
    assert np.abs(e - np.sort(values)[::-1]).max() < 1e-17
    assert np.abs(x.T @ x - np.eye(24)).max() < 1e-17
    assert np.abs(a @ x - x * e).max() < 1e-17
    tight = np.abs((q[:, 1:5].T @ x[:, 1:5])) - np.eye(4)
    assert np.abs(tight).max() < 1e-8  # gaps of 1e-9, far below float32
    assert whitening.refined(np.zeros((3, 3)))[0].tolist() == [0, 0, 0]


# --- op13


def whole(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(token_counts.default_tokenizer())
    return [len(t.encode(x or "", add_special_tokens=False).ids) for x in texts]


ODD = [None, "", " \n\t", "It's WE'LL o'd!'s 12,345", "été É é ñ ΑΣ ΣΑΣ. ǅ İstanbul ﬁ ½ 漢字かな ไทย", "a<|endoftext|>b <|startoftext|> <|endoftext|", "<|endoftext|><|endoftext|>", "  x​y\x85z", "x\x0by\x0cz\x1c\x1d", "w" * 200_000, "word " * 60_000, "🙂🙃 👩‍👩‍👧 #!@$%", "a\x00b\x01 \x7f", "﻿a �"]


def test_counts_whole_table(spark):
    docs = table(spark, SF, "documents")
    rows = docs.select("doc_id", "text").collect()
    want = {r.doc_id: (len((r.text or "").encode()), n, n > 2048) for r, n in zip(rows, whole([r.text for r in rows]), strict=True)}
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.op13(docs).collect()} == want


@pytest.mark.parametrize("frequent", [0, 5, 65_536])
def test_counts_awkward_rows(spark, frequent):
    rows = [(i, t, "i", 0.5, "r", "n", 1, "x") for i, t in enumerate(ODD)] + [(None, ODD[4], *[None] * 6), (3, ODD[3], *[None] * 6), (3, ODD[3], *[None] * 6)]
    out = token_counts.count_tokens(spark.createDataFrame(rows, DOCS).repartition(5), n_frequent=frequent).collect()
    want = sorted((str(r[0]), len((r[1] or "").encode()), n) for r, n in zip(rows, whole([r[1] for r in rows]), strict=True))
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in out) == want
    assert token_counts.op13(spark.createDataFrame([], DOCS)).collect() == []


def test_counts_small_holds(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "HELD", 3)
    docs = table(spark, SF, "documents").limit(50)
    words = token_counts.vocabulary(docs, token_counts.default_tokenizer())
    assert words.count() == words.select("pre_token").distinct().count()


def test_counts_with_another_tokenizer(spark):
    """One that keeps white space: whole texts are cut by the library itself."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    t, texts = Tokenizer.from_file(path), [x or "" for x in ODD[:8]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    assert {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, path).collect()} == {i: len(t.encode(x, add_special_tokens=False).ids) for i, x in enumerate(texts)}
