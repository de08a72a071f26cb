"""Toxicity by a weighted lexicon.

Texts are folded (case, accents, homoglyphs, digits and signs that stand for letters, invisible
characters; look-alike letters only in words that are not wholly of their own script), terms are found with one Aho-Corasick automaton, hits inside exception phrases do not
count, and the weighted hits, plain and normalised by length, give a calibrated score.

The lexicon is a stated word list and the words and word stems that a bounded sample of labelled
documents shows to mark toxic texts; the weights are smoothed log odds from the same sample.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold, labelled_texts, map_batches, small_batches

#: Labelled documents that weights and calibration are learned from, at most.
SAMPLE = 8_000
#: Shortest and longest learned stems, in letters.
STEM = (4, 8)

# Insults of common use, folded.
TERMS = (
    "asshole bastard bitch clown crap creep cretin damn disgusting dumb dumbass fool freak garbage "
    "hateful hideous idiot idiotic imbecile jerk loser lunatic moron moronic pathetic pig psycho "
    "repulsive retard rubbish scum shit shut up slut stupid trash ugly vermin vile whore worthless "
    "abruti batard connard salaud idiota imbecil estupido basura idioten dummkopf abschaum arschloch"
).replace("shut up", "shut_up").split()
# Phrases in which a term is not meant as an insult.
EXCEPTIONS = (
    "trash can", "trash bin", "trash day", "trash collection", "take out the trash", "garbage collection",
    "garbage collector", "garbage truck", "clown fish", "circus clown", "guinea pig", "pig iron", "bird of prey",
    "sore loser rule", "ugly duckling", "not stupid", "not an idiot", "not worthless", "fool proof", "freak of nature",
)
# Letters of other scripts that look like Latin ones.
PAIRS = (
    "аa бb вb еe ѕs іi јj кk мm нh оo рp сc тt уy хx ԁd һh ԛq ԝw ɡg ѐe ёe ґr "
    "αa βb εe ηn ικ ιi κk νv οo ρp τt υu χx ωw γy σo ıi łl øo đd ɑa ɩi ʀr ɴn ʟl"
).split()
HOMOGLYPHS = {p[0]: p[1] for p in PAIRS if p[1].isascii()}
# Digits and signs that stand for letters.
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i"}
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"

_ALIKE = {ord(k): v for k, v in HOMOGLYPHS.items()}
_SOME_ALIKE = re.compile(f"[{''.join(HOMOGLYPHS)}]")
_INVISIBLE = dict.fromkeys(map(ord, INVISIBLE))
#: Letters of scripts that put no space between words (Thai to Khmer, kana, Han): their terms are pairs of letters.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff]")
#: A word of three letters or more in any script, with the vowel signs of Indic ones; or a run of unspaced letters.
_TERM = re.compile(f"{_UNSPACED.pattern}+|(?:(?!{_UNSPACED.pattern})[^\\W\\d_])(?:(?!{_UNSPACED.pattern})[^\\W\\d_]|[\u0900-\u0dff])" + "{2,}")
#: A run that mixes letters with digits or signs, from its first letter or digit to its last.
_MIXED = re.compile(r"(?:[^\W_]|[@$!](?=[^\W_]))+")
_HAS = re.compile(r"[0-9@$!][a-z]|[a-z][0-9]")
_MARKS = re.compile("[\u0300-\u036f]+")
_LEET = str.maketrans(LEET)


def _unleet(m: re.Match) -> str:
    word = m[0]
    if word.isalpha() or not any(c.isalpha() for c in word):
        return word
    return word.translate(_LEET)


def _unalike(m: re.Match) -> str:
    """A word's look-alike letters as Latin ones, unless it holds other letters of a script and no Latin one: then it is a word of that script."""
    word = m[0]
    if word.isascii() or not (any("a" <= c <= "z" for c in word) or all(c.isascii() or c in HOMOGLYPHS or not c.isalpha() for c in word)):
        return word
    return word.translate(_ALIKE)


def folded(text: str) -> str:
    """Lower case without accents; look-alike letters, digits and signs inside words become Latin letters."""
    if text.isascii():
        text = text.lower()
    else:
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text)).lower().translate(_INVISIBLE)
        if _SOME_ALIKE.search(text):
            text = _MIXED.sub(_unalike, text)
    return _MIXED.sub(_unleet, text) if _HAS.search(text) else text


@dataclass(frozen=True)
class Model:
    """Weights by term, exception phrases, and the logistic calibration of (plain, per-length) sums."""

    weights: tuple[tuple[str, float], ...]
    exceptions: tuple[str, ...] = EXCEPTIONS
    bias: float = -3.0
    plain: float = 1.0
    dense: float = 1.0


@lru_cache(maxsize=4)
def _automaton(model: Model):
    import ahocorasick

    auto = ahocorasick.Automaton()
    for term, weight in model.weights:
        word = term.rstrip("*").replace("_", " ")
        auto.add_word(word, (len(word), weight, term.endswith("*")))
    for phrase in model.exceptions:
        auto.add_word(phrase, (len(phrase), None, False))
    auto.make_automaton()
    return auto


def measure(model: Model, text: str) -> tuple[float, int]:
    """(sum of the weights of hits outside exception phrases, number of hits).

    Words match whole, stems match the beginning of a word, and pairs of unspaced letters anywhere; a place counts once,
    by its longest term.
    """
    text = folded(text)
    hits: dict[int, tuple[int, float]] = {}
    covered = []
    for end, (length, weight, stem) in _automaton(model).iter(text):
        start = end - length + 1
        if not _UNSPACED.match(text[start]) and ((start and text[start - 1].isalpha()) or (not stem and end + 1 < len(text) and text[end + 1].isalpha())):
            continue
        if weight is None:
            covered.append((start, end))
        elif start not in hits or hits[start][0] < end:
            hits[start] = (end, weight)
    if covered:
        hits = {at: h for at, h in hits.items() if not any(a <= at and h[0] <= b for a, b in covered)}
    return sum(w for _, w in hits.values()), len(hits)


def score(model: Model, total: float, length: int) -> float:
    if total <= 0:
        return 1 / (1 + math.exp(-model.bias))
    dense = total * 100 / max(20, length / 6)  # for each hundred words of about six characters
    z = model.bias + model.plain * math.log1p(total) + model.dense * math.log1p(dense)
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _sequence(text: str) -> list[str]:
    """The words of a text; of scripts without spaces, pairs of letters."""
    out = []
    for w in _TERM.findall(folded(text)):
        if _UNSPACED.match(w):
            out += [w[i : i + 2] for i in range(len(w) - 1)]
        else:
            out.append(w)
    return out


def learn_lexicon(rows: list[tuple[str, int]]) -> dict[str, float]:
    """Words and stems (with a final *) that mark toxic rows, with their log odds.

    Support is the number of distinct neighbourhoods of a word in toxic texts, so the words of a
    passage or document that is merely copied many times do not pass.  A stem needs several
    different words that begin with it; a word or stem that a longer one would repeat is not listed twice.
    """
    toxic = sum(y for _, y in rows)
    clean = len(rows) - toxic
    around: dict[str, set] = defaultdict(set)
    seen: list[Counter] = [Counter(), Counter()]
    number: dict[str, int] = {"": 0}
    for text, y in rows:
        words = _sequence(text)
        seen[y].update(set(words))
        if y:
            ids = [0, *[number.setdefault(w, len(number)) for w in words], 0]
            for w, a, b in zip(words, ids, ids[2:], strict=False):
                around[w].add(a << 32 | b)
    odds = lambda p, n: math.log((p + 0.5) / (toxic + 1)) - math.log((n + 0.5) / (clean + 1))
    stems: dict[str, list] = defaultdict(lambda: [0, 0, 0, 0])  # support, words, toxic rows, clean rows (at most)
    # support that chance gives no word of the vocabulary, were toxic rows any rows
    least = max(4.0, math.log(max(2, len(seen[0].keys() | seen[1].keys()))) / math.log(len(rows) / toxic))
    rare = {w for w in around if odds(seen[1][w], seen[0][w]) > 1}
    for w in rare:
        for k in range(STEM[0], min(STEM[1], len(w)) + 1):
            stems[w[:k]][0] += len(around[w])
            stems[w[:k]][1] += 1
    for y in (0, 1):
        for w, n in seen[y].items():
            for k in range(STEM[0], min(STEM[1], len(w)) + 1):
                if (x := stems.get(w[:k])) is not None:
                    x[3 - y] += n
    found: dict[str, float] = {}
    for s in sorted(stems, key=lambda s: (len(s), s)):
        support, words, p, n = stems[s]
        if support >= least and words >= 3 and (w := odds(min(p, toxic), n)) > 3 and n <= 0.02 * p and not any(s[:k] + "*" in found for k in range(STEM[0], len(s))):
            found[s + "*"] = w
    for t in around:
        n, p = seen[0][t], seen[1][t]
        if min(p, len(around[t])) >= least and (w := odds(p, n)) > 3 and not any(t[:k] + "*" in found for k in range(STEM[0], STEM[1] + 1)):
            found[t] = w
    families = Counter(t[:k] for t in found for k in range(STEM[0], min(STEM[1], len(t)) + 1))
    for t in around:  # words that begin as several found ones do need less support
        n, p = seen[0][t], seen[1][t]
        if t not in found and min(p, len(around[t])) >= 2 and odds(p, n) > 2 and any(families[t[:k]] >= 3 for k in range(STEM[0], min(STEM[1], len(t)) + 1)):
            if not any(t[:k] + "*" in found for k in range(STEM[0], STEM[1] + 1)):
                found[t] = odds(p, n)
    for t in TERMS:  # the stated words, unless the rows speak against one
        if t not in found and not (seen[0][t] >= 3 and odds(seen[1][t], seen[0][t]) < 1):
            found[t] = max(2.0, odds(seen[1][t], seen[0][t])) if seen[1][t] else 2.0
    return found


def fit(rows: list[tuple[str, int]]) -> Model:
    """Learn terms, weights and calibration; without both classes the stated list keeps equal weights."""
    toxic = sum(y for _, y in rows)
    if not toxic or toxic == len(rows):
        return Model(tuple((t, 3.0) for t in TERMS))
    draft = Model(tuple(sorted(learn_lexicon(rows).items())))
    x, y = [], np.array([y for _, y in rows], float)
    for text, _ in rows:
        total, _n = measure(draft, text)
        x.append((1.0, math.log1p(total), math.log1p(total * 100 / max(20, len(text) / 6))))
    x, w = np.array(x), np.zeros(3)
    ridge = np.diag([1e-3, 0.05, 0.05])
    for _ in range(30):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (p - y) + ridge @ w)
    return Model(draft.weights, bias=float(w[0]), plain=float(w[1]), dense=float(w[2]))


def score_frame(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """doc_id (or the columns in keep), with score and n_hits; a null or empty text scores as one without hits."""
    cols = keep or [id_col]
    kinds = dict(docs.dtypes)
    names = [f"c{i}" for i in range(len(cols))]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores, hits = [], []
        for text in batch.column(len(cols)).to_pylist():
            total, n = measure(model, text or "")
            scores.append(score(model, total, len(text or "")))
            hits.append(n)
        return pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(cols))], pa.array(scores, pa.float64()), pa.array(hits, pa.int64())], [*names, "score", "n_hits"])

    schema = ", ".join(f"{n} {kinds[c]}" for n, c in zip(names, cols, strict=True)) + ", score double, n_hits bigint"
    picked = docs.select(*[F.col(c).alias(n) for c, n in zip(cols, names, strict=True)], F.col(text_col).cast("string").alias("t"))
    return map_batches(picked, work, schema)


def train(docs: DataFrame, labels: DataFrame, among: Column | None = None, n: int = SAMPLE) -> Model:
    """Fit on at most n labelled documents; among: which (by column k, the id), by default crc32 mod 4 not 2."""
    return fit(labelled_texts(docs, labels, "toxic", fold("k", 4) != 2 if among is None else among, n))


def op7(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Score every document; a row a row of documents.

    Null and empty texts get the score of a text without hits.  A null doc_id is never held out.  An
    empty labels table leaves the stated word list with equal weights.
    """
    out = score_frame(docs, train(docs, labels)).withColumnRenamed("c0", "doc_id")
    return out.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "n_hits")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Pipeline stage: the documents that are not rejected, with every column as it was.

    The text itself is scored in a column beside the others, so repeated ids and null ids are each judged on
    their own text.
    """
    small_batches(docs.sparkSession)
    model = train(docs, labels)

    def judge(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: score(model, measure(model, t or "")[0], len(t or "")))

    return docs.filter(F.pandas_udf(judge, "double")(F.coalesce("text", F.lit(""))) < threshold)
