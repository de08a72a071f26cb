"""Scores of the learned operators, row by row, against plain scorers of one text at a time; bounds; SQL."""

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from fieldseries.llm import language_id, packing, quality_model, queries, toxicity
from fieldseries.llm.common import table
from fieldseries.llm.textcore import mix

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


@pytest.fixture(scope="module")
def labels(spark):
    return table(spark, SF, "labels")


def by_id(df, *columns):
    return {r.doc_id: tuple(r[c] for c in columns) for r in df.collect()}


def plain_toxicity(model, text):
    """Every term and phrase searched for at every place."""
    text = toxicity.folded(text)
    hits, covered = {}, []
    terms = [(t.rstrip("*").replace("_", " "), w, t.endswith("*")) for t, w in model.weights] + [(p, None, False) for p in model.exceptions]
    for word, weight, stem in terms:
        at = text.find(word)
        while at >= 0:
            end = at + len(word)
            if not (at and text[at - 1].isalpha()) and (stem or not (end < len(text) and text[end].isalpha())):
                if weight is None:
                    covered.append((at, end))
                elif at not in hits or hits[at][0] < end:
                    hits[at] = (end, weight)
            at = text.find(word, at + 1)
    return sum(w for a, (e, w) in hits.items() if not any(x <= a and e <= y for x, y in covered))


def test_toxicity_scores_by_hand(docs, labels):
    model = toxicity.train(docs, labels)
    got = by_id(toxicity.op7(docs, labels), "score", "predicted")
    for r in docs.collect():
        total, length = plain_toxicity(model, r.text or ""), len(r.text or "")
        z = model.bias + (model.plain * math.log1p(total) + model.dense * math.log1p(total * 100 / max(20, length / 6)) if total > 0 else 0)
        score = 1 / (1 + math.exp(-max(-30, min(30, z))))
        assert got[r.doc_id][0] == pytest.approx(score, abs=1e-9) and got[r.doc_id][1] == int(got[r.doc_id][0] >= 0.3)


def plain_subwords(text):
    """The n-grams of a text's words, byte by byte; a blank may stand at an end of one."""
    low = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in text.encode())
    for size in language_id.SIZES:
        for i in range(len(low) - size + 1):
            gram = low[i : i + size]
            if 32 not in gram[1:-1] and not (gram[0] == 32 and gram[-1] == 32):
                value = 0
                for b in gram:
                    value = value * 257 + b
                yield int(mix(np.array([value + (size << 56)], np.uint64))[0] >> np.uint64(49))


def test_languages_by_hand(docs):
    model = language_id.train(docs)
    got = by_id(language_id.op6(docs), "lang_pred", "score")
    for r in sorted(docs.collect(), key=lambda r: len(r.text or ""))[:120]:
        text = r.text or ""
        if not re.search(r"[^\W\d_]", text):
            assert got[r.doc_id] == ("und", 0.0)
            continue
        grams = Counter(plain_subwords(text + " "))
        z = sum((n * model.table[k].astype(float) for k, n in grams.items()), np.zeros(len(model.languages))) / max(1, sum(grams.values())) + model.bias
        p = np.exp(z - z.max())
        assert got[r.doc_id][0] == model.languages[int(p.argmax())] and got[r.doc_id][1] == pytest.approx(float(p.max() / p.sum()), abs=1e-6)


def plain_features(text):
    """Some of the statistics, from the words themselves."""
    raw = text.encode()
    words = re.findall(rb"[^\x20\x09-\x0d]+", raw)
    low = [w.lower() if w.isascii() else bytes(b + 32 if 65 <= b <= 90 else b for b in w) for w in words]
    n = max(1, len(words))
    lines = [x for x in raw.split(b"\n") if x]
    kinds = [bytes(b + 32 if 65 <= b <= 90 else b for b in x) for x in lines]

    def repeated(size):
        grams = [tuple(low[i : i + size]) for i in range(len(low) - size + 1)] if len(low) >= size else [tuple(low)] if low else []
        c = Counter(grams)
        return sum(v for v in c.values() if v > 1) / n

    return {
        "log_bytes": math.log1p(len(raw)), "log_words": math.log1p(len(words)), "long_word": max(map(len, words), default=0),
        "upper": sum(65 <= b <= 90 for b in raw) / max(1, len(raw)), "distinct_words": len(set(low)) / n, "top_word": max(Counter(low).values(), default=0) / n,
        "repeat_3": repeated(3), "repeat_6": repeated(6), "duplicate_lines": (len(lines) - len(set(kinds))) / max(1, len(lines)), "lines_per_word": len(lines) / n,
    }


def test_quality_scores_by_hand(docs, labels):
    """Features from the words, and the tables looked up one at a time."""
    model = quality_model.train(docs, labels)
    rows = docs.collect()
    raw = [(r.text or "").encode() for r in rows]
    x = quality_model.features(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    got = by_id(quality_model.op4(docs, labels), "score")
    for r, row in zip(rows, x, strict=True):
        for name, value in plain_features(r.text or "").items():
            assert row[quality_model.FEATURES.index(name)] == pytest.approx(value, abs=1e-9), (r.doc_id, name)
        z = model.intercept
        for j, t in enumerate(model.tables):
            z += t[sum(e <= row[j] for e in model.edges[j])]
        for i, j, t in model.pairs:
            z += t[sum(e <= row[i] for e in model.pair_edges[i]), sum(e <= row[j] for e in model.pair_edges[j])]
        assert got[r.doc_id][0] == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, z)))), abs=1e-9)


def test_null_ids_are_in_no_fold(spark, docs, labels):
    odd = spark.createDataFrame([(None, "a text", "en"), (1, "another", "en")], "doc_id long, text string, lang string")
    for out in (quality_model.op4(odd, labels), toxicity.op7(odd, labels), language_id.op6(odd)):
        assert [r.held_out for r in out.collect() if r.doc_id is None] == [False]


def plain_bound(lengths, size):
    """The families of dual feasible functions, one length at a time."""
    best = -(-sum(lengths) // size)
    for t in range(1, size // 2 + 1):
        best = max(best, sum(x > size - t for x in lengths) + -(-sum(x for x in lengths if t <= x <= size - t) // size))
    for k in range(1, 21):
        total = sum(k * x if (k + 1) * x % size == 0 else (k + 1) * x // size * size for x in lengths)
        best = max(best, -(-total // (k * size)))
    return best


def test_bounds_and_bins_of_each_partition(spark):
    rng = np.random.default_rng(5)
    for size, n in ((64, 400), (100, 150), (2048, 60)):
        lengths = rng.integers(1, size + 1, n).tolist()
        assert packing.dual_feasible_bound(np.array(lengths), size) == plain_bound(lengths, size)
    lengths = [int(x) for x in rng.integers(1, 65, 900)]
    df = spark.createDataFrame(list(enumerate(lengths)), "row long, length long")
    out = packing.pack(df, 64, part_pieces=150).toPandas()
    assert sorted(out.row) == list(range(900))
    of = dict(enumerate(lengths))
    for part, g in out.groupby(out.sequence_id // (1 << 24)):
        assert g.sequence_id.nunique() <= g.part_bins.iloc[0] and g.part_bound.iloc[0] <= g.part_bins.iloc[0], part
    assert (out.assign(n=out.row.map(of)).groupby("sequence_id").n.sum() <= 64).all()
    assert plain_bound(lengths, 64) <= out.sequence_id.nunique() <= plain_bound(lengths, 64) * 1.02 + 1


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    theirs = con.execute(queries.ORACLE_SQL[name]).df()
    ours = queries.QUERIES[name](spark, SF).toPandas()[list(theirs.columns)]
    key = lambda d: Counter(tuple(None if v != v else v for v in r) for r in d.astype(object).itertuples(index=False))
    assert key(ours) == key(theirs)


#: Insults and plain words by script; the insults are invented, and only the labels say what they are.
SCRIPTS = {
    "cyrillic": ("дрянькин мразловец гнидоух", "дорога погода письмо работа вечер книга город"),
    "greek": ("ζυμπραξ φλεγμθος ψωρδιλας", "δρομος καιρος γραμμα βραδυ βιβλιο ψωμι δεντρο"),
    "arabic": ("خسيسون لئيمقط وغدشار", "طريق طقس رسالة مساء كتاب مدينة شجرة"),
    "han": ("蠢驢 笨豬 垃圾人", "今天 天氣 朋友 城市 書本 晚上 工作"),
    "devanagari": ("नीचकर दुष्टमल पाजीपन", "रास्ता मौसम चिट्ठी शाम किताब शहर पेड़"),
}


@pytest.mark.parametrize("script", SCRIPTS)
def test_lexicon_in_every_script(script):
    import random

    from fieldseries.llm import toxicity

    rng = random.Random(5)
    bad, plain = (x.split() for x in SCRIPTS[script])
    join = "" if script == "han" else " "

    def text(toxic: bool) -> str:
        words = [rng.choice(plain) for _ in range(40)]
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        return join.join(words)

    rows = [(text(k % 5 == 0), int(k % 5 == 0)) for k in range(400)]
    model = toxicity.fit(rows[:300])
    told = [(toxicity.score(model, toxicity.measure(model, t)[0], len(t)) >= 0.3) == bool(y) for t, y in rows[300:]]
    assert sum(told) >= 0.97 * len(told)


def test_folding_knows_scripts():
    from fieldseries.llm.toxicity import folded

    assert folded("ІDIOT Ідіот idіоt") == "idiot ідіот idiot"  # a look-alike among Latin letters, a word of its own script, mixed
    assert folded("соре хуур") == "cope xyyp"  # look-alikes only: the same for every text
    assert folded("дорога εδώ") == "дорога εδω"
    assert folded("1d10t id\u200biot STUPID") == "idiot idiot stupid"


def test_a_tokenizer_that_keeps_space_gets_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    whole, ours = Tokenizer.from_file(path), packing.Encoder(path)
    for text in ("a  b", " it's\n\n  so\t", "", "été  x"):
        assert np.frombuffer(ours(text.encode()), "<u4").tolist() == [*whole.encode(text, add_special_tokens=False).ids, 0]
    assert not ours.cut and packing.Encoder(packing.default_tokenizer()).cut


def test_spans_merge_in_a_sort():
    import pyarrow as pa

    from fieldseries.llm.suffix_dedup import merged_spans

    many = [{"a": 10 * i, "b": 10 * i + 5} for i in range(200_000)]
    rows = [[], [{"a": 5, "b": 9}, {"a": 1, "b": 3}, {"a": 3, "b": 4}, {"a": 6, "b": 7}], many[::-1]]
    kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
    out = merged_spans(pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array([1, 2, 3]), pa.array(rows, kind)], ["d0", "d1", "s"]))
    assert out.column(2).to_pylist() == [[], [{"a": 1, "b": 4}, {"a": 5, "b": 9}], many]
