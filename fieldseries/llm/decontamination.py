"""Benchmark decontamination with an FM-index for each training shard.

A shard is a bounded run of documents of one task.  Their words become symbols of the benchmark's
vocabulary; only stretches whose neighbouring words are neighbours somewhere in the benchmark can
hold an occurrence, and only these are kept, in order, with a separator between them.  An FM-index
over them is searched backwards for all benchmark windows at once; occurrences are located through
sampled suffix positions and merged into removal spans.

The benchmark is read in blocks of bounded size.  Usually that is one block, in one pass over the
documents; a larger benchmark takes a pass for each block, and spans are merged by row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import BATCH_ROWS, drop_scratch, materialise
from .fm_index import FMIndex
from .textcore import ALNUM, mix, runs, string_buffers, word_hashes

WINDOW = 13
#: Bytes of benchmark text in a block: the bound of what each task is sent.
BLOCK_BYTES = 8 << 20
#: Candidate words and documents in a shard's index, about.
SHARD_WORDS, SHARD_DOCS = 1 << 20, 20_000
#: Bytes of rows that wait for their shard, about.
SHARD_BYTES = 16 << 20
_FILTER_BITS = 22


@dataclass(frozen=True)
class Phrases:
    """A block of the benchmark: vocabulary, neighbour filter, distinct windows and the items of each."""

    vocabulary: np.ndarray
    neighbours: np.ndarray
    windows: np.ndarray
    lengths: np.ndarray
    items: list[str]  # by name; the number after them stands for all items without an id
    first: np.ndarray  # window k belongs to items of[first[k]:first[k + 1]]
    of: np.ndarray
    shortest: int


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a.astype(np.uint64) * np.uint64(0x9E3779B1) + b.astype(np.uint64)) >> np.uint64(64 - _FILTER_BITS)


def phrases(rows: list[tuple[object, str | None]], size: int = WINDOW) -> Phrases:
    """Windows of the items; those without a word have none.  Rows of one id are one item."""
    rows = [(k, t) for k, t in rows if t]
    data, offsets = string_buffers(pa.array([t for _, t in rows], pa.string()))
    _, _, doc, h = word_hashes(data[offsets[0] : offsets[-1]] if len(rows) else data, offsets, ALNUM)
    vocabulary = np.unique(h)
    ids = np.searchsorted(vocabulary, h) + 1
    near = np.zeros(1 << _FILTER_BITS, bool)
    together = doc[1:] == doc[:-1]
    near[_pair(ids[:-1][together], ids[1:][together])] = True
    names = sorted({str(k) for k, _ in rows if k is not None})
    place_of = {k: i for i, k in enumerate(names)}
    number = np.array([len(names) if k is None else place_of[str(k)] for k, _ in rows], np.int64)
    count = np.bincount(doc, minlength=len(rows))
    starts = _ranges(np.where(count > 0, np.maximum(1, count - size + 1), 0))
    owner = np.repeat(np.arange(len(rows)), np.where(count > 0, np.maximum(1, count - size + 1), 0))
    length = np.minimum(count[owner], size)
    place = (np.cumsum(count) - count)[owner] + starts
    rows_of = np.zeros((len(owner), size), np.int32 if len(vocabulary) < 1 << 31 else np.int64)
    for k in range(size):
        some = length > k
        rows_of[some, k] = ids[place[some] + k]
    windows, which = np.unique(rows_of, axis=0, return_inverse=True) if len(owner) else (rows_of, np.zeros(0, np.int64))
    pair = np.unique(np.stack([which.reshape(-1), number[owner]], 1), axis=0) if len(owner) else np.zeros((0, 2), np.int64)
    first = np.r_[0, np.cumsum(np.bincount(pair[:, 0], minlength=len(windows)))]
    lengths = (windows > 0).sum(1)
    return Phrases(vocabulary, near, windows.astype(np.int64), lengths, names, first, pair[:, 1], int(lengths.min()) if len(windows) else 1 << 30)


def candidates(p: Phrases, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(words of each document, [symbol, document, word number, start byte, end byte] of the candidate words).

    A symbol 0 ends every stretch.
    """
    n = len(offsets) - 1
    total, parts = np.zeros(n, np.int64), []
    for a, b in runs(offsets):
        bounds = offsets[a : b + 1] - offsets[a]
        start, end, doc, h = word_hashes(data[offsets[a] : offsets[b]], bounds, ALNUM)
        count = np.bincount(doc, minlength=b - a)
        total[a:b] = count
        if not len(p.vocabulary) or not len(h):
            continue
        at = np.minimum(np.searchsorted(p.vocabulary, h), len(p.vocabulary) - 1)
        ids = np.where(p.vocabulary[at] == h, at + 1, 0)
        linked = (ids[:-1] > 0) & (ids[1:] > 0) & (doc[1:] == doc[:-1])
        where = np.flatnonzero(linked)
        linked[where] = p.neighbours[_pair(ids[where], ids[where + 1])]
        # stretches of linked words
        cut = np.flatnonzero(np.r_[True, ~linked])
        length = np.diff(np.append(cut, len(ids)))
        good = (length >= p.shortest) & (ids[cut] > 0)
        cut, length = cut[good], length[good]
        if not len(cut):
            continue
        words = np.repeat(cut, length + 1) + _ranges(length + 1)
        last = np.cumsum(length + 1) - 1
        words[last] -= 1
        symbol = ids[words]
        symbol[last] = 0
        number = words - (np.cumsum(count) - count)[doc[words]]
        low = bounds[doc[words]]
        parts.append(np.stack([symbol, doc[words] + a, number, start[words] - low, end[words] - low]))
    return total, list(np.concatenate(parts, 1)) if parts else [np.zeros(0, np.int64)] * 5


def _ranges(length: np.ndarray) -> np.ndarray:
    """0 .. length[0]-1, 0 .. length[1]-1, and so on."""
    return np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)


def occurrences(p: Phrases, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, window) of every occurrence in the shard's sequence."""
    index = FMIndex(symbol, len(p.vocabulary) + 1)
    lo, hi = index.search(p.windows, p.lengths)
    n = np.maximum(hi - lo, 0)
    window = np.repeat(np.arange(len(n)), n)
    return index.locate(np.repeat(lo, n) + _ranges(n)), window


_FOUND = "n_words bigint, spans array<struct<first_word:bigint,end_word:bigint,first_byte:bigint,end_byte:bigint>>, items array<string>"
_SPAN = pa.struct([("first_word", pa.int64()), ("end_word", pa.int64()), ("first_byte", pa.int64()), ("end_byte", pa.int64())])


def _shard(p: Phrases, rows: pa.Array, ids: pa.Array, total: np.ndarray, parts: list[np.ndarray]) -> pa.RecordBatch:
    n = len(total)
    symbol, doc, number, start, end = parts
    spans = (np.zeros(n + 1, np.int64), [np.zeros(0, np.int64)] * 4)
    items: tuple[np.ndarray, list[str]] = (np.zeros(n + 1, np.int64), [])
    if len(symbol):
        place, window = occurrences(p, symbol)
        cover = np.zeros(len(symbol) + 1, np.int64)
        np.add.at(cover, place, 1)
        np.add.at(cover, place + p.lengths[window], -1)
        hit = np.cumsum(cover[:-1]) > 0
        # merged spans: hit words that follow each other in a document (stretches never touch)
        first = np.flatnonzero(hit & ~np.r_[False, hit[:-1]])
        last = np.flatnonzero(hit & ~np.r_[hit[1:], False])
        spans = (np.r_[0, np.cumsum(np.bincount(doc[first], minlength=n))], [number[first], number[last] + 1, start[first], end[last]])
        k = p.first[window + 1] - p.first[window]
        pair = np.unique(np.repeat(doc[place], k) * (len(p.items) + 1) + p.of[np.repeat(p.first[window], k) + _ranges(k)])
        pair = pair[pair % (len(p.items) + 1) < len(p.items)]  # an item without an id hits words and has no name
        items = (np.r_[0, np.cumsum(np.bincount(pair // (len(p.items) + 1), minlength=n))], [p.items[i] for i in pair % (len(p.items) + 1)])
    arrays = [
        rows,
        ids,
        pa.array(total),
        pa.ListArray.from_arrays(pa.array(spans[0], pa.int32()), pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in spans[1]], fields=list(_SPAN))),
        pa.ListArray.from_arrays(pa.array(items[0], pa.int32()), pa.array(items[1], pa.string())),
    ]
    return pa.RecordBatch.from_arrays(arrays, ["row", "doc_id", "n_words", "spans", "items"])


def _search_block(docs: DataFrame, p: Phrases) -> DataFrame:
    schema = StructType([*docs.select("row", "doc_id").schema.fields, *StructType.fromDDL(_FOUND).fields])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        words = n = size = 0

        def flush() -> pa.RecordBatch:
            shift = np.cumsum([0, *(len(h[2]) for h in held)])
            parts = [np.concatenate([h[3][k] + (shift[i] if k == 1 else 0) for i, h in enumerate(held)]) for k in range(5)]
            out = _shard(p, pa.concat_arrays([h[0] for h in held]), pa.concat_arrays([h[1] for h in held]), np.concatenate([h[2] for h in held]), parts)
            held.clear()
            return out

        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                total, found = candidates(p, *string_buffers(part.column(2)))
                held.append((part.column(0), part.column(1), total, found))
                words, n, size = words + len(found[0]), n + len(total), size + part.column(1).nbytes
                if words >= SHARD_WORDS or n >= SHARD_DOCS or size >= SHARD_BYTES:
                    yield flush()
                    words = n = size = 0
        if held:
            yield flush()

    return docs.mapInArrow(task, schema)


def blocks(benchmark: DataFrame, limit: int = BLOCK_BYTES) -> Iterator[list[tuple[object, str | None]]]:
    """The benchmark's rows in blocks of about `limit` bytes of text; one block is on the driver at a time."""
    b = benchmark.select(F.col("item_id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    size = b.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // limit))
    for k in range(n):
        yield [(r.item_id, r.text) for r in (b if n == 1 else b.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)).collect()]


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, used: list[str] | None = None) -> DataFrame:
    """doc_id, n_words, spans (merged, in words and bytes of the text), items: one row a row of docs.

    A benchmark of one block takes one pass.  With more, the texts are numbered in a written table, so that a row has
    the same number in every pass, and each pass is written before the next block is read; `used` gets the table that is then returned.
    """
    read = docs.select(F.lit(0).cast("bigint").alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    parts = blocks(benchmark)
    first, second = next(parts), next(parts, None)
    if second is None:
        return _search_block(read, phrases(first, window)).drop("row")
    scratch: list[str] = []
    read = materialise(read.withColumn("row", F.monotonically_increasing_id()), "numbered", scratch)
    texts = read.select("row", F.lit(None).cast("bigint").alias("doc_id"), "text")
    passes = []
    block, rest = first, chain([second], parts)
    while block is not None:
        found = _search_block(texts, phrases(block, window))
        passes.append(materialise(found.filter(F.size("spans") > 0).select("row", "spans", "items") if passes else found.drop("doc_id"), "pass", scratch))
        block = next(rest, None)
    every = passes[0]
    for p in passes[1:]:
        every = every.unionByName(p, allowMissingColumns=True)
    merged = every.groupBy("row").agg(F.max("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    out = materialise(read.select("row", "doc_id").join(merged, "row").drop("row"), "found", used)
    drop_scratch(docs.sparkSession, scratch)
    return out


def n_hit() -> Column:
    """Words under the spans; spans of several blocks may overlap."""
    return F.aggregate("spans", F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("to")), lambda a, s: F.struct((a["n"] + F.greatest(s["end_word"] - F.greatest(s["first_word"], a["to"]), F.lit(0))).alias("n"), F.greatest(a["to"], s["end_word"]).alias("to")), lambda a: a["n"])


def op8(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's columns and the spans; a row a row of documents.

    Null and empty texts have no words, and an empty benchmark hits nothing.  Benchmark rows without a word have no
    window; rows that share an id are one item.  A row without an id hits words like any other, and as it has no
    name it counts neither in n_items nor in items_sha256.  A null doc_id stays null.
    """
    out = find(docs, benchmark).withColumn("n_hit", n_hit())
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
        "spans",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, used: list[str] | None = None) -> DataFrame:
    """Pipeline stage: documents that the rule does not call contaminated, with every column as it was.

    The text is judged beside its row, so repeated and null ids do not matter.
    """
    rule = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    numbered = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc_id"), F.col("text"))
    kept = find(numbered, benchmark, used=used).withColumn("n_hit", n_hit()).filter(~rule)
    return kept.select(*[F.col("doc_id").getField(c).alias(c) for c in docs.columns])
