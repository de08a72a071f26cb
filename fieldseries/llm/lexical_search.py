"""Ranked lexical search of all documents for a stated set of items, as dense blocked matrix products.

1. Items come in blocks of bounded text.  A block's terms are its vocabulary, as small numbers.
2. One pass over the documents counts their terms and writes the vocabulary's ones as (term, times).
3. Document frequencies come from that table; they and the counts give each term of a document an
   integer impact.
4. Tiles of items (0/1 over the tile's own vocabulary) are multiplied with tiles of documents
   (impacts) in float64.  A tile is narrow enough for every partial sum to stay below 2**53, so
   products are exact in any order; tiles are added up as 64-bit integers.
5. A tile keeps each item's best documents with ties decided by id, then a task, then groups of
   tasks, then all.  What moves is some rows an item and task, whatever the documents hold.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import BATCH_ROWS, drop_scratch, give_back, map_batches, materialise, small_batches

#: Bytes of item texts in a block, about: what the driver and each task hold of the items.
BLOCK_BYTES = 4 << 20
#: Items, terms and documents in a tile.
ITEMS, TERMS, DOCS = 128, 1024, 1024
#: Candidates that a task holds before it keeps the best of them only.
HELD = 65_536
#: Groups of tasks whose best documents meet before all meet.
GROUPS = 16

#: Letters and digits as they are (A-Z in lower case), the bytes of other characters too; everything else ends a term.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


@dataclass
class Block:
    """Some items: their ids, their terms as numbers of the block's vocabulary, and tiles of both."""

    ids: list
    numbers: dict[bytes, int]
    held: list[np.ndarray]
    tiles: dict[int, tuple] = field(default_factory=dict)

    @staticmethod
    def of(rows: list[tuple[object, str | None]]) -> Block:
        numbers: dict[bytes, int] = {}
        held = [np.array(sorted({numbers.setdefault(t, len(numbers)) for t in terms((text or "").encode())}), np.int64) for _, text in rows]
        return Block([i for i, _ in rows], numbers, held)

    def tile(self, at: int) -> tuple[np.ndarray, np.ndarray]:
        """(place of each vocabulary term in the tile or -1, items x places as 0/1) of the items from `at` on."""
        if at not in self.tiles:
            own = self.held[at : at + ITEMS]
            vocabulary = np.unique(np.concatenate(own))
            place = np.full(len(self.numbers), -1, np.int64)
            place[vocabulary] = np.arange(len(vocabulary))
            matrix = np.zeros((len(own), len(vocabulary)))
            for k, t in enumerate(own):
                matrix[k, place[t]] = 1
            if len(self.tiles) >= 8:
                self.tiles.pop(next(iter(self.tiles)))
            self.tiles[at] = place, matrix
        return self.tiles[at]


def blocks(items: DataFrame, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The items (`item_id`, `text`) in blocks of about `limit` bytes of text, one on the driver at a time."""
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-size // limit))
    for k in range(n):
        yield Block.of([(r.item_id, r.text) for r in (items if n == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)).collect()])


def postings(docs: DataFrame, block: Block) -> DataFrame:
    """doc_id, n (terms with repeats), term and times (arrays over the block's vocabulary): a row a document with a term."""
    kind, numbers = dict(docs.dtypes)["doc_id"], docs.sparkSession.sparkContext.broadcast(block.numbers)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        find, keep, n, at, term, times = numbers.value.get, [], [], [0], [], []
        for k, text in enumerate(batch.column(1).cast(pa.large_binary()).fill_null(b"").to_pylist()):
            if not (words := terms(text)):
                continue
            found = Counter(map(find, words))
            found.pop(None, None)
            keep.append(k)
            n.append(len(words))
            term.extend(found.keys())
            times.extend(found.values())
            at.append(len(term))
        at = pa.array(at, pa.int32())
        columns = [batch.column(0).take(pa.array(keep, pa.int64())), pa.array(n, pa.int64()), pa.ListArray.from_arrays(at, pa.array(term, pa.int32())), pa.ListArray.from_arrays(at, pa.array(times, pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "term", "times"])

    return map_batches(docs, work, f"doc_id {kind}, n bigint, term array<int>, times array<bigint>")


def document_frequencies(found: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each of the block's `size` terms; counted in the tasks, summed by Spark."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, np.int64)
        for batch in batches:
            held += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(held[at])], ["term", "df"])

    rows = found.select("term").mapInArrow(task, "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(size, np.int64)
    out[rows["term"].to_numpy()] = rows["df"].to_numpy()
    return out


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)


def lengths(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of documents of n terms, exact where 90 * n * N leaves 64 bits too."""
    if len(n) and 90 * int(n.max()) * n_docs >= 1 << 63:
        return np.array([10 + 90 * x * n_docs // n_terms for x in n.tolist()], np.int64)
    return 10 + 90 * n * n_docs // n_terms


def tile_scores(block: Block, at: int, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n: int) -> np.ndarray:
    """Scores (documents x items) of the n documents of a tile for the items from `at` on, as exact integers."""
    place, matrix = block.tile(at)
    where = place[term]
    inside = where >= 0
    doc, where, impact = doc[inside], where[inside], impact[inside]
    width = min(TERMS, max(1, ((1 << 53) - 1) // max(1, int(impact.max(initial=0)))))
    scores = np.zeros((n, len(matrix)), np.int64)
    for a in range(0, matrix.shape[1], width):
        own = (where >= a) & (where < a + width)
        dense = np.zeros((n, min(width, matrix.shape[1] - a)))
        dense[doc[own], where[own] - a] = impact[own]
        scores += (dense @ matrix[:, a : a + width].T).astype(np.int64)
    return scores


def best(held: list[pa.Table], k: int) -> pa.Table:
    """Each item's k best rows: highest score first, then the smallest id; null ids last."""
    rows = pa.concat_tables(held).sort_by([("item", "ascending"), ("score", "descending"), ("doc_id", "ascending")])
    item = rows["item"].to_numpy()
    start = np.flatnonzero(np.r_[True, item[1:] != item[:-1]])
    place = np.arange(len(item)) - np.repeat(start, np.diff(np.r_[start, len(item)]))
    return rows.filter(pa.array(place < k))


def task_best(found: DataFrame, block: Block, weight: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """item (number in the block), doc_id, score: each task's k best documents of each item."""
    kind, shared = dict(found.dtypes)["doc_id"], found.sparkSession.sparkContext.broadcast((block.ids[:0], block.numbers, block.held))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, numbers, terms_of = shared.value
        mine = Block(ids, numbers, terms_of)
        least = np.ones(len(terms_of), np.int64)  # a score below it is not among the task's best
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            for start in range(0, batch.num_rows, DOCS):
                part = pa.Table.from_batches([batch.slice(start, DOCS)]).sort_by("doc_id").combine_chunks()
                at = part["term"].combine_chunks()
                count = np.diff(at.offsets.to_numpy())
                doc, term, times = np.repeat(np.arange(len(count)), count), at.flatten().to_numpy(), part["times"].combine_chunks().flatten().to_numpy()
                m = lengths(part["n"].to_numpy(), n_docs, n_terms)
                impact = weight[term] * (1_000_000_000 * times // (1000 * times + 8 * m[doc]))
                item, row, score = [], [], []
                for first in range(0, len(terms_of), ITEMS):
                    scores = tile_scores(mine, first, doc, term, impact, part.num_rows)
                    enough = scores >= least[first : first + ITEMS]
                    for i in np.flatnonzero(enough.any(axis=0)).tolist():
                        rows = np.flatnonzero(enough[:, i])
                        rows = rows[np.argsort(-scores[rows, i], kind="stable")[:k]]  # ids rise in the tile, so equal scores keep the smaller
                        item.append(np.full(len(rows), first + i, np.int32))
                        row.append(rows)
                        score.append(scores[rows, i])
                if not item:
                    continue
                held.append(pa.table({"item": np.concatenate(item), "doc_id": part["doc_id"].take(pa.array(np.concatenate(row))), "score": np.concatenate(score)}))
                size += len(held[-1])
                if size >= HELD + k * len(terms_of):
                    held = [best(held, k)]
                    size = len(held[0])
                    of, s = held[0]["item"].to_numpy(), held[0]["score"].to_numpy()
                    full = np.flatnonzero(np.bincount(of, minlength=len(least)) == k)
                    lowest = np.full(len(least), 1 << 62, np.int64)
                    np.minimum.at(lowest, of, s)
                    least[full] = lowest[full]
        if held:
            yield from best(held, k).combine_chunks().to_batches(max_chunksize=BATCH_ROWS * 8)
        give_back()

    return found.select("doc_id", "n", "term", "times").mapInArrow(task, f"item int, doc_id {kind}, score bigint")


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: each item's k best documents with a score above 0.

    Each row of `docs` is a document and each row of `items` an item, so repeated rows are ranked and answered as often as
    they stand there; a null item_id is an item without a name.  Null and empty texts have no terms and no results.  Equal
    scores go by ascending doc_id, a null doc_id last.  Without documents or items the result is empty.
    """
    spark, scratch, out = docs.sparkSession, [], []
    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    asked = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    small_batches(spark)
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    for block in blocks(asked, block_bytes):
        found = materialise(postings(read, block), "postings", scratch)
        n_docs, n_terms = found.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        weight = weights(document_frequencies(found, len(block.numbers)), n_docs)
        few = task_best(found, block, weight, n_docs, n_terms, k).withColumn("group", F.pmod(F.spark_partition_id(), F.lit(GROUPS)))
        few = few.withColumn("rank", F.row_number().over(Window.partitionBy("item", "group").orderBy(*order))).filter(F.col("rank") <= k)
        few = few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= k)
        names = F.broadcast(spark.createDataFrame(list(enumerate(block.ids)), f"item int, item_id {dict(asked.dtypes)['item_id']}"))
        out.append(materialise(few.join(names, "item").select("item_id", "rank", "doc_id", "score"), "ranked"))
        drop_scratch(spark, scratch)
    every = out[0]
    for more in out[1:]:
        every = every.unionByName(more)
    return every


def op11(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's columns: each benchmark item's ten best documents."""
    return search(docs, benchmark)
