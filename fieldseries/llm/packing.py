"""Best-fit packing of token sequences, certified by dual-feasible-function bounds.

1. Texts become token ids once; only each piece's length and checksum go on.
2. Pieces are dealt to partitions of bounded size and packed there by best-fit decreasing.
3. Lower bounds from dual feasible functions are computed on each partition's lengths.  A
   partition whose bin count equals its bound is certified optimal and is left alone.
4. Partitions with a gap exchange the documents of their bins that are not full: these are dealt
   anew over fewer partitions and packed again; the better of old and new packing stays.  The
   bins that are least full in certified partitions join the exchange, so that the rounding
   loss of one bin a partition goes too.  Exchanges go on until one saves no bin.

A partition holds a bounded number of (length, row) pairs and no text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BATCH_ROWS, drop_scratch, give_back, materialise, small_batches

#: Pieces in a packing partition, on average.
PART_PIECES = 50_000
#: Bytes that a Python worker's mapping of strings to ids takes, about; there are two, each with a predecessor.
CACHE = 64 << 20
#: Exchanges at most; each works on fewer pieces than the one before it.
ROUNDS = 8


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _Recent(dict):
    """A mapping of bounded bytes: when full, only entries used since it was last full go on."""

    def __init__(self, make: Callable):
        super().__init__()
        self.make, self.old, self.size = make, {}, 0

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self.size += len(key) + len(value) + 200  # two objects and their place in the mapping
        if self.size >= CACHE:
            self.old = dict(self)
            self.clear()
            self.size = 0
        self[key] = value
        return value


#: Strings for which lower case, letters and digits mean the same to Python as to the tokenizer.
_PLAIN = re.compile("[\x21-\x7e\u00a1\u00ab\u00bb\u00bf-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e\u2010-\u2027]+")
#: The words that the tokenizer's own pattern finds in such a string.
_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u017e]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u017e]+")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones themselves, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit numbers, with id 0 at the end.

    A tokenizer that drops white space and never looks across it gives a text the ids of its
    parts between ASCII white space, in order; with any other, texts are encoded whole.  Parts, and the words in parts, repeat: each is
    encoded once while it stays in use.  A part with anything unusual goes to the tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.parts, self.words = _Recent(self._part), _Recent(self._word)
        self.cut = self._drops_space()
        self.split = self.cut and self._splits_alike()

    def _word(self, word: str) -> bytes:
        if not word.isascii():
            word = "".join([self.letters[b] for b in word.encode()])
        return b"".join([t.id.to_bytes(4, "little") for t in self.tokenizer.model.tokenize(word)])

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _part(self, part: bytes) -> bytes:
        text = part.decode()
        if self.split and _PLAIN.fullmatch(text) and "<|" not in text:
            return b"".join([self.words[w] for w in _WORDS.findall(text.lower())])
        return self._whole(text)

    def _splits_alike(self) -> bool:
        """Whether this tokenizer cuts words as _WORDS does; another one gets whole parts."""
        probe = "It's We'LL 12-ab_cd!? \u00c9t\u00e9 na\u00efve#7 \u00bfqu\u00e9? o'd!'s"
        mine = b"".join([self._word(w) for part in probe.split() for w in _WORDS.findall(part.lower())])
        return mine == self._whole(probe)

    def _drops_space(self) -> bool:
        """Whether texts may be cut at white space."""
        probe = "a  b\tIt's\n c\x0b\x0cd "
        return b"".join([self._whole(part) for part in probe.split()]) == self._whole(probe)

    def forget(self) -> None:
        """Between tasks: the worker keeps no strings while others use its memory."""
        self.parts, self.words = _Recent(self._part), _Recent(self._word)

    def __call__(self, text: bytes) -> bytes:
        if not self.cut:
            return self._whole(text.decode()) + b"\0\0\0\0"
        parts = self.parts
        return b"".join([parts[p] for p in text.split()]) + b"\0\0\0\0"


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces(docs: DataFrame, tokenizer: str, size: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and row (a number of its own for every piece)."""
    kind = dict(docs.dtypes)[id_col]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, texts = batch.column(0), batch.column(1).cast(pa.large_binary()).fill_null(b"").to_pylist()
        at, piece, start, length, crc = [], [], [], [], []
        encode = encoder(tokenizer)
        for k, text in enumerate(texts):
            raw = encode(text)
            view = memoryview(raw)
            for p, a in enumerate(range(0, len(raw), 4 * size)):
                part = view[a : a + 4 * size]
                at.append(k)
                piece.append(p)
                start.append(a // 4)
                length.append(len(part) // 4)
                crc.append(zlib.crc32(part))
        columns = [ids.take(pa.array(at)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                yield work(batch.slice(at, BATCH_ROWS))
        encoder(tokenizer).forget()
        give_back()

    small_batches(docs.sparkSession)
    out = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(task, f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")
    return out.withColumn("row", F.monotonically_increasing_id())


def best_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, int]:
    """(bin of each item, number of bins).  Ties keep input order."""
    order = np.argsort(-lengths, kind="stable")
    bins = np.empty(len(lengths), np.int64)
    waiting: list[list[int]] = [[] for _ in range(size + 1)]  # bins by room left
    mask, made = 0, 0  # bit r: a bin with room r waits
    for i, need in zip(order.tolist(), lengths[order].tolist(), strict=True):
        above = mask >> need
        if above:
            room = need + (above & -above).bit_length() - 1
            b = waiting[room].pop()
            if not waiting[room]:
                mask &= ~(1 << room)
        else:
            b, room = made, size
            made += 1
        bins[i] = b
        if left := room - need:
            waiting[left].append(b)
            mask |= 1 << left
    return bins, made


def dual_feasible_bound(lengths: np.ndarray, size: int) -> int:
    """A lower bound on the bins needed: the best over three families of dual feasible functions.

    f maps lengths so that any set that fits one bin maps to at most 1 in total; the rounded-up
    sum of f is then a bound.  Families: the plain volume; Fekete and Schepers' threshold
    functions (lengths over size - t count whole, under t count nothing); and their rounding
    functions u(k), where (k + 1) * length / size is rounded down unless it is whole.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=size + 1)[: size + 1].astype(np.int64)
    x = np.arange(size + 1, dtype=np.int64)
    best = -(-int((count * x).sum()) // size)
    whole, volume = np.cumsum(count[::-1])[::-1], np.cumsum(count * x)
    t = np.arange(1, size // 2 + 1)
    big = whole[np.minimum(size - t + 1, size)]
    middle = volume[size - t] - volume[t - 1]
    best = max(best, int((big + -(-middle // size)).max()))
    for k in range(1, 21):
        scaled = (k + 1) * x
        twice = np.where(scaled % size == 0, k * x, (scaled // size) * size)  # times k * size
        best = max(best, -(-int((count * twice).sum()) // (k * size)))
    return best


def _pack(size: int, keep_lowest: float):
    """A packing of one partition: the rows with their bin, place, the bin's fill and whether it goes on."""

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("row", kind="stable")
        lengths = frame["length"].to_numpy()
        bins, made = best_fit_decreasing(lengths, size)
        if "old_bin" in frame:  # an exchange must not cost bins
            before = frame["old_bin"].to_numpy()
            if len(np.unique(before)) <= made:
                bins = np.unique(before, return_inverse=True)[1]
                made = int(bins.max()) + 1 if len(bins) else 0
        bound = dual_feasible_bound(lengths, size)
        fill = np.bincount(bins, weights=lengths, minlength=made).astype(np.int64)
        gap = made - bound
        again = fill < size if gap > 0 else fill < keep_lowest * size
        order = np.lexsort((np.arange(len(bins)), bins))
        place = np.empty(len(bins), np.int64)
        run = np.cumsum(lengths[order]) - lengths[order]
        first = np.r_[True, bins[order][1:] != bins[order][:-1]] if len(bins) else np.zeros(0, bool)
        place[order] = run - np.maximum.accumulate(np.where(first, run, 0))
        return pd.DataFrame({"row": frame["row"].to_numpy(), "length": lengths, "part": frame["part"].to_numpy(), "bin": bins, "offset": place, "again": again[bins], "bins": made, "bound": bound})

    return work


_PACKED = "row bigint, length bigint, part bigint, bin bigint, offset bigint, again boolean, bins bigint, bound bigint"


def pack(lengths: DataFrame, size: int, part_pieces: int = PART_PIECES, rounds: int = ROUNDS, scratch: list[str] | None = None) -> DataFrame:
    """(row, length) -> row, sequence_id, offset, and the bins and bound of the partition that packed it.

    An empty input gives no rows.  A length over size or under 1 is an error.
    """
    scratch = [] if scratch is None else scratch
    left, key, done, before = lengths.select("row", "length"), "row", [], None
    for salt in range(rounds + 1):
        parts = max(1, -(-left.count() // part_pieces))
        todo = left.withColumn("part", (F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(parts)) + F.lit(salt << 32)).cast("bigint")).repartition(parts, "part")
        packed = materialise(todo.groupBy("part").applyInPandas(_pack(size, 0.97), _PACKED), f"pack{salt}", scratch)
        made = packed.groupBy("part").agg(F.first("bins").alias("bins")).agg(F.sum("bins")).first()[0] or 0
        again = packed.filter("again")
        open_bins = again.select("part", "bin").distinct().count()
        if salt == rounds or made == before or not open_bins or parts == 1 and salt:
            done.append(packed)
            break
        done.append(packed.filter(~F.col("again")))
        before = open_bins
        # all pieces of an old bin travel together, so that the old packing can stand if it is no worse
        left, key = again.select("row", "length", (F.col("part") * F.lit(1 << 24) + F.col("bin")).alias("old_bin")), "old_bin"
    every = done[0]
    for d in done[1:]:
        every = every.unionByName(d)
    return every.select("row", (F.col("part") * F.lit(1 << 24) + F.col("bin")).alias("sequence_id"), "offset", F.col("bins").alias("part_bins"), F.col("bound").alias("part_bound"))


def op10(docs: DataFrame, tokenizer: str | None = None, size: int = 2048) -> DataFrame:
    """Pack all documents; a row a piece, with the bound that certifies its partition's bin count.

    A null text is empty and is one token (id 0).  Repeated rows are documents of their own; a null
    doc_id stays null.  Columns but the id and the text are left out.  No documents, no rows.
    """
    scratch: list[str] = []
    cut = materialise(pieces(docs, tokenizer or default_tokenizer(), size), "pieces", scratch)
    out = cut.join(pack(cut.select("row", "length"), size, scratch=scratch), "row").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "part_bins", "part_bound")
    packed = materialise(out, "packed")
    drop_scratch(docs.sparkSession, scratch)
    return packed
