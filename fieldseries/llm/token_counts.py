"""Token counts of texts without making their ids.

1. Texts fall into pre-tokens, the strings that a tokenizer's merges never look across.  Their
   frequencies over all texts are summed in the tasks and then by Spark.
2. The pieces of each distinct pre-token are counted once, by the tokenizer's own model.
3. Each document's pre-token frequencies meet those counts.  The most frequent pre-tokens, a bounded
   number of them, are at every task; what else a document holds goes by a shuffle join, where no key
   can be hot any more, and comes back as one sum a document.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BATCH_ROWS, drop_scratch, give_back, map_batches, materialise, small_batches
from .packing import _PLAIN, _WORDS, _byte_letters, default_tokenizer

#: Pre-tokens that every task gets at most, and the bytes of each at most: some 10 MB.
FREQUENT, FREQUENT_BYTES = 65_536, 64
#: Distinct parts (what stands between white space) that a task holds, and bytes of text that they can come from, before it hands them on.
HELD, HELD_BYTES = 400_000, 128 << 20
#: Begins the key of a part that holds a special token's string: the tokenizer sees such a part whole.
_RAW = " "


class PreTokens:
    """The pre-tokens of texts, and the pieces of a pre-token, as one tokenizer's file has them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = _byte_letters()
        self.by_words = self.by_parts = False
        self.by_parts = self._agrees(["a  b", "It's\tWe'LL\n12-ab Été\x0b\x0c x", " <|endoftext|> a<|endoftext|>b "])
        self.by_words = self.by_parts
        self.by_words = self.by_parts and self._agrees(["It's We'LL 12-ab_cd!? Été naïve#7 ¿qué? o'd!'s"])

    def _agrees(self, probes: list[str]) -> bool:
        """Whether texts may be cut at ASCII white space (by_parts), and plain parts by _WORDS, with this tokenizer."""
        split = [[w for p in t.encode().split() for w in self.of(p.decode())] for t in probes]
        return all(sum(map(self.pieces, words)) == len(self.tokenizer.encode(t, add_special_tokens=False).ids) for t, words in zip(probes, split, strict=True))

    def of(self, part: str) -> list[str]:
        """The pre-tokens of a part."""
        for s in self.special:
            if s in part:
                return [_RAW + part]
        if self.by_words and _PLAIN.fullmatch(part):
            words = _WORDS.findall(part.lower())
            return words if part.isascii() else [w if w.isascii() else "".join([self.letters[b] for b in w.encode()]) for w in words]
        normal, cut = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        text = normal.normalize_str(part) if normal else part
        return [w for w, _ in cut.pre_tokenize_str(text)] if cut else [text]

    def cut(self, text: bytes) -> list:
        """The parts of a text; the whole text is one, decoded, where the tokenizer may not be cut at white space."""
        return text.split() if self.by_parts else [text.decode()]

    def words(self, part: bytes | str) -> list[str]:
        return self.of(part if isinstance(part, str) else part.decode())

    def pieces(self, pre_token: str) -> int:
        if pre_token.startswith(_RAW) and any(s in pre_token for s in self.special):
            return len(self.tokenizer.encode(pre_token[1:], add_special_tokens=False).ids)
        return len(self.tokenizer.model.tokenize(pre_token))


@lru_cache(maxsize=2)
def pre_tokens(path: str) -> PreTokens:
    return PreTokens(path)


class Known(dict):
    """part -> pieces of its pre-tokens that are known.  `lost` has the others of each part that has any.

    It is emptied when it is full: parts repeat, so it fills again with those that matter.
    """

    def __init__(self, pre: PreTokens, pieces: dict[str, int]):
        super().__init__()
        self.pre, self.pieces, self.lost = pre, pieces, {}

    def __missing__(self, part: bytes | str) -> int:
        n, find = 0, self.pieces.get
        for w in self.pre.words(part):
            if (pieces := find(w)) is None:
                self.lost.setdefault(part, []).append(w)
            else:
                n += pieces
        self[part] = n
        return n

    def count(self, text: bytes) -> tuple[int, Counter]:
        """(pieces of the text's known pre-tokens, frequencies of the others)."""
        if len(self) >= HELD:
            self.clear()
            self.lost.clear()
        parts = Counter(self.pre.cut(text))
        total, rest = sum(map(mul, map(self.__getitem__, parts), parts.values())), Counter()
        if not self.lost.keys().isdisjoint(parts):
            for part in self.lost.keys() & parts.keys():
                for w in self.lost[part]:
                    rest[w] += parts[part]
        return total, rest


def vocabulary(texts: DataFrame, tokenizer: str) -> DataFrame:
    """pre_token, n (how often it stands in all texts), pieces: a row a distinct pre-token of the column `text`."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pre, parts = pre_tokens(tokenizer), Counter()

        def flush() -> pa.RecordBatch:
            held: Counter = Counter()
            for part, n in parts.items():
                for w in pre.words(part):
                    held[w] += n
            parts.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.string()), pa.array(list(held.values()), pa.int64())], ["pre_token", "n"])

        size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                for text in batch.column(0).slice(at, BATCH_ROWS).cast(pa.large_binary()).drop_null().to_pylist():
                    parts.update(pre.cut(text))
                    size += len(text)
                    if len(parts) >= HELD or size >= HELD_BYTES:
                        yield flush()
                        size = 0
        if parts:
            yield flush()
        give_back()

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        pieces = pre_tokens(tokenizer).pieces
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array([pieces(w) for w in batch.column(0).to_pylist()], pa.int64())], ["pre_token", "n", "pieces"])

    small_batches(texts.sparkSession)
    found = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(task, "pre_token string, n bigint")
    return map_batches(found.groupBy("pre_token").agg(F.sum("n").alias("n")), count, "pre_token string, n bigint, pieces bigint")


def frequent(words: DataFrame, n: int = FREQUENT) -> dict[str, int]:
    """pre_token -> pieces of the n most frequent short pre-tokens: what the driver holds is bounded by n."""
    rows = words.filter(F.octet_length("pre_token") <= FREQUENT_BYTES).orderBy(F.desc("n"), "pre_token").limit(n).select("pre_token", "pieces").toArrow()
    return dict(zip(rows["pre_token"].to_pylist(), rows["pieces"].to_pylist(), strict=True))


def count_tokens(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", n_frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_bytes, n_tokens: a row a row of docs.

    Null and empty texts have no tokens.  Repeated rows and null ids are rows like others; further columns are not looked at.
    """
    tokenizer = tokenizer or default_tokenizer()
    spark, scratch = docs.sparkSession, []
    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    words = materialise(vocabulary(read, tokenizer), "pre-tokens", scratch)
    known = spark.sparkContext.broadcast(frequent(words, n_frequent))

    def work(mine: Known, batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, sums, at, rest, times = [], [], [0], [], []
        for text in batch.column(1).cast(pa.large_binary()).fill_null(b"").to_pylist():
            total, others = mine.count(text)
            rest += others.keys()
            times += others.values()
            sizes.append(len(text))
            sums.append(total)
            at.append(len(rest))
        pairs = pa.StructArray.from_arrays([pa.array(rest, pa.string()), pa.array(times, pa.int64())], ["pre_token", "times"])
        columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()), pa.ListArray.from_arrays(pa.array(np.array(at, np.int32)), pairs)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_known", "rest"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Known(pre_tokens(tokenizer), known.value)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                yield work(mine, batch.slice(at, BATCH_ROWS))
        give_back()

    kind = dict(read.dtypes)["doc_id"]
    small_batches(spark)
    counted = read.mapInArrow(task, f"doc_id {kind}, n_bytes bigint, n_known bigint, rest array<struct<pre_token: string, times: bigint>>")
    counted = materialise(counted.withColumn("row", F.monotonically_increasing_id()), "frequencies", scratch)
    met = counted.select("row", F.inline("rest")).join(words.select("pre_token", "pieces"), "pre_token")
    more = met.groupBy("row").agg(F.sum(F.col("times") * F.col("pieces")).alias("more"))
    out = counted.drop("rest").join(more, "row", "left").select("doc_id", "n_bytes", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_tokens"))
    out = materialise(out, "token-counts")
    drop_scratch(spark, scratch)
    known.destroy()
    return out


def op13(docs: DataFrame, limit: int = 2048) -> DataFrame:
    """The contract's columns: doc_id, n_bytes, n_tokens, over_limit."""
    return count_tokens(docs).withColumn("over_limit", F.col("n_tokens") > limit)
