"""Exact removal of long repeated byte strings, by suffix sorting of what can repeat at all.

1. Anchors.  Every window of `length` bytes has one anchor: its K-byte substring of smallest hash.
   Equal windows have equal anchors at equal places, so a window can only repeat if its anchor does.
   Only anchors that occur twice go on, each with a hash of its context: all bytes of the windows that
   have this anchor.
2. A context that occurs twice repeats as a whole, and so do all windows in it.
3. What is left are anchors that stand in different contexts.  One copy of each such context goes to
   a shard, chosen by the anchor.  A shard is suffix-sorted by recursive induction with queues on disk
   (`induced_sort`), which carry suffixes with what they have in common with their neighbours.  Neighbours with `length`
   common bytes that are different places are repeats.  Files of a shard are its task's own and are made anew with it.
4. An anchor in more contexts than a shard is meant to hold goes to no shard: the windows of its contexts are
   counted by their hashes, which splits it however many texts share it.
5. Spans meet their documents and are merged and cut out.

Texts are identified by their MD5 digest, so copies of a text share all work and results, and
results do not depend on row order.  No step holds all rows of a key in memory: counts are
pre-aggregated, and what meets in a shard is one row a distinct context.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from .common import Bloom, bloom, drop_scratch, map_batches, materialise
from .induced_sort import sort_with_prefixes
from .textcore import _RINV, mix, powers, prefix_hash, runs, span_hash, string_buffers, byte_buffers

LENGTH, ANCHOR = 200, 100
#: Contexts in a shard, about, and contexts of one anchor in a shard at most.
SHARD_CONTEXTS = 4_000


def _slide(x: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """pick over every run of `width` values."""
    step = 1
    while step * 2 <= width:
        x = pick(x[:-step], x[step:])
        step *= 2
    rest = width - step
    return pick(x[: len(x) - rest], x[rest:]) if rest else x


def anchors(raw: np.ndarray, bounds: np.ndarray, length: int, k: int) -> tuple[np.ndarray, ...]:
    """(hash, context hash, document, place, bytes of context before, bytes after the anchor) of every anchor."""
    none = tuple(np.zeros(0, np.int64) for _ in range(6))
    if len(raw) < length:
        return none
    width = length - k + 1
    sums = prefix_hash(raw)
    h = mix((sums[k:] - sums[:-k]) * powers(_RINV, len(sums), "i")[: len(raw) - k + 1])
    small = np.maximum(h >> np.uint64(32), np.uint64(1)).astype(np.uint32)  # 0 stands for places outside
    least = _slide(small, width, np.minimum)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    at = np.arange(len(least))
    inside = bounds[doc[: len(least)] + 1] - at >= length
    shown = np.concatenate([np.zeros(width - 1, np.uint32), np.where(inside, least, 0), np.zeros(width - 1, np.uint32)])
    place = np.flatnonzero(_slide(shown, width, np.maximum)[: len(small)] == small)
    of = doc[place]
    # the windows of an anchor stand next to each other; its context is what they reach
    mine = np.lib.stride_tricks.sliding_window_view(shown, width)[place] == small[place][:, None]
    lo = place - width + 1 + mine.argmax(1)
    last = place - mine[:, ::-1].argmax(1)
    # of equal hashes in one window the left-most is the anchor
    by = np.lexsort((place, small[place]))
    tie = np.full(len(place), -1)
    tie[by[1:]] = np.where(small[place[by[1:]]] == small[place[by[:-1]]], place[by[:-1]], -1)
    lo = np.maximum(lo, tie + 1)
    real = lo <= last
    place, of, lo, hi = place[real], of[real], lo[real], last[real] + length
    return h[place].view(np.int64), span_hash(sums, lo, hi).view(np.int64), of, place - bounds[of], place - lo, hi - place - k


def _digests(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """MD5 of each text as two integers."""
    view = memoryview(data)
    return np.frombuffer(b"".join([hashlib.md5(view[a:b]).digest() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]), "<i8").reshape(-1, 2)


def _anchor_rows(docs: DataFrame, length: int, k: int, known: Bloom | None) -> DataFrame:
    """The anchors of all texts; with `known`, only those that it may hold, in full."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        data, offsets = string_buffers(batch.column(0))
        key = _digests(data, offsets) if known is not None else None
        parts = []
        for a, b in runs(offsets, 1 << 18):
            found = anchors(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], length, k)
            if known is None:
                parts.append((found[0],))
            else:
                some = known.may_hold(found[0])
                ah, ch, doc, place, before, after = (x[some] for x in found)
                parts.append((ah, ch, key[doc + a, 0], key[doc + a, 1], place, before, after))
        if not parts:
            return None
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)], names)

    names = ["ah"] if known is None else ["ah", "ch", "d0", "d1", "place", "before", "after"]
    return map_batches(docs.select(F.col("text").cast("string").alias("text")), work, ", ".join(f"{n} bigint" for n in names))


_CONTEXT = "ah bigint, ch bigint, n bigint, d0 bigint, d1 bigint, place bigint, before bigint, bytes binary"


def _contexts(docs: DataFrame, wanted: DataFrame, texts: Bloom, k: int) -> DataFrame:
    """The bytes of the wanted contexts: one row a row of wanted, which names the text and one document that has it."""
    per_text = wanted.groupBy("d0", "d1", "id").agg(F.collect_list(F.struct("ah", "ch", "n", "place", "before", "after")).alias("wants"))
    kind = dict(docs.dtypes)["id"]

    def only_needed(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        key = _digests(*string_buffers(batch.column(1)))
        some = np.flatnonzero(texts.may_hold(key[:, 0]))
        # of rows with one id and text, one a batch is enough; what is left are copies at one place, no repeats
        named = zip(key[some, 0].tolist(), key[some, 1].tolist(), batch.column(0).take(pa.array(some)).to_pylist(), strict=True)
        one = {row: k for k, row in zip(some.tolist(), named, strict=True)}
        some = pa.array(sorted(one.values()), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(key[:, 0]).take(some), pa.array(key[:, 1]).take(some), batch.column(0).take(some), batch.column(1).take(some)], ["d0", "d1", "id", "text"]) if len(some) else None

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        out: list[list] = [[] for _ in range(8)]
        for d0, d1, text, wants in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            raw = text.encode()
            for w in wants:
                row = (w["ah"], w["ch"], w["n"], d0, d1, w["place"], w["before"], raw[w["place"] - w["before"] : w["place"] + k + w["after"]])
                for column, v in zip(out, row, strict=True):
                    column.append(v)
        kinds = [pa.int64()] * 7 + [pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], ["ah", "ch", "n", "d0", "d1", "place", "before", "bytes"])

    read = map_batches(docs, only_needed, f"d0 bigint, d1 bigint, id {kind}, text string")
    wants = per_text.withColumnsRenamed({"d0": "_d0", "d1": "_d1", "id": "_id"})
    met = (F.col("d0") == F.col("_d0")) & (F.col("d1") == F.col("_d1")) & F.col("id").eqNullSafe(F.col("_id"))
    joined = read.join(wants, met).select("d0", "d1", "text", "wants")
    return map_batches(joined, cut, _CONTEXT)


def shard_repeats(rows: dict[str, np.ndarray], data: np.ndarray, offsets: np.ndarray, length: int, k: int, folder: str) -> list[tuple[int, int, int]]:
    """(row, first byte, end byte) in the text of every maximal repeated stretch of the rows' contexts.

    A stretch counts where it also stands at another place, or where its context occurs more than once.
    """
    size = np.diff(offsets)
    # a window reaches over the anchor to both sides; some three quarters of its reach must repeat for it to
    sums = prefix_hash(data)
    reach, keep = length - k, np.zeros(len(size), bool)
    for i in range(4):
        lo = rows["before"] - reach * i // 4
        hi = lo + k + reach * i // 4 + (reach * 3) // 4 - reach * i // 4
        fits = np.flatnonzero((lo >= 0) & (hi <= size))
        _, group, count = np.unique(span_hash(sums, offsets[:-1][fits] + lo[fits], offsets[:-1][fits] + hi[fits]), return_inverse=True, return_counts=True)
        keep[fits] |= count[group] > 1
    kept = np.flatnonzero(keep)
    if len(kept) < 2:
        return []
    # the contexts one after another, with separators (1) between them and the least symbol (0) at the end
    where = np.cumsum(size[kept] + 1) - size[kept] - 1
    total = int(size[kept].sum() + len(kept)) + 1
    text = np.ones(total, np.int16)
    at = np.flatnonzero(_inside(where, size[kept], total))
    inner = np.repeat(offsets[:-1][kept] - where, size[kept]) + at
    text[at] = data[inner].astype(np.int16) + 2
    text[-1] = 0
    del inner, at
    texts = np.unique(np.stack([rows["d0"], rows["d1"]], 1), axis=0, return_inverse=True)[1].reshape(-1)
    covers: list[np.ndarray] = []
    # the context of a place, and how far into it the place is
    context = lambda at: np.searchsorted(where, at, "right") - 1
    for part in sort_with_prefixes(text, folder, cap=length):
        run = np.cumsum(part["common"] < length)
        many = np.bincount(run)[run] > 1
        part, run = part["at"][many], run[many]
        c = context(part)
        whole = part - where[c] + length <= size[kept[c]]
        part, run, c = part[whole], run[whole], c[whole]
        if not len(part):
            continue
        r = kept[c]
        place = texts[r] * (1 << 40) + rows["place"][r] - rows["before"][r] + part - where[c]
        at = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
        twice = (np.minimum.reduceat(place, at) != np.maximum.reduceat(place, at)) | (np.maximum.reduceat(rows["n"][r], at) > 1)
        covers.append(part[np.repeat(twice, np.diff(np.append(at, len(part))))])
    begin = np.sort(np.concatenate([np.zeros(0, np.int64), *covers]))
    if not len(begin):
        return []
    c = context(begin)
    r = kept[c]
    begin = begin - where[c] + rows["place"][r] - rows["before"][r]
    # begins are ordered by row, then place; close begins make one stretch
    fresh = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (begin[1:] > begin[:-1] + length)])
    end = begin[np.append(fresh[1:], len(begin)) - 1] + length
    return list(zip(r[fresh].tolist(), begin[fresh].tolist(), end.tolist(), strict=True))


def _hot_spans(contexts: DataFrame, length: int) -> DataFrame:
    """(d0, d1, a, b) of the repeated windows of contexts whose anchors stand in very many of them.

    A window counts where it also stands at another place, or where its context occurs more than once; counts are
    pre-aggregated, so no window's places meet in one task.
    """

    def windows(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        data, offsets = byte_buffers(batch.column("bytes"))
        size = np.maximum(np.diff(offsets) - length + 1, 0)
        if not size.sum():
            return None
        sums = prefix_hash(data)
        row = np.repeat(np.arange(len(size)), size)
        off = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        start = offsets[:-1][row] + off
        column = lambda n: batch.column(n).to_numpy()[row]
        out = [span_hash(sums, start, start + length).view(np.int64), column("n"), column("d0"), column("d1"), column("place") - column("before") + off]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in out], ["w", "n", "d0", "d1", "a"])

    w = map_batches(contexts, windows, "w bigint, n bigint, d0 bigint, d1 bigint, a bigint")
    place = F.struct("d0", "d1", "a")
    again = w.groupBy("w").agg(F.min(place).alias("lo"), F.max(place).alias("hi"), F.max("n").alias("n")).filter("lo <> hi or n > 1").select("w")
    return w.filter("n = 1").join(again, "w", "left_semi").select("d0", "d1", "a", (F.col("a") + length).alias("b"))


def _inside(where: np.ndarray, size: np.ndarray, total: int) -> np.ndarray:
    """Flags of the places that are not separators."""
    out = np.ones(total - 1, bool)
    out[where + size] = False
    return out


def _partial(contexts: DataFrame, shards: int, length: int, k: int) -> DataFrame:
    """Repeated stretches of contexts that occur once, a shard a partition."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory() as folder, tempfile.TemporaryFile(dir=folder) as file:
            columns: dict[str, list[np.ndarray]] = {n: [] for n in ("ah", "ch", "n", "d0", "d1", "place", "before")}
            sizes = [np.zeros(1, np.int64)]
            for batch in batches:
                for n in columns:
                    columns[n].append(batch.column(n).to_numpy())
                for raw in batch.column("bytes"):
                    file.write(raw.as_buffer())
                sizes.append(np.array([len(b.as_buffer()) for b in batch.column("bytes")], np.int64))
            if len(sizes) == 1:
                return
            rows = {n: np.concatenate(c) for n, c in columns.items()}
            offsets = np.cumsum(np.concatenate(sizes))
            file.flush()
            data = np.memmap(file, np.uint8, "r", shape=(int(offsets[-1]),)) if offsets[-1] else np.zeros(0, np.uint8)
            found = [f for f in shard_repeats(rows, data, offsets, length, k, folder) if rows["n"][f[0]] == 1]
            del data
            if found:
                r, a, b = (np.array(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(rows["d0"][r]), pa.array(rows["d1"][r]), pa.array(a), pa.array(b)], ["d0", "d1", "a", "b"])

    return contexts.repartition(shards, "ah").mapInArrow(task, "d0 bigint, d1 bigint, a bigint, b bigint")


def merged_spans(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(d0, d1, spans) of rows with spans in any order: those that overlap or touch are one.  A sort and a running maximum a row."""
    column = batch.column(2)
    ends, inner = column.offsets.to_numpy(), column.values
    first, last = inner.field("a").to_numpy(), inner.field("b").to_numpy()
    at, out_a, out_b = [0], [], []
    for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        a, b = first[lo:hi], last[lo:hi]
        order = np.argsort(a, kind="stable")
        a, b = a[order], np.maximum.accumulate(b[order])
        new = np.flatnonzero(np.r_[True, a[1:] > b[:-1]]) if len(a) else np.zeros(0, np.int64)
        out_a.append(a[new])
        out_b.append(b[np.append(new[1:], len(b)) - 1] if len(a) else b)
        at.append(at[-1] + len(new))
    joined = lambda parts: pa.array(np.concatenate([np.zeros(0, np.int64), *parts]), pa.int64())
    spans = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.StructArray.from_arrays([joined(out_a), joined(out_b)], ["a", "b"]))
    return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), spans], ["d0", "d1", "spans"])


def repeated_spans(docs: DataFrame, length: int = LENGTH, k: int = ANCHOR, scratch: list[str] | None = None, shard_contexts: int = SHARD_CONTEXTS) -> DataFrame:
    """(d0, d1, spans): for every text (by digest) that has any, its merged spans of repeated bytes.

    docs: columns id and text.  id only chooses one of several equal texts and may be null.
    """
    scratch = [] if scratch is None else scratch
    spark = docs.sparkSession
    counted = _anchor_rows(docs, length, k, None).groupBy("ah").count().filter("count > 1").select("ah")
    again = materialise(counted, "anchors", scratch)
    occurrences = materialise(_anchor_rows(docs, length, k, bloom(again, "ah")).join(again, "ah"), "occurrences", scratch)
    kinds = materialise(occurrences.groupBy("ah", "ch").agg(F.count("*").alias("n"), F.min(F.struct("d0", "d1", "place", "before", "after")).alias("one")), "contexts", scratch)
    whole = kinds.filter("n > 1").select("ah", "ch")
    span = [(F.col("place") - F.col("before")).alias("a"), (F.col("place") + k + F.col("after")).alias("b")]
    covered = occurrences.join(whole, ["ah", "ch"], "left_semi").filter(F.col("before") + F.col("after") + k >= length).select("d0", "d1", *span).distinct()
    mixed = kinds.groupBy("ah").agg(F.count("*").alias("c")).filter("c > 1").select("ah", (F.col("c") > shard_contexts).alias("hot"))
    wanted = kinds.join(mixed, "ah").select("ah", "ch", "n", "hot", "one.*")
    holders = docs.select(F.md5("text").alias("m"), "id").groupBy("m").agg(F.min("id").alias("id"))
    # both halves of a digest as the integers that _digests() gives
    half = lambda at: F.conv(F.concat(*[F.substring("m", at + 14 - 2 * i, 2) for i in range(8)]), 16, -10).cast("bigint")
    holders = holders.select(half(1).alias("d0"), half(17).alias("d1"), "id")
    wanted = materialise(wanted.join(holders, ["d0", "d1"]), "wanted", scratch)
    n, hot = wanted.count(), wanted.filter("hot")
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n // shard_contexts)
    texts = bloom(wanted, "d0")
    every = covered.unionByName(_partial(_contexts(docs, wanted.filter("not hot"), texts, k), shards, length, k))
    if not hot.isEmpty():
        every = every.unionByName(_hot_spans(materialise(_contexts(docs, hot, texts, k), "hot", scratch), length))
    return map_batches(every.groupBy("d0", "d1").agg(F.collect_set(F.struct("a", "b")).alias("s")), merged_spans, "d0 bigint, d1 bigint, spans array<struct<a: bigint, b: bigint>>")


def with_spans(docs: DataFrame, finish: Callable[[bytes, list[tuple[int, int]]], tuple], schema: str, length: int = LENGTH, scratch: list[str] | None = None) -> DataFrame:
    """Rows (row, *finish(text, spans)) for every row of docs (id, text, row); finish gets the whole text and its spans.

    scratch gets the table that the rows are made from, for the caller to drop once they are written.

    row goes along with its text and is no key of anything, so it may be of any type.
    """
    kind = docs.schema["row"].dataType
    used: list[str] = []
    spans = materialise(repeated_spans(docs.select("id", "text"), length, scratch=used), "spans", scratch)
    drop_scratch(spans.sparkSession, used)
    known = bloom(spans, "d0")

    full = StructType([StructField("row", kind), *StructType.fromDDL(schema).fields])
    names, arrow = full.names, [f.type for f in to_arrow_schema(StructType(full.fields[1:]))]

    def finished(rows: pa.Array, texts: pa.Array, found: list) -> pa.RecordBatch:
        out = [finish((text or "").encode(), [(s["a"], s["b"]) for s in spans or ()]) for text, spans in zip(texts.to_pylist(), found, strict=True)]
        columns = [pa.array([row[i] for row in out], t) for i, t in enumerate(arrow)]
        return pa.RecordBatch.from_arrays([rows, *columns], names)

    def clean(batch: pa.RecordBatch) -> pa.RecordBatch:
        some = pa.array(np.flatnonzero(~known.may_hold(_digests(*string_buffers(batch.column(1)))[:, 0])))
        return finished(batch.column(0).take(some), batch.column(1).take(some), [None] * len(some))

    def open_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        key = _digests(*string_buffers(batch.column(1)))
        some = np.flatnonzero(known.may_hold(key[:, 0]))
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(some)), batch.column(1).take(pa.array(some)), pa.array(key[some, 0]), pa.array(key[some, 1])], ["row", "text", "d0", "d1"])

    def done(batch: pa.RecordBatch) -> pa.RecordBatch:
        return finished(batch.column(0), batch.column(1), batch.column(2).to_pylist())

    read = docs.select("row", "text")
    rest = map_batches(read, open_rows, StructType([StructField("row", kind), *StructType.fromDDL("text string, d0 bigint, d1 bigint").fields]))
    met = rest.join(spans, ["d0", "d1"], "left").select("row", "text", "spans")
    return map_batches(read, clean, full).unionByName(map_batches(met, done, full))


def kept(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, parts = 0, []
    for a, b in spans:
        parts.append(text[at:a])
        at = b
    parts.append(text[at:])
    return b"".join(parts)


def op3(docs: DataFrame) -> DataFrame:
    """The contract's columns; a row a row of documents.

    A null text is empty; texts under 200 bytes lose nothing by themselves.  Repeated rows are each other's
    copies.  A null doc_id stays null.  No documents, no rows.
    """

    def finish(text: bytes, spans: list[tuple[int, int]]) -> tuple:
        return len(text), sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept(text, spans)).hexdigest()

    read = docs.select(F.col("doc_id").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.col("doc_id").alias("row"))
    return with_spans(read, finish, "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string").withColumnRenamed("row", "doc_id")


def whole_characters(text: bytes, a: int, b: int) -> tuple[int, int]:
    """The part of a span that cuts no character."""
    while a < b and text[a] & 0xC0 == 0x80:
        a += 1
    while b > a and b < len(text) and text[b] & 0xC0 == 0x80:
        b -= 1
    return a, b


def cut_repeats(docs: DataFrame, length: int = LENGTH, scratch: list[str] | None = None) -> DataFrame:
    """Pipeline stage: every document, with its repeated strings cut out of the text and n_chars to match.

    Only whole characters are cut.  A null text stays null, and other columns stay as they are.
    """

    def finish(text: bytes, spans: list[tuple[int, int]]) -> tuple:
        return (kept(text, [whole_characters(text, a, b) for a, b in spans]).decode(),)

    names = docs.columns
    others = F.struct(*[F.col(f"`{c}`") for c in names if c not in ("text", "n_chars")])
    row = F.struct(F.col("text").isNull().alias("none"), others.alias("others"))
    out = with_spans(docs.select(F.col("doc_id").alias("id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), row.alias("row")), finish, "left_text string", length, scratch)
    there = ~F.col("row.none")
    new = {"text": F.when(there, F.col("left_text")), "n_chars": F.when(there, F.length("left_text").cast(dict(docs.dtypes).get("n_chars", "bigint")))}
    return out.select(*[new[c].alias(c) if c in new else F.col("row.others").getField(c).alias(c) for c in names])
