"""Similarity join on word shingles by several global token orders.

A document is the set of its distinct word shingles.  If two sets have a Jaccard similarity of at
least t, then under *any* global order of the shingles their prefixes (the first n - ceil(t*n) + 1)
share one.  All orders here put shingles first that one set only holds: no other prefix can
hold those, so what is left of a prefix is short, and most documents have nothing left at all.  The
first order goes on by document frequency, the others by a permutation each.  Candidates share a
prefix shingle under the first order and must share one under every other order too; only what
passes all of them is verified on the full sets.

1. Documents become batches of shingles, dealt to buckets by the shingle.  A bucket counts them and
   sends back those that different sets hold; a batch then knows its prefixes and, of documents that
   still have one, all shingles that can be in an intersection.  Shingles so frequent that they would
   fill a bucket are known from a sketch and stay with their batch.
2. Equal sets are one class from the start.  Each prefix shingle names one leader, the class that has
   it foremost, and every class of the group is verified against that.
3. Groups that hold several components even then compare their smaller components with the rest: sizes,
   places in the prefixes and parity sketches leave out pairs that no link allows.  Links inside a
   component are not needed for it, and no link between two components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_scratch, give_back, map_batches, materialise, small_batches
from .components import components
from .textcore import NOT_SPACE, mix, runs, shingles, string_buffers, word_hashes

#: Slots of the sketch of heavy shingles: its size for any input.
SLOTS = 1 << 20
#: Shingles of a task between two reports of heavy ones.
REPORT = 1_000_000
#: Shingles of a batch, about; more where there are very many buckets.
HOLD = 500_000
#: Shingles in a counting task, about; buckets for each of them.
PART, SPREAD = 2_000_000, 4
#: Least number of times that a frequent shingle is seen before it stays out of the buckets.
FREQUENT = 1_000
#: Shingles in a row that goes to a bucket, at most.
ROW = 4_096
SKETCH = ["p0", "p1", "p2", "p3"]


def document_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(a, b, shingle, document from a) of the distinct shingles of documents a to b, by document and shingle."""
    for a, b in runs(offsets):
        bounds = offsets[a : b + 1] - offsets[a]
        _, _, doc, h = word_hashes(data[offsets[a] : offsets[b]], bounds, NOT_SPACE)
        token, of = shingles(h, doc, b - a, size)
        by = _by_document(token, of, b - a)
        token, of = token[by], of[by]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (of[1:] != of[:-1])
        yield a, b, token[new], of[new]


def _by_document(key: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """The order by document, then key; one sort of packed numbers where the packing loses no order."""
    bits = np.uint64(max(1, int(n).bit_length()))
    packed = (of.astype(np.uint64) << (np.uint64(64) - bits)) | (key >> bits)
    by = np.argsort(packed)
    p, k = packed[by], key[by]
    return np.lexsort((key, of)) if ((p[1:] == p[:-1]) & (k[1:] != k[:-1])).any() else by


def _classes(token: np.ndarray, of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, size) of each document's set; an empty set has size 0."""
    size = np.bincount(of, minlength=n)
    first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.zeros(0, np.int64)
    total, other = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    if len(of):
        total[of[first]] = np.add.reduceat(mix(token), first)
        other[of[first]] = np.bitwise_xor.reduceat(mix(token ^ np.uint64(0x5851F42D4C957F2D)), first)
    return mix(total + mix(other) + size.astype(np.uint64)).view(np.int64), size


def summaries(docs: DataFrame, size: int) -> DataFrame:
    """A row a document (id, cls, n) and rows (slot, seen) for shingles that are frequent in a task."""
    names = ["id", "cls", "n", "slot", "seen"]

    def heavy(held: list[np.ndarray], kind: pa.DataType) -> pa.RecordBatch | None:
        token, count = np.unique(np.concatenate(held), return_counts=True)
        some = count >= 4
        slot = (token[some] & np.uint64(SLOTS - 1)).astype(np.int32)
        none = pa.nulls(len(slot), pa.int64())
        return pa.RecordBatch.from_arrays([pa.nulls(len(slot), kind), none, none, pa.array(slot), pa.array(count[some])], names) if len(slot) else None

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting, kind = [], 0, pa.null()
        for batch in batches:
            data, offsets = string_buffers(batch.column(1))
            n, kind = batch.num_rows, batch.column(0).type
            cls, count = np.zeros(n, np.int64), np.zeros(n, np.int64)
            for a, b, token, of in document_sets(data, offsets, size):
                cls[a:b], count[a:b] = _classes(token, of, b - a)
                held.append(token)
                waiting += len(token)
                if waiting > REPORT:
                    if (out := heavy(held, kind)) is not None:
                        yield out
                    held, waiting = [], 0
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cls), pa.array(count), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int64())], names)
        if held and (out := heavy(held, kind)) is not None:
            yield out
        held.clear()
        give_back()

    small_batches(docs.sparkSession)
    return docs.select("id", "text").mapInArrow(task, f"id {docs.schema['id'].dataType.simpleString()}, cls bigint, n bigint, slot int, seen bigint")


def heavy_levels(summary: DataFrame, least: int) -> np.ndarray:
    """Rounded logarithms of counts by slot, from `least` on; at most SLOTS small rows come to the driver."""
    rows = summary.filter("slot is not null").groupBy("slot").agg(F.sum("seen").alias("n")).filter(F.col("n") >= least).toArrow()
    levels = np.zeros(SLOTS, np.uint8)
    levels[rows["slot"].to_numpy()] = _level(rows["n"].to_numpy()) if rows.num_rows else 0
    return levels


def _level(count: np.ndarray) -> np.ndarray:
    return np.minimum(63, np.ceil(np.log2(np.maximum(count, 1)))).astype(np.uint8)


def _sketches(token: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """256 parities of each set, as four integers: sets that differ in k shingles differ in at most k parities."""
    odd = np.bincount(of * 256 + (token >> np.uint64(40) & np.uint64(255)).astype(np.int64), minlength=n * 256) & 1
    return np.packbits(odd.astype(np.uint8).reshape(n, 256), axis=1).view(np.int64)


_BLOBS = "bucket int, batch bigint, docs binary, high binary, low binary, at binary, who binary, level binary"


def _batch_rows(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    columns = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(columns)], [n for n, _ in columns])


def _blobs(docs: DataFrame, size: int, levels: np.ndarray, buckets: int) -> DataFrame:
    """The shingles of batches of documents, a row a batch and bucket: the upper 48 bits of each and the document in
    the batch, and for each run of one document its class.  Classes that a batch holds already are left out.

    One more row a batch has its classes, their sizes and sketches, and the frequent shingles with their levels.
    """
    hold = min(4_000_000, max(HOLD, 128 * buckets))

    def flush(batch: int, held: list[tuple]) -> Iterator[pa.RecordBatch]:
        token, of, cls, n, sketch = (np.concatenate(c) for c in zip(*held, strict=True))
        held.clear()
        first = np.unique(cls, return_index=True)[1]
        first = np.sort(first[n[first] > 0])
        number = np.full(len(cls), -1, np.int32)
        number[first] = np.arange(len(first))
        number = number[of]
        token, at = token[number >= 0], number[number >= 0].astype(np.uint16)
        level = levels[(token & np.uint64(SLOTS - 1)).astype(np.int64)]
        token >>= np.uint64(16)
        often = level > 0
        parts = lambda t, a: ((t >> np.uint64(16)).astype(np.uint32).tobytes(), (t & np.uint64(0xFFFF)).astype(np.uint16).tobytes(), a.tobytes())
        named = cls[first]
        meta = cls[first].tobytes() + n[first].astype(np.int64).tobytes() + sketch[first].tobytes()
        rows = [(batch % buckets, batch, meta, *parts(token[often], at[often]), None, level[often].tobytes())]
        token, at = token[~often], at[~often]
        bucket = (token % np.uint64(buckets)).astype(np.uint16 if buckets < 1 << 16 else np.int64)
        order = np.argsort(bucket, kind="stable")
        token, at, bucket = token[order], at[order], bucket[order]
        far = np.diff(at.astype(np.int32)) > 255  # the next document is too far away for one row
        cut = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | far]) if len(bucket) else []
        for start, end in zip(cut, [*cut[1:], len(token)], strict=True):
            for a in range(start, end, ROW):
                own = at[a : min(end, a + ROW)]
                who = named[own[np.flatnonzero(np.r_[True, own[1:] != own[:-1]])]]
                high, low, _ = parts(token[a : min(end, a + ROW)], own)
                rows.append((int(bucket[a]), batch, None, high, low, _steps(own), who.tobytes(), None))
            if len(rows) >= 256:
                yield _batch_rows(_BLOBS, rows)
                rows = []
        yield _batch_rows(_BLOBS, rows)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch, held, waiting, count = TaskContext.get().partitionId() << 32, [], 0, 0
        for rows in batches:
            for a, b, token, of in document_sets(*string_buffers(rows.column(0)), size):
                if held and (waiting + len(token) > hold or count + b - a > 60_000):
                    yield from flush(batch, held)
                    batch, held, waiting, count = batch + 1, [], 0, 0
                held.append((token, (of + count).astype(np.int32), *_classes(token, of, b - a), _sketches(token, of, b - a)))
                waiting, count = waiting + len(token), count + b - a
        if held:
            yield from flush(batch, held)
        give_back()

    small_batches(docs.sparkSession)
    return docs.select("text").mapInArrow(task, _BLOBS)


def _steps(at: np.ndarray) -> bytes:
    """Rising numbers of documents, each at most 255 above the one before: the first, and a byte for every step."""
    return at[:1].tobytes() + np.diff(at).astype(np.uint8).tobytes()


def _documents(steps: bytes) -> np.ndarray:
    return np.cumsum(np.r_[np.frombuffer(steps, np.uint16, 1).astype(np.int64), np.frombuffer(steps, np.uint8, offset=2)]).astype(np.uint16)


def _tokens(high: bytes, low: bytes) -> np.ndarray:
    return np.frombuffer(high, np.uint32).astype(np.uint64) << np.uint64(16) | np.frombuffer(low, np.uint16)


def _classes_of(at: np.ndarray, who: bytes) -> np.ndarray:
    """The class of each shingle of a row; who has one for each run of a document."""
    run = np.cumsum(np.r_[True, at[1:] != at[:-1]]) - 1
    return np.frombuffer(who, np.int64)[run]


def levels_of(token: np.ndarray, who: np.ndarray) -> np.ndarray:
    """The level of each shingle by its count; 0 if one class only has it."""
    order = np.argsort(token)
    token, who = token[order], who[order]
    first = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
    count = np.diff(np.append(first, len(token)))
    shared = np.minimum.reduceat(who, first) != np.maximum.reduceat(who, first)
    out = np.empty(len(token), np.uint8)
    out[order] = np.repeat(np.where(shared, _level(count), 0).astype(np.uint8), count)
    return out


def _counted(blobs: DataFrame, parts: int) -> DataFrame:
    """The same rows with the level of each shingle by its count; shingles of one class only are left out.  A bucket is
    in one task."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for rows in batches:
            known = rows.filter(rows.column("level").is_valid())
            if known.num_rows:
                yield known
            rest = rows.filter(rows.column("level").is_null())
            held += zip(*(rest.column(c).to_pylist() for c in ("batch", "high", "low", "at", "who")), strict=True)
        if not held:
            return
        level = levels_of(np.concatenate([_tokens(h[1], h[2]) for h in held]), np.concatenate([_classes_of(_documents(h[3]), h[4]) for h in held]))
        end, out = 0, []
        for batch, high, low, steps, _ in held:
            at = _documents(steps)
            own = level[end : end + len(at)]
            end += len(at)
            more = np.flatnonzero(own)
            if len(more):
                out.append((0, batch, None, np.frombuffer(high, np.uint32)[more].tobytes(), np.frombuffer(low, np.uint16)[more].tobytes(), at[more].tobytes(), None, own[more].tobytes()))
            if len(out) >= 256:
                yield _batch_rows(_BLOBS, out)
                out = []
        if out:
            yield _batch_rows(_BLOBS, out)
        give_back()

    return blobs.repartition(parts, "bucket").mapInArrow(task, _BLOBS)


_PREFIXES = "token bigint, cls bigint, n bigint, place bigint, " + ", ".join(f"{p} bigint" for p in SKETCH) + ", q2 array<bigint>, q3 array<bigint>, tokens binary"


def _prefixes(counted: DataFrame, parts: int, percent: int) -> DataFrame:
    """Of documents that share enough shingles with others: prefix rows (token, cls, n, place, sketch) under the first
    order, and a row (cls, n, q2, q3, tokens) with the prefixes under the other orders and all repeated shingles.

    Every prefix begins with the shingles that the document has for itself; they are counted and not listed.
    """
    names = [c.split()[0] for c in _PREFIXES.split(", ")]

    def lists(at: np.ndarray, values: np.ndarray, some: np.ndarray, docs: int) -> pa.Array:
        ends = np.cumsum(np.bincount(at, minlength=docs))[some]
        return pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(values.view(np.int64)))

    def assemble(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        meta = next(r[0] for r in rows if r[0] is not None)
        docs = len(meta) // 48
        cls, n = np.frombuffer(meta, np.int64, docs), np.frombuffer(meta, np.int64, docs, 8 * docs)
        sketch = np.frombuffer(meta, np.int64, 4 * docs, 16 * docs).reshape(docs, 4)
        token = np.concatenate([_tokens(r[1], r[2]) for r in rows])
        at = np.concatenate([np.frombuffer(r[3], np.uint16) for r in rows]).astype(np.int64)
        level = np.concatenate([np.frombuffer(r[4], np.uint8) for r in rows])
        own = n - np.bincount(at, minlength=docs)
        take = n - (percent * n + 99) // 100 + 1 - own
        some = np.flatnonzero(take > 0)
        if not len(some):
            return
        mine = take[at] > 0
        token, at, level = token[mine], at[mine], level[mine]
        count = np.bincount(at, minlength=docs)
        rank = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count)

        def ordered(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            by = np.lexsort((key, at))
            head = rank < take[at[by]]
            return token[by][head], at[by][head], rank[head]

        first, d, place = ordered(level.astype(np.uint64) << np.uint64(58) | mix(token) >> np.uint64(6))
        none = lambda k, kind: pa.nulls(k, kind)
        arrays = pa.list_(pa.int64())
        index = [first.view(np.int64), cls[d], n[d], place + own[d], *(sketch[d, k] for k in range(4))]
        yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in index), none(len(d), arrays), none(len(d), arrays), none(len(d), pa.binary())], names)
        others = [ordered(mix(token ^ np.uint64(salt))) for salt in (0x3C6EF372FE94F82A, 0xDAA66D2C7DDF743F)]
        whole = np.lexsort((token, at))
        ends = np.cumsum(count)[some]
        blob = pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer((np.r_[0, ends] * 8).astype(np.int32).tobytes()), pa.py_buffer(token[whole].tobytes())])
        k = len(some)
        yield pa.RecordBatch.from_arrays([none(k, pa.int64()), pa.array(cls[some]), pa.array(n[some]), *([none(k, pa.int64())] * 5), *(lists(o[1], o[0], some, docs) for o in others), blob], names)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        for rows in batches:
            for batch, *row in zip(*(rows.column(c).to_pylist() for c in ("batch", "docs", "high", "low", "at", "level")), strict=True):
                held.setdefault(batch, []).append(tuple(row))
        while held:
            yield from assemble(held.pop(next(iter(held))))
        give_back()

    return counted.repartition(parts, "batch").mapInArrow(task, _PREFIXES)


def _least(n: str, percent: int) -> str:
    """The least intersection of two linked sets whose sizes add up to n."""
    return f"((({n}) * {percent} + {99 + percent}) div {100 + percent})"


def _may_link(a: str, b: str, percent: int) -> Column:
    """What sizes, places and sketches of two index rows (columns with suffix a or b) leave possible, for a pair and this token.

    The first shingle that two prefixes share leaves at most min(rest) more, and linked sets differ in at
    most n1 + n2 - 2 * (the least intersection) shingles and so in no more parities.
    """
    least = _least(f"n{a} + n{b}", percent)
    sizes = F.expr(f"100 * least(n{a}, n{b}) >= {percent} * greatest(n{a}, n{b})")
    room = F.expr(f"least(n{a} - place{a}, n{b} - place{b}) >= {least}")
    apart = F.expr(" + ".join(f"bit_count({p}{a} ^ {p}{b})" for p in SKETCH) + f" <= n{a} + n{b} - 2 * {least}")
    return sizes & room & apart


def _verify(pairs: DataFrame, sets: DataFrame, scratch: list[str], name: str) -> DataFrame:
    """(x, y, both, nx, ny) of the pairs that pass the other orders; `both` is the size of the intersection."""
    side = lambda c, cols: sets.select(F.col("cls").alias(c), *[F.col(k).alias(f"{k}{c}") for k in cols])
    passed = pairs.join(side("x", ["q2", "q3"]), "x").join(side("y", ["q2", "q3"]), "y").filter(F.arrays_overlap("q2x", "q2y") & F.arrays_overlap("q3x", "q3y")).select("x", "y")
    met = passed.join(side("y", ["n", "tokens"]), "y").join(side("x", ["n", "tokens"]), "x").select("x", "y", "nx", "ny", "tokensx", "tokensy")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        both = [len(np.intersect1d(np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64), assume_unique=True)) for a, b in zip(batch.column(4), batch.column(5), strict=True)]
        return pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(4)], pa.array(both, pa.int64())], ["x", "y", "nx", "ny", "both"])

    return materialise(map_batches(met, work, "x bigint, y bigint, nx bigint, ny bigint, both bigint"), name, scratch)


def linked(percent: int) -> Column:
    return F.expr(f"100 * both >= {percent} * (nx + ny - both)")


#: Sizes are cut into bands of so many parts of themselves where groups are compared.
BAND = 1.02


def _across(opened: DataFrame, percent: int) -> DataFrame:
    """(x, y) of index rows of one token (with root) that different components hold and that may link.

    The smaller set of a pair holds the token in a shorter prefix, and the larger one in a prefix that gets shorter
    with the smaller set's size; both are applied before rows meet.  Rows of the group's largest component
    meet only those of other components.
    """
    largest = opened.groupBy("token", "root").count().groupBy("token").agg(F.max_by("root", "count").alias("main"))
    rows = opened.join(largest, "token").withColumn("other", F.col("root") != F.col("main")).drop("main")
    band = lambda n: F.floor(F.log(n.cast("double")) / F.log(F.lit(BAND)))
    columns = ["cls", "n", "place", *SKETCH, "root", "other"]
    small = rows.filter(f"n - place >= {_least('n + n', percent)}").select("token", band(F.col("n")).alias("band"), *[F.col(c).alias(f"{c}1") for c in columns])
    smallest = F.expr(f"(n * {percent} + 99) div 100")
    large = rows.withColumn("band", F.explode(F.sequence(band(smallest), band(F.col("n")))))
    floor = F.greatest(smallest, F.floor(F.pow(F.lit(BAND), F.col("band").cast("double"))) - 1)
    large = large.withColumn("m", floor).filter(f"n - place >= {_least('n + m', percent)}").select("token", "band", *[F.col(c).alias(f"{c}2") for c in columns])

    def met(a: DataFrame, b: DataFrame) -> DataFrame:
        pairs = a.join(b, ["token", "band"]).filter((F.col("n1") <= F.col("n2")) & (F.col("cls1") != F.col("cls2")) & (F.col("root1") != F.col("root2")) & _may_link("1", "2", percent))
        return pairs.select(F.least("cls1", "cls2").alias("x"), F.greatest("cls1", "cls2").alias("y"))

    return met(small.filter("other1"), large).unionByName(met(small.filter("not other1"), large.filter("other2"))).distinct()


def classes(docs: DataFrame, size: int = 4, percent: int = 85, scratch: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(members, roots): members (id, cls, n) of every row of docs (id, text); roots (cls, root) of classes
    that are linked to another class, root being one class of each component.

    Rows may share an id, and ids may be null.
    """
    scratch = [] if scratch is None else scratch
    summary = materialise(summaries(docs, size), "summary", scratch)
    members = summary.filter("slot is null").select("id", "cls", "n")
    total = members.agg(F.sum("n")).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // PART)
    levels = heavy_levels(summary, max(FREQUENT, total // (16 * parts)))
    counted = _counted(_blobs(docs, size, levels, SPREAD * parts), parts)
    prefixes = materialise(_prefixes(counted, parts, percent), "prefixes", early := [])
    row = ["cls", "n", "place", *SKETCH]
    index = prefixes.filter("token is not null").select("token", *row).distinct()
    # tokens of one class only (its copies) end here; the class that has a token foremost leads the others
    leader = F.min(F.struct("place", "cls", *[c for c in row if c not in ("place", "cls")]))
    several = index.groupBy("token").agg(leader.alias("x"), F.min("cls").alias("lo"), F.max("cls").alias("hi")).filter("lo < hi").select("token", "x")
    index = materialise(index.join(several, "token"), "index", scratch)
    sets = prefixes.filter("tokens is not null").select("cls", "n", "q2", "q3", "tokens").join(index.select("cls").distinct(), "cls", "left_semi")
    sets = materialise(sets.groupBy("cls").agg(F.first(F.struct("n", "q2", "q3", "tokens")).alias("s")).select("cls", "s.*"), "sets", scratch)
    drop_scratch(docs.sparkSession, early)
    led = index.select(*[F.col(c).alias(f"{c}1") for c in row], *[F.col("x")[c].alias(f"{c}2") for c in row]).filter((F.col("cls1") != F.col("cls2")) & _may_link("1", "2", percent))
    pairs = materialise(led.select(F.least("cls1", "cls2").alias("x"), F.greatest("cls1", "cls2").alias("y")).distinct(), "pairs", scratch)
    checked = _verify(pairs, sets, scratch, "checked")
    roots = components(checked.filter(linked(percent)).select("x", "y"), scratch)
    # groups that still hold several components
    rooted = index.drop("x").join(roots.select(F.col("node").alias("cls"), "root"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    open_groups = rooted.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("token")
    opened = materialise(rooted.join(open_groups, "token", "left_semi"), "open", scratch)
    rest = materialise(_across(opened, percent).join(pairs, ["x", "y"], "left_anti"), "pairs2", scratch)
    if not rest.isEmpty():
        checked = checked.unionByName(_verify(rest, sets, scratch, "checked2"))
        roots = components(checked.filter(linked(percent)).select("x", "y"), scratch)
    return members, roots.select(F.col("node").alias("cls"), "root")


def component_ids(docs: DataFrame, size: int = 4, percent: int = 85, scratch: list[str] | None = None) -> DataFrame:
    """(id, n, cls, component) a row a row of docs (id, text); component is the smallest id reachable by links.

    ids are of any type with an order.  Null ids name a component only where it has no other.
    """
    used: list[str] = []
    members, roots = classes(docs, size, percent, used)
    firsts = members.filter("n > 0").groupBy("cls").agg(F.min("id").alias("first"))
    named = firsts.join(roots, "cls")
    named = named.join(named.groupBy("root").agg(F.min("first").alias("component")), "root").select("cls", "component")
    named = firsts.join(named, "cls", "left").select("cls", F.coalesce("component", "first").alias("component"))
    out = members.join(named, "cls", "left").select("id", "n", "cls", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component"))
    kept = materialise(out, "components", scratch)
    drop_scratch(docs.sparkSession, used)
    return kept


def op5(docs: DataFrame) -> DataFrame:
    """The contract's columns; a row a row of documents.

    Null and empty texts and texts without words have no shingles and are their own components.  Repeated
    rows are linked as copies.  doc_id keeps its type; a null one stays null and never names a component that
    has another id.
    """
    out = component_ids(docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text")))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80, used: list[str] | None = None) -> DataFrame:
    """Pipeline stage: of each group of linked documents the one with the smallest id (of equal rows, one) stays.

    Documents without shingles all stay.  Columns stay as they are; near-duplicates share `percent` of their
    `size`-word shingles or more.  `used` gets the table that is returned, for the caller to drop.
    """
    names, spark, scratch = docs.columns, docs.sparkSession, []
    # written once, so that a row's number is the same whenever a task runs again
    rows = materialise(docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")).withColumn("number", F.monotonically_increasing_id()), "rows", scratch)
    key = F.struct(F.col("row.doc_id").isNull().alias("none"), F.col("row.doc_id").alias("id"), F.col("number"))
    found = component_ids(rows.select(key.alias("id"), F.col("row.text").cast("string").alias("text")), size, percent, scratch)
    losers = found.filter("n > 0 and id.number <> component.number").select("id.number")
    kept = materialise(rows.join(losers, "number", "left_anti").select(*[F.col("row").getField(c).alias(c) for c in names]), "kept", used)
    drop_scratch(spark, scratch)
    return kept
