"""External suffix sorting by recursive induction, with the common prefixes of neighbours.

Suffixes wait in queues that are ordered by first symbol and, within a symbol, by arrival: the priority in
which induction needs them.  What waits is a tuple: the suffix's symbol (its queue), its position, and what it
has in common with the one that arrived before it.  A queue keeps a bounded number of tuples in memory and the rest
on disk.  A level sorts the substrings between left-most S positions by induction, names them, sorts the
shorter string of names (recursively, or in memory once it is short), and induces the order of all suffixes from
it.  Two suffixes that are induced from others have one symbol more in common than those, and those the least that any
neighbours between them have, so common prefixes come down the recursion with the order.  All work on a symbol's tuples is
done in arrays.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

from .textcore import mix, powers

#: Tuples that a queue holds in memory, and names below which a level is sorted in memory.
IN_MEMORY = 4_000_000
#: Common prefixes are told up to this length, if nothing else is asked for.
CAP = 200


class BucketQueue:
    """A queue of tuples for each symbol, backed by one file."""

    def __init__(self, folder: str, kind: np.dtype, limit: int = IN_MEMORY):
        self.folder, self.kind, self.limit, self.held = folder, np.dtype(kind), limit, 0
        self.memory: dict[int, list[np.ndarray]] = {}
        self.disk: dict[int, list[tuple[int, int]]] = {}
        self.file = None

    def append(self, symbols: np.ndarray, positions: np.ndarray) -> None:
        """Add tuples to the queues of their symbols, in order."""
        order = np.argsort(symbols, kind="stable")
        self.append_grouped(symbols[order], positions[order])

    def append_grouped(self, symbols: np.ndarray, positions: np.ndarray) -> None:
        """append() for symbols that are in order."""
        cut = np.flatnonzero(symbols[1:] != symbols[:-1]) + 1
        ends = [0, *cut.tolist(), len(symbols)]
        for s, lo, hi in zip(symbols[[0, *cut]].tolist(), ends[:-1], ends[1:], strict=True):
            self.memory.setdefault(s, []).append(positions[lo:hi])
        self.held += len(positions)
        if self.held > self.limit:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile(dir=self.folder)
        self.file.seek(0, 2)
        for s, parts in self.memory.items():
            together = np.concatenate(parts)
            self.disk.setdefault(s, []).append((self.file.tell(), len(together)))
            self.file.write(together.astype(self.kind).tobytes())
        self.memory, self.held = {}, 0

    def take(self, symbol: int) -> np.ndarray:
        """All tuples waiting for a symbol, which then has none."""
        parts = []
        for at, n in self.disk.pop(symbol, []):
            self.file.seek(at)
            parts.append(np.frombuffer(self.file.read(self.kind.itemsize * n), self.kind))
        own = self.memory.pop(symbol, [])
        self.held -= sum(map(len, own))
        parts += own
        return np.concatenate(parts) if parts else np.zeros(0, self.kind)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def s_types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one; the last symbol must be smaller than all others."""
    n = len(text)
    out = np.zeros(n, bool)
    out[-1] = True
    rising, equal = text[:-1] < text[1:], np.flatnonzero(text[:-1] == text[1:])
    out[:-1] = rising
    if len(equal):  # a run of equal symbols is as its end is
        run = np.flatnonzero(np.r_[True, np.diff(equal) > 1])
        ends = equal[np.append(run[1:], len(equal)) - 1] + 1
        out[equal] = np.repeat(out[ends], np.diff(np.append(run, len(equal))))
    return out


def range_least(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The least of values[first..last], both included, for every pair."""
    out, table = values[last], values
    level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
    for k in range(1, int(level.max(initial=0)) + 1):
        table = np.minimum(table[: -(1 << k - 1)], table[1 << k - 1 :])
        mine = np.flatnonzero(level == k)
        out[mine] = np.minimum(table[first[mine]], table[last[mine] + 1 - (1 << k)])
    return out


class Neighbours:
    """What the suffixes of a scan have in common with the one before, for those that they induce.

    Of the scan behind, only the places are kept whose number no later one reaches: one for each number up to the cap.
    """

    def __init__(self, symbols: int, cap: int):
        self.cap, self.scanned = cap, 0
        self.latest = np.full(symbols, -1, np.int64)  # place of the scan that induced each symbol's latest suffix
        self.places, self.least = np.zeros(0, np.int64), np.zeros(0, np.int16)

    def induced(self, common: np.ndarray, at: np.ndarray, of: np.ndarray) -> np.ndarray:
        """For the places `at` of a scanned stretch, which induce suffixes of the symbols `of` and are grouped by them: what
        each of those has in common with the one that its queue got before it (0: the first)."""
        first = np.r_[True, of[1:] != of[:-1]][: len(of)]
        found = np.empty(len(of), np.int16)
        later, head = np.flatnonzero(~first), np.flatnonzero(first)
        found[later] = range_least(common, at[later - 1] + 1, at[later])
        if len(head):
            before, least = self.latest[of[head]], np.minimum.accumulate(common)[at[head]]
            behind = np.searchsorted(self.places, before, "right")
            there = np.flatnonzero(behind < len(self.places))
            least[there] = np.minimum(least[there], self.least[behind[there]])
            found[head] = np.where(before < 0, -1, least)
            end = np.r_[first[1:], True]
            self.latest[of[end]] = self.scanned + at[end]
        self._pass(common)
        return np.minimum(found + 1, self.cap)

    def _pass(self, common: np.ndarray) -> None:
        if not len(common):
            return
        least = np.minimum.accumulate(common[::-1])[::-1]
        own = np.flatnonzero(common < np.append(least[1:], np.iinfo(np.int16).max))
        still = self.least < least[0]
        self.places = np.concatenate([self.places[still], self.scanned + own])
        self.least = np.concatenate([self.least[still], common[own]])
        self.scanned += len(common)


def _induce(text: np.ndarray, s_type: np.ndarray, seeds: np.ndarray, folder: str, common: np.ndarray | None = None, cap: int = CAP) -> Iterator[np.ndarray]:
    """Tuples (at, common) symbol by symbol, from the largest symbol down, each in ascending suffix order, given the
    left-most S positions (seeds) in suffix order and what each has in common with the seed before it.

    Without that, positions come out alone, and their common prefixes as 0.
    """
    alphabet = np.unique(text)
    kind = np.dtype([("at", seeds.dtype), ("common", np.int16)], align=True)
    carried = common is not None

    def tuples(at: np.ndarray, shared: np.ndarray | int) -> np.ndarray:
        out = np.empty(len(at), kind)
        out["at"], out["common"] = at, shared
        return out

    def run(at: int) -> int:
        ahead = text[at : at + cap]
        other = np.flatnonzero(ahead != ahead[0])
        return int(other[0]) if len(other) else len(ahead)

    def border(low: np.ndarray, high: np.ndarray) -> int:
        """Common prefix of a symbol's last L and first S suffix: after the shorter of their runs one goes down or the other up."""
        return min(run(int(low["at"][-1])), run(int(high["at"][0]))) if carried and len(low) and len(high) else 0

    def before(now: np.ndarray, wanted: bool, queue: BucketQueue, scan: Neighbours) -> None:
        at = now["at"] - 1
        some = np.flatnonzero((s_type[at] == wanted) & (at >= 0))
        symbols = text[at[some]]
        order = np.argsort(symbols, kind="stable")
        some, symbols = some[order], symbols[order]
        common = scan.induced(np.ascontiguousarray(now["common"]), some, symbols) if carried else 0
        if len(some):
            queue.append_grouped(symbols, tuples(at[some], common))

    starts, larger = BucketQueue(folder, kind), BucketQueue(folder, kind)
    starts.append(text[seeds], tuples(seeds, common if carried else 0))
    kept_l, scan = BucketQueue(folder, kind), Neighbours(int(alphabet[-1]) + 1, cap)
    for c in alphabet.tolist():
        low = np.zeros(0, kind)
        while len(now := larger.take(c)):
            kept_l.append(np.full(len(now), c, text.dtype), now)
            before(now, False, larger, scan)
            low = now
        if len(seed := starts.take(c)):
            seed = seed.copy()
            seed["common"][0] = border(low, seed)
            before(seed, False, larger, scan)

    smaller, scan = BucketQueue(folder, kind), Neighbours(int(alphabet[-1]) + 1, cap)
    last = len(text) - 1
    for c in alphabet[::-1].tolist():
        down = []  # from the largest, each with what it has in common with the larger one before it
        if c == int(text[last]):
            down.append(tuples(np.array([last]), 0))
        while len(now := smaller.take(c)):
            down.append(now)
            before(now, True, smaller, scan)
        low, high = kept_l.take(c), np.concatenate([np.zeros(0, kind), *down])[::-1]
        between = border(low, high)
        if len(low):
            before(tuples(low["at"][::-1], np.append(low["common"][1:], between)[::-1]), True, smaller, scan)
        yield np.concatenate([low, tuples(high["at"], np.r_[between, high["common"][:-1]][: len(high)])])
    for q in (starts, larger, kept_l, smaller):
        q.close()


def shared(values: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """How many values from the places a and b on are equal, up to cap; a step at a time, for those that still agree."""
    out, live = np.zeros(len(a), np.int64), np.arange(len(a))
    for k in range(cap):
        x, y = a[live] + k, b[live] + k
        inside = np.maximum(x, y) < len(values)
        live, x, y = live[inside], x[inside], y[inside]
        live = live[values[x] == values[y]]
        if not len(live):
            break
        out[live] += 1
    return out


def names_in_order(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order of names by rank doubling, and how many names neighbours share, out of the same ranks.

    The last name must be unique.
    """
    rank, step, ranks = names.astype(np.int64), 1, []
    while True:
        ranks.append(rank)
        order = np.argsort(key := rank * (len(rank) + 2) + np.append(rank[step:] + 1, np.zeros(min(step, len(rank)), np.int64)))
        new = np.empty_like(rank)
        new[order] = np.cumsum(np.r_[0, np.diff(key[order]) != 0])
        rank, step = new, step * 2
        if rank[order[-1]] == len(rank) - 1:
            break
    a, b = order[1:].copy(), order[:-1].copy()
    for k in range(len(ranks) - 1, -1, -1):
        same = ranks[k][a] == ranks[k][b]
        a[same] += 1 << k
        b[same] += 1 << k
    return order, a - order[1:]


def sort_with_prefixes(text: np.ndarray, folder: str, in_memory: int = IN_MEMORY, cap: int = CAP) -> Iterator[np.ndarray]:
    """The suffixes of text in descending runs: arrays of (at, common), each ascending, later ones smaller.

    `common` is what a suffix shares with the next smaller one, up to cap (below 32,000).  The last symbol must be unique and
    smaller than all others.
    """
    s_type = s_types(text)
    seeds = np.flatnonzero(s_type & ~np.r_[True, s_type[:-1]]).astype(np.int32 if len(text) < 1 << 31 else np.int64)
    common = np.zeros(len(seeds), np.int16)
    if len(seeds) > 1:
        # order of the substrings from one seed to the next, by induction from unordered seeds
        is_seed = np.zeros(len(text), bool)
        is_seed[seeds] = True
        ordered = np.concatenate([part["at"][is_seed[part["at"]]] for part in _induce(text, s_type, seeds, folder)][::-1])
        ends = np.append(seeds[1:], len(text) - 1)
        order = np.searchsorted(seeds, ordered)
        names = _name(text, seeds, ends, order)
        alike = np.zeros(len(seeds) - 1, np.int64)  # names that neighbours share
        if names.max() + 1 < len(seeds):
            if len(seeds) <= in_memory:
                order, alike = names_in_order(names)
            else:
                whole = np.concatenate([*sort_with_prefixes(np.append(names + 1, 0), folder, in_memory, cap)][::-1])[1:]
                order, alike = whole["at"].astype(np.int64), whole["common"][1:].astype(np.int64)
        a, b = seeds[order[1:] + alike].astype(np.int64), seeds[order[:-1] + alike].astype(np.int64)
        # equal names, then what the first different ones begin with
        common[1:] = np.minimum(a - seeds[order[1:]] + shared(text, a, b, cap), cap)
        seeds = seeds[order]
    return _induce(text, s_type, seeds, folder, common, cap)


def sort_suffixes(text: np.ndarray, folder: str, in_memory: int = IN_MEMORY) -> Iterator[np.ndarray]:
    """The suffixes of text in descending runs: arrays of positions, each ascending, later ones smaller."""
    return (part["at"] for part in sort_with_prefixes(text, folder, in_memory))


def _name(text: np.ndarray, seeds: np.ndarray, ends: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Ranks of the substrings seed..end (both included), equal for equal ones; order: their sorted order."""
    value = np.cumsum((mix(text.astype(np.uint64) + np.uint64(1)) | np.uint64(1)) * _odd(len(text)), dtype=np.uint64)
    head = np.r_[np.uint64(0), value][seeds]
    h = (value[ends] - head) * _odd_inverse(len(text))[seeds]
    size = ends - seeds
    a, b = order[1:], order[:-1]
    new = np.r_[False, (h[a] != h[b]) | (size[a] != size[b])]
    out = np.empty(len(seeds), np.int64)
    out[order] = np.cumsum(new)
    return out


_BASE = 0xD6E8FEB86659FD93


def _odd(n: int) -> np.ndarray:
    return powers(_BASE, n, "induced")


def _odd_inverse(n: int) -> np.ndarray:
    return powers(pow(_BASE, -1, 1 << 64), n, "induced-inverse")
