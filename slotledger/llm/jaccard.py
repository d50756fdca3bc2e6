"""N-gram Jaccard join: sets of word shingles that are nearly equal, found by partitioning the universe of shingles.

Shingles are hashed into m segments by the size band of a set. Two sets that are similar enough differ in at most H shingles,
so with m = H + 1 + SPARE segments at least 1 + SPARE of them are the same in both, and sets are indexed by the contents of
their segments. How the differences are paid for is decided by cost, band by band (`plan_band`): either every segment has to
be met exactly, or fewer and larger segments are met up to one difference each, through neighbourhoods with one shingle
deleted. Segments with fewer than two shingles say little and are left out where a set has no more than SPARE of them; where
segments are thin, empty ones are left out, and there are as many more segments.
Candidates are verified exactly.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotledger.llm.common import BROADCAST_KEYS, connected, dealt_anew, fresh_name, mix, pieces, release, row_key, small, sorted_groups, stored, tidied, word_names

SHINGLE = 3
#: Similarity as a fraction: linked if PART[1] * intersection >= PART[0] * union.
PART = (90, 100)
#: Ratio of the limits of a size band.
BAND_RATIO = 1.4
#: Segments that may be left out for having fewer than two shingles.
SPARE = 1
#: Segments that hold fewer shingles on average are thin.
THIN = 5.0
#: Signatures are first compared by so many more bits than it takes to number them.
PRINT_BITS = 14
#: Signatures of a task that are sorted and packed at once, and about as many as are compared at once.
PACKED, IN_RANGE = 1 << 20, 1 << 20
#: The sieve has a bit for each signature that is indexed, up to 2 to the power of this (64 MB); beyond, it lets more pass.
SIEVE_BITS = 29
#: Leaders of the sets of one signature that are compared with further ones; beyond, unlike sets are tied and cost more to verify.
LEADERS = 2048
#: Shingles aimed at in one block of a verification (8 bytes each).
BLOCK_SHINGLES = 200_000


# -- sets ----------------------------------------------------------------------------------------------------------------


def shingle_sets(texts: pa.Array, n: int = SHINGLE) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sorted distinct 64-bit shingle names of each row) in runs; A-Z lowered, words parted by white space."""
    for first, last, raw, limits in pieces(texts):
        words, at = word_names(raw, limits, lower=True)
        if len(words) >= n:
            grams = words[: len(words) - n + 1].copy()
            for k in range(1, n):
                grams = mix(grams * np.uint64(3) + words[k : len(words) - n + 1 + k])
        out = []
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            if b - a >= n:
                s = np.sort(grams[a : b - n + 1])
                keep = np.ones(len(s), dtype=bool)
                keep[1:] = s[1:] != s[:-1]
                out.append(s[keep])
            elif b > a:  # the whole short sequence is one shingle
                whole = np.array([b - a], dtype=np.uint64)
                for k in range(a, b):
                    whole = mix(whole * np.uint64(5) + words[k])
                out.append(whole)
            else:
                out.append(np.zeros(0, dtype=np.uint64))
        yield first, out


def set_name(s: np.ndarray) -> int:
    """A 64-bit name of a set, as a signed number."""
    return int(mix(np.array([np.add.reduce(mix(s ^ np.uint64(0x5851F42D4C957F2D))) + np.uint64(len(s))], dtype=np.uint64)).view(np.int64)[0])


# -- bands and costs -----------------------------------------------------------------------------------------------------


def band_limits(size: int) -> int:
    """The band of a set size of at least 1."""
    return int(math.floor(math.log(size) / math.log(BAND_RATIO) + 1e-9))


def band_range(band: int) -> tuple[int, int]:
    """The smallest and the largest size of a band; bands without any size have the largest below the smallest."""
    low = max(1, math.ceil(BAND_RATIO**band - 1e-9))
    while band_limits(low) < band:
        low += 1
    high = max(low - 1, math.floor(BAND_RATIO ** (band + 1)) + 1)
    while high >= low and band_limits(high) > band:
        high -= 1
    return low, high


def largest(size: int, part: tuple[int, int] = PART) -> int:
    """The largest size of a set that can be linked with one of `size`."""
    return size * part[1] // part[0]


def differences(size: int, part: tuple[int, int] = PART) -> int:
    """The most shingles in which a set of at most `size` and a linked one that is no smaller can differ."""
    # |x ^ y| = |x| + |y| - 2 i, with i >= t (|x| + |y|) / (1 + t); the bound grows with both sizes
    both = size + largest(size, part)
    return both * (part[1] - part[0]) // (part[1] + part[0])


@dataclass(frozen=True)
class Plan:
    """How the sets of a band and the larger ones linked with them are indexed."""

    band: int
    segments: int
    deletions: bool  # segments are met up to one difference
    spare: int
    weak: int = 2  # segments with fewer shingles are left out where a set has no more than `spare` of them


def _most_empty(size: int, segments: int) -> int:
    """So many of its segments a set of `size` shingles has empty, with few exceptions."""
    mean = segments * (1 - 1 / segments) ** size
    return math.ceil(mean + 3 * math.sqrt(mean))


def plan_band(band: int, n_sets: int, part: tuple[int, int] = PART) -> Plan:
    """The cheaper of two plans for a band of `n_sets` sets: index rows, plus pairs expected to meet by chance.

    Exact: H + 1 + SPARE segments, a row each. Deletions: a segment may take up one difference, so that two differences are
    needed to spoil it: H // 2 + 1 segments, with a row each for the whole and for each shingle left out. By chance two sets
    meet in a segment that both have empty.

    Where a limit far below 1 makes segments thin, nearly every set has more weak segments than SPARE, and empty ones would
    tie together whatever has them. There as many segments are added as the smallest sets of the band have empty ones, and
    these are left out; small sets take deletions, whose segments are twice as thick.
    """
    low, high = band_range(band)
    h = differences(high, part)
    if h == 0:
        return Plan(band, 1, False, 0)
    exact = h + 1 + SPARE
    if low / exact < THIN and exact * (1 + low / exact) * math.exp(-low / exact) > SPARE:
        spare = SPARE
        while spare <= h // 2 and (needed := _most_empty(low, h + 1 + spare)) > spare:
            spare = needed
        # in small sets more segments only make more empty ones
        return Plan(band, h + 1 + spare, False, spare, 1) if spare <= h // 2 else Plan(band, h // 2 + 1, True, 0)
    fewer = h // 2 + 1

    def chance(m: int, least: int) -> float:
        share = low / m
        empty = sum(math.exp(-share) * share**k / math.factorial(k) for k in range(least))
        return m * n_sets * n_sets / 2 * empty**2 * math.exp(-share * least)

    cost_exact = n_sets * exact + chance(exact, 2 if SPARE else 1)
    cost_fewer = n_sets * fewer * (1 + high / fewer) + chance(fewer, 1)
    return Plan(band, exact, False, SPARE) if cost_exact <= cost_fewer else Plan(band, fewer, True, 0)


def bands_of(size: int, part: tuple[int, int] = PART) -> list[int]:
    """The bands under which a set is indexed: its own, and those of smaller sets that it can be linked with."""
    own = band_limits(size)
    smallest = -(-size * part[0] // part[1])
    return list(range(band_limits(smallest), own + 1))


def signatures(s: np.ndarray, plan: Plan) -> np.ndarray:
    """The 64-bit names under which a sorted set is indexed by a plan."""
    m = plan.segments
    seed = np.uint64((plan.band * 1_000_003 + m) * 2 + plan.deletions)
    values = mix(s + np.uint64(0x632BE59BD9B4E019))
    if m == 1:
        limits = np.array([0, len(s)])
    else:
        # shingles are sorted by value and segments are ranges of it
        of = ((s >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        limits = np.searchsorted(of, np.arange(m + 1, dtype=np.uint64))
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(values, dtype=np.uint64)])
    sums = total[limits[1:]] - total[limits[:-1]]
    sizes = np.diff(limits)
    at = np.arange(m, dtype=np.uint64)
    names = mix(mix(sums + sizes.astype(np.uint64)) + mix(at * np.uint64(2654435761) + seed))
    if plan.deletions:
        # a segment with one shingle left out meets another one with one left out, or a smaller one as a whole
        owner = np.repeat(np.arange(m), sizes)
        less = mix(mix(sums[owner] - values + (sizes[owner] - 1).astype(np.uint64)) + mix(at[owner] * np.uint64(2654435761) + seed))
        return np.unique(np.concatenate([names, less]))
    weak = sizes < plan.weak
    if plan.spare and weak.sum() <= plan.spare:
        names = names[~weak]
    return names


# -- the join ------------------------------------------------------------------------------------------------------------


def _measure(n: int):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in shingle_sets(batch.column("text"), n):
                rows = [batch.column(c).slice(first, len(sets)) for c in ("rk", "doc_id")]
                sizes = pa.array([len(s) for s in sets], pa.int64())
                names = pa.array([set_name(s) if len(s) else None for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([*rows, sizes, names], names=["rk", "doc_id", "n", "sid"])

    return measure


@dataclass(frozen=True)
class Sieve:
    """Signatures are cut to `prints` bits and dealt by the first `ranges` of them; `bits` number the places of the sieve."""

    prints: int
    ranges: int
    bits: int

    @staticmethod
    def for_rows(rows: int) -> Sieve:
        size = max(1, rows).bit_length()
        bits = min(max(size, 16), SIEVE_BITS)
        ranges = min(max(size - IN_RANGE.bit_length() + 1, 3), bits - 6)
        return Sieve(min(max(size + PRINT_BITS, bits), 62), ranges, bits)

    def passing(self, names: np.ndarray, words: np.ndarray) -> np.ndarray:
        bit = names >> np.uint64(64 - self.bits)
        word = words[(bit >> np.uint64(6)).astype(np.int64)]
        return names[(word >> (bit & np.uint64(63))) & np.uint64(1) == 1]


def _signed(batches: Iterator[pa.RecordBatch], plans: dict[int, Plan], n: int, part: tuple[int, int]) -> Iterator[tuple[int, np.ndarray, list[tuple[int, np.ndarray]]]]:
    """The name, the shingles and, by band, the signatures of each set of a task, equal sets once."""
    seen: set[int] = set()
    for batch in batches:
        for _, sets in shingle_sets(batch.column("text"), n):
            for s in sets:
                bands = [b for b in bands_of(len(s), part) if b in plans] if len(s) else []
                if bands and (sid := set_name(s)) not in seen:
                    seen.add(sid)
                    yield sid, s, [(b, signatures(s, plans[b])) for b in bands]


def pack(values: np.ndarray) -> bytes:
    """Sorted numbers below 2^63 as the first and the steps between them, with as many bytes for each as the largest step needs."""
    steps = np.diff(values, prepend=np.uint64(0))
    width = max(1, -(-int(steps[1:].max(initial=0)).bit_length() // 8))
    return int(values[0]).to_bytes(8, "little") + bytes([width]) + steps[1:].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack(data: bytes) -> np.ndarray:
    width = data[8]
    body = np.frombuffer(data, dtype=np.uint8, offset=9).reshape(-1, width)
    steps = np.zeros((len(body) + 1, 8), dtype=np.uint8)
    steps[1:, :width] = body
    steps[0] = np.frombuffer(data, dtype=np.uint8, count=8)
    return np.cumsum(steps.view("<u8")[:, 0], dtype=np.uint64)


def _prints(plans: dict[int, Plan], n: int, part: tuple[int, int], sieve: Sieve):
    """(range, packed): the signatures of a task's sets, cut short, sorted, and packed by range."""

    def packed(held: list[np.ndarray]) -> pa.RecordBatch:
        values = np.concatenate(held)
        values >>= np.uint64(64 - sieve.prints)
        values.sort()
        of = values >> np.uint64(sieve.prints - sieve.ranges)
        first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        parts = [pack(values[a:b]) for a, b in zip(first, np.append(first[1:], len(values)))]
        return pa.RecordBatch.from_arrays([pa.array(of[first].astype(np.int32)), pa.array(parts, pa.binary())], names=["range", "packed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for _, _, by_band in _signed(batches, plans, n, part):
            held += [names for _, names in by_band]
            count += sum(len(names) for _, names in by_band)
            if count >= PACKED:
                yield packed(held)
                held, count = [], 0
        if count:
            yield packed(held)

    return run


def _met(sieve: Sieve):
    """(range, words): for each range the places of the sieve whose signatures came more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["range"]):
            values = np.sort(np.concatenate([unpack(x) for x in group.column("packed").to_pylist()]))
            twice = values[1:][values[1:] == values[:-1]]
            bit = (twice >> np.uint64(sieve.prints - sieve.bits)) & np.uint64((1 << (sieve.bits - sieve.ranges)) - 1)
            places = np.zeros(1 << (sieve.bits - sieve.ranges), dtype=np.uint8)
            places[bit.astype(np.int64)] = 1
            yield pa.RecordBatch.from_arrays([group.column("range").combine_chunks()[:1], pa.array([np.packbits(places, bitorder="little").tobytes()])], names=["range", "words"])

    return run


def _sieve_words(docs: DataFrame, plans: dict[int, Plan], n: int, part: tuple[int, int], sieve: Sieve) -> np.ndarray:
    """The sieve, 64 places in a word. Tasks send what they have sorted and packed; the driver gets bits of a fixed number."""
    prints = docs.select("text").mapInArrow(tidied(_prints(plans, n, part, sieve)), "range int, packed binary")
    prints = prints.repartition("range").sortWithinPartitions("range")
    met = prints.mapInArrow(tidied(_met(sieve)), "range int, words binary")
    out = np.zeros((1 << sieve.ranges, 1 << (sieve.bits - sieve.ranges - 6)), dtype="<u8")
    for r in met.toLocalIterator():
        out[r["range"]] = np.frombuffer(r["words"], dtype="<u8")
    return out.reshape(-1)


def outline_places(band: int) -> int:
    """Into how many places the outlines of a band count: about a quarter of its smallest size."""
    return 1 << max(4, (band_range(band)[0] // 4).bit_length())


def outline(s: np.ndarray, band: int) -> bytes:
    """How many shingles a set has in each place, up to 15, two in a byte, after the band and the size of the set.

    The sum of the differences of two outlines is at most the number of shingles in which the sets differ.
    """
    places = outline_places(band)
    counts = np.bincount((s >> np.uint64(65 - places.bit_length())).astype(np.int64), minlength=places)
    counts = np.minimum(counts, 15).astype(np.uint8)
    return bytes([band]) + len(s).to_bytes(7, "little") + (counts[::2] << 4 | counts[1::2]).tobytes()


def counts_of(outlines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The sizes of sets, and their outlines, of one band, as rows of counts."""
    packed = np.frombuffer(b"".join(outlines), dtype=np.uint8).reshape(len(outlines), -1)
    sizes = packed[:, :8].copy().view("<u8")[:, 0] >> np.uint64(8)
    return sizes.astype(np.int64), np.concatenate([packed[:, 8:] >> 4, packed[:, 8:] & 15], axis=1).astype(np.int16)


def _index(plans: dict[int, Plan], n: int, part: tuple[int, int], sieve: Sieve, words: Broadcast):
    """Rows of signature, set and outline, of the signatures that pass the sieve."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, ids, outlines, count = [], [], [], 0

        def rows() -> pa.RecordBatch:
            columns = [pa.array(np.concatenate(names).view(np.int64)), pa.array(np.concatenate(ids)), pa.array(outlines, pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["sig", "sid", "outline"])

        for sid, s, by_band in _signed(batches, plans, n, part):
            for band, own in by_band:
                own = sieve.passing(own, words.value)
                if len(own):
                    names.append(own)
                    ids.append(np.full(len(own), sid, dtype=np.int64))
                    outlines += [outline(s, band)] * len(own)
                    count += len(own)
            if count >= PACKED // 32:
                yield rows()
                names, ids, outlines, count = [], [], [], 0
        if count:
            yield rows()

    return index


class Neighbours:
    """The sets of one signature, seen one after another, tied together where they may be linked.

    A tie has a leader, a radius, the largest distance of a member's outline from the leader's, and the size of its largest set.
    Linked sets of known sizes differ in so many shingles at most. A set whose outline is farther from a leader than that and the
    radius together differs from every member in more, by the triangle inequality; otherwise it joins. So linked sets are
    always tied, and only leaders are held. Beyond LEADERS leaders all further sets are tied to the first.
    """

    def __init__(self, part: tuple[int, int] = PART):
        self.part, self.ids = part, []
        self.radius, self.largest = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.outlines: np.ndarray | None = None

    def _apart(self, sizes: np.ndarray, others: np.ndarray) -> np.ndarray:
        """The most shingles in which linked sets of such sizes differ; the other is no larger than a linked one can be."""
        others = np.minimum(others, sizes * self.part[1] // self.part[0])
        return (sizes + others) * (self.part[1] - self.part[0]) // (self.part[1] + self.part[0])

    def _lead(self, x: int, size: int, own: np.ndarray) -> None:
        self.ids.append(x)
        self.radius, self.largest = np.append(self.radius, 0), np.append(self.largest, size)
        self.outlines = own[None] if self.outlines is None else np.concatenate([self.outlines, own[None]])

    def add(self, ids: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, int]]:
        """Pairs that tie these sets to each other and to those before."""
        start = 0
        if self.outlines is None:
            self._lead(int(ids[0]), int(sizes[0]), counts[0])
            start = 1
            if len(ids) == 1:
                return
        if len(self.ids) == 1:
            far = np.abs(counts[start:] - self.outlines[0]).sum(axis=1)
            if (far <= self.radius[0] + self._apart(sizes[start:], np.full(len(far), self.largest[0]))).all():
                self.radius[0] = max(self.radius[0], int(far.max(initial=0)))
                self.largest[0] = max(self.largest[0], int(sizes[start:].max(initial=0)))
                yield from ((int(x), self.ids[0]) for x in ids[start:])
                return
        for x, size, own in zip(ids[start:].tolist(), sizes[start:].tolist(), counts[start:]):
            far = np.abs(self.outlines - own).sum(axis=1)
            near = np.flatnonzero(far <= self.radius + self._apart(np.full(len(far), size), self.largest))
            if len(near):
                first = int(near[0])
                self.radius[first] = max(self.radius[first], int(far[first]))
                self.largest[first] = max(self.largest[first], size)
                yield from ((x, self.ids[k]) for k in near.tolist())
            elif len(self.ids) < LEADERS:
                self._lead(x, size, own)
            else:
                self.radius[0] = 1 << 30
                yield x, self.ids[0]
                yield from ((k, self.ids[0]) for k in self.ids[1:])


def _ties(part: tuple[int, int]):
    """(a, b): sets tied by a signature, from rows sorted by it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, found = None, Neighbours(part)
        for batch in batches:
            if not batch.num_rows:
                continue
            sig, sid, outlines = batch.column("sig").to_numpy(), batch.column("sid").to_numpy(), batch.column("outline").to_pylist()
            edges = np.concatenate([[0], np.flatnonzero(sig[1:] != sig[:-1]) + 1, [len(sig)]]).tolist()
            ties: list[tuple[int, int]] = []
            for a, b in zip(edges, edges[1:]):
                if sig[a] != now:
                    now, found = sig[a], Neighbours(part)
                    if b - a == 1 and b < len(sig):
                        continue  # alone
                ties += found.add(sid[a:b], *counts_of(outlines[a:b]))
            if ties:
                made = np.unique(np.array(ties, dtype=np.int64), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(made[:, 0]), pa.array(made[:, 1])], names=["a", "b"])

    return run


def _sets(n: int, columns: list[str]):
    """The shingles of the column `text`, as `grams`, beside other columns."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, found in shingle_sets(batch.column("text"), n):
                limits = np.concatenate([[0], np.cumsum([len(s) for s in found])]).astype(np.int32)
                column = pa.ListArray.from_arrays(pa.array(limits), pa.array(np.concatenate(found).view(np.int64)))
                part = [batch.column(c).slice(first, len(found)) for c in columns]
                yield pa.RecordBatch.from_arrays([*part, column], names=[*columns, "grams"])

    return sets


def _arrays(table: pa.Table) -> list[np.ndarray]:
    """The sets of a table."""
    column = table.column("grams").combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0)
    limits = column.offsets.to_numpy()
    values = column.values.to_numpy().view(np.uint64)
    return [values[x:y] for x, y in zip(limits[:-1], limits[1:])]


def _pairs(a: list[int], b: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _stars(part: tuple[int, int]):
    """(a, b): the sets of a block of a cluster that are linked with its leader, which bears the cluster's name."""

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_a, out_b = [], []
        for group in sorted_groups(batches, ["cluster", "at"]):
            cluster, sid = group.column("cluster")[0].as_py(), group.column("sid").to_numpy()
            sets, lead = _arrays(group), int(np.flatnonzero(sid == cluster)[0])
            leader = sets[lead]
            for k, s in enumerate(sets):
                if k != lead:
                    at = np.minimum(np.searchsorted(leader, s), len(leader) - 1)
                    common = int((leader[at] == s).sum())
                    if part[1] * common >= part[0] * (len(s) + len(leader) - common):
                        out_a.append(int(sid[k]))
                        out_b.append(cluster)
            if len(out_a) > 10_000:
                yield _pairs(out_a, out_b)
                out_a, out_b = [], []
        if out_a:
            yield _pairs(out_a, out_b)

    return stars


def linked_pairs(a: list[np.ndarray], b: list[np.ndarray] | None, part: tuple[int, int]) -> Iterator[tuple[int, int]]:
    """Indices of linked sets: within `a`, or between `a` and `b`; leaves out pairs that others already connect.

    All sets of `b` that share a shingle with one of `a` are counted through one sorted list of (shingle, owner).
    """
    other = a if b is None else b
    owner = np.repeat(np.arange(len(other)), [len(s) for s in other])
    grams = np.concatenate(other)
    order = np.argsort(grams, kind="stable")
    grams, owner = grams[order], owner[order]
    sizes = np.array([len(s) for s in other])
    root = list(range(len(a) + (0 if b is None else len(b))))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, s in enumerate(a):
        low, high = np.searchsorted(grams, s, side="left"), np.searchsorted(grams, s, side="right")
        n = high - low
        hit = np.repeat(high - np.cumsum(n), n) + np.arange(n.sum())
        common = np.bincount(owner[hit], minlength=len(other))
        good = part[1] * common >= part[0] * (len(s) + sizes - common)
        for j in np.flatnonzero(good).tolist():
            if b is None and j <= i:
                continue
            x, y = find(i), find(j if b is None else len(a) + j)
            if x != y:
                root[x] = y
                yield i, j


UNIT = ["cluster", "cross", "band", "i", "other", "j"]


def _verify(part: tuple[int, int]):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_a, out_b = [], []
        for group in sorted_groups(batches, UNIT):
            if group.num_rows < 2:
                continue
            sid = group.column("sid").to_numpy()
            right = group.column("right").to_numpy(zero_copy_only=False).astype(bool)
            sets = _arrays(group)
            cross, band, i, other, j = (group.column(c)[0].as_py() for c in UNIT[1:])
            same = not cross and (band, i) == (other, j)
            a = np.flatnonzero(~right)
            b = None if same else np.flatnonzero(right)
            if not len(a) or (b is not None and not len(b)):
                continue
            for x, y in linked_pairs([sets[k] for k in a], None if b is None else [sets[k] for k in b], part):
                out_a.append(sid[a[x]])
                out_b.append(sid[a[y]] if b is None else sid[b[y]])
            if len(out_a) > 10_000:
                yield _pairs(out_a, out_b)
                out_a, out_b = [], []
        if out_a:
            yield _pairs(out_a, out_b)

    return verify


def _band_column(size: str):
    """The band of a size column, from a table of limits (exact, unlike a logarithm in SQL)."""
    out, band = F.lit(0), 0
    while True:
        low, high = band_range(band)
        if low > 1 << 40:
            return out
        if high >= low:
            out = F.when(F.col(size) >= low, band).otherwise(out)
        band += 1


def _without_copies(docs: DataFrame, measured: DataFrame) -> DataFrame:
    """`docs` with one row for each set, where the others are few enough to be named to all tasks; this changes the cost only."""
    first = dealt_anew(measured.filter("n > 0").groupBy("sid").agg(F.min("rk").alias("first")), "sid")
    copies = stored(measured.join(first, "sid").filter("rk <> first").select("rk").distinct(), "copies")
    if copies.limit(BROADCAST_KEYS + 1).count() > BROADCAST_KEYS:
        return docs
    return docs.join(F.broadcast(copies), "rk", "left_anti")


def candidate_clusters(docs: DataFrame, measured: DataFrame, n: int, part: tuple[int, int]) -> DataFrame:
    """(node, label), stored: sets that meet in the index, directly or through others.

    Nearly all signatures belong to one set. They are first sent cut short and packed, a few bytes each, to find those that
    come more than once; only these are sent with their sets, and with outlines of them, by which most of the sets that have
    met by chance are told apart at once.
    """
    counts = measured.filter("n > 0").select("sid", "n").distinct().groupBy("n").agg(F.count("*").alias("sets"))
    counts = counts.groupBy(_band_column("n").alias("band")).agg(F.sum("sets").alias("sets"))
    # at most a few hundred bands
    sets = {r.band: r.sets for r in counts.collect()}
    # where no difference is allowed, linked sets are equal and have one name already
    plans = {b: plan_band(b, k, part) for b, k in sets.items() if differences(band_range(b)[1], part)}

    def rows_of(band: int) -> int:
        """About so many signatures a set of the band has."""
        high = band_range(band)[1]
        return sum(plans[b].segments + high * plans[b].deletions for b in bands_of(high, part) if b in plans)

    sieve = Sieve.for_rows(sum(k * rows_of(b) for b, k in sets.items()))
    docs = _without_copies(docs, measured)
    words = docs.sparkSession.sparkContext.broadcast(_sieve_words(docs, plans, n, part, sieve))
    rows = docs.select("text").mapInArrow(tidied(_index(plans, n, part, sieve, words)), "sig long, sid long, outline binary")
    rows = rows.repartition("sig").sortWithinPartitions("sig")
    links = rows.mapInArrow(tidied(_ties(part)), "a long, b long").filter("a <> b").distinct()
    clusters = stored(connected(links, "candidates"), "clusters")
    words.unpersist()
    return clusters


def _unit(cross: bool, band: Column, i: Column, other: Column, j: Column, right: Column) -> Column:
    return F.struct(F.lit(cross).alias("cross"), band.alias("band"), i.alias("i"), other.alias("other"), j.alias("j"), right.alias("right"))


_NO_UNITS = "array<struct<cross:boolean,band:int,i:int,other:int,j:int,right:boolean>>"


def _each_block(blocks: Column, unit: Callable[[Column], Column]) -> Column:
    """A unit for each of so many blocks; none where there is no such band."""
    return F.when(blocks.isNull(), F.array().cast(_NO_UNITS)).otherwise(F.transform(F.sequence(F.lit(0), blocks - 1), unit))


def _units(reach: int) -> Column:
    """The units of work of a set: `rest` ones meet each other and all others, these meet only rest ones.

    `rest_blocks` and `other_blocks` say how many blocks of either kind a band of the cluster has.
    """
    band, rest = F.col("band"), F.col("rest")
    mine = F.pmod(F.xxhash64("sid"), F.when(rest, F.col("rest_blocks")[band]).otherwise(F.col("other_blocks")[band])).cast("int")
    alone, among, across = F.lit(False), [], []
    among.append(_each_block(F.col("rest_blocks")[band], lambda j: _unit(False, band, F.least(mine, j), band, F.greatest(mine, j), mine > j)))
    for k in range(-reach, reach + 1):
        far = band + k
        if k:  # blocks of another band: the lower band stands first
            among.append(
                _each_block(
                    F.col("rest_blocks")[far],
                    (lambda j: _unit(False, band, mine, far, j, alone)) if k > 0 else (lambda j: _unit(False, far, j, band, mine, ~alone)),  # noqa: B023
                )
            )
        with_rest = _each_block(F.col("rest_blocks")[far], lambda j: _unit(True, band, mine, far, j, alone))  # noqa: B023
        with_others = _each_block(F.col("other_blocks")[far], lambda i: _unit(True, far, i, band, mine, ~alone))  # noqa: B023
        across.append(F.when(rest, with_others).otherwise(with_rest))
    return F.concat(F.when(rest, F.concat(*among)).otherwise(F.array().cast(_NO_UNITS)), *across)


def _blocks_by_band(members: DataFrame, name: str) -> DataFrame:
    blocks = members.groupBy("cluster", "band").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("k"))
    return blocks.groupBy("cluster").agg(F.map_from_entries(F.collect_list(F.struct("band", "k"))).alias(name))


def verified_links(docs: DataFrame, measured: DataFrame, clusters: DataFrame, n: int, part: tuple[int, int]) -> DataFrame:
    """(a, b), stored: links between sets of one cluster, enough of them to connect whatever is linked.

    First every set meets the leader of its cluster, in blocks of about BLOCK_SHINGLES that the leader is sent to. Sets linked
    with it are connected already, so of the others, the rest, each meets the rest and all those, but these not each other.
    There a cluster is cut by size band and, within a band, into blocks; blocks of one band or of bands that can be linked
    meet in a unit of work of its own, so that no group is held whole. A cluster of copies that are like its leader moves
    once, however large it is.
    """
    one = measured.filter("n > 0").groupBy("sid", "n").agg(F.min("rk").alias("rk"))
    members = one.join(clusters.select(F.col("node").alias("sid"), F.col("label").alias("cluster")), "sid")
    members = stored(members.withColumn("band", _band_column("n")), "members")

    def sets(of: DataFrame, columns: list[str]) -> DataFrame:
        wanted = small(of.select("rk"), BROADCAST_KEYS)  # other texts need not be moved
        texts = docs.select("rk", "text").join(wanted, "rk", "left_semi").join(of, "rk").select(*columns, "text")
        schema = ", ".join(f"{c} {texts.schema[c].dataType.simpleString()}" for c in columns)
        return texts.mapInArrow(tidied(_sets(n, columns)), f"{schema}, grams array<bigint>")

    parts = members.groupBy("cluster").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("parts"))
    own = F.array(F.pmod(F.xxhash64("sid"), F.col("parts")).cast("int"))
    places = F.when(F.col("sid") == F.col("cluster"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(own)
    spread = sets(members.join(small(parts, BROADCAST_KEYS), "cluster"), ["sid", "cluster", "parts"]).select("sid", "cluster", F.explode(places).alias("at"), "grams")
    spread = spread.repartition("cluster", "at").sortWithinPartitions("cluster", "at")
    stars = stored(spread.mapInArrow(tidied(_stars(part)), "a long, b long"), "stars")

    others = members.filter("sid <> cluster").join(stars.select(F.col("a").alias("sid"), F.lit(False).alias("rest")), "sid", "left")
    others = stored(others.withColumn("rest", F.coalesce("rest", F.lit(True))), "others")
    # a single set that is unlike the leader has nothing else to meet
    left = others.groupBy("cluster").agg(F.count("*").alias("sets"), F.bool_or("rest").alias("open")).filter("open and sets > 1").select("cluster")
    left = others.join(small(dealt_anew(left, "cluster"), BROADCAST_KEYS), "cluster", "left_semi")
    maps = _blocks_by_band(left.filter("rest"), "rest_blocks").join(_blocks_by_band(left.filter("not rest"), "other_blocks"), "cluster", "left")
    maps = maps.withColumn("other_blocks", F.coalesce("other_blocks", F.create_map().cast("map<int,int>")))
    columns = ["sid", "cluster", "band", "rest", "rest_blocks", "other_blocks"]
    reach = max(1, math.ceil(math.log(part[1] / part[0]) / math.log(BAND_RATIO)))
    spread = sets(left.join(small(maps, BROADCAST_KEYS), "cluster"), columns).select("sid", "cluster", "grams", F.inline(_units(reach)))
    spread = spread.repartition(*UNIT).sortWithinPartitions(*UNIT)
    links = stored(spread.mapInArrow(tidied(_verify(part)), "a long, b long").unionByName(stars), "links")
    release(others, stars, members)
    return links


def grouped(docs: DataFrame, n: int = SHINGLE, part: tuple[int, int] = PART) -> DataFrame:
    """(rk, doc_id, n, label), stored: per row of `docs` the size of its set and the name of its group; null without words."""
    docs = docs.select(row_key().alias("rk"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    measured = stored(docs.mapInArrow(tidied(_measure(n)), "rk long, doc_id long, n long, sid long"), "sets")
    clusters = candidate_clusters(docs, measured, n, part)
    links = verified_links(docs, measured, clusters, n, part)
    release(clusters)
    groups = connected(links, "groups").withColumnsRenamed({"node": "sid"})
    return stored(measured.join(groups, "sid", "left").select("rk", "doc_id", "n", F.coalesce("label", "sid").alias("label")), "grouped")


def near_duplicate_groups(docs: DataFrame, n: int = SHINGLE, part: tuple[int, int] = PART) -> DataFrame:
    """Per row of `docs` (doc_id, text): rk, doc_id, n_shingles, component_id.

    component_id is the smallest doc_id that links lead to, the row's own included; a document without words is linked with
    nothing. Rows that share a doc_id are told apart by their text. A null doc_id is never the smallest of a group with
    others. Shingles are compared by 64-bit hashes. Other columns are not looked at. An empty table gives an empty result.
    """
    rows = grouped(docs, n, part)
    least = rows.filter(F.col("label").isNotNull()).groupBy("label").agg(F.min("doc_id").alias("least"))
    return rows.join(dealt_anew(least, "label"), "label", "left").select("rk", "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))


def one_of_each_group(docs: DataFrame, n: int = SHINGLE, part: tuple[int, int] = PART) -> DataFrame:
    """The rows of `docs`, all columns: of each group the one of the smallest doc_id (nulls last, then the smallest key).

    Of rows equal in doc_id and text one stays. Documents without words form no groups.
    """
    rows = grouped(docs, n, part)
    # the place of a row in its group; a document without words is a group of its own
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rk")
    first = rows.filter("label is not null").groupBy("label").agg(F.min(order)["rk"].alias("first"))
    gone = rows.join(dealt_anew(first, "label"), "label").filter("rk <> first").select("rk").distinct()
    key = fresh_name(docs, "rk")
    out = docs.withColumn(key, row_key()).join(small(stored(gone, "copies").withColumnRenamed("rk", key), BROADCAST_KEYS), key, "left_anti")
    if rows.groupBy("rk").count().filter("count > 1").limit(1).count():
        out = out.dropDuplicates([key])
    return out.drop(key)
