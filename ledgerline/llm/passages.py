"""Substring dedup: near-duplicate passages by compact windows of min-hashes.

The tokens are five-word shingles. Under one hash function, every run of at least ``T``
shingles of a text has a smallest token. All runs with the same smallest token form a compact
window ``(left, centre, right)``: they contain the centre and stay between left and right. The
windows are the nodes of the Cartesian tree over the hashes that span ``T`` shingles or more,
about ``2 n / T`` for n shingles. Two passages with equal shingles have equal centres under each hash
function; two with Jaccard similarity s agree in each with probability s.

1. Shingles are dealt into buckets and counted there; each chunk of documents gets back which of its
   own another document holds too.
2. Each text is cut into compact windows under ``HASHES`` functions; a window's key is its
   centre's hash. Windows are kept, with the shingles they span, if their centre is shared and
   as many and as dense shingles are shared as any passage has in common (an exact bound).
3. Interval join: a window meets the first window of the key's first document. The matches of
   two documents are put together.
4. Verification: inside the matched windows the best common stretch of both texts is taken; it
   begins and ends with a common shingle, and counts if both sides have ``T`` shingles or more,
   four in five of them common, and the sides' Jaccard similarity is at least 0.8. Stretches of
   two documents do not overlap.
5. A window whose centre no passage covers yet is open. Keys with an open window are taken
   again: each window in turn is compared with those after it, unless both are settled or an
   exact count of common shingles rules the two out. So an open window meets every window of
   its key, and equal or near copies are settled by the first of them, without all pairs.

Defined results: null, empty and short texts have no passage; rows without a doc_id are left
out; rows that share a doc_id are one document, whose repeats inside itself do not count;
other columns are left out; documents without a repeated passage have no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import grouped, map_arrow, partitions, tasks_for, tiled
from ledgerline.llm.common import materialise as written
from ledgerline.llm.shingles import WIDTH, powers, shingle_hashes

#: A passage has more than 50 words: 51 words are 47 shingles.
LEAST_WORDS = 51
T = LEAST_WORDS - WIDTH + 1
PERCENT = 80
#: Common shingles per other one of both sides together, and of a side when both have as many.
OTHERS_OF_BOTH = PERCENT // (100 - PERCENT)
OTHERS = 2 * OTHERS_OF_BOTH
#: Positions in common that a side of a stretch that counts has at least: all others may be its own.
LEAST_COMMON = -(-PERCENT * T // 100)
#: One odd constant per hash function (fixed values of this module).
HASHES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
#: A side with T shingles or more and four in five of them common has DENSE_COMMON in some DENSE
#: of them: with fewer, L = DENSE q + r shingles would have at most 17 q + min(r, 17) < 0.8 L.
DENSE, DENSE_COMMON = 24, 18
#: Equal runs of a chain of which all pairs are counted at once; of a longer one fewer first runs at a time.
RUNS = 512
#: Steps between equal runs that are remembered.
STEPS = 100_000
#: Bytes per shingle in what verification compares; windows are short, so 24 bits suffice.
SHORT = 3
#: Text of a chunk of documents whose shingles are counted together.
CHUNK_BYTES = 2 << 20
#: Spark's setting that drops a finished execution's shuffle files.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Shingles of a key's block when its windows are taken again; a task holds two blocks.
KEY_BLOCK = 200_000


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once; the shuffle files of the write, which no later step reads, are dropped."""
    conf = df.sparkSession.conf
    before = conf.get(RELEASE)
    conf.set(RELEASE, "true")
    try:
        return written(df.select("*"), name)
    finally:
        conf.set(RELEASE, before)


def compact_windows(hashed: np.ndarray, least: int = T) -> np.ndarray:
    """``(left, centre, right)`` rows, right inclusive: Cartesian tree nodes of ``least`` or more."""
    out = []
    stack = [(0, len(hashed))] if len(hashed) >= least else []
    while stack:
        lo, hi = stack.pop()
        centre = lo + int(hashed[lo:hi].argmin())
        out.append((lo, centre, hi - 1))
        if centre - lo >= least:
            stack.append((lo, centre))
        if hi - centre > least:
            stack.append((centre + 1, hi))
    return np.array(out, np.int32).reshape(-1, 3)


def _mixed(h: np.ndarray, k: int) -> np.ndarray:
    x = (h ^ (h >> np.uint64(32))) * np.uint64(HASHES[k])
    x = (x ^ (x >> np.uint64(29))) * np.uint64(HASHES[(k + 1) % len(HASHES)])
    return x ^ (x >> np.uint64(32))


def windows_of(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and windows of a text's shingles under all hash functions."""
    keys, windows = [], []
    for k in range(len(HASHES)):
        hashed = _mixed(h, k)
        w = compact_windows(hashed)
        keys.append(hashed[w[:, 1]].view(np.int64))
        windows.append(w)
    return np.concatenate(keys), np.concatenate(windows)


def _chunks(docs: DataFrame) -> DataFrame:
    """``docs`` with a ``chunk``: rows are dealt by hash into chunks of about ``CHUNK_BYTES`` of text."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(tasks_for(int(total), CHUNK_BYTES, 1))))


def _shingles_of(table: pa.Table) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Documents of a chunk with ``T`` shingles or more, always in the same order: their shingles,
    the distinct ones, and the place of each among these."""
    rows = sorted(zip(table["doc_id"].to_pylist(), table["text"].to_pylist(), strict=True), key=lambda r: (r[0], r[1] or ""))
    each = ((doc, shingle_hashes(text)) for doc, text in rows)
    return [(doc, h, *np.unique(h, return_inverse=True)) for doc, h in each if len(h) >= T]


def _dealt(h: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the shingles by bucket, and where each bucket ends there."""
    bucket = ((h >> np.uint64(32)) % np.uint64(parts)).astype(np.int32)
    return np.argsort(bucket, kind="stable"), np.cumsum(np.bincount(bucket, minlength=parts))


def shared_bits(chunks: DataFrame) -> DataFrame:
    """``(chunk, bucket, bits)``: which distinct shingles of a chunk's documents another row holds too.

    Each bucket of shingles is counted whole, by 32 bits beside the bucket's number. Equal
    shingles are always found; unequal ones that agree in these bits only let windows pass.
    """
    parts = partitions(chunks.sparkSession)

    def values(table: pa.Table) -> pa.Table | None:
        h = np.concatenate([np.empty(0, np.uint64), *(d for _, _, d, _ in _shingles_of(table))])
        order, ends = _dealt(h, parts)
        low = h[order].astype("<u4")
        rows = [(k, low[lo:hi].tobytes()) for k, (lo, hi) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)) if hi > lo]
        if not rows:
            return None
        buckets, found = zip(*rows, strict=True)
        chunk = [table["chunk"][0].as_py()] * len(rows)
        return pa.table([pa.array(buckets, pa.int32()), pa.array(chunk, pa.int64()), pa.array(found, pa.binary())], names=["bucket", "chunk", "low"])

    def bits(table: pa.Table) -> pa.Table:
        each = [np.frombuffer(x.as_buffer(), "<u4") for x in table["low"]]
        every = np.concatenate(each)
        order = np.argsort(every)
        every = every[order]
        equal = every[1:] == every[:-1]
        shared = np.empty(len(every), bool)
        shared[order] = np.concatenate((equal, [False])) | np.concatenate(([False], equal))
        packed = [np.packbits(x).tobytes() for x in np.split(shared, np.cumsum([len(x) for x in each])[:-1])]
        return pa.table([table["chunk"], table["bucket"], pa.array(packed, pa.binary())], names=["chunk", "bucket", "bits"])

    dealt = grouped(chunks, ["chunk"], values, "bucket int, chunk long, low binary")
    return grouped(dealt, ["bucket"], bits, "chunk long, bucket int, bits binary")


def may_match(shared: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Windows whose centre is shared and that have as many and as dense shared shingles as any passage.

    What two documents have in common is shared, so no window of a passage fails.
    """
    held = np.concatenate(([0], np.cumsum(shared, dtype=np.int32)))
    dense = np.concatenate(([0], np.cumsum(held[DENSE:] - held[:-DENSE] >= DENSE_COMMON, dtype=np.int32)))
    left, centre, right = windows.T
    return shared[centre] & (held[right + 1] - held[left] >= LEAST_COMMON) & (dense[right + 2 - DENSE] > dense[left])


def contents(docs: DataFrame) -> DataFrame:
    """Per document its windows that may match, and the shingles from ``base`` that they span."""
    chunks = _chunks(docs)
    parts = partitions(docs.sparkSession)
    bits = materialise(shared_bits(chunks), "passage-shared")
    none = F.lit(None)
    both = chunks.select("chunk", "doc_id", "text", none.cast("int").alias("bucket"), none.cast("binary").alias("bits")).unionByName(
        bits.select("chunk", none.cast("long").alias("doc_id"), none.cast("string").alias("text"), "bucket", "bits")
    )

    def found(table: pa.Table) -> pa.Table | None:
        texts = _shingles_of(table.filter(pc.is_null(table["bits"])))
        if not texts:
            return None
        order, ends = _dealt(np.concatenate([d for _, _, d, _ in texts]), parts)
        starts = np.concatenate(([0], ends[:-1]))
        shared = np.zeros(len(order), bool)
        packed = table.filter(pc.is_valid(table["bits"]))
        for k, raw in zip(packed["bucket"].to_pylist(), packed["bits"], strict=True):
            own = order[starts[k] : ends[k]]
            shared[own] = np.unpackbits(np.frombuffer(raw.as_buffer(), np.uint8), count=len(own)).astype(bool)
        rows, at = [], 0
        for doc, h, distinct, place in texts:
            flags, at = shared[at : at + len(distinct)][place], at + len(distinct)
            if np.count_nonzero(flags) < LEAST_COMMON:
                continue
            keys, windows = windows_of(h)
            hit = may_match(flags, windows)
            if hit.any():
                w = windows[hit]
                lo, hi = int(w[:, 0].min()), int(w[:, 2].max())
                short = h[lo : hi + 1].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SHORT]
                rows.append((doc, keys[hit], *w.T, lo, short.tobytes()))
        if not rows:
            return None
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _CONTENT, strict=True)], schema=pa.schema(_CONTENT))

    schema = "doc long, keys array<long>, lefts array<int>, centres array<int>, rights array<int>, base int, seq binary"
    return grouped(both, ["chunk"], found, schema)


_INTS = pa.list_(pa.int32())
_CONTENT = [
    pa.field("doc", pa.int64()),
    pa.field("keys", pa.list_(pa.int64())),
    pa.field("lefts", _INTS),
    pa.field("centres", _INTS),
    pa.field("rights", _INTS),
    pa.field("base", pa.int32()),
    pa.field("seq", pa.binary()),
]


def _stretch(flags: np.ndarray, others: int) -> tuple[int, int]:
    """Bounds of the longest stretch with at most one other shingle for ``others`` common ones.

    In prefix sums of +1 and -others, it is the longest pair ``i < j`` with ``sums[j] >= sums[i]``.
    """
    sums = np.concatenate(([0], np.cumsum(np.where(flags, 1, -others))))
    later = np.maximum.accumulate(sums[::-1])  # largest sum from the end, ascending
    ends = len(sums) - 1 - np.searchsorted(later, sums, "left")
    lo = int((ends - np.arange(len(sums))).argmax())
    hi = int(ends[lo])
    common = np.flatnonzero(flags[lo:hi])
    return (lo + int(common[0]), lo + int(common[-1]) + 1) if len(common) else (lo, lo)


def _near(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two stretches are long enough and their shingle sets similar enough."""
    if min(len(x), len(y)) < T:
        return False
    x, y = np.unique(x), np.unique(y)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


def _has(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which small numbers of ``a`` also ``b`` holds."""
    held = np.zeros(1 + max(int(a.max(initial=0)), int(b.max(initial=0))), bool)
    held[b] = True
    return held[a]


def _least_share(common: np.ndarray) -> float:
    """The least share of others to common ones in a stretch of ``T`` shingles or more."""
    sums = np.concatenate(([0], np.cumsum(common)))
    most = [(n, int((sums[n:] - sums[:-n]).max())) for n in range(T, min(2 * T, len(sums)))]
    return min(((n - c) / c if c else np.inf for n, c in most), default=np.inf)


def _before(x: np.ndarray) -> np.ndarray:
    """The last place before each one that has its shingle; ``-T`` if none has."""
    order = np.argsort(x, kind="stable")
    same = x[order[1:]] == x[order[:-1]]
    out = np.full(len(x), -T)
    out[order[1:][same]] = order[:-1][same]
    return out


class Pair:
    """Two stretches, which of their shingles the other one holds, and the chains of equal runs tried so far.

    After a run the nearest equal shingles of both sides go on. A gap of more others than a
    quarter of the shorter side, and as many as the window has, ends the chain.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray, flags: tuple[np.ndarray, np.ndarray], before: tuple[np.ndarray, np.ndarray]) -> None:
        self.a, self.b, self.flags, self.before = a, b, flags, before
        self.most = min(len(a), len(b)) // OTHERS_OF_BOTH + 1
        self.at, self.o_at = (np.flatnonzero(f) for f in flags)
        # the same common shingles in the same order: the next ones of both sides are the nearest
        self.aligned = len(self.at) == len(self.o_at) and bool((a[self.at] == b[self.o_at]).all())
        self.repeats = any(int(x.max(initial=-1)) >= 0 for x in before)
        # a step depends on the place alone, forward as back
        self.sides = {False: (a, b, {}), True: (a[::-1], b[::-1], {})}
        self.tried: set[bytes] = set()
        self.unlike: set[tuple[int, int, int, int]] = set()

    def part(self, lo: int, hi: int, o_lo: int, o_hi: int) -> Pair:
        """Stretches of both sides, which hold small numbers."""
        if (lo, hi, o_lo, o_hi) == (0, len(self.a) - 1, 0, len(self.b) - 1):
            return self
        a, b = self.a[lo : hi + 1], self.b[o_lo : o_hi + 1]
        return Pair(a, b, (_has(a, b), _has(b, a)), (self.before[0][lo : hi + 1] - lo, self.before[1][o_lo : o_hi + 1] - o_lo))

    def may_hold(self) -> bool:
        """Whether a passage of both is possible, in any order (exact bounds)."""
        # no side of a stretch that counts has more others than this
        return min(len(self.at), len(self.o_at)) >= LEAST_COMMON and self.few_others() and all(_reached(f, np.arange(len(f))).any() for f in self.flags)

    def few_others(self) -> bool:
        """Whether both sides have a stretch of ``T`` shingles with few distinct others.

        As sets, a passage has four common shingles for each other one of both sides.
        """
        distinct = int(np.count_nonzero(self.before[0][self.at] < 0))
        others = 0
        for flags, before in zip(self.flags, self.before, strict=True):
            others += _least_others(flags, before)
            if OTHERS_OF_BOTH * others > distinct:
                return False
        return True

    @cached_property
    def may_follow(self) -> bool:
        """Whether a passage in the same order of both sides is possible (an exact bound).

        The others of both sides together are at most a quarter of the common positions, so the least shares
        of others to common ones in a stretch of either side are as much together. A stretch of 2 T or more
        has a part of T or more with a share no larger than its own.
        """
        return OTHERS_OF_BOTH * sum(_least_share(f) for f in self.flags) <= 1 + 1e-9

    def _step(self, back: bool, p: int, q: int) -> tuple[int, int, int]:
        """Length of the equal run at a place, and the place of the next run; -1 if none follows."""
        x, y, known = self.sides[back]
        got = known.get((p, q))
        if got is not None:
            return got
        first, limit, run, size = (p, q), min(len(x) - p, len(y) - q), 0, 64
        while run < limit:
            n = min(size, limit - run)
            unlike = x[p + run : p + run + n] != y[q + run : q + run + n]
            at = int(unlike.argmax())
            if unlike[at]:
                run += at
                break
            run, size = run + n, 2 * size
        p, q = p + run, q + run
        reach, step = 8, None
        while step is None and p < len(x) and q < len(y):
            u, v = np.nonzero(x[p : p + reach, None] == y[None, q : q + reach]) if reach <= 64 else np.intersect1d(x[p : p + reach], y[q : q + reach], return_indices=True)[1:]
            gap = u + v
            # beyond the slices a nearer pair needs a step of their length at least
            if len(gap) and (int(gap.min()) <= reach or reach > self.most):
                # of equally near ones the least shingle
                step = int(np.lexsort((x[p + u], gap))[0])
            elif reach > self.most:
                break
            reach *= 2
        got = (run, -1, -1) if step is None or gap[step] > self.most else (run, p + int(u[step]), q + int(v[step]))
        if len(known) >= STEPS:
            known.clear()
        known[first] = got
        return got

    def runs(self, i: int, j: int) -> np.ndarray:
        """Equal runs ``(start, other start, length)`` in order of both sides, from ``a[i] == b[j]`` out."""
        if self.aligned and i < len(self.a) and j < len(self.b) and self.flags[0][i] and (r := int(np.searchsorted(self.at, i))) == int(np.searchsorted(self.o_at, j)) and self.o_at[r] == j:
            gap = np.diff(self.at) + np.diff(self.o_at) - 2
            far = np.flatnonzero(gap > self.most) + 1
            k = int(np.searchsorted(far, r, "right"))
            lo, hi = int(far[k - 1]) if k else 0, int(far[k]) if k < len(far) else len(self.at)
            new = np.concatenate(([lo], np.flatnonzero(gap[lo : hi - 1]) + lo + 1))
            return np.stack((self.at[new], self.o_at[new], np.diff(np.append(new, hi))), axis=1)
        sides = []
        for back in (True, False):
            x, y, _ = self.sides[back]
            out = []
            p, q = (len(x) - i, len(y) - j) if back else (i, j)
            while 0 <= p < len(x) and 0 <= q < len(y):
                run, to, o_to = self._step(back, p, q)
                if run:
                    out.append((len(x) - p - run, len(y) - q - run, run) if back else (p, q, run))
                p, q = to, o_to
            sides.append(out)
        before, after = sides
        if before and after and (before[0][0] + before[0][2], before[0][1] + before[0][2]) == after[0][:2]:
            # the run around both places
            lo, p, n = before.pop(0)
            after[0] = (lo, p, n + after[0][2])
        return np.array(before[::-1] + after, np.int64).reshape(-1, 3)


def _news(codes: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Of each place the block after the last one before it that has its value; 0 if none has."""
    order = np.argsort(codes, kind="stable")
    same = codes[order[1:]] == codes[order[:-1]]
    out = np.zeros(len(codes), np.int64)
    out[order[1:][same]] = block[order[:-1][same]] + 1
    return out


def _in_order(pair: Pair, i: int, j: int) -> tuple[int, int, int, int] | None:
    """Longest near-equal stretch of both sides along the runs through ``a[i] == b[j]``.

    The others of both sides together are at most a quarter of the common shingles. Every run is
    tried as the first with every run as the last; their distinct shingles are counted at once.
    """
    runs = pair.runs(i, j)
    if not len(runs) or runs.tobytes() in pair.tried:
        return None
    pair.tried.add(runs.tobytes())
    start, other, n = runs.T
    m, held = len(runs), np.cumsum(n)
    # nothing is longer than the whole chain
    lo, hi, p, q = int(start[0]), int(start[-1] + n[-1]), int(other[0]), int(other[-1] + n[-1])
    if min(hi - lo, q - p) >= T and OTHERS_OF_BOTH * (hi - lo + q - p - 2 * int(held[-1])) <= held[-1] and (not pair.repeats or _near(pair.a[lo:hi], pair.b[p:q])):
        return lo, hi, p, q
    best, got, places = 0, None, None
    rows = max(1, RUNS * RUNS // m)
    for at in range(0, m, rows):
        # from run u to run v: common shingles, and the positions of both sides
        us = np.arange(at, min(at + rows, m))[:, None]
        common = held - (held - n)[us]
        size, o_size = start + n - start[us], other + n - other[us]
        both = size + o_size
        ok = (np.arange(m) >= us) & (np.minimum(size, o_size) >= T) & (OTHERS_OF_BOTH * (both - 2 * common) <= common) & (both > best)
        # without repeats the sets are as near as the positions
        if pair.repeats and ok.any():
            u, v = np.nonzero(ok)
            # ends that another chain had already
            each = list(zip(start[u + at].tolist(), (start + n)[v].tolist(), other[u + at].tolist(), (other + n)[v].tolist(), strict=True)) if len(u) <= RUNS else []
            if each and pair.unlike.issuperset(each):
                continue
            places = places or _places(pair.a, pair.b, runs)
            near = ok & _similar(places, at, len(us), m)
            if each and len(pair.unlike) < STEPS:
                pair.unlike.update(e for e, k in zip(each, near[u, v].tolist(), strict=True) if not k)
            ok = near
        both[~ok] = 0
        k = int(both.argmax())
        if both.flat[k] > best:
            u, v = at + k // m, k % m
            best, got = int(both.flat[k]), (int(start[u]), int(start[v] + n[v]), int(other[u]), int(other[v] + n[v]))
    return got


def _places(a: np.ndarray, b: np.ndarray, runs: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Of both sides and their union along the runs: a weight, and by place the first and the last run
    from which its shingle is new there, and the first run up to which a stretch holds it."""
    start, other, n = runs.T
    x, y = a[start[0] : start[-1] + n[-1]], b[other[0] : other[-1] + n[-1]]
    sides = []
    for z, begin in ((x, start - start[0]), (y, other - other[0])):
        block = np.repeat(np.arange(len(runs)), np.diff(np.append(begin, len(z))))
        sides.append((z, block, block + (np.arange(len(z)) >= (begin + n)[block])))
    # a gap comes after its run; the runs are the same on both sides
    (_, block, until), (_, o_block, o_until) = sides
    gap = o_until > o_block
    z, block, until = np.concatenate((x, y[gap])), np.concatenate((block, o_block[gap])), np.concatenate((until, o_until[gap]))
    order = np.lexsort((until, block))
    sides.append((z[order], block[order], until[order]))
    # both >= 0.8 of the union where the sides' sizes add up to 1.8 of it
    out = []
    for weight, (z, block, until) in zip((100, 100, -100 - PERCENT), sides, strict=True):
        first = _news(z.astype(np.uint16) if int(z.max()) < 1 << 16 else z, block)
        new = first <= block
        out.append((weight, first[new], block[new], until[new]))
    return out


def _similar(places: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]], at: int, rows: int, m: int) -> np.ndarray:
    """Whether the sets of both sides are similar enough, by first run (``rows`` of them from ``at``) and last run."""
    total = np.zeros((rows + 1) * m)
    for weight, first, last, until in places:
        use = (last >= at) & (first < at + rows)
        lo, hi = np.maximum(first[use] - at, 0), np.minimum(last[use] + 1 - at, rows)
        total += weight * (np.bincount(lo * m + until[use], minlength=len(total)) - np.bincount(hi * m + until[use], minlength=len(total)))
    return total.reshape(rows + 1, m)[:rows].cumsum(axis=0).cumsum(axis=1) >= 0


def common_passage(a: np.ndarray, b: np.ndarray, i: int = 0, j: int = 0) -> tuple[int, int, int, int] | None:
    """Bounds of the longest near-equal stretch of both sides, if it is long and near enough."""
    a, b = _small(a, b)
    pair = Pair(a, b, (_has(a, b), _has(b, a)), (_before(a), _before(b)))
    return _longest(pair, i, j) if pair.may_hold() else None


def _small(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Small numbers in the same order instead of the shingles: they are looked up in tables."""
    both = np.unique(np.concatenate((a, b)), return_inverse=True)[1].astype(np.int32)
    return both[: len(a)], both[len(a) :]


def _longest(pair: Pair, i: int, j: int) -> tuple[int, int, int, int] | None:
    """Stretches in the same order of both sides around ``a[i]``, ``b[j]`` come first, then those that
    hold the same shingles in any order."""
    got = _in_order(pair, i, j)
    for others in (OTHERS, OTHERS_OF_BOTH):
        if got is None:
            got = _any_order(pair, others)
    return got


def _any_order(pair: Pair, others: int) -> tuple[int, int, int, int] | None:
    a, b = pair.a, pair.b
    lo, hi = _stretch(pair.flags[0], others)
    if hi - lo < T:
        return None
    p, q = _stretch(_has(b, a[lo:hi]), others)
    if q - p < T:
        return None
    lo2, hi2 = _stretch(_has(a[lo:hi], b[p:q]), others)
    lo, hi = lo + lo2, lo + hi2
    return (lo, hi, p, q) if _near(a[lo:hi], b[p:q]) else None


def _short(seq: memoryview) -> np.ndarray:
    raw = np.frombuffer(seq, np.uint8).reshape(-1, SHORT).astype(np.int32)
    return raw[:, 0] | raw[:, 1] << 8 | raw[:, 2] << 16


def _least_others(common: np.ndarray, before: np.ndarray) -> int:
    """The least number of distinct others that a stretch of ``T`` shingles has."""
    at = np.flatnonzero(~common)
    if not len(at):
        return 0
    # a stretch that begins after the last place with the same shingle counts this one
    first = np.maximum(np.maximum(before[at], at - T) + 1, 0)
    change = np.bincount(first, minlength=len(common) + 1) - np.bincount(at + 1, minlength=len(common) + 1)
    return int(np.cumsum(change)[: len(common) - T + 1].min(initial=T))


def _run_start(a: np.ndarray, b: np.ndarray, i: int, j: int) -> tuple[int, int]:
    """First place of the equal run around ``a[i]`` and ``b[j]``; all its places begin the same chain."""
    n = min(i, j) + 1
    unlike = np.flatnonzero(a[i + 1 - n : i + 1] != b[j + 1 - n : j + 1])
    start = i + 1 - n + (int(unlike[-1]) + 1 if len(unlike) else 0)
    return start, i - j


def passages_of(x: np.ndarray, y: np.ndarray, matches: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Near-equal stretches of two texts inside their matched windows, which do not overlap.

    ``matches`` has rows ``(left, centre, right, other left, other centre, other right)``. Wide
    windows come first. A window is left out only if its centre lies in a stretch already, or if
    no stretch of it can be near enough.
    """
    x, y = _small(x, y)
    whole = Pair(x, y, (_has(x, y), _has(y, x)), (_before(x), _before(y)))
    return _passages(whole, matches) if whole.may_hold() else iter(())


def _passages(whole: Pair, matches: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    held, o_held = (np.concatenate(([0], np.cumsum(c))) for c in whole.flags)
    done: list[tuple[int, int]] = []
    failed, tried, pair = None, set(), None
    # in a fixed order, so that reruns agree
    left, at, right, o_left, _, o_right = matches.T
    for lo, centre, hi, o_lo, o_centre, o_hi in matches[np.lexsort((at, o_right - o_left, left - right))].tolist():
        if any(a <= centre < b for a, b in done):
            continue
        lo = max([lo, *(b for _, b in done if b <= centre)])
        hi = min([hi, *(a - 1 for a, _ in done if a > centre)])
        if min(held[hi + 1] - held[lo], o_held[o_hi + 1] - o_held[o_lo]) < LEAST_COMMON:
            continue
        if (lo, hi, o_lo, o_hi) == failed:
            # only the centres are new here
            if pair is None or not pair.may_follow:
                continue
            run = _run_start(pair.a, pair.b, centre - lo, o_centre - o_lo)
            if run in tried:
                continue
            tried.add(run)
            got = _in_order(pair, centre - lo, o_centre - o_lo)
        else:
            failed, pair = None, whole.part(lo, hi, o_lo, o_hi)
            pair.tried.clear()
            if pair is not whole and not pair.may_hold():
                pair, got = None, None
            else:
                tried = {_run_start(pair.a, pair.b, centre - lo, o_centre - o_lo)}
                got = _longest(pair, centre - lo, o_centre - o_lo)
        if got is None:
            failed = (lo, hi, o_lo, o_hi)
        else:
            done.append((lo + got[0], lo + got[1]))
            yield lo + got[0], lo + got[1], o_lo + got[2], o_lo + got[3]


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("left", "centre", "right", "o_left", "o_centre", "o_right")
    for batch in batches:
        lists = batch.column("matches")
        at = lists.offsets.to_numpy()
        every = np.stack([lists.values.field(lists.type.value_type.get_field_index(n)).to_numpy() for n in names], axis=1)
        docs, firsts, bases, o_bases = (batch.column(c).to_numpy() for c in ("doc", "first", "base", "o_base"))
        out = []
        for i, (seq, o_seq) in enumerate(zip(batch.column("seq"), batch.column("o_seq"), strict=True)):
            seq, o_seq = seq.as_buffer(), o_seq.as_buffer()
            doc, first, base, o_base = int(docs[i]), int(firsts[i]), int(bases[i]), int(o_bases[i])
            if seq.equals(o_seq) and seq.size >= T * SHORT:
                found = [(0, seq.size // SHORT, 0, seq.size // SHORT)]
            else:
                matches = every[at[i] : at[i + 1]] - np.array([base, base, base, o_base, o_base, o_base])
                found = passages_of(_short(seq), _short(o_seq), matches)
            for a, b, p, q in found:
                out.append((doc, first, base + a, base + b - 1 + WIDTH))
                out.append((first, doc, o_base + p, o_base + q - 1 + WIDTH))
        if out:
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["doc", "other", "start", "stop"])


def _cut(lo: str, hi: str) -> Column:
    """The shingles from ``lo`` to ``hi`` of a document's ``seq``."""
    return F.expr(f"substring(seq, ({lo} - base) * {SHORT} + 1, ({hi} - {lo} + 1) * {SHORT})")


def passage_pairs(docs: DataFrame) -> DataFrame:
    """``(doc, other, start, stop)``: words of ``doc`` that ``other`` repeats, both ways; of open windows
    the merged ranges of a key, with the least of the others."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    rows = materialise(contents(texts), "passage-contents")
    window = F.explode(F.arrays_zip(F.col("keys").alias("key"), F.col("lefts").alias("left"), F.col("centres").alias("centre"), F.col("rights").alias("right")))
    flat = rows.select("doc", window.alias("w")).select("doc", "w.*")
    first = materialise(_first_pairs(rows, flat), "passage-first")
    return first.unionByName(_open_pairs(rows, first))


def _first_pairs(rows: DataFrame, flat: DataFrame) -> DataFrame:
    """Passages of windows and the first window of their key."""
    # the first document of each key and its window there; combined before the shuffle
    pivots = flat.groupBy("key").agg(F.min(F.struct("doc", "left", "centre", "right")).alias("p"), F.max("doc").alias("last"))
    pivots = pivots.where("p.doc < last").select("key", F.col("p.doc").alias("first"), *[F.col(f"p.{c}").alias(f"o_{c}") for c in ("left", "centre", "right")])
    met = flat.join(pivots, "key").where("doc != first")
    pairs = met.groupBy("doc", "first").agg(F.collect_list(F.struct("left", "centre", "right", "o_left", "o_centre", "o_right")).alias("matches"))
    ends = pairs.select(
        "*", *[F.array_min(f"matches.{c}").alias(f"{c}_lo") for c in ("left", "o_left")], *[F.array_max(f"matches.{c}").alias(f"{c}_hi") for c in ("right", "o_right")]
    )
    # only the matched part of a text goes on to the first document's partition
    own = ends.join(rows.select("doc", "base", "seq"), "doc").select(
        "doc", "first", "matches", "o_left_lo", "o_right_hi", F.col("left_lo").alias("own_base"), _cut("left_lo", "right_hi").alias("own_seq")
    )
    both = own.join(rows.select(F.col("doc").alias("first"), "base", "seq"), "first").select(
        "doc", "first", "matches", F.col("own_base").alias("base"), F.col("own_seq").alias("seq"), F.col("o_left_lo").alias("o_base"), _cut("o_left_lo", "o_right_hi").alias("o_seq")
    )
    return both.transform(map_arrow, _verify, "doc long, other long, start long, stop long")


def _can_match(texts: list[np.ndarray], docs: np.ndarray, open_: np.ndarray) -> np.ndarray:
    """Windows with enough shingles that an open one and another document hold, until none falls out."""
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    value = np.unique(np.concatenate(texts), return_inverse=True)[1]
    order = np.argsort(value, kind="stable")
    row, value = row[order], value[order]
    left = len(texts) + 1
    while len(row):
        at = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1])))
        held = docs[row]
        use = np.minimum.reduceat(held, at) < np.maximum.reduceat(held, at)
        use &= np.logical_or.reduceat(open_[row], at)
        use = np.repeat(use, np.diff(np.concatenate((at, [len(row)]))))
        enough = np.bincount(row[use], minlength=len(texts)) >= LEAST_COMMON
        use &= enough[row]
        row, value = row[use], value[use]
        if int(enough.sum()) == left:
            return np.flatnonzero(enough)
        left = int(enough.sum())
    return np.empty(0, np.int64)


def _reached(common: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Which centres lie in a stretch of ``T`` shingles or more of which four in five are common."""
    if len(common) >= T and (1 + OTHERS_OF_BOTH) * np.count_nonzero(common) >= OTHERS_OF_BOTH * len(common):
        return np.ones(len(centres), bool)
    sums = np.concatenate(([0], np.cumsum(np.where(common, 1, -OTHERS_OF_BOTH))))
    ends = len(common) - np.searchsorted(np.maximum.accumulate(sums[::-1]), sums, "left")  # farthest end of each start
    ends[ends - np.arange(len(sums)) < T] = 0
    return np.maximum.accumulate(ends)[centres] > centres


def _meet(table: pa.Table) -> pa.Table | None:
    """Merged passages of a key's windows: each in turn with those after it, unless both are settled.

    A window has one centre or several, each open or settled.
    """
    m = table.num_rows
    docs, left = (table[c].to_numpy() for c in ("doc", "left"))
    centres, opens = ([np.atleast_1d(x) for x in table[c].to_pylist()] for c in ("centre", "open"))
    open_ = np.array([x.any() for x in opens], bool)
    if m < 2 or not open_.any():
        return None
    order = np.lexsort((left, docs))
    docs, left, open_ = docs[order], left[order], open_[order]
    centres, opens = [centres[i] - at for i, at in zip(order.tolist(), left.tolist(), strict=True)], [opens[i] for i in order.tolist()]
    seqs = table["seq"].combine_chunks()
    texts = [_short(seqs[i].as_buffer()) for i in order.tolist()]
    can = _can_match(texts, docs, open_)
    if not open_[can].any():
        return None
    docs, left, open_, m = docs[can], left[can], open_[can], len(can)
    texts, centres, opens = ([x[i] for i in can.tolist()] for x in (texts, centres, opens))
    # small numbers in the same order stand for the shingles
    values, at = np.unique(np.concatenate(texts), return_inverse=True)
    before: list[np.ndarray | None] = [None] * m
    starts = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    out = []
    held = np.zeros(len(values), bool)
    waiting = np.ones(m, bool)
    for i in np.flatnonzero(open_).tolist():
        if not open_[i]:
            continue
        waiting[i] = False
        others = waiting & (docs != docs[i])
        if not others.any():
            continue
        own = at[starts[i] : starts[i + 1]]
        held[own] = True
        hit = held[at]
        common = np.add.reduceat(hit, starts[:-1], dtype=np.int32)
        held[own] = False
        # a slice that runs into the next window only lets a pair through
        sums = np.concatenate(([0], np.cumsum(hit, dtype=np.int32)))
        dense = np.zeros(len(hit), bool)
        dense[: len(sums) - DENSE] = sums[DENSE:] - sums[:-DENSE] >= DENSE_COMMON
        others &= np.logical_or.reduceat(dense, starts[:-1])
        for j in np.flatnonzero(others & (common >= LEAST_COMMON)).tolist():
            if not (open_[i] or open_[j]):
                continue
            # a passage of this key holds the centres of both sides
            theirs = at[starts[j] : starts[j + 1]]
            v_common = hit[starts[j] : starts[j + 1]]
            v_in = _reached(v_common, centres[j])
            if not v_in.any():
                continue
            held[theirs] = True
            u_common = held[own]
            held[theirs] = False
            u_in = _reached(u_common, centres[i])
            u, v = np.nonzero((opens[i][:, None] | opens[j]) & u_in[:, None] & v_in)
            if not len(u):
                continue
            for k in (i, j):
                if before[k] is None:
                    before[k] = _before(at[starts[k] : starts[k + 1]])
            pair = Pair(own, theirs, (u_common, v_common), (before[i], before[j]))
            if not pair.few_others():
                continue
            matches = np.zeros((len(u), 6), np.int64)
            matches[:, 1], matches[:, 2], matches[:, 4], matches[:, 5] = centres[i][u], len(texts[i]) - 1, centres[j][v], len(texts[j]) - 1
            for a, b, p, q in _passages(pair, matches):
                out.append((docs[i], docs[j], left[i] + a, left[i] + b - 1 + WIDTH))
                out.append((docs[j], docs[i], left[j] + p, left[j] + q - 1 + WIDTH))
                opens[i] &= (centres[i] < a) | (centres[i] >= b)
                opens[j] &= (centres[j] < p) | (centres[j] >= q)
                open_[i], open_[j] = opens[i].any(), opens[j].any()
    if not out:
        return None
    return _merged(np.array(out, np.int64))


def _merged(found: np.ndarray) -> pa.Table:
    """The merged word ranges of each document in rows ``(doc, other, start, stop)``, with the least of its others.

    These are all that the result needs, and they grow with the windows, not with their pairs.
    """
    found = found[np.lexsort((found[:, 2], found[:, 0]))]
    first = np.flatnonzero(np.concatenate(([True], found[1:, 0] != found[:-1, 0])))
    rows: list[list[int]] = []
    for own, least in zip(np.split(found, first[1:]), np.minimum.reduceat(found[:, 1], first).tolist(), strict=True):
        doc, reach = int(own[0, 0]), np.maximum.accumulate(own[:, 3])
        new = np.flatnonzero(np.concatenate(([True], own[1:, 2] > reach[:-1])))
        rows += [[doc, least, a, b] for a, b in zip(own[new, 2].tolist(), reach[np.append(new[1:], len(own)) - 1].tolist(), strict=True)]
    return pa.table([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["doc", "other", "start", "stop"])


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A document's widest windows of each key, with a hash of their shingles, the centres of those
    inside them, and whether no passage covers these."""
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            keys, left, centre, right, starts, stops = (
                np.array(batch.column(c)[i].as_py() or [], np.int64) for c in ("keys", "lefts", "centres", "rights", "starts", "stops")
            )
            order = np.lexsort((-right, left, keys))
            keys, left, centre, right = keys[order], left[order], centre[order], right[order]
            # windows of a key lie inside one another or apart
            new, held = np.ones(len(keys), bool), 0
            for j in range(1, len(keys)):
                held = held if keys[j] == keys[j - 1] and left[j] <= right[held] else j
                new[j] = held == j
            inside = (starts <= centre[:, None]) & (centre[:, None] + WIDTH <= stops)
            open_ = ~inside.any(axis=1)
            at = np.flatnonzero(new)
            centres, opens = np.split(centre, at[1:]), np.split(open_, at[1:])
            keys, left, right = keys[at], left[at], right[at]
            base, x = batch.column("base")[i].as_py(), _short(batch.column("seq")[i].as_buffer()).astype(np.uint64)
            power, inverse = powers(len(x) + 1)
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((x + np.uint64(1)) * np.uint64(HASHES[0]) * power[: len(x)])))
            sig = (sums[right + 1 - base] - sums[left - base]) * inverse[left - base]
            places = np.add.reduceat((centre - np.repeat(left, [len(c) for c in centres]) + 1).astype(np.uint64) * np.uint64(HASHES[1]), at)
            doc = np.full(len(keys), batch.column("doc")[i].as_py())
            out.append((keys, doc, left, right, (sig ^ places).view(np.int64), centres, opens))
        if out:
            *flat, centres, opens = zip(*out, strict=True)
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
            columns = [pa.array(np.concatenate(c), t) for c, t in zip(flat, types, strict=True)]
            columns += [pa.array([x for c in lists for x in c], pa.list_(t)) for lists, t in ((centres, pa.int32()), (opens, pa.bool_()))]
            yield pa.record_batch(columns, names=["key", "doc", "left", "right", "sig", "centre", "open"])


def _open_pairs(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Passages of the windows whose centre ``found`` leaves uncovered, with any window of their key."""
    covered = islands(found).groupBy("doc").agg(F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops"))
    own = rows.select("doc", "base", "seq")
    marked = rows.join(covered, "doc", "left").transform(map_arrow, _mark, "key long, doc long, left int, right int, sig long, centre array<int>, open array<boolean>")
    marked = materialise(marked, "passage-windows")
    keys = marked.groupBy("key").agg(F.min("doc").alias("a"), F.max("doc").alias("b"), F.max(F.array_contains("open", True)).alias("any")).where("a < b and any")
    marked = marked.join(keys.select("key"), "key", "left_semi")
    # equal settled windows: two documents stand for all, so that one of them is another document
    is_open = F.array_contains("open", True)
    at = F.struct("doc", "left", "right", "centre", "open")
    equal = marked.where(~is_open).groupBy("key", "sig").agg(F.min(at).alias("lo"), F.max(at).alias("hi"))
    settled = equal.select("key", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("w")).select("key", "w.*")
    members = marked.where(is_open).select(*settled.columns).unionByName(settled).join(own, "doc")
    members = members.select("key", "doc", "left", "centre", "open", (F.col("right") - F.col("left") + 1).alias("n"), _cut("left", "right").alias("seq"))
    tiles = tiled(members, "key", "doc", "n", KEY_BLOCK).select("key", "tile_i", "tile_j", "doc", "left", "centre", "open", "seq")
    return grouped(tiles, ["key", "tile_i", "tile_j"], _meet, "doc long, other long, start long, stop long")


def islands(found: DataFrame) -> DataFrame:
    """``(doc, start, stop)``: the merged word ranges of each document."""
    spans = found.select("doc", "start", "stop").distinct()
    order = Window.partitionBy("doc").orderBy("start", "stop")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("new", F.when(before.isNull() | (F.col("start") > before), 1).otherwise(0))
    marked = marked.withColumn("island", F.sum("new").over(order))
    return marked.groupBy("doc", "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("island")


def repeated_passages(docs: DataFrame) -> DataFrame:
    """Documents with a passage that another one repeats: ``doc_id, first_doc, n_passages, n_words, spans``.

    ``first_doc`` is the smallest doc_id among the document and those it was matched with; ``spans`` lists the
    merged word ranges ``start:stop``.
    """
    found = materialise(passage_pairs(docs), "passage-pairs")
    least = found.groupBy("doc").agg(F.min("other").alias("least"))
    per = islands(found).groupBy("doc").agg(
        F.count("*").alias("n_passages"),
        F.sum(F.col("stop") - F.col("start")).alias("n_words"),
        F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("s"),
    )
    text = F.array_join(F.transform("s", lambda x: F.concat_ws(":", x["start"].cast("string"), x["stop"].cast("string"))), ",")
    return per.join(least, "doc").select(F.col("doc").alias("doc_id"), F.least("doc", "least").alias("first_doc"), "n_passages", "n_words", text.alias("spans"))
