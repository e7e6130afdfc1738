"""Periodic runs of words: stretches that repeat with a period, found on a grammar of the text.

A run is a stretch of consecutive words whose smallest period q goes at least twice into it, of 12
words or more, that no neighbouring word extends. Each document is compressed by pair replacement:
every pair of neighbouring symbols that occurs twice becomes a new symbol, the more frequent pair
first, until no pair occurs twice (``Grammar``). A run of the text crosses the boundary between the
two halves of some symbol, or between two symbols of the last sequence. So the runs that cross a
boundary are computed once for every symbol, inside the symbol's own words; they are carried to all
places where the symbol was derived; and stretches of equal period that overlap by a period or more
are merged into the maximal one (``find_runs``).

At a boundary only such periods are tried at which a stretch of words beside the boundary occurs
again: a run of period q has at least max(q, 6) consecutive words equal to those q later, so half
of them lie on one side of the boundary. Stretch lengths double with the period, which keeps the
tries few. A text in which no six consecutive words occur twice has no run and needs no grammar.

Each document is worked on by itself in the scan's own task; nothing is shuffled.

Defined results: a null or empty text has no words and no runs; rows that share a ``doc_id`` are
judged each for itself; a null ``doc_id`` stays null, and ``looped`` leaves its words as they are;
other columns are left out, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import WORD, map_arrow
from ledgerline.llm.token_files import slices

#: Shortest run in words.
LEAST = 12
#: Texts worked on together hold about so many bytes.
CHARS_A_BATCH = 1_000_000
#: Words compared at a time.
SLICE = 4_000_000
_WORDS = re.compile(WORD)
#: White space that ``str.split`` cuts at and the word rule does not.
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Odd constants that mix symbol pairs and word ids.
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)

RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


class Grammar:
    """Pair replacement of a sequence of small integers, in rounds.

    A round replaces all repeated pairs at once; where two would overlap the more frequent pair
    wins, then the one with the higher mixed key, so a round shortens what repeats by a constant
    share. ``left``, ``middle`` and ``right`` delimit the first place of each new symbol and the
    boundary in it; ``symbols`` and ``places`` list every place where a symbol was derived;
    ``top`` has the boundaries of the last sequence.
    """

    def __init__(self, x: np.ndarray) -> None:
        n = len(x)
        symbols, starts = x.astype(np.int64), np.arange(n, dtype=np.int64)
        first = following = int(x.max()) + 1 if n else 0
        left, middle, right, made, places = [], [], [], [], []
        # pairs that may occur twice: a pair that did not, and has no new symbol, never will
        live = np.ones(max(n - 1, 0), bool)
        while live.any():
            tried = np.flatnonzero(live)
            kinds, kind, counts = np.unique(symbols[tried] * following + symbols[tried + 1], return_inverse=True, return_counts=True)
            if counts.max() < 2:
                break
            order = np.lexsort((kinds.astype(np.uint64) * _MIX, counts))
            rank = np.empty(len(kinds), np.int64)
            rank[order] = np.arange(len(kinds))
            rank[counts < 2] = -1
            ranks = np.full(len(live), -1)
            ranks[tried] = rank[kind]
            at = _chosen(ranks)
            chosen = ranks[at]
            where = np.full(len(kinds), -1)
            where[chosen[::-1]] = np.arange(len(at))[::-1]  # first place of each chosen pair
            used = where >= 0
            new = (np.cumsum(used) - 1)[chosen]
            where = where[used]
            ends = np.append(starts[2:], n)[at]
            left.append(starts[at][where])
            middle.append(starts[at + 1][where])
            right.append(ends[where])
            made.append(following - first + new)
            places.append(starts[at])
            symbols[at] = following + new
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            twice = np.append(ranks >= 0, False)[keep]
            symbols, starts = symbols[keep], starts[keep]
            fresh = symbols >= following
            live = twice[:-1] | fresh[:-1] | fresh[1:]
            following += len(where)
        empty = [np.empty(0, np.int64)]
        self.left, self.middle, self.right = (np.concatenate(p or empty) for p in (left, middle, right))
        self.symbols, self.places = np.concatenate(made or empty), np.concatenate(places or empty)
        self.top = starts[1:]


def _chosen(rank: np.ndarray) -> np.ndarray:
    """Pairs to replace: no lower than both neighbours, every other one among equals in a row."""
    n = len(rank)
    new = np.ones(n, bool)
    new[1:] = rank[1:] != rank[:-1]
    at = np.arange(n)
    offset = at - np.maximum.accumulate(np.where(new, at, 0))
    before = np.concatenate(([-2], rank[:-1]))
    after = np.concatenate((rank[1:], [-2]))
    return np.flatnonzero((rank >= 0) & (offset % 2 == 0) & (rank >= before) & (rank >= after))


def _names(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One small integer per pair of small integers; equal pairs get equal ones."""
    return np.unique(a * (int(b.max()) + 1) + b, return_inverse=True)[1].astype(np.int64)


def _expand(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ``(i, j)`` with ``low[i] <= j < high[i]``."""
    sizes = np.maximum(high - low, 0)
    owner = np.repeat(np.arange(len(low)), sizes)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[owner]


def _stretches(x: np.ndarray, spans: Spans, doc: np.ndarray, start: np.ndarray, period: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """``(candidates, start, end)``: the longest stretch of each candidate's period around its start.

    Every document is compared once with itself moved by each of its periods; a slice of them at
    a time, so memory stays bounded.
    """
    order = np.lexsort((period, doc))
    cut = np.ones(len(order), bool)
    cut[1:] = (np.diff(doc[order]) != 0) | (np.diff(period[order]) != 0)
    heads = np.flatnonzero(cut)
    sizes = spans.ends[doc[order][heads]] - spans.starts[doc[order][heads]]
    slices = (np.cumsum(sizes) - sizes) // SLICE
    bounds = [*np.flatnonzero(np.diff(slices, prepend=-1)).tolist(), len(heads)]
    stride = len(x) + 2
    for lo, hi in itertools.pairwise(bounds):
        part = order[heads[lo] : heads[hi] if hi < len(heads) else len(order)]
        d, q = doc[order][heads[lo:hi]], period[order][heads[lo:hi]]
        pair, at = _expand(spans.starts[d], spans.ends[d] - q)
        other = np.flatnonzero(x[at] != x[at + q[pair]])
        number = np.arange(len(d))
        # places are moved up by one, so that the place before the first word is not negative
        keys = np.concatenate((pair[other] * stride + at[other] + 1, number * stride + spans.starts[d], number * stride + spans.ends[d] - q + 1))
        keys.sort()
        mine = np.repeat(number, np.diff(np.append(heads[lo:hi], heads[lo] + len(part))))
        k = np.searchsorted(keys, mine * stride + start[part] + 1, "right")
        yield part, keys[k - 1] - mine * stride, keys[k] - mine * stride - 1 + period[part]


def _crossing(x: np.ndarray, spans: Spans, left: np.ndarray, middle: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Repeating stretches at the boundaries.

    First as rows ``(start, end, period)``, as long as they can be in their document; then, of
    boundaries whose symbol is a part of it, as rows ``(boundary, start, end, period)`` cut to the
    symbol's ``left`` to ``right``.
    """
    n = len(x)
    boundaries = np.arange(len(left))
    doc = spans.of(middle)
    part_only = (left > spans.starts[doc]) | (right < spans.ends[doc])
    longest = int((spans.ends - spans.starts).max())
    known, found = [np.empty((3, 0), np.int64)], [np.empty((4, 0), np.int64)]
    k, low, high = 3, 1, 11
    names = _names(_names(x[:-1], x[1:])[:-1], x[2:])
    while longest >= 2 * low:
        again = (np.bincount(names) > 1)[names]
        places = np.flatnonzero(again)
        if not len(places):
            break
        keys = np.sort(names[places] * (n + 1) + places)
        again = np.append(again, np.zeros(n + 1 - len(again), bool))
        gram = np.concatenate((middle, middle - k))
        b = np.concatenate((boundaries, boundaries))
        ok = np.flatnonzero((gram >= left[b]) & (gram + k <= right[b]) & again[gram])
        g, b = np.tile(gram[ok], 2), np.tile(b[ok], 2)
        after = np.arange(len(g)) < len(ok)
        base = names[g] * (n + 1)
        least = np.maximum(g + np.where(after, low, -high), left[b])
        most = np.minimum(g + np.where(after, high, -low), right[b] - k)
        i, at = _expand(np.searchsorted(keys, base + least), np.where(most >= least, np.searchsorted(keys, base + most, "right"), 0))
        other = keys[at] % (n + 1)
        owner, start, period = b[i], np.minimum(g[i], other), np.abs(g[i] - other)
        # two equal stretches inside a run of a short period repeat with that period
        reach = np.zeros(n + 1, np.int64)
        for rows in known:
            short = rows[2] <= k
            np.maximum.at(reach, rows[0][short], rows[1][short])
        new = np.maximum.accumulate(reach)[start] < start + period + k
        owner, start, period = owner[new], start[new], period[new]
        for part, s, e in _stretches(x, spans, doc[owner], start, period) if len(owner) else ():
            q, b = period[part], owner[part]
            good = e - s >= np.maximum(LEAST, 2 * q)
            s, e, q, b = s[good], e[good], q[good], b[good]
            known.append(np.stack((s, e, q))[:, np.unique(s * (n + 1) + q, return_index=True)[1]])
            inner = part_only[b]
            s, e, q, b = np.maximum(s, left[b])[inner], np.minimum(e, right[b])[inner], q[inner], b[inner]
            good = e - s >= np.maximum(LEAST, 2 * q)
            found.append(np.stack((b, s, e, q))[:, good])
        if len(names) <= k:
            break
        names = _names(names[:-k], names[k:])
        k *= 2
        low, high = 2 * k, 4 * k - 1
    return np.concatenate(known, axis=1), np.concatenate(found, axis=1)


def _maximal(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Merged stretches as rows ``(start, end, period)``, each with its smallest period."""
    order = np.lexsort((end, start, period))
    period, start, end = period[order], start[order], end[order]
    span = int(end.max()) + 1
    rank = np.unique(period, return_inverse=True)[1]
    far = np.maximum.accumulate(end + rank * span) - rank * span  # farthest end so far of this period
    cut = np.ones(len(start), bool)
    cut[1:] = (period[1:] != period[:-1]) | (start[1:] + period[1:] > far[:-1])
    at = np.flatnonzero(cut)
    period, start, end = period[at], start[at], np.maximum.reduceat(end, at)
    # a stretch inside one of a shorter period has that period too
    kept: list[np.ndarray] = []
    reach = np.zeros(span, np.int64)
    for part in np.split(np.arange(len(at)), np.flatnonzero(np.diff(period)) + 1):
        own = part[np.maximum.accumulate(reach)[start[part]] < end[part]]
        kept.append(own)
        np.maximum.at(reach, start[own], end[own])
    own = np.concatenate(kept)
    return np.stack((start[own], end[own], period[own]), axis=1)


class Spans:
    """Places of documents in a joint sequence; a symbol of its own follows each of them."""

    def __init__(self, sizes: list[int]) -> None:
        whole = np.array(sizes, np.int64)
        self.ends = np.cumsum(whole + 1) - 1
        self.starts = self.ends - whole

    def of(self, place: np.ndarray) -> np.ndarray:
        """Document of each place; the place after its last word counts as its own."""
        return np.searchsorted(self.starts, place, "right") - 1


Runs = list[tuple[int, int, int]]


def find_runs(docs: list[np.ndarray]) -> list[Runs]:
    """All runs of sequences of word ids as ``(start, length, period)``, by start, then period.

    The ids of a sequence are below its length. The sequences share the array operations, not
    their ids: they are laid end to end.
    """
    out: list[Runs] = [[] for _ in docs]
    chosen = [d for d, x in enumerate(docs) if len(x) >= LEAST and _repeats(x)]
    if not chosen:
        return out
    spans = Spans([len(docs[d]) for d in chosen])
    # ids below the document's end, the separator at it: all different between documents
    x = np.concatenate([np.append(docs[d], len(docs[d])) + start for d, start in zip(chosen, spans.starts.tolist(), strict=True)])
    grammar = Grammar(x)
    long = np.flatnonzero(grammar.right - grammar.left >= LEAST)
    doc = spans.of(grammar.top)
    left = np.concatenate((grammar.left[long], spans.starts[doc]))
    middle = np.concatenate((grammar.middle[long], grammar.top))
    right = np.concatenate((grammar.right[long], spans.ends[doc]))
    known, (boundary, start, end, period) = _crossing(x, spans, left, middle, right)
    symbol = long[boundary]
    # every place of the symbol has the same words, so the same stretches
    order = np.argsort(grammar.symbols, kind="stable")
    symbols, places = grammar.symbols[order], grammar.places[order]
    i, at = _expand(np.searchsorted(symbols, symbol), np.searchsorted(symbols, symbol, "right"))
    shift = places[at] - grammar.left[symbol[i]]
    rows = np.concatenate((known, np.stack((start[i] + shift, end[i] + shift, period[i]))), axis=1)
    if rows.shape[1]:
        rows = _maximal(*rows)
        for d, s, e, q in zip(spans.of(rows[:, 0]).tolist(), *rows.T.tolist(), strict=True):
            out[chosen[d]].append((s - int(spans.starts[d]), e - s, q))
    return [sorted(runs) for runs in out]


def _repeats(x: np.ndarray) -> bool:
    """Whether six consecutive words may occur twice; false is certain."""
    mixed = np.zeros(len(x) - 5, np.uint64)
    for i in range(6):
        mixed = mixed * _STEP + x[i : len(x) - 5 + i].astype(np.uint64)
    mixed.sort()
    return bool((mixed[1:] == mixed[:-1]).any())


def kept_words(words: list[str], runs: Runs) -> list[str]:
    """Words that no run contains after its first period."""
    if not runs:
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0).tolist()]


def as_given(doc_id: int | None, words: list[str]) -> list[str]:
    return words


def looped(doc_id: int | None, words: list[str]) -> list[str]:
    """Words as the query's contract sets them: the tail of one document in ten loops."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * -(-(n - a) // p))[: n - a]


def words_of(text: str | None) -> list[str]:
    if not text:
        return []
    return _WORDS.findall(text) if _OTHER_SPACE.search(text) else text.split()


def word_ids(words: list[str]) -> np.ndarray:
    """Place of each word's first occurrence."""
    return np.fromiter(map({}.setdefault, words, range(len(words))), np.int64, len(words))


def periodic_runs(docs: DataFrame, alter: Callable[[int | None, list[str]], list[str]] = as_given) -> DataFrame:
    """Runs of every ``docs(doc_id, text)`` and its text without the repeats.

    ``collapsed`` keeps the first period of every run; ``alter`` may change a document's words.
    """
    entry = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    types = {"doc_id": pa.int64(), "n_words": pa.int64(), "runs": pa.list_(entry), "collapsed": pa.string()}

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in slices(batch.column("text"), CHARS_A_BATCH):
                ids = batch.column("doc_id").slice(lo, hi - lo).to_pylist()
                texts = [alter(d, words_of(t)) for d, t in zip(ids, batch.column("text").slice(lo, hi - lo).to_pylist(), strict=True)]
                runs = find_runs([word_ids(w) for w in texts])
                listed = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs]
                kept = [" ".join(kept_words(w, r)) for w, r in zip(texts, runs, strict=True)]
                columns = [ids, [len(w) for w in texts], listed, kept]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types.values(), strict=True)], names=list(types))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").transform(map_arrow, over, RUNS)


def run_digests(docs: DataFrame, alter: Callable[[int | None, list[str]], list[str]] = as_given) -> DataFrame:
    """Number of runs, the longest one, and digests of all runs and of the collapsed text."""
    rows = periodic_runs(docs, alter)
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    best = rows.withColumns({"best": longest, "runs_sha256": F.sha2(listed, 256)})
    length = -F.col("best.less")
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        length.alias("length"),
        F.col("best.period").alias("period"),
        F.floor(1000 * length / F.col("best.period")).cast("long").alias("exponent_milli"),
        "runs_sha256",
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
