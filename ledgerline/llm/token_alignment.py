"""Alignment of the tokens of two tokenizers, and how often their ids meet in the whole corpus.

Tokenizer A is a byte-level file of the ``tokenizers`` library, B a ``sentencepiece`` model with
byte fallback that puts a space before a text. Both are read as byte intervals of space + text.
``coalesce`` sorts the intervals of A and B together by start and accumulates their largest end: a
group ends where a start reaches that maximum, which is where a token of A and one of B both end.
Inside the groups every overlap of an A and a B interval is a link.

1. ``linked`` tokenizes every text once, gives each document its groups, and stores its linked id
   pairs with how often each occurs there. Distinct words are aligned once and kept.
2. ``count_pairs`` adds the stored pairs up over all documents.
3. ``align`` sums the counts of each document's stored pairs. Frequent pairs (at most ``HEAD_PAIRS``
   of them, chosen by a histogram of the counts, so the bound is known before anything is sent)
   travel to the tasks; they are what every document holds. The other pairs are joined by Spark;
   none of them is frequent, so no key of that join is hot.

Texts are cut at single spaces where both tokenizers cut as well: a space before a visible Latin
character, no character whose bytes B might change, no piece of B with a space inside it. All other
texts are aligned whole by the same functions.

Defined results: a null or empty text, and one whose joined bytes of A or B differ from space +
text, has no tokens, counts nowhere and gets zeros and an empty digest; rows that share a
``doc_id`` are documents of their own; a null ``doc_id`` stays null; other columns are left out,
whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import map_arrow, materialise
from ledgerline.llm.token_files import slices

#: Most frequent pairs that every task gets: 17 bytes each.
HEAD_PAIRS = 1 << 20
#: Words a worker keeps at a time; some 300 bytes each.
CACHE_WORDS = 300_000
#: Pairs that a task adds up at a time.
HELD_PAIRS = 1_200_000
#: Words aligned in one go.
JOINT_WORDS = 4000

_SPACE_PIECE = "▁"
_BYTE_PIECE = re.compile("<0x([0-9A-F]{2})>")
#: A text is cut at its spaces if it has only these characters and each space, and the text's
#: start, comes before a visible one.
_LATIN = re.compile("[\t\n\x0b\x0c\r -~\xa1-ɏ]*")
_UNSAFE_SPACE = re.compile(" (?![!-~\xa1-ɏ])")


def coalesce(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Group number of each interval: a group breaks where a start reaches all earlier ends."""
    order = np.lexsort((ends, starts))
    s, far = starts[order], np.maximum.accumulate(ends[order])
    number = np.zeros(len(order), np.int64)
    number[1:] = np.cumsum(s[1:] >= far[:-1])
    out = np.empty_like(number)
    out[order] = number
    return out


def overlaps(a_starts: np.ndarray, a_ends: np.ndarray, b_starts: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All overlapping ``(a, b)`` of two gapless runs of intervals, by b, then a."""
    low = np.searchsorted(a_ends, b_starts, "right")
    sizes = np.searchsorted(a_starts, b_ends, "left") - low
    b = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(b)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[b], b


class Aligned:
    """Tokens of consecutive texts or words (``parts``), with their groups and links."""

    def __init__(self, aligner: Aligner, a: np.ndarray, b: np.ndarray, a_heads: np.ndarray, b_heads: np.ndarray) -> None:
        self.parts = len(a_heads)
        a_ends, b_ends = np.cumsum(aligner.a_sizes[a]), np.cumsum(aligner.b_sizes[b])
        a_starts, b_starts = a_ends - aligner.a_sizes[a], b_ends - aligner.b_sizes[b]
        group = coalesce(np.concatenate((a_starts, b_starts)), np.concatenate((a_ends, b_ends)))
        left, right = overlaps(a_starts, a_ends, b_starts, b_ends)
        self.pairs = a[left].astype(np.int64) * len(aligner.b_sizes) + b[right]
        self.n_a = np.diff(a_heads, append=len(a))
        self.n_b = np.diff(b_heads, append=len(b))
        self.links = np.searchsorted(right, np.append(b_heads, len(b)))  # where each part's links start
        self._tokens = aligner, a, b, group, a_heads

    def groups(self) -> tuple[np.ndarray, list[str]]:
        """Number of groups of each part, and the groups written out."""
        aligner, a, b, group, a_heads = self._tokens
        of_b = np.arange(len(group)) >= len(a)
        order = np.lexsort((of_b, group))  # stable: by group, A before B, by start
        number, second = group[order], of_b[order]
        first = np.append(True, number[1:] != number[:-1])
        turn = np.append(False, second[1:] & ~second[:-1])
        head = np.zeros(len(a), bool)
        head[a_heads] = True
        begins = np.flatnonzero(np.concatenate((head, np.zeros(len(b), bool)))[order])
        mark = np.where(first, 2, np.where(turn, 1, 0))
        mark[begins] = 3
        names = np.concatenate((a, b + len(aligner.a_sizes)))[order].tolist()
        written = [_MARKS[m] + aligner.names[i] for m, i in zip(mark.tolist(), names, strict=True)]
        cuts = [*begins.tolist(), len(written)]
        counts = np.add.reduceat(first.astype(np.int64), begins)
        return counts, ["".join(written[i:j]) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]


_MARKS = (",", "|", ";", "")


class Aligner:
    """Both tokenizers; one per worker and pair of files."""

    _made: dict[tuple[str, str], Aligner] = {}

    def __init__(self, a_file: str, b_file: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        visible = {chr(c): c for c in [*range(33, 127), *range(161, 173), *range(174, 256)]}
        hidden = [c for c in range(256) if chr(c) not in visible]
        visible.update((chr(256 + i), c) for i, c in enumerate(hidden))
        entries = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            if all(c in visible for c in entry):
                self.a_bytes[i] = bytes(visible[c] for c in entry)
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            byte = _BYTE_PIECE.fullmatch(piece) if self.b.is_byte(i) else None
            self.b_bytes.append(bytes([int(byte[1], 16)]) if byte else piece.replace(_SPACE_PIECE, " ").encode())
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        self.names = [str(i) for i in [*range(len(self.a_bytes)), *range(len(self.b_bytes))]]
        self.a_spaced = np.array([x[:1] == b" " for x in self.a_bytes])
        self.b_spaced = np.array([x[:1] == b" " for x in self.b_bytes])
        inner = any(" " in x.decode("utf-8", "replace").lstrip(" ") for x in self.b_bytes)
        plain = all(self._same(f"x{chr(c)}x") for c in [9, 10, 11, 12, 13, *range(32, 127), *range(161, 0x250)])
        self.cuts = plain and not inner

    @classmethod
    def of(cls, a_file: str, b_file: str) -> Aligner:
        if (a_file, b_file) not in cls._made:
            cls._made[a_file, b_file] = cls(a_file, b_file)
        return cls._made[a_file, b_file]

    def _ids(self, text: str) -> tuple[list[int], list[int]]:
        return self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, self.b.encode(text, num_threads=1)

    def _equal(self, text: str, a: list[int], b: list[int]) -> bool:
        want = (" " + text).encode()
        return b"".join(map(self.a_bytes.__getitem__, a)) == want and b"".join(map(self.b_bytes.__getitem__, b)) == want

    def _same(self, text: str) -> bool:
        return self._equal(text, *self._ids(text))

    def words(self, text: str) -> list[str] | None:
        """The text at its spaces; None: to be aligned whole."""
        if not self.cuts or not _LATIN.fullmatch(text) or _UNSAFE_SPACE.search(text) or not _LATIN_START.match(text):
            return None
        return text.split(" ")

    def whole(self, text: str) -> Aligned | None:
        """One text by itself; None: it has no tokens."""
        a, b = self._ids(text)
        if not text or not self._equal(text, a, b):
            return None
        zero = np.zeros(1, np.int64)
        return Aligned(self, np.array(a, np.int64), np.array(b, np.int64), zero, zero)

    def joint(self, words: list[str]) -> Aligned:
        """Words laid one after another; each is a part."""
        text = " ".join(words)
        a, b = self._ids(text)
        if not self._equal(text, a, b):
            raise ValueError("a tokenizer changed the bytes of a plain Latin text")
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        heads = np.flatnonzero(self.a_spaced[a]), np.flatnonzero(self.b_spaced[b])
        if not len(heads[0]) == len(heads[1]) == len(words):
            raise ValueError("a tokenizer joined two words")
        return Aligned(self, a, b, *heads)


_LATIN_START = re.compile("[!-~\xa1-ɏ]")


LINKED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs binary, times binary"
)


def linked(docs: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """Tokens and groups of every ``docs(doc_id, text)``, and its linked id pairs with their number.

    ``pairs`` are packed as little-endian long and ``times`` as int, so Spark moves bytes only.
    """

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.int64)
        documents = Documents(Aligner.of(a_file, b_file), none, none, none.astype(bool))
        at = TaskContext.get().partitionId() << 40
        for batch in batches:
            for lo, hi in slices(batch.column("text")):
                *sums, _, _, digests, pairs, times = documents.rows(batch.column("text").slice(lo, hi - lo).to_pylist())
                ids = batch.column("doc_id").slice(lo, hi - lo)
                yield pa.record_batch([pa.array(range(at, at + hi - lo), pa.int64()), ids, *sums, digests, pairs, times], names=_LINKED_NAMES)
                at += hi - lo

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").transform(map_arrow, over, LINKED)


_LINKED_NAMES = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]


def _added(pairs: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of counts by pair."""
    kinds, kind = np.unique(np.concatenate(pairs), return_inverse=True)
    total = np.zeros(len(kinds), np.int64)
    np.add.at(total, kind, np.concatenate(counts))
    return kinds, total


def _unpacked(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs and times of a batch of ``linked`` rows, and where each row's begin and end."""
    pairs, times = (b"".join(batch.column(c).to_pylist()) for c in ("pairs", "times"))
    at = np.append(0, np.cumsum(pc.binary_length(batch.column("times")).to_numpy())) // 4
    return np.frombuffer(pairs, "<i8"), np.frombuffer(times, "<i4").astype(np.int64), at


def count_pairs(rows: DataFrame, b_file: str) -> DataFrame:
    """``(pair, b, n, best)`` of every pair of ``linked`` rows; ``best``: no pair of its B id has more."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        for batch in batches:
            found, times, _ = _unpacked(batch)
            pairs.append(found)
            counts.append(times)
            if sum(map(len, pairs)) >= HELD_PAIRS:
                kinds, total = _added(pairs, counts)
                pairs, counts = [kinds], [total]
                if 2 * len(kinds) >= HELD_PAIRS:
                    yield pa.record_batch([pa.array(kinds), pa.array(total)], names=["pair", "n"])
                    pairs, counts = [], []
        if pairs:
            yield pa.record_batch([pa.array(c) for c in _added(pairs, counts)], names=["pair", "n"])

    partial = map_arrow(rows.select("pairs", "times"), over, "pair long, n long")
    pieces = _pieces(b_file)
    sums = materialise(partial.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("b", F.pmod("pair", F.lit(pieces))), "token-pairs")
    # one row per B id, so at most as many as the vocabulary has
    most = F.broadcast(sums.groupBy("b").agg(F.max("n").alias("most")))
    return sums.join(most, "b").select("pair", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def _pieces(b_file: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=b_file).get_piece_size()


def frequent(counts: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """``counts`` in two: at most ``most`` of the most frequent pairs, and the rest."""
    level = F.floor(8 * F.log2("n")).cast("int")
    left, limit = most, 1 << 30
    for row in counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():  # some 500 levels
        left -= row["count"]
        if left < 0:
            break
        limit = row["level"]
    return counts.where(level >= limit), counts.where(level < limit)


SUMMED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long, "
    "rare array<struct<pair: long, times: long>>"
)


def align(documents: DataFrame, counts: DataFrame, head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """``linked`` rows with the sums of ``counts`` over their links."""
    head, rest = frequent(counts, head_pairs)
    table = head.orderBy("pair").select("pair", "n", "best").toArrow()
    sent = documents.sparkSession.sparkContext.broadcast(tuple(table.column(c).to_numpy() for c in ("pair", "n", "best")))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair, times, at = _unpacked(batch)
            hit, best, n = _counted(pair, *sent.value)
            sums = [pa.array(_runs(v * times, at)) for v in (best, n)]
            rare = _lists(np.append(0, np.cumsum(~hit))[at], pair[~hit], times[~hit])
            yield pa.record_batch([*batch.columns[:-2], *sums, rare], names=[*_LINKED_NAMES[:-2], "n_best", "count_sum", "rare"])

    rows = materialise(documents.select(*_LINKED_NAMES).transform(map_arrow, over, SUMMED), "token-sums")
    links = rows.select("row", F.explode("rare").alias("link")).select("row", "link.pair", "link.times")
    sums = (
        links.join(rest.select("pair", "n", "best"), "pair")
        .groupBy("row")
        .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    )
    more = rows.drop("rare").join(sums, "row", "left")
    return more.select(
        *("doc_id", "n_a", "n_b", "n_groups", "n_links"),
        (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )


def _runs(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between the places of ``at``."""
    return np.diff(np.append(0, np.cumsum(values))[at])


def _counted(found: np.ndarray, pairs: np.ndarray, n: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether each pair found is in the sorted ``pairs``, whether it is a best one, and its count."""
    if not len(pairs):
        hit = np.zeros(len(found), bool)
        return hit, hit, np.zeros(len(found), np.int64)
    at = np.minimum(np.searchsorted(pairs, found), len(pairs) - 1)
    hit = pairs[at] == found
    return hit, hit & best[at], np.where(hit, n[at], 0)


def _lists(at: np.ndarray, pair: np.ndarray, times: np.ndarray) -> pa.ListArray:
    """Lists of ``(pair, times)`` between the places of ``at``."""
    links = pa.StructArray.from_arrays([pa.array(pair, pa.int64()), pa.array(times, pa.int64())], ["pair", "times"])
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), links)


class Documents:
    """Rows of documents, with the sums of the given pairs' counts, and all other pairs packed.

    Keeps what words add to them.
    """

    def __init__(self, aligner: Aligner, pairs: np.ndarray, n: np.ndarray, best: np.ndarray) -> None:
        self.aligner, self.pairs, self.n, self.best = aligner, pairs, n, best
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.sums = np.empty((0, 6), np.int64)
        self.texts: list[str] = []
        self.others = np.empty(0, np.int64)  # pairs without a given count, word after word
        self.ends = np.zeros(1, np.int64)  # where each word's pairs end, from 0

    def _sums(self, got: Aligned) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Per part: n_a, n_b, groups, links, best links, counts; groups written out; other pairs and their ends."""
        groups, texts = got.groups()
        hit, best, n = _counted(got.pairs, self.pairs, self.n, self.best)
        sums = np.stack((got.n_a, got.n_b, groups, np.diff(got.links), _runs(best, got.links), _runs(n, got.links)), axis=1)
        return sums, texts, got.pairs[~hit], np.cumsum(_runs(~hit, got.links))

    def _learn(self, words: list[str]) -> None:
        sums, others, ends = [self.sums], [self.others], [self.ends]
        for lo in range(0, len(words), JOINT_WORDS):
            some = words[lo : lo + JOINT_WORDS]
            new, texts, pairs, to = self._sums(self.aligner.joint(some))
            base = len(self.texts)
            self.index.update(zip(some, range(base, base + len(some)), strict=True))
            self.texts += texts
            sums.append(new)
            others.append(pairs)
            ends.append(to + ends[-1][-1])
        self.sums, self.others, self.ends = np.concatenate(sums), np.concatenate(others), np.concatenate(ends)

    def rows(self, texts: list[str | None]) -> list[pa.Array]:
        parts = [self.aligner.words(t) if t else None for t in texts]
        if len(self.index) > CACHE_WORDS:
            self._forget()
        missing = [w for w in dict.fromkeys(chain.from_iterable(p for p in parts if p)) if w not in self.index]
        if missing:
            self._learn(missing)
        sums = np.zeros((len(texts), 6), np.int64)
        digests, links = [""] * len(texts), [np.empty(0, np.int64)] * len(texts)
        for k, (text, words) in enumerate(zip(texts, parts, strict=True)):
            if words:
                at = list(map(self.index.__getitem__, words))
                written = ";".join([self.texts[i] for i in at])
                at = np.array(at)
                sums[k] = self.sums[at].sum(axis=0)
                sizes = self.ends[at + 1] - self.ends[at]
                links[k] = self.others[np.arange(sizes.sum()) + np.repeat(self.ends[at + 1] - np.cumsum(sizes), sizes)]
            elif text and (got := self.aligner.whole(text)) is not None:
                one, (written,), links[k], _ = self._sums(got)
                sums[k] = one[0]
            else:
                continue
            digests[k] = hashlib.sha256(written.encode()).hexdigest()
        kinds = [np.unique(x, return_counts=True) for x in links]
        packed = [pa.array([x[i].astype(kind).tobytes() for x in kinds], pa.binary()) for i, kind in enumerate(("<i8", "<i4"))]
        return [*(pa.array(c) for c in sums.T.copy()), pa.array(digests), *packed]


def align_documents(docs: DataFrame, a_file: str, b_file: str, head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """Link the tokens of all documents, count the pairs, then sum each document's counts."""
    rows = materialise(linked(docs, a_file, b_file), "token-links")
    return align(rows, materialise(count_pairs(rows, b_file), "token-counts"), head_pairs)
