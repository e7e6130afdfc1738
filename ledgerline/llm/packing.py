"""Vector best-fit packing of documents into token sequences.

Every sequence has three capacities: tokens, documents and attention cost (the sum of squared
piece lengths). A piece goes, longest first, into the open sequence that has room in all three
and scores best: either the smallest weighted norm of what would remain, or the largest
weighted dot product of the piece with the sequence's free room. No fitting sequence: a new one.

Only documents longer than a sequence are cut: the first piece takes the remainder, all later
ones are full. Documents are dealt to tasks by hash, each with enough pieces that the open
sequences at its end hardly count, so nothing passes through one task.

Defined results: a null or empty text is its end id alone; rows that share a ``doc_id`` are
packed each for itself; a null ``doc_id`` stays; other columns are left out; no rows give none.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import map_arrow, tasks_for
from ledgerline.llm.tokens import Encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"
#: Documents whose last pieces one task packs together.
DOCS_A_TASK = 40_000


@dataclass(frozen=True)
class Room:
    """Capacities of a sequence and the weight of each in the score.

    The defaults for documents and cost are what ``tokens`` alone already implies, so only
    the tokens bind; smaller values bind by themselves.
    """

    tokens: int = 2048
    documents: int | None = None
    cost: int | None = None
    weights: tuple[float, float, float] = (1.0, 1e-9, 1e-9)
    score: str = "norm"

    def limits(self) -> tuple[int, int, int]:
        return self.tokens, self.documents or self.tokens, self.cost or self.tokens**2


class Bins:
    """Open sequences by free tokens, then by free documents and cost.

    Sequences in the same state are interchangeable and share one entry, so a large group
    of equal documents costs one look-up per document.
    """

    def __init__(self, room: Room) -> None:
        self.limits = room.limits()
        self.weights, self.score = room.weights, room.score
        self.free: list[int] = []
        self.states: dict[int, dict[tuple[int, int], list[int]]] = {}
        self.count = 0

    def place(self, length: int) -> tuple[int, int]:
        """Sequence and offset of a piece."""
        tokens, documents, cost = self.limits
        best = self._by_norm(length) if self.score == "norm" else self._by_dot(length)
        if best is None:
            sequence, r, d, c = self.count, tokens, documents, cost
            self.count += 1
        else:
            r, d, c = best
            entry = self.states[r]
            sequence = entry[d, c].pop()
            if not entry[d, c]:
                del entry[d, c]
                if not entry:
                    del self.states[r]
                    del self.free[bisect_left(self.free, r)]
        left = r - length, d - 1, c - length * length
        if left[0] > 0 and left[1] > 0 and left[2] > 0:
            if left[0] not in self.states:
                self.states[left[0]] = {}
                insort(self.free, left[0])
            self.states[left[0]].setdefault(left[1:], []).append(sequence)
        return sequence, tokens - r

    def _fitting(self, r: int, length: int) -> Iterator[tuple[int, int]]:
        need = length * length
        return (s for s in self.states[r] if s[1] >= need)

    def _by_norm(self, length: int) -> tuple[int, int, int] | None:
        (tokens, documents, cost), (wt, wd, wc) = self.limits, self.weights
        best, found = float("inf"), None
        for r in self.free[bisect_left(self.free, length) :]:
            least = wt * ((r - length) / tokens) ** 2
            if least >= best:
                break
            for d, c in self._fitting(r, length):
                s = least + wd * ((d - 1) / documents) ** 2 + wc * ((c - length * length) / cost) ** 2
                if s < best or (s == best and (r, d, c) < found):
                    best, found = s, (r, d, c)
        return found

    def _by_dot(self, length: int) -> tuple[int, int, int] | None:
        (tokens, documents, cost), (wt, wd, wc) = self.limits, self.weights
        vt, vd, vc = wt * length / tokens**2, wd / documents**2, wc * length * length / cost**2
        best, found = -1.0, None
        for r in reversed(self.free[bisect_left(self.free, length) :]):
            if vt * r + vd * documents + vc * cost < best:
                break
            for d, c in self._fitting(r, length):
                s = vt * r + vd * d + vc * c
                if s > best or (s == best and (r, d, c) < found):
                    best, found = s, (r, d, c)
        return found


def cut_lengths(length: int, most: int) -> list[int]:
    """Piece lengths of a document: the remainder first, then full pieces."""
    full, rest = divmod(length, most)
    return [rest] * (rest > 0) + [most] * full


def pieces(docs: DataFrame, tokenizer: str, end_id: int, most: int) -> DataFrame:
    """Encode each whole text, append the end id and cut what is longer than a sequence."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = encoder.encode(text.as_py()) + end
                at = 0
                for k, size in enumerate(cut_lengths(len(ids) // 4, most)):
                    rows.append((doc, k, at, size, zlib.crc32(ids[4 * at : 4 * (at + size)])))
                    at += size
            if rows:
                yield pa.record_batch(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _PIECE_TYPES, strict=True)], names=_PIECE_NAMES
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").transform(map_arrow, over, PIECES)


_PIECE_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32"]
_PIECE_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]


def pack(items: DataFrame, room: Room, documents: int) -> DataFrame:
    """Place ``items(doc_id, piece, start, length, ids_crc32)``; ``documents``: their number."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held)
        length = table["length"].to_numpy()
        keys = [table[c].fill_null(-(2**63)).to_numpy() if table[c].null_count else table[c].to_numpy() for c in ("ids_crc32", "piece", "doc_id")]
        order = np.lexsort((*keys, -length))
        bins, base = Bins(room), TaskContext.get().partitionId() << 40
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        for i, size in zip(order.tolist(), length[order].tolist(), strict=True):
            sequence[i], offset[i] = bins.place(size)
        out = table.append_column("sequence_id", pa.array(sequence + base)).append_column("offset", pa.array(offset))
        yield from out.combine_chunks().to_batches(max_chunksize=50_000)

    n = tasks_for(documents, DOCS_A_TASK)
    # the pieces of a document are dealt singly: full pieces of a long one need no neighbours
    return items.repartition(n, F.xxhash64("doc_id", "piece", "ids_crc32")).transform(map_arrow, over, PACKED)


def pack_documents(docs: DataFrame, tokenizer: str, room: Room = Room(), end_id: int = 0) -> DataFrame:
    """Encode, cut and pack ``docs(doc_id, text)``; one row per piece."""
    return pack(pieces(docs, tokenizer, end_id, room.tokens), room, docs.count())
