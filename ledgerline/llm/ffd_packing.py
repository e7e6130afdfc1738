"""First-fit decreasing packing of documents, with a tournament tree over the bins' free room.

Every document is encoded whole and cut into full pieces and one rest. The encoded pieces are
written once to the shared folder with a number each and their checksum, so nothing is encoded again
when an executor is lost and the dealing below cannot change between attempts. Their lengths are then
dealt at random into groups of about ``GROUP_TOKENS`` ids, and each group is packed alone: the pieces,
longest first, go to the first bin with room, which a tournament tree over the bins finds in
logarithmic time. A group is bounded by its ids, so no document, source or group of copies is too
large for one task. The ids stay where they are; only those of a piece that was cut are fetched again
by its number, for the checksums of its parts.

A sequence is padded to ``room`` ids unless its length is a power of two. First fit leaves a few
bins of a group part-filled; ``close`` then moves pieces of the emptiest ones into the gaps of the
fullest, cutting where a gap asks for it, and cuts the last bin into powers of two. No padding is
left, and only the pieces next to a gap are cut.

Defined results: a null or empty text is its end id alone; rows that share a ``doc_id`` are packed
each for itself; a null ``doc_id`` stays null; other columns are left out, whatever their names; an
empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import grouped, map_arrow, materialise
from ledgerline.llm.ngram_join import bitmap
from ledgerline.llm.tokens import Encoder

ROOM = 4096
#: Ids of one group: some 1,000 sequences.
GROUP_TOKENS = 4 << 20
#: Ids that leave a worker in one batch while encoding.
BATCH_TOKENS = 1 << 20

ENCODED = "piece long, doc_id long, start long, doc_tokens long, length long, ids_crc32 long, ids binary"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded long"


class Tournament:
    """Bins in order of opening; finds the first one with enough free room.

    A complete binary tree over the bins: each inner node holds the larger free room of its two
    children, so the first bin with room is found on one way down from the root.
    """

    def __init__(self, bins: int, room: int) -> None:
        self.size = 1 << max(0, bins - 1).bit_length()
        self.best = [room] * (2 * self.size)

    def place(self, need: int) -> tuple[int, int]:
        """Bin of a piece and its free room before; there is always a bin that fits."""
        best, node = self.best, 1
        while node < self.size:
            node *= 2
            if best[node] < need:
                node += 1
        free = best[node]
        best[node] = free - need
        at = node >> 1
        while at:
            new = max(best[2 * at], best[2 * at + 1])
            if best[at] == new:
                break
            best[at] = new
            at >>= 1
        return node - self.size, free


Part = tuple[int, int, int]  # piece, first id of it, end


def first_fit(lengths: list[int], room: int) -> list[list[Part]]:
    """Bins of whole pieces; ``lengths`` are given longest first."""
    tree = Tournament(len(lengths), room)
    bins: list[list[Part]] = []
    for piece, need in enumerate(lengths):
        k, free = tree.place(need)
        if free == room:
            bins.append([])
        bins[k].append((piece, 0, need))
    return bins


def padded_length(length: int, room: int) -> int:
    """A power of two needs no padding."""
    return length if length & (length - 1) == 0 else room


def close(bins: list[list[Part]], room: int) -> list[list[Part]]:
    """The same pieces in bins that need no padding; cuts only next to a gap."""
    held = [sum(b - a for _, a, b in parts) for parts in bins]
    done = [parts for parts, n in zip(bins, held, strict=True) if padded_length(n, room) == n]
    rest = sorted((k for k, n in enumerate(held) if padded_length(n, room) != n), key=lambda k: -held[k])
    open_bins = [list(bins[k]) for k in rest]
    fill = [held[k] for k in rest]
    first, last = 0, len(rest) - 1
    while first < last:
        gap = room - fill[first]
        if not gap:
            done.append(open_bins[first])
            first += 1
            continue
        piece, a, b = open_bins[last].pop()
        cut = min(gap, b - a)
        open_bins[first].append((piece, a, a + cut))
        fill[first] += cut
        fill[last] -= cut
        if cut < b - a:
            open_bins[last].append((piece, a + cut, b))
        if not fill[last]:
            last -= 1
    for parts, n in zip(open_bins[first : last + 1], fill[first : last + 1], strict=True):
        done.extend(powers(parts, n))
    return done


def powers(parts: list[Part], held: int) -> list[list[Part]]:
    """One bin as bins of a power of two ids each, the largest first."""
    out: list[list[Part]] = []
    left = list(reversed(parts))
    for bit in reversed(range(held.bit_length())):
        need, taken = held & (1 << bit), []
        while need:
            piece, a, b = left.pop()
            cut = min(need, b - a)
            taken.append((piece, a, a + cut))
            need -= cut
            if cut < b - a:
                left.append((piece, a + cut, b))
        if taken:
            out.append(taken)
    return out


def encode(docs: DataFrame, tokenizer: str, end_id: int, room: int) -> DataFrame:
    """Pieces of every whole text with their ids: the rest of a document first, then full pieces."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        names = ["piece", "doc_id", "start", "doc_tokens", "length", "ids_crc32", "ids"]
        types = [pa.int64()] * 6 + [pa.binary()]
        piece = TaskContext.get().partitionId() << 40

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        for batch in batches:
            rows: list[tuple] = []
            waiting = 0
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = encoder.encode(text.as_py()) + end
                n, at = len(ids) // 4, 0
                while at < n:
                    size = (n - at) % room or room
                    part = ids[4 * at : 4 * (at + size)]
                    rows.append((piece, doc, at, n, size, zlib.crc32(part), part))
                    piece += 1
                    at += size
                    waiting += size
                    if waiting >= BATCH_TOKENS:
                        yield out(rows)
                        rows, waiting = [], 0
            if rows:
                yield out(rows)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").transform(map_arrow, over, ENCODED)


def pack(pieces: DataFrame, tokens: int, room: int = ROOM, group_tokens: int = GROUP_TOKENS, with_ids: bool = False) -> DataFrame:
    """Pack a written table of ``ENCODED`` rows; ``tokens``: the sum of their lengths.

    One row per piece with its sequence and place, and its ids if asked for.
    """

    def one(table: pa.Table) -> pa.Table:
        lengths = table["length"].to_numpy()
        order = np.lexsort((table["start"].to_numpy(), -lengths))
        bins = close(first_fit(lengths[order].tolist(), room), room)
        base = table["grp"][0].as_py() << 32
        piece, doc, start, whole, sums = (table[c].to_pylist() for c in ("piece", "doc_id", "start", "doc_tokens", "ids_crc32"))
        rows: list[tuple] = []
        for k, parts in enumerate(bins):
            at = 0
            padded = padded_length(sum(b - a for _, a, b in parts), room)
            for place, a, b in parts:
                i = int(order[place])
                crc = sums[i] if b - a == lengths[i] else None
                rows.append((piece[i], a, doc[i], start[i] + a, b - a, crc, whole[i], base + k, at, padded))
                at += b - a
        return pa.table([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["piece", "first", *_NAMES])

    groups = max(1, -(-tokens // group_tokens))
    dealt = pieces.drop("ids").withColumn("grp", F.pmod(F.xxhash64("piece"), F.lit(groups)))
    parts = materialise(grouped(dealt, ["grp"], one, f"piece long, first long, {PACKED}", groups), "ffd-parts")
    ids = F.substring("ids", (4 * F.col("first") + 1).cast("int"), (4 * F.col("length")).cast("int"))
    if with_ids:
        out = parts.drop("ids_crc32").join(pieces.select("piece", "ids"), "piece").withColumn("ids", ids)
        return out.select(*(F.crc32("ids").alias(n) if n == "ids_crc32" else n for n in _NAMES), "ids")
    cut = parts.where(F.col("ids_crc32").isNull())
    found = cut.drop("ids_crc32").join(ids_of(pieces, cut), "piece").withColumn("ids_crc32", F.crc32(ids))
    return parts.where(F.col("ids_crc32").isNotNull()).select(*_NAMES).unionAll(found.select(*_NAMES))


def ids_of(pieces: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(piece, ids)`` of the pieces that a map of ``wanted(piece)`` names; the others stay in their tasks."""
    named = bitmap(wanted.select(F.xxhash64("piece").alias("h")))

    @F.arrow_udf("boolean")
    def has(h: pa.Array) -> pa.Array:
        return pa.array(named.has(h.to_numpy()))

    # the numbers alone go to Python; the package is there since the pieces were encoded or packed
    return pieces.select("piece", "ids").where(has(F.xxhash64("piece")))


_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded"]


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int = 2, room: int = ROOM, group_tokens: int = GROUP_TOKENS, with_ids: bool = False
) -> DataFrame:
    """Encode, cut and pack ``docs(doc_id, text)``; one row per piece.

    ``padded`` is the length of the piece's sequence after padding; ``with_ids`` adds the ids of
    the piece as little-endian unsigned 32-bit integers.
    """
    pieces = materialise(encode(docs, tokenizer, end_id, room), "ffd-pieces")
    tokens = pieces.agg(F.sum("length")).first()[0] or 0
    return pack(pieces, int(tokens), room, group_tokens, with_ids)
