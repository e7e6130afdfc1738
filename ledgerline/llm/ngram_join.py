"""Exact Jaccard join on five-word shingles by pivots, windows and recursive regions.

Two documents link when their shingle sets have a Jaccard similarity of at least 0.8.

Regions. Unrelated texts are all at distance 1 from each other, so document pivots alone
part nothing. The first pivots are therefore single shingles: a document is as near to each
shingle it holds as to any other, and the tie goes to the smallest in a global order. For a
link at distance r, the boundary window of a document with n shingles is its smallest
``n - ceil((1 - r) n) + 1`` shingles: two linked documents share one of them. A document is
replicated to the cells of its window, and the cells of one smallest document form its region.

The global order puts frequent shingles last, so that a passage that many documents
share opens no region unless a document holds little else. Any order gives the same links; a
sample of documents only tells which shingles are worth putting last.

Recursion. In a region, documents that share too few window shingles to reach the threshold
part (an exact bound); what stays together forms a group. Groups are joined on whole sets:
a pivot is compared with all others, what it links is one class, and by the triangle
inequality only documents whose distances to every pivot so far differ by at most r can still
link; among those the next pivot is taken. A large group or region is dealt into blocks and
each pair of blocks is a tile, so no task holds more than two blocks.

Equal sets are one class from the start. Links inside a class are not spelled out: the
result is each document's component.

Defined results: a null, empty or wordless text has no shingle, links with nothing and is its
own component; one to four words are one shingle; rows that share a doc_id count as one
document for ``keep_one``; a null doc_id takes part but names no component unless no other
id is there; other columns are left out by ``link`` and pass through ``keep_one``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import components, grouped, map_arrow, materialise, tiled
from ledgerline.llm.near_vectors import smallest_reach
from ledgerline.llm.shingles import shingle_set

#: Similarity in percent.
PERCENT = 80
#: One document in so many, by hash, tells frequent shingles; so many of them hold one.
SAMPLE_ONE_IN = 16
FREQUENT = 3
#: Bits of the maps that name frequent shingles or wanted documents: a fixed size, whatever
#: the input. Two that share a bit are both named, which costs work and changes no result.
MAP_BITS = 24
#: Documents of a region's block, and shingles of a group's block.
REGION_BLOCK = 1024
GROUP_BLOCK = 2_000_000


#: Bits of a part of a map: what one row of ``bitmap`` packs (4 kB).
PART_BITS = 15


class BitMap:
    """A set of slots in ``2 ** size`` bits."""

    def __init__(self, slots: np.ndarray, size: int = MAP_BITS) -> None:
        self.size = size
        self.bits = np.zeros(1 << (size - 3), np.uint8)
        np.bitwise_or.at(self.bits, slots >> 3, (1 << (slots & 7)).astype(np.uint8))

    def put(self, part: int, packed: pa.Buffer) -> None:
        """Set the bits of a part of ``2 ** PART_BITS`` slots."""
        at = part << (PART_BITS - 3)
        self.bits[at : at + len(packed)] = np.frombuffer(packed, np.uint8)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        slots = (hashes & hashes.dtype.type((1 << self.size) - 1)).astype(np.int64)
        return (self.bits[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1


def packed_parts(hashes: DataFrame, size: int) -> DataFrame:
    """``(part, packed)``: the slots of ``hashes(h)`` as bits, set on Spark."""
    slot = F.col("h").bitwiseAND(F.lit((1 << size) - 1))
    # positions within a part are below 2 ** 15, which is one bitmap of Spark's
    rows = hashes.select(F.shiftright(slot, PART_BITS).cast("int").alias("part"), slot.bitwiseAND(F.lit((1 << PART_BITS) - 1)).alias("bit"))
    return rows.groupBy("part").agg(F.bitmap_construct_agg("bit").alias("packed"))


def bitmap(hashes: DataFrame, size: int = MAP_BITS) -> BitMap:
    """Map of the slots of ``hashes(h)``; ``2 ** (size - 3)`` bytes return at most, whatever the input."""
    out = BitMap(np.empty(0, np.int64), size)
    got = packed_parts(hashes, size).toArrow()
    for part, packed in zip(got["part"].to_pylist(), got["packed"], strict=True):
        out.put(part, packed.as_buffer())
    return out


def window_size(n: int) -> int:
    """Shingles of a document with ``n`` of them of which a linked document shares one."""
    return n - -(-PERCENT * n // 100) + 1


def least_common(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Window shingles that linked documents with ``n`` and ``m`` shingles share at least.

    They share ``PERCENT / (100 + PERCENT)`` of ``n + m``. Beyond the window that ends first in the
    order, that document has ``ceil(0.8 n) - 1`` shingles left.
    """
    both = -(-PERCENT * (n + m) // (100 + PERCENT))
    return np.maximum(1, both - (-(-PERCENT * np.maximum(n, m) // 100) - 1))


def _id_hash(doc_id: Column) -> Column:
    return F.xxhash64(doc_id)


def frequent_shingles(docs: DataFrame) -> BitMap:
    """Map of the shingles that several documents of the sample hold."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(t.as_py()) for t in batch.column("text")]
            names = [hashlib.md5(s.tobytes()).digest() for s in found]
            lists = pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))
            yield pa.record_batch([pa.array(names, pa.binary()), lists], names=["sig", "hs"])

    sample = docs.where(F.pmod(_id_hash(F.col("doc_id")), F.lit(SAMPLE_ONE_IN)) == 0).select("text")
    rows = sample.transform(map_arrow, sets, "sig binary, hs array<long>").dropDuplicates(["sig"]).select(F.explode("hs").alias("h"))
    return bitmap(rows.groupBy("h").count().where(F.col("count") >= FREQUENT))


def profile(docs: DataFrame, frequent: BitMap) -> DataFrame:
    """``doc_id, n_shingles, sig, hs``: the set's size and name, and its window shingles."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, names, windows = [], [], []
            for text in batch.column("text"):
                s = shingle_set(text.as_py())
                sizes.append(len(s))
                names.append(hashlib.md5(s.tobytes()).digest() if len(s) else None)
                late = frequent.has(s)
                windows.append(np.concatenate((s[~late], s[late]))[: window_size(len(s))].view(np.int64) if len(s) else s.view(np.int64))
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()), pa.array(windows, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "sig", "hs"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").transform(map_arrow, over, "doc_id long, n_shingles long, sig binary, hs array<long>")


def _near(table: pa.Table) -> pa.Table | None:
    """Spanning edges of a region tile: pairs that share enough window shingles to link."""
    m = table.num_rows
    if m < 2:
        return None
    node, n = table["node"].to_numpy(), table["n"].to_numpy()
    lists = table["hs"].combine_chunks()
    values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
    values = values[offsets[0] : offsets[-1]]
    row = np.repeat(np.arange(m), np.diff(offsets))
    distinct, column, held = np.unique(values, return_inverse=True, return_counts=True)
    # shingles of one document join nothing
    many = held > 1
    place = np.cumsum(many) - 1
    use = many[column]
    row, column, width = row[use], place[column[use]], int(many.sum())
    common = np.zeros((m, m), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for lo in range(0, width, 4096):
        a, b = np.searchsorted(column, (lo, lo + 4096))
        part = np.zeros((m, min(4096, width - lo)), np.float32)
        part[row[a:b], column[a:b] - lo] = 1
        common += part @ part.T
    i, j = np.nonzero(np.triu(common, 1))
    c, x, y = common[i, j], n[i], n[j]
    ok = (c >= least_common(x, y)) & (100 * np.minimum(x, y) >= PERCENT * np.maximum(x, y))
    return _edges(node, i[ok], j[ok])


def _edges(node: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.Table | None:
    if not len(i):
        return None
    root = smallest_reach(len(node), i, j)
    hit = np.flatnonzero(root != np.arange(len(node)))
    return pa.table({"a": node[hit], "b": node[root[hit]]})


def exact_links(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Spanning links of ``sets``: pivots, and windows from their distances.

    Each pair is either compared, or connected already, or parted by a pivot p with
    ``|d(x, p) - d(y, p)| > r``.
    """
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    every = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    r = 1 - PERCENT / 100 + 1e-9
    label = np.arange(m)
    waiting = np.ones(m, bool)
    distances: list[np.ndarray] = []
    links = []
    for q in range(m):
        waiting[q] = False
        open_ = waiting & (label != label[q]) & (100 * np.minimum(sizes, sizes[q]) >= PERCENT * np.maximum(sizes, sizes[q]))
        for d in distances:
            if not open_.any():
                break
            open_ &= ~(np.abs(d - d[q]) > r)
        if not open_.any():
            continue
        at = np.searchsorted(sets[q], every)
        at[at == sizes[q]] = 0
        both = np.add.reduceat((sets[q][at] == every).astype(np.int64), starts)
        union = sizes + sizes[q] - both
        if len(distances) < 16:
            distances.append(1 - both / union)
        hit = np.flatnonzero(open_ & (100 * both >= PERCENT * union))
        for x in hit.tolist():
            if label[x] != label[q]:
                links.append((q, x))
                label[label == label[x]] = label[q]
    return links


def _resolve(table: pa.Table) -> pa.Table | None:
    if table.num_rows < 2:
        return None
    sets = [np.frombuffer(s, np.uint64) for s in table["set"].to_pylist()]
    links = exact_links(sets)
    if not links:
        return None
    node = table["node"].to_numpy()
    i, j = np.array(links).T
    return pa.table({"a": node[i], "b": node[j]})


def candidate_groups(classes: DataFrame) -> DataFrame:
    """``(node, root)`` of the classes whose windows leave a link possible."""
    cells = classes.select("node", F.col("n_shingles").alias("n"), F.explode("hs").alias("h"))
    # combined before the shuffle: a frequent cell is a few rows
    pivots = cells.groupBy("h").agg(F.count("*").alias("held"), F.min("node").alias("pivot")).where("held > 1").select("h", "pivot")
    shared = cells.join(pivots, "h").groupBy("node").agg(F.first("n").alias("n"), F.collect_list("h").alias("hs"), F.collect_set("pivot").alias("pivots"))
    members = shared.select("node", "n", "hs", F.explode("pivots").alias("pivot"), F.lit(1).alias("one"))
    members = tiled(materialise(members, "join-members"), "pivot", "node", "one", REGION_BLOCK)
    edges = grouped(members.select("pivot", "tile_i", "tile_j", "node", "n", "hs"), ["pivot", "tile_i", "tile_j"], _near, "a long, b long")
    return components(edges, "join-groups")


def whole_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(sig, n, set)`` of the texts of ``wanted(sig, doc_id)``, from a second pass."""
    ids = bitmap(wanted.select(_id_hash(F.col("doc_id")).alias("h")))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = pa.array(ids.has(batch.column("h").to_numpy()))
            sets = [shingle_set(t.as_py()) for t in batch.column("text").filter(hit)]
            sets = [s for s in sets if len(s)]
            if sets:
                names = [hashlib.md5(s.tobytes()).digest() for s in sets]
                yield pa.record_batch(
                    [pa.array(names, pa.binary()), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["sig", "n", "set"],
                )

    return docs.select(_id_hash(F.col("doc_id").cast("long")).alias("h"), "text").transform(map_arrow, over, "sig binary, n long, set binary")


def link(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of each row of ``docs(doc_id, text)``."""
    rows = materialise(profile(docs, frequent_shingles(docs)), "join-profile")
    first = rows.where("sig is not null").groupBy("sig").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("hs").alias("hs")
    )
    # written once, so the numbers of the classes are fixed
    classes = materialise(first.withColumn("node", F.monotonically_increasing_id()), "join-classes")
    groups = candidate_groups(classes)
    names = materialise(groups.join(classes.select("node", "sig", "doc_id"), "node"), "join-names")
    sets = whole_sets(docs, names).join(names.select("sig", "node", "root"), "sig").dropDuplicates(["sig"])
    sets = materialise(sets.select("root", "node", "n", "set"), "join-sets")
    tiles = tiled(sets, "root", "node", "n", GROUP_BLOCK).select("root", "tile_i", "tile_j", "node", "set")
    reach = components(grouped(tiles, ["root", "tile_i", "tile_j"], _resolve, "a long, b long"), "join-links")
    named = classes.select("node", "sig", "doc_id").join(reach, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    facts = named.join(lowest, "root").select("sig", "component_id")
    return rows.select("doc_id", "n_shingles", "sig").join(facts, "sig", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component: the one that names it.

    Rows that share a doc_id are one document; the row with the smallest text hash stays.
    """
    ids = link(docs).where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("keep")).distinct()
    # own names inside, so that no column of the input clashes
    names = [c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(docs.columns)]
    rows = docs.toDF(*names)
    order = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    kept = rows.join(ids, F.col("doc_id") == F.col("keep"), "left_semi")
    kept = kept.withColumn("place", F.row_number().over(order)).where("place = 1").drop("place")
    return kept.unionAll(rows.where(F.col("doc_id").isNull())).toDF(*docs.columns)
