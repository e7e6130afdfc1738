"""Embedding near-duplicates by PCA-ordered tiles with suffix-norm bounds.

Vectors of one label are scaled to length one and rotated to their principal axes, so that
the leading coordinates hold most of a product. Equal vectors form one class first. The first
axes are cut into cells as wide as the largest distance of a linked pair: links lie in equal
or neighbouring cells. Cells are dealt into blocks, and each pair of blocks that can hold a
link is a tile. In a tile the products of the leading dimensions come first; a pair goes on
only while ``partial + |rest of a| * |rest of b|`` can still reach the threshold.

A tile returns one row per class that has a link: how many vectors it links with, and the
smallest class of its group inside the tile. All pairs are never written.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components,
and vectors without a label, link with nothing and stay; vectors of different length link
with nothing; equal vectors link with each other; rows that repeat a vec_id are vectors of
their own; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import components, grouped, map_arrow, materialise

#: Vectors of a block, axes that are cut into cells, and dimensions after which pairs are dropped.
BLOCK = 1024
AXES = 1
STEPS = (8, 16, 32)
#: Products differ from those of the given vectors by rounding of the rotation only.
SLACK = 1e-12


def usable(vector: Column, label: Column) -> Column:
    """Vectors that may link at all."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    return F.coalesce(label.isNotNull() & (F.size(vector) > 0) & fine & some, F.lit(False))


def _unit(table: pa.Table | pa.RecordBatch, dims: int) -> np.ndarray:
    """Rows of ``v`` as doubles of length one; scaled first, so that squares stay finite."""
    x = np.concatenate([np.asarray(v.values if hasattr(v, "values") else v, float) for v in table["v"]]).reshape(-1, dims)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def axes(classes: DataFrame) -> dict[int, np.ndarray]:
    """Principal axes of each vector length, from the second moments of all classes.

    Each task returns one matrix of squared length; the sums that reach the driver are as
    many as the squared lengths, whatever the number of vectors.
    """

    def moments(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes = np.diff(batch["v"].offsets.to_numpy())
            for d in np.unique(sizes).tolist():
                x = _unit(batch.filter(pa.array(sizes == d)), d)
                sums[d] = sums.get(d, 0) + x.T @ x
        for d, m in sums.items():
            yield pa.record_batch([pa.array(np.full(d * d, d, np.int32)), pa.array(np.arange(d * d)), pa.array(m.ravel())], names=["dims", "at", "s"])

    rows = classes.select("v").transform(map_arrow, moments, "dims int, at long, s double").groupBy("dims", "at").agg(F.sum("s").alias("s")).toArrow()
    dims, at, s = (rows[c].to_numpy() for c in ("dims", "at", "s"))
    out = {}
    for d in np.unique(dims).tolist():
        m = np.zeros(d * d)
        m[at[dims == d]] = s[dims == d]
        _, vectors = np.linalg.eigh((m.reshape(d, d) + m.reshape(d, d).T) / 2)
        out[d] = np.ascontiguousarray(vectors[:, ::-1])
    return out


def _rotated(classes: DataFrame, turn: dict[int, np.ndarray], width: float) -> DataFrame:
    """Classes with rotated coordinates ``y`` and their cell."""

    def over(batches):
        for batch in batches:
            sizes = np.diff(batch["v"].offsets.to_numpy())
            for d in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == d))
                y = _unit(part, d) @ turn[d]
                cells = np.zeros((len(y), AXES), np.int32)
                cells[:, : min(AXES, d)] = np.floor(y[:, :AXES] / width)
                yield pa.record_batch(
                    [
                        part["node"],
                        part["label"],
                        part["copies"],
                        pa.array(np.full(len(y), d, np.int32)),
                        pa.array(list(cells), pa.list_(pa.int32())),
                        pa.array([r.tobytes() for r in y], pa.binary()),
                    ],
                    names=["node", "label", "copies", "dims", "cell", "y"],
                )

    return classes.select("node", F.col("label").cast("string").alias("label"), "copies", "v").transform(map_arrow, 
        over, "node binary, label string, copies long, dims int, cell array<int>, y binary"
    )


def linked_pairs(a: np.ndarray, b: np.ndarray, least: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs with product of at least ``least``; ``same``: one block with itself."""
    d = a.shape[1]
    cuts = [s for s in STEPS if s < d] + [d]
    rest = lambda x, s: np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", x[:, :s], x[:, :s])))
    part = a[:, : cuts[0]] @ b[:, : cuts[0]].T
    open_ = part + np.outer(rest(a, cuts[0]), rest(b, cuts[0])) >= least - SLACK
    if same:
        open_ = np.triu(open_, 1)
    i, j = np.nonzero(open_)
    acc = part[i, j]
    for lo, hi in itertools.pairwise(cuts):
        if not len(i):
            break
        if len(i) > 0.1 * part.size:  # many pairs go on: one product of blocks is cheaper
            acc = acc + (a[:, lo:hi] @ b[:, lo:hi].T)[i, j]
        else:
            acc = acc + np.einsum("ij,ij->i", a[i, lo:hi], b[j, lo:hi])
        keep = acc + rest(a, hi)[i] * rest(b, hi)[j] >= least - SLACK
        i, j, acc = i[keep], j[keep], acc[keep]
    keep = acc >= least
    return i[keep], j[keep]


def smallest_reach(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index that each of ``n`` items reaches over the pairs ``(i, j)``."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _tile(table: pa.Table, least: float) -> pa.Table | None:
    dims = table["dims"][0].as_py()
    y = np.frombuffer(b"".join(table["y"].to_pylist()), float).reshape(-1, dims)
    side = table["side"].to_numpy()
    nodes = table["node"].to_pylist()
    copies = table["copies"].to_numpy()
    one = np.flatnonzero(side == 0)
    two = np.flatnonzero(side == 1)
    i, j = linked_pairs(y[one], y[two] if len(two) else y[one], least, not len(two))
    i, j = one[i], (two if len(two) else one)[j]
    if not len(i):
        return None
    links = np.zeros(len(nodes), np.int64)
    np.add.at(links, i, copies[j])
    np.add.at(links, j, copies[i])
    order = np.array(sorted(range(len(nodes)), key=nodes.__getitem__))
    rank = np.empty(len(nodes), np.int64)
    rank[order] = np.arange(len(nodes))
    root = smallest_reach(len(nodes), rank[i], rank[j])
    hit = np.flatnonzero(links)
    return pa.table(
        {"node": pa.array([nodes[k] for k in hit], pa.binary()), "root": pa.array([nodes[order[root[rank[k]]]] for k in hit], pa.binary()), "links": links[hit]}
    )


def tiles(rotated: DataFrame) -> DataFrame:
    """Rows of ``rotated`` once for each tile that needs them, with ``tile`` and ``side``."""
    place = ["label", "dims", "cell"]
    sizes = rotated.groupBy(*place).agg(F.count("*").alias("held")).withColumn("blocks", F.ceil(F.col("held") / BLOCK).cast("int"))
    rows = rotated.join(sizes.drop("held"), place).withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int")).drop("blocks")
    every = sizes.select(*place, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    # each unordered pair of equal or neighbouring cells once: the first non-zero step is up
    steps = [s for s in itertools.product((-1, 0, 1), repeat=AXES) if s >= (0,) * AXES]
    shifts = F.array(*[F.array(*[F.lit(x) for x in s]) for s in steps])
    moved = every.withColumn("step", F.explode(shifts)).withColumn("near", F.zip_with("cell", "step", lambda c, s: c + s))
    other = every.select(
        F.col("label").alias("o_label"), F.col("dims").alias("o_dims"), F.col("cell").alias("near"), F.col("block").alias("o_block")
    )
    pairs = moved.join(other, [moved["label"] == other["o_label"], moved["dims"] == other["o_dims"], moved["near"] == other["near"]]).select(
        moved["label"], moved["dims"], moved["cell"], moved["block"], moved["near"].alias("o_cell"), "o_block"
    )
    # inside one cell a pair of blocks counts once
    pairs = pairs.where((F.col("cell") != F.col("o_cell")) | (F.col("block") <= F.col("o_block")))
    pairs = pairs.withColumn("tile", F.unhex(F.md5(F.to_json(F.struct("label", "dims", "cell", "block", "o_cell", "o_block")))))
    alone = (F.col("cell") == F.col("o_cell")) & (F.col("block") == F.col("o_block"))
    sides = F.when(alone, F.array(F.struct(F.col("cell"), F.col("block"), F.lit(0).alias("side")))).otherwise(
        F.array(F.struct(F.col("cell"), F.col("block"), F.lit(0).alias("side")), F.struct(F.col("o_cell").alias("cell"), F.col("o_block").alias("block"), F.lit(1).alias("side")))
    )
    wanted = pairs.select("label", "dims", "tile", F.explode(sides).alias("s")).select("label", "dims", "tile", "s.cell", "s.block", "s.side")
    return rows.join(wanted, ["label", "dims", "cell", "block"]).select("tile", "side", "node", "copies", "dims", "y")


def near_vectors(vectors: DataFrame, least: float = 0.98) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of each row of ``vectors(vec_id, embedding, label)``."""
    v = F.col("embedding").cast("array<double>")
    text = F.concat_ws(",", F.col("label").cast("string"), F.transform(F.col("embedding"), lambda x: (x + 0).cast("string")))
    # the name of a class: the digest of its label and components (-0.0 is 0.0)
    node = F.when(usable(F.col("embedding"), F.col("label")), F.unhex(F.md5(text)))
    rows = materialise(vectors.select("vec_id", "label", node.alias("node"), v.alias("v")), "vectors")
    fine = rows.where("node is not null")
    classes = fine.groupBy("node").agg(
        F.first("label").alias("label"), F.first("v").alias("v"), F.count("*").alias("copies"), F.min("vec_id").alias("low")
    )
    classes = materialise(classes, "vector-classes")
    turn = axes(classes)
    # two vectors of length one with this product are this far apart, and no coordinate further
    width = math.sqrt(max(0.0, 2 - 2 * least)) + 1e-9
    found = grouped(tiles(_rotated(classes, turn, width)), ["tile"], lambda t: _tile(t, least), "node binary, root binary, links long")
    found = materialise(found, "vector-links")
    reach = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), "vectors")
    low = classes.join(reach, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = low.groupBy("root").agg(F.min("low").alias("component"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    facts = low.join(lowest, "root").join(links, "node", "left").select(
        "node", "component", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n")
    )
    out = rows.join(facts, "node", "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept")
    )
