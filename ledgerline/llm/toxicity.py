"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A document's features are the distinct hashed character n-grams of its whole lower-cased text.
Training takes every labelled row that is not held out. Spark counts, per class, the documents
that hold each n-gram; the log ratio of the smoothed class frequencies scales the feature. The
n-grams with the strongest evidence enter a logistic regression with L2 penalty: the rows are dealt
by the hash of their id into groups of about ``Sizes.sample``, each group is fitted in a task, and
the weights are averaged by the groups' rows (parameter mixing, McDonald et al., 2009). Up to
``Sizes.sample`` rows are one group.

Bounds, none of which leaves a row out: ``2 ** Sizes.bits`` hash buckets, ``Sizes.kept`` features,
the rows of one fit. The model that goes to the tasks has one number per bucket, whatever the input.

Defined results: a null or empty text scores the bias alone; labels that are null are not
learnt from, and a doc_id with several labels counts as toxic if one says so; without labels
of both classes the score is the smoothed share of toxic labels; rows that repeat score
alike; ``keep`` passes other columns through; an empty input gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import grouped, map_arrow

#: Characters hashed at a time; longer texts go in overlapping parts.
PART_CHARS = 1 << 20
THRESHOLD = 0.3
#: Buckets whose counts are one row of the shuffle.
COUNT_PART = 1 << 12


@dataclass(frozen=True)
class Sizes:
    """Bounds and settings of the training; ``sample``: labelled rows of one fit."""

    grams: tuple[int, ...] = (4, 5, 6)
    bits: int = 18
    sample: int = 16_000
    kept: int = 4_000
    least_documents: int = 3
    smooth: float = 1.0
    penalty: float = 3.0
    steps: int = 200


@dataclass(frozen=True)
class Model:
    """Weight per hash bucket (zero: not a feature) and the bias."""

    weights: np.ndarray
    bias: float
    sizes: Sizes

    def scores(self, texts: list[str | None]) -> np.ndarray:
        used = self.weights != 0
        out = np.empty(len(texts))
        for i, text in enumerate(texts):
            found = features(text, self.sizes, used)
            out[i] = self.bias + float(self.weights[found].sum(dtype=np.float64))
        return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


def hashes(text: str, sizes: Sizes) -> Iterator[np.ndarray]:
    """Buckets of all n-grams of a text, part by part."""
    most = max(sizes.grams)
    for at in range(0, len(text), PART_CHARS):
        c = np.frombuffer(text[at : at + PART_CHARS + most - 1].encode("utf-32-le", "surrogatepass"), np.uint32)
        h = c
        for n in range(2, most + 1):
            if len(c) < n:
                break
            h = h[:-1] * np.uint32(0x01000193) + c[n - 1 :]
            if n in sizes.grams:
                mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
                yield (mixed + np.uint32(n)) * np.uint32(0x9E3779B1) >> np.uint32(32 - sizes.bits)


def features(text: str | None, sizes: Sizes, used: np.ndarray | None = None) -> np.ndarray:
    """Distinct buckets of a text, of the used ones if given."""
    if not text:
        return np.empty(0, np.uint32)
    found = [h if used is None else h[used[h]] for h in hashes(text.lower(), sizes)]
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.uint32)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def known(labels: DataFrame) -> DataFrame:
    """``(_id, toxic)``: every id with a label to learn from."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    return rows.groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").cast("int").alias("toxic"))


def train(docs: DataFrame, labels: DataFrame, sizes: Sizes = Sizes()) -> Model:
    """Fit on all rows to learn from; the texts themselves stay in the tasks."""
    docs = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    labels = known(labels)
    # both sides grow with the input: the same plan at every size
    rows = docs.join(labels.hint("merge"), F.col("doc_id") == F.col("_id")).select("text", "toxic")
    seen, held = class_counts(rows, sizes)
    prior = float(np.log((held[1] + 1) / (held[0] + 1)))
    if min(held) == 0:
        return Model(np.zeros(1 << sizes.bits, np.float32), prior, sizes)
    share = (seen + sizes.smooth) / (held[:, None] + 2 * sizes.smooth)
    ratio = np.log(share[1] / share[0])
    # evidence: how far the class frequencies differ, in standard errors
    spread = np.sqrt((share * (1 - share) / held[:, None]).sum(axis=0))
    evidence = np.where(seen.sum(axis=0) >= sizes.least_documents, np.abs(share[1] - share[0]) / spread, 0)
    chosen = np.sort(np.argsort(-evidence, kind="stable")[: sizes.kept])
    used = np.zeros(1 << sizes.bits, bool)
    used[chosen] = evidence[chosen] > 0
    weights, bias = mixed(_rows(docs, labels, used, sizes), int(held.sum()), ratio, prior, sizes)
    return Model((weights * ratio * used).astype(np.float32), bias, sizes)


def class_counts(rows: DataFrame, sizes: Sizes) -> tuple[np.ndarray, np.ndarray]:
    """Documents of each class that hold each bucket, and documents of each class."""
    width = min(COUNT_PART, 1 << sizes.bits)
    parts = (1 << sizes.bits) // width

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held = np.zeros((2, 1 << sizes.bits), "<u4"), np.zeros((2, 1), "<u4")
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                y = int(toxic > 0)
                seen[y, features(text, sizes)] += 1
                held[y] += 1
        # part -1 holds the number of documents of the class
        found = [(y, part, seen[y, part * width : (part + 1) * width] if part >= 0 else held[y]) for y in (0, 1) for part in range(-1, parts)]
        found = [(y, part, n.tobytes()) for y, part, n in found if n.any()]
        columns = list(zip(*found, strict=True)) or [(), (), ()]
        types = [pa.int64(), pa.int64(), pa.binary()]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["y", "part", "n"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(n, "<u4").astype("<i8") for n in table["n"].to_pylist())
        return pa.table({"y": table["y"][:1], "part": table["part"][:1], "n": pa.array([total.tobytes()], pa.binary())})

    counts = rows.transform(map_arrow, count, "y long, part long, n binary").transform(grouped, ["y", "part"], add, "y long, part long, n binary")
    seen, held = np.zeros((2, 1 << sizes.bits)), np.zeros(2)
    got = counts.toArrow()
    for y, part, n in zip(*(got[c].to_pylist() for c in ("y", "part", "n")), strict=True):
        n = np.frombuffer(n, "<i8")
        if part < 0:
            held[y] = n[0]
        else:
            seen[y, part * width : (part + 1) * width] = n
    return seen, held


def _rows(docs: DataFrame, labels: DataFrame, used: np.ndarray, sizes: Sizes) -> DataFrame:
    """``(doc_id, found, toxic)``: the used features of each row; only they meet the labels."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t, sizes, used).astype("<u4").tobytes() for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(found, pa.binary())], names=["doc_id", "found"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.transform(map_arrow, over, f"doc_id {kind}, found binary")
    return found.join(labels.hint("merge"), F.col("doc_id") == F.col("_id")).drop("_id")


def mixed(rows: DataFrame, n: int, ratio: np.ndarray, prior: float, sizes: Sizes) -> tuple[np.ndarray, float]:
    """Weights and bias of the groups of ``n`` rows in all, averaged by the groups' rows."""

    def one(table: pa.Table) -> pa.Table:
        every = sorted(zip(table["found"].to_pylist(), table["toxic"].to_pylist(), strict=True))
        # rows that share a doc_id share a group: a group that grew so is fitted in blocks
        blocks = -(-len(every) // (2 * sizes.sample))
        places, values = [], []
        for k in range(blocks):
            parts = [np.frombuffer(f, "<u4") for f, _ in every[k::blocks]]
            starts = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
            y = np.array([float(toxic > 0) for _, toxic in every[k::blocks]])
            weights, bias = fit(np.concatenate(parts), starts, y, ratio, prior, sizes)
            at = np.flatnonzero(weights)
            # place -1 holds the bias
            places += [[-1], at]
            values += [[bias * len(y)], weights[at] * len(y)]
        return pa.table({"place": pa.array(np.concatenate(places), pa.int64()), "value": pa.array(np.concatenate(values), pa.float64())})

    groups = max(1, -(-n // sizes.sample))
    dealt = rows.withColumn("grp", F.pmod(F.xxhash64("doc_id"), F.lit(groups)))
    parts = dealt.select("grp", "found", "toxic").transform(grouped, ["grp"], one, "place long, value double", groups)
    # exact sums, so the order in which the groups end changes nothing
    got = parts.groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,18)")).cast("double").alias("value")).toArrow()
    place, value = got["place"].to_numpy(), got["value"].to_numpy() / n
    weights = np.zeros(len(ratio))
    weights[place[place >= 0]] = value[place >= 0]
    return weights, float(value[place < 0][0])


def fit(x: np.ndarray, starts: np.ndarray, y: np.ndarray, ratio: np.ndarray, prior: float, sizes: Sizes) -> tuple[np.ndarray, float]:
    """Logistic regression on ``ratio``-scaled presence, by accelerated gradient steps."""
    columns, place = np.unique(x, return_inverse=True)
    scale = ratio[columns]
    row = np.repeat(np.arange(len(y)), np.diff(starts))
    value = scale[place]
    # step length from a bound on the curvature: power iterations on the scaled matrix
    v = np.ones(len(columns)) / np.sqrt(max(1, len(columns)))
    top = 1.0
    for _ in range(15):
        z = np.bincount(row, value * v[place], len(y))
        u = np.bincount(place, value * z[row], len(columns))
        top = float(np.linalg.norm(u)) or 1.0
        v = u / top
    step = 1 / (0.25 * 1.1 * (top + len(y)) + sizes.penalty)
    w = old = np.zeros(len(columns))
    b = old_b = prior
    for k in range(sizes.steps):
        m = k / (k + 3)
        ahead, ahead_b = w + m * (w - old), b + m * (b - old_b)
        z = np.bincount(row, value * ahead[place], len(y)) + ahead_b
        error = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - y
        old, old_b = w, b
        w = ahead - step * (np.bincount(place, value * error[row], len(columns)) + sizes.penalty * ahead)
        b = ahead_b - step * float(error.sum())
    weights = np.zeros(len(ratio))
    weights[columns] = w
    return weights, float(b)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` after its own columns."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.scores(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))], names=[*names, "score", "predicted"]
            )

    names = [f"c{i}" for i in range(len(docs.columns))]
    names[docs.columns.index("text")] = "text"
    # own names inside, so that columns named like the results do not clash
    out = docs.toDF(*names).transform(map_arrow, over, _schema(docs.toDF(*names)))
    return out.toDF(*docs.columns, "score", "predicted")


def _schema(docs: DataFrame) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), "score double, predicted int"])


def keep(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without the rows predicted toxic."""
    scored = score(docs, model)
    names = [f"c{i}" for i in range(len(docs.columns))]
    return scored.toDF(*names, "score", "predicted").where("predicted = 0").select(*names).toDF(*docs.columns)
