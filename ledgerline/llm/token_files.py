"""Token ids as ORC files: run-length encoded ids, row indexes, Bloom filters on doc_id.

``write_tokens`` deals the documents into key ranges of ``doc_id``, sorts each range, encodes
it and writes one ORC file per range. ORC stores the ids as run-length encoded integers, cuts
a file into stripes that readers split over, and keeps per stripe and per row group the
smallest and largest ``doc_id`` and a Bloom filter, so a lookup skips what cannot match.

Defined results: a null or empty text is the end id alone; rows that share a ``doc_id`` each
stay a document of their own, ordered by the hash of their text; a null ``doc_id`` sorts first;
other columns of the input are left out; an empty input gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import map_arrow, partitions
from ledgerline.llm.tokens import Encoder

SCHEMA = "part int, before long, doc_id long, n_tokens long, ids array<int>"
#: ORC settings: stripes are the unit of a parallel read, row groups the unit of skipping.
STRIPE_BYTES = 64 << 20
ROW_GROUP = 1000
BLOOM_FPP = 0.01
#: Texts encoded before their rows leave the worker.
CHARS_A_BATCH = 2_000_000


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, files: int | None = None) -> None:
    """Encode ``docs(doc_id, text)`` into ORC files under ``path``, ascending by ``doc_id``.

    ``part`` is the file's place in the order and ``before`` the ids of the same file before
    the document, so a reader finds any document's global start from one sum per file.
    """
    spark = docs.sparkSession

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer)
        part = TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        before = 0
        for batch in batches:
            for lo, hi in slices(batch.column("text")):
                ids = [encoder.encode(t) + end for t in batch.column("text").slice(lo, hi - lo).to_pylist()]
                sizes = np.array([len(x) // 4 for x in ids], np.int64)
                ends = np.cumsum(sizes)
                values = pa.array(np.frombuffer(b"".join(ids), "<i4"))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), values)
                yield pa.record_batch(
                    [
                        pa.array(np.full(hi - lo, part, np.int32)),
                        pa.array(before + ends - sizes),
                        batch.column("doc_id").slice(lo, hi - lo),
                        pa.array(sizes),
                        lists,
                    ],
                    names=["part", "before", "doc_id", "n_tokens", "ids"],
                )
                before += int(ends[-1])

    n = files or partitions(spark)
    tie = F.xxhash64("text")
    (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange(n, "doc_id", tie)
        .sortWithinPartitions("doc_id", tie)
        .transform(map_arrow, encode, SCHEMA)
        .write.option("compression", "zstd")
        .option("orc.create.index", "true")
        .option("orc.stripe.size", str(STRIPE_BYTES))
        .option("orc.row.index.stride", str(ROW_GROUP))
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", str(BLOOM_FPP))
        .orc(path)
    )


def slices(texts: pa.Array, most: int = CHARS_A_BATCH) -> Iterator[tuple[int, int]]:
    """Cut a batch so that one part holds about ``most`` bytes of text."""
    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    lo = held = 0
    for i, size in enumerate(sizes):
        held += int(size)
        if held >= most:
            yield lo, i + 1
            lo, held = i + 1, 0
    if lo < len(sizes):
        yield lo, len(sizes)


def read_tokens(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """Documents of the files; ``where`` on ``doc_id`` reaches the ORC reader and prunes."""
    rows = spark.read.schema(SCHEMA).orc(path)
    return rows if where is None else rows.where(where)


def with_start(rows: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Add ``start``: ids of all documents before the row's, from one sum per file.

    ``stored``: the files' rows, when ``rows`` derives from them; the sums then read their sizes
    alone and not what ``rows`` computes from the ids.
    """
    from pyspark.sql import Window

    # one row per file; the window sees as many rows as there are files
    sums = (rows if stored is None else stored).groupBy("part").agg(F.sum("n_tokens").alias("held"))
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("part", F.coalesce(F.sum("held").over(order), F.lit(0)).alias("base"))
    return rows.join(bases, "part").withColumn("start", F.col("base") + F.col("before")).drop("base")


def id_checksums(rows: DataFrame) -> DataFrame:
    """``(part, doc_id, before, n_tokens, ids_crc32)`` from the ids that the files hold."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<u4")).cast("B")
            at = lists.offsets.to_numpy()
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            sizes = np.diff(at).astype(np.int64)
            yield pa.record_batch(
                [batch.column("part"), batch.column("doc_id"), batch.column("before"), pa.array(sizes), pa.array(crc, pa.int64())],
                names=["part", "doc_id", "before", "n_tokens", "ids_crc32"],
            )

    return rows.select("part", "doc_id", "before", "ids").transform(map_arrow, sums, "part int, doc_id long, before long, n_tokens long, ids_crc32 long")
