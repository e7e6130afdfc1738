"""Helpers that several operators of this folder share."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import scratch_path

#: White space of the word rule: space and U+0009 to U+000D (fixed by the contracts).
SPACE = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One given table."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back.

    The written table cuts the lineage and survives the loss of any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()

#: Rows that Spark hands a worker at a time. Texts are long: 10,000 of them, the default, are
#: some 40 MB on both sides. A session with another value keeps it.
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_DEFAULT = "10000"
BATCH_ROWS = 1000


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow``, with this package sent to the executors first.

    Functions of the package are pickled by name, so a worker must be able to import it; Spark
    sends the archive once per application.
    """
    sc = df.sparkSession.sparkContext
    if sc.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        top = os.path.dirname(package)
        archive = os.path.join(tempfile.mkdtemp(prefix="package-"), "ledgerline.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for folder, _, names in os.walk(package):
                for name in sorted(names):
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        z.write(path, os.path.relpath(path, top))
        sc.addPyFile(archive)
        _shipped.add(sc.applicationId)
    conf = df.sparkSession.conf
    if conf.get(BATCH_SETTING) == BATCH_DEFAULT:
        conf.set(BATCH_SETTING, str(BATCH_ROWS))

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        release()

    return df.mapInArrow(over, schema)


def release() -> None:
    """Give a worker's free memory back: workers live on between tasks and stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tasks_for(rows: int, per_task: int, least: int = 1) -> int:
    """Number of tasks so that each gets about ``per_task`` rows."""
    return max(least, -(-rows // per_task))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Cut a key-sorted stream of batches into one table per key.

    Holds one key's rows at a time; callers bound that by splitting large keys into tiles.
    """
    kept: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_pylist() for k in keys]
        rows = list(zip(*columns, strict=True))
        start = 0
        for i, key in enumerate(rows):
            if last is not None and key != last:
                if i > start:
                    kept.append(batch.slice(start, i - start))
                if kept:
                    yield pa.Table.from_batches(kept)
                kept, start = [], i
            last = key
        if start < len(rows):
            kept.append(batch.slice(start))
    if kept:
        yield pa.Table.from_batches(kept)


def grouped(df: DataFrame, keys: list[str], fn: Callable[[pa.Table], pa.Table | None], schema: str, n: int | None = None) -> DataFrame:
    """``fn`` once per key over Arrow tables: hash partitioning, sort, one pass."""
    parts = n or partitions(df.sparkSession)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[pa.Table] = []
        held = 0
        for table in runs(batches, keys):
            got = fn(table)
            if got is not None and got.num_rows:
                out.append(got)
                held += got.num_rows
            if held > 20_000:
                yield from pa.concat_tables(out).combine_chunks().to_batches()
                out, held = [], 0
        if out:
            yield from pa.concat_tables(out).combine_chunks().to_batches()

    return map_arrow(df.repartition(parts, *keys).sortWithinPartitions(*keys), over, schema)


def tiled(members: DataFrame, key: str, member: str, weight: str, most: int) -> DataFrame:
    """Add ``(tile_i, tile_j, home)`` so that every two members of a key meet in a tile.

    A key whose weights sum to ``most`` or less is one tile. A larger one is dealt by hash
    into b blocks, and each block goes to the b tiles ``(min(i, j), max(i, j))`` that hold
    it, so a task never gets more than two blocks.
    """
    blocks = members.groupBy(key).agg(F.ceil(F.sum(F.col(weight)) / F.lit(most)).cast("int").alias("blocks"))
    large = blocks.where("blocks > 1")
    marked = members.join(large, key, "left")
    b = F.greatest(F.col("blocks"), F.lit(1))
    home = F.pmod(F.xxhash64(F.col(member)), b).cast("int")
    other = F.explode(F.when(b > 1, F.sequence(F.lit(0), b - 1)).otherwise(F.array(F.lit(0))))
    return (
        marked.withColumn("home", F.when(b > 1, home).otherwise(F.lit(0)))
        .withColumn("other", other)
        .withColumn("tile_i", F.least("home", "other"))
        .withColumn("tile_j", F.greatest("home", "other"))
        .drop("other", "blocks")
    )


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of ``(a, b)`` edges as ``(node, root)``; root: the smallest node.

    Alternates large-star and small-star steps (Kiveris et al., 2014) until the edge set
    stops changing. A node's neighbours are never gathered: each step takes a partial
    minimum and a join, so a hot node is combined map-side and its join side can be split.
    Each round is written to the shared folder.
    """
    cur = materialise(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), f"{name}-edges"
    )
    mark = _mark(cur)
    while mark[0]:
        both = cur.select("u", "v").union(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: larger neighbours of u hang on the smallest of u's neighbourhood
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: u and its smaller neighbours hang on the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        new = (
            small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).where("u > v").distinct()
        )
        cur = materialise(new, f"{name}-round")
        after = _mark(cur)
        if after == mark:
            break
        mark = after
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
    return int(row[0]), int(row[1])
