"""Storage: run buffers, dead letters, ledger events and the partitioned reporting table.

All state lives under one root in the shared filesystem (the cluster's checkpoint dir,
HDFS...). Buffers are only ever written into new folders; an attempt becomes visible through
a ledger event written last, so a job that dies half-way leaves unreferenced folders and
nothing half-visible (T22). Tables are plain Parquet or JSON folders with a partition column.

Layout under ``root``::

    staging_rows/run=r<h>/attempt=a<n>/       A2: extracted rows, tagged with sort position
    staging_offsets/run=r<h>/attempt=a<n>/    offsets.json: one record per sorted partition (W2)
    validated_rows/run=r<h>/attempt=a<n>/     A4: the evaluated change set (valid flag, codes)
    validated_chunks/run=r<h>/attempt=a<n>/   A4: one row per chunk, empty chunks too (T9)
    dead_letter/run=r<h>/                     A6: append-only, partitioned by run
    ledger/day=<date>/<seq>.json              A9: append-only state event records
    financial_records/keys_<width>=<n>/       A7: rows of one range of keys
"""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import dedupe_changes, drop_stale

# ------------------------------------------------------------------ filesystem helpers


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    """Recursive delete through the Hadoop FileSystem API (works on any cluster FS)."""
    fs, p = _fs_path(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def has_data_file(spark: SparkSession, path: str, suffix: str) -> bool:
    """True when the folder holds any visible data file with ``suffix`` below it."""
    if not path_exists(spark, path):
        return False
    fs, p = _fs_path(spark, path)
    files = fs.listFiles(p, True)
    while files.hasNext():
        name = files.next().getPath().getName()
        if name.endswith(suffix) and not name.startswith(("_", ".")):
            return True
    return False


def has_parquet(spark: SparkSession, path: str) -> bool:
    return has_data_file(spark, path, ".parquet")


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if has_parquet(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


# Small commit records (ledger events) are JSON-lines files
# written through the Hadoop FileSystem API: no Spark job for a few rows. Each file is
# written under a hidden name, then renamed, so a reader never sees half a record; an existing
# name stops a second writer. This needs a file system with atomic rename (HDFS and alike). On an object
# store two writers could both commit: there, let one writer at a time run.
RECORD_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _json_value(v):
    if isinstance(v, _dt.datetime):
        return v.strftime("%Y-%m-%dT%H:%M:%S.%f")
    if isinstance(v, decimal.Decimal):
        return str(v)
    return v


def commit_records(spark: SparkSession, folder: str, name: str, rows: Sequence[dict]) -> None:
    jvm = spark.sparkContext._jvm
    fs, dir_p = _fs_path(spark, folder)
    fs.mkdirs(dir_p)
    final = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    if fs.exists(final):
        raise FileExistsError(f"record {folder}/{name} exists: another writer?")
    tmp = jvm.org.apache.hadoop.fs.Path(f"{folder}/_tmp-{uuid.uuid4().hex}-{name}")
    data = "\n".join(json.dumps({k: _json_value(v) for k, v in r.items()}) for r in rows) + "\n"
    out = fs.create(tmp, False)
    try:
        out.write(bytearray(data.encode("utf-8")))
    finally:
        out.close()
    if not fs.rename(tmp, final):
        fs.delete(tmp, False)
        raise FileExistsError(f"could not commit record {folder}/{name}")


def has_records(spark: SparkSession, folder: str) -> bool:
    if not path_exists(spark, folder):
        return False
    fs, p = _fs_path(spark, folder)
    return any(not st.getPath().getName().startswith(("_", ".")) for st in fs.listStatus(p))


def read_records(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """All committed record files of a folder (hidden temp files are skipped by Spark)."""
    if not has_records(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("timestampNTZFormat", RECORD_TIME_FORMAT).json(folder)


def run_folder(run_id: str) -> str:
    """A filesystem-safe, stable folder name for any run id (ids may hold ':' or '+')."""
    return "r" + hashlib.sha1(run_id.encode()).hexdigest()[:20]


# ------------------------------------------------------------------ workspace


class Workspace:
    """Paths and readers of the buffer, dead-letter and ledger datasets under one root."""

    BUFFERS = ("staging_rows", "staging_offsets", "validated_rows", "validated_chunks")

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def buffer(self, kind: str, run_id: str, attempt: str) -> str:
        return f"{self.root}/{kind}/run={run_folder(run_id)}/attempt={attempt}"

    def dataset(self, kind: str) -> str:
        return f"{self.root}/{kind}"

    @property
    def dead_letter_path(self) -> str:
        return f"{self.root}/dead_letter"

    @property
    def ledger_path(self) -> str:
        return f"{self.root}/ledger"

    def clear_run(self, run_id: str) -> None:
        """Delete every buffer folder of one run (all attempts); others untouched."""
        for kind in self.BUFFERS:
            delete_path(self.spark, f"{self.root}/{kind}/run={run_folder(run_id)}")

    def read_current(self, kind: str, schema: T.StructType, current: DataFrame, fmt: str = "parquet",
                     run_ids: Sequence[str] | None = None) -> DataFrame:
        """Rows of the current attempts only: the whole dataset semi-joined with
        ``current`` (pipeline_run_id, attempt) from the ledger, so a stale attempt left by
        a crash is never read. ``fmt='json'`` for record files (offset tables)."""
        path = self.dataset(kind)
        if not has_data_file(self.spark, path, ".json" if fmt == "json" else ".parquet"):
            return self.spark.createDataFrame([], schema)
        full = T.StructType(schema.fields + [T.StructField("run", T.StringType()), T.StructField("attempt", T.StringType())])
        reader = self.spark.read.schema(full).option("basePath", path)
        df = reader.option("timestampNTZFormat", RECORD_TIME_FORMAT).json(path) if fmt == "json" else reader.parquet(path)
        if run_ids is not None:  # partition pruning on the run folder
            df = df.where(F.col("run").isin([run_folder(r) for r in run_ids]))
        live = current.where(F.col("attempt").isNotNull()).select("pipeline_run_id", "attempt")
        return df.join(live, ["pipeline_run_id", "attempt"], "left_semi").drop("run", "attempt")


# ------------------------------------------------------------------ partitioned reporting table


def replace_partitions(rows: DataFrame, path: str, column: str, fmt: str = "parquet", **options: str) -> None:
    """Rewrite the partitions of ``path`` that ``rows`` have, by Spark's dynamic overwrite.

    ``rows`` may come from ``path`` itself. They are written beside it first: the overwrite takes
    old partitions away before it moves new ones in, and a writer that dies there leaves a whole
    copy, which ``finish_replace`` publishes. Repeating either changes nothing.
    """
    rows.write.format(fmt).options(**options).mode("overwrite").partitionBy(column).save(f"{path}_waiting")
    finish_replace(rows.sparkSession, path, rows.schema, column, fmt, **options)


def finish_replace(spark: SparkSession, path: str, schema: T.StructType, column: str, fmt: str = "parquet", **options: str) -> None:
    """Publish a complete copy that an earlier ``replace_partitions`` left; else do nothing."""
    waiting = f"{path}_waiting"
    if not path_exists(spark, f"{waiting}/_SUCCESS"):
        return
    rows = spark.read.schema(schema).format(fmt).options(**options).load(waiting)
    rows.write.format(fmt).options(**options, partitionOverwriteMode="dynamic").mode("overwrite").partitionBy(column).save(path)
    delete_path(spark, waiting)


class LayoutError(ValueError):
    """A table was opened with another width than the one it is stored in."""


#: Keys per partition and per file of a table that is opened without a width.
DEFAULT_WIDTH = 10_000_000
FILE_KEYS = 1_000_000


class RangeTable:
    """A keyed Parquet table partitioned by ranges of its integral key.

    The partition column ``keys_<width>`` holds ``key div width``, so the layout can be read off
    the folder names by any Parquet reader. For a rising key (``BIGSERIAL``) new rows land in the
    last ranges and updates of recent rows stay near them: a run rewrites some ranges, not the
    table. A range holds at most ``width`` rows, a task ``FILE_KEYS`` of them. Choose the width so
    that ``max key / width`` stays in the tens of thousands.

    An upsert joins the table with the ranges of its changes; Spark prunes the other partitions
    from the scan by that join. Single writer: the caller (the ledger) orders the loads.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: Sequence[str], width: int | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.key = list(key)
        if len(self.key) != 1 or not isinstance(schema[self.key[0]].dataType, T.IntegralType):
            raise ValueError("a range table needs one integral key")
        if width is not None and width < 1:
            raise ValueError("width must be at least 1")
        stored = self._stored_width()
        if stored is not None and width not in (None, stored):
            raise LayoutError(f"{self.path} is stored in ranges of {stored} keys, not {width}")
        self.width = stored or width or DEFAULT_WIDTH

    @property
    def column(self) -> str:
        return f"keys_{self.width}"

    def _stored_width(self) -> int | None:
        """The width in the name of any partition folder, of the table or of a waiting copy."""
        for path in (self.path, f"{self.path}_waiting"):
            if path_exists(self.spark, path):
                fs, p = _fs_path(self.spark, path)
                found = fs.listStatusIterator(p)
                while found.hasNext():
                    name = found.next().getPath().getName()
                    if name.startswith("keys_"):
                        return int(name.removeprefix("keys_").partition("=")[0])
        return None

    def _stored_schema(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(self.column, T.LongType())])

    def range_of(self) -> Column:
        """Range of a key, rounded down for negative keys too."""
        key, width = F.col(self.key[0]).cast("long"), F.lit(self.width).cast("long")
        return F.call_function("div", key - F.pmod(key, width), width)

    def _rows(self) -> DataFrame:
        """Stored rows with their range."""
        finish_replace(self.spark, self.path, self._stored_schema(), self.column)
        return read_or_empty(self.spark, self.path, self._stored_schema())

    def read(self) -> DataFrame:
        return self._rows().select(*self.schema.names)

    def touched(self, changes: DataFrame) -> DataFrame:
        """Stored rows of the ranges that ``changes`` hit; other partitions are not read.

        The ranges are one number each, as many as the table has at most.
        """
        ranges = changes.select(self.range_of().alias(self.column))
        # Spark prunes by a join only if its other side is filtered; this holds for every range
        every = F.col(self.column) >= F.lit(-(1 << 63) // self.width)
        return self._rows().join(F.broadcast(ranges.where(every).distinct()), self.column, "left_semi")

    def _merged(self, old: DataFrame, latest: DataFrame) -> DataFrame:
        """Old rows and deduplicated changes, the change winning per key; one shuffle, whose
        partitions are the files of the rewritten ranges."""
        cols = self.schema.names
        slot = F.floor(F.pmod(F.col(self.key[0]), F.lit(self.width)) / F.lit(FILE_KEYS))
        both = old.select(*cols, F.lit(0).alias("_src")).unionByName(latest.select(*cols, F.lit(1).alias("_src")))
        laid_out = both.withColumn(self.column, self.range_of()).withColumn("_slot", slot).repartition(self.column, "_slot")
        pick = Window.partitionBy(self.column, "_slot", *self.key).orderBy(F.col("_src").desc())
        return laid_out.withColumn("_rank", F.row_number().over(pick)).where(F.col("_rank") == 1).drop("_rank", "_src", "_slot")

    def upsert(
        self,
        changes: DataFrame,
        order: Sequence[str | Column] | None = None,
        on_duplicate: str = "latest",
        guard: str | None = None,
    ) -> None:
        """Apply ``changes`` (target columns plus the order columns)."""
        old = self.touched(changes)
        latest = dedupe_changes(changes, self.key, order, on_duplicate).select(*self.schema.names)
        if guard is not None:
            latest = drop_stale(old, latest, self.key, guard)
        replace_partitions(self._merged(old, latest), self.path, self.column)


def merge_into(changes: DataFrame, table: str, key: Sequence[str], order: Sequence[str | Column] | None = None,
               on_duplicate: str = "latest", guard: str | None = None) -> None:
    """M1: ``MERGE INTO table`` for catalogs with row-level operations.

    The table format finds the rows to change; nothing else is rewritten. Catalogs without it
    (plain Parquet) raise an ``UnsupportedOperationException``: use ``RangeTable`` there.
    """
    target = changes.sparkSession.table(table).columns
    latest = dedupe_changes(changes, list(key), order, on_duplicate).select(*target).alias("source")
    same = F.lit(True)
    for k in key:
        same = same & (F.col(f"source.{k}") == F.col(f"{table}.{k}"))
    merge = latest.mergeInto(table, same)
    newer = None if guard is None else F.col(f"source.{guard}") >= F.col(f"{table}.{guard}")
    merge.whenMatched(newer).updateAll().whenNotMatched().insertAll().merge()
