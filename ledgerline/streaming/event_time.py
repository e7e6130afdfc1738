"""Event time in the stream, with the late rows as an output.

Spark's own operators drop a row whose time the watermark has passed. ``mark_late`` keeps it,
marked, so that it can be reported: the watermark is declared with ``withWatermark`` and read by a
``transformWithState`` operator whose time column is a plain copy, which Spark does not filter by.
Rows are dealt to the operator by a hash of their key, a batch of rows at a time; it keeps no state
of its own, since repeated rows are the upsert's business.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def streaming_session(spark: SparkSession) -> SparkSession:
    """A session on the same context with the state store that ``mark_late`` needs; the
    caller's own settings stay as they are."""
    own = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone", "spark.checkpoint.dir"):
        value = spark.conf.get(key, None)
        if value is not None and spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set(STATE_STORE, ROCKS_DB)
    return own


def _processor(names: list[str]):
    """Made inside a function, so that it travels to the executors by value."""
    from pyspark.sql.streaming import StatefulProcessor

    class MarkLate(StatefulProcessor):
        def init(self, handle) -> None:
            pass

        def handleInputRows(self, key, frames, timers):
            passed = timers.getCurrentWatermarkInMs() * 1000
            for frame in frames:
                late = (frame.iloc[:, len(names)] <= passed).fillna(False).astype(bool)
                rows = frame.iloc[:, : len(names)].set_axis(names, axis=1)  # Spark renames some columns
                yield rows.assign(late=late)

        def close(self) -> None:
            pass

    return MarkLate()


def mark_late(stream: DataFrame, key: Sequence[str], time: str, delay: str, shards: int = 256) -> DataFrame:
    """``stream`` with a ``late`` column: true where the watermark (``delay`` behind the newest
    time of earlier batches) has reached the row's ``time``. No row is dropped; a row without a
    time is not late.

    The stream's session needs ``ROCKS_DB`` as its state store (``streaming_session``).
    """
    clash = {"late", "_time", "_micros", "_shard"} & set(stream.columns)
    if clash:
        raise ValueError(f"the stream has columns of its own named {sorted(clash)}")
    timed = stream.withColumn("_time", F.col(time).cast("timestamp")).withWatermark("_time", delay)
    plain = timed.select(*stream.columns, F.unix_micros("_time").alias("_micros"), F.pmod(F.xxhash64(*key), F.lit(shards)).alias("_shard"))
    return plain.groupBy("_shard").transformWithStateInPandas(
        statefulProcessor=_processor(stream.columns),
        outputStructType=T.StructType([*stream.schema.fields, T.StructField("late", T.BooleanType(), False)]),
        outputMode="Append",
        timeMode="EventTime",
    )
