"""Pack rows of a chunk into one JSON array and back.

The packed form is an export / interchange form only; typed rows stay the working form.
A chunk holds at most ``chunk_size`` rows, so ``collect_list`` per chunk is bounded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Times keep their microseconds through the round trip.
JSON_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def pack(df: DataFrame, group: Sequence[str], rows: Sequence[str], order: str) -> DataFrame:
    """One row per group with ``records``, a JSON array of the rows in ``order``."""
    item = F.struct(F.col(order).alias("_ord"), F.struct(*[F.col(c) for c in rows]).alias("r"))
    ordered = F.transform(F.array_sort(F.collect_list(item)), lambda x: x["r"])
    return df.groupBy(*group).agg(F.to_json(ordered, JSON_OPTIONS).alias("records"))


def unpack(packed: DataFrame, group: Sequence[str], schema: T.StructType) -> DataFrame:
    """The rows of each JSON array, typed by ``schema`` (nothing is inferred)."""
    rows = F.explode(F.from_json("records", T.ArrayType(schema), JSON_OPTIONS)).alias("r")
    return packed.select(*group, rows).select(*group, "r.*")
