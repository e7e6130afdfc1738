"""Load projection of the reporting table."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.temporal import ntz
from ..schemas import FINANCIAL_RECORDS, TRANSACTION_COLUMNS


def load_projection(valid: DataFrame, loaded_at: _dt.datetime | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """The 12 target columns: typed contract columns, ``source_updated_at := updated_at``,
    and ``loaded_at`` as a run parameter (``localtimestamp()`` when not given). ``carry``
    columns (an arrival order, say) are kept after them."""
    stamp = ntz(loaded_at) if loaded_at is not None else F.localtimestamp()
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in FINANCIAL_RECORDS.fields if f.name in TRANSACTION_COLUMNS]
    return valid.select(
        *typed,
        F.col("updated_at").cast("timestamp_ntz").alias("source_updated_at"),
        stamp.alias("loaded_at"),
        *carry,
    )
