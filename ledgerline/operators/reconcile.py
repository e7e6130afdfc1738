"""Do source and target hold the same rows? Digests first, keys only where they differ.

Each side is reduced to one order-free digest per key range: the row count and two sums of row
hashes, which add up map-side, so nothing but a few numbers per range is shuffled. Only the ranges
whose digests differ are cut finer, and only the rows of the finest differing ranges are compared
one by one. On tables that agree, no row is shuffled at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys of a range on each level; each level looks only into ranges that differ on the one above.
LEVELS = (1 << 20, 1 << 10)


def _range(key: str, width: int) -> Column:
    wide, k = F.lit(width).cast("long"), F.col(key).cast("long")
    return F.call_function("div", k - F.pmod(k, wide), wide)


def _row_hash(columns: Sequence[str]) -> list[Column]:
    """Two independent hashes of a row; a null differs from every value by its own flag."""
    values = [c for name in columns for c in (F.col(name), F.col(name).isNull())]
    return [F.xxhash64(*values), F.xxhash64(F.lit(1), *values)]


def digests(rows: DataFrame, key: str, columns: Sequence[str], width: int) -> DataFrame:
    """``(range, rows, a, b)``: equal for equal sets of rows, whatever their order."""
    sums = [F.sum(h.cast("decimal(20,0)")).alias(name) for h, name in zip(_row_hash(columns), "ab", strict=True)]
    return rows.groupBy(_range(key, width).alias("range")).agg(F.count(F.lit(1)).alias("rows"), *sums)


def differing_ranges(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str], width: int) -> DataFrame:
    """Ranges whose digests differ, those of one side alone among them."""
    same = F.lit(True)
    for c in ("rows", "a", "b"):
        same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    pair = digests(left, key, columns, width).alias("l").join(digests(right, key, columns, width).alias("r"), F.col("l.range").eqNullSafe(F.col("r.range")), "full_outer")
    return pair.where(~same).select(F.coalesce("l.range", "r.range").alias("range")).distinct()


def reconcile(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str], levels: Sequence[int] = LEVELS) -> DataFrame:
    """``(key, outcome)`` of every key that is ``missing`` in ``right``, ``extra`` there, or
    ``changed``: held by both sides with other rows. ``columns`` are compared besides the key.

    The key is integral; rows with a null key are one more key. A key that stands on several rows
    is compared as a whole, by the number and the digest of its rows.
    """
    compared = [key, *columns]
    unlike = [c for c in compared if left.schema[c].dataType != right.schema[c].dataType]
    if unlike:  # equal values of unlike types have other hashes
        raise ValueError(f"columns of different types on the two sides, cast one of them: {unlike}")
    left, right = left.select(*compared), right.select(*compared)
    for width in levels:
        ranges = differing_ranges(left, right, key, columns=compared, width=width)
        inside = _range(key, width).eqNullSafe(F.col("range"))
        # neither side is broadcast by hand: the number of differing ranges is not bounded
        left, right = (side.join(ranges, inside, "left_semi") for side in (left, right))

    def per_key(rows: DataFrame) -> DataFrame:
        sums = [F.sum(h.cast("decimal(20,0)")).alias(name) for h, name in zip(_row_hash(compared), "ab", strict=True)]
        return rows.groupBy(key).agg(F.count(F.lit(1)).alias("rows"), *sums)

    pair = per_key(left).alias("l").join(per_key(right).alias("r"), F.col(f"l.{key}").eqNullSafe(F.col(f"r.{key}")), "full_outer")
    same = F.lit(True)
    for c in ("rows", "a", "b"):
        same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    outcome = F.when(F.col("r.rows").isNull(), "missing").when(F.col("l.rows").isNull(), "extra").otherwise("changed")
    return pair.where(~same).select(F.coalesce(f"l.{key}", f"r.{key}").alias(key), outcome.alias("outcome"))
