"""Upsert and change application as DataFrame work.

There is no ``MERGE INTO`` on Parquet: an upsert is "latest change per key", then
``target left_anti changes`` plus the changes. The dedupe is a ``groupBy`` with
``max_by``, which combines map-side, so a key holding a third of all rows is reduced in
every map task before the shuffle instead of landing whole in one window task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    """``on_duplicate='fail'``: one key twice in one change set."""


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def latest_per_key(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str | Column],
    earliest: bool = False,
) -> DataFrame:
    """The row with the greatest ``order`` per key (the least with ``earliest``); the
    order must be unique per key.

    ``groupBy(key).agg(max_by(struct(row), struct(order)))`` — partial aggregation keeps
    hot keys cheap. ``order`` may name columns of ``df`` or be expressions over them.
    """
    key = list(key)
    rest = [c for c in df.columns if c not in key]
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    ordering = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order_cols)])
    pick = F.min_by if earliest else F.max_by
    best = pick(F.struct(*_cols(rest)), ordering).alias("_row")
    if not rest:
        return df.select(*key).distinct()
    return df.groupBy(*key).agg(best).select(*key, "_row.*").select(*df.columns)


def check_unique(df: DataFrame, key: Sequence[str], sample: int = 5) -> None:
    """Raise when a key appears twice (bounded sample to the driver)."""
    dups = df.groupBy(*key).count().where(F.col("count") > 1).limit(sample).collect()
    if dups:
        raise DuplicateKeyError(f"duplicate keys in change set: {[tuple(r)[:-1] for r in dups]}")


def dedupe_changes(
    changes: DataFrame,
    key: Sequence[str],
    order: Sequence[str | Column] | None,
    on_duplicate: str = "latest",
) -> DataFrame:
    """``'latest'`` keeps the last arrival per key (by ``order``); ``'fail'`` raises."""
    if on_duplicate == "fail":
        check_unique(changes, key)
        return changes
    if on_duplicate != "latest":
        raise ValueError(f"on_duplicate must be 'latest' or 'fail', got {on_duplicate!r}")
    if not order:
        raise ValueError("on_duplicate='latest' needs an arrival order")
    return latest_per_key(changes, key, order)


def drop_stale(target: DataFrame, changes: DataFrame, key: Sequence[str], guard: str) -> DataFrame:
    """Optional guard (not the default, T12): keep a change only when it is not older
    than the target row of its key."""
    current = target.select(*key, F.col(guard).alias("_current"))
    return (
        changes.join(current, list(key), "left")
        .where(F.col("_current").isNull() | (F.col(guard) >= F.col("_current")))
        .drop("_current")
    )


def upsert(
    target: DataFrame,
    changes: DataFrame,
    key: Sequence[str],
    order: Sequence[str | Column] | None = None,
    on_duplicate: str = "latest",
    guard: str | None = None,
) -> DataFrame:
    """Insert new keys, replace every non-key column of existing ones.

    Unconditional by default: the last arrival wins even when older (T12). Columns are
    matched by name; the result has the target's columns.
    """
    key = list(key)
    changes = dedupe_changes(changes.select(*target.columns, *[c for c in changes.columns if c not in target.columns]),
                             key, order, on_duplicate).select(*target.columns)
    if guard is not None:
        changes = drop_stale(target, changes, key, guard)
    kept = target.join(changes.select(*key), key, "left_anti")
    return kept.unionByName(changes)


def upsert_outcome(target: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """M7: per key, ``insert`` / ``update`` / ``keep`` (one full outer join on keys)."""
    key = list(key)
    t = target.select(*key).distinct().withColumn("_in_t", F.lit(True))
    c = changes.select(*key).distinct().withColumn("_in_c", F.lit(True))
    j = t.join(c, key, "full_outer")
    outcome = (
        F.when(F.col("_in_c") & F.col("_in_t"), "update").when(F.col("_in_c"), "insert").otherwise("keep")
    )
    return j.select(*key, outcome.alias("outcome"))


def insert_if_absent(target: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """``INSERT ... ON CONFLICT DO NOTHING`` — rows whose key is new, appended."""
    key = list(key)
    new = rows.select(*target.columns).join(target.select(*key), key, "left_anti")
    return target.unionByName(new)
