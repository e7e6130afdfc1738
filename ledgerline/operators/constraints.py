"""Table constraints as jobs: keys, references, CHECK and NOT NULL.

Each check is one aggregate or one anti-join. The referenced side of a foreign key is not
broadcast by hand: Spark broadcasts it only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and shuffles both sides otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import checkpoint_materialize


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that appear more than once, with their row count (partial aggregation)."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)


def orphans(df: DataFrame, fk: Sequence[str], ref: DataFrame, ref_key: Sequence[str]) -> DataFrame:
    """Rows whose non-null foreign key has no row in the referenced table."""
    present = F.lit(True)
    for a in fk:
        present = present & F.col(a).isNotNull()
    keys = ref.select(*[F.col(b).alias(a) for a, b in zip(fk, ref_key)]).distinct()
    return df.where(present).join(keys, list(fk), "left_anti")


#: Bits of the map of parent keys: 2 MB, whatever the tables' size.
MAP_BITS = 1 << 24
#: Keys that are broadcast at most; more are joined by a shuffle.
SMALL_ROWS = 200_000


def key_map(keys: DataFrame, slot: Column) -> DataFrame:
    """``(bucket, bits)``: the slots that ``keys`` hit, 32,768 to a row of 4 kB. The maps are
    combined on the map side, so the shuffle carries maps and no keys."""
    return keys.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))


def _bit(bits: Column, slot: Column) -> Column:
    """Whether ``slot`` is in its bucket's map."""
    place = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring(bits, F.call_function("div", place, F.lit(8)).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, F.pmod(place, F.lit(8)).cast("int")) == 1, F.lit(False))


def orphans_of_large(df: DataFrame, fk: Sequence[str], ref: DataFrame, ref_key: Sequence[str], bits: int = MAP_BITS) -> DataFrame:
    """V24 / J4 for a referenced table that is too large to broadcast; the result of ``orphans``.

    A map of the parents' hashed keys, ``bits`` long and so of a known size, settles the rows
    whose bit is not set: they are orphans for certain. Of the others only the distinct keys are
    shuffled, to be looked up exactly; what is not found there were hash collisions. Child rows
    themselves are not shuffled, so a key that a third of them share costs one row a task.
    """
    unlike = [(a, b) for a, b in zip(fk, ref_key, strict=True) if df.schema[a].dataType != ref.schema[b].dataType]
    if unlike:  # equal values of unlike types have other hashes
        raise ValueError(f"keys of different types, cast one side: {unlike}")
    present = F.lit(True)
    for a in fk:
        present = present & F.col(a).isNotNull()
    names = [f"key{i}" for i in range(len(fk))]
    slot = F.pmod(F.xxhash64(*names), F.lit(bits)) + 1
    parents = ref.select(*[F.col(b).alias(n) for b, n in zip(ref_key, names, strict=True)])
    maps = F.broadcast(key_map(parents, slot))
    children = df.where(present).select(F.struct("*").alias("row"), *[F.col(a).alias(n) for a, n in zip(fk, names, strict=True)])

    def looked_up(rows: DataFrame) -> DataFrame:
        return rows.join(maps, F.bitmap_bucket_number(slot) == F.col("bucket"), "left").withColumn("maybe", _bit(F.col("bits"), slot)).drop("bucket", "bits")

    by_chance = looked_up(children.select(*names).distinct()).where("maybe").drop("maybe").join(parents.distinct(), names, "left_anti")
    by_chance = checkpoint_materialize(by_chance.withColumn("lost", F.lit(True)))
    if by_chance.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS:
        by_chance = F.broadcast(by_chance)
    marked = looked_up(children).join(by_chance, names, "left")
    return marked.where(~F.col("maybe") | F.col("lost")).select("row.*")


@dataclass(frozen=True)
class Check:
    """A SQL CHECK: ``predicate`` must not be false. A null result passes."""

    name: str
    predicate: Column


@dataclass(frozen=True)
class NotNull:
    name: str
    column: str


@dataclass(frozen=True)
class MaxLength:
    name: str
    column: str
    limit: int


def violation_counts(df: DataFrame, checks: Sequence[Check | NotNull | MaxLength]) -> DataFrame:
    """One pass, one ``count_if`` per constraint, unpivoted to rows
    ``(constraint_name, violations)``."""
    counts = []
    for c in checks:
        if isinstance(c, Check):
            bad = c.predicate == F.lit(False)
        elif isinstance(c, NotNull):
            bad = F.col(c.column).isNull()
        else:
            bad = F.char_length(F.col(c.column)) > c.limit
        counts.append(F.count_if(F.coalesce(bad, F.lit(False))).alias(c.name))
    wide = df.agg(*counts)
    pairs = F.array(*[F.struct(F.lit(c.name).alias("constraint_name"), F.col(c.name).alias("violations")) for c in checks])
    return wide.select(F.inline(pairs))


def transaction_constraints(amount: Column | None = None) -> list[Check | NotNull | MaxLength]:
    """The DDL of the source ``transactions`` table as constraint objects."""
    amt = amount if amount is not None else F.col("amount")
    return [
        NotNull("transaction_id_not_null", "transaction_id"),
        NotNull("account_id_not_null", "account_id"),
        NotNull("category_id_not_null", "category_id"),
        NotNull("amount_not_null", "amount"),
        Check("amount_not_zero", amt != 0),
        NotNull("currency_not_null", "currency"),
        MaxLength("currency_length", "currency", 3),
        NotNull("transaction_type_not_null", "transaction_type"),
        Check("transaction_type_in", F.col("transaction_type").isin("debit", "credit")),
        MaxLength("transaction_type_length", "transaction_type", 10),
        NotNull("status_not_null", "status"),
        Check("status_in", F.col("status").isin("pending", "completed", "failed")),
        MaxLength("status_length", "status", 10),
        MaxLength("description_length", "description", 255),
        NotNull("created_at_not_null", "created_at"),
        NotNull("updated_at_not_null", "updated_at"),
    ]


def account_constraints() -> list[Check | NotNull | MaxLength]:
    """The DDL of the source ``accounts`` table."""
    return [
        *[NotNull(f"{c}_not_null", c) for c in ("account_id", "account_name", "account_type", "owner_name", "currency", "balance",
                                                "is_active", "created_at", "updated_at")],
        Check("account_type_in", F.col("account_type").isin("savings", "checking", "investment")),
        *[MaxLength(f"{c}_length", c, n) for c, n in (("account_name", 100), ("account_type", 20), ("owner_name", 100), ("currency", 3))],
    ]


def category_constraints() -> list[Check | NotNull | MaxLength]:
    """The DDL of the source ``categories`` table; the unique name is a ``duplicate_keys`` job."""
    return [
        *[NotNull(f"{c}_not_null", c) for c in ("category_id", "name", "updated_at")],
        *[MaxLength(f"{c}_length", c, n) for c, n in (("name", 50), ("description", 200))],
    ]


def reporting_constraints() -> list[Check | NotNull | MaxLength]:
    """The DDL of the reporting table ``financial_records``."""
    return [
        *[NotNull(f"{c}_not_null", c) for c in ("transaction_id", "account_id", "category_id", "amount", "currency", "transaction_type",
                                                "status", "created_at", "updated_at", "source_updated_at", "loaded_at")],
        *[MaxLength(f"{c}_length", c, n) for c, n in (("currency", 3), ("transaction_type", 10), ("status", 10), ("description", 255))],
    ]


def ledger_constraints() -> list[Check | NotNull | MaxLength]:
    """V25 / V27 over ledger rows: status set and not-null columns."""
    return [
        NotNull("pipeline_run_id_not_null", "pipeline_run_id"),
        NotNull("last_watermark_not_null", "last_watermark"),
        NotNull("status_not_null", "status"),
        Check("status_in", F.col("status").isin("running", "completed", "failed")),
    ]
