"""Mixing sources to target weights.

Every document gets a hash-random key. Within a source the documents stand in key order: the
key space is cut into equal ranges (the keys are uniform, so the ranges are even), the sizes
of the ranges give prefix sums, and a window inside each range gives the sum before each
document. A source's budget is so many whole epochs plus a cut at an exact word.

Defined results: a null or empty text has size 0 and takes nothing; a null source is a source
of its own, after all others; rows equal in ``doc_id`` and text share what the cut leaves
them evenly; other columns pass through ``take``; an empty input gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import WORD, materialise, tasks_for

#: Rows of one key range, and the largest share a source may take of its own size.
ROWS_A_RANGE = 10_000
MOST_EPOCHS = 3
SEED = "mix-1"


def size_of(text: Column) -> Column:
    """Words of a text; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """Hex digest that orders a source's documents at random, the same way in each run."""
    return F.md5(F.concat_ws(":", F.lit(seed), doc_id.cast("string"), text))


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST_EPOCHS) -> DataFrame:
    """Target of each source from ``sizes(source, source_size)``.

    Sources by code point, null last, take the weights in turn. A source stops at ``most``
    times its size; the rest is shared again by weight. With sources ordered by cap over
    weight, the capped ones are a prefix, and one pass of running sums finds it. The windows
    see one row per source.
    """
    place = Window.orderBy(F.col("source").cast("binary").asc_nulls_last())
    turn = F.pmod(F.row_number().over(place) - 1, F.lit(len(weights)))
    w = F.element_at(F.array(*[F.lit(x).cast("long") for x in weights]), (turn + 1).cast("int"))
    rows = sizes.withColumn("w", w).withColumn("cap", F.col("source_size") * most)
    ratio = F.col("cap") / F.col("w")
    before = Window.orderBy(ratio, F.col("source").cast("binary").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    rows = rows.select(
        "*",
        F.sum("source_size").over(every).alias("total"),
        F.sum("w").over(every).alias("all_w"),
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("cap_before"),
        F.coalesce(F.sum("w").over(before), F.lit(0)).alias("w_before"),
    )
    # what is left to the sources from this one on, and their weights
    left, left_w = F.col("total") - F.col("cap_before"), F.col("all_w") - F.col("w_before")
    rows = rows.withColumn("capped", F.col("cap") * left_w <= left * F.col("w")).withColumn("left", left).withColumn("left_w", left_w)
    share = F.max(F.when(~F.col("capped"), F.col("left"))).over(every)
    share_w = F.max(F.when(~F.col("capped"), F.col("left_w"))).over(every)
    shared = share * F.col("w") / share_w
    return rows.select("source", "source_size", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(shared.cast("double")).alias("target"))


def keyed(docs: DataFrame) -> DataFrame:
    """The narrow rows all steps read, written once: ``(doc_id, source, size, key)``."""
    return materialise(
        docs.select(
            F.col("doc_id"), F.col("source"), size_of(F.col("text")).alias("size"), random_key(F.col("doc_id"), F.col("text")).alias("key")
        ),
        "mix-keys",
    )


def mix(rows: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST_EPOCHS) -> DataFrame:
    """``rows`` of ``keyed`` with ``source_size``, ``target`` and ``taken`` (words, repeats counted)."""
    ranges = tasks_for(rows.count(), ROWS_A_RANGE)
    part = (F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * ranges / F.lit(1 << 32)).cast("long")
    rows = rows.withColumn("part", part)
    # prefix sums over the ranges of each source: few rows, combined before the shuffle
    sums = rows.groupBy("source", "part").agg(F.sum("size").alias("held"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("source", "part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))
    budget = targets(sums.groupBy("source").agg(F.sum("held").alias("source_size")), weights, most)
    bases = bases.join(budget, bases["source"].eqNullSafe(budget["source"])).drop(budget["source"])
    # rows of one key are equal rows: the frame takes them together
    order = Window.partitionBy("source", "part").orderBy("key")
    rows = rows.withColumn("upto", F.sum("size").over(order)).withColumn("same", F.count("*").over(Window.partitionBy("source", "part", "key")))
    b = bases.select(F.col("source").alias("b_source"), F.col("part").alias("b_part"), "base", "source_size", "target")
    rows = rows.join(b, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("part") == F.col("b_part")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = F.floor(F.col("target")) - epochs * F.col("source_size")
    start = F.col("base") + F.col("upto") - F.col("same") * F.col("size")
    extra = F.greatest(F.lit(0), F.least(rest - start, F.col("same") * F.col("size")))
    taken = epochs * F.col("size") + F.floor(extra / F.col("same"))
    return rows.select("doc_id", "source", "key", "size", "source_size", "target", taken.cast("long").alias("taken"), epochs.alias("epochs"))


def cuts(mixed: DataFrame) -> DataFrame:
    """One row per source: whole epochs, the last key that takes more, and how much it takes."""
    more = F.col("taken") - F.col("epochs") * F.col("size")
    got = F.when(more > 0, F.struct(F.col("key"), more.alias("words")))
    return mixed.groupBy("source").agg(F.max("epochs").alias("epochs"), F.max(got).alias("cut"))


def take(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST_EPOCHS) -> DataFrame:
    """The mixed documents: a row for each epoch; the last repeat of a cut one is its first words.

    Columns and names as in ``docs``; ``n_chars``, if there, follows the text. The texts are
    not shuffled: each row compares its key with its source's cut.
    """
    # a written table of one row per source: Spark knows its size and broadcasts it if small
    per = materialise(cuts(mix(keyed(docs), weights, most)), "mix-cuts").select(F.col("source").alias("_c_source"), F.col("epochs").alias("_epochs"), F.col("cut").alias("_cut"))
    rows = docs.withColumn("_key", random_key(F.col("doc_id"), F.col("text"))).withColumn("_size", size_of(F.col("text")))
    rows = rows.join(per, rows["source"].eqNullSafe(per["_c_source"]))
    extra = (
        F.when(F.col("_cut").isNull() | (F.col("_key") > F.col("_cut.key")), F.lit(0))
        .when(F.col("_key") == F.col("_cut.key"), F.col("_cut.words"))
        .otherwise(F.col("_size"))
    )
    rows = rows.withColumn("_extra", extra)
    copies = F.when(F.col("_size") > 0, F.col("_epochs") + (F.col("_extra") > 0).cast("long")).otherwise(F.lit(0))
    rows = rows.withColumn("_copies", copies).where("_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    whole = (F.col("_copy") <= F.col("_epochs")) | (F.col("_extra") == F.col("_size"))
    lead = F.regexp_extract("text", "^[\\x20\\x09-\\x0D]*", 0)
    first = F.regexp_extract_all("text", F.lit(WORD + "[\\x20\\x09-\\x0D]*"), F.lit(0))
    prefix = F.concat(lead, F.array_join(F.slice(first, F.lit(1), F.greatest(F.col("_extra"), F.lit(1)).cast("int")), ""))
    rows = rows.withColumn("text", F.when(whole, F.col("text")).otherwise(prefix))
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return rows.select(*docs.columns)
