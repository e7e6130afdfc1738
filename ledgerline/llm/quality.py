"""Quality rules: word statistics, repeats, and lines that many documents of a host share.

The method is cross-document line frequency. Lines are normalised (trimmed, inner white space
to one space, A-Z lower-cased) and hashed. For each host the distinct documents that hold a line are
counted; a line above the limit is removed, and a document that keeps too few of its words is
rejected. ``documents`` has no URL, so its ``source`` stands for the host.

All steps are DataFrame functions. Lines are distinct per document before the count, the
count is combined before its shuffle, and the removal joins only lines above the limit.

Defined results: a null or empty text has no word and fails the base rules; a null host is a
host of its own; rows that share a ``doc_id`` count once for a line; rows equal in ``doc_id``
and text get equal results and stay separate rows; an empty input gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import SPACE, WORD, materialise

SYMBOLS = "#*$%&|<>"
WINDOW = 5


@dataclass(frozen=True)
class Limits:
    """A line is removed when more than ``documents`` documents of the host hold it, whatever the
    host's size. A document is rejected when less than ``kept`` of its words, or fewer than
    ``words`` words, remain."""

    documents: int = 20
    kept: float = 0.3
    words: int = 10


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _words(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def _repeated(words: Column) -> Column:
    """Words inside five-word windows that occur twice or more, from the words' hashes.

    Window hashes and their positions are sorted; neighbours of equal hash are repeats. Each
    repeat covers five words from its position, and overlaps count once. The sort runs only
    where some hash occurs twice.
    """

    def windows(h: Column) -> Column:
        # the sequence is empty for fewer than five words
        at = F.when(F.size(h) >= WINDOW, F.sequence(F.lit(0), F.size(h) - WINDOW)).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))

    def covered(w: Column) -> Column:
        pairs = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def at(p: Column) -> Column:
            same = lambda i, j: F.coalesce(F.get(p, i)["h"] == F.get(p, j)["h"], F.lit(False))
            marked = F.transform(p, lambda x, i: F.when((i > 0) & same(i, F.greatest(i - 1, F.lit(0))) | same(i, i + 1), x["i"]))
            return F.sort_array(F.array_compact(marked))

        def total(s: Column) -> Column:
            gaps = F.transform(s, lambda x, i: F.least(F.coalesce(F.get(s, i + 1) - x, F.lit(WINDOW)), F.lit(WINDOW)))
            return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)

        return let(let(pairs, at), total)

    def count(w: Column) -> Column:
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(covered(w))

    return let(let(words, windows), count)


def _line(raw: Column) -> Column:
    """Normalised form of a line; empty if it has no word."""
    spaced = F.translate(raw, SPACE[1:], " " * (len(SPACE) - 1))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.trim(F.regexp_replace(F.translate(spaced, upper, upper.lower()), " {2,}", " "))


def profile(docs: DataFrame, host: str = "source") -> DataFrame:
    """Base statistics and the hashed lines of each document, one pass over the texts."""
    text = F.coalesce(F.col("text"), F.lit(""))
    hashes = F.transform(_words(text), lambda w: F.xxhash64(w))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, SPACE, "")) > 0)
    rows = docs.select(
        "doc_id",
        F.col(host).alias("host"),
        F.xxhash64(text).alias("text_hash"),
        hashes.alias("words"),
        lines.alias("lines"),
        F.length(F.translate(text, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    # each line with its words: hash and count; equal lines of a document are one entry
    line = F.transform(
        F.col("lines"), lambda x: F.struct(F.xxhash64(_line(x)).alias("line"), F.regexp_count(x, F.lit(WORD)).cast("long").alias("words"))
    )
    return rows.select(
        "doc_id",
        "host",
        "text_hash",
        F.size("words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated(F.col("words")).alias("n_repeat_words"),
        line.alias("lines"),
    )


def _frequent(rows: DataFrame, limits: Limits) -> DataFrame:
    """The lines of each document of ``profile`` that too many documents of its host hold."""
    every = rows.select("doc_id", "host", "text_hash", F.explode("lines").alias("l")).select("doc_id", "host", "text_hash", "l.line", "l.words")
    # distinct documents per host and line; partial counts before the shuffle on (host, line)
    counts = every.select("host", "line", "doc_id").distinct().groupBy("host", "line").agg(F.count("*").alias("documents"))
    f = counts.where(F.col("documents") > limits.documents).select(F.col("host").alias("_f_host"), F.col("line").alias("_f_line"))
    return every.join(f, F.col("host").eqNullSafe(F.col("_f_host")) & (F.col("line") == F.col("_f_line")))


def _same_row(a: DataFrame, b: DataFrame) -> Column:
    return F.lit(True) & a["doc_id"].eqNullSafe(b["doc_id"]) & a["host"].eqNullSafe(b["host"]) & (a["text_hash"] == b["text_hash"])


def without_frequent_lines(docs: DataFrame, host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """``docs`` with each text rebuilt without its frequent lines; other lines stay as they are."""
    rows = materialise(profile(docs, host), "quality-profile")
    cut = _frequent(rows, limits).groupBy("doc_id", "host", "text_hash").agg(F.collect_set("line").alias("_cut"))
    full = docs.withColumn("host", F.col(host)).withColumn("text_hash", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    out = full.join(cut, _same_row(full, cut), "left").select(*[full[c] for c in docs.columns], "_cut")
    kept = F.filter(F.split("text", "\n", -1), lambda x: (F.length(F.translate(x, SPACE, "")) == 0) | ~F.array_contains(F.col("_cut"), F.xxhash64(_line(x))))
    text = F.when(F.col("_cut").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    return out.withColumn("text", text).drop("_cut")


def judge(docs: DataFrame, host: str = "source", limits: Limits = Limits()) -> DataFrame:
    """Statistics, ``base_failed`` and ``kept`` of each row of ``docs(doc_id, text, host)``."""
    rows = materialise(profile(docs, host), "quality-profile")
    hit = _frequent(rows, limits)
    # rows equal in doc_id and text would add up: the words of one of them are what is removed
    copies = rows.groupBy("doc_id", "host", "text_hash").agg(F.count("*").alias("copies"))
    removed = hit.groupBy("doc_id", "host", "text_hash").agg(F.sum("words").alias("removed"))
    keys = ["doc_id", "host", "text_hash"]
    cut = removed.join(copies, _same_row(removed, copies)).select(*[removed[k] for k in keys], (F.col("removed") / F.col("copies")).cast("long").alias("n_removed_words"))
    base = rows.drop("lines")
    out = base.join(cut, _same_row(base, cut), "left").select(
        *[base[c] for c in base.columns if c not in ("host", "text_hash")], F.coalesce("n_removed_words", F.lit(0).cast("long")).alias("n_removed_words")
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    left = F.col("n_words") - F.col("n_removed_words")
    depleted = (left < limits.words) | (left < limits.kept * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & ~depleted)
