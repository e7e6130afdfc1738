"""URL filters by hash prefixes of host-suffix and path-prefix expressions.

A rule is ``host + path`` with a verdict. Each URL is expanded into the expressions that a
rule could have: the host's suffixes at label boundaries times the path's prefixes. The
expressions are hashed; a short prefix of the digest is the equi-join key, the full digest
confirms a hit, and among a URL's hits the longest rule wins.

Suffixes are taken for the label counts, and prefixes for the path lengths, that occur among
the rules: any other expression can match none. Both lists are short (label counts and path
lengths of URLs), whatever the number of rules. Only DataFrame functions are used.

Defined results: a null URL, or one without ``://``, has an empty host and path and no rule;
of rules of equal length the longer host wins, then block; rows that repeat stay rows of
their own; an empty rule table leaves every URL to the default verdict; an empty input gives
no rows; columns named host, path, rule or verdict are replaced, others pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Hex digits of the join key (32 bits).
KEY_DIGITS = 8


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(rules: DataFrame) -> DataFrame:
    """``rules(host, path, verdict)`` with the digest of the expression and its short key."""
    expression = F.concat_ws(" ", "host", "path")
    return (
        rules.select(F.translate("host", UPPER, UPPER.lower()).alias("host"), "path", "verdict")
        .withColumn("rule", F.concat("host", "path"))
        .withColumn("digest", F.sha2(expression, 256))
        .withColumn("short", F.substring("digest", 1, KEY_DIGITS))
    )


def _expressions(host: Column, path: Column, labels: list[int], lengths: list[int]) -> Column:
    """Every expression of a URL that a rule could equal; null elements do not fit it."""
    has = F.length(host) - F.length(F.replace(host, F.lit("."))) + 1
    size = F.length(path)
    found = [
        F.when((has >= k) & (size >= n) & (host != ""), F.concat_ws(" ", F.substring_index(host, ".", -k), F.substring(path, 1, n)))
        for k in labels
        for n in lengths
    ]
    return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to ``pages(url, ...)``."""
    table = rule_table(rules)
    forms = table.agg(
        F.sort_array(F.collect_set(F.size(F.split("host", r"\.")))).alias("labels"),
        F.sort_array(F.collect_set(F.length("path"))).alias("lengths"),
    ).first()
    rows = pages.drop("rule", "verdict").withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url"))).withColumn("_row", F.monotonically_increasing_id())
    spread = rows.withColumn("_expr", F.explode_outer(_expressions(F.col("host"), F.col("path"), forms["labels"], forms["lengths"])))
    spread = spread.withColumn("_digest", F.sha2("_expr", 256)).withColumn("_short", F.substring("_digest", 1, KEY_DIGITS))
    r = table.select(
        F.col("short").alias("_r_short"),
        F.col("digest").alias("_r_digest"),
        F.struct(
            F.length("rule").alias("size"),
            F.length("host").alias("host_size"),
            (F.col("verdict") == "block").alias("block"),
            F.col("rule"),
            F.col("verdict"),
        ).alias("_hit"),
    )
    # the short key finds candidates, the full digest confirms them
    joined = spread.join(r, F.col("_short") == F.col("_r_short"), "left")
    hit = F.when(F.col("_digest") == F.col("_r_digest"), F.col("_hit"))
    names = [c for c in rows.columns if c != "_row"]
    best = joined.groupBy("_row", *names).agg(F.max(hit).alias("_best"))
    return best.select(*names, F.col("_best.rule").alias("rule"), F.coalesce("_best.verdict", F.lit(default)).alias("verdict"))
