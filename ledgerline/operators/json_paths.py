"""What a free-form JSON column holds, by VARIANT.

Each document is parsed once into a VARIANT; objects and arrays are opened level by level, and every
path is counted by the type of its values. Counts combine map-side: the shuffle carries paths.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Nesting levels that are opened; deeper values are counted as the object or array they stand in.
DEPTH = 8


def _kind(value: Column) -> Column:
    """``object``, ``array``, ``number``, ``string``, ``boolean`` or ``null``."""
    name = F.lower(F.regexp_extract(F.schema_of_variant(value), "^[A-Za-z]+", 0))
    return F.when(name.isin("bigint", "decimal", "double", "float"), "number").when(name == "void", "null").otherwise(name)


def json_paths(docs: DataFrame, column: str, depth: int = DEPTH) -> DataFrame:
    """``(path, type, values)`` over all documents of a JSON text column.

    ``$`` is a document itself, ``$.a.b`` a key, ``[]`` the elements of an array. A text that is
    no JSON counts as path ``$`` with type ``malformed``, a null one as ``missing``.
    """
    text = F.col(column)
    level = docs.select(F.try_parse_json(text).alias("doc"), F.lit("$").alias("path"), text.isNull().alias("missing"))
    none = F.when(F.col("missing"), "missing").otherwise("malformed")
    counted = [level.select("path", F.when(F.col("doc").isNull(), none).otherwise(_kind(F.col("doc"))).alias("type"))]
    level = level.drop("missing")
    for _ in range(depth):
        inner = docs.sparkSession.tvf.variant_explode(F.col("doc").outer())
        step = F.when(F.col("key").isNull(), F.lit("[]")).otherwise(F.concat(F.lit("."), F.col("key")))
        level = level.lateralJoin(inner).select(F.col("value").alias("doc"), F.concat("path", step).alias("path"))
        counted.append(level.select("path", _kind(F.col("doc")).alias("type")))
    return functools.reduce(DataFrame.unionByName, [c.groupBy("path", "type").agg(F.count(F.lit(1)).alias("values")) for c in counted])
