"""Readers for the input tables and for a generic change-data source (A1, A10)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables; Catalyst prunes columns and pushes filters."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_source(spark: SparkSession, fmt: str, path: str | None = None, schema=None, **options) -> DataFrame:
    """A source table in any batch format Spark reads (parquet, orc, json, jdbc, ...).

    For JDBC pass ``url``, ``dbtable`` and, for a parallel read, ``partitionColumn``,
    ``lowerBound``, ``upperBound`` and ``numPartitions``; the watermark ``where`` is pushed
    into the database query by Spark. Source and target are separate parameters (A10).
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path is not None else reader.load()
