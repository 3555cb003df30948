"""Landed tables laid out by the key that they are looked up by.

A table is written in buckets of a key, sorted in each, and registered with
Spark's catalog. Joins and groupings by the key then read the buckets as they
lie: only the other side of a join is shuffled, however wide the landed rows
are. The price is paid once, when the table lands, and one bucket is one task,
so a key that holds a large share of a table should be left to the plain joins,
which Spark can split.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def write_buckets(df: DataFrame, path: str, key: str, buckets: int, name: str | None = None) -> DataFrame:
    """Write ``df`` under ``path`` in ``buckets`` files of ``key`` and return the table.

    The name, one of its own if none is given, is how later sessions with the
    same catalog find the layout again; see ``read_buckets``.
    """
    spark = df.sparkSession
    name = name or f"landed_{uuid.uuid4().hex}"
    # One file per bucket: else every task would write as many files as there are buckets.
    rows = df.repartition(buckets, key)
    rows.write.bucketBy(buckets, key).sortBy(key).option("path", path).mode("overwrite").saveAsTable(name)
    return spark.table(name)


def read_buckets(spark: SparkSession, name: str) -> DataFrame:
    """A table that ``write_buckets`` has written under ``name``."""
    return spark.table(name)
