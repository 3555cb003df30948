"""Company tables: schemas, readers, writers, column checks."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmscope.functions.text import pad_number

REQUIRED_COLUMNS = ("CompanyName", "CompanyNumber")

# The columns an enriched table gains, '' when nothing was found.
RESULT_COLUMNS = (
    "company_url", "description", "employees_2024", "employees_2023",
    "employees_2022", "manufacturing_location",
)

COMPANY_SCHEMA = T.StructType(
    [
        T.StructField("CompanyName", T.StringType()),
        # A string: inference would read 00041424 as a number.
        T.StructField("CompanyNumber", T.StringType()),
        T.StructField("incorporation_date", T.DateType()),
        T.StructField("CompanyStatus", T.StringType()),
        *[T.StructField(f"SICCode_SicText_{n}", T.StringType()) for n in range(1, 5)],
    ]
)


def require_columns(df: DataFrame, columns: Iterable[str] = REQUIRED_COLUMNS) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return df


def clean_columns(df: DataFrame) -> DataFrame:
    """Dots, blanks and hyphens become ``_``; other special characters go."""
    names = [
        "".join(c for c in re.sub(r"[. -]", "_", name) if c.isalnum() or c == "_")
        for name in df.columns
    ]
    clashes = sorted({name for name in names if names.count(name) > 1})
    if clashes:
        raise ValueError(f"column names clash once cleaned: {', '.join(clashes)}")
    return df.toDF(*names)


def _format_of(path: str) -> str:
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if suffix not in ("csv", "parquet"):
        raise ValueError(f"unsupported file format: {path}")
    return suffix


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    line_breaks: bool = False,
) -> DataFrame:
    """Read by suffix. Without a schema every CSV column is a string.

    ``line_breaks`` allows them inside quotes; Spark then cannot split a file
    among tasks, so large tables should come in many files or without them.
    """
    if _format_of(path) == "parquet":
        return spark.read.parquet(path)
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    # Nothing between two commas is null, "" is an empty text: the null mark
    # must differ from both, or empty texts would be read as null.
    reader = reader.option("nullValue", "\u0000").option("enforceSchema", False)
    reader = reader.option("multiLine", line_breaks)
    return reader.schema(schema).csv(path) if schema else reader.csv(path)


def read_companies(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    line_breaks: bool = False,
) -> DataFrame:
    return require_columns(read_table(spark, path, schema, line_breaks))


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write by suffix. Appending adds files; what is there is never rewritten.

    In CSV an empty text is written as ``""`` and a missing one as nothing, so
    both come back as they were.
    """
    writer = df.write.mode(mode)
    if _format_of(path) == "parquet":
        writer.parquet(path)
    else:
        (
            writer.option("header", True).option("quote", '"').option("escape", '"')
            .option("emptyValue", '""').option("nullValue", "")
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(path)
        )


def append_rows(existing: DataFrame, rows: DataFrame) -> DataFrame:
    """Both tables in one, columns matched by name."""
    return existing.unionByName(rows)


def ingest_companies(raw: DataFrame) -> DataFrame:
    """Pad the number, then clean the column names (so it must be so named)."""
    require_columns(raw, ["CompanyNumber"])
    return clean_columns(raw.withColumn("CompanyNumber", pad_number(F.col("CompanyNumber"))))
