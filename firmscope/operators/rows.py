"""Table profiles, and a user's Python function over rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def profile_table(df: DataFrame) -> DataFrame:
    """One row per column: place, name, type, filled rows, all rows. One pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.array(
            *[
                F.struct(
                    F.lit(place).alias("position"),
                    F.lit(field.name).alias("column_name"),
                    F.lit(field.dataType.simpleString()).alias("column_type"),
                    F.count(F.col(f"`{field.name}`")).alias("non_null"),
                )
                for place, field in enumerate(df.schema.fields, 1)
            ]
        ).alias("columns"),
    )
    return counts.select(F.explode("columns").alias("c"), "rows").select(
        "c.*", "rows", F.lit(len(df.columns)).alias("columns")
    )


def map_rows_safe(
    df: DataFrame, function: Callable[[dict[str, Any]], Any], result: T.DataType
) -> DataFrame:
    """Call ``function`` on every row (a dict); what it raises becomes a value.

    Adds ``result`` and ``error`` (``Type: message``, null when it went well).
    Rows travel in Arrow batches; one bad row does not fail the job.
    """
    schema = T.StructType(
        [
            *df.schema.fields,
            T.StructField("result", result),
            T.StructField("error", T.StringType()),
        ]
    )
    kind = to_arrow_type(result)

    def attempt(row: dict[str, Any]) -> tuple[Any, str | None]:
        try:
            value = function(row)
            pa.scalar(value, type=kind)  # a value of the wrong type is an error too
            return value, None
        except Exception as problem:  # noqa: BLE001 - it is the result
            return None, f"{type(problem).__name__}: {problem}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [attempt(row) for row in batch.to_pylist()]
            results = pa.array([value for value, _ in done], type=kind)
            errors = pa.array([error for _, error in done], type=pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, results, errors], names=schema.names
            )

    return df.mapInArrow(run, schema)
