"""Jobs from file to file: ingest, describe, enrich with resume."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from firmscope.operators.lookup import pending
from firmscope.operators.ordered import sample_head
from firmscope.operators.rows import profile_table
from firmscope.plans.enrich import YEARS, Landed, enrich_companies, outcomes, succeeded
from firmscope.shared import stored
from firmscope.sources import tables


@dataclass(frozen=True)
class Description:
    """What ``describe_file`` reports; the tables are small or lazy."""

    size: int
    profile: DataFrame
    missing: list[str]
    sample: DataFrame


def _size(spark: SparkSession, path: str) -> int:
    """Bytes of the files under a path; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def describe_file(spark: SparkSession, path: str) -> Description:
    """Size, columns with fill, required columns that are missing, three rows."""
    table = tables.read_table(spark, path)
    missing = sorted(set(tables.REQUIRED_COLUMNS) - set(table.columns))
    return Description(
        _size(spark, path), profile_table(table), missing,
        sample_head(table, 3, *table.columns[:1]),
    )


def ingest_file(spark: SparkSession, source: str, target: str) -> None:
    tables.write_table(tables.ingest_companies(tables.read_table(spark, source)), target)


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return tables.read_table(spark, path)
    except AnalysisException as error:
        # Nothing there yet, or only the leftovers of a run that failed. Any
        # other trouble must not end in overwriting the table.
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def enrich_file(
    spark: SparkSession,
    source: str,
    target: str,
    landed: Landed,
    years: tuple[int, ...] = YEARS,
    gazetteers: tuple[DataFrame, DataFrame] | None = None,
    resume: bool = False,
    log: str | None = None,
    run: str = "run",
    at: Column | None = None,
) -> dict[str, int]:
    """Enrich a company file; with ``resume`` only what the target does not hold yet.

    New rows are appended, so what an earlier run wrote stays as it is. Returns
    how many rows this run wrote, for how many anything and a site was found
    and for how many nothing, counted while writing. ``log`` names a table that
    gets a row (run, ts, id, ok) for each of them.
    """
    companies = tables.read_companies(spark, source)
    done = _stored(spark, target) if resume else None
    left = companies if done is None else pending(companies, done)
    result = enrich_companies(left, landed, years, gazetteers)
    if log:
        result = stored(result, "enriched")  # the target and the log tell of the same rows
    seen = Observation("enriched")
    counted = result.observe(
        seen,
        F.count(F.lit(1)).alias("processed"),
        F.count_if(succeeded(years)).alias("successful"),
        F.count_if(~succeeded(years)).alias("failed"),
        F.count_if(F.col("company_url") != "").alias("with_site"),
    )
    tables.write_table(counted, target, mode="overwrite" if done is None else "append")
    if log:
        outcomes(result, run, F.current_timestamp() if at is None else at, years).write.mode(
            "append"
        ).parquet(log)
    return dict(seen.get)
