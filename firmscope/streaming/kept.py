"""Lookups kept up to date with a growing landing zone.

What lands is read once: a stream over each landed table turns new files into
short partial rows, which are written in one folder per micro-batch and
overwritten when a batch is repeated. Partials merge: of a company's filings
the first listed ones of every batch hold the first listed ones of all, of a
name's hits and a link's pages the least ones do, and a document's headcount
is the same whenever it is read. So a restart reads only documents, pages,
filings and hits that landed since, and the lookups are joins of short tables.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmscope.functions.headcount import document_id, filing_year
from firmscope.functions.markup import site_description
from firmscope.operators.lookup import (
    best_hits,
    latest_filings,
    official_sites,
    read_pages,
    with_page_descriptions,
)
from firmscope.plans.enrich import YEARS, Lookups, document_headcounts, pick_headcounts
from firmscope.streaming.jobs import file_stream, read_batches, write_stream

#: The kept tables, and which landed table each one is made from.
FILINGS = "company_number string, seq bigint, category string, year string, document_id string"
TABLES = {
    "filings": FILINGS,
    "filing_docs": "document_id string, headcount bigint",
    "search_results": "company_name string, rank int, href string",
    "pages": "_link string, page_id bigint, description string",
}


def _filings(batch: DataFrame) -> DataFrame:
    """The first listed filings of each company in a batch, also those without a document."""
    return latest_filings(
        batch.select(
            "company_number", F.col("seq").cast("bigint").alias("seq"), "category",
            filing_year(F.col("made_up_date")).alias("year"),
            document_id(F.col("links")).alias("document_id"),
        )
    )


def _documents(batch: DataFrame) -> DataFrame:
    return document_headcounts(batch).withColumn("headcount", F.col("headcount").cast("bigint"))


def _pages(batch: DataFrame) -> DataFrame:
    return read_pages(batch, site_description(F.col("html")))


PARTIALS = {
    "filings": _filings,
    "filing_docs": _documents,
    "search_results": best_hits,
    "pages": _pages,
}


def _missing(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def refresh(spark: SparkSession, path: str, schemas: Mapping[str, T.StructType], kept: str) -> dict[str, int]:
    """Read what landed under ``path`` since the last call into the kept tables.

    Each table lies in a Parquet folder of its name, with the columns that
    ``schemas`` says; one that has no folder yet is left for the next call. The
    result says how many rows of each were looked at.
    """
    seen = {}
    for name in TABLES:
        try:
            stream = file_stream(spark, f"{path}/{name}", schemas[name])
        except AnalysisException as error:
            if not _missing(error):
                raise
            seen[name] = 0
            continue
        query = write_stream(stream, f"{kept}/{name}", f"{kept}/_checkpoints/{name}", PARTIALS[name])
        query.awaitTermination()
        seen[name] = sum(int(progress["numInputRows"]) for progress in query.recentProgress)
    return seen


def _kept(spark: SparkSession, kept: str, name: str) -> DataFrame:
    try:
        return read_batches(spark, f"{kept}/{name}").drop("batch")
    except AnalysisException as error:
        if not _missing(error):
            raise
        return spark.createDataFrame([], TABLES[name])  # nothing has landed yet


def kept_lookups(spark: SparkSession, kept: str, years: tuple[int, ...] = YEARS) -> Lookups:
    """The lookups of everything read so far: rows as those of ``prepare``; the location stays empty."""
    listed = latest_filings(_kept(spark, kept, "filings"))
    wanted = listed.filter(F.col("year").isin(*map(str, years)) & F.col("document_id").isNotNull()).drop("category")
    by_number = pick_headcounts(wanted.join(_kept(spark, kept, "filing_docs"), "document_id", "left"), years)
    sites = official_sites(_kept(spark, kept, "search_results"))
    by_name = with_page_descriptions(sites, _kept(spark, kept, "pages"))
    return Lookups(by_number.withColumn("manufacturing_location", F.lit("")), by_name)
