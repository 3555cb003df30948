"""The whole enrichment of a company table as one lazy plan."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmscope.functions.headcount import document_headcount, document_id, filing_year
from firmscope.functions.markup import site_description
from firmscope.functions.text import format_address
from firmscope.operators.lookup import (
    geocode,
    join_descriptions,
    latest_filings,
    official_sites,
    one_per_key,
    splittable,
    with_number,
)
from firmscope.operators.wanted import bitmap, may_be_in, only_wanted, positions
from firmscope.sources.tables import require_columns

YEARS = (2024, 2023, 2022)


@dataclass(frozen=True)
class Landed:
    """The landed tables an enrichment looks things up in."""

    profiles: DataFrame
    filings: DataFrame
    filing_docs: DataFrame
    search_results: DataFrame
    pages: DataFrame


def document_headcounts(filing_docs: DataFrame) -> DataFrame:
    """(document_id, headcount): documents are read where they lie, once each.

    Not filtered by the result: Spark would read each document a second time
    for the filter, which costs far more than shuffling an id.
    """
    return filing_docs.select(
        "document_id",
        document_headcount(F.col("content"), F.col("text")).alias("headcount"),
    )


def headcount_by_year(
    filings: DataFrame, filing_docs: DataFrame, years: tuple[int, ...] = YEARS
) -> DataFrame:
    """Per company and year the first filing that yields a headcount, as text.

    One row per company that has any listed filing of those years; '' where no
    filing yields one. Only ids and numbers are shuffled, never documents, and
    only documents that a listed filing of those years names are read.
    """
    wanted = wanted_filings(filings, years)
    needed = only_wanted(filing_docs, F.col("document_id"), wanted.select("document_id"))
    counted = wanted.join(document_headcounts(needed), "document_id", "left")
    return pick_headcounts(counted, years)


def wanted_filings(filings: DataFrame, years: tuple[int, ...] = YEARS) -> DataFrame:
    """(company_number, seq, year, document_id) of the listed filings of those years that name a document."""
    # Year and id first: the shuffle that lists a company's filings then carries
    # two short texts instead of dates and link maps.
    short = filings.select(
        "company_number", "seq", "category",
        filing_year(F.col("made_up_date")).alias("year"),
        document_id(F.col("links")).alias("document_id"),
    )
    listed = latest_filings(short).filter(
        F.col("year").isin(*[str(y) for y in years]) & F.col("document_id").isNotNull()
    )
    return listed.drop("category")


def pick_headcounts(counted: DataFrame, years: tuple[int, ...] = YEARS) -> DataFrame:
    """Per company and year the headcount of the first filing that has one, as text."""
    per_year = [
        F.coalesce(
            F.min_by(
                "headcount",
                F.when((F.col("year") == str(year)) & F.col("headcount").isNotNull(), F.col("seq")),
            ).cast("string"),
            F.lit(""),
        ).alias(f"employees_{year}")
        for year in years
    ]
    return counted.groupBy("company_number").agg(*per_year)


def company_sites(search_results: DataFrame, pages: DataFrame) -> DataFrame:
    """(company_name, company_url, description) for names with an official site.

    Only pages that are some name's site are read.
    """
    sites = official_sites(search_results)
    return join_descriptions(sites, pages, site_description(F.col("html")))


def locate(profiles: DataFrame, gazetteers: tuple[DataFrame, DataFrame]) -> DataFrame:
    """(company_number, manufacturing_location): geocoded registered address, else the address."""
    address = format_address(F.col("registered_office_address")).alias("address")
    known = one_per_key(
        profiles.select("company_number", address), "company_number", F.col("address")
    )
    placed = geocode(known, *gazetteers)
    return placed.select(
        "company_number",
        F.coalesce("position", "address").alias("manufacturing_location"),
    )


def narrowed(landed: Landed, companies: DataFrame) -> Landed:
    """The landed rows that these companies may need, told where they lie.

    Of documents and pages ``headcount_by_year`` and ``company_sites`` read
    those that the remaining filings and hits name.
    """
    bits = positions(companies)
    numbers = bitmap(with_number(companies).select("company_number"), bits)
    names = bitmap(companies.select("CompanyName"), bits)
    numbered = may_be_in(F.col("company_number"), numbers, bits)
    return replace(
        landed,
        profiles=landed.profiles.filter(numbered),
        filings=landed.filings.filter(numbered),
        search_results=landed.search_results.filter(may_be_in(F.col("company_name"), names, bits)),
    )


@dataclass(frozen=True)
class Lookups:
    """Everything an enrichment adds, one row per key."""

    by_number: DataFrame
    by_name: DataFrame

    def each(self, change: Callable[[DataFrame], DataFrame]) -> Lookups:
        return Lookups(change(self.by_number), change(self.by_name))

    def for_companies(self, companies: DataFrame) -> Lookups:
        """Only what these companies may need, told where the lookups lie instead of shuffling them."""
        numbers = with_number(companies).select("company_number")
        return Lookups(
            only_wanted(self.by_number, F.col("company_number"), numbers),
            only_wanted(self.by_name, F.col("company_name"), companies.select("CompanyName")),
        )


def prepare(
    landed: Landed,
    years: tuple[int, ...] = YEARS,
    gazetteers: tuple[DataFrame, DataFrame] | None = None,
) -> Lookups:
    """Work the lookups out. The location stays empty unless gazetteers are given."""
    by_number = headcount_by_year(landed.filings, landed.filing_docs, years)
    if gazetteers is None:
        by_number = by_number.withColumn("manufacturing_location", F.lit(""))
    else:
        # Brought together before they meet the companies: one join with the
        # input per key, in which Spark can split a frequent company.
        located = locate(landed.profiles, gazetteers)
        by_number = by_number.join(located, "company_number", "full")
    return Lookups(by_number, company_sites(landed.search_results, landed.pages))


def attach(companies: DataFrame, lookups: Lookups) -> DataFrame:
    """Companies with their result columns, '' where nothing was found.

    Every lookup has one row per key, so each input row comes out exactly once
    and duplicates stay.
    """
    require_columns(companies)
    added = [c for c in lookups.by_number.columns if c != "company_number"]
    result = ["company_url", "description", *added]
    clash = sorted({*result, "company_number", "company_name"} & set(companies.columns))
    if clash:
        raise ValueError(f"input already has result columns: {', '.join(clash)}")

    by_number = splittable(lookups.by_number, "company_number")
    by_name = splittable(lookups.by_name, "company_name")
    enriched = (
        with_number(companies)
        .join(by_number, "company_number", "left")
        .join(by_name, F.col("CompanyName") == F.col("company_name"), "left")
    )
    return enriched.select(
        *companies.columns, *[F.coalesce(c, F.lit("")).alias(c) for c in result]
    )


def enrich_companies(
    companies: DataFrame,
    landed: Landed,
    years: tuple[int, ...] = YEARS,
    gazetteers: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """The whole job as one lazy plan.

    Landed rows that no company asks for are left out where they lie, before
    documents and pages are parsed; nothing of their contents is shuffled.
    """
    require_columns(companies)
    return attach(companies, prepare(narrowed(landed, companies), years, gazetteers))


def succeeded(years: tuple[int, ...] = YEARS) -> Column:
    """Whether anything was found for an enriched company."""
    found = ["company_url", "description", *(f"employees_{year}" for year in years)]
    return F.greatest(*(F.col(c) for c in (*found, "manufacturing_location"))) != ""


def outcomes(
    enriched: DataFrame, run: str, at: Column, years: tuple[int, ...] = YEARS
) -> DataFrame:
    """The run log of enriched companies: (run, ts, id, ok)."""
    return enriched.select(
        F.lit(run).alias("run"),
        at.cast("timestamp").alias("ts"),
        F.col("CompanyNumber").alias("id"),
        succeeded(years).alias("ok"),
    )
