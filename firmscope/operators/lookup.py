"""Joins of companies with the landed tables, and picks among their rows.

Notes on size. Everything heavy (documents, pages) is read into a short value
before a join, so only keys and short values are shuffled. Many-row sides are
either reduced to one row per key first, by aggregates that combine before the
shuffle, or stand on the side of the join that Spark can split when one key is
too frequent (left of a left join, either side of an inner join). No side is
broadcast by hint: Spark broadcasts a side when its measured size allows it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firmscope.functions.headcount import document_id, filing_year
from firmscope.operators.ordered import micros
from firmscope.operators.wanted import only_wanted
from firmscope.functions.text import (
    can_geocode,
    format_position,
    is_candidate_link,
    is_company_domain,
    pad_number,
    with_scheme,
)

FILINGS_LISTED = 20
HITS_LISTED = 10
DAY = 86_400

# How long an answer stays fresh, by kind, in seconds.
LIFETIMES = {"ddg_search": DAY, "website_desc": 7 * DAY, "geocode": 30 * DAY}
DEFAULT_LIFETIME = 7 * DAY


def one_per_key(df: DataFrame, key: str, order: Column) -> DataFrame:
    """The row with the least ``order`` for each key, combined before the shuffle."""
    rest = F.struct(*[c for c in df.columns if c != key])
    return df.groupBy(key).agg(F.min_by(rest, order).alias("_row")).select(key, "_row.*")


def splittable(lookup: DataFrame, key: str) -> DataFrame:
    """Give a lookup, grouped by ``key`` before, a join key that is a new value.

    Spark splits a frequent key of the other side only where both sides come
    straight from a shuffle. A grouped lookup would be joined as it lies; the
    equal but new key makes Spark shuffle its few short rows once more.
    """
    return lookup.withColumn(key, F.concat(F.col(key), F.lit("")))


def with_number(companies: DataFrame) -> DataFrame:
    return companies.withColumn("company_number", pad_number(F.col("CompanyNumber")))


def join_profiles(companies: DataFrame, profiles: DataFrame, laid_out: bool = False) -> DataFrame:
    """Every company, with its profile's columns (null when it has none).

    ``laid_out`` says that the profiles lie in buckets of their number, which
    are then read as they are; else Spark may split a frequent company.

    Of several profiles of a number the one fetched last counts, where the
    table says so in ``fetched_at``; else, and among equals, one picked by hash.
    """
    digest = F.xxhash64(*[c for c in profiles.columns if c != "company_number"])
    order = F.struct(digest)
    if "fetched_at" in profiles.columns:
        age = -F.coalesce(micros(profiles, "fetched_at"), F.lit(-(1 << 62)).cast("bigint"))
        order = F.struct(age, digest)
    unique = one_per_key(profiles, "company_number", order)
    if not laid_out:
        unique = splittable(unique, "company_number")
    return with_number(companies).join(unique, "company_number", "left")


def join_filings(companies: DataFrame, filings: DataFrame, laid_out: bool = False) -> DataFrame:
    """Every company with each of its filings; one row of nulls when it has none.

    An inner join plus the companies without filings, because Spark can split
    a frequent company in these two and could not in one outer join. With
    ``laid_out`` the filings lie in buckets of their number, and one outer join
    reads them once, as they are.
    """
    numbered = with_number(companies)
    if laid_out:
        return numbered.join(filings, "company_number", "left")
    matched = numbered.join(filings, "company_number")
    known = filings.select("company_number").distinct()
    unmatched = numbered.join(
        splittable(known, "company_number"), "company_number", "left_anti"
    )
    return matched.unionByName(unmatched, allowMissingColumns=True)


def latest_filings(filings: DataFrame, listed: int = FILINGS_LISTED) -> DataFrame:
    """The first accounts filings in list order, per company.

    Spark cuts each task's rows to ``listed`` per company before the shuffle.
    """
    order = Window.partitionBy("company_number").orderBy("seq")
    return (
        filings.filter(F.col("category") == "accounts")
        .withColumn("_place", F.row_number().over(order))
        .filter(F.col("_place") <= listed)
        .drop("_place")
    )


def filings_of_years(filings: DataFrame, years: tuple[int, ...]) -> DataFrame:
    year = filing_year(F.col("made_up_date"))
    return filings.withColumn("year", year).filter(
        F.col("year").isin(*[str(y) for y in years])
    )


def with_document_id(filings: DataFrame) -> DataFrame:
    return filings.withColumn("document_id", document_id(F.col("links"))).filter(
        F.col("document_id").isNotNull()
    )


def join_documents(filings: DataFrame, documents: DataFrame, *values: Column) -> DataFrame:
    """Filings with values of their documents; documents without content do not count.

    The values are worked out where the documents lie, of documents that a
    filing names, so that only they and ids are shuffled.
    """
    named = only_wanted(documents, F.col("document_id"), filings.select("document_id"))
    present = named.filter((F.octet_length("content") > 0) | (F.length("text") > 0))
    return filings.join(present.select("document_id", *values), "document_id")


def best_hits(search_results: DataFrame) -> DataFrame:
    """First acceptable hit per company name: (company_name, rank, href)."""
    acceptable = search_results.filter(
        (F.col("rank") < HITS_LISTED)
        & is_candidate_link(F.col("href"))
        & is_company_domain(F.col("href"), F.col("company_name"))
    )
    best = F.min(F.struct("rank", "href")).alias("_best")
    return acceptable.groupBy("company_name").agg(best).select("company_name", "_best.*")


def official_sites(search_results: DataFrame) -> DataFrame:
    """The site of each company name that has one: (company_name, company_url)."""
    return best_hits(search_results).select("company_name", F.col("href").alias("company_url"))


def geocode(addresses: DataFrame, primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """Adds ``position``: from the primary gazetteer, else the fallback, else null.

    Addresses that are too short are not looked up.
    """

    def positions(gazetteer: DataFrame, place: int) -> DataFrame:
        position = format_position(F.col("lat"), F.col("lng"), F.col("formatted"))
        return gazetteer.select(
            F.col("address").alias("_query"),
            F.struct(F.lit(place).alias("place"), position.alias("position")).alias("_answer"),
        ).filter(F.col("_answer.position").isNotNull())

    # One table of best answers, so that one join serves both and an address
    # that many companies share can be split.
    answers = (
        positions(primary, 0).unionByName(positions(fallback, 1))
        .groupBy("_query").agg(F.min("_answer").alias("_answer"))
    )
    query = F.when(can_geocode(F.col("address")), F.col("address"))
    return (
        addresses.withColumn("_query", query)
        .join(splittable(answers, "_query"), "_query", "left")
        .select(*addresses.columns, F.col("_answer.position").alias("position"))
    )


def join_descriptions(sites: DataFrame, pages: DataFrame, description: Column) -> DataFrame:
    """Sites with the description of their page; pages of sites are read before the join."""
    links = sites.select(with_scheme(F.col("company_url")))
    needed = only_wanted(pages, with_scheme(F.col("url")), links)
    return with_page_descriptions(sites, read_pages(needed, description))


def read_pages(pages: DataFrame, description: Column) -> DataFrame:
    """(_link, page_id, description): the first page of each link, read."""
    read = pages.select(
        with_scheme(F.col("url")).alias("_link"), "page_id", description.alias("description")
    )
    best = F.min_by(F.struct("page_id", "description"), "page_id").alias("_best")
    return read.groupBy("_link").agg(best).select("_link", "_best.*")


def with_page_descriptions(sites: DataFrame, read: DataFrame) -> DataFrame:
    """Sites with the description of their page, from pages that are read already."""
    unique = read.groupBy("_link").agg(F.min_by("description", "page_id").alias("description"))
    linked = sites.withColumn("_link", with_scheme(F.col("company_url")))
    return linked.join(splittable(unique, "_link"), "_link", "left").drop("_link")


def pending(companies: DataFrame, done: DataFrame) -> DataFrame:
    """Companies that the output does not hold yet; missing values compare equal."""
    keys = done.select("CompanyName", "CompanyNumber").distinct().alias("d")
    same = F.col("c.CompanyName").eqNullSafe(F.col("d.CompanyName")) & F.col(
        "c.CompanyNumber"
    ).eqNullSafe(F.col("d.CompanyNumber"))
    return companies.alias("c").join(keys, same, "left_anti")


# Lookups that expire

def lifetime(prefix: Column, lifetimes: Mapping[str, int], default: int) -> Column:
    seconds = F.lit(default)
    for name, value in lifetimes.items():
        seconds = F.when(prefix == name, F.lit(value)).otherwise(seconds)
    return seconds


def fresh_answers(
    snapshots: DataFrame,
    as_of: Column,
    lifetimes: Mapping[str, int] = LIFETIMES,
    default: int = DEFAULT_LIFETIME,
) -> DataFrame:
    """Latest answer per (prefix, key), if it has a payload and has not expired.

    A newer empty answer makes the key unknown again.
    """
    now = micros(snapshots, "fetched_at", as_of)
    age = now - F.col("_fetched_us")
    lived = lifetime(F.col("prefix"), lifetimes, default).cast("bigint") * 1_000_000
    newest = F.max(F.struct("_fetched_us", "payload", "fetched_at")).alias("_newest")
    return (
        snapshots.withColumn("_fetched_us", micros(snapshots, "fetched_at"))
        .filter(F.col("_fetched_us") <= now)
        .groupBy("prefix", "key").agg(newest)
        .select("prefix", "key", "_newest.*")
        .filter(F.col("payload").isNotNull() & (age < lived))
        .drop("_fetched_us")
    )


def missing_answers(requests: DataFrame, fresh: DataFrame) -> DataFrame:
    """Distinct requests (prefix, key) without a fresh answer."""
    return requests.select("prefix", "key").distinct().join(fresh, ["prefix", "key"], "left_anti")


def snapshot_stats(snapshots: DataFrame) -> DataFrame:
    """Entries and volume in bytes per prefix."""
    return snapshots.groupBy("prefix").agg(
        F.count(F.lit(1)).alias("entries"),
        F.coalesce(F.sum(F.octet_length("payload")), F.lit(0)).alias("volume"),
    )
