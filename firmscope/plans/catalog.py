"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmscope.functions import headcount as H
from firmscope.functions import markup as M
from firmscope.functions import text as X
from firmscope.functions.expr import collapse_space
from firmscope.operators import expiry, lookup, ordered, rows, shaping
from firmscope.plans import enrich, inputs
from firmscope.plans import jobs as file_jobs
from firmscope.plans import runs
from firmscope.shared import new_folder
from firmscope.sources import landed as services
from firmscope.sources import layout, tables
from firmscope.streaming import jobs, kept

Query = Callable[[SparkSession, str], DataFrame]

YEARS = (2000, 1999, 1998)
AS_OF = "2024-01-25 12:00:00"
# One token in six hours, two at most: slow enough for the events to queue.
RATE, BURST = 1 / 21_600, 2
LIMITS = {"initial": 2.0, "floor": 0.25, "ceiling": 5.0}
CHUNK = 500
REPORT_EVERY = 50

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _table(name: str, *columns: str) -> Query:
    return lambda spark, sf_dir: inputs.read(spark, sf_dir, name).select(*columns)


def _value(name: str, source: Query, key: str, result: str, value: Callable[[DataFrame], Column]):
    """Register a query that shows one computed column next to a key."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = source(spark, sf_dir)
        return df.select(key, value(df).alias(result))

    QUERIES[name] = run


# Sources and sinks

@query
def read_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "companies") + ".csv"
    tables.write_table(inputs.companies(spark, sf_dir), path)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in inputs.COMPANIES])
    return tables.read_companies(spark, path, schema)


@query
def write_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = enriched(spark, sf_dir)
    folder = new_folder(spark, "roundtrip")
    tables.write_table(done, folder + ".csv")
    again = tables.read_table(spark, folder + ".csv", done.schema)
    tables.write_table(again, folder + ".parquet")
    return tables.read_table(spark, folder + ".parquet")


@query
def append_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "appended") + ".csv"
    given = inputs.companies(spark, sf_dir)
    active = F.col("CompanyStatus") == "Active"
    tables.write_table(given.filter(active), path, mode="append")
    tables.write_table(given.filter(~active), path, mode="append")
    stored = tables.read_companies(spark, path, given.schema)
    # The same rows once more, joined in memory.
    return tables.append_rows(stored, given)


@query
def ingest_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.companies(spark, sf_dir).toDF(
        "Company Name", "CompanyNumber", "Company.Status", "SICCode-SicText_1", "SIC (second)"
    )
    path = new_folder(spark, "ingested") + ".csv"
    tables.write_table(tables.ingest_companies(raw), path)
    return tables.read_table(spark, path)


@query
def clean_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = inputs.read(spark, sf_dir, "orders").toDF(
        "order.key", "customer-key (fk)", "Order Status!", "total £", "order.date", "Priority"
    )
    return tables.clean_columns(raw).drop("order_date")


@query
def read_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = inputs.profiles(spark, sf_dir)
    answers = given.select("company_number", F.to_json(F.struct(*given.columns)).alias("payload"))
    return services.profiles(answers).select(
        "company_number", "company_status",
        F.col("registered_office_address.postal_code").alias("postal_code"),
        F.col("registered_office_address.region").alias("region"),
    )


@query
def read_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = inputs.filings(spark, sf_dir).drop("seq")
    item = F.struct(*[c for c in given.columns if c != "company_number"])
    other = F.struct(F.lit("officers").alias("category"), F.lit("x").alias("unknown_field"))
    # Each answer lists the filing and one of another category.
    payload = F.concat(
        F.lit('{"items":['), F.to_json(item), F.lit(","), F.to_json(other), F.lit("]}")
    )
    answers = given.select("company_number", payload.alias("payload"))
    return services.filings(answers).select(
        "company_number", "seq", "category", "made_up_date",
        F.col("links")["document_metadata"].alias("link"),
    )


@query
def read_search_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = inputs.search_results(spark, sf_dir)
    hit = F.to_json(F.struct("href"))
    answers = given.select(
        F.concat_ws("/", "company_name", "rank").alias("company_name"),
        F.concat(F.lit("["), hit, F.lit(","), hit, F.lit("]")).alias("payload"),
    )
    return services.search_results(answers).select("company_name", "rank", "href")


# Projections, filters, predicates

_value("normalise_company_number", inputs.companies, "CompanyName", "company_number",
       lambda df: X.pad_number(F.col("CompanyNumber")))
_value("format_address", inputs.profiles, "company_number", "address",
       lambda df: X.format_address(F.col("registered_office_address")))
_value("search_query_text", inputs.companies, "CompanyNumber", "query",
       lambda df: X.search_query(F.col("CompanyName")))
_value("company_name_tokens", inputs.companies, "CompanyNumber", "tokens",
       lambda df: F.array_join(X.name_tokens(F.col("CompanyName")), "|"))
_value("clean_site_text", _table("documents", "doc_id", "text"), "doc_id", "cleaned",
       lambda df: X.clean_site_text(F.concat(F.lit("Welcome  to "), F.col("text"))))
_value("clean_meta_text", inputs.pages, "page_id", "cleaned",
       lambda df: X.clean_meta_text(F.col("html")))


@query
def url_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = inputs.read(spark, sf_dir, "pages")
    return pages.select("page_id", "url", X.url_domain(F.col("url")).alias("domain"))


@query
def valid_business_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = inputs.search_results(spark, sf_dir)
    valid = X.is_company_domain(F.col("href"), F.col("company_name"))
    return hits.select("company_name", "rank", "href", valid.alias("valid"))


@query
def search_blacklist_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = inputs.search_results(spark, sf_dir)
    return hits.filter(X.is_candidate_link(F.col("href"))).select("company_name", "rank", "href")


@query
def normalise_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = inputs.read(spark, sf_dir, "pages")
    bare = F.when(F.col("page_id") % 2 == 0, F.regexp_replace("url", "^https?://", "")).otherwise(
        F.col("url")
    )
    return pages.select("page_id", X.with_scheme(bare).alias("url"))


@query
def filing_year_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = lookup.filings_of_years(inputs.filings(spark, sf_dir), YEARS)
    return chosen.select("company_number", "seq", "year")


@query
def filing_document_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = lookup.with_document_id(inputs.filings(spark, sf_dir))
    return named.select("company_number", "seq", "document_id")


_value("document_format", inputs.filing_docs, "document_id", "is_tagged",
       lambda df: F.coalesce(H.looks_tagged(F.col("content")), F.lit(False)))


@query
def lossy_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.read(spark, sf_dir, "documents")
    # Bytes that are not UTF-8, put around and between the real ones.
    stray = F.unhex(F.lit("FF"))
    broken = F.concat(stray, F.col("text").cast("binary"), stray, F.unhex(F.lit("C3")))
    return docs.select("doc_id", H.lossy_text(broken).alias("decoded"))


# Joins

@query
def company_profile_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = lookup.join_profiles(inputs.companies(spark, sf_dir), inputs.profiles(spark, sf_dir))
    return joined.select(
        "CompanyNumber", "company_number", "company_status",
        X.format_address(F.col("registered_office_address")).alias("address"),
    )


@query
def company_filings_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = lookup.join_filings(inputs.companies(spark, sf_dir), inputs.filings(spark, sf_dir))
    return joined.select("CompanyNumber", "company_number", "seq", "category", "made_up_date")


@query
def filing_documents_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    filings = lookup.with_document_id(inputs.filings(spark, sf_dir))
    size = F.length(F.coalesce(F.decode("content", "UTF-8"), "text")).cast("bigint")
    joined = lookup.join_documents(
        filings, inputs.filing_docs(spark, sf_dir), size.alias("size")
    )
    return joined.select("company_number", "seq", "document_id", "size")


@query
def laid_out_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies with profiles, filings and documents that lie in buckets of their keys."""
    base = new_folder(spark, "laid_out")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def laid(df: DataFrame, name: str, key: str) -> DataFrame:
        return layout.write_buckets(df, f"{base}/{name}", key, buckets)

    profiles = laid(inputs.profiles(spark, sf_dir), "profiles", "company_number")
    filings = laid(inputs.filings(spark, sf_dir), "filings", "company_number")
    docs = laid(inputs.filing_docs(spark, sf_dir), "docs", "document_id")
    known = lookup.join_profiles(inputs.companies(spark, sf_dir), profiles, laid_out=True)
    known = known.select("CompanyNumber", "company_status")
    filed = lookup.with_document_id(lookup.join_filings(known, filings, laid_out=True))
    size = F.length(F.coalesce(F.decode("content", "UTF-8"), "text")).cast("bigint")
    read = lookup.join_documents(filed, docs, size.alias("size"))
    return read.select("CompanyNumber", "company_status", "seq", "document_id", "size")


@query
def official_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = lookup.official_sites(inputs.search_results(spark, sf_dir))
    companies = inputs.companies(spark, sf_dir)
    return companies.join(
        sites, F.col("CompanyName") == F.col("company_name"), "left"
    ).select("CompanyNumber", "CompanyName", "company_url")


@query
def site_description_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.company_sites(
        inputs.search_results(spark, sf_dir), inputs.site_pages(spark, sf_dir)
    )


@query
def geocode_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    addresses = inputs.profiles(spark, sf_dir).select(
        "company_number",
        F.when(
            F.col("company_status") == "active",
            X.format_address(F.col("registered_office_address")),
        ).otherwise(F.col("registered_office_address.postal_code")).alias("address"),
    )
    return lookup.geocode(addresses, *_gazetteers(spark, sf_dir))


def _gazetteers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    customers = inputs.read(spark, sf_dir, "customer")
    flat = customers.selectExpr(
        "c_mktsegment", "c_acctbal", *inputs.columns({**inputs.PROFILES, **inputs.GAZETTEER})
    )
    address = X.join_parts([F.col(part) for part in X.ADDRESS_PARTS])
    named = flat.withColumn("address", address)

    def service(name: str, formatted: str) -> DataFrame:
        address = f"{inputs.KNOWN_AS[name]} AS address"
        return named.selectExpr(address, "lat", "lng", f"{formatted} AS formatted")

    return service("first", "upper(address)"), service("second", "locality")


@query
def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    companies = inputs.companies(spark, sf_dir).withColumn(
        "CompanyNumber",
        F.when(F.col("CompanyNumber").like("NI%"), F.lit(None)).otherwise(F.col("CompanyNumber")),
    )
    done = companies.filter("CompanyStatus = 'Active'")
    return lookup.pending(companies, done).select("CompanyName", "CompanyNumber")


# Aggregations

@query
def profile_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rows.profile_table(inputs.companies(spark, sf_dir))


@query
def headcount_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.headcount_by_year(
        inputs.filings(spark, sf_dir), inputs.filing_docs(spark, sf_dir), YEARS
    )


def _rounded(df: DataFrame) -> DataFrame:
    """Six digits; the small shift keeps exact halves at the seventh from
    rounding by the last bit of a product."""
    return df.select(
        *[
            F.round(F.col(f.name) + 1e-8, 6).alias(f.name)
            if f.dataType == T.DoubleType()
            else f.name
            for f in df.schema.fields
        ]
    )


@query
def run_progress_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(ordered.run_progress_final(inputs.run_log(spark, sf_dir)))


@query
def snapshot_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup.snapshot_stats(inputs.snapshots(spark, sf_dir))


# Order, windows, limits

@query
def chunk_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = inputs.read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"
    )
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    return ordered.chunk_rows(items, 1_000, *order).drop("l_shipdate")


@query
def checkpoint_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "chunks")
    chunked = ordered.chunk_rows(
        inputs.companies(spark, sf_dir).select("CompanyNumber", "CompanyName"),
        CHUNK, "CompanyNumber", unique=True,
    )
    ordered.write_chunks(chunked, path)
    return ordered.checkpoint_prefix(spark.read.parquet(path), 1)


@query
def run_progress_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(ordered.run_progress_running(inputs.run_log(spark, sf_dir), REPORT_EVERY))


@query
def token_bucket_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaping.token_bucket(inputs.calls(spark, sf_dir), ["caller"], "ts", "id", RATE, BURST)


@query
def token_bucket_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = inputs.calls(spark, sf_dir).withColumn("asked", F.col("id") % 4)
    return shaping.token_bucket(calls, ["caller"], "ts", "id", RATE, BURST, "asked")


@query
def token_bucket_available(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaping.tokens_available(
        inputs.calls(spark, sf_dir), ["caller"], "ts", "id", RATE,
        F.lit(AS_OF), BURST,
    )


@query
def token_bucket_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaping.full_buckets(inputs.calls(spark, sf_dir).select("caller"), RATE, BURST)


@query
def adaptive_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(
        shaping.adaptive_rate(
            inputs.calls(spark, sf_dir), ["caller"], "ts", "id", "ok", "limited", **LIMITS
        )
    )


@query
def sample_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered.sample_head(inputs.companies(spark, sf_dir), 3, "CompanyNumber")


@query
def latest_filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Ten instead of twenty, so that the limit bites in these tables.
    return lookup.latest_filings(inputs.filings(spark, sf_dir), 10).select(
        "company_number", "seq", "made_up_date"
    )


@query
def slice_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    companies = inputs.companies(spark, sf_dir).select("CompanyNumber", "CompanyName")
    return ordered.slice_rows(companies, 40, 100, "CompanyNumber")


# Pages

_value("page_title", inputs.pages, "page_id", "title", lambda df: M.page_title(F.col("html")))
_value("meta_description", inputs.pages, "page_id", "description",
       lambda df: M.meta_description(F.col("html")))
_value("meta_keywords", inputs.pages, "page_id", "keywords",
       lambda df: F.array_join(M.meta_keywords(F.col("html")), "|"))
_value("page_text", inputs.pages, "page_id", "page_text", lambda df: M.page_text(F.col("html")))
_value("first_paragraph", inputs.pages, "page_id", "paragraph",
       lambda df: M.first_paragraph(F.col("html")))
_value("headings_description", inputs.pages, "page_id", "headings",
       lambda df: M.headings_description(F.col("html")))
_value("site_description", inputs.pages, "page_id", "description",
       lambda df: M.site_description(F.col("html")))
_value("contact_email", _table("documents", "doc_id", "text"), "doc_id", "email",
       lambda df: X.business_email(F.col("text")))
_value("contact_phone", inputs.pages, "page_id", "phone",
       lambda df: X.uk_phone(M.page_text(F.col("html"))))


@query
def document_phone(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.read(spark, sf_dir, "documents")
    return docs.select("doc_id", X.uk_phone(F.col("text")).alias("phone"))


@query
def open_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = inputs.pages(spark, sf_dir).select("page_id", M.open_graph(F.col("html")).alias("og"))
    return found.select("page_id", *[F.col("og")[key].alias(key) for key in M.OPEN_GRAPH])


@query
def jsonld_organization(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = inputs.pages(spark, sf_dir).select("page_id", M.organisation(F.col("html")).alias("o"))
    return found.filter("o is not null").select("page_id", "o.*")


@query
def page_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = inputs.pages(spark, sf_dir).select("page_id", M.page_metadata(F.col("html")).alias("m"))
    company = F.col("m.company_info")
    return found.select(
        "page_id", "m.title", "m.description",
        F.array_join("m.keywords", "|").alias("keywords"),
        F.array_join(F.array_sort(F.map_keys(company)), "|").alias("company_fields"),
        company["name"].alias("company_name"),
        company["address"].alias("company_address"),
        company["og_title"].alias("og_title"),
        F.col("m.contact_info")["email"].alias("email"),
        F.col("m.contact_info")["phone"].alias("phone"),
    )


# Filings

def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.filing_docs(spark, sf_dir)
    return docs.select("document_id", H.lossy_text(F.col("content")).alias("doc"))


_value("ixbrl_tag_headcount", _tagged, "document_id", "headcount",
       lambda df: H.tag_headcount(F.col("doc")))
_value("ixbrl_regex_headcount", _tagged, "document_id", "headcount",
       lambda df: H.markup_headcount(F.col("doc")))
_value("ixbrl_namespace_headcount", _tagged, "document_id", "headcount",
       lambda df: H.namespace_headcount(F.col("doc")))
_value("ixbrl_headcount", _tagged, "document_id", "headcount",
       lambda df: H.tagged_headcount(F.col("doc")))
_value("text_headcount", inputs.filing_docs, "document_id", "headcount",
       lambda df: H.text_headcount(F.col("text")))
@query
def packed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into archives, written, read again and counted."""
    path = new_folder(spark, "archives")
    services.write_archives(inputs.filing_docs(spark, sf_dir), path, 1 << 16)
    return enrich.document_headcounts(services.packed_documents(spark.read.parquet(path)))


_value("document_headcount", inputs.filing_docs, "document_id", "headcount",
       lambda df: H.document_headcount(F.col("content"), F.col("text")))


@query
def ixbrl_numeric_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.read(spark, sf_dir, "documents")
    return docs.select("doc_id", H.numeric_value(F.col("text")).alias("number"))


@query
def headcount_context_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = inputs.filing_docs(spark, sf_dir).filter("text is not null")
    text = F.lower(collapse_space(F.col("text")))
    found = docs.select(
        "document_id", text.alias("text"), F.regexp_extract("text", r"(\d+)\D*$", 1).alias("digits")
    ).filter("digits <> ''")
    return found.select(
        "document_id", "digits", H.near_people(F.col("text"), F.col("digits")).alias("plausible")
    )


# Lookups that expire

@query
def fresh_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    fresh = lookup.fresh_answers(inputs.snapshots(spark, sf_dir), F.lit(AS_OF))
    fetched = ordered.micros(fresh, "fetched_at").alias("fetched_us")
    return fresh.select("prefix", "key", "payload", fetched)


@query
def lookup_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshots = inputs.snapshots(spark, sf_dir)
    return lookup.missing_answers(snapshots, lookup.fresh_answers(snapshots, F.lit(AS_OF)))


@query
def first_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expiry.first_requests(inputs.snapshots(spark, sf_dir), "fetched_at")


# The whole job

def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.enrich_companies(
        inputs.companies(spark, sf_dir), inputs.landed(spark, sf_dir), YEARS
    )


@query
def enrich_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched(spark, sf_dir)


@query
def enrich_with_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = enrich.enrich_companies(
        inputs.companies(spark, sf_dir), inputs.landed(spark, sf_dir), YEARS,
        _gazetteers(spark, sf_dir),
    )
    return done.select("CompanyNumber", "CompanyName", "manufacturing_location")


@query
def enrich_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first run over the active companies, a second one over what is left."""
    folder = new_folder(spark, "resumed")
    given = inputs.companies(spark, sf_dir)
    tables.write_table(given.filter("CompanyStatus = 'Active'"), f"{folder}/first.csv")
    tables.write_table(given, f"{folder}/all.csv")
    landed = inputs.landed(spark, sf_dir)
    target = f"{folder}/enriched.parquet"
    file_jobs.enrich_file(spark, f"{folder}/first.csv", target, landed, YEARS)
    file_jobs.enrich_file(spark, f"{folder}/all.csv", target, landed, YEARS, resume=True)
    return tables.read_table(spark, target)


@query
def enrich_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a file run logs about each company, and the progress report on it."""
    folder = new_folder(spark, "logged")
    tables.write_table(inputs.companies(spark, sf_dir), f"{folder}/all.csv")
    file_jobs.enrich_file(
        spark, f"{folder}/all.csv", f"{folder}/enriched.parquet", inputs.landed(spark, sf_dir),
        YEARS, log=f"{folder}/log", run="first", at=F.lit(AS_OF),
    )
    log = spark.read.parquet(f"{folder}/log")
    final = ordered.run_progress_final(log).select(F.col("run").alias("_run"), "processed", "failed")
    return log.join(final, F.col("run") == F.col("_run")).select("run", "id", "ok", "processed", "failed")


@query
def enrich_committed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs, and between them one that fails before it is committed."""
    folder = new_folder(spark, "runs")
    given = inputs.companies(spark, sf_dir)
    tables.write_table(given.filter("CompanyStatus = 'Active'"), f"{folder}/first.csv")
    tables.write_table(given, f"{folder}/all.csv")
    landed = inputs.landed(spark, sf_dir)
    at = F.lit(AS_OF)
    runs.enrich_run(spark, f"{folder}/first.csv", f"{folder}/done", landed, "first", YEARS, at=at)
    store = runs.Runs(spark, f"{folder}/done")
    store.write("lost", "enriched", store.read("enriched"))
    runs.enrich_run(spark, f"{folder}/all.csv", f"{folder}/done", landed, "second", YEARS, at=at)
    log, rows = store.read("log"), store.read("enriched")
    every = rows.agg(F.count(F.lit(1)).alias("enriched"))
    return log.select("run", "id", "ok").join(every)


# User functions

def _share(row: dict[str, Any]) -> int:
    """An ordinary row function: fails on some rows."""
    kind = row["event_type"]
    if kind == "error":
        raise ValueError(f"event {row['event_id']} failed")
    return int(row["event_id"]) // (int(row["user_id"]) % 10)


@query
def map_rows_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = inputs.read(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    mapped = rows.map_rows_safe(events, _share, T.LongType())
    # Python words a division by zero differently from version to version.
    error = F.regexp_replace("error", "^(ZeroDivisionError):.*", "$1")
    return mapped.select("event_id", "result", error.alias("error"))


# Streams, each run until nothing is left and read back

def _stream(
    spark: SparkSession, sf_dir: str, table: str, expressions: dict[str, str]
) -> DataFrame:
    schema = inputs.read(spark, sf_dir, table).schema
    # The pattern lets the table be one file or a folder of files.
    source = jobs.file_stream(spark, f"{sf_dir}/{table}.parquet*", schema)
    return source.selectExpr(*inputs.columns(expressions))


def _folders(spark: SparkSession, name: str) -> tuple[str, str, str]:
    base = new_folder(spark, name)
    return f"{base}/out", f"{base}/state", f"{base}/checkpoint"


@query
def stream_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _, checkpoint = _folders(spark, "enrich")
    companies = _stream(spark, sf_dir, "customer", inputs.COMPANIES)
    lookups = enrich.prepare(inputs.landed(spark, sf_dir), YEARS)
    jobs.enrich_stream(companies, lookups, out, checkpoint).awaitTermination()
    return jobs.read_batches(spark, out).drop("batch")


@query
def stream_kept_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lookups kept while the landed tables arrive in two parts, each read once."""
    base = new_folder(spark, "kept")
    landed = inputs.landed(spark, sf_dir)
    schemas = {name: getattr(landed, name).schema for name in kept.TABLES}
    for part in (0, 1):
        for name, key in (("filings", "seq"), ("filing_docs", "document_id"), ("search_results", "href"), ("pages", "page_id")):
            arrived = getattr(landed, name).filter(F.pmod(F.crc32(F.col(key).cast("string")), F.lit(2)) == part)
            arrived.write.mode("append").parquet(f"{base}/landing/{name}")
        kept.refresh(spark, f"{base}/landing", schemas, f"{base}/kept")
    lookups = kept.kept_lookups(spark, f"{base}/kept", YEARS)
    return enrich.attach(inputs.companies(spark, sf_dir), lookups)


@query
def stream_run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log that the callback of a stream writes, batch by batch."""
    out, log, checkpoint = _folders(spark, "logged")

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        rows = enrich.outcomes(batch, "stream", F.lit(AS_OF), YEARS)
        rows.write.mode("overwrite").parquet(f"{log}/batch={batch_id}")

    companies = _stream(spark, sf_dir, "customer", inputs.COMPANIES)
    lookups = enrich.prepare(inputs.landed(spark, sf_dir), YEARS)
    jobs.enrich_stream(companies, lookups, out, checkpoint, on_batch).awaitTermination()
    return jobs.read_batches(spark, log).select("run", "id", "ok")


@query
def stream_lookup_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = _stream(spark, sf_dir, "events", inputs.SNAPSHOTS)
    folders = _folders(spark, "requests")
    jobs.first_requests(requests, "fetched_at", *folders).awaitTermination()
    return jobs.read_batches(spark, folders[0]).select("prefix", "key", "asked_us")


@query
def stream_lookup_answered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with answers that were landed before the stream."""
    requests = _stream(spark, sf_dir, "events", inputs.SNAPSHOTS)
    folders = _folders(spark, "requests")
    answers = inputs.answers(spark, sf_dir)
    jobs.first_requests(requests, "fetched_at", *folders, answers=answers).awaitTermination()
    return jobs.read_batches(spark, folders[0]).select("prefix", "key", "asked_us")


@query
def stream_token_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, state, checkpoint = _folders(spark, "bucket")
    calls = _stream(spark, sf_dir, "events", inputs.CALLS)
    jobs.token_bucket_stream(
        calls, ["caller"], "ts", "id", RATE, BURST, out, state, checkpoint
    ).awaitTermination()
    return jobs.read_batches(spark, out).drop("batch")


@query
def stream_adaptive_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, state, checkpoint = _folders(spark, "adaptive")
    calls = _stream(spark, sf_dir, "events", inputs.CALLS)
    jobs.adaptive_rate_stream(
        calls, ["caller"], "ts", "id", "ok", "limited",
        LIMITS["initial"], LIMITS["floor"], LIMITS["ceiling"], state, checkpoint,
    ).awaitTermination()
    return _rounded(jobs.latest(jobs.read_batches(spark, state), ["caller"]))


@query
def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    folders = _folders(spark, "progress")
    log = _stream(spark, sf_dir, "events", inputs.RUN_LOG)
    jobs.progress_stream(log, *folders).awaitTermination()
    return jobs.latest(jobs.read_batches(spark, folders[0]), ["run"]).drop("last")
