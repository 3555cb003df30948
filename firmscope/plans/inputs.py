"""Inputs for the registered queries, derived from the given tables.

The expressions are plain SQL that Spark and the checking engine both accept,
so the two sides start from the same rows and differ only in the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmscope.plans.enrich import Landed


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _number(key: str) -> str:
    return (
        f"CASE WHEN {key} % 7 = 3 THEN 'NI' || lpad(cast({key} AS string), 6, '0') "
        f"ELSE cast({key} AS string) END"
    )


def _padded(key: str) -> str:
    return (
        f"CASE WHEN {key} % 7 = 3 THEN 'NI' || lpad(cast({key} AS string), 6, '0') "
        f"ELSE lpad(cast({key} AS string), 8, '0') END"
    )


def _word(key: str) -> str:
    return (
        f"CASE {key} % 7 WHEN 0 THEN 'north' WHEN 1 THEN 'silver' WHEN 2 THEN 'granite' "
        "WHEN 3 THEN 'amber' WHEN 4 THEN 'cedar' WHEN 5 THEN 'falcon' ELSE 'mill' END"
    )


def _trade(key: str) -> str:
    return (
        f"CASE {key} % 5 WHEN 0 THEN 'valves' WHEN 1 THEN 'pumps' WHEN 2 THEN 'gears' "
        "WHEN 3 THEN 'tool' ELSE 'hub' END"
    )


def _name(key: str) -> str:
    return (
        f"upper({_word(key)} || ' ' || {_trade(key)}) || ' ' || cast({key} AS string) || "
        f"CASE {key} % 4 WHEN 0 THEN ' LTD' WHEN 1 THEN ' LIMITED' WHEN 2 THEN ' PLC' ELSE ' GROUP' END"
    )


def _site(key: str) -> str:
    return (
        f"'https://www.' || {_word(key)} || '-' || {_trade(key)} || cast({key} AS string) || "
        f"CASE {key} % 3 WHEN 0 THEN '.co.uk' WHEN 1 THEN '.com' ELSE '.io' END || '/'"
    )


COMPANIES = {
    "CompanyName": _name("c_custkey"),
    "CompanyNumber": _number("c_custkey"),
    "CompanyStatus": "CASE WHEN c_acctbal < 0 THEN 'Active - Proposal to Strike off' ELSE 'Active' END",
    "SICCode_SicText_1": "lpad(cast(c_custkey % 99999 AS string), 5, '0') || ' - Manufacture of ' || lower(c_mktsegment) || ', not elsewhere'",
    "SICCode_SicText_2": "CASE WHEN c_custkey % 3 = 0 THEN '46' || cast(c_nationkey AS string) || ' - Wholesale' END",
}

#: Some companies have their profile under a number that no company uses.
_PROFILED = f"CASE WHEN c_custkey % 13 = 5 THEN 'ZZ' || lpad(cast(c_custkey AS string), 6, '0') ELSE {_padded('c_custkey')} END"

PROFILES = {
    "company_number": _PROFILED,
    "company_status": "CASE WHEN c_acctbal < 0 THEN 'dissolved' ELSE 'active' END",
    "premises": "cast(c_custkey % 200 AS string)",
    "address_line_1": "lower(c_mktsegment) || ' Street'",
    "address_line_2": "CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'Unit ' || cast(c_custkey % 9 AS string) END",
    "locality": "CASE WHEN c_custkey % 11 = 0 THEN '' ELSE 'Town ' || cast(c_nationkey AS string) END",
    "region": "CASE WHEN c_custkey % 5 = 0 THEN 'West Yorkshire' END",
    "postal_code": "'LS' || cast(c_custkey % 28 AS string) || ' 1AA'",
    "country": "CASE WHEN c_custkey % 2 = 0 THEN 'England' ELSE '' END",
}

FILINGS = {
    "company_number": _padded("o_custkey"),
    "seq": "o_orderkey",
    "category": "CASE WHEN o_orderkey % 10 = 9 THEN 'confirmation-statement' ELSE 'accounts' END",
    "made_up_date": "CASE o_orderkey % 13 WHEN 12 THEN NULL WHEN 11 THEN '199' ELSE cast(cast(o_orderdate AS date) AS string) END",
    "link": "CASE WHEN o_orderkey % 17 = 16 THEN '' ELSE 'https://documents.example.org/document/D' || cast(o_orderkey AS string) END",
}

_N = "cast(o_orderkey % 997 AS string)"
_N3 = "lpad(cast(o_orderkey % 997 AS string), 3, '0')"
_XHTML = "'<html xmlns=\"http://www.w3.org/1999/xhtml\">"
DOCUMENTS = {
    "document_id": "'D' || cast(o_orderkey AS string)",
    "tagged": (
        "CASE o_orderkey % 8 "
        f"WHEN 0 THEN {_XHTML}<uk-gaap:AverageNumberOfEmployees contextRef=\"c1\">' || {_N} || '</uk-gaap:AverageNumberOfEmployees></html>' "
        f"WHEN 1 THEN {_XHTML}<p><ix:nonFraction name=\"bus:NumberOfEmployees\" scale=\"0\">' || {_N} || '</ix:nonFraction></p></html>' "
        f"WHEN 2 THEN '<xbrl xmlns:e=\"http://www.xbrl.org/uk/gaap/pt/2022-01-01\" xmlns:f=\"http://other.example.org/\"><f:EmployeesTotal>9,999</f:EmployeesTotal><e:DirectorsAndEmployees>1,' || {_N3} || '</e:DirectorsAndEmployees></xbrl>' "
        f"WHEN 3 THEN {_XHTML}<a <b <uk-gaap:TotalAssets>' || {_N} || '</uk-gaap:TotalAssets><employeestotal> ' || {_N} || ' <b>7</b></employeestotal></html>' "
        "END"
    ),
    "text": (
        "CASE o_orderkey % 8 "
        f"WHEN 4 THEN 'The average number of  employees during the year was ' || {_N} || '.' "
        f"WHEN 5 THEN 'Staff numbers: ' || {_N} || ' at ' || lower(o_orderpriority) || ' sites' "
        f"WHEN 6 THEN 'Turnover fell. Employees: ' || {_N} || ' thousand. ' || repeat('The office was kept open all year. ', 6) || 'Average number employed: ' || cast(o_orderkey % 89 + 1000 AS string) "
        f"WHEN 7 THEN CASE WHEN o_orderkey % 3 = 0 THEN 'Nobody counted who works at this place.' ELSE 'Private Limited. Employees ' || {_N} END "
        "END"
    ),
}

SEARCH_RESULTS = {
    "company_name": _name("c_custkey"),
    "rank": "rank",
    "href": (
        "CASE rank "
        f"WHEN 0 THEN CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'https://www.LinkedIn.com/company/' || {_word('c_custkey')} END "
        f"WHEN 1 THEN 'https://' || {_word('c_custkey')} || '.xyz/' "
        f"WHEN 2 THEN CASE WHEN c_custkey % 10 = 7 THEN 'http://unrelated.com/' ELSE {_site('c_custkey')} END "
        f"ELSE CASE WHEN c_custkey % 20 = 7 THEN 'http://' || {_word('c_custkey')} || '.co.uk:8080/' ELSE 'https://' || upper({_trade('c_custkey')}) || '.ORG/home' END "
        "END"
    ),
}

_ID = "cast(page_id AS string)"
_HEAD = (
    "CASE page_id % 6 "
    f"WHEN 0 THEN '<meta name=\"description\" content=\"Welcome to  page ' || {_ID} || ' &amp;amp; its long description &#0000000065; &#x00000041;\">' "
    f"WHEN 1 THEN '<meta property=\"og:title\" content=\" Title ' || {_ID} || ' \"><meta property=\"og:description\" content=\"About the maker of article ' || {_ID} || '\"><meta property=\"og:url\" content=\"\"><meta property=\"og:site_name\" content=\"Site ' || {_ID} || '\">' "
    f"WHEN 2 THEN '<script type=\"application/ld+json\">{{\"@type\": \"Organization\", \"name\": \"Maker ' || {_ID} || '\", \"url\": \"https://m' || {_ID} || '.example.com\", \"address\": {{\"streetAddress\": \"' || {_ID} || ' High St\", \"addressRegion\": \"\", \"postalCode\": \"LS1 1AA\"}}}}</script>' "
    f"WHEN 3 THEN '<meta name=\"Keywords\" content=\"valves, ,pumps ' || {_ID} || ', \"><meta name=\"description\" content=\"Too short\"><meta name=\"Description\" content=\"Home - a long enough description ' || {_ID} || '\">' "
    f"WHEN 5 THEN '<script type=\"application/ld+json\">{{\"@type\": \"Corporation\", \"name\": \"First\", \"url\": \"https://first.example.com\"}}</script><script type=\"application/ld+json\">{{broken</script><script type=\"application/ld+json\">{{\"@type\": \"Company\", \"name\": \"Second ' || {_ID} || '\", \"url\": \"\", \"telephone\": \"0113 496 0000\", \"address\": \"1 Low St\"}}</script><script type=\"application/ld+json\">{{\"@type\": \"WebSite\", \"name\": \"Other\"}}</script>' "
    "ELSE '' END"
).replace("{{", "{").replace("}}", "}")
_TAIL = (
    "CASE WHEN page_id % 4 = 1 THEN '<p>Write to noreply@p' || "
    f"{_ID} || '.example.com or sales@p' || {_ID} || '.example.com, phone 0113 496 0' || lpad(cast(page_id % 1000 AS string), 3, '0') || '</p>' "
    "WHEN page_id % 4 = 2 THEN '<h2>A second heading ' || "
    f"{_ID} || '</h2><p>Call (0113) 496000</p>' ELSE '' END"
)
PAGES = {
    "page_id": "page_id",
    "html": f"replace(replace(html, '<head>', '<head>' || {_HEAD}), '</article>', {_TAIL} || '</article>')",
}
SITE_PAGES = {
    "page_id": "page_id",
    "url": _site("page_id"),
    "html": PAGES["html"],
}

RUN_LOG = {
    "run": "cast(cast(ts AS date) AS string)",
    "ts": "ts",
    "id": "event_id",
    "ok": "event_type <> 'error'",
}

CALLS = {
    "caller": "user_id",
    "ts": "ts",
    "id": "event_id",
    "ok": "event_type <> 'error'",
    "limited": "value > 60",
}

SNAPSHOTS = {
    "prefix": "CASE event_type WHEN 'click' THEN 'ddg_search' WHEN 'view' THEN 'website_desc' WHEN 'signup' THEN 'geocode' ELSE 'ch_' || event_type END",
    "key": "cast(user_id AS string)",
    "payload": "CASE WHEN value < 8 THEN NULL ELSE props || cast(event_id AS string) END",
    "fetched_at": "ts",
}

#: Each service knows some places by another address than the registry.
KNOWN_AS = {
    "first": "CASE WHEN c_mktsegment = 'MACHINERY' THEN 'near ' || address ELSE address END",
    "second": "CASE WHEN c_acctbal < 1000 THEN 'near ' || address ELSE address END",
}

#: Answers landed before the last requests; those of some users under keys that nobody asks for.
ANSWERS = {
    "prefix": SNAPSHOTS["prefix"],
    "key": "CASE WHEN user_id % 3 = 0 THEN 'x' ELSE '' END || cast(user_id AS string)",
    "fetched_at": "ts - INTERVAL '20' DAY",
}

GAZETTEER = {
    "lat": "cast(50 + c_custkey % 9 AS string) || '.' || lpad(cast(c_custkey % 1000 AS string), 3, '0')",
    "lng": "'-' || cast(c_custkey % 4 AS string) || '.5'",
}


def columns(expressions: dict[str, str]) -> list[str]:
    return [f"{expression} AS {name}" for name, expression in expressions.items()]


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").selectExpr(*columns(COMPANIES))


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = read(spark, sf_dir, "customer").selectExpr(*columns(PROFILES))
    parts = [c for c in PROFILES if c not in ("company_number", "company_status")]
    return flat.select(
        "company_number", "company_status",
        F.struct(*parts).alias("registered_office_address"),
    )


def filings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        read(spark, sf_dir, "orders")
        .selectExpr(*columns(FILINGS))
        .withColumn("links", F.create_map(F.lit("document_metadata"), F.col("link")))
        .drop("link")
    )


def filing_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").selectExpr(*columns(DOCUMENTS)).select(
        "document_id", F.col("tagged").cast("binary").alias("content"), "text"
    )


def search_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        read(spark, sf_dir, "customer")
        .withColumn("rank", F.explode(F.sequence(F.lit(0), F.lit(3))))
        .selectExpr(*columns(SEARCH_RESULTS))
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").selectExpr(*columns(PAGES))


def site_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").selectExpr(*columns(SITE_PAGES))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").selectExpr(*columns(RUN_LOG))


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").selectExpr(*columns(CALLS))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").selectExpr(*columns(SNAPSHOTS))


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").selectExpr(*columns(ANSWERS))


def landed(spark: SparkSession, sf_dir: str) -> Landed:
    return Landed(
        profiles=profiles(spark, sf_dir),
        filings=filings(spark, sf_dir),
        filing_docs=filing_docs(spark, sf_dir),
        search_results=search_results(spark, sf_dir),
        pages=site_pages(spark, sf_dir),
    )
