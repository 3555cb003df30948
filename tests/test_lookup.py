from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from firmscope.operators import lookup, rows
from firmscope.plans import enrich
from firmscope.sources import tables
from pyspark.sql import types as T
from tests.helpers import shuffled_columns

DOC = '<html xmlns=""><uk-gaap:EmployeesTotal>{}</uk-gaap:EmployeesTotal></html>'


@pytest.fixture(scope="module")
def landed(spark):
    address = "struct<" + ", ".join(f"{p}: string" for p in lookup_parts()) + ">"
    profiles = spark.createDataFrame(
        [("00000001", ("12", None, "", "Leeds", None, "LS1 1AA", ""))],
        f"company_number string, registered_office_address {address}",
    )

    def filing(number, seq, date, doc, category="accounts"):
        return (number, seq, category, date, {"document_metadata": f"https://x/document/{doc}"} if doc else {})

    filings = spark.createDataFrame(
        [
            filing("00000001", 1, "2024-03-31", "none"),
            filing("00000001", 2, "2024-03-31", "seven"),
            filing("00000001", 3, "2024-03-31", "nine"),
            filing("00000001", 4, "2023-03-31", "nine"),
            filing("00000001", 5, "2022-03-31", None),
            filing("00000001", 6, "2022-03-31", "nine", category="other"),
            filing("00000001", 7, "2021-03-31", "nine"),
            filing("NI123456", 1, None, "nine"),
            filing("NI123456", 2, "2022", "text"),
            *[filing("00000002", n, "2019-01-01", "nine") for n in range(20)],
            filing("00000002", 20, "2024-01-01", "nine"),
        ],
        "company_number string, seq long, category string, made_up_date string, links map<string,string>",
    )
    docs = spark.createDataFrame(
        [
            ("seven", bytearray(DOC.format(7).encode()), None),
            ("nine", bytearray(DOC.format(9).encode()), None),
            ("none", bytearray(DOC.format(0).encode()), None),
            ("text", bytearray(b"%PDF"), "Staff numbers: 22"),
            ("empty", bytearray(b""), None),
        ],
        "document_id string, content binary, text string",
    )
    hits = spark.createDataFrame(
        [
            ("ACME VALVES", 0, "https://linkedin.com/acme"),
            ("ACME VALVES", 1, "https://acme.xyz"),
            ("ACME VALVES", 2, "https://acme.com"),
            ("ACME VALVES", 3, "https://valves.com"),
            ("LATE LTD", 10, "https://late.com"),
            ("BARE CO", 0, "http://bare.co.uk/x"),
        ],
        "company_name string, rank int, href string",
    )
    pages = spark.createDataFrame(
        [
            (2, "https://acme.com", "<title>second copy</title>"),
            (1, "acme.com", "<title>first copy</title>"),
            (3, "http://bare.co.uk/x", ""),
        ],
        "page_id long, url string, html string",
    )
    return enrich.Landed(profiles, filings, docs, hits, pages)


def lookup_parts():
    from firmscope.functions.text import ADDRESS_PARTS

    return ADDRESS_PARTS


COMPANIES = [
    ("ACME VALVES", "1"), ("ACME VALVES", "1"), ("LATE LTD", "NI123456"), ("BARE CO", "2"),
    ("UNKNOWN", None), (None, "1"),
]


@pytest.fixture(scope="module")
def companies(spark):
    return spark.createDataFrame(COMPANIES, "CompanyName string, CompanyNumber string")


def test_enrich(companies, landed):
    done = enrich.enrich_companies(companies, landed)
    assert done.columns == ["CompanyName", "CompanyNumber", *tables.RESULT_COLUMNS]
    got = sorted((tuple(r) for r in done.collect()), key=str)
    counts = ("7", "9", "")
    acme = ("ACME VALVES", "1", "https://acme.com", "first copy", *counts, "")
    want = [
        acme, acme,
        ("BARE CO", "2", "http://bare.co.uk/x", "", "", "", "", ""),
        ("LATE LTD", "NI123456", "", "", "", "", "22", ""),
        (None, "1", "", "", *counts, ""),
        ("UNKNOWN", None, "", "", "", "", "", ""),
    ]
    assert got == sorted(want, key=str)


def test_enrich_with_only_what_is_needed(companies, landed):
    wanted = companies.filter("CompanyName = 'BARE CO'")
    want = enrich.attach(wanted, enrich.prepare(landed)).collect()
    assert sorted(map(str, enrich.enrich_companies(wanted, landed).collect())) == sorted(map(str, want))
    bare = enrich.narrowed(landed, companies.filter("CompanyName = 'BARE CO'"))
    assert {r.company_number for r in bare.filings.collect()} == {"00000002"}
    assert {r.company_name for r in bare.search_results.collect()} == {"BARE CO"}


def test_enrich_other_years_and_location(companies, landed, spark):
    spot = "12, Leeds, LS1 1AA"
    primary = spark.createDataFrame([("else", "1", "2", "x")], "address string, lat string, lng string, formatted string")
    fallback = spark.createDataFrame([(spot, "53.8", "-1.5", "Leeds")], primary.schema)
    done = enrich.enrich_companies(companies, landed, (2021,), (primary, fallback))
    row = done.filter("CompanyName = 'ACME VALVES'").first()
    assert row.employees_2021 == "9" and row.manufacturing_location == "53.8,-1.5 (Leeds)"
    none = enrich.enrich_companies(companies, landed, (2021,), (primary, primary))
    assert none.filter("CompanyName = 'ACME VALVES'").first().manufacturing_location == spot


def test_enrich_refuses_bad_input(companies, landed):
    with pytest.raises(ValueError, match="CompanyNumber"):
        enrich.enrich_companies(companies.drop("CompanyNumber"), landed)
    with pytest.raises(ValueError, match="description"):
        enrich.enrich_companies(companies.withColumn("description", F.lit("")), landed)


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_documents_and_pages_stay_out_of_shuffles(spark, companies, landed, threshold):
    """Whether or not a side may be broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        shuffles = shuffled_columns(enrich.enrich_companies(companies, landed))
        joined = lookup.join_documents(lookup.with_document_id(landed.filings), landed.filing_docs, F.length("text"))
        shuffles += shuffled_columns(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(shuffles) > 5
    assert not any({"content", "text", "html"} & columns for columns in shuffles)


def test_only_needed_documents_and_pages_are_read(spark, companies, landed):
    """What is not asked for is not parsed: here it could not be."""
    bad = F.raise_error(F.lit("parsed without need")).cast("string")
    lost = spark.createDataFrame([(f"lost{k}",) for k in range(50)], "document_id string")
    docs = landed.filing_docs.unionByName(lost.select("document_id", bad.cast("binary").alias("content"), bad.alias("text")))
    far = spark.createDataFrame([(k, f"http://far{k}.com") for k in range(50)], "page_id long, url string")
    pages = landed.pages.unionByName(far.withColumn("html", bad))
    more = enrich.Landed(landed.profiles, landed.filings, docs, landed.search_results, pages)
    got = enrich.enrich_companies(companies, more).collect()
    assert sorted(map(str, got)) == sorted(map(str, enrich.enrich_companies(companies, landed).collect()))


def test_join_filings_keeps_companies_without(companies, landed):
    got = lookup.join_filings(companies, landed.filings).groupBy("CompanyName").agg(
        F.count("seq").alias("n"), F.count(F.lit(1)).alias("rows")
    )
    assert {r.CompanyName: (r.n, r.rows) for r in got.collect()} == {
        "ACME VALVES": (14, 14), "LATE LTD": (2, 2), "BARE CO": (21, 21), "UNKNOWN": (0, 1),
        None: (7, 7),
    }


def test_join_profiles_never_multiplies(companies, landed):
    twice = landed.profiles.unionByName(landed.profiles)
    assert lookup.join_profiles(companies, twice).count() == len(COMPANIES)


def test_join_documents_skips_empty(landed, spark):
    asked = spark.createDataFrame([("empty",), ("nine",), ("lost",)], "document_id string")
    assert [r.document_id for r in lookup.join_documents(asked, landed.filing_docs).collect()] == ["nine"]


def test_resume(companies, spark):
    done = spark.createDataFrame([("ACME VALVES", "1"), ("UNKNOWN", None)], companies.schema)
    left = lookup.pending(companies, done)
    assert sorted(map(tuple, left.collect()), key=str) == sorted(
        [("BARE CO", "2"), ("LATE LTD", "NI123456"), (None, "1")], key=str
    )


def test_resume_loses_nothing(spark, tmp_path):
    path = str(tmp_path / "out.csv")
    given = spark.createDataFrame([(f"C{n}", str(n)) for n in range(5)], "CompanyName string, CompanyNumber string")
    tables.write_table(given.filter("CompanyNumber < 2"), path)
    left = lookup.pending(given, tables.read_companies(spark, path))
    assert left.count() == 3
    tables.write_table(left, path, mode="append")
    assert tables.read_companies(spark, path).count() == 5


def test_geocode(spark):
    asked = spark.createDataFrame(
        [(1, "1 High Street"), (2, "2 High Street"), (3, "3 High Street"), (4, "short"), (5, None)],
        "id int, address string",
    )
    schema = "address string, lat string, lng string, formatted string"
    primary = spark.createDataFrame([("1 High Street", "1", "2", "One"), ("short", "9", "9", "S")], schema)
    fallback = spark.createDataFrame(
        [("1 High Street", "8", "8", "No"), ("2 High Street", "3", "4", None)], schema
    )
    got = lookup.geocode(asked, primary, fallback)
    assert got.columns == ["id", "address", "position"]
    assert {r.id: r.position for r in got.collect()} == {
        1: "1,2 (One)", 2: "3,4 ()", 3: None, 4: None, 5: None,
    }


def test_fresh_answers(spark):
    now = datetime.datetime(2024, 1, 31)
    day = datetime.timedelta(days=1)
    snapshots = spark.createDataFrame(
        [
            ("website_desc", "a", "old", now - 6 * day),
            ("website_desc", "a", "new", now - 5 * day),
            ("website_desc", "a", "future", now + day),
            ("website_desc", "b", "expired", now - 7 * day),
            ("ddg_search", "a", "expired", now - 2 * day),
            ("geocode", "a", "kept", now - 29 * day),
            ("other", "a", "default", now - 6 * day),
            ("other", "b", "hidden", now - 3 * day),
            ("other", "b", None, now - 2 * day),
        ],
        "prefix string, key string, payload string, fetched_at timestamp_ntz",
    )
    fresh = lookup.fresh_answers(snapshots, F.lit("2024-01-31 00:00:00"))
    assert fresh.columns == ["prefix", "key", "payload", "fetched_at"]
    assert {(r.prefix, r.key): r.payload for r in fresh.collect()} == {
        ("website_desc", "a"): "new", ("geocode", "a"): "kept", ("other", "a"): "default",
    }
    misses = lookup.missing_answers(snapshots, fresh)
    assert {tuple(r) for r in misses.collect()} == {
        ("website_desc", "b"), ("ddg_search", "a"), ("other", "b"),
    }
    stats = {r.prefix: (r.entries, r.volume) for r in lookup.snapshot_stats(snapshots).collect()}
    assert stats["other"] == (3, 13)


def test_profile_table(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "`a.b` int, c string")
    got = rows.profile_table(df).orderBy("position").collect()
    assert [tuple(r) for r in got] == [(1, "a.b", "int", 2, 2, 2), (2, "c", "string", 1, 2, 2)]


def test_map_rows_safe(spark):
    def half(row):
        return 10 // row["n"]

    df = spark.createDataFrame([(0,), (5,), (None,), (3,)], "n int")
    got = {r.n: (r.result, r.error) for r in rows.map_rows_safe(df, half, T.LongType()).collect()}
    assert got[5] == (2, None) and got[3] == (3, None)
    assert got[0][0] is None and got[0][1].startswith("ZeroDivisionError")
    assert got[None][0] is None and got[None][1].startswith("TypeError")


def test_map_rows_safe_checks_the_type(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "n int, s string")
    mapped = rows.map_rows_safe(df, lambda row: row["s"] if row["n"] == 1 else 7, T.LongType())
    got = {r.n: (r.result, r.error is None) for r in mapped.collect()}
    assert got == {1: (None, False), 2: (7, True)}


def test_frequent_keys_are_split_in_the_joins(spark, landed):
    """Half of the companies are one company: Spark must split it in both joins."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.shuffle.partitions": "32",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        many = spark.range(0, 60_000, 1, 4).select(
            F.when(F.col("id") % 2 == 0, "ACME VALVES").otherwise(F.concat(F.lit("C"), "id")).alias("CompanyName"),
            F.when(F.col("id") % 2 == 0, "1").otherwise(F.col("id").cast("string")).alias("CompanyNumber"),
            F.expr("uuid()").alias("note"),
        )
        done = enrich.enrich_companies(many, landed)
        assert done.filter("employees_2024 = '7'").count() == 30_000 + 1
        done.write.format("noop").mode("overwrite").save()
        rows = done.collect()
        assert len(rows) == 60_000
        plan = done._jdf.queryExecution().executedPlan().toString()
        assert plan.split("Initial Plan")[0].count("skew=true") == 2
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_the_newest_profile_counts(spark):
    given = spark.createDataFrame([("A", "1")], "CompanyName string, CompanyNumber string")
    rows = [("00000001", status, f"2024-0{month}-01 00:00:00") for month, status in enumerate("dbeac", 1)]
    profiles = spark.createDataFrame(rows, "company_number string, company_status string, fetched_at string")
    profiles = profiles.withColumn("fetched_at", F.col("fetched_at").cast("timestamp"))
    assert lookup.join_profiles(given, profiles).first().company_status == "c"


def test_equal_ranks_pick_the_same_site(spark):
    rows = [("Acme", 0, f"https://acme.com/{k}") for k in (3, 1, 2)]
    hits = spark.createDataFrame(rows, "company_name string, rank int, href string").repartition(3)
    assert lookup.official_sites(hits).first().company_url == "https://acme.com/1"
