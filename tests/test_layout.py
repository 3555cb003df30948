from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from firmscope.operators import lookup
from firmscope.sources.layout import read_buckets, write_buckets
from tests.helpers import shuffled_columns
from tests.test_lookup import companies, landed  # noqa: F401


@pytest.fixture
def laid(spark, landed, tmp_path):  # noqa: F811
    keys = {"profiles": "company_number", "filings": "company_number", "filing_docs": "document_id"}
    return {name: write_buckets(getattr(landed, name), str(tmp_path / name), key, 8) for name, key in keys.items()}


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_the_landed_side_is_read_as_it_lies(spark, companies, laid, no_broadcast):  # noqa: F811
    """Only companies and ids are shuffled, never a column of a landed table."""
    profiled = lookup.join_profiles(companies, laid["profiles"], laid_out=True)
    assert shuffled_columns(profiled) and not any("registered_office_address" in c for c in shuffled_columns(profiled))
    filed = lookup.join_filings(companies, laid["filings"], laid_out=True)
    assert shuffled_columns(filed) and not any({"seq", "links"} & c for c in shuffled_columns(filed))
    ids = laid["filings"].select("seq", F.element_at(F.split(F.col("links")["document_metadata"], "/"), -1).alias("document_id"))
    read = lookup.join_documents(ids, laid["filing_docs"], F.length("text").alias("size"))
    assert shuffled_columns(read) and not any({"size", "text", "content"} & c for c in shuffled_columns(read))


def test_rows_are_those_of_the_plain_joins(companies, landed, laid):  # noqa: F811
    def rows(df):
        return sorted(str(r) for r in df.collect())

    want = lookup.join_profiles(companies, landed.profiles)
    assert rows(lookup.join_profiles(companies, laid["profiles"], laid_out=True)) == rows(want)
    columns = ["CompanyName", "CompanyNumber", "company_number", "seq", "category", "made_up_date"]
    want = lookup.join_filings(companies, landed.filings).select(columns)
    assert rows(lookup.join_filings(companies, laid["filings"], laid_out=True).select(columns)) == rows(want)


def test_a_named_layout_is_found_again(spark, landed, tmp_path, no_broadcast):  # noqa: F811
    write_buckets(landed.filings, str(tmp_path / "named"), "company_number", 4, "landed_filings_test")
    again = read_buckets(spark, "landed_filings_test")
    assert again.count() == landed.filings.count()
    assert shuffled_columns(again.groupBy("company_number").count()) == []
