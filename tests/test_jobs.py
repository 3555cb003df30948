from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from firmscope.operators.ordered import run_progress_final, run_progress_running
from firmscope.plans import jobs
from firmscope.plans.enrich import document_headcounts
from firmscope.sources.landed import filing_documents
from firmscope.sources import tables
from tests.helpers import shuffled_columns
from tests.test_lookup import companies, landed  # noqa: F401


@pytest.fixture
def source(tmp_path):
    path = tmp_path / "companies.csv"
    path.write_text(
        'CompanyName,CompanyNumber\nACME VALVES,00000001\n"LATE, LTD",NI123456\nBARE CO,2\n'
    )
    return str(path)


def test_enrich_file_and_resume(spark, landed, source, tmp_path):  # noqa: F811
    target = str(tmp_path / "enriched.csv")
    done = jobs.enrich_file(spark, source, target, landed)
    assert done == {"processed": 3, "successful": 3, "failed": 0, "with_site": 2}
    first = tables.read_table(spark, target)
    assert first.columns == ["CompanyName", "CompanyNumber", *tables.RESULT_COLUMNS]
    acme = first.filter("CompanyName = 'ACME VALVES'").first()
    assert (acme.company_url, acme.employees_2024, acme.employees_2022) == ("https://acme.com", "7", "")

    with open(source, "a") as more:
        more.write("NEW CO,3\n")
    assert jobs.enrich_file(spark, source, target, landed, resume=True) == {
        "processed": 1, "successful": 0, "failed": 1, "with_site": 0
    }
    names = [r.CompanyName for r in tables.read_table(spark, target).collect()]
    assert sorted(names) == ["ACME VALVES", "BARE CO", "LATE, LTD", "NEW CO"]
    assert jobs.enrich_file(spark, source, target, landed, resume=True)["processed"] == 0


def test_resume_without_earlier_output(spark, landed, source, tmp_path):  # noqa: F811
    target = str(tmp_path / "fresh.parquet")
    assert jobs.enrich_file(spark, source, target, landed, resume=True)["processed"] == 3


def test_describe_file(spark, source, tmp_path):
    seen = jobs.describe_file(spark, source)
    assert seen.size == 78 and seen.missing == []
    assert [(r.column_name, r.non_null, r.rows) for r in seen.profile.orderBy("position").collect()] == [
        ("CompanyName", 3, 3), ("CompanyNumber", 3, 3),
    ]
    assert [r.CompanyName for r in seen.sample.collect()] == ["ACME VALVES", "BARE CO", "LATE, LTD"]
    bad = tmp_path / "bad.csv"
    bad.write_text("CompanyNumber,x y\n7,\n")
    assert jobs.describe_file(spark, str(bad)).missing == ["CompanyName"]


def test_ingest_file(spark, tmp_path):
    raw = tmp_path / "raw.csv"
    raw.write_text("Company Name,CompanyNumber,SIC.Code\nA,41424,x\n")
    jobs.ingest_file(spark, str(raw), str(tmp_path / "companies.csv"))
    row = tables.read_table(spark, str(tmp_path / "companies.csv")).first()
    assert row.asDict() == {"Company_Name": "A", "CompanyNumber": "00041424", "SIC_Code": "x"}


def test_scans_read_what_is_needed(spark, landed, tmp_path):  # noqa: F811
    from firmscope.plans.enrich import headcount_by_year

    stored = {}
    for name, df in (("filings", landed.filings), ("docs", landed.filing_docs)):
        df.write.parquet(str(tmp_path / name))
        stored[name] = spark.read.parquet(str(tmp_path / name))
    counted = headcount_by_year(stored["filings"], stored["docs"])
    plan = counted._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    # Documents once; filings for the join and, with their ids, for the bitmap.
    assert sum("content" in line for line in scans) == 1
    assert all("EqualTo(category,accounts)" in line for line in scans if "made_up_date" in line)
    assert not any({"content", "text"} & columns for columns in shuffled_columns(counted))
    assert "WindowGroupLimit" in plan


def test_run_log_feeds_the_progress_reports(spark, landed, source, tmp_path):  # noqa: F811
    log = str(tmp_path / "log")
    with open(source, "a") as more:
        more.write("NEW CO,3\n")
    for run in ("first", "second"):
        jobs.enrich_file(
            spark, source, str(tmp_path / f"{run}.parquet"), landed, log=log, run=run,
            at=F.lit("2024-01-01 10:00:00"),
        )
    rows = spark.read.parquet(log)
    assert sorted((r.run, r.id, r.ok) for r in rows.collect())[:4] == [
        ("first", "00000001", True), ("first", "2", True), ("first", "3", False), ("first", "NI123456", True),
    ]
    final = {r.run: (r.processed, r.successful, r.failed) for r in run_progress_final(rows).collect()}
    assert final == {"first": (4, 3, 1), "second": (4, 3, 1)}
    running = run_progress_running(rows, 1).filter("run = 'first'").orderBy("processed").collect()
    assert [(r.processed, r.successful) for r in running] == [(1, 1), (2, 2), (3, 2), (4, 3)]


def test_landed_documents_are_counted(spark, tmp_path):
    tagged = "<html xmlns='x'><uk-gaap:EmployeesTotal>12</uk-gaap:EmployeesTotal></html>"
    (tmp_path / "D1.xhtml").write_text(tagged)
    (tmp_path / "D2.txt").write_text("Average number of employees: 34")
    (tmp_path / "D3.pdf").write_bytes(b"%PDF-1.4 Employees: 5")
    counted = document_headcounts(filing_documents(spark, str(tmp_path)))
    assert {r.document_id: r.headcount for r in counted.collect()} == {"D1": 12, "D2": 34, "D3": None}


def test_documents_in_archives(spark, tmp_path):
    """Archives beside single files; odd names, texts, empty ones, several archives."""
    from firmscope.sources.landed import pack_documents, packed_documents

    rows = [(f"D/{k} ä.x", None if k % 3 else f"<html>{k}".encode(), f"text {k}" if k % 3 == 1 else None) for k in range(40)]
    rows += [("empty", b"", None), ("void", None, None), (None, b"x", None)]
    docs = spark.createDataFrame(rows, "document_id string, content binary, text string").coalesce(1)
    archives = pack_documents(docs, 60)
    assert archives.count() > 3
    got = {r.document_id: (bytes(r.content), r.text) for r in packed_documents(archives).collect()}
    assert got == {
        number: (text.encode() if content is None else content, None if content is not None else text)
        for number, content, text in rows
        if number and (content is not None or text is not None)
    }
    for k, row in enumerate(archives.collect()):
        (tmp_path / f"{k}.TAR").write_bytes(row.content)
    (tmp_path / "single.txt").write_text("Employees: 7")
    every = filing_documents(spark, str(tmp_path))
    assert every.count() == len(got) + 1
    assert [r.text for r in every.filter("document_id = 'single'").collect()] == ["Employees: 7"]
    (tmp_path / "broken.tar").write_bytes(b"no archive")
    with pytest.raises(Exception, match="ReadError"):
        filing_documents(spark, str(tmp_path)).count()


def test_row_groups_of_archives_are_small(spark, monkeypatch, tmp_path):
    """A reader decodes a row group's rows together, so only few archives lie in one."""
    import pyarrow.parquet as pq

    from firmscope.plans import catalog, inputs

    docs = spark.range(0, 1200, 1, 1).selectExpr("concat('D', id) document_id", "CAST(NULL AS binary) content", "concat('Employees: ', id + 1, repeat(' ', 8000)) text")
    monkeypatch.setattr(inputs, "filing_docs", lambda spark, sf_dir: docs)
    monkeypatch.setattr(catalog, "new_folder", lambda spark, name: str(tmp_path / name))
    counted = catalog.QUERIES["packed_documents"](spark, "unused")
    assert {r.document_id: r.headcount for r in counted.collect()} == {f"D{k}": k + 1 for k in range(1200)}
    (file,) = (tmp_path / "archives").glob("*.parquet")
    groups = pq.ParquetFile(file).metadata
    assert groups.num_rows > 100
    assert max(groups.row_group(k).num_rows for k in range(groups.num_row_groups)) <= 64
