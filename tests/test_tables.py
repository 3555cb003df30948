from __future__ import annotations

import datetime

import pytest

from firmscope.sources import landed, tables


def test_read_companies(spark, tmp_path):
    path = tmp_path / "in.CSV"
    path.write_text(
        "CompanyName,CompanyNumber,incorporation_date,CompanyStatus,SICCode_SicText_1,"
        "SICCode_SicText_2,SICCode_SicText_3,SICCode_SicText_4\n"
        '"Smith, ""Sons"" & Co",00041424,2001-02-03,Active,"1 - a, b",,"",\n'
        "Plain Ltd,NI706541,,,,,,\n"
    )
    first, second = tables.read_companies(spark, str(path), tables.COMPANY_SCHEMA).collect()
    assert first.CompanyName == 'Smith, "Sons" & Co' and first.CompanyNumber == "00041424"
    assert first.incorporation_date == datetime.date(2001, 2, 3)
    assert (first.SICCode_SicText_2, first.SICCode_SicText_3) == (None, "")
    assert second.CompanyNumber == "NI706541" and second.CompanyStatus is None


def test_line_breaks_in_quotes(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('CompanyName,CompanyNumber\n"A\nB",1\n')
    assert tables.read_companies(spark, str(path), line_breaks=True).first().CompanyName == "A\nB"


def test_required_columns_and_formats(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text("CompanyName\nA\n")
    with pytest.raises(ValueError, match="CompanyNumber"):
        tables.read_companies(spark, str(path))
    with pytest.raises(ValueError, match="format"):
        tables.read_table(spark, str(tmp_path / "in.xlsx"))
    with pytest.raises(ValueError, match="format"):
        tables.write_table(spark.range(1), str(tmp_path / "out.json"))


@pytest.mark.parametrize("suffix", ["csv", "parquet"])
def test_empty_and_missing_survive(spark, tmp_path, suffix):
    path = str(tmp_path / f"t.{suffix}")
    rows = [("a", "", None), (" lead", "trail ", 'q"u,o'), (None, None, "")]
    df = spark.createDataFrame(rows, "x string, y string, z string")
    tables.write_table(df, path)
    assert sorted(map(tuple, tables.read_table(spark, path, df.schema).collect()), key=str) == sorted(rows, key=str)


def test_append_never_rewrites(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    tables.write_table(spark.createDataFrame([("a",)], "x string"), path)
    before = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "t.csv").glob("part-*")}
    tables.write_table(spark.createDataFrame([("b",)], "x string"), path, mode="append")
    after = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "t.csv").glob("part-*")}
    assert before.items() <= after.items()
    assert sorted(r.x for r in tables.read_table(spark, path).collect()) == ["a", "b"]


def test_append_rows_matches_names(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("y", 2)], "s string, n int")
    assert sorted(map(tuple, tables.append_rows(a, b).collect())) == [(1, "x"), (2, "y")]


def test_clean_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`a.b` int, `c d-e` int, `f(g)!` int")
    assert tables.clean_columns(df).columns == ["a_b", "c_d_e", "fg"]
    with pytest.raises(ValueError, match="a_b"):
        tables.clean_columns(spark.createDataFrame([(1, 2)], "`a.b` int, `a b` int"))


def test_ingest(spark):
    df = spark.createDataFrame([(7, "x")], "CompanyNumber int, `SIC Code.1` string")
    assert tables.ingest_companies(df).first().asDict() == {"CompanyNumber": "00000007", "SIC_Code_1": "x"}
    with pytest.raises(ValueError, match="CompanyNumber"):
        tables.ingest_companies(df.withColumnRenamed("CompanyNumber", "Company Number"))


def test_landed_answers(spark):
    answers = spark.createDataFrame(
        [
            ("1", '{"items":[{"category":"accounts","links":{"document_metadata":"u"}},{"type":"AA"}]}'),
            ("2", "{}"), ("3", "not json"), ("4", None),
        ],
        "company_number string, payload string",
    )
    got = landed.filings(answers).orderBy("seq").collect()
    assert [(r.company_number, r.seq, r.category, r.type) for r in got] == [
        ("00000001", 0, "accounts", None), ("00000001", 1, None, "AA"),
    ]
    assert got[0].links == {"document_metadata": "u"}
    profiles = landed.profiles(
        spark.createDataFrame(
            [("NI000001", '{"company_status":"active","registered_office_address":{"locality":"Leeds"}}'), ("2", None)],
            "company_number string, payload string",
        )
    ).collect()
    assert [(r.company_number, r.registered_office_address.locality) for r in profiles] == [("NI000001", "Leeds")]
    hits = landed.search_results(
        spark.createDataFrame([("A", '[{"href":"x"},{"href":"y","title":"t"}]')], "company_name string, payload string")
    )
    assert [(r.rank, r.href, r.title) for r in hits.orderBy("rank").collect()] == [(0, "x", None), (1, "y", "t")]


def test_documents_folder(spark, tmp_path):
    (tmp_path / "abc.xhtml").write_bytes(b"<x/>")
    (tmp_path / "plain").write_bytes(b"\xff")
    got = landed.filing_documents(spark, str(tmp_path)).orderBy("document_id").collect()
    assert [(r.document_id, bytes(r.content)) for r in got] == [("abc", b"<x/>"), ("plain", b"\xff")]
