from __future__ import annotations

from pyspark.sql import functions as F

from firmscope.plans import enrich
from firmscope.streaming import kept
from tests.test_lookup import companies, landed  # noqa: F401


def _land(table, path, condition):
    table.filter(condition).coalesce(1).write.mode("append").parquet(path)


def test_only_what_landed_since_is_read(spark, companies, landed, tmp_path):  # noqa: F811
    """After each landing the lookups are those of all landed rows, whatever came first."""
    base, store = str(tmp_path / "landing"), str(tmp_path / "kept")
    tables = {name: getattr(landed, name) for name in kept.TABLES}
    keys = {"filings": "seq", "filing_docs": "document_id", "search_results": "href", "pages": "page_id"}
    schemas = {name: table.schema for name, table in tables.items()}
    kept.refresh(spark, base, schemas, store)  # no folder yet
    for name in tables:
        tables[name].limit(0).write.parquet(f"{base}/{name}")
    kept.refresh(spark, base, schemas, store)
    assert all(r.employees_2024 == "" for r in enrich.attach(companies, kept.kept_lookups(spark, store)).collect())
    for part in range(2):
        counts = {}
        for name, table in tables.items():
            condition = F.pmod(F.crc32(F.col(keys[name]).cast("string")), F.lit(2)) == part
            counts[name] = table.filter(condition).count()
            _land(table, f"{base}/{name}", condition)
        # Read once for each step of the partial at most, and never the rows of earlier landings.
        assert {k: bool(n) for k, n in kept.refresh(spark, base, schemas, store).items()} == {k: bool(n) for k, n in counts.items()}
        so_far = enrich.Landed(landed.profiles, *(spark.read.parquet(f"{base}/{name}") for name in kept.TABLES))
        got = enrich.attach(companies, kept.kept_lookups(spark, store)).collect()
        assert sorted(map(str, got)) == sorted(map(str, enrich.enrich_companies(companies, so_far).collect()))
    assert set(kept.refresh(spark, base, schemas, store).values()) == {0}


def test_documents_are_not_read_again(spark, landed, tmp_path):  # noqa: F811
    base, store = str(tmp_path / "landing"), str(tmp_path / "kept")
    schemas = {name: getattr(landed, name).schema for name in kept.TABLES}
    for name in kept.TABLES:
        _land(getattr(landed, name), f"{base}/{name}", F.lit(True))
    kept.refresh(spark, base, schemas, store)
    want = sorted(map(str, kept.kept_lookups(spark, store).by_number.collect()))
    # Gone from the landing zone, known all the same.
    for file in (tmp_path / "landing" / "filing_docs").glob("*.parquet"):
        file.unlink()
    kept.refresh(spark, base, schemas, store)
    assert sorted(map(str, kept.kept_lookups(spark, store).by_number.collect())) == want
