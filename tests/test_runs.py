from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from firmscope.plans import runs
from firmscope.sources import tables
from tests.test_jobs import source  # noqa: F401
from tests.test_lookup import companies, landed  # noqa: F401

AT = "2024-01-01 10:00:00"
STEPS = [("after enriched", "second"), ("after log", "first"), ("before commit", "second")]


@pytest.mark.parametrize("step, again", STEPS)
def test_a_failure_anywhere_and_a_rerun_give_each_row_once(spark, landed, source, tmp_path, monkeypatch, step, again):  # noqa: F811
    base = str(tmp_path / "done")
    write, commit = runs.Runs.write, runs.Runs.commit

    def failing_write(self, run, name, rows):
        if step == f"before {name}":
            raise RuntimeError(step)
        written = write(self, run, name, rows)
        if step == f"after {name}":
            raise RuntimeError(step)
        return written

    def failing_commit(self, run, names):
        raise RuntimeError(step)

    monkeypatch.setattr(runs.Runs, "write", failing_write)
    if step == "before commit":
        monkeypatch.setattr(runs.Runs, "commit", failing_commit)
    with pytest.raises(RuntimeError, match=step):
        runs.enrich_run(spark, source, base, landed, "first", at=F.lit(AT))
    monkeypatch.setattr(runs.Runs, "write", write)
    monkeypatch.setattr(runs.Runs, "commit", commit)
    store = runs.Runs(spark, base)
    assert store.read("enriched") is None and store.read("log") is None and store.committed() == set()

    done = runs.enrich_run(spark, source, base, landed, again, at=F.lit(AT))
    assert done == {"processed": 3, "successful": 3, "failed": 0}
    assert sorted(r.CompanyNumber for r in store.read("enriched").collect()) == ["00000001", "2", "NI123456"]
    assert sorted((r.run, r.id, r.ok) for r in store.read("log").collect()) == [
        (again, "00000001", True), (again, "2", True), (again, "NI123456", True),
    ]


def test_runs_go_on_and_names_are_used_once(spark, landed, source, tmp_path):  # noqa: F811
    base = str(tmp_path / "done")
    runs.enrich_run(spark, source, base, landed, "a/b c", at=F.lit(AT))
    with open(source, "a") as more:
        more.write("NEW CO,3\n")
    with pytest.raises(ValueError, match="committed"):
        runs.enrich_run(spark, source, base, landed, "a/b c", at=F.lit(AT))
    assert runs.enrich_run(spark, source, base, landed, "next", at=F.lit(AT))["processed"] == 1
    assert runs.enrich_run(spark, source, base, landed, "none left", at=F.lit(AT))["processed"] == 0
    store = runs.Runs(spark, base)
    assert store.committed() == {"a/b c", "next", "none left"}
    assert store.read("enriched").columns == ["CompanyName", "CompanyNumber", *tables.RESULT_COLUMNS]
    assert sorted((r.run, r.id) for r in store.read("log").collect()) == [
        ("a/b c", "00000001"), ("a/b c", "2"), ("a/b c", "NI123456"), ("next", "3"),
    ]
