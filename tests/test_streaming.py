from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from firmscope.operators import shaping
from firmscope.plans import catalog, enrich, inputs
from firmscope.streaming import jobs
from tests.test_ordered import SCHEMA, TRACES

DATA = "/root/testdata/sf0.001"


@pytest.fixture
def landing(spark, tmp_path):
    """A trace in five files that arrive in time order."""
    path = str(tmp_path / "events")
    rows = sorted(TRACES["spread"], key=lambda r: (r[1], r[2]))
    for start in range(0, len(rows), 120):
        spark.createDataFrame(rows[start : start + 120], SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark, path):
    return jobs.file_stream(spark, path, spark.read.parquet(path).schema, max_files=1)


def test_token_bucket_stream_equals_table(spark, landing, tmp_path):
    query = jobs.token_bucket_stream(
        stream(spark, landing), ["k"], "ts", "id", 0.2, 3,
        str(tmp_path / "out"), str(tmp_path / "state"), str(tmp_path / "check"), ranges=3,
    )
    query.awaitTermination()
    got = jobs.read_batches(spark, str(tmp_path / "out"))
    assert got.select("batch").distinct().count() == 5
    want = shaping.token_bucket(spark.read.parquet(landing), ["k"], "ts", "id", 0.2, 3)
    assert sorted(map(str, got.drop("batch").collect())) == sorted(map(str, want.collect()))


def test_adaptive_stream_equals_table(spark, landing, tmp_path):
    query = jobs.adaptive_rate_stream(
        stream(spark, landing), ["k"], "ts", "id", "ok", "limited", 2.0, 0.1, 3.0,
        str(tmp_path / "state"), str(tmp_path / "check"), ranges=3,
    )
    query.awaitTermination()
    got = jobs.latest(jobs.read_batches(spark, str(tmp_path / "state")), ["k"])
    want = shaping.adaptive_rate(
        spark.read.parquet(landing), ["k"], "ts", "id", "ok", "limited", 2.0, 0.1, 3.0
    )

    def rounded(df):
        return sorted(str(r) for r in df.withColumn("rate", F.round("rate", 9)).collect())

    assert rounded(got) == rounded(want)


def test_progress_stream(spark, landing, tmp_path):
    log = stream(spark, landing).withColumnRenamed("k", "run")
    folders = [str(tmp_path / name) for name in ("out", "state", "check")]
    jobs.progress_stream(log, *folders).awaitTermination()
    got = jobs.latest(jobs.read_batches(spark, folders[0]), ["run"]).drop("last")
    want = spark.read.parquet(landing).groupBy("k").agg(F.count("*"), F.count_if("ok"), F.count_if(~F.col("ok")))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))


def test_ended_runs_leave_the_state_and_open_again(spark, tmp_path):
    """Over restarts: a run that is idle is not kept, a late row finds its counts."""
    path = str(tmp_path / "log")
    folders = [str(tmp_path / name) for name in ("out", "state", "check")]
    landings = [
        [("a", 0, True), ("a", 1, False), (None, 0, True), ("untimed", None, True)],
        [("b", 5, True)],
        [("c", 30, True), ("b", 6, False)],
        [("a", 2, True), ("d", 31, True), (None, 31, False)],
        [("c", 60, True)],
        [("a", 3, False), ("untimed", None, False)],
    ]
    # Runs that are going on: heard of within ten hours of the newest row.
    kept = [{"a", None, "untimed"}, {"a", "b", None, "untimed"}, {"c", None, "untimed"}, {"c", "d", None, "untimed"}, {"c", None, "untimed"}, {"c", None, "untimed"}]
    seen = {}
    for batch, rows in enumerate(landings):
        df = spark.createDataFrame(rows, "run string, hour int, ok boolean")
        df = df.selectExpr("run", "timestamp'2024-01-01' + make_interval(0, 0, 0, 0, hour) AS ts", "ok")
        df.coalesce(1).write.mode("append").parquet(path)
        jobs.progress_stream(stream(spark, path), *folders, idle=36_000).awaitTermination()
        for run, _, ok in rows:
            n, good, bad = seen.get(run, (0, 0, 0))
            seen[run] = n + 1, good + ok, bad + (not ok)
        got = jobs.latest(jobs.read_batches(spark, folders[0]), ["run"]).collect()
        assert {r.run: (r.processed, r.successful, r.failed) for r in got} == seen
        state = spark.read.parquet(f"{folders[1]}/batch={batch}")
        assert {r.run for r in state.collect()} == kept[batch]


def requests_of(spark, path, rows, one_file):
    df = spark.createDataFrame(rows, "prefix string, key string, hour int")
    df = df.selectExpr("prefix", "key", "timestamp'2024-01-01' + make_interval(0, 0, 0, 0, hour) AS asked")
    for part in [df.coalesce(1)] if one_file else [df.filter(F.col("asked") == t) for t in sorted({r.asked for r in df.collect()})]:
        part.coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("one_file", [True, False])
def test_first_requests_repeat_after_the_lifetime(spark, tmp_path, one_file):
    """In one batch and in many: a request within its kind's lifetime of the last one asked is known."""
    path, out = str(tmp_path / "requests"), str(tmp_path / "out")
    day = [0, 1, 23, 24, 47, 48, 300, 5_000]
    rows = [("ddg_search", "a", h) for h in day] + [("geocode", "a", h) for h in day] + [("x", None, h) for h in day]
    requests_of(spark, path, rows, one_file)
    state, check = str(tmp_path / "state"), str(tmp_path / "check")
    jobs.first_requests(stream(spark, path), "asked", out, state, check, ranges=3).awaitTermination()
    origin = 1_704_067_200_000_000
    got = {}
    for r in jobs.read_batches(spark, out).collect():
        got.setdefault((r.prefix, r.key), []).append((r.asked_us - origin) // 3_600_000_000)
    assert {k: sorted(v) for k, v in got.items()} == {
        ("ddg_search", "a"): [0, 24, 48, 300, 5_000],
        ("geocode", "a"): [0, 5_000],
        ("x", None): [0, 300, 5_000],
    }


def test_late_requests_and_landed_answers(spark, tmp_path):
    path, out = str(tmp_path / "requests"), str(tmp_path / "out")
    for part in ([("p", "a", 5_000)], [("p", "b", 0)], [("p", "a", 10)], [("p", "c", 100)]):
        requests_of(spark, path, part, True)
    landed = spark.sql("SELECT 'p' prefix, 'c' key, timestamp'2024-01-03' fetched_at")
    state, check = str(tmp_path / "state"), str(tmp_path / "check")
    jobs.first_requests(stream(spark, path), "asked", out, state, check, answers=landed).awaitTermination()
    # Old requests of other keys are not lost; one that comes after a younger one is answered by it.
    assert sorted(r.key for r in jobs.read_batches(spark, out).collect()) == ["a", "b"]


def test_enrich_stream_resumes(spark, tmp_path):
    path, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    companies = inputs.companies(spark, DATA)
    lookups = enrich.prepare(inputs.landed(spark, DATA), catalog.YEARS)
    seen = []
    for part in (0, 1):
        companies.filter(F.crc32("CompanyNumber") % 2 == part).coalesce(1).write.mode("append").parquet(path)
        query = jobs.enrich_stream(
            stream(spark, path), lookups, out, check, lambda batch, id: seen.append((id, batch.count()))
        )
        query.awaitTermination()
    got = jobs.read_batches(spark, out).drop("batch")
    want = enrich.attach(companies, lookups)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert [id for id, _ in seen] == [0, 1] and sum(n for _, n in seen) == want.count()
