"""Range-wise operators against plain loops, with frequent keys and equal times."""

from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from firmscope.operators import ordered, shaping

START = datetime.datetime(2024, 1, 1)
SCHEMA = "k string, ts timestamp_ntz, id long, ok boolean, limited boolean"


def trace(seed, rows=600, instants=None):
    """Half of the rows belong to one key; with ``instants`` many share a time."""
    rng = random.Random(seed)
    out = []
    for id in range(rows):
        key = "hot" if rng.random() < 0.5 else rng.choice([None, "k1", "k2", "k3", "k4"])
        second = rng.choice(instants) if instants else rng.uniform(0, 3_000)
        ts = START + datetime.timedelta(seconds=second)
        ok = rng.random() < 0.85
        out.append((key, ts, id, ok, not ok and rng.random() < 0.3))
    rng.shuffle(out)
    return out


def by_key(rows):
    groups = {}
    for row in sorted(rows, key=lambda r: (r[1], r[2])):
        groups.setdefault(row[0], []).append(row)
    return groups


def us(ts):
    return round((ts - datetime.datetime(1970, 1, 1)) / datetime.timedelta(microseconds=1))


def bucket_loop(rows, interval, burst, asked=lambda id: 1):
    """Serve the events one after the other from a bucket of tokens."""
    starts = {}
    for key, events in by_key(rows).items():
        tokens, last = burst * interval, None
        for _, ts, id, *_ in events:
            now = us(ts) if last is None else max(us(ts), last)
            if last is not None:
                tokens = min(burst * interval, tokens + now - last)
            need = asked(id) * interval
            start = now + max(0, need - tokens)
            tokens = tokens + (start - now) - need
            last = start
            starts[key, id] = max(start, us(ts))
    return starts


def adaptive_loop(rows, initial, floor, ceiling):
    out = {}
    for key, events in by_key(rows).items():
        rate, streak, failures = initial, 0, 0
        for *_, ok, limited in events:
            if ok:
                streak, failures = streak + 1, max(0, failures - 1)
                if streak == 10:
                    rate, streak = min(ceiling, rate * 1.1), 0
            else:
                streak, failures = 0, failures + 1
                if limited or failures >= 3:
                    rate = max(floor, rate * 0.5)
        out[key] = (len(events), round(rate, 9), streak, failures)
    return out


TRACES = {
    "spread": trace(1),
    "crowded": trace(2, instants=[10, 10, 10, 10, 500, 501]),
    "one instant": trace(3, instants=[7]),
    "single row": trace(4, rows=1),
}


@pytest.mark.parametrize("name", TRACES)
@pytest.mark.parametrize("ranges", [2, 13])
def test_token_bucket(spark, name, ranges):
    rows = TRACES[name]
    df = spark.createDataFrame(rows, SCHEMA)
    got = shaping.token_bucket(df, ["k"], "ts", "id", rate=0.2, burst=3, ranges=ranges).collect()
    assert {(r.k, r.id): r.start_us for r in got} == bucket_loop(rows, 5_000_000, 3)
    assert len(got) == len(rows)
    assert all(r.wait_us == r.start_us - r.time_us for r in got)


def test_token_bucket_with_more_tokens(spark):
    # One to five tokens each, more than the bucket holds.
    rows = TRACES["spread"]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("asked", F.col("id") % 5 + 1)
    got = shaping.token_bucket(df, ["k"], "ts", "id", 0.2, 3, tokens="asked", ranges=9).collect()
    assert {(r.k, r.id): r.start_us for r in got} == bucket_loop(
        rows, 5_000_000, 3, lambda id: id % 5 + 1
    )


def test_token_bucket_known_waits(spark):
    rows = [("a", START, id, True, False) for id in range(10)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = shaping.token_bucket(df, ["k"], "ts", "id", rate=1, burst=3).orderBy("id").collect()
    assert [r.wait_us // 1_000_000 for r in got] == [0, 0, 0, 1, 2, 3, 4, 5, 6, 7]


def test_tokens_available(spark):
    rows = [("a", START, id, True, False) for id in range(3)] + [
        ("later", START + datetime.timedelta(days=1), 9, True, False)
    ]
    df = spark.createDataFrame(rows, SCHEMA)

    def tokens(at, rate=1.0, burst=3):
        got = shaping.tokens_available(df, ["k"], "ts", "id", rate, F.lit(at), burst)
        return {r.k: r.tokens for r in got.collect()}

    assert tokens("2024-01-01 00:00:00") == {"a": 0, "later": 3}
    assert tokens("2024-01-01 00:00:02.5") == {"a": 2, "later": 3}
    assert tokens("2024-01-01 00:01:00") == {"a": 3, "later": 3}
    # the burst follows from the rate when none is given
    assert tokens("2023-01-01 00:00:00", rate=2.0, burst=None) == {"a": 4, "later": 4}


@pytest.mark.parametrize("name", TRACES)
@pytest.mark.parametrize("ranges", [2, 13])
def test_adaptive_rate(spark, name, ranges, monkeypatch):
    monkeypatch.setattr(shaping, "FOLD_WIDTH", 4)
    rows = TRACES[name]
    df = spark.createDataFrame(rows, SCHEMA)
    got = shaping.adaptive_rate(
        df, ["k"], "ts", "id", "ok", "limited", initial=2.0, floor=0.1, ceiling=3.0, ranges=ranges
    ).collect()
    assert {r.k: (r.events, round(r.rate, 9), r.streak, r.failures) for r in got} == adaptive_loop(
        rows, 2.0, 0.1, 3.0
    )


def outcomes(flags):
    return [("a", START + datetime.timedelta(seconds=n), n, ok, False) for n, ok in enumerate(flags)]


@pytest.mark.parametrize(
    "flags, initial, floor, ceiling, rate",
    [
        ([True] * 15, 1.0, 0.1, 5.0, 1.1),
        ([False] * 5, 2.0, 0.5, 10.0, 0.5),
        ([True] * 50, 2.0, 1.0, 3.0, 3.0),
        ([True] * 50 + [False] * 50, 2.0, 1.0, 3.0, 1.0),
    ],
)
def test_adaptive_rate_known(spark, flags, initial, floor, ceiling, rate):
    df = spark.createDataFrame(outcomes(flags), SCHEMA)
    got = shaping.adaptive_rate(
        df, ["k"], "ts", "id", "ok", "limited", initial=initial, floor=floor, ceiling=ceiling
    ).first()
    assert got.rate == pytest.approx(rate)


def test_long_runs_do_not_overflow(spark):
    flags = [True] * 90_000 + [False] * 3_000
    got = shaping.adaptive_rate(
        spark.createDataFrame(outcomes(flags), SCHEMA), ["k"], "ts", "id", "ok", "limited", 2.0
    ).first()
    assert (got.rate, got.failures) == (0.1, 3_000)


@pytest.mark.parametrize("name", ["spread", "crowded"])
def test_running_progress(spark, name):
    rows = TRACES[name]
    log = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("k", "run")
    want = []
    for run, events in by_key(rows).items():
        good = 0
        for n, (_, ts, _, ok, _) in enumerate(events, 1):
            good += ok
            if n % 20 == 0:
                elapsed = (us(ts) - us(events[0][1])) / 1e6
                rate = n / elapsed if elapsed else 0.0
                eta = (len(events) - n) / rate if rate else 0.0
                want.append((run, len(events), n, good, n - good, n / len(events) * 100, elapsed, rate, eta))
    got = ordered.run_progress_running(log, 20, ranges=7).collect()
    assert len(got) == len(want) > 0
    for row, expected in zip(sorted(map(tuple, got), key=str), sorted(want, key=str)):
        assert row[:5] == expected[:5] and row[5:] == pytest.approx(expected[5:])


def test_final_progress_with_totals(spark):
    log = spark.createDataFrame(outcomes([True, False, True]), SCHEMA).withColumnRenamed("k", "run")
    totals = spark.createDataFrame([("a", 6)], "run string, total long")
    row = ordered.run_progress_final(log, totals).first()
    assert (row.processed, row.successful, row.failed, row.percent) == (3, 2, 1, 50.0)
    assert (row.elapsed, row.rate, row.eta) == (2.0, 1.5, 2.0)


def test_ranges_split_a_hot_key_and_a_hot_instant(spark):
    for name in ("spread", "one instant"):
        df = spark.createDataFrame(TRACES[name], SCHEMA)
        cut = ordered.with_ranges(
            df.withColumn("us", ordered.micros(df, "ts")), ["k"], "us", "id", ranges=10
        )
        hot = cut.filter("k = 'hot'")
        sizes = [r["count"] for r in hot.groupBy("_range").count().collect()]
        assert len(sizes) > 5 and max(sizes) <= 1.5 * 600 / 10
        first_last = hot.groupBy("_range").agg(
            F.min(F.struct("us", "id")).alias("a"), F.max(F.struct("us", "id")).alias("z")
        ).orderBy("_range").collect()
        assert all(x.z < y.a for x, y in zip(first_last, first_last[1:]))


def test_rare_keys_are_one_range(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("us"), "id",
    )
    cut = ordered.with_ranges(df, ["k"], "us", "id", ranges=10)
    pairs = cut.select("k", "_range").distinct().count()
    # One per key, and one more for each range that begins inside a key.
    assert 13_334 <= pairs <= 13_334 + 10
    assert cut.filter("k = 0").select("_range").distinct().count() >= 3


def test_times_do_not_depend_on_the_session_zone(spark):
    df = spark.createDataFrame(TRACES["spread"], SCHEMA)
    want = df.select(F.sum(ordered.micros(df, "ts"))).first()[0]
    # An hour that New York skips.
    gap = datetime.datetime(2024, 3, 10, 2, 30, 0, 123456)
    one = spark.createDataFrame([(gap,)], "ts timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert df.select(F.sum(ordered.micros(df, "ts"))).first()[0] == want
        assert one.select(ordered.micros(one, "ts")).first()[0] == us(gap)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("rows, size", [(0, 3), (1, 3), (10, 3), (1000, 7)])
def test_chunks(spark, rows, size):
    df = spark.range(rows).select(F.format_string("%05d", (F.col("id") * 7919) % 100_003).alias("key"))
    got = ordered.chunk_rows(df, size, "key").orderBy("key").collect()
    assert [r.chunk_id for r in got] == [n // size for n in range(rows)]


def test_equal_rows_are_split_too(spark):
    df = spark.range(1000).select(F.lit("same").alias("key"), "id")
    numbered = ordered.number_rows(df, "key", ranges=8)
    assert sorted(r.row_no for r in numbered.collect()) == list(range(1000))
    spread = numbered.groupBy(F.spark_partition_id()).count()
    assert spread.agg(F.max("count")).first()[0] < 1000


def test_slice(spark):
    df = spark.range(100).select(F.format_string("%03d", "id").alias("key"))
    keys = [f"{n:03d}" for n in range(100)]

    def slice(start, length):
        return sorted(r.key for r in ordered.slice_rows(df, start, length, "key").collect())

    assert slice(10, 5) == keys[10:15]
    assert slice(95, 50) == keys[95:]
    assert slice(97, None) == keys[97:]
    assert slice(200, None) == []


@pytest.mark.parametrize("sampled", [8, 4_000])
def test_slices_against_sorted_rows(spark, monkeypatch, sampled):
    """Missing values first, several columns, copies, large ranges cut again; parts at both ends and between."""
    monkeypatch.setattr(ordered, "SAMPLED", sampled)
    monkeypatch.setattr(ordered, "RANGE_ROWS", 40)
    luck = random.Random(6)
    rows = [(luck.choice([None, "", "a", "b", "ü"]), luck.choice([None, *range(30)]), None) for _ in range(500)]
    df = spark.createDataFrame(rows, "s string, n int, x double").repartition(4)
    want = sorted(rows, key=lambda r: ((r[0] is not None, (r[0] or "").encode()), (r[1] is not None, r[1] or 0)))
    for start, length in ((3, 200), (250, None), (499, 10), (500, 3)):
        got = ordered.slice_rows(df, start, length, "s", "n").collect()
        end = None if length is None else start + length
        assert sorted(map(str, map(tuple, got))) == sorted(map(str, want[start:end]))


def test_slices_of_tied_rows_agree_at_any_length(spark):
    df = spark.range(3_000).select((F.col("id") % 3).alias("key"), "id")
    short = [r.id for r in ordered.slice_rows(df, 5, 20, "key").collect()]
    long = ordered.slice_rows(df, 5, 2_000, "key")
    again = [r.id for r in ordered.slice_rows(df, 5, 20, "key").collect()]
    assert sorted(short) == sorted(again)
    assert set(short) <= {r.id for r in long.collect()}


def test_checkpoint_prefix_reads_back(spark, tmp_path):
    df = spark.range(50).withColumnRenamed("id", "key")
    ordered.write_chunks(ordered.chunk_rows(df, 20, "key"), str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    assert ordered.checkpoint_prefix(table, 0).count() == 20
    assert ordered.checkpoint_prefix(table, 9).count() == 50


def test_nothing_at_all(spark):
    df = spark.createDataFrame([], SCHEMA)
    log = df.withColumnRenamed("k", "run")
    assert shaping.token_bucket(df, ["k"], "ts", "id", 1.0).count() == 0
    assert shaping.tokens_available(df, ["k"], "ts", "id", 1.0, F.lit("2024-01-01 00:00:00")).count() == 0
    assert shaping.adaptive_rate(df, ["k"], "ts", "id", "ok", "limited", 2.0).count() == 0
    assert ordered.run_progress_running(log).count() == 0
    assert ordered.run_progress_final(log).count() == 0
    assert ordered.slice_rows(df, 0, None, "k").count() == 0


def test_rows_without_a_time_are_kept(spark):
    df = spark.createDataFrame([("a", None, 1, True, False), ("a", START, 2, True, False)], SCHEMA)
    got = shaping.token_bucket(df, ["k"], "ts", "id", 1.0, 1).orderBy("id").collect()
    assert [(r.id, r.wait_us) for r in got] == [(1, None), (2, 0)]
