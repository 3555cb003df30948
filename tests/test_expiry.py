from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from firmscope.operators import expiry
from firmscope.operators.ordered import held, hold_keys, with_ranges

HOUR = 3_600_000_000
SCHEMA = "prefix string, key string, us bigint"


def sequential(rows, days, last):
    """Asked for one by one, in order of time."""
    asked, known = [], dict(last)
    for prefix, key, us in sorted(rows, key=lambda r: (r[2] is not None, r[2] or 0)):
        if us is None:
            continue
        end = known.get((prefix, key))
        if end is None or us >= end + days.get(prefix, 7) * 24 * HOUR:
            asked.append((prefix, key, us))
            known[prefix, key] = us
    return sorted(asked, key=str)


def found(spark, rows, ranges, last=()):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("at", F.timestamp_micros("us")).repartition(3)
    known = spark.createDataFrame([(*k, v) for k, v in last], "prefix string, key string, last bigint") if last else None
    got = expiry.first_requests(df, "at", last=known, ranges=ranges)
    return sorted((tuple(r) for r in got.collect()), key=str)


DAYS = {"ddg_search": 1, "website_desc": 7, "geocode": 30}


@pytest.mark.parametrize("ranges", [2, 40])
def test_equals_asking_one_by_one(spark, ranges):
    """A key with half of all requests, others with few, missing names and times, repeats."""
    luck = random.Random(4)
    rows = []
    for _ in range(1_500):
        hot = luck.random() < 0.5
        prefix = "ddg_search" if hot else luck.choice(["ddg_search", "website_desc", "geocode", "x", None])
        key = "hot" if hot else luck.choice(["a", "b", "c", None, ""])
        rows.append((prefix, key, luck.choice([None, *[luck.randrange(0, 90 * 24) * HOUR for _ in range(20)]])))
    rows += rows[:100]
    assert found(spark, rows, ranges) == sequential(rows, DAYS, {})
    last = {("ddg_search", "hot"): 30 * 24 * HOUR, ("geocode", "a"): 1, (None, None): 24 * HOUR, ("gone", "z"): 5}
    assert found(spark, rows, ranges, tuple(last.items())) == sequential(rows, DAYS, last)


def test_long_chains_and_edges(spark):
    """A request exactly at the end of the lifetime counts; chains of any length are followed to their end."""
    day = 24 * HOUR
    rows = [("ddg_search", "long", k * day) for k in range(60)] + [("ddg_search", "edge", k) for k in (0, day - 1, day, 2 * day - 1, 2 * day)]
    got = found(spark, rows, 5)
    assert got == sequential(rows, DAYS, {}) and len(got) == 63


def test_nothing_to_ask(spark):
    assert found(spark, [], 2) == []
    assert found(spark, [("a", "b", None)], 2) == []
    assert found(spark, [("a", "b", 5)], 2, ((("a", "b"), 4),)) == []


def test_a_hot_key_is_spread(spark):
    rows = [("ddg_search", "hot", k * HOUR) for k in range(2_000)] + [("x", f"k{k}", k) for k in range(500)]
    df = hold_keys(spark.createDataFrame(rows, SCHEMA), expiry.KEY)
    ranged = with_ranges(df, held(expiry.KEY), "us", "us", 10)
    sizes = {r._range: r["count"] for r in ranged.filter("key = 'hot'").groupBy("_range").count().collect()}
    assert len(sizes) >= 7 and max(sizes.values()) <= 2 * 2_500 / 10
