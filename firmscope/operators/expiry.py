"""Which requests must be asked for, when an answer stays fresh for a while.

Of a key's requests in order of time the first is asked for, then the first at
or after the end of its answer's lifetime, and so on: each choice hangs on the
one before. Sequentially that is one task per key. Here every request gets a
pointer to the one that would follow it, found in ranges of the order that hold
a bounded share of all rows, whatever a key holds; pointers are doubled by
self-joins until none is left, and the chosen requests are unfolded from the
first one along the longest pointers down to the shortest. So a chain of n
choices costs as many rounds as n has bits.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firmscope.operators.lookup import DEFAULT_LIFETIME, LIFETIMES, lifetime
from firmscope.operators.ordered import held, hold_keys, micros, release_keys, with_ranges
from firmscope.shared import stored

KEY = ["prefix", "key"]


def newest_answers(answers: DataFrame) -> DataFrame:
    """(prefix, key, last): when each key was answered last, from rows with ``fetched_at``."""
    return answers.groupBy(*KEY).agg(F.max(micros(answers, "fetched_at")).alias("last"))


def first_requests(
    requests: DataFrame,
    time: str,
    lifetimes: Mapping[str, int] = LIFETIMES,
    default: int = DEFAULT_LIFETIME,
    last: DataFrame | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """(prefix, key, asked_us): the requests that must be asked for.

    A request is asked for if its key was never asked for or the lifetime of
    its kind has passed since, exactly. ``last`` (prefix, key, last), one row
    per key in microseconds, says when keys were asked for before. Requests at
    the same instant are one; those without a time are not asked for; a missing
    prefix or key is one like any other.
    """
    key = held(KEY)
    timed = hold_keys(requests.select(*KEY, micros(requests, time).alias("_us")), KEY)
    times = stored(timed.filter("_us is not null").distinct(), "times")
    if last is None:
        last = requests.sparkSession.createDataFrame([], "prefix string, key string, last bigint")
    known = hold_keys(last.filter("last is not null"), KEY)
    lives = lifetime(F.when(~F.col("_no_prefix"), F.col("prefix")), lifetimes, default).cast("bigint") * 1_000_000

    # Every request asks for the first one at or after its answer's end; so do the keys asked before.
    event, probe = F.lit(1).alias("_kind"), F.lit(0).alias("_kind")
    moved = (F.col("_us") + lives).alias("_at")
    ends = (F.col("last") + lives).alias("_at")
    nothing = F.lit(None).cast("bigint").alias("_us")
    rows = (
        times.select(*key, F.col("_us").alias("_at"), event, "_us")
        .union(times.select(*key, moved, probe, "_us"))
        .union(known.select(*key, ends, probe, nothing))
    )
    follow = _followers(with_ranges(rows, key, "_at", "_kind", ranges), key)
    follow = stored(follow.filter("_next is not null"), "pointers")

    begun = follow.filter("_us is null").select(*key, F.col("_next").alias("_us"))
    new = times.join(known, key, "left_anti").groupBy(*key).agg(F.min("_us").alias("_us"))
    chosen = stored(begun.union(new), "begun")
    jumps = [follow.filter("_us is not null").select(*key, "_us", F.col("_next").alias("_to"))]
    while jumps[-1].take(1):
        jumps.append(stored(_doubled(jumps[-1], key), "pointers"))
    for jump in reversed(jumps[:-1]):
        chosen = _unfolded(chosen, jump, key)
    return chosen.select(*release_keys(KEY), F.col("_us").alias("asked_us"))


def _followers(rows: DataFrame, key: list[str]) -> DataFrame:
    """Add ``_next`` to each probe: the first event of its key that stands at or after it."""
    when = F.when(F.col("_kind") == 1, F.col("_at"))
    # From the end of each range, so that what follows is what was seen before.
    back = Window.partitionBy(*key, "_range").orderBy(F.desc("_at"), F.desc("_kind"))
    inside = rows.withColumn("_inside", F.min(when).over(back.rowsBetween(Window.unboundedPreceding, 0)))
    firsts = rows.groupBy(*key, "_range").agg(F.min(when).alias("_first"))
    later = Window.partitionBy(*key).orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    carried = firsts.select(*key, "_range", F.min("_first").over(later).alias("_later"))
    probes = inside.filter("_kind = 0").join(carried, [*key, "_range"])
    return probes.select(*key, "_us", F.coalesce("_inside", "_later").alias("_next"))


def _doubled(jump: DataFrame, key: list[str]) -> DataFrame:
    """Pointers over twice as many requests."""
    on = jump.select(*key, F.col("_us").alias("_to"), F.col("_to").alias("_far"))
    return jump.join(on, [*key, "_to"]).select(*key, "_us", F.col("_far").alias("_to"))


def _unfolded(chosen: DataFrame, jump: DataFrame, key: list[str]) -> DataFrame:
    """The chosen requests and those that their pointers lead to."""
    met = chosen.join(jump, [*key, "_us"], "left")
    both = F.filter(F.array("_us", "_to"), lambda at: at.isNotNull())
    return met.select(*key, F.explode(both).alias("_us"))


def asked_last(asked: DataFrame, last: DataFrame | None) -> DataFrame:
    """(prefix, key, last) after some requests were asked for."""
    now = asked.select(*KEY, F.col("asked_us").alias("last"))
    every = now if last is None else last.select(*KEY, "last").unionByName(now)
    return every.groupBy(*KEY).agg(F.max("last").alias("last"))
