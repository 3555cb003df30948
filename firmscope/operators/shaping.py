"""Rates: what a token bucket and an adaptive limit would have done to events.

Both are folds over one key's events in (time, id) order. They are written as
sums and running maxima or minima, which can be computed range by range and
chained (see ``ordered``), so one key may hold most of the events. All times
are whole microseconds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firmscope.operators.ordered import (
    before_range,
    held,
    hold_keys,
    in_range,
    micros,
    release_keys,
    with_ranges,
)

# Fixed values of the adaptive limit.
STREAK = 10
RAISE, CUT = 1.1, 0.5
FAILURES = 3
FLOOR, CEILING = 0.1, 10.0

FOLD_WIDTH = 10_000
_FOLD_LEVELS = 2
# A factor beyond these has long hit a bound; stopping there avoids overflow.
_LEAST_FACTOR, _MOST_FACTOR = 1e-150, 1e150


def _interval(rate: float) -> int:
    return round(1_000_000 / rate)


def _burst(rate: float, burst: int | None) -> int:
    return burst or max(1, int(rate * 2))


# Token bucket
#
# Let T be the time one token takes and used_i the tokens that a key's events
# up to and with event i ask for. The bucket is paid back at
#   owed_i = used_i * T + max over j <= i of (time_j - used_(j-1) * T)
# and the event starts at max(time_i, owed_i - burst * T). State after an event
# is just the tokens used and that maximum.

def _bucket(
    events: DataFrame, key: Sequence[str], time: str, order: str, interval: int,
    tokens: str | None, ranges: int | None, state: DataFrame | None,
) -> tuple[DataFrame, DataFrame]:
    """Rows with tokens used and peak in their range, and the ranges placed in order."""
    asked = F.lit(1) if tokens is None else F.col(tokens)
    narrow = events.select(
        *key, order, micros(events, time).alias("_us"), asked.cast("bigint").alias("_asked")
    )
    window = in_range(held(key), "_us", order)
    rows = (
        with_ranges(hold_keys(narrow, key), held(key), "_us", order, ranges)
        .withColumn("_used", F.sum("_asked").over(window))
        .withColumn("_slack", F.col("_us") - (F.col("_used") - F.col("_asked")) * interval)
        .withColumn("_peak", F.max("_slack").over(window))
    )
    sums = rows.groupBy(*held(key), "_range").agg(
        F.sum("_asked").alias("_n"), F.max("_slack").alias("_top")
    )
    if state is not None:
        # Earlier events stand in front, as one more range.
        sums = sums.unionByName(
            hold_keys(state, key).select(
                *held(key), F.lit(-1).cast("bigint").alias("_range"),
                F.col("used").alias("_n"), F.col("peak").alias("_top"),
            )
        )
    before = F.coalesce(F.sum("_n").over(before_range(held(key))), F.lit(0))
    return rows, sums.withColumn("_before", before)


def token_bucket_step(
    events: DataFrame,
    key: Sequence[str],
    time: str,
    order: str,
    rate: float,
    burst: int | None = None,
    tokens: str | None = None,
    ranges: int | None = None,
    state: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Shaped events, and the state (key, used, peak) that they leave.

    ``rate`` is tokens per second and key; the bucket starts full. ``tokens``
    names the column with the tokens an event asks for, one each by default.
    ``state`` is what earlier events left. (time, order) must tell a key's
    events apart, and the tokens a key uses must take less than 2**63
    microseconds (290,000 years) to pay back.
    """
    interval, size = _interval(rate), _burst(rate, burst)
    rows, placed = _bucket(events, key, time, order, interval, tokens, ranges, state)
    top = F.col("_top") - F.col("_before") * interval
    carried = placed.select(
        *held(key), "_range", "_before", F.max(top).over(before_range(held(key))).alias("_carried")
    )
    peak = F.greatest("_carried", F.col("_peak") - F.col("_before") * interval)
    owed = (F.col("_before") + F.col("_used")) * interval + peak
    shaped = (
        rows.join(carried, [*held(key), "_range"])
        .withColumn("start_us", F.greatest(F.col("_us"), owed - size * interval))
        .select(
            *release_keys(key), order, F.col("_us").alias("time_us"), "start_us",
            (F.col("start_us") - F.col("_us")).alias("wait_us"),
        )
    )
    totals = placed.groupBy(*held(key)).agg(
        F.sum("_n").alias("used"), F.max(top).alias("peak")
    )
    return shaped, totals.select(*release_keys(key), "used", "peak")


def token_bucket(
    events: DataFrame,
    key: Sequence[str],
    time: str,
    order: str,
    rate: float,
    burst: int | None = None,
    tokens: str | None = None,
    ranges: int | None = None,
    state: DataFrame | None = None,
) -> DataFrame:
    """When each event may start: (key, order, time_us, start_us, wait_us)."""
    return token_bucket_step(events, key, time, order, rate, burst, tokens, ranges, state)[0]


def tokens_available(
    events: DataFrame,
    key: Sequence[str],
    time: str,
    order: str,
    rate: float,
    at: Column,
    burst: int | None = None,
    tokens: str | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Whole tokens per key at one time, given the events until then."""
    interval, size = _interval(rate), _burst(rate, burst)
    now = micros(events, time, at)
    until = events.filter(micros(events, time) <= now)
    _, state = token_bucket_step(until, key, time, order, rate, burst, tokens, ranges)
    owed = F.col("used") * interval + F.col("peak")
    free = now - owed + size * interval
    left = F.least(F.lit(size), F.greatest(F.lit(0), F.floor(free / interval)))
    # No event yet means a full bucket; least and greatest skip nulls.
    known = F.when(F.col("used").isNull(), F.lit(size)).otherwise(left)
    keys = hold_keys(events.select(*key), key).distinct()
    return keys.join(hold_keys(state, key), held(key), "left").select(
        *release_keys(key), known.cast("int").alias("tokens")
    )


def full_buckets(keys: DataFrame, rate: float, burst: int | None = None) -> DataFrame:
    """State after a reset: every key has all its tokens again."""
    return keys.distinct().withColumn("tokens", F.lit(_burst(rate, burst)))


# Adaptive rate
#
# A success lengthens the streak and takes one recent failure back; a failure
# ends the streak and adds one. The count of recent failures is a walk of +1
# and -1 that is held at zero, that is, the walk minus its lowest point. The
# streak is the successes so far minus those at the last failure. Both follow
# from running sums, maxima and minima. What remains is the rate itself: every
# change is x -> min(high, max(low, factor * x)), and such steps in a row are
# again one step of that form, so they are composed in blocks of bounded size.

def _adaptive_rows(
    outcomes: DataFrame, key: Sequence[str], time: str, order: str, ok: str, limited: str,
    ranges: int | None, state: DataFrame | None,
) -> DataFrame:
    """Outcomes with the streak and the recent failures after each."""
    # Both flags in one column: rows and sums then need the same columns, and
    # Spark shuffles the rows once for both.
    flags = F.when(F.col(ok), 1).when(F.col(limited), 2).otherwise(0)
    narrow = outcomes.select(
        *key, order, micros(outcomes, time).alias("_us"), flags.alias("_flags")
    )
    narrow = hold_keys(narrow, key)
    key = held(key)
    ranged = with_ranges(narrow, key, "_us", order, ranges)
    window = in_range(key, "_us", order)
    succeeded = F.col("_flags") == 1
    step = F.when(succeeded, -1).otherwise(1)
    rows = (
        ranged.withColumn("_good", F.count_if(succeeded).over(window))
        .withColumn("_walk", F.sum(step).over(window))
        .withColumn("_base", F.max(F.when(~succeeded, F.col("_good"))).over(window))
        .withColumn("_low", F.min("_walk").over(window))
    )
    sums = rows.groupBy(*key, "_range").agg(
        F.count_if(succeeded).alias("_good_sum"),
        F.sum(step).alias("_walk_sum"),
        F.max("_base").alias("_base_top"),
        F.min("_low").alias("_low_end"),
    )
    if state is not None:
        # The state enters as a range that ends in its streak and failures.
        sums = sums.unionByName(
            state.select(
                *key, F.lit(-1).cast("bigint").alias("_range"),
                F.col("streak").alias("_good_sum"), F.col("failures").alias("_walk_sum"),
                F.lit(None).cast("bigint").alias("_base_top"),
                F.lit(0).cast("bigint").alias("_low_end"),
            )
        )
    earlier = before_range(key)
    started = sums.withColumn(
        "_good_before", F.coalesce(F.sum("_good_sum").over(earlier), F.lit(0))
    ).withColumn("_walk_before", F.coalesce(F.sum("_walk_sum").over(earlier), F.lit(0)))
    carried = started.withColumn(
        "_base_before",
        F.coalesce(F.max(F.col("_good_before") + F.col("_base_top")).over(earlier), F.lit(0)),
    ).withColumn(
        "_low_before",
        F.least(
            F.lit(0),
            F.coalesce(F.min(F.col("_walk_before") + F.col("_low_end")).over(earlier), F.lit(0)),
        ),
    )
    befores = ["_good_before", "_walk_before", "_base_before", "_low_before"]
    whole = rows.join(carried.select(*key, "_range", *befores), [*key, "_range"])
    good = F.col("_good_before") + F.col("_good")
    base = F.greatest(F.col("_base_before"), F.col("_good_before") + F.col("_base"))
    walk = F.col("_walk_before") + F.col("_walk")
    low = F.least(F.col("_low_before"), F.col("_walk_before") + F.col("_low"))
    return whole.select(
        *key, "_range", "_us", order, "_flags",
        ((good - base) % STREAK).alias("streak"), (walk - low).alias("failures"),
    )


def _step(factor: float, low: float, high: float) -> Column:
    return F.struct(
        F.lit(float(factor)).alias("factor"),
        F.lit(float(low)).alias("low"),
        F.lit(float(high)).alias("high"),
    )


def _compose(blocks: Column) -> Column:
    """One step (factor, low, high) that does what the ordered steps do in turn."""
    start = _step(1.0, 0.0, float("inf"))

    def then(done: Column, block: Column) -> Column:
        def held(bound: str) -> Column:
            return F.least(
                block["step"]["high"],
                F.greatest(block["step"]["low"], done[bound] * block["step"]["factor"]),
            )

        return F.struct(
            F.least(
                F.lit(_MOST_FACTOR),
                F.greatest(F.lit(_LEAST_FACTOR), done["factor"] * block["step"]["factor"]),
            ).alias("factor"),
            held("low").alias("low"),
            held("high").alias("high"),
        )

    return F.aggregate(F.array_sort(blocks), start, then)


def adaptive_rate(
    outcomes: DataFrame,
    key: Sequence[str],
    time: str,
    order: str,
    ok: str,
    limited: str,
    initial: float,
    floor: float = FLOOR,
    ceiling: float = CEILING,
    ranges: int | None = None,
    state: DataFrame | None = None,
) -> DataFrame:
    """Where each key's limit ends: (key, events, rate, streak, failures).

    Ten successes in a row raise the rate by a tenth up to ``ceiling``; a rate
    limit answer, or a failure while three or more are recent, halves it down
    to ``floor``. ``state`` is the result for the outcomes before these.
    """
    names, key = key, held(key)
    if state is not None:
        state = hold_keys(state, names)
    rows = _adaptive_rows(outcomes, names, time, order, ok, limited, ranges, state)
    succeeded = F.col("_flags") == 1
    raised = succeeded & (F.col("streak") == 0)
    lowered = ~succeeded & ((F.col("_flags") == 2) | (F.col("failures") >= FAILURES))
    step = F.when(raised, _step(RAISE, 0.0, ceiling)).when(
        lowered, _step(CUT, floor, float("inf"))
    )
    # Blocks hold at most FOLD_WIDTH changes of the rate each. They become one
    # step, level by level; what else a block knows is its last row's state.
    changes = F.count("step").over(in_range(key, "_us", order))
    blocks = (
        rows.withColumn("step", step)
        .withColumn("_at", changes)
        .withColumn("_last", F.struct("_us", order, "streak", "failures"))
        .withColumn("events", F.lit(1).cast("bigint"))
        .select(*key, "_range", "_at", "step", "_last", "events")
    )

    def merge(groups: list[str | Column]) -> DataFrame:
        steps = F.collect_list(F.when(F.col("step").isNotNull(), F.struct("_at", "step")))
        return blocks.groupBy(*groups).agg(
            _compose(steps).alias("step"),
            F.max("_last").alias("_last"),
            F.sum("events").alias("events"),
        )

    for level in range(_FOLD_LEVELS):
        last = level == _FOLD_LEVELS - 1
        block = F.lit(0).cast("bigint") if last else F.expr(f"_at div {FOLD_WIDTH}")
        blocks = blocks.withColumn("_block", block)
        blocks = merge([*key, "_range", "_block"]).withColumnRenamed("_block", "_at")
    blocks = blocks.drop("_at").withColumnRenamed("_range", "_at")
    ended = merge(key).select(*key, "step", "_last.streak", "_last.failures", "events")

    start = F.lit(float(initial))
    if state is not None:
        earlier = state.select(
            *key, F.col("rate").alias("_rate"), F.col("streak").alias("_streak"),
            F.col("failures").alias("_failures"), F.col("events").alias("_events"),
        )
        ended = ended.join(earlier, key, "full").withColumns(
            {
                "streak": F.coalesce("streak", "_streak"),
                "failures": F.coalesce("failures", "_failures"),
                "events": F.coalesce("events", F.lit(0)) + F.coalesce("_events", F.lit(0)),
            }
        )
        start = F.coalesce("_rate", start)
    changed = F.least(
        F.col("step.high"), F.greatest(F.col("step.low"), start * F.col("step.factor"))
    )
    # Steps that never occurred change nothing.
    rate = F.when(F.col("step").isNull(), start).otherwise(changed)
    return ended.select(*release_keys(names), "events", rate.alias("rate"), "streak", "failures")
