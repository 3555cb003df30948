"""Streams over landed files.

Every job writes one folder per micro-batch and overwrites that folder when a
batch is repeated after a failure, so each row counts once. Rate shaping keeps
its state as a small table per batch instead of in a keyed state store: the
batch is shaped with the same range-wise operators as a table, so one key may
hold most of a batch. No Python worker sees a row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from firmscope.operators import expiry
from firmscope.operators.expiry import newest_answers
from firmscope.operators.lookup import DEFAULT_LIFETIME, LIFETIMES
from firmscope.operators.ordered import micros
from firmscope.operators.shaping import adaptive_rate, token_bucket_step
from firmscope.operators.wanted import only_wanted
from firmscope.plans.enrich import Lookups, attach
from firmscope.shared import stored

Callback = Callable[[DataFrame, int], None]


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def _run(
    stream: DataFrame, step: Callback, checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _folder(path: str, batch_id: int) -> str:
    return f"{path}/batch={batch_id}"


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All batches written so far, with their number in ``batch``."""
    return spark.read.parquet(path)


def enrich_stream(
    companies: DataFrame,
    lookups: Lookups,
    out: str,
    checkpoint: str,
    on_batch: Callback | None = None,
) -> StreamingQuery:
    """Enrich companies as they arrive; a restart goes on where it stopped.

    The lookups are worked out once and kept in the shared folder, so a batch
    costs two joins with what its companies need and does not read documents or
    pages again. ``on_batch`` is called with each batch's result once written.
    """
    ready = lookups.each(lambda lookup: stored(lookup, "lookup"))

    def step(batch: DataFrame, batch_id: int) -> None:
        folder = _folder(out, batch_id)
        batch.persist()
        try:
            attach(batch, ready.for_companies(batch)).write.mode("overwrite").parquet(folder)
        finally:
            batch.unpersist()
        if on_batch:
            on_batch(batch.sparkSession.read.parquet(folder), batch_id)

    return _run(companies, step, checkpoint)


def first_requests(
    requests: DataFrame,
    time: str,
    out: str,
    state_path: str,
    checkpoint: str,
    lifetimes: Mapping[str, int] = LIFETIMES,
    default: int = DEFAULT_LIFETIME,
    answers: DataFrame | None = None,
    ranges: int | None = None,
) -> StreamingQuery:
    """Write the requests of a stream that must be asked for, as (prefix, key, asked_us).

    The state says when each key was asked for last; each batch is worked on by
    the operator for tables, which spreads a frequent key over tasks. A request
    is asked for if there is no such time or the lifetime of its kind has passed
    since, exactly; one that comes late is answered by what is known by then.
    Nothing is dropped. ``answers`` (prefix, key, fetched_at) are landed before
    the stream; the newest one of a key counts as asked for then.
    """

    def shape(batch: DataFrame, state: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        if state is None and answers is not None:
            state = newest_answers(answers)
        asked = stored(expiry.first_requests(batch, time, lifetimes, default, state, ranges), "asked")
        return asked, expiry.asked_last(asked, state)

    return _stateful(requests, shape, out, state_path, checkpoint)


def write_stream(
    rows: DataFrame,
    out: str,
    checkpoint: str,
    change: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Write each micro-batch, or what ``change`` makes of it, to its own folder."""

    def step(batch: DataFrame, batch_id: int) -> None:
        (change(batch) if change else batch).write.mode("overwrite").parquet(_folder(out, batch_id))

    return _run(rows, step, checkpoint)


def progress_stream(
    log: DataFrame, out: str, state_path: str, checkpoint: str, idle: int = 86_400
) -> StreamingQuery:
    """Counts per run, written for the runs that a batch changed.

    The state holds the runs that are going on. One that logs nothing while
    ``idle`` seconds pass in the log has ended and leaves the state; a row that
    comes later still finds its counts in what was written, so it opens again
    exactly where it stood.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        counted = batch.groupBy("run").agg(
            F.count(F.lit(1)).alias("processed"),
            F.count_if(F.col("ok")).alias("successful"),
            F.count_if(~F.col("ok")).alias("failed"),
            F.max(micros(batch, "ts")).alias("last"),
        )
        counted = stored(counted.withColumn("_changed", F.lit(True)), "counts")
        known = counted.limit(0)
        if batch_id:
            known = spark.read.parquet(_folder(state_path, batch_id - 1)).withColumn("_changed", F.lit(False))
            ended = counted.select("run").join(known, "run", "left_anti")
            written = read_batches(spark, out).filter(F.col("batch") < batch_id)
            written = latest(only_wanted(written, F.col("run"), ended), ["run"]).join(ended, "run", "left_semi")
            known = known.unionByName(written.withColumn("_changed", F.lit(False)))
        merged = known.unionByName(counted).groupBy("run").agg(
            *(F.sum(c).alias(c) for c in ("processed", "successful", "failed")),
            F.max("last").alias("last"), F.max("_changed").alias("_changed"),
        )
        merged = stored(merged, "progress")
        merged.filter("_changed").drop("_changed").write.mode("overwrite").parquet(_folder(out, batch_id))
        clock = F.lit(merged.agg(F.max("last")).first()[0]).cast("bigint")
        # A run without a name is told by no bitmap and stays.
        going_on = F.col("run").isNull() | F.coalesce(F.col("last") >= clock - idle * 1_000_000, F.lit(True))
        merged.filter(going_on).drop("_changed").write.mode("overwrite").parquet(_folder(state_path, batch_id))

    return _run(log, step, checkpoint)


def latest(batches: DataFrame, key: Sequence[str]) -> DataFrame:
    """The newest row per key."""
    rest = [c for c in batches.columns if c not in (*key, "batch")]
    newest = F.max_by(F.struct(*rest), "batch").alias("_row")
    return batches.groupBy(*key).agg(newest).select(*key, "_row.*")


def _stateful(
    stream: DataFrame,
    shape: Callable[[DataFrame, DataFrame | None], tuple[DataFrame | None, DataFrame]],
    out: str | None,
    state_path: str,
    checkpoint: str,
) -> StreamingQuery:
    """Run ``shape(batch, state) -> (rows, new state)`` on every batch."""

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            state = None
            if batch_id > 0:
                state = spark.read.parquet(_folder(state_path, batch_id - 1))
            rows, after = shape(batch, state)
            if out and rows is not None:
                rows.write.mode("overwrite").parquet(_folder(out, batch_id))
            after.write.mode("overwrite").parquet(_folder(state_path, batch_id))
        finally:
            batch.unpersist()

    return _run(stream, step, checkpoint)


def token_bucket_stream(
    events: DataFrame,
    key: Sequence[str],
    time: str,
    order: str,
    rate: float,
    burst: int | None,
    out: str,
    state_path: str,
    checkpoint: str,
    ranges: int | None = None,
) -> StreamingQuery:
    """Token bucket over a stream.

    Events are served batch by batch, inside a batch by (time, order). An
    event that arrives in a later batch than younger ones is served after
    them, as a caller that shows up late would be; nothing is dropped.
    """

    def shape(batch: DataFrame, state: DataFrame | None) -> tuple[DataFrame, DataFrame]:
        return token_bucket_step(batch, key, time, order, rate, burst, None, ranges, state)

    return _stateful(events, shape, out, state_path, checkpoint)


def adaptive_rate_stream(
    outcomes: DataFrame,
    key: Sequence[str],
    time: str,
    order: str,
    ok: str,
    limited: str,
    initial: float,
    floor: float,
    ceiling: float,
    state_path: str,
    checkpoint: str,
    ranges: int | None = None,
) -> StreamingQuery:
    """Adaptive limit over a stream; the newest state holds each key's rate."""

    def shape(batch: DataFrame, state: DataFrame | None) -> tuple[None, DataFrame]:
        return None, adaptive_rate(
            batch, key, time, order, ok, limited, initial, floor, ceiling, ranges, state
        )

    return _stateful(outcomes, shape, None, state_path, checkpoint)
