"""Results that depend on the order of rows, computed without one task per key.

A running value over one key would put all rows of that key into one task. So
the rows are cut into ranges of the order by key and time, each holding a
bounded share of all rows. Every (key, range) is worked on by itself, summed up
in one row, the summaries are chained per key (never more than the number of
ranges), and what went before is added back to the rows. Most keys lie in one
range, so there are hardly more summaries than keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from firmscope.shared import pin, stored

RANGE_ROWS = 1_000_000
#: Ranges whose sizes one task adds up.
SUMMED = 1_000


def range_count(df: DataFrame) -> int:
    """As many ranges as shuffles have partitions, and more where a range would hold too many rows."""
    wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(2, wanted, -(-df.count() // RANGE_ROWS))


def with_ranges(
    df: DataFrame, key: Sequence[str], time: str, tie: str, ranges: int | None = None
) -> DataFrame:
    """Add ``_range``, which never decreases along (time, tie) for a key.

    The rows are range-partitioned by key, time and tie, of any orderable types,
    and a row's range is the partition it fell to. A frequent key, or an instant
    of it, spans as many ranges as its rows need; of the others at most one per
    range lies on its edge, so there are hardly more (key, range) pairs than
    keys and ranges. The cuts follow from Spark's own sample; rows and ranges
    are written, so that tasks that run again find the same ones, and the plan
    does not grow with their number.
    """
    ranges = ranges or range_count(df)
    split = df.repartitionByRange(ranges, *key, time, tie)
    return stored(split.withColumn("_range", F.spark_partition_id().cast("bigint")), "ranges")


def in_range(key: Sequence[str], *order: str):
    """Window over one key in one range, up to the current row."""
    return (
        Window.partitionBy(*key, "_range")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def before_range(key: Sequence[str]):
    """Window over the summaries of the same key's earlier ranges."""
    return (
        Window.partitionBy(*key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    )


def hold_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Replace key columns by ones without nulls, a flag telling them apart.

    A missing key is then a key like any other: it survives the joins of rows
    with their sums, and Spark adds no null filters that would make the two
    sides of such a join read and shuffle the rows separately.
    """
    for name in key:
        kind = df.schema[name].dataType
        plain = 0 if isinstance(kind, (T.NumericType, T.BooleanType)) else "1970-01-01"
        df = df.withColumn(f"_no_{name}", F.col(name).isNull()).withColumn(
            name, F.coalesce(F.col(name), F.lit(plain).cast(kind))
        )
    return df


def held(key: Sequence[str]) -> list[str]:
    """All columns that ``hold_keys`` keeps a key in."""
    return [part for name in key for part in (name, f"_no_{name}")]


def release_keys(key: Sequence[str]) -> list[Column]:
    return [F.when(~F.col(f"_no_{name}"), F.col(name)).alias(name) for name in key]


def micros(df: DataFrame, time: str, value: Column | None = None) -> Column:
    """Microseconds since 1970 of a time column, or of a value of its type.

    Times without a zone count as UTC whatever the session's zone is.
    """
    kind = df.schema[time].dataType
    instant = (F.col(time) if value is None else value).cast(kind)
    if isinstance(kind, T.TimestampNTZType):
        minutes = F.unix_date(instant.cast("date")).cast("bigint") * 1_440 + (
            F.hour(instant) * 60 + F.minute(instant)
        )
        seconds = F.extract(F.lit("SECOND"), instant) * 1_000_000
        return minutes * 60_000_000 + seconds.cast("bigint")
    return F.unix_micros(instant)


# Numbering and chunks

def _hashable(df: DataFrame) -> list[str]:
    """Columns that can be hashed: all but maps and variants, also inside others."""
    return [
        field.name
        for field in df.schema.fields
        if not any(kind in field.dataType.simpleString() for kind in ("map<", "variant"))
    ]


def _with_tie(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``_digest`` and ``_tie``, which tell rows of equal order apart, copies as well.

    The first is a hash of the row, the second its place in its task. The rows
    are sorted first, so that a task that runs again gives the same places
    whatever order its input comes in.
    """
    digested = df.withColumn("_digest", F.xxhash64(*_hashable(df)))
    return digested.sortWithinPartitions(*order, "_digest").withColumn(
        "_tie", F.monotonically_increasing_id()
    )


def number_rows(
    df: DataFrame, *order: str, unique: bool = False, ranges: int | None = None
) -> DataFrame:
    """Add ``row_no`` (from 0) along columns of any types.

    One range shuffle. Rows of equal order are told apart, so that many copies
    can be split too; ``unique`` says that there are none and saves that sort.
    Each partition counts its own rows; only the counts, one per partition, are
    summed in one place. The split is pinned, because counts and rows must come
    from the same one.
    """
    ranges = ranges or range_count(df)
    told = df if unique else _with_tie(df, order)
    full_order = order if unique else (*order, "_digest", "_tie")
    split = (
        told.repartitionByRange(ranges, *full_order)
        .sortWithinPartitions(*full_order)
        .drop("_digest", "_tie")
        .withColumn("_place", F.monotonically_increasing_id())
    )
    pinned = pin(split)
    # The id holds the partition above bit 33 and the place in it below.
    part = F.shiftright("_place", 33)
    place = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    counts = pinned.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    # Sums in groups of ranges, and of the groups before, so that no task adds up all ranges.
    grouped = counts.withColumn("_group", F.expr(f"_part div {SUMMED}"))
    inside = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = grouped.groupBy("_group").agg(F.sum("_rows").alias("_sum"))
    groups = groups.select("_group", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    within = F.coalesce(F.sum("_rows").over(inside), F.lit(0)).alias("_within")
    offsets = grouped.select("_part", "_group", within).join(groups, "_group")
    # Written first: Spark then knows how few they are and need not shuffle the rows to meet them.
    offsets = stored(
        offsets.select("_part", (F.col("_base") + F.col("_within")).alias("_offset")), "offsets"
    )
    return (
        pinned.withColumn("_part", part)
        .join(offsets, "_part")
        .withColumn("row_no", F.col("_offset") + place)
        .drop("_part", "_offset", "_place")
    )


def chunk_rows(
    df: DataFrame, chunk_size: int, *order: str, unique: bool = False
) -> DataFrame:
    """Add ``chunk_id``: consecutive slices of ``chunk_size`` rows, the last one short."""
    numbered = number_rows(df, *order, unique=unique)
    return numbered.withColumn("chunk_id", F.expr(f"row_no div {int(chunk_size)}")).drop("row_no")


def _range_of(keys: list[Column], cuts: list[tuple]) -> Column:
    """How many of the sorted cuts are not above a row, by a search tree of comparisons."""

    def above(cut: tuple) -> Column:
        """Whether the row stands before the cut; a missing value stands before all others."""
        before = F.lit(False)
        for key, value in reversed(list(zip(keys, cut, strict=True))):
            if value is None:
                before = key.isNull() & before
            else:
                value = F.lit(value)
                before = key.isNull() | (key < value) | ((key == value) & before)
        return F.coalesce(before, F.lit(False))

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(above(cuts[middle]), search(low, middle)).otherwise(search(middle + 1, high))

    return search(0, len(cuts))


def slice_rows(
    df: DataFrame, start: int, length: int | None, *order: str, unique: bool = False
) -> DataFrame:
    """Rows ``start`` to ``start + length`` of the order (to the end without length).

    Rows of equal order stand by a hash of their columns, at any length. A
    sample of bounded size cuts the order into a few ranges; one pass counts
    them. Of the ranges that hold an end of the slice large ones are cut again,
    and what is left is numbered. Rows between those ends are taken as they are
    read, so a slice costs no copy of the table.
    """
    told = df if unique else df.withColumn("_mark", F.xxhash64(*_hashable(df)))
    names = [*order] if unique else [*order, "_mark"]
    end = None if length is None else start + length
    found = _slice(told, start, end, names, unique)
    return df.limit(0) if found is None else found.select(*df.columns)


def _slice(told: DataFrame, start: int, end: int | None, names: Sequence[str], unique: bool) -> DataFrame | None:
    keys = [F.col(name) for name in names]
    cuts = _cuts(told.select(*keys))
    ranged = told.withColumn("_part", _range_of(keys, cuts))
    sizes = {row._part: row["count"] for row in ranged.groupBy("_part").count().collect()}
    whole, edges, before = [], [], 0
    for part in range(len(cuts) + 1):
        first, last = before, before + sizes.get(part, 0)
        before = last
        if last <= start or first == last or (end is not None and first >= end):
            continue
        (whole if first >= start and (end is None or last <= end) else edges).append((part, first))
    parts = [ranged.filter(F.col("_part").isin([part for part, _ in whole])).drop("_part")] if whole else []
    for part, first in edges:
        own = ranged.filter(F.col("_part") == part).drop("_part")
        low, high = max(0, start - first), None if end is None else end - first
        if sizes[part] > RANGE_ROWS and len(sizes) > 1:
            parts.append(_slice(own, low, high, names, unique))
            continue
        row_no = F.col("row_no")
        chosen = row_no >= low if high is None else (row_no >= low) & (row_no < high)
        parts.append(number_rows(own, *names, unique=unique).filter(chosen).drop("row_no"))
    return reduce(DataFrame.unionByName, parts) if parts else None


#: Rows that the cuts of a slice are taken from, and how many cuts there are.
SAMPLED, CUTS = 4_000, 15


def _cuts(keys: DataFrame) -> list[tuple]:
    """Rows that cut the order into about equal ranges, from a sample chosen by hashes."""
    n = keys.count()
    luck = F.shiftrightunsigned(F.xxhash64(F.lit("cuts"), *keys.columns), 11) / F.lit(float(1 << 53))
    some = keys.filter(luck < min(1.0, SAMPLED / max(n, 1))).distinct().limit(4 * SAMPLED)
    rows = [tuple(row) for row in some.orderBy(*keys.columns).collect()]
    # Values that no comparison with a literal could be exact for are left to one range.
    rows = [row for row in rows if not any(isinstance(v, float) or isinstance(v, (list, dict, tuple)) for v in row)]
    step = max(1, len(rows) // (CUTS + 1))
    return rows[step::step][:CUTS]


def sample_head(df: DataFrame, count: int, *order: str) -> DataFrame:
    return df.orderBy(*order).limit(count)


def write_chunks(chunked: DataFrame, path: str) -> None:
    """Write what ``chunk_rows`` gives, so that ``chunk_id <= k`` reads few files.

    The rows are already split along the chunks, so each file covers a narrow
    run of them and Parquet's own statistics skip the others; nothing is
    shuffled again. A folder per chunk would mean one per few hundred rows.
    """
    chunked.write.mode("overwrite").parquet(path)


def checkpoint_prefix(table: DataFrame, chunk: int) -> DataFrame:
    """What had been written once chunk number ``chunk`` was done."""
    return table.filter(F.col("chunk_id") <= chunk)


# Progress of a run

def _progress_columns() -> list[Column]:
    elapsed = (F.col("_now") - F.col("_start")) / F.lit(1_000_000.0)
    rate = F.when(elapsed > 0, F.col("processed") / elapsed).otherwise(F.lit(0.0))
    left = F.col("total") - F.col("processed")
    return [
        F.col("total"),
        F.col("processed"),
        F.col("successful"),
        F.col("failed"),
        (F.col("processed") / F.col("total") * 100.0).alias("percent"),
        elapsed.alias("elapsed"),
        rate.alias("rate"),
        F.when(rate > 0, left / rate).otherwise(F.lit(0.0)).alias("eta"),
    ]


def run_progress_final(log: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Per run: counts, share, rate and time left as of its last row.

    ``log`` has (run, ts, id, ok). A run starts at its first row. ``totals``
    (run, total) says how many rows a run will have; without it, those it has.
    """
    now = micros(log, "ts")
    summed = log.groupBy("run").agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(F.col("ok")).alias("successful"),
        F.count_if(~F.col("ok")).alias("failed"),
        F.min(now).alias("_start"),
        F.max(now).alias("_now"),
    )
    if totals is None:
        planned = summed.withColumn("total", F.col("processed"))
    else:
        planned = summed.join(totals, "run")
    return planned.select("run", *_progress_columns())


def run_progress_running(
    log: DataFrame, report_every: int = 50, ranges: int | None = None
) -> DataFrame:
    """A report after every ``report_every`` rows of each run, in order of (ts, id).

    Ids of any orderable type; those that are no numbers are numbered first.
    """
    key = held(["run"])
    narrow = log.select("run", F.col("id").alias("_id"), "ok", micros(log, "ts").alias("_now"))
    if not isinstance(narrow.schema["_id"].dataType, T.NumericType):
        narrow = number_rows(narrow, "_now", "_id").drop("_id").withColumnRenamed("row_no", "_id")
    rows = with_ranges(hold_keys(narrow, ["run"]), key, "_now", "_id", ranges)
    order = in_range(key, "_now", "_id")
    counted = rows.select(
        *key, "_range", "_id", "_now",
        F.count(F.lit(1)).over(order).alias("_n"),
        F.count_if(F.col("ok")).over(order).alias("_ok"),
    )
    sums = rows.groupBy(*key, "_range").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(F.col("ok")).alias("_good"),
        F.min("_now").alias("_first"),
    )
    whole = Window.partitionBy(*key)
    carried = sums.select(
        *key, "_range",
        F.coalesce(F.sum("_rows").over(before_range(key)), F.lit(0)).alias("_rows_before"),
        F.coalesce(F.sum("_good").over(before_range(key)), F.lit(0)).alias("_good_before"),
        F.sum("_rows").over(whole).alias("total"),
        F.min("_first").over(whole).alias("_start"),
    )
    reports = (
        counted.join(carried, [*key, "_range"])
        .withColumn("processed", F.col("_n") + F.col("_rows_before"))
        .filter(F.col("processed") % report_every == 0)
        .withColumn("successful", F.col("_ok") + F.col("_good_before"))
        .withColumn("failed", F.col("processed") - F.col("successful"))
    )
    return reports.select(*release_keys(["run"]), *_progress_columns())
