"""Mixing sources to target weights by Sainte-Lague apportionment.

All token blocks are of equal size. A source's share of the blocks is its
quota under Sainte-Lague's rule (the highest quotients target / 1, 3, 5 ...
win), its quota is dealt to the source's shards by the same rule over their
sizes. A shard's documents stand in an order that follows from a seed; blocks
are cut along it and the first ones are taken, after as many whole rounds as
the quota holds, so that of each shard at most one document is cut. Only
DataFrame functions are used.

Quotients are not listed one by one. Rounding every target by the common
divisor gives quotas whose sum is off by at most half the number of rivals,
and as all quotas then move the same way, a rival's quota moves by at most
1.5 * rivals * share + 1. Only that many quotients per rival are ranked, at
most 4.5 per rival on average, however many blocks there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import new_folder
from .rows import every, row_hash

WORD = r"[^\x20\x09-\x0D]+"
PIECE = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
BLOCK = 8
SHARD_WORDS = 500_000
#: Shards that are given their quotas together.
GROUP = 1000
SEED = 11


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _mark(seed: int) -> Column:
    """The seeded place of a row in its source's order, by id and text: rows that share one of them are spread."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(f"{seed}:"), name, F.lit(":"), F.md5(F.coalesce("text", F.lit("")))).cast("binary")).alias("mark")


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Add each source's target to (source, source_size).

    Sources in code point order, null last, get the weights in turn. A target
    is the smaller of ``most`` times the source and weight times one common
    level, the level at which the targets add up to ``share`` of everything:
    what capped sources leave is thereby shared again by weight.
    """
    everything = Window.partitionBy()
    ranked = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(ranked) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), turn + 1)
    cap = F.col("source_size") * float(most)
    rows = sources.select("source", "source_size", weight.alias("weight"), cap.alias("cap"))
    filled = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    capped = F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    heavy = F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = (F.sum("source_size").over(everything) * share - capped) / (F.sum("weight").over(everything) - heavy)
    rows = rows.withColumn("level", level)
    fits = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))
    rows = rows.withColumn("level", F.max(fits).over(everything))
    target = F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    return rows.select("source", "source_size", target.alias("target"))


def apportion(rivals: DataFrame, within: list[str], order: list[Column], votes: str, seats: str) -> DataFrame:
    """Add ``quota``: ``seats`` of each group of ``within`` dealt by ``votes`` under Sainte-Lague's rule.

    Equal quotients go to the rival that is first in ``order``. Without votes
    nobody gets a seat.
    """
    group = Window.partitionBy(*within)
    total, v = F.sum(votes).over(group), F.col(votes)
    rows = rivals.withColumn("part", F.when(total > 0, v / total).otherwise(0.0))
    rows = rows.withColumn("first", F.floor(F.col("part") * F.col(seats) + 0.5).cast("long"))
    missing = F.when(total > 0, F.col(seats) - F.sum("first").over(group)).otherwise(F.lit(0))
    rows = rows.withColumn("missing", missing.cast("long"))
    moves = (F.ceil(F.count("*").over(group) * F.col("part") * 1.5) + 2).cast("int")
    rows = rows.withColumn("moves", moves).withColumn("place", F.row_number().over(group.orderBy(*order)))
    steps = rows.filter("missing != 0").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("moves"))))
    more = F.col("missing") > 0
    seat = F.when(more, F.col("first") + F.col("k") - 1).otherwise(F.col("first") - F.col("k"))
    steps = steps.withColumn("seat", seat).filter("seat >= 0")
    quotient = v / (2 * F.col("seat") + 1)
    ranking = group.orderBy(
        F.when(more, -quotient).otherwise(quotient), F.when(more, F.col("place")).otherwise(-F.col("place"))
    )
    steps = steps.withColumn("rank", F.row_number().over(ranking)).filter(F.col("rank") <= F.abs("missing"))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in within] + [F.col("a.place") == F.col("b.place")]
    moved = steps.groupBy(*within, "place").agg(F.sum(F.signum("missing")).cast("long").alias("moved"))
    joined = rows.alias("a").join(moved.alias("b"), [c for c in same], "left")
    return joined.select(
        *(F.col(f"a.{c}") for c in rivals.columns),
        (F.col("a.first") + F.coalesce(F.col("b.moved"), F.lit(0))).alias("quota"),
    )


def _sized(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, source, size and the seeded mark of each row, written once."""
    path = new_folder(docs.sparkSession, "sizes")
    docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), _mark(seed)).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def _shard() -> Column:
    number = F.conv(F.substring("mark", 1, 8), 16, 10).cast("long")
    return F.pmod(number, F.col("shards"))


def quotas(sized: DataFrame, block: int, shard_words: int) -> tuple[DataFrame, DataFrame]:
    """(source, source_size, target, shards) and (source, shard, shard_size, quota) of sized rows."""
    sources = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long")
    seats = F.floor(F.sum("source_size").over(Window.partitionBy()) * SHARE / block + 0.5).cast("long")
    sources = sources.withColumn("shards", shards).withColumn("seats", seats)
    sources = apportion(sources, [], [F.col("source").asc_nulls_last()], "target", "seats")
    path = new_folder(sized.sparkSession, "sources")
    sources.select("source", "source_size", "target", "shards", F.col("quota").alias("blocks")).write.parquet(path)
    sources = sized.sparkSession.read.parquet(path)
    parts = _with(sized, sources, "source", "size").withColumn("shard", _shard())
    parts = parts.groupBy("source", "shard", "blocks").agg(F.sum("size").alias("shard_size"))
    # Dealt to groups of shards first, so that no task holds all shards of a source.
    parts = parts.withColumn("group", F.floor(F.col("shard") / GROUP).cast("long"))
    groups = parts.groupBy("source", "group", "blocks").agg(F.sum("shard_size").alias("group_size"))
    groups = apportion(groups, ["source"], [F.col("group")], "group_size", "blocks")
    groups = groups.select(F.col("source").alias("its"), F.col("group").alias("its_group"), F.col("quota").alias("seats"))
    same = F.col("source").eqNullSafe(F.col("its")) & (F.col("group") == F.col("its_group"))
    parts = apportion(parts.join(groups, same), ["source", "group"], [F.col("shard")], "shard_size", "seats")
    return sources, parts.select("source", "shard", "shard_size", "quota")


def _with(rows: DataFrame, sources: DataFrame, *more: str) -> DataFrame:
    s = sources.select(F.col("source").alias("its"), *(c for c in sources.columns if c != "source"))
    return rows.join(s, F.col("source").eqNullSafe(F.col("its"))).drop("its")


def _taken(rows: DataFrame, parts: DataFrame, block: int, order: list[Column]) -> DataFrame:
    """Add full, how often the row is taken whole, and first, how many of its words are taken once more."""
    p = parts.select(F.col("source").alias("its"), F.col("shard").alias("sh"), "shard_size", "quota")
    rows = rows.withColumn("shard", _shard())
    rows = rows.join(p, F.col("source").eqNullSafe(F.col("its")) & (F.col("shard") == F.col("sh"))).drop("its", "sh")
    stream = Window.partitionBy("source", "shard").orderBy("mark", F.col("doc_id"), F.col("size"), *order)
    start = F.sum("size").over(stream.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("shard_size") / block)).cast("long")
    rows = rows.withColumn("start", start).withColumn("n_blocks", blocks)
    quota = F.least("quota", F.col("n_blocks") * MOST)
    rows = rows.withColumn("full", F.floor(quota / F.col("n_blocks")).cast("long"))
    rest = quota - F.col("full") * F.col("n_blocks")
    return rows.withColumn("first", F.greatest(F.lit(0), F.least("size", rest * block - F.col("start"))).cast("long"))


def mix(docs: DataFrame, block: int = BLOCK, shard_words: int = SHARD_WORDS, seed: int = SEED) -> DataFrame:
    """How many words the mix takes of each document.

    One row per input row: doc_id, source, size, source_size, target, taken.
    A null text has size 0 and nothing is taken of it; a null source is a
    source, a null ``doc_id`` stays null. Repeated rows are documents of their
    own that stand side by side. A table without words or rows takes nothing.
    Other columns are not looked at. Each source's taken words differ from its
    target by at most about one block per shard, and no document gives more
    than ``MOST`` times its words. Reruns agree: places follow from ``seed``
    and the rows.
    """
    sized = _sized(docs, seed)
    sources, parts = quotas(sized, block, shard_words)
    every_row = _with(sized, sources)
    rows = _taken(every_row.filter("size > 0"), parts, block, [])
    taken = (F.col("full") * F.col("size") + F.col("first")).alias("taken")
    columns = ["doc_id", "source", "size", "source_size", "target"]
    # Nothing can be taken of rows without words; they need no place.
    none = every_row.filter("size = 0").select(*columns, F.lit(0).cast("long").alias("taken"))
    return rows.select(*columns, taken).union(none)


def mixed_documents(docs: DataFrame, block: int = BLOCK, shard_words: int = SHARD_WORDS, seed: int = SEED) -> DataFrame:
    """The mix as documents: a row for each time that words of a document are taken.

    A document that is cut keeps its first words with the white space between
    them; a text taken whole is unchanged. Rows of which no word is taken go,
    null and empty texts with them; an empty table stays empty. Null ids and
    sources and repeated rows are as in ``mix``. All columns stay, of any
    names and types; ``n_chars``, where present, is that of the new text.
    """
    sized = _sized(docs, seed)
    sources, parts = quotas(sized, block, shard_words)
    size, row = size_of(F.col("text")).alias("size"), F.struct(*every(docs)).alias("row")
    rows = docs.select("doc_id", "source", "text", size, _mark(seed), row, row_hash(docs).alias("hash")).filter("size > 0")
    rows = _taken(_with(rows, sources), parts, block, [F.col("hash")])
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(MOST))))
    part = F.col("copy") == F.col("full") + 1
    n = F.when(F.col("copy") <= F.col("full"), F.col("size")).when(part, F.col("first")).otherwise(0)
    rows = rows.withColumn("n", n).filter("n > 0")
    pieces = F.slice(F.regexp_extract_all("text", F.lit(PIECE), F.lit(0)), 1, F.col("n").cast("int"))
    rows = rows.withColumn("new", F.when(F.col("n") == F.col("size"), F.col("text")).otherwise(F.array_join(pieces, "")))
    new = {"text": F.col("new"), "n_chars": F.length("new").cast("long")}
    return rows.select(*(new.get(c, F.col("row")[c]).alias(c) for c in docs.columns))
