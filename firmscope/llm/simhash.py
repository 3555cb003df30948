"""SimHash near-duplicates by the generalised pigeonhole principle.

The 64 bits are dealt into parts of bits that go together, and each part gets
a number of units that add up to the distance plus one. Fingerprints within
the distance then agree, in at least one part with units, in all but fewer
bits than the part's units. Which part gets how many units is found by
dynamic programming over candidate counts that a sample predicts. A
fingerprint is filed in its bucket of each part and asks, where a part has
two units or more, in the buckets that differ from its own in as many bits;
candidates are verified by counting differing bits.

Equal fingerprints are one class from the start, so copies cost a row each
and no more. A bucket's tasks give a spanning forest of its links, not the
links; buckets of more than ``TILE`` classes are cut into tiles, each pair of
which is worked on by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import stored
from .graph import Forest, components
from .rows import every, luck, row_hash
from .words import ranges, stretches, tidy, words

SHINGLE = 3
DISTANCE = 3
SEED = 42
#: Classes of a bucket that one task compares at once.
TILE = 4096
#: Fingerprints that bit groups and units are planned on.
SAMPLE = 20_000


def _fingerprints(size: int):
    """Fingerprints of texts, in Arrow batches."""
    from xxhash import xxh64_intdigest

    def of_stretch(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        found = words(data, offsets)
        # The words once more with one space between them, and one between texts.
        lengths = found.ends - found.starts
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        joined = np.full(int(ends[-1]) + 1 if len(ends) else 0, 0x20, np.uint8)
        joined[ranges(starts, lengths)] = data[ranges(found.starts, lengths)]
        text = joined.tobytes()
        last = np.repeat(found.firsts[1:], found.counts)
        first = np.arange(len(starts))
        stop = np.minimum(first + size, last)
        own = np.repeat(found.firsts[:-1], found.counts)
        whole = (first + size <= last) | (first == own)
        first, stop = starts[first[whole]], ends[stop[whole] - 1]
        hashes = [xxh64_intdigest(text[a:b], SEED) for a, b in zip(first.tolist(), stop.tolist(), strict=True)]
        counts = np.where(found.counts >= size, found.counts - size + 1, np.minimum(found.counts, 1))
        return _votes(np.array(hashes, np.uint64), counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tidy(batches):
            for begin, end, data, offsets in stretches(batch.column(1), lower=True):
                made = of_stretch(data, offsets).view(np.int64)
                ids = batch.column(0).slice(begin, end - begin).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([ids, pa.array(made)], ["doc_id", "fp"])

    return run


def _votes(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per text, the bits that over half of its hashes have."""
    out = np.zeros(len(counts), np.uint64)
    bounds = np.concatenate(([0], np.cumsum(counts)))
    for low in range(0, 64, 8):
        byte = (hashes >> np.uint64(low)).astype(np.uint8)
        for bit in range(8):
            sums = np.zeros(len(hashes) + 1, np.int64)
            np.cumsum((byte >> bit) & 1, out=sums[1:])
            most = 2 * (sums[bounds[1:]] - sums[bounds[:-1]]) > counts
            out |= most.astype(np.uint64) << np.uint64(low + bit)
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of every whole text; fp is the fingerprint as a signed 64-bit number."""
    return docs.select("doc_id", "text").mapInArrow(_fingerprints(shingle), "doc_id long, fp long")


def _bits(fps: np.ndarray) -> np.ndarray:
    return (fps[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)


def bit_groups(fps: np.ndarray, parts: int) -> list[list[int]]:
    """Deal the 64 bits into parts of about equal size, bits that go together into one part.

    A part starts with the free bit of most variance, and takes the bits that
    go most with what it holds.
    """
    bits = _bits(fps).astype(float)
    if len(bits) < 2:
        return [sorted(range(64))[k::parts] for k in range(parts)]
    spread = bits.std(0)
    centred = (bits - bits.mean(0)) / np.where(spread > 0, spread, 1)
    together = np.abs(centred.T @ centred) / len(bits)
    free, groups = set(range(64)), []
    for k in range(parts):
        size = (64 - sum(map(len, groups))) // (parts - k)
        first = max(sorted(free), key=lambda b: spread[b])
        group = [first]
        free.discard(first)
        while len(group) < size:
            bit = max(sorted(free), key=lambda b: together[b, group].sum())
            group.append(bit)
            free.discard(bit)
        groups.append(sorted(group))
    return groups


def _near(values: np.ndarray, radius: int, pairs: tuple[np.ndarray, np.ndarray]) -> float:
    """Share of sampled pairs whose values differ in at most ``radius`` bits."""
    apart = np.bitwise_count(values[pairs[0]] ^ values[pairs[1]])
    return float(np.mean(apart <= radius))


def plan(fps: np.ndarray, n: int, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """(bit mask, units) of each part to be probed, for n distinct fingerprints.

    For each number of parts, units are dealt by dynamic programming so that
    the predicted work, rows filed and asked plus candidates compared, is least.
    """
    fps = np.unique(fps)
    luck = np.random.default_rng(7)
    size = max(len(fps), 1)
    pairs = luck.integers(0, size, 200_000), luck.integers(0, size, 200_000)
    apart = pairs[0] != pairs[1]
    pairs = pairs[0][apart], pairs[1][apart]
    best: tuple[float, list[tuple[int, int]]] = (np.inf, [])
    for parts in range(1, distance + 2):
        masks = [sum(1 << b for b in group) for group in bit_groups(fps, parts)]
        widths = [m.bit_count() for m in masks]
        cost = np.full((parts, distance + 2), np.inf)
        for k, mask in enumerate(masks):
            cost[k, 0] = 0.0
            for units in range(1, min(distance + 1, 3) + 1):
                asked = sum(_choose(widths[k], r) for r in range(units))
                share = _near(fps & np.uint64(mask), units - 1, pairs) if len(pairs[0]) else 0.0
                share = max(share, 2.0 ** -widths[k])
                cost[k, units] = n * asked + 0.05 * n * n * share
        least = np.full((parts + 1, distance + 2), np.inf)
        least[0, 0] = 0.0
        choice = np.zeros((parts + 1, distance + 2), int)
        for k in range(parts):
            for total in range(distance + 2):
                for units in range(total + 1):
                    now = least[k, total - units] + cost[k, units]
                    if now < least[k + 1, total]:
                        least[k + 1, total], choice[k + 1, total] = now, units
        if least[parts, distance + 1] < best[0]:
            dealt, total = [], distance + 1
            for k in range(parts, 0, -1):
                dealt.append((masks[k - 1], int(choice[k, total])))
                total -= int(choice[k, total])
            best = float(least[parts, distance + 1]), [(m, u) for m, u in dealt[::-1] if u]
    return best[1]


def _choose(n: int, k: int) -> int:
    return len(list(combinations(range(n), k))) if k else 1


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _filed(classes: DataFrame, parts: list[tuple[int, int]]) -> DataFrame:
    """(part, key, fp, asks): each class in its own buckets, and asking in near ones.

    Of two buckets that differ in one bit only the one with the bit unset
    asks, so that no pair meets twice for it; with two bits, the smaller asks.
    """
    rows = []
    for number, (mask, units) in enumerate(parts):
        own = F.col("fp").bitwiseAND(F.lit(_signed(mask)))
        rows.append(F.array(F.struct(F.lit(number).alias("part"), own.alias("key"), F.lit(False).alias("asks"))))
        bits = [b for b in range(64) if mask >> b & 1]
        for radius in range(1, units):
            flips = [_signed(sum(1 << b for b in some)) for some in combinations(bits, radius)]
            near = F.transform(F.array(*map(F.lit, flips)), lambda flip, own=own: own.bitwiseXOR(flip))
            near = F.filter(near, lambda key, own=own: key > own)
            rows.append(
                F.transform(
                    near,
                    lambda key, number=number: F.struct(F.lit(number).alias("part"), key.alias("key"), F.lit(True).alias("asks")),
                )
            )
    return classes.select("fp", F.explode(F.concat(*rows)).alias("f")).select("f.part", "f.key", "f.asks", "fp")


def _tiled(filed: DataFrame) -> DataFrame:
    """Add the tile: rows of a large bucket go to every pair of tiles that their own tile is in."""
    bucket = ["part", "key"]
    large = filed.groupBy(*bucket).agg(F.count("*").alias("n")).filter(F.col("n") > TILE)
    large = large.select(F.col("part").alias("p"), F.col("key").alias("k"), F.ceil(F.col("n") / TILE).cast("int").alias("g"))
    large = stored(large, "buckets")
    if not large.take(1):
        return filed.withColumn("tile", F.lit(0).cast("long"))
    same = (F.col("part") == F.col("p")) & (F.col("key") == F.col("k"))
    rows = filed.join(large, same, "left").withColumn("g", F.coalesce("g", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("g")).cast("long")
    others = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("g").cast("long") - 1),
        lambda other: F.least(own, other) * F.col("g") + F.greatest(own, other),
    )
    return rows.select(*bucket, "asks", "fp", F.explode(others).alias("tile"))


def _forests(distance: int):
    """Spanning forests of the links in each bucket, from rows sorted by bucket."""

    def links(keys: np.ndarray, fps: np.ndarray, asks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Links inside runs of equal keys, as two arrays of fingerprints."""
        edges = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
        begins = np.concatenate(([0], edges))
        sizes = np.diff(np.concatenate((begins, [len(keys)])))
        run = np.repeat(np.arange(len(begins)), sizes)
        left, right = [], []
        small = sizes <= 64
        for step in range(1, int(sizes[small].max(initial=1))):
            a = np.flatnonzero((run[:-step] == run[step:]) & small[run[:-step]])
            near = np.bitwise_count((fps[a] ^ fps[a + step]).view(np.uint64)) <= distance
            near &= ~(asks[a] & asks[a + step])
            left.append(fps[a[near]])
            right.append(fps[a[near] + step])
        for k in np.flatnonzero(~small):
            own = slice(begins[k], begins[k] + sizes[k])
            a, b = _forest(fps[own].view(np.uint64), asks[own], distance)
            left.append(fps[own][a])
            right.append(fps[own][b])
        if not left:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(left), np.concatenate(right)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None
        for batch in tidy(batches):
            table = pa.Table.from_batches([batch])
            table = table if kept is None else pa.concat_tables([kept, table])
            keys = _keys(table)
            # The last bucket may go on in the next batch.
            same = np.flatnonzero(np.any(keys != keys[-1], axis=1))
            cut = int(same[-1]) + 1 if len(same) else 0
            if cut:
                yield _linked(links, table.slice(0, cut))
            kept = table.slice(cut).combine_chunks()
        if kept is not None and len(kept):
            yield _linked(links, kept)

    return run


def _keys(table: pa.Table) -> np.ndarray:
    return np.stack([table[c].to_numpy().astype(np.int64) for c in ("part", "key", "tile")], 1)


def _linked(links, table: pa.Table) -> pa.RecordBatch:
    a, b = links(_keys(table), table["fp"].to_numpy(), table["asks"].to_numpy(zero_copy_only=False))
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _forest(fps: np.ndarray, asks: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Every linked row of one bucket with its root."""
    forest = Forest(len(fps))
    step = max(1, (1 << 22) // len(fps))
    for k in range(0, len(fps), step):
        near = np.bitwise_count(fps[k : k + step, None] ^ fps[None, :]) <= distance
        near &= ~(asks[k : k + step, None] & asks[None, :])
        a, b = np.nonzero(near)
        forest.join(a + k, b)
    every = np.arange(len(fps))
    roots = forest.roots(every)
    moved = roots != every
    return every[moved], roots[moved]


def links(classes: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): enough links between the distinct fingerprints ``fp`` to connect all within the distance."""
    n = classes.count()
    share = min(1.0, SAMPLE / max(n, 1))
    some = np.array([row.fp for row in classes.filter(luck("plan", "fp") < share).collect()], np.int64).view(np.uint64)
    filed = _tiled(_filed(classes, plan(some, n, distance)))
    width = max(1, int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = filed.repartition(width, "part", "key", "tile").sortWithinPartitions("part", "key", "tile")
    return dealt.mapInArrow(_forests(distance), "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id): the smallest id reachable by links of at most ``distance`` bits.

    One row per input row, repeated rows included; they share a fingerprint
    and so a component. Texts without words, null ones too, have fingerprint 0
    and are linked like any other. Rows with a null ``doc_id`` take part and
    name no component unless it has no other id. Other columns are not looked at.
    """
    marked = stored(fingerprints(docs, shingle), "fingerprints")
    classes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    found = components(links(classes.select("fp"), distance))
    rooted = classes.join(found, F.col("fp") == F.col("node"), "left")
    rooted = rooted.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.select(F.col("root").alias("r"), "component_id")
    of_class = rooted.join(named, F.col("root") == F.col("r")).select(F.col("fp").alias("f"), "component_id")
    of_class = stored(of_class, "components")
    return marked.join(of_class, F.col("fp") == F.col("f")).select("doc_id", "fp", "component_id")


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def deduplicated(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One document of each group, the one with the smallest id, with all its columns.

    Rows with a null ``doc_id`` stay. Of rows that repeat an id the one with
    the smallest hash of its columns stays. Texts without words, null ones
    too, are one group. An empty table stays empty. Columns may have any names
    and types.
    """
    kept = near_duplicates(docs, shingle, distance).filter(F.col("doc_id") == F.col("component_id"))
    kept = stored(kept.select(F.col("doc_id").alias("kept")).distinct(), "kept")
    rows = docs.select("doc_id", F.struct(*every(docs)).alias("row"), row_hash(docs).alias("hash"))
    one = Window.partitionBy("doc_id").orderBy("hash")
    rows = rows.join(kept, F.col("doc_id") == F.col("kept")).withColumn("place", F.row_number().over(one))
    rows = rows.filter("place = 1").select("row.*")
    return rows.union(docs.filter("doc_id is null"))
