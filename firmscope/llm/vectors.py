"""Embedding near-duplicates by product quantisation.

Unit vectors are filed in inverted lists by their nearest coarse centroid, and
what is left of them is coded per subspace. A query looks into its ``PROBES``
nearest lists: tables of squared distances from each of its subvectors to the
codebook's give its distance to every coded vector by lookups and a sum. A
coded vector knows its own coding error, so the triangle inequality says
which distances can still be near enough: no candidate is lost by the codes.
Candidates are ranked again by the exact cosine in double precision.

Equal vectors are one class. A link is counted in one list only, even where
both ends probe each other's list, and a list's tasks give link counts and a
spanning forest, not the links. Lists are cut into tiles of bounded size.

The first centroids are few enough to be sent to every task. Where they are
not enough, each list that is too long is divided by centroids of its own,
learned from a sample of its vectors in a task of its own and kept as a table
that the vectors are joined with; a query then looks into the nearest parts of
the lists that it probes. So a query meets about as many vectors however many
there are.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from decimal import Decimal
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import stored
from .blocks import tidied
from .graph import Forest, components
from .rows import luck

COSINE = 0.95
PROBES = 8
SUBSPACES = 8
CODES = 64
#: Vectors of a list on average, and most lists of one length at the first level.
PER_LIST, MOST_LISTS = 400, 4096
#: A list longer than so many times ``PER_LIST`` is divided, into so many parts at most.
LONG, MOST_PARTS = 3, 1 << 11
#: Numbers of a list and its parts: the list's is a multiple, the parts' follow.
PARTS = 1 << 12
#: Added to an id, so that all are written with as many digits and no sign.
_UP = Decimal(1 << 63)
#: In place of those digits where all rows of a vector lack an id; behind all digits.
_NO_ID = "~" * 20
#: Classes that centroids and codebooks are fitted on: so many, or so many per list.
SAMPLE, SAMPLE_PER_LIST = 20_000, 16
#: Coded vectors and queries that meet in one tile.
TILE, ASKING = 4096, 16_384
_CHUNK = 1 << 21


class Model(NamedTuple):
    """Coarse centroids and codebooks of the vectors of one length, whose lists are numbered from ``first`` on."""

    first: int
    centroids: np.ndarray
    codebooks: np.ndarray  # subspace, code, component


def _means(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Lloyd's centroids from k rows picked by a seeded generator; an empty one keeps its place."""
    generator = np.random.default_rng(seed)
    centres = x[generator.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = _nearest(x, centres, 1)[:, 0]
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        n = np.bincount(own, minlength=len(centres))
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def _nearest(x: np.ndarray, centres: np.ndarray, k: int) -> np.ndarray:
    """The k nearest centres of each row, nearest first."""
    out = np.zeros((len(x), k), np.int32)
    step = max(1, _CHUNK // len(centres))
    norms = (centres**2).sum(1)
    for a in range(0, len(x), step):
        far = norms - 2 * x[a : a + step] @ centres.T
        best = np.argpartition(far, k - 1, axis=1)[:, :k] if k < len(centres) else np.tile(np.arange(k), (len(far), 1))
        order = np.argsort(np.take_along_axis(far, best, 1), axis=1, kind="stable")
        out[a : a + step] = np.take_along_axis(best, order, 1)
    return out


def _split(x: np.ndarray) -> np.ndarray:
    """Rows as subvectors, filled up with zeros: subspace, row, component."""
    width = -(-x.shape[1] // SUBSPACES)
    wide = np.zeros((len(x), width * SUBSPACES))
    wide[:, : x.shape[1]] = x
    return wide.reshape(len(x), SUBSPACES, width).transpose(1, 0, 2)


def train(sample: np.ndarray, lists: int, first: int = 0) -> Model:
    """Coarse centroids and residual codebooks of unit vectors."""
    centroids = _means(sample, lists, 8, 1)
    left = sample - centroids[_nearest(sample, centroids, 1)[:, 0]]
    books = [_means(part, CODES, 8, 2 + k) for k, part in enumerate(_split(left))]
    return Model(first, centroids, np.stack(books))


class Models:
    """The models of all lengths that a sample holds; any other length has one list and no codes."""

    def __init__(self, own: dict[int, Model]) -> None:
        self.own = own

    def of(self, length: int) -> Model:
        if length in self.own:
            return self.own[length]
        width = -(-length // SUBSPACES)
        return Model(-length, np.zeros((1, length)), np.zeros((SUBSPACES, 1, width)))


def _unit(vectors: list[bytes], double: bool) -> np.ndarray:
    x = np.frombuffer(b"".join(vectors), np.float64 if double else np.float32)
    x = x.reshape(len(vectors), -1).astype(np.float64)
    # Scaled by the largest component first, so that no square runs over or under.
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x**2).sum(1, keepdims=True))


def _read(embeddings: DataFrame) -> tuple[DataFrame, bool]:
    """(vec_id, vector): the components as bytes, null where a vector links with nothing."""
    double = "double" in dict(embeddings.dtypes)["embedding"]
    kind = np.float64 if double else np.float32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = []
            for value in batch.column(1):
                x = value.values.to_numpy(zero_copy_only=False).astype(kind) if value.is_valid else np.zeros(0, kind)
                good = len(x) and np.isfinite(x).all() and x.any()
                vectors.append((x + kind(0)).tobytes() if good else None)  # -0 is 0
            ids = batch.column(0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([ids, pa.array(vectors, pa.binary())], ["vec_id", "vector"])

    rows = embeddings.select("vec_id", "embedding").mapInArrow(run, "vec_id long, vector binary")
    return rows, double


def _assigned(classes: DataFrame, model: bytes, double: bool, probes: int) -> DataFrame:
    """Each class with the lists it probes, its own first, and their centroids' squared distances."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = _model(model)
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column(2)).to_numpy()
            for size in np.unique(sizes).tolist():
                own = batch.filter(pa.array(sizes == size))
                x = _unit(own.column(2).to_pylist(), double)
                first, centroids, _ = models.of(x.shape[1])
                near = _nearest(x, centroids, min(probes, len(centroids)))
                far = ((x[:, None, :] - centroids[near]) ** 2).sum(2)
                columns = [*own.columns, pa.array(list((first + near.astype(np.int64)) * PARTS), pa.list_(pa.int64()))]
                columns.append(pa.array(list(far), pa.list_(pa.float64())))
                yield pa.RecordBatch.from_arrays(columns, [*own.schema.names, "lists", "far"])

    return classes.select("id", "n", "vector").mapInArrow(run, "id string, n long, vector binary, lists array<long>, far array<double>")


def _divided(assigned: DataFrame, double: bool, probes: int) -> DataFrame:
    """The same with parts of long lists in their place, as many of the nearest as ``probes``."""
    sizes = assigned.groupBy(F.col("lists")[0].alias("list")).agg(F.count("*").alias("size"))
    parts = F.least(F.lit(MOST_PARTS), F.ceil(F.col("size") / PER_LIST)).cast("int")
    tiles = F.ceil(F.col("size") * probes / ASKING).cast("int")
    long = sizes.filter(F.col("size") > LONG * PER_LIST)
    long = stored(long.select(F.col("list").alias("l"), "size", parts.alias("parts"), tiles.alias("tiles")), "long")
    if not long.take(1):
        return assigned
    members = assigned.select(F.col("lists")[0].alias("list"), "id", "vector").join(long, F.col("list") == F.col("l"))
    members = members.filter(luck("parts", "id") < SAMPLE_PER_LIST * F.col("parts") / F.col("size"))

    def learn(table: pa.Table) -> pa.Table:
        x = _unit(table.sort_by("id")["vector"].to_pylist(), double)
        centres = _means(x, table["parts"][0].as_py(), 8, 1).astype(np.float32)
        return pa.table([table["list"][:1], pa.array([centres.tobytes()], pa.binary())], ["list", "centres"])

    centres = members.select("list", "id", "vector", "parts").groupBy("list").applyInArrow(tidied(learn), "list long, centres binary")
    centres = stored(centres, "parts").join(long, F.col("list") == F.col("l"))
    every = centres.select("list", "centres", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"))
    probed = assigned.select("id", "vector", F.explode(F.arrays_zip("lists", "far")).alias("p"))
    probed = probed.select("id", "vector", F.col("p.lists").alias("list"), F.col("p.far").alias("far"))
    probed = probed.join(long, F.col("list") == F.col("l"), "left")
    tile = F.pmod(F.xxhash64(F.lit("part"), "id"), F.col("tiles")).cast("int").alias("tile")
    asking = probed.filter("tiles is not null").select("id", "vector", "list", tile)

    def near(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return pa.table([pa.array([], pa.string()), pa.array([], pa.int64()), pa.array([], pa.float64())], ["id", "list", "far"])
        x = _unit(left["vector"].to_pylist(), double)
        centres = np.frombuffer(right["centres"][0].as_py(), np.float32).reshape(-1, x.shape[1]).astype(np.float64)
        found = _nearest(x, centres, min(probes, len(centres)))
        far = ((x[:, None, :] - centres[found]) ** 2).sum(2)
        ids = left["id"].combine_chunks().take(pa.array(np.repeat(np.arange(len(x)), found.shape[1])))
        return pa.table([ids, pa.array((left["list"][0].as_py() + 1 + found.astype(np.int64)).ravel()), pa.array(far.ravel())], ["id", "list", "far"])

    found = asking.groupBy("list", "tile").cogroup(every.groupBy("list", "tile"))
    found = found.applyInArrow(tidied(near), "id string, list long, far double")
    found = found.union(probed.filter("tiles is null").select("id", "list", "far"))
    nearest = F.slice(F.array_sort(F.collect_list(F.struct("far", "list"))), 1, probes)
    chosen = found.groupBy(F.col("id").alias("of")).agg(nearest.alias("near"))
    rows = assigned.select("id", "n", "vector").join(chosen, F.col("id") == F.col("of"))
    return stored(rows.select("id", "n", "vector", F.col("near.list").alias("lists")), "divided")


@lru_cache(maxsize=2)
def _model(made: bytes) -> Models:
    return pickle.loads(made)


def _trained(vectors: list[bytes], double: bool, share: float) -> dict[int, Model]:
    """Models of the lengths in a sample that holds ``share`` of all vectors; lists are numbered through."""
    lengths = np.array([len(v) for v in vectors]) // (8 if double else 4)
    own: dict[int, Model] = {}
    first = 0
    for length, n in zip(*np.unique(lengths, return_counts=True), strict=True):
        part = [vectors[k] for k in np.flatnonzero(lengths == length)]
        lists = max(1, min(MOST_LISTS, int(n / share) // PER_LIST))
        own[int(length)] = train(_unit(part, double), lists, first)
        first += len(own[int(length)].centroids)
    return own


def _tiles(assigned: DataFrame) -> DataFrame:
    """A row for each tile that a class is coded or asks in; every two parts of a list meet in one."""
    probed = assigned.select(F.explode("lists").alias("list")).groupBy("list").agg(F.count("*").alias("asking"))
    filed = assigned.groupBy(F.col("lists")[0].alias("list")).agg(F.count("*").alias("coded"))
    sizes = probed.join(filed, "list", "left")
    asks, codes = (F.greatest(F.lit(1), F.ceil(F.col(n) / most)).cast("int") for n, most in (("asking", ASKING), ("coded", TILE)))
    sizes = sizes.select(F.col("list").alias("l"), F.coalesce(asks, F.lit(1)).alias("asks"), F.coalesce(codes, F.lit(1)).alias("codes"))
    large = stored(sizes.filter("asks > 1 or codes > 1"), "large")
    rows = assigned.select("*", F.posexplode("lists").alias("place", "list"))
    if large.take(1):
        rows = rows.join(large, F.col("list") == F.col("l"), "left")
        rows = rows.withColumns({"asks": F.coalesce("asks", F.lit(1)), "codes": F.coalesce("codes", F.lit(1))})
    else:
        rows = rows.withColumns({"asks": F.lit(1), "codes": F.lit(1)})
    asks, codes = F.col("asks"), F.col("codes")
    tile = F.xxhash64(F.lit("tile"), "id")
    asking = rows.withColumn("a", F.pmod(tile, asks).cast("int")).withColumn("c", F.explode(F.sequence(F.lit(0), codes - 1)))
    coding = rows.filter("place = 0").withColumn("c", F.pmod(tile, codes).cast("int"))
    coding = coding.withColumn("a", F.explode(F.sequence(F.lit(0), asks - 1)))
    columns = ["list", "a", "c", "id", "n", "vector", "lists"]
    return asking.select(*columns, F.lit(True).alias("asks")).union(coding.select(*columns, F.lit(False).alias("asks")))


def _searched(model: bytes, double: bool, cosine: float):
    """Link counts and spanning forest of a tile."""
    reach = float(np.sqrt(2 - 2 * cosine))

    def run(table: pa.Table) -> pa.Table:
        asks = table["asks"].combine_chunks().to_numpy(zero_copy_only=False)
        x = _unit(table["vector"].to_pylist(), double)
        first, centroids, books = _model(model).of(x.shape[1])
        centroid = centroids[table["list"][0].as_py() // PARTS - first]
        n = table["n"].to_numpy()
        lists = _even(table["lists"].combine_chunks())
        names, who = np.unique(np.array(table["id"].to_pylist(), "U52"), return_inverse=True)
        q, c = np.flatnonzero(asks), np.flatnonzero(~asks)
        rest = x - centroid
        codes, error = _coded(rest[c], books)
        counts, forest = np.zeros(len(names), np.int64), Forest(len(names))
        for a in range(0, len(q), step := max(1, _CHUNK // max(len(c), 1))):
            own = q[a : a + step]
            parts = _split(rest[own])
            far = np.zeros((len(own), len(c)), np.float32)
            for m in range(SUBSPACES):
                table_m = ((parts[m][:, None, :] - books[m][None, :, :]) ** 2).sum(2).astype(np.float32)
                far += table_m[:, codes[:, m]]
            i, j = np.nonzero(far <= ((reach + error) ** 2 * (1 + 1e-5) + 1e-6).astype(np.float32))
            i, j = own[i], c[j]
            home, other = lists[i, 0], lists[j, 0]
            # A pair of one list counts from its smaller name; one of two lists only where it meets first.
            both = (lists[j] == home[:, None]).any(1) & (home < other)
            once = np.where(home == other, who[i] < who[j], ~both)
            i, j = i[once], j[once]
            near = np.einsum("kd,kd->k", x[i], x[j]) >= cosine
            i, j = i[near], j[near]
            np.add.at(counts, who[i], n[j])
            np.add.at(counts, who[j], n[i])
            forest.join(who[i], who[j])
        linked = np.flatnonzero(counts)
        roots = forest.roots(linked) if len(linked) else linked
        return pa.table(
            {
                "id": pa.array(names[linked].tolist(), pa.string()),
                "root": pa.array(names[roots].tolist(), pa.string()),
                "links": pa.array(counts[linked], pa.int64()),
            }
        )

    return run


def _even(lists: pa.ListArray) -> np.ndarray:
    """Lists as rows of one length, filled up with the least number there is."""
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.full((len(lists), int(sizes.max(initial=1))), np.iinfo(np.int64).min)
    out[np.arange(out.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy()
    return out


def _coded(rest: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of residuals and the distance that each code is off."""
    codes = np.zeros((len(rest), SUBSPACES), np.int32)
    off = np.zeros(len(rest))
    for m, part in enumerate(_split(rest)):
        codes[:, m] = _nearest(part, books[m], 1)[:, 0]
        off += ((part - books[m][codes[:, m]]) ** 2).sum(1)
    return codes, np.sqrt(off)


def linked_vectors(embeddings: DataFrame, cosine: float = COSINE, probes: int = PROBES) -> DataFrame:
    """vec_id, n_links, component_id, kept: near-duplicates among all rows.

    One row per input row. A vector that is null, empty or zero, or that holds
    a null or a component that is not finite links with nothing. Vectors link
    with those of their own length; each length has lists and codes of its
    own. Rows that repeat a vector are linked, also where they repeat the id.
    A component has its smallest id; rows with a null id take part and name
    none. Labels and other columns are not looked at. An empty table has no
    rows.
    """
    rows, double = _read(embeddings)
    classes = rows.filter("vector is not null").groupBy("vector").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"))
    # Named by the least id first, so that a component's least name holds its least id.
    digits = F.lpad((F.col("least").cast("decimal(20,0)") + F.lit(_UP)).cast("string"), 20, "0")
    classes = classes.withColumn("id", F.concat(F.coalesce(digits, F.lit(_NO_ID)), F.md5("vector")))
    classes = stored(classes, "classes")
    n = classes.count()
    lists = max(1, min(MOST_LISTS, -(-n // PER_LIST)))
    share = min(1.0, max(SAMPLE, SAMPLE_PER_LIST * lists) / max(n, 1))
    sample = classes.filter(luck("train", "vector") < share).select("id", "vector").orderBy("id").toArrow()
    model = pickle.dumps(Models(_trained(sample["vector"].to_pylist(), double, share)))
    assigned = stored(_assigned(classes, model, double, probes), "assigned")
    assigned = _divided(assigned, double, probes)
    tiles = _tiles(assigned).groupBy("list", "a", "c")
    found = stored(tiles.applyInArrow(tidied(_searched(model, double, cosine)), "id string, root string, links long"), "found")
    counts = found.groupBy("id").agg(F.sum("links").alias("links")).withColumnRenamed("id", "linked")
    roots = components(found.filter("id != root").select("id", "root"))
    named = classes.join(counts, F.col("id") == F.col("linked"), "left").join(roots, F.col("id") == F.col("node"), "left")
    root = F.substring(F.coalesce("root", "id"), 1, 20)
    least = F.when(root != _NO_ID, (root.cast("decimal(20,0)") - F.lit(_UP)).cast("long"))
    links = (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")
    named = stored(named.select(F.md5("vector").alias("of"), links, least.alias("component_id")), "named")
    out = rows.withColumn("id", F.md5("vector")).join(named, F.col("id") == F.col("of"), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
