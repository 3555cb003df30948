"""Best-fit packing of documents into sequences, planned on lengths alone.

Pieces of equal length can stand for each other, so a plan over the counts of
the at most ``LIMIT`` lengths packs any number of documents. Large lengths
are dealt, longest first, into groups of equal cardinality and rounded up to
the longest of their group; over these few sizes the configurations of a
sequence are optimised by column generation (a linear programme whose prices
ask a knapsack for the next configuration). Configurations are filled with
the actual lengths of each group, and small lengths go, longest first, where
the least room is left that still holds them. Spark then counts each piece's
place among those of its length, and the plan tells which slot that is.
"""

from __future__ import annotations

import pickle
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shared import stored
from .words import Remembered, Words, ranges, spans, stretches, tidy, words

LIMIT = 4096
END = 1
#: Numbers of groups that are tried; the plan of fewest sequences is taken.
GROUPS = (16, 32, 64)
#: Column generation ends when no configuration is worth this much more than its sequence.
GAIN = 1e-3
#: Lengths above this share of a sequence are large.
LARGE = 1 / 8
#: Rows that one task ranks among pieces of one length.
SHARD = 256
#: Shards that are summed up together.
GROUP = 1000
VOCABULARY = "word_bpe_49k.json"


class Plan:
    """Slots of each length, in runs of equal sequences.

    A run is ``count`` sequences numbered from ``first`` on, each of which has
    a slot of the length at ``offset``. The n-th piece of a length takes the
    n-th slot.
    """

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.sequences = 0
        self.runs: list[tuple[int, int, int, int]] = []  # length, count, first sequence, offset

    def table(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        by_length: dict[int, list[tuple[int, int, int]]] = {}
        for length, count, first, offset in self.runs:
            by_length.setdefault(length, []).append((count, first, offset))
        out = {}
        for length, runs in by_length.items():
            counts, firsts, offsets = (np.array(x, np.int64) for x in zip(*runs, strict=True))
            out[length] = np.concatenate(([0], np.cumsum(counts))), firsts, offsets
        return out


class _Bins:
    """Open runs of equal sequences by the room that is left in them."""

    def __init__(self, plan: Plan) -> None:
        self.plan = plan
        self.rooms: list[int] = []
        self.runs: dict[int, list[tuple[int, int]]] = {}  # room: (first sequence, count)

    def open(self, count: int) -> int:
        first = self.plan.sequences
        self.plan.sequences += count
        return first

    def give(self, room: int, first: int, count: int) -> None:
        if room and count:
            if room not in self.runs:
                insort(self.rooms, room)
                self.runs[room] = []
            self.runs[room].append((first, count))

    def place(self, length: int, count: int) -> None:
        """Best fit: the least room that holds the length, again and again; new sequences beyond that."""
        while count:
            k = bisect_left(self.rooms, length)
            if k == len(self.rooms):
                fits = self.plan.limit // length
                full, rest = divmod(count, fits)
                for bins, times in ((full, fits), (1, rest)):
                    if bins and times:
                        first = self.open(bins)
                        for t in range(times):
                            self.plan.runs.append((length, bins, first, t * length))
                        self.give(self.plan.limit - times * length, first, bins)
                return
            room = self.rooms[k]
            first, bins = self.runs[room].pop()
            if not self.runs[room]:
                del self.runs[room]
                self.rooms.pop(k)
            times = room // length
            whole = min(bins, count // times)
            if whole:
                for t in range(times):
                    self.plan.runs.append((length, whole, first, self.plan.limit - room + t * length))
                self.give(room - times * length, first, whole)
                count -= whole * times
            else:
                whole = 1
                for t in range(count):
                    self.plan.runs.append((length, 1, first, self.plan.limit - room + t * length))
                self.give(room - count * length, first, 1)
                count = 0
            self.give(room, first + whole, bins - whole)


def _grouped(lengths: list[tuple[int, int]], groups: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """(rounded length, own lengths and counts) of groups of equal cardinality, longest first."""
    total = sum(n for _, n in lengths)
    out: list[tuple[int, list[tuple[int, int]]]] = []
    cuts = [total * (k + 1) // groups for k in range(groups)]
    done = 0
    own: list[tuple[int, int]] = []
    for length, n in sorted(lengths, reverse=True):
        while n:
            take = min(n, cuts[0] - done)
            if take:
                own.append((length, take))
                done, n = done + take, n - take
            if done == cuts[0]:
                cuts.pop(0)
                if own:
                    out.append((own[0][0], own))
                own = []
    return out


def configurations(sizes: list[int], needs: list[int], limit: int) -> list[tuple[tuple[int, ...], float]]:
    """Configurations (how many of each size) and how often each is used in the best fractional packing."""
    m = len(sizes)
    need = np.array(needs, float)
    basis = np.diag([float(limit // s) for s in sizes])
    inverse = np.linalg.inv(basis)
    for _ in range(60 * m):
        prices = inverse.sum(0)  # each configuration costs one sequence
        column = _knapsack(sizes, prices, limit)
        if prices @ column <= 1 + GAIN:
            break
        used, direction = inverse @ need, inverse @ column
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(direction > 1e-12, np.maximum(used, 0) / direction, np.inf)
        leaving = int(np.argmin(ratio))
        basis[:, leaving] = column
        inverse = np.linalg.inv(basis)
    used = np.maximum(inverse @ need, 0)
    return [(tuple(int(x) for x in basis[:, k]), float(used[k])) for k in range(m)]


def _knapsack(sizes: list[int], prices: np.ndarray, limit: int) -> np.ndarray:
    """The configuration of most value, one more item per round."""
    value = np.zeros(limit + 1)
    choices = []
    for _ in range(limit // min(sizes)):
        new, choice = value.copy(), np.full(limit + 1, -1)
        for k, (size, price) in enumerate(zip(sizes, prices, strict=True)):
            gain = value[: limit + 1 - size] + price
            better = gain > new[size:] + 1e-12
            new[size:][better] = gain[better]
            choice[size:][better] = k
        if (choice < 0).all():
            break
        value = new
        choices.append(choice)
    out, room = np.zeros(len(sizes)), limit
    for choice in reversed(choices):
        if (k := choice[room]) >= 0:
            out[k] += 1
            room -= sizes[k]
    return out


def plan_packing(counts: dict[int, int], limit: int = LIMIT, groups: tuple[int, ...] = GROUPS) -> Plan:
    """Pack ``counts`` pieces of each length from 1 to ``limit``."""
    return min((_planned(counts, limit, n) for n in groups), key=lambda plan: plan.sequences)


def _planned(counts: dict[int, int], limit: int, groups: int) -> Plan:
    plan = Plan(limit)
    bins = _Bins(plan)
    if full := counts.get(limit, 0):
        plan.runs.append((limit, full, bins.open(full), 0))
    large = [(n, c) for n, c in counts.items() if limit > n > limit * LARGE and c]
    small = [(n, c) for n, c in counts.items() if 0 < n <= limit * LARGE and c]
    parts = _grouped(large, min(groups, sum(c for _, c in large))) if large else []
    stacks = [sorted(own) for _, own in parts]  # taken from the end: longest first
    left = [sum(c for _, c in own) for own in stacks]
    used = configurations([size for size, _ in parts], left, limit) if parts else []
    for config, times in used:
        todo = int(times)
        while todo:
            slots = [k for k, n in enumerate(config) for _ in range(n)]
            # Sequences that can be filled alike: as many as the shortest run of equal lengths allows.
            alike = todo
            for k, n in enumerate(config):
                if n and not stacks[k]:
                    slots = [s for s in slots if s != k]
                elif n:
                    alike = min(alike, max(1, stacks[k][-1][1] // n))
            if not slots:
                break
            first, offset = bins.open(alike), 0
            for k in slots:
                if not stacks[k]:
                    continue
                length, n = stacks[k][-1]
                take = min(n, alike)
                plan.runs.append((length, take, first, offset))
                if take < alike:  # the run ends inside; cannot be, as alike was cut to it
                    raise AssertionError("a run of equal lengths was overdrawn")
                stacks[k][-1] = (length, n - take)
                if n == take:
                    stacks[k].pop()
                offset += length
            bins.give(limit - offset, first, alike)
            todo -= alike
    rest: dict[int, int] = {}
    for stack in stacks:
        for length, n in stack:
            rest[length] = rest.get(length, 0) + n
    for length, n in sorted(rest.items(), reverse=True):
        bins.place(length, n)
    for length, n in sorted(small, reverse=True):
        bins.place(length, n)
    return plan


class Chunks:
    """Token ids of text between white space, remembered by hash up to ``most`` chunks.

    No token of the vocabulary spans white space, so a text's ids are those of
    its chunks in order. Chunks of plain letters, digits and signs below
    U+0250 are lower-cased and split into runs here and only merged by the
    tokenizer's model; all others go through the whole tokenizer.
    """

    def __init__(self, path: str, most: int = 600_000) -> None:
        import regex
        from tokenizers import Tokenizer

        self.path = path
        #: Merges one run; a tokenizer around it would cost twice as much again for offsets.
        self.merging = Tokenizer.from_file(path).model.tokenize
        self.plain = regex.compile(r"[!-~\u00a1-\u024f]+").fullmatch
        self.runs = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+").findall
        shown = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or 174 <= b]
        hidden = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in set(shown))}
        self.byte_signs = {b: chr(hidden.get(b, b)) for b in range(256)}
        self.memory = Remembered(np.uint32, most)
        self._forget()

    @cached_property
    def whole(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def of(self, data: np.ndarray, found: Words) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the words, and where each word's ids end."""
        keys, first, place = np.unique(spans(data, found.starts, found.ends), return_index=True, return_inverse=True)
        text = data.tobytes()

        def learn(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            own = first[new]
            return self._learn([text[a:b].decode() for a, b in zip(found.starts[own].tolist(), found.ends[own].tolist(), strict=True)])

        row = self.memory.rows_of(keys, learn)[place]
        begins = self.memory.offsets[row]
        lengths = self.memory.offsets[row + 1] - begins
        return self.memory.values[ranges(begins, lengths)], np.cumsum(lengths)

    def _learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > 100_000:
            self._forget()
        known, new, others = self.known, [], []
        codes, counts = [], []  # rows of the runs, -1 - k for the k-th word that is no runs; how many each word has
        for word in words:
            runs = self._split(word)
            if runs is None:
                others.append(self.whole.encode(word, add_special_tokens=False).ids)
                codes.append(-len(others))
                counts.append(1)
                continue
            counts.append(len(runs))
            for run in runs:
                row = known.get(run)
                if row is None:
                    row = known[run] = len(known)
                    new.append(run)
                codes.append(row)
        self.offsets, self.values = _with(self.offsets, self.values, self._merged(new))
        offsets, values = _with(self.offsets, self.values, others)
        row = np.array(codes, np.int64)
        row = np.where(row < 0, len(known) - 1 - row, row)
        lengths = offsets[row + 1] - offsets[row]
        ends = np.concatenate(([0], np.cumsum(lengths)))[np.cumsum(counts)]
        return np.diff(ends, prepend=0), values[ranges(offsets[row], lengths)]

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.offsets, self.values = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def _split(self, word: str) -> list[str] | None:
        if word.isascii():  # the most frequent forms first
            if word.isalpha():
                return [word.lower()]
            if word[-1] in ".,;:!?" and word[:-1].isalpha():
                return [word[:-1].lower(), word[-1]]
        if not self.plain(word) or "<|" in word:
            return None
        low = word.lower()
        if low.isalpha():
            return [low]
        if low[:-1].isalpha() and low[-1] in ".,;:!?":
            return [low[:-1], low[-1]]
        return self.runs(low)

    def _merged(self, runs: list[str]) -> list[list[int]]:
        signs = [r if r.isascii() else r.encode().decode("latin-1").translate(self.byte_signs) for r in runs]
        return [[token.id for token in self.merging(sign)] for sign in signs]


def _with(offsets: np.ndarray, values: np.ndarray, more: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and values with those of some lists after them."""
    if not more:
        return offsets, values
    sizes = np.fromiter(map(len, more), np.int64, len(more))
    added = np.fromiter(chain.from_iterable(more), values.dtype, int(sizes.sum()))
    return np.concatenate((offsets, offsets[-1] + np.cumsum(sizes))), np.concatenate((values, added))


@lru_cache(maxsize=1)
def _chunks(path: str) -> Chunks:
    return Chunks(path)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


PIECE_COLUMNS = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(docs: DataFrame, vocabulary: str | None = None, limit: int = LIMIT, with_ids: bool = False) -> DataFrame:
    """Pieces of each document's ids, at most ``limit`` long; all but a document's last are full.

    A document is its text's ids and then ``END``, so a null or empty text is
    one piece of one id. With ``with_ids`` the ids come along.
    """
    path = vocabulary or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = _chunks(path)
        for batch in tidy(batches):
            for begin, end, data, offsets in stretches(batch.column(1)):
                found = words(data, offsets)
                ids, ends = chunks.of(data, found) if len(found.starts) else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
                bounds = np.concatenate(([0], ends))[found.firsts]
                rows: list[list] = [[], [], [], [], []]
                for row in range(end - begin):
                    own = np.append(ids[bounds[row] : bounds[row + 1]], np.uint32(END)).astype("<u4")
                    for piece, start in enumerate(range(0, len(own), limit)):
                        part = own[start : start + limit]
                        values = row, piece, start, len(part), part
                        for column, value in zip(rows, values, strict=True):
                            column.append(value)
                where, piece, start, length, parts = rows
                arrays = [batch.column(0).slice(begin, end - begin).cast(pa.int64()).take(pa.array(where, pa.int64()))]
                arrays += [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64())]
                arrays.append(pa.array([zlib.crc32(p.tobytes()) for p in parts], pa.int64()))
                if with_ids:
                    arrays.append(pa.array([p.astype(np.int32) for p in parts], pa.list_(pa.int32())))
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays(arrays, names[: len(arrays)])

    columns = PIECE_COLUMNS + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(run, columns)


def pack(docs: DataFrame, vocabulary: str | None = None, limit: int = LIMIT, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their sequence and their place in it.

    One row per piece: those of ``cut`` and sequence_id, offset. Repeated rows
    are documents of their own; null ids stay null. An empty table has no
    pieces. Other columns are not looked at. Pieces of equal length take
    slots in the order of (shard, doc_id, piece), so reruns agree. The plan
    has a few runs for each of at most ``limit`` lengths, however many
    documents there are.
    """
    pieces = stored(cut(docs, vocabulary, limit, with_ids), "pieces")
    counts = {row.length: row["count"] for row in pieces.groupBy("length").count().collect()}
    plan = pickle.dumps(plan_packing(counts, limit).table())
    hot = {length: -(-n // SHARD) for length, n in counts.items() if n > SHARD}
    shard = F.lit(0).cast("long")
    if hot:
        wide = F.create_map(*(F.lit(x) for pair in sorted(hot.items()) for x in pair))[F.col("length")]
        shard = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.coalesce(wide, F.lit(1))).cast("long")
    rows = pieces.withColumn("shard", shard)
    # Shards are summed up in groups first, so that no task holds all of a length.
    sizes = rows.groupBy("length", "shard").agg(F.count("*").alias("n"))
    sizes = stored(sizes.withColumn("group", F.floor(F.col("shard") / GROUP).cast("long")), "sizes")
    earlier = Window.partitionBy("l").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    groups = sizes.groupBy(F.col("length").alias("l"), F.col("group").alias("g")).agg(F.sum("n").alias("n"))
    groups = groups.select("l", "g", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("length", "group").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("within", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    sizes = sizes.join(groups, (F.col("length") == F.col("l")) & (F.col("group") == F.col("g")))
    sizes = sizes.select(F.col("length").alias("l"), F.col("shard").alias("s"), (F.col("base") + F.col("within")).alias("before"))
    rows = rows.join(sizes, (F.col("length") == F.col("l")) & (F.col("shard") == F.col("s")))
    own = Window.partitionBy("length", "shard").orderBy("doc_id", "piece", "ids_crc32", "start")
    rank = F.col("before") + F.row_number().over(own) - 1
    names = pieces.columns
    rows = rows.select(*names, rank.cast("long").alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(plan)
        for batch in tidy(batches):
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            values, begins = np.unique(length[order], return_index=True)
            for value, at in zip(values, np.split(order, begins[1:]), strict=True):
                ends, firsts, offsets = table[int(value)]
                run = np.searchsorted(ends, rank[at], "right") - 1
                sequence[at], offset[at] = firsts[run] + rank[at] - ends[run], offsets[run]
            arrays = [batch.column(c) for c in names] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(arrays, [*names, "sequence_id", "offset"])

    columns = PIECE_COLUMNS + ", ids array<int>" * with_ids + ", sequence_id long, offset long"
    return rows.mapInArrow(place, columns)


@lru_cache(maxsize=1)
def _table(made: bytes) -> dict:
    return pickle.loads(made)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of pieces packed with their ids; a sequence has at most ``limit`` of them."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
