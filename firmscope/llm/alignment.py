"""Alignment of two tokenizers' tokens over a corpus, by external spill counting.

Two vocabularies cut a text at different places. Where tokens of both end at
one byte, the text falls into groups, and all tokens of one side in a group
are linked with all of the other. How often a pair of ids is linked is counted
in documents.

Documents are read in blocks of bounded size. A block's pairs of ids, each
with its number of documents, are radix-partitioned by the first id and
spilled as sorted runs of compressed frames; the documents' own lists of pairs
are spilled beside them. Runs of one radix are merged a bounded number at a
time through a heap of their frames, level by level, until one run is left.
It is ordered by first id, so each id's highest count is known as it passes,
and counts stream back the way the runs came, down to the blocks. A pair that
all documents hold is one record of each run, so no key is hot.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import new_folder, stored
from .blocks import tidied
from .words import ranges, tidy

FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: UTF-8 bytes of a block's texts, and of the texts that are aligned at once.
BLOCK_BYTES, ALIGNED = 1 << 24, 1 << 20
#: Radixes of the first id, and runs that are merged at once.
RADIXES, FAN = 64, 32
#: Records of a frame.
FRAME = 1 << 15
#: Groups of more links than this are linked by their distinct ids.
WIDE = 4096

COLUMNS = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)
RUNS = "block long, radix int, frames array<binary>"


class Pair(NamedTuple):
    """Where two vocabularies lie, and the first one's split pattern."""

    first: str
    second: str
    pattern: str


def public_pair(first: str = FIRST, second: str = SECOND) -> Pair:
    import public_tokenizers

    return Pair(public_tokenizers.path(first), public_tokenizers.path(second), public_tokenizers.PATTERN)


def byte_signs() -> dict[str, int]:
    """The sign by which byte-level vocabularies write each byte: itself if it shows, else one from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Vocabularies:
    """Both tokenizers, their tokens' bytes, and the signs of their ids in a list of groups."""

    def __init__(self, pair: Pair) -> None:
        import sentencepiece
        import tiktoken

        with open(pair.first, encoding="utf-8") as file:
            listed = json.load(file)
        own = {t["content"] for t in listed["added_tokens"] if t["special"]}
        signs = byte_signs()
        ranks = {bytes(signs[c] for c in t): k for t, k in listed["model"]["vocab"].items() if t not in own}
        self.first = tiktoken.Encoding("first", pat_str=pair.pattern, mergeable_ranks=ranks, special_tokens={})
        self.second = sentencepiece.SentencePieceProcessor(model_file=pair.second)
        self.first_bytes = [b""] * (max(ranks.values()) + 1)
        for token, k in ranks.items():
            self.first_bytes[k] = token
        pieces = [self.second.id_to_piece(k) for k in range(self.second.get_piece_size())]
        self.second_bytes = [_piece_bytes(p, self.second.is_byte(k)) for k, p in enumerate(pieces)]
        self.first_sizes = np.array([len(t) for t in self.first_bytes], np.int64)
        self.second_sizes = np.array([len(t) for t in self.second_bytes], np.int64)
        n, m = len(self.first_bytes), len(self.second_bytes)
        self.shift = (m - 1).bit_length()
        self.bits = self.shift + (n - 1).bit_length()  # of a pair of ids
        # Codes of the signs: an id inside its side of a group, then one at its end.
        self.codes = 0, n, 2 * n, 2 * n + m
        self.signs = np.array(
            [f"{k}{sign}" for sign, size in ((",", n), ("|", n), (",", m), (";", m)) for k in range(size)], "S"
        )

    def encode(self, texts: list[str | None]) -> Iterator[tuple[list[int], list[int]] | None]:
        """Both ids of each text; None where a side's tokens do not spell it."""
        seconds = self.second.encode([t or "" for t in texts], num_threads=1)
        for text, second in zip(texts, seconds, strict=True):
            if not text:
                yield None
                continue
            spaced = " " + text
            first = self.first.encode_ordinary(spaced)
            whole = spaced.encode()
            same = b"".join(map(self.first_bytes.__getitem__, first)) == whole
            same = same and b"".join(map(self.second_bytes.__getitem__, second)) == whole
            yield (first, second) if same else None


def _piece_bytes(piece: str, is_byte: bool) -> bytes:
    return bytes([int(piece[3:-1], 16)]) if is_byte else piece.replace("▁", " ").encode()


@lru_cache(maxsize=2)
def _vocabularies(pair: Pair) -> Vocabularies:
    return Vocabularies(pair)


class Aligned(NamedTuple):
    """Some texts' figures, and their pairs: text, pair of ids and times linked, ordered by text and pair."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digests: list[str]
    texts: np.ndarray
    pairs: np.ndarray
    times: np.ndarray


def align(texts: list[str | None], words: Vocabularies) -> Aligned:
    """Groups and linked pairs of some texts. A text without tokens has zeros and ''."""
    n = len(texts)
    n_a, n_b = np.zeros(n, np.int64), np.zeros(n, np.int64)
    all_a, all_b = [], []
    for k, ids in enumerate(words.encode(texts)):
        if ids:
            n_a[k], n_b[k] = len(ids[0]), len(ids[1])
            all_a.append(np.array(ids[0], np.int64))
            all_b.append(np.array(ids[1], np.int64))
    if not all_a:
        none = np.zeros(0, np.int64)
        return Aligned(n_a, n_b, n_a.copy(), n_a.copy(), [""] * n, none, none, none)
    a, b = np.concatenate(all_a), np.concatenate(all_b)
    ends_a, ends_b = np.cumsum(words.first_sizes[a]), np.cumsum(words.second_sizes[b])
    reached = np.zeros((2, int(ends_a[-1]) + 1), bool)
    reached[0, ends_a], reached[1, ends_b] = True, True
    last_a, last_b = reached[1, ends_a], reached[0, ends_b]
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    # First token of each group on each side, one more at the end.
    begin_a = np.concatenate(([0], np.flatnonzero(last_a) + 1))
    begin_b = np.concatenate(([0], np.flatnonzero(last_b) + 1))
    size_a, size_b = np.diff(begin_a), np.diff(begin_b)
    bounds_a, bounds_b = np.concatenate(([0], np.cumsum(n_a))), np.concatenate(([0], np.cumsum(n_b)))
    groups = np.searchsorted(begin_a, bounds_a)  # first group of each text
    sums = np.concatenate(([0], np.cumsum(size_a * size_b)))

    signs = np.zeros(len(a) + len(b), np.int32)
    inside_a, end_a, inside_b, end_b = words.codes
    signs[np.arange(len(a)) + begin_b[group_a]] = a + np.where(last_a, end_a, inside_a)
    signs[np.arange(len(b)) + begin_a[group_b + 1]] = b + np.where(last_b, end_b, inside_b)
    digests = []
    for k in range(n):
        own = signs[bounds_a[k] + bounds_b[k] : bounds_a[k + 1] + bounds_b[k + 1]]
        listed = words.signs[own].tobytes().translate(None, b"\0")[:-1]
        digests.append(hashlib.sha256(listed).hexdigest() if len(own) else "")

    wide = size_a * size_b > WIDE
    text_of_group = np.repeat(np.arange(n), np.diff(groups))
    some = np.flatnonzero(~wide[group_a])
    width = size_b[group_a[some]]
    left = np.repeat(some, width)
    right = ranges(begin_b[group_a[some]], width)
    key = (text_of_group[group_a[left]] << words.bits) | (a[left] << words.shift) | b[right]
    keys, times = np.unique(key, return_counts=True)
    if wide.any():
        more = [_wide(g, text_of_group[g] << words.bits, a, b, begin_a, begin_b, words.shift) for g in np.flatnonzero(wide)]
        every = np.concatenate([keys, *(k for k, _ in more)])
        keys, place = np.unique(every, return_inverse=True)
        summed = np.zeros(len(keys), np.int64)
        np.add.at(summed, place, np.concatenate([times, *(t for _, t in more)]))
        times = summed
    text, pair = keys >> words.bits, keys & ((1 << words.bits) - 1)
    return Aligned(n_a, n_b, np.diff(groups), np.diff(sums[groups]), digests, text, pair, times)


def _wide(group, text, a, b, begin_a, begin_b, shift) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one large group: each two distinct ids, and how often they are linked."""
    x, n = np.unique(a[begin_a[group] : begin_a[group + 1]], return_counts=True)
    y, m = np.unique(b[begin_b[group] : begin_b[group + 1]], return_counts=True)
    return (text | (x[:, None] << shift) | y[None, :]).ravel(), (n[:, None] * m[None, :]).ravel()


# Frames: sorted numbers as differences, any numbers as they are.


@lru_cache(maxsize=1)
def _codec():
    import zstandard

    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _packed(values: np.ndarray) -> bytes:
    return _codec()[0].compress(np.ascontiguousarray(values, np.int64).tobytes())


def _unpacked(frame: bytes) -> np.ndarray:
    return np.frombuffer(_codec()[1].decompress(frame), np.int64)


def spill(pairs: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """Frames of a run: the pairs' differences, then their counts."""
    return [
        _packed(np.concatenate((np.diff(pairs[k : k + FRAME], prepend=0), counts[k : k + FRAME])))
        for k in range(0, len(pairs), FRAME)
    ]


def read(frames: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(pairs, counts) of each frame of a run."""
    for frame in frames:
        gaps, counts = np.split(_unpacked(frame), 2)
        yield np.cumsum(gaps), counts


def merge(runs: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs in order and their summed counts, from one frame of each run at a time.

    The heap holds the last pair of each run's frame. Up to the least of them
    all records are at hand.
    """
    readers = [read(frames) for frames in runs]
    held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    heap: list[tuple[int, int]] = []

    def load(run: int) -> None:
        frame = next(readers[run], None)
        if frame is not None:
            held[run] = frame
            heapq.heappush(heap, (int(frame[0][-1]), run))

    for run in range(len(runs)):
        load(run)
    while heap:
        bound = heap[0][0]
        parts = []
        for run, (pairs, counts) in held.items():
            cut = int(np.searchsorted(pairs, bound, "right"))
            if cut:
                parts.append((pairs[:cut], counts[:cut]))
                held[run] = pairs[cut:], counts[cut:]
        keys, place = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
        yield keys, np.bincount(place, np.concatenate([c for _, c in parts])).astype(np.int64)
        while heap and heap[0][0] == bound:
            _, run = heapq.heappop(heap)
            del held[run]
            load(run)


def _merged(runs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    parts = list(merge(runs))
    return np.concatenate([p for p, _ in parts]), np.concatenate([c for _, c in parts])


def best(pairs: np.ndarray, counts: np.ndarray, shift: int) -> np.ndarray:
    """Whether each count is the highest of its first id."""
    first = pairs >> shift
    begins = np.flatnonzero(np.diff(first, prepend=-1))
    most = np.maximum.reduceat(counts, begins)
    return counts == np.repeat(most, np.diff(np.append(begins, len(pairs))))


# Blocks


class _Block:
    """Texts aligned so far, and the rows that they become."""

    def __init__(self, radixes: int, shift: int) -> None:
        self.radixes, self.shift = radixes, shift
        self.ids: list[pa.Array] = []
        self.parts: list[Aligned] = []
        self.size = 0

    def add(self, ids: pa.Array, texts: list[str | None], size: int, words: Vocabularies) -> None:
        self.ids.append(ids)
        self.parts.append(align(texts, words))
        self.size += size

    def rows(self, block: int) -> pa.RecordBatch:
        """One row with the documents (radix -1), and one with the run of each radix."""
        pairs = np.concatenate([p.pairs for p in self.parts])
        distinct, place = np.unique(pairs, return_inverse=True)
        radix = (distinct >> self.shift) % self.radixes
        order = np.argsort(radix, kind="stable")
        counts = np.bincount(place, minlength=len(distinct))
        at = np.empty_like(order)
        at[order] = np.arange(len(order))
        used = [np.bincount(p.texts, minlength=len(p.n_a)) for p in self.parts]
        figures = [np.concatenate([getattr(p, c) for p in self.parts]) for c in ("n_a", "n_b", "n_groups", "n_links")]
        docs = pa.table(
            [
                pa.concat_arrays(self.ids),
                *map(pa.array, figures),
                pa.array([d for p in self.parts for d in p.digests], pa.string()),
                pa.array(np.concatenate(used), pa.int64()),
            ],
            ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "used"],
        )
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, docs.schema) as out:
            out.write_table(docs)
        times = np.concatenate([p.times for p in self.parts])
        lists = [_codec()[0].compress(x.astype(np.int32).tobytes()) for x in (at[place], times)]
        radixes, frames = [-1], [[_codec()[0].compress(sink.getvalue().to_pybytes()), *lists]]
        pairs, counts, radix = distinct[order], counts[order], radix[order]
        for r in np.unique(radix).tolist():
            own = slice(*np.searchsorted(radix, (r, r + 1)))
            radixes.append(r)
            frames.append(spill(pairs[own], counts[own]))
        names = ["block", "radix", "frames"]
        arrays = [pa.array([block] * len(radixes), pa.int64()), pa.array(radixes, pa.int32())]
        return pa.RecordBatch.from_arrays([*arrays, pa.array(frames, pa.list_(pa.binary()))], names)


def _blocks(docs: DataFrame, pair: Pair, block_bytes: int, radixes: int) -> tuple[DataFrame, DataFrame]:
    """(documents, runs) of all blocks, written once; a block's number names its task and its place there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _vocabularies(pair)
        number = TaskContext.get().partitionId() << 32
        held = _Block(radixes, words.shift)
        for batch in tidy(batches):
            ids, texts = batch.column(0).cast(pa.int64()), batch.column(1)
            sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy()
            ends = np.cumsum(sizes)
            first = 0
            while first < len(batch):
                done = int(ends[first - 1]) if first else 0
                last = max(first + 1, int(np.searchsorted(ends, done + ALIGNED, "right")))
                held.add(ids.slice(first, last - first), texts.slice(first, last - first).to_pylist(), int(ends[last - 1]) - done, words)
                first = last
                if held.size >= block_bytes:
                    yield held.rows(number)
                    number, held = number + 1, _Block(radixes, words.shift)
        if held.ids:
            yield held.rows(number)

    path = new_folder(docs.sparkSession, "runs")
    rows = docs.select("doc_id", "text").mapInArrow(run, RUNS)
    rows.withColumn("kind", F.when(F.col("radix") < 0, "docs").otherwise("run")).write.partitionBy("kind").parquet(path)
    # The schema is given, as a table without rows leaves no file to read it from.
    rows = docs.sparkSession.read.schema(RUNS + ", kind string").parquet(path)
    return rows.filter("kind = 'docs'").drop("kind", "radix"), rows.filter("kind = 'run'").drop("kind")


# Levels


def _parents(runs: DataFrame, n: int, fan: int) -> tuple[DataFrame, int]:
    """Add the parent that each block's runs are merged into, one per ``fan`` blocks."""
    parents = -(-n // fan)
    return runs.withColumn("parent", F.pmod(F.xxhash64("block"), F.lit(parents))), parents


def _merge_up(table: pa.Table) -> pa.Table:
    frames = spill(*_merged(table["frames"].to_pylist()))
    row = [table["parent"][0].as_py()], [table["radix"][0].as_py()], [frames]
    kinds = pa.int64(), pa.int32(), pa.list_(pa.binary())
    return pa.table([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], ["block", "radix", "frames"])


def _answered(children: pa.Table, pairs: np.ndarray, answers: np.ndarray) -> pa.Table:
    """The children's rows with the answers to their own pairs, frame by frame, beside them."""
    found = [
        [_packed(answers[np.searchsorted(pairs, own)]) for own, _ in read(frames)]
        for frames in children["frames"].to_pylist()
    ]
    return children.select(["block", "radix", "frames"]).append_column("answers", pa.array(found, pa.list_(pa.binary())))


def _counted(runs: DataFrame, n: int, shift: int, fan: int) -> DataFrame:
    """(block, radix, frames, answers): twice the count, and one more where it is its first id's highest."""
    levels = []
    while n > fan:
        runs, n = _parents(runs, n, fan)
        levels.append(runs)
        runs = stored(runs.groupBy("parent", "radix").applyInArrow(tidied(_merge_up), RUNS), "merged")

    def top(table: pa.Table) -> pa.Table:
        pairs, counts = _merged(table["frames"].to_pylist())
        return _answered(table, pairs, 2 * counts + best(pairs, counts, shift))

    def down(children: pa.Table, parent: pa.Table) -> pa.Table:
        pairs = np.concatenate([p for p, _ in read(parent["frames"][0].as_py())])
        return _answered(children, pairs, np.concatenate([_unpacked(f) for f in parent["answers"][0].as_py()]))

    columns = RUNS + ", answers array<binary>"
    counted = runs.groupBy("radix").applyInArrow(tidied(top), columns)
    for children in reversed(levels):
        counted = stored(counted, "counted")
        parents = counted.withColumnRenamed("block", "parent").groupBy("parent", "radix")
        counted = children.groupBy("parent", "radix").cogroup(parents).applyInArrow(tidied(down), columns)
    return counted


def _scored(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """A block's documents with their sums over the answers to its pairs."""
    held, places, times = docs["frames"][0].as_py()
    with pa.ipc.open_stream(_codec()[1].decompress(held)) as rows:
        table = rows.read_all()
    answers = answers.take(np.argsort(answers["radix"].to_numpy())) if len(answers) else answers
    found = [_unpacked(f) for frames in answers["answers"].to_pylist() for f in frames]
    places, times = (np.frombuffer(_codec()[1].decompress(x), np.int32) for x in (places, times))
    answer = np.concatenate([*found, np.zeros(0, np.int64)])[places]
    bounds = np.concatenate(([0], np.cumsum(table["used"].to_numpy())))
    sums = [np.concatenate(([0], np.cumsum(x * times)))[bounds] for x in (answer & 1, answer >> 1)]
    out = dict(zip(table.column_names, table.columns, strict=True))
    out["n_best"], out["count_sum"] = (pa.array(np.diff(s), pa.int64()) for s in sums)
    return pa.table({c.split()[0]: out[c.split()[0]] for c in COLUMNS.split(", ")})


def align_tokens(
    docs: DataFrame, pair: Pair | None = None, block_bytes: int = BLOCK_BYTES, radixes: int = RADIXES, fan: int = FAN
) -> DataFrame:
    """Each document's tokens, groups, links, and sums of corpus-wide counts over its links.

    One row per input row: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256. Texts that are null or empty, or that a side's
    tokens do not spell, have zeros and ''. Repeated rows are documents of
    their own and count as such; a null ``doc_id`` stays null. Other columns
    are not looked at. An empty table has no rows. Ties for an id's highest
    count are all highest.
    """
    pair = pair or public_pair()
    documents, runs = _blocks(docs, pair, block_bytes, radixes)
    counted = _counted(runs, documents.count(), _vocabularies(pair).shift, fan)
    return documents.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(tidied(_scored), COLUMNS)


def linked_ids(
    docs: DataFrame, pair: Pair | None = None, block_bytes: int = BLOCK_BYTES, radixes: int = RADIXES, fan: int = FAN
) -> DataFrame:
    """(a, b, count, is_best): every pair of ids that a document links, and in how many documents.

    Rows as in ``align_tokens``; no documents give no pairs.
    """
    pair = pair or public_pair()
    shift = _vocabularies(pair).shift
    documents, runs = _blocks(docs, pair, block_bytes, radixes)
    n = documents.count()
    while n > fan:
        runs, n = _parents(runs, n, fan)
        runs = stored(runs.groupBy("parent", "radix").applyInArrow(tidied(_merge_up), RUNS), "merged")

    def listed(table: pa.Table) -> pa.Table:
        pairs, counts = _merged(table["frames"].to_pylist())
        a, b = pairs >> shift, pairs & ((1 << shift) - 1)
        return pa.table([a, b, counts, best(pairs, counts, shift)], ["a", "b", "count", "is_best"])

    return runs.groupBy("radix").applyInArrow(tidied(listed), "a long, b long, count long, is_best boolean")
