"""Substring duplicates by relative Lempel-Ziv parsing against indexed blocks.

Documents lie in reference blocks. Every block is indexed: of each window of
``WINDOW`` words the rarest-hashed run of ``GRAM`` words inside it is its
anchor, and blocks meet by their anchors, so two blocks that share a window
share its anchor. Windows whose anchor two blocks have are looked up in the
index of all blocks by their hash, all others in that of their own block. This
gives where a factor may begin and its source: the first place in the block,
or for that one the place before it among all blocks' first places. So a
window is the source of one other block's at most, and a block is asked for
each of its windows once, however many documents share a passage.

A factor is then read word by word against its source. Its words, and as many
again while windows have an earlier place, go to the source's block, which
tells how far they agree; sources in the own block are read there. A document
is parsed from left to right with the lengths that were read: the factor that
is reached first is taken as long as it is, factors inside it are passed over,
and at its end the next one that goes further is taken, be it that it begins
before that end, for windows that reach over the border. Factors of fewer than
``WINDOW`` agreeing words are none. The words of all factors taken go.

Hashes of windows have 96 bits and only propose; words decide. Only anchors,
windows whose anchor two blocks have and words of proposed factors are
shuffled; equal windows of a block count once, so a passage that a third of all
documents share costs one row per block.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import block_count, block_of, packed, tidied, unpacked
from .words import OTHER, SPACE, spans, stretches, words

WINDOW = 20
GRAM = 8
BLOCK_BYTES = 1 << 22
#: Stands for a null id, after all others. Words of such rows are numbered on from block to block.
NO_ID = np.iinfo(np.int64).max
SHIFT = 32
NUMBERED = 1 << SHIFT


class Block:
    """The documents of a block, in order of id and text, with their words numbered.

    ``key`` and ``place`` name a word: the document's id, and its number among
    the words of the rows with this id in the block.
    """

    def __init__(self, table: pa.Table) -> None:
        self.rows = unpacked(table["stream"])
        ids = self.rows["doc_id"].combine_chunks().cast(pa.int64()).fill_null(NO_ID).to_numpy()
        hashes, others, counts = [], [], []
        texts, begins, ends, size = [], [], [], 0
        for _, _, data, offsets in stretches(self.rows["text"].combine_chunks()):
            found = words(data, offsets)
            texts.append(data.tobytes())
            begins.append(found.starts + size)
            ends.append(found.ends + size)
            size += len(data)
            hashes.append(spans(data, found.starts, found.ends))
            others.append(spans(data, found.starts, found.ends, OTHER))
            counts.append(found.counts)
        self.counts = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        self.firsts = np.concatenate(([0], np.cumsum(self.counts)))
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.others = np.concatenate(others) if others else np.zeros(0, np.uint64)
        #: All texts end to end, and where each word lies in them.
        self.data = b"".join(texts)
        self.begins = np.concatenate(begins) if begins else np.zeros(0, np.int64)
        self.ends = np.concatenate(ends) if ends else np.zeros(0, np.int64)
        self.key = np.repeat(ids, self.counts)
        new_id = np.concatenate(([True], ids[1:] != ids[:-1])) if len(ids) else np.zeros(0, bool)
        base = np.maximum.accumulate(np.where(new_id, self.firsts[:-1], 0)) if len(ids) else self.firsts[:-1]
        self.place = np.arange(len(self.hashes)) - np.repeat(base, self.counts)
        self.place[self.key == NO_ID] += table["block"][0].as_py() * NUMBERED
        text = np.repeat(np.arange(len(self.counts)), self.counts)
        size = len(self.hashes) - WINDOW + 1
        #: First words of all windows inside one text.
        self.windows = np.flatnonzero(text[:size] == text[WINDOW - 1 :]) if size > 0 else np.zeros(0, np.int64)

    def piece(self, start: int, stop: int) -> bytes:
        """The text from one word to the one before another."""
        return self.data[self.begins[start] : self.ends[stop - 1]] if stop > start else b""

    def agreeing(self, at: int, text: bytes, n: int) -> int:
        """How many of the n words of a text stand at a word and after it in its row."""
        row_end = self.firsts[np.searchsorted(self.firsts, at, "right")]
        own = self.piece(at, min(at + n, row_end))
        if own == text:
            return n
        pairs = zip(own.split(), text.split(), strict=False)
        return next((k for k, (a, b) in enumerate(pairs) if a != b), int(min(n, row_end - at)))

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the run of ``GRAM`` words at each word, and the smallest inside each place's window."""
        size = max(len(self.hashes) - GRAM + 1, 0)
        starts = np.arange(size)
        grams = spans(self.hashes, starts, starts + GRAM)
        return grams, _sliding(grams, WINDOW - GRAM + 1, np.minimum)

    def anchors(self) -> np.ndarray:
        """Hashes of the places that are the smallest of some window."""
        grams, least = self.grams()
        if not len(self.windows):
            return np.zeros(0, np.uint64)
        wide = WINDOW - GRAM + 1
        valid = np.zeros(len(grams) + wide - 1, np.uint64)
        valid[self.windows + wide - 1] = least[self.windows]
        return grams[_sliding(valid, wide, np.maximum)[: len(grams)] == grams]

    def hashed(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """64 and 32 more bits of the windows that begin at some words."""
        more = spans(self.others, at, at + WINDOW, OTHER)
        return spans(self.hashes, at, at + WINDOW), (more >> np.uint64(32)).astype(np.uint32)


def _sliding(x: np.ndarray, n: int, least) -> np.ndarray:
    """least of x[i : i + n] for each i that has so many."""
    done = 1
    while done < n:
        step = min(done, n - done)
        x = least(x[: len(x) - step], x[step:]) if len(x) > step else x[:0]
        done += step
    return x


def _index_anchors(table: pa.Table) -> pa.Table:
    found = np.unique(Block(table).anchors())
    block = np.full(len(found), table["block"][0].as_py())
    return pa.table({"anchor": pa.array(found.view(np.int64)), "block": pa.array(block)})


def _index_windows(left: pa.Table, right: pa.Table) -> pa.Table:
    """First places in the block of windows whose anchor other blocks have too."""
    empty = np.zeros(0, np.int64)
    at, high, low, block = empty, empty.view(np.uint64), empty.astype(np.uint32), None
    if len(left) and len(right):
        block = Block(left)
        _, least = block.grams()
        known = np.sort(right["anchor"].to_numpy().view(np.uint64))
        own = least[block.windows]
        spot = np.minimum(np.searchsorted(known, own), len(known) - 1)
        at = block.windows[known[spot] == own]
        high, low = block.hashed(at)
        # In the order of the texts, in which neighbouring rows compress best.
        first = np.sort(np.unique(high, return_index=True)[1])
        at, high, low = at[first], high[first], low[first]
    return pa.table(
        {
            "high": pa.array(high.view(np.int64)),
            "low": pa.array(low.view(np.int32)),
            "key": pa.array(block.key[at] if block else empty),
            "place": pa.array(block.place[at] if block else empty),
        }
    )


def _sources(block: Block, found: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First words of windows with an earlier place, the id and number of that place's word, and that word if it is in the block (else -1)."""
    key, place = found["key"].to_numpy(), found["place"].to_numpy()
    high, _ = block.hashed(block.windows)
    order = np.argsort(high, kind="stable")
    ranked = high[order]
    begins = np.concatenate(([True], ranked[1:] != ranked[:-1])) if len(ranked) else np.zeros(0, bool)
    leader = order[np.flatnonzero(begins)[np.cumsum(begins) - 1]] if len(ranked) else order
    first = np.empty(len(high), np.int64)
    first[order] = leader
    here = block.windows[first]
    source_key, source_place = block.key[here], block.place[here]
    here = np.where(first != np.arange(len(high)), here, -1)
    earlier = here >= 0
    if len(key):
        # The block's first places of windows that other blocks hold before.
        own_key, own_place = block.key[block.windows], block.place[block.windows]
        rank = np.lexsort((place, key))
        at = _find(own_key, own_place, key[rank], place[rank])
        source_key[at] = found["source_key"].to_numpy()[rank]
        source_place[at] = found["source_place"].to_numpy()[rank]
        earlier[at] = True
    return block.windows[earlier], source_key[earlier], source_place[earlier], here[earlier]


def _find(keys: np.ndarray, places: np.ndarray, key: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Where each (key, place) stands among the sorted keys and places."""
    low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
    begin = places[low]
    at = low + place - begin
    # Windows of an id are consecutive but where one row with this id ends and another begins.
    wrong = np.flatnonzero((at >= high) | (places[np.minimum(at, len(places) - 1)] != place))
    for k in wrong:
        at[k] = low[k] + np.searchsorted(places[low[k] : high[k]], place[k])
    return at


def _proposed(left: pa.Table, right: pa.Table) -> pa.Table:
    """Factors to read: with their words where the source is in another block, with their length where it is in this."""
    if not len(left):
        return pa.table({name: pa.array([], kind) for name, kind in _PROPOSED})
    block = Block(left)
    at, key, place, here = _sources(block, right)
    row = np.searchsorted(block.firsts, at, "right") - 1
    follows = (at[1:] == at[:-1] + 1) & (row[1:] == row[:-1])
    same = follows & (key[1:] == key[:-1]) & (place[1:] == place[:-1] + 1) & ((here[1:] < 0) == (here[:-1] < 0))
    first = _begins(same, len(at))
    last = np.append(first[1:], len(at))[: len(first)] - 1
    # A factor may go on where the next window has another source, as far as windows have one.
    stretch = _begins(follows, len(at))
    stretch_last = np.append(stretch[1:], len(at))[: len(stretch)] - 1
    stop = at[stretch_last[np.searchsorted(stretch, first, "right") - 1]] + WINDOW if len(at) else at
    begin, length = at[first], last - first + WINDOW
    stop = np.minimum(begin + 2 * length, stop)
    texts: list[bytes | None] = []
    agreed = stop - begin
    for k, (start, end, source) in enumerate(zip(begin.tolist(), stop.tolist(), here[first].tolist(), strict=True)):
        text = block.piece(start, end)
        texts.append(text if source < 0 else None)
        if source >= 0:
            agreed[k] = block.agreeing(source, text, end - start)
    own = np.full(len(first), left["block"][0].as_py())
    values = (own, begin, agreed, key[first], place[first], texts)
    return pa.table({name: pa.array(v, kind) for (name, kind), v in zip(_PROPOSED, values, strict=True)})


def _begins(goes_on: np.ndarray, n: int) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], ~goes_on))) if n else np.zeros(0, np.int64)


_PROPOSED = [("block", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("source_key", pa.int64()), ("source_place", pa.int64()), ("words", pa.binary())]
PROPOSED = "block long, start long, length long, source_key long, source_place long, words binary"


def _read(left: pa.Table, right: pa.Table) -> pa.Table:
    """Proposed factors with the number of words that agree, where that makes a window."""
    right = right.select([name for name, _ in _PROPOSED])
    length = right["length"].to_numpy().copy()
    asked = np.flatnonzero(right["words"].is_valid().to_numpy())
    if len(asked):
        block = Block(left)
        key, place = right["source_key"].to_numpy()[asked], right["source_place"].to_numpy()[asked]
        place = np.where(key == NO_ID, place % NUMBERED, place)
        source = np.searchsorted(block.key, key) + place
        for k, at in zip(asked.tolist(), source.tolist(), strict=True):
            length[k] = block.agreeing(at, right["words"][k].as_py(), int(length[k]))
    right = right.set_column(2, "length", pa.array(length)).drop_columns("words")
    return right.filter(pa.array(length >= WINDOW))


def _taken(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The greedy parse: factors in order of start, longest first, that reach further than all before."""
    order = np.lexsort((-length, start))
    end = (start + length)[order]
    before = np.concatenate(([-1], np.maximum.accumulate(end)[:-1])) if len(end) else end
    return order[end > before]


_FACTOR = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("source_doc", pa.int64()), ("source_start", pa.int64())]))
FACTORS = "array<struct<start: long, length: long, source_doc: long, source_start: long>>"


def _parsed(left: pa.Table, right: pa.Table) -> tuple[pa.Table, np.ndarray, list[list[dict]], Block]:
    """Rows of a block, which words go, and the factors of each row."""
    block = Block(left)
    start, length = right["start"].to_numpy(), right["length"].to_numpy()
    taken = _taken(start, length)
    start, length = start[taken], length[taken]
    key, place = right["source_key"].to_numpy()[taken], right["source_place"].to_numpy()[taken]
    row = np.searchsorted(block.firsts, start, "right") - 1
    steps = np.zeros(len(block.hashes) + 1, np.int64)
    np.add.at(steps, start, 1)
    np.add.at(steps, start + length, -1)
    gone = np.cumsum(steps[:-1]) > 0
    factors: list[list[dict]] = [[] for _ in block.counts]
    for k, own in enumerate(row.tolist()):
        factors[own].append(
            {
                "start": int(start[k] - block.firsts[own]),
                "length": int(length[k]),
                "source_doc": None if key[k] == NO_ID else int(key[k]),
                "source_start": int(place[k]) % NUMBERED,
            }
        )
    return block.rows, gone, factors, block


def _reported(left: pa.Table, right: pa.Table) -> pa.Table:
    if not len(left):
        return _report([], [], [], [], [])
    rows, gone, factors, block = _parsed(left, right)
    removed, digests = [], []
    for k, text in enumerate(rows["text"].combine_chunks().cast(pa.binary())):
        own = gone[block.firsts[k] : block.firsts[k + 1]]
        found = (text.as_py() or b"").split()
        n = int(np.count_nonzero(own))
        removed.append(n)
        digests.append(hashlib.sha256(b" ".join(compress(found, (~own).tolist()) if n else found)).hexdigest())
    return _report(rows["doc_id"].combine_chunks().cast(pa.int64()), block.counts, removed, digests, factors)


def _report(ids, counts, removed, digests, factors) -> pa.Table:
    return pa.table(
        {
            "doc_id": pa.array(ids, pa.int64()) if isinstance(ids, list) else ids,
            "n_words": pa.array(counts, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "kept_sha256": pa.array(digests, pa.string()),
            "factors": pa.array(factors, _FACTOR),
        }
    )


def _indexed(docs: DataFrame, columns: list[str], block_bytes: int) -> tuple[DataFrame, DataFrame]:
    """Blocks, and for each block its factors, read against their sources."""
    blocks = block_count(docs, block_bytes)
    streams = packed(docs, blocks, columns)
    anchors = streams.groupBy("block").applyInArrow(tidied(_index_anchors), "anchor long, block long")
    often = anchors.withColumn("often", F.count("*").over(Window.partitionBy("anchor"))).filter("often > 1")
    found = streams.groupBy("block").cogroup(often.select("block", "anchor").groupBy("block"))
    found = found.applyInArrow(tidied(_index_windows), "high long, low int, key long, place long")
    same = Window.partitionBy("high", "low").orderBy("key", "place")
    found = found.withColumn("source", F.lag(F.struct("key", "place")).over(same)).filter("source is not null")
    found = found.select(_home("key", "place", blocks).alias("block"), "key", "place", F.col("source.key").alias("source_key"), F.col("source.place").alias("source_place"))
    proposed = streams.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(tidied(_proposed), PROPOSED)
    to = F.when(F.col("words").isNull(), F.col("block")).otherwise(_home("source_key", "source_place", blocks))
    asked = proposed.withColumn("to", to)
    factors = "block long, start long, length long, source_key long, source_place long"
    return streams, streams.groupBy("block").cogroup(asked.groupBy("to")).applyInArrow(tidied(_read), factors)


def _home(key: str, place: str, blocks: int) -> Column:
    """A word's block: it follows from the id, or for rows without one from the number."""
    return F.when(F.col(key) == NO_ID, F.shiftright(place, SHIFT)).otherwise(block_of(F.col(key), blocks))


def duplicate_factors(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and the factors of every whole text.

    One row per input row. Null and empty texts have no words. Rows that
    repeat an id are parts of one document, in order of their texts, but no
    window reaches from one to the next; exact copies of a row are removed but
    for the first like any other copy. A null id comes after all others.
    Other columns are not looked at. A factor's start and its source's start
    count words from 0; the source's count goes on over rows that repeat its id.
    """
    streams, found = _indexed(docs, ["doc_id", "text"], block_bytes)
    parsed = streams.groupBy("block").cogroup(found.groupBy("block"))
    return parsed.applyInArrow(
        tidied(_reported), f"doc_id long, n_words long, n_removed long, kept_sha256 string, factors {FACTORS}"
    )


def without_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """All rows and columns with the words of factors cut out of the text.

    A word goes with the white space before it; a text of which nothing goes
    is unchanged. ``n_chars``, where present, is that of the new text.
    """
    schema, columns = docs.schema, docs.columns
    streams, found = _indexed(docs, columns, block_bytes)

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):
            return pa.Table.from_batches([], pa.schema([(c, pa.null()) for c in columns]))
        rows, gone, _, block = _parsed(left, right)
        texts = rows["text"].to_pylist()
        for k in np.flatnonzero(np.add.reduceat(np.append(gone, False), block.firsts[:-1]) * (block.counts > 0)):
            texts[k] = _cut(texts[k], gone[block.firsts[k] : block.firsts[k + 1]])
        rows = rows.set_column(columns.index("text"), "text", pa.array(texts, pa.string()))
        if "n_chars" in columns:
            lengths = pa.array([None if t is None else len(t) for t in texts], pa.int64())
            place = columns.index("n_chars")
            rows = rows.set_column(place, "n_chars", lengths.cast(rows.schema.field(place).type))
        return rows

    return streams.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(tidied(cut), schema)


def _cut(text: str, gone: np.ndarray) -> str:
    data = np.frombuffer(text.encode(), np.uint8)
    found = words(data, np.array([0, len(data)]), SPACE)
    drop = np.zeros(len(data) + 1, np.int32)
    before = np.concatenate(([0], found.ends[:-1]))
    np.add.at(drop, before[gone], 1)
    np.add.at(drop, found.ends[gone], -1)
    return data[np.cumsum(drop[:-1]) == 0].tobytes().decode()
