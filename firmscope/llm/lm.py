"""LM scoring: the probability of a text summed over all its segmentations.

The vocabulary is a public one. Its own scores are merge ranks and no
probabilities, so each piece's probability is learned: all training words are
cut greedily into longest pieces, and the counts are smoothed. A text's
probability is the product over its words, as no piece spans white space, of
the sum over all segmentations, by a forward recursion in log space, and of
an end.

Beside it stands a plain smoothed word model. Its counts cover all training
words; a block of documents reports each of its distinct words once and is
told that word's count in all blocks, so the traffic grows with the blocks'
vocabularies and no table of all words has to fit anywhere.
"""

from __future__ import annotations

import pickle
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import block_count, packed, tidied, unpacked
from ..shared import stored
from .language import vocabulary_path
from .lattice import log_marginals, longest_pieces, pieces
from .words import LOWER, Remembered, mixed, spans, stretches, words

BLOCK_BYTES = 1 << 23
SMOOTHING = 0.1
#: Hash of the end of a text; no word is empty.
END = int(mixed(np.array([0], np.uint64) + np.uint64(1))[0])
WORD, PIECE = 0, 1


def held_out(doc_id: Column, parts: int = 7, part: int = 2) -> Column:
    """Whether crc32 of the id as text leaves ``part``; a null id never does."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


class Block:
    """Distinct words of a block's documents, and which of them each word is."""

    def __init__(self, streams: pa.ChunkedArray) -> None:
        self.rows = unpacked(streams)
        hashes, counts, texts, starts, ends, size = [], [], [], [], [], 0
        for _, _, data, offsets in stretches(self.rows["text"].combine_chunks(), lower=True):
            found = words(data, offsets)
            hashes.append(spans(data, found.starts, found.ends))
            counts.append(found.counts)
            texts.append(data)
            starts.append(found.starts + size)
            ends.append(found.ends + size)
            size += len(data)
        self.counts = np.concatenate(counts)
        self.keys, first, self.place = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        self.place = self.place.astype(np.int32)
        self.text = b"".join(t.tobytes() for t in texts)
        self.starts, self.ends = np.concatenate(starts)[first], np.concatenate(ends)[first]

    def words(self, at: np.ndarray) -> list[bytes]:
        spots = zip(self.starts[at].tolist(), self.ends[at].tolist(), strict=True)
        return [self.text[a:b] for a, b in spots]


@lru_cache(maxsize=1)
def _segmentations(path: str) -> Remembered:
    return Remembered(np.int32, 500_000)


@lru_cache(maxsize=1)
def _marginals(model: bytes) -> Remembered:
    return Remembered(np.float64, 600_000)


def _counted(path: str):
    def run(table: pa.Table) -> pa.Table:
        block = Block(table["stream"])
        vocabulary, memory = pieces(path), _segmentations(path)
        training = ~block.rows["held_out"].combine_chunks().to_numpy(zero_copy_only=False)
        often = np.bincount(block.place[np.repeat(training, block.counts)], minlength=len(block.keys))
        own = np.flatnonzero(often)

        def learn(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            sizes, values = [], []
            for k in range(0, len(new), 20_000):
                some = block.words(own[new[k : k + 20_000]])
                word, piece = longest_pieces(vocabulary, some)
                order = np.argsort(word, kind="stable")
                values.append(piece[order])
                sizes.append(np.bincount(word, minlength=len(some)))
            return np.concatenate(sizes), np.concatenate(values)

        row = memory.rows_of(block.keys[own], learn)
        begins = memory.offsets[row]
        sizes = memory.offsets[row + 1] - begins
        at = np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        used = np.bincount(memory.values[at], np.repeat(often[own], sizes), vocabulary.size).astype(np.int64)
        seen = np.flatnonzero(used)
        keys = np.concatenate((block.keys.view(np.int64), np.array([END], np.uint64).view(np.int64), seen))
        counts = np.concatenate((often, [np.count_nonzero(training)], used[seen]))
        kinds = np.full(len(keys), PIECE, np.int32)
        kinds[: len(block.keys) + 1] = WORD
        number = np.full(len(keys), table["block"][0].as_py(), np.int64)
        return pa.table({"kind": kinds, "key": keys, "block": number, "n": counts.astype(np.int64)})

    return run


def _scored(model: bytes):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        path, scores, end = pickle.loads(model)
        if not len(left):
            empty = pa.array([], pa.int64())
            return _result(empty, pa.array([], pa.bool_()), *[np.zeros(0)] * 4)
        block = Block(left["stream"])
        vocabulary, memory = pieces(path), _marginals(model)

        def learn(new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            made = [np.zeros(0)]
            for k in range(0, len(new), 20_000):
                made.append(log_marginals(vocabulary, block.words(new[k : k + 20_000]), scores[:, None])[:, 0])
            return np.ones(len(new), np.int64), np.concatenate(made)

        row = memory.rows_of(block.keys, learn)
        marginal = memory.values[memory.offsets[row]]
        told = right["key"].to_numpy().view(np.uint64)
        order = np.argsort(told)
        totals = right["total"].to_numpy()[order]
        count = totals[np.searchsorted(told[order], block.keys)]
        ends = int(totals[np.searchsorted(told[order], np.uint64(END))])
        bounds = np.concatenate(([0], np.cumsum(block.counts)))

        def summed(values: np.ndarray) -> np.ndarray:
            # Each text is added up by itself: long running sums would lose digits.
            sums = np.zeros(len(block.counts))
            full = block.counts > 0
            if full.any():
                sums[full] = np.add.reduceat(values[block.place], bounds[:-1][full])
            return sums

        known = summed((count > 0).astype(float)) + (ends > 0)
        logs = summed(np.log10(count + 1.0)) + np.log10(ends + 1.0)
        score = (summed(marginal) + end) / np.log(10)
        ids = block.rows["doc_id"].combine_chunks().cast(pa.int64())
        return _result(ids, block.rows["held_out"].combine_chunks(), block.counts + 1, known, logs, score)

    return run


def _result(ids, held, tokens, known, logs, score) -> pa.Table:
    return pa.table(
        {
            "doc_id": ids,
            "held_out": held,
            "n_tokens": pa.array(np.asarray(tokens, np.int64)),
            "n_known": pa.array(np.asarray(known).astype(np.int64)),
            "logs": pa.array(np.asarray(logs, float)),
            "score": pa.array(np.asarray(score, float)),
        }
    )


def score_texts(docs: DataFrame, vocabulary: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every whole text.

    Learns from rows that are not held out. One row per input row, repeated
    rows included; each counts. A null or empty text is one end. A null
    ``doc_id`` stays null and is learned from. Without training rows every
    count is 0. Other columns are not looked at.
    """
    path = vocabulary or vocabulary_path()
    rows = docs.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    streams = packed(rows, block_count(rows, block_bytes), ["doc_id", "text", "held_out"])
    counts = streams.groupBy("block").applyInArrow(tidied(_counted(path)), "kind int, key long, block long, n long")
    same = Window.partitionBy("kind", "key")
    counts = counts.select(
        "kind", "key", "block", F.sum("n").over(same).alias("total"), (F.min("block").over(same) == F.col("block")).alias("first")
    )
    counts = stored(counts, "counts")
    once = counts.filter("first")
    all_words = once.filter(F.col("kind") == WORD).agg(F.sum("total").alias("n"), F.count_if(F.col("total") > 0).alias("v")).first()
    n, v = all_words.n or 0, all_words.v
    used = once.filter(F.col("kind") == PIECE).select("key", "total").toArrow()
    signed_end = int(np.array([END], np.uint64).view(np.int64)[0])
    ends = once.filter((F.col("kind") == WORD) & (F.col("key") == signed_end)).agg(F.sum("total")).first()[0] or 0
    table = np.full(pieces(path).size + 1, SMOOTHING)
    table[used["key"].to_numpy()] += used["total"].to_numpy()
    table[-1] += ends
    logs = np.log(table / table.sum())
    model = pickle.dumps((path, logs[:-1], float(logs[-1])))
    told = counts.filter(F.col("kind") == WORD).select("block", "key", "total")
    scored = streams.groupBy("block").cogroup(told.groupBy("block"))
    scored = scored.applyInArrow(
        tidied(_scored(model)), "doc_id long, held_out boolean, n_tokens long, n_known long, logs double, score double"
    )
    base = F.col("logs") - F.col("n_tokens") * float(np.log10(n + v + 1.0))
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), "score"
    )
