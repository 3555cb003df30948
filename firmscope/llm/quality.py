"""Quality rules: fixed counts and a hashed n-gram logistic model.

Every word, pair of words and run of ``CHARACTERS`` bytes is hashed into one
of ``2 ** BITS`` weights; a text's logit is the mean weight of each of the
three families plus an intercept. The model is fitted on a bounded sample of
labelled rows, and a second part of the sample calibrates its logits to
probabilities. Texts are scored in Arrow batches, stretch by stretch.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .learn import newton, sigmoid, sparse_logistic
from .rows import luck
from .words import SPACE, Words, covered, per_text, spans, stretches, tidy, windows, words

BITS = 16
CHARACTERS = 4
#: Most labelled rows that the model is fitted on and calibrated with, half of each class where there are as many.
SAMPLE = 3_000
KEEP_FROM = 0.4
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
#: Scale of the mean counts, so that weights and ridge are of ordinary size.
SCALE = 20.0

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LINE = np.ones(256, bool)
_LINE[:] = False
_LINE[10] = True


def _hashed(data: np.ndarray, offsets: np.ndarray, found: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """(bucket, offsets of the texts) of each family."""
    hashes = spans(data, found.starts, found.ends)
    pairs, firsts = windows(hashes, found, 2)
    size = max(len(data) - CHARACTERS + 1, 0)
    starts = np.arange(size)
    runs = np.zeros(size, np.uint64)
    for k in range(CHARACTERS):  # bytes side by side are the run's own number
        runs |= data[k : size + k].astype(np.uint64) << np.uint64(8 * k)
    runs = (runs * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)
    lasts = np.maximum(offsets[1:] - CHARACTERS + 1, offsets[:-1])
    within = np.zeros(size + 1, np.int64)
    np.add.at(within, np.minimum(offsets[:-1], size), 1)
    np.add.at(within, np.minimum(lasts, size), -1)
    inside = np.cumsum(within[:-1]) > 0
    top = np.uint64(64 - BITS)
    bounds = np.searchsorted(firsts, found.firsts)
    runs_at = np.searchsorted(starts[inside], offsets)
    return [(hashes >> top, found.firsts), (pairs >> top, bounds), (runs[inside], runs_at)]


def logits(data: np.ndarray, offsets: np.ndarray, found: Words, weights: np.ndarray) -> np.ndarray:
    """Logit of each text; ``weights`` holds the families one after the other, then the intercept."""
    total = np.full(len(offsets) - 1, weights[-1])
    for family, (buckets, bounds) in enumerate(_hashed(data, offsets, found)):
        sums = np.zeros(len(buckets) + 1)
        np.cumsum(weights[(family << BITS) + buckets.astype(np.int64)], out=sums[1:])
        counts = np.diff(bounds)
        total += SCALE * (sums[bounds[1:]] - sums[bounds[:-1]]) / np.maximum(counts, 1)
    return total


def counts(data: np.ndarray, offsets: np.ndarray, found: Words) -> dict[str, np.ndarray]:
    """The fixed counts of each text."""
    first_of_point = (data & 0xC0) != 0x80
    return {
        "n_words": found.counts,
        "word_chars": per_text(first_of_point & ~SPACE[data], offsets),
        "n_symbols": per_text(_SYMBOL[data], offsets),
        "n_dup_lines": _repeated_lines(data, offsets, found),
        "n_repeat_words": _repeated_words(data, found),
    }


def _repeated_lines(data: np.ndarray, offsets: np.ndarray, found: Words) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    lines = words(data, offsets, _LINE)
    holds = np.searchsorted(found.starts, lines.ends) > np.searchsorted(found.starts, lines.starts)
    text = np.repeat(np.arange(len(lines.counts)), lines.counts)[holds]
    keys = spans(data, lines.starts[holds], lines.ends[holds])
    return _again(text, keys, len(lines.counts))


def _again(text: np.ndarray, keys: np.ndarray, size: int) -> np.ndarray:
    """Per text, how many keys stood in it before."""
    order = np.lexsort((keys, text))
    text, keys = text[order], keys[order]
    same = (text[1:] == text[:-1]) & (keys[1:] == keys[:-1])
    return np.bincount(text[1:][same], minlength=size)


def _repeated_words(data: np.ndarray, found: Words) -> np.ndarray:
    """Words in windows whose words stand in the text twice or more."""
    hashes = spans(data, found.starts, found.ends)
    keys, firsts = windows(hashes, found, WINDOW)
    if not len(keys):
        return np.zeros(len(found.counts), np.int64)
    text = np.repeat(np.arange(len(found.counts), dtype=np.uint64), found.counts)[firsts]
    keys = keys ^ (text * np.uint64(0x9E3779B97F4A7C15))  # equal only inside a text
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    same = sorted_keys[1:] == sorted_keys[:-1]
    twice = np.zeros(len(keys), bool)
    twice[1:] |= same
    twice[:-1] |= same
    flags = covered(np.sort(firsts[order[twice]]), WINDOW, len(hashes))
    return per_text(flags, found.firsts)


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's buckets and their scaled mean counts."""
    for batch in tidy(batches):
        buckets, values = [], []
        for _, _, data, offsets in stretches(batch.column(0)):
            families = _hashed(data, offsets, words(data, offsets))
            for row in range(len(offsets) - 1):
                cells, shares = [], []
                for family, (found, bounds) in enumerate(families):
                    own, n = np.unique(found[bounds[row] : bounds[row + 1]].astype(np.int64), return_counts=True)
                    cells.append(own + (family << BITS))
                    shares.append(SCALE * n / max(n.sum(), 1))
                buckets.append(np.concatenate(cells).astype(np.int32))
                values.append(np.concatenate(shares).astype(np.float32))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(buckets, pa.list_(pa.int32())),
                pa.array(values, pa.list_(pa.float32())),
                batch.column(1).cast(pa.int32()),
                batch.column(2).cast(pa.int32()),
            ],
            ["buckets", "shares", "y", "part"],
        )


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> bytes:
    """Weights and calibration from a sample of the labelled rows of ``labels``; needs doc_id, quality."""
    rows = labels.select(F.col("doc_id").alias("labelled"), F.col("quality").cast("int").alias("y"))
    rows = rows.filter(F.col("y").isin(0, 1) & F.col("labelled").isNotNull())
    rows = rows.groupBy("labelled").agg(F.min("y").alias("y"))
    n = rows.agg(F.sum("y").alias("good"), F.count("*").alias("all")).first()
    good, bad = n.good or 0, n["all"] - (n.good or 0)
    share = [min(1.0, size / 2 / max(k, 1)) for k in (bad, good)]
    rows = rows.filter(luck("quality", "labelled") < F.when(F.col("y") == 1, share[1]).otherwise(share[0]))
    rows = rows.withColumn("part", F.pmod(F.xxhash64(F.lit("part"), "labelled"), F.lit(4)).cast("int"))
    texts = docs.select("doc_id", "text")
    texts = texts.join(F.broadcast(rows), F.col("doc_id") == F.col("labelled")).select("text", "y", "part")
    seen = texts.mapInArrow(_cells, "buckets array<int>, shares array<float>, y int, part int").toArrow()
    y = seen["y"].to_numpy().astype(float)
    if len(np.unique(y)) < 2:
        return pickle.dumps((np.zeros((3 << BITS) + 1), np.array([0.0, 1.0]), 1.0 if not len(y) else float(y[0])))
    lists = seen["buckets"].combine_chunks()
    row = np.repeat(np.arange(len(y)), np.diff(lists.offsets.to_numpy()))
    bucket = lists.flatten().to_numpy().astype(np.int64)
    value = seen["shares"].combine_chunks().flatten().to_numpy().astype(float)
    fitting = seen["part"].to_numpy() != 0
    if len(np.unique(y[fitting])) < 2 or len(np.unique(y[~fitting])) < 2:
        fitting[:] = True
    place = np.cumsum(fitting) - 1
    own = fitting[row]
    weights = sparse_logistic(place[row[own]], bucket[own], value[own], y[fitting], 3 << BITS, 1e-4, 150)
    judged = ~fitting if not fitting.all() else fitting
    z = np.bincount(row, value * weights[bucket], len(y))[judged] + weights[-1]
    x = np.stack([np.ones(len(z)), z], 1)
    calibration = newton(x, y[judged], np.array([0.0, 1.0]), np.array([0.01, 0.01]))
    return pickle.dumps((weights, calibration, float(y.mean())))


COLUMNS = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, probability double, kept boolean"
)


def judge(docs: DataFrame, model: bytes, keep_from: float = KEEP_FROM) -> DataFrame:
    """Counts, calibrated probability of good quality, and verdict of every whole text.

    One row per input row, repeated rows included. A null or empty text has no
    words and fails; a null ``doc_id`` stays null. Other columns are not
    looked at. Without labels of both classes every text that passes the
    counts is kept, unless all labels are bad.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, calibration, plain = pickle.loads(model)
        for batch in tidy(batches):
            for first, last, data, offsets in stretches(batch.column(1)):
                found = words(data, offsets)
                base = counts(data, offsets, found)
                n = base["n_words"]
                failed = (n < MIN_WORDS) | (100 * base["n_repeat_words"] > MAX_REPEAT_PERCENT * n)
                if weights.any():
                    z = logits(data, offsets, found, weights)
                    good = sigmoid(calibration[0] + calibration[1] * z)
                else:
                    good = np.full(len(n), plain)
                arrays = [batch.column(0).slice(first, last - first).cast(pa.int64())]
                arrays += [pa.array(base[name].astype(np.int64)) for name in base]
                arrays += [pa.array(failed), pa.array(good), pa.array(~failed & (good >= keep_from))]
                yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in COLUMNS.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(score, COLUMNS)
