"""Language ID by unigram models over pieces, summed over all segmentations.

Each language has its own probabilities of the pieces of a fixed public
vocabulary. A word's probability in a language is the sum over all its
segmentations, by the forward recursion of ``lattice``; a text's is the
product over its words. The language of most posterior probability wins.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lattice import log_marginals, longest_pieces, pieces
from .rows import luck
from .toxicity import held_out
from .words import tidy

VOCABULARY = "piece_bpe_32k.model"
#: About how many training documents per language the piece probabilities are fitted on, at most.
SAMPLE = 1_500
#: Added to every piece's count.
SMOOTHING = 0.2
#: Words whose probabilities a worker keeps at hand.
REMEMBERED = 150_000
UNDECIDED = "und"

_WORD = re.compile(r"[^\W\d_]+")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased."""
    found = _WORD.findall(text.lower()) if text else []
    if "".join(found).isalpha():
        return found
    # The pattern also takes numbers that are no digits, such as fractions.
    return [part for word in found for part in "".join(c if c.isalpha() else " " for c in word).split()]


def fit(docs: DataFrame, size: int = SAMPLE, vocabulary: str | None = None) -> bytes:
    """Languages and their log piece probabilities, from training rows with a language."""
    path = vocabulary or vocabulary_path()
    rows = docs.select("doc_id", "lang", "text").filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {row.lang: row["count"] for row in rows.groupBy("lang").count().collect()}
    if not counts:
        return pickle.dumps(([], path, np.zeros((pieces(path).size, 0))))
    langs = sorted(counts)
    share = F.create_map(*(F.lit(x) for lang in langs for x in (lang, min(1.0, size / counts[lang]))))
    # By id and text, so that rows that share one of them are not taken or left together.
    rows = rows.filter(luck("lang", "doc_id", "text") < share[F.col("lang")]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = {}
        for batch in tidy(batches):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found.setdefault(lang, Counter()).update(words_of(text))
        for lang, counter in found.items():
            words = list(counter)
            word, piece = longest_pieces(pieces(path), [w.encode() for w in words])
            often = np.fromiter(counter.values(), np.int64, len(words))
            n = np.bincount(piece, often[word], pieces(path).size)
            own = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(own), pa.string()), pa.array(own.astype(np.int32)), pa.array(n[own].astype(np.int64))],
                ["lang", "piece", "n"],
            )

    seen = rows.mapInArrow(count, "lang string, piece int, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n"))
    table = np.zeros((pieces(path).size, len(langs)))
    got = seen.toArrow()
    column = {lang: k for k, lang in enumerate(langs)}
    where = [column[x] for x in got["lang"].to_pylist()]
    table[got["piece"].to_numpy(), where] = got["n"].to_numpy()
    table += SMOOTHING
    return pickle.dumps((langs, path, np.log(table / table.sum(0)).astype(np.float32)))


@lru_cache(maxsize=2)
def _model(made: bytes) -> tuple:
    return (*pickle.loads(made), {})


def _known(model: tuple, words: set[str]) -> tuple[dict[str, int], np.ndarray]:
    """Place and log probabilities of words, from the worker's memory or worked out."""
    langs, path, scores, memory = model
    if len(memory.get("place", ())) + len(words) > REMEMBERED:
        memory.clear()
    place = memory.setdefault("place", {})
    new = [w for w in words if w not in place]
    for k in range(0, len(new), 20_000):
        part = new[k : k + 20_000]
        made = log_marginals(pieces(path), [w.encode() for w in part], scores).astype(np.float32)
        size = len(place)
        place.update(zip(part, range(size, size + len(part)), strict=True))
        held = memory.get("values", np.zeros((0, len(langs)), np.float32))
        if size + len(part) > len(held):
            grown = np.zeros((max(2 * len(held), size + len(part)), len(langs)), np.float32)
            grown[:size] = held[:size]
            memory["values"] = held = grown
        held[size : size + len(part)] = made
    return place, memory.get("values", np.zeros((0, len(langs)), np.float32))


#: Characters of text that are worked on at once, beyond one whole text.
GROUP = 1 << 21


def predict(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, held_out, lang_pred and its posterior probability, of every whole text.

    One row per input row, repeated rows included. A null text or one without
    a letter is ``und`` with score 0, and so is every text if no language was
    learned. Ties go to the language first in order. A null ``doc_id`` stays
    null and is not held out. Only the text enters the prediction.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _model(model)
        langs = own[0]
        for batch in tidy(batches):
            texts, preds, scores = batch.column(2), [], []
            for group in _groups(texts):
                found = [words_of(t) if langs else [] for t in group]
                place, values = _known(own, set().union(*found))
                counts = np.fromiter(map(len, found), np.int64, len(found))
                at = np.fromiter((place[w] for words in found for w in words), np.int64, int(counts.sum()))
                sums = np.zeros((len(at) + 1, len(langs)))
                np.cumsum(values[at], axis=0, out=sums[1:])
                bounds = np.concatenate(([0], np.cumsum(counts)))
                for row, n in enumerate(counts):
                    if not n:
                        preds.append(UNDECIDED)
                        scores.append(0.0)
                        continue
                    total = sums[bounds[row + 1]] - sums[bounds[row]]
                    best = int(np.argmax(total))
                    preds.append(langs[best])
                    scores.append(float(1 / np.exp(total - total[best]).sum()))
            ids = batch.column(0).cast(pa.int64())
            arrays = [ids, batch.column(1), pa.array(preds, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(score, "doc_id long, held_out boolean, lang_pred string, score double")


def _groups(texts: pa.Array) -> Iterator[list[str | None]]:
    group, size = [], 0
    for value in texts:
        text = value.as_py()
        group.append(text)
        size += len(text or "")
        if size >= GROUP:
            yield group
            group, size = [], 0
    if group:
        yield group
