"""Spelling variants: each word's near words, by dynamic programming over sorted lists.

Two words that differ by one edit agree in the first or in the last half of
the word that asks. So every word is filed under its halves, once as it stands
and once reversed, and a list holds the words of one half in order. A list is
scanned once for all that ask in it: words that follow each other share the
edit matrix's rows as far as their common prefix goes, only the band of one
edit beside the diagonal is kept of a row, and a range of words whose shared
prefix is more than one edit away from all that the asking word can reach is
skipped as a whole. All asking words of many lists advance together, one code
point of the lists a step, in NumPy arrays.

Long lists are cut into tiles by hash; every part that asks meets every part
that is listed. Only counts and the best near word leave a tile.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import stored
from .words import ranges, tidy

LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH = 7
LEAST_COUNT = 2
#: A word's form has at least so many times its occurrences.
RATIO = 10
#: One of so many hashes loses a code point.
LUCK = 31
#: Listed words of a tile; rows that are scanned at once; rows of a partition.
TILE, CHUNK, PARTITION = 8192, 16_384, 400_000
#: Listed words that the asking words of one pass have before them, added up.
PASS = 1 << 20
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): runs of letters in lower case, one in ``LUCK`` less a code point.

    Which run of a document loses which code point follows from the crc32 of
    ``<doc_id>:<run>``; a null id is empty there. Short and rare words go.
    """
    runs = F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))
    words = docs.select("doc_id", F.explode(runs).alias("run"))
    words = words.select("doc_id", F.translate("run", _UPPER, _LOWER).alias("run"))
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    words = words.select("run", F.crc32(name.cast("binary")).alias("h"))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    cut = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))
    word = F.when(F.col("h") % LUCK == 0, cut).otherwise(F.col("run"))
    words = words.select(word.alias("word")).filter(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def _filed(words: DataFrame) -> DataFrame:
    """(reversed, key, word, n, asks): each word under its halves, in both directions.

    A word of length l asks under its first l // 2 code points. It is listed
    under the halves of the lengths from l - 1 to l + 1, which are two.
    """
    half = (F.length("word") / 2).cast("int")
    other = F.when(F.length("word") % 2 == 0, half - 1).otherwise(half + 1)

    def under(flag: bool, word: Column, length: Column, asks: bool) -> Column:
        parts = F.lit(flag).alias("reversed"), word.substr(F.lit(1), length).alias("key"), word.alias("word")
        return F.struct(*parts, F.col("n"), F.lit(asks).alias("asks"))

    ways = [(False, F.col("word")), (True, F.reverse("word"))]
    rows = [under(flag, word, length, asks) for flag, word in ways for length, asks in ((half, True), (other, False))]
    return words.select(F.explode(F.array(*rows)).alias("f")).select("f.*")


def _tiled(filed: DataFrame, tile: int) -> DataFrame:
    """Add the tile and whether the row is listed in it; each part that asks meets each listed part."""
    large = filed.groupBy("reversed", "key").agg(F.count("*").alias("size")).filter(F.col("size") > tile)
    large = large.select(F.col("reversed").alias("r"), F.col("key").alias("k"), F.ceil(F.col("size") / tile).cast("int").alias("parts"))
    large = stored(large, "lists")
    if not large.take(1):
        return filed.select("*", F.lit(0).alias("tile"), F.lit(True).alias("listed"))
    same = (F.col("reversed") == F.col("r")) & (F.col("key") == F.col("k"))
    rows = filed.join(large, same, "left").withColumn("parts", F.coalesce("parts", F.lit(1))).drop("r", "k")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
    own, parts, every = F.col("own"), F.col("parts"), F.sequence(F.lit(0), F.col("parts") - 1)

    def listed(part: Column) -> Column:
        mine = F.col("asks") & (part == own)
        return F.struct((part * parts + own).alias("tile"), F.lit(True).alias("listed"), mine.alias("asks"))

    def asking(part: Column) -> Column:
        return F.struct((own * parts + part).alias("tile"), F.lit(False).alias("listed"), F.lit(True).alias("asks"))

    others = F.when(F.col("asks"), F.transform(F.filter(every, lambda p: p != own), asking)).otherwise(F.array())
    rows = rows.withColumn("place", F.explode(F.concat(F.transform(every, listed), others)))
    return rows.select("reversed", "key", "word", "n", "place.asks", "place.tile", "place.listed")


class Lists:
    """Sorted lists of words, end to end: code points, and per row its list, its size and its roles."""

    def __init__(self, words: pa.Array, lists: np.ndarray, known: np.ndarray, listed: np.ndarray, asks: np.ndarray) -> None:
        self.sizes = pa.compute.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        text = "".join(words.to_pylist())
        self.codes = np.append(np.frombuffer(text.encode("utf-32-le"), np.int32), np.zeros(2, np.int32))
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.lists, self.known = lists, known
        self.rows = np.flatnonzero(listed)
        self.asking = np.flatnonzero(asks)
        own = lists[self.rows]
        self.firsts = np.searchsorted(own, np.arange(len(known)))
        self.lasts = np.searchsorted(own, np.arange(len(known)), "right")

    def near(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows that ask, and listed rows that are one edit away from them."""
        before = np.cumsum(np.minimum(self.lasts - self.firsts, 1000)[self.lists[self.asking]])
        cuts = np.searchsorted(before, np.arange(PASS, before[-1] + PASS, PASS)) if len(before) else []
        found = [self._pass(part) for part in np.split(self.asking, cuts)]
        return np.concatenate([q for q, _ in found]), np.concatenate([w for _, w in found])

    def _pass(self, asking: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begin, size = self.begins[self.rows], self.sizes[self.rows]
        own = self.lists[self.rows]
        differs = np.ones(len(own), bool)  # from the word before, in the code points read so far
        differs[1:] = own[1:] != own[:-1]
        depths = self.known[self.lists[asking]]
        order = np.argsort(depths, kind="stable")
        waiting, depths, done = asking[order], depths[order], 0
        q = low = high = open_rows = np.zeros(0, np.int64)
        band = np.zeros((3, 0), np.int8)  # of the row: the columns beside the diagonal, 2 for more than one edit
        found_q, found_w = [q], [q]
        depth = 0
        while len(q) or done < len(waiting):
            if not len(q):
                depth, open_rows = int(depths[done]), open_rows[:0]
            if done < len(waiting) and depths[done] == depth:
                last = int(np.searchsorted(depths, depth, "right"))
                new, done = waiting[done:last], last
                lists = np.unique(self.lists[new])
                more = ranges(self.firsts[lists], self.lasts[lists] - self.firsts[lists])
                open_rows = np.sort(np.concatenate((open_rows, more)))
                begins, ends = self.firsts[self.lists[new]], self.lasts[self.lists[new]]
                some = ends > begins
                q, low, high = (np.concatenate(x) for x in ((q, new[some]), (low, begins[some]), (high, ends[some])))
                # The prefix is shared: no edit on the diagonal, one beside it.
                start = np.tile(np.array([[1], [0], [1]], np.int8), (1, int(some.sum())))
                start[2, depth + 1 > self.sizes[new[some]]] = 2
                band = np.concatenate((band, start), 1)
            # A listed word that ends here stands first in its range.
            column = self.sizes[q] - depth + 1
            ending = np.flatnonzero((size[low] == depth) & (column >= 0) & (column <= 2))
            ending = ending[band[column[ending], ending] == 1]
            found_q.append(q[ending])
            found_w.append(self.rows[low[ending]])
            # Words that go on begin a range of their own where they differ from the word before.
            open_rows = open_rows[size[open_rows] > depth]
            sign = self.codes[begin[open_rows] + depth]
            back = open_rows - 1
            before = np.where((back >= 0) & (size[back] > depth), self.codes[np.minimum(begin[back] + depth, len(self.codes) - 1)], -1)
            differs[open_rows] |= sign != before
            fresh = differs[open_rows]
            starts, signs = open_rows[fresh], sign[fresh]
            left, right = np.searchsorted(starts, low), np.searchsorted(starts, high)
            parent = np.repeat(np.arange(len(q)), right - left)
            child = ranges(left, right - left)
            following = np.append(starts, 0)[child + 1]
            high = np.where(child + 1 < right[parent], following, high[parent])
            low, q = starts[child], q[parent]
            band = self._row(band[:, parent], signs[child], q, depth)
            kept = band.min(0) <= 1
            q, low, high, band = q[kept], low[kept], high[kept], band[:, kept]
            depth += 1
        return np.concatenate(found_q), np.concatenate(found_w)

    def _row(self, above: np.ndarray, sign: np.ndarray, q: np.ndarray, depth: int) -> np.ndarray:
        """The band one row down, where the lists' words go on with ``sign``."""
        out = np.empty_like(above)
        at, size = self.begins[q] + depth, self.sizes[q]
        for k in range(3):  # the column depth + k, whose code point is the asking word's depth + k - 1
            place = at + k - 1
            cost = above[k] + (self.codes[np.clip(place, 0, len(self.codes) - 1)] != sign)
            if k < 2:
                cost = np.minimum(cost, above[k + 1] + 1)
            if k:
                cost = np.minimum(cost, out[k - 1] + 1)
            out[k] = np.minimum(cost, 2)
            out[k][(depth + k > size) | (depth + k < 1)] = 2
        return out

    def same_tail(self, q: np.ndarray, w: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the last n code points of both rows are equal."""
        a, b = (ranges(self.begins[x] + self.sizes[x] - n, n) for x in (q, w))
        wrong = np.concatenate(([0], np.cumsum(self.codes[a] != self.codes[b])))
        ends = np.cumsum(n)
        return wrong[ends] == wrong[ends - n]


def _scanned(table: pa.Table) -> pa.RecordBatch:
    """Of whole lists: asking words with near ones, their number, and the commonest's count and word."""
    fresh = _edges(table)
    lists = np.cumsum(fresh) - 1
    known = pa.compute.utf8_length(table["key"]).to_numpy()[fresh]
    words = table["word"].combine_chunks()
    flags = (table[c].to_numpy() for c in ("listed", "asks"))
    scan = Lists(words, lists, known, *flags)
    q, w = scan.near()
    # Reversed lists find what the others find as well where the first half agrees.
    turned = table["reversed"].to_numpy()
    twice = np.zeros(len(q), bool)
    back = np.flatnonzero(turned[q])
    twice[back] = scan.same_tail(q[back], w[back], known[lists[q[back]]])
    q, w = q[~twice], w[~twice]
    n = table["n"].to_numpy()
    plain = pa.compute.if_else(table["reversed"].combine_chunks(), pa.compute.utf8_reverse(words), words)
    place = np.empty(len(plain), np.int64)
    place[pa.compute.sort_indices(plain).to_numpy()] = np.arange(len(plain))
    order = np.lexsort((place[w], -n[w], q))
    q, w = q[order], w[order]
    asked, first, count = np.unique(q, return_index=True, return_counts=True)
    arrays = [plain.take(pa.array(asked)), pa.array(count, pa.int64()), pa.array(n[w[first]], pa.int64()), plain.take(pa.array(w[first]))]
    return pa.RecordBatch.from_arrays(arrays, ["word", "n_near", "best_n", "best"])


def _edges(table: pa.Table) -> np.ndarray:
    """Rows that begin a list."""
    out = np.ones(len(table), bool)
    out[1:] = False
    for column in ("reversed", "key", "tile"):
        values = table[column]
        out[1:] |= pa.compute.not_equal(values[1:], values[:-1]).to_numpy()
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: pa.Table | None = None
    for batch in tidy(batches):
        if not len(batch):
            continue
        own = pa.Table.from_batches([batch])
        held = own if held is None else pa.concat_tables([held, own])
        if len(held) < CHUNK:
            continue
        # The last list may go on in the next batch.
        begins = np.flatnonzero(_edges(held))
        cut, first = int(begins[-1]), 0
        while first < cut:
            last = int(begins[np.searchsorted(begins, min(first + CHUNK, cut), "right") - 1])
            last = last if last > first else int(begins[np.searchsorted(begins, first, "right")])
            yield _scanned(held.slice(first, last - first).combine_chunks())
            first = last
        held = held.slice(cut).combine_chunks()
    if held is not None and len(held):
        yield _scanned(held.combine_chunks())


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """(word, n_near, best_n, best): how many words are one edit away, and the commonest, of equals the first.

    ``words`` has distinct words and their counts ``n``; words without near
    ones have no row. Words of any length are compared; one of length l and
    less than two code points asks all words of the lengths around it.
    """
    rows = _tiled(_filed(words), tile)
    spark = words.sparkSession
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-4 * words.count() // PARTITION))
    lists = ["reversed", "key", "tile"]
    rows = rows.repartition(width, *lists).sortWithinPartitions(*lists, "word")
    found = rows.mapInArrow(_scan, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best"))).alias("b")
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return found.select("word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: the last of their forms, by joins that double the steps."""
    reached = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = reached.select(F.col("word").alias("via"), F.col("root").alias("next"))
        if not reached.join(further, F.col("root") == F.col("via"), "left_semi").take(1):
            return reached
        reached = reached.join(further, F.col("root") == F.col("via"), "left")
        reached = stored(reached.select("word", F.coalesce("next", "root").alias("root")), "roots")


def spelling_variants(
    docs: DataFrame,
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    ratio: int = RATIO,
    tile: int = TILE,
) -> DataFrame:
    """Each word of the texts with the form that it may be a misspelling of.

    One row per distinct word: word, form, root, n, n_near, form_n. A form is
    the commonest word one edit away, of equals the first by code points, where
    it occurs at least ``ratio`` times as often; without one form and form_n
    are null and root is the word. Null and empty texts have no words; repeated
    rows count again; an empty table has no rows. Other columns are not looked
    at.
    """
    words = stored(word_counts(docs, least_length, least_count), "words")
    near = near_words(words, tile).withColumnRenamed("word", "of")
    rows = words.join(near, F.col("word") == F.col("of"), "left")
    has = F.col("best_n") >= F.col("n") * ratio
    rows = rows.select(
        "word",
        F.when(has, F.col("best")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, F.col("best_n")).alias("form_n"),
    )
    rows = stored(rows, "forms")
    last = roots(rows.filter("form is not null")).withColumnRenamed("word", "of")
    rows = rows.join(last, F.col("word") == F.col("of"), "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
