"""Toxicity: misspelled terms by a Levenshtein automaton over a lexicon trie.

The lexicon holds whole terms and stems. They form a trie; its states paired
with a number of edits, determinised, are the intersection of the terms'
Levenshtein automata with the trie, and one table of next states reads all
words of a stretch side by side, letter by letter, until they are rejected.
Words that end in an accepting state are hits. What stands around a hit (quote
marks, words of reporting, words of address) separates quotation from abuse;
a logistic model over a text's hits gives its score.

Terms and stems are mined from labelled training rows, besides a few fixed
ones; the model's weights are fitted on the same rows.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import stored
from .learn import newton, sigmoid
from .rows import luck
from .words import tidy

# Insults known before any label is seen.
SEED_TERMS = (
    "idiot", "idiots", "moron", "morons", "scum", "trash", "worthless", "pathetic", "disgusting", "clown", "loser",
    "losers", "stupid", "dumb", "imbecile", "bastard", "scumbag", "dimwit", "halfwit", "vermin",
)
# Words of reporting, and of address.
REPORTING = frozenset(
    "said says say called calls word words term terms phrase quote quoted quotes wrote writes written slur insult "
    "insults meaning means definition dit mot terme citation sagte wort zitat dijo palabra cita".split()
)
ADDRESS = frozenset("you your youre yours u ur du dich dir tu toi vous te usted".split())
QUOTES = frozenset("\"“”„«»‘’`")

THRESHOLD = 0.3
#: Most labelled training rows that lexicon and model are fitted on, about half of them toxic where there are as many.
SAMPLE = 12_000
WINDOW = 8
FUZZY_FROM = 5
SHORTEST_STEM, LONGEST_STEM = 4, 9
DEAD = 0


class Lexicon:
    """Terms and stems as one deterministic automaton over letter classes.

    A term of at least ``FUZZY_FROM`` letters also accepts words at one edit
    from it that share its first letter; a stem accepts words that begin with
    it, and, where it is as long, words at one edit from it and words that
    begin with it at one edit before its last letter. (An edit of the last
    letter would make any continuation of a shorter stem a hit.) ``kind`` of a
    state: 0 none, 1 misspelled term or stem, 2 stem, 3 term.
    """

    def __init__(self, terms: list[str], stems: list[str]) -> None:
        letters = sorted({c for t in terms + stems for c in t})
        self.letters = np.zeros(0x10000, np.int32)
        for k, c in enumerate(letters):
            if ord(c) < 0x10000:
                self.letters[ord(c)] = k + 1
        children: list[dict[str, int]] = [{}]
        term_at, stem_at, fuzzy = [False], [False], [False]
        for text, marks in [(t, term_at) for t in terms] + [(s, stem_at) for s in stems]:
            node = 0
            for c in text:
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                    for flags in (term_at, stem_at, fuzzy):
                        flags.append(False)
                node = children[node][c]
            marks[node] = True
        long_stem = set()
        for k, t in enumerate(terms + stems):  # nodes on the way of a term or stem that may hold an edit
            if len(t) >= FUZZY_FROM:
                node = 0
                for c in t:
                    node = children[node][c]
                    fuzzy[node] = True
                if k >= len(terms):
                    long_stem.add(node)
        ends = {node for node, here in enumerate(term_at) if here and fuzzy[node]} | long_stem

        def step(state: frozenset, c: str) -> frozenset:
            out = set()
            for node, edits in state:
                if node == -1 and not edits:
                    return state
                if node == -1:
                    out.add((-1, 1))
                    continue
                if c in children[node]:
                    out.add((children[node][c], edits))
                    if edits and children[node][c] in long_stem:
                        out.add((-1, 1))
                if not edits and fuzzy[node]:
                    out.add((node, 1))  # a letter too many
                    for child in children[node].values():
                        if fuzzy[child]:
                            out.add((child, 1))  # another letter
                            if c in children[child]:
                                out.add((children[child][c], 1))  # a letter missing
                                if children[child][c] in long_stem:
                                    out.add((-1, 1))
            if any(not edits and stem_at[node] for node, edits in out):
                return frozenset({(-1, 0)})
            if (-1, 1) in out:  # whatever else is at one edit says no more
                return frozenset(x for x in out if not x[1]) | {(-1, 1)}
            return frozenset(x for x in out if not x[1] or fuzzy[x[0]])

        def kind(state: frozenset) -> int:
            if (-1, 0) in state:
                return 2
            if any(not edits and term_at[node] for node, edits in state):
                return 3
            if (-1, 1) in state:
                return 1
            missing = any(
                not edits and fuzzy[node] and child in ends for node, edits in state for child in children[node].values()
            )
            return int(missing or any(edits and node in ends for node, edits in state))

        start = frozenset({(0, 0)})
        numbers: dict[frozenset, int] = {frozenset(): DEAD, start: 1}
        table, kinds, waiting = {DEAD: [DEAD] * (len(letters) + 1)}, {DEAD: 0, 1: 0}, [start]
        while waiting:
            state = waiting.pop()
            row = []
            for c in ["", *letters]:
                below = step(state, c)
                if below not in numbers:
                    numbers[below] = len(numbers)
                    kinds[numbers[below]] = kind(below)
                    waiting.append(below)
                row.append(numbers[below])
            table[numbers[state]] = row
        self.table = np.array([table[k] for k in range(len(table))], np.int32)
        self.kinds = np.array([kinds[k] for k in range(len(kinds))], np.int8)

    def read(self, classes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Kind of each word."""
        state = np.ones(len(starts), np.int32)
        live, place = np.arange(len(starts)), starts.copy()
        while len(live):
            state[live] = self.table[state[live], classes[place]]
            place = place + 1
            on = (state[live] != DEAD) & (place < ends[live])
            live, place = live[on], place[on]
        return self.kinds[state]


_IS_LETTER = np.array([chr(k).isalpha() for k in range(0x10000)])
_IS_SPACE = np.array([chr(k).isspace() for k in range(0x10000)])

FEATURES = ("bias", "terms", "misspelled", "stems", "share", "quoted", "reported", "addressed")
#: Before any row is seen: one plain hit is abuse, a quoted and reported one is not.
PRIOR = np.array([-4.0, 4.0, 1.5, 3.0, 0.5, -2.0, -1.5, 0.5])
STRENGTH = np.array([0.1, 0.1, 1.0, 0.1, 0.5, 2.0, 2.0, 2.0])

#: A text is worked on in pieces of whole words of about so many characters.
PIECE = 1 << 20


def _inside(text: str, k: int) -> bool:
    """Whether a digit or sign stands at ``k`` between two letters."""
    if not 0 < k < len(text) - 1 or text[k].isalpha() or text[k].isspace():
        return False
    return text[k - 1].isalpha() and text[k + 1].isalpha()


def _pieces(text: str) -> Iterator[str]:
    if len(text) <= PIECE:
        yield text
        return
    start = 0
    while start < len(text):
        stop = min(start + PIECE, len(text))
        while stop < len(text) and (text[stop].isalpha() or _inside(text, stop - 1) or _inside(text, stop)):
            stop += 1
        yield text[start:stop]
        start = stop


def hits(lexicon: Lexicon, texts: list[str]) -> np.ndarray:
    """Counts of each text: words, terms, misspelled terms, stems, quoted, reported and addressed hits."""
    out = np.zeros((len(texts), 7), np.int64)
    group, rows, size = [], [], 0
    for row, text in enumerate(texts):
        for piece in _pieces(text):
            group.append(piece)
            rows.append(row)
            size += len(piece)
            if size >= PIECE:
                _count(lexicon, group, rows, out)
                group, rows, size = [], [], 0
    _count(lexicon, group, rows, out)
    return out


def _count(lexicon: Lexicon, texts: list[str], rows: list[int], out: np.ndarray) -> None:
    if not texts:
        return
    joined = "\n".join(texts).lower()  # may change lengths, so texts are found again by their line feeds
    lengths = np.array([len(t.lower()) for t in texts])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    small = np.minimum(codes, 0xFFFF)
    letter = _IS_LETTER[small] | (codes > 0xFFFF)
    begin, end = letter.copy(), letter.copy()
    begin[1:] &= ~letter[:-1]
    end[:-1] &= ~letter[1:]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    begins = np.cumsum(lengths + 1) - lengths - 1
    of_text = np.searchsorted(begins, starts, "right") - 1
    row = np.array(rows)[of_text]
    out[:, 0] += np.bincount(row, minlength=len(out))
    classes = lexicon.letters[small]
    kinds = lexicon.read(classes, starts, ends)
    # Two words with one digit or sign between them are also read as one word that holds another letter there.
    split = np.flatnonzero((starts[1:] - ends[:-1] == 1) & ~_IS_SPACE[small[ends[:-1]]]) if len(starts) > 1 else np.zeros(0, np.int64)
    split = split[(kinds[split] == 0) & (kinds[split + 1] == 0)]
    found = lexicon.read(classes, starts[split], ends[split + 1])
    kinds[split] = np.where(found == 1, 1, kinds[split])
    for word in np.flatnonzero(kinds):
        kind, t = int(kinds[word]), of_text[word]
        low = max(word - WINDOW, np.searchsorted(starts, begins[t]))
        high = min(word + WINDOW + 1, np.searchsorted(starts, begins[t] + lengths[t]))
        near = {joined[starts[k] : ends[k]] for k in range(low, high)}
        left, right = joined[starts[low] : starts[word]], joined[ends[word] : ends[high - 1] + 1]
        quoted = any(c in QUOTES for c in left) and any(c in QUOTES for c in right)
        found = out[row[word]]
        found[{3: 1, 1: 2, 2: 3}[kind]] += 1
        found[4] += quoted
        found[5] += bool(near & REPORTING)
        found[6] += bool(near & ADDRESS)


def features(counts: np.ndarray) -> np.ndarray:
    words, terms, misspelled, stems, quoted, reported, addressed = counts.T.astype(float)
    every = np.maximum(terms + misspelled + stems, 1)
    share = np.log1p(100 * (terms + misspelled + stems) / np.maximum(words, 1))
    columns = (
        np.ones(len(counts)), np.log1p(terms), np.log1p(misspelled), np.log1p(stems), share,
        quoted / every, reported / every, addressed / every,
    )
    return np.stack(columns, 1)


def held_out(doc_id: Column, parts: int = 4, part: int = 2) -> Column:
    """Whether crc32 of the id as text leaves ``part``; a null id never does."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame, size: int) -> DataFrame:
    """(text, y) of at most about ``size`` training rows, chosen by the id's hash."""
    rows = labels.select(F.col("doc_id").alias("labelled"), F.col("toxic").cast("int").alias("y"))
    rows = rows.filter(F.col("y").isin(0, 1) & F.col("labelled").isNotNull() & ~held_out(F.col("labelled")))
    rows = rows.groupBy("labelled").agg(F.max("y").alias("y"))
    count = rows.agg(F.sum("y").alias("toxic"), F.count("*").alias("n")).first()
    toxic, clean = count.toxic or 0, count.n - (count.toxic or 0)
    share = [min(1.0, size / 2 / max(n, 1)) for n in (clean, toxic)]
    rows = rows.filter(luck("toxic", "labelled") < F.when(F.col("y") == 1, share[1]).otherwise(share[0]))
    # About ``size`` ids: small enough for every task, so that no text is shuffled to find the sample.
    texts = docs.select("doc_id", "text").join(F.broadcast(rows), F.col("doc_id") == F.col("labelled"))
    return stored(texts.select("text", "y"), "sample")


def _keys(text: str | None) -> set[str]:
    """Words of a text, which end in $, and beginnings of its words."""
    keys = set()
    for word in set("".join(c if c.isalpha() else " " for c in (text or "").lower()).split()):
        if len(word) <= 24:
            keys.add(word + "$")
        keys.update(word[:n] for n in range(SHORTEST_STEM, min(len(word), LONGEST_STEM + 1)))
    return keys


def _reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and clean texts each key occurs."""
    found: dict[str, list[int]] = defaultdict(lambda: [0, 0])
    for batch in batches:
        for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for key in _keys(text):
                found[key][y] += 1
    yield pa.RecordBatch.from_pydict(
        {
            "key": pa.array(list(found), pa.string()),
            "clean": pa.array([n[0] for n in found.values()], pa.int64()),
            "toxic": pa.array([n[1] for n in found.values()], pa.int64()),
        }
    )


#: A key is kept from so many toxic texts to each clean one, half a text added to both, and where by chance alone, by
#: the share of toxic texts among all, it would come at most once in ``LUCK`` keys.
AGAINST, LUCK = 9, 10_000


def strong(clean: int, toxic: int) -> bool:
    return toxic + 0.5 >= AGAINST * (clean + 0.5)


def telling(clean: int, toxic: int, share: float) -> bool:
    """Whether a key with so many clean and toxic texts is kept."""
    if not strong(clean, toxic) or not 0 < share < 1 or toxic <= share * (clean + toxic):
        return False
    n = clean + toxic
    odds = toxic * np.log(toxic / (n * share)) + (clean * np.log(clean / (n * (1 - share))) if clean else 0.0)
    return bool(odds >= np.log(LUCK))


def mined(holders: dict[str, tuple[set[int], set[int]]]) -> tuple[list[str], list[str]]:
    """Terms and stems among keys that are telling, by the numbers of the clean and toxic texts that hold each.

    A beginning is a stem, and stands for all its continuations, where the
    texts that it adds to theirs are strong by themselves; else its
    continuations stay and it goes. No key is dropped for one beside it.
    """
    below: dict[str, tuple[set[int], set[int]]] = defaultdict(lambda: (set(), set()))
    for key, texts in holders.items():
        for n in range(SHORTEST_STEM, len(key)):
            if key[:n] in holders:
                for all_below, own in zip(below[key[:n]], texts, strict=True):
                    all_below |= own
    stems: set[str] = set()
    terms = []
    for key in sorted(holders, key=lambda k: (len(k), k)):
        if any(key[:n] in stems for n in range(SHORTEST_STEM, len(key))):
            continue
        if key.endswith("$"):
            terms.append(key[:-1])
        elif strong(*(len(own - rest) for own, rest in zip(holders[key], below[key], strict=True))):
            stems.add(key)
    return terms, sorted(stems)


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> bytes:
    """Lexicon and weights from the labelled training rows of ``labels``; needs doc_id, toxic."""
    rows = _sample(docs, labels, size)
    counts = rows.mapInArrow(_reach, "key string, clean long, toxic long").groupBy("key")
    counts = counts.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    share = rows.agg(F.avg("y")).first()[0] or 0.0
    # By the first summand alone, which is the larger one.
    chance = F.col("toxic") * (F.log("toxic") - F.log(F.col("clean") + F.col("toxic")) - float(np.log(share or 1.0)))
    likely = counts.filter(f"toxic + 0.5 >= {AGAINST} * (clean + 0.5)").filter(chance >= float(np.log(LUCK)) - 1e-6)
    kept = frozenset(row.key for row in likely.collect() if telling(row.clean, row.toxic, share))

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = pa.array([sorted(_keys(t) & kept) for t in batch.column(0).to_pylist()], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([keys, batch.column(1).cast(pa.int32())], ["keys", "y"])

    holders: dict[str, tuple[set[int], set[int]]] = defaultdict(lambda: (set(), set()))
    for number, row in enumerate(rows.mapInArrow(held, "keys array<string>, y int").collect()):
        for key in row.keys:
            holders[key][row.y].add(number)
    terms, stems = mined(holders)
    # Made once, as a worker would take seconds for each long lexicon.
    lexicon = Lexicon(sorted({*SEED_TERMS, *terms}), stems)
    made = pickle.dumps((lexicon, PRIOR))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = _model(made)[0]
        for batch in batches:
            found = hits(lexicon, [t or "" for t in batch.column(0).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.list_(pa.int64())), batch.column(1).cast(pa.int32())], ["found", "y"]
            )

    seen = rows.mapInArrow(count, "found array<long>, y int").collect()
    weights = PRIOR
    if seen:
        x = features(np.array([row.found for row in seen], np.int64))
        y = np.array([row.y for row in seen], float)
        weights = newton(x, y, PRIOR, STRENGTH)
    return pickle.dumps((lexicon, weights))


@lru_cache(maxsize=1)
def _model(made: bytes) -> tuple[Lexicon, np.ndarray]:
    return pickle.loads(made)


def score_toxicity(docs: DataFrame, model: bytes, threshold: float = THRESHOLD) -> DataFrame:
    """Score every whole text: doc_id, held_out, score (0 to 1), predicted and the counts of hits.

    One row per input row, repeated rows included. A null or empty text has no
    hits and the score of none; a null ``doc_id`` stays null and is not held
    out. Only the text enters the score; other columns are not looked at.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, weights = _model(model)
        for batch in tidy(batches):
            found = hits(lexicon, [t or "" for t in batch.column(2).to_pylist()])
            scores = sigmoid(features(found) @ weights)
            arrays = [batch.column(0).cast(pa.int64()), batch.column(1), pa.array(scores)]
            arrays.append(pa.array((scores >= threshold).astype(np.int32)))
            arrays += [pa.array(found[:, k]) for k in (1, 2, 3, 4)]
            yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in COLUMNS.split(", ")])

    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(score, COLUMNS)


COLUMNS = (
    "doc_id long, held_out boolean, score double, predicted int, n_terms long, n_misspelled long, n_stems long, n_quoted long"
)


def without_toxic(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """The documents that are not toxic, with all their columns; unlabelled data rejects by the fixed terms.

    Null and empty texts have no hits and stay, so do rows without an id where
    their text is clean; repeated rows are judged alike. An empty table stays
    empty. Columns may have any names and types.
    """
    model = fit(docs, labels, size)
    place = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, weights = _model(model)
        for batch in tidy(batches):
            found = hits(lexicon, [t or "" for t in batch.column(place).to_pylist()])
            yield batch.filter(pa.array(sigmoid(features(found) @ weights) < THRESHOLD))

    # Under plain names, as Spark looks columns up by them.
    plain = docs.toDF(*(f"c{k}" for k in range(len(docs.columns))))
    return plain.mapInArrow(keep, plain.schema).toDF(*docs.columns)
