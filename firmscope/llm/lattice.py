"""Sums over all segmentations of words into pieces of a fixed vocabulary.

A word is written as a space (the vocabulary's word mark) and its UTF-8. The
pieces form a trie over bytes, kept as one table of next states, and the
forward recursion runs over many words at once, word place by word place.
Every byte is a piece of its own, so each word has a segmentation.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Most bytes of a piece.
LONGEST = 48
#: Words from so many bytes on are worked on one by one, in stretches of so many places.
SIDE_BY_SIDE, STRETCH = 2_048, 1 << 16
MARK = "▁"


class Pieces:
    """The pieces of a sentencepiece model as a trie."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        found: dict[bytes, int] = {}
        for k in range(model.get_piece_size()):
            if model.is_control(k) or model.is_unknown(k) or model.is_byte(k) or model.is_unused(k):
                continue
            piece = model.id_to_piece(k).replace(MARK, " ").encode()
            if len(piece) <= LONGEST and b"  " not in piece:
                found.setdefault(piece, k)
        for b in range(256):
            found.setdefault(bytes([b]), model.get_piece_size() + b)
        self.size = model.get_piece_size() + 256
        table = [np.full(256, -1, np.int32)]
        piece_of = [-1]
        for piece, k in found.items():
            state = 0
            for b in piece:
                if table[state][b] < 0:
                    table[state][b] = len(table)
                    table.append(np.full(256, -1, np.int32))
                    piece_of.append(-1)
                state = table[state][b]
            piece_of[state] = k
        self.table, self.piece_of = np.stack(table), np.array(piece_of, np.int32)
        self.texts = {k: piece for piece, k in found.items()}


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def letters(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all words end to end, each behind its mark; where each word begins, and its length."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    data = np.frombuffer(b"".join(b" " + w for w in words), np.uint8)
    return data, np.cumsum(lengths) - lengths, lengths


def longest_pieces(vocabulary: Pieces, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(word, piece) for each piece of the words' greedy segmentations, longest piece first."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    data, begins, lengths = letters(words)
    at, ends = begins.copy(), begins + lengths
    who, what = [], []
    live = np.arange(len(words))
    while len(live):
        state = np.zeros(len(live), np.int32)
        best, stop = np.full(len(live), -1, np.int32), at[live].copy()
        walking = np.arange(len(live))
        step = 0
        while len(walking):
            place = at[live[walking]] + step
            inside = place < ends[live[walking]]
            walking, place = walking[inside], place[inside]
            state[walking] = vocabulary.table[state[walking], data[place]]
            alive = state[walking] >= 0
            walking = walking[alive]
            found = vocabulary.piece_of[state[walking]]
            hit = found >= 0
            best[walking[hit]] = found[hit]
            stop[walking[hit]] = at[live[walking[hit]]] + step + 1
            step += 1
        who.append(live)
        what.append(best)
        at[live] = stop
        live = live[at[live] < ends[live]]
    return np.concatenate(who), np.concatenate(what)


def log_marginals(vocabulary: Pieces, words: list[bytes], log_scores: np.ndarray) -> np.ndarray:
    """Natural log of the summed probability of all segmentations of each word.

    ``log_scores``: one row per piece and one column per model. Returns one
    row per word. Words are never cut: the last ``LONGEST`` forward values are
    carried along, as no piece reaches further back.
    """
    out = np.zeros((len(words), log_scores.shape[1]))
    short = [k for k, word in enumerate(words) if len(word) < SIDE_BY_SIDE]
    if short:
        out[short] = _side_by_side(vocabulary, [words[k] for k in short], log_scores)
    for k, word in enumerate(words):
        if len(word) >= SIDE_BY_SIDE:
            out[k] = _along(vocabulary, word, log_scores)
    return out


def _side_by_side(vocabulary: Pieces, words: list[bytes], log_scores: np.ndarray) -> np.ndarray:
    """Marginals of many words, place by place; a place's values stand where those of ``LONGEST`` + 1 before it stood."""
    models = log_scores.shape[1]
    out = np.zeros((len(words), models))
    data, begins, sizes = letters(words)
    order = np.argsort(-sizes, kind="stable")
    begins, sizes = begins[order], sizes[order]
    width = int(sizes[0])
    ring = LONGEST + 1
    forward = np.full((ring, len(words), models), -np.inf)
    forward[0] = 0.0
    # How many words have at least so many bytes.
    long_enough = np.searchsorted(-sizes, -np.arange(width + 2), "right")
    for i in range(width + 1):
        more, all_here = long_enough[i + 1], long_enough[i]
        out[order[more:all_here]] = forward[i % ring, more:all_here]
        here = forward[i % ring, :more].copy()
        forward[i % ring, :all_here] = -np.inf
        walking, state = np.arange(more), np.zeros(more, np.int32)
        for j in range(i, width):
            on = walking < long_enough[j + 1]
            walking, state = walking[on], state[on]
            state = vocabulary.table[state, data[begins[walking] + j]]
            alive = state >= 0
            walking, state = walking[alive], state[alive]
            if not len(walking):
                break
            piece = vocabulary.piece_of[state]
            hit = piece >= 0
            at, to = walking[hit], (j + 1) % ring
            forward[to, at] = np.logaddexp(forward[to, at], here[at] + log_scores[piece[hit]])
    return out


def _along(vocabulary: Pieces, word: bytes, log_scores: np.ndarray) -> np.ndarray:
    """Marginal of one very long word: the pieces of a stretch of places are found at once, then summed in order."""
    data = np.frombuffer(b" " + word, np.uint8)
    ring = LONGEST + 1
    forward = np.full((ring, log_scores.shape[1]), -np.inf)
    forward[0] = 0.0
    for first in range(0, len(data), STRETCH):
        # Pieces that end behind one of these places.
        last = min(first + STRETCH, len(data))
        begin = np.arange(max(0, first - LONGEST + 1), last)
        at, state = begin, np.zeros(len(begin), np.int32)
        stops, lengths, found = [], [], []
        for length in range(1, LONGEST + 1):
            on = at + length <= last
            at, state = at[on], vocabulary.table[state[on], data[at[on] + length - 1]]
            at, state = at[state >= 0], state[state >= 0]
            if not len(at):
                break
            piece = vocabulary.piece_of[state]
            hit = (piece >= 0) & (at + length > first)
            stops.append(at[hit] + length)
            lengths.append(np.full(len(stops[-1]), length))
            found.append(piece[hit])
        stop = np.concatenate(stops)
        order = np.argsort(stop, kind="stable")
        source = ((stop - np.concatenate(lengths)) % ring)[order]
        scores = log_scores[np.concatenate(found)[order]]
        bounds = np.searchsorted(stop[order], np.arange(first + 1, last + 2)).tolist()
        for k, to in enumerate(range(first + 1, last + 1)):
            a, b = bounds[k], bounds[k + 1]
            forward[to % ring] = np.logaddexp.reduce(forward[source[a:b]] + scores[a:b], axis=0)
    return forward[len(data) % ring]
