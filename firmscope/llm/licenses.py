"""License scans: matching statistics of texts against a suffix automaton.

All license templates and phrases are put, token by token, into one
generalised suffix automaton. A text is streamed through it: after each token
the automaton knows the longest suffix read so far that occurs in some
template (the matching statistic) and its state, whose suffix links tell the
same for each template by itself. Where a template's match cannot be carried
on it is maximal; maximal matches of at least ``MIN_MATCH`` tokens, with all
places where the template holds them, are chained per template by dynamic
programming: in order on both sides, foreign words between them cost
``GAP_COST`` each, and a chain goes on as long as it is worth more than its
gaps. The best chain's worth as a share of the template decides about its
label; one that names a version needs the version's word in the chain. A
template of which every fourth word is replaced has no match.

Tokens of which no template holds the pair with the next one have a statistic
of at most one, which neither a phrase nor a long match can use, so only runs
of known pairs are streamed.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .words import LOWER, tidy

# Phrases that give a base label.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Wording of common licenses, label and text.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0"),
    (
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
        "with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless "
        "required by applicable law or agreed to in writing software distributed under the license is distributed "
        "on an as is basis without warranties or conditions of any kind either express or implied see the license "
        "for the specific language governing permissions and limitations under the license",
    ),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
        "permit persons to whom the software is furnished to do so subject to the following conditions the above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "software the software is provided as is without warranty of any kind express or implied including but not "
        "limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    ),
    ("gpl-3.0", "licensed under the gnu general public license version 3"),
    ("gpl-2.0", "licensed under the gnu general public license version 2"),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
        "public license as published by the free software foundation either version 3 of the license or at your "
        "option any later version this program is distributed in the hope that it will be useful but without any "
        "warranty without even the implied warranty of merchantability or fitness for a particular purpose see the "
        "gnu general public license for more details",
    ),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("cc-by-4.0", "licensed under cc by 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that "
        "the following conditions are met redistributions of source code must retain the above copyright notice this "
        "list of conditions and the following disclaimer redistributions in binary form must reproduce the above "
        "copyright notice this list of conditions and the following disclaimer in the documentation and or other "
        "materials provided with the distribution",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
        "granted provided that the above copyright notice and this permission notice appear in all copies",
    ),
    (
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was "
        "not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    ),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)

MIN_MATCH = 4
#: What a foreign word in a chain costs, in covered words.
GAP_COST = 0.25
MIN_SHARE = 0.6
_VERSION = re.compile(r"-(\d+)\.\d+$")

#: Lower-case letters, digits and all that is not ASCII stay; A-Z are lowered.
TOKEN_BYTES = bytes(
    LOWER[b] if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)


def tokens(text: bytes) -> list[bytes]:
    return text.translate(TOKEN_BYTES).split()


class Automaton:
    """Generalised suffix automaton over the token ids of all sequences."""

    def __init__(self, sequences: list[list[int]]) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        #: For each state, the sequences that hold its strings and all end places in each.
        self.places: list[dict[int, set[int]]] = [{}]
        ends = []
        for number, sequence in enumerate(sequences):
            last = 0
            for place, token in enumerate(sequence):
                last = self._extend(last, token)
                ends.append((last, number, place + 1))
        for state, number, place in ends:
            self.places[state].setdefault(number, set()).add(place)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if (up := self.link[state]) > 0:
                for number, own in self.places[state].items():
                    self.places[up].setdefault(number, set()).update(own)

    def _new(self, length: int, follow: dict[int, int], link: int) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        self.places.append({})
        return len(self.next) - 1

    def _split(self, state: int, token: int, below: int) -> int:
        """The state of exactly ``state``'s strings plus token, cloned off if need be."""
        if self.length[below] == self.length[state] + 1:
            return below
        clone = self._new(self.length[state] + 1, dict(self.next[below]), self.link[below])
        self.link[below] = clone
        while state >= 0 and self.next[state].get(token) == below:
            self.next[state][token] = clone
            state = self.link[state]
        return clone

    def _extend(self, last: int, token: int) -> int:
        if token in self.next[last]:
            return self._split(last, token, self.next[last][token])
        state = self._new(self.length[last] + 1, {}, 0)
        while last >= 0 and token not in self.next[last]:
            self.next[last][token] = state
            last = self.link[last]
        if last >= 0:
            self.link[state] = self._split(last, token, self.next[last][token])
        return state

    def walk(self, sequence: list[int]) -> Iterator[tuple[int, int]]:
        """State and matching statistic after each token."""
        state = length = 0
        for token in sequence:
            while state and token not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if token in self.next[state]:
                state, length = self.next[state][token], length + 1
            yield state, length


class Scanner:
    """Finds phrases and covered templates in token lists."""

    def __init__(self, phrases: dict[str, str], templates: tuple[tuple[str, str], ...]) -> None:
        self.phrases = [tokens(p.encode()) for p in phrases]
        self.phrase_labels = list(phrases.values())
        self.templates = [tokens(text.encode()) for _, text in templates]
        self.template_labels = [label for label, _ in templates]
        every = self.phrases + self.templates
        self.ids = {word: k + 1 for k, word in enumerate(sorted({w for s in every for w in s}))}
        sequences = [[self.ids[w] for w in s] for s in every]
        self.automaton = Automaton(sequences)
        n = len(self.ids) + 1
        self.pairs, self.phrase_pairs = np.zeros((2, n, n), bool)
        for k, s in enumerate(sequences):
            for a, b in zip(s, s[1:], strict=False):
                self.pairs[a, b] = True
                self.phrase_pairs[a, b] |= k < len(self.phrases)
        # Phrases that end where a state's strings end, if the match is long enough.
        below: dict[int, list[tuple[int, int]]] = {}
        for k, s in enumerate(sequences[: len(self.phrases)]):
            *_, (state, length) = self.automaton.walk(s)
            below.setdefault(state, []).append((k, length))
        self.endings: list[list[tuple[int, int]]] = [[] for _ in self.automaton.next]
        # The longest match of each template that ends with a state's strings, and its places.
        self.reach: list[dict[int, tuple[int, tuple[int, ...]]]] = [{} for _ in self.automaton.next]
        self.versions = [self._version(label, words) for label, words in zip(self.template_labels, self.templates, strict=True)]
        for state in sorted(range(1, len(self.endings)), key=self.automaton.length.__getitem__):
            self.endings[state] = below.get(state, []) + self.endings[self.automaton.link[state]]
            size, up = self.automaton.length[state], self.automaton.link[state]
            own = {k - len(phrases): (size, tuple(sorted(ends))) for k, ends in self.automaton.places[state].items() if k >= len(phrases)}
            self.reach[state] = self.reach[up] | (own if size >= MIN_MATCH else {})

    @staticmethod
    def _version(label: str, words: list[bytes]) -> int | None:
        """The place of a label's main version number in its template."""
        found = _VERSION.search(label)
        return words.index(found[1].encode()) if found and found[1].encode() in words else None

    def runs(self, words: list[bytes]) -> Iterator[tuple[int, list[int]]]:
        """(first word, ids) of runs whose pairs all occur in a template and that can matter."""
        ids = np.fromiter((self.ids.get(w, 0) for w in words), np.int32, len(words))
        if len(ids) < 2 or np.count_nonzero(ids) < 2:
            return
        known = np.concatenate(([False], self.pairs[ids[:-1], ids[1:]], [False]))
        if not known.any():
            return
        edges = np.flatnonzero(known[1:] != known[:-1])
        phrase = np.concatenate(([0], np.cumsum(self.phrase_pairs[ids[:-1], ids[1:]])))
        for a, b in edges.reshape(-1, 2):
            if b - a + 1 >= MIN_MATCH or phrase[b] > phrase[a]:
                yield int(a), ids[a : b + 1].tolist()

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[tuple[int, int, int, float]]]:
        """(phrase, first word) of each place; (template, first word, word after the last, share) of each best chain."""
        places: list[tuple[int, int]] = []
        matches: dict[int, list[Match]] = {}
        for first, ids in self.runs(words):
            before: dict[int, tuple[int, tuple[int, ...]]] = {}
            for k, (state, length) in enumerate(self.automaton.walk(ids)):
                places += [(p, first + k + 1 - m) for p, m in self.endings[state] if length >= m]
                now = {t: (min(length, most), ends) for t, (most, ends) in self.reach[state].items() if length >= MIN_MATCH}
                self._close(matches, before, now, first + k)
                before = now
            self._close(matches, before, {}, first + len(ids))
        return places, [(t, *chain) for t in sorted(matches) if (chain := self.chain(t, matches[t]))]

    @staticmethod
    def _close(matches: dict[int, list[Match]], before: dict, now: dict, end: int) -> None:
        """Note the matches that end before word ``end``, as they are not carried on."""
        for template, (size, ends) in before.items():
            if now.get(template, (0,))[0] != size + 1:
                matches.setdefault(template, []).append(Match(end - size, end, ends))

    def chain(self, template: int, matches: list[Match]) -> tuple[int, int, float] | None:
        """(first word, word after the last, share) of the chain that is worth most; None if it lacks the version.

        Each match stands at one of its places. It begins a chain, or goes on
        with one that ends earlier on both sides, where words that overlap on
        either side count once. A chain is not worth more than its template
        has words, so it can only go on within as many words as those pay for.
        """
        size, version = len(self.templates[template]), self.versions[template]
        reach = size / GAP_COST
        ends: list[Link] = []
        first, best = 0, None
        for match in sorted(matches, key=lambda m: (m.end, m.begin)):
            n = match.end - match.begin
            while first < len(ends) and match.begin - ends[first].end > reach:
                first += 1
            new = []
            for place in match.places:
                holds = version is None or place - n <= version < place
                found = {holds: Link(match.begin, match.end, place, float(n), holds)}
                for link in ends[first:]:
                    gained = min(match.end - max(match.begin, link.end), place - max(place - n, link.place))
                    if gained <= 0 or link.end >= match.end:
                        continue
                    worth = link.worth + gained - GAP_COST * max(0, match.begin - link.end)
                    held = link.versioned or (version is not None and place - gained <= version < place)
                    if held not in found or worth > found[held].worth:
                        found[held] = Link(link.begin, match.end, place, worth, held)
                new += found.values()
            ends += new
            for link in new:
                if link.versioned and (best is None or link.worth > best.worth):
                    best = link
        return best and (best.begin, best.end, min(1.0, best.worth / size))


class Match(NamedTuple):
    """Words of a text that a template holds, and the places in the template where they end."""

    begin: int
    end: int
    places: tuple[int, ...]


class Link(NamedTuple):
    """The best chain that ends with a match at one place, and whether it holds the template's version."""

    begin: int
    end: int
    place: int
    worth: float
    versioned: bool


@lru_cache(maxsize=4)
def _scanner(made: bytes) -> Scanner:
    return Scanner(*pickle.loads(made))


COLUMNS = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, spans array<struct<label: string, start: long, stop: long, share: double>>"
)


def scan_licenses(
    docs: DataFrame,
    phrases: dict[str, str] = PHRASES,
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    min_share: float = MIN_SHARE,
) -> DataFrame:
    """Phrases, labels and covered template spans of every whole text.

    One row per input row, repeated rows included. A null or empty text has no
    words, null places, empty labels and score 0; a null ``doc_id`` stays null.
    Other columns of the input are not looked at. Labels of a template need
    ``min_share`` of it covered, gaps deducted; among equal chains the earlier
    is kept. A label with a version needs the version's word. The score is the largest share, 1 where a phrase stands.
    """
    made = pickle.dumps((phrases, templates))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(made)
        for batch in tidy(batches):
            rows = []
            for value in batch.column(1).cast(pa.binary()):
                found = tokens(value.as_py() or b"")
                places, chains = scanner.scan(found)
                starts = [start for _, start in places]
                base = {scanner.phrase_labels[p] for p, _ in places}
                spans = [
                    {"label": scanner.template_labels[t], "start": a, "stop": b, "share": share}
                    for t, a, b, share in chains
                    if share >= min_share
                ]
                rows.append(
                    {
                        "n_words": len(found),
                        "n_base": len(places),
                        "first_word": min(starts, default=None),
                        "last_word": max(starts, default=None),
                        "base_labels": ",".join(sorted(base)),
                        "labels": ",".join(sorted(base | {s["label"] for s in spans})),
                        "score": max([1.0 if base else 0.0, *(share for *_, share in chains)]),
                        "spans": spans,
                    }
                )
            yield _batch(batch.column(0), rows)

    return docs.select("doc_id", "text").mapInArrow(scan, COLUMNS)


_SPAN = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("share", pa.float64())]))
_TYPES = {
    "n_words": pa.int64(),
    "n_base": pa.int64(),
    "first_word": pa.int64(),
    "last_word": pa.int64(),
    "base_labels": pa.string(),
    "labels": pa.string(),
    "score": pa.float64(),
    "spans": _SPAN,
}


def _batch(ids: pa.Array, rows: list[dict]) -> pa.RecordBatch:
    columns = {"doc_id": ids.cast(pa.int64())}
    columns |= {name: pa.array([row[name] for row in rows], kind) for name, kind in _TYPES.items()}
    return pa.RecordBatch.from_pydict(columns)


def phrase_places(text: str, phrase: str) -> list[int]:
    """First words of a phrase's places, found by comparing at every word; for checks."""
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate({k: k + 32 for k in range(65, 91)}))
    wanted = phrase.split()
    return [k for k in range(len(found)) if found[k : k + len(wanted)] == wanted]
