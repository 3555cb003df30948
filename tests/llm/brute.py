"""Plain versions of the operators' results, one document after the other."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import numpy as np

SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def spaced(text: str | None) -> list[str]:
    return SPACED.findall(text or "")


def lowered(text: str | None) -> str:
    return (text or "").translate({k: k + 32 for k in range(65, 91)})


def crc(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode())


def quality(text: str | None) -> tuple[int, ...]:
    found, lines = spaced(text), (text or "").split("\n")
    seen, dup = set(), 0
    for line in lines:
        dup += line in seen and bool(spaced(line))
        seen.add(line)
    windows = [tuple(found[k : k + 5]) for k in range(len(found) - 4)]
    often = collections.Counter(windows)
    repeated = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(5)}
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(repeated)


def substring(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int, str]]:
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        found = spaced(text)
        gone = [False] * len(found)
        for k in range(len(found) - 19):
            window = tuple(found[k : k + 20])
            if window in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(window)
        kept = " ".join(w for w, x in zip(found, gone, strict=True) if not x)
        out[doc_id] = len(found), sum(gone), hashlib.sha256(kept.encode()).hexdigest()
    return out


def word_model(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int, int, float]]:
    tokens = {i: [*spaced(lowered(t)), None] for i, t in rows}
    count = collections.Counter(w for i, ws in tokens.items() if crc(i) % 7 != 2 for w in ws)
    n, v = sum(count.values()), len(count)
    return {
        i: (len(ws), sum(count[w] > 0 for w in ws), n, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws))
        for i, ws in tokens.items()
    }


def fingerprint(text: str | None) -> int:
    from xxhash import xxh64_intdigest

    found = spaced(lowered(text))
    shingles = [" ".join(found[k : k + 3]) for k in range(max(1, len(found) - 2))] if found else []
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(ids: list[int], linked: np.ndarray) -> dict[int, int]:
    """Smallest id reachable, by repeated smallest neighbours."""
    least = np.array(ids)
    while True:
        new = np.array([least[row | (np.arange(len(ids)) == k)].min() for k, row in enumerate(linked)])
        if (new == least).all():
            return dict(zip(ids, least.tolist(), strict=True))
        least = new


def targets(sizes: dict[str | None, int], weights=(3, 1, 2), share=1.5, most=2) -> dict[str | None, float]:
    """Targets by sharing what capped sources leave, round by round."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > most * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        for s in over:
            out[s] = float(most * sizes[s])
            left -= out[s]
        free -= over
    return out


def sainte_lague(votes: list[int], seats: int) -> list[int]:
    out = [0] * len(votes)
    for _ in range(seats if sum(votes) else 0):
        out[max(range(len(votes)), key=lambda k: (votes[k] / (2 * out[k] + 1), -k))] += 1
    return out
