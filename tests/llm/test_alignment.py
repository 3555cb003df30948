"""Alignment of two tokenizers' tokens."""

from __future__ import annotations

import collections
import hashlib

import numpy as np
import pytest

from firmscope.llm import alignment, queries
from tests.llm.conftest import DATA


@pytest.fixture(scope="module")
def tools():
    import public_tokenizers as public
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    signs = {v: bytes([k]) for k, v in _signs().items()}
    return first, signs, sentencepiece.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))


def _signs():
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    out, n = {b: chr(b) for b in shown}, 0
    for b in range(256):
        if b not in out:
            out[b], n = chr(256 + n), n + 1
    return out


def _tokens(tools, text):
    first, signs, second = tools
    ids = first.encode(" " + text, add_special_tokens=False)
    a = [(k, b"".join(signs[c] for c in t)) for k, t in zip(ids.ids, ids.tokens, strict=True)]
    pieces = second.encode(text, out_type=str)
    b = []
    for k, piece in zip(second.encode(text), pieces, strict=True):
        b.append((k, bytes([int(piece[3:5], 16)]) if len(piece) == 6 and piece.startswith("<0x") else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if b"".join(t for _, t in a) == whole == b"".join(t for _, t in b) else None


def _groups(a, b):
    """Groups by walking both lists of tokens."""
    out, i, j, x, y, left, right = [], 0, 0, 0, 0, [], []
    while i < len(a) or j < len(b):
        if x <= y:
            left.append(a[i][0])
            x, i = x + len(a[i][1]), i + 1
        else:
            right.append(b[j][0])
            y, j = y + len(b[j][1]), j + 1
        if x == y:
            out.append((left, right))
            left, right = [], []
    return out


def _plain(tools, texts):
    """Each text's row, from all links in full."""
    groups = [_groups(*found) if text and (found := _tokens(tools, text)) else [] for text in texts]
    links = [[(x, y) for left, right in g for x in left for y in right] for g in groups]
    count = collections.Counter(pair for own in links for pair in set(own))
    best = collections.defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    rows = []
    for g, own in zip(groups, links, strict=True):
        listed = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in g)
        rows.append(
            (
                sum(len(left) for left, _ in g),
                sum(len(right) for _, right in g),
                len(g),
                len(own),
                sum(count[p] == best[p[0]] for p in own),
                sum(count[p] for p in own),
                hashlib.sha256(listed.encode()).hexdigest() if g else "",
            )
        )
    return rows, count


FIELDS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_whole_table_against_all_links(spark, texts, tools):
    found = {row.doc_id: row for row in queries.QUERIES["op11_token_alignment"](spark, DATA).collect()}
    expected, _ = _plain(tools, [text for _, text in texts])
    assert len(found) == len(texts)
    for (doc_id, _), row in zip(texts, expected, strict=True):
        assert tuple(found[doc_id][f] for f in FIELDS) == row


def test_many_blocks_and_levels(spark, texts, tools):
    """Blocks of a few texts, merged two at a time, count as one block does."""
    own = [text for _, text in texts[:60]] + [
        "",
        None,
        "<|endoftext|> <s> </s> <unk> <0x41>",
        "a▁b",
        "\n\n\t  x  y   z\r\n",
        "漢字かな交じり文 🙂🙃 é  　x",
        "a" * 5000 + "=" * 5000 + " " * 300,
        "nul \x00 inside",
        "ﬁ ① ﻿​½",
    ]
    own += own[:5]
    docs = spark.createDataFrame(list(enumerate(own)), "doc_id long, text string").repartition(3)
    expected, count = _plain(tools, own)
    rows = alignment.align_tokens(docs, block_bytes=2000, radixes=5, fan=2).collect()
    assert {r.doc_id: tuple(r[f] for f in FIELDS) for r in rows} == dict(enumerate(expected))
    listed = alignment.linked_ids(docs, block_bytes=2000, radixes=5, fan=2).collect()
    assert {(r.a, r.b): r["count"] for r in listed} == dict(count)
    most = collections.defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    assert all(r.is_best == (r["count"] == most[r.a]) for r in listed)


def test_merge_reads_frames_as_they_are_due(monkeypatch):
    monkeypatch.setattr(alignment, "FRAME", 3)
    luck = np.random.default_rng(0)
    for _ in range(30):
        runs, expected = [], collections.Counter()
        for _ in range(int(luck.integers(1, 6))):
            pairs = np.unique(luck.integers(0, 60, int(luck.integers(1, 40))))
            counts = luck.integers(1, 9, len(pairs))
            expected.update(dict(zip(pairs.tolist(), counts.tolist(), strict=True)))
            runs.append(alignment.spill(pairs, counts))
        merged = list(alignment.merge(runs))
        keys = np.concatenate([k for k, _ in merged])
        assert keys.tolist() == sorted(expected)
        assert np.concatenate([c for _, c in merged]).tolist() == [expected[k] for k in sorted(expected)]


def test_wide_groups_are_linked_by_distinct_ids(monkeypatch, tools):
    words = alignment.Vocabularies(alignment.public_pair())
    own = ["漢字かな交じり文 🙂🙃🙂🙃 text", "unbelievable antidisestablishmentarianism"]
    plain = alignment.align(own, words)
    monkeypatch.setattr(alignment, "WIDE", 1)
    for one, other in zip(plain, alignment.align(own, words), strict=True):
        assert np.array_equal(one, other)


def test_odd_rows_and_empty_table(spark, odd, none):
    docs = odd.withColumn("my.col", odd.size).withColumnsRenamed({"block": "radix", "row": "frames"})
    rows = alignment.align_tokens(docs).collect()
    assert len(rows) == odd.count() and sum(r.doc_id is None for r in rows) == 1
    zero = [r for r in rows if r.doc_id in (3, 4)]
    assert all(r.n_a == r.n_links == r.count_sum == 0 and r.groups_sha256 == "" for r in zero)
    twice = [r for r in rows if r.doc_id == 2]
    assert twice[0] == twice[1] and twice[0].count_sum > 3 * twice[0].n_groups
    assert alignment.align_tokens(none).collect() == []
    assert alignment.linked_ids(none).collect() == []
