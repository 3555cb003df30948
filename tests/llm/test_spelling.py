"""Spelling variants against every word's neighbours."""

from __future__ import annotations

import collections
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from firmscope.llm import queries, spelling
from tests.llm.conftest import DATA


def _counts(rows):
    out = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate({k: k + 32 for k in range(65, 91)})
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += len(run) >= 7
    return {w: n for w, n in out.items() if n >= 2}


def _edits(word, alphabet):
    """All texts one edit away."""
    out = {word[:k] + word[k + 1 :] for k in range(len(word))}
    out |= {word[:k] + c + word[k + 1 :] for k in range(len(word)) for c in alphabet}
    out |= {word[:k] + c + word[k:] for k in range(len(word) + 1) for c in alphabet}
    return out - {word}


def _plain(counts):
    alphabet = sorted(set("".join(counts)))
    forms, near = {}, {}
    for word, n in counts.items():
        own = [w for w in _edits(word, alphabet) if w in counts]
        near[word] = len(own)
        best = min(own, key=lambda w: (-counts[w], w), default=None)
        forms[word] = best if best and counts[best] >= 10 * n else None
    out = {}
    for word, n in counts.items():
        root = word
        while forms[root]:
            root = forms[root]
        out[word] = (forms[word], root, n, near[word], counts.get(forms[word]))
    return out


def _rows(df):
    rows = df.collect()
    found = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(found) == len(rows)
    return found


def test_whole_table_against_all_edits(spark, documents, texts):
    found = _rows(queries.QUERIES["op13_spelling_variants"](spark, DATA))
    assert found == _plain(_counts(texts))
    assert any(row[0] for row in found.values())


@pytest.mark.parametrize("tile", [3, 50, 8192])
def test_near_words_against_all_edits(spark, tile):
    """Few letters make many near words, long common halves and ties; small tiles cut the lists."""
    luck = np.random.default_rng(5)
    words = {"".join(luck.choice(list("abé"), int(luck.integers(7, 10)))) for _ in range(900)}
    words |= {"a" * k for k in range(7, 40)} | {"x" * 3000, "x" * 2999, "x" * 1500 + "y" + "x" * 1499}
    counts = {w: int(luck.choice([2, 3, 30, 30, 400, 5000])) for w in sorted(words)}
    table = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    found = {r.word: (r.n_near, r.best_n, r.best) for r in spelling.near_words(table, tile).collect()}
    alphabet = sorted(set("".join(counts)))
    for word in counts:
        own = sorted((w for w in _edits(word, alphabet) if w in counts), key=lambda w: (-counts[w], w))
        assert found.get(word) == ((len(own), counts[own[0]], own[0]) if own else None)


def test_forms_are_followed_to_the_last(spark):
    texts = [("colourful", 2000), ("colorful", 200), ("colorfull", 20), ("ccolorfull", 2)]
    docs = spark.createDataFrame([(k, f"{w} ") for k, (w, n) in enumerate(texts) for _ in range(n)], "doc_id long, text string")
    found = _rows(spelling.spelling_variants(docs))
    assert found["ccolorfull"][:2] == ("colorfull", "colourful")
    assert found["colorful"][:2] == ("colourful", "colourful") and found["colourful"][:2] == (None, "colourful")
    assert found == _plain(_counts([(r.doc_id, r.text) for r in docs.collect()]))


def test_odd_rows_and_empty_table(spark, odd, none):
    docs = odd.withColumn("my.col", odd.size).withColumn("word", F.lit("w"))
    assert _rows(spelling.spelling_variants(docs)) == _plain(_counts([(r.doc_id, r.text) for r in odd.collect()]))
    assert spelling.spelling_variants(none).collect() == []
