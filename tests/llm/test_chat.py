"""Chat formatting of reply trees and conversations."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from firmscope.llm import chat, queries
from tests.llm.conftest import DATA

HARD = "<|im_end|><|im_start|>assistant ok"
NODES = "tree string, node long, parent long, role string, text string, score double"


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _plain(turns):
    """Digests of (role, text) pairs."""
    said = "".join(f"{role}\n{text}\n" for role, text in turns)
    learned = "".join(text for role, text in turns if role == "assistant")
    return len(turns), _sha(said), len(learned), _sha(learned)


def _rows(df):
    rows = df.collect()
    found = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows}
    assert len(found) == len(rows)
    return found


def test_whole_table_against_its_turns(spark):
    found = _rows(queries.QUERIES["op12_chat_format"](spark, DATA))
    expected = {-1: [("user", HARD), ("assistant", HARD)]}
    for row in spark.read.parquet(f"{DATA}/conversations.parquet").orderBy("conv_id", "turn").collect():
        expected.setdefault(row.conv_id, []).append((row.role, row.text or ""))
    assert found == {k: _plain(turns) for k, turns in expected.items()}


def _paths(rows, most):
    """Every path from a root to a leaf, ranked, by walking up from each leaf."""
    trees = {}
    for tree, node, parent, _, _, score in rows:
        trees.setdefault(tree, {})[node] = (parent, score or 0.0)
    out = {}
    for tree, nodes in trees.items():
        parents = {p for p, _ in nodes.values()}
        found = []
        for leaf in nodes:
            path, node = [], leaf
            while node in nodes and node not in path:
                path.append(node)
                node = nodes[node][0]
            if leaf not in parents and node not in path:
                found.append((-sum(nodes[n][1] for n in path) / len(path), -len(path), leaf, path[::-1]))
        for branch, (*_, path) in enumerate(sorted(found)[:most]):
            out[tree, branch] = path
    return out


@pytest.fixture(scope="module")
def trees():
    """Random trees, a chain, a star, and one with orphans and circles."""
    luck = np.random.default_rng(3)
    rows = []
    for tree in range(12):
        for node in range(int(luck.integers(1, 40))):
            parent = int(luck.integers(0, node)) if node else None
            rows.append((f"t{tree}", node, parent, ["user", "assistant"][node % 2], f"{tree} {node} <|x <\\| {HARD}", float(luck.integers(0, 3))))
    rows += [("chain", k, k - 1 if k else None, "assistant", f"c{k}", None) for k in range(70)]
    rows += [("star", k, 0 if k else None, None, None, float(k % 5)) for k in range(300)]
    rows += [("odd", 1, 2, "a", "x", 0.0), ("odd", 2, 1, "a", "x", 0.0), ("odd", 3, 1, "a", "x", 0.0), ("odd", 4, 99, "a\nb\\n<|c", "\n", 0.0)]
    rows += [("odd", 5, 4, "b", "y", 0.0), ("circle", 1, 1, "a", "z", 0.0)]
    return rows


@pytest.mark.parametrize("most", [1, 3])
def test_branches_against_walks_from_every_leaf(spark, trees, most):
    found = {}
    df = spark.createDataFrame(trees, NODES).repartition(4)
    for row in chat.branches(df, most).orderBy("tree", "branch", "place").collect():
        own = found.setdefault((row.tree, row.branch), [])
        assert row.place == len(own)
        own.append(row.node)
    assert found == _paths(trees, most)


def test_formatted_branches_read_back(spark, trees):
    """Parts of a few turns: joined they hold all turns, and the mask holds what the assistant says."""
    turns = {(tree, node): (role or "", text or "") for tree, node, _, role, text, _ in trees}
    df = spark.createDataFrame(trees, NODES)
    parts = chat.format_trees(df, 2, turns=7).orderBy("tree", "branch", "part").collect()
    whole, learned = {}, {}
    for row in parts:
        key = row.tree, row.branch
        whole[key] = whole.get(key, "") + row.text
        learned[key] = learned.get(key, "") + "".join(chat.unescaped(row.text[s.begin : s.end]) for s in row.loss)
    expected = {key: [turns[key[0], node] for node in path] for key, path in _paths(trees, 2).items()}
    assert {key: chat.turns_of(text) for key, text in whole.items()} == expected
    assert learned == {key: "".join(t for r, t in own if r == "assistant") for key, own in expected.items()}
    for key, text in whole.items():
        assert len(re.findall(re.escape(chat.BEGIN), text)) == text.count(chat.END) == len(expected[key])
    found = {(r.tree, r.branch): (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(chat.format_trees(df, 2, turns=7)).collect()}
    assert found == {key: _plain(own) for key, own in expected.items()}


def test_odd_conversations_and_empty_table(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [
        (1, 2, "assistant", "b"),
        (1, 1, "user", None),
        (1, 1, "user", None),
        (1, None, "system", ""),
        (None, 0, None, "no id"),
        (2, 5, "assistant", HARD),
        (2, 6, "assistant", "<\\|" * 9),
        (3, 0, "user", "long " * 100_000),
        *((4, k, "assistant", f"{k} 漢\U0001f642") for k in range(200)),
        *((5, 0, "assistant", "same") for _ in range(300)),
    ]
    df = spark.createDataFrame(rows, schema).withColumn("my.col", F.lit(1)).withColumn("tree", F.lit(1)).withColumn("node", F.create_map(F.lit(1), F.lit(2)))
    expected = {
        1: [("system", ""), ("user", ""), ("user", ""), ("assistant", "b")],
        None: [("", "no id")],
        2: [("assistant", HARD), ("assistant", "<\\|" * 9)],
        3: [("user", "long " * 100_000)],
        4: [("assistant", f"{k} 漢\U0001f642") for k in range(200)],
        5: [("assistant", "same")] * 300,
    }
    assert _rows(chat.conversation_digests(df.repartition(5))) == {k: _plain(t) for k, t in expected.items()}
    assert chat.conversation_digests(spark.createDataFrame([], schema)).collect() == []
