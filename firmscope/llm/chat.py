"""Chat formatting of reply trees.

A tree's nodes know their parent. Iterative self-joins enumerate the paths from
the root to the leaves: in each round a node's ancestor is replaced by that
one's own, so that a path of any length is walked in as many rounds as its
length has bits, and a node knows how long its path is and what its scores add
up to. Branches are ranked by their mean score per turn; only the paths of the
chosen ones are written out, by the same joins from the longest step to the
shortest, and each is formatted as one conversation.

Texts take no part in that. They meet the chosen paths once and are joined to
parts of a bounded number of turns, so that a conversation of any length is no
group of one task.

The template marks each turn by ``<|im_start|>role`` and ``<|im_end|>``. Inside
roles and texts every ``<|`` gets a backslash in between, and ``<\\|`` one more,
so that no control string is left and every text can be read back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordered import number_rows
from ..shared import stored
from .words import tidy

BEGIN, END = "<|im_start|>", "<|im_end|>"
#: Whose texts are learned from.
LEARNED = "assistant"
#: Turns of a part.
TURNS = 64

DIGESTS = (
    "tree string, branch int, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def escaped_role(role: Column) -> Column:
    """A role on one line."""
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescaped(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def unescaped_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda found: "\n" if found[1] == "n" else found[1], unescaped(role))


# Paths


def _climbed(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(tree, node, length, total) of all nodes that a root is above, and each round's steps (tree, node, up).

    Round k steps over 2 ** k nodes. A round in which no path gets to its
    root leaves only nodes that lie on a circle or below one.
    """
    key = nodes.select(F.col("tree").alias("t"), F.col("node").alias("n"))
    same = (F.col("tree") == F.col("t")) & (F.col("parent") == F.col("n"))
    now = nodes.join(key, same, "left")
    now = stored(now.select("tree", "node", F.col("n").alias("up"), F.lit(1).cast("long").alias("length"), F.col("score").alias("total")), "steps")
    done, steps, left = now.filter("up is null"), [], now.filter("up is not null").count()
    while left:
        under = now.filter("up is not null")
        steps.append(under.select("tree", "node", "up"))
        above = done.union(under).select(
            F.col("tree").alias("t"), F.col("node").alias("n"), F.col("up").alias("next"), F.col("length").alias("more"), F.col("total").alias("added")
        )
        met = under.join(above, (F.col("tree") == F.col("t")) & (F.col("up") == F.col("n")))
        met = met.select("tree", "node", F.col("next").alias("up"), (F.col("length") + F.col("more")).alias("length"), (F.col("total") + F.col("added")).alias("total"))
        now = stored(met, "steps")
        done = done.union(now.filter("up is null"))
        before, left = left, now.filter("up is not null").count()
        if left == before:
            break
    return done.drop("up"), steps


def branches(nodes: DataFrame, most: int = 1) -> DataFrame:
    """(tree, branch, place, node, length) of the ``most`` best paths of each tree, branches from 0.

    ``nodes`` has tree, node, parent and score. A node without a parent in its
    tree is a root, a null score is 0. The best path has the highest mean
    score; of equals the longest, then that of the smallest leaf. Nodes on a
    circle or below one are on no path. A null tree or node has no path.
    """
    nodes = nodes.filter("tree is not null and node is not null")
    nodes = nodes.groupBy("tree", "node").agg(F.min("parent").alias("parent"), F.sum(F.coalesce("score", F.lit(0.0))).alias("score"))
    nodes = stored(nodes, "nodes")
    climbed, steps = _climbed(nodes)
    parents = nodes.filter("parent is not null").select(F.col("tree").alias("t"), F.col("parent").alias("p")).distinct()
    leaves = climbed.join(parents, (F.col("tree") == F.col("t")) & (F.col("node") == F.col("p")), "left_anti")
    ranked = Window.partitionBy("tree").orderBy((F.col("total") / F.col("length")).desc(), F.col("length").desc(), "node")
    chosen = leaves.withColumn("branch", F.row_number().over(ranked) - 1).filter(F.col("branch") < most)
    paths = stored(chosen.select("tree", "branch", "node", "length", (F.col("length") - 1).alias("place")), "leaves")
    for k in reversed(range(len(steps))):
        step = steps[k].select(F.col("tree").alias("t"), F.col("node").alias("n"), "up")
        met = paths.join(step, (F.col("tree") == F.col("t")) & (F.col("node") == F.col("n")), "left")
        here = F.struct("node", "place")
        above = F.struct(F.col("up").alias("node"), (F.col("place") - 2**k).alias("place"))
        both = F.when(F.col("up").isNull(), F.array(here)).otherwise(F.array(here, above))
        paths = met.select("tree", "branch", "length", F.explode(both).alias("at")).select("tree", "branch", "at.place", "at.node", "length")
    return paths.select("tree", "branch", "place", "node", "length")


# Format


def formatted(paths: DataFrame, contents: DataFrame, turns: int = TURNS) -> DataFrame:
    """(tree, branch, part, parts, text, loss): the paths as conversations in parts.

    ``paths`` as from ``branches`` with the ``content`` of each node, and
    ``contents`` with one row of role and text per tree and content; nulls are
    empty. A conversation is its parts in order, nothing between. ``loss``
    holds the begin and end of each learned text in its part, in code points.
    """
    c = contents.select(F.col("tree").alias("t"), F.col("content").alias("c"), "role", "text")
    rows = paths.join(c, (F.col("tree") == F.col("t")) & (F.col("content") == F.col("c")))
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(BEGIN), escaped_role(role), F.lit("\n"))
    turn = F.struct("place", head.alias("head"), escaped(text).alias("text"), (role == LEARNED).alias("learned"))
    part = F.floor(F.col("place") / turns).cast("long").alias("part")
    parts = F.ceil(F.col("length") / turns).cast("long").alias("parts")
    rows = rows.select("tree", "branch", part, parts, turn.alias("turn"))
    rows = rows.groupBy("tree", "branch", "part", "parts").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    tail = F.lit(f"{END}\n")
    sizes = F.transform("turns", lambda x: (F.length(x["head"]) + F.length(x["text"]) + F.length(tail)).cast("long"))
    rows = rows.withColumn("sizes", sizes)
    # The texts before a turn are at most those of its part.
    before = lambda k: F.aggregate(F.slice("sizes", 1, k), F.lit(0).cast("long"), lambda a, b: a + b)
    begins = F.transform("turns", lambda x, k: before(k) + F.length(x["head"]))
    spans = F.transform(
        F.filter(F.arrays_zip(F.col("turns").alias("turn"), begins.alias("begin")), lambda z: z["turn"]["learned"]),
        lambda z: F.struct(z["begin"].alias("begin"), (z["begin"] + F.length(z["turn"]["text"])).alias("end")),
    )
    text = F.array_join(F.transform("turns", lambda x: F.concat(x["head"], x["text"], tail)), "")
    return rows.select("tree", "branch", "part", "parts", text.alias("text"), spans.alias("loss"))


def format_trees(rows: DataFrame, most: int = 1, turns: int = TURNS) -> DataFrame:
    """The ``most`` best branches of each reply tree, formatted: rows as in ``formatted``.

    ``rows`` has tree, node, parent, role, text and score. Of rows that repeat
    a node the one that is smallest by a hash of role and text is its turn. An
    empty table gives none. Other columns are not looked at.
    """
    content = _content("role", "text")
    rows = rows.select("tree", "node", "parent", "score", "role", "text", content.alias("content"))
    paths = branches(rows, most)
    own = rows.groupBy(F.col("tree").alias("t"), F.col("node").alias("n")).agg(F.min("content").alias("content"))
    paths = paths.join(own, (F.col("tree") == F.col("t")) & (F.col("node") == F.col("n"))).drop("t", "n")
    return formatted(paths, _contents(rows), turns)


def _content(*columns: str) -> Column:
    """A name of 96 bits for a turn's role and text."""
    return F.concat_ws("/", F.hex(F.xxhash64(*columns)), F.hex(F.hash(*columns)))


def _contents(rows: DataFrame) -> DataFrame:
    """One row of role and text per tree and content."""
    return rows.groupBy("tree", "content").agg(F.first("role").alias("role"), F.first("text").alias("text"))


def threads(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, contents) of conversations whose turns each answer the one before.

    The tree is ``=`` and the conv_id, or empty for a null one. Turns stand by
    number, null first; equal ones by a hash of role and text. Rows that repeat
    are turns of their own. The order is that of one numbering of all turns, so
    that a conversation with very many turns is no group of one task.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    rows = conversations.select(tree.alias("tree"), "turn", _content("role", "text").alias("content"), "role", "text")
    numbered = stored(number_rows(rows.select("tree", "turn", "content"), "tree", "turn", "content"), "turns")
    before = numbered.select(F.col("tree").alias("t"), F.col("row_no").alias("parent"))
    met = numbered.join(before, (F.col("tree") == F.col("t")) & (F.col("row_no") == F.col("parent") + 1), "left")
    nodes = met.select("tree", F.col("row_no").alias("node"), "parent", F.lit(0.0).alias("score"), "content")
    return nodes, _contents(rows)


def format_conversations(conversations: DataFrame, turns: int = TURNS) -> DataFrame:
    """Each conversation formatted, from conv_id, turn, role and text: rows as in ``formatted``.

    The tree names the conv_id as in ``threads``. A null role or text is
    empty, an empty table gives no rows, other columns are not looked at.
    """
    nodes, contents = threads(conversations)
    nodes = stored(nodes, "threads")
    own = nodes.select(F.col("tree").alias("t"), F.col("node").alias("n"), "content")
    paths = branches(nodes).join(own, (F.col("tree") == F.col("t")) & (F.col("node") == F.col("n"))).drop("t", "n")
    return formatted(paths, contents, turns)


# Reading back


def turns_of(text: str) -> list[tuple[str, str]]:
    """Role and text of each turn of formatted text."""
    turns = []
    for turn in text.split(f"{END}\n")[:-1]:
        role, said = turn.removeprefix(BEGIN).split("\n", 1)
        turns.append((unescaped_role(role), unescaped(said)))
    return turns


class _Digest:
    """What is read back of one conversation, part by part."""

    def __init__(self, tree: str, branch: int) -> None:
        self.names = tree, branch
        self.turns = self.learned = self.size = 0
        self.said, self.loss = hashlib.sha256(), hashlib.sha256()

    def read(self, text: str, loss: list[dict]) -> None:
        turns = turns_of(text)
        self.turns += len(turns)
        self.size += len(text)
        for role, said in turns:
            self.said.update(f"{role}\n{said}\n".encode())
        for span in loss:
            learned = unescaped(text[span["begin"] : span["end"]])
            self.learned += len(learned)
            self.loss.update(learned.encode())

    def row(self) -> tuple:
        return *self.names, self.turns, self.said.hexdigest(), self.learned, self.loss.hexdigest(), self.size


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its parts, which stand in order."""
    names = [c.split()[0] for c in DIGESTS.split(", ")]
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    now: _Digest | None = None

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for batch in tidy(batches):
        rows = []
        trees, numbers = batch.column("tree").to_pylist(), batch.column("branch").to_pylist()
        for k, own in enumerate(zip(trees, numbers, strict=True)):
            if now is None or now.names != own:
                if now:
                    rows.append(now.row())
                now = _Digest(*own)
            now.read(batch.column("text")[k].as_py(), batch.column("loss")[k].as_py())
        yield out(rows)
    if now:
        yield out([now.row()])


def digests(parts: DataFrame) -> DataFrame:
    """What is read back of formatted conversations: turns, the texts under the loss mask, and their digests.

    Conversations of one part are read where they lie. A digest runs over all
    parts of a conversation in turn, so those of longer ones are sorted into
    one task, which holds one part at a time.
    """
    columns = ["tree", "branch", "text", "loss"]
    short = parts.filter("parts = 1").select(*columns).mapInArrow(_read_back, DIGESTS)
    long = parts.filter("parts > 1").repartition("tree", "branch").sortWithinPartitions("tree", "branch", "part")
    return short.union(long.select(*columns).mapInArrow(_read_back, DIGESTS))


def conversation_digests(conversations: DataFrame, turns: int = TURNS) -> DataFrame:
    """One row per conversation: conv_id and what is read back of its formatted text."""
    rows = digests(format_conversations(conversations, turns))
    conv_id = F.when(F.col("tree") != "", F.substring("tree", 2, 20).cast("long"))
    return rows.select(conv_id.alias("conv_id"), "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
