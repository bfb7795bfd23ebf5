r"""Chat formatting of reply trees (list item 6).

Messages are nodes with a parent.  Self-joins by pointer doubling give each
node its ancestors at 1, 2, 4, ... steps, so a tree of depth d needs log2(d)
joins, not d; the same tables then list every chosen leaf's path.  Leaves are
ranked in their tree by path score (sum of node scores; ties: smaller leaf
id), and every chosen path becomes one conversation, streamed turn by turn
from rows sorted by depth.

Template: ``<|role|>\n`` text ``<|end|>\n`` per turn.  Inside texts and roles
the backslash and the first sign of every control string are written as
``\\``, ``\l`` (<), ``\s`` ([), ``\p`` (|), so no control string of this or
the usual other templates survives verbatim and reading back is exact.  The
loss mask lists the code-point spans of the assistant texts.

Edge cases: null text or role is empty; a parent that does not exist makes
its child a root; null trees are one tree; a parent cycle raises ValueError;
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

TRAINED_ROLE = "assistant"
END = "<|end|>\n"
_CONTROL = re.compile(r"\\|<(?=\||/?s>|</?SYS>)|\[(?=/?INST\])|\|(?=>)")
_SHORT = {"\\": "\\\\", "<": "\\l", "[": "\\s", "|": "\\p"}
_LONG = {v[1]: k for k, v in _SHORT.items()}
FORMATTED = "tree bigint, leaf bigint, score double, n_turns bigint, formatted string, mask array<struct<start:bigint,end:bigint>>"


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: _SHORT[m[0]], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _LONG[m[1]], text, flags=re.S)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        head = formatted.index("|>\n", at)
        end = formatted.index(END, head + 3)
        turns.append((unescape(formatted[at + 2:head]), unescape(formatted[head + 3:end])))
        at = end + len(END)
    return turns


def jump_tables(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables (node, up) of the ancestors 1, 2, 4, ... steps up, and (node, depth, total) from the root to each node.

    A node leaves the rounds when its jump reaches the root, so a round joins only nodes deeper than the jump.
    """
    known = nodes.select(F.col("node").alias("parent"), F.lit(True).alias("__known"))
    first = nodes.select("node", "parent", F.col("score").alias("total"))
    # roots do not join: their null parents would all meet in one task
    child = first.filter("parent is not null").join(known, "parent", "left").select(
        "node", F.expr("if(__known, parent, null)").alias("up"), "total")
    root = first.filter("parent is null").select("node", F.col("parent").alias("up"), "total")
    live = written(child.unionByName(root).select("node", "up", F.lit(1).cast("bigint").alias("depth"), "total"), "jump")
    tables, reach, n, done = [], 1, None, None
    while True:
        ended = live.filter("up is null")
        done = ended if done is None else done.unionByName(ended)
        live = live.filter("up is not null")
        if live.isEmpty():
            return tables, done.select("node", "depth", "total")
        n = nodes.count() if n is None else n
        if reach > n:
            raise ValueError("the parents form a cycle")
        tables.append(live.select("node", "up"))
        above = done.unionByName(live).select(F.col("node").alias("up"), F.col("up").alias("__up"),
                                              F.col("depth").alias("__d"), F.col("total").alias("__t"))
        live = written(live.join(above, "up").select(
            "node", F.col("__up").alias("up"), (F.col("depth") + F.col("__d")).alias("depth"),
            (F.col("total") + F.col("__t")).alias("total")), "jump")
        reach *= 2


def chosen_paths(nodes: DataFrame, branches: int | None = 1) -> DataFrame:
    """leaf, node, score: the nodes of the best ``branches`` root-to-leaf paths of each tree (None: of all)."""
    tables, totals = jump_tables(nodes)
    parents = nodes.select(F.col("parent").alias("node")).filter("node is not null").distinct()
    leaves = nodes.select("tree", "node").join(parents, "node", "left_anti").join(totals, "node")
    if branches is not None:
        # Spark keeps only the first rows of each tree before the exchange (window group limit)
        best = Window.partitionBy("tree").orderBy(F.col("total").desc(), "node")
        leaves = leaves.withColumn("__rank", F.row_number().over(best)).filter(F.col("__rank") <= branches)
    paths = written(leaves.select(F.col("node").alias("leaf"), "node", F.col("total").alias("score")), "paths")
    for t in reversed(tables):  # the far ancestors first: the paths grow to their full size in the last round only
        up = paths.join(t, "node").select("leaf", F.col("up").alias("node"), "score")
        paths = written(paths.unionByName(up), "paths")
    return paths.join(totals.select("node", "depth"), "node")


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (leaf, depth): tree, leaf, score, role, text."""
    now, parts, mask, at, turns = None, [], [], 0, 0

    def done():
        return pa.RecordBatch.from_pylist(
            [{"tree": now[0], "leaf": now[1], "score": now[2], "n_turns": turns, "formatted": "".join(parts),
              "mask": [{"start": a, "end": b} for a, b in mask]}],
            schema=pa.schema([("tree", pa.int64()), ("leaf", pa.int64()), ("score", pa.float64()), ("n_turns", pa.int64()),
                              ("formatted", pa.string()), ("mask", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]))

    for b in batches:
        for tree, leaf, score, role, text in zip(*(c.to_pylist() for c in b.columns)):
            if now is None or leaf != now[1]:
                if now is not None:
                    yield done()
                now, parts, mask, at, turns = (tree, leaf, score), [], [], 0, 0
            head, body = f"<|{escape(role)}|>\n", escape(text)
            if role == TRAINED_ROLE:
                mask.append((at + len(head), at + len(head) + len(body)))
            parts += [head, body, END]
            at += len(head) + len(body) + len(END)
            turns += 1
    if now is not None:
        yield done()


def format_trees(nodes: DataFrame, branches: int | None = 1) -> DataFrame:
    """(tree, node, parent, role, text, score) -> one formatted conversation per chosen path, columns ``FORMATTED``."""
    cols = nodes.select("tree", "node", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = chosen_paths(nodes, branches).join(cols, "node")
    turns = turns.repartition("leaf").sortWithinPartitions("leaf", "depth").select("tree", "leaf", "score", "role", "text")
    return turns.mapInArrow(_format, FORMATTED)
