"""Prefix trie of conversations from sorted, padded matrices of turn ids.

A turn's id is a 128-bit digest of its role and text; a conversation is the row of its
ids. Rows are dealt to range shards by ids and conversation, so a conversation that
occurs in a third of all rows is split like any other. A task orders its shard by
lexsort over bands of padded columns and takes it in runs of rows whose padded matrix
is bounded. In a run, OR-accumulated masks of the columns that change from row to row
mark where nodes start; reduceat aggregates members, children, leaves and savings of
all nodes of a depth, from the deepest up.

Only nodes on the first or the last row's path can go on beyond a run or a shard. They
stay open on a stack of the current path, and those on a shard's own edges, about two
paths a shard, are recombined in shard order. That last step streams: it holds one path
and a running hash for each of its nodes.

Defined results: rows without ``conv_id`` belong to no conversation; a NULL turn comes
first, rows of one turn go by the digest of role and text, equal rows stay separate
turns; NULL role or text count as empty; other columns are ignored; an empty table has
no nodes; the remainder of a negative id is negative, as in SQL. A conversation's turn ids (16 bytes each) and word counts are held by a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import SPACE, arrow_schema, written

SHARD_TURNS = 500_000  # turns a range shard, about
CELLS = 1_000_000  # of a padded matrix, unless a single conversation has more

PIECES = (
    "kind string, shard int, ref bigint, conv_id bigint, depth bigint, parent_ref bigint, "
    "parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends_sha256 string, right boolean, words bigint, turn binary, ends binary"
)
RESULT = (
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
    "ends_sha256",
)


def conversations_by_id(turns: DataFrame) -> DataFrame:
    """``conv_id, ids, words``: each conversation's turn ids (hex, joined) and word counts."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    one = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.struct(
            F.col("turn").isNotNull().alias("numbered"), F.col("turn").alias("turn"),
            F.substring(F.sha2(F.concat(
                F.length(role).cast("string"), F.lit(":"), role, text
            ), 256), 1, 32).alias("id"),
            F.regexp_count(text, F.lit(f"[^{SPACE}]+")).alias("words"),
        ).alias("t"),
    )
    return one.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t")).select(
        "conv_id", F.array_join("t.id", "").alias("ids"), F.col("t.words").alias("words")
    )


def with_shared_starts(convs: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """Conversations whose first turns are those of the first of their group of ids.

    ``h``, the check sum of the id modulo ``most``, says how many are replaced.
    """
    heads = convs.where(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("base"),
        F.substring("ids", 1, 32 * (most - 1)).alias("head_ids"),
        F.slice("words", 1, most - 1).alias("head_words"),
    )
    h = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    none = F.array().cast("array<int>")
    return (
        convs.withColumns({"h": h, "base": F.col("conv_id") - F.col("conv_id") % group})
        .join(heads, "base", "left")
        .select(
            "conv_id",
            F.concat(
                F.coalesce(F.substring("head_ids", F.lit(1), F.col("h") * 32), F.lit("")),
                F.substring("ids", F.col("h") * 32 + 1, F.length("ids")),
            ).alias("ids"),
            F.concat(
                F.coalesce(F.slice("head_words", F.lit(1), F.col("h")), none),
                F.slice("words", F.col("h") + 1, F.size("words")),
            ).alias("words"),
        )
    )


def row_order(ids: list[bytes], convs, cells: int):
    """The rows by turn ids, then conversation: lexsort over bands of padded columns.

    Rows that agree over a whole band are ordered by the next one; a band is as wide as
    ``cells`` allow for the rows it holds.
    """
    import numpy as np

    convs = np.asarray(convs)
    lengths = np.array([len(i) // 16 for i in ids], dtype=np.int64)

    def ordered(rows, at):
        width = int(max(1, min(cells // len(rows), lengths[rows].max() - at)))
        part = [ids[r][16 * at:16 * (at + width)] for r in rows]
        table = np.frombuffer(
            b"".join(p.ljust(16 * width, b"\0") for p in part), dtype=">u8"
        ).reshape(len(rows), 2 * width).astype(np.uint64)
        held = np.minimum(lengths[rows] - at, width)
        # A row that ends comes before the rows that go on.
        by = np.lexsort((convs[rows], held, *table.T[::-1]))
        rows, table, held = rows[by], table[by], held[by]
        same = np.all(table[1:] == table[:-1], axis=1) & (held[1:] == width) & (held[:-1] == width)
        more = lengths[rows] > at + width
        bounds = np.flatnonzero(np.concatenate([[True], ~same, [True]]))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b - a > 1 and more[a:b].any():
                rows[a:b] = ordered(rows[a:b], at + width)
        return rows

    return ordered(np.arange(len(ids)), 0) if ids else np.arange(0)


class _Node:
    """A node that may go on in rows still to come."""

    __slots__ = (
        "aliases", "children", "conv", "ends", "first", "leaves", "n", "ref", "saved", "turn",
        "words",
    )

    def __init__(self, turn, n, conv, words, children, leaves, saved, ends):
        self.turn, self.n, self.conv, self.words = turn, n, conv, words
        self.children, self.leaves, self.saved, self.ends = children, leaves, saved, ends
        self.ref, self.first, self.aliases = None, False, []

    def grow(self, other: _Node) -> None:
        self.n += other.n
        self.conv = min(self.conv, other.conv)
        self.children += other.children
        self.leaves += other.leaves
        self.saved += other.saved
        self.ends.extend(other.ends)
        self.aliases += other.aliases


class _Running:
    """Hash of conversation ids as a comma-joined list; they come in ascending runs."""

    def __init__(self, runs=()):
        from hashlib import sha256

        self.made, self.mark = sha256(), ""
        self.extend(runs)

    def extend(self, runs) -> None:
        for run in runs:
            if len(run):
                self.made.update((self.mark + ",".join(map(str, run))).encode())
                self.mark = ","

    def hexdigest(self) -> str:
        return self.made.hexdigest()


class Spine:
    """The path of open nodes, from the root to the last row seen.

    ``open_edge``: rows may come before the first one, so nodes on its path stay open.
    ``put`` takes finished nodes as rows of ``PIECES``.
    """

    def __init__(self, shard: int, open_edge: bool, put: Callable[[dict], None]):
        self.shard, self.open_edge, self.put = shard, open_edge, put
        self.stack: list[_Node] = []
        self.left: list[tuple[int, _Node]] = []
        self.refs = 0

    def enter(self, left: list[_Node], right: list[_Node], shared: int) -> None:
        """Names the open nodes of the next rows: ``left`` is the first row's path from the
        root, ``right`` the last row's beyond the ``shared`` turns."""
        self.common = 0
        if self.stack:
            pairs = zip(self.stack[1:], left[1:], strict=False)
            self.common = 1 + next(
                (i for i, (a, b) in enumerate(pairs) if a.turn != b.turn),
                min(len(self.stack), len(left)) - 1,
            )
        for depth, node in enumerate(left):
            if depth < self.common:
                node.ref = self.stack[depth].ref
            else:
                node.ref, node.first = self._new(), self.open_edge and not self.stack
        for node in right:
            node.ref = self._new()

    def merge(self, left: list[_Node], right: list[_Node], shared: int) -> None:
        self._close(self.common)
        for depth, node in enumerate(left):
            if depth < self.common:
                self.stack[depth].grow(node)
            else:
                self.stack.append(node)
        if right:
            self._close(shared + 1)
            self.stack += right

    def finish(self) -> None:
        if not self.open_edge:
            self._close(0)
            return
        import numpy as np

        edges = [(False, d, n) for d, n in self.left]
        edges += [(not n.first, d, n) for d, n in enumerate(self.stack)]
        for is_right, depth, node in edges:
            ends = np.concatenate([np.zeros(0, dtype="<i8"), *node.ends]).astype("<i8")
            self.put({
                "kind": "part", "shard": self.shard, "ref": node.ref, "conv_id": node.conv,
                "depth": depth, "n_convs": node.n, "n_children": node.children,
                "n_leaves": node.leaves, "saved_tokens": node.saved, "right": is_right,
                "words": node.words, "turn": node.turn, "ends": ends.tobytes(),
            })

    def _new(self) -> int:
        self.refs += 1
        return self.refs

    def _close(self, depth: int) -> None:
        """Finishes the nodes from ``depth`` down."""
        while len(self.stack) > depth:
            node, at = self.stack.pop(), len(self.stack)
            if node.first:
                self.left.append((at, node))
                continue
            leaves = node.leaves if node.children else 1
            saved = node.saved + (node.n - 1) * node.words
            parent = self.stack[-1] if self.stack else None
            if parent:
                parent.children += 1
                parent.leaves += leaves
                parent.saved += saved
            ends = node.ends
            self.put({
                "kind": "node", "shard": self.shard, "ref": node.ref, "conv_id": node.conv,
                "depth": at, "parent_ref": parent and parent.ref, "n_convs": node.n,
                "n_children": node.children, "n_leaves": leaves, "saved_tokens": saved,
                "ends_sha256": (ends if isinstance(ends, _Running) else _Running(ends)).hexdigest(),
            })
            for shard, ref in node.aliases:
                self.put({"kind": "alias", "shard": shard, "ref": ref, "conv_id": node.conv})


def _run(spine: Spine, convs, ids: list[bytes], words: list) -> None:
    """All nodes of a run of ordered rows; those that may go on are left with the spine."""
    import numpy as np

    n = len(ids)
    lengths = np.array([len(i) // 16 for i in ids], dtype=np.int64)
    depth = int(lengths.max())
    table = np.frombuffer(
        b"".join(i.ljust(16 * depth, b"\0") for i in ids), dtype=">u8"
    ).reshape(n, depth, 2)
    cost = np.zeros((n, depth), dtype=np.int64)
    for row, counts in enumerate(words):
        cost[row, :len(counts)] = counts
    changed = np.ones((n, depth), dtype=bool)
    present = np.arange(depth) < lengths[:, None]
    changed[1:] = np.any(table[1:] != table[:-1], axis=2) | (present[1:] != present[:-1])
    starts_node = np.logical_or.accumulate(changed, axis=1)

    start = [np.zeros(1, dtype=np.int64)]
    start += [np.flatnonzero(starts_node[:, d]) for d in range(depth)]
    members = [np.diff(np.append(s, n)) for s in start]
    least = [np.minimum.reduceat(convs, s) for s in start]
    ending = [np.add.reduceat(lengths == d, s) for d, s in enumerate(start)]
    shared = 0
    while shared < depth and len(start[shared + 1]) == 1 and lengths[0] > shared:
        shared += 1

    def node(d, g, children, leaves, saved):
        s = start[d][g]
        return _Node(
            ids[s][16 * d - 16:16 * d] if d else b"", int(members[d][g]), int(least[d][g]),
            int(cost[s, d - 1]) if d else 0, children, leaves, saved,
            [convs[s:s + ending[d][g]]],
        )

    left = [node(d, 0, 0, 0, 0) for d in range(lengths[0] + 1)]
    right = [node(d, -1, 0, 0, 0) for d in range(shared + 1, lengths[-1] + 1)]
    spine.enter(left, right, shared)

    # Of the finished nodes one depth further down, at the rows where they start.
    children, leaves, saved = (np.zeros(n, dtype=np.int64) for _ in range(3))
    for d in range(depth, -1, -1):
        s = start[d]
        sums = [np.add.reduceat(x, s) for x in (children, leaves, saved)]
        whole = lengths[s] >= d
        if d <= lengths[0]:
            whole[0] = False
            left[d].children, left[d].leaves, left[d].saved = (int(x[0]) for x in sums)
        if shared < d <= lengths[-1]:
            whole[-1] = False
            open_node = right[d - shared - 1]
            open_node.children, open_node.leaves, open_node.saved = (int(x[-1]) for x in sums)
        for x in (children, leaves, saved):
            x[:] = 0
        g = np.flatnonzero(whole)
        if not len(g):
            continue
        at = s[g]
        children[at] = 1
        leaves[at] = np.where(sums[0][g] == 0, 1, sums[1][g])
        saved[at] = sums[2][g] + (members[d][g] - 1) * cost[at, d - 1]
        up = np.searchsorted(start[d - 1], at, side="right") - 1
        of_first = (up == 0) & (lengths[0] >= d - 1)
        of_last = (up == len(start[d - 1]) - 1) & (shared < d - 1 <= lengths[-1])
        for i, a, first, last, p in zip(g, at, of_first, of_last, up, strict=True):
            open_parent = left[d - 1].ref if first else right[d - 2 - shared].ref if last else None
            spine.put({
                "kind": "node", "shard": spine.shard, "conv_id": int(least[d][i]), "depth": d,
                "parent_ref": open_parent,
                "parent_conv_id": None if open_parent else int(least[d - 1][p]),
                "n_convs": int(members[d][i]), "n_children": int(sums[0][i]),
                "n_leaves": int(leaves[a]), "saved_tokens": int(saved[a]),
                "ends_sha256": _Running([convs[a:a + ending[d][i]]]).hexdigest(),
            })
    spine.merge(left, right, shared)


def _rows_out(target: pa.Schema, rows: list[dict], least: int = 0) -> Iterator[pa.RecordBatch]:
    """The rows gathered so far as batches, once there are enough."""
    if len(rows) > least:
        yield pa.RecordBatch.from_pylist(rows, schema=target)
        rows.clear()


def shard_pieces(convs: DataFrame, cells: int = CELLS) -> DataFrame:
    """Finished nodes and open edges of each shard; ``convs`` is dealt by range."""
    target = arrow_schema(PIECES)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        shard, ids, conv_ids, words = 0, [], [], []
        for batch in batches:
            for at, conv, i, w in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                shard = at
                ids.append(bytes(i))
                conv_ids.append(conv)
                words.append(np.array(w, dtype="<i4"))
        rows: list[dict] = []
        spine = Spine(shard, True, rows.append)
        order = row_order(ids, np.array(conv_ids, dtype=np.int64), cells)
        begin, longest = 0, 0
        for end in range(len(order) + 1):
            size = len(ids[order[end]]) // 16 if end < len(order) else 0
            if end == len(order) or (end - begin + 1) * max(longest, size) > cells:
                run = order[begin:end]
                if len(run):
                    _run(
                        spine, np.array([conv_ids[r] for r in run], dtype=np.int64),
                        [ids[r] for r in run], [words[r] for r in run],
                    )
                    yield from _rows_out(target, rows, 10_000)
                begin, longest = end, 0
            longest = max(longest, size)
        if len(order):
            spine.finish()
        yield from _rows_out(target, rows)

    return convs.mapInArrow(work, PIECES)


def recombined(parts: DataFrame) -> DataFrame:
    """The nodes that the shards' edges make together."""
    target = arrow_schema(PIECES)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        rows: list[dict] = []
        spine = Spine(-1, False, rows.append)
        paths: dict[bool, list[tuple[int, _Node]]] = {False: [], True: []}
        shard = None

        def take() -> None:
            left, right = ([made for _, made in paths[side]] for side in (False, True))
            shared = paths[True][0][0] - 1 if right else len(left) - 1
            spine.enter(left, right, shared)
            for made in left[spine.common:] + right:
                made.ends = _Running(made.ends)
            spine.merge(left, right, shared)

        for batch in batches:
            for part in batch.to_pylist():
                if shard is not None and part["shard"] != shard:
                    take()
                    paths = {False: [], True: []}
                    yield from _rows_out(target, rows, 10_000)
                shard = part["shard"]
                made = _Node(
                    part["turn"], part["n_convs"], part["conv_id"], part["words"],
                    part["n_children"], part["n_leaves"], part["saved_tokens"],
                    [np.frombuffer(part["ends"], dtype="<i8")],
                )
                made.aliases.append((part["shard"], part["ref"]))
                paths[part["right"]].append((part["depth"], made))
        if shard is not None:
            take()
            spine.finish()
        yield from _rows_out(target, rows)

    ordered = parts.repartition(1).sortWithinPartitions("shard", "right", "depth")
    return ordered.mapInArrow(work, PIECES)


def trie(convs: DataFrame, shard_turns: int = SHARD_TURNS, cells: int = CELLS) -> DataFrame:
    """One row per node of the trie of ``conv_id, ids, words``; see ``RESULT``."""
    spark = convs.sparkSession
    stored = written(convs.withColumn("ids", F.unhex("ids")), "convs")
    turns = stored.agg(F.sum(F.size("words"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // shard_turns))
    dealt = stored.repartitionByRange(shards, "ids", "conv_id").select(
        F.spark_partition_id().alias("shard"), "conv_id", "ids", "words"
    )
    pieces = written(shard_pieces(dealt, cells), "trie-shards")
    edges = written(recombined(pieces.where("kind = 'part'")), "trie-edges")
    both = pieces.where("kind <> 'part'").union(edges)
    names = both.where("ref IS NOT NULL").selectExpr(
        "shard", "ref AS parent_ref", "conv_id AS named"
    )
    nodes = both.where("kind = 'node'")
    resolved = nodes.where("parent_ref IS NULL").select(*RESULT)
    rest = nodes.where("parent_ref IS NOT NULL").join(names, ["shard", "parent_ref"])
    return resolved.union(rest.withColumn("parent_conv_id", F.col("named")).select(*RESULT))


def prefix_nodes(turns: DataFrame) -> DataFrame:
    """The trie of the table's conversations with shared starts."""
    return trie(with_shared_starts(written(conversations_by_id(turns), "conversations")))
