"""The trie of conversation prefixes, read off a sorted order by range minima.

A turn is the md5 of its role and text, a conversation the row of its turns' digests. Sorted, all conversations that start
alike stand next to each other, and LCPs of neighbours say how far. A sparse table over the LCPs answers range minima; every
candidate prefix (row, depth) finds the left and the right end of its members by two binary searches of its own, without
a stack. Children, leaves and savings follow from the ends, since nodes ordered by (first row, depth) are in preorder.

Scale: texts end at the digests. Conversations are sorted by Spark into ranges of about ``part_turns`` turns, doc ids as the
last key, so a prefix or a whole conversation that a third of all rows share is spread over many ranges. A range judges all
nodes whose members it holds. Only prefixes of its first and last row can go on beyond it; of these it reports partial figures,
which Spark sums by node. What is left for one task are the nodes on two paths for each range. Member ids of such nodes
come as one text for each range and are hashed in order as a stream. The digests of one conversation (20 bytes a turn) have to fit a row.

Nulls: a null role or text is ''; a null turn comes first; rows without a ``conv_id`` belong to no conversation. Turns of
equal number follow by role, then by the text's digest. Repeated rows are turns of their own. ``c - c % 100`` keeps the sign
of c, as in SQL. An empty table has no nodes. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.session import Workspace

PART_TURNS = 200_000
DIGEST = 16
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
FIGURES = f"node binary, parent binary, size long, part int, ends string, {NODE}"
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _turns(conversations: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, turns (digest and code points in order)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    one = F.struct("turn", role.alias("role"), F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"), F.length(text).alias("size"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long"), one.alias("t"))
    ordered = F.transform(F.sort_array(F.collect_list("t")), lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size")))
    return rows.groupBy("conv_id").agg(ordered.alias("turns"))


def _first(turns: str, n: Column) -> Column:
    return F.slice(F.col(turns), F.lit(1), n)


def rebuilt(conversations: DataFrame, group: int = 100, heads: int = 6) -> DataFrame:
    """Rows (conv_id, digests, sizes): the first h turns of the group's first conversation, then the own ones after h; h below ``heads``."""
    own = _turns(conversations)
    base = own.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), _first("turns", F.lit(heads - 1)).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")
    rows = own.select("conv_id", "turns", (F.col("conv_id") - F.col("conv_id") % group).alias("base"), h.alias("h")).join(base, "base", "left")
    rest = F.slice(F.col("turns"), F.col("h") + 1, F.size("turns"))
    turns = F.concat(F.coalesce(_first("head", F.col("h")), _first("turns", F.lit(0))), rest)
    return rows.select("conv_id", turns.alias("turns")).select(
        "conv_id", F.unhex(F.array_join("turns.digest", "")).alias("digests"), F.col("turns.size").alias("sizes"))


def neighbour_lcps(digests: list[bytes], lengths: np.ndarray) -> np.ndarray:
    """Turns that each row shares with the one before; -1 for the first row."""
    lcp = np.zeros(len(digests), np.int64)
    words = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    row = np.arange(1, len(digests))
    most, depth = np.minimum(lengths[1:], lengths[:-1]), 0
    while len(row):
        row = row[most[row - 1] > depth]
        row = row[(words[starts[row] + depth] == words[starts[row - 1] + depth]).all(axis=1)]
        lcp[row] += 1
        depth += 1
    lcp[:1] = -1
    return lcp


class RangeMinimum:
    """Sparse table: level k holds the minimum of 2^k neighbours from each place on."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 ** len(self.levels) <= len(values):
            half, last = 2 ** (len(self.levels) - 1), self.levels[-1]
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Minimum over [low, high] for each pair."""
        k = np.frexp((high - low + 1).astype(float))[1] - 1
        out = np.empty(len(low), np.int64)
        for level in np.unique(k):
            at = k == level
            out[at] = np.minimum(self.levels[level][low[at]], self.levels[level][high[at] - 2**level + 1])
        return out

    def extents(self, row: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last row around each ``row`` between which no value is below ``depth``."""
        n, left, right = len(self.levels[0]), row.copy(), row.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            step, level = 2**k, self.levels[k]
            fits = right + step < n
            fits[fits] = level[right[fits] + 1] >= depth[fits]
            right[fits] += step
            fits = left - step >= 0
            fits[fits] = level[left[fits] - step + 1] >= depth[fits]
            left[fits] -= step
        return left, right


def range_nodes(ids: np.ndarray, digests: list[bytes], sizes: list[np.ndarray], part: int) -> pd.DataFrame:
    """All nodes of one sorted range, those that may go on in another range with their partial figures."""
    n = len(ids)
    lengths = np.array([len(s) for s in sizes], np.int64)
    lcp = neighbour_lcps(digests, lengths)
    table = RangeMinimum(lcp)
    # A node is the prefix at the first row that has it: depths beyond the LCP with the row before, the root at row 0.
    counts = lengths - np.maximum(lcp, -1)
    row = np.repeat(np.arange(n), counts)
    first_node = np.cumsum(counts) - counts
    depth = np.arange(len(row)) - np.repeat(first_node, counts) + np.repeat(lcp + 1, counts)
    left, right = table.extents(row, depth)
    # The parent's own first row is found by the same search one turn higher.
    up, _ = table.extents(row, depth - 1)
    parent = np.where(depth > 0, first_node[up] + (depth - 1) - (lcp[up] + 1), -1)
    members = right - left + 1
    smallest = RangeMinimum(ids).least(left, right)
    flat = np.concatenate([*sizes, np.zeros(0, np.int64)]).astype(np.int64)
    begin = np.cumsum(lengths) - lengths
    size = np.where(depth > 0, flat[np.minimum(begin[row] + depth - 1, max(len(flat) - 1, 0))] if len(flat) else 0, 0)
    # Members that end at a node stand first in it; of equal conversations the last differs from the row after it.
    differs = np.concatenate([(lcp[1:] < lengths[1:]) | (lengths[1:] != lengths[:-1]), [True]])
    group_end = np.flatnonzero(differs)[np.searchsorted(np.flatnonzero(differs), row)]
    is_open = (left == 0) | (right == n - 1)
    hangs = np.flatnonzero(parent >= 0)
    children = np.bincount(parent[hangs], minlength=len(row))
    closed_children = np.bincount(parent[hangs][~is_open[hangs]], minlength=len(row))
    last_node = first_node[right] + counts[right]  # one past the node's subtree in preorder
    leaves = np.concatenate([[0], np.cumsum(~is_open & (children == 0))])
    saved = np.concatenate([[0], np.cumsum(np.where(is_open, 0, (members - 1) * size))])
    at = np.arange(len(row))
    ends = [",".join(map(str, ids[a:b + 1])) if e else None for a, b, e in zip(left, group_end, lengths[row] == depth)]
    name = np.full(len(row) + 1, None, object)  # the last one stands for no parent
    for i in np.flatnonzero(is_open):
        name[i] = hashlib.md5(digests[row[i]][: DIGEST * depth[i]]).digest()
    inside = (parent >= 0) & ~is_open[parent]
    return pd.DataFrame({
        "node": name[:-1], "parent": name[parent], "size": size, "part": part, "ends": [e if o else None for e, o in zip(ends, is_open)],
        "conv_id": smallest, "depth": depth, "parent_conv_id": pd.Series(smallest[parent], dtype="Int64").where(inside),
        "n_convs": members, "n_children": np.where(is_open, closed_children, children), "n_leaves": leaves[last_node] - leaves[at], "saved_tokens": saved[last_node] - saved[at],
        "ends_sha256": [NO_ENDS if e is None else None if o else hashlib.sha256(e.encode()).hexdigest() for e, o in zip(ends, is_open)]})


def _ranges(sequences: DataFrame, part_turns: int, work: Workspace) -> DataFrame:
    """The nodes of every range of the sorted conversations."""
    kept = work.keep(sequences, "sequences")
    turns = kept.agg(F.coalesce(F.sum(F.size("sizes") + 1), F.lit(0))).first()[0]
    parts = max(1, -(-turns // part_turns))
    order = ["digests", "conv_id"]
    placed = kept.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    schema = _schema()

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            rows = pa.Table.from_batches(held).combine_chunks()
            column = rows["sizes"].chunk(0)
            cuts = column.offsets.to_numpy()
            flat = column.values.to_numpy()
            sizes = [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
            nodes = range_nodes(rows["conv_id"].to_numpy(), rows["digests"].to_pylist(), sizes, rows["part"][0].as_py())
            yield from pa.Table.from_pandas(nodes, schema, preserve_index=False).to_batches(max_chunksize=20_000)

    return placed.select("conv_id", "digests", "sizes", "part").mapInArrow(judge, FIGURES)


def _schema() -> pa.Schema:
    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    return pa.schema([(n, types[t]) for n, t in (f.split() for f in FIGURES.split(", "))])


def rolled_up(nodes: pd.DataFrame) -> pd.DataFrame:
    """Figures of the nodes that several ranges share, from their closed parts and from each other; the root's parent is missing."""
    place = {k: i for i, k in enumerate(nodes["node"])}
    parent = np.array([-1 if p is None else place[p] for p in nodes["parent"]], np.int64)
    children = nodes["n_children"].to_numpy(np.int64) + np.bincount(parent[parent >= 0], minlength=len(nodes))
    members, ids, depth = (nodes[c].to_numpy(np.int64) for c in ("n_convs", "conv_id", "depth"))
    # Closed nodes are counted by all their ancestors already; only what these nodes add themselves is passed up.
    leaves = (children == 0).astype(np.int64)
    saved = (members - 1) * nodes["size"].to_numpy(np.int64)
    for d in range(int(depth.max(initial=0)), 0, -1):
        at = np.flatnonzero(depth == d)
        np.add.at(leaves, parent[at], leaves[at])
        np.add.at(saved, parent[at], saved[at])
    leaves += nodes["n_leaves"].to_numpy(np.int64)
    saved += nodes["saved_tokens"].to_numpy(np.int64)
    above = pd.Series(ids[parent], dtype="Int64").where(parent >= 0)
    return pd.DataFrame({"node": nodes["node"], "conv_id": ids, "depth": depth, "parent_conv_id": above, "n_convs": members, "n_children": children, "n_leaves": leaves, "saved_tokens": saved})


def _ends(shared: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the nodes at which members end, whose ids come range by range in ascending order."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            done: list[tuple[bytes, str]] = []
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key == node:
                    digest.update(b",")
                else:
                    if node is not None:
                        done.append((node, digest.hexdigest()))
                    node, digest = key, hashlib.sha256()
                digest.update(ids.encode())
            yield _pairs(done)
        if node is not None:
            yield _pairs([(node, digest.hexdigest())])

    rows = shared.where(F.col("ends").isNotNull()).select("node", "ends", "part")
    return rows.repartition("node").sortWithinPartitions("node", "part").select("node", "ends").mapInArrow(stream, "node binary, ends_sha256 string")


def _pairs(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], ["node", "ends_sha256"])


def trie(sequences: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """One row per distinct prefix of the sequences (conv_id, digests, sizes), the empty one included.

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    work = Workspace(sequences.sparkSession)
    found = work.keep(_ranges(sequences, part_turns, work), "ranges")
    columns = [f.split()[0] for f in NODE.split(", ")]
    shared = found.where(F.col("node").isNotNull())
    merged = shared.groupBy("node").agg(
        F.max("parent").alias("parent"), F.max("size").alias("size"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    figures = "node binary, " + ", ".join(NODE.split(", ")[:-1])

    def roll(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = list(batches)
        if held:
            yield rolled_up(pd.concat(held, ignore_index=True))

    paths = merged.coalesce(1).mapInPandas(roll, figures)  # two paths for each range
    paths = work.keep(paths.join(_ends(shared), "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS))), "paths")
    closed = found.where(F.col("node").isNull())
    hung = closed.where(F.col("parent").isNotNull()).drop("parent_conv_id")
    hung = hung.join(paths.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id")), "parent")
    return closed.where(F.col("parent").isNull()).select(*columns).unionByName(hung.select(*columns)).unionByName(paths.select(*columns))


SQL = """
WITH tab AS (SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
own AS (SELECT conv_id, list({'r': coalesce(role, ''), 'x': coalesce(text, '')}
          ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS w
        FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT conv_id, w, (xor(list_reduce(list_prepend(4294967295, list_transform(range(strlen(conv_id::VARCHAR)), lambda p: ('0x' || substr(hex(encode(conv_id::VARCHAR)), 2 * p + 1, 2))::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 6)::BIGINT AS h FROM own, tab),
re AS (SELECT h.conv_id, list_concat(coalesce(b.w[1:h.h], []), h.w[h.h + 1:]) AS w FROM h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % 100),
px AS (SELECT conv_id, d, len(w) AS n, CASE WHEN d > 0 THEN length(w[d].x) ELSE 0 END AS size, md5(w[1:d]::VARCHAR) AS k, CASE WHEN d > 0 THEN md5(w[1:d - 1]::VARCHAR) END AS up
       FROM (SELECT *, unnest(range(0, len(w) + 1)) AS d FROM re)),
nd AS (SELECT d, k, any_value(up) AS up, min(conv_id) AS c, count(*) AS m, any_value(size) AS size,
              sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) AS ends FROM px GROUP BY d, k),
ch AS (SELECT d - 1 AS d, up AS k, count(*) AS kids FROM nd WHERE d > 0 GROUP BY ALL),
al AS (SELECT nd.*, coalesce(kids, 0) AS kids FROM nd LEFT JOIN ch USING (d, k)),
su AS (SELECT px.d, px.k, count(*) FILTER (WHERE kids = 0) AS leaves, sum((m - 1) * al.size) AS saved
       FROM al JOIN px ON px.conv_id = al.c AND px.d <= al.d GROUP BY ALL)
SELECT al.c AS conv_id, al.d AS depth, p.c AS parent_conv_id, al.m AS n_convs, al.kids AS n_children, leaves AS n_leaves, saved::BIGINT AS saved_tokens, al.ends AS ends_sha256
FROM al JOIN su USING (d, k) LEFT JOIN nd p ON p.d = al.d - 1 AND p.k = al.up
"""
