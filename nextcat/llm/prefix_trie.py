"""Prefix trie of conversations: a node per distinct sequence of first turns.

Conversations become sequences of turn ids (16 bytes of a SHA-256 of role and
text) and are range-sharded by (sequence, conversation), so that the members of
a node lie side by side over neighbouring shards.  A shard sorts its padded
turn-id matrix with numpy's lexsort; masks of changed columns, accumulated by
OR from left to right, give for every row how many first turns it shares with
the row before.  Rows that share fewer than d turns with the row before start
the nodes of depth d, and reduceat sums the rows of every node, depth by depth.

A shard knows the last sequence before it and the first one after it.  All
aggregates of a node are sums over its rows of what a row adds to the sorted
row before it, so a node whose rows lie in several shards (a boundary node) is
put together by adding its shards' sums, whatever the depth of its subtree:

* children: rows that bring a new node of the next depth;
* leaves: rows that the row after does not continue or repeat;
* saved tokens: words of the turns, from the node's own on, that a row shares
  with the row before.

The conversations that end at a node are hashed as one text.  Those of a
boundary node are texts per shard, hashed one after another in shard order by a
task that holds one at a time (SHA-256 has no parallel form).

Defined cases: rows with a null conversation id take no part; null turns come
first, and equal turns are ordered by turn id; null role and text are empty; a
conversation without turns is a member of the root alone; rows that repeat are
turns that repeat; an empty table has no root and gives no rows; only the id,
turn, role and text columns are read.  A conversation's turn ids (24 bytes a
turn) stand in one row; the matrix is filled in blocks of columns, so that a
long conversation does not pad the others."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut, importable, text_of

#: Columns of the padded matrix that are filled at once.
BLOCK = 32


@dataclass(frozen=True)
class Trie:
    shard: int = 1 << 20       # turns and conversations of a shard, on average, of large tables
    small_shard: int = 1 << 15  # of smaller ones, as long as there are not
    shards: int = 512          # more shards than this


def turn_id(role: Column, text: Column) -> Column:
    """16 bytes, equal for equal role and text."""
    role, text = text_of(role), text_of(text)
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.unhex(F.substring(digest, 1, 32))


def turn_sequences(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id long, turns array<struct<id binary, words int>>), a row per conversation."""
    rows = turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.struct(
            F.col(turn).alias("turn"), turn_id(F.col(role), F.col(text)).alias("id"),
            F.regexp_count(text_of(text), F.lit(WORD)).cast("int").alias("words")).alias("t"))
    own = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return own.select("conv_id", F.transform("ts", lambda x: F.struct(x["id"].alias("id"), x["words"].alias("words"))).alias("turns"))


def with_shared_heads(sequences: DataFrame, every: int = 20, heads: int = 4) -> DataFrame:
    """Conversations that begin alike: the first h turns of conversation c come
    from conversation c - c % every (none where that is absent), the others are
    c's own after its first h; h = crc32(c in decimal) % heads."""
    own = cut(sequences)
    hosts = own.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("host"), F.slice("turns", 1, max(1, heads - 1)).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    joined = own.withColumn("h", h).withColumn("host", F.col("conv_id") - F.col("conv_id") % every).join(hosts, "host", "left")
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("h") + 1, F.size("turns"))
    return joined.select("conv_id", F.concat(head, rest).alias("turns"))


# ---------------------------------------------------------------- one shard

class Rows:
    """Sequences of turn codes one after another, with where each begins."""

    def __init__(self, codes: np.ndarray, sizes: np.ndarray):
        self.codes, self.sizes = codes, sizes
        self.starts = np.cumsum(sizes) - sizes

    def block(self, rows: np.ndarray, first: int) -> np.ndarray:
        """Padded matrix of the rows' columns from ``first`` on, -1 where a row has ended."""
        at = first + np.arange(BLOCK)
        there = at[None, :] < self.sizes[rows][:, None]
        out = np.full(there.shape, -1, np.int64)
        out[there] = self.codes[(self.starts[rows][:, None] + at[None, :])[there]]
        return out

    def order(self, tie: np.ndarray) -> np.ndarray:
        """Rows by (sequence, tie); a sequence comes before those that it begins.
        Blocks of columns are sorted from the last to the first, each stably."""
        order = np.argsort(tie, kind="stable")
        top = int(self.sizes.max(initial=0))
        for first in range((max(top - 1, 0) // BLOCK) * BLOCK, -1, -BLOCK):
            reach = self.sizes[order] > first
            live = order[reach]
            m = self.block(live, first)
            by = np.lexsort([m[:, j] for j in range(BLOCK - 1, -1, -1)])
            order = np.concatenate([order[~reach], live[by]])
        return order

    def shared(self, order: np.ndarray) -> np.ndarray:
        """First turns that each row shares with the one before it in ``order`` (0 for the first)."""
        out = np.zeros(len(order), np.int64)
        live, first = np.arange(1, len(order)), 0
        while len(live):
            a, b = self.block(order[live - 1], first), self.block(order[live], first)
            changed = np.logical_or.accumulate((a != b) | (a < 0), axis=1)
            out[live] += BLOCK - changed.sum(axis=1)
            live = live[~changed[:, -1]]
            first += BLOCK
        return out


def dense(raw: bytes) -> np.ndarray:
    """Codes of 16-byte ids, in the order of their bytes."""
    ids = np.frombuffer(raw, ">u8").reshape(-1, 2).astype(np.uint64)
    order = np.lexsort((ids[:, 1], ids[:, 0]))
    new = np.ones(len(ids), np.int64)
    if len(ids):
        new[1:] = (ids[order[1:]] != ids[order[:-1]]).any(axis=1)
    out = np.empty(len(ids), np.int64)
    out[order] = np.cumsum(new)
    return out


def path_keys(ids: list[bytes], depth: int) -> list[bytes]:
    """Digests of the first 0, 1, ... ``depth`` turns."""
    h, out = hashlib.sha256(), []
    for i in range(depth + 1):
        out.append(h.copy().digest()[:16])
        if i < depth:
            h.update(ids[i])
    return out


SHARD_ROWS = ("part int, key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
              "n_leaves long, saved_tokens long, turn_id binary, ends_sha256 string, ends string")
_ARROW = pa.schema([("part", pa.int32()), ("key", pa.binary()), ("parent_key", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()),
                    ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
                    ("saved_tokens", pa.int64()), ("turn_id", pa.binary()), ("ends_sha256", pa.string()), ("ends", pa.string())])


def shard_nodes(rows: pa.Table, near: pa.Table) -> pa.Table:
    """The nodes of a shard.  Those with rows in another shard have a key and
    ``ends`` (the text to hash) and are partial; children of these have a parent_key."""
    if not rows.num_rows:
        return _ARROW.empty_table()
    part = rows["part"][0].as_py()
    beside = near.to_pylist()[0] if near.num_rows else {"before": None, "after": None}
    before, after = beside["before"], beside["after"]
    ids = [x or [] for x in rows["ids"].to_pylist()]
    n = len(ids)
    flat = [x for s in ids for x in s]
    sizes = np.array([*map(len, ids), len(before or []), len(after or [])], np.int64)
    table = Rows(dense(b"".join([*flat, *(before or []), *(after or [])])), sizes)
    conv = rows["conv_id"].to_numpy()
    order = Rows(table.codes, sizes[:n]).order(conv)
    with_near = np.concatenate([[n] if before is not None else [], order, [n + 1] if after is not None else []]).astype(np.int64)
    both = table.shared(with_near)
    skip = int(before is not None)
    shared = both[skip:skip + n]                                   # with the row before, of any shard
    follows = np.concatenate([both[skip + 1:], [-1] if after is None else []])  # of the row after with this row
    low, high = (int(shared[0]) if before is not None else -1), (int(both[-1]) if after is not None else -1)
    inside = shared.copy()
    inside[0] = -1
    size, conv = sizes[:n][order], conv[order]
    words = np.concatenate([np.asarray(rows["words"].combine_chunks().flatten().to_numpy(zero_copy_only=False), np.int64), [0]])
    sums = np.cumsum(words) - words                                # words of all turns before one
    start = table.starts[:n][order]
    upto = sums[start + shared] - sums[start]                      # words of the shared turns
    leaf = (follows < size).astype(np.int64)
    first_ids, last_ids = ids[order[0]], ids[order[-1]]
    low_keys, high_keys = path_keys(first_ids, max(low, 0)), path_keys(last_ids, max(high, 0))
    out: dict[str, list] = {c: [] for c in _ARROW.names}
    node_of, parent_conv, parent_key = np.zeros(n, np.int64), [], []  # of the depth before: node of every row, and the nodes' columns
    live = np.arange(n)
    for depth in range(int(size.max(initial=0)) + 1):
        live = live[size[live] >= depth]
        begin = np.flatnonzero(inside[live] < depth)
        total = lambda x: np.add.reduceat(x, begin)
        count = np.diff(np.append(begin, len(live)))
        smallest = np.minimum.reduceat(conv[live], begin)
        ended = total((size[live] == depth).astype(np.int64))
        prior = sums[start[live] + depth - 1] - sums[start[live]] if depth else 0
        saved = total(np.maximum(upto[live] - prior, 0))
        children = total(((shared[live] <= depth) & (size[live] > depth)).astype(np.int64))
        keys: list[bytes | None] = [None] * len(begin)
        if depth <= low and live[0] == 0:
            keys[0] = low_keys[depth]
        if depth <= high and live[-1] == n - 1:
            keys[-1] = high_keys[depth]
        heads = live[begin]
        if depth:
            above = node_of[heads]
            above_conv = [None if parent_key[a] is not None else parent_conv[a] for a in above.tolist()]
            above_key = [parent_key[a] for a in above.tolist()]
        else:
            above_conv = above_key = [None] * len(begin)
        texts = [",".join(map(str, conv[live[b]:live[b] + e].tolist())) if e else "" for b, e in zip(begin.tolist(), ended.tolist())]
        out["part"] += [part] * len(begin)
        out["key"] += keys
        out["parent_key"] += above_key
        out["conv_id"] += smallest.tolist()
        out["depth"] += [depth] * len(begin)
        out["parent_conv_id"] += above_conv
        out["n_convs"] += count.tolist()
        out["n_children"] += children.tolist()
        out["n_leaves"] += total(leaf[live]).tolist()
        out["saved_tokens"] += saved.tolist()
        out["turn_id"] += [ids[order[h]][depth - 1] if depth else None for h in heads.tolist()]
        out["ends_sha256"] += [hashlib.sha256(t.encode()).hexdigest() if k is None else None for k, t in zip(keys, texts)]
        out["ends"] += [None if k is None else t for k, t in zip(keys, texts)]
        node_of[live] = np.repeat(np.arange(len(begin)), count)
        parent_conv, parent_key = smallest.tolist(), keys
    return pa.table({c: pa.array(v, _ARROW.field(c).type) for c, v in out.items()}, _ARROW)


# ---------------------------------------------------------------- all shards

def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, ends_sha256) from (key, ends) sorted by key and shard: one text at a time."""
    key, h, some = None, None, False
    put = lambda: pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([h.hexdigest()])], ["key", "ends_sha256"])
    for batch in batches:
        for k, text in zip(batch.column(0), batch.column(1)):
            k, text = k.as_py(), text.as_py()
            if k != key:
                if h is not None:
                    yield put()
                key, h, some = k, hashlib.sha256(), False
            if text:
                h.update((b"," if some else b"") + text.encode())
                some = True
    if h is not None:
        yield put()


def prefix_trie(sequences: DataFrame, conf: Trie = Trie()) -> DataFrame:
    """The trie of (conv_id, turns array<struct<id, words>>), conv_id unique: a
    row per node with conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256, turn_id (of its last turn)."""
    importable(sequences.sparkSession)
    flat = sequences.select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.words").alias("words"))
    cells = flat.agg(F.coalesce(F.sum(F.size("ids") + 1), F.lit(0))).first()[0]
    shards = max(1, -(-cells // conf.shard), min(conf.shards, -(-cells // conf.small_shard)))
    rows = cut(flat.repartitionByRange(shards, "ids", "conv_id").withColumn("part", F.spark_partition_id()))
    edges = cut(rows.groupBy("part").agg(F.min("ids").alias("first"), F.max("ids").alias("last")))
    numbers = edges.select("part", F.row_number().over(Window.orderBy("part")).alias("n"))  # a row per shard that has rows
    edges = edges.join(numbers, "part")
    near = (numbers.join(edges.select((F.col("n") + 1).alias("n"), F.col("last").alias("before")), "n", "left")
            .join(edges.select((F.col("n") - 1).alias("n"), F.col("first").alias("after")), "n", "left")
            .select(F.col("part").alias("shard"), "before", "after"))
    nodes = cut(rows.groupBy("part").cogroup(near.groupBy("shard")).applyInArrow(shard_nodes, SHARD_ROWS))
    partial = nodes.where(F.col("key").isNotNull())
    sums = partial.groupBy("key").agg(
        F.first("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("turn_id").alias("turn_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    ends = (partial.select("key", "part", "ends").repartition("key").sortWithinPartitions("key", "part").select("key", "ends")
            .mapInArrow(_hash_ends, "key binary, ends_sha256 string"))
    merged = cut(sums.join(ends, "key"))
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    # a shard's children of a boundary node meet their shard's copy of it: no key has more rows than a shard
    copies = (partial.select("part", "key").join(merged.select("key", "conv_id"), "key")
              .select("part", F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id")))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "turn_id"]
    whole = nodes.where(F.col("key").isNull())
    return (whole.where(F.col("parent_key").isNull()).select(*columns)
            .unionByName(whole.where(F.col("parent_key").isNotNull()).drop("parent_conv_id").join(copies, ["part", "parent_key"]).select(*columns))
            .unionByName(merged.join(parents, "parent_key", "left").select(*columns)))
