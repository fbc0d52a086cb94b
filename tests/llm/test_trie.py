"""Conversation prefix trie against a plain dictionary trie."""

import hashlib
import random
import zlib
from collections import defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from nextcat.llm import prefix_trie as T

CHATS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32], role, text))
    own = {c: [(r, t) for *_, r, t in sorted(ts)] for c, ts in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 4 for c in own}
    return {c: own.get(c - int(np.fmod(c, 20)), [])[:h[c]] + ts[h[c]:] for c, ts in own.items()}


def plain(convs):
    members = defaultdict(list)
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members[tuple(ts[:d])].append(c)
    kids = defaultdict(list)
    for path in members:
        if path:
            kids[path[:-1]].append(path)
    out = []
    for path, cs in members.items():
        below = [path]
        for p in below:
            below += kids[p]
        saved = sum((len(members[p]) - 1) * len(brute.words(p[-1][1])) for p in below if p)
        ends = ",".join(str(c) for c in sorted(cs) if len(convs[c]) == len(path))
        out.append((min(cs), len(path), min(members[path[:-1]]) if path else None, len(cs), len(kids[path]), sum(not kids[p] for p in below),
                    saved, brute.sha(ends)))
    return sorted(map(repr, out))


def nodes(df, conf=T.Trie()):
    return sorted(repr(tuple(r)) for r in T.prefix_trie(T.with_shared_heads(T.turn_sequences(df)), conf).select(*COLUMNS).collect())


def chats():
    r = random.Random(3)
    rows = []
    for c in [*range(0, 90), -41, -40, -7]:
        for turn in range(r.choice([1, 1, 2, 3, 4, 5])):
            rows.append((c, turn, r.choice(["user", "assistant"]), r.choice(["a", "a b", "c  d\te", ""])))
    rows += [(100 + i, t, "user", "same turn") for i in range(40) for t in range(3)]            # one conversation, many copies
    rows += [(200, t, "user", "w " * (t % 3)) for t in range(150)] + [(201, t, "user", "w " * (t % 3)) for t in range(149)]
    rows += [(301, None, None, None), (301, None, "user", "x"), (301, 4, "user", None), (None, 0, "user", "lost"), (302, 7, "ü", "é \U0001f600 b")]
    rows += [(303, 1, "user", "tie"), (303, 1, "user", "tie"), (303, 1, "assistant", "tie"), (304, 0, "user", "long " * 400_000)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("conf", [T.Trie(), T.Trie(shard=25, small_shard=25), T.Trie(shard=4, small_shard=4, shards=60)])
def test_trie_equals_plain(spark, conf):
    rows = chats()
    df = spark.createDataFrame(rows, CHATS).repartition(5)
    assert nodes(df, conf) == plain(rebuilt(rows))


def test_trie_edge_tables(spark):
    assert nodes(spark.createDataFrame([], CHATS)) == []
    bare = [(c, 0, "user", "t") for c in range(20, 29) if zlib.crc32(str(c).encode()) % 4 and c % 20]  # own first turns go, hosts are absent
    assert nodes(spark.createDataFrame(bare, CHATS), T.Trie(shard=2, small_shard=2)) == plain(rebuilt(bare)) == [
        repr((min(c for c, *_ in bare), 0, None, len(bare), 0, 1, 0, brute.sha(",".join(str(c) for c, *_ in bare))))]
    more = spark.createDataFrame(chats()[:60], CHATS).select("*", F.lit(1).alias("ids"), F.lit("x").alias("part"), F.lit(2).alias("Key"), F.lit(3).alias("turns"))
    assert nodes(more) == plain(rebuilt(chats()[:60]))


def test_shared_turns_over_blocks():
    r = random.Random(1)
    seqs = [[r.choice([1, 2]) for _ in range(r.choice([0, 1, 3]))] for _ in range(30)]
    seqs += [[1] * n for n in (31, 32, 33, 64, 65, 200)] + [[1] * 64 + [2], [1] * 32 + [3]] * 2
    rows = T.Rows(np.array([x for s in seqs for x in s], np.int64), np.array([*map(len, seqs)], np.int64))
    tie = np.array(r.sample(range(len(seqs)), len(seqs)))
    order = rows.order(tie)
    assert [(seqs[i], tie[i]) for i in order] == sorted((s, t) for s, t in zip(seqs, tie))
    want = [0] + [next((j for j, (x, y) in enumerate(zip(seqs[a], seqs[b])) if x != y), min(len(seqs[a]), len(seqs[b])))
                  for a, b in zip(order, order[1:])]
    assert rows.shared(order).tolist() == want
