"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints are made per text in Python tasks (word shingles, XXH64, majority
per bit).  Equal fingerprints collapse to one row first.  By the pigeonhole
rule, two 64-bit fingerprints within radius r that are cut into m blocks agree
in at least m - r blocks, so each fingerprint is filed under all C(m, r) choices
of m - r blocks and every linked pair meets in some bucket: no candidate is
lost, whatever the data.  Buckets above ``bucket_rows`` are dealt as pairs of
sub-blocks to separate tasks.

Within a task the bucket's fingerprints are stored as 64 vertical bit planes,
64 rows to a machine word.  The planes are compared with themselves moved by d
rows: carry-save counters add up the differing bits of 64 pairs at once, and
words whose pairs have all passed the radius are abandoned.  A task puts out a
spanning forest of its links, not its pairs, so no bucket's output exceeds its
rows.

Components: every node hooks to the smallest neighbour (in hashed order, so
long chains shrink fast) until no edge is left; all of it joins and aggregates
over tables written to the shared checkpoint folder, nothing at the driver.

Defined cases: a null or empty text, or one without words, has fingerprint 0
and is linked like any other; fewer words than a shingle: the whole sequence is
one shingle; a null id has a fingerprint but never names a component (a
component of null ids only has a null name); repeated rows give repeated
rows; an empty table gives no rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, fresh, importable, row_key

BITS = 64
#: Machine words compared at once: arrays of this length stay in a core's cache.
_LANES = 8192


@dataclass(frozen=True)
class SimHash:
    shingle: int = 4         # words
    radius: int = 4          # largest distance that links
    blocks: int = 6          # blocks the fingerprint is cut into; more: smaller buckets, more copies of each row
    bucket_rows: int = 4096  # larger buckets are dealt as pairs of sub-blocks
    seed: int = 42


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of one whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    h = xxhash.xxh64_intdigest
    hashes = [h(line[a:b], seed) for a, b in zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist())]
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[i:i + (1 << 16)], np.uint64).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, conf: SimHash = SimHash(), id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fp, key) per row; fp is the fingerprint's 64 bits as a signed long, key the row's id and text in 16 bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [fingerprint(t.as_py(), conf.shingle, conf.seed) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.array(made, np.uint64).view(np.int64)), b.column(2)],
                                             ["id", "fp", "key"])
    importable(docs.sparkSession)
    small = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).cast("string").alias("text"),
                        row_key(docs, id_col, text).alias("key"))
    return small.mapInArrow(run, "id long, fp long, key binary")


def masks(conf: SimHash) -> list[int]:
    """One mask per choice of blocks that a linked pair can agree on, as signed longs."""
    edges = [round(i * BITS / conf.blocks) for i in range(conf.blocks + 1)]
    block = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(conf.blocks)]
    every = [sum(block[i] for i in c) for c in combinations(range(conf.blocks), conf.blocks - conf.radius)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in every]


def _planes(values: np.ndarray) -> np.ndarray:
    """Vertical bit planes: word w of plane p holds bit p of rows 64 w to 64 w + 63; one spare word."""
    n = len(values)
    bits = np.unpackbits(values.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    rows = np.zeros((BITS, (n // 64 + 2) * 64), np.uint8)
    rows[:, :n] = bits.T
    return np.packbits(rows, axis=1, bitorder="little").view(np.uint64)


def close_pairs(values: np.ndarray, run: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of one run within the radius.  values: uint64, rows of a run
    adjacent; run: the run's number per row.  Yields arrays (first rows, second
    rows), some shifts at a time."""
    n = len(values)
    planes = _planes(values)
    words = planes.shape[1] - 1
    digits = radius.bit_length()
    live, d = np.arange(n), 0
    while True:
        parts, size = [], 0  # (words, their wanted lanes, shift), of several shifts to fill an array
        while size < _LANES and d + 1 < n:
            d += 1
            live = live[live + d < n]
            live = live[run[live] == run[live + d]]
            if not len(live):
                d = n
                break
            flags = np.zeros(words * 64, np.uint8)
            flags[live] = 1
            wanted = np.packbits(flags, bitorder="little").view(np.uint64)
            at = np.flatnonzero(wanted)
            parts.append((at, wanted[at], np.full(len(at), d)))
            size += len(at)
        if not parts:
            return
        at, wanted, shift = (np.concatenate(x) for x in zip(*parts))
        q, s = shift // 64, (shift % 64).astype(np.uint64)
        counter = [np.zeros(len(at), np.uint64) for _ in range(digits)]
        over = np.zeros(len(at), np.uint64)
        for p in range(BITS):
            # row r against row r + shift, for the 64 rows of a word; two steps, as a shift by 64 is not defined
            carry = planes[p][at] ^ ((planes[p][at + q] >> s) | (planes[p][at + q + 1] << (np.uint64(63) - s) << np.uint64(1)))
            for c in counter:  # carry-save: add one bit to 64 counters at once
                both = c & carry
                c ^= carry
                carry = both
            over |= carry
            if p % 8 == 7:
                alive = (wanted & ~(over | _above(counter, radius))) != 0
                if not alive.all():
                    at, wanted, shift, q, s, over = (x[alive] for x in (at, wanted, shift, q, s, over))
                    counter = [c[alive] for c in counter]
                    if not len(at):
                        break
        if len(at):
            good = wanted & ~(over | _above(counter, radius))
            w, lane = np.nonzero(np.unpackbits(good.view(np.uint8), bitorder="little").reshape(-1, 64))
            first = at[w] * 64 + lane
            yield first, first + shift[w]


def _above(counter: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter is above the radius: compare from the highest digit down."""
    more = np.zeros_like(counter[0])
    equal = ~more
    for i in reversed(range(len(counter))):
        if radius >> i & 1:
            equal = equal & counter[i]
        else:
            more = more | (equal & counter[i])
            equal = equal & ~counter[i]
    return more


def _forest(values: np.ndarray, run: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links, as (value, root's value)."""
    n = len(values)
    root = np.arange(n)
    for a, b in close_pairs(values, run, radius):
        while True:
            ra, rb = root[a], root[b]
            differ = ra != rb
            if not differ.any():
                break
            hi, lo = np.maximum(ra, rb)[differ], np.minimum(ra, rb)[differ]
            np.minimum.at(root, hi, lo)
            while True:  # every row straight to its root
                up = root[root]
                if (up == root).all():
                    break
                root = up
    child = np.flatnonzero(root != np.arange(n))
    return values[child], values[root[child]]


def links(fps: DataFrame, conf: SimHash = SimHash()) -> DataFrame:
    """(a, b): links between different fingerprints that connect whatever the
    radius connects.  ``fps``: one row per distinct fp."""
    if not 0 < conf.radius < conf.blocks <= BITS:
        raise ValueError("blocks must exceed the radius")
    filed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks(conf)])).alias("c", "key"))
    sizes = filed.groupBy("c", "key").agg(F.count("*").alias("n")).where("n > 1")
    large = sizes.where(F.col("n") > conf.bucket_rows).select("c", "key", F.ceil(F.col("n") / conf.bucket_rows).cast("int").alias("g"))
    own = filed.join(large, ["c", "key"], "left")
    # block b of g goes to the tasks (b, j) and (j, b) of every other block j
    b = F.pmod(F.xxhash64("fp"), F.col("g")).cast("int")
    tasks = F.when(F.col("g").isNull(), F.array(F.struct(F.lit(-1).alias("i"), F.lit(-1).alias("j")))).otherwise(
        F.transform(F.filter(F.sequence(F.lit(0), F.col("g") - 1), lambda j: j != b),
                    lambda j: F.struct(F.least(b, j).alias("i"), F.greatest(b, j).alias("j"))))
    dealt = own.select("c", "key", "fp", F.explode(tasks).alias("t")).select("c", "key", "t.i", "t.j", "fp")
    grouped = dealt.repartition("c", "key", "i", "j").sortWithinPartitions("c", "key", "i", "j", "fp")
    limit = 64 * conf.bucket_rows
    importable(fps.sparkSession)

    def flush(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        runs = np.concatenate([p[0] for p in parts])
        values = np.concatenate([p[1] for p in parts])
        pair = np.flatnonzero(runs[1:] == runs[:-1])
        member = np.zeros(len(runs), bool)
        member[pair] = member[pair + 1] = True
        if member.any():
            x, y = _forest(values[member], runs[member], conf.radius)
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        rows, number, last = 0, 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(4)])
            new = np.ones(batch.num_rows, bool)
            new[1:] = (cols[:, 1:] != cols[:, :-1]).any(axis=0)
            new[0] = last is None or (cols[:, 0] != last).any()
            runs = number + np.cumsum(new)
            number, last = runs[-1], cols[:, -1]
            values = batch.column(4).to_numpy().astype(np.int64).view(np.uint64)
            firsts = np.flatnonzero(new)
            if rows >= limit and len(firsts):  # whole runs only
                k = firsts[0]
                held.append((runs[:k], values[:k]))
                yield from flush(held)
                held, rows, runs, values = [], 0, runs[k:], values[k:]
            held.append((runs, values))
            rows += len(runs)
        if held:
            yield from flush(held)

    return grouped.mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge; all nodes of a component
    get the same root.  ``edges``: (a, b) of longs."""
    mixed = edges.select(F.xxhash64("a").alias("a"), F.xxhash64("b").alias("b"))  # a bijection on longs
    names = cut(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    labels = names.select("node", F.xxhash64("node").alias("root"))
    mixed = cut(mixed)
    while not mixed.isEmpty():
        both = mixed.unionByName(mixed.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = cut(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("to")))
        to = lambda name: hook.select(F.col("a").alias(name), F.col("to").alias(f"{name}_to"))
        labels = cut(labels.join(to("root"), "root", "left").select("node", F.coalesce("root_to", "root").alias("root")))
        mixed = cut(mixed.join(to("a"), "a").join(to("b"), "b").select(F.col("a_to").alias("a"), F.col("b_to").alias("b"))
                    .where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    return labels


def simhash_groups(docs: DataFrame, conf: SimHash = SimHash(), id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fp, key, root, component) per row of ``docs``; rows of one component
    share root and component, the smallest id reachable over links."""
    prints = cut(fingerprints(docs, conf, id_col, text))
    reps = cut(prints.groupBy("fp").agg(F.min("id").alias("least")))
    found = components(links(reps.select("fp"), conf))
    rooted = reps.join(found, reps.fp == found.node, "left").select("fp", "least", F.coalesce("root", F.xxhash64("fp")).alias("root"))
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component")), "root").select("fp", "root", "component")
    return prints.join(named, "fp").select("id", "fp", "key", "root", "component")


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_copies(docs: DataFrame, conf: SimHash = SimHash(), id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of every component, columns unchanged: the smallest id's (null
    last); of rows that repeat it, the one with the smallest key."""
    groups = simhash_groups(docs, conf, id_col, text)
    first = groups.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("first"))
    key, pick = fresh(docs, "_key", "_pick")
    own = docs.withColumn(key, row_key(docs, id_col, text))
    own = own.join(first.select(F.col("first.key").alias(key)), key, "left_semi")
    order = Window.partitionBy(key).orderBy(key)  # what is left are equal rows
    return own.withColumn(pick, F.row_number().over(order)).where(F.col(pick) == 1).select(*docs.columns)
