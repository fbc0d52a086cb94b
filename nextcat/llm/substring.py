"""Exact substring dedup with a count-min prefilter.

A window is ``window`` consecutive words of one document.  Each window has an
anchor, its leftmost word group of ``gram`` words with the smallest hash; equal
windows have equal anchors at equal offsets, so an anchor starts at least as
often as any window that it stands for, and neighbouring windows share one.

1. Every partition counts its anchors in a sketch of ``depth`` rows of ``width``
   cells, kept sparse and saturating at two; the sketches are merged by cell
   range.  The smallest cell overestimates a window's count.
2. Windows whose anchor is estimated to repeat are put out, one row per run of
   windows with a common anchor, and grouped exactly: equal runs first (copies
   match run by run), then window by window where an anchor has several
   different runs: in one row where these are few, by a shuffle of windows where
   they are many.  A run put out without cause counts 1 and drops out.
3. Documents are joined with their covered spans.

None is lost: the sketch only overestimates.  Its rows grow with the texts, so
that it passes few windows without cause at any size.  Up to ``most`` cells a row
the merged sketch is broadcast (``depth * most / 8`` bytes, 128 MB, is the bound).
Wider ones stay where they are merged: the cells lie in shards, an anchor has its
cells of all rows in one shard, and the anchors of every partition, each once,
meet their shard by shuffle.  Documents are then joined with those of their
anchors that passed.  Both ways put out all windows that repeat, and the exact
grouping decides alike.  Windows are equal if two independent 64-bit hashes (of
anchor and window) are.

Defined cases: a null or empty text has no words and stays empty; documents
shorter than a window lose nothing; equal rows are separate documents, so all
their windows repeat; overlapping equal windows inside one document (periodic
text) repeat as well."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, cut, fresh, importable, row_key

#: Words whose windows are hashed together.
CHUNK = 1 << 18
#: Cells of a sketch row that are merged together.
SHARD = 1 << 20
#: Least cells of a row that is sized by the texts, and most of one that is broadcast: two are 128 MB in every task.
LEAST, MOST = 1 << 27, 1 << 29
#: Shards of a wider sketch; beyond 2^36 cells a row a shard's row holds more than SHARD.
SHARDS = 1 << 16
#: Anchors whose rows are spread over SALTS keys: any other one has under 1 / HOT of all.
HOT, SALTS = 1 << 12, 64
#: Anchors that a task holds before it deals them.
HELD = 1 << 21
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64


@dataclass(frozen=True)
class Substrings:
    window: int = 35
    gram: int = 8
    width: int | None = None  # cells of a sketch row, a multiple of SHARD; by the size of the texts if not set
    most: int = MOST      # cells of a row that may be broadcast
    depth: int = 2
    kinds: int = 512      # anchors with more different runs are counted by shuffled windows


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    out[:1] = 1
    return np.cumprod(out, dtype=_U)


def _split(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()  # bytes: ASCII white space only


def runs_of(docs: list[list[bytes]], conf: Substrings) -> tuple[np.ndarray, ...]:
    """Runs of windows with a common anchor: (document's number, first window,
    windows, anchor) and, concatenated, all window hashes."""
    sizes = np.fromiter(map(len, docs), np.int64, len(docs))
    h = xxhash.xxh3_64_intdigest
    words = np.fromiter((h(w) for d in docs for w in d), _U, int(sizes.sum()))
    n, w, g = len(words), conf.window, conf.gram
    ends = np.repeat(np.cumsum(sizes), sizes)
    at = np.flatnonzero(np.arange(n) + w <= ends)
    if not len(at):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, _U),) * 2
    total = np.zeros(n + 1, _U)
    np.cumsum(words * _powers(_BASE, n), dtype=_U, out=total[1:])
    back = _powers(pow(_BASE, -1, 1 << 64), n)
    grams = _mixed((total[g:] - total[:-g]) * back[:n - g + 1])
    windows = _mixed((total[w:] - total[:-w]) * back[:n - w + 1] + _U(w))
    # leftmost smallest gram of every window, by doubling the stretch that is covered
    low, where, covered, wanted = grams, np.arange(len(grams)), 1, w - g + 1
    while covered < wanted:
        step = min(covered, wanted - covered)
        first, second = low[:-step], low[step:]
        right = second < first
        where = np.where(right, where[step:], where[:-step])
        low = np.where(right, second, first)
        covered += step
    where, low = where[at], low[at]
    doc = np.repeat(np.arange(len(docs)), sizes)[at]
    new = np.ones(len(at), bool)
    new[1:] = (where[1:] != where[:-1]) | (doc[1:] != doc[:-1])
    start = np.flatnonzero(new)
    length = np.diff(np.append(start, len(at)))
    first = at[start] - (np.cumsum(sizes) - sizes)[doc[start]]
    return doc[start], first, length, low[start], windows[at]


def _cells(anchor: np.ndarray, row: int, width: int) -> np.ndarray:
    return _mixed(anchor + _U((row + 1) * _BASE & (1 << 64) - 1)) % _U(width)


def _chunks(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    for batch in batches:
        begin = words = 0
        docs: list[list[bytes]] = []
        for i in range(batch.num_rows):
            docs.append(_split(batch.column(column)[i].as_py()))
            words += len(docs[-1])
            if words >= CHUNK or i == batch.num_rows - 1:
                yield batch.slice(begin, i + 1 - begin), docs
                begin, words, docs = i + 1, 0, []


def sized(docs: DataFrame, conf: Substrings, text: str = "text") -> Substrings:
    """``conf`` with eight cells a row per expected anchor, LEAST at least: anchors
    lie half of (window - gram + 2) words apart on average, words six characters.
    The width decides how many windows pass, never the result."""
    if conf.width is None:
        chars = docs.agg(F.coalesce(F.sum(F.length(F.col(text).cast("string"))), F.lit(0))).first()[0]
        cells = 8 * chars // (3 * (conf.window - conf.gram + 2))
        conf = replace(conf, width=max(LEAST, 1 << int(cells).bit_length()))
    if conf.width % SHARD or not 0 < conf.gram <= conf.window:
        raise ValueError("width must be a multiple of SHARD, and a gram no longer than a window")
    return conf


def _anchors(batches: Iterator[pa.RecordBatch], column: int, conf: Substrings) -> Iterator[np.ndarray]:
    """The anchors of a partition's runs, some millions at a time."""
    held: list[np.ndarray] = []
    for _, own in _chunks(batches, column):
        held.append(runs_of(own, conf)[3])
        if sum(map(len, held)) > HELD:
            yield np.concatenate(held)
            held = []
    if held:
        yield np.concatenate(held)


def sketch(docs: DataFrame, conf: Substrings = Substrings(), text: str = "text") -> np.ndarray:
    """The merged sketch: per row a bitmap of the cells that count two or more."""
    conf = sized(docs, conf, text)

    def part(anchors: np.ndarray) -> Iterator[pa.RecordBatch]:
        for row in range(conf.depth):
            cell, count = np.unique(_cells(anchors, row, conf.width), return_counts=True)
            cuts = np.searchsorted(cell, np.arange(0, conf.width + 1, SHARD).astype(_U))
            some = np.flatnonzero(np.diff(cuts))
            spans = [slice(cuts[s], cuts[s + 1]) for s in some]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(some), row, np.int32)), pa.array(some.astype(np.int32)),
                pa.array([(cell[x] % _U(SHARD)).astype(np.uint32).tobytes() for x in spans], pa.binary()),
                pa.array([np.minimum(count[x], 2).astype(np.uint8).tobytes() for x in spans], pa.binary()),
            ], ["row", "shard", "cells", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for anchors in _anchors(batches, 0, conf):
            yield from part(anchors)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, cells = None, np.zeros(SHARD, np.uint8)

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int32()), pa.array([now[1]], pa.int32()),
                                               pa.array([np.packbits(cells >= 2, bitorder="little").tobytes()], pa.binary())],
                                              ["row", "shard", "bits"])
        for batch in batches:
            for row, shard, cell, n in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if now != (row, shard):
                    if now is not None:
                        yield done()
                    now = (row, shard)
                    cells[:] = 0
                at = np.frombuffer(cell, np.uint32)  # no cell twice
                cells[at] = np.minimum(cells[at] + np.frombuffer(n, np.uint8), 2)
        if now is not None:
            yield done()

    parts = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "row int, shard int, cells binary, counts binary")
    merged = parts.repartition("row", "shard").sortWithinPartitions("row", "shard").mapInArrow(merge, "row int, shard int, bits binary")
    out = np.zeros((conf.depth, conf.width // 8), np.uint8)
    for r in merged.toLocalIterator():  # depth * width / 8 bytes in all, whatever the input
        out[r["row"], r["shard"] * (SHARD // 8):(r["shard"] + 1) * (SHARD // 8)] = np.frombuffer(r["bits"], np.uint8)
    return out


def _lists(values: np.ndarray, of: np.ndarray, kind: pa.DataType) -> tuple[np.ndarray, pa.ListArray]:
    """The different numbers in ``of`` (sorted), and the values under each as a list."""
    start = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1]))) if len(of) else np.zeros(0, np.int64)
    offsets = np.append(start, len(of)).astype(np.int32)
    return of[start], pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def repeated_anchors(rows: DataFrame, conf: Substrings) -> DataFrame:
    """(anchor, n): the anchors of ``rows`` (key, text) that the sharded sketch
    estimates to repeat, and how often they occur.  A shard receives its cells of
    every partition's sketch first, then every partition's different anchors."""
    shards = min(SHARDS, conf.width // SHARD)
    size = -(-conf.width // shards)

    def part(anchors: np.ndarray) -> Iterator[pa.RecordBatch]:
        anchors, n = np.unique(anchors, return_counts=True)
        shard = (_mixed(anchors ^ _U(_BASE)) % _U(shards)).astype(np.int64)
        for row in range(conf.depth):
            cell, place = np.unique(shard * size + _cells(anchors, row, size).astype(np.int64), return_inverse=True)
            twice = np.bincount(place, n, len(cell)) >= 2
            of, small = _lists(np.where(twice, ~(cell % size), cell % size).astype(np.int32), cell // size, pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(of, pa.int32()), pa.array(np.full(len(of), row, np.int32)), small,
                                              pa.nulls(len(of), pa.list_(pa.int64()))], names)
        order = np.argsort(shard, kind="stable")
        of, own = _lists(anchors[order].view(np.int64), shard[order], pa.int64())
        _, often = _lists(np.minimum(n[order], np.iinfo(np.int32).max).astype(np.int32), shard[order], pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(of, pa.int32()), pa.array(np.full(len(of), conf.depth, np.int32)), often, own], names)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for anchors in _anchors(batches, 1, conf):
            yield from part(anchors)

    def summed(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        found, place = np.unique(np.concatenate([a for a, _ in held]), return_inverse=True)
        return found, np.bincount(place, np.concatenate([n for _, n in held]), len(found)).astype(np.int64)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, cells = None, np.zeros((conf.depth, size), np.uint8)
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def done() -> Iterator[pa.RecordBatch]:
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in summed(held)], ["anchor", "n"])
                held.clear()
        for batch in batches:
            shard, row = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for i in range(batch.num_rows):
                if now != shard[i]:
                    yield from done()
                    now = shard[i]
                    cells[:] = 0
                small = batch.column(2)[i].values.to_numpy()
                if row[i] < conf.depth:  # no cell twice; negative: two or more
                    at = np.where(small < 0, ~small, small)
                    cells[row[i], at] = np.minimum(cells[row[i], at] + 1 + (small < 0), 2)
                    continue
                anchors = batch.column(3)[i].values.to_numpy()
                passed = np.logical_and.reduce([cells[r, _cells(anchors.view(_U), r, size).astype(np.int64)] >= 2 for r in range(conf.depth)])
                if passed.any():
                    held.append((anchors[passed], small[passed]))
                    if sum(len(a) for a, _ in held) > HELD:
                        held[:] = [summed(held)]
        yield from done()

    names = ["shard", "row", "small", "anchors"]
    dealt = rows.mapInArrow(deal, "shard int, row int, small array<int>, anchors array<long>")
    return dealt.repartition("shard").sortWithinPartitions("shard", "row").mapInArrow(meet, "anchor long, n long")


def with_repeated_anchors(rows: DataFrame, conf: Substrings) -> DataFrame:
    """(key, text, anchors): the rows that have anchors which the sharded sketch
    passes, with these.  An anchor of very many documents is dealt over SALTS keys."""
    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _chunks(batches, 1):
            doc, _, _, anchor, _ = runs_of(texts, conf)
            order = np.lexsort((anchor, doc))
            doc, anchor = doc[order], anchor[order]
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (anchor[1:] != anchor[:-1])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc[new])), pa.array(anchor[new].view(np.int64))], ["key", "anchor"])

    passed = cut(repeated_anchors(rows, conf))
    hot = F.broadcast(cut(passed.orderBy(F.desc("n"), "anchor").limit(HOT).select("anchor", F.lit(True).alias("hot"))))
    each = passed.join(hot, "anchor", "left").select("anchor", F.explode(F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1)))
                                                                      .otherwise(F.array(F.lit(0)))).alias("salt"))
    met = (rows.mapInArrow(own, "key binary, anchor long").join(hot, "anchor", "left")
           .select("key", "anchor", F.when(F.col("hot"), F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")).otherwise(0).alias("salt"))
           .join(each, ["anchor", "salt"], "left_semi").groupBy("key").agg(F.collect_set("anchor").alias("anchors")))
    return cut(rows.join(met, "key").select("key", "text", "anchors"))


def candidate_runs(rows: DataFrame, conf: Substrings, bits: Broadcast | None, hashes: bool) -> DataFrame:
    """The runs of ``rows`` (key, text) whose anchor the sketch estimates to
    repeat, as (anchor, run, hashes) with all window hashes, or as (key, anchor,
    run, first) with the document and first window.  run hashes the run's windows.
    Without the sketch's bits, ``rows`` have their anchors that passed it."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bits.value if bits else None
        for batch, own in _chunks(batches, 1):
            doc, first, length, anchor, windows = runs_of(own, conf)
            if table is None:  # to pass is an anchor's property, whichever row names it
                keep = np.isin(anchor, batch.column(2).flatten().to_numpy().view(_U))
            else:
                keep = np.ones(len(doc), bool)
                for row in range(conf.depth):
                    cell = _cells(anchor, row, conf.width).astype(np.int64)
                    keep &= (table[row][cell >> 3] >> (cell & 7).astype(np.uint8) & 1).astype(bool)
            if not keep.any():
                continue
            flat = windows[np.repeat(keep, length)].view(np.int64)
            offsets = np.concatenate(([0], np.cumsum(length[keep])))
            raw = flat.tobytes()
            run = np.array([xxhash.xxh3_64_intdigest(raw[8 * a:8 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())], _U)
            names = [pa.array(anchor[keep].view(np.int64)), pa.array(run.view(np.int64))]
            if hashes:
                yield pa.RecordBatch.from_arrays([*names, pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))],
                                                 ["anchor", "run", "hashes"])
            else:
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc[keep])), *names, pa.array(first[keep].astype(np.int32))],
                                                 ["key", "anchor", "run", "first"])

    schema = "anchor long, run long, hashes array<long>" if hashes else "key binary, anchor long, run long, first int"
    return rows.mapInArrow(emit, schema)


def _shared_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, run, at) of the windows that a run without equal shares with another run of its anchor."""
    for batch in batches:
        out: tuple[list, list, list] = ([], [], [])
        for anchor, kinds in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            seen = Counter()
            for k in kinds:
                for h in k["hashes"]:
                    seen[h] += k["n"]
            for k in kinds:
                if k["n"] == 1:
                    at = [i for i, h in enumerate(k["hashes"]) if seen[h] > 1]
                    if at:
                        for column, value in zip(out, (anchor, k["run"], at)):
                            column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.list_(pa.int32()))],
                                         ["anchor", "run", "at"])


def repeated_spans(docs: DataFrame, conf: Substrings, key: Column, text: str = "text") -> DataFrame:
    """(key, spans array<struct<first, n>>): stretches of consecutive repeated
    windows, by first word, per document that has any."""
    conf = sized(docs, conf, text)
    rows, bits = docs.select(key.alias("key"), F.col(text).cast("string").alias("text")), None
    if conf.width <= conf.most:
        bits = docs.sparkSession.sparkContext.broadcast(sketch(docs, conf, text))
    else:
        rows = with_repeated_anchors(rows, conf)
    # candidates are made twice, with hashes and with places, rather than once and stored with both
    kinds = cut(candidate_runs(rows, conf, bits, True).groupBy("anchor", "run")
                .agg(F.count("*").alias("n"), F.any_value("hashes").alias("hashes")))
    copied = kinds.where("n > 1").select("anchor", "run", F.array(F.struct(F.lit(0).alias("at"), F.size("hashes").alias("n"))).alias("spans"))
    # an anchor with several kinds of run, one of them without equal: its windows are counted one by one
    mixed = cut(kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).where("kinds > 1 AND least = 1"))
    few = kinds.join(mixed.where(F.col("kinds") <= conf.kinds).select("anchor"), "anchor", "left_semi")
    near = (few.groupBy("anchor").agg(F.collect_list(F.struct("run", "n", "hashes")).alias("k"))
            .mapInArrow(_shared_windows, "anchor long, run long, at array<int>"))
    frequent = mixed.where(F.col("kinds") > conf.kinds).select("anchor")  # their runs do not meet in one task
    many = (kinds.join(broadcast_if_small(frequent, frequent.count(), 100_000), "anchor", "left_semi")
            .select("anchor", "run", "n", F.posexplode("hashes").alias("at", "hash")))
    twice = many.groupBy("anchor", "hash").agg(F.sum("n").alias("n")).where("n > 1").select("anchor", "hash")
    far = (many.where("n = 1").join(twice, ["anchor", "hash"], "left_semi")
           .groupBy("anchor", "run").agg(F.collect_list("at").alias("at")))
    single = near.unionByName(far).select("anchor", "run", F.transform("at", lambda x: F.struct(x.alias("at"), F.lit(1).alias("n"))).alias("spans"))
    hits = copied.unionByName(single)
    return (candidate_runs(rows, conf, bits, False).join(hits, ["anchor", "run"])
            .select("key", F.transform("spans", lambda x: F.struct((F.col("first") + x["at"]).alias("first"), x["n"].alias("n"))).alias("spans"))
            .groupBy("key").agg(F.flatten(F.collect_set("spans")).alias("spans")))  # equal rows have equal spans


def substring_dedup(docs: DataFrame, conf: Substrings = Substrings(), id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id_col, n_words long, n_removed long, kept string) per row of ``docs``;
    kept: the words that no repeated window covers, joined by one space."""
    importable(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]
    spans = repeated_spans(docs, conf, row_key(docs, id_col, text), text)
    key, = fresh(docs, "_key")
    own = docs.withColumn(key, row_key(docs, id_col, text)).select(
        F.col(id_col).alias("id"), F.col(text).cast("string").alias("text"), F.col(key).alias("key"))
    joined = own.join(spans, "key", "left").select("id", "text", F.col("spans.first").alias("first"), F.col("spans.n").alias("n"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for i in range(batch.num_rows):
                words = _split(batch.column(1)[i].as_py())
                first, n = batch.column(2)[i].values, batch.column(3)[i].values
                gone = 0
                if first is not None and len(first):
                    first, n = first.to_numpy(), n.to_numpy()
                    step = np.zeros(len(words) + 1, np.int64)
                    np.add.at(step, first, 1)
                    np.add.at(step, first + n + (conf.window - 1), -1)
                    keep = np.cumsum(step[:-1]) == 0
                    gone = len(words) - int(keep.sum())
                    n_words.append(len(words))
                    words = [w for w, k in zip(words, keep.tolist()) if k]
                else:
                    n_words.append(len(words))
                n_removed.append(gone)
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                                              pa.array(kept, pa.binary()).cast(pa.string())], [id_col, "n_words", "n_removed", "kept"])
    return joined.mapInArrow(apply, f"`{id_col}` {kind}, n_words long, n_removed long, kept string")
