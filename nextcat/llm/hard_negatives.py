"""Hard-negative mining by best-first search of STR-packed R-trees.

Vectors become integers, so that scores (inner products) are exact.  Vectors of
one dimension and label are packed by sort-tile-recursive: range-sorted by the
coordinate of the largest variance and cut into runs, each run tiled by further
coordinates into leaves.  A run is a tree: a minimum bounding box per leaf, per
group of leaves, and for the whole.  For a probe q a box gives the interval
[sum of min(q*low, q*high), sum of max(q*low, q*high)] of its vectors' scores.

A probe asks for the k best vectors with scores in a window, of its own label or
of the others.  Probes are searched in blocks: a queue holds boxes by the best
score that they still promise to a probe of the block; a box is dropped for a
probe whose window it misses, whose k-th best score it stays strictly below, or
whose k-th best it could only tie with larger ids.  What remains at a leaf is
multiplied out.

Anchors meet their own tree first, which gives them a score that k of their
label reach.  Blocks then meet the roots of all trees, without vectors, and only
pairs that a root does not rule out bring blocks and trees together, in groups of
bounded size; each pair of groups gives k rows a probe, and the k best of those
are the result.  Positives are such a search in the own label; negatives one in
the other labels, with a window per positive score.

Defined cases: rows with a null id, label or vector, or a null or non-finite
component, take no part; an anchor's own rows are all rows with its id; anchor
rows equal in id, label and vector count once, other rows that repeat are
candidates each; only vectors of one dimension are compared; ties go to the
smaller id; a positive score below 0 has an empty window; an empty table gives no
rows; columns of other names are ignored."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, cut, importable
from .topk import products

_LEAST, _MOST = -(1 << 62), 1 << 62


@dataclass(frozen=True)
class Mining:
    positives: int = 5
    negatives: int = 10
    window: tuple[int, int] = (30, 90)  # negative scores, in hundredths of the positive's
    scale: int = 256
    axes: int = 3           # coordinates by which runs are tiled
    leaf: int = 64          # vectors of a leaf
    fan: int = 8            # leaves of an inner node
    tree: int = 4096        # vectors of a tree
    block: int = 256        # probes of a block
    group_bytes: int = 16 << 20  # trees, or blocks, that meet in one task


def _valid(vector: Column) -> Column:
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def labelled_vectors(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str | Column = "label",
                     scale: int = Mining.scale) -> DataFrame:
    """(id long, label long, vector array<double> of integers) of the rows that take part."""
    label = F.col(label) if isinstance(label, str) else label
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    return (rows.where(F.col(id_col).isNotNull() & _valid(F.col(vector)))
            .select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), whole.alias("vector"))
            .where(F.col("label").isNotNull()))


# ---------------------------------------------------------------- trees

def tile(x: np.ndarray, axes: list[int], leaf: int) -> np.ndarray:
    """Order of the rows in which stretches of ``leaf`` rows are the tiles: sorted by
    the first axis, cut into slabs, each tiled by the other axes."""
    leaves = -(-len(x) // leaf)
    if not axes or leaves <= 1:
        return np.arange(len(x))
    order = np.argsort(x[:, axes[0]], kind="stable")
    slabs = int(np.ceil(leaves ** (1 / len(axes))))
    size = -(-leaves // slabs) * leaf
    return np.concatenate([order[i:i + size][tile(x[order[i:i + size]], axes[1:], leaf)] for i in range(0, len(x), size)])


class Tree:
    """Boxes over the stretches of a tiled run: the root, inner nodes, leaves."""

    def __init__(self, number: int, label: int, ids: np.ndarray, x: np.ndarray, conf: Mining):
        self.number, self.label, self.ids, self.x = number, label, ids, x
        self.leaf = np.arange(0, len(ids), conf.leaf)
        self.low, self.high = np.minimum.reduceat(x, self.leaf), np.maximum.reduceat(x, self.leaf)
        self.first = np.minimum.reduceat(ids, self.leaf)
        self.inner = np.arange(0, len(self.leaf), conf.fan)
        self.inner_low, self.inner_high = np.minimum.reduceat(self.low, self.inner), np.maximum.reduceat(self.high, self.inner)
        self.inner_first = np.minimum.reduceat(self.first, self.inner)

    @property
    def root(self) -> tuple[np.ndarray, np.ndarray, int]:
        return self.low.min(axis=0), self.high.max(axis=0), int(self.first.min())


def _numbers(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a, np.float64).tobytes()


_TREES = "dim int, label long, ids binary, vectors binary, anchors binary, low binary, high binary, first long, bytes long"


def build_trees(vectors: DataFrame, conf: Mining = Mining()) -> DataFrame:
    """A row per tree of (id, label, vector, anchor): number, dim, label, ids,
    vectors and anchors (raw numbers, tiled), low and high of the root box, first
    (smallest id), bytes, g (group of neighbouring trees of the dimension)."""
    spread = cut(vectors.select(F.size("vector").alias("dim"), F.posexplode("vector").alias("axis", "value")).groupBy("dim", "axis")
                 .agg(F.var_pop("value").alias("spread")).groupBy("dim")
                 .agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("spread")).alias("by"), "axis"))), 1, conf.axes)["axis"].alias("axes")))
    rows = (vectors.withColumn("dim", F.size("vector")).join(broadcast_if_small(spread, spread.count()), "dim", "left")
            .withColumn("along", F.coalesce(F.try_element_at(F.col("vector"), F.get("axes", F.lit(0)) + 1), F.lit(0.0))))
    ordered = rows.repartitionByRange("dim", "label", "along", "id").sortWithinPartitions("dim", "label", "along", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def put(key: tuple, axes: list[int], ids: list, parts: list, flags: list) -> pa.RecordBatch:
            ids, x, flags = np.concatenate(ids), np.concatenate(parts), np.concatenate(flags)
            order = tile(x, axes[1:], conf.leaf)
            tree = Tree(0, key[1], ids[order], x[order], conf)
            low, high, first = tree.root
            raw = [tree.ids.tobytes(), _numbers(tree.x), flags[order].astype(np.uint8).tobytes(), _numbers(low), _numbers(high)]
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int64()), *(pa.array([r], pa.binary()) for r in raw),
                 pa.array([first], pa.int64()), pa.array([sum(map(len, raw))], pa.int64())],
                ["dim", "label", "ids", "vectors", "anchors", "low", "high", "first", "bytes"])
        now, ids, parts, flags, n, axes = None, [], [], [], 0, []
        for batch in batches:
            dims, labels, some = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            flag = batch.column(5).to_numpy(zero_copy_only=False)
            flat = batch.column(3).flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(dims, dtype=np.int64)
            change = (np.flatnonzero((dims[1:] != dims[:-1]) | (labels[1:] != labels[:-1])) + 1).tolist()
            for a, b in zip([0, *change], [*change, len(dims)]):
                if a == b:
                    continue
                key = int(dims[a]), int(labels[a])
                x = flat[ends[a] - key[0]:ends[b - 1]].reshape(b - a, key[0])
                at = 0
                while at < b - a:
                    if now is not None and (now != key or n == conf.tree):
                        yield put(now, axes, ids, parts, flags)
                        now, ids, parts, flags, n = None, [], [], [], 0
                    if now is None:
                        now, axes = key, batch.column(4)[a].as_py() or []
                    take = min(conf.tree - n, b - a - at)
                    ids.append(some[a + at:a + at + take].astype(np.int64))
                    parts.append(x[at:at + take])
                    flags.append(flag[a + at:a + at + take])
                    n += take
                    at += take
        if now is not None:
            yield put(now, axes, ids, parts, flags)
    return _grouped(ordered.select("dim", "label", "id", "vector", "axes", "anchor").mapInArrow(run, _TREES), conf.group_bytes)


def _grouped(rows: DataFrame, size: int) -> DataFrame:
    """``rows`` (with dim and bytes), written, with number and g: groups, counted
    from 0 per dimension, of neighbours of about ``size`` bytes.  A row's bytes are
    added up inside its task, and to the sums of the tasks before (a row per task)."""
    rows = cut(rows.withColumn("number", F.monotonically_increasing_id()))
    small = rows.select("dim", "bytes", "number", F.shiftright("number", 33).alias("task"))
    before = lambda *keys: Window.partitionBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    tasks = small.groupBy("dim", "task").agg(F.sum("bytes").alias("all")).select(
        "dim", "task", F.coalesce(F.sum("all").over(before("dim").orderBy("task")), F.lit(0)).alias("ahead"))
    inside = F.coalesce(F.sum("bytes").over(before("dim", "task").orderBy("number")), F.lit(0))
    placed = small.withColumn("inside", inside).join(tasks, ["dim", "task"])
    return cut(rows.join(placed.select("number", F.floor((F.col("ahead") + F.col("inside")) / size).cast("int").alias("g")), "number"))


def _unpack(ids: bytes, vectors: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, np.int64)
    return i, np.frombuffer(vectors, np.float64).reshape(len(i), dim)


def bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and most inner product of every probe with vectors of every box, a little widened."""
    up, down = np.maximum(q, 0.0), np.minimum(q, 0.0)
    most, least = up @ high.T + down @ low.T, up @ low.T + down @ high.T
    slack = 1e-9 * (np.abs(most) + np.abs(least)) if max(np.abs(most).max(initial=0), np.abs(least).max(initial=0)) >= 2.0 ** 52 else 0.0
    return least - slack, most + slack


# ---------------------------------------------------------------- search

class Probes:
    """A block of probes and the k best that each has found."""

    def __init__(self, q: np.ndarray, own: np.ndarray, label: np.ndarray, low: np.ndarray, high: np.ndarray, reach: np.ndarray, k: int, same: bool):
        self.q, self.own, self.label, self.low, self.high, self.k, self.same = q, own, label, low, high, k, same
        self.kth = np.maximum(reach, low)  # no lower score can be among the k best
        self.last = np.full(len(own), _MOST)  # at the k-th score no larger id can
        self.best: list[list[tuple[int, int]]] = [[] for _ in own]  # (-score, id), sorted
        self.products = 0

    def wants(self, label: int | np.ndarray) -> np.ndarray:
        return (self.label == label) == self.same

    def open(self, some: np.ndarray, low: np.ndarray, high: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """some probes x boxes: whether the box may still hold a result; most score."""
        least, most = bounds(self.q[some], low, high)
        kth = self.kth[some][:, None]
        return ((most > kth) | ((most >= kth) & (first[None, :] <= self.last[some][:, None]))) & (least <= self.high[some][:, None]), most

    def leaf(self, some: np.ndarray, ids: np.ndarray, x: np.ndarray) -> None:
        score = products(self.q[some], x)
        self.products += score.size
        fits = (score >= self.kth[some][:, None]) & (score <= self.high[some][:, None]) & (ids[None, :] != self.own[some][:, None])
        for r in np.flatnonzero(fits.any(axis=1)).tolist():
            i, columns = some[r], np.flatnonzero(fits[r])
            s = score[r, columns]
            if len(s) > self.k:  # ties at the k-th place stay
                columns = columns[s >= np.partition(s, len(s) - self.k)[len(s) - self.k]]
                s = score[r, columns]
            self.best[i] = sorted([*self.best[i], *zip((-s).tolist(), ids[columns].tolist())])[:self.k]
            if len(self.best[i]) == self.k and -self.best[i][-1][0] >= self.kth[i]:
                self.kth[i], self.last[i] = -self.best[i][-1][0], self.best[i][-1][1]

    def search(self, trees: list[Tree]) -> None:
        """Best-first over the boxes of all trees, for all probes of the block."""
        queue: list[tuple] = []

        def push(kind: int, tree: Tree, some: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray, first: np.ndarray) -> None:
            left, most = self.open(some, low, high, first)
            for j in np.flatnonzero(left.any(axis=0)).tolist():
                rows = left[:, j]
                heapq.heappush(queue, (-float(most[rows, j].max()), next(count), kind, int(at[j]), some[rows], tree, low[j:j + 1], high[j:j + 1], first[j:j + 1]))
        count = iter(range(1, 1 << 62))
        for t in trees:
            some = np.flatnonzero(self.wants(t.label))
            if len(some):
                low, high, first = t.root
                push(0, t, some, np.zeros(1, int), low[None, :], high[None, :], np.array([first]))
        while queue:
            _, _, kind, at, some, t, low, high, first = heapq.heappop(queue)
            some = some[self.open(some, low, high, first)[0][:, 0]]  # scores have risen since it was queued
            if not len(some):
                continue
            if kind == 0:
                push(1, t, some, np.arange(len(t.inner)), t.inner_low, t.inner_high, t.inner_first)
            elif kind == 1:
                to = slice(t.inner[at], t.inner[at + 1] if at + 1 < len(t.inner) else len(t.leaf))
                push(2, t, some, np.arange(to.start, to.stop), t.low[to], t.high[to], t.first[to])
            else:
                to = slice(t.leaf[at], t.leaf[at + 1] if at + 1 < len(t.leaf) else len(t.ids))
                self.leaf(some, t.ids[to], t.x[to])


def _probes_of(row: dict, k: int, same: bool) -> Probes:
    column = lambda name: np.frombuffer(row[name], np.int64)
    own, q = _unpack(row["own"], row["vectors"], row["dim"])
    return Probes(q, own, column("labels"), column("low"), column("high"), column("reach"), k, same)


def seeds(trees: DataFrame, conf: Mining = Mining()) -> DataFrame:
    """(own, label, vector, reach, near) of every anchor: the score that enough
    vectors of its own tree reach, and the tree's number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, x = _unpack(row["ids"], row["vectors"], row["dim"])
                at = np.flatnonzero(np.frombuffer(row["anchors"], np.uint8))
                for some in np.array_split(at, max(1, -(-len(at) // conf.block))):
                    m = len(some)
                    if not m:
                        continue
                    whole = np.full(m, _LEAST)
                    probes = Probes(x[some], ids[some], np.full(m, row["label"]), whole, np.full(m, _MOST), whole, conf.positives, True)
                    probes.search([Tree(row["number"], row["label"], ids, x, conf)])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[some], pa.int64()), pa.array([row["label"]] * m, pa.int64()),
                         pa.array(x[some].tolist(), pa.list_(pa.float64())), pa.array(probes.kth, pa.int64()), pa.array([row["number"]] * m, pa.int64())],
                        ["own", "label", "vector", "reach", "near"])
    found = trees.select("number", "dim", "label", "ids", "vectors", "anchors").mapInArrow(
        run, "own long, label long, vector array<double>, reach long, near long")
    return found.groupBy("own", "label", "vector").agg(F.max("reach").alias("reach"), F.min("near").alias("near"))


def _blocks(probes: DataFrame, conf: Mining) -> DataFrame:
    """Blocks of neighbouring probes (pid, own, label, vector, low, high, reach, near), grouped."""
    names = ("pid", "own", "label", "low", "high", "reach")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(0).to_numpy()
            columns = [batch.column(1 + i).to_numpy().astype(np.int64) for i in range(len(names))]
            flat = batch.column(1 + len(names)).flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(dims, dtype=np.int64)
            cuts = sorted({0, len(dims), *(np.flatnonzero(dims[1:] != dims[:-1]) + 1).tolist(), *range(0, len(dims), conf.block)})
            for a, b in zip(cuts, cuts[1:]):
                raw = [c[a:b].tobytes() for c in columns] + [_numbers(flat[ends[a] - dims[a]:ends[b - 1]])]
                yield pa.RecordBatch.from_arrays([pa.array([int(dims[a])], pa.int32()), *(pa.array([r], pa.binary()) for r in raw),
                                                  pa.array([sum(map(len, raw))], pa.int64())],
                                                 ["dim", "pids", "own", "labels", "low", "high", "reach", "vectors", "bytes"])
    sized = probes.withColumn("dim", F.size("vector"))
    ordered = sized.repartitionByRange("dim", "label", "near", "own", "pid").sortWithinPartitions("dim", "label", "near", "own", "pid")
    packed = ordered.select("dim", *names, "vector").mapInArrow(
        run, "dim int, pids binary, own binary, labels binary, low binary, high binary, reach binary, vectors binary, bytes long")
    return _grouped(packed, conf.group_bytes)


def _every(rows: DataFrame, group: str, other: DataFrame, other_group: str) -> DataFrame:
    """``rows`` once for every group of the other side, of their dimension."""
    groups = other.groupBy("dim").agg((F.max("g") + 1).alias("groups"))
    return (rows.withColumnRenamed("g", group).join(broadcast_if_small(cut(groups), groups.count()), "dim")
            .withColumn(other_group, F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).drop("groups"))


def search(probes: DataFrame, trees: DataFrame, k: int, same: bool, conf: Mining = Mining()) -> DataFrame:
    """(pid, rank, id, score): the k best vectors per probe, of its label or of the others."""
    blocks = _blocks(probes, conf)
    roots = trees.select("dim", "label", "low", "high", "first", F.col("number").alias("tree"), F.col("g").alias("tg"),
                         (F.length("low") + F.length("high") + 32).cast("long").alias("bytes"))
    roots = _grouped(roots, conf.group_bytes).drop("number", "bytes")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        """Which groups of trees the blocks of a group have to visit."""
        out: set[tuple] = set()
        if left.num_rows and right.num_rows:
            dim, bg = left["dim"][0].as_py(), left["bg"][0].as_py()
            box = lambda name: np.stack([np.frombuffer(b, np.float64) for b in right[name].to_pylist()])
            low, high, first, label, tg = box("low"), box("high"), right["first"].to_numpy(), right["label"].to_numpy(), right["tg"].to_numpy()
            for row in left.to_pylist():
                p = _probes_of(row, k, same)
                left_, _ = p.open(np.arange(len(p.own)), low, high, first)
                left_ &= (p.label[:, None] == label[None, :]) == same
                out |= {(dim, bg, int(g)) for g in np.unique(tg[left_.any(axis=0)])}
        return pa.table([pa.array([r[i] for r in out], pa.int32()) for i in range(3)], names=["dim", "bg", "tg"])
    pairs = cut(_every(blocks, "bg", roots, "rg").groupBy("dim", "bg", "rg").cogroup(_every(roots, "rg", blocks, "bg").groupBy("dim", "bg", "rg"))
                .applyInArrow(meet, "dim int, bg int, tg int").distinct())

    def visit(left: pa.Table, right: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        forest = [Tree(r["number"], r["label"], *_unpack(r["ids"], r["vectors"], r["dim"]), conf)
                  for r in sorted(right.select(["number", "dim", "label", "ids", "vectors"]).to_pylist(), key=lambda r: r["number"])]
        for row in left.to_pylist() if forest else []:
            p = _probes_of(row, k, same)
            p.search(forest)
            for pid, found in zip(np.frombuffer(row["pids"], np.int64).tolist(), p.best):
                for score, other in found:
                    for column, value in zip(out, (pid, other, -score)):
                        column.append(value)
        return pa.table([pa.array(c, pa.int64()) for c in out], names=["pid", "id", "score"])
    to = blocks.withColumnRenamed("g", "bg").join(pairs, ["dim", "bg"])
    of = trees.select("number", "dim", "label", "ids", "vectors", F.col("g").alias("tg")).join(pairs, ["dim", "tg"])
    found = to.groupBy("dim", "bg", "tg").cogroup(of.groupBy("dim", "bg", "tg")).applyInArrow(visit, "pid long, id long, score long")
    order = Window.partitionBy("pid").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(vectors: DataFrame, conf: Mining = Mining()) -> DataFrame:
    """(anchor_id, positive_id, rank int, negative_id, positive_score,
    negative_score) from (id, label, vector, anchor boolean)."""
    importable(vectors.sparkSession)
    trees = build_trees(vectors.select("id", "label", "vector", F.coalesce("anchor", F.lit(False)).alias("anchor")), conf)
    anchors = cut(seeds(trees, conf).select("*", F.lit(_LEAST).alias("low"), F.lit(_MOST).alias("high"), F.monotonically_increasing_id().alias("pid")))
    positives = cut(search(anchors, trees, conf.positives, True, conf).select("pid", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))
    low, high = conf.window
    windows = positives.where("positive_score >= 0").select("pid", "positive_score").distinct()
    score = F.col("positive_score")
    probes = cut(windows.withColumnRenamed("pid", "anchor").join(anchors.select(F.col("pid").alias("anchor"), "own", "label", "vector", "near"), "anchor")
                 .withColumns({"low": F.expr(f"({low} * positive_score + 99) div 100"), "high": F.expr(f"({high} * positive_score) div 100"),
                               "reach": F.lit(_LEAST), "pid": F.monotonically_increasing_id()}))
    negatives = search(probes, trees, conf.negatives, False, conf).select("pid", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    asked = probes.select("pid", "anchor", F.col("own").alias("anchor_id"), score)
    return (positives.withColumnRenamed("pid", "anchor").join(asked, ["anchor", "positive_score"]).join(negatives, "pid")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
