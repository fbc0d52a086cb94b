"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are turned into integers, sorted by length (longest first) and packed
into buckets of neighbouring lengths.  A query meets the buckets in that order
with its k-th best score so far as threshold t.  For a bucket whose longest
vector is l, t / (|q| l) is the cosine that a vector must reach there: above 1
the bucket and all after it are left out; a high one makes the bucket prune by
coordinates (the query's largest coordinates bound where the vector's must
lie), a low one by length (vectors shorter than t / |q|).  What is left is
verified by its products.  Bounds are widened against rounding, so nothing that
could reach the threshold is left out, and scores are exact integers.

Queries start with the threshold that a seed bucket of the longest vectors
gives.  Buckets and query blocks are dealt as pairs of groups of bounded size,
each put out its k best a query, and the k best of those are the result: no
task or driver holds a whole side.

Defined cases: null vectors, and vectors that hold null or non-finite
components, take no part, nor do rows with a null id; a query's own row is every
row with its id; equal query rows count once; rows that repeat are candidates
each; ties go to the smaller id; only vectors of one dimension are compared; with
fewer candidates than k all are returned; an empty table gives no rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, importable

_EXACT = float(1 << 53)


@dataclass(frozen=True)
class TopK:
    k: int = 5
    scale: int = 256
    bucket: int = 2048      # vectors a bucket
    block: int = 256        # queries a block
    group: int = 16         # buckets, or query blocks, that a task holds
    focus: int = 4          # coordinates of the query that prune
    coordinate_from: float = 0.6  # local cosine from which coordinates prune better than length


def _integers(vector: Column) -> Column:
    return F.transform(vector, lambda x: x.cast("double"))


def _valid(vector: Column) -> Column:
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def _pack(rows: DataFrame, size: int, scale: int) -> DataFrame:
    """(dim, longest, ids, vectors): runs of at most ``size`` neighbours of
    (dim, length), from (id, vector); numbers as raw bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def put(dim: int, ids: list, vectors: list) -> pa.RecordBatch:
            v = np.concatenate(vectors)
            longest = float(np.sqrt((v * v).sum(axis=1)).max()) if dim else 0.0
            return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([longest]), pa.array([np.concatenate(ids).tobytes()], pa.binary()),
                                               pa.array([v.tobytes()], pa.binary())], ["dim", "longest", "ids", "vectors"])
        now, ids, vectors, n = None, [], [], 0
        for batch in batches:
            key = batch.column(0).to_numpy()
            dims = batch.column(2).to_numpy()
            flat = np.floor(scale * batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            ends = np.cumsum(dims)
            i = 0
            while i < len(key):
                if now is not None and (n == size or dims[i] != now):
                    yield put(now, ids, vectors)
                    now, ids, vectors, n = None, [], [], 0
                now = int(dims[i])
                same = i + int((dims[i:] != now).argmax()) if (dims[i:] != now).any() else len(key)
                j = min(same, i + size - n)
                ids.append(key[i:j].astype(np.int64))
                vectors.append(flat[ends[i] - now:ends[j - 1]].reshape(j - i, now))
                n += j - i
                i = j
        if now is not None:
            yield put(now, ids, vectors)
    length = F.aggregate("vector", F.lit(0.0), lambda s, x: s + F.pow(F.floor(x * scale), 2))
    by = rows.select("id", "vector", F.size("vector").alias("dim"), length.alias("length"))
    ordered = by.repartitionByRange("dim", F.col("length").desc(), "id").sortWithinPartitions("dim", F.col("length").desc(), "id")
    return ordered.select("id", "vector", "dim").mapInArrow(run, "dim int, longest double, ids binary, vectors binary")


def _numbered(packed: DataFrame, group: int) -> DataFrame:
    """With number (per dimension, longest first) and g, the group of ``group`` numbers."""
    known = cut(packed.withColumn("b", F.monotonically_increasing_id()))
    order = Window.partitionBy("dim").orderBy(F.col("longest").desc(), "b")  # a row per bucket, without its vectors
    names = known.select("dim", "longest", "b").select("b", (F.row_number().over(order) - 1).alias("number"))
    return known.join(names, "b").withColumn("g", F.floor(F.col("number") / group).cast("int"))


def _unpack(ids: bytes, vectors: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, np.int64)
    return i, np.frombuffer(vectors, np.float64).reshape(len(i), dim)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer products of integers held as doubles."""
    high = (np.abs(q).max(initial=0) * np.abs(x).max(initial=0)) * max(1, q.shape[1])
    if high < _EXACT:
        return (q @ x.T).astype(np.int64)
    ints = lambda a: np.array([[int(v) for v in row] for row in a.tolist()], object).reshape(a.shape)
    return ints(q) @ ints(x).T


class Best:
    """The k best (score, id) of every query of a block."""

    def __init__(self, queries: np.ndarray, conf: TopK, threshold: np.ndarray):
        self.q, self.conf = queries, conf
        self.norm = np.sqrt((queries * queries).sum(axis=1))
        self.scores: list[list[tuple]] = [[] for _ in queries]  # (-score, id), sorted
        self.threshold = threshold.copy()  # a score that k candidates reach; -inf: none known

    def candidates(self, x: np.ndarray, length: np.ndarray) -> np.ndarray:
        """queries x vectors: whether the bucket's pruning leaves the pair."""
        longest = length.max(initial=0.0)
        left = np.ones((len(self.q), len(x)), bool)
        with np.errstate(divide="ignore", invalid="ignore"):
            cosine = np.where(self.threshold > 0, self.threshold / (self.norm * longest), -1.0)
        left[cosine > 1 + 1e-9] = False
        for i in np.flatnonzero((cosine > 0) & (cosine <= 1 + 1e-9)):
            if cosine[i] < self.conf.coordinate_from:
                left[i] = length >= self.threshold[i] / self.norm[i] * (1 - 1e-9)
                continue
            c, unit = min(cosine[i], 1.0), self.q[i] / self.norm[i]
            slack = np.sqrt(max(0.0, 1 - c * c))
            for f in np.argsort(-np.abs(unit))[:self.conf.focus]:
                # a unit vector at cosine >= c to the query has coordinate f within the cap around the query's
                off = slack * np.sqrt(max(0.0, 1 - unit[f] ** 2))
                low = -1.0 if -unit[f] >= c else unit[f] * c - off
                high = 1.0 if unit[f] >= c else unit[f] * c + off
                left[i] &= (x[:, f] >= low * length - 1e-6 * longest) & (x[:, f] <= high * length + 1e-6 * longest)
        return left

    def meet(self, own: np.ndarray, ids: np.ndarray, x: np.ndarray) -> None:
        length = np.sqrt((x * x).sum(axis=1))
        left = self.candidates(x, length) & (own[:, None] != ids[None, :])
        rows = np.flatnonzero(left.any(axis=1))
        columns = np.flatnonzero(left.any(axis=0))
        if not len(rows):
            return
        score = products(self.q[rows], x[columns])
        k = self.conf.k
        for r, i in enumerate(rows):
            some = np.flatnonzero(left[i, columns])
            s = score[r, some]
            if len(s) > k:  # ties at the k-th place stay
                some = some[s >= np.partition(s, len(s) - k)[len(s) - k]]
                s = score[r, some]
            if np.isfinite(self.threshold[i]):
                reach = s >= self.threshold[i]
                s, some = s[reach], some[reach]
            if len(s):
                self.scores[i] = sorted([*self.scores[i], *zip((-s).tolist(), ids[columns[some]].tolist())])[:k]
                if len(self.scores[i]) == k:
                    self.threshold[i] = max(self.threshold[i], -self.scores[i][-1][0])


def top_products(queries: DataFrame, candidates: DataFrame, conf: TopK = TopK(), id_col: str = "vec_id",
                 vector: str = "embedding") -> DataFrame:
    """(query_id long, rank int, vec_id long, score long): the k best per query."""
    def rows(df: DataFrame) -> DataFrame:
        return df.where(F.col(id_col).isNotNull() & _valid(F.col(vector))).select(
            F.col(id_col).cast("long").alias("id"), _integers(F.col(vector)).alias("vector"))
    importable(candidates.sparkSession)
    buckets = cut(_numbered(_pack(rows(candidates), conf.bucket, conf.scale), conf.group))
    blocks = cut(_numbered(_pack(rows(queries).distinct(), conf.block, conf.scale), conf.group))
    counts = lambda df: df.groupBy("dim").agg((F.max("g") + 1).alias("groups"))
    seeds = buckets.where("number = 0").select("dim", F.col("ids").alias("seed_ids"), F.col("vectors").alias("seed_vectors"))  # one bucket a dimension
    left = (blocks.join(counts(buckets), "dim").join(seeds, "dim")
            .select("dim", F.col("g").alias("qg"), F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("cg"), "number", "ids", "vectors",
                    "seed_ids", "seed_vectors"))
    right = (buckets.join(counts(blocks), "dim")
             .select("dim", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("qg"), F.col("g").alias("cg"), "number", "ids", "vectors"))

    def run(q: pa.Table, c: pa.Table) -> pa.Table:
        out: tuple[list, list, list, list] = ([], [], [], [])
        packs = sorted(c.select(["number", "ids", "vectors"]).to_pylist(), key=lambda r: r["number"])
        for block in q.to_pylist():
            dim = block["dim"]
            own, vectors = _unpack(block["ids"], block["vectors"], dim)
            ids, x = _unpack(block["seed_ids"], block["seed_vectors"], dim)
            score = products(vectors, x).astype(object if dim == 0 else None)
            least = np.full(len(own), -np.inf)
            for i in range(len(own)):
                s = np.sort(score[i][ids != own[i]])
                if len(s) >= conf.k:
                    least[i] = float(s[-conf.k]) * (1 - 1e-12 if s[-conf.k] > 0 else 1 + 1e-12)
            best = Best(vectors, conf, least)
            for p in packs:
                best.meet(own, *_unpack(p["ids"], p["vectors"], dim))
            for n, (i, found) in enumerate(zip(own.tolist(), best.scores)):
                for s, other in found:
                    for column, value in zip(out, (block["number"] * conf.block + n, i, other, -s)):
                        column.append(value)
        return pa.table([pa.array([c["dim"][0].as_py() if len(c) else 0] * len(out[0]), pa.int32()), *(pa.array(x, pa.int64()) for x in out)],
                        names=["dim", "slot", "query_id", "vec_id", "score"])

    found = (left.groupBy("dim", "qg", "cg").cogroup(right.groupBy("dim", "qg", "cg"))
             .applyInArrow(run, "dim int, slot long, query_id long, vec_id long, score long"))
    order = Window.partitionBy("dim", "slot").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= conf.k).select("query_id", "rank", "vec_id", "score")
