"""Hard negatives against plain Python, and the R-tree's boxes and pruning."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from nextcat.llm import hard_negatives as H

ROWS = "vec_id long, embedding array<float>, label int"
TINY = H.Mining(leaf=4, fan=2, tree=16, block=3, group_bytes=3000)


def plain(rows, conf):
    ok = [(i, label, [math.floor(conf.scale * float(np.float32(x))) for x in v]) for i, v, label in rows
          if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, label, q in [x for n, x in enumerate(ok) if x[0] % 10 == 0 and x not in ok[:n]]:
        others = sorted((-dot(q, v), j, other) for j, other, v in ok if j != i and len(v) == len(q))
        for ps, j, _ in [x for x in others if x[2] == label][:conf.positives]:
            fits = [x for x in others if x[2] != label and conf.window[0] * -ps <= 100 * -x[0] <= conf.window[1] * -ps]
            out += [(i, j, r, n, -ps, -s) for r, (s, n, _) in enumerate(fits[:conf.negatives], 1)]
    return sorted(out)


def mined(df, conf):
    rows = H.labelled_vectors(df).withColumn("anchor", F.col("id") % 10 == 0)
    return sorted(map(tuple, H.mine(rows, conf).collect()))


def sample():
    r = random.Random(7)
    centre = [[r.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = [(i, [c + r.gauss(0, 0.4) for c in centre[i % 4]], r.choice([0, 0, 1, 2])) for i in range(150)]
    rows += [(150 + i, [0.5] * 6, i % 2) for i in range(60)]                         # one vector, many rows: ties
    rows += [rows[0], rows[0], rows[10], (10, rows[11][1], rows[11][2])]             # repeated rows and ids
    rows += [(300, None, 1), (301, [1.0, None], 1), (302, [float("nan")] * 6, 1), (303, [float("inf")] * 6, 1), (None, [1.0] * 6, 1),
             (304, [1.0] * 6, None), (310, [], 1), (311, [], 1), (312, [], 0), (320, [1.0, 2.0], 0), (321, [1.0, 1.0], 0), (322, [0.5, 0.5], 1),
             (330, [-1.0, -2.0], 5), (331, [1.0, 1.0], 5), (340, [0.0] * 6, 3), (341, [0.0] * 6, 3)]
    return rows


@pytest.mark.parametrize("conf", [H.Mining(), TINY, H.Mining(positives=2, negatives=3, window=(0, 100), leaf=8, tree=32, block=5, group_bytes=9000)])
def test_mine_equals_plain(spark, conf):
    rows = sample()
    assert mined(spark.createDataFrame(rows, ROWS).repartition(3), conf) == plain(rows, conf)


def test_mine_small_tables(spark):
    assert mined(spark.createDataFrame([], ROWS), H.Mining()) == []
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.5], 1)]
    assert mined(spark.createDataFrame(rows, ROWS), H.Mining()) == []
    more = spark.createDataFrame(sample()[:60], ROWS).select("*", *[F.lit(1).alias(c) for c in ("id", "vector", "dim", "along", "Axes", "g", "anchor")])
    assert mined(more, TINY) == plain(sample()[:60], TINY)


def test_tiles_are_sorted_slabs():
    x = np.random.default_rng(1).integers(-50, 50, (200, 3)).astype(float)
    order = H.tile(x, [0, 1], 10)
    assert sorted(order) == list(range(200))
    slabs = [x[order[i:i + 40]] for i in range(0, 200, 40)]  # 20 leaves: 5 slabs of 4 leaves
    assert all(a[:, 0].max() <= b[:, 0].min() for a, b in zip(slabs, slabs[1:]))
    for s in slabs:
        leaves = [s[i:i + 10] for i in range(0, 40, 10)]
        assert all(a[:, 1].max() <= b[:, 1].min() for a, b in zip(leaves, leaves[1:]))


def probes(q, conf, low=H._LEAST, high=H._MOST, same=True):
    n = len(q)
    return H.Probes(q, np.full(n, -1), np.zeros(n, np.int64), np.full(n, low), np.full(n, high), np.full(n, H._LEAST), conf, same)


def test_boxes_bound_and_prune():
    g = np.random.default_rng(3)
    centre = g.normal(0, 200, (40, 16))
    x = np.floor(np.repeat(centre, 100, axis=0) + g.normal(0, 6, (4000, 16)))  # clusters, as embeddings have them
    conf = H.Mining(leaf=32)
    order = H.tile(x, [0, 1, 2], conf.leaf)
    tree = H.Tree(0, 0, np.arange(4000)[order], x[order], conf)
    q = x[:8]
    least, most = H.bounds(q, tree.low, tree.high)
    for j, a in enumerate(tree.leaf):
        s = q @ tree.x[a:a + conf.leaf].T
        assert (least[:, j] <= s.min(axis=1)).all() and (s.max(axis=1) <= most[:, j]).all()
    for low, high in ((H._LEAST, H._MOST), (0, 300_000)):
        p = probes(q, 5, low, high)
        p.search([tree])
        want = [sorted((-int(s), i) for i, s in enumerate(row) if low <= s <= high)[:5] for row in (q @ x.T)]
        assert p.best == want
        assert p.products < 0.5 * len(q) * len(x)  # over half of the products are never made


def test_equal_vectors_are_pruned_by_id():
    x = np.full((6400, 4), 3.0)
    tree = H.Tree(0, 0, np.arange(6400), x, H.Mining())
    p = probes(x[:1], 5)
    p.search([tree])
    assert p.best == [[(-36, i) for i in range(5)]] and p.products <= 64
