"""Versioned tables, the growing dictionary, and refreshes of both kinds."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from nextcat.config import FeatureConfig, SequenceConfig
from nextcat.functions.periods import canonical_period
from nextcat.operators import dictionary as D
from nextcat.operators.features import category_columns
from nextcat.plans.feature_store import build_feature_store
from nextcat.plans.supervised import labelled, rolled_features
from nextcat.session import scratch_path
from nextcat.sources import io as IO
from nextcat.sources import versioned as V
from nextcat.streaming import incremental as I

TXN = "customer_id string, timestamp timestamp_ntz, amount decimal(18,2), category string, merchant_id string, payment_method string, is_online int"


def txns(spark, rows):
    return spark.createDataFrame([(c, dt.datetime.fromisoformat(t), Decimal(a), k, "M", "card", 1) for c, t, a, k in rows], TXN)


BASE = [("C1", "2025-01-05", 10, "a"), ("C1", "2025-02-05", 20, "b"), ("C1", "2025-03-05", 30, "a"), ("C2", "2025-03-06", 5, "b")]
RAISED = [(c, t, a + 1, k) for c, t, a, k in BASE]


@pytest.mark.parametrize("since", ["2025-02", "2025-02-15", "2025-2", " 2025-02-01 00:00:00"])
@pytest.mark.parametrize("kind", ["plain", "store"])
def test_refresh_from_any_form_of_since(spark, since, kind):
    old, new = txns(spark, BASE), txns(spark, RAISED)
    path = scratch_path(spark, "t-since")
    if kind == "plain":
        fs, cfg = build_feature_store(old, FeatureConfig())
        IO.write_partitioned(fs, path)
        I.refresh_since(new, cfg, path, since)
        got = IO.read_partitioned(spark, path)
    else:
        I.create_store(old, FeatureConfig(), path)
        I.refresh_store(new, FeatureConfig(), path, since)
        got, _ = I.read_store(spark, path)
    rows = {(r.customer_id, r.period): (r.total_spent, r.prev_total_spent) for r in got.collect()}
    assert rows == {("C1", "2025-01"): (10, 0), ("C1", "2025-02"): (21, 10), ("C1", "2025-03"): (31, 21), ("C2", "2025-03"): (6, 0)}


@pytest.mark.parametrize("since", ["soon", "2025-13", ""])
def test_refresh_from_no_period_is_an_error(spark, since):
    with pytest.raises(ValueError):
        canonical_period(spark, since, "month")


def test_refresh_removes_emptied_periods_by_index(spark):
    path = scratch_path(spark, "t-emptied")
    I.create_store(txns(spark, BASE), FeatureConfig(), path)
    I.refresh_store(txns(spark, [r for r in BASE if r[1] != "2025-02-05"]), FeatureConfig(), path, "2025-2-10")
    rows = {(r.customer_id, r.period): r.prev_total_spent for r in I.read_store(spark, path)[0].collect()}
    assert rows == {("C1", "2025-01"): 0, ("C1", "2025-03"): 10, ("C2", "2025-03"): 0}


def test_new_category_keeps_indices_columns_and_old_rows(spark):
    path = scratch_path(spark, "t-grow")
    cfg = I.create_store(txns(spark, BASE), FeatureConfig(), path)
    assert cfg.categories == ("a", "b") and category_columns(cfg) == ["cat_a", "cat_b"]
    late = [*BASE, ("C1", "2025-03-07", 100, "A"), ("C1", "2025-04-01", 7, "0 new"), ("C2", "2025-04-02", 9, "diversity")]
    cfg = I.refresh_store(txns(spark, late), FeatureConfig(category_prefix="cat_"), path, "2025-03")
    # 'A' would be cat_A, which an entry has in another case
    assert cfg.categories == ("a", "b", "0 new", "A", "diversity")
    assert category_columns(cfg) == ["cat_a", "cat_b", "cat_0_new", "cat_A_d3d99e8b", "cat_diversity"]
    fs, cfg = I.read_store(spark, path)
    rows = {(r.customer_id, r.period): tuple(r[c] for c in category_columns(cfg)) for r in fs.collect()}
    assert rows == {("C1", "2025-01"): (10, 0, 0, 0, 0), ("C1", "2025-02"): (0, 20, 0, 0, 0), ("C1", "2025-03"): (30, 0, 0, 100, 0),
                    ("C2", "2025-03"): (0, 5, 0, 0, 0), ("C1", "2025-04"): (0, 0, 7, 0, 0), ("C2", "2025-04"): (0, 0, 0, 0, 9)}
    assert I.read_store(spark, path, version=1)[0].count() == 4 and "cat_A_d3d99e8b" not in I.read_store(spark, path, version=1)[0].columns
    # a rebuild from fewer rows keeps every class and column
    again = I.create_store(txns(spark, BASE[:1]), FeatureConfig(), path)
    assert (again.categories, again.category_names) == (cfg.categories, cfg.category_names)


def test_ties_go_to_the_first_name_whatever_its_class(spark):
    path = scratch_path(spark, "t-ties")
    I.create_store(txns(spark, [("C1", "2025-01-05", 10, "b")]), FeatureConfig(), path)
    I.refresh_store(txns(spark, [("C1", "2025-02-05", 10, "b"), ("C1", "2025-02-06", 10, "a")]), FeatureConfig(), path, "2025-02")
    fs, cfg = I.read_store(spark, path)
    assert cfg.categories == ("b", "a")
    rows = labelled(rolled_features(fs, cfg), cfg, SequenceConfig(1)).orderBy("period_idx").collect()
    assert [r.top_category for r in rows] == ["b", "a"]


def test_failure_before_the_commit_leaves_the_old_table(spark, monkeypatch):
    path = scratch_path(spark, "t-atomic")
    I.create_store(txns(spark, BASE), FeatureConfig(), path)
    before = sorted(map(tuple, I.read_store(spark, path)[0].collect()))

    def stop(*args):
        raise OSError("stopped")
    monkeypatch.setattr(V, "_publish", stop)
    with pytest.raises(OSError):
        I.refresh_store(txns(spark, RAISED[2:]), FeatureConfig(), path, "2025-02")  # February goes, March changes
    monkeypatch.undo()
    assert sorted(map(tuple, I.read_store(spark, path)[0].collect())) == before
    I.refresh_store(txns(spark, RAISED[2:]), FeatureConfig(), path, "2025-02")
    assert sorted((r.period, r.total_spent) for r in I.read_store(spark, path)[0].collect()) == [("2025-01", 10), ("2025-03", 6), ("2025-03", 31)]
    assert len(V.vacuum(spark, f"{path}/feature_store", keep=1)) == 1  # what the stopped attempt left
    assert I.read_store(spark, path)[0].count() == 3


def test_second_writer_from_one_version_fails(spark):
    path = scratch_path(spark, "t-two")
    df = spark.createDataFrame([("2025-01", 1)], "period string, x int")
    base = V.commit(df, path)
    V.commit(df.withColumn("x", F.lit(2)), path, base=base)
    with pytest.raises(V.CommitConflict):
        V.commit(df.withColumn("x", F.lit(3)), path, base=base)
    assert [r.x for r in V.read_current(spark, path).collect()] == [2]


def test_versions_schema_and_pruning(spark):
    path = scratch_path(spark, "t-versions")
    V.commit(spark.createDataFrame([("2025-01", 1), ("2025-02", 2), ("a/b=c", 9)], "period string, x int"), path)
    V.commit(spark.createDataFrame([("2025-02", 3, 1.5)], "period string, x int, y double"), path, replace="partitions", remove=["a/b=c", "none"])
    rows = lambda **k: sorted(map(tuple, V.read_current(spark, path, **k).select("period", *[c for c in ("x", "y") if c in V.read_current(spark, path, **k).columns]).collect()))
    assert rows() == [("2025-01", 1, None), ("2025-02", 3, 1.5)] and rows(fill=True) == [("2025-01", 1, 0.0), ("2025-02", 3, 1.5)]
    assert rows(version=1) == [("2025-01", 1), ("2025-02", 2), ("a/b=c", 9)]
    assert sorted(map(tuple, V.partition_counts(spark, path).select("period", "n", "version").collect())) == [("2025-01", 1, 1), ("2025-02", 1, 2)]
    with pytest.raises(ValueError, match="is stored as"):
        V.commit(spark.createDataFrame([("2025-03", "t")], "period string, x string"), path, replace="partitions")
    plan = V.read_current(spark, path).where("period = '2025-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan
    V.commit(spark.createDataFrame([], "period string, x int"), path)
    assert V.read_current(spark, path).collect() == []
    with pytest.raises(ValueError):
        V.read_current(spark, scratch_path(spark, "none"))


def test_dictionary_is_append_only(spark):
    path, cfg = scratch_path(spark, "t-dict"), FeatureConfig()
    values = lambda *vs: txns(spark, [("C", "2025-01-01", 1, v) for v in vs])
    assert D.extend_dictionary(values("m", "x y", "x-y", None), cfg, path) == 4  # three categories, one payment method
    first = {(r.pivot, r.value): (r.class_index, r.column_name) for r in D.read_dictionary(spark, path).collect()}
    assert first[("category", "m")] == (0, "cat_m") and first[("payment", "card")] == (0, "pay_card")
    assert first[("category", "x y")][1] != first[("category", "x-y")][1] and first[("category", "x y")][1].startswith("cat_x_y_")
    assert D.extend_dictionary(values("m", "x y"), cfg, path) == 0
    assert D.extend_dictionary(values("a", "M", "x.y", "m"), cfg, path) == 3
    after = {(r.pivot, r.value): (r.class_index, r.column_name) for r in D.read_dictionary(spark, path).collect()}
    assert {k: after[k] for k in first} == first
    assert [after[("category", v)][0] for v in ("M", "a", "x.y")] == [3, 4, 5]
    assert len({n.lower() for _, n in after.values()}) == len(after)
