"""Bucketed merges, quarantine, observed writes, lost anchors, and model numbers that can fail."""

import re
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nextcat import queries as Q
from nextcat.config import FIXTURE_SPLIT, FeatureConfig, ModelConfig, SequenceConfig
from nextcat.operators.features import discover_pivot_values
from nextcat.operators.sequences import history_runs, rejected_anchors, split_counts, trailing_sequences
from nextcat.operators.tables import merge_bucketed, merge_tables, observe_counts, observe_keys, validate_keys
from nextcat.plans import model as M
from nextcat.plans.feature_store import build_feature_store
from nextcat.plans.supervised import supervised_sequences
from nextcat.session import scratch_path
from nextcat.sources import io as IO
from nextcat.sources.fixtures import TPCH_CONFIG, sparse_transactions, tpch_transactions

from conftest import SF_SMALL


# ---------------------------------------------------------------- J2 without a shuffle

def bucketed(spark, frames):
    out = []
    for n, df in enumerate(frames):
        path = scratch_path(spark, "t-bucket")
        name = "b_" + path.rsplit("-", 1)[1]
        IO.write_bucketed(df, name, path, ("k", "p"), 4)
        out.append(spark.table(name))
    return out


def test_bucketed_merge_has_no_exchange(spark):
    frames = [spark.range(40).select((F.col("id") % 13).alias("k"), (F.col("id") / 13).cast("int").cast("string").alias("p"), (F.col("id") * n).alias(f"v{n}"))
              for n in range(1, 6)]
    frames[2] = frames[2].where("k <> 3")
    merged = merge_bucketed(bucketed(spark, frames), ("k", "p"))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("Scan parquet", plan)) == 5 and "Exchange" not in plan and plan.count("SortMergeJoin") == 4
    want = merge_tables(frames, ("k", "p"))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, want.select(merged.columns).collect())) and merged.count() == 37


def test_bucketed_merge_of_null_and_repeated_keys(spark):
    kind = lambda v: f"k int, p string, {v} int"
    a = spark.createDataFrame([(1, "x", 1), (None, "x", 2), (2, "y", 3)], kind("a"))
    b = spark.createDataFrame([(1, "x", 4), (None, "x", 5)], kind("b"))
    assert [tuple(r) for r in merge_bucketed(bucketed(spark, [a, b]), ("k", "p")).collect()] == [(1, "x", 1, 4)]
    with pytest.raises(Exception, match="repeated key"):
        merge_bucketed(bucketed(spark, [a, b.union(b)]), ("k", "p")).collect()


# ---------------------------------------------------------------- quarantine

def test_quarantine_by_hand(spark, tmp_path):
    schema = T.StructType([T.StructField("customer_id", T.StringType()), T.StructField("timestamp", T.StringType()),
                           T.StructField("amount", T.DecimalType(6, 2)), T.StructField("is_online", T.IntegerType())])
    lines = ["customer_id,timestamp,amount,is_online", "C1,2025-01-02 03:04:05,10.50,1", "C2,2025-01-02,7,", ",,,", "C3,soon,1.00,0", "C4,2025-01-01,12345678.00,0",
             "C5,2025-01-01,1.005,2.5", "C6,2025-01-01", "C7,2025-01-01,1.00,1,extra", 'C8,"2025-01-01","1.00",0', "C9,2025-13-01,x,y"]
    (tmp_path / "t.csv").write_text("\n".join(lines) + "\n")
    good, bad = IO.quarantine_transactions_csv(spark, str(tmp_path / "t.csv"), scratch_path(spark, "t-quarantine"), schema)
    assert sorted((r.customer_id or "", str(r.timestamp), r.amount, r.is_online) for r in good.collect()) == [
        ("", "None", None, None), ("C1", "2025-01-02 03:04:05", Decimal("10.50"), 1), ("C2", "2025-01-02 00:00:00", Decimal("7.00"), None), ("C8", "2025-01-01 00:00:00", Decimal("1.00"), 0)]
    assert dict(good.dtypes) == {"customer_id": "string", "timestamp": "timestamp_ntz", "amount": "decimal(6,2)", "is_online": "int"}
    got = {r.record.split(",")[0]: r.reason for r in bad.collect()}
    assert got == {"C3": "timestamp: not timestamp", "C4": "amount: not decimal(6,2)", "C5": "amount: more than 2 decimals; is_online: not int",
                   "C6": "wrong number of fields", "C7": "wrong number of fields", "C9": "timestamp: not timestamp; amount: not decimal(6,2); is_online: not int"}
    assert "C7,2025-01-01,1.00,1,extra" in {r.record for r in bad.collect()}


# ---------------------------------------------------------------- checks inside the write

KEYS = ("customer_id", "order_key", "line_number")


def test_observed_keys_equal_validation_with_one_scan(spark):
    txns = sparse_transactions(spark, SF_SMALL)
    rows, seen = observe_keys(txns, KEYS)
    assert rows.columns == txns.columns
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 3  # lineitem, orders, part once each
    rows.write.parquet(scratch_path(spark, "t-observed"))
    bad = validate_keys(txns, KEYS).groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("keys")).collect()
    by = {r.kind: r for r in bad}
    assert seen.get == {"n_rows": txns.count(), "n_null_keys": by["null_key"].n, "n_repeated_keys": by["duplicate_key"].n - by["duplicate_key"]["keys"]}
    with pytest.raises(ValueError):
        observe_keys(txns, ("none",))


def test_observed_keys_of_stored_features_add_no_shuffle(spark):
    fs, _ = build_feature_store(tpch_transactions(spark, SF_SMALL), TPCH_CONFIG)
    count = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    rows, seen = observe_keys(fs)
    assert count(rows) == count(fs)
    rows.write.format("noop").mode("overwrite").save()
    assert seen.get == {"n_rows": fs.count(), "n_null_keys": 0, "n_repeated_keys": 0}


def test_observed_counts_equal_split_counts(spark):
    fs, cfg = build_feature_store(tpch_transactions(spark, SF_SMALL), TPCH_CONFIG)
    sup = supervised_sequences(fs, cfg, SequenceConfig(3), FIXTURE_SPLIT)
    rows, seen = observe_counts(sup, "split", ("train", "test", "predict", "none"))
    rows.write.format("noop").mode("overwrite").save()
    assert seen.get == {r.split: r.n for r in split_counts(sup).collect()} | {"none": 0}


# ---------------------------------------------------------------- anchors

def test_rejected_and_accepted_anchors_are_all(spark):
    rows = [("A", i) for i in (3, 4, 5, 9, 10, 12)] + [("B", 7)] + [("C", i) for i in range(4)]
    df = spark.createDataFrame(rows, "customer_id string, period_idx int").withColumn("x", F.lit(1.0))
    bad = rejected_anchors(df, seq_len=3)
    assert sorted(map(tuple, bad.collect())) == [
        ("A", 3, [1, 2], "short"), ("A", 4, [2], "short"), ("A", 9, [7, 8], "gap"), ("A", 10, [8], "gap"), ("A", 12, [11], "gap"),
        ("B", 7, [5, 6], "short"), ("C", 0, [-2, -1], "short"), ("C", 1, [-1], "short")]
    good = trailing_sequences(df, "customer_id", "period_idx", ["x"], 3).where("seq IS NOT NULL").select("customer_id", "period_idx")
    assert sorted(map(tuple, good.union(bad.select("customer_id", "period_idx")).collect())) == sorted(rows)
    assert [r[3] for r in rejected_anchors(spark.createDataFrame([("A", 1), ("A", 3)], "customer_id string, period_idx int"), seq_len=5).orderBy("period_idx").collect()] == ["short", "both"]
    assert sorted(map(tuple, history_runs(df).collect())) == [("A", 3, 5, 3), ("A", 9, 10, 2), ("A", 12, 12, 1), ("B", 7, 7, 1), ("C", 0, 3, 4)]


# ---------------------------------------------------------------- wide discovery

def test_wide_discovery_is_bounded(spark):
    df = spark.range(30).select(F.col("id").cast("string").alias("c"))
    assert len(discover_pivot_values(df, ["c"], 30)["c"]) == 30
    with pytest.raises(ValueError, match="build_feature_maps"):
        discover_pivot_values(df, ["c"], 29)


# ---------------------------------------------------------------- model numbers

@pytest.fixture(scope="module")
def trained(spark):
    fs, cfg = build_feature_store(tpch_transactions(spark, SF_SMALL), TPCH_CONFIG)
    path = scratch_path(spark, "t-model")
    supervised_sequences(fs, cfg, SequenceConfig(2), FIXTURE_SPLIT).write.parquet(path)
    names = M.feature_columns(M.rolled_features(fs, cfg), cfg)
    sup = spark.read.parquet(path)
    fit = lambda kind: M.train(sup, names, cfg.categories, ModelConfig(kind=kind, epochs=3, hidden_dim=5), 2)
    return sup, cfg, fit


@pytest.mark.parametrize("kind", ["mlp", "logistic", "centroid"])
def test_forward_pass_equals_the_model(trained, kind):
    sup, cfg, fit = trained
    res = fit(kind)
    rows = M.vectors(sup.where("split IN ('train', 'test')"), res.means, res.scales).select("features", "label", "split")
    own = {r.split: r for r in M.recomputed_scores(res, rows).collect()}
    for split in ("train", "test"):
        assert own[split].n == res.metrics[split]["n"] and own[split].accuracy == res.metrics[split]["accuracy"]
        assert own[split].log_loss == pytest.approx(res.metrics[split]["log_loss"], abs=1e-9)


def test_wrong_loss_or_class_is_not_ok(spark, trained):
    sup, cfg, fit = trained
    res = fit("logistic")
    preds = M.predict(res, sup, "customer_id", "2001-07")
    check = lambda p: [tuple(r)[2:] for r in Q._prediction_checks(p, res, sup).collect()]
    assert set(check(preds)) == {(True, True)}
    other = F.when(F.col("predicted_category") == "PROMO", "SMALL").otherwise("PROMO")
    assert set(check(preds.withColumn("predicted_category", other))) == {(False, True)}
    assert set(check(preds.withColumn("probabilities", F.transform("probabilities", lambda p: p + 1e-6)))) == {(True, False)}
    own = M.recomputed_scores(res, M.vectors(sup.where("split = 'test'"), res.means, res.scales).select("features", "label", "split")).first()
    assert abs(own.log_loss - (res.metrics["test"]["log_loss"] + 1e-6)) > 1e-9


def test_centroid_by_hand(spark):
    from pyspark.ml.linalg import Vectors
    rows = [(0.0, [0.0, 0.0]), (0.0, [0.0, 2.0]), (2.0, [4.0, 1.0])]
    df = spark.createDataFrame(
        [(l, Vectors.dense(v)) for l, v in rows], ["label", "features"])
    m = M.CentroidModel.fit(df, 2, 3)
    assert m.means == [[0.0, 1.0], [0.0, 0.0], [4.0, 1.0]] and m.counts == [2, 0, 1]
    out = m.transform(df).collect()
    assert [r.prediction for r in out] == [0.0, 0.0, 2.0] and all(r.probability[1] == 0 and abs(sum(r.probability) - 1) < 1e-12 for r in out)
    with pytest.raises(ValueError):
        ModelConfig(kind="centroid", report_every=2)
    assert replace(FeatureConfig(), max_wide=5).max_wide == 5
