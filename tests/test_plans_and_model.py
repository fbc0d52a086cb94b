"""Plan-shape, property and model tests on the sf0.001 fixture."""

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from nextcat.config import FIXTURE_SPLIT, ModelConfig, SequenceConfig
from nextcat.operators.scaling import fit_scaler, scale_sequences
from nextcat.operators.sequences import explode_steps, sequences_by_self_join
from nextcat.plans.feature_store import build_feature_store
from nextcat.operators.features import category_columns, payment_columns
from nextcat.plans.model import build_estimator, evaluate, train_and_predict, with_classes
from nextcat.plans.supervised import feature_columns, labelled, rolled_features, supervised_sequences
from nextcat.session import scratch_path
from nextcat.sources import io as IO
from nextcat.sources.fixtures import TPCH_CONFIG, tpch_transactions

from conftest import SF_SMALL

SEQ = SequenceConfig(seq_len=3)


@pytest.fixture(scope="module")
def fs(spark):
    return build_feature_store(tpch_transactions(spark, SF_SMALL), TPCH_CONFIG)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_plans(fs):
    f, cfg = fs
    sup = supervised_sequences(f, cfg, SEQ, FIXTURE_SPLIT)
    for df in (f, sup):
        p = _plan(df)
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_one_window_for_trends(fs):
    f, _ = fs
    p = f._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("Window [") == 1


def test_one_window_for_label_and_sequence(fs):
    f, cfg = fs
    plan = supervised_sequences(f, cfg, SEQ, FIXTURE_SPLIT)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 2  # lags of the feature table; label and sequence together
    assert plan.count("collect_list(") == 1


def test_source_is_computed_once(spark):
    """Staged, the source's tables are scanned by the staging job alone; the features and the discovery read what it wrote."""
    f, _ = build_feature_store(tpch_transactions(spark, SF_SMALL), TPCH_CONFIG)
    plan = f._jdf.queryExecution().optimizedPlan().toString()
    assert "Relation [" not in plan and plan.count("LogicalRDD [") == 2


def test_sequences_shuffle_once(spark, fs):
    f, cfg = fs
    path = scratch_path(spark, "t-once")
    IO.write_partitioned(f, path)
    p = _plan(supervised_sequences(IO.read_partitioned(spark, path), cfg, SEQ, FIXTURE_SPLIT))
    assert p.count("Exchange") == 1


def test_single_aggregate_equals_three_way_join(spark, fs):
    """The one-pass table against core aggregates and the two pivots built one by one and joined."""
    f, cfg = fs
    t = tpch_transactions(spark, SF_SMALL).withColumn("period", F.date_format("timestamp", "yyyy-MM"))
    keys = ["customer_id", "period"]
    core = t.groupBy(*keys).agg(F.sum("amount").cast("double").alias("total_spent"), F.count("amount").alias("txn_count"),
                                F.countDistinct("merchant_id").alias("unique_merchants"))
    cats = t.groupBy(*keys).pivot("category", list(cfg.categories)).agg(F.sum("amount").cast("double")).na.fill(0)
    pays = t.groupBy(*keys).pivot("payment_method", list(cfg.payments)).agg(F.count("amount")).na.fill(0)
    three = core.join(cats, keys).join(pays, keys).toDF(*keys, "total_spent", "txn_count", "unique_merchants", *category_columns(cfg), *payment_columns(cfg))
    one = f.select(*three.columns)
    assert one.count() == three.count() and one.exceptAll(three).count() == 0


def test_few_files_per_period(spark, fs):
    f, _ = fs
    path = scratch_path(spark, "t-files")
    IO.write_partitioned(f, path)
    df = IO.read_partitioned(spark, path)
    per = df.select("period", F.input_file_name().alias("file")).distinct().groupBy("period").count().agg(F.max("count")).first()[0]
    assert per == 1  # small periods are not split


def test_partition_filter_reaches_scan(spark, fs):
    f, _ = fs
    path = scratch_path(spark, "t-part")
    IO.write_partitioned(f, path)
    df = IO.read_partitioned(spark, path).where(F.col("period") >= "2001-01").select("customer_id", "total_spent")
    p = _plan(df)
    assert "PartitionFilters: [isnotnull(period" in p
    assert "ReadSchema: struct<customer_id:bigint,total_spent:double>" in p


def test_counts_match_fixture(fs):
    f, cfg = fs
    assert f.count() == 4664
    sup = supervised_sequences(f, cfg, SEQ, FIXTURE_SPLIT)
    counts = {r["split"]: r["count"] for r in sup.groupBy("split").count().collect()}
    assert counts == {"train": 729, "test": 9, "predict": 12}


def test_pivots_sum_to_totals(fs):
    f, cfg = fs
    cats = [c for c in f.columns if c.startswith("cat_")]
    pays = [c for c in f.columns if c.startswith("pay_")]
    bad = f.where((F.abs(sum(F.col(c) for c in cats) - F.col("total_spent")) > 1e-6)
                  | (sum(F.col(c) for c in pays) != F.col("txn_count"))).count()
    assert bad == 0


def test_window_equals_self_join(fs):
    f, cfg = fs
    rolled = rolled_features(f, cfg)
    names = feature_columns(rolled, cfg)
    w = explode_steps(labelled(rolled, cfg, SEQ).where("seq IS NOT NULL").select("customer_id", "period_idx", "seq"),
                      ["customer_id"], names)
    j = sequences_by_self_join(rolled, "customer_id", "period_idx", names, SEQ.seq_len).drop("step_idx")
    assert w.count() == j.count() == 799 * 3
    assert w.exceptAll(j.select(*w.columns)).count() == 0


def test_rollup_is_idempotent(fs):
    f, cfg = fs
    once = rolled_features(f, cfg)
    again = once.withColumn("period", F.date_format("period_start", "yyyy-MM")).drop("period_start", "period_idx")
    from nextcat.operators.tables import monthly_rollup
    twice = monthly_rollup(again, explicit={c: "sum" for c in again.columns if c.startswith(("cat_", "pay_"))})
    assert once.exceptAll(twice.select(*once.columns)).count() == 0


def test_scaled_train_features_standardised(fs):
    f, cfg = fs
    sup = supervised_sequences(f, cfg, SEQ, FIXTURE_SPLIT)
    names = feature_columns(rolled_features(f, cfg, strict=False), cfg)
    tr = sup.where("split = 'train'")
    means, scales = fit_scaler(tr, names)
    sc = scale_sequences(tr, means, scales)
    vals = sc.select(F.explode("seq_scaled").alias("x")).select(F.posexplode("x").alias("j", "v"))
    stats = vals.groupBy("j").agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).collect()
    for r in stats:
        assert abs(r["m"]) < 1e-9
        assert abs(r["s"] - 1) < 1e-9 or r["s"] == 0


def test_model_predictions(spark, fs):
    f, cfg = fs
    res, preds = train_and_predict(f, cfg, SEQ, FIXTURE_SPLIT, ModelConfig(epochs=5))
    rows = preds.collect()
    assert len(rows) == 12 and len({r["customer_id"] for r in rows}) == 12
    assert {r["predicted_category"] for r in rows} <= set(cfg.categories)
    assert res.metrics["test"]["n"] == 9 and 0 <= res.metrics["test"]["accuracy"] <= 1
    assert all(len(r["probabilities"]) == len(cfg.categories) and abs(sum(r["probabilities"]) - 1) < 1e-9 for r in rows)
    assert all(cfg.categories[r["probabilities"].index(max(r["probabilities"]))] == r["predicted_category"] for r in rows)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0  # nothing stays cached
    res2, preds2 = train_and_predict(f, cfg, SEQ, FIXTURE_SPLIT, ModelConfig(epochs=5))
    assert sorted(map(tuple, preds2.collect())) == sorted(map(tuple, rows))  # same seed, same predictions


def test_training_report(fs):
    f, cfg = fs
    for kind in ("mlp", "logistic"):
        res, _ = train_and_predict(f, cfg, SEQ, FIXTURE_SPLIT, ModelConfig(kind=kind, epochs=5, report_every=2))
        assert [(r["iteration"], r["split"]) for r in res.report] == [(i, s) for i in (2, 4, 5) for s in ("test", "train")]
        assert res.report[-1]["log_loss"] == pytest.approx(res.metrics["train"]["log_loss"])
    losses = [r["log_loss"] for r in res.report if r["split"] == "train"]
    assert losses == sorted(losses, reverse=True)


def test_settings_that_a_classifier_lacks_are_errors():
    ModelConfig(solver="gd", step_size=0.1), ModelConfig(kind="logistic", reg_param=0.1)
    for bad in ({"step_size": 0.1}, {"reg_param": 0.1}, {"kind": "other"}):
        with pytest.raises(ValueError):
            ModelConfig(**bad)


def test_logistic_knows_unseen_classes(spark):
    rows = [("train", float(i % 2), Vectors.dense([float(i % 2), 1.0])) for i in range(20)] + [("test", 2.0, Vectors.dense([0.5, 1.0]))]
    data = with_classes(spark.createDataFrame(rows, ["split", "label", "features"]), ["a", "b", "c"])
    model = build_estimator(ModelConfig(kind="logistic"), 2, 3).fit(data.where("split = 'train'"))
    assert model.numClasses == 3 and evaluate(model, data)["test"]["accuracy"] == 0


def test_logistic_alternative(fs):
    f, cfg = fs
    res, preds = train_and_predict(f, cfg, SEQ, FIXTURE_SPLIT, ModelConfig(kind="logistic", epochs=5))
    assert preds.count() == 12


def test_scan_dispatch_rejects_unknown(spark):
    with pytest.raises(ValueError):
        IO.read_table(spark, "/nonexistent/table.txt")
