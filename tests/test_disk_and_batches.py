"""Disk that jobs hold, results in batches, and model checks without a lambda per weight."""

import datetime as dt
import glob
import os
import time
from decimal import Decimal

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from nextcat import queries as Q
from nextcat.config import PERIOD_UNITS, FeatureConfig, ModelConfig, SequenceConfig, SplitConfig
from nextcat.functions.periods import parse_period, period_start
from nextcat.operators.scaling import scale_sequences
from nextcat.operators.sequences import in_full_runs
from nextcat.operators.tables import merge_batches, merge_tables
from nextcat.plans import model as M
from nextcat.plans import sparse as SP
from nextcat.plans.feature_store import build_feature_batches, build_feature_maps, build_feature_store, narrow_tables
from nextcat.session import STORING, cut, ensure_checkpoint_dir, scratch_path, storing
from nextcat.sources import io as IO

from conftest import SF_SMALL

KINDS = "customer_id string, timestamp timestamp_ntz, amount decimal(18,2), category string, merchant_id string, payment_method string, is_online int"
SPLIT = SplitConfig("2025-03", "2025-04", "2025-05")


@pytest.fixture(scope="module")
def txns(spark):
    rows = [(f"C{i % 17}", dt.datetime(2025, 1 + i // 17 % 4, 1 + i % 20), Decimal(i % 11), "ab"[i % 2], f"M{i % 3}", "card", i % 2) for i in range(300)]
    path = scratch_path(spark, "t-txns")
    spark.createDataFrame([*rows, (None, *rows[0][1:]), ("C0", None, *rows[0][2:]), (None, *rows[3][1:3], "only-null", *rows[3][4:])], KINDS).write.parquet(path)
    return spark.read.parquet(path)


def lines(df):
    return sorted(map(str, df.collect()))


def shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*.data")}


def names_in_scratch(spark):
    return set(os.listdir(ensure_checkpoint_dir(spark).removeprefix("file:")))


@pytest.mark.parametrize("job", ["cut", "partitioned", "stored"])
def test_written_jobs_leave_no_shuffle_files(spark, job):
    rows = spark.range(5000).withColumn("period", (F.col("id") % 3).cast("string")).repartition(5, "id")
    before = shuffle_files(spark)
    if job == "cut":
        assert cut(rows).count() == 5000
    elif job == "partitioned":
        IO.write_partitioned(rows, path := scratch_path(spark, "t-freed"))
        assert IO.read_partitioned(spark, path).count() == 5000
    else:
        with IO.stored(rows, "t-freed") as kept:
            assert kept.count() == 5000
    for _ in range(40):  # files go in the background
        left = {f for f in shuffle_files(spark) - before if os.path.exists(f) and os.path.getsize(f) > 10_000}
        if not left:
            break
        time.sleep(0.25)
    assert not left


def test_settings_come_back(spark):
    was = {k: spark.conf.get(k, None) for k in STORING}
    with pytest.raises(RuntimeError), storing(spark):
        assert all(spark.conf.get(k) == v for k, v in STORING.items())
        raise RuntimeError
    assert {k: spark.conf.get(k, None) for k in STORING} == was


def test_layer_is_one_product(spark):
    w, b, x = np.array([[1.0, -2.0, 0.5], [0.0, 3.0, 1e-3]]), [0.25, -1.0], [[1.0, 2.0, 3.0], [0.0, 0.0, 0.0], [-1e6, 0.5, 7.0]]
    df = spark.createDataFrame([(i, Vectors.dense(v)) for i, v in enumerate(x)], ["i", "features"])
    got = {r.i: list(r.z) for r in M.affine_column(df, "features", w, b, "z").collect()}
    assert [got[i] for i in range(3)] == [pytest.approx(list(w @ np.array(v) + np.array(b))) for v in x]
    assert M.affine_column(df, "features", w, b, "z").columns == ["i", "features", "z"]


@pytest.mark.parametrize("layers", [1, 2])
def test_forward_equals_the_model_without_a_lambda_per_weight(spark, layers):
    rng = np.random.default_rng(1)
    rows = [(float(i % 3), Vectors.dense(rng.normal(size=4) + i % 3), "train") for i in range(60)]
    data = M.with_classes(spark.createDataFrame(rows, ["label", "features", "split"]), "abc")
    model = M.build_estimator(ModelConfig(hidden_dim=5, num_layers=layers, epochs=4), 4, 3).fit(data)
    own = M.forward(M.TrainResult(model, [], [], [], tuple("abc"), {}, []), data)
    assert own.columns == [*data.columns, "probabilities"]
    plan = own._jdf.queryExecution().optimizedPlan().toString()
    assert "zip_with" not in plan
    for r in model.transform(own).collect():
        assert list(r.probability) == pytest.approx(r.probabilities, abs=1e-12)


def test_the_last_report_is_the_evaluation(spark, txns, monkeypatch):
    calls, real = [], M.evaluate
    monkeypatch.setattr(M, "evaluate", lambda *a, **k: calls.append(1) or real(*a, **k))
    fs, cfg = build_feature_store(txns, FeatureConfig())
    res, _ = M.train_and_predict(fs, cfg, SequenceConfig(2), SPLIT, ModelConfig(epochs=4, report_every=2, hidden_dim=3))
    assert len(calls) == 2 and {r["iteration"] for r in res.report} == {2, 4}
    last = {r["split"]: r["log_loss"] for r in res.report if r["iteration"] == 4}
    assert {s: res.metrics[s]["log_loss"] for s in ("train", "test")} == last


def test_batches_are_the_table(spark, txns):
    fs, cfg = build_feature_store(txns, FeatureConfig())
    batches, bcfg = build_feature_batches(txns, FeatureConfig(), batch_bytes=IO.input_bytes(txns) // 4)
    assert len(batches) > 3 and bcfg == cfg and "only-null" in cfg.categories
    base = scratch_path(spark, "t-batches")
    paths = IO.write_feature_store(batches, narrow_tables(batches[0], cfg), base)
    assert lines(IO.read_partitioned(spark, paths["feature_store"]).select(*fs.columns)) == lines(fs)
    tables = IO.read_narrow_tables(spark, paths)
    merged = merge_batches(tables, batch_bytes=sum(map(IO.input_bytes, tables)) // 3)
    assert len(merged) > 2
    assert sorted(x for m in merged for x in lines(m.select(*fs.columns))) == lines(merge_tables(tables).select(*fs.columns)) == lines(fs)
    one, p1 = M.train_and_predict(fs, cfg, SequenceConfig(2), SPLIT, ModelConfig(kind="centroid"))
    many, p2 = M.train_and_predict(merged, cfg, SequenceConfig(2), SPLIT, ModelConfig(kind="centroid"), dealt=True)
    assert one.metrics["counts"] == many.metrics["counts"] and min(many.metrics["counts"].values()) > 0
    assert sorted(r.customer_id for r in p1.collect()) == sorted(r.customer_id for r in p2.collect())


def test_rows_of_full_runs(spark):
    rows = [("A", i) for i in (1, 2, 3, 5, 6, 9, 10, 11, 12, 12)] + [("B", 1), ("B", 3), (None, 1), (None, 2), (None, 3)]
    df = spark.createDataFrame(rows, "customer_id string, period_idx int")
    got = sorted((str(r.customer_id), r.period_idx) for r in in_full_runs(df, "customer_id", "period_idx", 3).collect())
    assert got == [("A", 1), ("A", 2), ("A", 3), ("A", 9), ("A", 10), ("A", 11), ("A", 12), ("A", 12), ("None", 1), ("None", 2), ("None", 3)]
    assert in_full_runs(df, "customer_id", "period_idx", 1).count() == len(rows)


def test_sparse_entries_stay_where_they_lie(spark, txns):
    cfg = FeatureConfig()
    words = Q._kept(spark.createDataFrame([("category", v, i, f"cat_{v}") for i, v in enumerate(("a", "b", "only-null"))] + [("payment", "card", 0, "pay_card")],
                                          "pivot string, value string, class_index int, column_name string"), "t-words")
    rows = SP.sparse_rows(build_feature_maps(txns, cfg, keep_index=True), words, cfg)
    assert rows._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    seqs = SP.sparse_sequences(build_feature_maps(txns, cfg, keep_index=True), words, cfg, SequenceConfig(2), SPLIT)
    seqs = Q._kept(seqs, "t-seqs")
    scales = Q._kept(SP.sparse_scales(seqs.where("split = 'train'"), 2), "t-scales")
    vectors = SP.sparse_vectors(seqs, scales, cfg, 2, 100)
    assert vectors._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert vectors.count() == seqs.count() > 0


def test_intermediate_tables_are_removed(spark):
    before = names_in_scratch(spark)
    for name in ("sequence_self_join", "scan_dispatch", "merge_bucketed_tables", "merge_feature_tables"):
        assert Q.QUERIES[name](spark, SF_SMALL).count() > 0
    new = {n for n in names_in_scratch(spark) - before}
    assert not [n for n in new if n.startswith("transactions")]
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    for n in new:
        assert not os.path.exists(f"{root}/{n}/feature_store"), n
        if n.startswith("dispatch"):
            assert all(f.endswith(".csv.gz") for f in os.listdir(f"{root}/{n}/core.csv") if f.startswith("part"))


def test_scaling_calls_one_lambda_per_value(spark):
    df = spark.createDataFrame([([[1.0, 2.0], [3.0, None]],), ([],), (None,)], "seq array<array<double>>")
    got = scale_sequences(df, [1.0, 0.5], [3.0, 0.1])
    assert got._jdf.queryExecution().analyzed().toString().count("zip_with(") == 1
    assert [r.seq_scaled for r in got.collect()] == [[[0.0, (2.0 - 0.5) / 0.1], [(3.0 - 1.0) / 3.0, None]], [], None]


@pytest.mark.parametrize("unit", PERIOD_UNITS)
def test_period_starts_by_date_arithmetic(spark, unit):
    days = [dt.date(y, m, d) for y in (1969, 2000, 2024) for m in (1, 2, 3, 6, 12) for d in (1, 15, 28)] + [dt.date(2024, 2, 29), dt.date(2024, 12, 31), None]
    df = spark.createDataFrame([(d, d and dt.datetime(d.year, d.month, d.day, 23, 59, 59)) for d in days], "d date, t timestamp_ntz")
    rows = df.select(F.date_trunc(unit, "t").cast("date").alias("want"), period_start("t", unit).alias("a"), period_start("d", unit).alias("b"),
                     parse_period(F.col("d").cast("string"), unit).alias("c"))
    assert "date_trunc" not in df.select(period_start("t", unit), parse_period("d", unit))._jdf.queryExecution().analyzed().toString()
    assert all(r.want == r.a == r.b == r.c for r in rows.collect())
