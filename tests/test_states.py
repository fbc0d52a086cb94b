"""Mergeable states, map pivots and sparse vectors by hand and against the wide forms."""

import datetime as dt
import statistics
from dataclasses import replace
from decimal import Decimal

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from nextcat.config import FIXTURE_SPLIT, FeatureConfig, SequenceConfig, SplitConfig
from nextcat.operators import states as S
from nextcat.operators.dictionary import ENTRY, entries, pivot_values
from nextcat.plans import sparse as SP
from nextcat.plans.feature_store import build_feature_maps, build_feature_store, maps_from_states
from nextcat.session import scratch_path
from nextcat.sources.fixtures import TPCH_CONFIG, tpch_transactions

from conftest import SF_SMALL

TXN = "customer_id string, timestamp timestamp_ntz, amount decimal(18,2), category string, merchant_id string, payment_method string, is_online int"
ROWS = [("C", "2025-01-01", "10.50", "b", "M1", "card", 1), ("C", "2025-01-01", "-3.25", "a", "M1", "upi", None), ("C", "2025-01-20", "7.00", "a", "M2", "card", 0),
        ("C", "2025-01-20", None, "c", "M1", None, 1), ("C", "2025-01-21", "1.00", None, None, "card", None), ("C", "2025-02-02", "5.00", "a", "M3", "card", None),
        ("D", "2025-01-03", "2.00", "a", "M1", None, 1), (None, "2025-01-03", "2.00", "a", "M1", "card", 1)]


@pytest.fixture(scope="module")
def txns(spark):
    rows = [(c, dt.datetime.fromisoformat(t), None if a is None else Decimal(a), *rest) for c, t, a, *rest in ROWS]
    return spark.createDataFrame(rows, TXN)


def rows(df):
    return {(r.customer_id, r.period): r.asDict() for r in df.collect()}


def test_maps_by_hand(txns):
    got = rows(build_feature_maps(txns, FeatureConfig()))
    assert set(got) == {("C", "2025-01"), ("C", "2025-02")}  # D has no payment method, the NULL customer no key
    jan = got[("C", "2025-01")]
    assert list(jan["category_spend"].items()) == [("a", 3.75), ("b", 10.5), ("c", 0.0)] and jan["category_diversity"] == 2
    assert jan["payment_count"] == {"card": 3, "upi": 1}
    amounts = [10.5, -3.25, 7.0, 1.0]
    assert (jan["total_spent"], jan["txn_count"], jan["min_spent"], jan["max_spent"]) == (15.25, 4, -3.25, 10.5)
    assert jan["spend_std_dev"] == pytest.approx(statistics.stdev(amounts), rel=1e-14) and jan["online_ratio"] == pytest.approx(2 / 3)
    assert jan["unique_merchants"] == 2
    feb = got[("C", "2025-02")]
    assert (feb["spend_std_dev"], feb["online_ratio"], feb["prev_total_spent"], feb["online_ratio_change"]) == (0, 0, 15.25, 0)


@pytest.mark.parametrize("required", [True, False])
def test_maps_equal_the_wide_build(txns, required):
    cfg = FeatureConfig(require_pivot_rows=required)
    wide, full = build_feature_store(txns, cfg)
    maps = build_feature_maps(txns, cfg)
    flat = S.wide_pivots(S.wide_pivots(maps, "category_spend", full.categories, ["cat_a", "cat_b", "cat_c"]), "payment_count", full.payments, ["pay_card", "pay_upi"])
    want, got = rows(wide), rows(flat)
    assert set(want) == set(got)
    assert all(got[k][c] == pytest.approx(v, rel=1e-12) if isinstance(v, float) else got[k][c] == v for k, r in want.items() for c, v in r.items())


def test_days_merge_to_the_month(spark, txns):
    day = FeatureConfig(period_unit="day", require_pivot_rows=False)
    states = S.period_states(txns, day)
    month = FeatureConfig()
    direct, rolled = rows(build_feature_maps(txns, month)), rows(maps_from_states(S.roll_states(states, replace(month, period_unit="day"), "month"), month))
    assert rolled == direct
    # in two steps, and from halves of the rows, the states are the same
    weeks = S.roll_states(S.period_states(txns.where("merchant_id = 'M1'"), day).unionByName(S.period_states(txns.where("merchant_id <> 'M1' OR merchant_id IS NULL"), day)), day, "day")
    exact = [c for c in states.columns if c not in ("unique_merchants", "merchant_sketch")]
    assert sorted(map(str, weeks.select(exact).collect())) == sorted(map(str, states.select(exact).collect()))
    empty = S.roll_states(S.period_states(txns.limit(0), day), day, "year")
    assert empty.columns == states.columns and empty.collect() == []


def test_std_of_large_and_close_amounts(spark):
    base = 90_000_000_000_000
    units = [base + x for x in (1, 2, 4, 8)]
    df = spark.createDataFrame([(len(units), sum(units), Decimal(sum(u * u for u in units)))], "n long, s long, q decimal(38,0)")
    got = df.select(S.sample_std(F.col("n"), F.col("s"), F.col("q")).alias("v")).first().v
    assert got == pytest.approx(statistics.stdev([1, 2, 4, 8]), rel=1e-12)  # doubles alone would lose all digits


def test_no_discovery_and_one_scan(spark):
    maps = build_feature_maps(tpch_transactions(spark, SF_SMALL), TPCH_CONFIG)  # no job has run: nothing is collected to build the plan
    plan = maps._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 3  # lineitem, orders, part once each
    assert "sum(CASE WHEN" not in plan.replace("sum(CASE WHEN (kind", "")  # no aggregate per value


def test_sketch_error_bound(spark):
    n = 30_000
    t = spark.range(n).select(F.lit("C").alias("customer_id"), F.timestamp_seconds(F.col("id") % 300 * 86400).cast("timestamp_ntz").alias("timestamp"),
                              F.lit(1).cast("decimal(18,2)").alias("amount"), F.lit("a").alias("category"), (F.col("id") % 20_000).alias("merchant_id"),
                              F.lit("p").alias("payment_method"), F.lit(1).alias("is_online"))
    cfg = FeatureConfig(period_unit="day")
    rolled = S.roll_states(S.period_states(t, cfg), cfg, "year")
    assert abs(rolled.select(F.hll_sketch_estimate("merchant_sketch")).first()[0] - 20_000) <= 4 * S.sketch_error() * 20_000
    assert S.period_states(t, cfg).agg(F.sum("unique_merchants")).first()[0] == n  # daily counts count twice


def test_sparse_vectors_equal_dense_and_train(spark):
    txn = tpch_transactions(spark, SF_SMALL)
    words = entries(pivot_values(txn, TPCH_CONFIG), spark.createDataFrame([], ENTRY), TPCH_CONFIG)
    maps = build_feature_maps(txn, TPCH_CONFIG, keep_index=True)
    path = scratch_path(spark, "t-sparse")
    SP.sparse_sequences(maps, words, TPCH_CONFIG, SequenceConfig(2), FIXTURE_SPLIT).write.parquet(path)
    seqs = spark.read.parquet(path)
    scales = SP.sparse_scales(seqs.where("split = 'train'"), 2)
    plain = SP.plain_columns(maps, TPCH_CONFIG)
    size = SP.vector_size(words, plain, 2)
    assert size == 2 * (len(plain) + 12)
    v = SP.store_vectors(SP.sparse_vectors(seqs, scales, TPCH_CONFIG, 2, size), scratch_path(spark, "t-vectors"))
    assert v.count() == seqs.count()
    train = v.where("split = 'train'")
    dense = np.array([r.a for r in train.select(vector_to_array("features").alias("a")).collect()])
    raw = np.zeros((len(dense) * 2, size // 2))
    for k, r in enumerate(seqs.where("split = 'train'").select("seq").collect()):
        for s, step in enumerate(r.seq):
            for e in step:
                raw[2 * k + s, e.i] = e.x
    std = raw.std(axis=0)
    got = {r.i: r["std"] for r in scales.collect()}
    assert all(got[i] == pytest.approx(std[i], rel=1e-9, abs=1e-9) for i in got) and all(std[i] == 0 for i in range(size // 2) if i not in got)
    assert dense[:, ::2].std(axis=0).max() < 2 and (dense != 0).mean() < 0.8
    model = LogisticRegression(regParam=0.1, maxIter=5, standardization=False).fit(train)
    assert model.numFeatures == size and model.transform(v.where("split = 'predict'")).count() > 0


def test_sparse_sequences_skip_gaps_and_unknown_values_fail(spark, txns):
    cfg, split = FeatureConfig(), SplitConfig("2025-02", "2025-03", "2025-03")
    maps = build_feature_maps(txns, cfg, keep_index=True)
    words = entries(pivot_values(txns, cfg), spark.createDataFrame([], ENTRY), cfg)
    rows = SP.sparse_sequences(maps, words, cfg, SequenceConfig(2), split).collect()
    assert [(r.customer_id, r.period, r.split, len(r.seq)) for r in rows] == [("C", "2025-02", "predict", 2)]
    places = {r.feature: r.i for r in SP.feature_places(words, SP.plain_columns(maps, cfg)).collect()}
    assert {e.i: e.x for e in rows[0].seq[1]}[places["cat_a"]] == 5.0 and places["pay_upi"] == places["cat_b"] + 1
    with pytest.raises(Exception, match="without a dictionary entry"):
        SP.sparse_sequences(maps, words.where("value <> 'a'"), cfg, SequenceConfig(2), split).collect()
