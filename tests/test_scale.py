"""What is shuffled, how often, and that a task's share does not grow with the input."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from nextcat.config import FeatureConfig, SequenceConfig, SplitConfig
from nextcat.operators.sequences import sequences_by_self_join
from nextcat.operators.states import period_states, roll_states
from nextcat.operators import tables as T
from nextcat.operators.tables import merge_tables, monthly_rollup, validate_keys
from nextcat.plans.feature_store import build_feature_maps, build_feature_store, maps_from_states
from nextcat.plans.supervised import supervised_sequences
from nextcat.session import scratch_path
from nextcat.sources import io as IO
from nextcat.sources.fixtures import meet

KINDS = "customer_id string, timestamp timestamp_ntz, amount decimal(18,2), category string, merchant_id string, payment_method string, is_online int"


@pytest.fixture(scope="module")
def txns(spark):
    rows = [(f"C{i % 7}", dt.datetime(2025, 1 + i % 5, 1 + i % 20), Decimal(i % 11), "ab"[i % 2], f"M{i % 3}", "card", i % 2) for i in range(300)]
    return spark.createDataFrame([*rows, (None, *rows[0][1:]), ("C0", None, *rows[0][2:]), ("D", dt.datetime(2025, 1, 1), Decimal(1), "a", None, "card", 1)], KINDS)


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_features_shuffle_raw_rows_only(spark, txns):
    fs, _ = build_feature_store(txns, FeatureConfig())
    assert exchanges(fs) == 2  # the rows, and the merchants' three columns of them; no aggregate and no window of its own
    got = {(r.customer_id, r.period): r.unique_merchants for r in fs.collect()}
    assert got[("D", "2025-01")] == 0 and got[("C1", "2025-01")] == len({i % 3 for i in range(300) if i % 7 == 1 and i % 5 == 0})
    assert len(got) == 36


def test_merge_and_roll_up_in_one_shuffle(spark, txns):
    fs, _ = build_feature_store(txns, FeatureConfig())
    base = scratch_path(spark, "t-merge")
    parts = [["total_spent", "txn_count"], ["cat_a", "cat_b"], ["prev_total_spent"]]
    tables = []
    for n, cols in enumerate(parts):
        IO.write_partitioned(fs.select("customer_id", "period", *cols), f"{base}/{n}")
        tables.append(IO.read_partitioned(spark, f"{base}/{n}"))
    merged = merge_tables(tables, deal_by="customer_id")
    assert exchanges(monthly_rollup(merged)) == 1
    want = fs.select("customer_id", "period", *sum(parts, []))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, want.collect())) == sorted(map(tuple, merge_tables(tables).collect()))


def test_merge_of_tables_with_keys_alone(spark):
    a = spark.createDataFrame([("A", "p"), ("B", "p")], "customer_id string, period string")
    b = spark.createDataFrame([("A", "p", 1), ("C", "p", 2)], "customer_id string, period string, v int")
    assert [tuple(r) for r in merge_tables([a, b]).collect()] == [("A", "p", 1)]


def test_buckets_and_tasks_follow_the_input(spark):
    path = scratch_path(spark, "t-tasks")
    spark.range(20_000).write.parquet(path)
    one = spark.read.parquet(path)
    spark.range(200_000).write.mode("append").parquet(path)
    more = spark.read.parquet(path)
    assert IO.tasks_for(more, 4096) > 5 * IO.tasks_for(one, 4096) > 0
    assert IO.tasks_for(one) == IO.bucket_count(one) == spark.sparkContext.defaultParallelism
    assert IO.tasks_for(spark.createDataFrame([(1,)], "a int")) is None and IO.bucket_count(spark.createDataFrame([(1,)], "a int")) == 8


def test_keys_are_counted_in_as_many_tasks_as_the_files_need(spark, monkeypatch):
    path = scratch_path(spark, "t-keys")
    rows = [(i % 90 if i % 10 else None, i % 3, "x" * 20) for i in range(100)]
    spark.createDataFrame(rows, "a int, b int, wide string").write.parquet(path)
    monkeypatch.setattr(T, "tasks_for", lambda df: 37)
    bad = validate_keys(spark.read.parquet(path), ("a", "b"))
    plan = bad._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and ", 37), REPARTITION_BY_NUM" in plan
    assert "HashAggregate" not in plan[plan.index("Exchange hashpartitioning"):]  # no task holds its rows' keys before the shuffle as well
    want = {}
    for a, b, _ in rows:
        want[a, b] = want.get((a, b), 0) + 1
    want = {("null_key" if a is None else "duplicate_key", a, b, n) for (a, b), n in want.items() if a is None or n > 1}
    assert {tuple(r) for r in bad.collect()} == want and {k for k, *_ in want} == {"null_key", "duplicate_key"}


def test_larger_tables_meet_in_as_many_tasks_as_the_files_need(spark):
    base = scratch_path(spark, "t-meet")
    left = [(i % 50 if i % 7 else None, i) for i in range(400)] + [(999, -1)]
    right = [(i // 2 if i % 9 else None, f"r{i}") for i in range(60)]  # most keys twice, some NULL
    spark.createDataFrame(left, "k long, v long").write.parquet(f"{base}/l")
    spark.createDataFrame(right, "rk long, w string").write.parquet(f"{base}/r")
    li, other = spark.read.parquet(f"{base}/l"), spark.read.parquet(f"{base}/r")
    met = meet(li, other, "k", "rk", small=0, task_bytes=64)
    tasks = IO.tasks_for(met, 64)
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert tasks > 8 and plan.count(f", {tasks}), REPARTITION_BY_NUM") == 2 and plan.count("Exchange") == 2 and "SortMergeJoin" in plan
    plain = meet(li, other, "k", "rk")
    assert "REPARTITION_BY_NUM" not in plain._jdf.queryExecution().executedPlan().toString()  # the planner's choice
    want = sorted((k, v, rk, w) for k, v in left for rk, w in right if k is not None and k == rk)
    assert sorted(map(tuple, met.collect())) == sorted(map(tuple, plain.collect())) == want


def test_sequences_of_a_build_add_no_shuffle(spark, txns):
    fs, cfg = build_feature_store(txns, FeatureConfig())
    split = SplitConfig("2025-02", "2025-03", "2025-05")
    sup = supervised_sequences(fs, cfg, SequenceConfig(2), split, dealt=True)
    assert exchanges(sup) == exchanges(fs) == 2
    assert sorted(map(str, sup.collect())) == sorted(map(str, supervised_sequences(fs, cfg, SequenceConfig(2), split).collect()))


def test_self_join_counts_steps_by_keys_alone(spark):
    df = spark.createDataFrame([("A", i, float(i)) for i in (1, 2, 3, 5, 6, 9)] + [("B", 1, 0.0)], "customer_id string, period_idx int, v double")
    j = sequences_by_self_join(df, "customer_id", "period_idx", ["v"], 2)
    plan = j._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Window ["):]
    assert "v#" not in below.split("Join")[0].split("\n")[0] and plan.index("Join") < plan.index("Window [")  # the wide join is above the window
    assert sorted((r.customer_id, r.period_idx, r.step, r.v) for r in j.collect()) == [
        ("A", 2, 0, 1.0), ("A", 2, 1, 2.0), ("A", 3, 0, 2.0), ("A", 3, 1, 3.0), ("A", 6, 0, 5.0), ("A", 6, 1, 6.0)]


@pytest.mark.parametrize("many", [True, False])
def test_states_shuffle_once(spark, txns, many):
    cfg = FeatureConfig(many_entities=many)
    maps = build_feature_maps(txns, cfg)
    assert exchanges(maps) == (1 if many else 3)
    day = FeatureConfig(period_unit="day", require_pivot_rows=False, many_entities=many)
    rolled = roll_states(period_states(txns, day), day, "month")
    rows = lambda df: sorted(map(str, df.drop("unique_merchants").collect()))
    assert rows(maps_from_states(rolled, cfg)) == rows(build_feature_maps(txns, FeatureConfig(require_pivot_rows=False)))
