"""Hand-computed edge cases (gap, first month, single transaction, NULL
category / amount / key, zero total, refund, ties)."""

import datetime as dt
from decimal import Decimal

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from nextcat.config import FeatureConfig, SequenceConfig
from nextcat.operators.features import category_columns, payment_columns
from nextcat.operators.labels import check_periods, invalid_periods
from nextcat.operators.tables import merge_tables, monthly_rollup
from nextcat.operators.trends import number_transactions, period_gaps, range_sorted, running_balance
from nextcat.plans.feature_store import build_feature_store, narrow_tables
from nextcat.plans.supervised import feature_columns, labelled, rolled_features
from nextcat.session import scratch_path
from nextcat.sources import io as IO
from nextcat.streaming.incremental import refresh_since

ROWS = [
    ("C1", "2025-08-03", 10, "a", "M1", "card", 1),
    ("C1", "2025-08-09", 10, "b", "M1", "upi", 0),
    ("C1", "2025-09-05", 20, "b", "M2", "upi", 1),
    ("C1", "2025-11-02", 5, "a", "M3", "card", 0),
    ("C1", "2025-11-03", -5, "a", "M3", "card", 0),
    ("C2", "2025-08-04", 7, None, "M1", "card", 1),
    ("C2", "2025-09-04", None, "a", "M1", "card", 1),
    (None, "2025-09-01", 9, "a", "M1", "card", 0),
    ("C3", "2025-08-01", 3, "a", "M1", "card", 0),
    ("C3", "2025-09-01", 4, "b", "M2", "card", 0),
    ("C3", "2025-10-01", 6, "a", "M1", "upi", 1),
]

# The feature columns in table order.
COLS = ["total_spent", "txn_count", "avg_spent", "min_spent", "max_spent", "spend_std_dev", "online_ratio",
        "unique_merchants", "avg_spend_per_txn", "max_txn_ratio", "cat_a", "cat_b", "category_diversity",
        "pay_card", "pay_upi", "prev_total_spent", "prev_txn_count", "prev_online_ratio", "spend_growth",
        "txn_growth", "online_ratio_change"]

EXPECTED = {
    ("C1", "2025-08"): [20, 2, 10, 10, 10, 0, 0.5, 1, 10, 0.5, 10, 10, 2, 1, 1, 0, 0, 0, 0, 0, 0],
    ("C1", "2025-09"): [20, 1, 20, 20, 20, 0, 1, 1, 20, 1, 0, 20, 1, 0, 1, 20, 2, 0.5, 0, -1, 0.5],
    ("C1", "2025-11"): [0, 2, 0, -5, 5, 7.071068, 0, 1, 0, 0, 0, 0, 0, 2, 0, 20, 1, 1, -20, 1, -1],
    ("C2", "2025-09"): [0, 0, 0, 0, 0, 0, 1, 1, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0],
    ("C3", "2025-08"): [3, 1, 3, 3, 3, 0, 0, 1, 3, 1, 3, 0, 1, 1, 0, 0, 0, 0, 0, 0, 0],
    ("C3", "2025-09"): [4, 1, 4, 4, 4, 0, 0, 1, 4, 1, 0, 4, 1, 1, 0, 3, 1, 0, 1, 0, 0],
    ("C3", "2025-10"): [6, 1, 6, 6, 6, 0, 1, 1, 6, 1, 6, 0, 1, 0, 1, 4, 1, 0, 2, 0, 1],
}


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(c, dt.datetime.fromisoformat(t), None if a is None else Decimal(a), cat, m, p, o)
            for c, t, a, cat, m, p, o in ROWS]
    return spark.createDataFrame(rows, "customer_id string, timestamp timestamp_ntz, amount decimal(18,2), "
                                       "category string, merchant_id string, payment_method string, is_online int")


@pytest.fixture(scope="module")
def store(edge):
    return build_feature_store(edge, FeatureConfig())


def test_feature_store_values(store):
    fs, cfg = store
    assert cfg.categories == ("a", "b") and cfg.payments == ("card", "upi")
    got = {(r["customer_id"], r["period"]): r for r in fs.collect()}
    assert set(got) == set(EXPECTED)  # C2/2025-08 (only NULL category) and the NULL key are absent
    for key, exp in EXPECTED.items():
        for col, e in zip(COLS, exp):
            assert got[key][col] == pytest.approx(e, abs=1e-6), (key, col)


def test_cross_checks(store):
    fs, _ = store
    for r in fs.collect():
        if r["customer_id"] != "C2":  # the NULL-amount row breaks the count identity by design
            assert r["pay_card"] + r["pay_upi"] == r["txn_count"]
        assert r["avg_spend_per_txn"] == r["avg_spent"]


def test_labels_and_sequences(store):
    fs, cfg = store
    rolled = rolled_features(fs, cfg)
    lab = labelled(rolled, cfg, SequenceConfig(seq_len=2)).collect()
    labels = {(r["customer_id"], r["period_start"].strftime("%Y-%m")): r["target_category"]
              for r in lab if r["target_category"] is not None}
    assert labels == {("C1", "2025-08"): "b", ("C1", "2025-09"): "a", ("C3", "2025-08"): "b",
                      ("C3", "2025-09"): "a"}
    tops = {(r["customer_id"], r["period_start"].strftime("%Y-%m")): r["top_category"] for r in lab}
    assert tops[("C1", "2025-08")] == "a"  # tie → first name
    anchors2 = {(r["customer_id"], r["period_start"].strftime("%Y-%m")) for r in lab if r["seq"] is not None}
    assert anchors2 == {("C1", "2025-09"), ("C3", "2025-09"), ("C3", "2025-10")}
    lab3 = labelled(rolled, cfg, SequenceConfig(seq_len=3)).collect()
    anchors3 = [(r["customer_id"], r["period_start"].strftime("%Y-%m")) for r in lab3 if r["seq"] is not None]
    assert anchors3 == [("C3", "2025-10")]
    seq = [r for r in lab3 if r["seq"] is not None][0]["seq"]
    names = feature_columns(rolled, cfg)
    assert names[0] == "cat_a"  # summed columns sorted, then averaged ones sorted
    i = names.index("total_spent")
    assert [step[i] for step in seq] == [3.0, 4.0, 6.0]  # oldest step first


def test_adjacent_labels(store):
    fs, cfg = store
    lab = labelled(rolled_features(fs, cfg), cfg, SequenceConfig(seq_len=2, require_adjacent=True)).collect()
    labels = {(r["customer_id"], r["period_start"].strftime("%Y-%m")) for r in lab if r["target_category"]}
    assert ("C1", "2025-09") not in labels  # next observed month is not adjacent
    assert ("C1", "2025-08") in labels


def test_period_gaps(spark, store):
    fs, cfg = store
    from nextcat.functions.periods import parse_period, period_index
    g = period_gaps(fs.withColumn("period_idx", period_index(parse_period("period"))), "customer_id").collect()
    assert [(r["customer_id"], r["missing"]) for r in g] == [("C1", 1)]


def _txns(spark, rows, amount="decimal(18,2)"):
    cast = Decimal if amount.startswith("decimal") else (lambda x: x)
    return spark.createDataFrame([(c, dt.datetime.fromisoformat(t), None if a is None else cast(a), cat, "M1", pay, o)
                                  for c, t, a, cat, pay, o in rows],
                                 f"customer_id string, timestamp timestamp_ntz, amount {amount}, category string, "
                                 "merchant_id string, payment_method string, is_online int")


def test_online_ratio_differences_come_before_filling(spark):
    rows = [("C", f"2025-0{m}-01", "5", "a", "card", o) for m, o in ((1, None), (2, 1), (3, None), (4, 0), (5, 1))]
    fs, _ = build_feature_store(_txns(spark, rows), FeatureConfig())
    got = [(r["online_ratio"], r["prev_online_ratio"], r["online_ratio_change"]) for r in fs.orderBy("period").collect()]
    assert got == [(0, 0, 0), (1, 0, 0), (0, 1, 0), (0, 0, 0), (1, 0, 1)]


def test_any_category_name(spark):
    values = ["a-b", "a b", "Food", "food", "rows", "食品", "飲料", "egory_diversity", "cats", "", "`q` \"x\", y"]
    rows = [("C", "2025-01-01", str(i + 1), v, v, 1) for i, v in enumerate(values)]
    fs, cfg = build_feature_store(_txns(spark, rows), FeatureConfig())
    row = fs.first().asDict()
    assert len({c.lower() for c in fs.columns}) == len(fs.columns)
    cats, pays = category_columns(cfg), payment_columns(cfg)
    assert [row[c] for c in cats] == [float(values.index(v) + 1) for v in cfg.categories]
    assert [row[c] for c in pays] == [1] * len(values) and row["category_diversity"] == len(values)
    rolled = rolled_features(fs, cfg)
    lab = labelled(rolled, cfg, SequenceConfig(seq_len=1)).first()
    assert lab["top_category"] == values[-1]


def test_many_categories(spark):
    rows = [("C", "2025-01-01", "1", f"c{i}", "card", 1) for i in range(300)]
    fs, cfg = build_feature_store(_txns(spark, rows), FeatureConfig())
    assert len(cfg.categories) == 300 and fs.first()["category_diversity"] == 300


def test_unlisted_value_fails(spark):
    t = _txns(spark, [("C", "2025-01-01", "7", "new", "card", 1)])
    fs, _ = build_feature_store(t, FeatureConfig(categories=("a",), payments=("card",)))
    with pytest.raises(Exception, match="new"):
        fs.collect()


@pytest.mark.parametrize("amount, rows, total", [
    ("decimal(20,4)", ["1.2300", "2.0000"], 3.23), ("double", [1.23, 2.0, float("nan")], 3.23), ("int", [1, 2], 3.0),
    ("decimal(18,2)", ["9999999999999999.99"], 9999999999999999.99)])
def test_amount_units(spark, amount, rows, total):
    fs, _ = build_feature_store(_txns(spark, [("C", "2025-01-01", a, "a", "card", 1) for a in rows], amount), FeatureConfig())
    assert fs.first()["total_spent"] == total


@pytest.mark.parametrize("amount, value", [("decimal(20,4)", "1.2345"), ("double", 0.125)])
def test_lost_decimals_fail(spark, amount, value):
    t = _txns(spark, [("C", "2025-01-01", value, "a", "card", 1)], amount)
    with pytest.raises(Exception, match="decimals"):
        build_feature_store(t, FeatureConfig())[0].collect()
    fs, _ = build_feature_store(t, FeatureConfig(amount_scale=4))
    assert fs.first()["total_spent"] == float(value)


LEDGER = [("A", "2025-01-02", 1, 5), ("A", "2025-01-01", 2, None), ("A", None, 3, 7), (None, "2025-01-01", 4, 1), ("A", "2025-01-02", 5, 2),
          ("B", "2025-01-01", 6, 3)]


def _ledger(spark):
    return spark.createDataFrame([(c, None if t is None else dt.datetime.fromisoformat(t), k, None if a is None else Decimal(a), Decimal(100))
                                  for c, t, k, a in LEDGER],
                                 "customer_id string, timestamp timestamp_ntz, order_key long, amount decimal(18,2), opening_balance decimal(18,2)")


def test_running_balance_keeps_null_rows(spark):
    got = {r["order_key"]: int(r["balance"]) for r in running_balance(_ledger(spark)).collect()}
    assert got == {3: 93, 2: 93, 1: 88, 5: 86, 4: 99, 6: 97}


def test_numbers_are_unique_and_keep_null_rows(spark):
    got = {r["order_key"]: r["transaction_id"] for r in number_transactions(_ledger(spark), order=("timestamp", "order_key")).collect()}
    assert got == {4: "T1", 3: "T2", 2: "T3", 1: "T4", 5: "T5", 6: "T6"}


def test_one_entity_over_many_ranges(spark):
    n = 5000
    df = spark.range(n, numPartitions=8).select(
        F.lit("hot").alias("customer_id"), F.lit(dt.datetime(2025, 1, 1)).alias("timestamp"), F.col("id").alias("order_key"),
        F.lit(1).cast("decimal(18,2)").alias("amount"), F.lit(0).cast("decimal(18,2)").alias("opening_balance"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert range_sorted(df, "customer_id", "timestamp", "order_key").select("_part").distinct().count() > 1
        got = running_balance(df).select((F.col("balance") + F.col("order_key") + 1).alias("d")).distinct().collect()
        ids = [int(r["transaction_id"][1:]) - r["order_key"] for r in number_transactions(df, order=("timestamp", "order_key")).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(ids) == n and set(ids) == {1}
    assert [int(r["d"]) for r in got] == [0]


def test_rollup_skips_null_and_nan(spark):
    nan = float("nan")
    rows = [("A", "2025-01", 1.0, None, nan), ("A", "2025-01-15", nan, None, 4.0), (None, "2025-01", 9.0, 1, 1.0), ("A", None, 9.0, 1, 1.0)]
    df = spark.createDataFrame(rows, "customer_id string, period string, total double, n long, avg_x double")
    got = [tuple(r)[3:] for r in monthly_rollup(df).collect()]
    assert got == [(0, 1.0, 4.0)]


def test_merge_tables(spark):
    a = spark.createDataFrame([("A", "p", 1), ("B", "p", None), (None, "p", 3)], "customer_id string, period string, x int")
    b = spark.createDataFrame([("A", "p", 4.0), ("B", "p", 5.0), ("C", "p", 6.0)], "customer_id string, period string, y double")
    assert sorted(map(tuple, merge_tables([a, b]).collect())) == [("A", "p", 1, 4.0), ("B", "p", None, 5.0)]
    with pytest.raises(Exception, match="repeated key"):
        merge_tables([a.union(a), b]).collect()
    with pytest.raises(ValueError):
        merge_tables([a, a])


def test_refresh_removes_emptied_periods(spark):
    rows = [("A", f"2025-0{m}-01", "1", "a", "card", 1) for m in (1, 2, 3, 4)]
    whole, cfg = build_feature_store(_txns(spark, rows), FeatureConfig())
    path = scratch_path(spark, "t-refresh")
    IO.write_partitioned(whole, path)
    refresh_since(_txns(spark, [r for r in rows if "-03-" not in r[1]]), cfg, path, "2025-02")
    assert IO.stored_periods(spark, path) == ["2025-01", "2025-02", "2025-04"]
    with pytest.raises(Exception, match="other"):
        refresh_since(_txns(spark, [("A", "2025-04-01", "1", "other", "card", 1)]), cfg, path, "2025-04")


def test_malformed_csv_fails(spark):
    path = scratch_path(spark, "t-csv") + ".csv"
    spark.createDataFrame([("A", "x")], "customer_id string, total string").write.option("header", True).csv(path)
    with pytest.raises(Exception):
        IO.read_table(spark, path, csv_schema=T.StructType([T.StructField("customer_id", T.StringType()), T.StructField("total", T.DoubleType())])).collect()


def test_drop_partitions_of_tables(spark):
    rows = [("A", f"2025-0{m}-01", "1", "a", "card", 1) for m in (1, 2)]
    fs, cfg = build_feature_store(_txns(spark, rows), FeatureConfig())
    paths = IO.write_feature_store(fs, narrow_tables(fs, cfg), scratch_path(spark, "t-drop"))
    assert len(IO.drop_partitions(spark, [*paths.values(), "/nowhere/at/all"], ["2025-01", "1999-01"])) == 6
    assert all(IO.stored_periods(spark, p) == ["2025-02"] for p in paths.values())
    assert len(IO.drop_partitions(spark, list(paths.values()))) == 6


def test_drop_catalog_partitions(spark):
    path = scratch_path(spark, "t-catalog")
    spark.sql(f"CREATE TABLE t_catalog (x INT, period STRING) USING parquet PARTITIONED BY (period) LOCATION '{path}'")
    spark.sql("INSERT INTO t_catalog VALUES (1, '2025-01'), (2, '2025-02'), (3, 'it''s')")
    IO.drop_table_partitions(spark, ["t_catalog"], ["2025-01", "it's", "1999-01"])
    assert [r[0] for r in spark.table("t_catalog").select("x").collect()] == [2]
    spark.sql("DROP TABLE t_catalog")


def test_bad_period_fails_in_the_plan(spark, store):
    fs, cfg = store
    with pytest.raises(Exception, match="not a period: bad"):
        rolled_features(fs.withColumn("period", F.lit("bad")), cfg).collect()


def test_checkpoint_folder_off_one_machine():
    from nextcat.session import ensure_checkpoint_dir

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(type("S", (), {"sparkContext": Context()})())


def test_bad_period_raises(spark):
    df = spark.createDataFrame([("C1", "2025-08"), ("C1", "bad"), ("C2", "2025-08-01"), ("C3", "2025Q3")],
                               "customer_id string, period string")
    assert [r[0] for r in invalid_periods(df).collect()] == ["bad"]
    with pytest.raises(ValueError, match="bad"):
        check_periods(df)
