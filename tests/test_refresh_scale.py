"""Refreshing a stored table: the transactions are joined once, and the rows before are aggregated without a sort."""

import datetime as dt
from decimal import Decimal

import pytest

from nextcat import oracle as O
from nextcat import queries as Q
from nextcat.config import FeatureConfig
from nextcat.session import scratch_path
from nextcat.sources import io as IO
from nextcat.streaming import incremental as I


@pytest.fixture(scope="module")
def tables(spark):
    base = scratch_path(spark, "t-tables")
    cats, pays = O.TPCH_CATEGORIES, O.TPCH_PAYMENTS
    li = [(i // 3, i % len(cats), i % 5, i % 3, dt.datetime(2000 + i // 30 % 2, 1 + i // 5 % 6, 1 + i % 20), Decimal(i), "N", "OF"[i % 2]) for i in range(300)]
    spark.createDataFrame(li, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_shipdate timestamp_ntz, l_extendedprice decimal(18,2), "
                              "l_returnflag string, l_linestatus string").write.parquet(f"{base}/lineitem.parquet")
    orders = [(i, i % 4, pays[i % len(pays)]) for i in range(100)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderpriority string").write.parquet(f"{base}/orders.parquet")
    spark.createDataFrame(list(enumerate(cats)), "p_partkey long, p_type string").write.parquet(f"{base}/part.parquet")
    return base


@pytest.mark.parametrize("name, step", [("withdraw_period", "refresh_since"), ("overwrite_periods", "refresh_since"), ("refresh_new_category", "refresh_store")])
def test_build_and_refresh_share_one_join(spark, tables, monkeypatch, name, step):
    read, real = [], getattr(Q, step)
    monkeypatch.setattr(Q, step, lambda txns, *rest: (read.extend(txns.inputFiles()), real(txns, *rest)))
    out = Q.QUERIES[name](spark, tables)
    assert read and not [f for f in read if "lineitem" in f]
    rows = out.collect()
    assert rows and len({(r.customer_id, r.period) for r in rows}) == len(rows)
    assert not [f for f in read if IO.is_directory(spark, f.rsplit("/", 1)[0])]  # the joined transactions are gone, the result is not
    if name == "withdraw_period":
        assert {r.period for r in rows} >= {"2000-03", "2001-02"} and not {r.period for r in rows} & {"2001-03", "2001-04"}


def test_last_rows_without_a_sort(spark):
    stored = spark.createDataFrame([("A", "2024-12", 1.0, 2, None), ("A", "2024-03", 5.0, 6, 0.5), ("B", "2025-01", 7.0, 1, 1.0), ("C", "2023-01", 3.0, 4, 0.25)],
                                   "customer_id string, period string, total_spent double, txn_count long, online_ratio double")
    last = I.last_rows(stored, FeatureConfig(), 2025 * 12)
    assert "Sort" not in last._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, last.collect())) == [("A", 2024 * 12 + 11, 1.0, 2, None), ("C", 2023 * 12, 3.0, 4, 0.25)]
