"""Transaction-shaped views over the generated TPC-H-like test tables.

These are the inputs every registered query runs on.  Each view keeps exactly the columns the feature
operators need, so Catalyst prunes the Parquet scans to those columns; joins
are plain equi-joins: with small tables the planner picks the strategy from (runtime)
sizes, larger ones meet in as many tasks as their files need (:func:`meet`) —
no hint forces a broadcast of a table whose size grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FeatureConfig, TxnColumns
from .io import deal, input_bytes, tasks_for

AMOUNT_TYPE = "decimal(18,2)"
# Bytes of the files of a table that the planner may broadcast, and of a task of a join beyond.
SMALL_TABLE = 32 << 20
JOIN_TASK = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def meet(rows: DataFrame, other: DataFrame, key: str, other_key: str, small: int = SMALL_TABLE, task_bytes: int = JOIN_TASK) -> DataFrame:
    """Equi-join of ``rows`` with a table that they refer to.  Beyond ``small`` bytes
    of its files both sides are dealt to one task per ``task_bytes`` of all files and
    merged, so what a task sorts does not grow with the input, however few partitions
    the session names or adaptive execution leaves."""
    joined = rows.join(other, F.col(key) == F.col(other_key))
    if input_bytes(other) <= small:
        return joined
    tasks = tasks_for(joined, task_bytes)
    return deal(rows, tasks, key).join(deal(other, tasks, other_key).hint("merge"), F.col(key) == F.col(other_key))


def tpch_transactions(spark: SparkSession, sf_dir: str, with_city: bool = False) -> DataFrame:
    """``txn``: one row per lineitem.

    customer_id = o_custkey, timestamp = l_shipdate, amount = l_extendedprice as
    DECIMAL(18,2), category = p_type, merchant_id = l_suppkey, payment_method =
    o_orderpriority, device = l_returnflag, is_online = (l_linestatus = 'O').
    ``city`` (n_name, via customer and nation) only when asked for: no feature
    uses it, and an inner join cannot be pruned away by the optimiser."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate",
        "l_extendedprice", "l_returnflag", "l_linestatus")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    t = meet(meet(li, o, "l_orderkey", "o_orderkey"), p, "l_partkey", "p_partkey")
    cols = [
        F.col("o_custkey").alias("customer_id"),
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_extendedprice").cast(AMOUNT_TYPE).alias("amount"),
        F.col("p_type").alias("category"),
        F.col("l_suppkey").alias("merchant_id"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("l_returnflag").alias("device"),
        F.when(F.col("l_linestatus") == "O", 1).otherwise(0).alias("is_online"),
    ]
    if with_city:
        c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
        n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
        t = t.join(c, t.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == n.n_nationkey)
        cols.append(F.col("n_name").alias("city"))
    return t.select(*cols)


TPCH_TXN_SQL = """
SELECT o.o_custkey AS customer_id, l.l_shipdate AS "timestamp",
       CAST(l.l_extendedprice AS DECIMAL(18,2)) AS amount, p.p_type AS category,
       l.l_suppkey AS merchant_id, o.o_orderpriority AS payment_method,
       l.l_returnflag AS device,
       CASE WHEN l.l_linestatus = 'O' THEN 1 ELSE 0 END AS is_online
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                JOIN part p ON l.l_partkey = p.p_partkey
"""


def sparse_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sparse_txn``: the same rows with NULLs: no online flag in every third
    month, no amount on every seventh line of an order, no category on every
    fifth, no customer for every hundredth order."""
    t = tpch_transactions(spark, sf_dir)
    month = F.year("timestamp") * 12 + F.month("timestamp") - 1
    null = F.lit(None)
    return t.select(
        F.when(F.col("order_key") % 100 == 0, null).otherwise(F.col("customer_id")).alias("customer_id"),
        "order_key", "line_number", "timestamp",
        F.when((F.col("order_key") + F.col("line_number")) % 7 == 0, null).otherwise(F.col("amount")).alias("amount"),
        F.when((F.col("order_key") + F.col("line_number")) % 5 == 0, null).otherwise(F.col("category")).alias("category"),
        "merchant_id", "payment_method", "device",
        F.when(month % 3 == 0, null).otherwise(F.col("is_online")).alias("is_online"))


SPARSE_TXN_SQL = """
SELECT CASE WHEN l.l_orderkey % 100 = 0 THEN NULL ELSE o.o_custkey END AS customer_id, l.l_shipdate AS "timestamp",
       CASE WHEN (l.l_orderkey + l.l_linenumber) % 7 = 0 THEN NULL ELSE CAST(l.l_extendedprice AS DECIMAL(18,2)) END AS amount,
       CASE WHEN (l.l_orderkey + l.l_linenumber) % 5 = 0 THEN NULL ELSE p.p_type END AS category,
       l.l_suppkey AS merchant_id, o.o_orderpriority AS payment_method, l.l_returnflag AS device,
       CASE WHEN (year(l.l_shipdate) * 12 + month(l.l_shipdate) - 1) % 3 = 0 THEN NULL
            WHEN l.l_linestatus = 'O' THEN 1 ELSE 0 END AS is_online
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                JOIN part p ON l.l_partkey = p.p_partkey
"""


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_txn``: events as daily transactions (no payment method, no
    online flag).  merchant_id is the JSON field ``k`` of ``props``."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("timestamp"),
        F.col("value").cast(AMOUNT_TYPE).alias("amount"),
        F.col("event_type").alias("category"),
        F.get_json_object("props", "$.k").alias("merchant_id"),
    )


EVENT_TXN_SQL = """
SELECT user_id AS customer_id, ts AS "timestamp", CAST(value AS DECIMAL(18,2)) AS amount,
       event_type AS category, json_extract_string(props, '$.k') AS merchant_id
FROM events
"""


def order_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``order_ledger``: orders with the customer's opening balance."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderkey").alias("order_key"),
        F.col("o_orderdate").alias("timestamp"),
        F.col("o_totalprice").cast(AMOUNT_TYPE).alias("amount"),
        F.col("c_acctbal").cast(AMOUNT_TYPE).alias("opening_balance"),
    )


ORDER_LEDGER_SQL = """
SELECT o.o_custkey AS customer_id, o.o_orderkey AS order_key, o.o_orderdate AS "timestamp",
       CAST(o.o_totalprice AS DECIMAL(18,2)) AS amount,
       CAST(c.c_acctbal AS DECIMAL(18,2)) AS opening_balance
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
"""

# Feature configurations matching the two transaction views.
TPCH_CONFIG = FeatureConfig(stage_source=True)  # the view is a join of three tables
EVENT_CONFIG = FeatureConfig(cols=TxnColumns(payment=None, online=None), payments=())
