"""Registered queries: one per operator of the inventory, each ``(spark,
sf_dir) -> DataFrame`` over the generated tables, plus the matching DuckDB
SQL.  Float columns whose last bits depend on the aggregation algorithm
(standard deviations, scaled values) are rounded on both sides."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle as O
from .config import FeatureConfig
from .functions.periods import index_start, period_index, period_label, period_start
from .operators.features import CORE_COLUMNS, category_columns, core_columns, payment_columns
from .operators.trends import GROWTH_COLUMNS, TREND_COLUMNS, growth_columns, trend_columns
from .plans.feature_store import build_feature_batches, build_feature_store, transaction_columns
from .sources.fixtures import (EVENT_CONFIG, SPARSE_TXN_SQL, TPCH_CONFIG, event_transactions, sparse_transactions,
                               tpch_transactions)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

STD_DIGITS = 4


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _rounded(df: DataFrame, cols=("spend_std_dev",), digits: int = STD_DIGITS) -> DataFrame:
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in cols else F.col(c) for c in df.columns])


def tpch_feature_store(spark: SparkSession, sf_dir: str, cfg: FeatureConfig = TPCH_CONFIG,
                       keep_index: bool = False):
    return build_feature_store(tpch_transactions(spark, sf_dir), cfg, keep_index=keep_index)


# ---------------------------------------------------------------- L1 family

_CORE = list(CORE_COLUMNS)
_CATS = O.pivot_names("cat_", O.TPCH_CATEGORIES)
_PAYS = O.pivot_names("pay_", O.TPCH_PAYMENTS)
_TREND = [*TREND_COLUMNS, "online_ratio_change"]
_GROWTH = [c for c in GROWTH_COLUMNS if c != "online_ratio_change"]
_ALL = _CORE + _CATS + ["category_diversity"] + _PAYS + [*TREND_COLUMNS, *GROWTH_COLUMNS]


def _fs_projection(cols_fn):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        fs, cfg = tpch_feature_store(spark, sf_dir)
        return _rounded(fs.select("customer_id", "period", *cols_fn(cfg)))
    return q


register("monthly_core_features", O.select_from_fs(_CORE))(_fs_projection(core_columns))
register("category_spend_pivot", O.select_from_fs(_CATS))(_fs_projection(category_columns))
register("payment_count_pivot", O.select_from_fs(_PAYS))(_fs_projection(payment_columns))
register("category_diversity", O.select_from_fs(["category_diversity"]))(
    _fs_projection(lambda cfg: ["category_diversity"]))
register("trend_features", O.select_from_fs(_TREND))(
    _fs_projection(lambda cfg: trend_columns(cfg) + ["online_ratio_change"]))
register("growth_features", O.select_from_fs(_GROWTH))(
    _fs_projection(lambda cfg: growth_columns(cfg, include_online_change=False)))
register("feature_store_combined", O.select_from_fs(_ALL))(_fs_projection(
    lambda cfg: core_columns(cfg) + category_columns(cfg) + ["category_diversity"] + payment_columns(cfg)
    + trend_columns(cfg) + growth_columns(cfg)))


@register("sparse_feature_store", O.select_from_fs(_ALL, cte=O.feature_store_sql(SPARSE_TXN_SQL)))
def q_sparse_feature_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 over transactions with NULL customers, amounts, categories and online
    flags: differences before filling (W2), NULL keys out (Q10)."""
    fs, _ = build_feature_store(sparse_transactions(spark, sf_dir), TPCH_CONFIG)
    return _rounded(fs.select("customer_id", "period", *_ALL))


_EV_CORE = [c for c in CORE_COLUMNS if c != "online_ratio"]
_EV_CATS = O.pivot_names("cat_", O.EVENT_TYPES)
_EV_ALL = _EV_CORE + _EV_CATS + ["category_diversity", "prev_total_spent", "prev_txn_count",
                                 "spend_growth", "txn_growth"]


@register("event_feature_store_daily", O.select_from_fs(
    _EV_ALL, cte=O.feature_store_sql(O.EVENT_TXN_SQL, O.EVENT_TYPES, (), unit="day", online=False)))
def q_event_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 over the events view at daily periods (no payment, no online flag)."""
    cfg = replace(EVENT_CONFIG, period_unit="day")
    fs, _ = build_feature_store(event_transactions(spark, sf_dir), cfg)
    return _rounded(fs)


@register("period_bucket", f"""
WITH txn AS ({O.TPCH_TXN_SQL})
SELECT customer_id, {O.label_sql('"timestamp"', 'month')} AS period,
       {O.idx_sql('"timestamp"', 'month')} AS period_idx,
       {O.start_sql('"timestamp"', 'month')} AS period_start,
       {O.label_sql('"timestamp"', 'quarter')} AS quarter,
       {O.idx_sql('"timestamp"', 'week')} AS week_idx
FROM txn""")
def q_period_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-transaction period label / index / start (month), plus the
    quarter label and week index."""
    t = tpch_transactions(spark, sf_dir)
    return t.select("customer_id",
                    period_label("timestamp", "month").alias("period"),
                    period_index("timestamp", "month").alias("period_idx"),
                    period_start("timestamp", "month").alias("period_start"),
                    period_label("timestamp", "quarter").alias("quarter"),
                    period_index("timestamp", "week").alias("week_idx"))


@register("category_values", """
SELECT category, CAST(row_number() OVER (ORDER BY category) - 1 AS INTEGER) AS class_index
FROM (SELECT DISTINCT p_type AS category FROM part p JOIN lineitem l ON l.l_partkey = p.p_partkey
      JOIN orders o ON l.l_orderkey = o.o_orderkey WHERE p_type IS NOT NULL)""")
def q_category_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E9 + M1: the sorted categories present in the transactions, with the
    class index each gets (ordering runs over the distinct values only)."""
    from .operators.labels import category_index
    return category_index(tpch_transactions(spark, sf_dir), "category")


# ---------------------------------------------------------------- L2 family

from .config import FIXTURE_SPLIT, SequenceConfig  # noqa: E402
from .operators.labels import category_index, drop_unlabelled, invalid_periods, normalize_periods  # noqa: E402
from .operators.sequences import explode_steps, in_full_runs, sequences_by_self_join, split_counts  # noqa: E402
from .plans.supervised import feature_columns, labelled, rolled_features, supervised_sequences  # noqa: E402

SEQ = SequenceConfig(seq_len=3)
_SUP = O.supervised_sql(seq_len=SEQ.seq_len)


def _rolled(spark: SparkSession, sf_dir: str):
    fs, cfg = tpch_feature_store(spark, sf_dir)
    return rolled_features(fs, cfg, dealt=True), cfg


def _flat_sql(where: str, extra: str = "") -> str:
    feats = ", ".join(
        (f"round(CAST(s.{O.ident(c)} AS DOUBLE), {STD_DIGITS}) AS {O.ident(c)}" if c == "spend_std_dev"
         else f"CAST(s.{O.ident(c)} AS DOUBLE) AS {O.ident(c)}") for c in _ALL)
    return _SUP + f"""
SELECT s.customer_id, s.period, s.step{extra}, {feats}
FROM steps s JOIN sup0 USING (customer_id, period_idx) WHERE {where}"""


def _flat(df: DataFrame, cfg, rolled_cols, extra=()) -> DataFrame:
    e = explode_steps(df, ["customer_id", "period", *extra], rolled_cols)
    return _rounded(e.drop("period_idx"))


@register("top_category", _SUP + "\nSELECT customer_id, period, top_category FROM m")
def q_top_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: top spend category of each customer-month (ties → first name)."""
    from .operators.labels import top_category
    fs, cfg = tpch_feature_store(spark, sf_dir)
    return fs.select("customer_id", "period",
                     top_category(category_columns(cfg), list(cfg.categories)).alias("top_category"))


@register("next_top_category", _SUP + """
SELECT customer_id, period, label_period, target_category FROM l2
WHERE label_idx IS NOT NULL AND target_category IS NOT NULL""")
def q_next_top_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next observed month and its top category."""
    rolled, cfg = _rolled(spark, sf_dir)
    m = drop_unlabelled(labelled(rolled, cfg, SEQ))
    return m.select("customer_id", period_label("period_start", "month").alias("period"),
                    period_label(index_start("label_idx", "month"), "month").alias("label_period"),
                    "target_category")


@register("label_index", _SUP + """
SELECT customer_id, period, target_category, label FROM l2
WHERE label_idx IS NOT NULL AND target_category IS NOT NULL""")
def q_label_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: class index (double) of the target in the sorted category list."""
    from .operators.labels import class_index
    rolled, cfg = _rolled(spark, sf_dir)
    m = drop_unlabelled(labelled(rolled, cfg, SEQ))
    return m.select("customer_id", period_label("period_start", "month").alias("period"), "target_category",
                    class_index("target_category", cfg.categories).alias("label"))


@register("training_sequences", _flat_sql("TRUE"))
def q_training_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every anchor with a complete 3-month history that is a
    train/test/predict/unused example, flattened to (anchor, step) rows."""
    fs, cfg = tpch_feature_store(spark, sf_dir)
    sup = supervised_sequences(fs, cfg, SEQ, FIXTURE_SPLIT, keep_unused=True, dealt=True)
    cols = feature_columns(rolled_features(fs, cfg, strict=False), cfg)
    return _flat(sup, cfg, cols)


@register("sequence_self_join", _flat_sql("TRUE"))
def q_sequence_self_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sequences by exploding each anchor to its step periods and
    equi-joining (cross-check of the window formulation)."""
    path = scratch_path(spark, "rolled")  # the join reads the rows three times
    with _stored_transactions(spark, sf_dir) as txn, storing(spark):
        fs, cfg = build_feature_store(txn, _STORED_CONFIG)
        rolled = rolled_features(fs, cfg, dealt=True)
        cols = feature_columns(rolled, cfg)
        in_full_runs(rolled, "customer_id", "period_idx", SEQ.seq_len).write.parquet(path)
    j = sequences_by_self_join(spark.read.parquet(path), "customer_id", "period_idx", cols, SEQ.seq_len)
    j = j.select("customer_id", period_label(index_start("period_idx", "month"), "month").alias("period"),
                 "step", *[F.col(c).cast("double").alias(c) for c in cols])
    return _rounded(j)


@register("prediction_sequences", _flat_sql("split = 'predict'"))
def q_prediction_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences ending the month before the prediction month."""
    fs, cfg = tpch_feature_store(spark, sf_dir)
    sup = supervised_sequences(fs, cfg, SEQ, FIXTURE_SPLIT, dealt=True).where("split = 'predict'")
    cols = feature_columns(rolled_features(fs, cfg, strict=False), cfg)
    return _flat(sup, cfg, cols)


@register("temporal_split", _SUP + "\nSELECT customer_id, period, label_period, split FROM sup0")
def q_temporal_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split assignment of every anchor with a complete
    history, unused ones included."""
    fs, cfg = tpch_feature_store(spark, sf_dir)
    return supervised_sequences(fs, cfg, SEQ, FIXTURE_SPLIT, keep_unused=True, dealt=True).select(
        "customer_id", "period", "label_period", "split")


@register("split_counts", _SUP + "\nSELECT split, COUNT(*) AS n FROM sup GROUP BY split")
def q_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences per split."""
    fs, cfg = tpch_feature_store(spark, sf_dir)
    return split_counts(supervised_sequences(fs, cfg, SEQ, FIXTURE_SPLIT, dealt=True))


@register("supervised_sequences", _flat_sql("(split IN ('train', 'test') AND label IS NOT NULL) OR split = 'predict'",
                                            ", sup0.split, sup0.label_period, sup0.target_category, sup0.label"))
def q_supervised_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L2 flagship: labelled train/test sequences and prediction sequences,
    flattened to one row per (anchor, step)."""
    fs, cfg = tpch_feature_store(spark, sf_dir)
    sup = supervised_sequences(fs, cfg, SEQ, FIXTURE_SPLIT, dealt=True)
    cols = feature_columns(rolled_features(fs, cfg, strict=False), cfg)
    return _flat(sup, cfg, cols, extra=("split", "label_period", "target_category", "label"))


@register("period_normalize", O.feature_store_sql() + """
SELECT customer_id, period, CAST(strptime(period, '%Y-%m') AS DATE) AS period_start FROM fs""")
def q_period_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Period text → month start date."""
    fs, _ = tpch_feature_store(spark, sf_dir)
    return normalize_periods(fs.select("customer_id", "period"), "period", "month")


@register("invalid_periods", O.feature_store_sql() + """
, u AS (SELECT period FROM fs UNION ALL SELECT o_orderpriority FROM orders)
SELECT DISTINCT period FROM u
WHERE NOT regexp_matches(period, '^[0-9]{4}-[0-9]{2}$')
ORDER BY period LIMIT 5""")
def q_invalid_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: first five unparseable period values of a text column that mixes
    feature-store periods with order priorities."""
    fs, _ = tpch_feature_store(spark, sf_dir)
    pri = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderpriority").alias("period"))
    return invalid_periods(fs.select("period").unionByName(pri), "period", "month")


# ---------------------------------------------------------------- sources, sinks, tables

from .operators.tables import merge_batches, merge_tables, monthly_rollup, validate_keys  # noqa: E402
from .operators.trends import fill_calendar, number_transactions, period_gaps, running_balance  # noqa: E402
from .plans import model as M  # noqa: E402
from .plans.feature_store import narrow_tables  # noqa: E402
from .session import scratch_path, storing  # noqa: E402
from .sources import io as IO  # noqa: E402
from .sources.fixtures import ORDER_LEDGER_SQL, order_ledger  # noqa: E402
from .operators.dictionary import read_dictionary  # noqa: E402
from .streaming.incremental import create_store, read_store, refresh_since, refresh_store  # noqa: E402
from pyspark.sql.types import (DecimalType, IntegerType, LongType, StringType,  # noqa: E402
                               StructField, StructType)

_FS_ALL_SQL = O.select_from_fs(_ALL)


def _fs_all(df: DataFrame) -> DataFrame:
    return _rounded(df.select("customer_id", "period", *_ALL))


@register("scan_csv_roundtrip", f"""
WITH txn AS ({O.TPCH_TXN_SQL})
SELECT customer_id, "timestamp", amount, category, merchant_id, payment_method, device, is_online FROM txn""")
def q_scan_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10 + S1 + S2: write the transactions as header CSV, read them back
    with an explicit schema and strict timestamp parsing."""
    cols = ["customer_id", "timestamp", "amount", "category", "merchant_id", "payment_method", "device",
            "is_online"]
    path = scratch_path(spark, "txn-csv")
    IO.write_csv(tpch_transactions(spark, sf_dir).select(*cols), path)
    schema = StructType([StructField("customer_id", LongType()), StructField("timestamp", StringType()),
                         StructField("amount", DecimalType(18, 2)), StructField("category", StringType()),
                         StructField("merchant_id", LongType()), StructField("payment_method", StringType()),
                         StructField("device", StringType()), StructField("is_online", IntegerType())])
    return IO.read_transactions_csv(spark, path, schema=schema)


def _stored_feature_store(spark: SparkSession, sf_dir: str):
    base = scratch_path(spark, "feature-store")
    with _stored_transactions(spark, sf_dir) as txn:
        batches, cfg = build_feature_batches(txn, _STORED_CONFIG)
        paths = IO.write_feature_store(batches, narrow_tables(batches[0], cfg), base)
    return paths, cfg


def _narrow_tables_alone(spark: SparkSession, sf_dir: str):
    """The five narrow tables as stored, for queries that read no other: the
    combined table that they were written from is removed."""
    paths, cfg = _stored_feature_store(spark, sf_dir)
    IO.remove(spark, paths.pop("feature_store"))
    return IO.read_narrow_tables(spark, paths), cfg


@register("scan_partitioned", _FS_ALL_SQL)
def q_scan_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 + S3: write the combined table partitioned by period, read it back
    (period returns as text)."""
    fs, _ = tpch_feature_store(spark, sf_dir)
    path = scratch_path(spark, "fs-part")
    IO.write_partitioned(fs, path)
    return _fs_all(IO.read_partitioned(spark, path))


@register("sink_partitioned_roundtrip", _FS_ALL_SQL + " WHERE period >= '2000-01'")
def q_sink_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 + S3 with a period filter that prunes partitions at the scan."""
    fs, _ = tpch_feature_store(spark, sf_dir)
    path = scratch_path(spark, "fs-part")
    IO.write_partitioned(fs, path)
    return _fs_all(IO.read_partitioned(spark, path).where(F.col("period") >= "2000-01"))


_FORMATS = ("directory", "parquet", "csv")


@register("scan_dispatch", O.feature_store_sql() + ", core AS (" + O.select_from_fs(_CORE, cte="") + f""")
SELECT format, core.* FROM core CROSS JOIN (SELECT unnest({list(_FORMATS)}) AS format)""")
def q_scan_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole core table through the dispatcher as a partitioned
    directory, a ``.parquet`` path and a ``.csv`` path."""
    base = scratch_path(spark, "dispatch")
    with _stored_transactions(spark, sf_dir) as txn:
        fs, cfg = build_feature_store(txn, _STORED_CONFIG)
        core = fs.select("customer_id", "period", *core_columns(cfg))
        IO.write_partitioned(core, f"{base}/dir")
    stored = IO.read_partitioned(spark, f"{base}/dir").select(*core.columns)
    stored.write.parquet(f"{base}/core.parquet")
    IO.write_csv(stored, f"{base}/core.csv", compression="gzip")
    reads = [IO.read_table(spark, f"{base}/dir"), IO.read_table(spark, f"{base}/core.parquet"),
             IO.read_table(spark, f"{base}/core.csv", csv_schema=core.schema)]
    named = [_rounded(r.select(*core.columns)).select(F.lit(f).alias("format"), "*") for f, r in zip(_FORMATS, reads)]
    return named[0].unionByName(named[1]).unionByName(named[2])


@register("feature_store_tables", O.feature_store_sql() + """
SELECT 'feature_store' AS table_name, COUNT(*) AS n_rows, 30 AS n_columns FROM fs
UNION ALL SELECT 'core_behavior', COUNT(*), 12 FROM fs
UNION ALL SELECT 'category', COUNT(*), 9 FROM fs
UNION ALL SELECT 'payment', COUNT(*), 7 FROM fs
UNION ALL SELECT 'growth', COUNT(*), 4 FROM fs
UNION ALL SELECT 'trend', COUNT(*), 6 FROM fs""")
def q_feature_store_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 + E7: six tables written (combined once, narrow ones from it); rows
    and columns of each as read back."""
    paths, _ = _stored_feature_store(spark, sf_dir)
    out = None
    for name, p in paths.items():
        t = IO.read_partitioned(spark, p)
        r = t.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(t.columns)).alias("n_columns"))
        out = r if out is None else out.unionByName(r)
    return out


@register("merge_feature_tables", _FS_ALL_SQL)
def q_merge_feature_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five narrow tables read back and inner-joined on
    (customer_id, period) reproduce the combined table."""
    tables, _ = _narrow_tables_alone(spark, sf_dir)
    path = scratch_path(spark, "merged")
    for part in merge_batches(tables):
        with storing(spark):
            part.write.mode("append").option("compression", "zstd").parquet(path)
    return _fs_all(spark.read.parquet(path))


def _rollup_sql() -> str:
    longs = {"txn_count", "unique_merchants", "category_diversity", "prev_txn_count", "txn_growth", *_PAYS}
    cols = []
    for c in _ALL:
        e = f"round({O.ident(c)}, {STD_DIGITS})" if c == "spend_std_dev" else O.ident(c)
        cols.append(f"CAST({e} AS {'BIGINT' if c in longs else 'DOUBLE'}) AS {O.ident(c)}")
    return O.feature_store_sql() + f"""
SELECT customer_id, CAST(strptime(period, '%Y-%m') AS DATE) AS period_start, period_idx, {", ".join(cols)}
FROM fs"""


@register("monthly_rollup", _rollup_sql())
def q_monthly_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roll-up of the merged narrow tables to one row per customer-month
    (identity on this keyed input; pivot columns summed explicitly)."""
    paths, cfg = _stored_feature_store(spark, sf_dir)
    merged = merge_tables(IO.read_narrow_tables(spark, paths), deal_by="customer_id")
    explicit = {c: "sum" for c in category_columns(cfg) + payment_columns(cfg)}
    return _rounded(monthly_rollup(merged, explicit=explicit))


@register("validate_keys", """
SELECT 'duplicate_key' AS kind, l_orderkey AS order_key, l_linenumber AS line_number, COUNT(*) AS n
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""")
def q_validate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key problems of the transaction table keyed by
    (order_key, line_number) — that pair is not unique in the test data."""
    return validate_keys(tpch_transactions(spark, sf_dir), keys=("order_key", "line_number"))


_SPARSE_KEYS = ("customer_id", "order_key", "line_number")


@register("validate_keys_sparse", f"""
WITH t AS (SELECT CASE WHEN l_orderkey % 100 = 0 THEN NULL ELSE o_custkey END AS customer_id, l_orderkey AS order_key, l_linenumber AS line_number
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)
SELECT CASE WHEN customer_id IS NULL THEN 'null_key' ELSE 'duplicate_key' END AS kind, customer_id, order_key, line_number, COUNT(*) AS n
FROM t GROUP BY customer_id, order_key, line_number HAVING customer_id IS NULL OR COUNT(*) > 1""")
def q_validate_keys_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5, both kinds of problem: NULL customers and repeated keys."""
    return validate_keys(sparse_transactions(spark, sf_dir), keys=_SPARSE_KEYS)


@register("validate_feature_tables", """
SELECT unnest(['feature_store', 'core_behavior', 'category', 'payment', 'growth', 'trend']) AS table_name, CAST(0 AS BIGINT) AS n_problems""")
def q_validate_feature_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 on the six stored tables: no key is NULL or repeated."""
    paths, _ = _stored_feature_store(spark, sf_dir)
    out = [validate_keys(IO.read_partitioned(spark, p)).agg(F.count(F.lit(1)).alias("n_problems")).select(
        F.lit(name).alias("table_name"), "n_problems") for name, p in paths.items()]
    for t in out[1:]:
        out[0] = out[0].unionByName(t)
    return out[0]


@register("drop_partitions", O.feature_store_sql() + """
SELECT t.table_name, period, COUNT(*) AS n FROM fs CROSS JOIN (SELECT unnest(['feature_store', 'core_behavior', 'category',
  'payment', 'growth', 'trend']) AS table_name) t WHERE period >= '1996-01' GROUP BY ALL""")
def q_drop_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delete the 1995 partitions of all six stored tables (names only, no
    data is read), then count what is left in each."""
    paths, _ = _stored_feature_store(spark, sf_dir)
    IO.drop_partitions(spark, list(paths.values()), [f"1995-{m:02d}" for m in range(1, 13)])
    left = [IO.read_partitioned(spark, p).groupBy("period").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(name).alias("table_name"), "period", "n") for name, p in paths.items()]
    out = left[0]
    for t in left[1:]:
        out = out.unionByName(t)
    return out


_STORED_CONFIG = replace(TPCH_CONFIG, stage_source=False)


def _stored_transactions(spark: SparkSession, sf_dir: str):
    """The transactions joined once, for a build and the refresh after it."""
    return IO.stored(tpch_transactions(spark, sf_dir).select(*transaction_columns(TPCH_CONFIG)), "transactions")


@register("overwrite_periods", _FS_ALL_SQL)
def q_overwrite_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 dynamic overwrite via the incremental refresh: store the feature
    table as of 2000-12, then recompute only the periods from 2001-01 on
    (lags seeded from the stored table) and overwrite just those partitions."""
    path = scratch_path(spark, "fs-incr")
    with _stored_transactions(spark, sf_dir) as txn:
        old, cfg = build_feature_store(txn.where(F.col("timestamp") < F.lit("2001-01-01").cast("timestamp_ntz")), _STORED_CONFIG)
        IO.write_partitioned(old, path)
        refresh_since(txn, cfg, path, "2001-01")
    return _fs_all(IO.read_partitioned(spark, path))


_WITHDRAWN = "year(l_shipdate) = 2001 AND month(l_shipdate) IN (3, 4)"


@register("withdraw_period", O.select_from_fs(_ALL, cte=O.feature_store_sql(O.TPCH_TXN_SQL + f" WHERE NOT ({_WITHDRAWN})")))
def q_withdraw_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store the whole feature table, withdraw the transactions of two
    months, refresh from the month before: their periods are gone and the lags
    of the next ones skip them."""
    path = scratch_path(spark, "fs-withdraw")
    with _stored_transactions(spark, sf_dir) as txn:
        whole, cfg = build_feature_store(txn, _STORED_CONFIG)
        IO.write_partitioned(whole, path)
        refresh_since(txn.where(f"NOT ({_WITHDRAWN.replace('l_shipdate', 'timestamp')})"), cfg, path, "2001-02")
    return _fs_all(IO.read_partitioned(spark, path))


# ---------------------------------------------------------------- stores with a growing dictionary

_LATE = "LARGE"
_LATE_TXN = f"SELECT * FROM ({O.TPCH_TXN_SQL}) WHERE NOT (category = {O.lit(_LATE)} AND \"timestamp\" < TIMESTAMP '2001-01-01')"


def _late_category_store(spark: SparkSession, sf_dir: str) -> str:
    """A store built without one category and without 2001, then refreshed from
    2001 on with all transactions: the category appears as a new class."""
    jan = F.lit("2001-01-01").cast("timestamp_ntz")
    base = scratch_path(spark, "fs-store")
    with _stored_transactions(spark, sf_dir) as txn:
        seen = txn.where((F.col("category") != _LATE) | (F.col("timestamp") >= jan))
        create_store(seen.where(F.col("timestamp") < jan), _STORED_CONFIG, base)
        refresh_store(seen, _STORED_CONFIG, base, "2001-01-15")  # any day of the period names it
    return base


@register("refresh_new_category", O.select_from_fs(_ALL, cte=O.feature_store_sql(_LATE_TXN)))
def q_refresh_new_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E9 + S8: a refresh in one commit that meets a new category; its column is
    0 in the periods before, all other columns stay."""
    fs, _ = read_store(spark, _late_category_store(spark, sf_dir))
    return _fs_all(fs)


@register("category_dictionary", f"""
WITH v AS (SELECT 'category' AS "pivot", category AS value, category = {O.lit(_LATE)} AS late FROM ({_LATE_TXN})
           UNION ALL SELECT 'payment', payment_method, FALSE FROM ({_LATE_TXN}) WHERE "timestamp" < TIMESTAMP '2001-01-01'),
d AS (SELECT DISTINCT * FROM v)
SELECT "pivot", value, CAST(row_number() OVER (PARTITION BY "pivot" ORDER BY late, value) - 1 AS INTEGER) AS class_index,
  CASE "pivot" WHEN 'category' THEN 'cat_' ELSE 'pay_' END || regexp_replace(value, '[^0-9A-Za-z_]', '_', 'g') AS column_name FROM d""")
def q_category_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E9 + M1: the stored dictionary after that refresh; the late category has
    the last class index, the others keep theirs."""
    return read_dictionary(spark, _late_category_store(spark, sf_dir) + "/dictionary")


@register("drop_catalog_partitions", O.feature_store_sql() + """
SELECT period, COUNT(*) AS n FROM fs WHERE period >= '1996-01' GROUP BY period""")
def q_drop_catalog_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8, catalog form: a partitioned table of the catalog loses its 1995
    partitions by ALTER TABLE; what is left per period."""
    fs, _ = tpch_feature_store(spark, sf_dir)
    path = scratch_path(spark, "fs-catalog")
    table = "fs_" + path.rsplit("-", 1)[1]
    fs.select("customer_id", "period").write.partitionBy("period").option("path", path).saveAsTable(table)
    IO.drop_table_partitions(spark, table, [f"1995-{m:02d}" for m in range(1, 13)])
    return spark.table(table).groupBy("period").agg(F.count(F.lit(1)).alias("n"))


_BASELINE = f"SELECT customer_id, '{FIXTURE_SPLIT.predict}' AS predict_period, top_category AS predicted_category FROM sup WHERE split = 'predict'"


@register("sink_predictions_csv", _SUP + "\n" + _BASELINE)
def q_sink_predictions_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction rows (here: the last-month baseline for the prediction
    anchors) written as header CSV and read back."""
    fs, cfg = tpch_feature_store(spark, sf_dir)
    sup = supervised_sequences(fs, cfg, SEQ, FIXTURE_SPLIT, dealt=True)
    preds = M.baseline_predictions(sup, cfg, FIXTURE_SPLIT)
    path = scratch_path(spark, "predictions")
    IO.write_predictions_csv(preds, path)
    return spark.read.option("header", True).option("mode", "FAILFAST").schema(preds.schema).csv(path)


@register("calendar_spine", O.feature_store_sql() + """
, bnd AS (SELECT customer_id, MIN(period_idx) AS lo, MAX(period_idx) AS hi FROM fs GROUP BY customer_id),
sp AS (SELECT customer_id, CAST(unnest(generate_series(lo, hi)) AS INTEGER) AS period_idx FROM bnd)
SELECT sp.customer_id, sp.period_idx, COALESCE(fs.period IS NOT NULL, FALSE) AS observed,
       COALESCE(fs.total_spent, 0) AS total_spent, COALESCE(fs.txn_count, 0) AS txn_count
FROM sp LEFT JOIN fs USING (customer_id, period_idx)""")
def q_calendar_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every calendar month between a customer's first and last month,
    observed flag and zero-filled totals."""
    fs, _ = tpch_feature_store(spark, sf_dir, keep_index=True)
    f = fill_calendar(fs.select("customer_id", "period_idx", "total_spent", "txn_count"))
    return f.select("customer_id", "period_idx", "observed",
                    F.coalesce("total_spent", F.lit(0.0)).alias("total_spent"),
                    F.coalesce("txn_count", F.lit(0).cast("long")).alias("txn_count"))


@register("running_balance", f"""
WITH led AS ({ORDER_LEDGER_SQL})
SELECT customer_id, order_key, "timestamp",
       CAST(opening_balance - SUM(amount) OVER (PARTITION BY customer_id ORDER BY "timestamp", order_key
                                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
       AS balance
FROM led""")
def q_running_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Opening balance minus cumulative order totals per customer."""
    b = running_balance(order_ledger(spark, sf_dir))
    return b.select("customer_id", "order_key", "timestamp", F.col("balance").cast("double").alias("balance"))


@register("period_gaps", O.feature_store_sql() + f"""
, g2 AS (SELECT customer_id, period_idx, LAG(period_idx) OVER (PARTITION BY customer_id ORDER BY period_idx) AS p
         FROM fs)
SELECT customer_id, {O.month_label_of_idx('p')} AS from_period, {O.month_label_of_idx('period_idx')} AS to_period,
       CAST(period_idx - p - 1 AS INTEGER) AS missing
FROM g2 WHERE period_idx - p > 1""")
def q_period_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing stretches in each customer's monthly history."""
    fs, _ = tpch_feature_store(spark, sf_dir, keep_index=True)
    g = period_gaps(fs, "customer_id", "period_idx")
    return g.select("customer_id",
                    period_label(index_start("from_idx", "month"), "month").alias("from_period"),
                    period_label(index_start("to_idx", "month"), "month").alias("to_period"),
                    F.col("missing").cast("int").alias("missing"))


@register("txn_number", """
SELECT o.o_custkey AS customer_id, l.l_shipdate AS "timestamp", l.l_orderkey AS order_key,
       l.l_linenumber AS line_number, CAST(l.l_extendedprice AS DECIMAL(18,2)) AS amount,
       'T' || CAST(row_number() OVER (ORDER BY o.o_custkey, l.l_shipdate, l.l_orderkey, l.l_linenumber, CAST(l.l_extendedprice AS DECIMAL(18,2))) AS VARCHAR)
       AS transaction_id
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey""")
def q_txn_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction numbers, unique in the table, customer by customer in time order."""
    t = tpch_transactions(spark, sf_dir).select("customer_id", "timestamp", "order_key", "line_number", "amount")
    return number_transactions(t, "customer_id", order=("timestamp", "order_key", "line_number", "amount"))


# ---------------------------------------------------------------- model operators

from .config import ModelConfig  # noqa: E402
from .operators.scaling import fit_scaler, scale_sequences, scaler_stats  # noqa: E402
from .operators.tables import rollup_rule  # noqa: E402
from pyspark.ml.functions import array_to_vector, vector_to_array  # noqa: E402

MODEL = ModelConfig()


def _feature_order() -> list[str]:
    rule = rollup_rule(_ALL, {c: "sum" for c in _CATS + _PAYS})
    return sorted(c for c in _ALL if rule[c] == "sum") + sorted(c for c in _ALL if rule[c] == "mean")


def sig6(c):
    """Six significant digits (engine-independent comparison of statistics)."""
    e = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(c))))
    return F.when(c == 0, F.lit(0.0)).otherwise(F.round(c / e, 6) * e)


def _sig6_sql(x: str) -> str:
    return f"CASE WHEN {x} = 0 THEN 0.0 ELSE round({x} / pow(10, floor(log10(abs({x})))), 6) * pow(10, floor(log10(abs({x})))) END"


def _train_steps_sql() -> str:
    order = _feature_order()
    casted = ", ".join(f"CAST(s.{O.ident(c)} AS DOUBLE) AS {O.ident(c)}" for c in order)
    lst = "[" + ", ".join(O.lit(c) for c in order) + "]"
    return _SUP + f""",
tr AS (SELECT {casted} FROM steps s JOIN sup ON s.customer_id = sup.customer_id AND s.period_idx = sup.period_idx
       WHERE sup.split = 'train'),
u AS (UNPIVOT tr ON COLUMNS(*) INTO NAME feature VALUE v),
st AS (SELECT CAST(list_position({lst}, feature) - 1 AS INTEGER) AS feature_index, feature,
              AVG(v) AS mean, STDDEV_POP(v) AS std FROM u GROUP BY feature),
st2 AS (SELECT *, CASE WHEN std = 0 OR std IS NULL THEN 1.0 ELSE std END AS scale FROM st),
pr AS (SELECT s.customer_id, s.period, sup.split, s.step, {", ".join(f"CAST(s.{O.ident(c)} AS DOUBLE) AS {O.ident(c)}" for c in order)}
       FROM steps s JOIN sup ON s.customer_id = sup.customer_id AND s.period_idx = sup.period_idx),
pu AS (UNPIVOT pr ON {", ".join(O.ident(c) for c in order)} INTO NAME feature VALUE v),
scaled AS (SELECT pu.customer_id, pu.period, pu.split, pu.step, st2.feature_index, pu.feature,
                  round((pu.v - st2.mean) / st2.scale, 4) AS value
           FROM pu JOIN st2 USING (feature))"""


def _sup_and_names(spark: SparkSession, sf_dir: str):
    fs, cfg = tpch_feature_store(spark, sf_dir)
    path = scratch_path(spark, "sequences")  # every reader of the sequences would build the features again
    with storing(spark):
        supervised_sequences(fs, cfg, SEQ, FIXTURE_SPLIT, dealt=True).write.parquet(path)
    names = feature_columns(rolled_features(fs, cfg, strict=False), cfg)
    return fs, cfg, spark.read.parquet(path), names


@register("scaler_stats", _train_steps_sql() + f"""
SELECT feature_index, feature, {_sig6_sql('mean')} AS mean, {_sig6_sql('std')} AS std, {_sig6_sql('scale')} AS scale
FROM st2""")
def q_scaler_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train-split mean / population std / scale per feature."""
    _, _, sup, names = _sup_and_names(spark, sf_dir)
    st = scaler_stats(sup.where("split = 'train'"), names)
    return st.select("feature_index", "feature", sig6(F.col("mean")).alias("mean"), sig6(F.col("std")).alias("std"),
                     sig6(F.col("scale")).alias("scale"))


@register("scaled_sequences", _train_steps_sql() + """
SELECT customer_id, period, split, step, feature, value FROM scaled""")
def q_scaled_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: the sequences of all three splits scaled with the train
    statistics, one row per (anchor, step, feature)."""
    _, _, sup, names = _sup_and_names(spark, sf_dir)
    means, scales = fit_scaler(sup.where("split = 'train'"), names)
    sc = scale_sequences(sup, means, scales)
    steps = sc.select("customer_id", "period", "split", F.posexplode("seq_scaled").alias("step", "_x"))
    vals = steps.select("customer_id", "period", "split", "step", F.posexplode("_x").alias("_j", "value"))
    names_arr = F.array(*[F.lit(n) for n in names])
    return vals.select("customer_id", "period", "split", "step", F.element_at(names_arr, F.col("_j") + 1).alias("feature"),
                       F.round("value", 4).alias("value"))


@register("sequence_vectors", _train_steps_sql() + f"""
SELECT customer_id, period, split, CAST(step * {len(_ALL)} + feature_index AS INTEGER) AS pos, value FROM scaled""")
def q_sequence_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: flattened L·F model vectors of the anchors of all three splits,
    one row per (anchor, position)."""
    _, _, sup, names = _sup_and_names(spark, sf_dir)
    means, scales = fit_scaler(sup.where("split = 'train'"), names)
    v = M.vectors(sup, means, scales)
    e = v.select("customer_id", "period", "split", F.posexplode(vector_to_array("features")).alias("pos", "value"))
    return e.select("customer_id", "period", "split", F.col("pos").cast("int").alias("pos"), F.round("value", 4).alias("value"))


@register("eval_accuracy", _SUP + """
SELECT split, COUNT(*) AS n,
       CAST(SUM(CASE WHEN top_category = target_category THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS accuracy
FROM sup WHERE split IN ('train', 'test') GROUP BY split""")
def q_eval_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: the scoring of fitted models, here on the last-month baseline
    (predict the anchor's own top category)."""
    from .operators.labels import class_index
    _, cfg, sup, _ = _sup_and_names(spark, sf_dir)
    guess = sup.where("split IN ('train', 'test')").withColumn("prediction", class_index("top_category", cfg.categories))
    return M.scores(guess)


def _trained(spark: SparkSession, sf_dir: str, model: ModelConfig = MODEL):
    res, preds, _ = _trained_with_sequences(spark, sf_dir, model)
    return res, preds


def _trained_with_sequences(spark: SparkSession, sf_dir: str, model: ModelConfig = MODEL):
    """The fitted model, its predictions and the sequences that both were made from."""
    fs, cfg = tpch_feature_store(spark, sf_dir)
    path = scratch_path(spark, "sequences")
    res, preds = M.train_and_predict(fs, cfg, SEQ, FIXTURE_SPLIT, model, dealt=True, keep=path)
    return res, preds, spark.read.parquet(path)


_N_TRAIN = "(SELECT COUNT(*) FROM sup WHERE split = 'train')"


@register("train_next_category", _SUP + f"""
SELECT {len(_ALL) * SEQ.seq_len} AS n_inputs, {len(O.TPCH_CATEGORIES)} AS n_classes, {_N_TRAIN} AS train_sequences,
       (SELECT COUNT(*) FROM sup WHERE split = 'test') AS test_sequences,
       (SELECT COUNT(*) FROM sup WHERE split = 'predict') AS predict_sequences""")
def q_train_next_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: fit the classifier; one row describing what it was fitted on."""
    res, preds = _trained(spark, sf_dir)
    row = (res.model.numFeatures, res.model.numClasses, res.metrics["train"]["n"], res.metrics["test"]["n"], preds.count())
    return spark.createDataFrame([row], "n_inputs int, n_classes int, train_sequences long, test_sequences long, predict_sequences long")


def _scored_rows(sup: DataFrame, res) -> DataFrame:
    """The train and test examples as the model saw them."""
    return M.vectors(sup.where("split IN ('train', 'test')"), res.means, res.scales).select("features", "label", "split")


def _close(a, b):
    return F.abs(F.col(a) - F.col(b)) <= 1e-9 * F.greatest(F.lit(1.0), F.abs(F.col(b)))


def _against_weights(sup: DataFrame, res, rows: DataFrame) -> DataFrame:
    """Reported n, accuracy and log loss beside those recomputed from the fitted
    weights: an accuracy that is off by one example, or a loss off by 1e-9, is not ok."""
    own = M.recomputed_scores(res, _scored_rows(sup, res)).select(
        "split", F.col("n").alias("_n"), F.col("accuracy").alias("_accuracy"), F.col("log_loss").alias("_log_loss"))
    both = rows.join(own, "split")
    return both.withColumns({"accuracy_ok": (F.col("n") == F.col("_n")) & _close("accuracy", "_accuracy"), "log_loss_ok": _close("log_loss", "_log_loss")})


@register("eval_model", _SUP + """
SELECT split, COUNT(*) AS n, TRUE AS accuracy_ok, TRUE AS log_loss_ok FROM sup WHERE split IN ('train', 'test') GROUP BY split""")
def q_eval_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5 + M6: accuracy and log loss of the fitted model on train and test,
    against both recomputed from its weights by array expressions."""
    res, _, sup = _trained_with_sequences(spark, sf_dir)
    rows = [(k, int(v["n"]), v["accuracy"], v["log_loss"]) for k, v in res.metrics.items() if k in ("train", "test")]
    reported = spark.createDataFrame(rows, "split string, n long, accuracy double, log_loss double")
    return _against_weights(sup, res, reported).select("split", "n", "accuracy_ok", "log_loss_ok")


@register("train_history", _SUP + f"""
SELECT CAST(iteration AS INTEGER) AS iteration, split, COUNT(*) AS n, TRUE AS falls, CASE WHEN iteration = {MODEL.epochs} THEN TRUE END AS accuracy_ok,
  CASE WHEN iteration = {MODEL.epochs} THEN TRUE END AS log_loss_ok
FROM sup, (SELECT unnest([5, {MODEL.epochs}]) AS iteration) WHERE split IN ('train', 'test') GROUP BY ALL""")
def q_train_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: train and test loss and accuracy after every fifth iteration.  The
    last report is checked against the final weights; the train loss must fall
    from report to report (a leg of l-bfgs begins at the weights of the one before
    and never ends above; the first report may still lie above the loss of the
    class frequencies)."""
    res, _, sup = _trained_with_sequences(spark, sf_dir, replace(MODEL, report_every=5))
    checked = _against_weights(sup, res, M.report_frame(spark, res))
    last = F.col("iteration") == MODEL.epochs
    train = [r["log_loss"] for r in res.report if r["split"] == "train"]
    falls = len(train) == 2 and all(b < a for a, b in zip(train, train[1:]))
    return checked.select("iteration", "split", "n", F.lit(falls).alias("falls"), F.when(last, F.col("accuracy_ok")).alias("accuracy_ok"),
                          F.when(last, F.col("log_loss_ok")).alias("log_loss_ok"))


def _prior_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train and test examples with the class frequencies of train as probabilities."""
    _, cfg, sup, _ = _sup_and_names(spark, sf_dir)
    counts = {int(r["label"]): r["count"] for r in sup.where("split = 'train'").groupBy("label").count().collect()}
    share = [counts.get(i, 0) / sum(counts.values()) for i in range(len(cfg.categories))]
    vector = array_to_vector(F.array(*[F.lit(x) for x in share]))
    return sup.where("split IN ('train', 'test')").select("split", "label").withColumns(
        {"probability": vector, "prediction": F.lit(float(share.index(max(share))))})


@register("eval_class_frequencies", _SUP + """,
freq AS (SELECT label, COUNT(*) * 1.0 / SUM(COUNT(*)) OVER () AS p FROM sup WHERE split = 'train' GROUP BY label),
best AS (SELECT label FROM freq ORDER BY p DESC, label LIMIT 1)
SELECT split, COUNT(*) AS n, AVG(CASE WHEN sup.label = best.label THEN 1.0 ELSE 0 END) AS accuracy, round(AVG(-ln(freq.p)), 9) AS log_loss
FROM sup LEFT JOIN freq ON freq.label = sup.label, best WHERE split IN ('train', 'test') GROUP BY split""")
def q_eval_class_frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5 + M6 with their values: the scoring of models over a probability vector
    that SQL knows, the class frequencies of train."""
    return M.scores(_prior_rows(spark, sf_dir)).withColumn("log_loss", F.round("log_loss", 9))


CENTROID = ModelConfig(kind="centroid")


def _centroid_sql() -> str:
    cats = "[" + ", ".join(O.lit(c) for c in O.TPCH_CATEGORIES) + "]"
    return _train_steps_sql() + f""",
z AS (SELECT pu.customer_id, pu.period, pu.split, pu.step, st2.feature_index AS j, (pu.v - st2.mean) / st2.scale AS z FROM pu JOIN st2 USING (feature)),
lz AS (SELECT z.*, sup.label FROM z JOIN sup USING (customer_id, period)),
mu AS (SELECT label, step, j, AVG(z) AS m FROM lz WHERE split = 'train' GROUP BY ALL),
cl AS (SELECT label, SUM(m * m) / 2 AS half FROM mu GROUP BY label),
pr0 AS (SELECT label, ln(COUNT(*) * 1.0 / SUM(COUNT(*)) OVER ()) AS lp FROM sup WHERE split = 'train' GROUP BY label),
dot AS (SELECT z.customer_id, z.period, z.split, mu.label AS k, SUM(z.z * mu.m) AS d FROM z JOIN mu ON mu.step = z.step AND mu.j = z.j GROUP BY ALL),
sc AS (SELECT customer_id, period, split, k, d - half + lp AS s FROM dot JOIN cl ON cl.label = k JOIN pr0 ON pr0.label = k),
so AS (SELECT *, exp(s - MAX(s) OVER q) / SUM(exp(s)) OVER q * exp(MAX(s) OVER q) AS p, row_number() OVER (PARTITION BY customer_id, period ORDER BY s DESC, k) AS r
       FROM sc WINDOW q AS (PARTITION BY customer_id, period)),
named AS (SELECT *, {cats}[CAST(k AS INTEGER) + 1] AS category FROM so)"""


@register("centroid_predictions", _centroid_sql() + f"""
SELECT customer_id, '{FIXTURE_SPLIT.predict}' AS predict_period, category AS predicted_category, round(p, 6) AS probability
FROM named WHERE split = 'predict' AND r = 1""")
def q_centroid_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3 / M4 / M8 / O4 / F14 with their values: fit, forward pass, softmax and
    argmax of the nearest-mean classifier, all stated in SQL as well."""
    _, preds = _trained(spark, sf_dir, CENTROID)
    return preds.select("customer_id", "predict_period", "predicted_category", F.round("probability", 6).alias("probability"))


@register("centroid_metrics", _centroid_sql() + """
SELECT n.split, COUNT(*) AS n, AVG(CASE WHEN n.r = 1 THEN 1.0 ELSE 0 END) AS accuracy, round(AVG(-ln(greatest(n.p, 1e-15))), 6) AS log_loss
FROM named n JOIN sup ON sup.customer_id = n.customer_id AND sup.period = n.period AND sup.label = n.k
WHERE n.split IN ('train', 'test') GROUP BY n.split""")
def q_centroid_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3 / M5 / M6 with their values: hold-out accuracy and cross-entropy of the
    fitted nearest-mean classifier."""
    res, _ = _trained(spark, sf_dir, CENTROID)
    rows = [(k, int(v["n"]), v["accuracy"], round(v["log_loss"], 6)) for k, v in res.metrics.items() if k in ("train", "test")]
    return spark.createDataFrame(rows, "split string, n long, accuracy double, log_loss double")


_PREDICTED = f"SELECT customer_id, '{FIXTURE_SPLIT.predict}' AS predict_period, TRUE AS category_ok, TRUE AS probabilities_ok FROM sup WHERE split = 'predict'"


def _prediction_checks(preds: DataFrame, res, sup: DataFrame) -> DataFrame:
    """A row per prediction: whether the category is the one, and every
    probability within 1e-9 of the one, that the fitted weights give by array
    expressions (the model's own transform made the predictions)."""
    cats = F.array(*[F.lit(c) for c in O.TPCH_CATEGORIES])
    own = M.forward(res, M.vectors(sup.where("split = 'predict'"), res.means, res.scales)).select("customer_id", F.col("probabilities").alias("_p"))
    best = F.element_at(cats, F.array_position("_p", F.array_max("_p")).cast("int"))
    near = F.forall(F.zip_with("probabilities", "_p", lambda a, b: F.coalesce(F.abs(a - b) <= 1e-9, F.lit(False))), lambda x: x)
    return preds.join(own, "customer_id", "left").select(
        "customer_id", "predict_period", F.coalesce(F.col("predicted_category") == best, F.lit(False)).alias("category_ok"),
        F.coalesce(near & (F.size("probabilities") == len(O.TPCH_CATEGORIES)), F.lit(False)).alias("probabilities_ok"))


@register("predict_next_category", _SUP + "\n" + _PREDICTED)
def q_predict_next_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One predicted category per prediction anchor, checked
    against the fitted weights."""
    res, preds, sup = _trained_with_sequences(spark, sf_dir)
    return _prediction_checks(preds, res, sup)


@register("predict_from_tables", _SUP + "\n" + _PREDICTED)
def q_predict_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 → S7 → S3 → J2 → A12 → L2 → L3: the five narrow tables written, read
    back and merged, then rolled up, sequenced, trained on and predicted from
    (here by multinomial logistic regression)."""
    tables, cfg = _narrow_tables_alone(spark, sf_dir)
    path = scratch_path(spark, "sequences")
    res, preds = M.train_and_predict(merge_batches(tables), cfg, SEQ, FIXTURE_SPLIT, ModelConfig(kind="logistic", reg_param=0.01), dealt=True, keep=path)
    return _prediction_checks(preds, res, spark.read.parquet(path))


@register("period_ranges", """
WITH b AS (SELECT o_custkey AS customer_id, CAST(date_trunc('month', MIN(o_orderdate)) AS DATE) AS lo, CAST(date_trunc('month', MAX(o_orderdate)) AS DATE) AS hi,
  CAST(MIN(o_orderdate) AS DATE) AS first_day, CAST(MAX(o_orderdate) AS DATE) AS last_day FROM orders GROUP BY o_custkey)
SELECT customer_id, CAST(lo - INTERVAL 1 MONTH AS DATE) AS month_before, CAST(hi + INTERVAL 1 MONTH AS DATE) AS month_after,
       CAST(date_diff('month', lo, hi) + 1 AS INTEGER) AS n_months, CAST(date_diff('day', first_day, last_day) + 1 AS INTEGER) AS n_days,
       CAST(lo + INTERVAL 1 MONTH * (date_diff('month', lo, hi) // 2) AS DATE) AS middle_month
FROM b""")
def q_period_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """month and day ranges between a customer's first and last
    order, the months before and after."""
    from .functions.periods import add_periods, period_range
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    b = o.groupBy(F.col("o_custkey").alias("customer_id")).agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    months = period_range("lo", "hi", "month")
    return b.select("customer_id", add_periods(period_start("lo"), -1).alias("month_before"), add_periods(period_start("hi"), 1).alias("month_after"),
                    F.size(months).alias("n_months"), F.size(period_range("lo", "hi", "day")).alias("n_days"),
                    F.element_at(months, F.floor((F.size(months) - 1) / 2).cast("int") + 1).alias("middle_month"))


@register("top_category_long", _SUP + "\nSELECT customer_id, period, top_category FROM m")
def q_top_category_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2, long form: spend per (customer, month, category) from the
    transactions, ranked inside each customer-month (spend desc, name asc).
    The ranking window sees at most one row per category of a group."""
    from .operators.features import period_category_spend
    from .operators.labels import top_category_long
    spend = period_category_spend(tpch_transactions(spark, sf_dir), TPCH_CONFIG)
    top = top_category_long(spend, ["customer_id", "period_idx"], "category", "spend")
    return top.select("customer_id", period_label(index_start("period_idx", "month"), "month").alias("period"),
                      "top_category")


@register("category_diversity_long", O.select_from_fs(["category_diversity"]))
def q_category_diversity_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11 from the long form of category spend."""
    from .operators.features import category_diversity, period_category_spend
    spend = period_category_spend(tpch_transactions(spark, sf_dir), TPCH_CONFIG)
    d = category_diversity(spend, ["customer_id", "period_idx"])
    return d.select("customer_id", period_label(index_start("period_idx", "month"), "month").alias("period"), "category_diversity")


# ---------------------------------------------------------------- bucketed merge, quarantine, observed writes, lost anchors

from .operators.sequences import history_runs, rejected_anchors  # noqa: E402
from .operators.tables import merge_bucketed, observe_counts, observe_keys  # noqa: E402


@register("merge_bucketed_tables", _FS_ALL_SQL)
def q_merge_bucketed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 without a shuffle: the five narrow tables bucketed and sorted by
    (customer, period), merged bucket by bucket."""
    base = scratch_path(spark, "fs-bucketed")
    with _stored_transactions(spark, sf_dir) as txn:
        batches, cfg = build_feature_batches(txn, _STORED_CONFIG)
        IO.write_partitioned(batches, f"{base}/feature_store")
    stored, tag = IO.read_partitioned(spark, f"{base}/feature_store"), base.rsplit("-", 1)[1]
    tables, buckets = [], IO.bucket_count(stored)
    for name, df in narrow_tables(stored, cfg).items():
        IO.write_bucketed(df, f"{name}_{tag}", f"{base}/{name}", buckets=buckets)
        tables.append(spark.table(f"{name}_{tag}"))
    IO.remove(spark, f"{base}/feature_store")
    return _fs_all(merge_bucketed(tables))


_DAMAGE_SQL = f"""
WITH t AS (SELECT o_custkey, l_orderkey, l_linenumber, l_shipdate, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, p_type, l_suppkey, o_orderpriority,
                  CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS is_online
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
x AS (SELECT *, l_orderkey % 11 = 0 AS no_amount, l_orderkey % 13 = 0 AS no_time, l_orderkey % 17 = 0 AS mils, l_orderkey % 19 = 0 AS short FROM t),
c AS (SELECT *, concat_ws(',', o_custkey, l_orderkey, l_linenumber, CASE WHEN no_time THEN '2001-02-30 10:00:00' ELSE strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') END,
    CASE WHEN no_amount THEN 'n/a' WHEN mils THEN amount::VARCHAR || '5' ELSE amount::VARCHAR END, p_type, l_suppkey, o_orderpriority)
    || CASE WHEN short THEN '' ELSE ',' || is_online END AS record FROM x)"""
_LINE_SCHEMA = StructType([StructField("customer_id", LongType()), StructField("order_key", LongType()), StructField("line_number", LongType()),
                           StructField("timestamp", StringType()), StructField("amount", DecimalType(18, 2)), StructField("category", StringType()),
                           StructField("merchant_id", LongType()), StructField("payment_method", StringType()), StructField("is_online", IntegerType())])


def _quarantined(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The transactions as text lines, some of them damaged, through the quarantine."""
    t = tpch_transactions(spark, sf_dir)
    hit = lambda n: F.col("order_key") % n == 0
    time = F.when(hit(13), "2001-02-30 10:00:00").otherwise(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
    amount = F.col("amount").cast("string")
    amount = F.when(hit(11), "n/a").when(hit(17), F.concat(amount, F.lit("5"))).otherwise(amount)
    line = F.concat_ws(",", "customer_id", "order_key", "line_number", time, amount, "category", "merchant_id", "payment_method")
    path = scratch_path(spark, "txn-lines")
    t.select(F.when(hit(19), line).otherwise(F.concat_ws(",", line, "is_online")).alias("value")).write.text(path)
    return IO.quarantine_transactions_csv(spark, path, scratch_path(spark, "quarantine"), _LINE_SCHEMA, header=False)


@register("quarantine_accepted", _DAMAGE_SQL + """
SELECT o_custkey AS customer_id, l_orderkey AS order_key, CAST(l_linenumber AS BIGINT) AS line_number, l_shipdate AS "timestamp", amount, p_type AS category,
  l_suppkey AS merchant_id, o_orderpriority AS payment_method, is_online FROM c WHERE NOT (no_amount OR no_time OR mils OR short)""")
def q_quarantine_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S2: the good records of a damaged transaction file, typed."""
    return _quarantined(spark, sf_dir)[0]


@register("quarantine_rejects", _DAMAGE_SQL + """
SELECT record, CASE WHEN short THEN 'wrong number of fields' ELSE concat_ws('; ', CASE WHEN no_time THEN 'timestamp: not timestamp' END,
  CASE WHEN no_amount THEN 'amount: not decimal(18,2)' WHEN mils THEN 'amount: more than 2 decimals' END) END AS reason
FROM c WHERE no_amount OR no_time OR mils OR short""")
def q_quarantine_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + S2: the bad records of that file, as text, each with the reasons."""
    return _quarantined(spark, sf_dir)[1]


@register("observed_keys", f"""
WITH t AS (SELECT CASE WHEN l_orderkey % 100 = 0 THEN NULL ELSE o_custkey END AS customer_id, l_orderkey, l_linenumber
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
k AS (SELECT customer_id, COUNT(*) AS n FROM t GROUP BY customer_id, l_orderkey, l_linenumber)
SELECT CAST(SUM(n) AS BIGINT) AS n_rows, CAST(SUM(n) FILTER (customer_id IS NULL) AS BIGINT) AS n_null_keys,
  CAST(SUM(n - 1) FILTER (customer_id IS NOT NULL) AS BIGINT) AS n_repeated_keys FROM k""")
def q_observed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5 inside the job that writes: rows, NULL keys and repeated keys of the
    sparse transactions, counted while they are written."""
    rows, seen = observe_keys(sparse_transactions(spark, sf_dir), _SPARSE_KEYS)
    rows.write.parquet(scratch_path(spark, "observed"))
    got = seen.get
    return spark.createDataFrame([tuple(got[c] for c in ("n_rows", "n_null_keys", "n_repeated_keys"))], "n_rows long, n_null_keys long, n_repeated_keys long")


@register("observed_split_counts", _SUP + "\nSELECT split, COUNT(*) AS n FROM sup GROUP BY split")
def q_observed_split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E16 inside the job that writes the sequences: examples per split."""
    fs, cfg = tpch_feature_store(spark, sf_dir)
    rows, seen = observe_counts(supervised_sequences(fs, cfg, SEQ, FIXTURE_SPLIT, dealt=True), "split", ("train", "test", "predict"))
    rows.write.parquet(scratch_path(spark, "observed-sequences"))
    return spark.createDataFrame(list(seen.get.items()), "split string, n long")


@register("history_runs", O.feature_store_sql() + f"""
, r AS (SELECT customer_id, period_idx, period_idx - row_number() OVER (PARTITION BY customer_id ORDER BY period_idx) AS run FROM fs)
SELECT customer_id, {O.month_label_of_idx('MIN(period_idx)')} AS from_period, {O.month_label_of_idx('MAX(period_idx)')} AS to_period, COUNT(*) AS length
FROM r GROUP BY customer_id, run""")
def q_history_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W7 as islands: stretches of contiguous months of each customer."""
    fs, _ = tpch_feature_store(spark, sf_dir, keep_index=True)
    label = lambda c: period_label(index_start(c, "month"), "month")
    return history_runs(fs).select("customer_id", label("from_idx").alias("from_period"), label("to_idx").alias("to_period"), "length")


@register("rejected_anchors", _SUP + f"""
, firsts AS (SELECT customer_id, MIN(period_idx) AS first_idx FROM m GROUP BY customer_id),
x AS (SELECT m.customer_id, m.period, m.period_idx, first_idx, m.period_idx - b AS miss FROM m JOIN firsts USING (customer_id), (SELECT unnest(range({SEQ.seq_len})) AS b)),
y AS (SELECT x.*, bool_or(miss < first_idx) OVER q AS early, bool_or(miss > first_idx) OVER q AS late
      FROM x ANTI JOIN m ON m.customer_id = x.customer_id AND m.period_idx = x.miss WINDOW q AS (PARTITION BY x.customer_id, x.period_idx))
SELECT customer_id, period, {O.month_label_of_idx('miss')} AS missing_period,
  CASE WHEN early AND late THEN 'both' WHEN early THEN 'short' ELSE 'gap' END AS reason FROM y""")
def q_rejected_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E15 + W7: the anchors that lack a complete history, with each missing month
    of the look-back and the reason."""
    rolled, _ = _rolled(spark, sf_dir)
    rows = rejected_anchors(rolled, "customer_id", "period_idx", SEQ.seq_len)
    label = lambda c: period_label(index_start(c, "month"), "month")
    return rows.select("customer_id", label("period_idx").alias("period"), F.explode("missing").alias("_m"), "reason").select(
        "customer_id", "period", label("_m").alias("missing_period"), "reason")


# ---------------------------------------------------------------- maps, states, sparse vectors

from .config import TxnColumns  # noqa: E402
from .operators import states as S  # noqa: E402
from .operators.dictionary import ENTRY, entries, pivot_values  # noqa: E402
from .plans import sparse as SP  # noqa: E402
from .plans.feature_store import build_feature_maps, maps_from_states  # noqa: E402


def _wide(maps: DataFrame) -> DataFrame:
    """The listed categories and payment methods of a map table as columns."""
    wide = S.wide_pivots(maps, "category_spend", O.TPCH_CATEGORIES, _CATS)
    return _fs_all(S.wide_pivots(wide, "payment_count", O.TPCH_PAYMENTS, _PAYS))


@register("feature_store_maps", _FS_ALL_SQL)
def q_feature_store_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 with map pivots (one pass, no discovery), its maps as columns."""
    return _wide(build_feature_maps(tpch_transactions(spark, sf_dir), TPCH_CONFIG))


_MANY_TXN = f"""SELECT o_custkey AS customer_id, l_shipdate AS ts, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
  CAST(l_partkey AS VARCHAR) || '/' || CAST(l_suppkey AS VARCHAR) || '.' || CAST(l_linenumber AS VARCHAR) AS category,
  CAST(l_orderkey AS VARCHAR) AS payment FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey"""


@register("many_value_pivots", f"""
WITH t AS ({_MANY_TXN}), b AS (SELECT *, {O.label_sql('ts', 'month')} AS period FROM t)
SELECT customer_id, period, 'category_spend' AS pivot_name, category AS value, CAST(SUM(amount) AS DOUBLE) AS amount FROM b GROUP BY ALL
UNION ALL SELECT customer_id, period, 'payment_count', payment, CAST(COUNT(amount) AS DOUBLE) FROM b GROUP BY ALL""")
def q_many_value_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9, A10 over tens of thousands of different values (part, supplier and line
    as category, order as payment method), the maps flattened."""
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    p = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey")
    t = (li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey).select(
        F.col("o_custkey").alias("customer_id"), F.col("l_shipdate").alias("timestamp"), F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
        F.concat("l_partkey", F.lit("/"), "l_suppkey", F.lit("."), "l_linenumber").alias("category"), F.col("l_suppkey").alias("merchant_id"),
        F.col("l_orderkey").alias("payment_method"), F.lit(1).alias("is_online")))
    maps = build_feature_maps(t, TPCH_CONFIG)
    flat = [S.long_pivot(maps, m, ["customer_id", "period"]).select(
        "customer_id", "period", F.lit(m).alias("pivot_name"), F.col("key").alias("value"), F.col("value").cast("double").alias("amount"))
        for m in ("category_spend", "payment_count")]
    return flat[0].unionByName(flat[1])


def _rolled_states(txns: DataFrame, spark: SparkSession, cfg: FeatureConfig, fine: str, coarse: str) -> tuple[DataFrame, FeatureConfig]:
    """States of the ``fine`` unit, stored, read back and merged to ``coarse`` periods."""
    path = scratch_path(spark, "states")
    S.period_states(txns, replace(cfg, period_unit=fine, require_pivot_rows=False)).write.parquet(path)
    return S.roll_states(spark.read.parquet(path), replace(cfg, period_unit=fine), coarse), replace(cfg, period_unit=coarse)


@register("daily_states_to_months", _FS_ALL_SQL)
def q_daily_states_to_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored daily states merged to months give the direct monthly
    build, deviations, ratios and pivots included."""
    return _wide(maps_from_states(*_rolled_states(tpch_transactions(spark, sf_dir), spark, TPCH_CONFIG, "day", "month")))


@register("sparse_states_to_months", O.select_from_fs(_ALL, cte=O.feature_store_sql(SPARSE_TXN_SQL)))
def q_sparse_states_to_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over transactions with NULLs: NULL customers, amounts, categories and flags."""
    return _wide(maps_from_states(*_rolled_states(sparse_transactions(spark, sf_dir), spark, TPCH_CONFIG, "day", "month")))


@register("merchant_sketches", f"""
WITH t AS ({O.TPCH_TXN_SQL}), d AS (SELECT category, "timestamp"::DATE AS day, COUNT(DISTINCT customer_id) AS n FROM t GROUP BY ALL),
s AS (SELECT category, CAST(year(day) AS VARCHAR) AS period, CAST(SUM(n) AS BIGINT) AS summed_days FROM d GROUP BY ALL)
SELECT s.category, s.period, COUNT(DISTINCT customer_id) AS distinct_exact, any_value(summed_days) AS summed_days, TRUE AS within_bound
FROM t JOIN s ON s.category = t.category AND s.period = CAST(year("timestamp") AS VARCHAR) GROUP BY s.category, s.period""")
def q_merchant_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 + A12: distinct counts that roll up (here: customers per category and
    year from daily sketches), beside the exact count and the sum of the daily
    counts, which counts twice; four standard errors are the bound."""
    cfg = replace(TPCH_CONFIG, cols=TxnColumns(entity="category", category="payment_method", merchant="customer_id", payment=None), payments=(), many_entities=False)
    txns = tpch_transactions(spark, sf_dir)
    path = scratch_path(spark, "sketches")
    S.period_states(txns, replace(cfg, period_unit="day")).write.parquet(path)
    days = spark.read.parquet(path)
    year = period_index(index_start("period_idx", "day"), "year")
    summed = days.groupBy("category", year.alias("period_idx")).agg(F.sum("unique_merchants").alias("summed_days"))
    rolled = S.roll_states(days, replace(cfg, period_unit="day"), "year").select("category", "period_idx", F.hll_sketch_estimate("merchant_sketch").alias("estimate"))
    exact = S.period_states(txns, replace(cfg, period_unit="year")).select("category", "period_idx", F.col("unique_merchants").alias("distinct_exact"))
    both = exact.join(rolled, ["category", "period_idx"], "left").join(summed, ["category", "period_idx"], "left")
    off = F.abs(F.col("estimate") - F.col("distinct_exact"))
    return both.select("category", F.col("period_idx").cast("string").alias("period"), "distinct_exact", "summed_days",
                       F.coalesce(off <= 4 * S.sketch_error() * F.col("distinct_exact") + 1, F.lit(False)).alias("within_bound"))


_DIRTY_RATIO = "CASE WHEN period_idx % 3 = 0 THEN NULL ELSE online_ratio END"
_DIRTY_STD = "CASE WHEN period_idx % 5 = 0 THEN CAST('NaN' AS DOUBLE) ELSE spend_std_dev END"


def _name_rule_sql() -> str:
    rule = rollup_rule(_ALL, {c: "sum" for c in _CATS + _PAYS})
    longs = {"txn_count", "unique_merchants", "category_diversity", "prev_txn_count", "txn_growth", *_PAYS}
    cols = []
    for c in _ALL:
        x = O.ident(c)
        if c == "spend_std_dev":
            x = f"CASE WHEN isnan({x}) THEN NULL ELSE {x} END"
        if rule[c] == "mean":
            cols.append(f"CAST(CAST(AVG({x}) AS FLOAT) AS DOUBLE) AS {O.ident(c)}")
        elif c in longs:
            cols.append(f"CAST(SUM({x}) AS BIGINT) AS {O.ident(c)}")
        else:
            cols.append(f"CAST(CAST(SUM({x}) AS FLOAT) AS DOUBLE) AS {O.ident(c)}")
    return O.feature_store_sql(unit="day") + f""",
dirty AS (SELECT * REPLACE ({_DIRTY_RATIO} AS online_ratio, {_DIRTY_STD} AS spend_std_dev) FROM fs)
SELECT customer_id, CAST(date_trunc('month', CAST(period AS DATE)) AS DATE) AS period_start, {", ".join(cols)} FROM dirty
GROUP BY customer_id, date_trunc('month', CAST(period AS DATE))"""


@register("daily_name_rule_rollup", _name_rule_sql())
def q_daily_name_rule_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A12 by the name rule where it merges rows: daily features to months, with
    NULL and NaN values to skip (a mean of averages; states give the true one).
    Compared as 32-bit floats: sums of doubles depend on their order, and averages
    of cents often lie midway between two decimals."""
    daily, cfg = build_feature_store(tpch_transactions(spark, sf_dir), replace(TPCH_CONFIG, period_unit="day"), keep_index=True)
    dirty = daily.withColumns({"online_ratio": F.expr(_DIRTY_RATIO), "spend_std_dev": F.expr(_DIRTY_STD)}).drop("period_idx")
    explicit = {c: "sum" for c in category_columns(cfg) + payment_columns(cfg)}
    out = monthly_rollup(dirty, unit="month", explicit=explicit).drop("period_idx")
    kinds = dict(out.dtypes)
    return out.select("customer_id", "period_start", *[F.col(c).cast("float").cast("double").alias(c) if kinds[c] == "double" else F.col(c) for c in _ALL])


_PLAIN = sorted(c for c in _ALL if c not in (*_CATS, *_PAYS))
_PLACE = {c: i for i, c in enumerate(_PLAIN)} | {c: len(_PLAIN) + 2 * i for i, c in enumerate(_CATS)} | {c: len(_PLAIN) + 2 * i + 1 for i, c in enumerate(_PAYS)}


def _kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read back: a join with it is planned by the size of its files."""
    path = scratch_path(df.sparkSession, name)
    with storing(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@register("sparse_sequence_vectors", _train_steps_sql() + f"""
SELECT pu.customer_id, pu.period, pu.split, CAST({SEQ.seq_len} * CASE feature {" ".join(f"WHEN {O.lit(c)} THEN {i}" for c, i in _PLACE.items())} END
  + pu.step AS INTEGER) AS pos, round(pu.v / st2.scale, 4) AS value FROM pu JOIN st2 USING (feature) WHERE pu.v <> 0""")
def q_sparse_sequence_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 + M3 in sparse form from the maps: the entries of the stored sparse
    vectors of all three splits, scaled without centring."""
    path = scratch_path(spark, "sparse-sequences")
    with _stored_transactions(spark, sf_dir) as txn:
        words = _kept(entries(pivot_values(txn, TPCH_CONFIG), spark.createDataFrame([], ENTRY), TPCH_CONFIG), "sparse-words")
        maps = build_feature_maps(txn, TPCH_CONFIG, keep_index=True)
        seqs = SP.sparse_sequences(maps, words, TPCH_CONFIG, SEQ, FIXTURE_SPLIT)
        with storing(spark):
            seqs.write.parquet(path)
    seqs = spark.read.parquet(path)
    scales = _kept(SP.sparse_scales(seqs.where("split = 'train'"), SEQ.seq_len), "sparse-scales")
    size = SP.vector_size(words, SP.plain_columns(maps, TPCH_CONFIG), SEQ.seq_len)
    v = SP.store_vectors(SP.sparse_vectors(seqs, scales, TPCH_CONFIG, SEQ.seq_len, size), scratch_path(spark, "sparse-vectors"))
    flat = v.select("customer_id", "period", "split", F.posexplode(vector_to_array("features")).alias("pos", "value"))
    return flat.where("value <> 0").select("customer_id", "period", "split", F.col("pos").cast("int").alias("pos"), F.round("value", 4).alias("value"))


# ---------------------------------------------------------------- quarterly variant

def _quarter_sql() -> str:
    names = _CATS
    mx = "greatest(" + ", ".join(O.ident(n) for n in names) + ")"
    top = "CASE " + " ".join(f"WHEN {O.ident(n)} = {mx} THEN {O.lit(c)}"
                             for n, c in zip(names, O.TPCH_CATEGORIES)) + " END"
    return O.feature_store_sql(unit="quarter") + f""",
m AS (SELECT customer_id, period, period_idx, {top} AS top_category FROM fs),
l AS (SELECT m.*, LEAD(period_idx) OVER w AS nidx, LEAD(top_category) OVER w AS ntop
      FROM m WINDOW w AS (PARTITION BY customer_id ORDER BY period_idx)),
fullh AS (SELECT a.customer_id, a.period_idx FROM m a JOIN m b
          ON a.customer_id = b.customer_id AND b.period_idx BETWEEN a.period_idx - 2 AND a.period_idx
          GROUP BY a.customer_id, a.period_idx HAVING COUNT(*) = 3)
SELECT customer_id, period, CAST(nidx // 4 AS VARCHAR) || 'Q' || CAST(nidx % 4 + 1 AS VARCHAR) AS label_period,
       ntop AS target_category
FROM l JOIN fullh USING (customer_id, period_idx) WHERE nidx = period_idx + 1"""


@register("quarterly_adjacent_labels", _quarter_sql())
def q_quarterly_adjacent_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Period unit = quarter: anchors with a full 3-quarter history whose
    label comes from the calendar-adjacent quarter (``require_adjacent``)."""
    fs, cfg = build_feature_store(tpch_transactions(spark, sf_dir), replace(TPCH_CONFIG, period_unit="quarter"))
    m = labelled(rolled_features(fs, cfg), cfg, SequenceConfig(seq_len=3, require_adjacent=True))
    m = m.where(F.col("seq").isNotNull() & F.col("target_category").isNotNull())
    return m.select("customer_id", period_label("period_start", "quarter").alias("period"),
                    period_label(index_start("label_idx", "quarter"), "quarter").alias("label_period"),
                    "target_category")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
