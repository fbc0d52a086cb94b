"""DuckDB SQL text for the oracle comparison of the registered queries.

The SQL is written independently of the Spark plans (plain GROUP BY / window /
self-join formulations) over the same Parquet tables; column names and types
are aligned with the Spark outputs."""

from __future__ import annotations

from .functions.columns import pivot_names
from .sources.fixtures import EVENT_TXN_SQL, TPCH_TXN_SQL

# The value domains of the generated test tables.  p_type, o_orderpriority and event_type, in sorted order.
TPCH_CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
TPCH_PAYMENTS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def lit(v: str) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def ident(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def idx_sql(ts: str, unit: str) -> str:
    if unit == "month":
        return f"CAST(year({ts}) * 12 + month({ts}) - 1 AS INTEGER)"
    if unit == "quarter":
        return f"CAST(year({ts}) * 4 + quarter({ts}) - 1 AS INTEGER)"
    if unit == "year":
        return f"CAST(year({ts}) AS INTEGER)"
    if unit == "day":
        return f"CAST(date_diff('day', DATE '1970-01-01', CAST({ts} AS DATE)) AS INTEGER)"
    if unit == "week":
        return (f"CAST((date_diff('day', DATE '1970-01-01', CAST(date_trunc('week', {ts}) AS DATE)) + 3)"
                f" // 7 AS INTEGER)")
    raise ValueError(unit)


def label_sql(ts: str, unit: str) -> str:
    if unit == "month":
        return f"strftime({ts}, '%Y-%m')"
    if unit == "day":
        return f"strftime({ts}, '%Y-%m-%d')"
    if unit == "week":
        return f"strftime(date_trunc('week', {ts}), '%Y-%m-%d')"
    if unit == "quarter":
        return f"CAST(year({ts}) AS VARCHAR) || 'Q' || CAST(quarter({ts}) AS VARCHAR)"
    return f"CAST(year({ts}) AS VARCHAR)"


def start_sql(ts: str, unit: str) -> str:
    return f"CAST(date_trunc('{unit}', {ts}) AS DATE)"


def feature_store_sql(txn_sql: str = TPCH_TXN_SQL, cats=TPCH_CATEGORIES, pays=TPCH_PAYMENTS,
                      unit: str = "month", online: bool = True) -> str:
    """CTE text ending in a relation ``fs`` (customer_id, period, period_idx,
    all combined feature-store columns)."""
    ts = '"timestamp"'
    cat_names = pivot_names("cat_", cats)
    pay_names = pivot_names("pay_", pays)
    cat_aggs = ",\n".join(f"    SUM(CASE WHEN category = {lit(v)} THEN amount END) AS {ident('_' + n)}"
                          for v, n in zip(cats, cat_names))
    pay_aggs = "".join(f",\n    COUNT(CASE WHEN payment_method = {lit(v)} THEN amount END) AS {ident(n)}"
                       for v, n in zip(pays, pay_names))
    having = "COUNT(category) > 0" + (" AND COUNT(payment_method) > 0" if pays else "")
    online_aggs = ",\n    SUM(is_online) AS on_sum, COUNT(is_online) AS on_cnt" if online else ""
    online_col = ("    CAST(on_sum AS DOUBLE) / NULLIF(on_cnt, 0) AS online_ratio,\n"
                  if online else "")
    cat_cols = ",\n".join(f"    COALESCE(CAST({ident('_' + n)} AS DOUBLE), 0) AS {ident(n)}" for n in cat_names)
    diversity = " + ".join(f"CASE WHEN COALESCE({ident('_' + n)}, 0) > 0 THEN 1 ELSE 0 END" for n in cat_names)
    pay_cols = "".join(f",\n    {ident(n)}" for n in pay_names)
    lag_online = (",\n  COALESCE(LAG(online_ratio) OVER w, 0) AS prev_online_ratio" if online else "")
    chg_online = (",\n  COALESCE(online_ratio - LAG(online_ratio) OVER w, 0) AS online_ratio_change"
                  if online else "")
    # differences are taken before NULLs become 0
    online_filled = " REPLACE (COALESCE(online_ratio, 0) AS online_ratio)" if online else ""
    return f"""
WITH txn AS ({txn_sql}),
b AS (
  SELECT *, {idx_sql(ts, unit)} AS period_idx, {label_sql(ts, unit)} AS period
  FROM txn WHERE customer_id IS NOT NULL AND {ts} IS NOT NULL
),
g AS (
  SELECT customer_id, period_idx, period,
    SUM(amount) AS s, COUNT(amount) AS txn_count, MIN(amount) AS mn, MAX(amount) AS mx,
    STDDEV_SAMP(CAST(amount AS DOUBLE)) AS sd{online_aggs},
    COUNT(DISTINCT merchant_id) AS unique_merchants,
{cat_aggs}{pay_aggs}
  FROM b GROUP BY customer_id, period_idx, period
  HAVING {having}
),
f AS (
  SELECT customer_id, period, period_idx,
    CAST(COALESCE(s, 0) AS DOUBLE) AS total_spent,
    txn_count,
    COALESCE(CAST(COALESCE(s, 0) AS DOUBLE) / NULLIF(txn_count, 0), 0) AS avg_spent,
    COALESCE(CAST(mn AS DOUBLE), 0) AS min_spent,
    COALESCE(CAST(mx AS DOUBLE), 0) AS max_spent,
    COALESCE(sd, 0) AS spend_std_dev,
{online_col}    unique_merchants,
    COALESCE(CAST(COALESCE(s, 0) AS DOUBLE) / NULLIF(txn_count, 0), 0) AS avg_spend_per_txn,
    COALESCE(COALESCE(CAST(mx AS DOUBLE), 0) / NULLIF(CAST(COALESCE(s, 0) AS DOUBLE), 0), 0) AS max_txn_ratio,
{cat_cols},
    CAST({diversity} AS BIGINT) AS category_diversity{pay_cols}
  FROM g
),
fs AS (
  SELECT f.*{online_filled},
  COALESCE(LAG(total_spent) OVER w, 0) AS prev_total_spent,
  COALESCE(LAG(txn_count) OVER w, 0) AS prev_txn_count{lag_online},
  COALESCE(total_spent - LAG(total_spent) OVER w, 0) AS spend_growth,
  COALESCE(txn_count - LAG(txn_count) OVER w, 0) AS txn_growth{chg_online}
  FROM f
  WINDOW w AS (PARTITION BY customer_id ORDER BY period_idx)
)"""


def select_from_fs(cols, round_cols=("spend_std_dev",), cte: str | None = None, digits: int = 4) -> str:
    """``SELECT customer_id, period, <cols>`` from ``fs`` with the rounding
    convention applied to the algorithm-dependent float columns."""
    out = []
    for c in cols:
        out.append(f"round({ident(c)}, {digits}) AS {ident(c)}" if c in round_cols else ident(c))
    return (feature_store_sql() if cte is None else cte) + "\nSELECT customer_id, period, " + ", ".join(out) + " FROM fs"


__all__ = ["TPCH_CATEGORIES", "TPCH_PAYMENTS", "EVENT_TYPES", "TPCH_TXN_SQL", "EVENT_TXN_SQL",
           "feature_store_sql", "select_from_fs", "idx_sql", "label_sql", "start_sql", "lit", "ident"]


def month_label_of_idx(idx: str) -> str:
    return f"strftime(make_date(CAST({idx} // 12 AS INTEGER), CAST({idx} % 12 + 1 AS INTEGER), 1), '%Y-%m')"


def supervised_sql(seq_len: int = 3, train_end: int = 24016, test_label: int = 24017, predict: int = 24018,
                   cats=TPCH_CATEGORIES) -> str:
    """CTEs on top of :func:`feature_store_sql` (monthly TPC-H fixture):
    ``m`` (features + top_category), ``l`` (+ label_idx, target_category,
    label_period, label), ``fullh`` (anchors with a complete history),
    ``sup`` (labelled anchors with complete history + split)."""
    names = pivot_names("cat_", cats)
    mx = "greatest(" + ", ".join(ident(n) for n in names) + ")"
    top = "CASE " + " ".join(f"WHEN {ident(n)} = {mx} THEN {lit(c)}" for n, c in zip(names, cats)) + " END"
    catlist = "[" + ", ".join(lit(c) for c in cats) + "]"
    return feature_store_sql() + f""",
m AS (SELECT fs.*, {top} AS top_category FROM fs),
l AS (
  SELECT m.*, LEAD(period_idx) OVER w AS label_idx, LEAD(top_category) OVER w AS target_category
  FROM m WINDOW w AS (PARTITION BY customer_id ORDER BY period_idx)
),
l2 AS (
  SELECT l.*, CASE WHEN label_idx IS NOT NULL THEN {month_label_of_idx('label_idx')} END AS label_period,
         CAST(list_position({catlist}, target_category) - 1 AS DOUBLE) AS label
  FROM l
),
fullh AS (
  SELECT a.customer_id, a.period_idx
  FROM m a JOIN m b ON a.customer_id = b.customer_id
                   AND b.period_idx BETWEEN a.period_idx - {seq_len - 1} AND a.period_idx
  GROUP BY a.customer_id, a.period_idx HAVING COUNT(*) = {seq_len}
),
sup0 AS (
  SELECT l2.*, CASE WHEN label_idx <= {train_end} THEN 'train'
                    WHEN label_idx = {test_label} THEN 'test'
                    WHEN period_idx = {predict - 1} THEN 'predict'
                    ELSE 'unused' END AS split
  FROM l2 JOIN fullh USING (customer_id, period_idx)
),
sup AS (
  SELECT * FROM sup0
  WHERE (split IN ('train', 'test') AND label IS NOT NULL) OR split = 'predict'
),
steps AS (
  SELECT a.customer_id, a.period, a.period_idx, b.period_idx - a.period_idx + {seq_len - 1} AS step, b.*
         EXCLUDE (customer_id, period, period_idx, top_category)
  FROM sup0 a JOIN m b ON a.customer_id = b.customer_id
                       AND b.period_idx BETWEEN a.period_idx - {seq_len - 1} AND a.period_idx
)"""


__all__ += ["supervised_sql", "month_label_of_idx"]
