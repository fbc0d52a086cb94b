"""Window operators over an entity's ordered rows.

Those over aggregated rows partition by entity and order by the period index:
one shuffle by entity, and functions over the same specification share one
Window node and one sort.  Those over raw rows (balance, numbering) range-sort
all rows first, so the rows of one entity lie over as many tasks as they need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import FeatureConfig
from ..session import cut

TREND_COLUMNS = ("prev_total_spent", "prev_txn_count", "prev_online_ratio")
GROWTH_COLUMNS = ("spend_growth", "txn_growth", "online_ratio_change")


def trend_growth(features: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """W1 + W2: previous *observed* period's total / count / online ratio and
    the differences to it (Q5: a gap is skipped, not filled); 0 in an entity's
    first period (Q8), and where one of two online ratios is NULL."""
    c = cfg.cols
    w = Window.partitionBy(c.entity).orderBy("period_idx")
    pairs = [("total_spent", "prev_total_spent", "spend_growth", 0.0),
             ("txn_count", "prev_txn_count", "txn_growth", 0)]
    if "online_ratio" in features.columns:
        pairs.append(("online_ratio", "prev_online_ratio", "online_ratio_change", 0.0))
    prev = {src: F.lag(src, 1).over(w) for src, *_ in pairs}
    out = [F.col(x) for x in features.columns]
    out += [F.coalesce(prev[src], F.lit(z)).alias(p) for src, p, _, z in pairs]
    out += [F.coalesce(F.col(src) - prev[src], F.lit(z)).alias(g) for src, _, g, z in pairs]
    return features.select(*out)


def trend_columns(cfg: FeatureConfig) -> list[str]:
    return [x for x in TREND_COLUMNS if cfg.cols.online or x != "prev_online_ratio"]


def growth_columns(cfg: FeatureConfig, include_online_change: bool = True) -> list[str]:
    cols = ["spend_growth", "txn_growth"]
    if include_online_change and cfg.cols.online:
        cols.append("online_ratio_change")
    return cols


def period_gaps(df: DataFrame, entity: str = "customer_id", idx: str = "period_idx") -> DataFrame:
    """One row per missing stretch in an entity's history:
    (entity, from_idx, to_idx, missing) where ``from``/``to`` are the observed
    periods around the gap."""
    w = Window.partitionBy(entity).orderBy(idx)
    prev = F.lag(idx, 1).over(w)
    return (df.select(entity, idx, prev.alias("_prev"))
              .where(F.col(idx) - F.col("_prev") > 1)
              .select(entity, F.col("_prev").alias("from_idx"), F.col(idx).alias("to_idx"),
                      (F.col(idx) - F.col("_prev") - 1).alias("missing")))


def range_sorted(df: DataFrame, *order: str | Column) -> DataFrame:
    """``df`` in global order: (..., _part, _at), where _part numbers the range
    and _at the rows within it.  NULLs stay, and sort first
    unless the order says otherwise.  Written to the
    checkpoint folder, because ranges are sampled and must not change between
    the sums over them and the rows."""
    s = df.repartitionByRange(*order).sortWithinPartitions(*order)
    row = F.monotonically_increasing_id()  # range number in the upper bits, row number in the lower 33
    return cut(s.select("*", F.shiftright(row, 33).cast("int").alias("_part"), row.bitwiseAND((1 << 33) - 1).alias("_at")))


def running_balance(ledger: DataFrame, entity: str = "customer_id", ts: str = "timestamp",
                    tiebreak: str = "order_key", amount: str = "amount",
                    opening: str = "opening_balance") -> DataFrame:
    """Balance after each transaction = opening balance minus the running
    sum of amounts in (time, tie-break) order, exact in DECIMAL.  A NULL amount
    counts 0; rows with a NULL time come first; a NULL entity is an entity.

    Two-level prefix sum: rows are range-sorted by (entity, time, tie-break),
    summed within their range, and an entity that began in earlier ranges gets
    their sums added — only the first entity of a range can, so there are fewer
    such sums than ranges and they are broadcast."""
    rows = range_sorted(ledger, entity, ts, tiebreak)
    spent = F.coalesce(F.col(amount), F.lit(0))
    per = rows.groupBy(entity, "_part").agg(F.sum(spent).alias("_sum"))
    earlier = Window.partitionBy(entity).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (per.select(F.col(entity).alias("_entity"), F.col("_part").alias("_range"), F.sum("_sum").over(earlier).alias("_before"))
               .where(F.col("_before").isNotNull()))
    inside = Window.partitionBy(entity, "_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (rows.join(F.broadcast(offsets), F.col(entity).eqNullSafe(F.col("_entity")) & (F.col("_part") == F.col("_range")), "left")
            .withColumn("balance", F.col(opening) - (F.coalesce(F.col("_before"), F.lit(0)) + F.sum(spent).over(inside)))
            .select(*ledger.columns, "balance"))


def numbered(df: DataFrame, *order: str | Column) -> DataFrame:
    """``df`` with ``_n``: 1, 2, 3 … in the given order over the whole table.
    No window: a row's number is its place in its sorted range plus the rows of
    the ranges before, a broadcast of one number per range."""
    rows = range_sorted(df, *order)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    offsets = (rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
               .select(F.col("_part").alias("_range"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before")))
    return (rows.join(F.broadcast(offsets), F.col("_part") == F.col("_range"))
            .select(*df.columns, (F.col("_before") + F.col("_at") + 1).alias("_n")))


def number_transactions(txns: DataFrame, entity: str = "customer_id", order=("timestamp",),
                        prefix: str = "T", name: str = "transaction_id") -> DataFrame:
    """``T<n>`` ids, unique in the table and increasing in time order within
    each entity, entity by entity.  Ties in ``order`` must be broken by the
    caller (append a unique column) for a deterministic numbering; rows with
    NULLs are numbered too, NULL first."""
    return (numbered(txns, entity, *order)
            .withColumn(name, F.concat(F.lit(prefix), F.col("_n").cast("string"))).drop("_n"))


def calendar_spine(df: DataFrame, entity: str = "customer_id", idx: str = "period_idx",
                   lo: int | None = None, hi: int | None = None) -> DataFrame:
    """Every (entity, period index) in a calendar range — the entity's own
    first..last observed period by default, or the fixed [lo, hi].  Generated
    per entity with ``explode(sequence(...))`` (no cross join); the output size
    is exactly the number of entity-periods asked for.  The min/max aggregate
    is combined map-side, so a hot entity is cheap."""
    if lo is None or hi is None:
        bounds = df.groupBy(entity).agg(F.min(idx).alias("_lo"), F.max(idx).alias("_hi"))
    else:
        bounds = df.select(entity).distinct().select(entity, F.lit(lo).alias("_lo"), F.lit(hi).alias("_hi"))
    return bounds.select(entity, F.explode(F.sequence("_lo", "_hi")).alias(idx))


def fill_calendar(df: DataFrame, entity: str = "customer_id", idx: str = "period_idx",
                  lo: int | None = None, hi: int | None = None) -> DataFrame:
    """J5 + fill: left-join rows onto the spine; ``observed`` marks real rows,
    numeric gaps are filled with 0 by the caller's fill (E6)."""
    spine = calendar_spine(df, entity, idx, lo, hi)
    return (spine.join(df.withColumn("observed", F.lit(True)), [entity, idx], "left")
                 .withColumn("observed", F.coalesce(F.col("observed"), F.lit(False))))
