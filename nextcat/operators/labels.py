"""Top category of a period, next-period labels and class indices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import q
from ..functions.periods import parse_period
from .trends import numbered


def top_category(spend_cols: list[str], names: list[str]) -> Column:
    """O2: name of the largest spend among ``spend_cols`` (wide form).

    Ties go to the first name in ``names`` order (sorted category list, Q7);
    NULL / NaN spends never win; a row with no spend value at all has no top
    category (NULL).  Built from ``array_max`` over (spend, -position, name)
    structs — one expression, no explode, no shuffle."""
    if len(spend_cols) != len(names) or not names:
        raise ValueError("need one name per spend column")
    items = F.array(*[
        F.struct(F.nanvl(F.col(q(c)).cast("double"), F.lit(None).cast("double")).alias("v"),
                 F.lit(-i).alias("p"), F.lit(n).alias("name"))
        for i, (c, n) in enumerate(zip(spend_cols, names))])
    present = F.filter(items, lambda s: s["v"].isNotNull())
    return F.array_max(present)["name"]


def top_category_long(long_df: DataFrame, keys: list[str], category: str = "category",
                      spend: str = "spend") -> DataFrame:
    """O2, long form: one row per key with the top category by spend, ties to
    the smallest category name.  A window ranking over the keys — for data
    that is not pivoted."""
    w = Window.partitionBy(*keys).orderBy(F.col(spend).desc(), F.col(category).asc())
    return (long_df.where(F.col(spend).isNotNull() & ~F.isnan(F.col(spend).cast("double")))
                   .withColumn("_rk", F.row_number().over(w)).where("_rk = 1")
                   .select(*keys, F.col(category).alias("top_category")))


def label_columns(entity: str, idx: str, top: str = "top_category", require_adjacent: bool = False) -> list[Column]:
    """W3 + W4: ``label_idx`` and ``target_category`` of row t = index and top
    category of the entity's next observed row.  With ``require_adjacent`` the
    next row must be the calendar-adjacent period (else no label).  The top
    category is computed once per row and shifted with ``lead``; selected
    together with other functions of the same window they share its node."""
    w = Window.partitionBy(entity).orderBy(idx)
    nxt_idx = F.lead(idx, 1).over(w)
    nxt_top = F.lead(top, 1).over(w)
    if require_adjacent:
        ok = nxt_idx == F.col(idx) + 1
        nxt_top = F.when(ok, nxt_top)
        nxt_idx = F.when(ok, nxt_idx)
    return [nxt_idx.alias("label_idx"), nxt_top.alias("target_category")]


def next_period_labels(df: DataFrame, entity: str, idx: str, top: str = "top_category",
                       require_adjacent: bool = False) -> DataFrame:
    """:func:`label_columns` appended to ``df``."""
    return df.select("*", *label_columns(entity, idx, top, require_adjacent))


def drop_unlabelled(df: DataFrame) -> DataFrame:
    """Keep rows that have both a label period and a target."""
    return df.dropna(subset=["label_idx", "target_category"])


def class_index(target: str, categories) -> Column:
    """0-based position of ``target`` in the sorted category list
    as DOUBLE (Spark ML labels are doubles); NULL when not in the list."""
    arr = F.array(*[F.lit(c) for c in categories])
    pos = F.array_position(arr, F.col(target))
    return F.when(pos > 0, (pos - 1).cast("double"))


def class_name(index_col: str, categories) -> Column:
    """class index → category name."""
    arr = F.array(*[F.lit(c) for c in categories])
    return F.element_at(arr, F.col(index_col).cast("int") + 1)


def category_index(txns: DataFrame, category: str = "category") -> DataFrame:
    """E9 + M1 as a relation: sorted distinct categories with their class
    index, numbered over sorted ranges of the distinct values."""
    d = txns.select(category).where(F.col(category).isNotNull()).distinct()
    return numbered(d, category).select(category, (F.col("_n") - 1).cast("int").alias("class_index"))


def normalize_periods(df: DataFrame, period: str = "period", unit: str = "month",
                      out: str = "period_start") -> DataFrame:
    """The period text parsed to the period start date (NULL when it does
    not parse).  ``periods.checked_period`` fails the job on such a value."""
    return df.withColumn(out, parse_period(period, unit))


def invalid_periods(df: DataFrame, period: str = "period", unit: str = "month", n: int = 5) -> DataFrame:
    """O3: the first ``n`` distinct unparseable period values (sorted)."""
    bad = df.select(F.col(period).cast("string").alias(period)).where(parse_period(period, unit).isNull())
    return bad.distinct().orderBy(period).limit(n)


def check_periods(df: DataFrame, period: str = "period", unit: str = "month") -> None:
    """E2 guard as a job of its own: raise with up to five examples."""
    bad = [r[0] for r in invalid_periods(df, period, unit).collect()]
    if bad:
        raise ValueError(f"these are no periods of unit {unit}: {bad}")
