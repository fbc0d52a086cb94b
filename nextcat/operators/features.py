"""Per-(entity, period) feature aggregation.

Core aggregates, a category-spend pivot and a payment-count pivot of the same
rows are one ``groupBy(entity, period_idx).agg(...)`` with conditional
aggregates (``sum(when(category = v, amount))``), so the wide buffers are
never shuffled: the raw rows are dealt by entity first.  A raw row is a third as
wide as the buffers and most (entity, period) groups have one or two rows, so
partial aggregation before the shuffle would save none of them.

The exact distinct count of merchants is a branch of its own over three narrow
columns, dealt likewise and joined where both lie, by entity, as a map from period
to count: in one aggregate it would carry all the wide buffers per merchant.  The window that follows finds its
entities together as well.  The raw rows of one entity meet in one task, which
streams them into at most one buffer per period; where entities are few or one has
a large share of all rows, ``many_entities=False`` aggregates before each shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

from ..config import FeatureConfig
from ..functions.columns import not_nan, pivot_names, row_sum, safe_div
from ..functions.periods import index_start, period_index, period_label
from ..sources.io import deal

# Names of the core feature columns, as users of the feature tables know them.
CORE_COLUMNS = (
    "total_spent", "txn_count", "avg_spent", "min_spent", "max_spent", "spend_std_dev",
    "online_ratio", "unique_merchants", "avg_spend_per_txn", "max_txn_ratio",
)


def with_period(txns: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """Add ``period_idx`` (and keep only rows with an entity and a time:
    grouping drops NULL keys, Q10)."""
    c = cfg.cols
    return (txns.where(F.col(c.entity).isNotNull() & F.col(c.timestamp).isNotNull())
                .withColumn("period_idx", period_index(c.timestamp, cfg.period_unit)))


def dealt(rows: DataFrame, cfg: FeatureConfig, tasks: int | None) -> DataFrame:
    """``rows`` by entity in one shuffle, where the configuration says that entities are many."""
    return deal(rows, tasks, cfg.cols.entity) if cfg.many_entities else rows


def discover_pivot_values(df: DataFrame, columns: list[str], most: int = 4096) -> dict[str, list]:
    """E9 for several columns in *one* job: (column, value) pairs from a single
    scan, distinct (partially aggregated before the shuffle).  The values become
    column names, so the driver has to know them: more than ``most`` are an error
    (the map form has no such limit)."""
    if not columns:
        return {}
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("k"), F.col(c).cast("string").alias("v"))
                                for i, c in enumerate(columns)]))
    d = df.select(pairs.alias("p")).select("p.k", "p.v").where(F.col("v").isNotNull()).distinct()
    out = {c: [] for c in columns}
    found = d.limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} values in {columns}: build_feature_maps takes any number")
    for r in found:
        out[columns[r["k"]]].append(r["v"])
    for c, vals in out.items():
        if not vals:
            raise ValueError(f"column {c!r} has no non-NULL values")
        vals.sort()
    return out


def resolve_values(txns: DataFrame, cfg: FeatureConfig) -> FeatureConfig:
    """Fix the pivot values (explicit lists win; the others are discovered in
    one shared job).  Values are compared as text."""
    if cfg.category_names is not None:
        return cfg  # fixed by a dictionary, in class order
    c = cfg.cols
    todo = []
    if cfg.categories is None:
        todo.append(c.category)
    if cfg.payments is None and c.payment:
        todo.append(c.payment)
    found = discover_pivot_values(txns, todo, cfg.max_wide)
    cats = cfg.categories if cfg.categories is not None else found[c.category]
    pays = cfg.payments if cfg.payments is not None else found.get(c.payment, [])
    return cfg.with_values(sorted(cats), sorted(pays))


def amount_units(df: DataFrame, cfg: FeatureConfig) -> Column:
    """The amount as an exact integer of ``10^-amount_scale``; sums, minima and
    maxima then run on longs and do not depend on how rows are split (Q25).

    An amount with more decimals than the scale, or beyond a long, fails the
    job; NaN is no amount.  Amounts below 2^52 units take the exact route over
    doubles."""
    name, s = cfg.cols.amount, cfg.amount_scale
    kind, a = df.schema[name].dataType, not_nan(df, name)
    if isinstance(kind, IntegralType):
        return a.cast("long") * 10 ** s
    exact = a.cast(f"decimal(28,{s})") * F.lit(10 ** s).cast(f"decimal({s + 1},0)")
    fast = F.round(a.cast("double") * 10 ** s).cast("long")
    units = F.when(F.abs(a.cast("double")) < 2.0 ** 52 / 10 ** s, fast).otherwise(exact.cast("long"))
    if isinstance(kind, DecimalType) and kind.scale <= s:
        return units
    return F.when(a != F.round(a, s), F.raise_error(F.concat(
        F.lit(f"amount with more than {s} decimals: "), a.cast("string"))).cast("long")).otherwise(units)


def _amount(c: Column, cfg: FeatureConfig) -> Column:
    return c.cast("double") / float(10 ** cfg.amount_scale)


def _unlisted(c: Column, values) -> Column:
    return F.max(F.when(~c.cast("string").isin([str(v) for v in values]), c.cast("string")))


def feature_aggregates(df: DataFrame, cfg: FeatureConfig, check_values: bool) -> list[Column]:
    """Aggregate expressions for one pass over the transactions of a group.
    Internal columns are numbered, so no pivot value can spell one."""
    c = cfg.cols
    amt = F.col("_units")
    aggs = [
        F.sum(amt).alias("_sum"),
        F.count(amt).alias("txn_count"),
        F.min(amt).alias("_min"),
        F.max(amt).alias("_max"),
        F.stddev_samp(_amount(amt, cfg)).alias("_std"),
    ]
    if c.online:
        on = F.col(c.online).cast("int")
        aggs += [F.sum(on).alias("_on_sum"), F.count(on).alias("_on_cnt")]
    cat = F.col(c.category)
    aggs += [F.sum(F.when(cat.cast("string") == F.lit(str(v)), amt)).alias(f"_c{i}") for i, v in enumerate(cfg.categories)]
    aggs.append(F.count(cat).alias("_cats"))
    if check_values:
        aggs.append(_unlisted(cat, cfg.categories).alias("_new_cat"))
    if c.payment and cfg.payments:
        pay = F.col(c.payment)
        aggs += [F.count(F.when(pay.cast("string") == F.lit(str(v)), amt)).alias(f"_p{i}") for i, v in enumerate(cfg.payments)]
        aggs.append(F.count(pay).alias("_pays"))
        if check_values:
            aggs.append(_unlisted(pay, cfg.payments).alias("_new_pay"))
    return aggs


def period_features(txns: DataFrame, cfg: FeatureConfig, check_values: bool = True, tasks: int | None = None) -> DataFrame:
    """One row per (entity, period_idx).

    Columns: entity, period_idx, the ten core features (``online_ratio`` still
    NULL where no row of the period has the flag: differences are taken before
    NULLs become 0), one ``cat_<v>`` spend column per category (0 when none),
    ``category_diversity`` (number of categories with spend > 0), one
    ``pay_<v>`` count per payment method.  ``cfg`` must have resolved pivot
    values (see :func:`resolve_values`); with ``check_values`` a value that
    they do not list fails the job instead of getting lost.  ``tasks``: partitions
    to deal the rows to (``io.tasks_for`` the files they come from)."""
    if cfg.categories is None or cfg.payments is None:
        raise ValueError("resolve pivot values first (resolve_values)")
    c = cfg.cols
    rows = dealt(with_period(txns, cfg), cfg, tasks)
    keys = [c.entity, "period_idx"]
    g = (rows.withColumn("_units", amount_units(rows, cfg)).groupBy(*keys)
         .agg(*feature_aggregates(rows, cfg, check_values)))
    merchants = (rows.where(F.col(c.merchant).isNotNull()).select(*keys, c.merchant).distinct()
                 .groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
                 .groupBy(c.entity).agg(F.map_from_entries(F.collect_set(F.struct("period_idx", "n"))).alias("_merchants")))
    g = g.join(merchants, c.entity, "left")  # by the one key that both are dealt by: neither is shuffled again
    keep = F.lit(True)
    if cfg.require_pivot_rows:
        keep = F.col("_cats") > 0
        if c.payment and cfg.payments:
            keep = keep & (F.col("_pays") > 0)
    for new in [x for x in ("_new_cat", "_new_pay") if x in g.columns]:
        keep = F.when(F.col(new).isNotNull(), F.raise_error(F.concat(
            F.lit("value outside the configured pivot lists: "), F.col(new))).cast("boolean")).otherwise(keep)
    g = g.where(keep)
    money = lambda name: F.coalesce(_amount(F.col(name), cfg), F.lit(0.0))
    total, zero = money("_sum"), F.lit(0.0)
    out = [
        F.col(c.entity), F.col("period_idx"),
        total.alias("total_spent"),
        F.col("txn_count"),
        F.coalesce(safe_div(total, F.col("txn_count")), zero).alias("avg_spent"),
        money("_min").alias("min_spent"),
        money("_max").alias("max_spent"),
        F.coalesce(F.nanvl(F.col("_std"), F.lit(None).cast("double")), zero).alias("spend_std_dev"),
    ]
    if c.online:
        out.append(safe_div(F.col("_on_sum").cast("double"), F.col("_on_cnt")).alias("online_ratio"))
    out += [
        F.coalesce(F.try_element_at("_merchants", F.col("period_idx")), F.lit(0)).cast("long").alias("unique_merchants"),
        F.coalesce(safe_div(total, F.col("txn_count")), zero).alias("avg_spend_per_txn"),
        F.coalesce(safe_div(money("_max"), total), zero).alias("max_txn_ratio"),
    ]
    out += [money(f"_c{i}").alias(n) for i, n in enumerate(category_columns(cfg))]
    out.append(row_sum([(F.coalesce(F.col(f"_c{i}"), F.lit(0)) > 0).cast("long") for i in range(len(cfg.categories))])
               .alias("category_diversity"))
    out += [F.col(f"_p{i}").alias(n) for i, n in enumerate(payment_columns(cfg))]
    return g.select(*out)


def period_category_spend(txns: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """A9 in long form: (entity, period_idx, category, spend), for any number
    of categories.  Top category and diversity need no wide columns:
    ``labels.top_category_long`` and :func:`category_diversity`."""
    c = cfg.cols
    rows = with_period(txns, cfg).where(F.col(c.category).isNotNull())
    return (rows.withColumn("_units", amount_units(rows, cfg))
            .groupBy(c.entity, "period_idx", F.col(c.category).cast("string").alias("category"))
            .agg(F.coalesce(_amount(F.sum("_units"), cfg), F.lit(0.0)).alias("spend")))


def category_diversity(spend: DataFrame, keys: list[str]) -> DataFrame:
    """A11 from the long form: categories with spend above 0 per key."""
    return spend.groupBy(*keys).agg(F.count(F.when(F.col("spend") > 0, 1)).alias("category_diversity"))


def core_columns(cfg: FeatureConfig) -> list[str]:
    return [x for x in CORE_COLUMNS if cfg.cols.online or x != "online_ratio"]


def category_columns(cfg: FeatureConfig) -> list[str]:
    return list(cfg.category_names) if cfg.category_names is not None else pivot_names(cfg.category_prefix, cfg.categories)


def payment_columns(cfg: FeatureConfig) -> list[str]:
    if not (cfg.cols.payment and cfg.payments):
        return []
    return list(cfg.payment_names) if cfg.payment_names is not None else pivot_names(cfg.payment_prefix, cfg.payments)


def with_label(df: DataFrame, cfg: FeatureConfig, keep_index: bool = False) -> DataFrame:
    """Replace ``period_idx`` by the text ``period`` label (second column)."""
    c = cfg.cols
    rest = [x for x in df.columns if x not in (c.entity, "period_idx")]
    cols = [F.col(c.entity), period_label(index_start("period_idx", cfg.period_unit), cfg.period_unit).alias("period")]
    if keep_index:
        cols.append(F.col("period_idx"))
    return df.select(*cols, *rest)
