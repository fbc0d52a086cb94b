"""Incremental, period-scoped rebuild of a stored feature store.

There is no stream source: tables are rewritten whole, and there is a
cleaner that deletes partitions before a rebuild (S8).  The incremental unit
here is therefore the *period*: when transactions from period ``since`` on
change or arrive, only those periods are recomputed and replaced; older
partitions are not touched.

Lag features of the first refreshed period of an entity depend on its
previous *observed* period (Q5), which may be any distance back.  That row is
taken from the stored table itself (a column-pruned, partition-pruned scan of
the periods before), so the raw transactions before ``since`` are not re-read.
A stored online ratio of 0 counts as 0, also where it was NULL before filling.

``since`` may be any text or date that names a period; periods are compared by
their index, never as text.

:func:`refresh_since` works on a plain partitioned directory, whose readers see
the new periods appear one after another.  :func:`create_store`,
:func:`refresh_store` and :func:`read_store` keep the table as commits
(``sources.versioned``) next to a growing dictionary of its pivot values
(``operators.dictionary``): a refresh replaces and removes periods in one step,
and a value that it meets for the first time becomes a new class and a new
column, 0 in older periods, while those there are stay as they were."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FeatureConfig
from ..functions.columns import fill_zero
from ..functions.periods import canonical_period, parse_period, period_index
from ..operators.dictionary import configured, extend_dictionary
from ..operators.features import period_features, with_label
from ..operators.trends import trend_growth
from ..plans.feature_store import build_feature_store
from ..session import cut
from ..sources import versioned as V
from ..sources.io import drop_partitions, overwrite_periods, read_partitioned, stored_periods

_SEED_COLS = ("total_spent", "txn_count", "online_ratio")


def _before(stored: DataFrame, index: int, unit: str) -> DataFrame:
    """With period_idx, the rows of periods before ``index``: a filter on the partition column alone."""
    idx = period_index(parse_period("period", unit), unit)
    return stored.where(idx < index).withColumn("period_idx", idx)


def last_rows(stored: DataFrame, cfg: FeatureConfig, index: int) -> DataFrame:
    """Per entity, the latest row of ``stored`` before period ``index`` (only the
    columns the lag features need).  ``max_by`` aggregates partially before
    the shuffle, so a hot entity costs one partial row per task; one per column, since
    a struct as its value would have all stored rows sorted by entity."""
    ent = cfg.cols.entity
    cols = [c for c in _SEED_COLS if cfg.cols.online or c != "online_ratio"]
    latest = [F.max_by(c, "period_idx").alias(c) for c in cols]
    return _before(stored, index, cfg.period_unit).groupBy(ent).agg(F.max("period_idx").alias("period_idx"), *latest)


def refreshed_rows(txns: DataFrame, stored: DataFrame, cfg: FeatureConfig, since: str, index: int) -> DataFrame:
    """Feature rows of the periods from ``since`` on, lags seeded from ``stored``."""
    ent, unit, ts = cfg.cols.entity, cfg.period_unit, cfg.cols.timestamp
    start = parse_period(F.lit(since), unit)
    fresh = period_features(txns.where(F.col(ts) >= start), cfg).withColumn("_seed", F.lit(False))
    both = fresh.unionByName(last_rows(stored, cfg, index).withColumn("_seed", F.lit(True)), allowMissingColumns=True)
    out = trend_growth(both, cfg).where(~F.col("_seed")).drop("_seed")
    return with_label(fill_zero(out, exclude=(ent, "period_idx")), cfg)


def emptied(spark: SparkSession, stored: list[str], written: set[str], index: int, unit: str) -> list[str]:
    """Stored period texts from period ``index`` on that are not among the written ones."""
    if not stored:
        return []
    rows = spark.createDataFrame([(p,) for p in stored], "period string").where(period_index(parse_period("period", unit), unit) >= index).collect()
    return sorted(r["period"] for r in rows if r["period"] not in written)


def refresh_since(txns: DataFrame, cfg: FeatureConfig, path: str, since: str) -> DataFrame:
    """Recompute every period >= ``since`` from ``txns`` and overwrite those
    partitions of the table at ``path``; stored periods from ``since`` on that
    have no rows any more are removed.  ``cfg`` must carry the pivot values the
    table was built with: a transaction with another value fails the job (the
    table then needs a rebuild with the wider list).  Returns the rows written."""
    if cfg.categories is None or cfg.payments is None:
        raise ValueError("pass the stored table's pivot values in cfg")
    spark = txns.sparkSession
    label, index = canonical_period(spark, since, cfg.period_unit)
    out = cut(refreshed_rows(txns, read_partitioned(spark, path), cfg, label, index))
    overwrite_periods(out, path)
    written = {r["period"] for r in out.select("period").distinct().collect()}  # a label per period
    drop_partitions(spark, path, emptied(spark, stored_periods(spark, path), written, index, cfg.period_unit))
    return out


# ---------------------------------------------------------------- stores with a growing dictionary

def _paths(base: str) -> tuple[str, str]:
    return f"{base.rstrip('/')}/dictionary", f"{base.rstrip('/')}/feature_store"


def create_store(txns: DataFrame, cfg: FeatureConfig, base: str) -> FeatureConfig:
    """Build the feature table of ``txns`` under ``base``, replacing what is
    there; the dictionary only grows.  Returns ``cfg`` with its values."""
    words, table = _paths(base)
    extend_dictionary(txns, cfg, words)
    cfg = configured(txns.sparkSession, words, cfg)
    fs, _ = build_feature_store(txns, cfg)
    V.commit(fs, table)
    return cfg


def refresh_store(txns: DataFrame, cfg: FeatureConfig, base: str, since: str) -> FeatureConfig:
    """Recompute the periods from ``since`` on from ``txns`` in one commit;
    values that the dictionary lacks are appended to it first (a failure after
    that leaves entries without rows, which the next refresh uses)."""
    spark = txns.sparkSession
    words, table = _paths(base)
    label, index = canonical_period(spark, since, cfg.period_unit)
    state = V.snapshot(spark, table)
    if not state.version:
        raise ValueError(f"no feature store: {base}")
    recent = txns.where(F.col(cfg.cols.timestamp) >= parse_period(F.lit(label), cfg.period_unit))
    extend_dictionary(recent, cfg, words)
    cfg = configured(spark, words, cfg)
    stored = V.read_current(spark, table, version=state.version, fill=True)
    out = refreshed_rows(recent, stored, cfg, label, index)
    gone = emptied(spark, list(state.partitions), set(), index, cfg.period_unit)  # all from there on; those with rows are written anew
    V.commit(out, table, replace="partitions", remove=gone, base=state)
    return cfg


def read_store(spark: SparkSession, base: str, cfg: FeatureConfig = FeatureConfig(), version: int | None = None) -> tuple[DataFrame, FeatureConfig]:
    """The feature table as of its newest commit (or ``version``) and ``cfg`` with
    the dictionary's values; older partitions have 0 in columns added since."""
    words, table = _paths(base)
    return V.read_current(spark, table, version=version, fill=True), configured(spark, words, cfg)
