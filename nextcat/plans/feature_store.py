"""L1: transactions → combined per-(entity, period) feature store, and the
five narrow tables projected from it (E7)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..config import FeatureConfig
from ..functions.columns import fill_zero
from ..operators.features import (category_columns, core_columns, payment_columns,
                                  period_features, resolve_values, with_label)
from ..operators.states import period_states, state_features
from ..operators.trends import growth_columns, trend_columns, trend_growth
from ..session import cut
from ..sources.io import batch_count, entity_batches, tasks_for

# Fixed value: bytes of stored transactions whose features are shuffled at once; about nine times as many are shuffled.
BATCH_BYTES = 256 << 20


def build_feature_store(txns: DataFrame, cfg: FeatureConfig,
                        keep_index: bool = False) -> tuple[DataFrame, FeatureConfig]:
    """One aggregate + one window pass over rows dealt by entity.  Returns the combined table (entity,
    period, core, category spends, category_diversity, payment counts,
    prev_*, growth) and the config with its pivot values fixed: keep it with the
    table, since passing it again saves the discovery job and checks the data
    against it in the same pass."""
    listed = cfg.categories is not None and cfg.payments is not None
    tasks = tasks_for(txns)
    if cfg.stage_source:
        txns = cut(txns.select(*transaction_columns(cfg)))
    cfg = resolve_values(txns, cfg)
    return _features(txns, cfg, listed, tasks, keep_index), cfg


def _features(txns: DataFrame, cfg: FeatureConfig, check_values: bool, tasks: int | None, keep_index: bool = False) -> DataFrame:
    f = period_features(txns, cfg, check_values=check_values, tasks=tasks)
    f = fill_zero(trend_growth(f, cfg), exclude=(cfg.cols.entity, "period_idx"))
    return with_label(f, cfg, keep_index=keep_index)


def build_feature_batches(txns: DataFrame, cfg: FeatureConfig, batch_bytes: int | None = None) -> tuple[list[DataFrame], FeatureConfig]:
    """:func:`build_feature_store` of stored transactions (a table to be read several
    times) as one frame per batch of entities, together its rows: a writer that takes them
    one after the other holds the shuffles of one batch.  A batch per ``batch_bytes``
    of files; the pivot values are those of all transactions."""
    listed = cfg.categories is not None and cfg.payments is not None
    tasks, cfg = tasks_for(txns), resolve_values(txns, cfg)
    parts = entity_batches(txns, cfg.cols.entity, batch_count(txns, batch_bytes or BATCH_BYTES))
    return [_features(t, cfg, listed, tasks and -(-tasks // len(parts))) for t in parts], cfg


def transaction_columns(cfg: FeatureConfig) -> list[str]:
    """The columns of the transactions that the features are made from."""
    c = cfg.cols
    return [x for x in (c.entity, c.timestamp, c.amount, c.category, c.merchant, c.payment, c.online) if x]


def table_columns(cfg: FeatureConfig) -> dict[str, list[str]]:
    """The narrow tables and their value columns (their layout:
    growth holds spend and txn growth, trend holds the lags and the online
    ratio change)."""
    trend = trend_columns(cfg) + (["online_ratio_change"] if cfg.cols.online else [])
    return {
        "core_behavior": core_columns(cfg),
        "category": category_columns(cfg) + ["category_diversity"],
        "payment": payment_columns(cfg),
        "growth": growth_columns(cfg, include_online_change=False),
        "trend": trend,
    }


def narrow_tables(combined: DataFrame, cfg: FeatureConfig) -> dict[str, DataFrame]:
    keys = [cfg.cols.entity, "period"]
    return {name: combined.select(*keys, *cols)
            for name, cols in table_columns(cfg).items() if cols}


def build_feature_maps(txns: DataFrame, cfg: FeatureConfig, keep_index: bool = False) -> DataFrame:
    """L1 for any number of pivot values: the combined table with the pivots as
    map columns (category_spend, payment_count) instead of a column per value.
    One pass over the transactions, no discovery job, no value on the driver;
    ``states.wide_pivots`` projects chosen values to columns."""
    return maps_from_states(period_states(txns, cfg), cfg, keep_index)


def maps_from_states(states: DataFrame, cfg: FeatureConfig, keep_index: bool = False) -> DataFrame:
    """:func:`build_feature_maps` from stored or rolled-up states of ``cfg.period_unit`` periods."""
    f = fill_zero(trend_growth(state_features(states, cfg), cfg), exclude=(cfg.cols.entity, "period_idx"))
    return with_label(f, cfg, keep_index=keep_index)
