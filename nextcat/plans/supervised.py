"""L2: feature rows → labelled, calendar-contiguous sequences with a split.

Plan: one exchange by entity (none where the features lie so) → period check and roll-up to one row per (entity,
period) → top category per row → one Window node (lead for the label, a bounded
RANGE frame for the sequence) → split column.  Feature rows are at most one per
entity and stored period, so partitioning them by entity cannot concentrate a
large share of the data in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import FeatureConfig, SequenceConfig, SplitConfig
from ..functions.columns import fill_zero
from ..functions.periods import index_start, period_label
from ..operators.features import category_columns, payment_columns
from ..operators.labels import class_index, label_columns, top_category
from ..operators.sequences import assign_split, trailing_sequences
from ..operators.tables import monthly_rollup

ID_COLUMNS = ("period_start", "period_idx")


def rolled_features(features: DataFrame, fcfg: FeatureConfig, strict: bool = True, dealt: bool = False) -> DataFrame:
    """E2 + A12: normalise periods and re-aggregate (pivot columns summed).  A
    mean of no value is 0, as everywhere in the feature tables.  ``strict``: a
    text that is no period fails the job; otherwise its rows drop out.  ``dealt``: the
    rows of an entity lie together already, as a feature build or a merge by entity
    in the same plan leaves them."""
    ent, unit = fcfg.cols.entity, fcfg.period_unit
    # feature rows are one per entity and stored period: dealt by entity once, they are rolled up and
    # windowed where they lie
    features = features if dealt else features.repartition(F.col(ent))
    explicit = {c: "sum" for c in category_columns(fcfg) + payment_columns(fcfg) if c in features.columns}
    return fill_zero(monthly_rollup(features, ent, "period", unit, explicit, strict), exclude=(ent, *ID_COLUMNS))


def feature_columns(rolled: DataFrame, fcfg: FeatureConfig) -> list[str]:
    """Model features: every numeric roll-up column (sums sorted, then means
    sorted), category spends included (Q24)."""
    return [c for c in rolled.columns if c not in (fcfg.cols.entity, *ID_COLUMNS)]


def labelled(rolled: DataFrame, fcfg: FeatureConfig, scfg: SequenceConfig,
             feature_cols: list[str] | None = None) -> DataFrame:
    """Top category, next-period label and trailing sequence on every row."""
    ent = fcfg.cols.entity
    feature_cols = feature_cols or feature_columns(rolled, fcfg)
    names, columns = zip(*sorted(zip(fcfg.categories, category_columns(fcfg))))  # ties go to the first name, whatever its class index
    m = rolled.withColumn("top_category", top_category(list(columns), list(names)))
    label = label_columns(ent, "period_idx", "top_category", scfg.require_adjacent)
    return trailing_sequences(m, ent, "period_idx", feature_cols, scfg.seq_len, extra=label)


def supervised_sequences(features: DataFrame, fcfg: FeatureConfig, scfg: SequenceConfig,
                         split: SplitConfig, feature_cols: list[str] | None = None,
                         strict: bool = True, keep_unused: bool = False, dealt: bool = False) -> DataFrame:
    """(entity, period, period_idx, label_period, label_idx, top_category,
    target_category, label, split, seq) for every anchor with a complete L-period history that
    is a train/test example (labelled) or a prediction anchor."""
    if not (split.train_end < split.test_label < split.predict):
        raise ValueError("split boundaries must satisfy train_end < test_label < predict")
    ent, unit = fcfg.cols.entity, fcfg.period_unit
    rolled = rolled_features(features, fcfg, strict=strict, dealt=dealt)
    m = labelled(rolled, fcfg, scfg, feature_cols)
    m = assign_split(m, split, unit)
    m = m.withColumn("label", class_index("target_category", fcfg.categories))
    keep = F.col("seq").isNotNull()
    if not keep_unused:
        keep = keep & (((F.col("split").isin("train", "test")) & F.col("label").isNotNull())
                       | (F.col("split") == "predict"))
    label_period = F.when(F.col("label_idx").isNotNull(),
                          period_label(index_start("label_idx", unit), unit))
    return m.where(keep).select(
        ent, period_label("period_start", unit).alias("period"), "period_idx",
        label_period.alias("label_period"), "label_idx", "top_category", "target_category", "label", "split",
        "seq")
