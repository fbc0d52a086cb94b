"""nextcat — per-entity, per-period feature tables, next-period top-category
labels, calendar-contiguous sequences and a next-category classifier, as
ordinary Spark DataFrame plans."""

from .config import FeatureConfig, ModelConfig, SequenceConfig, SplitConfig, TxnColumns  # noqa: F401

__all__ = ["FeatureConfig", "ModelConfig", "SequenceConfig", "SplitConfig", "TxnColumns"]
