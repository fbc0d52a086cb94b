"""Configuration objects: column names, period unit, sequence length, split
boundaries and model parameters.  Every operator takes one of these instead of
hard-coding names, so the same plans run on any transaction-shaped table."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

PERIOD_UNITS = ("day", "week", "month", "quarter", "year")


@dataclass(frozen=True)
class TxnColumns:
    """Names of the transaction columns the feature operators read."""

    entity: str = "customer_id"
    timestamp: str = "timestamp"
    amount: str = "amount"
    category: str = "category"
    merchant: str = "merchant_id"
    payment: str = "payment_method"
    online: str = "is_online"


@dataclass(frozen=True)
class FeatureConfig:
    """How transactions become (entity, period) feature rows.

    ``categories`` / ``payments`` fix the pivot values (sorted on use); a value
    in the data that they do not list then fails the job.  When ``None`` they
    are discovered with one ``distinct`` job over the data, up to ``max_wide``
    values, since each becomes a column; ``build_feature_maps`` builds the same
    table with map columns for any number of values and without discovery.
    ``payments=()`` disables the payment pivot (sources that have no payment
    column).

    ``amount_scale``: decimals of an amount that count.  Amounts become exact
    integers of that unit; one with more decimals fails the job."""

    cols: TxnColumns = field(default_factory=TxnColumns)
    period_unit: str = "month"
    categories: tuple[str, ...] | None = None
    payments: tuple[str, ...] | None = None
    # Write the projected transactions once under the checkpoint folder and build
    # from there: for a source that costs more to compute than to store, such as a
    # join, which discovery and both aggregates would each compute again.
    stage_source: bool = False
    # Raw rows are dealt by entity once, before they are aggregated.  False, for few
    # entities or one with a large share of the rows: partial aggregates are shuffled instead.
    many_entities: bool = True
    amount_scale: int = 2
    max_wide: int = 4096
    category_prefix: str = "cat_"
    payment_prefix: str = "pay_"
    # Column names of the values, in their order, where a dictionary has fixed
    # them; otherwise prefix and value make the name.
    category_names: tuple[str, ...] | None = None
    payment_names: tuple[str, ...] | None = None
    # Q9: a period whose rows all have a NULL pivot value drops out (inner-join
    # semantics of the three-table merge).  False keeps such rows.
    require_pivot_rows: bool = True

    def __post_init__(self) -> None:
        if self.period_unit not in PERIOD_UNITS:
            raise ValueError(f"period_unit must be one of {PERIOD_UNITS}, got {self.period_unit!r}")
        if not 0 <= self.amount_scale <= 8:
            raise ValueError("amount_scale must be 0 to 8")

    def with_values(self, categories, payments, category_names=None, payment_names=None) -> "FeatureConfig":
        names = [None if n is None else tuple(n) for n in (category_names, payment_names)]
        return replace(self, categories=tuple(categories), payments=tuple(payments), category_names=names[0], payment_names=names[1])


@dataclass(frozen=True)
class SplitConfig:
    """Temporal split on period labels (``yyyy-MM`` for months).

    train: label period <= train_end;  test: label period == test_label;
    predict: sequences ending the period before ``predict``."""

    train_end: str
    test_label: str
    predict: str


@dataclass(frozen=True)
class SequenceConfig:
    seq_len: int = 3
    # Q6: the label is the next *observed* period.  True requires it to be the
    # calendar-adjacent period.
    require_adjacent: bool = False

    def __post_init__(self) -> None:
        if self.seq_len < 1:
            raise ValueError("seq_len must be >= 1")


@dataclass(frozen=True)
class ModelConfig:
    """Classifier settings.  ``epochs`` maps to ``maxIter`` and ``hidden_dim *
    num_layers`` to the hidden layers.  ``step_size`` is the learning rate of
    the perceptron's gradient descent (solver ``gd``; ``l-bfgs`` has none) and
    ``reg_param`` the L2 penalty of the logistic regression; a setting that the
    chosen classifier does not have is an error.  ``report_every``: iterations
    between rows of the training report (0: none)."""

    kind: str = "mlp"  # "mlp" | "logistic" | "centroid" (nearest class mean; has no iterations)
    hidden_dim: int = 64
    num_layers: int = 1
    epochs: int = 10
    solver: str = "l-bfgs"  # of the perceptron: "l-bfgs" | "gd"
    step_size: float | None = None
    reg_param: float | None = None
    seed: int = 42
    block_size: int = 128
    report_every: int = 0

    def __post_init__(self) -> None:
        if self.kind not in ("mlp", "logistic", "centroid") or self.solver not in ("l-bfgs", "gd"):
            raise ValueError("unknown kind or solver")
        if self.step_size is not None and (self.kind, self.solver) != ("mlp", "gd"):
            raise ValueError("step_size needs kind 'mlp' and solver 'gd'")
        if self.report_every and self.kind == "centroid":
            raise ValueError("kind 'centroid' has no iterations to report")
        if self.reg_param is not None and self.kind != "logistic":
            raise ValueError("reg_param needs kind 'logistic'")


# Split boundaries used by the TPC-H derived fixture (monthly periods).
FIXTURE_SPLIT = SplitConfig(train_end="2001-05", test_label="2001-06", predict="2001-07")
