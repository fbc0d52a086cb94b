"""Fixed-length, calendar-contiguous sequences and the temporal split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import SplitConfig
from ..functions.columns import q
from ..functions.periods import parse_period, period_index


def feature_array(cols: list[str]) -> Column:
    return F.array(*[F.col(q(c)).cast("double") for c in cols])


def steps_of(entity: str, idx: str, features: Column, seq_len: int) -> Column:
    """The rows of the ``seq_len`` periods ending at a row, as (index, features)
    structs.  A RANGE frame over the integer period index covers exactly the
    calendar periods [t-(L-1), t]; the window holds one entity's rows, which are
    at most one per period."""
    w = Window.partitionBy(entity).orderBy(idx).rangeBetween(-(seq_len - 1), 0)
    return F.collect_list(F.struct(F.col(idx).alias("i"), features.alias("x"))).over(w)


def trailing_steps(entity: str, idx: str, feature_cols: list[str], seq_len: int) -> Column:
    """:func:`steps_of` for wide rows."""
    return steps_of(entity, idx, feature_array(feature_cols), seq_len)


def complete_sequence(steps: str, seq_len: int) -> Column:
    """The feature vectors of a step list, oldest first, as
    ``array<array<double>>`` — NULL when any of the periods is missing."""
    return F.when(F.size(steps) == seq_len, F.transform(F.sort_array(steps), lambda s: s["x"]))


def trailing_sequences(df: DataFrame, entity: str, idx: str, feature_cols: list[str],
                       seq_len: int, out: str = "seq", extra: list[Column] | None = None) -> DataFrame:
    """W5 + E15 on every row.  ``extra``: more columns of the same window, which
    are computed in the same node."""
    with_steps = df.select("*", *(extra or []), trailing_steps(entity, idx, feature_cols, seq_len).alias("_steps"))
    return with_steps.withColumn(out, complete_sequence("_steps", seq_len)).drop("_steps")


def in_full_runs(df: DataFrame, entity: str, idx: str, seq_len: int) -> DataFrame:
    """The rows that lie in a stretch of at least ``seq_len`` contiguous periods of
    their entity: every complete history is made of such rows alone.  A window by
    entity, so rows that lie by entity are filtered where they lie."""
    near = F.collect_set(F.col(idx)).over(Window.partitionBy(entity).orderBy(idx).rangeBetween(-(seq_len - 1), seq_len - 1))
    full = F.exists(F.sequence(F.lit(1 - seq_len), F.lit(0)), lambda k: F.size(F.array_intersect(
        F.col("_near"), F.sequence(F.col(idx) + k, F.col(idx) + k + (seq_len - 1)))) == seq_len)
    return df.withColumn("_near", near).where(full).drop("_near")


def sequences_by_self_join(df: DataFrame, entity: str, idx: str, feature_cols: list[str],
                           seq_len: int) -> DataFrame:
    """J4 cross-check of :func:`trailing_sequences`: each anchor is expanded
    to its ``seq_len`` step periods and equi-joined to the rows on (entity,
    period) — no range condition, so no pairwise comparison inside an entity.
    One output row per (anchor, step); anchors missing any step are dropped, by a
    join of the keys alone, before the wide rows are joined."""
    a = df.select(F.col(entity), F.col(idx).alias("_a"),
                  F.explode(F.sequence(F.col(idx) - (seq_len - 1), F.col(idx))).alias("_s"))
    here = df.select(F.col(entity), F.col(idx).alias("_s"))
    full = Window.partitionBy(entity, "_a")  # over the keys alone: only complete anchors meet the wide rows
    a = a.join(here, [entity, "_s"]).withColumn("_n", F.count(F.lit(1)).over(full)).where(F.col("_n") == seq_len).drop("_n")
    b = df.select(F.col(entity), F.col(idx).alias("_s"), *[F.col(q(c)) for c in feature_cols])
    j = a.join(b, [entity, "_s"])  # equi-join on (entity, step period): fan-out <= seq_len
    return j.select(entity, F.col("_a").alias(idx), (F.col("_s") - F.col("_a") + (seq_len - 1)).alias("step"),
                    F.col("_s").alias("step_idx"), *[F.col(q(c)) for c in feature_cols])


def history_runs(df: DataFrame, entity: str = "customer_id", idx: str = "period_idx") -> DataFrame:
    """W7 as runs: the stretches of contiguous periods of an entity, (entity,
    from_idx, to_idx, length).  A period's index less its rank is the same
    throughout a run.  Rows are one per entity and period."""
    rank = F.row_number().over(Window.partitionBy(entity).orderBy(idx))
    runs = df.select(entity, F.col(idx).alias("_i"), (F.col(idx) - rank).alias("_run"))
    return runs.groupBy(entity, "_run").agg(F.min("_i").alias("from_idx"), F.max("_i").alias("to_idx"),
                                            F.count(F.lit(1)).alias("length")).drop("_run")


def rejected_anchors(df: DataFrame, entity: str = "customer_id", idx: str = "period_idx", seq_len: int = 3) -> DataFrame:
    """E15 explained: the rows that have no complete history of ``seq_len``
    periods, each with ``missing`` (the periods of its look-back without a row,
    oldest first) and ``reason``: ``short`` (all before the entity's first
    period), ``gap`` (none before it) or ``both``.  Accepted anchors are the other
    rows.  One window over the entity's rows, as for the sequences."""
    w = Window.partitionBy(entity).orderBy(idx)
    back = F.collect_list(F.col(idx)).over(w.rangeBetween(-(seq_len - 1), 0))
    first = F.min(idx).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = df.select(entity, idx, first.alias("_first"), back.alias("_there"))
    missing = F.array_except(F.sequence(F.col(idx) - (seq_len - 1), F.col(idx)), F.col("_there"))
    rows = rows.where(F.size("_there") < seq_len).withColumn("missing", missing)
    early, late = F.exists("missing", lambda i: i < F.col("_first")), F.exists("missing", lambda i: i > F.col("_first"))
    return rows.select(entity, idx, "missing", F.when(early & late, "both").when(early, "short").otherwise("gap").alias("reason"))


def split_indices(split: SplitConfig, unit: str = "month") -> tuple[Column, Column, Column]:
    """Integer period indices of the three boundaries (literal expressions,
    constant-folded by the optimiser)."""
    def ix(v):
        return period_index(parse_period(F.lit(v), unit), unit)
    return ix(split.train_end), ix(split.test_label), ix(split.predict)


def assign_split(df: DataFrame, split: SplitConfig, unit: str = "month", idx: str = "period_idx",
                 label_idx: str = "label_idx") -> DataFrame:
    """``split`` column.

    train:   label period <= train_end
    test:    label period == test_label
    predict: anchor is the period just before ``predict`` (label not needed)
    unused:  everything else (Q22)."""
    tr, te, pr = split_indices(split, unit)
    s = (F.when(F.col(label_idx) <= tr, F.lit("train"))
          .when(F.col(label_idx) == te, F.lit("test"))
          .when(F.col(idx) == pr - 1, F.lit("predict"))
          .otherwise(F.lit("unused")))
    return df.withColumn("split", s)


def split_counts(df: DataFrame) -> DataFrame:
    """Number of sequences per split (a pipeline raises on a zero)."""
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def explode_steps(df: DataFrame, keys: list[str], feature_cols: list[str], seq: str = "seq",
                  idx: str = "period_idx") -> DataFrame:
    """Flatten ``seq`` to one row per (anchor, step) with named feature
    columns (F11 reshape (N, L, F) → (N·L, F))."""
    e = df.select(*keys, idx, F.posexplode(seq).alias("step", "_x"))
    return e.select(*keys, idx, "step", *[F.col("_x")[i].alias(c) for i, c in enumerate(feature_cols)])
