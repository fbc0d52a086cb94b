"""Feature-table level operators: merging the narrow tables (J2), key
validation (S5) and the per-(entity, period) roll-up (A12)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.columns import not_nan, q
from ..functions.periods import checked_period, parse_period, period_index
from ..sources.io import deal, entity_batches, input_bytes, tasks_for

# The name parts by which users of the feature tables tell averaged columns.
MEAN_MARKERS = ("ratio", "avg", "std", "change")

# Fixed value: bytes of stored feature tables that are merged at once; about twice as many are shuffled.
BATCH_BYTES = 1 << 30


def merge_batches(tables: list[DataFrame], entity: str = "customer_id", keys=("customer_id", "period"), batch_bytes: int | None = None) -> list[DataFrame]:
    """:func:`merge_tables` by ``entity`` of stored tables as one frame per batch of
    entities, together its rows: whoever writes them one after the other holds
    the shuffle of one batch.  A batch per ``batch_bytes`` of files."""
    size = batch_bytes or BATCH_BYTES
    n = max(1, -(-sum(input_bytes(t) for t in tables) // size))
    parts = [entity_batches(t, entity, n) for t in tables]
    return [merge_tables(list(p), keys, deal_by=entity, share=n) for p in zip(*parts)]


def merge_tables(tables: list[DataFrame], keys=("customer_id", "period"), deal_by: str | None = None, share: int = 1) -> DataFrame:
    """Inner merge of feature tables, each unique on the keys, on these.

    One union and one aggregate, so all tables meet in a single shuffle however
    many there are.  The rows are shuffled as they are, each table's values as one
    struct, and spread to columns where they meet: no row carries the columns of
    the other tables along.  ``deal_by``: the key whose rows are to lie together
    (the entity, for roll-up and windows that follow); otherwise all keys.  A key
    that a table lacks, or that is NULL, drops out; one that a table has twice
    fails the job (a merge would multiply its rows).  ``share``: the tables are filtered
    to one of so many parts of their files."""
    keys = list(keys)
    for n, t in enumerate(tables, 1):
        lacking = [k for k in keys if k not in t.columns]
        if lacking:
            raise ValueError(f"table {n} of {len(tables)} lacks the key columns {lacking}")
    values = [[c for c in t.columns if c not in keys] for t in tables]
    names = [c for cs in values for c in cs]
    if len({c.lower() for c in names}) != len(names):
        raise ValueError("a value column is in more than one table")
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [
        t.select(*keys, F.struct(*[F.col(q(c)) for c in cs] or [F.lit(1).alias("_in")]).alias(f"_t{n}")) for n, (t, cs) in enumerate(zip(tables, values))])
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    tasks = tasks_for(united)
    met = deal(united.where(known), tasks and -(-tasks // share), *([deal_by] if deal_by else keys))
    merged = met.groupBy(*keys).agg(*[F.any_value(F.col(f"_t{n}")[c], F.lit(True)).alias(c) for n, cs in enumerate(values) for c in cs],
                                    *[F.count(f"_t{n}").alias(f"_n{n}") for n in range(len(tables))])
    counts = [F.col(f"_n{n}") for n in range(len(tables))]
    twice = reduce(lambda a, b: a | b, [c > 1 for c in counts])
    every = reduce(lambda a, b: a & b, [c == 1 for c in counts])
    return merged.where(F.when(twice, F.raise_error(F.concat_ws(
        " ", F.lit("repeated key:"), *[F.col(k).cast("string") for k in keys])).cast("boolean")).otherwise(every)).select(*keys, *[q(c) for c in names])


def merge_bucketed(tables: list[DataFrame], keys=("customer_id", "period")) -> DataFrame:
    """J2 over tables that are bucketed alike by ``keys`` (``io.write_bucketed``):
    the same result as :func:`merge_tables`, each table aggregated to its keys
    and merge-joined where its buckets lie, so that no row is shuffled."""
    keys = list(keys)
    values = [c for t in tables for c in t.columns if c not in keys]
    if len({c.lower() for c in values}) != len(values):
        raise ValueError("a value column is in more than one table")
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    one = [t.where(known).groupBy(*keys).agg(*[F.any_value(q(c)).alias(c) for c in t.columns if c not in keys],
                                             F.count(F.lit(1)).alias(f"_n{n}")) for n, t in enumerate(tables)]
    both = reduce(lambda a, b: a.hint("merge").join(b.hint("merge"), keys), one)
    twice = reduce(lambda a, b: a | b, [F.col(f"_n{n}") > 1 for n in range(len(tables))])
    return both.where(F.when(twice, F.raise_error(F.concat_ws(
        " ", F.lit("repeated key:"), *[F.col(k).cast("string") for k in keys])).cast("boolean")).otherwise(F.lit(True))).select(*keys, *[q(c) for c in values])


def observe_keys(df: DataFrame, keys=("customer_id", "period")) -> tuple[DataFrame, Observation]:
    """S5 inside another job: ``df`` unchanged, and an observation whose ``get``
    has, once a job has run over it, n_rows, n_null_keys (rows with a NULL in a
    key) and n_repeated_keys (rows beyond the first of their key).

    Rows of a key are brought together by a window over the keys, which needs no
    shuffle of its own where the rows already lie by (some of) the keys; rows with a
    NULL key are spread by their other values.  A stage that Spark runs again after
    losing an executor counts its rows again: zeros stay zeros, other counts
    may come out high."""
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"missing key columns {missing}")
    null = reduce(lambda a, b: a | b, [F.col(q(k)).isNull() for k in keys])
    rest = [F.col(q(c)) for c, kind in df.dtypes if c not in keys and "map<" not in kind]
    spread = F.when(null, F.xxhash64(*rest) if rest else F.lit(0).cast("long"))
    nth = F.row_number().over(Window.partitionBy(*[q(k) for k in keys], spread).orderBy(*[q(k) for k in keys]))
    seen = Observation()
    flagged = df.withColumn("_again", ~null & (nth > 1)).withColumn("_null", null)
    observed = flagged.observe(seen, F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(F.col("_null").cast("long")), F.lit(0)).alias("n_null_keys"),
                               F.coalesce(F.sum(F.col("_again").cast("long")), F.lit(0)).alias("n_repeated_keys"))
    return observed.drop("_again", "_null"), seen


def observe_counts(df: DataFrame, column: str, values) -> tuple[DataFrame, Observation]:
    """E16 inside another job: ``df`` unchanged, and an observation of how many
    rows have each of the listed ``values`` in ``column``."""
    seen = Observation()
    return df.observe(seen, *[F.count(F.when(F.col(column) == v, 1)).alias(str(v)) for v in values]), seen


def validate_keys(df: DataFrame, keys=("customer_id", "period")) -> DataFrame:
    """Problems with the key columns, one row per offending key value:
    (kind, key..., n) where kind is ``null_key`` or ``duplicate_key``.  An
    empty result means the table is keyed correctly.  Raises right away if a
    key column is missing (schema check, no job).

    Nearly every key is expected once, so counting before the shuffle would only hold
    each task's rows twice: the keys alone are dealt to as many tasks as the files
    need and counted there.  Rows with one and the same key meet in one task, which
    streams them into one count."""
    missing = [k for k in keys if k not in df.columns]
    if missing:
        raise ValueError(f"missing key columns {missing}")
    keys = list(keys)
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    rows, tasks = df.select(*keys), tasks_for(df)
    counted = (deal(rows, tasks, *keys) if tasks else rows).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(any_null | (F.col("n") > 1)).select(
        F.when(any_null, F.lit("null_key")).otherwise(F.lit("duplicate_key")).alias("kind"), *keys, "n")


def rollup_rule(columns: list[str], explicit: dict[str, str] | None = None) -> dict[str, str]:
    """A12 aggregation map: explicit entries win; otherwise a column whose
    lower-cased name contains ratio / avg / std / change is averaged and every
    other numeric column summed.  Pivot columns should be passed explicitly
    (Q3: a category named e.g. 'decoration' must not be averaged)."""
    explicit = explicit or {}
    rule = {}
    for c in columns:
        if c in explicit:
            rule[c] = explicit[c]
        else:
            rule[c] = "mean" if any(m in c.lower() for m in MEAN_MARKERS) else "sum"
    return rule


def monthly_rollup(df: DataFrame, entity: str = "customer_id", period: str = "period",
                   unit: str = "month", explicit: dict[str, str] | None = None, strict: bool = False) -> DataFrame:
    """Re-aggregate feature rows to one row per (entity, period).

    The period text is parsed (E2) and truncated to ``unit``; numeric columns
    are summed or averaged by :func:`rollup_rule`; non-numeric columns are
    dropped, and so are rows with a NULL entity or period, or with a text that
    is no period (``strict``: that fails the job).  NULL and NaN are
    skipped: a sum of none is 0, a mean of none NULL.  Output: entity,
    ``period_start`` (DATE), ``period_idx``, then summed columns in sorted
    order, then averaged ones in sorted order.  On input that is already unique
    per (entity, period) this is the identity."""
    num = [f.name for f in df.schema.fields
           if isinstance(f.dataType, NumericType) and f.name not in (entity, period, "period_idx")]
    rule = rollup_rule(num, explicit)
    sums = sorted(c for c, r in rule.items() if r == "sum")
    means = sorted(c for c, r in rule.items() if r == "mean")
    src = df.where(F.col(entity).isNotNull() & F.col(period).isNotNull())
    src = src.withColumn("period_start", checked_period(period, unit) if strict else parse_period(period, unit))
    aggs = [F.coalesce(F.sum(not_nan(df, c)), F.lit(0)).alias(c) for c in sums] + [F.avg(not_nan(df, c)).alias(c) for c in means]
    g = src.groupBy(entity, "period_start").agg(*aggs)
    g = g.where(F.col("period_start").isNotNull())  # on aggregated rows: the text is parsed once per row
    return g.select(entity, "period_start", period_index("period_start", unit).alias("period_idx"), *[q(c) for c in sums + means])
