"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a seeded random order (MD5 of seed,
id and text), gone through ``max_epochs`` times.  A document copy's virtual finish
time is its source's cumulative tokens, this copy included, divided by the
source's target, so every source reaches its target at virtual time 1.  The copies
of all sources are sorted by (finish, source, epoch, place in the source) and
taken from the front until the total budget is used up; the copy in service then
is taken in part.  No source is cut on its own: what one leaves at time 1,
because its next document is long, goes to those whose next documents finish
first.  A source therefore takes its target up to the size of one of its
documents, or up to what others leave.

Targets: sources get budget in proportion to weight, stop at ``max_epochs``
times their size, and what is over goes to the others by weight (water-filling,
solved by sorting sources by the share at which they stop).

No source is handled whole by one task: rows are range-sorted by (source, order),
ranges summed, their sums (a row per source and range) prefix-summed, and the
running sum inside a range added.  Finish times fill 0 to 1 evenly in words
whatever the sources, so fixed ranges of them, as many as the counted rows ask
for, are even; times from 2 on fall in ranges of their logarithm.  Only the ranges
before the budget's end are sorted.  Texts are never shuffled.

Defined cases: null text: size 0; documents of size 0 are never taken; a null
source is a source, last in order; rows of equal id and text are ordered by id and
size, and rows equal in all are interchangeable; an empty table gives no rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.trends import numbered, range_sorted
from .common import SPACE, WORD, cut, fresh, row_key, text_of

#: Least number of ranges of the virtual time from 0 to 1, and rows of a range beyond which there are more.
RANGES = 4096
RANGE_ROWS = 100_000


@dataclass(frozen=True)
class Mix:
    weights: tuple[float, ...] = (5, 2, 1)  # of the sources in code point order, repeating
    budget: float = 1.5                     # words of the mix, as a multiple of all words
    max_epochs: int = 2                     # times that a document may be taken
    seed: int = 42


def size_of(text: str = "text") -> Column:
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """(source, source_size, target) from (source, source_size), a row per source.

    Sources are numbered, and their caps and weights summed, over sorted ranges:
    no task sees more than a range of them."""
    last = F.col("source").asc_nulls_last()
    weight = F.array(*[F.lit(float(w)) for w in mix.weights])[F.pmod(F.col("_n") - 1, F.lit(len(mix.weights))).cast("int")]
    w = numbered(sizes.select("source", "source_size"), last).select("source", "source_size", weight.alias("weight"))
    w = w.withColumn("cap", F.col("source_size") * mix.max_epochs).withColumn("full", F.col("cap") / F.col("weight"))
    rows = range_sorted(w, F.col("full"), last)
    per = cut(rows.groupBy("_part").agg(F.sum("cap").alias("cap"), F.sum("weight").alias("weight"), F.sum("source_size").alias("size")))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    ahead = per.select(F.col("_part").alias("range"), F.coalesce(F.sum("cap").over(earlier), F.lit(0)).alias("caps"),
                       F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)).alias("weights"))
    whole = per.agg((F.sum("size") * F.lit(mix.budget)).alias("budget"), F.sum("weight").alias("all_weights"))
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    filled = (rows.join(F.broadcast(ahead), F.col("_part") == F.col("range")).join(F.broadcast(whole)).select(
        "source", "source_size", "weight", F.col("cap").cast("double").alias("cap"), "budget",
        (F.col("caps") + F.coalesce(F.sum("cap").over(inside), F.lit(0))).alias("stopped"),
        (F.col("all_weights") - (F.col("weights") + F.coalesce(F.sum("weight").over(inside), F.lit(0.0)))).alias("open")))
    # share per weight if all sources before this one have stopped; the first that does not stop there sets it for all after
    filled = cut(filled.withColumn("share", (F.col("budget") - F.col("stopped")) / F.col("open")))
    level = filled.agg(F.min(F.when(F.col("share") * F.col("weight") <= F.col("cap"), F.struct("stopped", "share")))["share"].alias("level"))
    return filled.join(F.broadcast(level)).select("source", "source_size", F.when(  # one row
        F.col("level").isNull() | (F.col("level") * F.col("weight") > F.col("cap")), F.col("cap"))
        .otherwise(F.col("level") * F.col("weight")).alias("target"))


def finish_range(finish: Column, ranges: int) -> Column:
    """Number of the range that a virtual finish time falls in, ascending with it."""
    late = 2 * ranges + F.floor(F.log2(F.greatest(finish, F.lit(2.0))) * 64)
    return F.when(finish < 2, F.floor(finish * ranges)).otherwise(late).cast("int")


def mix_sources(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text: str = "text",
                source: str = "source") -> tuple[DataFrame, DataFrame]:
    """(documents, mix).

    documents: a row per row of ``docs``: id, key (of the whole row), slot (the
    row's place in its source, unique), source, size, source_size, target.
    mix: a row per copy taken, in mixing order: slot, source, epoch, taken
    (words), finish (virtual time), position (words of the mix before it); the
    order is that of (finish, source, epoch, slot)."""
    order = F.md5(F.concat(F.lit(f"{mix.seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(":"), F.md5(text_of(text))))
    sized = docs.select(F.col(id_col).alias("id"), row_key(docs, id_col, text).alias("key"), F.col(source).cast("string").alias("source"),
                        size_of(text).alias("size"), order.alias("order"))
    sized = cut(sized.withColumn("row", F.monotonically_increasing_id()))
    # the row number, last in order, lets a third of all rows be equal: they lie over as many ranges as they need
    rows = range_sorted(sized, F.col("source").asc_nulls_last(), "order", "id", "size", "key", "row")
    sums = cut(rows.groupBy("source", "_part").agg(F.sum("size").alias("sum"), F.count("*").alias("rows")))
    goal = cut(targets(sums.groupBy("source").agg(F.sum("sum").alias("source_size")), mix))
    total = F.coalesce(F.sum("source_size"), F.lit(0))
    budget, n = goal.agg(F.floor(total * F.lit(mix.budget))).first()[0], sums.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    ranges = max(RANGES, -(-n // RANGE_ROWS))
    earlier = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    start = (sums.select("source", "_part", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("sum_before"),
                         F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before")))
    at = (start.join(goal.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
          .withColumnsRenamed({"source": "_source", "_part": "_range"}))
    inside = Window.partitionBy("source", "_part").orderBy("_at")
    queued = rows.join(at, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_part") == F.col("_range")))
    queued = cut(queued.select(
        "id", "key", "source", "size", "source_size", "target",
        (F.col("rows_before") + F.row_number().over(inside)).alias("slot"),
        (F.col("sum_before") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("before")))
    epochs = F.sequence(F.lit(0), F.lit(mix.max_epochs - 1))
    copies = (queued.where("size > 0").select("slot", "source", "size", "target", "before", "source_size", F.explode(epochs).alias("epoch"))
              .select("slot", "source", "epoch", "size",
                      ((F.col("before") + F.col("epoch") * F.col("source_size") + F.col("size")).cast("double") / F.col("target")).alias("finish")))
    timed = copies.withColumn("range", finish_range(F.col("finish"), ranges))
    ahead = timed.groupBy("range").agg(F.sum("size").alias("n")).select("range", F.coalesce(F.sum("n").over(  # a row per range
        Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead")).where(F.col("ahead") < budget)
    own = Window.partitionBy("range").orderBy("finish", F.col("source").asc_nulls_last(), "epoch", "slot")
    placed = timed.join(ahead, "range").select(
        "slot", "source", "epoch", "size", "finish",
        (F.col("ahead") + F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")).alias("position"))
    taken = F.least(F.col("size"), budget - F.col("position"))
    mixed = placed.where(F.col("position") < budget).select("slot", "source", "epoch", taken.alias("taken"), "finish", "position")
    return queued.drop("before"), mixed


def mix_report(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(id, size, source_size, target, taken) per row of ``docs``; taken sums its copies' words."""
    rows, mixed = mix_sources(docs, mix, id_col, text, source)
    taken = mixed.groupBy("source", "slot").agg(F.sum("taken").alias("taken"))
    return rows.join(taken, rows.source.eqNullSafe(taken.source) & (rows.slot == taken.slot), "left").select(
        "id", "size", "source_size", "target", F.coalesce(taken.taken, F.lit(0)).alias("taken"))


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word, white space between words kept."""
    pieces = F.split(text, r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")  # every piece but a blank first one holds a word
    lead = F.when(text.rlike("^" + SPACE), 1).otherwise(0)
    return F.regexp_replace(F.array_join(F.slice(pieces, 1, n.cast("int") + lead), ""), SPACE + "+$", "")


def mixed_documents(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """A row per copy taken, with the columns of ``docs``, range-sorted into
    mixing order; the copy in service when the budget ends is cut after the words
    taken."""
    rows, mixed = mix_sources(docs, mix, id_col, text, source)
    key, size, taken, position, pick = fresh(docs, "_key", "_size", "_taken", "_position", "_pick")
    chosen = rows.join(mixed, rows.source.eqNullSafe(mixed.source) & (rows.slot == mixed.slot)).select(
        F.col("key").alias(key), rows["size"].alias(size), F.col("taken").alias(taken), F.col("position").alias(position))
    own = docs.withColumn(key, row_key(docs, id_col, text))
    one = Window.partitionBy(key).orderBy(key)  # of equal rows; each of them has slots, so copies, of its own
    both = own.withColumn(pick, F.row_number().over(one)).where(F.col(pick) == 1).join(chosen, key).orderBy(position)
    columns = [F.when(F.col(taken) < F.col(size), first_words(F.col(text), F.col(taken))).otherwise(F.col(text)).alias(text)
               if c == text else F.col(c) for c in docs.columns]
    return both.select(*columns)
