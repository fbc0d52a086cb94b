r"""Chat formatting into budgeted windows [native].

Template: each turn is ``<turn ROLE>``, a new line, the text, ``</turn>`` and a
new line.  In roles and texts ``\`` is written ``\b``, ``<`` is ``\l`` and ``>``
is ``\g``, so no marker can occur inside a text and the reading back is exact.

A conversation's turns (a first turn of role system apart) have a running sum
of tokens.  It is cut into strides of ``budget - history - system tokens``:
turns inside one stride make a window, a turn that crosses into the next makes
one of its own, so windows are aligned to turns and only a single turn larger
than a stride can exceed the budget.  Every window begins with the system turn,
then repeats the turns that began at most ``history`` tokens before it.  The
loss mask covers the texts of assistant turns where they are new; repeated
targets are masked out.

Running sums are two-level: rows are range-sorted by conversation and turn, so
a long conversation lies over many tasks, each sums its own part, and the parts'
sums are added up.  A window's turns are gathered in one row (bounded by the
budget); no conversation is.

Defined cases: null roles and texts are empty; turns are ordered by turn (null
first), role, then MD5 of the text; repeated rows are turns of their own; a null
conv_id is a conversation; a system turn alone makes one window; an empty table
makes none."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, cut, let, text_of


@dataclass(frozen=True)
class ChatWindows:
    budget: int = 512    # tokens (words, and three for a turn's markers)
    history: int = 128   # of these, for repeated turns
    target: str = "assistant"
    system: str = "system"


def escape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l")), F.lit(">"), F.lit("\\g"))


def unescape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("\\g"), F.lit(">")), F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def head_of(role: Column) -> Column:
    return F.concat(F.lit("<turn "), escape(role), F.lit(">\n"))


TAIL = "</turn>\n"


def _turns(rows: DataFrame, conf: ChatWindows) -> DataFrame:
    """(conv, at, role, text, system, tokens, begin, stride, span): rows in
    order, with the tokens before them; span -1 for the system turn."""
    ordered = cut(rows.repartitionByRange("conv", "turn", "role", "tie").sortWithinPartitions("conv", "turn", "role", "tie")
                  .select("conv", "role", "text", "tokens", F.spark_partition_id().alias("part"),
                          F.monotonically_increasing_id().alias("at")))
    heads = ordered.groupBy("conv").agg(F.min("at").alias("first"), F.min_by(F.struct("role", "tokens"), "at").alias("head"))
    room = F.greatest(F.lit(1), F.lit(conf.budget) - F.when(F.col("head.role") == conf.system, F.col("head.tokens")).otherwise(0))
    past = F.greatest(F.lit(0), F.least(F.lit(conf.history), room - max(1, conf.budget // 4)))
    heads = heads.select(F.col("conv").alias("h_conv"), F.when(F.col("head.role") == conf.system, F.col("first")).alias("system_at"),
                         past.alias("past"), (room - past).alias("stride"))
    joined = cut(ordered.join(heads, F.col("conv").eqNullSafe(F.col("h_conv"))).select(
        ordered["*"], "stride", "past", F.coalesce(F.col("at") == F.col("system_at"), F.lit(False)).alias("system")))
    size = F.when(F.col("system"), 0).otherwise(F.col("tokens"))
    parts = joined.groupBy("conv", "part").agg(F.sum(size).alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("conv").alias("p_conv"), F.col("part").alias("p_part"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("conv", "part").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    summed = (joined.join(parts, F.col("conv").eqNullSafe(F.col("p_conv")) & (F.col("part") == F.col("p_part")))
              .select("conv", "at", "role", "text", "system", "tokens", "stride", "past", (F.col("before") + F.sum(size).over(inside) - size).alias("begin")))
    cell = F.floor(F.col("begin") / F.col("stride"))
    last = F.floor((F.col("begin") + F.col("tokens") - 1) / F.col("stride"))
    return cut(summed.withColumn("span", F.when(F.col("system"), F.lit(-1)).otherwise(
        2 * cell + F.when(cell == last, 0).otherwise(1)).cast("long")))


def format_windows(chats: DataFrame, conf: ChatWindows = ChatWindows(), conv: str = "conv_id", turn: str = "turn",
                   role: str = "role", text: str = "text") -> DataFrame:
    """(conv column, window long, text string, n_turns int, repeated int, loss
    array<struct<begin, end>>) per window.  window numbers rise with the turns
    but may leave gaps; the first ``repeated`` turns of a window stand in an
    earlier one too; loss: code point ranges of the text, 0-based, end excluded."""
    if not 0 <= conf.history < conf.budget:
        raise ValueError("history must be below the budget")
    body = text_of(text)
    turns = _turns(chats.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), text_of(role).alias("role"), body.alias("text"), F.md5(body).alias("tie"),
        (F.regexp_count(body, F.lit(WORD)) + 3).cast("long").alias("tokens")), conf)
    spans = turns.groupBy("conv", "span").agg(F.min("begin").alias("start"), F.first("stride").alias("stride"))
    most = turns.groupBy("conv").agg(F.max("span").alias("most")).select(F.col("conv").alias("m_conv"), "most")
    windows = cut(spans.join(most, F.col("conv").eqNullSafe(F.col("m_conv"))).where("span >= 0 OR most = -1")
                  .select(F.col("conv").alias("w_conv"), F.col("span").alias("window"), "start", F.floor(F.col("start") / F.col("stride")).alias("w_cell")))
    part = F.struct("at", "role", F.col("text").alias("text"), F.col("new"))
    own = turns.where("span >= 0").select("conv", F.col("span").alias("window"), "at", "role", "text", F.lit(True).alias("new"))
    system = turns.where("system").join(windows, F.col("conv").eqNullSafe(F.col("w_conv"))).select(
        "conv", "window", "at", "role", "text", (F.col("start") == 0).alias("new"))
    # a turn can be history of windows that start at most `history` tokens after it: these lie in a few strides
    near = turns.where("span >= 0").withColumn("cell", F.explode(F.sequence(
        F.floor((F.col("begin") + F.col("tokens")) / F.col("stride")), F.floor((F.col("begin") + F.greatest(F.col("tokens"), F.col("past"))) / F.col("stride")))))
    again = near.join(windows, F.col("conv").eqNullSafe(F.col("w_conv")) & (F.col("cell") == F.col("w_cell"))).where(
        (F.col("start") > F.col("begin")) & (F.col("start") - F.col("begin") <= F.col("past")) & (F.col("window") > F.col("span"))).select(
        "conv", "window", "at", "role", "text", F.lit(False).alias("new"))
    gathered = own.unionByName(system).unionByName(again).groupBy("conv", "window").agg(F.sort_array(F.collect_list(part)).alias("turns"))

    def built(t: Column) -> Column:
        pieces = F.transform(t, lambda x: F.struct(head_of(x["role"]).alias("head"), escape(x["text"]).alias("text"),
                                                   (x["new"] & (x["role"] == conf.target)).alias("loss")))
        size = lambda x: F.length(x["head"]) + F.length(x["text"]) + len(TAIL)
        before = lambda p, i: F.aggregate(F.slice(p, 1, i), F.lit(0), lambda s, x: s + size(x))
        return let(pieces, lambda p: F.struct(
            F.array_join(F.transform(p, lambda x: F.concat(x["head"], x["text"], F.lit(TAIL))), "").alias("text"),
            F.size(p).alias("n_turns"), F.size(F.filter(t, lambda x: ~x["new"])).alias("repeated"),
            F.transform(F.filter(F.transform(p, lambda x, i: F.struct(
                x["loss"].alias("loss"), (before(p, i) + F.length(x["head"])).alias("begin"),
                (before(p, i) + F.length(x["head"]) + F.length(x["text"])).alias("end"))), lambda x: x["loss"]),
                lambda x: F.struct(x["begin"].alias("begin"), x["end"].alias("end"))).alias("loss")))
    return gathered.select(F.col("conv").alias(conv), F.col("window").cast("long").alias("window"), let(F.col("turns"), built).alias("w")).select(
        conv, "window", "w.text", "w.n_turns", "w.repeated", "w.loss")


def read_turns(window_text: Column) -> Column:
    """The turns of a formatted text: array<struct<role, text>>."""
    pieces = F.split(window_text, "</turn>\n")
    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda p: F.struct(
        unescape(F.substring(F.substring_index(p, ">\n", 1), 7, 1 << 30)).alias("role"),
        unescape(F.substring(p, F.instr(p, ">\n") + 2, F.length(p))).alias("text")))


def loss_text(window_text: Column, loss: Column) -> Column:
    """All text under the mask, unescaped."""
    return F.array_join(F.transform(loss, lambda x: unescape(F.substring(window_text, x["begin"] + 1, x["end"] - x["begin"]))), "")


def conversation_digests(windows: DataFrame, conv: str = "conv_id") -> DataFrame:
    """The digest columns per conversation, read back from formatted windows.  A
    digest over a whole conversation needs its new turns in one row."""
    new = F.slice(read_turns(F.col("text")), F.col("repeated") + 1, F.col("n_turns"))
    said = F.array_join(F.transform(new, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = windows.select(conv, (F.col("n_turns") - F.col("repeated")).alias("n"), F.length("text").alias("chars"),
                          F.struct("window", said.alias("said"), loss_text(F.col("text"), F.col("loss")).alias("loss")).alias("w"))
    whole = read.groupBy(conv).agg(F.sum("n").cast("long").alias("n_turns"), F.sum("chars").cast("long").alias("formatted_chars"),
                                   F.sort_array(F.collect_list("w")).alias("w"))
    joined = lambda name: F.array_join(F.transform("w", lambda x: x[name]), "")
    return whole.select(conv, "n_turns", F.sha2(joined("said"), 256).alias("turns_sha256"), F.length(joined("loss")).cast("long").alias("loss_chars"),
                        F.sha2(joined("loss"), 256).alias("loss_sha256"), "formatted_chars")
