"""Line dedup by distinct-site spread [native].

A line (trimmed of white space at both ends) that many sites share is
boilerplate.  One aggregate per line hash merges HyperLogLog sketches of the
sites; only lines whose estimate lies near the threshold get an exact distinct
count, so the decision equals the exact one as long as an estimate is not off
by more than the margin (ten times the sketch's standard error, and two sites).

Lines are split once into a written table of hashes; hot lines are
pre-aggregated before they are shuffled, and only line numbers travel back to
the documents.

Shared lines go whatever their share of a document; only one in which no line of
its own would remain is left whole, for the near-duplicate stage.

Defined cases: null or empty text: no lines, text unchanged; a null site counts
as one site of its own; blank lines never count and are never removed; repeated
rows are treated alike; a null id is an id like any other."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, cut, fresh, let, row_key, text_of

#: Line hashes that are broadcast (some megabytes); beyond, lines are joined by shuffle.
BROADCAST_LINES = 100_000
_BLANKS = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class LineRules:
    min_sites: int = 10  # distinct sites that make a line boilerplate
    lg_k: int = 12       # log2 of the sketch's registers: standard error 1.04 / sqrt(2^lg_k)

    @property
    def margin(self) -> float:
        return 2 + self.min_sites * 10 * 1.04 / 2 ** (self.lg_k / 2)


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(_BLANKS))


def line_rows(docs: DataFrame, id_col: str = "doc_id", text: str = "text", site: str = "source") -> DataFrame:
    """(key, site, pos, line) of every non-blank line; key stands for the row, line is the line's MD5."""
    base = docs.select(row_key(docs, id_col, text).alias("key"), F.concat(F.lit("s"), F.col(site).cast("string")).alias("s"),
                       _lines(text_of(text)).alias("lines"))
    rows = base.select("key", F.coalesce("s", F.lit("null")).alias("site"), F.posexplode("lines").alias("pos", "raw"))
    return (rows.select("key", "site", "pos", _trimmed(F.col("raw")).alias("t")).where(F.col("t") != "")
            .select("key", "site", "pos", F.unhex(F.md5("t")).alias("line")))


def shared_lines(lines: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """The ``line`` hashes that at least ``min_sites`` sites share."""
    sketched = (lines.groupBy("line").agg(F.count("*").alias("n"), F.hll_sketch_agg("site", rules.lg_k).alias("sk"))
                .where(F.col("n") >= rules.min_sites)
                .select("line", F.hll_sketch_estimate("sk").alias("est")))
    sketched = cut(sketched.where(F.col("est") >= rules.min_sites - rules.margin))
    clear = sketched.where(F.col("est") > rules.min_sites + rules.margin).select("line")
    near = sketched.where(F.col("est") <= rules.min_sites + rules.margin).select("line")
    # (line, site) pairs are made distinct before lines meet, so that a hot line is a row per site and task
    close = _among(lines.select("line", "site"), near) if near.count() <= BROADCAST_LINES else _among(
        lines.select("line", "site").distinct(), near)
    exact = (close.groupBy("line").agg(F.countDistinct("site").alias("sites"))
             .where(F.col("sites") >= rules.min_sites).select("line"))
    return clear.unionByName(exact)


def _among(lines: DataFrame, some: DataFrame) -> DataFrame:
    """The rows whose line is in ``some``, a written table of 16-byte hashes."""
    return lines.join(broadcast_if_small(some, some.count(), BROADCAST_LINES), "line", "left_semi")


def _without(lines: Column, pos: Column) -> Column:
    """``lines`` but those at the sorted places ``pos``: the stretches between
    them, so that the work grows with the lines and not with their product."""
    n = F.size(pos)
    begin = lambda k: F.when(k == 0, 0).otherwise(F.get(pos, k - 1) + 1)
    end = lambda k: F.when(k == n, F.size(lines)).otherwise(F.get(pos, k))
    return F.flatten(F.transform(F.sequence(F.lit(0), n), lambda k: F.slice(lines, begin(k) + 1, end(k) - begin(k))))


def line_dedup(docs: DataFrame, rules: LineRules = LineRules(), id_col: str = "doc_id", text: str = "text",
               site: str = "source", out: str = "lines") -> DataFrame:
    """``docs`` with the boilerplate lines taken out of ``text`` (other columns
    unchanged), plus a struct ``out``: n_lines (non-blank lines before),
    n_shared (boilerplate lines found) and n_removed (0 where the document is
    left whole)."""
    lines = cut(line_rows(docs, id_col, text, site))  # hashes only, read three times
    hits = (_among(lines, cut(shared_lines(lines, rules)))
            .groupBy("key").agg(F.sort_array(F.collect_set("pos")).alias("pos")))
    key, pos, row, out = fresh(docs, "_key", "_pos", "_row", out)
    left = docs.withColumn(row, row_key(docs, id_col, text))
    both = left.join(hits.select(F.col("key").alias(key), F.col("pos").alias(pos)), F.col(row) == F.col(key), "left")
    n_lines = F.size(F.filter(_lines(text_of(text)), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))).cast("long")
    n_shared = F.coalesce(F.size(pos), F.lit(0)).cast("long")
    stats, = fresh(both, "_stats")
    both = both.withColumn(stats, F.struct(n_lines.alias("n_lines"), n_shared.alias("n_shared")))
    n_lines, n_shared = F.col(stats)["n_lines"], F.col(stats)["n_shared"]
    cuts = (n_shared > 0) & (n_shared < n_lines)
    kept = let(_lines(F.col(text)), lambda ls: F.array_join(_without(ls, F.col(pos)), "\n"))
    columns = [F.when(cuts, kept).otherwise(F.col(text)).alias(text) if c == text else F.col(c) for c in docs.columns]
    return both.select(*columns, F.struct(
        F.col(stats)["n_lines"].alias("n_lines"), F.col(stats)["n_shared"].alias("n_shared"),
        F.when(cuts, F.col(stats)["n_shared"]).otherwise(F.lit(0)).cast("long").alias("n_removed")).alias(out))


def drop_shared_lines(docs: DataFrame, rules: LineRules = LineRules(), id_col: str = "doc_id", text: str = "text",
                      site: str = "source") -> DataFrame:
    """``docs`` without boilerplate lines, columns unchanged."""
    out, = fresh(docs, "lines")
    return line_dedup(docs, rules, id_col, text, site, out).drop(out)
