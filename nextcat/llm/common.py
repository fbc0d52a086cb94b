"""Helpers shared by the operators: the word definition, a one-value binding
for column expressions, row keys and fresh column names."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut  # noqa: F401  the operators' lineage cut

#: White space between words, and a word, as every contract states them.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def importable(spark: SparkSession) -> None:
    """Let Python tasks import this package from where the driver has it; on a
    cluster that installs or ships it, that changes nothing."""
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often the
    body names it (the optimizer would copy a column alias into lambdas)."""
    return F.transform(F.array(value), body)[0]


def text_of(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text, in order (empty array for an empty text)."""
    return F.array_remove(F.split(text, SPACE + "+"), "")


def row_key(docs: DataFrame, id_col: str, text: str) -> Column:
    """16 bytes, equal only for rows that agree in id, text and (by hash) all
    other columns; map columns are left out, as they have no hash."""
    rest = [F.col(c) for c, kind in docs.dtypes if c not in (id_col, text) and "map<" not in kind]
    other = F.xxhash64(*rest).cast("string") if rest else F.lit("")
    return F.unhex(F.md5(F.concat_ws("\n", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), other, text_of(text))))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def broadcast_if_small(df: DataFrame, rows: int, limit: int = 10_000) -> DataFrame:
    """A broadcast hint when the counted rows stay within ``limit``; beyond it
    the planner joins by shuffle."""
    return F.broadcast(df) if rows <= limit else df
