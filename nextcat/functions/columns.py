"""Small column helpers shared by the operators."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

_UNSAFE = re.compile(r"[^0-9A-Za-z_]")
#: Feature columns that a prefix and a value could spell as well.
RESERVED = ("category_diversity",)


def pivot_names(prefix: str, values) -> list[str]:
    """Column names of pivot values: prefix + value with every character
    outside ``[0-9A-Za-z_]`` replaced by ``_`` (Parquet- and SQL-friendly).

    Values whose names would be equal, in any case, all get the CRC-32 of the
    value appended, so any text in any script has a name of its own."""
    names = [prefix + _UNSAFE.sub("_", str(v)) for v in values]
    often = Counter(n.lower() for n in (*names, *RESERVED))
    names = [n if often[n.lower()] == 1 else f"{n}_{zlib.crc32(str(v).encode()):08x}" for n, v in zip(names, values)]
    taken = Counter(n.lower() for n in names)
    if len(taken) != len(names):  # equal values, or a value that looks like another one's name
        raise ValueError(f"pivot values {[v for n, v in zip(names, values) if taken[n.lower()] > 1]!r} have one name")
    return names


def q(name: str) -> str:
    """Back-quote a column name for Spark SQL strings."""
    return "`" + name.replace("`", "``") + "`"


def safe_div(num, den) -> Column:
    """Division that yields NULL (not an ANSI error, not ±inf) on a zero or
    NULL denominator."""
    return F.try_divide(num, den)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often the body
    names it (a column alias would be copied into every lambda)."""
    return F.transform(F.array(value), body)[0]


def row_sum(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, cols) if cols else F.lit(0)


def not_nan(df: DataFrame, name: str) -> Column:
    """The column with NaN as NULL (other types unchanged)."""
    c = F.col(q(name))
    kind = df.schema[name].dataType.typeName()
    return F.nanvl(c, F.lit(None).cast(kind)) if kind in ("double", "float") else c


def fill_zero(df: DataFrame, exclude=()) -> DataFrame:
    """NULL → 0 on every numeric column (NaN too, for doubles)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, NumericType) and f.name not in set(exclude):
            out.append(F.coalesce(not_nan(df, f.name), F.lit(0).cast(f.dataType)).alias(f.name))
        else:
            out.append(F.col(q(f.name)))
    return df.select(*out)
