"""Output normalisation shared by the Spark side and the SQL side of a comparison.

Integers become BIGINT, floating values DOUBLE rounded by ``sround`` (8 significant
digits, at most 6 decimals), dates stay DATE.  The SQL side is generated from the
same column kinds, so both engines apply identical arithmetic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harvestframe.checks.sql import sround as sql_sround
from harvestframe.functions.numeric import sround


def kind_of(dt: T.DataType) -> str:
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "i"
    if isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "d"
    if isinstance(dt, T.DateType):
        return "t"
    if isinstance(dt, T.BooleanType):
        return "b"
    return "s"


def normalize(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        k = kind_of(f.dataType)
        c = F.col(f"`{f.name}`")
        if k == "i":
            c = c.cast("bigint")
        elif k == "d":
            c = sround(c.cast("double"))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def sql_normalized(inner: str, cols: Sequence[tuple[str, str]]) -> str:
    """``SELECT`` over ``inner`` (a FROM-able name or ``(subquery)``) with the same kinds."""
    out = []
    for name, k in cols:
        q = f'"{name}"'
        if k == "i":
            out.append(f"CAST({q} AS BIGINT) AS {q}")
        elif k == "d":
            out.append(f"{sql_sround(f'CAST({q} AS DOUBLE)')} AS {q}")
        elif k == "t":
            out.append(f"CAST({q} AS DATE) AS {q}")
        else:
            out.append(q)
    return f"SELECT {', '.join(out)} FROM {inner}"


def kinds(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, kind_of(f.dataType)) for f in df.schema.fields]
