"""Stable output form used by the registered queries.

The same form is produced by the DuckDB oracles: integers as BIGINT, floating values
rounded to 6 places as DOUBLE, timestamps and dates as ISO text, arrays as '|'-joined
text. This removes float summation-order noise and engine type differences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6
SCALE = float(10 ** DIGITS)
BIAS = 0.501


def canon(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.IntegerType, T.ShortType, T.ByteType, T.LongType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
            # floor(x * 10^d + 0.501) / 10^d: the same IEEE operations in Spark and DuckDB.
            # The boundary sits just off .5 so exact decimal ties (k / 2^n values whose
            # last bit depends on summation order) round the same way on both sides.
            c = F.floor(c.cast("double") * F.lit(SCALE) + F.lit(BIAS)).cast("double") / F.lit(SCALE) + F.lit(0.0)
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, T.ArrayType):
            c = F.array_join(F.transform(c, lambda x: x.cast("string")), "|")
        elif isinstance(t, (T.MapType, T.StructType)):
            c = F.to_json(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def canon_sql(core: str, types: dict[str, str], order: list[str] | None = None) -> str:
    """Wrap an oracle query with the canonical projection.

    ``types`` maps a column to 'd' (double), 'i' (bigint), 'ts' (timestamp), 'date', 'arr'
    (list of values) or 's'/'b' (as is). Columns not named pass through unchanged
    (``* REPLACE``).
    """
    forms = {
        "d": "CAST(floor(CAST({c} AS DOUBLE) * %.1f + %s) AS DOUBLE) / %.1f + 0.0" % (SCALE, BIAS, SCALE),
        "i": "CAST({c} AS BIGINT)",
        "ts": "strftime(CAST({c} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f')",
        "date": "strftime(CAST({c} AS DATE), '%Y-%m-%d')",
        "arr": "array_to_string(list_transform({c}, lambda x: CAST(x AS VARCHAR)), '|')",
        "s": "{c}", "b": "{c}",
    }
    repl = ", ".join(f"{forms[t].format(c=_q(c))} AS {_q(c)}" for c, t in types.items()
                     if t not in ("s", "b"))
    star = f"* REPLACE ({repl})" if repl else "*"
    return f"SELECT {star} FROM (\n{core}\n) AS q"


def _q(c: str) -> str:
    return '"' + c + '"'
