"""Stable hashing (F31) — same values in Spark and DuckDB (md5 based)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plateau.functions.common import as_col


def md5_int(*parts) -> Column:
    """First 32 bits of md5(parts joined by '|') as a non-negative bigint."""
    text = F.concat_ws("|", *[as_col(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_bucket(c, n: int) -> Column:
    """Stable bucket in [0, n) of a value (replaces a per-process salted hash)."""
    return F.pmod(md5_int(c), F.lit(n))


def sql_md5_int(*parts: str) -> str:
    text = " || '|' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST(('0x' || substr(md5({text}), 1, 8))::UBIGINT AS BIGINT)"
