"""Helpers shared by the operators: session preparation, lineage cuts, words, hashing."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plateau.session import checkpoint_dir, ensure_utc

# The white space of every contract: space and the characters 0x09-0x0D. ``bytes.split()``
# and ``bytes.translate(None, SPACE)`` treat exactly these as white space.
SPACE = b" \t\n\x0b\x0c\r"

M64 = (1 << 64) - 1


def prepare(spark: SparkSession) -> None:
    """UTC, the shared checkpoint folder, and Arrow batches bounded in rows and bytes."""
    import plateau.llm
    from pyspark import cloudpickle
    cloudpickle.register_pickle_by_value(plateau.llm)  # executors need no copy of this package
    ensure_utc(spark)
    checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder: lineage ends here and lost executors cost
    nothing that was written."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_swept(df: DataFrame) -> DataFrame:
    """``cut``, and the files go of shuffles and checkpoints that nothing refers to any more. Spark deletes them when the
    driver collects its garbage; during an operator of many exchanges over small rows it may not happen to."""
    spark = df.sparkSession
    out = cut(df)
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return out


def text_bytes(col: str | Column) -> Column:
    """UTF-8 of a text column, null as empty."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit("")).cast("binary")


def column_of(batch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser over uint64 arrays."""
    x = np.asarray(x, dtype=np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniforms(key: int, stream: int, n: int) -> np.ndarray:
    """n numbers in (0, 1) that depend on (key, stream) alone: counter-based, so a retried
    task or another partitioning draws the same ones."""
    start = int(mix64(np.array([(key ^ (stream * 0x9E3779B97F4A7C15)) & M64], dtype=np.uint64))[0])
    with np.errstate(over="ignore"):
        c = np.uint64(start) + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mix64(c) >> np.uint64(11)).astype(np.float64) + 0.5) * (1.0 / (1 << 53))


def batches(rows: Iterator[tuple], schema, size: int = 2000):
    """Arrow record batches of at most ``size`` rows from tuples."""
    import pyarrow as pa
    buf: list[tuple] = []
    for r in rows:
        buf.append(r)
        if len(buf) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*buf), schema)], schema=schema)
            buf = []
    if buf:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*buf), schema)], schema=schema)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def columns(df: DataFrame) -> list[Column]:
    """All columns by name, whatever characters the names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def attach_once(docs: DataFrame, facts: DataFrame, keys: dict[str, Column], carry: str | None = None) -> tuple[DataFrame, str | None]:
    """The documents that have a fact, with all their columns and the fact column ``carry`` under a name that
    is free; returns the frame and that name.

    ``facts`` (checkpointed) has one row per key and a column ``m``, the rows of ``docs`` with that key; ``keys`` maps its
    key columns to expressions over ``docs``, compared null-safe. Of ``m`` rows that agree in the whole key one stays."""
    name: dict[str, str] = {}
    wide = docs
    for c in [*(f"l_{k}" for k in keys), *(f"r_{k}" for k in keys), "m", *([carry] if carry else [])]:
        name[c] = fresh(wide, f"_{c}")
        wide = wide.withColumn(name[c], F.lit(None))
    left = docs.withColumns({name[f"l_{k}"]: e for k, e in keys.items()})
    right = facts.select(*[facts[k].alias(name[f"r_{k}"]) for k in keys], facts["m"].alias(name["m"]),
                         *([facts[carry].alias(name[carry])] if carry else []))
    on = None
    for k in keys:
        c = F.col(name[f"l_{k}"]).eqNullSafe(F.col(name[f"r_{k}"]))
        on = c if on is None else on & c
    joined = left.join(right, on)
    out = [*columns(docs), *([F.col(name[carry])] if carry else [])]
    found = name.get(carry) if carry else None
    if facts.filter("m > 1").isEmpty():
        return joined.select(*out), found
    single = joined.filter(F.col(name["m"]) == 1).select(*out)
    several = joined.filter(F.col(name["m"]) > 1).dropDuplicates([name[f"l_{k}"] for k in keys]).select(*out)
    return single.unionAll(several), found


def seeded_sample(df: DataFrame, n: int, keys: list[str], seed: int = 0) -> DataFrame:
    """At most ``n`` rows: those with the smallest seeded hash of ``keys``. Rows are first thinned to about 2n by
    the hash itself, so no task sorts, and none receives, more than a bounded number."""
    total = df.count()
    space = 1 << 30
    h = F.xxhash64(F.lit(seed), *keys)
    if total > 4 * n:
        df = df.filter(F.pmod(h, F.lit(space)) < int(space * (2 * n / total)) + 1)
    return df.orderBy(F.xxhash64(F.lit(seed + 1), *keys), *keys).limit(n)
