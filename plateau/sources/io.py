"""Generic scans, sinks, validation and dataset profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plateau.config import EXCLUDED_COLUMNS, FEATURES


WRITERS = 8  # files that a task of ``write_observed`` keeps open


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", limit: int | None = None,
               schema: T.StructType | None = None) -> DataFrame:
    """Catalog / bridge / master table scan, optionally limited."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    df = r.load(path)
    return df.limit(limit) if limit is not None else df


def read_collections(spark: SparkSession, directory: str, fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """Collections and the collection -> item bridge, read together."""
    return (read_table(spark, f"{directory}/collections", fmt),
            read_table(spark, f"{directory}/collection_of_recipes", fmt))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV scan with an explicit schema and a header line."""
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def read_json_doc(spark: SparkSession, path: str, schema: T.StructType | None = None,
                  multi_line: bool = True) -> DataFrame:
    """JSON document (a list of objects, ``multi_line``) or JSON lines as rows."""
    r = spark.read.option("multiLine", multi_line)
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def write_json_doc(df: DataFrame, path: str) -> None:
    """JSON lines, one object per row (read back with ``multi_line=False``)."""
    df.write.mode("overwrite").json(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Table sink (S08); partitioning lets later reads prune."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.save(path)


def write_bucketed(df: DataFrame, name: str, path: str, keys: list[str], buckets: int, sort: list[str] | None = None) -> DataFrame:
    """Table sink for repeated joins (S08): Parquet files under ``path`` bucketed by ``keys`` and sorted inside, known to the
    session's catalog as ``name``. Tables of the same buckets join on the keys without moving either. Returns the table."""
    # One task per bucket: a bucket is one file, so that its order holds.
    dealt = df.repartition(buckets, *keys)
    (dealt.write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*(sort or keys)).saveAsTable(name))
    return df.sparkSession.table(name)


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replaces only the partitions that ``df`` has rows of (S08); the others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def write_observed(df: DataFrame, path: str, metrics: dict[str, Column], partition_by: list[str] | None = None) -> dict:
    """Writes a table and returns aggregates of its rows taken in the same pass (S09, L03): the plan runs once."""
    seen = Observation()
    out = df.observe(seen, *[c.alias(k) for k, c in metrics.items()])
    conf = df.sparkSession.conf
    before = conf.get("spark.sql.maxConcurrentOutputFileWriters")
    # A task keeps a file open for each of a few partitions: otherwise it sorts its rows by partition first, on disk.
    conf.set("spark.sql.maxConcurrentOutputFileWriters", str(max(int(before), WRITERS)))
    try:
        write_table(out, path, partition_by=partition_by)
    finally:
        conf.set("spark.sql.maxConcurrentOutputFileWriters", before)
    return seen.get


def training_metadata(df: DataFrame, feature_cols: list[str] | None = None, label: str = "label") -> DataFrame:
    """One row: total samples, users, items, number of features, positive ratio
    (share of ``label == 1``, as the reference), feature list (S09)."""
    feats = feature_cols or feature_columns(df)
    return df.agg(
        F.count(F.lit(1)).alias("total_samples"),
        F.countDistinct("user_id").alias("n_users"),
        F.countDistinct("recipe_id").alias("n_recipes"),
        F.avg((F.col(label) == 1.0).cast("double")).alias("positive_ratio"),
    ).withColumn("n_features", F.lit(len(feats)).cast("bigint")) \
     .withColumn("feature_columns", F.array(*[F.lit(c) for c in feats]))


_NUM = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType, T.BooleanType)


def feature_columns(df: DataFrame, exclude: list[str] | None = None,
                    skip=("label", "rating", "user_id", "recipe_id", "split")) -> list[str]:
    """Numeric columns minus the exclusion list (P09), in the declared feature order first."""
    ex = set(exclude if exclude is not None else EXCLUDED_COLUMNS) | set(skip)
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, _NUM) and f.name not in ex]
    ordered = [c for c in FEATURES if c in numeric]
    return ordered + [c for c in numeric if c not in ordered]


def validate(df: DataFrame, required: list[str]) -> DataFrame:
    """One row ``ok, n_rows, missing`` (S11): required columns present and table non-empty."""
    missing = [c for c in required if c not in df.columns]
    n = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return n.select((F.lit(not missing) & (F.col("n_rows") > 0)).alias("ok"), "n_rows",
                    F.lit(",".join(missing)).alias("missing"))


def profile(df: DataFrame, label: str | None = None) -> DataFrame:
    """Per column: type and NULL count, in one aggregate pass unpivoted (S12); with
    ``label`` a ``positive_ratio`` row-level share of label == 1 is added as a column."""
    nulls = df.agg(*[F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(c) for c in df.columns])
    stacked = nulls.unpivot([], df.columns, "column", "null_count")
    types = df.sparkSession.createDataFrame([(f.name, f.dataType.simpleString()) for f in df.schema.fields],
                                            "column string, dtype string")
    out = stacked.join(types, "column")
    if label:
        pr = df.agg(F.avg((F.col(label) == 1.0).cast("double")).alias("positive_ratio"),
                    F.count(F.lit(1)).alias("n_rows"))
        out = out.crossJoin(pr)
    return out


def source_summary(recipes: DataFrame, ingredients: DataFrame, bridge: DataFrame) -> DataFrame:
    """Rows, columns and first row per source table plus bridge coverage (S13), one aggregate per table."""
    rows = []
    for name, d, key in (("recipes", recipes, F.col("recipe_id")), ("ingredients", ingredients, F.col("id")),
                         ("recipe_ingredients", bridge, F.struct("recipe_id", "ingredient_id"))):
        text = F.concat_ws("\n", *[F.concat(F.lit(f"{c}: "), F.col(f"`{c}`").cast("string")) for c in d.columns])
        rows.append(d.agg(F.count(F.lit(1)).alias("rows"), F.min_by(text, key).alias("first_row")).select(
            F.lit(name).alias("table"), "rows", F.lit(len(d.columns)).cast("bigint").alias("n_columns"),
            F.lit(",".join(d.columns)).alias("columns"), "first_row"))
    out = rows[0].unionByName(rows[1]).unionByName(rows[2])
    cov = bridge.agg(F.countDistinct("recipe_id").alias("bridge_recipes"),
                     F.countDistinct("ingredient_id").alias("bridge_ingredients"))
    return out.crossJoin(cov)  # 3 rows x 1 row


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in whatever store Spark reads it from; other errors rise."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def load_catalog(spark: SparkSession, encoded_path: str | None, raw_path: str, required: list[str],
                 fmt: str = "parquet") -> DataFrame:
    """Encoded catalog when it exists, else the raw one (S10); fails when the chosen table
    lacks columns the model needs (checked on the schema, no job)."""
    found = encoded_path is not None and path_exists(spark, encoded_path)
    df = read_table(spark, encoded_path if found else raw_path, fmt)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"catalog lacks model columns: {missing}")
    return df
