"""Event cleaning job (T05): v1 + v2 raw lines -> combined events table.

Row-wise only (no shuffle): scan -> parse -> version rules -> union -> derived columns.
The same plan runs unchanged on a streaming DataFrame (see plateau.streaming).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plateau.sources.events import (add_derived_columns, normalize_events, parse_event_lines,
                                    read_events, select_combined)


def combine_events(v1_parsed: DataFrame, v2_parsed: DataFrame) -> DataFrame:
    both = normalize_events(v1_parsed, "v1").unionByName(normalize_events(v2_parsed, "v2"))
    return select_combined(add_derived_columns(both))


def combined_events_from_lines(v1_lines: DataFrame, v2_lines: DataFrame, text_col: str = "value") -> DataFrame:
    return combine_events(parse_event_lines(v1_lines, text_col), parse_event_lines(v2_lines, text_col))


def build_combined_events(spark: SparkSession, v1_path: str, v2_path: str,
                          out_path: str | None = None) -> DataFrame:
    df = combine_events(read_events(spark, v1_path), read_events(spark, v2_path))
    if out_path:
        df.write.mode("overwrite").parquet(out_path)
        return spark.read.parquet(out_path)
    return df
