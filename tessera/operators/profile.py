"""The profile of sources and of a truth."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import parsed_ids


def profile_source(df: DataFrame) -> DataFrame:
    """One row: records, distinct and repeated ids, and of each text column its blanks and lengths (least, most, mean, median, 5th and 95th percentile, exact)."""
    parts = [
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("entity_id").alias("n_ids"),
        (F.count(F.lit(1)) - F.count_distinct("entity_id")).alias("n_repeated"),
    ]
    for c in ("business_name", "business_address"):
        size = F.length(F.coalesce(F.col(c), F.lit("")))
        filled = F.when(size > 0, size)
        parts += [
            F.sum((size == 0).cast("int")).alias(f"{c}_blank"),
            F.min(filled).alias(f"{c}_min"),
            F.max(filled).alias(f"{c}_max"),
            F.round(F.avg(filled), 6).alias(f"{c}_mean"),
            F.percentile(filled, F.lit(0.5)).alias(f"{c}_median"),
            F.percentile(filled, F.lit(0.05)).alias(f"{c}_p05"),
            F.percentile(filled, F.lit(0.95)).alias(f"{c}_p95"),
        ]
    return df.agg(*parts)


def histogram(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Rows by value."""
    return df.groupBy(value.alias(name)).agg(F.count(F.lit(1)).alias("n"))


def country_histogram(df: DataFrame) -> DataFrame:
    return histogram(df, F.col("country"), "country")


def prefix_histogram(df: DataFrame) -> DataFrame:
    return histogram(df, F.split(F.col("entity_id"), "-")[0], "prefix")


def match_histogram(truth: DataFrame) -> DataFrame:
    """Records by their number of matches, of a truth with comma lists."""
    return histogram(truth, F.size(parsed_ids(F.col("matched_entity_ids"))), "matches")


def truth_coverage(pairs: DataFrame, s1: DataFrame, target: DataFrame) -> DataFrame:
    """One row: pairs, targets of several records, ids that no source has on either side, and the number of all possible pairs."""
    reuse = pairs.groupBy("target_id").agg(F.count_distinct("s1_id").alias("n")).agg(F.count(F.when(F.col("n") > 1, 1)).alias("reused_targets"))
    ids = lambda df, c: df.select(F.col("entity_id").alias(c)).distinct()
    parts = [
        pairs.agg(F.count(F.lit(1)).alias("pairs")),
        reuse,
        pairs.join(ids(s1, "s1_id"), "s1_id", "left_anti").agg(F.count_distinct("s1_id").alias("unknown_s1")),
        pairs.join(ids(target, "target_id"), "target_id", "left_anti").agg(F.count_distinct("target_id").alias("unknown_targets")),
        s1.agg(F.count(F.lit(1)).alias("n1")).crossJoin(target.agg(F.count(F.lit(1)).alias("n2"))).select((F.col("n1") * F.col("n2")).alias("possible_pairs")),
    ]
    return reduce(DataFrame.crossJoin, parts)
