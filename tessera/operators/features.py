"""The 28 features of a candidate pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import similarity as S

TEXT = ["exact", "jw", "lev", "token_set", "token_sort", "partial", "len_diff", "len_ratio", "jaccard", "shared_tokens", "containment"]
COLUMNS = [f"{p}_{t}" for p in ("name", "addr") for t in TEXT] + ["addr_num_match", "country_match", "country_missing", "s1_has_addr", "target_has_addr", "both_have_addr"]


def text_features(a: Column, b: Column, prefix: str) -> list[Column]:
    """X1 to X11 of two columns."""
    made = [S.exact(a, b), S.jaro_winkler_column(a, b), S.indel_column(a, b), S.token_set_column(a, b), S.token_sort_column(a, b), S.partial_column(a, b), S.length_difference(a, b), S.length_ratio(a, b), S.token_jaccard(a, b), S.shared_tokens(a, b), S.containment(a, b)]
    return [c.alias(f"{prefix}_{t}") for c, t in zip(made, TEXT)]


def with_records(pairs: DataFrame, s1: DataFrame, target: DataFrame) -> DataFrame:
    """Pairs with both records' columns; nulls where a record isn't there."""
    side = lambda df, key, p: df.select(F.col("entity_id").alias(key), F.col("business_name").alias(f"{p}_name"), F.col("business_address").alias(f"{p}_address"), F.col("country").alias(f"{p}_country"))
    return pairs.join(side(s1, "s1_id", "s1"), "s1_id", "left").join(side(target, "target_id", "target"), "target_id", "left")


def country_features() -> list[Column]:
    """X13 to X15."""
    a, b = F.col("s1_country"), F.col("target_country")
    mine, theirs = (F.length(F.coalesce(F.col(f"{p}_address"), F.lit(""))) > 2 for p in ("s1", "target"))
    return [
        (F.coalesce(a, F.lit("")) == F.coalesce(b, F.lit(""))).cast("int").alias("country_match"),
        (a.isNull() | b.isNull()).cast("int").alias("country_missing"),
        mine.cast("int").alias("s1_has_addr"),
        theirs.cast("int").alias("target_has_addr"),
        (mine & theirs).cast("int").alias("both_have_addr"),
    ]


def feature_matrix(pairs: DataFrame, s1: DataFrame, target: DataFrame) -> DataFrame:
    """The pairs' own columns and the 28 features.

    Pairs are few bytes and much work, so they are dealt to all cores by number, not by size.
    """
    session = pairs.sparkSession
    tasks = max(4 * session.sparkContext.defaultParallelism, int(session.conf.get("spark.sql.shuffle.partitions")))
    joined = with_records(pairs, s1, target).repartition(tasks, "s1_id", "target_id")
    return joined.select(
        *pairs.columns,
        *text_features(F.col("s1_name"), F.col("target_name"), "name"),
        *text_features(F.col("s1_address"), F.col("target_address"), "addr"),
        S.number_match(F.col("s1_address"), F.col("target_address")).alias("addr_num_match"),
        *country_features(),
    )
