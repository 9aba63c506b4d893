"""Samples and folds that depend on ids only, not on partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hashed(key: Column) -> Column:
    """The first 60 bits of the key's MD5 as a long, the same in every engine."""
    return F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 15), 16, 10).cast("long")


def sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows, those of the least hash of their key.

    All rows are the same frame back. Else rows are counted by their hashes' first 12 bits, so only the rows of the
    one value of these that the n-th row has are sorted, not n rows in one task.
    """
    order = hashed(F.concat(F.col(key).cast("string"), F.lit(f"/{seed}")))
    first = F.coalesce(F.shiftright(order, 48), F.lit(-1))
    counts = df.groupBy(first.alias("first")).agg(F.count(F.lit(1)).alias("n")).collect()
    if sum(r["n"] for r in counts) <= n:
        return df
    below = 0
    for r in sorted(counts, key=lambda r: r["first"]):
        if below + r["n"] > n:
            break
        below += r["n"]
    edge = df.where(first == r["first"]).orderBy(order, key).limit(n - below)
    return df.where(first < r["first"]).unionByName(edge)


def with_fold(df: DataFrame, key: str = "s1_id", folds: int = 5) -> DataFrame:
    """M3: a fold by hash of the key, so no key is in two."""
    return df.withColumn("fold", (hashed(F.coalesce(F.col(key).cast("string"), F.lit(""))) % folds).cast("int"))


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """R5."""
    return df.limit(n)


def semi(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """rows whose key is among the ids."""
    return df.join(ids.select(key).distinct(), key, "left_semi")


def anti(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """rows whose key isn't."""
    return df.join(ids.select(key).distinct(), key, "left_anti")
