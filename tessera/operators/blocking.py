"""Candidate pairs by exact key, shared tokens, phonetic key, and the union of strategies."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import first_word, soundex, strip, tokens
from tessera.operators.tfidf import Entries, Vectors, block_tfidf, nearest_classes, nearest_targets

#: The most targets of a token, of a phonetic key, and of a record.
TOKEN_TARGETS, PHONETIC_TARGETS, TOKEN_TOP = 5_000, 1_000, 20


def not_blank(c: Column) -> Column:
    """F3."""
    return F.coalesce(strip(c) != "", F.lit(False))


def longer_than(c: Column, n: int) -> Column:
    """F4."""
    return F.length(F.coalesce(c, F.lit(""))) > n


def has_address(df: DataFrame, n: int = 3) -> DataFrame:
    return df.where(longer_than(F.col("business_address"), n))


def _keyed(df: DataFrame, key: Column, name: str) -> DataFrame:
    return df.select(F.col("entity_id").alias(name), key.alias("key"))


def _once(keyed: DataFrame, name: str) -> DataFrame:
    """Rows of an id and a key, each once, with `more`: all keys of an id that has several, else null."""
    keys = keyed.groupBy(name).agg(F.collect_set("key").alias("keys"))
    return keys.select(name, F.when(F.size("keys") > 1, F.col("keys")).alias("more"), F.explode("keys").alias("key"))


def block_exact(s1: DataFrame, target: DataFrame, column: str, longer: int = 0) -> DataFrame:
    """Pairs whose column is equal, not blank and longer than `longer` characters, each once.

    Rows are made distinct before the join, so pairs, which may be many times the records, are not shuffled.
    """
    use = lambda df, name: _once(_keyed(df.where(not_blank(F.col(column)) & longer_than(F.col(column), longer)), F.col(column), name), name)
    pairs = use(s1, "s1_id").withColumnRenamed("more", "x").join(use(target, "target_id").withColumnRenamed("more", "y"), "key")
    # ids of several keys each may meet more than once: the pair is taken at the least key that they share
    first = F.array_min(F.array_intersect("x", "y")) == F.col("key")
    return pairs.where(F.col("x").isNull() | F.col("y").isNull() | first).select("s1_id", "target_id")


def rare_keys(target: DataFrame, most: int) -> DataFrame:
    """(target_id, key) rows without the keys that more than `most` targets have."""
    counts = target.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= most).select("key")
    return target.join(counts, "key")


def _classes(df: DataFrame, column: str) -> DataFrame:
    """(words, n, ids): records by their set of distinct words over two characters, joined by spaces in order."""
    words = F.array_sort(F.array_distinct(F.filter(tokens(F.col(column)), lambda t: F.length(t) > 2)))
    return df.select(F.array_join(words, " ").alias("words"), "entity_id").where("words <> ''")


def _usable(left: DataFrame, right: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Of each class of both sides its words that at most `most` targets have, rarest first, and how many targets have them: (words, usable)."""
    mine, theirs = left.select("words").distinct(), right.groupBy("words").agg(F.count(F.lit(1)).alias("n"))
    each = lambda df, *more: df.select("words", *more, F.explode(F.split("words", " ")).alias("word"))
    df = each(theirs, "n").groupBy("word").agg(F.sum("n").alias("df")).where(F.col("df") <= most)
    sets = lambda classes: each(classes).join(df, "word").groupBy("words").agg(F.transform(F.array_sort(F.collect_list(F.struct("df", "word"))), lambda x: x["word"]).alias("usable"))
    return sets(mine), sets(theirs.drop("n"))


def shared_token_counts(s1: DataFrame, target: DataFrame, column: str, most: int = TOKEN_TARGETS) -> DataFrame:
    """A4: (s1_id, target_id, shared): distinct words over two characters that both have, those of more than `most` targets left out."""
    left, right = _classes(s1, column), _classes(target, column)
    x, y = (sets.select("words", F.explode("usable").alias("word")) for sets in _usable(left, right, most))
    pairs = x.toDF("a", "word").join(y.toDF("b", "word"), "word").groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared"))
    out = pairs.join(left.toDF("a", "s1_id"), "a").join(right.toDF("b", "target_id"), "b")
    return out.select("s1_id", "target_id", "shared").distinct()


def _shared_words(common: DataFrame) -> Vectors:
    """Words as vectors of ones whose products count shared words; the common ones, few since each has many targets, go to all tasks and don't count."""
    sent = common.sparkSession.sparkContext.broadcast(frozenset(common.toArrow()["word"].to_pylist()))

    def vectors(others: list[str], words: list[str]) -> tuple[Entries, Entries, Entries, int]:
        left_out, ids = sent.value, {}

        def entries(texts: list[str], number: Callable[[str], int | None]) -> Entries:
            cells = [(row, i) for row, text in enumerate(texts) for w in text.split(" ") if (i := number(w)) is not None]
            row, word = np.array(cells, np.int64).reshape(-1, 2).T
            return row, word, np.ones(len(row))

        theirs = entries(others, lambda w: None if w in left_out else ids.setdefault(w, len(ids)))
        each = np.arange(len(ids))
        return theirs, entries(words, ids.get), (each, each, np.ones(len(ids))), len(ids)

    return vectors


def block_token_overlap(s1: DataFrame, target: DataFrame, column: str, least: int = 3, k: int = TOKEN_TOP, most: int = TOKEN_TARGETS) -> DataFrame:
    """The k targets of each record that share most words, at least `least`.

    Records of equal word sets are one class, so a common name is compared once; classes are compared block by block in
    tasks, so no pair that k others of its block beat leaves one.
    """
    mine, theirs = _classes(s1, column).distinct(), _classes(target, column).distinct()
    left = mine.select("words").distinct().persist()
    right = theirs.groupBy("words").agg(F.count(F.lit(1)).alias("n"), F.min("entity_id").alias("first")).persist()
    common = right.select("n", F.explode(F.split("words", " ")).alias("word")).groupBy("word").agg(F.sum("n").alias("df")).where(F.col("df") > most)
    pairs = nearest_classes(left, right, _shared_words(common.select("word")), k, least, [])
    return nearest_targets(pairs, theirs, k, []).join(mine, "words").select(F.col("entity_id").alias("s1_id"), "target_id")


def block_phonetic(s1: DataFrame, target: DataFrame, column: str, most: int = PHONETIC_TARGETS) -> DataFrame:
    """Pairs whose first words sound alike; codes of more than `most` targets are left out."""
    code = soundex(first_word(F.col(column)))
    mine = _keyed(s1, code, "s1_id").where("key <> ''")
    return mine.join(rare_keys(_keyed(target, code, "target_id").where("key <> ''"), most), "key").select("s1_id", "target_id").distinct()


def once_a_class(s1: DataFrame, find: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What `find` finds for one record of each class of equal names and addresses, for all of the class.

    `find` gets records with a column `n`, how many they stand for; pairs of copies are made last, and not shuffled.
    """
    text = F.struct(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("business_name", "business_address")])
    keyed = s1.groupBy("entity_id").agg(F.sort_array(F.collect_list(text)).alias("key")).persist()
    one = keyed.groupBy("key").agg(F.min("entity_id").alias("s1_id"), F.count(F.lit(1)).alias("n")).persist()
    found = find(one.select(F.col("s1_id").alias("entity_id"), "n", F.inline("key")))
    members = keyed.join(one, "key").select("s1_id", "entity_id")
    return found.join(members, "s1_id").drop("s1_id").withColumnRenamed("entity_id", "s1_id").select(*found.columns)


def block_multi_strategy(s1: DataFrame, target: DataFrame, k: int = 10, threshold: float = 0.3, max_df: float = 0.1, min_rows: int = 0) -> DataFrame:
    """(s1_id, target_id, strategies): the union of n-grams of names, n-grams of addresses, shared words and equal names.

    The address strategy runs if more than min_rows targets have an address.
    """
    target = target.persist()
    placed = has_address(target)
    by_address = not min_rows or placed.count() > min_rows

    def find(few: DataFrame) -> DataFrame:
        parts = [block_tfidf(few, target, "business_name", k, threshold, max_df, weight="n").select("s1_id", "target_id", F.lit("tfidf_name").alias("strategy"))]
        if by_address:
            parts.append(block_tfidf(has_address(few), placed, "business_address", 5, 0.4, max_df, weight="n").select("s1_id", "target_id", F.lit("tfidf_address").alias("strategy")))
        parts.append(block_token_overlap(few, target, "business_name", 2).withColumn("strategy", F.lit("token_overlap")))
        parts.append(block_exact(few, target, "business_name").withColumn("strategy", F.lit("exact_name")))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.groupBy("s1_id", "target_id").agg(F.sort_array(F.collect_set("strategy")).alias("strategies"))

    return once_a_class(s1, find)
