"""TF-IDF over character n-grams as a postings table, and top-k of classes of equal words, block by block."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.functions.text import grams_of, tokens, word_grams

#: Classes of a block on either side; left blocks are cut down to LEAST where there are fewer tasks than cores.
LEFT, RIGHT, LEAST = 16_384, 32_768, 1_024
#: Bytes of products of common words that a task holds.
HELD = 64 << 20


def gram_counts(df: DataFrame, column: str) -> DataFrame:
    """(entity_id, gram, tf)."""
    return df.select("entity_id", F.explode(word_grams(F.coalesce(F.col(column), F.lit("")))).alias("gram")).groupBy("entity_id", "gram").agg(F.count(F.lit(1)).alias("tf"))


def vocabulary(counts: DataFrame, n_docs: int, min_df: int = 2, max_df: float = 0.1) -> DataFrame:
    """(gram, df, idf) of grams in at least min_df and at most max_df * n_docs records. Empty where no gram can be both."""
    return weighed(counts.groupBy("gram").agg(F.count(F.lit(1)).alias("df")), n_docs, min_df, max_df)


def weighed(df: DataFrame, n_docs: int, min_df: int, max_df: float) -> DataFrame:
    return df.where((F.col("df") >= min_df) & (F.col("df") <= max_df * n_docs)).withColumn("idf", F.log((1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0)


def postings(counts: DataFrame, vocab: DataFrame) -> DataFrame:
    """(entity_id, gram, weight), of length 1 over the vocabulary's grams."""
    weighted = counts.join(vocab, "gram").withColumn("raw", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(W.partitionBy("entity_id")))
    return weighted.select("entity_id", "gram", (F.col("raw") / norm).alias("weight"))


def top_k(pairs: DataFrame, k: int, score: str = "score", scope: list[str] | None = None) -> DataFrame:
    """The k best of each record by score, then by target id; Spark keeps k a group before it shuffles."""
    order = W.partitionBy("s1_id", *(scope or [])).orderBy(F.col(score).desc(), "target_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("rank")


def classes(df: DataFrame, column: str, scope: list[str], weight: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Records by their words, in order, with repeats: grams cross no word, so such a class has one vector.

    Returns (entity_id, words), and the classes (words, n, first) with their number of records and their least id,
    each of a scope's value. Rows of one id are one record, or as many as the column `weight` says.
    """
    words = F.array_join(F.array_sort(F.flatten(F.collect_list(tokens(F.lower(F.col(column)))))), " ")
    number = F.max(weight) if weight else F.max(F.lit(1))
    records = df.groupBy("entity_id", *scope).agg(words.alias("words"), number.alias("n")).where("words <> ''")
    return records.drop("n"), records.groupBy("words", *scope).agg(F.sum("n").alias("n"), F.min("entity_id").alias("first"))


def _spelled(words: list[str], known: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts as (row, word) by row, words numbered, and the known grams of all words, one after the other, with how many each has."""
    split = [w.split(" ") for w in words]
    ids: dict[str, int] = {}
    word = np.array([ids.setdefault(w, len(ids)) for ws in split for w in ws], np.int64)
    row = np.repeat(np.arange(len(words)), [len(ws) for ws in split])
    grams = [[known[g] for g in grams_of(w) if g in known] for w in ids]
    return row, word, np.array([g for gs in grams for g in gs], np.int64), np.array([len(g) for g in grams], np.int64)


def _raw(row: np.ndarray, word: np.ndarray, flat: np.ndarray, size: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, gram, tf * idf) of rows of words, by row, then gram."""
    n = size[word]
    at = np.repeat((np.cumsum(size) - size)[word] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    cell, tf = np.unique(np.repeat(row, n) * len(idf) + flat[at], return_counts=True)
    row, gram = np.divmod(cell, len(idf))
    return row, gram, tf * idf[gram]


def _matrix(words: list[str], known: dict[str, int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, gram, weight) of texts by row, then gram; rows have length 1 over the known grams."""
    row, gram, raw = _raw(*_spelled(words, known), idf)
    return row, gram, raw / np.sqrt(np.bincount(row, raw * raw, len(words)))[row]


def _by_word(words: list[str], known: dict[str, int], idf: np.ndarray) -> tuple[Entries, Entries]:
    """The same weights as texts of words, (row, word, factor), and words of grams, (word, gram, weight): grams cross no word, so they add up."""
    row, word, flat, size = _spelled(words, known)
    at, _, raw = _raw(row, word, flat, size, idf)
    norm = np.sqrt(np.bincount(at, raw * raw, len(words)))
    cell, times = np.unique(row * len(size) + word, return_counts=True)
    row, word = np.divmod(cell, len(size))
    use = size[word] > 0
    row, word = row[use], word[use]
    return (row, word, times[use] / norm[row]), _raw(np.arange(len(size)), np.arange(len(size)), flat, size, idf)


#: (row, gram, weight) by row of the texts of a block of targets; those of records as (row, word, factor) and (word, gram, weight); how many grams there are.
Entries = tuple[np.ndarray, np.ndarray, np.ndarray]
Vectors = Callable[[list[str], list[str]], tuple[Entries, Entries, Entries, int]]


def tfidf_vectors(vocab: DataFrame) -> Vectors:
    """T5, T6 in tasks. The vocabulary, grams of up to four characters, goes to all of them."""
    held = vocab.select("gram", "idf").orderBy("gram").toArrow()
    sent = vocab.sparkSession.sparkContext.broadcast((held["gram"].to_pylist(), held["idf"].to_numpy()))

    def vectors(others: list[str], words: list[str]) -> tuple[Entries, Entries, Entries, int]:
        known, idf = {g: i for i, g in enumerate(sent.value[0])}, sent.value[1]
        none = (np.array([], np.int64), np.array([], np.int64), np.array([]))
        return (_matrix(others, known, idf), *_by_word(words, known, idf), len(idf)) if known else (none, none, none, 0)

    return vectors


def _nearest(vectors: Vectors, k: int, threshold: float, scope: list[str]):
    """The k classes of a block of targets, of each scope, that are nearest to each class of a block of records."""

    def work(table: pa.Table) -> pa.Table:
        mine = table.filter(table["mine"])
        theirs = table.filter(pc.invert(table["mine"])).sort_by("first")
        words, others = mine["words"].to_pylist(), theirs["words"].to_pylist()
        out, pick, score = [], [], []
        if words and others:
            (row, gram, weight), (mark, own, factor), (part, part_gram, part_weight), grams = vectors(others, words)
            order = np.argsort(gram, kind="stable")
            posting, value = row[order], weight[order]
            begin = np.searchsorted(gram[order], np.arange(grams + 1))
            kinds = [np.array([str(x) for x in theirs[c].to_pylist()]) for c in scope]
            mark = np.searchsorted(mark, np.arange(len(words) + 1))
            count = int(max(own.max(initial=-1), part.max(initial=-1))) + 1
            cut = np.searchsorted(part, np.arange(count + 1))
            listed = lambda u: [(begin[g], begin[g + 1], w) for g, w in zip(part_gram[cut[u] : cut[u + 1]], part_weight[cut[u] : cut[u + 1]]) if begin[g] < begin[g + 1]]
            added = lambda lists: np.bincount(np.concatenate([posting[a:b] for a, b, _ in lists]), np.concatenate([value[a:b] * w for a, b, w in lists]), len(others))
            # products of the words that would cost most, postings times rows, are held for all targets of the block
            uses, length = np.bincount(own, minlength=count), np.bincount(part, np.diff(begin)[part_gram], count)
            worth = np.flatnonzero((uses > 1) & (length > len(others) / 16))
            worth = worth[np.argsort(-(uses * length)[worth], kind="stable")][: max(1, HELD // (8 * len(others)))]
            held = {int(u): added(listed(u)) for u in worth}
            for i in range(len(words)):
                total, lists = None, []
                for u, f in zip(own[mark[i] : mark[i + 1]].tolist(), factor[mark[i] : mark[i + 1]].tolist()):
                    if u in held:
                        total = held[u] * f if total is None else total + held[u] * f
                    else:
                        lists += [(a, b, w * f) for a, b, w in listed(u)]
                if lists:
                    total = added(lists) if total is None else total + added(lists)
                if total is None:
                    continue
                at = np.flatnonzero(total >= threshold - 1e-6)
                near = np.floor(total[at] * 1e6 + 0.5) / 1e6
                at, near = at[near >= threshold], near[near >= threshold]
                # rows stand in order of their least ids, so a stable sort leaves equal scores in that order
                at, near = (x[best] for best in [np.argsort(-near, kind="stable")] for x in (at, near))
                parts = [np.arange(len(at))] if not scope else [np.flatnonzero(kinds[0][at] == v) for v in np.unique(kinds[0][at])]
                for p in parts:
                    p = p[:k]
                    out += [i] * len(p)
                    pick.append(at[p])
                    score.append(near[p])
        chosen = np.concatenate(pick) if pick else np.array([], np.int64)
        found = theirs.take(pa.array(chosen))
        columns = {"a": mine["words"].take(pa.array(out, pa.int64())), "b": found["words"], **{c: found[c] for c in scope}, "first": found["first"], "score": pa.array(np.concatenate(score) if score else [], pa.float64())}
        return pa.table(columns)

    return work


def nearest_classes(left: DataFrame, right: DataFrame, vectors: Vectors, k: int, threshold: float, scope: list[str]) -> DataFrame:
    """(a, b, first, score): the k classes of targets nearest to each class of records, by score, then by least id.

    Every block of records meets every block of targets in a task of its own; what is dealt out are words, not
    postings, and no pair leaves a task that k others of its block beat.
    """
    spark = left.sparkSession
    n, m = left.count(), right.count()
    across = max(1, -(-m // RIGHT))
    down = max(1, -(-n // LEFT), min(-(-n // LEAST), -(-2 * spark.sparkContext.defaultParallelism // across)))
    numbers = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    block = lambda k: F.pmod(F.xxhash64("words"), F.lit(k)).cast("int")
    kind = {f.name: f.dataType for f in right.schema}
    mine = left.select(F.lit(True).alias("mine"), "words", *[F.lit(None).cast(kind[c]).alias(c) for c in scope], F.lit(None).cast(kind["first"]).alias("first"), block(down).alias("i"), numbers(across).alias("j"))
    theirs = right.select(F.lit(False).alias("mine"), "words", *scope, "first", numbers(down).alias("i"), block(across).alias("j"))
    dealt = mine.unionByName(theirs).withColumn("task", F.col("i") * across + F.col("j")).drop("i", "j")
    schema = ", ".join(["a string", "b string", *[f"`{c}` {kind[c].simpleString()}" for c in scope], f"first {kind['first'].simpleString()}", "score double"])
    met = dealt.repartition(2 * down * across, "task").groupBy("task").applyInArrow(_nearest(vectors, k, threshold, scope), schema)
    best = W.partitionBy("a", *scope).orderBy(F.col("score").desc(), "first")
    return met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).drop("rank")


def nearest_targets(pairs: DataFrame, theirs: DataFrame, k: int, scope: list[str]) -> DataFrame:
    """(words, target_id, score): the k targets of each class of records, from its k classes (`nearest_classes`) and the targets' (entity_id, words).

    Of the classes only the k best by score and least id, and of a class only its k least ids, can be among a record's k.
    """
    rank = F.row_number().over(W.partitionBy("words", *scope).orderBy("entity_id"))
    some = theirs.withColumn("rank", rank).where(F.col("rank") <= k).groupBy("words", *scope).agg(F.collect_list("entity_id").alias("ids"))
    near = pairs.join(some.withColumnRenamed("words", "b"), ["b", *scope]).select(F.col("a").alias("s1_id"), *scope, F.explode("ids").alias("target_id"), "score")
    return top_k(near, k, scope=scope).select(F.col("s1_id").alias("words"), "target_id", "score")


def block_tfidf(s1: DataFrame, target: DataFrame, column: str, k: int = 5, threshold: float = 0.5, max_df: float = 0.1, min_df: int = 2, scope: str = "global", weight: str | None = None) -> DataFrame:
    """The k targets of each record whose n-grams are nearest, at least `threshold`. Scores have 6 decimals before anything is compared.

    The vocabulary is of all records of s1, each as many as the column `weight` says. scope `source` keeps k of each
    target source (the targets then have a column `source`). Records of equal words are compared once.
    """
    each = ["source"] if scope == "source" else []
    n = s1.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0] if weight else s1.count()
    mine, left = classes(s1, column, [], weight)
    theirs, right = classes(target, column, each)
    left, right = left.persist(), right.persist()
    counts = left.select("n", F.explode(F.array_distinct(word_grams(F.col("words")))).alias("gram")).groupBy("gram").agg(F.sum("n").alias("df"))
    pairs = nearest_classes(left, right, tfidf_vectors(weighed(counts, n, min_df, max_df)), k, threshold, each)
    return nearest_targets(pairs, theirs, k, each).join(mine, "words").select(F.col("entity_id").alias("s1_id"), "target_id", "score")
