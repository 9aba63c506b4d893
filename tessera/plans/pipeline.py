"""The four flows: candidates, training, matching, evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import normalize_columns
from tessera.operators.blocking import block_exact, block_multi_strategy, block_token_overlap, has_address
from tessera.operators.evaluation import blocking_recall, macro_f05, micro
from tessera.operators.features import feature_matrix
from tessera.operators.sampling import anti, sample, semi
from tessera.operators.tfidf import block_tfidf
from tessera.plans.model import MatchModel, TreeSettings, held, train
from tessera.plans.presets import PRODUCTION, Blocking

TEXT = ["business_name", "business_address"]


def normalized_records(df: DataFrame) -> DataFrame:
    return normalize_columns(df, TEXT)


def candidates(s1: DataFrame, target: DataFrame, preset: Blocking = PRODUCTION) -> DataFrame:
    """L1, K1: (s1_id, target_id, strategy) of normalized records, a pair once for each strategy that finds it."""
    name = block_tfidf(s1, target, "business_name", preset.name_k, preset.name_threshold, preset.max_df, scope=preset.scope)
    address = block_tfidf(has_address(s1), has_address(target), "business_address", preset.address_k, preset.address_threshold, preset.max_df, scope=preset.scope)
    parts = [name.withColumn("strategy", F.lit("tfidf_name")), address.withColumn("strategy", F.lit("tfidf_address")), block_exact(s1, target, "business_name", preset.exact_longer).withColumn("strategy", F.lit("exact_name"))]
    if preset.token_overlap:
        parts.append(block_token_overlap(s1, target, "business_name", 2).withColumn("strategy", F.lit("token_overlap")))
    out = parts[0].select("s1_id", "target_id", "strategy")
    for p in parts[1:]:
        out = out.unionByName(p.select("s1_id", "target_id", "strategy"))
    return out


def training_pairs(s1: DataFrame, target: DataFrame, truth: DataFrame, most_s1: int = 30_000, most_targets: int = 1_000_000, most_matched: int = 300_000) -> DataFrame:
    """M1, M2: blocked pairs of samples, and all true pairs of a sample of matched records, labelled."""
    blocked = block_multi_strategy(sample(s1, "entity_id", most_s1), sample(target, "entity_id", most_targets)).select("s1_id", "target_id")
    everyone = truth.select("s1_id").distinct()
    matched = sample(everyone, "s1_id", most_matched)
    sure = F.lit(1) if matched is everyone else F.coalesce("sure", F.lit(0))
    true = truth if matched is everyone else truth.join(matched.withColumn("sure", F.lit(1)), "s1_id", "left")
    # one grouping makes pairs distinct and labels them, instead of a join with the truth
    both = blocked.select("s1_id", "target_id", F.lit(1).alias("kept"), F.lit(0).alias("label")).unionByName(true.select("s1_id", "target_id", sure.alias("kept"), F.lit(1).alias("label")))
    return both.groupBy("s1_id", "target_id").agg(F.max("kept").alias("kept"), F.max("label").alias("label")).where("kept = 1").drop("kept")


def train_matcher(s1: DataFrame, target: DataFrame, truth: DataFrame, settings: TreeSettings | None = None) -> tuple[MatchModel, DataFrame]:
    """L3."""
    features = held(feature_matrix(training_pairs(s1, target, truth), s1, target))
    return train(features, truth, settings)


def predict(pairs: DataFrame, s1: DataFrame, target: DataFrame, model: MatchModel, threshold: float | None = None) -> DataFrame:
    """Pairs of known records whose probability reaches the threshold."""
    known = semi(semi(pairs.select("s1_id", "target_id").distinct(), s1.select(F.col("entity_id").alias("s1_id")), "s1_id"), target.select(F.col("entity_id").alias("target_id")), "target_id")
    # worked once: the condition on the probability would have them worked twice
    scored = model.probabilities(held(feature_matrix(known, s1, target)))
    return scored.where(F.col("probability") >= (model.threshold if threshold is None else threshold)).select("s1_id", "target_id", "probability")


def evaluate(s1: DataFrame, target: DataFrame, truth: DataFrame, model: MatchModel, n_s1: int = 5_000, n_negative: int = 500_000) -> DataFrame:
    """M9, L4: macro F0.5, micro precision and recall, and the recall of blocking, on a sample of records with their true targets and others."""
    some = sample(s1, "entity_id", n_s1)
    own = truth.join(some.select(F.col("entity_id").alias("s1_id")), "s1_id", "left_semi")
    true_ids = own.select(F.col("target_id").alias("entity_id")).distinct()
    pool = semi(target, true_ids, "entity_id").unionByName(sample(anti(target, true_ids, "entity_id"), "entity_id", n_negative))
    blocked = held(block_multi_strategy(some, pool).select("s1_id", "target_id"))
    found = held(predict(blocked, some, pool, model))
    entities = some.select(F.col("entity_id").alias("s1_id"))
    recall = blocking_recall(blocked, own).select(F.col("recall").alias("blocking_recall"))
    return macro_f05(found, own, entities).crossJoin(micro(found, own)).crossJoin(recall)
