"""Quality of matches against a truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Thresholds of a sweep: 0.25, 0.27, ... 0.85.
SWEEP = [round(0.25 + 0.02 * k, 2) for k in range(31)]


def f05(tp: Column, predicted: Column, actual: Column) -> Column:
    """A6 from counts: 1 if both are empty, 0 if one is or nothing is right."""
    p, r = tp / predicted, tp / actual
    return F.when((predicted == 0) & (actual == 0), F.lit(1.0)).when((predicted == 0) | (actual == 0) | (tp == 0), F.lit(0.0)).otherwise(1.25 * p * r / (0.25 * p + r))


def f05_arrays(predicted: Column, actual: Column) -> Column:
    """A6 from arrays of ids, as sets."""
    p, a = F.array_distinct(predicted), F.array_distinct(actual)
    return f05(F.size(F.array_intersect(p, a)), F.size(p), F.size(a))


def entity_counts(predicted: DataFrame, truth: DataFrame, entities: DataFrame) -> DataFrame:
    """(s1_id, tp, predicted, actual) of each of the truth's entities; predictions of others are left out."""
    pred, act = predicted.select("s1_id", "target_id").distinct(), truth.select("s1_id", "target_id").distinct()
    both = pred.withColumn("p", F.lit(1)).join(act.withColumn("a", F.lit(1)), ["s1_id", "target_id"], "full")
    sums = both.groupBy("s1_id").agg(F.sum(F.coalesce(F.col("p") * F.col("a"), F.lit(0))).alias("tp"), F.count("p").alias("predicted"), F.count("a").alias("actual"))
    zero = {"tp": 0, "predicted": 0, "actual": 0}
    return entities.select("s1_id").distinct().join(sums, "s1_id", "left").na.fill(zero)


def macro_f05(predicted: DataFrame, truth: DataFrame, entities: DataFrame) -> DataFrame:
    """A5: the mean of A6 over the truth's entities; 0 without any."""
    return entity_counts(predicted, truth, entities).agg(F.coalesce(F.avg(f05(F.col("tp"), F.col("predicted"), F.col("actual"))), F.lit(0.0)).alias("macro_f05"))


def micro(predicted: DataFrame, truth: DataFrame) -> DataFrame:
    """Tp, fp, fn, precision, recall over all pairs; 0 where there is nothing to divide by."""
    both = predicted.select("s1_id", "target_id").distinct().withColumn("p", F.lit(1)).join(truth.select("s1_id", "target_id").distinct().withColumn("a", F.lit(1)), ["s1_id", "target_id"], "full")
    counts = both.agg(F.count(F.col("p") + F.col("a")).alias("tp"), F.count(F.when(F.col("a").isNull(), 1)).alias("fp"), F.count(F.when(F.col("p").isNull(), 1)).alias("fn"))
    share = lambda d: F.when(d == 0, F.lit(0.0)).otherwise(F.col("tp") / d)
    return counts.withColumn("precision", share(F.col("tp") + F.col("fp"))).withColumn("recall", share(F.col("tp") + F.col("fn")))


def blocking_recall(candidates: DataFrame, truth: DataFrame) -> DataFrame:
    """True pairs among the candidates, all true pairs, and their share."""
    act = truth.select("s1_id", "target_id").distinct()
    found = act.join(candidates.select("s1_id", "target_id").distinct().withColumn("f", F.lit(1)), ["s1_id", "target_id"], "left")
    return found.agg(F.count("f").alias("found"), F.count(F.lit(1)).alias("total")).withColumn("recall", F.when(F.col("total") == 0, 0.0).otherwise(F.col("found") / F.col("total")))


def label_pairs(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """Pairs with label 1 if the truth has them."""
    return pairs.join(truth.select("s1_id", "target_id").distinct().withColumn("_t", F.lit(1)), ["s1_id", "target_id"], "left").withColumn("label", F.when(F.col("_t").isNotNull(), 1).otherwise(0)).drop("_t")


def sweep(scored: DataFrame, truth: DataFrame, thresholds: list[float] | None = None) -> DataFrame:
    """M6: macro F0.5 at each threshold over the records that have pairs: (threshold, macro_f05).

    One pass over the pairs: a record's pairs count at every threshold that its probability reaches; a
    record without any at a threshold still counts there.
    """
    thresholds = thresholds or SWEEP
    spark = scored.sparkSession
    steps = spark.createDataFrame([(t,) for t in thresholds], "threshold double")
    labelled = label_pairs(scored.select("s1_id", "target_id", "probability"), truth)
    present = labelled.select("s1_id").distinct()
    actual = truth.select("s1_id", "target_id").distinct().groupBy("s1_id").agg(F.count(F.lit(1)).alias("actual"))
    reach = F.filter(F.array(*[F.lit(t) for t in thresholds]), lambda t: t <= F.col("probability"))
    hit = labelled.select("s1_id", "label", F.explode(reach).alias("threshold")).groupBy("s1_id", "threshold").agg(F.sum("label").alias("tp"), F.count(F.lit(1)).alias("predicted"))
    grid = present.crossJoin(F.broadcast(steps)).join(actual, "s1_id", "left").join(hit, ["s1_id", "threshold"], "left").na.fill({"tp": 0, "predicted": 0, "actual": 0})
    return grid.groupBy("threshold").agg(F.avg(f05(F.col("tp"), F.col("predicted"), F.col("actual"))).alias("macro_f05"))


def best_threshold(swept: DataFrame) -> float:
    """The first of the best thresholds."""
    row = swept.orderBy(F.round("macro_f05", 12).desc(), "threshold").first()
    return 0.4 if row is None else row["threshold"]
