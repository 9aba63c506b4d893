"""Tab-separated sources and sinks of records, pairs and matches."""

from __future__ import annotations

import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import parsed_ids, strip

RECORD = ["entity_id", "business_name", "business_address", "country"]
TRUTH = ["source1_entity_id", "matched_entity_ids"]


def _strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def header(spark: SparkSession, path: str) -> list[str]:
    """The names in the first line of a file or of a folder's first file."""
    first = spark.read.option("sep", "\t").option("quote", '"').option("escape", '"').option("header", True).option("inferSchema", False).csv(path)
    return first.columns


def read_strings(spark: SparkSession, path: str, needed: list[str], usecols: list[str] | None = None, nrows: int | None = None) -> DataFrame:
    """All columns as text, nothing taken for missing but the empty text; an error names columns that aren't there."""
    names = header(spark, path)
    missing = [c for c in (usecols or needed) if c not in names] or [c for c in needed if usecols is None and c not in names]
    if missing:
        raise ValueError(f"{path}: missing columns {missing}")
    df = spark.read.schema(_strings(names)).csv(path, sep="\t", header=True, quote='"', escape='"', enforceSchema=True)
    df = df.na.fill("")
    if usecols is not None:
        df = df.select(*usecols)
    return df if nrows is None else df.limit(nrows)


def load_source(spark: SparkSession, path: str, usecols: list[str] | None = None, nrows: int | None = None) -> DataFrame:
    """Records of a source."""
    return read_strings(spark, path, RECORD, usecols, nrows)


def load_ground_truth(spark: SparkSession, path: str) -> DataFrame:
    """(source1_entity_id, matched_entity_ids) as text."""
    return read_strings(spark, path, TRUTH)


def truth_pairs(truth: DataFrame) -> DataFrame:
    """The truth as distinct pairs (s1_id, target_id)."""
    return truth.select(F.col(TRUTH[0]).alias("s1_id"), F.explode(parsed_ids(F.col(TRUTH[1]))).alias("target_id")).distinct()


def load_sources(spark: SparkSession, folder: str, split: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three sources of `train` or `test` under a folder."""
    return tuple(load_source(spark, f"{folder}/{split}/{split}_source{k}.tsv") for k in (1, 2, 3))


def targets(s2: DataFrame, s3: DataFrame) -> DataFrame:
    """Both target sources with the number of the one a record comes from."""
    return s2.withColumn("source", F.lit(2)).unionByName(s3.withColumn("source", F.lit(3)))


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """A pair file in either format: raw (s1_id, target_id), or grouped, whose lists are taken apart. Other names: the first two columns are ids."""
    names = header(spark, path)
    df = read_strings(spark, path, names)
    if "s1_id" in names and "target_id" in names:
        return df.select("s1_id", "target_id")
    if "source1_entity_id" in names:
        lists = next(c for c in names if c != "source1_entity_id")
        return df.select(F.col("source1_entity_id").alias("s1_id"), F.explode(parsed_ids(F.col(lists))).alias("target_id"))
    return df.select(F.col(names[0]).alias("s1_id"), F.col(names[1]).alias("target_id"))


def grouped(pairs: DataFrame, s1: DataFrame, column: str = "candidate_entity_ids") -> DataFrame:
    """One row for every record of s1 with its distinct targets, sorted, as a comma list; empty without any. Null ids are no pairs."""
    lists = pairs.na.drop(subset=["s1_id", "target_id"]).groupBy("s1_id").agg(F.array_join(F.sort_array(F.collect_set("target_id")), ",").alias(column))
    return s1.select(F.col("entity_id").alias("source1_entity_id")).join(lists.withColumnRenamed("s1_id", "source1_entity_id"), "source1_entity_id", "left").select("source1_entity_id", F.coalesce(column, F.lit("")).alias(column))


def regrouped(pairs: DataFrame, s1: DataFrame, target: DataFrame, column: str = "candidate_entity_ids") -> DataFrame:
    """K4, U4: as `grouped`, of trimmed target ids that are in the targets only. A grouped file taken apart first gives the same again."""
    valid = target.select(F.col("entity_id").alias("target_id")).distinct()
    clean = pairs.withColumn("target_id", strip(F.col("target_id")))
    return grouped(clean.join(valid, "target_id", "left_semi"), s1, column)


def summary(pairs: DataFrame, s1: DataFrame) -> DataFrame:
    """K7, A10: distinct pairs, records with any, records, and pairs by record that has any."""
    distinct = pairs.na.drop(subset=["s1_id", "target_id"]).select("s1_id", "target_id").distinct()
    by = distinct.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n"))
    totals = by.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("unique_pairs"), F.count(F.lit(1)).alias("covered"))
    return totals.crossJoin(s1.agg(F.count(F.lit(1)).alias("entities"))).withColumn("average", F.col("unique_pairs") / F.greatest("covered", F.lit(1)))


def write_tsv(df: DataFrame, path: str) -> None:
    """K1 to K3: a folder of tab-separated files with header; duplicates are the caller's."""
    df.write.mode("overwrite").csv(path, sep="\t", header=True, quote='"', escape='"', emptyValue="")


def submission(folder: str, files: list[str], path: str) -> list[str]:
    """K6: files and folders under `folder` into a zip archive; returns those that aren't there."""
    missing = []
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for name in files:
            at = Path(folder, name)
            found = [at] if at.is_file() else sorted(p for p in at.rglob("*") if p.is_file()) if at.is_dir() else []
            if not found:
                missing.append(name)
            for p in found:
                out.write(p, p.relative_to(folder))
    return missing
