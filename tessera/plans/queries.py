"""Queries over the tables of a folder, by the id of the operator they apply, and their SQL.

Records come from whole tables: every row of `part` (name, brand and type as a business name, size and
type as an address) and of `pages` (its url as a name), dealt to three sources by their key.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import similarity as S
from tessera.functions import text as X
from tessera.functions.rules import ADDRESS, BUSINESS, token_map
from tessera.operators import blocking as B
from tessera.operators import evaluation as E
from tessera.operators import features as FE
from tessera.operators import profile as P
from tessera.operators import sampling as SA
from tessera.operators import tfidf as TF
from tessera.plans import model as M
from tessera.plans import pipeline as PL
from tessera.plans.presets import PRODUCTION
from tessera.sources import tsv

Query = Callable[[SparkSession, str], DataFrame]
SPARK: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f: Query) -> Query:
        SPARK[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return add


# ---- records ------------------------------------------------------------------------------


def raw_records(spark: SparkSession, sf: str) -> DataFrame:
    part = spark.read.parquet(f"{sf}/part.parquet")
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    src = lambda key: F.when(F.col(key) % 20 < 5, 1).when(F.col(key) % 20 < 12, 2).otherwise(3).alias("src")
    a = part.select(src("p_partkey"), F.concat(F.lit("-P"), F.col("p_partkey").cast("string")).alias("k"), F.concat("p_name", F.lit(", "), "p_brand", F.lit(" "), "p_type", F.lit(" Corp.")).alias("business_name"), F.concat(F.col("p_size").cast("string"), F.lit(" "), "p_type", F.lit(" St.")).alias("business_address"), F.concat(F.lit("C"), (F.col("p_size") % 3).cast("string")).alias("country"))
    b = pages.select(src("page_id"), F.concat(F.lit("-W"), F.col("page_id").cast("string")).alias("k"), F.col("url").alias("business_name"), F.lit("").alias("business_address"), F.lit("").alias("country"))
    return a.unionByName(b).select("src", F.concat(F.lit("S"), F.col("src").cast("string"), "k").alias("entity_id"), "business_name", "business_address", "country")


def sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Normalized records of source 1, and of sources 2 and 3."""
    n = PL.normalized_records(raw_records(spark, sf))
    return n.where("src = 1").drop("src"), n.where("src > 1").withColumnRenamed("src", "source")


def truth(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of equal raw name and country."""
    r = raw_records(spark, sf)
    a, b = r.where("src = 1"), r.where("src > 1")
    return a.select(F.col("entity_id").alias("s1_id"), "business_name", "country").join(b.select(F.col("entity_id").alias("target_id"), "business_name", "country"), ["business_name", "country"]).select("s1_id", "target_id")


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    s1, t = sides(spark, sf)
    return B.block_token_overlap(s1, t, "business_name", 3)


def joined(spark: SparkSession, sf: str) -> DataFrame:
    return FE.with_records(pairs(spark, sf), *sides(spark, sf))


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs with a made-up probability: the names' word Jaccard."""
    return joined(spark, sf).select("s1_id", "target_id", F.round(S.token_jaccard(F.col("s1_name"), F.col("target_name")), 6).alias("probability"))


def norm_sql(c: str, rules: dict[str, str]) -> str:
    plain = f"regexp_replace(strip_accents(regexp_replace(lower(trim({c})), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g')), '[^\\x00-\\x7F]', '', 'g')"
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in token_map(rules).items())
    return f"trim(regexp_replace(array_to_string(list_transform(string_split(trim(regexp_replace({plain}, '\\s+', ' ', 'g')), ' '), lambda w: CASE w {cases} ELSE w END), ' '), '\\s+', ' ', 'g'))"


_SRC = "CASE WHEN {k} % 20 < 5 THEN 1 WHEN {k} % 20 < 12 THEN 2 ELSE 3 END"
BASE = f"""WITH ent AS (
SELECT src, 'S' || src || k AS entity_id, business_name, business_address, country FROM (
  SELECT {_SRC.format(k="p_partkey")} AS src, '-P' || p_partkey AS k, p_name || ', ' || p_brand || ' ' || p_type || ' Corp.' AS business_name, p_size || ' ' || p_type || ' St.' AS business_address, 'C' || (p_size % 3) AS country FROM part
  UNION ALL SELECT {_SRC.format(k="page_id")}, '-W' || page_id, url, '', '' FROM pages)),
n AS MATERIALIZED (SELECT src, entity_id, {norm_sql("business_name", BUSINESS)} AS business_name, {norm_sql("business_address", ADDRESS)} AS business_address, country FROM ent),
s1 AS (SELECT * FROM n WHERE src = 1), t AS (SELECT * FROM n WHERE src > 1),
truth AS (SELECT a.entity_id AS s1_id, b.entity_id AS target_id FROM ent a JOIN ent b USING (business_name, country) WHERE a.src = 1 AND b.src > 1),
tok AS (SELECT DISTINCT src, entity_id, unnest(string_split(business_name, ' ')) AS w FROM n),
shared AS MATERIALIZED (SELECT a.entity_id AS s1_id, b.entity_id AS target_id, count(*) AS shared FROM tok a JOIN tok b USING (w) WHERE a.src = 1 AND b.src > 1 AND length(w) > 2 AND w IN (SELECT w FROM tok WHERE src > 1 GROUP BY w HAVING count(*) <= 5000) GROUP BY ALL),
pairs AS MATERIALIZED (SELECT s1_id, target_id FROM shared WHERE shared >= 3 QUALIFY row_number() OVER (PARTITION BY s1_id ORDER BY shared DESC, target_id) <= 20),
j AS MATERIALIZED (SELECT s1_id, target_id, a.business_name AS s1_name, a.business_address AS s1_address, a.country AS s1_country, b.business_name AS target_name, b.business_address AS target_address, b.country AS target_country FROM pairs LEFT JOIN s1 a ON a.entity_id = s1_id LEFT JOIN t b ON b.entity_id = target_id),
sets AS MATERIALIZED (SELECT *, list_filter(string_split(s1_name, ' '), lambda x: x <> '') AS x0, list_filter(string_split(target_name, ' '), lambda x: x <> '') AS y0, list_distinct(x0) AS x, list_distinct(y0) AS y FROM j),
scored AS MATERIALIZED (SELECT s1_id, target_id, round(CASE WHEN len(x) = 0 OR len(y) = 0 THEN 0.0 ELSE len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y))) END, 6) AS probability FROM sets)
"""


def lcs_sql(a: str, b: str) -> str:
    """The Indel ratio by rows of the usual table, each a list."""
    return (
        f"(CASE WHEN length({a}) + length({b}) = 0 THEN 1.0 ELSE 2.0 * list_last(list_reduce(string_split({a}, ''), lambda row, c: "
        f"list_reduce(range(1, length({b})::BIGINT + 1), lambda acc, i: list_append(acc, CASE WHEN substr({b}, i, 1) = c THEN row[i] + 1 ELSE greatest(row[i + 1], acc[i]) END), [0::BIGINT]), "
        f"list_transform(range(0, length({b})::BIGINT + 1), lambda z: 0::BIGINT))) / (length({a}) + length({b})) END)"
    )


def tfidf_sql(column: str, k: int, threshold: float, max_df: float, where: str = "TRUE", name: str = "f") -> str:
    """CTEs `{name}_g` (grams), `{name}_v` (vocabulary), `{name}_p` (postings), `{name}` (pairs)."""
    return f""",
{name}_w AS (SELECT src, entity_id, row_number() OVER () AS wid, ' ' || w || ' ' AS w FROM (SELECT src, entity_id, unnest(string_split({column}, ' ')) AS w FROM n WHERE {where}) WHERE w <> ''),
{name}_g AS MATERIALIZED (SELECT src, entity_id, gram, count(*) AS tf FROM (SELECT src, entity_id, unnest(list_transform(range(1, length(w) - q + 2), lambda i: substr(w, i, q))) AS gram FROM {name}_w, (SELECT unnest([2, 3, 4]) AS q) WHERE length(w) >= q) GROUP BY ALL),
{name}_v AS MATERIALIZED (SELECT gram, count(*) AS df, ln((1.0 + (SELECT count(*) FROM n WHERE src = 1 AND {where})) / (1.0 + count(*))) + 1.0 AS idf FROM {name}_g WHERE src = 1 GROUP BY gram HAVING count(*) >= 2 AND count(*) <= {max_df} * (SELECT count(*) FROM n WHERE src = 1 AND {where})),
{name}_p AS MATERIALIZED (SELECT src, entity_id, gram, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY entity_id)) AS weight FROM {name}_g JOIN {name}_v USING (gram)),
{name} AS MATERIALIZED (SELECT a.entity_id AS s1_id, b.entity_id AS target_id, round(sum(a.weight * b.weight), 6) AS score FROM {name}_p a JOIN {name}_p b USING (gram) WHERE a.src = 1 AND b.src > 1 GROUP BY a.entity_id, b.entity_id HAVING round(sum(a.weight * b.weight), 6) >= {threshold} QUALIFY row_number() OVER (PARTITION BY a.entity_id ORDER BY round(sum(a.weight * b.weight), 6) DESC, b.entity_id) <= {k})"""


F05 = "CASE WHEN predicted = 0 AND actual = 0 THEN 1.0 WHEN predicted = 0 OR actual = 0 OR tp = 0 THEN 0.0 ELSE 1.25 * (tp / predicted) * (tp / actual) / (0.25 * (tp / predicted) + (tp / actual)) END"
COUNTS = """, both_ AS (SELECT s1_id, count(*) FILTER (p IS NOT NULL AND a IS NOT NULL) AS tp, count(p) AS predicted, count(a) AS actual FROM (SELECT s1_id, target_id, 1 AS p FROM pairs) FULL JOIN (SELECT DISTINCT s1_id, target_id, 1 AS a FROM truth) USING (s1_id, target_id) GROUP BY s1_id),
counts AS (SELECT entity_id AS s1_id, coalesce(tp, 0) AS tp, coalesce(predicted, 0) AS predicted, coalesce(actual, 0) AS actual FROM s1 LEFT JOIN both_ ON s1_id = entity_id)"""


# ---- sources and sinks --------------------------------------------------------------------


def scratch(spark: SparkSession) -> str:
    """A folder that driver and executors share; one of our own only if all run in this process."""
    import atexit
    import re
    import shutil
    import tempfile

    held = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not held:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        held = tempfile.mkdtemp(prefix="tessera-")
        atexit.register(shutil.rmtree, held, ignore_errors=True)
    return f"{held.rstrip('/')}/scratch-{uuid.uuid4().hex}"


def _plain(spark: SparkSession, sf: str) -> DataFrame:
    return raw_records(spark, sf).select(*tsv.RECORD)


@query("I1", BASE + "SELECT entity_id, business_name, business_address, country FROM ent")
def _(spark, sf):
    at = scratch(spark)
    tsv.write_tsv(_plain(spark, sf), at)
    return tsv.load_source(spark, at)


@query("I2", BASE + "SELECT count(*) AS n, 'business_address' AS missing FROM ent")
def _(spark, sf):
    at = scratch(spark)
    tsv.write_tsv(_plain(spark, sf).drop("business_address"), at)
    try:
        tsv.load_source(spark, at)
        missing = ""
    except ValueError as e:
        missing = "business_address" if "business_address" in str(e) else ""
    return _plain(spark, sf).agg(F.count(F.lit(1)).alias("n")).withColumn("missing", F.lit(missing))


def _truth_lists(spark: SparkSession, sf: str) -> DataFrame:
    s1 = raw_records(spark, sf).where("src = 1")
    return tsv.grouped(truth(spark, sf), s1, "matched_entity_ids")


_LISTS = "SELECT e.entity_id AS source1_entity_id, coalesce(string_agg(target_id, ',' ORDER BY target_id), '') AS {c} FROM {s} e LEFT JOIN (SELECT DISTINCT s1_id, target_id FROM {p}) ON s1_id = e.entity_id GROUP BY e.entity_id"


@query("I3", BASE + _LISTS.format(c="matched_entity_ids", s="s1", p="truth"))
def _(spark, sf):
    at = scratch(spark)
    tsv.write_tsv(_truth_lists(spark, sf), at)
    return tsv.load_ground_truth(spark, at)


@query("I4", BASE + "SELECT entity_id, array_to_string(list_filter(list_transform(string_split(' ' || replace(business_name, ' ', ' , ') || ',, ', ','), lambda x: trim(x)), lambda x: x <> ''), '|') AS ids FROM ent")
def _(spark, sf):
    c = F.concat(F.lit(" "), F.replace(F.col("business_name"), F.lit(" "), F.lit(" , ")), F.lit(",, "))
    return raw_records(spark, sf).select("entity_id", F.array_join(X.parsed_ids(c), "|").alias("ids"))


@query("I5", BASE + "SELECT src, count(*) AS n FROM ent GROUP BY src")
def _(spark, sf):
    at = scratch(spark)
    for k in (1, 2, 3):
        tsv.write_tsv(raw_records(spark, sf).where(F.col("src") == k).select(*tsv.RECORD), f"{at}/train/train_source{k}.tsv")
    out = None
    for k, df in enumerate(tsv.load_sources(spark, at, "train"), 1):
        one = df.agg(F.count(F.lit(1)).alias("n")).withColumn("src", F.lit(k))
        out = one if out is None else out.unionByName(one)
    return out


SPARK["I6"], SQL["I6"] = SPARK["I1"], SQL["I1"]
SPARK["I9"], SQL["I9"] = SPARK["I5"], SQL["I5"]


@query("I7", BASE + "SELECT s1_id, target_id FROM pairs")
def _(spark, sf):
    at = scratch(spark)
    tsv.write_tsv(pairs(spark, sf), at)
    return tsv.read_pairs(spark, at)


@query("I8", BASE + "SELECT s1_id, target_id FROM pairs")
def _(spark, sf):
    at = scratch(spark)
    tsv.write_tsv(tsv.grouped(pairs(spark, sf), sides(spark, sf)[0]), at)
    return tsv.read_pairs(spark, at)


@query("K1", BASE + "SELECT s1_id, target_id FROM pairs UNION ALL SELECT a.entity_id, b.entity_id FROM s1 a JOIN t b USING (business_name) WHERE business_name <> ''")
def _(spark, sf):
    at = scratch(spark)
    tsv.write_tsv(pairs(spark, sf).unionByName(B.block_exact(*sides(spark, sf), "business_name")), at)
    return tsv.read_pairs(spark, at)


@query("K2", BASE + _LISTS.format(c="candidate_entity_ids", s="s1", p="pairs"))
def _(spark, sf):
    return tsv.grouped(pairs(spark, sf), sides(spark, sf)[0])


@query("K3", BASE + _LISTS.format(c="matched_entity_ids", s="s1", p="(SELECT * FROM scored WHERE probability >= 0.5)"))
def _(spark, sf):
    return tsv.grouped(scored(spark, sf).where("probability >= 0.5"), sides(spark, sf)[0], "matched_entity_ids")


@query("K4", BASE + _LISTS.format(c="candidate_entity_ids", s="s1", p="(SELECT * FROM pairs WHERE target_id LIKE 'S2%')"))
def _(spark, sf):
    s1, t = sides(spark, sf)
    dirty = pairs(spark, sf).select("s1_id", F.concat(F.lit(" "), "target_id", F.lit(" ")).alias("target_id"))
    return tsv.regrouped(dirty, s1, t.where("source = 2"))


@query("K7", BASE + "SELECT (SELECT count(*) FROM pairs) AS unique_pairs, (SELECT count(DISTINCT s1_id) FROM pairs) AS covered, (SELECT count(*) FROM s1) AS entities, (SELECT count(*) / greatest(count(DISTINCT s1_id), 1) FROM pairs) AS average")
def _(spark, sf):
    return tsv.summary(pairs(spark, sf), sides(spark, sf)[0])


# ---- projections and filters --------------------------------------------------------------


@query("F1", BASE + "SELECT entity_id, country FROM ent")
def _(spark, sf):
    return raw_records(spark, sf).select("entity_id", "country")


@query("F2", BASE + "SELECT s1_id, target_id, s1_name, target_name FROM j")
def _(spark, sf):
    return joined(spark, sf).select("s1_id", "target_id", "s1_name", "target_name")


@query("F3", BASE + "SELECT entity_id FROM ent WHERE trim(business_address) <> ''")
def _(spark, sf):
    return raw_records(spark, sf).where(B.not_blank(F.col("business_address"))).select("entity_id")


@query("F4", BASE + "SELECT entity_id FROM n WHERE length(business_address) > 3")
def _(spark, sf):
    return B.has_address(PL.normalized_records(raw_records(spark, sf))).select("entity_id")


@query("F5", BASE + "SELECT s1_id, target_id FROM pairs WHERE s1_id IN (SELECT s1_id FROM truth)")
def _(spark, sf):
    return SA.semi(pairs(spark, sf), truth(spark, sf), "s1_id").select("s1_id", "target_id")


@query("F6", BASE + "SELECT entity_id FROM t WHERE entity_id NOT IN (SELECT target_id FROM truth)")
def _(spark, sf):
    return SA.anti(sides(spark, sf)[1], truth(spark, sf).select(F.col("target_id").alias("entity_id")), "entity_id").select("entity_id")


@query("F7", BASE + "SELECT DISTINCT s1_id AS source1_entity_id FROM truth")
def _(spark, sf):
    return _truth_lists(spark, sf).where(F.size(X.parsed_ids(F.col("matched_entity_ids"))) > 0).select("source1_entity_id")


@query("F8", BASE + "SELECT s1_id, target_id, probability FROM scored WHERE probability >= 0.5")
def _(spark, sf):
    return scored(spark, sf).where("probability >= 0.5")


@query("F9", BASE + "SELECT s1_id, target_id, probability FROM scored WHERE probability >= 0.75")
def _(spark, sf):
    return scored(spark, sf).where("probability >= 0.75")


@query("F10", BASE + "SELECT w AS key, count(*) AS n FROM tok WHERE src > 1 AND w <> '' GROUP BY w HAVING count(*) <= 100")
def _(spark, sf):
    words = sides(spark, sf)[1].select(F.col("entity_id").alias("target_id"), F.explode(F.array_distinct(X.tokens(F.col("business_name")))).alias("key"))
    return B.rare_keys(words, 100).groupBy("key").agg(F.count(F.lit(1)).alias("n"))


@query("F11", BASE + "SELECT count(*) > 1000 AS runs FROM t WHERE length(business_address) > 3")
def _(spark, sf):
    return B.has_address(sides(spark, sf)[1]).agg((F.count(F.lit(1)) > 1000).alias("runs"))


@query("F12", BASE + "SELECT s1_id, target_id FROM pairs WHERE target_id LIKE 'S2%'")
def _(spark, sf):
    return pairs(spark, sf).withColumn("target_id", F.when(F.col("target_id").startswith("S2"), F.col("target_id"))).na.drop()


# ---- joins --------------------------------------------------------------------------------


@query("J1", BASE + "SELECT DISTINCT a.entity_id AS s1_id, b.entity_id AS target_id FROM s1 a JOIN t b USING (business_name) WHERE business_name <> ''")
def _(spark, sf):
    return B.block_exact(*sides(spark, sf), "business_name")


@query("J2", BASE + "SELECT DISTINCT a.entity_id AS s1_id, b.entity_id AS target_id FROM s1 a JOIN t b USING (business_name) WHERE length(business_name) > 2")
def _(spark, sf):
    return B.block_exact(*sides(spark, sf), "business_name", 2)


@query("J3", BASE + "SELECT s1_id, target_id FROM pairs")
def _(spark, sf):
    return pairs(spark, sf)


_SDX = "substr(replace(substr({runs}, 2), '0', ''), 1, 3)"


def soundex_sql(c: str) -> str:
    u = f"regexp_replace(upper({c}), '[^A-Z]', '', 'g')"
    runs = f"translate({u}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '01230120022455012623010202')"
    for d in range(7):
        runs = f"regexp_replace({runs}, '{d}+', '{d}', 'g')"
    return f"(CASE WHEN {u} = '' THEN '' ELSE rpad(substr({u}, 1, 1) || {_SDX.format(runs=runs)}, 4, '0') END)"


_CODES = f", codes AS (SELECT src, entity_id, {soundex_sql('split_part(business_name, chr(32), 1)')} AS code FROM n)"


@query("J4", BASE + _CODES + " SELECT a.entity_id AS s1_id, b.entity_id AS target_id FROM codes a JOIN codes b USING (code) WHERE a.src = 1 AND b.src > 1 AND code <> '' AND code IN (SELECT code FROM codes WHERE src > 1 GROUP BY code HAVING count(*) <= 1000)")
def _(spark, sf):
    return B.block_phonetic(*sides(spark, sf), "business_name")


@query("J5", BASE + tfidf_sql("business_name", 5, 0.5, 0.1) + " SELECT * FROM f")
def _(spark, sf):
    return TF.block_tfidf(*sides(spark, sf), "business_name")


@query("J6", BASE + tfidf_sql("business_name", 10, 0.3, 0.01) + " SELECT * FROM f")
def _(spark, sf):
    return TF.block_tfidf(*sides(spark, sf), "business_name", PRODUCTION.name_k, PRODUCTION.name_threshold, PRODUCTION.max_df)


@query("J7", BASE + "SELECT s1_id, target_id, s1_name, s1_address, s1_country FROM j")
def _(spark, sf):
    return joined(spark, sf).select("s1_id", "target_id", "s1_name", "s1_address", "s1_country")


@query("J8", BASE + "SELECT s1_id, target_id, target_name, target_address, target_country FROM j")
def _(spark, sf):
    return joined(spark, sf).select("s1_id", "target_id", "target_name", "target_address", "target_country")


_LABEL = "SELECT s1_id, target_id, CASE WHEN (s1_id, target_id) IN (SELECT (s1_id, target_id) FROM truth) THEN 1 ELSE 0 END AS label FROM pairs"


@query("J9", BASE + _LABEL)
def _(spark, sf):
    return E.label_pairs(pairs(spark, sf), truth(spark, sf))


SPARK["M2"], SQL["M2"] = SPARK["J9"], SQL["J9"]


@query("J10", BASE + _LISTS.format(c="matched_entity_ids", s="s1", p="truth"))
def _(spark, sf):
    return _truth_lists(spark, sf)


@query("J11", BASE + "SELECT count(*) AS found FROM (SELECT DISTINCT s1_id, target_id FROM truth) JOIN pairs USING (s1_id, target_id)")
def _(spark, sf):
    return E.blocking_recall(pairs(spark, sf), truth(spark, sf)).select("found")


# ---- aggregations -------------------------------------------------------------------------


@query("A1", BASE + "SELECT s1_id, string_agg(target_id, ',' ORDER BY target_id) AS ids FROM pairs GROUP BY s1_id")
def _(spark, sf):
    return pairs(spark, sf).groupBy("s1_id").agg(F.array_join(F.sort_array(F.collect_set("target_id")), ",").alias("ids"))


SPARK["A2"], SQL["A2"] = SPARK["A1"], SQL["A1"]


@query("A3", BASE + tfidf_sql("business_name", 5, 0.5, 0.1) + " SELECT gram, df FROM f_v")
def _(spark, sf):
    s1, _t = sides(spark, sf)
    return TF.vocabulary(TF.gram_counts(s1, "business_name"), s1.count()).select("gram", "df")


@query("A4", BASE + "SELECT s1_id, target_id, shared FROM shared")
def _(spark, sf):
    return B.shared_token_counts(*sides(spark, sf), "business_name")


@query("A5", BASE + COUNTS + f" SELECT round(coalesce(avg({F05}), 0.0), 9) AS macro_f05 FROM counts")
def _(spark, sf):
    s1, _t = sides(spark, sf)
    return E.macro_f05(pairs(spark, sf), truth(spark, sf), s1.select(F.col("entity_id").alias("s1_id"))).select(F.round("macro_f05", 9).alias("macro_f05"))


@query("A6", BASE + COUNTS + f" SELECT s1_id, round({F05}, 9) AS f05 FROM counts")
def _(spark, sf):
    s1, _t = sides(spark, sf)
    counts = E.entity_counts(pairs(spark, sf), truth(spark, sf), s1.select(F.col("entity_id").alias("s1_id")))
    return counts.select("s1_id", F.round(E.f05(F.col("tp"), F.col("predicted"), F.col("actual")), 9).alias("f05"))


@query("A7", BASE + COUNTS + ", c AS (SELECT sum(tp)::BIGINT AS tp, (sum(predicted) - sum(tp))::BIGINT AS fp, (sum(actual) - sum(tp))::BIGINT AS fn FROM counts) SELECT tp, fp, fn, round(CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END, 9) AS precision, round(CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END, 9) AS recall FROM c")
def _(spark, sf):
    return E.micro(pairs(spark, sf), truth(spark, sf)).withColumns({c: F.round(c, 9) for c in ("precision", "recall")})


@query("A8", BASE + ", c AS (SELECT (SELECT count(*) FROM (SELECT DISTINCT s1_id, target_id FROM truth) JOIN pairs USING (s1_id, target_id)) AS found, (SELECT count(*) FROM (SELECT DISTINCT s1_id, target_id FROM truth)) AS total) SELECT found, total, round(CASE WHEN total = 0 THEN 0.0 ELSE found / total END, 9) AS recall FROM c")
def _(spark, sf):
    return E.blocking_recall(pairs(spark, sf), truth(spark, sf)).withColumn("recall", F.round("recall", 9))


@query("A9", BASE + f", l AS ({_LABEL}) SELECT label, count(*) AS n FROM l GROUP BY label")
def _(spark, sf):
    return P.histogram(E.label_pairs(pairs(spark, sf), truth(spark, sf)), F.col("label"), "label")


SPARK["A10"], SQL["A10"] = SPARK["K7"], SQL["K7"]


def _profile_sql() -> str:
    parts = ["count(*) AS n_rows", "count(DISTINCT entity_id) AS n_ids", "count(*) - count(DISTINCT entity_id) AS n_repeated"]
    for c in ("business_name", "business_address"):
        v = f"nullif(length({c}), 0)"
        parts += [f"sum((length({c}) = 0)::INT)::BIGINT AS {c}_blank", f"min({v})::INT AS {c}_min", f"max({v})::INT AS {c}_max", f"round(avg({v}), 6) AS {c}_mean"]
        parts += [f"quantile_cont({v}, {q})::DOUBLE AS {c}_{k}" for k, q in (("median", 0.5), ("p05", 0.05), ("p95", 0.95))]
    return "SELECT " + ", ".join(parts) + " FROM ent"


@query("A11", BASE + _profile_sql())
def _(spark, sf):
    return P.profile_source(raw_records(spark, sf))


@query("A11_countries", BASE + "SELECT country, count(*) AS n FROM ent GROUP BY country")
def _(spark, sf):
    return P.country_histogram(raw_records(spark, sf))


@query("A11_prefixes", BASE + "SELECT split_part(entity_id, '-', 1) AS prefix, count(*) AS n FROM ent GROUP BY 1")
def _(spark, sf):
    return P.prefix_histogram(raw_records(spark, sf))


@query("A11_matches", BASE + ", m AS (SELECT entity_id, count(target_id) AS n FROM s1 LEFT JOIN (SELECT DISTINCT s1_id, target_id FROM truth) ON s1_id = entity_id GROUP BY entity_id) SELECT n::INT AS matches, count(*) AS n FROM m GROUP BY 1")
def _(spark, sf):
    return P.match_histogram(_truth_lists(spark, sf))


@query("A11_coverage", BASE + "SELECT (SELECT count(*) FROM truth) AS pairs, (SELECT count(*) FROM (SELECT target_id FROM truth GROUP BY 1 HAVING count(DISTINCT s1_id) > 1)) AS reused_targets, 0::BIGINT AS unknown_s1, 0::BIGINT AS unknown_targets, (SELECT count(*) FROM s1) * (SELECT count(*) FROM t) AS possible_pairs")
def _(spark, sf):
    return P.truth_coverage(truth(spark, sf), *sides(spark, sf))


# ---- order, samples, sets -----------------------------------------------------------------


@query("R1", BASE + "SELECT s1_id, target_id, probability FROM scored QUALIFY row_number() OVER (PARTITION BY s1_id ORDER BY probability DESC, target_id) <= 3")
def _(spark, sf):
    return TF.top_k(scored(spark, sf), 3, "probability")


SPARK["R2"], SQL["R2"] = SPARK["J3"], SQL["J3"]
SPARK["R3"], SQL["R3"] = SPARK["K2"], SQL["K2"]


@query("R5")
def _(spark, sf):
    at = scratch(spark)
    tsv.write_tsv(_plain(spark, sf), at)
    return tsv.load_source(spark, at, nrows=100)


def md5_sql(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


@query("R6", BASE + f"SELECT * FROM ent ORDER BY {md5_sql("entity_id || '/42'")}, entity_id LIMIT 500")
def _(spark, sf):
    return SA.sample(raw_records(spark, sf), "entity_id", 500)


@query("U1", BASE + "SELECT s1_id, target_id FROM pairs UNION SELECT s1_id, target_id FROM truth")
def _(spark, sf):
    return pairs(spark, sf).union(truth(spark, sf)).distinct()


@query("U2", BASE + "SELECT entity_id, src AS source FROM ent WHERE src > 1")
def _(spark, sf):
    r = raw_records(spark, sf)
    return tsv.targets(r.where("src = 2").drop("src"), r.where("src = 3").drop("src")).select("entity_id", "source")


@query("U3", BASE + "SELECT s1_id, target_id FROM pairs INTERSECT SELECT s1_id, target_id FROM truth")
def _(spark, sf):
    return pairs(spark, sf).intersect(truth(spark, sf))


@query("U3_except", BASE + "SELECT s1_id, target_id FROM truth EXCEPT SELECT s1_id, target_id FROM pairs")
def _(spark, sf):
    return truth(spark, sf).exceptAll(pairs(spark, sf)).distinct()


@query("U4", BASE + "SELECT DISTINCT entity_id FROM t")
def _(spark, sf):
    return sides(spark, sf)[1].select("entity_id").distinct()


@query("U5", BASE + "SELECT DISTINCT s1_id FROM pairs")
def _(spark, sf):
    return pairs(spark, sf).select("s1_id").dropDuplicates()


_MULTI = tfidf_sql("business_name", 10, 0.3, 0.1) + tfidf_sql("business_address", 5, 0.4, 0.1, "length(business_address) > 3", "g") + ", two AS (SELECT s1_id, target_id FROM shared WHERE shared >= 2 QUALIFY row_number() OVER (PARTITION BY s1_id ORDER BY shared DESC, target_id) <= 20)"


@query("U6", BASE + _MULTI + " SELECT s1_id, target_id, string_agg(DISTINCT s, ',' ORDER BY s) AS strategies FROM (SELECT s1_id, target_id, 'tfidf_name' AS s FROM f UNION ALL SELECT s1_id, target_id, 'tfidf_address' FROM g UNION ALL SELECT s1_id, target_id, 'token_overlap' FROM two UNION ALL SELECT a.entity_id, b.entity_id, 'exact_name' FROM s1 a JOIN t b USING (business_name) WHERE business_name <> '') GROUP BY s1_id, target_id")
def _(spark, sf):
    return B.block_multi_strategy(*sides(spark, sf)).select("s1_id", "target_id", F.array_join("strategies", ",").alias("strategies"))


# ---- text ---------------------------------------------------------------------------------


def _text_query(name: str, make, sql: str) -> None:
    SPARK[name] = lambda spark, sf: raw_records(spark, sf).select("entity_id", make(F.col("business_name")).alias("v"))
    SQL[name] = BASE + f"SELECT entity_id, {sql} AS v FROM ent"


_N2 = "regexp_replace(business_name, '[^\\p{L}\\p{N}_\\s]', ' ', 'g')"
_text_query("N1", X.lowered, "trim(lower(business_name))")
_text_query("N2", X.spaced, _N2)
_text_query("N3", X.ascii_folded, "regexp_replace(strip_accents(business_name), '[^\\x00-\\x7F]', '', 'g')")
_text_query("N4", lambda c: X.normalized(c, BUSINESS), norm_sql("business_name", BUSINESS))
_text_query("N5", lambda c: X.collapsed(X.spaced(c)), f"trim(regexp_replace({_N2}, '\\s+', ' ', 'g'))")


def rules_sql(c: str, rules: dict[str, str]) -> str:
    """The rules one after the other; a boundary is a place that a word character stands on one side of (captured, since RE2 looks neither way; twice, for abbreviations next to each other)."""
    out = f"trim(lower({c}))"
    for k, v in rules.items():
        if k == "&":
            out = f"regexp_replace({out}, '(\\w)&(\\w)', '\\1{v}\\2', 'g')"
            continue
        k = k.replace(" ", "\\s*")
        for _ in range(2):
            out = f"regexp_replace({out}, '(^|[^\\p{{L}}\\p{{N}}_]){k}($|[^\\p{{L}}\\p{{N}}_])', '\\1{v}\\2', 'g')"
    return f"trim(regexp_replace({out}, '\\s+', ' ', 'g'))"


_text_query("N6", lambda c: X.expand_abbreviations(c, BUSINESS), rules_sql("business_name", BUSINESS))
_text_query("N7", X.expand_address, rules_sql("business_name", ADDRESS))


def _rule_query(name: str, rules: dict[str, str]) -> None:
    def run(spark, sf):
        rows = ", ".join(f"('{k}', '{v}')" for k, v in rules.items())
        table = spark.sql(f"SELECT * FROM VALUES {rows} AS r(short, long)")
        return table.select("short", X.expand_abbreviations(F.when(F.col("short") == "&", F.lit("a&b")).otherwise(F.col("short")), rules).alias("long"))

    SPARK[name] = run
    rows = ", ".join(f"('{k}', '{'aandb' if k == '&' else v}')" for k, v in rules.items())
    SQL[name] = f"SELECT * FROM (VALUES {rows}) r(short, long)"


_rule_query("N8", BUSINESS)
_rule_query("N9", ADDRESS)


def _norm_query(name: str, make, sql: str) -> None:
    SPARK[name] = lambda spark, sf: PL.normalized_records(raw_records(spark, sf)).select("entity_id", make(F.col("business_name")).alias("v"))
    SQL[name] = BASE + f"SELECT entity_id, {sql} AS v FROM n"


_norm_query("P1", lambda c: X.soundex(c), soundex_sql("business_name"))
_norm_query("P2", X.first_word, "split_part(business_name, ' ', 1)")


def _tfidf_query(name: str, make, sql: str) -> None:
    def run(spark, sf):
        s1, t = sides(spark, sf)
        counts = TF.gram_counts(s1, "business_name")
        return make(s1, t, counts, TF.vocabulary(counts, s1.count()))

    SPARK[name] = run
    SQL[name] = BASE + tfidf_sql("business_name", 5, 0.5, 0.1) + " " + sql


_tfidf_query("T1", lambda s1, t, c, v: c.select("gram").distinct(), "SELECT DISTINCT gram FROM f_g WHERE src = 1")
_tfidf_query("T2", lambda s1, t, c, v: c, "SELECT entity_id, gram, tf FROM f_g WHERE src = 1")
_tfidf_query("T3", lambda s1, t, c, v: v.select("gram", "df"), "SELECT gram, df FROM f_v")
_tfidf_query("T4", lambda s1, t, c, v: v.select("gram", F.round("idf", 6).alias("idf")), "SELECT gram, round(idf, 6) AS idf FROM f_v")
_tfidf_query("T5", lambda s1, t, c, v: TF.postings(c, v).select("entity_id", "gram", F.round("weight", 6).alias("weight")), "SELECT entity_id, gram, round(weight, 6) AS weight FROM f_p WHERE src = 1")
_tfidf_query("T6", lambda s1, t, c, v: TF.postings(TF.gram_counts(t, "business_name"), v).select("entity_id", "gram", F.round("weight", 6).alias("weight")), "SELECT entity_id, gram, round(weight, 6) AS weight FROM f_p WHERE src > 1")
SPARK["T7"], SQL["T7"] = SPARK["J5"], SQL["J5"]


# ---- pair features ------------------------------------------------------------------------

_A, _B_ = F.col, F.col


def _pair_query(name: str, make, sql: str | None, source: str = "sets") -> None:
    SPARK[name] = lambda spark, sf: joined(spark, sf).select("s1_id", "target_id", make(F.col("s1_name"), F.col("target_name")).alias("v"))
    if sql:
        SQL[name] = BASE + f"SELECT s1_id, target_id, {sql} AS v FROM {source}"


_ratio = lambda f: lambda a, b: F.round(f(a, b), 6)
_inter, _union = "len(list_intersect(x, y))", "len(list_distinct(list_concat(x, y)))"
_empty = "len(x) = 0 OR len(y) = 0"
_pair_query("X1", S.exact, "(s1_name = target_name)::INT")
_pair_query("X2", _ratio(S.jaro_winkler_column), "round(CASE WHEN s1_name = '' AND target_name = '' THEN 1.0 ELSE jaro_winkler_similarity(s1_name, target_name) END, 6)")
_pair_query("X3", _ratio(S.indel_column), f"round({lcs_sql('s1_name', 'target_name')}, 6)")
_sa, _sb = "array_to_string(list_sort(x0), ' ')", "array_to_string(list_sort(y0), ' ')"
_pair_query("X5", _ratio(S.token_sort_column), f"round({lcs_sql('p', 'q')}, 6)", f"(SELECT *, {_sa} AS p, {_sb} AS q FROM sets)")
_core = "array_to_string(list_sort(list_intersect(x, y)), ' ')"
_side = lambda a, b: f"trim({_core} || ' ' || array_to_string(list_sort(list_filter({a}, lambda w: NOT list_contains({b}, w))), ' '))"
_pair_query(
    "X4",
    _ratio(S.token_set_column),
    f"round(CASE WHEN {_empty} THEN 0.0 WHEN c <> '' AND (c = p OR c = q) THEN 1.0 WHEN c = '' THEN {lcs_sql('p', 'q')} ELSE greatest({lcs_sql('p', 'q')}, {lcs_sql('c', 'p')}, {lcs_sql('c', 'q')}) END, 6)",
    f"(SELECT *, {_core} AS c, {_side('x', 'y')} AS p, {_side('y', 'x')} AS q FROM sets)",
)
_pair_query("X6", _ratio(S.partial_column), None)
_pair_query("X7", S.length_difference, "abs(length(s1_name) - length(target_name))::INT")
_pair_query("X8", _ratio(S.length_ratio), "round(least(greatest(length(s1_name), 1), greatest(length(target_name), 1)) / greatest(length(s1_name), length(target_name), 1), 6)")
_pair_query("X9", _ratio(S.token_jaccard), f"round(CASE WHEN {_empty} THEN 0.0 ELSE {_inter} / {_union} END, 6)")
_pair_query("X10", S.shared_tokens, f"{_inter}::INT")
_pair_query("X11", _ratio(S.containment), f"round(CASE WHEN {_empty} THEN 0.0 ELSE {_inter} / least(len(x), len(y)) END, 6)")
_NUM = "(SELECT *, list_distinct(regexp_extract_all(s1_address, '\\d+')) AS a, list_distinct(regexp_extract_all(target_address, '\\d+')) AS b FROM j)"
SPARK["X12"] = lambda spark, sf: joined(spark, sf).select("s1_id", "target_id", F.round(S.number_match(F.col("s1_address"), F.col("target_address")), 6).alias("v"))
SQL["X12"] = BASE + f"SELECT s1_id, target_id, round(CASE WHEN len(a) = 0 AND len(b) = 0 THEN -1.0 WHEN len(a) = 0 OR len(b) = 0 THEN 0.0 ELSE len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) END, 6) AS v FROM {_NUM}"
_FLAGS = {"country_match": "(coalesce(s1_country, '') = coalesce(target_country, ''))::INT", "country_missing": "(s1_country IS NULL OR target_country IS NULL)::INT", "s1_has_addr": "(length(s1_address) > 2)::INT", "target_has_addr": "(length(target_address) > 2)::INT", "both_have_addr": "(length(s1_address) > 2 AND length(target_address) > 2)::INT"}
for _id, _names in (("X13", ["country_match"]), ("X14", ["country_missing"]), ("X15", ["s1_has_addr", "target_has_addr", "both_have_addr"])):
    SPARK[_id] = lambda spark, sf, names=_names: joined(spark, sf).select("s1_id", "target_id", *[c for c in FE.country_features()]).select("s1_id", "target_id", *names)
    SQL[_id] = BASE + "SELECT s1_id, target_id, " + ", ".join(f"{_FLAGS[n]} AS {n}" for n in _names) + " FROM j"
SPARK["F13"], SQL["F13"] = SPARK["X12"], SQL["X12"]


@query("X16")
def _(spark, sf):
    return FE.feature_matrix(pairs(spark, sf), *sides(spark, sf))


# ---- training and evaluation --------------------------------------------------------------

#: What the queries train with, and a small stand-in for unit tests.
TREES, SMALL = M.TreeSettings(), M.TreeSettings(rounds=5, depth=4, folds=3, least=5)


@query("M1", BASE + _MULTI + ", b AS (SELECT s1_id, target_id FROM f UNION SELECT s1_id, target_id FROM g UNION SELECT s1_id, target_id FROM two UNION SELECT a.entity_id, b.entity_id FROM s1 a JOIN t b USING (business_name) WHERE business_name <> '' UNION SELECT s1_id, target_id FROM truth) SELECT s1_id, target_id, CASE WHEN (s1_id, target_id) IN (SELECT (s1_id, target_id) FROM truth) THEN 1 ELSE 0 END AS label FROM b")
def _(spark, sf):
    return PL.training_pairs(*sides(spark, sf), truth(spark, sf))


@query("M3", BASE + f"SELECT s1_id, target_id, ({md5_sql('s1_id')} % 5)::INT AS fold FROM pairs")
def _(spark, sf):
    return SA.with_fold(pairs(spark, sf))


_GRID = ", th AS (SELECT unnest([" + ", ".join(map(str, E.SWEEP)) + "])::DOUBLE AS threshold), l AS (SELECT s1_id, target_id, probability, CASE WHEN (s1_id, target_id) IN (SELECT (s1_id, target_id) FROM truth) THEN 1 ELSE 0 END AS label FROM scored), act AS (SELECT s1_id, count(DISTINCT target_id) AS actual FROM truth GROUP BY 1), grid AS (SELECT threshold, s1_id, coalesce(sum(label) FILTER (probability >= threshold), 0) AS tp, count(*) FILTER (probability >= threshold) AS predicted FROM l, th GROUP BY 1, 2), full_ AS (SELECT threshold, tp, predicted, coalesce(actual, 0) AS actual FROM grid LEFT JOIN act USING (s1_id))"


@query("M6", BASE + _GRID + f" SELECT threshold, round(avg({F05}), 9) AS macro_f05 FROM full_ GROUP BY threshold")
def _(spark, sf):
    return E.sweep(scored(spark, sf), truth(spark, sf)).select("threshold", F.round("macro_f05", 9).alias("macro_f05"))


def _labelled(spark, sf, found=None):
    s1, t = sides(spark, sf)
    return M.held(E.label_pairs(FE.feature_matrix(M.held(pairs(spark, sf)) if found is None else found, s1, t), truth(spark, sf)))


def _trained(spark, sf, settings=SMALL, found=None):
    features = _labelled(spark, sf, found)
    return features, M.MatchModel(M.fit(features, settings))


@query("M4")
def _(spark, sf):
    features, model = _trained(spark, sf, TREES)
    return model.probabilities(features).select("s1_id", "target_id", "probability")


@query("M5")
def _(spark, sf):
    return M.out_of_fold(_labelled(spark, sf), TREES)


def _matched(spark, sf, threshold=None):
    """Matches of the pairs that the model was trained on, which are blocked once, by the model as it is stored."""
    at, found = scratch(spark), M.held(pairs(spark, sf))
    M.MatchModel(_trained(spark, sf, TREES, found)[1].model, 0.5).save(at)
    return PL.predict(found, *sides(spark, sf), M.MatchModel.load(at), threshold)


@query("M7")
def _(spark, sf):
    return _matched(spark, sf)


@query("M8")
def _(spark, sf):
    return _matched(spark, sf, 0.7)


SPARK["I10"] = SPARK["K5"] = SPARK["M7"]


@query("M9")
def _(spark, sf):
    return PL.evaluate(*sides(spark, sf), truth(spark, sf), _trained(spark, sf, TREES)[1])


@query("A12")
def _(spark, sf):
    return _trained(spark, sf, TREES)[1].importances()


SPARK["R4"] = SPARK["A12"]


@query("L1", BASE + tfidf_sql("business_name", 10, 0.3, 0.01) + tfidf_sql("business_address", 5, 0.35, 0.01, "length(business_address) > 3", "g") + " SELECT s1_id, target_id, 'tfidf_name' AS strategy FROM f UNION ALL SELECT s1_id, target_id, 'tfidf_address' FROM g UNION ALL SELECT DISTINCT a.entity_id, b.entity_id, 'exact_name' FROM s1 a JOIN t b USING (business_name) WHERE length(business_name) > 2")
def _(spark, sf):
    return PL.candidates(*sides(spark, sf), PRODUCTION)


def queries() -> dict[str, Query]:
    return dict(SPARK)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
