"""Queries over the tables of a folder, one for each operator of this subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.common import table


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Where the public tokenizers' files are."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_shard_by_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.sharding import shard_by_bytes

    return shard_by_bytes(table(spark, sf_dir, "documents"), 16)


def op2_count_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.token_counts import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), vocabulary(), 1024)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.decontamination import contamination

    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), vocabulary(), 1024, 2)


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.near_duplicates import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), 75)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.language import identify

    return identify(table(spark, sf_dir, "documents"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.secrets import secret_report

    return secret_report(table(spark, sf_dir, "documents"))


def op9_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.token_store import stored_tokens

    return stored_tokens(table(spark, sf_dir, "documents"), vocabulary(), end_id=2)


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.fingerprints import edited_fingerprints

    return edited_fingerprints(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_shard_by_bytes, op2_count_tokens, op3_decontaminate, op4_toxicity, op5_pack_documents, op6_near_duplicates, op7_language, op8_secrets, op9_token_store, op10_fingerprints)}


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(pattern: str) -> str:
    return f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{pattern}')"


_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP3_SQL = f"""WITH d AS (SELECT doc_id, {_words(_ALNUM)} AS w FROM documents),
b AS (SELECT item_id, {_words(_ALNUM)} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: list_slice(w, i, i + 9))) AS ws FROM b WHERE len(w) > 0),
lens AS (SELECT DISTINCT n FROM win),
pos AS (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n),
found AS MATERIALIZED (SELECT doc_id, item_id, i, n FROM (SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS ws FROM pos) JOIN win USING (n, ws)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""

OP6_SQL = f"""WITH RECURSIVE d AS MATERIALIZED (SELECT doc_id, {_words(r"[^\x20\x09-\x0D]+")} AS w FROM documents),
sh AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w] ELSE list_transform(range(1, len(w) - 3), lambda i: list_slice(w, i, i + 4)) END) AS s FROM d),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
links AS MATERIALIZED (SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM sh x JOIN sh y USING (s) WHERE x.doc_id <> y.doc_id GROUP BY 1, 2) p JOIN n u ON u.doc_id = a JOIN n v ON v.doc_id = b WHERE 100 * i >= 75 * (u.n + v.n - i)),
reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM comp LEFT JOIN n USING (doc_id)"""


def _op8_sql() -> str:
    from tessera.llm.secrets import ADDED, BASE

    parts = []
    for k, r in enumerate(BASE + ADDED):
        pattern = "'" + r.pattern.replace("'", "''") + "'"
        parts.append(
            f"SELECT doc_id, {k} AS rule, '{r.kind}' AS kind, m[i] AS m, h[i] AS h, (list_sum(list_transform(list_slice(g, 1, i), lambda x: length(x))) + coalesce(list_sum(list_transform(list_slice(m, 1, i - 1), lambda x: length(x))), 0))::BIGINT AS s "
            f"FROM (SELECT doc_id, g, m, h, unnest(range(1, len(m) + 1)) AS i FROM (SELECT doc_id, string_split_regex(text, {pattern}) AS g, regexp_extract_all(text, {pattern}) AS m, regexp_extract_all(text, {pattern}, {r.group}) AS h FROM documents WHERE regexp_matches(text, {pattern}))) WHERE length(h[i]) >= {r.least}"
        )
    count = lambda kind: f"count(*) FILTER (kind = '{kind}') AS n_{kind}"
    shown = "kind || ':' || s || ':' || (s + length(m))"
    return (
        "WITH f AS (" + " UNION ALL ".join(parts) + f"), a AS (SELECT doc_id, {', '.join(count(r.kind) for r in BASE)}, string_agg({shown}, ',' ORDER BY s, rule) FILTER (rule < {len(BASE)}) AS base, string_agg({shown}, ',' ORDER BY s, rule) AS spans FROM f GROUP BY doc_id) "
        f"SELECT doc_id, {', '.join(f'coalesce(n_{r.kind}, 0) AS n_{r.kind}' for r in BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM documents LEFT JOIN a USING (doc_id)"
    )


def _op10_sql() -> str:
    split = "list_filter(list_transform(string_split(regexp_replace({t}, '([.!?])[ \\t]+', '\\1' || chr(10), 'g'), chr(10)), lambda p: trim(p)), lambda p: p <> '')".replace("\\\\", "\\")
    lanes = "list_transform(range(1, 65), lambda k: coalesce(list_sum(list_transform({p}, lambda q: instr('0123456789abcdef', substr(sha256(q), k, 1)) - 1)), 0)::BIGINT)"
    shown = "printf('%08x', len({p})) || array_to_string(list_transform({v}, lambda x: printf('%04x', x % 65536)), '')"

    def near(f: str, p: str, v: str, g: str, q: str, w: str) -> str:
        gap = f"list_sum(list_transform(range(1, 65), lambda k: (((({v}[k] - {w}[k] + 32768) % 65536 + 65536) % 65536 - 32768) - 7.5::DOUBLE * (len({p}) - len({q}))) ** 2))"
        return f"CASE WHEN {f} = {g} THEN 1.0::DOUBLE WHEN len({p}) + len({q}) = 0 THEN 1.0::DOUBLE ELSE greatest(0.0::DOUBLE, 1.0::DOUBLE - least(1.0::DOUBLE, {gap} / 1360.0::DOUBLE / (len({p}) + len({q})))) END"

    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n_chars FROM documents),
e AS (SELECT *, substr(t, 1, n_chars - n_chars // 2) || substr(coalesce(lead(t) OVER o, first_value(t) OVER o), 1, n_chars // 2) AS ed FROM d WINDOW o AS (ORDER BY doc_id)),
p AS (SELECT *, {split.format(t="t")} AS p1, {split.format(t="ed")} AS p2 FROM e),
l AS (SELECT *, {lanes.format(p="p1")} AS v1, {lanes.format(p="p2")} AS v2 FROM p),
f AS (SELECT *, {shown.format(p="p1", v="v1")} AS f1, {shown.format(p="p2", v="v2")} AS f2 FROM l),
x AS (SELECT *, coalesce(lead(f1) OVER o, first_value(f1) OVER o) AS f3, coalesce(lead(p1) OVER o, first_value(p1) OVER o) AS p3, coalesce(lead(v1) OVER o, first_value(v1) OVER o) AS v3 FROM f WINDOW o AS (ORDER BY doc_id))
SELECT doc_id, n_chars, sha256(ed) AS edited_sha256, f1 AS fingerprint, f2 AS edited_fingerprint, {near("f1", "p1", "v1", "f2", "p2", "v2")} AS near_edited, {near("f1", "p1", "v1", "f3", "p3", "v3")} AS near_next FROM x"""


def oracle_sql() -> dict[str, str]:
    """SQL of the operators that SQL can express; the others are tested against brute force, round trips or held-out rows."""
    return {"op3_decontaminate": OP3_SQL, "op6_near_duplicates": OP6_SQL, "op8_secrets": _op8_sql(), "op10_fingerprints": _op10_sql()}
