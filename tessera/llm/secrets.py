"""Secret scans by a trigram inverted index, in DataFrame operations only.

From each rule's regular expression the mandatory substrings are derived, and from those a Boolean
trigram query: any of its alternatives, all trigrams of one. Postings hold which documents have which
of the queries' trigrams; intersecting them gives candidates, on which the expression itself runs.
A rule whose expression has no mandatory trigram (a class repeated, say) is run over every text.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import beside_texts, free_name

#: Alternatives that a derived query may have before the rule counts as one without mandatory trigrams.
MOST_ALTERNATIVES = 64


@dataclass(frozen=True)
class Rule:
    """kind: name in spans. pattern: a Java expression. group, least: the match counts if that group (0: all) has so many characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The base rules, then prefixes of published key formats. A run of a class that is too
# short fails from each of its places, so a least length in the expression drops the same matches.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
ADDED = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)


# ---- Boolean trigram queries --------------------------------------------------------------


def _tree(pattern: str):
    """The expression's parse, by the grammar that Java and Python share for the rules' constructs."""
    from re import _parser  # the standard library's own parser of regular expressions

    return _parser.parse(pattern, re.ASCII)


def _exact(nodes) -> list[set[str] | None]:
    """The expression as a run of parts: the few strings that a part can be, or None where it can be many."""
    out: list[set[str] | None] = []
    for op, arg in nodes:
        name = str(op)
        if name == "LITERAL":
            out.append({chr(arg).lower()})
        elif name == "IN" and arg and str(arg[0][0]) != "NEGATE":
            chars: set[str] = set()
            for kind, x in arg:
                if str(kind) == "LITERAL":
                    chars.add(chr(x).lower())
                elif str(kind) == "RANGE":
                    chars |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
                else:
                    chars |= set(map(str, range(100)))  # a category: many
            out.append(chars if len(chars) <= 8 else None)
        elif name == "SUBPATTERN":
            inner = _exact(arg[-1])
            if None not in inner and _small(inner):
                out.append(_product(inner))
            else:  # keep what is sure inside
                out += [None, *inner, None]
        elif name == "BRANCH":
            parts = [_exact(x) for x in arg[1]]
            out.append(set().union(*(_product(x) for x in parts)) if all(None not in x and _small(x) for x in parts) else None)
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            low, high, inner = arg[0], arg[1], _exact(arg[2])
            if low == 0 and high == 1 and None not in inner and _small(inner):
                out.append({""} | _product(inner))
            elif low == high and int(low) <= 4 and None not in inner and _small(inner * int(low)):
                out.append(_product(inner * int(low)))
            else:
                out.append(None)
        elif name != "AT":
            out.append(None)
    return out


def _small(parts: list[set[str] | None]) -> bool:
    n = 1
    for p in parts:
        n *= len(p or ())
    return n <= MOST_ALTERNATIVES


def _product(parts) -> set[str]:
    return {"".join(x) for x in itertools.product(*parts)}


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives, each a set of lower-case trigrams that a text must all have; None if the expression has no mandatory trigram."""
    best: set[str] | None = None
    run: list[set[str]] = []

    def take() -> None:
        nonlocal best
        while run and not _small(run):
            run.pop()
        strings = _product(run) if run else set()
        if strings and min(map(len, strings)) >= 3 and (best is None or (min(map(len, strings)), -len(strings)) > (min(map(len, best)), -len(best))):
            best = strings
        run.clear()

    for part in _exact(_tree(pattern)):
        if part is None or not _small([*run, part]):
            take()
        if part is not None:
            run.append(part)
    take()
    if best is None:
        return None
    found = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in best}
    return sorted((x for x in found if not any(y < x for y in found)), key=sorted)  # a wider alternative adds nothing


# ---- scanning -----------------------------------------------------------------------------


def spans_of(text: Column, rule: Rule) -> Column:
    """Array of (start, kind order is the caller's, end) of a rule's matches: code points, end exclusive, leftmost and not overlapping.

    What lies between matches is split off, so lengths add up to places.
    """
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    held = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
    between = F.split(text, rule.pattern, -1)
    empty = F.expr("named_struct('at', 0, 'out', cast(array() as array<struct<start:int,end:int,size:int>>))")
    walked = F.aggregate(
        F.arrays_zip(found.alias("f"), held.alias("h"), between.alias("b")),
        empty,
        lambda t, x: F.struct(
            (t["at"] + F.length(x["b"]) + F.coalesce(F.length(x["f"]), F.lit(0))).cast("int").alias("at"),
            F.when(
                x["f"].isNotNull() & (F.length(x["h"]) >= rule.least),
                F.concat(t["out"], F.array(F.struct((t["at"] + F.length(x["b"])).cast("int").alias("start"), (t["at"] + F.length(x["b"]) + F.length(x["f"])).cast("int").alias("end"), F.length(x["h"]).alias("size")))),
            )
            .otherwise(t["out"])
            .alias("out"),
        ),
    )
    return F.when(text.rlike(rule.pattern), walked["out"]).otherwise(F.expr("cast(array() as array<struct<start:int,end:int,size:int>>)"))


def _posting_keys(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Candidates (id, mark, kinds) of the rules with a query: postings of the queries' trigrams, intersected."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    clauses = [(kind, k, sorted(c)) for kind, q in queries.items() if q for k, c in enumerate(q)]
    trigrams = sorted({t for _, _, c in clauses for t in c})
    # a column of its own: lower-cased once, not for each trigram
    low = docs.withColumn("low", F.lower(F.col("text")))
    kept = F.filter(F.array(*[F.when(F.col("low").contains(t), F.lit(t)) for t in trigrams]), lambda t: t.isNotNull())
    postings = low.select("id", "mark", F.explode(kept).alias("trigram"))
    fixed = [F.struct(F.lit(t).alias("trigram"), F.lit(kind).alias("kind"), F.lit(k).alias("clause"), F.lit(len(c)).alias("need")) for kind, k, c in clauses for t in c]
    terms = docs.sparkSession.range(1).select(F.inline(F.array(*fixed)))
    met = postings.join(F.broadcast(terms), "trigram").groupBy("id", "mark", "kind", "clause", "need").agg(F.count_distinct("trigram").alias("n"))
    return met.where("n = need").groupBy("id", "mark").agg(F.collect_set("kind").alias("kinds"))


def _named(k: int, kind: str):
    return lambda x: F.struct(x["start"].alias("start"), F.lit(k).alias("rule"), F.lit(kind).alias("kind"), x["end"].alias("end"))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + ADDED, name: str = "_spans") -> DataFrame:
    """Every row, all columns, with a column `name`, which docs must not have: an array of (start, rule, kind, end) by start and then rule order.

    A null text counts as empty. Null and repeated ids are told apart by their text's hash, so equal rows
    get equal spans; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select(F.col("doc_id").alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    id_, mark, kinds, own_mark = (free_name(docs, x) for x in ("found_id", "found_mark", "found_kinds", "own_mark"))
    found = beside_texts(_posting_keys(base, rules).toDF(id_, mark, kinds))
    first = docs.withColumn(own_mark, F.xxhash64(text)).join(found, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(own_mark) == F.col(mark)), "left")
    none = F.expr("cast(array() as array<struct<start:int,end:int,size:int>>)")
    parts = []
    for k, rule in enumerate(rules):
        own = spans_of(text, rule)
        if trigram_query(rule.pattern) is not None:
            own = F.when(F.array_contains(kinds, rule.kind), own).otherwise(none)
        parts.append(F.transform(own, _named(k, rule.kind)))
    return first.withColumn(name, F.array_sort(F.flatten(F.array(*parts)))).drop(own_mark, id_, mark, kinds)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of each row; see `scan`."""
    found = scan(docs.select("doc_id", "text")).select("doc_id", "_spans")
    count = lambda kind: F.size(F.filter("_spans", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("_spans", lambda x: x["rule"] < len(BASE))
    return found.select("doc_id", *[count(r.kind).alias(f"n_{r.kind}") for r in BASE], F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("_spans")).alias("spans"))


def redacted_text(text: Column, spans: Column, mask: str = "[REDACTED]") -> Column:
    """The text with each span, or run of spans that touch or overlap, replaced by the mask."""
    start = F.expr("named_struct('at', 0, 'out', '')")
    walked = F.aggregate(
        spans,
        start,
        lambda t, x: F.struct(
            F.greatest(t["at"], x["end"]).alias("at"),
            F.when(x["end"] <= t["at"], t["out"])
            .when((x["start"] < t["at"]) | ((x["start"] == t["at"]) & (t["at"] > 0)), t["out"])
            .otherwise(F.concat(t["out"], F.substring(text, t["at"] + 1, x["start"] - t["at"]), F.lit(mask)))
            .alias("out"),
        ),
    )
    return F.when(F.size(spans) > 0, F.concat(walked["out"], F.substring(text, walked["at"] + 1, F.length(text)))).otherwise(text)


def redacted(docs: DataFrame, mask: str = "[REDACTED]") -> DataFrame:
    """The documents, all their columns, with every span masked in the text and n_chars, where there is one, of the new text. Null texts stay null."""
    name = free_name(docs, "spans")
    found = scan(docs, name=name)
    found = found.withColumn("text", F.when(F.col("text").isNotNull(), redacted_text(F.col("text"), F.col(name), mask)))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(F.size(name) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return found.select(*docs.columns)
