"""Document fingerprints: a homomorphic hash of the multiset of paragraphs, in DataFrame operations only.

A paragraph hashes to a wide vector, the 64 hexadecimal digits of its SHA-256. A fingerprint is the
number of paragraphs and the sum of their vectors, each lane modulo 2**16 (the number modulo 2**32),
so it doesn't depend on order, and paragraphs can be added to and taken from it without the rest of
the text. Fingerprints of two texts differ by the sum over the paragraphs that only one has; the mean
square of that difference, which digits at random make 21.25 a paragraph, tells how many there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed

#: Lanes of the vector, their modulus, the variance of a random digit, and documents of a bucket of neighbours at least.
LANES, MODULUS, VARIANCE, BUCKET = 64, 1 << 16, 21.25, 2_000


def paragraphs(text: Column) -> Column:
    """Lines, and sentences within them, that aren't blank, without the spaces about them."""
    lines = F.split(F.regexp_replace(text, r"([.!?])[ \t]+", "$1\n"), "\n", -1)
    return F.filter(F.transform(lines, lambda p: F.trim(p)), lambda p: p != "")


def _lanes(parts: Column) -> Column:
    """The sum of the paragraphs' vectors: their digits' values by lane."""
    hashes = F.transform(parts, lambda p: F.sha2(p, 256))
    digits = F.transform(hashes, lambda h: F.transform(F.split(h, ""), lambda c: F.ascii(c) - F.when(c >= "a", 87).otherwise(48)))
    zero = F.expr(f"cast(array_repeat(0, {LANES}) as array<int>)")
    return F.aggregate(digits, zero, lambda t, d: F.zip_with(t, d, lambda x, y: (x + F.coalesce(y, F.lit(0))).cast("int")))


def _hex(value: Column, width: int) -> Column:
    return F.lpad(F.lower(F.hex(value.cast("long"))), width, "0")


def encode(count: Column, lanes: Column) -> Column:
    """8 hexadecimal digits of the number of paragraphs, then 4 for each lane."""
    return F.concat(_hex(F.pmod(count.cast("long"), F.lit(1 << 32)), 8), F.array_join(F.transform(lanes, lambda x: _hex(F.pmod(x, F.lit(MODULUS)), 4)), ""))


def fingerprint(text: Column) -> Column:
    parts = paragraphs(text)
    return encode(F.size(parts), _lanes(parts))


def _number(hexes: Column) -> Column:
    return F.conv(hexes, 16, 10).cast("long")


def lanes_of(print_: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(LANES - 1)), lambda k: _number(F.substring(print_, k * 4 + 9, F.lit(4))))


def count_of(print_: Column) -> Column:
    return _number(F.substring(print_, 1, 8))


def combined(a: Column, b: Column, sign: int = 1) -> Column:
    """The fingerprint of both texts' paragraphs together (sign 1), or of a's without b's (sign -1)."""
    return encode(count_of(a) + sign * count_of(b), F.zip_with(lanes_of(a), lanes_of(b), lambda x, y: x + sign * y))


def likeness(a: Column, b: Column) -> Column:
    """1 less the share of paragraphs that only one side has, as told from the fingerprints; 1 if they are equal.

    A digit's mean, 7.5, is taken off by the numbers of paragraphs before lanes are taken as signed differences,
    so only what is left, about 4.6 by the root of the paragraphs that differ, must fit a lane: 2 million do at five times that.
    """
    na, nb = count_of(a), count_of(b)
    half = MODULUS // 2
    mean = F.floor(7.5 * (na - nb)).cast("long")
    rest = 7.5 * (na - nb) - mean
    gap = F.zip_with(lanes_of(a), lanes_of(b), lambda x, y: F.pmod(x - y - mean + half, F.lit(MODULUS)) - half)
    square = F.aggregate(gap, F.lit(0.0), lambda t, x: t + (x - rest) * (x - rest))
    apart = square / F.lit(LANES * VARIANCE)
    return F.when(a == b, F.lit(1.0)).when(na + nb == 0, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), 1.0 - F.least(F.lit(1.0), apart / (na + nb))))


def bucketed(docs: DataFrame, per_bucket: int = BUCKET) -> DataFrame:
    """Rows (doc_id, mark, text) with `bucket`, increasing by (doc_id, mark), nulls first, and `ghost`, 1 for a copy of a bucket's first rows at the end of the bucket before.

    Buckets have about `per_bucket` rows, or the root of their number if that is more, so that both buckets and
    their bounds stay small. Bounds are keys that occur, taken from a sample by hash of about eight a bucket and
    put in order by one task; they are a value of the plan (a scalar subquery), looked up in two steps, so a row costs
    the root of their number. The last bucket's end has a copy of the very first rows. Rows of one id, however
    many, are dealt by their texts' hash.
    """
    n = docs.count()
    wanted = max(1, n // max(per_bucket, int(n**0.5)))
    keys = docs.select(F.struct("doc_id", "mark").alias("key"))
    rate = max(1, n // (8 * wanted))
    first = keys.agg(F.min("key").alias("key"))
    picked = keys.where(F.pmod(F.xxhash64("key.mark", "key.doc_id", F.lit(11)), F.lit(rate)) == 0).distinct()
    ordered = picked.agg(F.sort_array(F.collect_list("key")).alias("keys"))
    some = ordered.select(F.filter("keys", lambda x, i: i % 8 == 7).alias("keys"))
    bounds = checkpointed(some.unionByName(first.select(F.array("key").alias("keys"))).agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("keys")))).alias("keys")))
    step = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size("keys")))).cast("int")
    groups = F.transform(F.sequence(F.lit(1), F.greatest(F.size("keys"), F.lit(1)), step), lambda at: F.slice("keys", at, step))
    table = bounds.select(F.struct(F.size("keys").alias("n"), step.alias("step"), F.transform(groups, lambda g: F.element_at(g, 1)).alias("heads"), groups.alias("groups")).alias("table"))
    looked = docs.withColumn("key", F.struct("doc_id", "mark")).withColumn("table", table.scalar())
    looked = looked.withColumn("row", F.greatest(F.size(F.filter("table.heads", lambda x: x <= F.col("key"))), F.lit(1)))
    looked = looked.withColumn("inner", F.filter(F.element_at("table.groups", F.col("row")), lambda x: x <= F.col("key")))
    looked = looked.withColumn("at", (F.col("row") - 1) * F.col("table.step") + F.size("inner") - 1)
    own = F.struct(F.col("at").alias("bucket"), F.lit(0).alias("ghost"))
    before = F.struct(F.pmod(F.col("at") - 1, F.col("table.n")).cast("int").alias("bucket"), F.lit(1).alias("ghost"))
    places = F.when(F.element_at("inner", -1) == F.col("key"), F.array(own, before)).otherwise(F.array(own))
    return looked.select("doc_id", "mark", "text", F.inline(places))


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of whole texts and of their edited texts.

    The edited text has the last floor(n / 2) code points replaced by the first as many (or all) of the
    next document's, by ascending doc_id, after the last the first. Returns (doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    A null text counts as empty, an empty one has no paragraphs; equal ids follow each other by their
    text's hash; rows with a null id come first, so the last document's next is one of them if there are any;
    ids may be of any type that has an order; a single document is its own next; an empty table gives no rows;
    further columns are not read. A text of any length is one value of one task. Documents meet their neighbours
    in buckets of keys in a row, each with a copy of the next bucket's first, so there is one shuffle and no
    task holds all rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", F.xxhash64(text).alias("mark"), text.alias("text"))
    near = bucketed(base).withColumn("n_chars", F.length("text").cast("long")).withColumn("fingerprint", fingerprint(F.col("text")))
    order = W.partitionBy("bucket").orderBy("ghost", F.col("doc_id").asc_nulls_first(), "mark")
    beside = near.select("doc_id", "n_chars", "text", "fingerprint", "ghost", F.lead(F.struct("text", "fingerprint")).over(order).alias("next")).where("ghost = 0")
    half = F.floor(F.col("n_chars") / 2)
    other = F.coalesce(F.col("next.text"), F.col("text"))
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring(other, F.lit(1), half.cast("int")))
    out = beside.select("doc_id", "n_chars", "fingerprint", F.coalesce("next.fingerprint", "fingerprint").alias("next_print"), edited.alias("edited"))
    out = out.withColumn("edited_sha256", F.sha2("edited", 256)).withColumn("edited_fingerprint", fingerprint(F.col("edited"))).drop("edited")
    return out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next_print")).alias("near_next"))
