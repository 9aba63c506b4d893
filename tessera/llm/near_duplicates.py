"""Near-duplicate documents by circulant MinHash, banding and exact verification."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import textscan
from tessera.llm.common import BROADCAST_ROWS, beside_texts, checkpointed, free_name, over_texts, swept
from tessera.llm.components import components

#: Words of a shingle; bands and rows of a band. A pair of Jaccard similarity 0.75 shares no band once in 50,000.
WORDS, BANDS, ROWS = 5, 40, 5
COORDINATES = BANDS * ROWS
#: Bits of a sketch, one of each of further coordinates, and how many standard deviations a pair of the
#: similarity asked for may lie off before it isn't compared on full sets: once in 3 million.
BITS, DEVIATIONS = 1024, 5.0
#: Further bits of the sketch of nodes that are compared with all of a bucket. Both tell 0.68 from 0.75, where the first alone begin at 0.65.
FINE_BITS = 1024
#: Rounds in which each node meets one node of each of its buckets, before buckets still open are compared in full.
ROUNDS = 3
#: Rows with the same words from which on their group's name is sent to the rows instead of shuffling them to it.
HOT_ROWS = 100_000


def circulant_minhash(shingles: np.ndarray, out: np.ndarray, first: int = 0) -> None:
    """Signature of a set of mixed 64-bit hashes into `out` (uint32), from shift `first` on.

    The first permutation places a shingle on a circle of 2**32 (its hash's low half). Coordinate k is
    the least value of the second permutation, a bijective mix of 32 bits, shifted k places around it.
    """
    out[:] = 0xFFFFFFFF
    place = (shingles & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    shift = np.arange(first, first + len(out), dtype=np.uint32)
    for at in range(0, len(place), 256):
        x = place[at : at + 256, None] - shift[None, :]
        x *= np.uint32(0x85EBCA6B)
        x ^= x >> np.uint32(15)
        x *= np.uint32(0xC2B2AE35)
        np.minimum(out, x.min(0), out=out)


class Shingled:
    """Texts as sets of hashed shingles, and a 128-bit key of each text's words."""

    def __init__(self, parts: list[bytes]):
        _, _, _, hashes, self.first = textscan.words(parts, textscan.SOLID)
        self.n_words = np.diff(self.first)
        self.windows = textscan.window_hashes(hashes, WORDS)
        self.key = np.zeros((len(parts), 2), np.uint64)
        some = np.flatnonzero(self.n_words)
        place = (np.arange(len(hashes)) - np.repeat(self.first[:-1], self.n_words)).astype(np.uint64)
        for k, odd in enumerate((0xA0761D6478BD642F, 0xE7037ED1A0B428DB)):
            if some.size:
                self.key[some, k] = textscan.mix64(np.add.reduceat(textscan.mix64(hashes + (place + np.uint64(1)) * np.uint64(odd)), self.first[some]))

    def keys(self) -> pa.Array:
        raw = np.ascontiguousarray(self.key).tobytes()
        return pa.array([raw[i : i + 16] for i in range(0, len(raw), 16)], pa.binary())

    def shingles(self, k: int) -> np.ndarray:
        """The distinct shingles of text k, sorted."""
        n = int(self.n_words[k])
        if n >= WORDS:
            return np.unique(self.windows[self.first[k] : self.first[k] + n - WORDS + 1])
        return self.key[k, :1] if n else np.zeros(0, np.uint64)


def _signed(rest, parts):
    s = Shingled(parts)
    n = np.zeros(len(parts), np.int64)
    signature = np.zeros((len(parts), COORDINATES), np.uint32)
    done: dict[tuple[int, int], int] = {}
    fresh = []
    for k, key in enumerate(map(tuple, s.key.tolist())):
        if key in done:  # a copy within the block
            n[k] = n[done[key]]
            continue
        done[key] = k
        own = s.shingles(k)
        n[k] = len(own)
        if len(own):
            circulant_minhash(own, signature[k])
            fresh.append(k)
    band = np.zeros((len(fresh), BANDS), np.uint64)
    for b in range(BANDS):
        h = np.full(len(fresh), b + 1, np.uint64)
        for r in range(ROWS):
            h = textscan.mix64(h + signature[fresh, b * ROWS + r])
        band[:, b] = h
    bands = [None] * len(parts)
    for k, row in zip(fresh, band.view(np.int64).tolist()):
        bands[k] = row
    return {"doc_id": rest.column(0), "mark": rest.column(1), "key": s.keys(), "n_shingles": pa.array(n), "bands": pa.array(bands, pa.list_(pa.int64()))}


def sketches(sets: list[np.ndarray], bits: int, first: int) -> pa.Array:
    """A bit of each of `bits` coordinates of each set's signature, from shift `first` on."""
    out = np.zeros((len(sets), bits // 64), np.int64)
    signature = np.zeros(bits, np.uint32)
    for k, own in enumerate(sets):
        circulant_minhash(own.view(np.uint64), signature, first)
        out[k] = np.packbits((signature * np.uint32(0x9E3779B1)) >> np.uint32(31)).view(np.int64)
    return pa.array(list(out), pa.list_(pa.int64()))


def _sets(rest, parts):
    s = Shingled(parts)
    sets = [s.shingles(k).view(np.int64) for k in range(len(parts))]
    return {"key": s.keys(), "shingles": pa.array(sets, pa.list_(pa.int64())), "sketch": sketches(sets, BITS, COORDINATES)}


def _fine(batches):
    """(key, fine) of nodes with their full sets."""
    for batch in batches:
        sets = [x.values.to_numpy() for x in batch.column("shingles")]
        yield pa.RecordBatch.from_arrays([batch.column("key"), sketches(sets, FINE_BITS, COORDINATES + BITS)], names=["key", "fine"])


def _most(bits: int, percent: int) -> int:
    """Bits that sketches of two sets may differ in: those agree as often as half of 1 + Jaccard."""
    agree = (1 + percent / 100) / 2
    return int(bits * (1 - agree) + DEVIATIONS * (bits * agree * (1 - agree)) ** 0.5)


def _differ(a, b):
    return F.bit_count(a.bitwiseXOR(b))


def _apart(x: str, y: str):
    return sum((_differ(F.col(f"{x}.sketch")[k], F.col(f"{y}.sketch")[k]) for k in range(BITS // 64)), F.lit(0))


def _near(x: str, y: str, percent: int):
    """Whether two nodes can be similar, by their sets' sizes and their sketches."""
    return (100 * F.least(f"{x}.n", f"{y}.n") >= percent * F.greatest(f"{x}.n", f"{y}.n")) & (_apart(x, y) <= _most(BITS, percent))


def _nearer(x: str, y: str, percent: int):
    """The same by both sketches. As generated code it would be too long for the JVM to compile; it runs only where the first agree."""
    more = F.aggregate(F.zip_with(F.col(f"{x}.fine"), F.col(f"{y}.fine"), _differ), F.lit(0), lambda t, n: t + n)
    return _near(x, y, percent) & (_apart(x, y) + more <= _most(BITS + FINE_BITS, percent))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of nodes whose full sets reach the similarity."""
    full = sets.select("key", "shingles")
    both = pairs.join(full.toDF("a", "xa"), "a").join(full.toDF("b", "xb"), "b").withColumn("i", F.size(F.array_intersect("xa", "xb")))
    return both.where(100 * F.col("i") >= percent * (F.size("xa") + F.size("xb") - F.col("i"))).select("a", "b")


def _pairs(rows: DataFrame, x: str, y: str) -> DataFrame:
    return rows.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def _placed(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members of buckets with their component so far."""
    if labels is None:
        return members.withColumn("root", F.col("key"))
    return members.join(labels.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))


def _open(placed: DataFrame, round_: int) -> DataFrame:
    """Of each bucket with several components: one node, another in each round, as `y`."""
    lead = F.min(F.struct(F.xxhash64("key", F.lit(round_)).alias("h"), "key", "root", "n", "sketch"))
    return placed.groupBy("band").agg(lead.alias("y"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select(F.col("band").alias("open_band"), "y")


def _linked(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, root) of the graph of all similar pairs that share a bucket."""
    links = labels = None
    for k in range(ROUNDS):
        placed = _placed(members, labels)
        opened = _open(placed, k)
        # buckets of one component are done; of the others, the round's node has met all once they have met it
        hit = (F.col("x.root") != F.col("y.root")) & _near("x", "y", percent)
        met = checkpointed(placed.alias("x").join(opened, F.col("band") == F.col("open_band")).select("x.key", "band", "x.n", "x.sketch", F.col("y.key").alias("lead"), hit.alias("hit")))
        fresh = checkpointed(_confirmed(_pairs(met.where("hit"), "key", "lead"), sets, percent))
        links = fresh if links is None else links.unionByName(fresh)
        labels = checkpointed(components(links))
        members = met.where("key <> lead").drop("lead", "hit")
        swept(members.sparkSession)
    placed = _placed(members, labels)
    opened = checkpointed(_open(placed, ROUNDS).select("open_band", F.col("y.root").alias("main")))
    left = checkpointed(placed.join(opened, F.col("band") == F.col("open_band")))
    known = sets.select("key", "shingles").join(left.select("key").distinct(), "key", "left_semi").mapInArrow(_fine, "key binary, fine array<long>")
    open_bands = left.groupBy("key").agg(F.sort_array(F.collect_list("band")).alias("bands"))
    rest = checkpointed(left.join(known.join(open_bands, "key"), "key").drop("open_band"))
    del placed, opened, left, known, open_bands, members
    swept(rest.sparkSession)
    # every node outside the bucket's main component against all of the bucket's other components
    x, y = rest.where("root <> main").alias("x"), rest.alias("y")
    # a pair comes out of the first open bucket that it shares only
    once = F.element_at(F.array_intersect("x.bands", "y.bands"), 1) == F.col("x.band")
    across = x.join(y, (F.col("x.band") == F.col("y.band")) & (F.col("x.root") != F.col("y.root")) & _nearer("x", "y", percent) & once)
    return components(links.unionByName(_confirmed(_pairs(across, "x.key", "y.key"), sets, percent)))


def _named(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows (doc_id, key, n_shingles) with `component_id` of groups (key, n, component_id), their own id where their key has none.

    Few groups go to the rows. Of many, those of `HOT_ROWS` rows and more do, and there can't be more of them
    than rows by that number; the others' rows, none of a key with so many, are shuffled to their groups.
    """
    groups = checkpointed(groups)
    out = F.coalesce("component_id", "doc_id").alias("component_id")
    if groups.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(groups.drop("n")), "key", "left").select("doc_id", "n_shingles", out)
    hot = groups.where(F.col("n") >= HOT_ROWS).drop("n")
    some = rows.join(F.broadcast(hot), "key").select("doc_id", "n_shingles", "component_id")
    rest = rows.join(F.broadcast(hot.select("key")), "key", "left_anti").join(groups.where(F.col("n") < HOT_ROWS).drop("n"), "key", "left")
    return some.unionByName(rest.select("doc_id", "n_shingles", out))


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """Groups of documents linked by a Jaccard similarity of `percent` or more of their word shingles.

    Words are those of the lower-cased text (A-Z) between ASCII white space. Returns (doc_id, n_shingles,
    component_id, kept). Null and empty texts, and such without words, have no shingles and stand alone
    (component_id is their own id). Repeated rows and equal ids are one group if their texts are;
    an empty table gives no rows; a null id is smaller than none: a group's id is its least non-null one.
    Further columns are not read.

    A text of any length is one set, held by one task.

    Equal word sequences are one node, so copies never make pairs. In each of a few rounds every node of
    a bucket that holds several components so far is held against one node of it, which then leaves the
    bucket; a bucket of one component is done. So a large group of near copies costs a comparison a member
    and bucket, and falls together. In buckets still open, every node outside the main component is then
    held against all nodes of other components: each pair that shares a band is compared or already joined.
    Sizes and sketches, longer ones in that last step, rule out pairs within the join; the others are
    compared on full sets, which are built for nodes that share a band only.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    mark = F.xxhash64(text)
    kind = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select("doc_id", mark.alias("mark"), "text")
    rows = checkpointed(over_texts(source, f"doc_id {kind}, mark long, key binary, n_shingles long, bands array<long>", _signed))
    nodes = checkpointed(
        rows.where("n_shingles > 0").groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("rep"), F.min(F.struct("doc_id", "mark")).alias("least"), F.first("bands", ignorenulls=True).alias("bands"))
    )
    banded = nodes.select("key", F.explode("bands").alias("band"))
    shared = checkpointed(banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("band"))
    members = checkpointed(banded.join(shared.select("band"), "band", "left_semi"))
    met = members.select("key").distinct().join(nodes, "key").select(F.col("least.doc_id").alias("doc_id"), F.col("least.mark").alias("mark")).distinct()
    wanted = source.join(beside_texts(met.toDF("m_id", "m_mark")), F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("mark") == F.col("m_mark")), "left_semi")
    sets = checkpointed(over_texts(wanted.select("text"), "key binary, shingles array<long>, sketch array<long>", _sets).dropDuplicates(["key"]))
    sketched = checkpointed(members.join(sets.select("key", F.size("shingles").alias("n"), "sketch"), "key"))
    del members, met, wanted, banded, shared
    swept(docs.sparkSession)
    labels = _linked(sketched, sets, percent)
    swept(docs.sparkSession)
    placed = nodes.select("key", "n", "rep").join(labels.withColumnRenamed("node", "key"), "key")
    ids = placed.groupBy("root").agg(F.min("rep").alias("component_id"))
    joined = placed.join(beside_texts(ids), "root").select("key", "n", "component_id")
    copies = nodes.where("n > 1").join(labels, F.col("key") == F.col("node"), "left_anti").select("key", "n", F.col("rep").alias("component_id"))
    linked = _named(rows.where("n_shingles > 0").select("doc_id", "key", "n_shingles"), joined.unionByName(copies))
    alone = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicated(docs: DataFrame, percent: int = 75) -> DataFrame:
    """The documents, all their columns, that are the least id of their group; see `near_duplicates`. Rows that share both the id and the group stay together."""
    found = checkpointed(near_duplicates(docs, percent).select("doc_id", "kept"))
    swept(docs.sparkSession)
    name = free_name(docs, "gone")
    kept = found.where("kept").select("doc_id").distinct().withColumnRenamed("doc_id", "stays")
    gone = found.where("not kept").select(F.col("doc_id").alias(name)).distinct()
    gone = gone.join(kept, F.col(name).eqNullSafe(F.col("stays")), "left_anti")
    return docs.join(beside_texts(gone), F.col("doc_id").eqNullSafe(F.col(name)), "left_anti")
