"""Sharding by Karmarkar-Karp differencing: groups of equal texts stay whole, bytes near equal."""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed, unsigned_crc32

#: Groups that one task differences at once, and partial partitions that one task combines.
TASK_GROUPS, TASK_PARTS = 20_000, 4_096


def difference(parts: list[list[tuple[int, object]]]) -> list[tuple[int, object]]:
    """Combine partial partitions, each a list of (sum, tree) per bin, into one.

    Again and again the two of largest spread are joined in opposite order, the largest bin of one
    with the smallest of the other. A tree is None, a leaf or a pair of trees.
    """
    heap = []
    for k, p in enumerate(parts):
        p = sorted(p, key=_sum)
        heap.append((p[0][0] - p[-1][0], k, p))
    heapq.heapify(heap)
    k = len(heap)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        c = sorted([(x + y, s if t is None else t if s is None else (s, t)) for (x, s), (y, t) in zip(a, reversed(b))], key=_sum)
        heapq.heappush(heap, (c[0][0] - c[-1][0], k, c))
        k += 1
    return heap[0][2] if heap else []


@dataclass(frozen=True)
class Leaf:
    """A bin of a partial partition."""

    node: int
    bin: int


def _sum(slot: tuple[int, object]) -> int:
    return slot[0]


def leaves(tree: object) -> list[object]:
    out, stack = [], [tree]
    while stack:
        x = stack.pop()
        if type(x) is tuple:
            stack.extend(x)
        elif x is not None:
            out.append(x)
    return out


def _deal_groups(shards: int):
    def deal(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["bytes", "key"], ascending=[False, True], kind="stable").reset_index(drop=True)
        empty = [(0, None)] * (shards - 1)
        bins = difference([[*empty, (int(b), i)] for i, b in enumerate(rows["bytes"])])
        place = [0] * len(rows)
        for k, (_, tree) in enumerate(bins):
            for i in leaves(tree):
                place[i] = k
        return rows.assign(bin=place)[["key", "bytes", "node", "bin"]]

    return deal


def _deal_parts(shards: int):
    def deal(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["node", "bin"])
        parts = []
        for node, own in rows.groupby("node", sort=True):
            parts.append([(int(b), Leaf(int(node), int(k))) for k, b in zip(own["bin"], own["bytes"])])
            parts[-1] += [(0, None)] * (shards - len(parts[-1]))
        out = []
        for k, (total, tree) in enumerate(difference(parts)):
            for leaf in leaves(tree):
                out.append((leaf.node, leaf.bin, k))
        return pd.DataFrame(out, columns=["node", "bin", "up_bin"]).assign(up=rows["up"].iloc[0])[["node", "bin", "up", "up_bin"]].astype({"node": "int64", "bin": "int32", "up": "int64", "up_bin": "int32"})

    return deal


def shard_by_bytes(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Put documents into shards of near-equal bytes; equal texts share a shard.

    Returns (doc_id, size, text_crc32, law, shard, slot, grown_shard). size: UTF-8 bytes plus 1. A null
    text counts as empty and groups with the empty ones. Repeated rows are rows of their own; an empty
    table gives no rows; null ids come first in slots; further columns are not read.

    Groups are dealt by hash to tasks of about `TASK_GROUPS`; each task differences its own into one
    partial partition, and partial partitions are differenced up a tree of fan-in `TASK_PARTS`, so no
    task holds more than that however many documents there are. A group larger than its share of a
    shard bounds how equal the bytes can get. Slots: rows are dealt by hash within a shard, ranked
    there, and moved up by the rows of the hashes before.
    """
    base = checkpointed(
        docs.select(
            F.col("doc_id"),
            (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
            unsigned_crc32(F.col("text")).alias("text_crc32"),
            F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256)).alias("key"),
        )
    )
    n = base.count()
    nodes = max(1, -(-n // TASK_GROUPS))
    groups = base.groupBy("key").agg(F.sum("size").alias("bytes")).withColumn("node", F.pmod(F.xxhash64("key"), F.lit(nodes)))
    dealt = checkpointed(groups.groupBy("node").applyInPandas(_deal_groups(shards), "key binary, bytes long, node long, bin int"))
    sums = dealt.groupBy("node", "bin").agg(F.sum("bytes").alias("bytes"))
    to = None
    while True:
        step = sums.withColumn("up", F.floor(F.col("node") / TASK_PARTS).cast("long")).groupBy("up").applyInPandas(_deal_parts(shards), "node long, bin int, up long, up_bin int")
        step = checkpointed(step)
        to = step if to is None else to.join(step.toDF("n2", "b2", "u2", "v2"), (F.col("up") == F.col("n2")) & (F.col("up_bin") == F.col("b2"))).select("node", "bin", F.col("u2").alias("up"), F.col("v2").alias("up_bin"))
        nodes = -(-nodes // TASK_PARTS)
        if nodes == 1:
            break
        sums = sums.join(step, ["node", "bin"]).groupBy(F.col("up").alias("node"), F.col("up_bin").alias("bin")).agg(F.sum("bytes").alias("bytes"))
    place = dealt.join(to, ["node", "bin"]).select("key", F.col("up_bin").alias("shard"))
    subs = max(16, -(-n // TASK_GROUPS))
    rows = checkpointed(
        base.join(place, "key").select("doc_id", "size", "text_crc32", "shard", F.pmod(F.xxhash64("doc_id"), F.lit(subs)).alias("sub"))
    )
    before = W.partitionBy("shard").orderBy("sub").rowsBetween(W.unboundedPreceding, -1)
    offsets = rows.groupBy("shard", "sub").agg(F.count(F.lit(1)).alias("n")).select("shard", "sub", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    rank = F.row_number().over(W.partitionBy("shard", "sub").orderBy("doc_id", "size", "text_crc32"))
    return (
        rows.withColumn("rank", rank)
        .join(offsets, ["shard", "sub"])
        .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("before") + F.col("rank") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    )
