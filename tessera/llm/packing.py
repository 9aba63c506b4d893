"""Best-fit packing of token sequences by a grouping genetic algorithm on islands."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.bytelevel import encoder
from tessera.llm.common import checkpointed, over_texts

#: Pieces of a block, its islands, genomes on each, epochs, and crossovers of an epoch, which a migration ends.
TASK_PIECES, ISLANDS, GENOMES, EPOCHS, EPOCH = 4_096, 2, 8, 3, 16
#: Islands that one task evolves at most, at about 80 KB each.
TASK_ISLANDS = 256


def pieces(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """Ids of whole texts, then the end id, cut if longer than `capacity`; the first piece takes the odd rest.

    Returns (doc_id, piece, start, length, ids_crc32); the ids themselves stay where they were made.
    """

    def work(rest, parts):
        ids, at = encoder(path).encode(parts)
        n = np.diff(at) + 1
        count = -(-n // capacity)
        doc = np.repeat(np.arange(len(parts)), count)
        piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
        head = n - (count - 1) * capacity
        start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
        length = np.where(piece == 0, head[doc], capacity)
        whole = np.empty(int(n.sum()), "<u4")
        last = np.cumsum(n) - 1
        keep = np.ones(len(whole), bool)
        keep[last] = False
        whole[keep], whole[last] = ids, end_id
        view, base = memoryview(whole).cast("B"), (last - n + 1)[doc] + start
        crc = [zlib.crc32(view[4 * b : 4 * (b + k)]) for b, k in zip(base.tolist(), length.tolist())]
        return {
            "doc_id": rest.column(0).take(pa.array(doc)),
            "piece": pa.array(piece.astype(np.int32)),
            "start": pa.array(start),
            "length": pa.array(length),
            "ids_crc32": pa.array(crc, pa.int64()),
        }

    narrow = docs.select("doc_id", "text")
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return over_texts(narrow, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long", work)


class Genome:
    """Bins with their fill; bins that gave way to others are empty lists."""

    def __init__(self, capacity: int):
        self.capacity, self.bins, self.fill = capacity, [], []

    def count(self) -> int:
        return sum(map(bool, self.bins))

    def fitness(self) -> tuple[int, int]:
        """Fewer bins, then fuller ones."""
        return -self.count(), sum(f * f for f in self.fill)

    def copy(self) -> Genome:
        out = Genome(self.capacity)
        out.bins, out.fill = [b[:] for b in self.bins], self.fill[:]
        return out

    def best_fit(self, items: list[int], size: list[int]) -> None:
        """Put items, largest first, each into the bin that it fills best."""
        free: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        mask = 0
        for k, f in enumerate(self.fill):
            if self.bins[k]:
                free[self.capacity - f].append(k)
                mask |= 1 << (self.capacity - f)
        for i in sorted(items, key=lambda i: (-size[i], i)):
            s = size[i]
            fits = mask >> s
            if fits:
                room = s + (fits & -fits).bit_length() - 1
                k = free[room].pop()
                if not free[room]:
                    mask ^= 1 << room
                self.bins[k].append(i)
                self.fill[k] += s
            else:
                k, room = len(self.bins), self.capacity
                self.bins.append([i])
                self.fill.append(s)
            free[room - s].append(k)
            mask |= 1 << (room - s)

    def empty(self, which: list[int]) -> list[int]:
        out = []
        for k in which:
            out += self.bins[k]
            self.bins[k], self.fill[k] = [], 0
        return out


def crossed(a: Genome, b: Genome, size: list[int], rng: random.Random) -> Genome:
    """A child of a: well-filled bins of b come in whole, a's bins that share a document go, and what they held besides is fitted best."""
    child = a.copy()
    home = {}
    for k, items in enumerate(child.bins):
        for i in items:
            home[i] = k
    good = [k for k, x in enumerate(b.bins) if x and len(x) > 1 and b.fill[k] == b.capacity] or [k for k, x in enumerate(b.bins) if len(x) > 1]
    if not good:
        return child
    bring = [b.bins[k] for k in rng.sample(good, max(1, len(good) // 4))]
    brought = {i for x in bring for i in x}
    lost = child.empty(sorted({home[i] for i in brought}))
    for x in bring:
        child.bins.append(x[:])
        child.fill.append(sum(size[i] for i in x))
    child.best_fit([i for i in lost if i not in brought], size)
    return child


def shaken(a: Genome, size: list[int], rng: random.Random) -> Genome:
    """Mutation of a itself: the emptiest bins and a few others are emptied and their documents fitted anew."""
    live = sorted((k for k, x in enumerate(a.bins) if x), key=a.fill.__getitem__)
    if len(live) >= 3:
        some = live[: max(1, len(live) // 50)]
        a.best_fit(a.empty([*some, *rng.sample(live[len(some) :], min(len(live) - len(some), 2 * len(some)))]), size)
    return a


def started(size: list[int], capacity: int, rng: random.Random) -> list[Genome]:
    """An island's first genomes: a random part of the items fitted best, then the others."""
    out = []
    for m in range(GENOMES):
        g, everything = Genome(capacity), list(range(len(size)))
        head = rng.sample(everything, int(len(everything) * (0.05 + 0.1 * m)))
        g.best_fit(head, size)
        taken = set(head)
        g.best_fit([i for i in everything if i not in taken], size)
        out.append(g)
    return out


def evolved(people: list[Genome], size: list[int], rng: random.Random) -> list[Genome]:
    """The fittest genomes of an island after an epoch, the elite first. An island that can't do with fewer bins rests."""
    ranked = sorted(((g.fitness(), -k, g) for k, g in enumerate(people)), key=lambda x: x[:2], reverse=True)[:GENOMES]
    least = -(-sum(size) // people[0].capacity)
    for step in range(EPOCH):
        if -ranked[0][0][0] <= least or len(ranked) < 2:
            break
        a, b = (g for _, _, g in rng.sample(ranked, 2))
        child = shaken(crossed(a, b, size, rng), size, rng)
        ranked.append((child.fitness(), -len(people) - step, child))
        ranked.sort(key=lambda x: x[:2], reverse=True)
        ranked.pop()
    return [g for _, _, g in ranked]


def homes(genome: Genome, n: int) -> list[int]:
    """The bin of each of n items."""
    out = [0] * n
    for k, items in enumerate(b for b in genome.bins if b):
        for i in items:
            out[i] = k
    return out


def settled(home: list[int], size: list[int], capacity: int) -> Genome:
    """The genome of `homes`."""
    g = Genome(capacity)
    n = max(home, default=-1) + 1
    g.bins, g.fill = [[] for _ in range(n)], [0] * n
    for i, k in enumerate(home):
        g.bins[k].append(i)
        g.fill[k] += size[i]
    return g


def _fitted(capacity: int):
    """Best fit of a block: each piece with its place in the block, its bin, and whether fewer bins may be possible."""

    def deal(rows: pd.DataFrame) -> pd.DataFrame:
        encoder.cache_clear()  # all texts are encoded by now
        rows = rows.sort_values(["length", "ids_crc32", "doc_id", "piece"]).reset_index(drop=True)
        size = rows["length"].tolist()
        g = Genome(capacity)
        g.best_fit(list(range(len(size))), size)
        return rows.assign(place=np.arange(len(rows)), bin=homes(g, len(size)), open=g.count() > -(-sum(size) // capacity))

    return deal


def _epoch(capacity: int, epoch: int):
    """An epoch of each island of a batch, one island in memory at a time; its genomes arrive as bins of the block's pieces."""

    def run(batches):
        encoder.cache_clear()  # all texts are encoded by now
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                size = row["size"]
                rng = random.Random(f"{row['block']} {row['island']} {epoch}")
                people = [settled(h, size, capacity) for h in sorted(row["genomes"])]
                if not epoch:
                    people = (people if not row["island"] else []) + started(size, capacity, rng)
                people = evolved(people, size, rng)
                row["genomes"] = [homes(g, len(size)) for g in people]
                row["bins"], row["squares"] = people[0].count(), people[0].fitness()[1]
                yield pa.RecordBatch.from_pylist([row], schema=ISLAND)

    return run


ISLAND = pa.schema([("block", pa.int64()), ("island", pa.int32()), ("size", pa.list_(pa.int64())), ("genomes", pa.list_(pa.list_(pa.int32()))), ("bins", pa.int32()), ("squares", pa.int64())])


def _bred(fitted: DataFrame, capacity: int) -> DataFrame:
    """(block, place, bin) of the open blocks' pieces after all epochs.

    An island of a block is a row, its sizes and genomes arrays; islands are dealt to tasks, and after an
    epoch, a written round, the elite of each goes to the next island of its block.
    """
    opened = fitted.where("open").groupBy("block").agg(F.sort_array(F.collect_list(F.struct("place", "length", "bin"))).alias("own"))
    state = opened.select("block", F.col("own.length").alias("size"), F.array(F.col("own.bin")).alias("genomes"))
    rows = fitted.where("open").select("block").distinct().count() * ISLANDS
    tasks = max(1, -(-rows // TASK_ISLANDS), min(rows, fitted.sparkSession.sparkContext.defaultParallelism))
    schema = "block long, island int, size array<long>, genomes array<array<int>>, bins int, squares long"
    state = state.withColumn("island", F.explode(F.array(*map(F.lit, range(ISLANDS)))))
    for epoch in range(EPOCHS):
        if epoch:
            own = F.struct("island", "genomes")
            elite = F.struct(F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"), F.slice("genomes", 1, 1).alias("genomes"))
            state = state.select("block", "size", F.inline(F.array(own, elite)))
        met = state.repartition(tasks, "block", "island").groupBy("block", "island").agg(F.first("size").alias("size"), F.flatten(F.collect_list("genomes")).alias("genomes"))
        blank = [F.lit(0).alias("bins"), F.lit(0).cast("long").alias("squares")]
        state = checkpointed(met.select("block", "island", "size", "genomes", *blank).mapInArrow(_epoch(capacity, epoch), schema))
    best = state.groupBy("block").agg(F.max_by(F.col("genomes")[0], F.struct(-F.col("bins"), "squares", -F.col("island"))).alias("home"))
    return best.select("block", F.posexplode("home").alias("place", "bin"))


def pack_documents(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """Pack documents into as few sequences of at most `capacity` tokens as found.

    Returns per piece (doc_id, piece, start, length, ids_crc32, sequence_id, offset). A null or empty
    text is its end id alone. Repeated rows are pieces of their own; an empty table gives no rows; null
    ids are kept; further columns are not read. A text of any length is encoded by one task.

    Pieces are dealt by hash to blocks of about `TASK_PIECES`. A block that best fit can't pack into the
    fewest sequences possible gets islands, rows of their own, whose genomes evolve side by side in tasks and
    send their elite to the next island after each epoch. Sequences full to a 64th are kept; the others' pieces
    of all blocks meet again in fewer blocks, round by round, until one block holds them or a round doesn't shrink them.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, block long, place int, bin int, open boolean"
    rest = checkpointed(pieces(docs, path, capacity, end_id))
    done, n, round_ = None, rest.count(), 0
    while True:
        tasks = max(1, -(-n // TASK_PIECES))
        dealt = rest.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(round_)), F.lit(tasks)))
        fitted = checkpointed(dealt.groupBy("block").applyInPandas(_fitted(capacity), schema))
        placed = fitted.where("not open").select(*columns, "block", "place", "bin")
        if not fitted.where("open").isEmpty():
            bred = _bred(fitted.select("block", "place", "length", "bin", "open"), capacity)
            placed = placed.unionByName(fitted.where("open").select(*columns, "block", "place").join(bred, ["block", "place"]).select(*columns, "block", "place", "bin"))
        inside = Window.partitionBy("block", "bin")
        before = F.sum("length").over(inside.orderBy("place").rowsBetween(Window.unboundedPreceding, -1))
        number = F.lit(round_ << 58).cast("long").bitwiseOR(F.shiftleft(F.col("block"), 24)).bitwiseOR(F.col("bin").cast("long"))
        loose = F.sum("length").over(inside) < capacity - capacity // 64
        packed = checkpointed(placed.select(*columns, number.alias("sequence_id"), F.coalesce(before, F.lit(0)).alias("offset"), loose.alias("loose")))
        left = packed.where("loose").count() if tasks > 1 else 0
        last = tasks == 1 or left > 0.9 * n or round_ == 15
        part = (packed if last else packed.where("not loose")).drop("loose")
        done = part if done is None else done.unionByName(part)
        if last:
            return done
        rest, n, round_ = packed.where("loose").select(*columns), left, round_ + 1
