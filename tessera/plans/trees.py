"""Boosted trees on binned features, grown by the tasks of one barrier stage that add up their histograms."""

from __future__ import annotations

import hmac
import json
import secrets
import socket
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bins of a feature, rows that are worth a task of their own, units of a gradient (sums of whole numbers don't depend on their order), and the least Hessian of a leaf.
BINS, TASK_ROWS, UNITS, LEAST_HESSIAN = 32, 10_000, 1 << 30, 1e-3


def cells(x: np.ndarray) -> np.ndarray:
    """Numbers as whole numbers in the same order, equal if they agree in 12 binary digits; what isn't a number is the last."""
    x = np.where(np.isnan(x), np.inf, x).astype(np.float32) + np.float32(0)
    bits = x.view(np.int32).astype(np.int64)
    return np.where(bits < 0, -(bits & 0x7FFFFFFF), bits) >> 12


def cuts(values: np.ndarray, counts: np.ndarray) -> list[int]:
    """Up to BINS - 1 cells, each the last of its bin, that deal the rows evenly; every cell is a bin if there are few."""
    if len(values) <= BINS:
        return values[:-1].tolist()
    reached = np.cumsum(counts)
    at = np.unique(np.searchsorted(reached, reached[-1] * np.arange(1, BINS) / BINS))
    return values[at[at < len(values) - 1]].tolist()


def mixed(key: np.ndarray, seed: int) -> np.ndarray:
    """Numbers from 0 to 1 by key and seed (splitmix64)."""
    z = key.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return (z ^ (z >> np.uint64(31))).astype(np.float64) / 2.0**64


@dataclass
class Trees:
    """Cuts of each feature; of each tree, by node in order of level: feature (-1: leaf), bin, value; and each feature's share of the gains."""

    cuts: list[list[int]]
    trees: list[list[list]] = field(default_factory=list)
    gains: list[float] = field(default_factory=list)

    def binned(self, columns: list[np.ndarray]) -> np.ndarray:
        return np.stack([np.searchsorted(np.array(c, np.int64), cells(np.asarray(x, np.float64))).astype(np.uint8) for c, x in zip(self.cuts, columns)])

    def add(self, binned: np.ndarray, tree: list[list], score: np.ndarray) -> None:
        feature, split, value = (np.array(x) for x in tree)
        node, rows = np.zeros(binned.shape[1], np.int64), np.arange(binned.shape[1])
        while True:
            f = feature[node]
            inner = f >= 0
            if not inner.any():
                break
            node = np.where(inner, 2 * node + 1 + (binned[f, rows] > split[node]), node)
        score += value[node]

    def probabilities(self, columns: list[np.ndarray]) -> np.ndarray:
        binned = self.binned(columns)
        score = np.zeros(binned.shape[1])
        for tree in self.trees:
            self.add(binned, tree, score)
        return 1 / (1 + np.exp(-score))

    def text(self) -> str:
        return json.dumps([self.cuts, self.trees, self.gains])

    @staticmethod
    def of(text: str) -> Trees:
        return Trees(*json.loads(text))


def grown(columns: list[np.ndarray], label: np.ndarray, key: np.ndarray, settings, gather, total) -> Trees:
    """The same trees in every task, each with its own rows; gather(array) has the arrays of all tasks, total(array) their sum."""
    mine = [cells(x) for x in columns]
    split_up = [np.unique(x, return_counts=True) for x in mine]
    met = [gather(np.stack(x)) for x in split_up]
    model = Trees([])
    for parts in met:
        whole = np.concatenate(parts, axis=1)
        values, where = np.unique(whole[0], return_inverse=True)
        model.cuts.append(cuts(values, np.bincount(where, whole[1], len(values))))
    binned = np.stack([np.searchsorted(np.array(c, np.int64), x).astype(np.uint8) for c, x in zip(model.cuts, mine)])
    ones, everything = total(np.array([int(label.sum()), len(label)])).tolist()
    of_one, of_zero = everything / (2 * max(1, ones)), everything / (2 * max(1, everything - ones))
    weight, unit = np.where(label == 1, of_one, of_zero), UNITS / max(of_one, of_zero, 1e-9)
    n, at = len(columns), np.arange(len(columns))[:, None] * BINS
    score, gains = np.zeros(len(label)), np.zeros(n)

    def histograms(node: np.ndarray, rows: np.ndarray, g: np.ndarray, h: np.ndarray, which: list[int]) -> np.ndarray:
        """(node, gradient / Hessian / rows, feature, bin) over the rows of all tasks."""
        place = np.full(int(node.max(initial=0)) + 1 if len(node) else 1, -1)
        for k, w in enumerate(which):
            if w < len(place):
                place[w] = k
        slot = place[node]
        use = slot >= 0
        slot, rows, g, h = slot[use], rows[use], g[use], h[use]
        out = np.zeros((3, n, len(which), BINS))
        for f in range(n):
            cell = slot * BINS + binned[f, rows]
            for k, x in enumerate((g, h, None)):
                out[k, f] = np.bincount(cell, x, len(which) * BINS).reshape(len(which), BINS)
        return total(out.astype(np.int64)).transpose(2, 0, 1, 3)

    for t in range(settings.rounds):
        p = 1 / (1 + np.exp(-score))
        rows = np.flatnonzero(mixed(key, settings.seed * 1_000_003 + t) < settings.rows)
        g, h = (np.rint(x[rows] * unit) for x in (weight * (p - label), weight * p * (1 - p)))
        allowed = np.zeros(n, bool)
        allowed[np.random.default_rng([settings.seed, t]).permutation(n)[: max(1, round(n * settings.columns))]] = True
        size = 2 ** (settings.depth + 1) - 1
        feature, split, value, gained = [-1] * size, [0] * size, [0.0] * size, np.zeros(n)
        node = np.zeros(len(rows), np.int64)
        known = {0: histograms(node, rows, g, h, [0])[0]}
        for level in range(settings.depth + 1):
            children = []
            for k, hist in known.items():
                G, H, C = hist[:, 0].sum(axis=1) / unit
                C *= unit
                value[k] = float(-settings.rate * G / max(H, LEAST_HESSIAN))
                if level == settings.depth or C < 2 * settings.least:
                    continue
                GL, HL = (np.cumsum(hist[x], axis=1)[:, :-1] / unit for x in (0, 1))
                CL = np.cumsum(hist[2], axis=1)[:, :-1]
                fine = allowed[:, None] & (CL >= settings.least) & (C - CL >= settings.least) & (HL >= LEAST_HESSIAN) & (H - HL >= LEAST_HESSIAN)
                if not fine.any():
                    continue
                gain = np.where(fine, GL**2 / np.maximum(HL, LEAST_HESSIAN) + (G - GL) ** 2 / np.maximum(H - HL, LEAST_HESSIAN) - G**2 / max(H, LEAST_HESSIAN), 0)
                best = int(gain.argmax())
                f, b = divmod(best, BINS - 1)
                if gain[f, b] <= 1e-9:
                    continue
                feature[k], split[k], gained[f] = f, b, gained[f] + gain[f, b]
                children.append((k, bool(2 * CL[f, b] <= C)))
            if not children:
                break
            f = np.array(feature)[node]
            inner = f >= 0
            node = np.where(inner, 2 * node + 1 + (binned[f, rows] > np.array(split)[node]), -1)
            live = node >= 0
            node, rows, g, h = node[live], rows[live], g[live], h[live]
            lesser = [2 * k + (1 if left else 2) for k, left in children]
            found, before = histograms(node, rows, g, h, lesser), known
            known = {}
            for (k, left), w, own in zip(children, lesser, found):
                known[w], known[2 * k + (2 if left else 1)] = own, before[k] - own
        model.trees.append([feature, split, value])
        gains += gained / (gained.sum() or 1)
        model.add(binned, model.trees[-1], score)
    model.gains = (gains / (gains.sum() or 1)).tolist()
    return model


def packed(x: np.ndarray) -> bytes:
    return struct.pack(f"<q{x.ndim}q", x.ndim, *x.shape) + zlib.compress(x.astype("<i8").tobytes(), 1)


def unpacked(body: bytes) -> np.ndarray:
    (n,) = struct.unpack_from("<q", body)
    return np.frombuffer(zlib.decompress(body[8 + 8 * n :]), "<i8").reshape(struct.unpack_from(f"<{n}q", body, 8))


class Meeting:
    """Arrays of whole numbers of all tasks of a barrier stage, by way of the first one.

    Tasks learn its port and a secret from the barrier, whose own messages take a second each. A task that is
    gone ends the others' wait, and Spark runs the stage anew.
    """

    def __init__(self, barrier: BarrierTaskContext, patience: float = 600):
        self.peers, self.first, n = [], barrier.partitionId() == 0, len(barrier.getTaskInfos())
        if n == 1:
            return
        server = socket.create_server(("", 0), backlog=n) if self.first else None
        secret = secrets.token_hex(32)
        said = barrier.allGather(f"{server.getsockname()[1]} {secret}" if server else "")[0].split(" ")
        word = said[1].encode()
        if self.first:
            server.settimeout(patience)
            found = {}
            while len(found) < n - 1:
                peer = server.accept()[0]
                peer.settimeout(patience)
                hello = self._read(peer, len(word) + 8)
                if hmac.compare_digest(hello[8:], word):
                    found[struct.unpack("<q", hello[:8])[0]] = peer
            server.close()
            self.peers = [found[k] for k in sorted(found)]
        else:
            host = barrier.getTaskInfos()[0].address.rsplit(":", 1)[0].strip("[]")
            self.peers = [socket.create_connection((host, int(said[0])), patience)]
            self.peers[0].sendall(struct.pack("<q", barrier.partitionId()) + word)
        for p in self.peers:
            p.setsockopt(socket.IPPROTO_TCP, socket.TCP_NODELAY, 1)

    @staticmethod
    def _read(peer: socket.socket, n: int) -> bytes:
        out = bytearray()
        while len(out) < n:
            part = peer.recv(min(n - len(out), 1 << 20))
            if not part:
                raise ConnectionError("a task of the barrier stage is gone")
            out += part
        return bytes(out)

    def _get(self, peer: socket.socket) -> bytes:
        return self._read(peer, struct.unpack("<q", self._read(peer, 8))[0])

    @staticmethod
    def _put(peer: socket.socket, body: bytes) -> None:
        peer.sendall(struct.pack("<q", len(body)) + body)

    def gather(self, x: np.ndarray) -> list[np.ndarray]:
        if not self.first:
            self._put(self.peers[0], packed(x))
            return [unpacked(self._get(self.peers[0])) for _ in range(int(unpacked(self._get(self.peers[0]))[0]))]
        bodies = [packed(x), *map(self._get, self.peers)]
        for p in self.peers:
            for body in [packed(np.array([len(bodies)])), *bodies]:
                self._put(p, body)
        return [unpacked(b) for b in bodies]

    def total(self, x: np.ndarray) -> np.ndarray:
        if not self.first:
            self._put(self.peers[0], packed(x))
            return unpacked(self._get(self.peers[0]))
        for p in self.peers:
            x = x + unpacked(self._get(p))
        body = packed(x)
        for p in self.peers:
            self._put(p, body)
        return x


def fit_trees(features: DataFrame, columns: list[str], settings) -> Trees:
    """Boosted trees on label over all rows, both classes weighing the same.

    Rows are dealt to as many tasks as run at once (a barrier stage; it needs them all free, and no dynamic
    allocation). A task keeps a byte for each feature of its rows; histograms of whole numbers are added up
    between tasks at each level, so the trees don't depend on how rows are dealt.
    """
    context = features.sparkSession.sparkContext
    jvm = context._jsc.sc()
    slots = jvm.maxNumConcurrentTasks(jvm.resourceProfileManager().defaultResourceProfile())
    ids = [c for c in ("s1_id", "target_id") if c in features.columns] or columns
    narrow = features.select(*[F.col(c).cast("float").alias(c) for c in columns], F.col("label").cast("byte").alias("label"), F.xxhash64(*ids).alias("key"))
    tasks = max(1, min(slots, -(-features.count() // TASK_ROWS)))

    def stage(batches):
        held = [[np.zeros(0, np.float32)] for _ in columns], [np.zeros(0, np.int8)], [np.zeros(0, np.int64)]
        for batch in batches:
            for k, x in enumerate(held[0]):
                x.append(batch.column(k).to_numpy(zero_copy_only=False).astype(np.float32))
            held[1].append(batch.column(len(columns)).to_numpy(zero_copy_only=False).astype(np.int8))
            held[2].append(batch.column(len(columns) + 1).to_numpy(zero_copy_only=False))
        barrier = BarrierTaskContext.get()
        met = Meeting(barrier)
        model = grown([np.concatenate(x) for x in held[0]], np.concatenate(held[1]), np.concatenate(held[2]), settings, met.gather, met.total)
        if met.first:
            yield pa.RecordBatch.from_arrays([pa.array([model.text()])], names=["model"])

    return Trees.of(narrow.repartition(tasks).mapInArrow(stage, "model string", barrier=True).collect()[0]["model"])
