"""Benchmark decontamination by suffix arrays over the training texts."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import textscan
from tessera.llm.common import kept_texts, over_texts

#: Bytes of training text under one suffix array, and of benchmark text searched in one pass.
SHARD_BYTES, BENCHMARK_BYTES = 4 << 20, 4 << 20


@dataclass
class Suffixes:
    """All suffixes of a block of benchmark items, as numbers of their words; windows of equal words once, with the items that have them."""

    vocabulary: np.ndarray  # sorted hashes of the items' words; word k has number k + 1
    words: np.ndarray  # numbers of the words of all items, 0 behind each item
    start: np.ndarray  # place in `words` of each suffix
    item: np.ndarray  # its item, as a place in `names`
    need: np.ndarray  # words of the window that begins there; 0 if none does or a suffix before has it
    names: list[str]
    group: np.ndarray  # number of the items' list of the window that begins there
    items: list[np.ndarray]  # places in `names`, by that number
    depth: int  # words of a whole window
    array: np.ndarray  # places in `words`, sorted by all that follows in their items
    rank: np.ndarray  # where in `array` a place is
    low: np.ndarray  # of each window, its first row in `array`
    high: np.ndarray  # and the row past its last

    @staticmethod
    def of(names: list[str], texts: list[bytes], window: int) -> Suffixes:
        _, _, _, hashes, first = textscan.words(texts, textscan.ALNUM)
        vocabulary = np.unique(hashes)
        n = np.diff(first)
        number = np.zeros(len(hashes) + len(texts), np.int32)
        item = np.repeat(np.arange(len(texts)), n)
        start = np.arange(len(hashes)) + item
        number[start] = np.searchsorted(vocabulary, hashes) + 1
        place = np.arange(len(hashes)) - np.repeat(first[:-1], n)
        left = n[item] - place
        need = np.where(left >= window, window, np.where((n[item] < window) & (place == 0), n[item], 0))
        words = np.concatenate((number, [0]))
        # equal windows lie together once sorted by their words and their size
        own = np.flatnonzero(need)
        padded = np.concatenate((words, np.zeros(window, words.dtype)))
        columns = [np.where(need[own] > d, padded[start[own] + d], 0) for d in range(window)]
        order = own[np.lexsort([own, *columns[::-1]])] if own.size else own
        new = np.ones(len(order), bool)
        for d in range(window):
            value = np.where(need[order] > d, padded[start[order] + d], 0)
            new[1:] = (value[1:] != value[:-1]) if d == 0 else new[1:] | (value[1:] != value[:-1])
        heads = np.flatnonzero(new)
        ends = np.append(heads[1:], len(order))
        group, lists, items = np.full(len(need), -1), {}, []
        for a, b in zip(heads.tolist(), ends.tolist()):
            have = np.unique(item[order[a:b]]) if b - a > 1 else item[order[a:b]]
            key = have.tobytes()
            if key not in lists:
                lists[key] = len(items)
                items.append(have)
            group[order[a]] = lists[key]
        need = need.copy()
        need[order[~new]] = 0
        array, rank = sorted_suffixes(words)
        low, high = np.zeros(len(need), np.int64), np.zeros(len(need), np.int64)
        for a, b in zip(heads.tolist(), ends.tolist()):
            rows = rank[start[order[a:b]]]
            low[order[a]], high[order[a]] = rows.min(), rows.max() + 1
        return Suffixes(vocabulary, words, start, item, need, names, group, items, window, array, rank, low, high)


def sorted_suffixes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places, sorted by the words from each to its item's end (a 0), and each place's rank, by doubling."""
    n = len(words)
    inside = words > 0
    level = np.unique(words, return_inverse=True)[1].astype(np.int64)
    left = np.flatnonzero(~inside)
    size = (np.append(left, n)[np.searchsorted(left, np.arange(n))] - np.arange(n)) if n else np.zeros(0, np.int64)
    width, array = 1, np.argsort(level, kind="stable")
    while width <= (int(size.max()) if n else 0):
        after = np.zeros(n, np.int64)
        ahead = np.flatnonzero(size > width)
        after[ahead] = level[ahead + width] + 1
        array = np.lexsort((after, level))
        step = (level[array[1:]] != level[array[:-1]]) | (after[array[1:]] != after[array[:-1]])
        level = np.empty(n, np.int64)
        level[array] = np.concatenate(([0], np.cumsum(step)))
        width *= 2
    rank = np.empty(n, np.int64)
    rank[array] = np.arange(n)
    return array, rank


def suffix_array(words: np.ndarray, at: np.ndarray, depth: int, most: int) -> np.ndarray:
    """The places `at`, sorted by the `depth` words from each on; words are numbers up to `most`, several of which make one sort key."""
    if not len(at):
        return at
    bits = max(1, int(most).bit_length())
    each = 63 // bits
    padded = np.concatenate((words, np.zeros(depth, words.dtype))).astype(np.int64)
    keys = []
    for d in range(0, depth, each):
        key = np.zeros(len(at), np.int64)
        for k in range(d, min(d + each, depth)):
            key = (key << bits) | padded[at + k]
        keys.append(key)
    return at[np.lexsort(keys[::-1])]


def search(words: np.ndarray, array: np.ndarray, test: Suffixes, depth: int):
    """Binary-search every test suffix: (words of its longest match up to `depth`, the window's first and last row in the array).

    The rows that begin with the first d words of a test suffix are an interval; the next word narrows
    it by two binary searches over the array's words at that depth. Windows not found have no rows.
    """
    m, n = len(test.start), len(array)
    longest, low, high = np.zeros(m, np.int64), np.zeros(m, np.int64), np.zeros(m, np.int64)
    live = np.arange(m)
    lo, hi = np.zeros(m, np.int64), np.full(m, n, np.int64)
    padded = np.concatenate((words, np.zeros(depth + 1, words.dtype)))
    for d in range(depth):
        want = test.words[np.minimum(test.start[live] + d, len(test.words) - 1)]
        column = padded[array + d]
        lo, hi = _bound(column, lo, hi, want, False), _bound(column, lo, hi, want, True)
        keep = (lo < hi) & (want > 0)
        live, lo, hi = live[keep], lo[keep], hi[keep]
        if not live.size:
            break
        longest[live] = d + 1
        full = test.need[live] == d + 1
        low[live[full]], high[live[full]] = lo[full], hi[full]
    return longest, low, high


def _bound(column: np.ndarray, lo: np.ndarray, hi: np.ndarray, want: np.ndarray, right: bool) -> np.ndarray:
    """In each interval, where `want` begins (or ends) in the sorted column."""
    lo, hi = lo.copy(), hi.copy()
    top = len(column) - 1
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) >> 1
        got = column[np.minimum(mid, top)]
        less = open_ & ((got <= want) if right else (got < want))
        lo = np.where(less, mid + 1, lo)
        hi = np.where(open_ & ~less, mid, hi)


class Shard:
    """Texts of a shard as numbers of benchmark words, and the suffix array over them."""

    def __init__(self, parts: list[bytes], test: Suffixes, depth: int):
        # a block of texts at a time, since finding words takes many times a text's bytes
        some = [textscan.words(block, textscan.ALNUM)[3:] for _, block in textscan.blocks(parts)]
        hashes = np.concatenate([h for h, _ in some]) if some else np.zeros(0, np.uint64)
        self.n = np.concatenate([np.diff(first) for _, first in some]) if some else np.zeros(0, np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.n)))
        place = np.searchsorted(test.vocabulary, hashes)
        place[place == len(test.vocabulary)] = 0
        known = test.vocabulary[place] == hashes if len(test.vocabulary) else np.zeros(len(hashes), bool)
        doc = np.repeat(np.arange(len(parts)), self.n)
        self.words = np.zeros(len(hashes) + len(parts), np.int32)
        self.words[np.arange(len(hashes)) + doc] = np.where(known, place + 1, 0)
        self.begin = self.first[:-1] + np.arange(len(parts))  # a 0 between texts
        # only suffixes that begin with as many benchmark words as the shortest window has can hold one
        stops = np.flatnonzero(self.words == 0)
        size = np.diff(np.concatenate(([-1], stops, [len(self.words)])))
        ahead = np.repeat(np.concatenate((stops, [len(self.words)])), size)[: len(self.words)] - np.arange(len(self.words))
        least = int(test.need[test.need > 0].min()) if (test.need > 0).any() else 1
        self.array = suffix_array(self.words, np.flatnonzero(ahead >= least), depth, len(test.vocabulary))

    def occurrences(self, test: Suffixes, low: np.ndarray, high: np.ndarray):
        """(place in the shard's words, document, test suffix) of each window found."""
        count = high - low
        which = np.repeat(np.arange(len(low)), count)
        rows = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
        place = self.array[rows]
        return place, np.searchsorted(self.begin, place, "right") - 1, which


def benchmark_blocks(benchmark: DataFrame, window: int) -> list[Suffixes]:
    """The benchmark in blocks of about `BENCHMARK_BYTES`, read row by row; null texts have no words."""
    out, names, texts, size = [], [], [], 0
    for row in benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("binary").alias("text")).toLocalIterator():
        names.append(row["item_id"] or "")
        texts.append(bytes(row["text"] or b""))
        size += len(texts[-1])
        if size >= BENCHMARK_BYTES:
            out.append(Suffixes.of(names, texts, window))
            names, texts, size = [], [], 0
    return [*out, Suffixes.of(names, texts, window)] if names or not out else out


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Where training documents repeat windows of benchmark items.

    Words are those of the lower-cased text (A-Z) between bytes that are neither 0-9, a-z nor above
    U+007F. A window is `window` consecutive words of an item, or all of a shorter one. Returns (doc_id,
    n_words, n_hit, n_items, items_sha256, contaminated, longest): words inside any occurrence count as
    hit; longest is the longest verbatim match, in words, that holds a window (0: none).

    Texts are cut into shards of about `SHARD_BYTES` where they are read; every suffix of every item is
    binary-searched in each shard's suffix array. No shuffle. The benchmark goes to the executors in
    blocks of about `BENCHMARK_BYTES`, one pass of the same rows for each. Null or empty texts have no
    words; repeated rows give a row each; an empty benchmark hits nothing; further columns are not read.
    """
    blocks = benchmark_blocks(benchmark, window)
    df = docs.select("doc_id", "text")
    kind = df.schema["doc_id"].dataType.simpleString()
    for k, block in enumerate(blocks):
        last = k == len(blocks) - 1
        shared = df.sparkSession.sparkContext.broadcast(block)
        schema = f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, longest int" if last else f"doc_id {kind}, text string, spans array<long>, items array<string>, longest int"
        df = over_texts(df, schema, _search_block(shared, window, last), SHARD_BYTES)
    return df


def _search_block(shared, depth: int, last: bool):
    def work(rest, parts):
        test = shared.value
        shard = Shard(parts, test, depth)
        _, low, high = search(shard.words, shard.array, test, depth)
        place, doc, which = shard.occurrences(test, low, high)
        n = len(parts)
        mark = np.zeros(len(shard.words) + 1, np.int64)
        np.add.at(mark, place, 1)
        np.add.at(mark, place + test.need[which], -1)
        hit = np.cumsum(mark[:-1]) > 0
        pairs = np.unique((doc << 32) | test.group[which]) if len(doc) else np.zeros(0, np.int64)
        items: list[set[str]] = [set() for _ in range(n)]
        for p in pairs.tolist():
            items[p >> 32].update(test.names[k] for k in test.items[p & 0xFFFFFFFF].tolist())
        longest = _longest(shard, test, place, doc, which, n)
        if "spans" in rest.schema.names:  # what the blocks before found
            before = [rest.column(k).to_pylist() for k in ("spans", "items", "longest")]
            for k in range(n):
                for a, b in zip(before[0][k][0::2], before[0][k][1::2]):
                    hit[shard.begin[k] + a : shard.begin[k] + b] = True
                items[k].update(before[1][k])
            longest = np.maximum(longest, before[2])
        longest = pa.array(longest.astype(np.int32))
        if not last:
            a, b = textscan.runs(hit)
            own = np.searchsorted(shard.begin, a, "right") - 1
            spans = [[] for _ in range(n)]
            for d, x, y in zip(own.tolist(), a.tolist(), b.tolist()):
                spans[d] += [x - int(shard.begin[d]), y - int(shard.begin[d])]
            return {"doc_id": rest.column(0), "text": pa.array([p.decode() for p in parts]), "spans": pa.array(spans, pa.list_(pa.int64())), "items": pa.array([sorted(x) for x in items], pa.list_(pa.string())), "longest": longest}
        total = np.concatenate(([0], np.cumsum(hit)))
        edge = np.concatenate((shard.begin, [len(shard.words)]))
        n_hit = total[edge[1:]] - total[edge[:-1]]
        return {
            "doc_id": rest.column(0),
            "n_words": pa.array(shard.n.astype(np.int64)),
            "n_hit": pa.array(n_hit),
            "n_items": pa.array(np.fromiter(map(len, items), np.int64, n)),
            "items_sha256": pa.array([hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in items]),
            "contaminated": pa.array(n_hit > 0),
            "longest": longest,
        }

    return work


def _longest(shard: Shard, test: Suffixes, place: np.ndarray, doc: np.ndarray, which: np.ndarray, n: int) -> np.ndarray:
    """Words of the longest verbatim match in each document that holds a window.

    A place's matches in the benchmark are an interval of its sorted suffixes, which each further word
    narrows. A place whose interval is the one before's, moved on by a word, has the match before's less a word.
    """
    out = np.zeros(n, np.int64)
    if not len(place):
        return out
    np.maximum.at(out, doc, test.need[which])
    whole = np.flatnonzero(test.need[which] == test.depth)
    if not whole.size:
        return out
    at = np.argsort(place[whole], kind="stable")
    p, d, w = place[whole][at], doc[whole][at], which[whole][at]
    lo, hi = test.low[w], test.high[w]
    follows = np.zeros(len(p), bool)
    follows[1:] = (p[1:] == p[:-1] + 1) & (hi[1:] - lo[1:] == hi[:-1] - lo[:-1])
    inside = test.rank[np.minimum(test.array[lo[:-1]] + 1, len(test.rank) - 1)]
    follows[1:] &= (inside >= lo[1:]) & (inside < hi[1:])
    p, d, lo, hi = p[~follows], d[~follows], lo[~follows], hi[~follows]
    padded, depth = np.concatenate((test.words, [0])), test.depth
    live = np.arange(len(p))
    while live.size:
        np.maximum.at(out, d[live], depth)
        want = shard.words[np.minimum(p[live] + depth, len(shard.words) - 1)]
        column = padded[np.minimum(test.array + depth, len(padded) - 1)]
        a, b = _bound(column, lo[live], hi[live], want, False), _bound(column, lo[live], hi[live], want, True)
        keep = (a < b) & (want > 0) & (p[live] + depth < len(shard.words))
        live = live[keep]
        lo[live], hi[live] = a[keep], b[keep]
        depth += 1
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The documents, all their columns, without those that repeat a window of the benchmark; see `contamination`. Block after block of the benchmark takes its documents out."""
    for block in benchmark_blocks(benchmark, window):
        docs = kept_texts(docs, _clean(docs.sparkSession.sparkContext.broadcast(block), window), SHARD_BYTES)
    return docs


def _clean(shared, depth: int):
    def keep(parts):
        shard = Shard(parts, shared.value, depth)
        _, low, high = search(shard.words, shard.array, shared.value, depth)
        _, doc, _ = shard.occurrences(shared.value, low, high)
        out = np.ones(len(parts), bool)
        out[doc] = False
        return out

    return keep
