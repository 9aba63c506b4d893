"""Byte-level BPE over whole batches.

Pre-token boundaries of a byte-level BPE are a function of the classes (letter, number, space,
other white space, rest) of neighbouring characters, so they are found for a batch by array
operations. Classes are asked of the library itself, one code point at a time, when first seen.
Merges never cross those boundaries, so `Encoder` runs them once for each distinct pre-token and
gathers the ids. Both equal the library's results; the tests hold them against it. Whole texts
through the library itself take about 1,000 CPU seconds a GB.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

from tessera.llm import textscan

LETTER, NUMBER, OTHER, SPACE, WHITE, UNSEEN = 1, 2, 3, 4, 5, 0
#: Distinct pre-tokens kept by a worker between batches; beyond it the store starts anew.
KEPT = 600_000
#: Bytes of a pre-token beyond which the library itself merges it, in time that grows about as its length.
LONG = 128
#: Pre-tokens encoded at once, of a text or of many; fewer than the store's slots even if all are new.
RUN = 500_000


@lru_cache(maxsize=2)
def library(path: str):
    """The library's tokenizer of a vocabulary file, one per Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def byte_symbols() -> dict[str, int]:
    """The printable characters that stand for bytes in a byte-level vocabulary.

    Printable Latin-1 stands for itself; the other bytes follow from U+0100 on, in order.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class Splitter:
    """Pre-token boundaries of joined UTF-8 texts."""

    def __init__(self, path: str):
        self.tokenizer = library(path)
        self.split = self.tokenizer.pre_tokenizer
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.find = re.compile(b"|".join(re.escape(s.encode()) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.classes = np.zeros(0x110000, np.uint8)
        self._learn(np.arange(1, 128))
        self.classes[0] = self._ask(0)
        self.ascii = np.zeros(256, np.uint8)
        self.ascii[:128] = self.classes[:128]

    def _ask(self, code: int) -> int:
        """The class of a code point, from what the library joins it with."""
        c = chr(code)
        if c == " ":
            return SPACE
        pieces = lambda s: len(self.split.pre_tokenize_str(s))
        if pieces("a" + c) == 1:
            return LETTER
        if pieces("1" + c) == 1:
            return NUMBER
        if pieces("!" + c) == 1:
            return OTHER
        return WHITE

    def whole(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of pre-tokens by the library."""
        return [x.ids for x in self.tokenizer.encode_batch([p.decode() for p in pieces], add_special_tokens=False)]

    def _learn(self, codes: np.ndarray) -> None:
        for c in codes:
            self.classes[c] = self._ask(int(c))

    def byte_classes(self, data: np.ndarray) -> np.ndarray:
        """The class of the character that each byte belongs to."""
        cls = self.ascii[data]
        for low, high, size, mask in ((0xC0, 0xE0, 2, 0x1F), (0xE0, 0xF0, 3, 0x0F), (0xF0, 0xF8, 4, 0x07)):
            lead = np.flatnonzero((data >= low) & (data < high))
            if not lead.size:
                continue
            code = (data[lead] & mask).astype(np.int64)
            for k in range(1, size):
                code = (code << 6) | (data[lead + k] & 0x3F)
            got = self.classes[code]
            if (got == UNSEEN).any():
                self._learn(np.unique(code[got == UNSEEN]))
                got = self.classes[code]
            for k in range(size):
                cls[lead + k] = got
        return cls

    def starts(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bytes of all texts, text starts with the end appended, pre-token starts, special id or -1 of each pre-token)."""
        lengths = np.fromiter((len(p) for p in parts), np.int64, len(parts))
        edges = np.concatenate(([0], np.cumsum(lengths)))
        blob = b"".join(parts)
        data = np.frombuffer(blob, np.uint8)
        n = data.size
        if not n:
            return data, edges, np.zeros(0, np.int64), np.zeros(0, np.int64)
        cls = self.byte_classes(data)
        head = (data & 0xC0) != 0x80
        cut = np.zeros(n + 1, bool)  # a text or a piece between special strings begins here
        cut[edges] = True
        found = [(m.start(), m.end(), self.special[m.group().decode()]) for m in self.find.finditer(blob)] if self.find else []
        if found:  # not across the edge of two texts
            side = np.searchsorted(edges, [a for a, _, _ in found], "right") - 1
            found = [x for x, k in zip(found, side, strict=True) if x[1] <= edges[k + 1]]
        for a, b, _ in found:
            cut[a] = cut[b] = True
        fresh = cut[:n]
        prev = np.empty(n, np.uint8)
        prev[0] = UNSEEN
        prev[1:] = cls[:-1]
        prev[fresh] = UNSEEN
        white = cls >= SPACE
        # the class of the character after this one; UNSEEN at the end of a piece (characters of white space of several bytes look past themselves)
        begin = (prev != cls) & (prev != SPACE) & ~(white & (prev >= SPACE))
        late = np.flatnonzero(white & (prev >= SPACE) & head)
        if late.size:  # the last white space before something solid stands alone or leads the next pre-token
            size = np.where(data[late] < 0x80, 1, np.where(data[late] < 0xE0, 2, 3))
            after = late + size
            inside = after < n
            solid = np.zeros(late.size, bool)
            solid[inside] = (cls[after[inside]] < SPACE) & ~cut[after[inside]]
            begin[late] = solid
        begin &= head
        begin |= fresh
        quote = np.flatnonzero((data == 0x27) & begin & (prev != SPACE))
        if quote.size:
            pad = np.concatenate((data, np.zeros(3, np.uint8)))
            one, two = pad[quote + 1], pad[quote + 2]
            stop1, stop2 = cut[np.minimum(quote + 1, n)], cut[np.minimum(quote + 2, n)]
            single = np.isin(one, np.frombuffer(b"stmd", np.uint8)) & ~stop1
            double = (((one == 0x72) & (two == 0x65)) | ((one == 0x76) & (two == 0x65)) | ((one == 0x6C) & (two == 0x6C))) & ~stop1 & ~stop2
            for at, size in ((quote[single], 2), (quote[double], 3)):
                for k in range(1, size):
                    begin[at + k] = False
                end = at + size
                begin[end[end < n]] = True
        kinds = None
        if found:
            for a, b, _ in found:
                begin[a + 1 : b] = False
        at = np.flatnonzero(begin)
        kinds = np.full(at.size, -1, np.int64)
        if found:
            kinds[np.searchsorted(at, [a for a, _, _ in found])] = [i for _, _, i in found]
        return data, edges, at, kinds


class Table:
    """Numbers by 64-bit key: open addressing over arrays, whole arrays of keys at a time."""

    def __init__(self, bits: int):
        self.bits, self.size = bits, 0
        self.key, self.value = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The numbers of the keys; -1 where there is none."""
        slot = self._slots(keys)
        out = self.value.take(slot)
        off = np.flatnonzero((self.key.take(slot) != keys) & (out >= 0))
        while off.size:
            slot[off] = (slot[off] + 1) & (len(self.key) - 1)
            out[off] = self.value[slot[off]]
            off = off[(self.key[slot[off]] != keys[off]) & (out[off] >= 0)]
        return out

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add keys, each once, that aren't here."""
        slot, todo = self._slots(keys), np.arange(len(keys))
        self.size += len(keys)
        while todo.size:
            free = self.value[slot[todo]] < 0
            one, at = np.unique(slot[todo[free]], return_index=True)
            won = todo[free][at]
            self.key[one], self.value[one] = keys[won], values[won]
            todo = np.setdiff1d(todo, won, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & (len(self.key) - 1)


class Merges:
    """The merges of a byte-level BPE, run over many pre-tokens side by side."""

    def __init__(self, path: str):
        model = json.load(open(path, encoding="utf-8"))["model"]
        vocabulary = model["vocab"]
        self.single = np.zeros(256, np.int32)
        for c, b in byte_symbols().items():
            self.single[b] = vocabulary[c]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        key = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in pairs], np.uint64)
        key, first = np.unique(key, return_index=True)
        self.table = Table(18)
        self.table.put(key, first.astype(np.int32))
        self.made = np.array([vocabulary[a + b] for a, b in pairs], np.int32)

    def run(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens that lie one after the other in `data`, and how many each has.

        In each round every pre-token joins its pair of the lowest rank, wherever it stands, from the left.
        """
        ids, word = self.single[data], np.repeat(np.arange(len(lengths)), lengths)
        done = []
        while ids.size:
            inner = word[1:] == word[:-1]
            rank = np.full(ids.size, 1 << 30, np.int64)
            at = np.flatnonzero(inner)
            got = self.table.get((ids[at].astype(np.uint64) << np.uint64(32)) | ids[at + 1].astype(np.uint64))
            rank[at[got >= 0]] = got[got >= 0]
            begin = np.flatnonzero(np.concatenate(([True], ~inner)))
            best = np.minimum.reduceat(rank, begin)
            size = np.diff(np.concatenate((begin, [ids.size])))
            ended = best == 1 << 30
            if ended.any():
                over = np.repeat(ended, size)
                done.append((word[over], ids[over]))
                ids, word, rank = ids[~over], word[~over], rank[~over]
                best, size = best[~ended], size[~ended]
            if not ids.size:
                break
            hit = rank == np.repeat(best, size)
            first, last = textscan.runs(hit)  # in a run of hits, as for `aaa`, every other one
            if (last - first > 1).any():
                where = np.flatnonzero(hit)
                hit[where] = ((where - np.repeat(first, last - first)) & 1) == 0
            where = np.flatnonzero(hit)
            ids[where] = self.made[rank[where]]
            keep = np.ones(ids.size, bool)
            keep[where + 1] = False
            ids, word = ids[keep], word[keep]
        if not done:
            return np.zeros(0, np.uint16), np.zeros(len(lengths), np.int64)
        word, ids = np.concatenate([w for w, _ in done]), np.concatenate([i for _, i in done])
        return ids[np.argsort(word, kind="stable")].astype(np.uint16), np.bincount(word, minlength=len(lengths))


class Encoder:
    """Token ids of whole texts, as the library gives them without added special tokens.

    A worker keeps the ids of the distinct pre-tokens it has met, by hash; new ones are merged side by side.
    """

    def __init__(self, path: str):
        self.splitter, self.merges = Splitter(path), Merges(path)
        self._forget()

    def _forget(self) -> None:
        self.known = Table(21)
        self.offset, self.count = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int32)
        self.ids, self.used = np.zeros(1 << 18, np.uint16), 0

    def _number(self, hashes: np.ndarray, data: np.ndarray, at: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The store's number of each pre-token; new ones are added."""
        number = self.known.get(hashes)
        lost = np.flatnonzero(number < 0)
        if not lost.size:
            return number
        new, first = np.unique(hashes[lost], return_index=True)
        if self.known.size + len(new) > KEPT and self.known.size:
            self._forget()
            return self._number(hashes, data, at, ends)
        where = lost[first]
        lengths = ends[where] - at[where]
        before = np.cumsum(lengths) - lengths
        flat = data[np.arange(int(lengths.sum())) + np.repeat(at[where] - before, lengths)]
        ids, count = self._merged(flat, lengths)
        base = self.known.size
        while base + len(new) > len(self.offset):
            self.offset, self.count = (np.concatenate((x, np.zeros_like(x))) for x in (self.offset, self.count))
        while self.used + ids.size > self.ids.size:
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        self.ids[self.used : self.used + ids.size] = ids
        self.offset[base : base + len(new)] = self.used + np.cumsum(count) - count
        self.count[base : base + len(new)] = count
        self.used += ids.size
        self.known.put(new, np.arange(base, base + len(new), dtype=np.int32))
        return self.known.get(hashes)

    def _merged(self, flat: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens that lie one after the other, and how many each has."""
        long_ = lengths > LONG
        if not long_.any():
            return self.merges.run(flat, lengths)
        end = np.cumsum(lengths)
        ids, count = self.merges.run(flat[np.repeat(~long_, lengths)], lengths[~long_])
        got = self.splitter.whole([flat[a:b].tobytes() for a, b in zip((end - lengths)[long_].tolist(), end[long_].tolist())])
        both = np.zeros(len(lengths), np.int64)
        both[~long_], both[long_] = count, [len(x) for x in got]
        out, short = np.empty(int(both.sum()), np.uint16), np.repeat(~long_, both)
        out[short], out[~short] = ids, np.concatenate([np.array(x, np.uint16) for x in got])
        return out, both

    def encode(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the place where each text's begin (with the end appended)."""
        data, edges, at, special = self.splitter.starts(parts)
        if not at.size:
            return np.zeros(0, np.uint16), np.zeros(len(parts) + 1, np.int64)
        ends = np.concatenate((at[1:], [data.size]))
        runs = [self._ids(data, at[k : k + RUN], ends[k : k + RUN], special[k : k + RUN]) for k in range(0, at.size, RUN)]
        before = np.concatenate(([0], np.cumsum(np.concatenate([count for _, count in runs]))))
        return np.concatenate([out for out, _ in runs]), before[np.searchsorted(at, edges)]

    def _ids(self, data: np.ndarray, at: np.ndarray, ends: np.ndarray, special: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a run of pre-tokens, one after the other, and how many each has."""
        number = self._number(textscan.span_hashes(data, at, ends), data, at, ends)
        offset, count = self.offset[number], self.count[number].astype(np.int64)
        odd = np.flatnonzero(special >= 0)
        count[odd] = 1
        before = np.concatenate(([0], np.cumsum(count)))
        source = np.repeat(offset - before[:-1], count) + np.arange(int(before[-1]))
        out = self.ids.take(source, mode="clip")
        out[before[odd]] = special[odd]
        return out, count


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per Python worker and vocabulary file."""
    return Encoder(path)
