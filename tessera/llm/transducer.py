"""A byte-level BPE compiled, as texts need it, into a deterministic finite-state transducer.

Input symbols are bytes; each transition is annotated with the number of tokens it emits, the
change of the token count of the prefix read (a byte may also take a token back: merges join
tokens). A state holds, for every suffix of the bytes read that a token may still grow from, the
last token before that suffix and how many tokens back that place lies. That is all that decides
which token the next byte ends: a sequence of tokens is the BPE's own exactly when each pair of
neighbours is. Suffixes and counts are bounded by the longest token, so the states are finite;
only those that texts reach are built, and past `MOST_STATES` the table starts anew.

Long inputs are cut into chunks that run side by side. A chunk's state map is constant from its
first pre-token boundary on, since a boundary leads every state to the start; what lies before it
depends on the entry state. Of a chunk without any boundary the map is known, at first, for the start
state only. The maps are composed by a prefix scan over the chunks in rounds: each chunk's exit is the
entry of the next, and all chunks whose entry is another than the one they are known for run again, side
by side, until they meet the states of their run before, after a few bytes mostly; a round's changed exits
are the next round's entries. Pre-tokens of over `LONG` bytes are counted by the library.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np

from tessera.llm.bytelevel import Splitter, byte_symbols

START, WAITING = 0, 1
MOST_STATES = 200_000
#: Slots for transitions at first; a run that needs more doubles them. Longer inputs are cut at pre-tokens into runs of about as many bytes.
SLOTS = 1 << 21
CHUNK = 512
#: Bytes of a pre-token beyond which the library itself counts its tokens.
LONG = 1 << 16

_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def _pack(node: int, last: int, back: int) -> int:
    """A suffix in a state: its node in the trie, the token before it (-1: none) and minus the tokens since."""
    return (node << 24) | ((last + 1) << 8) | (back + 128)


class Transducer:
    def __init__(self, path: str):
        self.splitter = Splitter(path)
        model = json.load(open(path, encoding="utf-8"))["model"]
        symbols = byte_symbols()
        as_bytes = lambda s: bytes(symbols[c] for c in s)
        self.vocabulary = {as_bytes(s): i for s, i in model["vocab"].items()}
        self.text = {i: s for s, i in self.vocabulary.items()}
        self.length = np.zeros(max(self.text) + 2, np.int64)
        for i, s in self.text.items():
            self.length[i] = len(s)
        self.merges, self.halves, self.rank = {}, {}, dict.fromkeys(self.text, -1)
        for rank, pair in enumerate(model["merges"]):
            a, b = map(as_bytes, pair.split(" ") if isinstance(pair, str) else pair)
            x, y, z = self.vocabulary[a], self.vocabulary[b], self.vocabulary[a + b]
            self.merges[x, y] = (rank, z)
            if z not in self.halves:
                self.rank[z], self.halves[z] = rank, (x, y)
        self.single = [self.vocabulary[bytes([b])] for b in range(256)]
        self._pairs: dict[tuple[int, int], bool] = {}
        # trie of the tokens that the merges can reach: node -> byte -> node, node -> token or -1
        self.child: list[dict[int, int]] = [{}]
        self.token = [-1]
        for s, i in self.vocabulary.items():
            if self.merged(s) != [i]:
                continue
            node = 0
            for b in s:
                nxt = self.child[node].get(b)
                if nxt is None:
                    nxt = self.child[node][b] = len(self.child)
                    self.child.append({})
                    self.token.append(-1)
                node = nxt
            self.token[node] = i
        self._forget()

    def merged(self, piece: bytes) -> list[int]:
        """The BPE by its definition: the pair of the lowest rank first."""
        ids = [self.single[b] for b in piece]
        while len(ids) > 1:
            best = min(((self.merges[p][0], k) for k, p in enumerate(zip(ids, ids[1:])) if p in self.merges), default=None)
            if best is None:
                break
            pair = ids[best[1]], ids[best[1] + 1]
            new, k, out = self.merges[pair][1], 0, []
            while k < len(ids):
                if k + 1 < len(ids) and (ids[k], ids[k + 1]) == pair:
                    out.append(new)
                    k += 2
                else:
                    out.append(ids[k])
                    k += 1
            ids = out
        return ids

    def neighbours(self, a: int, b: int) -> bool:
        """Whether the BPE keeps token b after token a.

        Undoes their merges, latest first; the BPE would have joined the two sides if at some point
        a merge across the border came before the one just undone (or, at the same rank, stood left of it).
        """
        got = self._pairs.get((a, b))
        if got is None:
            if len(self._pairs) > MOST_STATES:
                self._pairs.clear()
            x, y, limit, got = a, b, 1 << 30, True
            while True:
                across = self.merges.get((x, y))
                if across is not None and across[0] < limit:
                    got = False
                    break
                p, q = self.rank[x], self.rank[y]
                if p < 0 and q < 0:
                    break
                if p > q:
                    limit, x = p, self.halves[x][1]
                else:
                    limit, y = q + 1, self.halves[y][0]
            self._pairs[a, b] = got
        return got

    def _forget(self) -> None:
        self.number: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.last = np.zeros(1 << 16, np.int32)
        # transitions by open addressing: key = state << 8 | byte; value = next state << 8 | (tokens emitted + 128)
        self.keys = np.full(SLOTS, -1, np.int64)
        self.values = np.zeros(SLOTS, np.int32)
        self.filled = 0
        self.shift = np.uint64(65 - SLOTS.bit_length())
        self._state((_pack(0, -1, 0),))
        self._state((-1,))

    def _slots(self, at: np.ndarray) -> np.ndarray:
        return ((at.astype(np.uint64) * _SPREAD) >> self.shift).astype(np.int64)

    def _grow(self) -> None:
        """Twice the slots; values become wide enough for any number of states."""
        held = np.flatnonzero(self.keys != -1)
        keys, values = self.keys[held], self.values[held]
        size = 2 * len(self.keys)
        self.keys, self.values = np.full(size, -1, np.int64), np.zeros(size, np.int64)
        self.shift = self.shift - np.uint64(1)
        slot, todo = self._slots(keys), np.arange(len(keys))
        while todo.size:
            free = self.keys[slot[todo]] == -1
            one, at = np.unique(slot[todo[free]], return_index=True)
            won = todo[free][at]
            self.keys[one], self.values[one] = keys[won], values[won]
            todo = np.setdiff1d(todo, won, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & (size - 1)

    def _state(self, key: tuple) -> int:
        got = self.number.get(key)
        if got is None:
            got = self.number[key] = len(self.states)
            self.states.append(key)
            if got >= len(self.last):
                self.last = np.concatenate((self.last, np.zeros(self.last.size, np.int32)))
            self.last[got] = ((key[0] >> 8) & 0xFFFF) - 1
        return got

    def _compile(self, at: int) -> None:
        """Build the transition of (state, byte) number `at`."""
        if at >> 8 == WAITING:
            to, emitted = WAITING, 0
        else:
            byte, child, tokens = at & 255, self.child, self.token
            grown, token, emitted = [], -1, 0
            for entry in self.states[at >> 8]:
                nxt = child[entry >> 24].get(byte)
                if nxt is None:
                    continue
                t, last = tokens[nxt], ((entry >> 8) & 0xFFFF) - 1
                if token < 0 and t >= 0 and (last < 0 or self.neighbours(last, t)):
                    token, emitted = t, (entry & 255) - 128 + 1
                if child[nxt]:
                    grown.append((nxt << 24) | (entry & 0xFFFFFF))
            to = self._state((_pack(0, token, 0), *(e - emitted for e in grown)))
        slot = ((at * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF) >> int(self.shift)
        while self.keys[slot] != -1:
            slot = (slot + 1) & (len(self.keys) - 1)
        self.keys[slot], self.values[slot] = at, (to << 8) | (emitted + 128)
        self.filled += 1

    def _find(self, at: np.ndarray) -> np.ndarray:
        """Slots of transitions; those not yet built are built."""
        slot = self._slots(at)
        key = self.keys.take(slot)
        off = np.flatnonzero(key != at)
        while off.size:
            lost = off[key[off] == -1]
            if lost.size:
                for x in np.unique(at[lost]).tolist():
                    self._compile(x)
                slot[lost] = self._slots(at[lost])
            step = off[key[off] != -1]
            slot[step] = (slot[step] + 1) & (len(self.keys) - 1)
            key[off] = self.keys.take(slot[off])
            off = off[key[off] != at[off]]
        return slot

    def _run(self, data: np.ndarray, fresh: np.ndarray, entry: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Lanes in lock step over `data` (steps x lanes); fresh: 0 where a pre-token begins, else 1. Returns the exit states."""
        s = entry.astype(np.int64)
        for i in range(len(data)):
            while self.filled + len(s) > len(self.keys) // 4 * 3:  # a lane builds one transition at most
                self._grow()
            v = self.values.take(self._find(((s * fresh[i]) << 8) | data[i]))
            values[i] = v
            s = (v >> 8).astype(np.int64)
        return s

    def scan(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """State after each byte, and tokens emitted by each byte; pre-tokens begin at `at`."""
        if len(self.states) > MOST_STATES or self.filled > SLOTS // 2:
            self._forget()
        n = data.size
        lanes = -(-n // CHUNK)
        size = lanes * CHUNK
        padded = np.zeros(size, np.uint8)
        padded[:n] = data
        fresh = np.ones(size, np.int8)
        fresh[at] = 0
        fresh[n:] = 0
        turn = lambda x: np.ascontiguousarray(x.reshape(lanes, CHUNK).T)
        values = np.zeros((CHUNK, lanes), np.int32 if n <= 1 << 22 else np.int64)
        steps, flags = turn(padded), turn(fresh)
        begins = fresh.reshape(lanes, CHUNK) == 0
        first = np.where(begins.any(1), begins.argmax(1), CHUNK)
        entry = np.where(first == CHUNK, START, WAITING)
        exits = self._run(steps, flags, entry, values)
        values = np.ascontiguousarray(values.T)
        todo = np.flatnonzero(first > 0)
        while todo.size:
            todo = todo[exits[todo - 1] != entry[todo]]
            if not todo.size:
                break
            entry[todo] = exits[todo - 1]
            live, state, changed = todo, entry[todo].astype(np.int64), []
            for i in range(int(first[todo].max())):
                while self.filled + len(live) > len(self.keys) // 4 * 3:
                    self._grow()
                v = self.values.take(self._find(((state * flags[i, live]) << 8) | steps[i, live]))
                met = (values[live, i] >> 8) == (v >> 8)
                values[live, i], state = v, (v >> 8).astype(np.int64)
                over = first[live] == i + 1
                out = over & ~met & (first[live] == CHUNK)
                exits[live[out]] = state[out]
                changed.append(live[out])
                keep = ~met & ~over
                live, state = live[keep], state[keep]
                if not live.size:
                    break
            todo = np.concatenate(changed) + 1
            todo = todo[todo < lanes]
            todo = todo[first[todo] > 0]
        values = values.ravel()[:n]
        return values >> 8, (values & 255) - 128

    def _scanned(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Last token of the state after each byte, and tokens emitted by each byte, in runs of pre-tokens: the table may start anew between them."""
        cuts = np.flatnonzero(np.diff(at // SLOTS)) + 1
        last, emits = [], []
        for own in np.split(at, cuts):
            end = at[np.searchsorted(at, own[-1]) + 1] if own[-1] < at[-1] else data.size
            states, emitted = self.scan(data[own[0] : end], own - own[0])
            last.append(self.last[states])
            emits.append(emitted)
        return np.concatenate(last), np.concatenate(emits)

    def counts(self, parts: list[bytes]) -> np.ndarray:
        """Number of tokens of each text."""
        data, edges, at, special = self.splitter.starts(parts)
        if not at.size:
            return np.zeros(len(parts), np.int64)
        size = np.diff(np.concatenate((at, [data.size])))
        long_ = np.flatnonzero(size > LONG)
        out = np.zeros(len(parts), np.int64)
        if long_.size:
            doc = np.searchsorted(edges, at[long_], "right") - 1
            np.add.at(out, doc, [len(x) for x in self.splitter.whole([data[at[k] : at[k] + size[k]].tobytes() for k in long_.tolist()])])
            keep = np.ones(at.size, bool)
            keep[long_] = False
            place = np.concatenate(([0], np.cumsum(np.repeat(keep, size))))
            data, edges, at, special = data[np.repeat(keep, size)], place[edges], place[at[keep]], special[keep]
            if not at.size:
                return out
        _, emits = self._scanned(data, at)
        total = np.concatenate(([0], np.cumsum(emits, dtype=np.int64)))
        out += total[edges[1:]] - total[edges[:-1]]
        for k in np.flatnonzero(special >= 0):  # one token instead of those of its bytes
            end = at[k + 1] if k + 1 < at.size else data.size
            out[np.searchsorted(edges, at[k], "right") - 1] += 1 - (total[end] - total[at[k]])
        return out

    def encode(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text's begin (with the end appended)."""
        data, edges, at, special = self.splitter.starts(parts)
        if not at.size:
            return np.zeros(0, np.uint16), np.zeros(len(parts) + 1, np.int64)
        last, emits = self._scanned(data, at)
        total = np.concatenate(([0], np.cumsum(emits, dtype=np.int64)))
        ends = np.concatenate((at[1:], [data.size]))
        count = total[ends] - total[at]
        odd = np.flatnonzero(special >= 0)
        count[odd] = 1
        before = np.concatenate(([0], np.cumsum(count)))
        out = np.empty(int(before[-1]), np.uint16)
        # from the last byte of each pre-token back: the state's last token, then the state before it
        place, slot, low = ends - 1, before[1:] - 1, at
        if odd.size:
            keep = special < 0
            out[before[odd]] = special[odd]
            place, slot, low = place[keep], slot[keep], low[keep]
        while place.size:
            ids = last[place]
            out[slot] = ids
            place = place - self.length[ids]
            more = place >= low
            place, slot, low = place[more], slot[more] - 1, low[more]
        return out, before[np.searchsorted(at, edges)]


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    """One per Python worker and vocabulary file."""
    return Transducer(path)
