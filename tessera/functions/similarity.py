"""Similarities of two texts: column expressions, and Arrow UDFs where dynamic programming is needed.

In all of them null is the empty text. Values are shares from 0 to 1. Choices where sources differ: two
empty texts have Jaro-Winkler, Indel and partial ratio 1 and token-set ratio 0.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import tokens


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence, 64 and more rows at a time in the bits of one number (Hyyro 2004)."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 0
    where: dict[str, int] = {}
    for k, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << k
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        u = v & where.get(c, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def indel_ratio(a: str, b: str) -> float:
    """Twice the longest common subsequence over both lengths."""
    total = len(a) + len(b)
    return 2 * lcs_length(a, b) / total if total else 1.0


def jaro_winkler(a: str, b: str) -> float:
    """Jaro, raised by a tenth of what is missing for each of up to four equal first characters where it is over 0.7."""
    if not a or not b:
        return float(a == b)
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    # four bytes a character; what is used up of b is a number that no character has
    kind = "ascii" if a.isascii() and b.isascii() else "utf-32-le"
    wide = 1 if kind == "ascii" else 4
    x, y = a.encode(kind, "surrogatepass"), bytearray(b.encode(kind, "surrogatepass"))
    gone, left, places = b"\xff" * wide, [], []
    for i in range(len(a)):
        c, end = x[i * wide : (i + 1) * wide], (i + reach + 1) * wide
        j = y.find(c, max(0, i - reach) * wide, end)
        while j % wide and j > 0:  # within a character
            j = y.find(c, j + 1, end)
        if j >= 0:
            y[j : j + wide] = gone
            left.append(a[i])
            places.append(j // wide)
    m = len(left)
    if not m:
        return 0.0
    swaps = sum(c != b[j] for c, j in zip(left, sorted(places))) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    if jaro <= 0.7:
        return jaro
    same = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        same += 1
    return jaro + same * 0.1 * (1 - jaro)


def token_sort_ratio(a: str, b: str) -> float:
    """X5."""
    return indel_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    """The best of what both share against either side and both sides; 1 if one side's words are all of the other's."""
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, only_x, only_y = sorted(x & y), sorted(x - y), sorted(y - x)
    if both and (not only_x or not only_y):
        return 1.0
    left, right = " ".join(both + only_x), " ".join(both + only_y)
    best = indel_ratio(left, right)
    if both:
        core = " ".join(both)
        best = max(best, indel_ratio(core, left), indel_ratio(core, right))
    return best


#: Texts of both sides together that are combed by array operations, and cells of a step; longer ones are worked one by one.
COMBED, STEP = 4_000, 1 << 16


def _letters(texts: list[str], longest: int, fill: int) -> np.ndarray:
    """(place, text) of code points, `fill` after a text's end."""
    out = np.full((len(texts), longest), fill, np.uint32)
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    out[np.arange(longest) < size[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.ascontiguousarray(out.T)


def _combed(a: list[str], b: list[str]) -> np.ndarray:
    """(place in b, pair): the strand that ends below each character of b when all pairs are combed at once (Tiskin's semi-local LCS).

    Strands are numbered from the left edge's foot upwards, len(a) of them in the longest, then along b. Cells of an
    antidiagonal meet different strands. Where characters differ, the greater strand goes on below, as strands
    cross once at most; where they agree, both turn.
    """
    m, n = max(map(len, a)), max(map(len, b))
    x, y = _letters(a, m, 0x110000)[::-1].copy(), _letters(b, n, 0x110001)
    letters = np.unique(np.concatenate([x.ravel(), y.ravel()]))
    kind = np.uint8 if m + n < 256 and len(letters) < 256 else np.uint16
    x, y = (np.searchsorted(letters, t).astype(kind) for t in (x, y))
    across, down = (np.repeat(np.arange(i, j, dtype=kind)[:, None], len(a), axis=1) for i, j in ((0, m), (m, m + n)))
    for d in range(m + n - 1):
        first, last = max(0, d - n + 1), min(d, m - 1)
        i, j = slice(m - 1 - last, m - first), slice(d - last, d - first + 1)
        h, v = across[i], down[j]
        equal = (x[i] == y[j]).view(np.uint8).astype(kind)
        np.negative(equal, out=equal)
        equal |= h
        np.minimum(equal, v, out=equal)
        v ^= h
        v ^= equal
        h[:] = equal
    return down


def _groups(a: list[str], b: list[str]):
    """Numbers of pairs of similar lengths, few enough for a step each."""
    size = [(len(x), len(y)) for x, y in zip(a, b)]
    order = sorted(range(len(a)), key=size.__getitem__)
    some, m, n = [], 0, 0
    for k in order:
        m, n = max(m, size[k][0]), max(n, size[k][1])
        if some and ((len(some) + 1) * (m + 8) > STEP or (len(some) + 1) * (m + n) > 16 * STEP):
            yield some
            some, (m, n) = [], size[k]
        some.append(k)
    if some:
        yield some


def _in_order(a: list[str], b: list[str], alone):
    """The results so far, with those of pairs that aren't combed, and the others' numbers, shorter text first."""
    out, rest = np.zeros(len(a)), []
    for k, (x, y) in enumerate(zip(a, b)):
        if x and y and len(x) + len(y) <= COMBED:
            rest.append(k)
        else:
            out[k] = alone(x, y)
    pairs = [(a[k], b[k]) if len(a[k]) <= len(b[k]) else (b[k], a[k]) for k in rest]
    return out, np.array(rest, np.int64), [x for x, _ in pairs], [y for _, y in pairs]


def indel_ratios(a: list[str], b: list[str]) -> np.ndarray:
    """`indel_ratio` of many pairs."""
    out, at, x, y = _in_order(a, b, indel_ratio)
    for some in _groups(x, y):
        left, right = [x[k] for k in some], [y[k] for k in some]
        m = max(map(len, left))
        short, long_ = (np.array([len(t) for t in s], np.int64) for s in (left, right))
        down = _combed(left, right)
        # strands from above that end below a text's own characters are characters without a partner
        lone = ((down >= m) & (np.arange(len(down))[:, None] < long_)).sum(0)
        out[at[some]] = 2 * (long_ - lone) / (short + long_)
    return out


def partial_ratios(a: list[str], b: list[str]) -> np.ndarray:
    """`partial_ratio` of many pairs: one combing has the common subsequences of the shorter text and all windows."""
    out, at, x, y = _in_order(a, b, partial_ratio)
    for some in _groups(x, y):
        left, right = [x[k] for k in some], [y[k] for k in some]
        m, every = max(map(len, left)), np.arange(len(some))
        short, long_ = (np.array([len(t) for t in s], np.int64) for s in (left, right))
        down = _combed(left, right).astype(np.int64) - m
        n = len(down)
        ends = np.full((n, len(some)), n, np.int64)  # where the strand from above each character ends
        place, pair = np.nonzero(down >= 0)
        ends[down[place, pair], pair] = place
        begin, end, lone, best = np.zeros(len(some), np.int64), np.zeros(len(some), np.int64), np.zeros(len(some), np.int64), np.zeros(len(some))
        for t in range(1, int((short + long_).max())):
            # the window from `begin` to `end`, at most `short` long, a character further
            drop = (t > short) & (begin < long_)
            lone -= drop & (ends[np.minimum(begin, n - 1), every] < end)
            begin += drop
            if t <= n:
                lone += (t <= long_) & (down[t - 1] >= begin)
            end = np.minimum(t, long_)
            size = end - begin
            np.maximum(best, np.where(size > 0, 2 * (size - lone) / (short + size), 0), out=best)
        out[at[some]] = best
    return out


def token_sort_ratios(a: list[str], b: list[str]) -> np.ndarray:
    """`token_sort_ratio` of many pairs."""
    return indel_ratios([" ".join(sorted(x.split())) for x in a], [" ".join(sorted(x.split())) for x in b])


def token_set_ratios(a: list[str], b: list[str]) -> np.ndarray:
    """`token_set_ratio` of many pairs; what both share begins either side, so only the sides are compared."""
    out, left, right, at, core = np.zeros(len(a)), [], [], [], []
    for k, (x, y) in enumerate(zip(a, b)):
        x, y = set(x.split()), set(y.split())
        if not x or not y:
            continue
        both, only_x, only_y = sorted(x & y), sorted(x - y), sorted(y - x)
        if both and (not only_x or not only_y):
            out[k] = 1.0
            continue
        at.append(k)
        left.append(" ".join(both + only_x))
        right.append(" ".join(both + only_y))
        core.append(len(" ".join(both)))
    best = indel_ratios(left, right)
    for side in (left, right):
        best = np.maximum(best, [2 * c / (c + len(s)) if c else 0.0 for c, s in zip(core, side)])
    out[at] = best
    return out


def jaro_winklers(a: list[str], b: list[str]) -> np.ndarray:
    return np.fromiter(map(jaro_winkler, a, b), np.float64, len(a))


def partial_ratio(a: str, b: str) -> float:
    """The best Indel ratio of the shorter text against windows of the longer, cut ones at both ends included."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return float(not b)
    n, best = len(a), 0.0
    most: dict[str, int] = {}
    for c in a:
        most[c] = most.get(c, 0) + 1
    # of each window at most as many characters are common as both have of them, in whatever order
    have, common, windows = dict.fromkeys(most, 0), 0, []
    for start in range(1 - n, len(b)):
        end = start + n
        if end <= len(b) and (c := b[end - 1]) in have:
            have[c] += 1
            common += have[c] <= most[c]
        if start > 0 and (c := b[start - 1]) in have:
            common -= have[c] <= most[c]
            have[c] -= 1
        windows.append((2 * common / (n + min(end, len(b)) - max(0, start)), start))
    for bound, start in sorted(windows, reverse=True):
        if bound <= best:
            break
        best = max(best, indel_ratio(a, b[max(0, start) : start + n]))
    return best


def _arrow(function):
    @F.pandas_udf("double")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        known: dict[tuple[str, str], int] = {}
        which = [known.setdefault(pair, len(known)) for pair in zip(a.fillna(""), b.fillna(""))]
        return pd.Series(function([x for x, _ in known], [y for _, y in known])[which], dtype="float64")

    return run


def udf_of(function):
    """A column function of two texts from a function of two lists of strings; each distinct pair of a batch is worked once."""
    held = []

    def apply(a: Column, b: Column) -> Column:
        if not held:
            held.append(_arrow(function))
        return held[0](a, b)

    return apply


jaro_winkler_column = udf_of(jaro_winklers)
indel_column = udf_of(indel_ratios)
token_set_column = udf_of(token_set_ratios)
token_sort_column = udf_of(token_sort_ratios)
partial_column = udf_of(partial_ratios)


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def exact(a: Column, b: Column) -> Column:
    """X1."""
    return (_text(a) == _text(b)).cast("int")


def length_difference(a: Column, b: Column) -> Column:
    """X7."""
    return F.abs(F.length(_text(a)) - F.length(_text(b)))


def length_ratio(a: Column, b: Column) -> Column:
    """A length of 0 counts as 1."""
    x, y = F.greatest(F.length(_text(a)), F.lit(1)), F.greatest(F.length(_text(b)), F.lit(1))
    return F.least(x, y) / F.greatest(x, y)


def _sets(a: Column, b: Column) -> tuple[Column, Column]:
    return F.array_distinct(tokens(a)), F.array_distinct(tokens(b))


def shared_tokens(a: Column, b: Column) -> Column:
    """X10."""
    x, y = _sets(a, b)
    return F.size(F.array_intersect(x, y))


def token_jaccard(a: Column, b: Column) -> Column:
    """0 if either side has no words."""
    x, y = _sets(a, b)
    return F.when((F.size(x) == 0) | (F.size(y) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y)))


def containment(a: Column, b: Column) -> Column:
    """X11: the shared words over the smaller side's; 0 if either has none."""
    x, y = _sets(a, b)
    return F.when((F.size(x) == 0) | (F.size(y) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(x, y)) / F.least(F.size(x), F.size(y)))


def number_match(a: Column, b: Column) -> Column:
    """Jaccard of the distinct runs of digits; -1 if neither side has any, 0 if one has none."""
    x, y = (F.array_distinct(F.regexp_extract_all(_text(c), F.lit(r"(\d+)"), F.lit(1))) for c in (a, b))
    return F.when((F.size(x) == 0) & (F.size(y) == 0), F.lit(-1.0)).when((F.size(x) == 0) | (F.size(y) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y)))
