"""Language spans: scripts narrow the candidates, Viterbi over per-word scores labels the words."""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import textscan
from tessera.llm.common import fold, over_texts

#: Numbers of scripts, and that of combining marks, which go with the letter before them.
SCRIPTS, MARK = 1024, 1023


@lru_cache(maxsize=1)
def script_table() -> np.ndarray:
    """The script of each code point, by the first word of its letters' Unicode names; 0 for what is neither letter nor mark."""
    table, numbers = np.zeros(0x110000, np.uint16), {}
    for code in (*range(0x40000), *range(0xE0000, 0xE0200)):
        kind = unicodedata.category(chr(code))[0]
        if kind == "M":
            table[code] = MARK
        elif kind == "L":
            words = unicodedata.name(chr(code), "LETTER").split(" ")
            name = words[1 if words[0] in ("FULLWIDTH", "HALFWIDTH") and len(words) > 1 else 0].split("-")[0]
            table[code] = numbers.setdefault(name, len(numbers) + 1)
    return table


#: Bytes of a run of letters that are one word; a longer run is cut into pieces of about as many, which are words each.
PIECE = 40
#: Words of a chunk, whose max-plus map is found beside those of all others.
CHUNK = 128


@dataclass
class Settings:
    """bits: log2 of the table of hashed byte n-grams (2 to 4, ends of runs included). sample: documents of a language that are learnt from, by hash, sample_bytes of text each at most. penalty: of a switch between words. smooth: added to each count."""

    bits: int = 16
    sample: int = 2_000
    sample_bytes: int = 24_000
    penalty: float = 12.0
    smooth: float = 0.5


def pieces(data: np.ndarray, begins: np.ndarray, stops: np.ndarray):
    """Runs of letters cut into words: (starts, ends, whether first of its run, whether last, the run's end)."""
    count = np.maximum(1, -(-(stops - begins) // PIECE))
    run = np.repeat(np.arange(len(begins)), count)
    k = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
    first, last = k == 0, k == count[run] - 1
    starts = begins[run] + k * PIECE
    for _ in range(3):  # back to the begin of a character
        starts -= ~first & ((data[starts] & 0xC0) == 0x80)
    stop = stops[run]
    ends = np.where(last, stop, np.append(starts[1:], 0))
    return starts, ends, first, last, stop


class Words:
    """Words of texts; the distinct ones with their script and n-grams.

    A word is a run of letters of one script, marks on them included. Runs of over `PIECE` bytes, as in scripts without
    spaces, are cut between characters into words that all count; the n-grams that begin in one reach into the next.
    """

    def __init__(self, parts: list[bytes], bits: int):
        data, begin, _ = textscan.joined(parts)
        data = textscan.lower_ascii(data)
        table = script_table()
        script = table[data & 0x7F] * (data < 0x80)
        for low, high, size, mask in ((0xC0, 0xE0, 2, 0x1F), (0xE0, 0xF0, 3, 0x0F), (0xF0, 0xF8, 4, 0x07)):
            lead = np.flatnonzero((data >= low) & (data < high))
            if lead.size:
                code = (data[lead] & mask).astype(np.int64)
                for k in range(1, size):
                    code = (code << 6) | (data[lead + k] & 0x3F)
                found = table[code]
                for k in range(size):
                    script[lead + k] = found
        mark = script == MARK
        letter = np.cumsum((script > 0) & ~mark & ((data & 0xC0) != 0x80))
        if mark.any():  # the script of what they stand on, none where that is no letter
            mark[0] = False
            script[0] = script[0] if script[0] != MARK else 0
            script = script[np.maximum.accumulate(np.where(mark, 0, np.arange(data.size)))]
        edges = np.concatenate(([0], np.flatnonzero(script[1:] != script[:-1]) + 1, [data.size]))
        solid = script[edges[:-1]] > 0
        begins, stops = edges[:-1][solid], edges[1:][solid]
        starts, ends, first, last, stop = pieces(data, begins, stops)
        kind = script[starts]
        self.first = np.concatenate((np.searchsorted(starts, begin), [len(starts)]))
        letter = np.concatenate(([0], letter))
        self.letters = letter[ends] - letter[starts]
        # n-grams begin in the word, and at the white space before a run; a run's neighbours are taken as white space
        reach = np.where(last, stop + 1, np.minimum(ends + 3, stop + 1))
        hashes = textscan.span_hashes(data, starts, ends)
        cut = np.flatnonzero(~(first & last))
        if cut.size:  # the same bytes are the same word only if what their n-grams reach is
            more = reach[cut] - ends[cut]
            key = first[cut].astype(np.uint64) | (last[cut].astype(np.uint64) << np.uint64(1)) | (more.astype(np.uint64) << np.uint64(2))
            for k in range(3):
                source = ends[cut] + k
                byte = np.where((k < more) & (source < stop[cut]), data[np.minimum(source, data.size - 1)], 0x20)
                key |= byte.astype(np.uint64) << np.uint64(8 * (k + 1))
            hashes[cut] = textscan.mix64(hashes[cut] ^ textscan.mix64(key + np.uint64(1 << 40)))
        _, at, self.back = np.unique(hashes, return_index=True, return_inverse=True)
        self.script = kind[at]
        a, b, stop = starts[at] - first[at], reach[at], stop[at]
        bound = np.where(last[at], b, ends[at])  # n-grams begin before it
        n = b - a
        total = int(n.sum())
        before = np.cumsum(n) - n
        place = np.arange(total) - np.repeat(before, n)
        source = np.repeat(a, n) + place
        outside = (source == np.repeat(stop, n)) | ((place == 0) & np.repeat(first[at], n))
        value = np.where(outside, 0x20, data[np.clip(source, 0, data.size - 1)]).astype(np.uint64)
        left = np.repeat(n, n) - place
        own = source < np.repeat(bound, n)
        word = np.repeat(np.arange(len(a)), n)
        grams, owners = [], []
        x = value.copy()
        for size in (2, 3, 4):
            x = x[: total - size + 1] if size > 1 else x
            x = (x[: max(0, total - size + 1)] << np.uint64(8)) | value[size - 1 :]
            keep = (left[: len(x)] >= size) & own[: len(x)]
            grams.append((textscan.mix64(x[keep] + np.uint64(size << 40)) >> np.uint64(64 - bits)).astype(np.int64))
            owners.append(word[: len(x)][keep])
        self.grams, self.owner = np.concatenate(grams), np.concatenate(owners)


@dataclass
class Model:
    names: list[str]
    table: np.ndarray  # log-probability of an n-gram, by hash and language
    scripts: np.ndarray  # whether a language uses a script
    settings: Settings

    def word_scores(self, words: Words) -> np.ndarray:
        """Of each word, by language; a language that doesn't use the word's script is no candidate unless none does."""
        n, out = len(words.script), np.zeros((len(words.script), len(self.names)), np.float32)
        for k in range(len(self.names)):
            out[:, k] = np.bincount(words.owner, self.table[words.grams, k], n)
        fit = self.scripts[:, words.script].T
        out[~fit & fit.any(1)[:, None]] -= 1e4
        return out[words.back]


def viterbi(scores: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of each word; words of text k are first[k] to first[k + 1], a switch costs `penalty`.

    Texts are cut into chunks. A chunk's map, from the label before it to the best score at each label
    after it, is found for all chunks in step; maps are composed along each text; then labels are traced.
    """
    n = np.diff(first)
    labels = scores.shape[1]
    count = -(-n // CHUNK)
    lanes = int(count.sum())
    if not lanes:
        return np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(n)), count)
    own = np.cumsum(count) - count
    start = first[doc] + (np.arange(lanes) - own[doc]) * CHUNK
    size = np.minimum(first[doc + 1] - start, CHUNK)
    order = np.argsort(-size, kind="stable")
    start, size = start[order], size[order]
    alive = [int(np.searchsorted(-size, -t, "left")) for t in range(int(size[0]))]  # lanes longer than t
    maps = np.full((lanes, labels, labels), -1e9, np.float32)
    maps[:, np.arange(labels), np.arange(labels)] = 0
    for t, m in enumerate(alive):
        v = maps[:m]
        maps[:m] = np.maximum(v, v.max(2, keepdims=True) - penalty) + scores[start[:m] + t][:, None, :]
    place = np.empty(lanes, np.int64)
    place[order] = np.arange(lanes)
    entry, leave = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
    v = np.zeros((len(n), labels), np.float32)
    back = np.zeros((lanes, labels), np.int64)
    for c in range(int(count.max())):
        live = np.flatnonzero(count > c)
        lane = place[own[live] + c]
        through = v[live][:, :, None] + maps[lane]
        back[lane] = through.argmax(1)
        v[live] = through.max(1)
    label = v.argmax(1)
    for c in range(int(count.max()) - 1, -1, -1):
        live = np.flatnonzero(count > c)
        lane = place[own[live] + c]
        leave[lane] = label[live]
        entry[lane] = label[live] = back[lane, label[live]]
    # trace within chunks, from the known label before to the known label at the end
    v = np.full((lanes, labels), -1e9, np.float32)
    v[np.arange(lanes), entry] = 0
    steps = len(alive)
    moved, best = np.zeros((steps, lanes, labels), bool), np.zeros((steps, lanes), np.int32)
    for t, m in enumerate(alive):
        u = v[:m]
        best[t, :m] = u.argmax(1)
        jump = u.max(1, keepdims=True) - penalty
        moved[t, :m] = jump > u
        v[:m] = np.maximum(u, jump) + scores[start[:m] + t]
    out = np.zeros(len(scores), np.int64)
    now = leave.copy()
    for t in range(steps - 1, -1, -1):
        m = alive[t]
        out[start[:m] + t] = now[:m]
        went = moved[t, np.arange(m), now[:m]]
        now[:m] = np.where(went, best[t, :m], now[:m])
    return out


def learnt(docs: DataFrame, settings: Settings) -> Model:
    """Learn from (key, text, lang) rows: a bounded sample of each language, chosen by hash of the key. Counts are summed on the executors."""
    s = settings
    known = docs.where("lang is not null and text is not null")
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = sorted(counts)
    parts = None
    if names:  # one scan: a language's rows are taken by hash at the rate that gives `sample` of them
        rate = F.element_at(F.create_map(*[F.lit(x) for name in names for x in (name, max(1, min(1_000_000, int(1e6 * s.sample / counts[name]))))]), F.col("lang"))
        parts = known.where((F.pmod(F.xxhash64("key", F.xxhash64("text")), F.lit(1_000_000)) < rate) & (F.octet_length("text") <= s.sample_bytes)).select("lang", "text")
    size = 1 << s.bits
    table, scripts = np.full((size, max(1, len(names))), s.smooth), np.zeros((max(1, len(names)), SCRIPTS))
    if parts is not None:

        def work(rest, texts):
            langs = rest.column(0).to_pylist()
            out = {"lang": [], "number": [], "n": []}
            for lang in sorted(set(langs)):
                words = Words([t for t, x in zip(texts, langs) if x == lang], s.bits)
                if not len(words.back):
                    continue
                times = np.bincount(words.back, minlength=len(words.script))
                grams = np.bincount(words.grams, times[words.owner], size)
                kinds = np.bincount(words.script, times, SCRIPTS)
                both = np.concatenate((grams, kinds)).astype(np.int64)
                at = np.flatnonzero(both)
                out["lang"] += [lang] * len(at)
                out["number"] += at.tolist()
                out["n"] += both[at].tolist()
            return {"lang": pa.array(out["lang"], pa.string()), "number": pa.array(out["number"], pa.int32()), "n": pa.array(out["n"], pa.int64())}

        sums = over_texts(parts, "lang string, number int, n long", work, 8 << 20).groupBy("lang", "number").agg(F.sum("n").alias("n")).toArrow()
        column = np.array([names.index(x) for x in sums["lang"].to_pylist()], np.int64)
        number, n = sums["number"].to_numpy(), sums["n"].to_numpy()
        gram = number < size
        table[number[gram], column[gram]] += n[gram]
        scripts[column[~gram], number[~gram] - size] += n[~gram]
    table = np.log(table / table.sum(0, keepdims=True)).astype(np.float32)
    uses = scripts > 0.01 * np.maximum(1, scripts.sum(1, keepdims=True))
    return Model(names or ["und"], table, uses, s)


def language_spans(parts: list[bytes], model: Model):
    """(words, label of each word) of texts: runs of one label are the spans."""
    words = Words(parts, model.settings.bits)
    return words, viterbi(model.word_scores(words), words.first, model.settings.penalty)


def identify(docs: DataFrame, settings: Settings | None = None, folds: int = 3, held: int = 1) -> DataFrame:
    """Language of whole texts: (doc_id, held_out, lang_pred, score, spans).

    Learns from rows with text and lang whose crc32(doc_id as text) modulo `folds` is not `held`. lang_pred
    is the label with most letters along the best path, score its share of the letters, spans the number
    of runs of one label. Letters are the code points of Unicode's letter categories. Null texts and such without a
    letter are `und` with score 0. A text of any length is read whole. Repeated rows give
    a row each; an empty table gives none; without any labelled row all are `und`. Documents are not shuffled.
    """
    settings = settings or Settings()
    model = docs.sparkSession.sparkContext.broadcast(learnt(docs.where(fold(F.col("doc_id"), folds) != held).select(F.col("doc_id").alias("key"), F.col("text"), F.col("lang").cast("string").alias("lang")), settings))
    narrow = docs.select("doc_id", (fold(F.col("doc_id"), folds) == held).alias("held_out"), "text")
    kind = narrow.schema["doc_id"].dataType.simpleString()

    def work(rest, parts):
        own = model.value
        words, label = language_spans(parts, own)
        n = len(parts)
        doc = np.repeat(np.arange(n), np.diff(words.first))
        names = own.names
        weight = np.bincount(doc * len(names) + label, words.letters, n * len(names)).reshape(n, len(names))
        total = weight.sum(1)
        best = weight.argmax(1)
        change = np.flatnonzero((label[1:] != label[:-1]) & (doc[1:] == doc[:-1])) + 1
        spans = np.bincount(doc[change], minlength=n) + (total > 0)
        score = np.where(total > 0, weight[np.arange(n), best] / np.maximum(total, 1), 0.0)
        score = np.where(np.array(names == ["und"]), 0.0, score)
        return {"doc_id": rest.column(0), "held_out": rest.column(1), "lang_pred": pa.array([names[k] if t > 0 else "und" for k, t in zip(best.tolist(), total.tolist())]), "score": pa.array(score), "spans": pa.array(spans.astype(np.int64))}

    return over_texts(narrow, f"doc_id {kind}, held_out boolean, lang_pred string, score double, spans long", work)
