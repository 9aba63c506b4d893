import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import bytelevel, textscan
from tessera.llm import packing
from tessera.llm.packing import Genome, crossed, evolved, homes, pack_documents, settled, shaken, started
from tessera.llm.queries import vocabulary
from tessera.llm.token_counts import count_tokens
from tessera.llm.token_store import Reader, Writer, read_store, stored_tokens, write_store
from tessera.llm.transducer import Transducer, transducer

PATH = vocabulary()
PIECES = ["a", "b", "'", "s", "t", "re", "ll", " ", "  ", "\n", "\t", "é", "ß", "1", "٣", "½", "!", "…", " ", "　", "中", "😀", "<|endoftext|>", "\r", "'ve", "\x00", "\x1c", "\x85", "²", "́", "the", "ing", "tion", "zz"]


def odd_texts(n=3000):
    rnd = random.Random(3)
    made = ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 30))) for _ in range(n)]
    return [*made, "ab" * 4000, "a" * 3000, " " * 3000 + "x", "".join(chr(rnd.randrange(0x20, 0x2FFF)) for _ in range(2000)), "".join(rnd.choice("abcdefgh") for _ in range(4000))]


def library(texts):
    return [e.ids for e in bytelevel.library(PATH).encode_batch(texts, add_special_tokens=False)]


def split(ids, at):
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]


def test_encoder_equals_library():
    texts = odd_texts()
    assert split(*bytelevel.encoder(PATH).encode([t.encode() for t in texts])) == library(texts)


def new_words(n):
    rnd = random.Random(13)
    return " ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(rnd.randint(3, 9))) + f"{k:x}" for k in range(n))


def test_encoder_of_a_long_text():
    text = " ".join(np.base_repr(k, 36) for k in range(36**4, 36**4 + 10)) + "".join(" " + chr(0x4E00 + k // 20_000) + chr(0x4E00 + k % 20_000) for k in range(1_510_000))
    ids, at = bytelevel.Encoder(PATH).encode([text.encode()])
    assert at.tolist() == [0, len(ids)]
    cut = len(text) // 2 // 3 * 3
    cut = text.index(" ", cut)
    assert ids.tolist() == sum(split(*bytelevel.Encoder(PATH).encode([text[:cut].encode(), text[cut:].encode()])), [])


def test_encoder_in_runs(monkeypatch):
    monkeypatch.setattr(bytelevel, "RUN", 150)
    monkeypatch.setattr(bytelevel, "KEPT", 200)
    texts = [*odd_texts(600), new_words(900)]
    assert split(*bytelevel.Encoder(PATH).encode([t.encode() for t in texts])) == library(texts)


def test_transducer_of_a_long_text(monkeypatch):
    monkeypatch.setattr("tessera.llm.transducer.SLOTS", 1 << 12)
    t, texts = Transducer(PATH), ["a b", new_words(3000), "", new_words(3000).replace(" ", ""), *odd_texts(100)]
    parts, want = [x.encode() for x in texts], library(texts)
    assert t.counts(parts).tolist() == [len(x) for x in want]
    assert split(*t.encode(parts)) == want


def test_encoder_forgets(monkeypatch):
    monkeypatch.setattr(bytelevel, "KEPT", 200)
    e, texts = bytelevel.Encoder(PATH), odd_texts(600)
    for k in range(0, 600, 50):
        assert split(*e.encode([t.encode() for t in texts[k : k + 50]])) == library(texts[k : k + 50])


def test_transducer_equals_library():
    texts = odd_texts()
    parts, want = [t.encode() for t in texts], library(texts)
    assert transducer(PATH).counts(parts).tolist() == [len(x) for x in want]
    assert split(*transducer(PATH).encode(parts)) == want


def test_transducer_forgets(monkeypatch):
    monkeypatch.setattr("tessera.llm.transducer.MOST_STATES", 100)
    t, texts = Transducer(PATH), odd_texts(300)
    for k in range(0, 300, 50):
        assert t.counts([x.encode() for x in texts[k : k + 50]]).tolist() == [len(x) for x in library(texts[k : k + 50])]


def long_words(n):
    rnd = random.Random(5)
    return ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n)), "ab" * (n // 2), "a" * n, "abc" * (n // 3) + "x", " " * n + "y", "é日" * (n // 5), "x " + "".join(rnd.choice("ent") for _ in range(n)) + " z"]


@pytest.mark.parametrize("n", [700, 5000, 40_000])
def test_chunk_maps_without_boundaries(n):
    texts = ["one", *long_words(n), "two words", *long_words(n // 2)]
    parts, want = [t.encode() for t in texts], library(texts)
    assert Transducer(PATH).counts(parts).tolist() == [len(x) for x in want]
    assert split(*Transducer(PATH).encode(parts)) == want
    assert split(*bytelevel.Encoder(PATH).encode(parts)) == want


def test_very_long_words():
    """4 MB without a boundary, and a special string behind it."""
    rnd = random.Random(6)
    texts = ["a b", "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=4 << 20)) + "<|endoftext|> end", "ab" * (2 << 20), "tail"]
    parts, want = [t.encode() for t in texts], library(texts)
    assert Transducer(PATH).counts(parts).tolist() == [len(x) for x in want]
    assert split(*bytelevel.Encoder(PATH).encode(parts)) == want


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_tokens long")


ROWS = [(3, "one two three", "x", 1), (1, None, None, None), (2, "", "y", 2), (None, "four", "z", 3), (3, "one two three", "x", 1), (9, "very long " * 3000, "w", 0)]


def test_count_query(spark):
    got = sorted(map(tuple, count_tokens(frame(spark, ROWS), PATH).collect()), key=str)
    want = sorted([(i, len((t or "").encode()), len(library([t or ""])[0]), len(library([t or ""])[0]) > 1024) for i, t, _, _ in ROWS], key=str)
    assert got == want
    assert count_tokens(frame(spark, []), PATH).count() == 0


def ids_of(text):
    return [*library([text or ""])[0], 2]


def test_store_query(spark):
    rows = [*ROWS, *[(100 + k, f"text number {k} " * (k % 7), "", k) for k in range(60)]]
    got = stored_tokens(frame(spark, rows), PATH).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    at, want = 0, {}
    for i, t, _, _ in order:
        ids = ids_of(t)
        want.setdefault(i, []).append((at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    found = {}
    for r in got:
        found.setdefault(r["doc_id"], []).append((r["start"], r["n_tokens"], r["ids_crc32"]))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}
    assert stored_tokens(frame(spark, []), PATH).count() == 0


def test_store_is_random_access(spark, tmp_path):
    rows = [(k, f"word{k} " * 400, "", 0) for k in range(40)]
    manifest = write_store(frame(spark, rows), PATH, str(tmp_path / "store"), files=3)
    assert read_store(manifest).count() == 40
    want = [i for _, t, _, _ in rows for i in ids_of(t)]
    got = []
    for r in sorted(manifest.collect(), key=lambda r: r["part"]):
        reader = Reader(r["file"])
        before = pa.total_allocated_bytes()
        for k in range(-(-r["tokens"] // reader.length)):
            ids, mask = reader.sequence(k)
            got += ids[mask].tolist()
        assert reader.ids(5, 1500).base is not None or r["tokens"] < 1505
        assert pa.total_allocated_bytes() - before < 1 << 20  # views of the mapped file
    assert got == want


def test_writer_batches(tmp_path):
    with pa.OSFile(str(tmp_path / "a"), "wb") as sink:
        w = Writer(sink, 4, 2)
        for n in (3, 0, 9, 1):
            w.add(np.arange(n, dtype=np.uint16))
        w.close()
    r = Reader(str(tmp_path / "a"))
    assert r.file.num_record_batches == 2
    assert r.ids(0, 13).tolist() == [0, 1, 2, 0, 1, 2, 3, 4, 5, 6, 7, 8, 0]
    assert r.sequence(3)[1].tolist() == [True, False, False, False]


def test_packing_query(spark):
    rows = [*ROWS, *[(k, "alpha beta gamma " * (k % 300), "", 0) for k in range(20, 320)]]
    got = pack_documents(frame(spark, rows), PATH).collect()
    by_doc, by_bin = {}, {}
    for r in got:
        assert r["length"] <= 1024
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_bin.setdefault(r["sequence_id"], []).append(r)
    for own in by_bin.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    for i, t, _, _ in rows:
        ids = ids_of(t)
        copies = sum(x[0] == i for x in rows)
        parts = sorted({(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in by_doc[i]})
        assert len(by_doc[i]) == copies * len(parts)
        assert sum(p[2] for p in parts) == len(ids)
        assert all(p[2] == 1024 for p in parts[1:])
        for _, start, length, crc in parts:
            assert crc == zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())
    total = sum(r["length"] for r in got)
    assert len(by_bin) <= -(-total // 1024) * 1.03 + 1
    assert pack_documents(frame(spark, []), PATH).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_genetic_steps_keep_documents(seed):
    rng = random.Random(seed)
    size = [rng.randint(200, 700) for _ in range(300)]
    a, b = Genome(1000), Genome(1000)
    a.best_fit(list(range(300)), size)
    for i in range(300):
        b.bins.append([i])
        b.fill.append(size[i])
    b.best_fit(b.empty(list(range(250))), size)
    for child in (crossed(a, b, size, rng), shaken(a, size, rng)):
        assert sorted(i for x in child.bins for i in x) == list(range(300))
        assert all(sum(size[i] for i in x) == f <= 1000 for x, f in zip(child.bins, child.fill))
    plain = Genome(1000)
    plain.best_fit(list(range(300)), size)
    assert settled(homes(plain, 300), size, 1000).fitness() == plain.fitness()
    people = evolved([plain, *started(size, 1000, rng)], size, rng)
    assert all(sorted(i for b in g.bins for i in b) == list(range(300)) for g in people)
    assert people[0].fitness() >= plain.fitness()


def optimum(size, capacity):
    """The fewest bins, by trying all."""
    best = len(size)

    def put(k, room):
        nonlocal best
        if len(room) >= best:
            return
        if k == len(size):
            best = len(room)
            return
        for r in range(len(room)):
            if room[r] >= size[k]:
                put(k + 1, [*room[:r], room[r] - size[k], *room[r + 1 :]])
        put(k + 1, [*room, capacity - size[k]])

    put(0, [])
    return best


@pytest.mark.parametrize("seed", range(3))
def test_islands(spark, seed):
    rng = random.Random(seed)
    blocks = {0: [31, 31, 31, 23, 23, 23, 23, 23, 23], 1: [rng.randint(20, 60) for _ in range(9)], 2: [rng.randint(200, 700) for _ in range(200)]}
    rows, fitted = [], {}
    for b, size in blocks.items():
        g = Genome(100 if b < 2 else 1000)
        g.best_fit(list(range(len(size))), size)
        fitted[b] = g.count()
    for capacity, some in ((100, (0, 1)), (1000, (2,))):
        rows = []
        for b in some:
            g = Genome(capacity)
            g.best_fit(list(range(len(blocks[b]))), blocks[b])
            rows += [(b, i, blocks[b][i], k, True) for i, k in enumerate(homes(g, len(blocks[b])))]
        found = {}
        for r in packing._bred(spark.createDataFrame(rows, "block long, place int, length long, bin int, open boolean"), capacity).collect():
            found.setdefault(r["block"], {})[r["place"]] = r["bin"]
        for b in some:
            assert sorted(found[b]) == list(range(len(blocks[b])))
            g = settled([found[b][i] for i in range(len(blocks[b]))], blocks[b], capacity)
            assert max(g.fill) <= capacity and g.count() <= fitted[b]
            if capacity == 100:
                assert g.count() == optimum(blocks[b], capacity)


def test_blocks():
    assert [(f, len(p)) for f, p in textscan.blocks(["aa", None, "b" * 9, "c"], 8)] == [(0, 2), (2, 1), (3, 1)]
