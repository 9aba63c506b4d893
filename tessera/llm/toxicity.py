"""Toxicity by a factorization machine over hashed terms."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed, fold, kept_texts, over_texts
from tessera.llm.terms import hashed_terms


@dataclass
class Settings:
    """bits: log2 of the table of hashed terms. factors: of the pairwise part. sample: labelled texts that the machine is fitted on at most (of each label), none of over sample_bytes. least: texts of the sample that a term must be in to have factors. sparse, decay: L1 of the weights, L2 of the factors. groups: group L1 of a term's factors, of which the one that does best on a fifth of the sample left out is taken. start: standard deviation of a text's sum of factors at first."""

    bits: int = 18
    factors: int = 4
    sample: int = 8_000
    sample_bytes: int = 16_000
    epochs: int = 10
    batch: int = 128
    rate: float = 0.5
    factor_rate: float = 0.1
    sparse: float = 16.0
    decay: float = 1e-3
    groups: tuple[float, ...] = (0.2, 1.0)
    least: int = 5
    start: float = 0.1
    seed: int = 7


class FactorizationMachine:
    """score = sigmoid(b + sum w_i + 1/2 sum_f ((sum v_if)^2 - sum v_if^2)) over a text's distinct terms.

    w is fitted by FTRL-proximal, whose L1 leaves terms that tell nothing at exactly 0, so that long
    texts gather no noise; v by proximal AdaGrad from small random numbers, whether or not a term has
    weight, so a pair tells even where neither of its terms does. A term's factors shrink together and,
    where no pair needs them, to 0 for good. Terms of fewer than `least` texts have none.
    """

    def __init__(self, settings: Settings, group: float | None = None):
        s = self.settings = settings
        self.group = s.groups[0] if group is None else group
        rng = np.random.default_rng(s.seed)
        size = 1 << s.bits
        self.b, self.w = 0.0, np.zeros(size, np.float32)
        self.z, self.n = np.zeros(size, np.float32), np.zeros(size, np.float32)
        self.v = rng.normal(0, min(0.02, s.start), (size, s.factors)).astype(np.float32)
        self.g = np.full((size, s.factors), 1.0, np.float32)

    def raw(self, terms: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Scores before the sigmoid of texts whose terms are terms[at[k]:at[k + 1]]."""
        n = len(at) - 1
        out = np.full(n, self.b, np.float64)
        doc = np.repeat(np.arange(n), np.diff(at))
        w = self.w[terms]
        on = np.flatnonzero(w)
        if on.size:
            out += np.bincount(doc[on], w[on], n)
        on = np.flatnonzero(self.v[:, 0][terms])
        if on.size:
            v, own = self.v[terms[on]].astype(np.float64), doc[on]
            for f in range(v.shape[1]):
                out += 0.5 * (np.bincount(own, v[:, f], n) ** 2 - np.bincount(own, v[:, f] ** 2, n))
        return out

    def fit(self, terms: np.ndarray, at: np.ndarray, label: np.ndarray, weight: np.ndarray) -> None:
        s = self.settings
        rng = np.random.default_rng(s.seed)
        grad_b = 1.0
        share = float((label * weight).sum() / max(1e-9, weight.sum()))
        self.b = float(np.log(max(share, 1e-3) / max(1 - share, 1e-3))) - 1.0
        self.v[np.bincount(terms, minlength=len(self.w)) < s.least] = 0
        active = np.count_nonzero(self.v[:, 0][terms]) / max(1, len(label))
        self.v *= np.float32(min(1.0, s.start / (0.02 * max(1.0, active) ** 0.5)))
        for _ in range(s.epochs):
            order = rng.permutation(len(label))
            for k in range(0, len(order), s.batch):
                rows = order[k : k + s.batch]
                size = at[rows + 1] - at[rows]
                own = np.concatenate(([0], np.cumsum(size)))
                t = terms[np.repeat(at[rows] - own[:-1], size) + np.arange(own[-1])]
                doc = np.repeat(np.arange(len(rows)), size)
                pair = np.flatnonzero(self.v[:, 0][t])
                v, mine = self.v[t[pair]], doc[pair]
                total = np.stack([np.bincount(mine, v[:, f], len(rows)) for f in range(s.factors)], 1)
                own_ = np.bincount(mine, (v.astype(np.float64) ** 2).sum(1), len(rows))
                raw = self.b + np.bincount(doc, self.w[t], len(rows)) + 0.5 * ((total**2).sum(1) - own_)
                p = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
                e = (p - label[rows]) * weight[rows]
                grad_b += float((e.sum()) ** 2)
                self.b -= s.rate * float(e.sum()) / grad_b**0.5
                if pair.size:
                    which, back = np.unique(t[pair], return_inverse=True)
                    gv = e[mine][:, None] * (total[mine] - v)
                    step = np.stack([np.bincount(back, gv[:, f], len(which)) for f in range(s.factors)], 1).astype(np.float32)
                    step += s.decay * self.v[which]
                    self.g[which] += step**2
                    rate = s.factor_rate / np.sqrt(self.g[which])
                    moved = self.v[which] - rate * step
                    norm = np.sqrt((moved**2).sum(1))
                    self.v[which] = moved * np.maximum(0, 1 - self.group * rate.mean(1) / np.maximum(norm, 1e-9))[:, None]
                which, back = np.unique(t, return_inverse=True)
                grad = np.bincount(back, e[doc]).astype(np.float32)
                old = self.n[which]
                new = old + grad**2
                self.z[which] += grad - (np.sqrt(new) - np.sqrt(old)) / s.rate * self.w[which]
                self.n[which] = new
                z = self.z[which]
                self.w[which] = np.where(np.abs(z) <= s.sparse, 0, -(z - np.sign(z) * s.sparse) / ((1.0 + np.sqrt(new)) / s.rate))


def chosen(settings: Settings, terms: np.ndarray, at: np.ndarray, label: np.ndarray, weight: np.ndarray) -> FactorizationMachine:
    """The machine of the group L1 that has the least loss on a fifth of the texts, left out for that, fitted on all of them."""
    left = np.random.default_rng(settings.seed).permutation(len(label)) % 5 == 0

    def part(keep: np.ndarray):
        size = np.diff(at)[keep]
        return terms[np.repeat(keep, np.diff(at))], np.concatenate(([0], np.cumsum(size)))

    losses = []
    for group in settings.groups if len(settings.groups) > 1 else ():
        machine = FactorizationMachine(settings, group)
        machine.fit(*part(~left), label[~left], weight[~left])
        raw = machine.raw(*part(left))
        losses.append(float((weight[left] * np.logaddexp(0, np.where(label[left] == 1, -raw, raw))).sum()))
    best = FactorizationMachine(settings, settings.groups[int(np.argmin(losses))] if losses else None)
    best.fit(terms, at, label, weight)
    return best


def _machine(settings: Settings):
    """All texts of the sample in one task, to the row of the machine fitted on them: (b, w, v), arrays as bytes."""

    def fit(batches):
        rows = sorted((str(k), m, t, y) for batch in batches for k, m, t, y in zip(*(batch.column(c).to_pylist() for c in ("key", "mark", "terms", "label"))))
        machine = FactorizationMachine(settings)
        label = np.array([r[3] for r in rows], np.float64)
        if not 0 < label.sum() < len(rows):  # nothing to tell apart
            machine.b, machine.v[:] = 4.0 if label.any() else -4.0, 0
        else:
            arrays = [np.frombuffer(r[2], np.int32) for r in rows]
            at = np.concatenate(([0], np.cumsum([len(a) for a in arrays])))
            weight = np.where(label == 1, min(4.0, max(1.0, (label == 0).sum() / max(1, (label == 1).sum()) / 3)), 1.0)
            machine = chosen(settings, np.concatenate(arrays), at, label, weight)
        yield pa.RecordBatch.from_pydict({"b": [machine.b], "w": [machine.w.tobytes()], "v": [machine.v.tobytes()]})

    return fit


def fitted(docs: DataFrame, known: DataFrame, settings: Settings) -> tuple[float, np.ndarray, np.ndarray]:
    """Fit on (key, text) rows and the labels (key, label), 0 or 1, of a bounded sample of texts; (b, w, v).

    The sample is chosen by hash among the distinct labelled texts of at most `sample_bytes`. Which they are,
    at most twice `sample`, goes to the executors, so texts are not shuffled; terms are hashed where texts are
    read and meet in one task, bounded by the sample's rows and bytes, that fits. The driver gets the weights only.
    """
    s = settings
    marked = docs.withColumn("mark", F.xxhash64("text"))
    labels = known.where("label in (0, 1)").select("key", F.col("label").cast("int").alias("label"))
    short = marked.where(F.octet_length("text") <= s.sample_bytes)
    usable = short.select("key", "mark").join(labels, "key").groupBy("key", "mark").agg(F.max("label").alias("label"))
    order = Window.partitionBy("label").orderBy(F.xxhash64("key", "mark", F.lit(s.seed)), "key", "mark")
    chosen = checkpointed(usable.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= s.sample).drop("rank"))

    def work(rest, texts):
        terms, at = hashed_terms(texts, s.bits)
        own = terms.astype(np.int32)
        return {"key": rest.column(0), "mark": rest.column(1), "label": rest.column(2), "terms": pa.array([own[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())}

    kind = docs.schema["key"].dataType.simpleString()
    sample = short.join(F.broadcast(chosen), ["key", "mark"]).select("key", "mark", "label", "text")
    terms = over_texts(sample, f"key {kind}, mark long, label int, terms binary", work)
    once = terms.groupBy("key", "mark").agg(F.first("label").alias("label"), F.first("terms").alias("terms"))  # repeated rows
    row = once.coalesce(1).mapInArrow(_machine(s), "b double, w binary, v binary").first()
    return row["b"], np.frombuffer(row["w"], np.float32), np.frombuffer(row["v"], np.float32).reshape(-1, s.factors)


def toxicity(docs: DataFrame, labels: DataFrame, settings: Settings | None = None, folds: int = 5) -> DataFrame:
    """Score whole texts: (doc_id, held_out, score, predicted).

    Labels are learnt from rows whose crc32(doc_id as text) modulo `folds` is not 0 (the others are held
    out); a document's own labels, language, source and id are no input of its score. Several labels of an
    id count as its largest; null labels are none. Null or empty texts get the machine's bias. Repeated
    rows give a row each; an empty table gives none; without both labels the bias alone speaks. Texts of any
    length are scored whole, each distinct term once; those of over `sample_bytes` are not learnt from.
    The model, 2**bits rows of factors + 1 numbers, goes to the executors; documents are not shuffled.
    """
    settings = settings or Settings()
    model = fitted_on(docs, labels, settings, folds)
    narrow = docs.select("doc_id", (fold(F.col("doc_id"), folds) == 0).alias("held_out"), "text")
    kind = narrow.schema["doc_id"].dataType.simpleString()

    def work(rest, parts):
        score = probabilities(model.value, settings, parts)
        return {"doc_id": rest.column(0), "held_out": rest.column(1), "score": pa.array(score), "predicted": pa.array((score >= 0.5).astype(np.int32))}

    return over_texts(narrow, f"doc_id {kind}, held_out boolean, score double, predicted int", work)


def fitted_on(docs: DataFrame, labels: DataFrame, settings: Settings, folds: int):
    """The model, broadcast, fitted on the documents that have labels and aren't held out."""
    known = labels.select(F.col("doc_id").alias("key"), F.col("toxic").cast("int").alias("label")).where("key is not null and label is not null").where(fold(F.col("key"), folds) != 0).groupBy("key").agg(F.max("label").alias("label"))
    texts = docs.select(F.col("doc_id").alias("key"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return docs.sparkSession.sparkContext.broadcast(fitted(texts, known, settings))


def probabilities(model, settings: Settings, parts: list[bytes]) -> np.ndarray:
    own = FactorizationMachine.__new__(FactorizationMachine)
    own.b, own.w, own.v = model
    return 1 / (1 + np.exp(-np.clip(own.raw(*hashed_terms(parts, settings.bits)), -50, 50)))


def without_toxic(docs: DataFrame, labels: DataFrame, settings: Settings | None = None, folds: int = 5, threshold: float = 0.5) -> DataFrame:
    """The documents, all their columns, whose score is below the threshold; see `toxicity`."""
    settings = settings or Settings()
    model = fitted_on(docs, labels, settings, folds)
    return kept_texts(docs, lambda parts: probabilities(model.value, settings, parts) < threshold)
