"""Toxicity: a factorization machine over hashed terms.

1. Terms are the lower-cased runs of letters of the whole text and their proper
   beginnings of 4 to 8 bytes (inflected and compound forms share a beginning),
   hashed to 2^20 numbers; a document is the set of its terms.
2. The machine learns from a bounded, uniform sample of the labelled rows outside
   the held-out fold (about ``SAMPLE_ROWS``, chosen by a hash of the id; all rows
   where there are fewer). One aggregate counts the toxic and the clean documents
   of every term in it; the terms whose rates differ most (absolute z-score of
   the two rates) become the features, whose number is a parameter.
3. The machine is fitted on the sample's features: bias, a weight for each
   feature and for each pair of features the product of two vectors, so that two
   terms together can count for more (or less) than the sum of their weights.
4. Every document is scored in one pass without a shuffle; the model is a
   broadcast of a size fixed by the parameters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import Words, keeping_own, row_chunks, text_of, written

HASH_BITS = 20
FEATURES = 2048
FACTORS = 4
SAMPLE_ROWS = 20_000
MIN_DOCUMENTS = 5
BEGINNINGS = range(4, 9)
#: Rates that differ less (in standard errors) are taken for chance.
MIN_Z = 4.0
STEPS, BATCH = 4000, 256

_TERM = np.full(256, 0x20, np.uint8)  # letters lower-cased, bytes of other scripts kept, the rest blank
_TERM[97:123] = np.arange(97, 123)
_TERM[65:91] = np.arange(97, 123)
_TERM[128:] = np.arange(128, 256)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def document_terms(buf: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
    """Distinct hashed terms of each document."""
    words = Words(buf, offs, table=_TERM)
    length = words.end - words.start
    kinds, owners = [words.hashes()], [np.repeat(np.arange(len(offs) - 1), np.diff(words.first))]
    for n in BEGINNINGS:
        longer = length > n
        # the beginning of a longer word is another term than the word of that spelling
        kinds.append(~words.span_hashes(words.start[longer], words.start[longer] + n))
        owners.append(owners[0][longer])
    terms = (np.concatenate(kinds) >> np.uint64(64 - HASH_BITS)).astype(np.int64)
    found = np.unique((np.concatenate(owners) << HASH_BITS) | terms)
    cuts = np.searchsorted(found, np.arange(1, len(offs) - 1) << HASH_BITS)
    return np.split((found & ((1 << HASH_BITS) - 1)).astype(np.int32), cuts)


def _with_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, buf, offs in row_chunks(batch, "text"):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(document_terms(buf, offs), pa.list_(pa.int32()))], ["label", "terms"])


class FactorizationMachine:
    """score = sigmoid(bias + sum of weights + sum over pairs of dot products) over the features present."""

    def __init__(self, features: int, factors: int, seed: int = 5):
        self.bias = 0.0
        self.weights = np.zeros(features)
        self.vectors = np.random.default_rng(seed).normal(0.0, 0.01, (features, factors))

    @classmethod
    def of(cls, bias: float, weights: np.ndarray, vectors: np.ndarray) -> FactorizationMachine:
        made = cls(1, 1)
        made.bias, made.weights, made.vectors = bias, weights, vectors
        return made

    def raw(self, rows: np.ndarray, features: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores before the sigmoid and the vector sums, of ``n`` rows given as (row, feature) entries."""
        linear = np.bincount(rows, self.weights[features], n)
        v = self.vectors[features]
        sums = np.stack([np.bincount(rows, v[:, k], n) for k in range(v.shape[1])], axis=1)
        squares = np.bincount(rows, (v * v).sum(axis=1), n)
        return self.bias + linear + 0.5 * ((sums * sums).sum(axis=1) - squares), sums

    def score(self, rows: np.ndarray, features: np.ndarray, n: int) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.raw(rows, features, n)[0], -30, 30)))

    def fit(self, docs: list[np.ndarray], labels: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = 0.1, decay: float = 1e-4, seed: int = 5) -> FactorizationMachine:
        """Logistic loss, AdaGrad steps, in a seeded order."""
        rng = np.random.default_rng(seed)
        share = min(max(labels.mean(), 1e-3), 1 - 1e-3)
        self.bias = float(np.log(share / (1 - share)))
        seen_w, seen_v, seen_b = np.full(len(self.weights), 1e-8), np.full(self.vectors.shape, 1e-8), 1e-8
        order = np.empty(0, np.int64)
        for _ in range(steps):
            if not len(order):
                order = rng.permutation(len(docs))
            own, order = order[:batch], order[batch:]
            rows = np.repeat(np.arange(len(own)), [len(docs[i]) for i in own])
            features = np.concatenate([docs[i] for i in own])
            raw, sums = self.raw(rows, features, len(own))
            wrong = (1.0 / (1.0 + np.exp(-np.clip(raw, -30, 30))) - labels[own]) / len(own)
            used = np.unique(features)
            g = np.bincount(features, wrong[rows], len(self.weights))[used] + decay * self.weights[used]
            each = wrong[rows, None] * (sums[rows] - self.vectors[features])
            gv = np.stack([np.bincount(features, each[:, k], len(self.weights)) for k in range(each.shape[1])], axis=1)[used] + decay * self.vectors[used]
            seen_w[used] += g * g
            self.weights[used] -= rate * g / np.sqrt(seen_w[used])
            seen_v[used] += gv * gv
            self.vectors[used] -= 0.1 * rate * gv / np.sqrt(seen_v[used])
            seen_b += wrong.sum() ** 2
            self.bias -= rate * wrong.sum() / np.sqrt(seen_b)
        return self


def _features(labelled: DataFrame, features: int) -> np.ndarray:
    """Sorted hashes of the terms whose document rates differ most between the classes, over all labelled rows."""
    n = {r.label: r.n for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    if not toxic or not clean:
        return np.empty(0, np.int32)
    counts = labelled.select("label", F.explode("terms").alias("term")).groupBy("term").agg(F.sum("label").alias("t"), F.count("*").alias("n")).where(F.col("n") >= MIN_DOCUMENTS)
    p, q = F.col("t") / toxic, (F.col("n") - F.col("t")) / clean
    both = F.col("n") / (toxic + clean)
    z = F.abs(p - q) / F.sqrt(both * (1 - both) * (1 / toxic + 1 / clean) + 1e-12)
    best = counts.select("term", z.alias("z")).where(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "term").limit(features)
    return np.array(sorted(r.term for r in best.collect()), np.int32)


def _chosen(terms: np.ndarray, docs: list[np.ndarray]) -> list[np.ndarray]:
    """The documents' terms as feature numbers, those that are no features left out."""
    out = []
    for d in docs:
        at = np.searchsorted(terms, d)
        at[at == len(terms)] = 0
        out.append(at[terms[at] == d] if len(terms) else at[:0])
    return out


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", features: int = FEATURES, sample_rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, FactorizationMachine]:
    """(features, machine) learned from the labelled rows outside the held-out fold.

    Rows with a null label or id take no part. With no labelled row of one
    class, the machine has no features and its score is the share of the other.
    The sample is uniform by a hash of the id, of ``sample_rows`` rows expected.
    """
    known = labels.select(F.col("doc_id").alias("__id"), F.col("toxic").cast("int").alias("label")).where(~held_out(F.col("__id")) & F.col("label").isNotNull())
    total = known.count()
    share = min(1.0, sample_rows / total) if total else 1.0
    sample = F.broadcast(known.where(F.pmod(F.xxhash64("__id", F.lit("sample")), F.lit(1_000_000)) < int(share * 1_000_000)))  # about sample_rows rows
    rows = docs.select(F.col(doc_id).alias("__id"), text_of(text).alias("text")).join(sample, "__id").select("label", "text")
    labelled = written(rows, "toxic-sample").mapInArrow(_with_terms, "label int, terms array<int>")
    terms = _features(labelled, features)
    found = labelled.mapInArrow(_features_only(terms), "label int, terms array<int>").collect()  # the few features present in each
    found.sort(key=lambda r: (r.label, r.terms))
    y = np.array([r.label for r in found], float)
    machine = FactorizationMachine(max(1, len(terms)), FACTORS)
    return terms, machine.fit([np.array(r.terms, np.int64) for r in found], y) if len(found) else machine


def _features_only(terms: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _chosen(terms, [np.array(x, np.int32) for x in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.astype(np.int32) for x in own], pa.list_(pa.int32()))], ["label", "terms"])

    return run


def score(docs: DataFrame, model: tuple[np.ndarray, FactorizationMachine], text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """All rows and columns of ``docs`` plus ``toxic_score`` (0 to 1); nulls and empty texts get the score of no terms."""
    terms, machine = model
    shared = docs.sparkSession.sparkContext.broadcast((terms, machine.bias, machine.weights, machine.vectors))
    columns = [c for c in docs.columns if c != "toxic_score"]
    plain = docs.select(*columns).withColumn("__text", text_of(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, *learned = shared.value
        machine = FactorizationMachine.of(*learned)
        for batch in batches:
            for part, buf, offs in row_chunks(batch, "__text"):
                own = _chosen(terms, document_terms(buf, offs))
                rows = np.repeat(np.arange(len(own)), [len(x) for x in own])
                value = machine.score(rows, np.concatenate(own).astype(np.int64), len(own))
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(columns))), pa.array(value)], [*columns, "toxic_score"])

    out = plain.select(*columns).schema.add("toxic_score", "double")
    return plain.mapInArrow(run, out)


def predict(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """All rows and columns of ``docs`` plus ``toxic_score`` and ``toxic_predicted`` (1 if the score is 0.5 or more).

    An empty table gives an empty result; repeated rows get equal scores.
    """
    scored = score(docs, fit(docs, labels, text, doc_id), text, doc_id)
    return scored.withColumn("toxic_predicted", (F.col("toxic_score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that ``predict`` does not call toxic, with their own columns whatever these are named."""
    return keeping_own(docs, ("toxic_score", "toxic_predicted"), lambda d: predict(d, labels, text, doc_id).where("toxic_predicted = 0"))
