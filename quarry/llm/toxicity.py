"""Toxicity by a linear classifier over character n-grams, with features scaled
by naive Bayes log-count ratios.

An n-gram is a run of n UTF-8 bytes of the text with A-Z lower-cased; a
feature is one of 2^20 hashed n-grams, present or not.  Spark counts the
documents of each label that hold a feature.  The features with the largest
log-count ratios (weighed by their support) are kept, each document becomes
one bit a feature, and a logistic regression is fitted to the bits times the
ratios.  Scoring looks up every n-gram of the whole text in one table of
fixed size.

Bounds: SAMPLE_ROWS labelled rows are learned from; their bits are
SAMPLE_ROWS * FEATURES / 8 bytes; the broadcast table has 2^20 entries.

Cases: a null or empty text has no feature and gets the score of the bias.
Rows that share a ``doc_id`` are scored one by one.  Without labels of both
kinds every score is the share of label 1 (0 without any).  Other columns
are ignored; ``reject`` passes them through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import LOWER, buffers, crc_mod, labelled_sample, mix64, runs, scored, table, unused

#: At most so many labelled rows are learned from.
SAMPLE_ROWS = 12_000
ORDERS = (4, 5, 6)
HASH_BITS = 20
#: Odd, so that an n-gram's hash keeps all bits of its last characters.
SPREAD = np.uint64(0x9E3779B97F4A7C15)
FEATURES = 2048
SMOOTHING = 1.0
RIDGE = 2e-4
#: A row of label 1 weighs as much as so many of label 0.
LIFT = 4.0
CUT = 0.7


def ngrams(raw: np.ndarray, off: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, hashed n-gram of characters), order by order; none crosses rows."""
    if not len(raw):
        return
    low = np.frombuffer(LOWER[raw].tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n, begins = len(low), np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[off]
    row = np.repeat(np.arange(len(off) - 1), np.diff(begins))
    room = begins[1:][row] - np.arange(n)  # characters to the end of the row
    gram = low.copy()
    for order in range(2, max(ORDERS) + 1):
        gram = gram[:-1] * SPREAD + low[order - 1:] if n >= order else gram[:0]
        if order in ORDERS:
            at = np.flatnonzero(room[:len(gram)] >= order)
            key = gram[at] * np.uint64(len(ORDERS) + 1) + np.uint64(order - min(ORDERS))
            yield row[at], (mix64(key) >> np.uint64(64 - HASH_BITS)).astype(np.int64)


def present(raw: np.ndarray, off: np.ndarray, column: np.ndarray) -> np.ndarray:
    """The distinct (row, feature) pairs of a batch, as row * FEATURES + feature,
    for the features that ``column`` numbers (-1: not kept)."""
    found = []
    for i, j in runs(off):
        part = off[i:j + 1]
        for row, h in ngrams(raw[part[0]:part[-1]], part - part[0]):
            c = column[h]
            hit = np.flatnonzero(c >= 0)
            found.append(np.unique((row[hit] + i) * FEATURES + c[hit]))
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either label that hold a feature, summed over the task's rows."""
    seen = np.zeros((2, 1 << HASH_BITS), dtype=np.int64)
    for batch in batches:
        raw, off = buffers(batch.column(0))
        label = np.asarray(batch.column(1).to_pylist(), dtype=np.int64)
        for i in range(len(label)):
            own = [h for _, h in ngrams(raw[off[i]:off[i + 1]], np.array([0, off[i + 1] - off[i]]))]
            if own:
                seen[int(label[i] > 0), np.unique(np.concatenate(own))] += 1
    at = np.flatnonzero(seen.any(axis=0))
    for k in range(0, len(at), 50_000):
        part = at[k:k + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(seen[1, part]), pa.array(seen[0, part])], ["feature", "ones", "zeros"])


def _bits(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = buffers(batch.column(0))
            x = np.zeros((len(off) - 1, FEATURES), dtype=bool)
            x.reshape(-1)[present(raw, off, shared.value)] = True
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([r.tobytes() for r in np.packbits(x, axis=1)], pa.binary())], ["label", "bits"])

    return run


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, steps: int = 300, lift: float = LIFT) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by accelerated gradient steps; ``lift`` weighs the rows of label 1."""
    n = len(y)
    v = np.ones(x.shape[1], np.float32)
    for _ in range(30):  # the largest eigenvalue of x'x / n bounds the curvature
        v = x.T @ (x @ (v / (np.linalg.norm(v) + 1e-12))) / n
    weight = np.where(y > 0, lift, 1.0)
    rate = 1 / (0.25 * lift * (1.2 * float(np.linalg.norm(v)) + 1) + ridge)
    w, b = np.zeros(x.shape[1], np.float32), float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    vw, vb, pw, pb = w, b, w, b
    for k in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ vw + vb, -30, 30)))
        g = ((p - y) * weight).astype(np.float32)
        w, b = vw - np.float32(rate) * (x.T @ g / n + np.float32(ridge) * vw), vb - rate * float(g.mean())
        m = k / (k + 3)
        vw, vb, pw, pb = w + np.float32(m) * (w - pw), b + m * (b - pb), w, b
    return w, b


class Model:
    """``column`` numbers the kept features, ``weight`` has theirs, ``bias`` the rest."""

    def __init__(self, column: np.ndarray, weight: np.ndarray, bias: float):
        self.column, self.weight, self.bias = column, weight, bias

    def score(self, texts: pa.Array) -> np.ndarray:
        raw, off = buffers(texts)
        pairs = present(raw, off, self.column)
        z = np.bincount(pairs // FEATURES, weights=self.weight[pairs % FEATURES], minlength=len(off) - 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, held: Column, rows: int = SAMPLE_ROWS) -> Model:
    """``held``: true for the rows of ``labels`` that may be learned from."""
    sample = labelled_sample(docs, labels, "toxic", held, rows)
    none = np.full(1 << HASH_BITS, -1, dtype=np.int16)
    n = {r["label"] > 0: r["n"] for r in sample.groupBy((F.col("label") > 0).cast("int").alias("label")).agg(F.count("*").alias("n")).collect()}
    ones, zeros = n.get(True, 0), n.get(False, 0)
    if not ones or not zeros:
        return Model(none, np.zeros(FEATURES), 30.0 if ones else -30.0)
    counts = sample.select("text", "label").mapInArrow(_counts, "feature long, ones long, zeros long").groupBy("feature").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
    ratio = F.log((F.col("ones") + SMOOTHING) / (ones + 2 * SMOOTHING)) - F.log((F.col("zeros") + SMOOTHING) / (zeros + 2 * SMOOTHING))
    support = F.col("ones") / ones - F.col("zeros") / zeros
    kept = (counts.select("feature", ratio.alias("ratio"), F.abs(ratio * support).alias("worth"))
            .orderBy(F.desc("worth"), "feature").limit(FEATURES).collect())
    column = none
    ratios = np.zeros(FEATURES, dtype=np.float32)
    for k, r in enumerate(kept):
        column[r["feature"]], ratios[k] = k, r["ratio"]
    shared = docs.sparkSession.sparkContext.broadcast(column)
    bits = sample.select("text", "label").mapInArrow(_bits(shared), "label int, bits binary").toPandas()
    y = (bits["label"].to_numpy() > 0).astype(np.float32)
    x = np.unpackbits(np.frombuffer(b"".join(bits["bits"]), np.uint8).reshape(len(y), -1), axis=1)[:, :FEATURES] * ratios
    w, b = logistic(x, y)
    return Model(column, (w * ratios).astype(np.float64), b)


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with a column ``name`` from 0 to 1, in place of one of that name."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = shared.value.score(batch.column(batch.schema.get_field_index("text")))
            yield batch.append_column(name, pa.array(s, pa.float64()))

    return docs.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in docs.dtypes) + f", `{name}` double")


def reject(docs: DataFrame, labels: DataFrame, held: Column, cut: float = CUT) -> DataFrame:
    """The documents that score under ``cut``, with the columns they have."""
    name = unused("toxicity", docs)
    return score(docs, fit(docs, labels, held), name).filter(F.col(name) < cut).drop(name)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"), crc_mod(3) != 1)
    return scored(docs, lambda d: score(d, model), 3, 1, CUT)
