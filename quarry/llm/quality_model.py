"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE_WORDS words (longer ones in
documents of over MAX_PASSAGES passages, so that a bag is bounded and all of
the text counts).  A passage is a vector of surface statistics and hashed word
shares.  A layer encodes it, a gated attention (tanh times sigmoid) weighs it
among the passages of its document, and the weighted sum of the encoded
passages gives the score.  Only document labels are learned from.

Bounds: SAMPLE_ROWS labelled rows with MAX_PASSAGES passages each at most;
the model has a few thousand numbers.

Cases: a null or empty text is a bag of one passage without words.  Rows that
share a ``doc_id`` are scored one by one.  Without labels of both kinds every
score is the share of label 1 (0 without any).  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import buffers, crc_mod, labelled_sample, runs, scored, table, words

#: At most so many labelled rows are learned from.
SAMPLE_ROWS = 6_000
PASSAGE_WORDS = 32
MAX_PASSAGES = 256
BUCKETS = 64
ENCODED, GATES = 24, 12
EPOCHS, BATCH, RATE, DECAY = 12, 128, 4e-3, 1e-4
CUT = 0.3

_CLASSES = [np.zeros(256, dtype=bool) for _ in range(6)]
for _mask, _bytes in zip(_CLASSES, (b"#*$%&|<>", bytes(range(65, 91)), b"0123456789", b".,;:!?", bytes(range(128, 256)), b"!")):
    _mask[list(_bytes)] = True
WIDTH = BUCKETS + len(_CLASSES) + 6


def passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(vectors of all passages, first passage of each row)."""
    raw, off = buffers(texts)
    out, firsts, at = [], [], 0
    for i, j in runs(off):
        part = off[i:j + 1]
        x, first = _passages(raw[part[0]:part[-1]], part - part[0])
        out.append(x)
        firsts.append(first + at)
        at += len(x)
    return (np.concatenate(out), np.concatenate(firsts)) if out else (np.zeros((0, WIDTH), np.float32), np.zeros(0, np.int64))


def _passages(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(off) - 1
    h, row, start, end = words(raw, off)
    n_words = np.bincount(row, minlength=n)
    length = np.maximum(PASSAGE_WORDS, -(-n_words // MAX_PASSAGES))
    count = np.maximum(1, -(-n_words // length))
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    first_word = np.concatenate([[0], np.cumsum(n_words)[:-1]])
    p = first[row] + (np.arange(len(h)) - first_word[row]) // length[row]
    total = int(count.sum())
    size = np.bincount(p, minlength=total)
    per = np.maximum(size, 1)
    x = np.zeros((total, WIDTH), dtype=np.float32)
    if len(h):
        bucket = p * BUCKETS + (h >> np.uint64(58)).astype(np.int64)
        x[:, :BUCKETS] = np.sqrt(np.bincount(bucket, minlength=total * BUCKETS).reshape(total, BUCKETS) / per[:, None])
        chars = np.bincount(p, weights=end - start, minlength=total)
        for k, mask in enumerate(_CLASSES):
            sums = np.zeros(len(raw) + 1, dtype=np.int32)
            np.cumsum(mask[raw], out=sums[1:])
            x[:, BUCKETS + k] = np.sqrt(np.bincount(p, weights=sums[end] - sums[start], minlength=total) / np.maximum(chars, 1))
        same = np.zeros(len(h), dtype=bool)
        same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
        order = np.lexsort((h, p))
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (p[order][1:] != p[order][:-1])
        k = BUCKETS + len(_CLASSES)
        x[:, k] = np.bincount(p, weights=same, minlength=total) / per
        x[:, k + 1] = np.bincount(p[order], weights=new, minlength=total) / per
        x[:, k + 2] = np.log1p(chars / per)
        x[:, k + 3] = np.bincount(p, weights=end - start == 1, minlength=total) / per
    k = BUCKETS + len(_CLASSES) + 4
    x[:, k] = np.log1p(np.repeat(n_words, count)) / 4
    x[:, k + 1] = size == 0
    return x, first


class Model:
    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.mean, self.spread = np.zeros(WIDTH, np.float32), np.ones(WIDTH, np.float32)
        shapes = {"w": (WIDTH, ENCODED), "b": (ENCODED,), "v": (ENCODED, GATES), "u": (ENCODED, GATES), "a": (GATES,), "c": (ENCODED,), "d": (1,)}
        self.p = {k: (r.normal(size=s) / np.sqrt(s[0])).astype(np.float32) if k not in "bd" else np.zeros(s, np.float32) for k, s in shapes.items()}
        self.constant: float | None = None

    def forward(self, x: np.ndarray, first: np.ndarray):
        q = self.p
        h = np.tanh((x - self.mean) / self.spread @ q["w"] + q["b"])
        t, g = np.tanh(h @ q["v"]), 1 / (1 + np.exp(-(h @ q["u"])))
        e = (t * g) @ q["a"]
        bag = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(x))))
        e = np.exp(e - np.maximum.reduceat(e, first)[bag])
        a = e / np.add.reduceat(e, first)[bag]
        z = np.add.reduceat(a[:, None] * h, first)
        return h, t, g, a, z, bag, 1 / (1 + np.exp(-np.clip(z @ q["c"] + q["d"], -30, 30)))

    def score(self, texts: pa.Array) -> np.ndarray:
        x, first = passages(texts)
        if self.constant is not None or not len(first):
            return np.full(len(first), self.constant or 0.0)
        return self.forward(x, first)[-1].astype(np.float64)

    def gradients(self, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        q = self.p
        h, t, g, a, z, bag, s = self.forward(x, first)
        ds = (s - y) / len(y)
        dz = (ds[:, None] * q["c"])[bag]
        da = (dz * h).sum(axis=1)
        de = (a * (da - np.add.reduceat(a * da, first)[bag]))[:, None]
        dt, dg = de * q["a"] * g * (1 - t * t), de * q["a"] * t * g * (1 - g)
        dh = (a[:, None] * dz + dt @ q["v"].T + dg @ q["u"].T) * (1 - h * h)
        return {"w": ((x - self.mean) / self.spread).T @ dh, "b": dh.sum(axis=0), "v": h.T @ dt, "u": h.T @ dg,
                "a": (de * t * g).sum(axis=0), "c": z.T @ ds, "d": ds.sum(keepdims=True)}

    def train(self, x: np.ndarray, first: np.ndarray, y: np.ndarray, seed: int = 7) -> None:
        """Adam over shuffled batches of bags."""
        self.mean, self.spread = x.mean(axis=0), x.std(axis=0) + 0.05
        r, last = np.random.default_rng(seed), np.append(first, len(x))
        m1, m2 = ({n: np.zeros_like(v) for n, v in self.p.items()} for _ in range(2))
        k = 0
        for _ in range(EPOCHS):
            for bags in np.array_split(r.permutation(len(y)), max(1, len(y) // BATCH)):
                size = last[bags + 1] - last[bags]
                at = np.concatenate([[0], np.cumsum(size)[:-1]])
                rows = np.repeat(last[bags] - at, size) + np.arange(size.sum())
                k += 1
                for n, g in self.gradients(x[rows], at, y[bags]).items():
                    g = g + DECAY * self.p[n]
                    m1[n] = 0.9 * m1[n] + 0.1 * g
                    m2[n] = 0.999 * m2[n] + 0.001 * g * g
                    self.p[n] = (self.p[n] - RATE * (m1[n] / (1 - 0.9 ** k)) / (np.sqrt(m2[n] / (1 - 0.999 ** k)) + 1e-8)).astype(np.float32)


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x, first = passages(batch.column(1))
        last = np.append(first, len(x))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([x[i:j].astype(np.float16).tobytes() for i, j in zip(last, last[1:])], pa.binary())], ["doc_id", "label", "bag"])


def fit(docs: DataFrame, labels: DataFrame, held: Column, rows: int = SAMPLE_ROWS) -> Model:
    """``held``: true for the rows of ``labels`` that may be learned from."""
    sample = labelled_sample(docs, labels, "quality", held, rows)
    bags = sample.mapInArrow(_bags, "doc_id long, label int, bag binary").toPandas().sort_values(["doc_id", "label"])
    y = (bags["label"].to_numpy() > 0).astype(np.float32)
    model = Model()
    if len(set(y)) < 2:
        model.constant = float(y.mean()) if len(y) else 0.0
        return model
    own = [np.frombuffer(b, np.float16).reshape(-1, WIDTH) for b in bags["bag"]]
    size = np.array([len(b) for b in own])
    model.train(np.concatenate(own).astype(np.float32), np.concatenate([[0], np.cumsum(size)[:-1]]), y)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with a column ``score`` from 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = shared.value.score(batch.column(batch.schema.get_field_index("text")))
            yield batch.append_column("score", pa.array(s, pa.float64()))

    return docs.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in docs.dtypes) + ", score double")


def op5_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"), crc_mod(5) != 0)
    return scored(docs, lambda d: score(d, model), 5, 0, CUT)
