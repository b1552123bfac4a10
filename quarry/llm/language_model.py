"""A hierarchical Pitman-Yor language model over spelled tokens.

Tokens are the lower-cased words of a text and one end; each is spelled in
bytes, and the model predicts every byte from the CONTEXT bytes before it, over
word boundaries, so that words never seen have a probability too.  A context's
restaurant has the restaurant of the context
without its first byte as parent, down to a uniform base.  Customers are seated
by the Chinese-restaurant process given the parent's predictions, tables become
customers of the parent, and each Gibbs sweep seats all of them anew under the
predictions of the parents' seating of the sweep before.  The predictions of the
sweeps after the first are averaged; their logarithms summed over a text score it.

Spark counts the (CONTEXT+1)-byte runs of the training texts.  Restaurants of
contexts over UPPER bytes are seated in the task that holds their last bytes, about
CHUNK_RUNS runs at a time, sweep after sweep from the seating before;
only the tables at (UPPER+1)-byte runs, of which there are at most
256^(UPPER+1), reach the driver, which seats the restaurants above.  For
scoring, documents are dealt into splits of bounded size; each split asks once
for every distinct run and word it holds and gets its answers by a join.

Cases: a null or empty text is the end token alone.  Rows that share a
``doc_id`` are scored one by one.  An empty training set leaves the uniform
base.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import _IS_WHITE, LOWER, buffers, checkpointed, crc_mod, runs, table, text_or_empty, words

CONTEXT = 5
UPPER = 2
#: Discounts by context length, the strength of all restaurants, and the Gibbs sweeps (the first is not averaged).
DISCOUNTS = (0.05, 0.2, 0.3, 0.4, 0.5, 0.6)
STRENGTH = 1.0
SWEEPS = 3
#: Bytes of text in one scoring split, about.
SPLIT_BYTES = 20_000_000
#: Runs that a task seats at a time, about (never less than those that share UPPER + 1 bytes of context).
CHUNK_RUNS = 500_000
#: Keys that a task gathers before it merges equal ones.
GATHERED = 600_000
BASE_ADD = 0.1

SPACE, END = 0x20, 0x0A
END_WORD = np.uint64(0)  # the end token's key among the word hashes
WORD, RUN = 1, 0


def spelled(raw: np.ndarray, off: np.ndarray):
    """The spelling of the rows: each byte run that predicts its last byte, the
    row of each, the word hashes with their rows."""
    h, row, start, end = words(raw, off)
    n_rows = len(off) - 1
    size = end - start
    out = np.full(int(size.sum()) + len(h) + (CONTEXT + 1) * n_rows, END, dtype=np.uint64)
    first = np.cumsum(size) - size + np.arange(len(h)) + (CONTEXT + 1) * row + CONTEXT
    at = np.repeat(first - start, size)
    chars = np.flatnonzero(~_IS_WHITE[raw])
    out[at + chars] = LOWER[raw[chars]]
    out[first + size] = SPACE
    length = np.bincount(row, weights=size + 1, minlength=n_rows).astype(np.int64) + CONTEXT + 1
    # runs_[i] covers out[i : i + CONTEXT + 1]: the nearest context byte stands highest, the
    # predicted one lowest; those that end in a row's padding are not predictions
    runs_ = out[CONTEXT:].copy()
    for k in range(CONTEXT):
        runs_ |= out[k:len(out) - CONTEXT + k] << np.uint64(8 * (k + 1))
    ok = np.ones(len(out), dtype=bool)
    ok[(np.cumsum(length) - length)[:, None] + np.arange(CONTEXT)] = False
    return runs_[ok[CONTEXT:]], np.repeat(np.arange(n_rows), length - CONTEXT), h, row


def _tally(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    k, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, n = k[order], n[order]
    first = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, np.int64)
    return k[first], np.add.reduceat(n, first) if len(k) else n


class Tally:
    """Distinct keys with their training counts; merged whenever many have come together."""

    def __init__(self):
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.size = self.kept = 0

    def add(self, keys: np.ndarray, trains: np.ndarray | None = None) -> None:
        for own, weight in ((keys, 1),) if trains is None else ((keys[trains], 1), (keys[~trains], 0)):
            k, n = np.unique(own, return_counts=True)
            self.keys.append(k)
            self.counts.append(n * weight)
            self.size += len(k)
        if self.size > GATHERED + self.kept:
            k, n = _tally(self.keys, self.counts)
            self.keys, self.counts, self.size, self.kept = [k], [n], 0, len(k)

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        return _tally(self.keys, self.counts)


def _rows(kind: int, tally: Tally) -> Iterator[pa.RecordBatch]:
    k, n = tally.merged()
    for i in range(0, len(k), 100_000):
        part = k[i:i + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), kind, np.int8)), pa.array(part.view(np.int64)), pa.array(n[i:i + 100_000])], ["kind", "key", "n"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs and words of the task's documents, with how often training ones have them."""
    seen, spoken = Tally(), Tally()
    for batch in batches:
        trains = np.asarray(batch.column(1))
        raw, off = buffers(batch.column(0))
        for i, j in runs(off):
            part, train = off[i:j + 1], trains[i:j]
            g, owner, h, row = spelled(raw[part[0]:part[-1]], part - part[0])
            seen.add(g, train[owner])
            spoken.add(h[train[row]])
            spoken.add(np.full(int(train.sum()), END_WORD))
    yield from _rows(RUN, seen)
    yield from _rows(WORD, spoken)


def counted(docs: DataFrame) -> DataFrame:
    """(kind, key, n) of all runs (n may be 0) and training words; ``docs`` has text and train."""
    own = docs.select(text_or_empty().alias("text"), "train").mapInArrow(_count, "kind byte, key long, n long")
    return own.groupBy("kind", "key").agg(F.sum("n").alias("n"))


def seat(customers: np.ndarray, parent: np.ndarray, room: np.ndarray, rooms: int, discount: float, rng) -> np.ndarray:
    """Tables of every (restaurant, dish) after its customers came in one by
    one.  ``parent`` is the parent's prediction of the dish, ``room`` numbers
    the restaurants.  Past 64 customers of a dish, those that come in blocks of
    a 32nd of the seated share one chance of a new table."""
    tables = (customers > 0).astype(np.int64)
    seated, active = 1, np.flatnonzero(customers > 1)
    while len(active):
        block = max(1, seated // 32) if seated >= 64 else 1
        open_ = np.bincount(room, weights=tables, minlength=rooms)
        new = (STRENGTH + discount * open_[room[active]]) * parent[active]
        coming = np.minimum(block, customers[active] - seated)
        tables[active] += rng.binomial(coming, new / (new + seated - discount * tables[active]))
        seated += block
        active = active[customers[active] > seated]
    return tables


class Level:
    """Predictions of the restaurants of one context length, from their seating."""

    def __init__(self, keys: np.ndarray, customers: np.ndarray, tables: np.ndarray, discount: float):
        self.keys, self.discount = keys, discount
        room = keys >> np.uint64(8)
        self.rooms, at = np.unique(room, return_inverse=True)
        self.total = np.bincount(at, weights=customers, minlength=len(self.rooms))
        self.open = np.bincount(at, weights=tables, minlength=len(self.rooms))
        self.own = np.maximum(customers - discount * tables, 0.0) * (customers > 0)

    def predict(self, keys: np.ndarray, parent: np.ndarray) -> np.ndarray:
        own, total, open_ = (_find(self.keys, keys, self.own), *(_find(self.rooms, keys >> np.uint64(8), x) for x in (self.total, self.open)))
        return (own + (STRENGTH + self.discount * open_) * parent) / (STRENGTH + total)


def _find(table_: np.ndarray, keys: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(table_):
        return np.zeros(len(keys))
    at = np.minimum(np.searchsorted(table_, keys), len(table_) - 1)
    return np.where(table_[at] == keys, values[at], 0.0)


#: An odd number whose multiples spread over the highest bits.
SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Lookup:
    """Values by key for many keys in any order.  A key has one slot of a table
    of two to four times their number; the few that share theirs are searched."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        self.shift = np.uint64(64 - max(10, (2 * len(keys)).bit_length()))
        self.at = np.zeros(1 << (64 - int(self.shift)), dtype=np.int32)
        self.at[self._slot(self.keys)] = np.arange(len(keys), dtype=np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * SPREAD >> self.shift).view(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self.at[self._slot(keys)]
        other = np.flatnonzero(self.keys[at] != keys)
        at[other] = np.searchsorted(self.keys, keys[other])
        return self.values[at]


def shorter(keys: np.ndarray, context: int, k: int) -> np.ndarray:
    """Runs with ``context`` bytes of context, with the k nearest of them."""
    cut = np.uint64(8 * (1 + context - k))
    return (keys >> cut << np.uint64(8)) | (keys & np.uint64(0xFF))


def predictions(levels: list[Level], keys: np.ndarray, context: int) -> np.ndarray:
    """Of runs with ``context`` bytes of context, by levels from none on."""
    p = np.full(len(keys), 1 / 256)
    for k, level in enumerate(levels):
        p = level.predict(shorter(keys, context, k), p)
    return p


def _seated(keys: np.ndarray, customers: np.ndarray, levels: list[Level], context: int, stop: int, rng) -> tuple[list[Level], np.ndarray, np.ndarray]:
    """Seat context lengths ``context`` down to ``stop`` given the predictions of
    ``levels``, a sweep before's (none yet: those of the base).
    Returns the levels, longest context last, and the customers that go on."""
    out = []
    for k in range(context, stop - 1, -1):
        parent = predictions(levels[:k], keys, k)
        room, at = np.unique(keys >> np.uint64(8), return_inverse=True)
        tables = seat(customers, parent, at, len(room), DISCOUNTS[k], rng)
        out.append(Level(keys, customers, tables, DISCOUNTS[k]))
        if k:
            keys, customers = _tally([shorter(keys, k, k - 1)], [tables])
    return out[::-1], keys, customers


#: The bits of a run below its stem, the UPPER + 1 nearest bytes of context.
BELOW_STEM = 8 * (CONTEXT - UPPER)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The task's runs and counts, which come sorted, about CHUNK_RUNS at a time
    and never cut within a stem."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size, low = 0, np.uint64(BELOW_STEM)
    for b in batches:
        k, n = b.column(0).to_numpy().view(np.uint64), b.column(1).to_numpy()
        if size >= CHUNK_RUNS and len(k):
            at = int(np.searchsorted(k >> low, held[-1][0][-1] >> low, side="right"))
            held.append((k[:at], n[:at]))
            k, n = k[at:], n[at:]
            if len(k):
                yield np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])
                held, size = [], 0
        if len(k):
            held.append((k, n))
            size += len(k)
    if held:
        yield np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])


def _lower(keys: np.ndarray, n: np.ndarray, upper: list[list[Level]]):
    """For every sweep the seated restaurants over UPPER bytes of a chunk's runs,
    under those of the sweep before and its upper levels, and the customers that go on."""
    own: list[Level] = []
    for sweep, levels in enumerate(upper):
        rng = np.random.default_rng([sweep, int(keys[0])])
        own, up, customers = _seated(keys, n, [*levels, *own] if levels else [], CONTEXT, UPPER + 1, rng)
        yield own, up, customers


def _up(upper):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, n in _chunks(batches):
            *_, (_, up, customers) = _lower(keys, n, upper.value)
            yield pa.RecordBatch.from_arrays([pa.array(up.view(np.int64)), pa.array(customers)], ["key", "n"])

    return run


def _predicted(upper):
    """Averages over the sweeps, each sweep's lower levels under the upper ones seated from them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sweeps = len(upper.value) - 1
        for keys, n in _chunks(batches):
            total, counted_ = 0.0, 0
            for sweep, (own, _, _) in enumerate(_lower(keys, n, upper.value[:sweeps])):
                if sweep or sweeps == 1:
                    total, counted_ = total + predictions([*upper.value[sweep + 1], *own], keys, CONTEXT), counted_ + 1
            value = np.log10(total / counted_)
            for i in range(0, len(keys), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(keys[i:i + 100_000].view(np.int64)), pa.array(value[i:i + 100_000])], ["key", "value"])

    return run


def fit(run_counts: DataFrame, sweeps: int = SWEEPS) -> DataFrame:
    """(key, value): log10 of the averaged prediction of every run in ``run_counts`` (key, n)."""
    sc = run_counts.sparkSession.sparkContext
    dealt = checkpointed(run_counts.repartition(F.shiftright("key", BELOW_STEM)).sortWithinPartitions("key").select("key", "n"))
    upper: list[list[Level]] = [[]]
    for sweep in range(sweeps):
        shared = sc.broadcast(upper)
        # at most 256^(UPPER+1) rows
        tops = (dealt.mapInArrow(_up(shared), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).toPandas().sort_values("key"))
        keys, n = tops["key"].to_numpy(np.int64).view(np.uint64), tops["n"].to_numpy(np.int64)
        levels, _, _ = _seated(keys, n, upper[-1][:UPPER + 1], UPPER, 0, np.random.default_rng([7, sweep]))
        upper = [*upper, levels]
    return dealt.mapInArrow(_predicted(sc.broadcast(upper)), "key long, value double")


def _ask(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
    """Every distinct run and word of a split, once."""
    raw, off = buffers(group.column("text"))
    seen, spoken = Tally(), Tally()
    for i, j in runs(off):
        part = off[i:j + 1]
        g, _, h, _ = spelled(raw[part[0]:part[-1]], part - part[0])
        seen.add(g)
        spoken.add(h)
    spoken.add(np.array([END_WORD]))
    batches = [*_rows(RUN, seen), *_rows(WORD, spoken)]
    t = pa.Table.from_batches(batches).drop_columns(["n"])
    return t.add_column(0, "split", pa.array(np.full(len(t), key[0].as_py(), np.int64)))


def _score(n: int, v: int):
    def run(group: pa.Table, answers: pa.Table) -> pa.Table:
        kind, keys, value = (answers.column(c).to_numpy() for c in ("kind", "key", "value"))
        told = {}
        for which in (RUN, WORD):
            own = kind == which
            told[which] = Lookup(keys[own].view(np.uint64), np.nan_to_num(value[own]))
        raw, off = buffers(group.column("text"))
        total, base, known, count = (np.zeros(len(off) - 1) for _ in range(4))
        add = lambda c: np.log10((c + BASE_ADD) / (n + BASE_ADD * (v + 1)))
        end = float(told[WORD](np.array([END_WORD]))[0])
        for i, j in runs(off):
            part = off[i:j + 1]
            g, owner, h, row = spelled(raw[part[0]:part[-1]], part - part[0])
            total[i:j] = np.bincount(owner, weights=told[RUN](g), minlength=j - i)
            c = told[WORD](h)
            base[i:j] = np.bincount(row, weights=add(c), minlength=j - i) + add(end)
            known[i:j] = np.bincount(row, weights=c > 0, minlength=j - i) + (end > 0)
            count[i:j] = np.bincount(row, minlength=j - i) + 1
        return pa.table({"doc_id": group.column("doc_id"), "held_out": pa.compute.invert(group.column("train")),
                         "n_tokens": pa.array(count.astype(np.int64)), "n_known": pa.array(known.astype(np.int64)),
                         "train_tokens": pa.array(np.full(len(count), n, np.int64)), "base_score": pa.array(base), "score": pa.array(total)})

    return run


def score(docs: DataFrame, train: Column) -> DataFrame:
    """Scores of all rows of ``docs`` under a model of those that meet ``train``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), train.alias("train"))
    counts = checkpointed(counted(docs))
    total = counts.filter((F.col("kind") == WORD) & (F.col("n") > 0)).agg(F.sum("n").alias("n"), F.count("n").alias("v")).first()
    volume = docs.agg(F.sum(F.octet_length("text") + 2).alias("b")).first()["b"] or 0
    splits = max(1, math.ceil(volume / SPLIT_BYTES))
    model = (fit(counts.filter(F.col("kind") == RUN).select("key", "n")).withColumn("kind", F.lit(RUN).cast("byte"))
             .unionByName(counts.filter(F.col("kind") == WORD).select("key", F.col("n").cast("double").alias("value"), "kind")))
    dealt = docs.withColumn("split", F.pmod(F.xxhash64("doc_id", "text"), F.lit(splits)))
    asked = dealt.groupBy("split").applyInArrow(_ask, "split long, kind byte, key long")
    answers = asked.join(model.hint("shuffle_hash"), ["kind", "key"], "left").select("split", "kind", "key", "value")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return dealt.groupBy("split").cogroup(answers.groupBy("split")).applyInArrow(_score(total["n"] or 0, total["v"] or 0), schema)


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), crc_mod(10) != 0)
