"""Near-duplicate documents by BagMinHash.

A document is the bag of its five-word shingles, each with its number of
occurrences.  BagMinHash gives REGISTERS minima whose agreement has the
weighted Jaccard similarity of two bags as its expectation: every shingle owns
Poisson processes over its discretised weight, one for each dyadic range of
occurrences (1, 2, 3-4, 5-8, ...), whose points are dealt at random to the
registers and thinned to the weight at hand.  Points come in ascending order,
so a process stops as soon as it is past what any register can still take.

Registers are banded.  Members of a bucket are first held against one hub of
it, which joins most copies of a text.  A byte of each register tells how many
of two texts agree; a pair at the least similarity has too few of them once in
ten thousand times (a byte can only agree too often).  The shared multiset of
both whole texts decides about the others.  Then all members of a bucket that
still holds several classes are held against each other, class by class: the
bucket is cut into blocks, a task has two blocks at a time, and a pair counts
in the first band that it shares.  Signatures are compared first; texts move
only for members with a pair that passes, and a task gives verified links that
join two classes, so its output grows with its members and not with the pairs.
The work in a task does grow with the square of a block.  Copies of a text are grouped before by a 128-bit digest and
have one representative.  Links are joined into classes by label propagation
with pointer jumping; no step gathers a bucket or a class.

Cases: a null text is an empty one.  Texts under five words have all their
words as one shingle; empty texts match only each other.  Rows that share a
``doc_id`` may be of different classes.  The class is named by its smallest
``doc_id`` (null last).  Other columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import buffers, written, mix64, runs, table, words

SHINGLE_WORDS = 5
MIN_SIMILARITY = 0.8
BANDS, BAND_ROWS = 28, 5
REGISTERS = BANDS * BAND_ROWS
#: Members of a block; a task compares the members of two blocks at a time.
BLOCK = 512
#: Pairs whose signatures are compared at once.
PAIRS_AT_ONCE = 1 << 14
#: Chance that a pair at the least similarity is passed over for its signatures.
MISS = 1e-4
#: Bits of the filter of texts that share a bucket (8 MB, whatever the input; a full one only lets more texts through).
FILTER_BITS = 1 << 26

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def shingles(raw: np.ndarray, off: np.ndarray, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every shingle, row by row."""
    h, row, _, _ = words(raw, off)
    count = np.bincount(row, minlength=len(off) - 1)
    first = np.cumsum(count) - count
    starts, sizes = [np.flatnonzero(row[:len(row) - size + 1] == row[size - 1:])] if len(h) >= size else [], [size]
    if not starts:
        starts = [np.zeros(0, np.int64)]
    for n in range(1, size):
        starts.append(first[count == n])
        sizes.append(n)
    out, rows = [], []
    for at, n in zip(starts, sizes):
        s = np.full(len(at), n, dtype=np.uint64)
        for k in range(n):
            s = mix64(s * _GOLD + h[at + k])
        out.append(s)
        rows.append(row[at])
    s, r = np.concatenate(out), np.concatenate(rows)
    order = np.argsort(r, kind="stable")
    return s[order], r[order]


def bags(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle, occurrences), each distinct shingle of a row once."""
    s, r = shingles(raw, off)
    order = np.lexsort((s, r))
    s, r = s[order], r[order]
    first = np.flatnonzero(np.append(True, (s[1:] != s[:-1]) | (r[1:] != r[:-1]))) if len(s) else np.zeros(0, np.int64)
    return r[first], s[first], np.diff(np.append(first, len(s)))


def _step(k: int) -> np.uint64:
    return np.uint64(k * int(_GOLD) & 0xFFFFFFFFFFFFFFFF)


def _unit(x: np.ndarray) -> np.ndarray:
    return ((x >> np.uint64(11)).astype(np.float64) + 1) * 2.0 ** -53


def signatures(row: np.ndarray, shingle: np.ndarray, weight: np.ndarray, n_rows: int, registers: int = REGISTERS) -> np.ndarray:
    """Minima of every row with a shingle (infinite for the others)."""
    sig = np.full((n_rows, registers), np.inf)
    # one process for each shingle and dyadic range of weight that it reaches
    rows, seeds, low, width, cap = [row], [mix64(shingle)], [np.zeros(len(row), np.int64)], [np.ones(len(row), np.int64)], [weight]
    at = 1
    more = np.flatnonzero(weight > at)
    while len(more):
        rows.append(row[more])
        seeds.append(mix64(shingle[more] + _step(at)))
        low.append(np.full(len(more), at))
        width.append(np.full(len(more), at))
        cap.append(weight[more])
        at *= 2
        more = more[weight[more] > at]
    rows, seeds, low, width, cap = (np.concatenate(x) for x in (rows, seeds, low, width, cap))
    total = np.bincount(row, weights=weight, minlength=n_rows)
    todo = total > 0
    limit = np.zeros(n_rows)
    limit[todo] = registers * (np.log(registers) + 4) / total[todo]
    while todo.any():
        own = np.flatnonzero(todo[rows])
        t, k = np.zeros(len(own)), 0
        while len(own):
            k += 1
            x = mix64(seeds[own] + _step(k))
            t = t - np.log(_unit(x)) / width[own]
            live = t <= limit[rows[own]]
            own, t, x = own[live], t[live], mix64(x[live] ^ _GOLD)
            level = low[own] + ((x & np.uint64(0xFFFFFFFF)) * width[own].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
            hit = level < cap[own]
            register = ((x[hit] >> np.uint64(32)) * np.uint64(registers) >> np.uint64(32)).astype(np.int64)
            np.minimum.at(sig.reshape(-1), rows[own[hit]] * registers + register, t[hit])
        # a row with an empty register is drawn again, up to a later time
        todo &= np.isinf(sig).any(axis=1)
        sig[todo] = np.inf
        limit *= 2
    return sig


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One key for each band of every row."""
    v = sig.view(np.uint64).reshape(len(sig), BANDS, BAND_ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), v.shape[:2]).copy()
    for k in range(BAND_ROWS):
        key = mix64(key * _GOLD + v[:, :, k])
    return key.view(np.int64)


def sketch(sig: np.ndarray) -> np.ndarray:
    """A byte of every register."""
    return (mix64(sig.view(np.uint64)) >> np.uint64(56)).astype(np.uint8)


def fewest_agreeing(least: float, registers: int = REGISTERS, miss: float = MISS) -> int:
    """The most registers that a pair of similarity ``least`` falls short of with a chance of ``miss`` at most."""
    below = 0.0
    for k in range(registers + 1):
        below += math.comb(registers, k) * least ** k * (1 - least) ** (registers - k)
        if below > miss:
            return k
    return registers


def _agreeing(fewest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, REGISTERS) for k in (2, 3))
            own = (a == b).sum(axis=1) >= fewest
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(own))

    return run


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, off = buffers(batch.column(1))
        for i, j in runs(off):
            part = off[i:j + 1]
            row, s, w = bags(raw[part[0]:part[-1]], part - part[0])
            sig = signatures(row, s, w, j - i)
            keys, own = band_keys(sig), sketch(sig)
            some = np.bincount(row, minlength=j - i) > 0
            size = np.where(some, BANDS, 0)
            lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)), pa.int32()), pa.array(keys[some].reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], lists, pa.array([x.tobytes() for x in own], pa.binary())], ["node", "keys", "sketch"])


def similarities(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Shared over all occurrences of shingles, pair by pair (0 where neither has any)."""
    out = np.zeros(len(a))
    ra, oa = buffers(a)
    rb, ob = buffers(b)
    for i, j in runs(oa + ob):
        found = []
        for raw, off in ((ra, oa), (rb, ob)):
            part = off[i:j + 1]
            found.append(shingles(raw[part[0]:part[-1]], part - part[0]))
        s, r = (np.concatenate([x[k] for x in found]) for k in (0, 1))
        side = np.repeat([0, 1], [len(found[0][0]), len(found[1][0])])
        order = np.lexsort((s, r))
        s, r, side = s[order], r[order], side[order]
        first = np.flatnonzero(np.append(True, (s[1:] != s[:-1]) | (r[1:] != r[:-1]))) if len(s) else np.zeros(0, np.int64)
        if len(first):
            n1 = np.add.reduceat(side, first)
            n0 = np.diff(np.append(first, len(s))) - n1
            shared = np.bincount(r[first], weights=np.minimum(n0, n1), minlength=j - i)
            every = np.bincount(r[first], weights=np.maximum(n0, n1), minlength=j - i)
            out[i:j] = shared / np.maximum(every, 1)
    return out


def _verify(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = similarities(batch.column(2), batch.column(3)) >= least - 1e-12
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(own))

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of all nodes of ``edges`` (a, b): the smallest node that a path reaches.

    Each step takes the smallest label among a node and its neighbours, then
    the label of that label."""
    edges = written(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    label = written(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")))
    while True:
        near = (edges.join(label.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        least = label.join(near, "node").select("node", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        jump = least.select(F.col("node").alias("label"), F.col("label").alias("next"))
        new = written(least.join(jump, "label", "left").select("node", F.least("label", "next").alias("label"), "old"))
        changed = new.filter(F.col("label") != F.col("old")).limit(1).count()
        label = new.drop("old")
        if not changed:
            return label


def _candidates(keys: DataFrame) -> DataFrame:
    """Pairs (a, b) of a bucket's hub, its smallest node, and its other members.  ``keys`` has key, node."""
    # a table of its own, so that a large bucket's side of the join can be split
    hubs = written(keys.groupBy("key").agg(F.min("node").alias("a")))
    return keys.join(hubs, "key").filter(F.col("node") > F.col("a")).select("a", F.col("node").alias("b")).distinct()


PLACE = "key long, i int, j int, band int, block int, node binary, label binary"


def _blocks(keys: DataFrame, label: DataFrame) -> DataFrame:
    """Members of buckets that hold several classes besides the hub, once for each two blocks (i, j) that they are compared in."""
    hubs = keys.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("n")).filter(F.col("n") > 2)
    own = written(keys.join(written(hubs.select("key", "hub")), "key").filter(F.col("node") != F.col("hub"))
                  .join(label, "node", "left").select("key", "band", "node", F.coalesce("label", "node").alias("label")))
    several = own.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("n")).filter(F.col("lo") < F.col("hi"))
    several = written(several.select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    met = own.join(several, "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return met.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "band", "block", "node", "label")


def _together(members: DataFrame) -> DataFrame:
    """The members of two blocks one after the other in one task."""
    return members.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def _starts(t: pa.Table) -> np.ndarray:
    """True where a row begins another two blocks."""
    out = np.ones(t.num_rows, dtype=bool)
    out[1:] = False
    for c in ("key", "i", "j"):
        v = t.column(c).to_numpy()
        out[1:] |= v[1:] != v[:-1]
    return out


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The batches, cut where two blocks end."""
    rest = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = t if rest is None else pa.concat_tables([rest, t])
        if not t.num_rows:
            continue
        last = int(np.flatnonzero(_starts(t))[-1])
        if last:
            yield t.slice(0, last).combine_chunks()
        rest = t.slice(last)
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks()


def _passing(t: pa.Table, label: np.ndarray, fewest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (a, b) of pairs of different classes whose signatures agree enough, each pair in the first band that it shares."""
    n, pad = t.num_rows, -REGISTERS % 8
    sign = np.zeros((n, REGISTERS + pad), np.uint8)
    sign[:, :REGISTERS] = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint8).reshape(n, REGISTERS)
    keys = t.column("keys").combine_chunks().flatten().to_numpy().reshape(n, BANDS)
    block, band = t.column("block").to_numpy(), t.column("band").to_numpy()
    one = t.column("i").to_numpy() == t.column("j").to_numpy()
    start = np.flatnonzero(_starts(t))
    size = np.diff(np.append(start, n))
    end = np.repeat(start + size, size)
    at, step = np.arange(n), 0
    while True:
        step += 1
        at = at[at + step < end[at]]
        if not len(at):
            return
        for k in range(0, len(at), PAIRS_AT_ONCE):
            a = at[k:k + PAIRS_AT_ONCE]
            b = a + step
            own = (label[a] != label[b]) & (one[a] | (block[a] != block[b]))
            a, b = a[own], b[own]
            # eight bytes at a time: no lane of the sums reaches 256
            lanes = (sign[a] == sign[b]).view(np.uint64).sum(axis=1, dtype=np.uint64)
            own = (lanes * np.uint64(0x0101010101010101) >> np.uint64(56)).astype(np.int64) - pad >= fewest
            a, b = a[own], b[own]
            own = (keys[a] == keys[b]).argmax(axis=1) == band[a]
            if own.any():
                yield a[own], b[own]


def _codes(t: pa.Table) -> np.ndarray:
    return t.column("label").combine_chunks().dictionary_encode().indices.to_numpy()


def _with_pairs(fewest: int):
    """Members that have a pair that passes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole(batches):
            some = np.zeros(t.num_rows, dtype=bool)
            for a, b in _passing(t, _codes(t), fewest):
                some[a] = some[b] = True
            yield from t.filter(pa.array(some)).to_batches()

    return run


def occurrences(text: pa.Array) -> np.ndarray:
    """A hash of every occurrence of a shingle in one text, ascending; the n-th one of a shingle is the same in all texts."""
    raw, off = buffers(text)
    _, s, n = bags(raw, off)
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.sort(mix64(np.repeat(s, n) + nth.astype(np.uint64) * _GOLD))


def _joining(least: float):
    """Links that join two classes, by the whole texts."""
    fewest = fewest_agreeing(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole(batches):
            label, text, node = _codes(t), t.column("text").combine_chunks(), t.column("node").combine_chunks()
            root, known, links = list(range(int(label.max()) + 1)), {}, []

            def find(x: int) -> int:
                while root[x] != x:
                    root[x] = x = root[root[x]]
                return x

            def bag(k: int) -> np.ndarray:
                if k not in known:
                    known[k] = occurrences(text.slice(k, 1))
                return known[k]

            for a, b in _passing(t, label, fewest):
                for x, y in zip(a.tolist(), b.tolist()):
                    p, q = find(label[x]), find(label[y])
                    if p == q:
                        continue
                    u, v = sorted((bag(x), bag(y)), key=len)
                    if len(u) < (least - 1e-12) * len(v):
                        continue
                    shared = int((v[np.minimum(np.searchsorted(v, u), len(v) - 1)] == u).sum())
                    if shared >= (least - 1e-12) * (len(u) + len(v) - shared):
                        root[p] = q
                        links.append((x, y))
            if links:
                x, y = (node.take(pa.array(k)) for k in zip(*links))
                yield pa.RecordBatch.from_arrays([x, y], ["a", "b"])

    return run


def _among(nodes: DataFrame) -> Column:
    """True for all of ``nodes`` and few others: a Bloom filter over the column ``node``, so that other texts don't move."""
    spots = [F.xxhash64(F.lit(k), "node").bitwiseAND(F.lit(FILTER_BITS - 1)) for k in (1, 2, 3)]
    set_bits = nodes.select(F.explode(F.array(*spots)).alias("at")).groupBy(F.shiftright("at", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(at & 63 AS int)))").alias("bits")).toArrow()  # FILTER_BITS / 64 rows at most
    words = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    words[set_bits.column("word").to_numpy()] = set_bits.column("bits").to_numpy()
    shared = nodes.sparkSession.sparkContext.broadcast(words)

    @F.pandas_udf("boolean")
    def found(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        hit = np.ones(len(a), dtype=bool)
        for at in (a, b, c):
            hit &= (shared.value[at.to_numpy() >> 6] >> (at.to_numpy() & 63)) & 1 == 1
        return pd.Series(hit)

    return found(*spots)


def classes(docs: DataFrame, least: float = MIN_SIMILARITY) -> DataFrame:
    """(node, label) of all texts that are near another one; a node is the digest of a text."""
    texts = docs.select(digest().alias("node"), F.coalesce("text", F.lit("")).alias("text"))
    signed = written(texts.mapInArrow(_signed, "node binary, keys array<long>, sketch binary").groupBy("node").agg(
        F.first("keys").alias("keys"), F.first("sketch").alias("sketch")))
    keys = signed.select("node", F.posexplode("keys").alias("band", "key"))
    # a key that one text alone holds links nothing
    shared = written(keys.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter(F.col("lo") < F.col("hi")).select("key"))
    keys = written(keys.join(shared, "key").select("key", "band", "node"))
    wanted = written(keys.select("node").distinct())
    texts = written(texts.filter(_among(wanted)).dropDuplicates(["node"]).join(wanted, "node", "left_semi"))
    sketches = written(signed.select("node", "sketch", "keys").join(wanted, "node", "left_semi"))

    def verified(pairs: DataFrame) -> DataFrame:
        signs = pairs.join(sketches.select(F.col("node").alias("b"), F.col("sketch").alias("sketch_b")), "b").join(
            sketches.select(F.col("node").alias("a"), F.col("sketch").alias("sketch_a")), "a")
        near = written(signs.select("a", "b", "sketch_a", "sketch_b").mapInArrow(_agreeing(fewest_agreeing(least)), "a binary, b binary"))
        joined = near.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b").join(
            texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        return written(joined.select("a", "b", "text_a", "text_b").mapInArrow(_verify(least), "a binary, b binary"))

    links = verified(written(_candidates(keys)))
    members = _blocks(keys, components(links)).join(sketches, "node")
    columns = "key", "i", "j", "band", "block", "node", "label", "sketch", "keys"
    schema = f"{PLACE}, sketch binary, keys array<long>"
    near = written(_together(members.select(*columns)).mapInArrow(_with_pairs(fewest_agreeing(least)), schema))
    joined = near.join(texts, "node").select(*columns, "text")
    return components(links.union(written(_together(joined).mapInArrow(_joining(least), "a binary, b binary"))))


def digest():
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))


def classed(docs: DataFrame) -> DataFrame:
    """(doc_id, node, label, class_id, class_size, n_same), a row for each distinct doc_id and text."""
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest().alias("node")).groupBy("doc_id", "node").agg(F.count("*").alias("n_same"))
    own = written(ids.join(classes(docs), "node", "left").withColumn("label", F.coalesce("label", "node")))
    size = written(own.groupBy("label").agg(F.min(F.struct(place.alias("place"), "node")).alias("first"), F.sum("n_same").alias("class_size")))
    return own.join(size, "label").select("doc_id", "node", "label", F.col("first.place.id").alias("class_id"), "class_size", "n_same",
                                          (F.struct(place, F.col("node")) == F.struct(F.col("first.place"), F.col("first.node"))).alias("first"))


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class: its smallest ``doc_id``."""
    found = written(classed(docs))
    kept = found.filter("first").select(F.col("doc_id").alias("__id"), F.col("node").alias("__node"), (F.col("n_same") > 1).alias("__again"))
    joined = docs.withColumn("__digest", digest()).join(kept, F.col("__digest").eqNullSafe(F.col("__node")) & docs["doc_id"].cast("long").eqNullSafe(F.col("__id")))
    once = joined.filter(~F.col("__again")).select(*docs.columns)
    again = joined.filter("__again").dropDuplicates(["__digest"]).select(*docs.columns)
    return once.unionAll(again)


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = classed(docs)
    return found.select(F.explode(F.array_repeat("doc_id", F.col("n_same").cast("int"))).alias("doc_id"), "class_id", "class_size",
                        F.col("first").cast("int").alias("kept"))
