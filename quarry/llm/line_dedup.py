"""Line dedup with two Bloom filters.

One scan turns every line key into a 128-bit digest.  A key that two documents
of the same batch hold is a suspected repeat already; it goes on once a batch
as twice seen.  All digests are routed by key range to slices, as many as their
count asks for, so that a slice's filters have a fixed size and are never full.
A slice sets the bits of a digest in its once-seen filter, or in its twice-seen
filter where the once-seen bit was set before, and then streams its digests
past the finished twice-seen filter: those whose bits are all twice seen are
suspects.  Only suspects are grouped by key, which tells exactly which keys
stand in two or more documents and which document has the smallest id.  Lines
and texts aren't routed, nothing is broadcast, and a filter's false alarms make
more suspects, never another result.

Cases: a null or empty text is one empty line.  Rows that share a ``doc_id``
are one document (each row is returned, with the same lines dropped).  A null
``doc_id`` is one document that sorts after all others.  Other columns pass
through; ``n_lines`` and ``n_dropped`` replace columns of these names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import WHITE, table, written

MIN_CHARS = 10
#: Bits of each of a slice's two filters (a power of two up to 2^24).
FILTER_BITS = 1 << 22
#: Bits for a routed digest, which set the number of slices: of lines seen once about one in 70 is suspected.
BITS_PER_KEY = 16
#: What a row of the digests is: a digest of one document, a digest of several documents of a batch, one of these documents.
SINGLE, SEVERAL, SUSPECT = 0, 1, 2


def line_keys(text: str | None, min_chars: int = MIN_CHARS) -> list[bytes | None]:
    """A digest of the key of each line; None where the key is too short to count."""
    out = []
    for line in (text or "").split("\n"):
        key = line.encode("utf-8", "surrogatepass").strip(WHITE).lower()
        long = len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars)
        out.append(hashlib.md5(key, usedforsecurity=False).digest() if long else None)
    return out


def _digests(min_chars: int):
    """Rows (kind, high, low, doc_id) for the keys of every batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keys = [], []
            for i, text in enumerate(batch.column(1)):
                own = {k for k in line_keys(text.as_py(), min_chars) if k}
                rows += [i] * len(own)
                keys += own
            if not keys:
                continue
            halves = np.frombuffer(b"".join(keys), dtype=">u8").reshape(-1, 2).astype(np.uint64).view(np.int64)
            order = np.lexsort((halves[:, 1], halves[:, 0]))
            halves, row = halves[order], np.array(rows)[order]
            new = np.ones(len(halves), dtype=bool)
            new[1:] = (halves[1:] != halves[:-1]).any(axis=1)
            alone = new & np.append(new[1:], True)
            several = halves[new & ~alone]
            ids = batch.column(0).take(pa.array(row))
            kind = np.concatenate([np.where(alone, SINGLE, SUSPECT), np.full(len(several), SEVERAL)]).astype(np.int8)
            high, low = np.concatenate([halves, several]).T
            yield pa.RecordBatch.from_arrays([pa.array(kind), pa.array(high), pa.array(low), pa.concat_arrays([ids, pa.nulls(len(several), pa.int64())])],
                                             ["kind", "high", "low", "doc_id"])

    return run


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The runs of rows of a batch that have the same ``slice``."""
    number = batch.column(0).to_numpy()
    cuts = np.flatnonzero(np.append(True, number[1:] != number[:-1])).tolist() if len(number) else []
    for a, b in zip(cuts, [*cuts[1:], len(number)]):
        yield int(number[a]), batch.slice(a, b - a)


def _positions(high: np.ndarray, low: np.ndarray, bits: int) -> np.ndarray:
    """Two filter positions for every digest."""
    return np.stack([high, low], axis=1) & np.int64(bits - 1)


def _build(bits: int):
    """The twice-seen filter of every slice, of rows (slice, high, low, kind) that come slice by slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, once, twice = None, np.zeros(bits, dtype=bool), np.zeros(bits, dtype=bool)

        def told() -> Iterator[pa.RecordBatch]:
            if twice.any():
                yield pa.RecordBatch.from_arrays([pa.array([current], pa.int64()), pa.array([np.packbits(twice).tobytes()], pa.binary())], ["slice", "twice"])

        for batch in batches:
            for number, part in _slices(batch):
                if number != current:
                    yield from told()
                    current = number
                    once[:] = False
                    twice[:] = False
                at = _positions(part.column(1).to_numpy(), part.column(2).to_numpy(), bits)
                twice[at[part.column(3).to_numpy() == SEVERAL]] = True
                at = np.sort(at, axis=None)
                new = np.ones(len(at), dtype=bool)
                new[1:] = at[1:] != at[:-1]
                twice[at[~new]] = True
                at = at[new]
                twice[at[once[at]]] = True
                once[at] = True
        yield from told()

    return run


def _test(bits: int):
    """The digests whose bits are all twice seen, of rows (slice, high, low, doc_id, twice)
    that come slice by slice, a slice's filter before its digests."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, seen = None, None
        for batch in batches:
            for number, part in _slices(batch):
                if number != current:
                    current, seen = number, None
                if part.column(4)[0].is_valid:
                    seen = np.frombuffer(part.column(4)[0].as_py(), np.uint8)
                    part = part.slice(1)
                if seen is not None and len(part):
                    at = _positions(part.column(1).to_numpy(), part.column(2).to_numpy(), bits)
                    hit = ((seen[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=1)
                    yield part.select(["high", "low", "doc_id"]).filter(pa.array(hit))

    return run


def suspected(docs: DataFrame, min_chars: int = MIN_CHARS, bits: int = FILTER_BITS) -> DataFrame:
    """(high, low, doc_id) of all keys that stand in two documents, and of a few that the filters take for such."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    digests = written(ids.mapInArrow(_digests(min_chars), "kind byte, high long, low long, doc_id long"))
    routed = digests.filter(F.col("kind") != SUSPECT)
    slices = max(1, -(-routed.count() * BITS_PER_KEY // bits))
    # the positions take the low bits
    routed = routed.withColumn("slice", F.pmod(F.shiftrightunsigned("high", 24), F.lit(slices)))
    filters = (routed.select("slice", "high", "low", "kind").repartition("slice").sortWithinPartitions("slice")
               .mapInArrow(_build(bits), "slice long, twice binary"))
    none = F.lit(None).cast("long")
    both = (routed.filter(F.col("kind") == SINGLE).select("slice", "high", "low", "doc_id", F.lit(None).cast("binary").alias("twice"), (F.col("slice") * 2 + 1).alias("place"))
            .unionByName(written(filters).select("slice", F.lit(0).cast("long").alias("high"), F.lit(0).cast("long").alias("low"), none.alias("doc_id"), "twice", (F.col("slice") * 2).alias("place"))))
    schema = "high long, low long, doc_id long"
    hits = both.repartition("slice").sortWithinPartitions("place").drop("place").mapInArrow(_test(bits), schema)
    return written(hits.unionByName(digests.filter(F.col("kind") == SUSPECT).select("high", "low", "doc_id")))


def _drop(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            i, d = (batch.schema.get_field_index(c) for c in ("text", "__drops"))
            texts, lines, dropped = [], [], []
            for text, drops in zip(batch.column(i), batch.column(d)):
                text, drops = text.as_py(), set(drops.as_py() or ())
                own = (text or "").split("\n")
                kept = own
                if drops:
                    kept = [x for x, k in zip(own, line_keys(text, min_chars)) if k is None or k not in drops]
                texts.append("\n".join(kept) if drops else text)
                lines.append(len(own))
                dropped.append(len(own) - len(kept))
            cols = {n: c for n, c in zip(batch.schema.names, batch.columns) if n != "__drops"}
            cols["text"] = pa.array(texts, pa.string())
            cols |= {"n_lines": pa.array(lines, pa.int64()), "n_dropped": pa.array(dropped, pa.int64())}
            yield pa.RecordBatch.from_pydict(cols)

    return run


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, bits: int = FILTER_BITS) -> DataFrame:
    """``docs`` with repeated lines taken from ``text``, and the line counts."""
    docs = docs.drop("n_lines", "n_dropped")
    suspects = suspected(docs, min_chars, bits)
    # a null id is one document, after all others; a table of its own, so that Spark can split a common line's side of the join
    repeats = written(suspects.groupBy("high", "low").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.bool_or(F.col("doc_id").isNull()).alias("none"))
                      .filter((F.col("first") != F.col("last")) | (F.col("first").isNotNull() & F.col("none"))).select("high", "low", "first"))
    digest = F.unhex(F.concat(F.lpad(F.hex("high"), 16, "0"), F.lpad(F.hex("low"), 16, "0")))
    drops = (suspects.join(repeats, ["high", "low"]).filter(F.col("doc_id").isNull() | (F.col("doc_id") != F.col("first")))
             .groupBy(F.col("doc_id").alias("__id")).agg(F.collect_set(digest).alias("__drops")))
    joined = docs.join(drops, docs["doc_id"].cast("long").eqNullSafe(drops["__id"]), "left").drop(drops["__id"])
    schema = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes) + ", n_lines long, n_dropped long"
    return joined.mapInArrow(_drop(min_chars), schema)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP3_SQL = r"""
WITH lines AS (
  SELECT doc_id, i, line, lower_key AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents)
  CROSS JOIN LATERAL (SELECT translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_key)),
firsts AS (SELECT key, min(doc_id) AS keep FROM lines WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (SELECT l.doc_id, l.i, l.line, f.keep IS NOT NULL AND f.keep <> l.doc_id AS gone FROM lines l LEFT JOIN firsts f ON f.key = l.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
