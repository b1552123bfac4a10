"""Helpers that several operators of this package share.

Text reaches Python as Arrow batches.  ``buffers`` gives the UTF-8 bytes of a
batch with the offsets of its rows, and ``words`` finds the words
``[^\\x20\\x09-\\x0D]+`` of all rows at once, with a 64-bit hash of each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import scratch_path, shared_dir

CHUNK_BYTES = 1 << 20
WHITE = b" \t\n\x0b\x0c\r"

_IS_WHITE = np.zeros(256, dtype=bool)
_IS_WHITE[list(WHITE)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: list[np.ndarray] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def unused(name: str, *frames: DataFrame) -> str:
    """``name`` with as many underscores before it as make it no column of ``frames``."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def crc_mod(modulus: int, col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % modulus


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage with a Parquet table in the shared folder.  Unlike a
    checkpoint it carries over no constraints of the plan, which grow from step
    to step of an iteration, and has a known size; it doesn't keep partitions."""
    path = scratch_path(df.sparkSession, "llm")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n+1 offsets of its rows; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string())
    if col.null_count:
        col = col.fill_null("")
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[col.offset:col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def runs(off: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each; a longer row stands alone."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        tables = []
        for base in (_BASE, _BASE_INVERSE):
            t = np.full(size, base, dtype=np.uint64)
            t[0] = 1
            tables.append(np.cumprod(t, dtype=np.uint64))
        _powers[:] = tables
    return _powers


def words(raw: np.ndarray, off: np.ndarray, lower: bool = True, between: np.ndarray = _IS_WHITE):
    """(hash, row, start, end) of every word, in text order; ``between`` marks
    the bytes that aren't of words.

    The hash is a polynomial over the bytes (A-Z lower-cased first if
    ``lower``), taken from prefix sums, so it costs a few operations a byte
    and none a word beyond them.
    """
    n = len(raw)
    if not n:
        z = np.zeros(0, np.int64)
        return z.astype(np.uint64), z, z, z
    white = between[raw]
    edge = np.zeros(n + 1, dtype=bool)
    edge[off] = True
    before = edge[:-1].copy()
    before[1:] |= white[:-1]
    after = edge[1:].copy()
    after[:-1] |= white[1:]
    start = np.flatnonzero(before & ~white)
    end = np.flatnonzero(after & ~white) + 1
    power, inverse = _power_tables(n)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(((LOWER[raw] if lower else raw).astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
    h = mix64((sums[end] - sums[start]) * inverse[start])
    return h, np.searchsorted(off, start, side="right") - 1, start, end


def first_in_row(row: np.ndarray) -> np.ndarray:
    """True where a word is the first of its row (``row`` ascending)."""
    out = np.ones(len(row), dtype=bool)
    out[1:] = row[1:] != row[:-1]
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, fit: Column, rows: int) -> DataFrame:
    """(doc_id, text, label) of at most ``rows`` labelled documents that meet
    ``fit``, chosen by a hash of the id.  Only this bounded set of ids is
    broadcast.  Several labels of a document count as their largest."""
    chosen = (labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & fit)
              .select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id", F.desc("label")).limit(rows)
              .groupBy("doc_id").agg(F.max("label").alias("label")))
    mine = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return checkpointed(mine.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label"))


def scored(docs: DataFrame, score, modulus: int, remainder: int, cut: float) -> DataFrame:
    """``score`` over the whole texts of all documents, as the queries return it."""
    out = score(docs.select("doc_id", "text"))
    return out.select("doc_id", (crc_mod(modulus) == remainder).alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))
