"""Best-fit packing of tokenized documents into fixed-length sequences.

Hierarchical residual packing.  Every partition packs its own pieces best-fit
decreasing and emits the bins that are full or nearly full.  The other bins
become items of their own (size: what they hold) and go to fewer tasks, where
best fit joins them again, round after round, until one task holds what is
left.  A bin carries the list of its pieces, at most one per token, so no
round needs a join, and a round shuffles only the underfull bins.

Cases: a null or empty text has one piece, the end token alone.  Repeated
rows are packed once each.  A null ``doc_id`` is kept.  An empty table gives
no pieces.  Other columns are ignored.  Documents longer than a sequence are
cut so that only their first piece may be short.
"""

from __future__ import annotations

import base64
import math
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import checkpointed

SEQUENCE_TOKENS = 2048
END_ID = 0
#: A bin with at most this many free tokens is emitted and not packed again.
SLACK = 4
#: Pieces that a task holds at once in the first round, and underfull bins per task in later ones.
LOCAL_PIECES = 200_000
ROUND_BINS = 8_192
#: A round that leaves more than this share of its underfull bins, over several tasks, is the last.
STALLED = 0.97

PIECE = "struct<doc_id:bigint,piece:int,start:bigint,length:bigint,ids_crc32:bigint,offset:bigint,ids:array<int>>"
BINS = f"bin bigint, fill int, pieces array<{PIECE}>"
_PIECE_ARROW = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                          ("ids_crc32", pa.int64()), ("offset", pa.int64()), ("ids", pa.list_(pa.int32()))])
_BINS_ARROW = pa.schema([("bin", pa.int64()), ("fill", pa.int32()), ("pieces", pa.list_(_PIECE_ARROW))])

_encoders: dict[str, object] = {}


def encoder(vocabulary: str):
    """The byte-level BPE of a vocabulary file in the tokenizers library's
    JSON form; its special tokens in a text are one id each, as that library
    gives them.  ``tiktoken`` runs the same merges over the same vocabulary
    several times faster."""
    if vocabulary not in _encoders:
        import json

        import public_tokenizers
        import tiktoken

        with open(vocabulary, encoding="utf-8") as f:
            model = json.load(f)
        special = {x["content"]: x["id"] for x in model.get("added_tokens", ()) if x["special"]}
        back = _byte_letters()
        ranks = {bytes(back[c] for c in piece): i for piece, i in model["model"]["vocab"].items() if piece not in special}
        _encoders[vocabulary] = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return _encoders[vocabulary]


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a printable letter: itself
    where it is one, else the next code point from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def cut(n: int, size: int = SEQUENCE_TOKENS) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; only the first may be short."""
    if n <= size:
        return [(0, n)]
    first = n % size
    at = [0] if first else []
    at += range(first, n, size)
    return [(a, b - a) for a, b in zip(at, [*at[1:], n])]


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Best-fit decreasing: the members of every bin.  Open bins are kept by
    their free space, with one bit for each space that occurs, so a fit is
    found by a shift and a lowest set bit."""
    bins: list[list[int]] = []
    by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    some = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = some >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            b = by_free[free].pop()
            if not by_free[free]:
                some &= ~(1 << free)
            bins[b].append(i)
            left = free - size
        else:
            b = len(bins)
            bins.append([i])
            left = capacity - size
        if left:
            by_free[left].append(b)
            some |= 1 << left
    return bins


def _emit(packed: list[tuple[int, list]], first: int) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(packed), 1000):
        part = packed[at:at + 1000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(first + at, first + at + len(part)), pa.int64()), pa.array([f for f, _ in part], pa.int32()),
             pa.array([p for _, p in part], pa.list_(_PIECE_ARROW))], schema=_BINS_ARROW)


def _laid(lists: list[list[dict]]) -> list[dict]:
    """Bins laid one after another in a new bin: their pieces with offsets moved."""
    out, at = [], 0
    for pieces in lists:
        out += [p | {"offset": p["offset"] + at} for p in pieces]
        at += sum(p["length"] for p in pieces)
    return out


def _first_bin(level: int) -> int:
    return (level << 56) | (TaskContext.get().partitionId() << 28)


def _local(vocabulary: str, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = partial(encoder(vocabulary).encode, allowed_special="all")
        pieces: list[dict] = []
        at = _first_bin(1)

        def flush():
            nonlocal pieces, at
            sizes = np.array([p["length"] for p in pieces], dtype=np.int64)
            packed = [(int(sizes[b].sum()), _laid([[pieces[i]] for i in b])) for b in best_fit(sizes, capacity)]
            pieces = []
            yield from _emit(packed, at)
            at += len(packed)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.array([*encode(text.as_py() or ""), END_ID], dtype="<u4")
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    own = ids[start:start + length]
                    pieces.append({"doc_id": doc_id, "piece": k, "start": start, "length": length,
                                   "ids_crc32": zlib.crc32(own.tobytes()), "offset": 0, "ids": own.tolist() if with_ids else None})
                if len(pieces) >= LOCAL_PIECES:
                    yield from flush()
        yield from flush()

    return run


def _merge(capacity: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fills, lists = [], []
        for batch in batches:
            fills += batch.column(1).to_pylist()
            lists += batch.column(2).to_pylist()
        sizes = np.array(fills, dtype=np.int64)
        packed = [(int(sizes[b].sum()), _laid([lists[i] for i in b])) for b in best_fit(sizes, capacity)]
        yield from _emit(packed, _first_bin(level))

    return run


def pack(docs: DataFrame, vocabulary: str, capacity: int = SEQUENCE_TOKENS, with_ids: bool = False) -> DataFrame:
    """One row per bin: its number, tokens, and pieces in their order.

    ``with_ids`` keeps the token ids of every piece, so that the bins are the
    finished sequences; without, their crc32 only."""
    level = 1
    bins = checkpointed(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
                        .mapInArrow(_local(vocabulary, capacity, with_ids), BINS))
    done = bins.filter(F.col("fill") >= capacity - SLACK)
    rest = bins.filter(F.col("fill") < capacity - SLACK)
    n = rest.count()
    while n:
        level += 1
        tasks = math.ceil(n / ROUND_BINS)
        bins = checkpointed(rest.repartition(tasks).mapInArrow(_merge(capacity, level), BINS))
        under = F.col("fill") < capacity - SLACK
        left = bins.filter(under).count()
        if tasks == 1 or left > STALLED * n:
            done = done.unionAll(bins)
            break
        done, rest, n = done.unionAll(bins.filter(~under)), bins.filter(under), left
    return done


def placements(bins: DataFrame) -> DataFrame:
    """One row per piece: its sequence and its offset there."""
    return bins.select(F.col("bin").alias("sequence_id"), F.inline("pieces")).drop("ids")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.common import table

    return placements(pack(table(spark, sf_dir, "documents"), default_vocabulary()))
