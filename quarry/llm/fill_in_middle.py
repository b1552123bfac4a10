"""Fill-in-middle: texts cut at line ends into prefix, middle and suffix, and put
together in another order around three marks.

The bytes of a batch are moved at once.  The lines of all its texts are found by
one scan for line ends; a difference array holds, at the first byte of every
part, by how much the shift to its place in the output changes; its cumulative
sum is the shift of every byte, and one scatter writes them all.  Restoring
scans the output for the marks alone, builds the shifts of the restored bytes
the same way and gathers them.

Which texts are changed, where they are cut and in which order they stand is
drawn from the sha256 of ``seed:doc_id``, so rows that share an id share draws.

Cases: a null or empty text is plain and empty.  A text that holds a mark stays
plain, as does one that ``rate`` leaves out.  A null ``doc_id`` draws as an empty
one.  Texts of any length are moved whole, about a megabyte at a time (a longer
text alone).  Other columns pass through, and the new ones replace those of the
same names.  A row whose marks don't stand as its form says restores to null.
An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quarry.llm.common import buffers, runs, table, text_or_empty

# The marks before prefix, suffix and middle.
MARKS = (b"<P>", b"<S>", b"<M>")
MARK = 3
SEED, RATE, SPM = 7, 100, 50
PLAIN, PSM, SPM_FORM = 0, 1, 2
FORMS = ["plain", "psm", "spm"]
ADDED = {"n_units": "long", "form": "string", "prefix_chars": "long", "middle_chars": "long", "fim_text": "string"}


def _marks(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, kind, row) of the marks of all rows, in text order."""
    at = np.flatnonzero(raw[:-2] == MARKS[0][0]) if len(raw) > 2 else np.zeros(0, np.int64)
    at = at[raw[at + 2] == MARKS[0][2]]
    letter = raw[at + 1]
    kind = np.select([letter == m[1] for m in MARKS], [0, 1, 2], -1)
    row = np.searchsorted(off, at, side="right") - 1
    ok = (kind >= 0) & (at + MARK <= off[row + 1])
    return at[ok], kind[ok], row[ok]


def _shifts(starts: np.ndarray, to: np.ndarray, n: int) -> np.ndarray:
    """For n bytes, each byte's place elsewhere: parts begin at ``starts``
    (ascending, some may be empty) and go to ``to``."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, starts, np.diff(to - starts, prepend=0))
    return np.arange(n) + np.cumsum(change)[:n]


def _filled(raw: np.ndarray, off: np.ndarray, draws: list[np.ndarray], rate: int, spm: int):
    """(units, form, bytes of output, its offsets, characters of prefix and middle) of all rows."""
    first, last = off[:-1], off[1:]
    ends = np.flatnonzero(raw == 10)
    before = np.searchsorted(ends, first)
    units = np.searchsorted(ends, last) - before
    units += (last > first) & (raw[np.maximum(last - 1, 0)] != 10) if len(raw) else 0
    form = np.where(draws[2] % 100 >= rate, PLAIN, np.where(draws[3] % 100 < spm, SPM_FORM, PSM))
    form[last == first] = PLAIN
    form[_marks(raw, off)[2]] = PLAIN

    def cut(unit: np.ndarray) -> np.ndarray:
        inner = ends[np.clip(before + unit - 1, 0, max(0, len(ends) - 1))] + 1 if len(ends) else last
        return np.where(unit == 0, first, np.where(unit >= units, last, inner))

    drawn = [h % (units + 1) for h in draws[:2]]
    a, b = cut(np.minimum(*drawn)), cut(np.maximum(*drawn))
    plain = form == PLAIN
    a, b = np.where(plain, last, a), np.where(plain, last, b)
    p, m, s = a - first, b - a, last - b
    size = last - first + np.where(plain, 0, 3 * MARK)
    out_off = np.concatenate([[0], np.cumsum(size)])
    o = out_off[:-1]
    spm_form = form == SPM_FORM
    to_prefix = o + np.where(plain, 0, np.where(spm_form, 2 * MARK + s, MARK))
    to_suffix = o + np.where(plain, p, np.where(spm_form, MARK, 2 * MARK + p))
    to_middle = o + np.where(plain, p, 3 * MARK + p + s)
    out = np.empty(out_off[-1], dtype=np.uint8)
    out[_shifts(np.stack([first, a, b], 1).ravel(), np.stack([to_prefix, to_middle, to_suffix], 1).ravel(), len(raw))] = raw
    for mark, place in zip(MARKS, (to_prefix, to_suffix, to_middle)):
        own = place[~plain] - MARK
        out[own[:, None] + np.arange(MARK)] = np.frombuffer(mark, np.uint8)
    seen = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    return units, form, out, out_off, seen[a] - seen[first], seen[b] - seen[a]


def _restored(raw: np.ndarray, off: np.ndarray, form: np.ndarray):
    """(bytes, offsets, is sound) of the texts that the output of ``_filled`` came from."""
    at, kind, row = _marks(raw, off)
    first, last = off[:-1], off[1:]
    place = np.zeros((3, len(first)), dtype=np.int64)
    sound = form >= 0
    for k in range(3):
        own = kind == k
        sound &= (form <= PLAIN) | (np.bincount(row[own], minlength=len(first)) == 1)
        place[k, row[own]] = at[own]
    p, s, m = place
    plain = form <= PLAIN
    psm, spm = form == PSM, form == SPM_FORM
    sound &= plain | (psm & (p == first) & (p < s) & (s < m)) | (spm & (s == first) & (s < p) & (p < m))
    plain |= ~sound
    prefix = np.where(plain, last - first, np.where(psm, s, m) - p - MARK)
    suffix = np.where(plain, 0, np.where(psm, m, p) - s - MARK)
    middle = np.where(plain, 0, last - m - MARK)
    out_off = np.concatenate([[0], np.cumsum(np.where(sound, prefix + middle + suffix, 0))])
    keep = np.flatnonzero(sound)
    o = out_off[:-1][keep]
    starts = np.stack([o, o + prefix[keep], o + prefix[keep] + middle[keep]], 1).ravel()
    to = np.stack([np.where(plain, first, p + MARK)[keep], np.where(plain, last, m + MARK)[keep], np.where(plain, last, s + MARK)[keep]], 1).ravel()
    return raw[_shifts(starts, to, int(out_off[-1]))], out_off, sound


def _strings(data: np.ndarray, off: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
    out = pa.LargeStringArray.from_buffers(len(off) - 1, pa.py_buffer(np.ascontiguousarray(off, dtype=np.int64)), pa.py_buffer(np.ascontiguousarray(data)))
    if valid is not None and not valid.all():
        out = pa.compute.if_else(pa.array(valid), out, pa.scalar(None, pa.large_string()))
    return out.cast(pa.string())


def _fill(rate: int, spm: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = buffers(batch.column(1))
            draws = [np.asarray(batch.column(2 + k)) for k in range(4)]
            for i, j in runs(off):
                part = off[i:j + 1]
                units, form, out, out_off, prefix, middle = _filled(raw[part[0]:part[-1]], part - part[0], [h[i:j] for h in draws], rate, spm)
                plain = form == PLAIN
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(units, pa.int64()), pa.array([FORMS[f] for f in form], pa.string()),
                                                  pa.array(prefix, pa.int64(), mask=plain), pa.array(middle, pa.int64(), mask=plain), _strings(out, out_off)], ["row", *ADDED])

    return run


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, off = buffers(batch.column(1))
        form = np.array([FORMS.index(f) if f in FORMS else -1 for f in batch.column(2).to_pylist()], dtype=np.int64)
        for i, j in runs(off):
            part = off[i:j + 1]
            data, out_off, sound = _restored(raw[part[0]:part[-1]], part - part[0], form[i:j])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), _strings(data, out_off, sound)], ["row", "restored_text"])


def _mapped(df: DataFrame, run, inputs: list[Column], added: dict[str, str]) -> DataFrame:
    """``df`` with the columns that ``run`` adds; its own travel as one struct, so names can't clash."""
    own = df.select(F.struct(*[df[c] for c in df.columns]).alias("row"), *inputs)
    schema = StructType([own.schema["row"]])
    for name, kind in added.items():
        schema = schema.add(name, kind)
    out = own.mapInArrow(run, schema)
    return out.select(*[F.col("row")[c].alias(c) for c in df.columns if c not in added], *added)


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """``docs`` with n_units, form, prefix_chars, middle_chars and fim_text.
    ``rate`` of 100 texts are changed, ``spm`` of 100 of them begin with the suffix."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    draws = [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]
    return _mapped(docs, _fill(rate, spm), [text_or_empty().alias("text"), *draws], ADDED)


def restore(filled: DataFrame) -> DataFrame:
    """``filled`` with restored_text, from ``fim_text`` and ``form`` alone."""
    return _mapped(filled, _gather, [text_or_empty("fim_text").alias("text"), F.col("form").cast("string").alias("form")], {"restored_text": "string"})


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    return restore(filled).select("doc_id", F.col("n_units").alias("n"), "form", "prefix_chars", "middle_chars",
                                  F.sha2("fim_text", 256).alias("output_sha256"), F.sha2("restored_text", 256).alias("restored_sha256"))


OP12_SQL = rf"""
WITH own AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units, sha256('{SEED}:' || doc_id) AS h FROM documents),
drawn AS (SELECT *, CAST(len(units) AS BIGINT) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM own),
formed AS (SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= {RATE} THEN 'plain'
                          WHEN h4 % 100 < {SPM} THEN 'spm' ELSE 'psm' END AS form,
                  least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM drawn),
parts AS (SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle, array_to_string(units[b + 1:n], '') AS suffix FROM formed)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
