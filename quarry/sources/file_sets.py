"""File sets as a data source and sink (S15, S16, X8), through Spark's Python
data source API.

``read_files`` gives one row per record of a set of files: a line of a text
file, a row of a CSV or TSV file, a whole binary file.  Text, CSV and TSV files
are cut into byte ranges of ``split_bytes``; a range holds the records that begin
in it, so one large file is read by many tasks and none holds more than a record.
CSV files that have line ends within quotes are read with ``multiline``, a file to
a task, as their records can't be found from the middle.  Listing and the header
line of each CSV file (read again by every range of it) are all that is read
beside the ranges.  The driver lists block by block and writes which ranges a task
reads to a plan's file, of which the task gets its place, so that it holds nothing
for each file.

``write_files`` writes such rows under the same relative names.  Each task writes
the ranges it holds to files of its own under ``_jobs``; when all tasks have ended
the driver renames them, SLICE at a time, by the lists that the tasks left beside
them, and a job that fails leaves nothing but what stood there before.  A file that was read in one range comes out as one file; of a larger one
the ranges come out as ``name``, ``name.part-00001``, .. which put together in the
order of their names are the file, so that no task has to write it whole.  Rows of
a range must come as they were read (projections and filters keep that).  What
tasks count in a column ``details`` goes to one Parquet file a task.

Records that nothing changed are written as they were read, byte for byte (bytes
that aren't UTF-8 as U+FFFD).  Paths are of any file system that pyarrow opens by
URI and that driver and executors share.
"""

from __future__ import annotations

import csv
import hashlib
import io
import json
import os
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import ExitStack
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from quarry.session import scratch_path

SOURCE, SINK = "quarry_files", "quarry_files_out"
SPLIT_BYTES = 64 << 20
BATCH_BYTES = 1 << 20
BATCH_ROWS = 10_000
OPEN_BYTES = 1 << 14
LISTED = 20_000  # names of a folder sorted at a time
SLICE, MOST_SLICES = 20_000, 512  # ranges that a commit holds at a time; slices are open together
MOVES = 16
JOBS, PARTS = "_jobs", "parts"

# The kinds of files, by extension; any other is binary.
KINDS = {"csv": "csv", "tsv": "tsv", "txt": "text", "text": "text", "md": "text", "log": "text", "json": "text", "jsonl": "text", "ndjson": "text",
         "xml": "text", "html": "text", "htm": "text", "yaml": "text", "yml": "text", "sh": "text", "py": "text"}
SEPARATORS = {"csv": ",", "tsv": "\t"}

SCHEMA = "path string, kind string, start long, row long, header boolean, record string, ending string, columns array<string>, cells array<string>, content binary"
ARROW = pa.schema([("path", pa.string()), ("kind", pa.string()), ("start", pa.int64()), ("row", pa.int64()), ("header", pa.bool_()), ("record", pa.string()),
                   ("ending", pa.string()), ("columns", pa.list_(pa.string())), ("cells", pa.list_(pa.string())), ("content", pa.binary())])
DETAIL = pa.schema([("path", pa.string()), ("field", pa.string()), ("info_type", pa.string()), ("n_transformed", pa.int64())])


def opened(root: str) -> tuple[pafs.FileSystem, str]:
    """A file system, and the root as it names it."""
    if "://" in root or root.startswith("file:"):
        fs, path = pafs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", root))
    else:
        fs, path = pafs.LocalFileSystem(), root
    return fs, path.rstrip("/")


def kind_of(path: str) -> str:
    name = path.rsplit("/", 1)[-1]
    return KINDS.get(name.rsplit(".", 1)[-1].lower(), "binary") if "." in name else "binary"


def bucket(path: str) -> int:
    """Which of 100 the file is in, by its relative path."""
    return int(hashlib.md5(path.encode()).hexdigest()[:8], 16) % 100


def entries(fs: pafs.FileSystem, folder: str) -> Iterator[tuple[str, int]]:
    """(name, bytes) of what a folder holds, a folder's name with a / at its end."""
    if isinstance(fs, pafs.LocalFileSystem):  # one by one; others give a folder's names at once
        with os.scandir(folder) as found:
            for e in found:
                if e.is_dir():
                    yield e.name + "/", 0
                elif e.is_file():
                    yield e.name, e.stat().st_size
        return
    for f in fs.get_file_info(pafs.FileSelector(folder)):
        if f.type == pafs.FileType.Directory:
            yield f.base_name + "/", 0
        elif f.type == pafs.FileType.File:
            yield f.base_name, f.size


def below(fs: pafs.FileSystem, base: str, folder: str = "") -> Iterator[tuple[str, int]]:
    """(relative path, bytes) of the files under ``base``, of which only LISTED
    names are held for each level of folders (in order, in folders of no more)."""
    names = entries(fs, f"{base}/{folder}".rstrip("/") or "/")
    while block := sorted(islice(names, LISTED)):
        for name, size in block:
            if name[0] in "_.":
                continue
            if name.endswith("/"):
                yield from below(fs, base, folder + name)
            else:
                yield folder + name, size


def chosen(root: str, include: Iterable[str] = (), exclude: Iterable[str] = (), kinds: Iterable[str] = (), percent: int = 100) -> Iterator[tuple[str, int]]:
    """(relative path, bytes) of the files under ``root``: those that match one of
    ``include`` (any, if it names none) and none of ``exclude``, of the given kinds,
    and of them the share of ``percent`` that their paths' hashes choose.  Names
    that begin with _ or . are left out."""
    fs, base = opened(root)
    include, exclude, kinds = list(include), list(exclude), list(kinds)
    for path, size in below(fs, base):
        if include and not any(re.search(p, path) for p in include) or any(re.search(p, path) for p in exclude):
            continue
        if (not kinds or kind_of(path) in kinds) and bucket(path) < percent:
            yield path, size


def list_files(root: str, include: Iterable[str] = (), exclude: Iterable[str] = (), kinds: Iterable[str] = (), percent: int = 100) -> list[tuple[str, int]]:
    """What ``chosen`` gives, as a whole and in order."""
    return sorted(chosen(root, include, exclude, kinds, percent))


@dataclass
class Range:
    path: str
    kind: str
    start: int
    stop: int


@dataclass
class Ranges(InputPartition):
    """What a task reads: one large range, or many small files."""
    parts: list[Range]


@dataclass
class Planned(InputPartition):
    """Where a task's ranges stand: a file of the plan, and bytes of it."""
    name: str
    at: int
    size: int


def packed(parts: Iterable[Range], split_bytes: int) -> Iterator[Ranges]:
    """Ranges put together, in order, to about ``split_bytes``; opening one counts as OPEN_BYTES."""
    now, size = Ranges([]), 0
    for r in parts:
        cost = r.stop - r.start + OPEN_BYTES
        if now.parts and size + cost > split_bytes + OPEN_BYTES:
            yield now
            now, size = Ranges([]), 0
        now.parts.append(r)
        size += cost
    if now.parts:
        yield now


def ranges(files: Iterable[tuple[str, int]], split_bytes: int, multiline: bool) -> Iterator[Range]:
    for path, size in files:
        kind = kind_of(path)
        step = max(1, split_bytes) if kind == "text" or (kind in SEPARATORS and not multiline) else max(1, size)
        for a in range(0, max(1, size), step):
            yield Range(path, kind, a, min(a + step, size))


def lines(f: pa.NativeFile, start: int, stop: int) -> Iterator[bytes]:
    """The lines, with their ends, that begin in [start, stop)."""
    f.seek(max(0, start - 1))
    at, rest, skip = max(0, start - 1), b"", start > 0
    while at < stop or rest:
        chunk = f.read(BATCH_BYTES)
        if not chunk:
            if rest and not skip and at < stop:
                yield rest
            return
        own = (rest + chunk).split(b"\n")
        rest = own.pop()
        for line in own:
            if skip:
                skip = False
            elif at < stop:
                yield line + b"\n"
            else:
                return
            at += len(line) + 1
        if at >= stop:
            return


def records(found: Iterator[bytes], multiline: bool) -> Iterator[tuple[str, str]]:
    """(record, ending); with ``multiline`` a record goes on to the line that closes its quotes."""
    held, odd = b"", False
    for line in found:
        held += line
        odd ^= line.count(b'"') % 2 == 1
        if multiline and odd:
            continue
        yield _text(held)
        held, odd = b"", False
    if held:
        yield _text(held)


def _text(raw: bytes) -> tuple[str, str]:
    ending = "\r\n" if raw.endswith(b"\r\n") else "\n" if raw.endswith(b"\n") else ""
    return raw[:len(raw) - len(ending)].decode("utf-8", "replace"), ending


PLAIN = re.compile(r'[^"\r\n]+')


def cells(record: str, kind: str) -> list[str]:
    if PLAIN.fullmatch(record):  # nothing that the csv module reads otherwise
        return record.split(SEPARATORS[kind])
    return next(csv.reader(io.StringIO(record, newline=""), delimiter=SEPARATORS[kind]), [])


class FilesReader(DataSourceReader):
    def __init__(self, options):
        self.root, self.multiline = options["path"], options.get("multiline", "false") == "true"
        self.split = int(options.get("split_bytes", SPLIT_BYTES))
        self.choice = [[p for p in options.get(k, "").split("\n") if p] for k in ("include", "exclude", "kinds")]
        self.percent = int(options.get("percent", 100))
        self.fields, self.plan = options.get("fields", "true") == "true", options.get("plan")

    def partitions(self) -> list[InputPartition]:
        tasks = packed(ranges(chosen(self.root, *self.choice, self.percent), self.split, self.multiline), self.split)
        if not self.plan:
            return list(tasks)
        fs, base = opened(self.plan)
        fs.create_dir(base, recursive=True)
        out, at = [], 0
        with fs.open_output_stream(f"{base}/{(name := uuid.uuid4().hex)}", buffer_size=BATCH_BYTES) as f:
            for task in tasks:
                raw = json.dumps([(r.path, r.kind, r.start, r.stop) for r in task.parts]).encode()
                f.write(raw)
                out.append(Planned(name, at, len(raw)))
                at += len(raw)
        return out

    def _parts(self, partition: InputPartition | None) -> list[Range]:
        if not isinstance(partition, Planned):
            return getattr(partition, "parts", [])
        fs, base = opened(self.plan)
        with fs.open_input_file(f"{base}/{partition.name}") as f:
            f.seek(partition.at)
            return [Range(*r) for r in json.loads(f.read(partition.size))]

    def read(self, partition: InputPartition | None) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(1 << 31)
        fs, base = opened(self.root)
        held, size = [], 0  # rows, of many files where they are small
        for part in self._parts(partition):
            for row, own in self._read(fs, base, part):
                held.append(row)
                size += own
                if size > BATCH_BYTES or len(held) >= BATCH_ROWS:
                    yield self._batch(held)
                    held, size = [], 0
        if held:
            yield self._batch(held)

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), ARROW)], schema=ARROW)

    def _read(self, fs: pafs.FileSystem, base: str, part: Range) -> Iterator[tuple[tuple, int]]:
        """Rows in the order of ARROW, with about their bytes."""
        with fs.open_input_file(f"{base}/{part.path}") as f:
            if part.kind == "binary":
                content = f.read()
                yield (part.path, part.kind, 0, 0, False, None, None, None, None, content), len(content)
                return
            table, names = part.kind in SEPARATORS, None
            many = self.multiline and table
            if table and self.fields:
                first = next(records(lines(f, 0, 1 if not many else part.stop), many), ("", ""))
                names = cells(first[0], part.kind)
            for n, (record, ending) in enumerate(records(lines(f, part.start, part.stop), many)):
                header = table and part.start == 0 and n == 0
                yield (part.path, part.kind, part.start, n, header, record, ending, names, None if names is None or header else cells(record, part.kind), None), len(record)


class Files(DataSource):
    """The source: options path, include, exclude, kinds (lines), percent, split_bytes, multiline, fields, plan (a folder)."""

    @classmethod
    def name(cls) -> str:
        return SOURCE

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FilesReader:
        return FilesReader(dict(self.options))


@dataclass
class Written(WriterCommitMessage):
    """What a task wrote: its folder, the number of ranges, and its details' file.  The
    folder's PARTS has (path, start) of each range, a line each, whose place names its file."""
    folder: str
    n: int
    details: str | None


class FilesWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.root, self.details = options["path"], options.get("details")
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, base = opened(self.root)
        attempt = f"{base}/{JOBS}/{self.job}/{uuid.uuid4().hex}"
        fs.create_dir(attempt, recursive=True)
        parts, counts, now, out = [], {}, None, None
        try:
            for batch in iterator:
                has = set(batch.schema.names)
                path, start, record, ending = (batch.column(c).to_pylist() for c in ("path", "start", "record", "ending"))
                content = batch.column("content").to_pylist() if "content" in has else [None] * len(path)
                details = batch.column("details").to_pylist() if "details" in has else [None] * len(path)
                for p, s, text, end, raw, counted in zip(path, start, record, ending, content, details):
                    if now != (p, s):
                        if out:
                            out.close()
                        now, out = (p, s), fs.open_output_stream(f"{attempt}/{len(parts)}")
                        parts.append(now)
                    out.write(raw if raw is not None else ((text or "") + (end or "")).encode())
                    for d in counted or ():
                        key = (p, d["field"], d["info_type"])
                        counts[key] = counts.get(key, 0) + d["n_transformed"]
        finally:
            if out:
                out.close()
        if len(set(parts)) < len(parts):
            raise ValueError("rows of a range must stand together, as they were read")
        with fs.open_output_stream(f"{attempt}/{PARTS}", buffer_size=BATCH_BYTES) as f:
            for part in parts:
                f.write(json.dumps(part).encode() + b"\n")
        kept = None
        if counts and self.details:
            kept = f"{attempt}/details.parquet"
            rows = [(*k, n) for k, n in sorted(counts.items())]
            pq.write_table(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), DETAIL)], schema=DETAIL), kept, filesystem=fs)
        return Written(attempt, len(parts), kept)

    @staticmethod
    def _dealt(fs: pafs.FileSystem, job: str, own: list[Written]) -> list[str]:
        """The tasks' ranges dealt by their paths to files of about SLICE each: (path, start, task, place) a line."""
        n = min(MOST_SLICES, -(-sum(m.n for m in own) // SLICE))
        names = [f"{job}/slice-{k}" for k in range(n)]
        with ExitStack() as stack:
            outs = [stack.enter_context(fs.open_output_stream(x, buffer_size=1 << 16)) for x in names]
            for i, m in enumerate(own):
                with fs.open_input_file(f"{m.folder}/{PARTS}") as f:
                    for k, line in enumerate(lines(f, 0, f.size())):
                        path, start = json.loads(line)
                        outs[zlib.crc32(path.encode()) % n].write(json.dumps((path, start, i, k)).encode() + b"\n")
        return names

    @staticmethod
    def _slice(fs: pafs.FileSystem, name: str, own: list[Written]) -> dict[str, list[tuple[int, str]]]:
        """(start, file) of every range of the paths in a slice."""
        files: dict[str, list[tuple[int, str]]] = {}
        with fs.open_input_file(name) as f:
            for line in lines(f, 0, f.size()):
                path, start, i, k = json.loads(line)
                files.setdefault(path, []).append((start, f"{own[i].folder}/{k}"))
        return files

    def commit(self, messages: list[Written | None]) -> None:
        fs, base = opened(self.root)
        own = [m for m in messages if m]
        slices = self._dealt(fs, f"{base}/{JOBS}/{self.job}", own)
        for name in slices:  # all, before anything is moved
            if any(len({s for s, _ in p}) < len(p) for p in self._slice(fs, name, own).values()):
                self.abort(messages)
                raise ValueError("a range came from two tasks: write rows as they were read")
        with ThreadPoolExecutor(MOVES) as pool:
            for name in slices:
                files = self._slice(fs, name, own)
                for _ in pool.map(lambda folder: fs.create_dir(folder, recursive=True), sorted({f"{base}/{path}".rsplit("/", 1)[0] for path in files})):
                    pass
                moves = [(name, f"{base}/{path}" + (f".part-{k:05d}" if k else "")) for path, parts in files.items() for k, (_, name) in enumerate(sorted(parts))]
                for _ in pool.map(lambda some: [fs.move(*m) for m in some], [moves[i:i + 1000] for i in range(0, len(moves), 1000)]):
                    pass
        if self.details:
            to_fs, to = opened(self.details)
            to_fs.create_dir(to, recursive=True)
            for m in own:
                if m.details:
                    fs.move(m.details, f"{to}/{uuid.uuid4().hex}.parquet")
        fs.delete_dir(f"{base}/{JOBS}/{self.job}") if own else None

    def abort(self, messages: list[Written | None]) -> None:
        fs, base = opened(self.root)
        job = f"{base}/{JOBS}/{self.job}"
        if fs.get_file_info(job).type == pafs.FileType.Directory:
            fs.delete_dir(job)


class FilesOut(DataSource):
    """The sink: options path, details (a folder for the details' files)."""

    @classmethod
    def name(cls) -> str:
        return SINK

    def writer(self, schema, overwrite: bool) -> FilesWriter:
        return FilesWriter(dict(self.options))


def read_files(spark: SparkSession, root: str, include: Iterable[str] = (), exclude: Iterable[str] = (), kinds: Iterable[str] = (),
               percent: int = 100, split_bytes: int = SPLIT_BYTES, multiline: bool = False, fields: bool = True) -> DataFrame:
    """The records of a file set (see SCHEMA and ``chosen``).  ``record``
    is the text of a line or CSV row, ``cells`` and ``columns`` a CSV row's fields
    and their names (NULL without ``fields``), ``content`` a binary file's bytes."""
    spark.dataSource.register(Files)
    options = {"include": "\n".join(include), "exclude": "\n".join(exclude), "kinds": "\n".join(kinds), "plan": scratch_path(spark, "files", "plan")}
    return (spark.read.format(SOURCE).options(**options, percent=percent, split_bytes=split_bytes, multiline=str(multiline).lower(), fields=str(fields).lower())
            .load(root))


def write_files(df: DataFrame, root: str, details: str | None = None) -> None:
    """Path, start, record, ending (and content, details where there are such
    columns) as files of the same names under ``root``.  ``details``: a folder for
    the sums of the column ``details``, array<struct<field, info_type, n_transformed>>."""
    df.sparkSession.dataSource.register(FilesOut)
    writer = df.write.format(SINK).mode("append").option("path", root)
    (writer.option("details", details) if details else writer).save()


def cell(name: str) -> Column:
    """The field of a CSV row by its name (NULL where the file has no such column)."""
    at = F.array_position("columns", F.lit(name))
    return F.when((at > 0) & (at <= F.size("cells")), F.element_at("cells", F.nullif(at, F.lit(0)).cast("int")))


def with_cell(cells_col: Column, name: str, value: Column) -> Column:
    """``cells_col`` with the named field replaced, where the row has it."""
    at = F.array_position("columns", F.lit(name)) - 1
    return F.transform(cells_col, lambda x, i: F.when(i == at, value).otherwise(x))


def encoded(cells_col: Column) -> Column:
    """A CSV or TSV row's text from its fields, quoted where that is needed."""

    def joined(sep: str) -> Column:
        quoted = F.transform(cells_col, lambda x: F.when(x.rlike(f'["\r\n{sep}]'), F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(x))
        return F.array_join(quoted, sep)

    return F.when(F.col("kind") == "tsv", joined("\t")).otherwise(joined(","))
