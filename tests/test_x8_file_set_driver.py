"""what the driver holds of a file set doesn't grow with the number of its files."""
import os
import pickle
import tracemalloc

import pyarrow as pa
import pyarrow.fs as pafs
import pytest

from __spark_entry__ import oracle_sql
from quarry.plans import file_plans as P
from quarry.sources import file_sets as FS


def batch(parts):
    paths, starts = zip(*parts)
    return pa.RecordBatch.from_pydict({"path": list(paths), "start": list(starts), "record": [f"{p} {s}" for p, s in parts], "ending": ["\n"] * len(parts)})


def test_a_plan_holds_the_names_of_the_files(tmp_path):
    names = [f"{'ab'[k % 2]}/deep/{k:04d}.txt" for k in range(2000)]
    for folder in "ab":
        os.makedirs(tmp_path / "in" / folder / "deep")
    for k, name in enumerate(names):
        (tmp_path / "in" / name).write_bytes(b"%d\n" % k)
    reader = FS.FilesReader({"path": f"{tmp_path}/in", "plan": f"file://{tmp_path}/plan", "split_bytes": str(1000 * FS.OPEN_BYTES)})
    tasks = reader.partitions()
    assert 2 <= len(tasks) <= 4 and len(pickle.dumps(tasks)) < 300 * len(tasks)
    read = [r for task in tasks for b in reader.read(pickle.loads(pickle.dumps(task))) for r in b.select(["path", "record"]).to_pylist()]
    assert sorted((r["path"], int(r["record"])) for r in read) == sorted((n, k) for k, n in enumerate(names))
    inline = FS.FilesReader({"path": f"{tmp_path}/in"})
    assert [p.path for task in inline.partitions() for p in task.parts] == sorted(names)


def test_folders_are_listed_block_by_block(tmp_path, monkeypatch):
    names = ["a", "a-b/x", "a.d/y", "a0", "b/c/z", "b/c0", "b-", "é/ü"] + [f"many/{k}" for k in range(10)]
    for name in [*names, "_no/x", "b/.no", "b/_no/x"]:
        os.makedirs((tmp_path / name).parent, exist_ok=True)
        (tmp_path / name).write_bytes(name.encode())
    want = sorted((n, len(n.encode())) for n in names)
    assert list(FS.chosen(str(tmp_path))) == want == FS.list_files(f"file://{tmp_path}")
    assert list(FS.below(pafs.SubTreeFileSystem(str(tmp_path), pafs.LocalFileSystem()), "")) == want  # a file system that lists folders as wholes
    monkeypatch.setattr(FS, "LISTED", 3)
    assert sorted(FS.chosen(str(tmp_path))) == want == FS.list_files(str(tmp_path))
    with pytest.raises(FileNotFoundError):
        FS.list_files(f"{tmp_path}/nothing")


def test_commit_holds_a_slice_at_a_time(tmp_path, monkeypatch):
    monkeypatch.setattr(FS, "SLICE", 100)
    n = 4000
    writer = FS.FilesWriter({"path": str(tmp_path)})
    told = [writer.write(iter([batch([(f"{k % 3}/{k:05d}.txt", 0) for k in range(i, n, 2)])])) for i in (0, 1)]
    assert len(pickle.dumps(told)) < 1000
    tracemalloc.start()
    writer.commit([*told, None])
    held = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert held < 1_500_000
    assert [(tmp_path / f"{k % 3}" / f"{k:05d}.txt").read_text() for k in range(n)] == [f"{k % 3}/{k:05d}.txt 0\n" for k in range(n)]
    assert os.listdir(tmp_path / "_jobs") == []


def test_ranges_of_tasks_in_slices(tmp_path, monkeypatch):
    """Parts of a file are numbered over all tasks, and a range that came twice stops the commit before a move."""
    monkeypatch.setattr(FS, "SLICE", 2)
    odd = 'a "q"\nb é.txt'
    writer = FS.FilesWriter({"path": str(tmp_path / "out")})
    told = [writer.write(iter([batch(x)])) for x in ([("big", 50), ("x/one", 0), (odd, 9)], [("big", 5), ("x/two", 0)], [("big", 700), ("y", 3)])]
    writer.commit(told)
    got = {os.path.relpath(os.path.join(d, f), tmp_path / "out"): open(os.path.join(d, f)).read() for d, _, fs in os.walk(tmp_path / "out") for f in fs}
    assert got == {"big": "big 5\n", "big.part-00001": "big 50\n", "big.part-00002": "big 700\n", "x/one": "x/one 0\n", "x/two": "x/two 0\n", odd: f"{odd} 9\n", "y": "y 3\n"}
    writer = FS.FilesWriter({"path": str(tmp_path / "twice")})
    told = [writer.write(iter([batch(x)])) for x in ([("a", 0), ("b", 0), ("c", 0)], [("d", 0), ("c", 0)])]
    with pytest.raises(ValueError, match="two tasks"):
        writer.commit(told)
    assert [f for _, _, fs in os.walk(tmp_path / "twice") for f in fs] == []


def test_redacted_csv_files_are_read_without_a_file_index(spark, tmp_path):
    import duckdb

    texts = ['he said "hi", a@b.co\tx\nplain', "", "\n\n", '"', "a\rb, c\nssn 123-45-6789\r", ' spaced ,"" \n\t', "back\\slash\\", None, "é ü 日本, 4111111111111111"]
    rows = [(i, texts[i % len(texts)], [None, "src two", "src1", "src12", "src%20x"][i % 5]) for i in range(200)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    found = P.x8_redact_csv_files(spark, str(tmp_path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and plan.count("quarry_files") == 1
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = sorted(con.execute(oracle_sql()["x8_redact_csv_files"]).fetchall())
    assert sorted(map(tuple, found.collect())) == want
