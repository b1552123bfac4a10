"""Many small files: few tasks, one read, and the same records as ever."""
import csv
import io
import os
import pickle
import random

import pyarrow as pa
from pyspark.sql import functions as F

from quarry.operators import sensitive as X
from quarry.plans import file_plans as P
from quarry.sources import file_sets as FS


def test_many_small_files_go_to_few_tasks(spark, tmp_path):
    os.makedirs(tmp_path / "in" / "a")
    for k in range(300):
        (tmp_path / "in" / "a" / f"{k:03d}.{['txt', 'csv'][k % 2]}").write_bytes(b"k,mail\n%d,a@b.co\n" % k)
    rows = FS.read_files(spark, f"{tmp_path}/in", split_bytes=1 << 22)
    assert rows.rdd.getNumPartitions() <= 3 and rows.count() == 600
    X.redact_files(spark, f"{tmp_path}/in", f"{tmp_path}/out", columns=["mail"], split_bytes=1 << 22)
    for k in range(300):
        want = b"k,mail\n%d,[redacted]\n" if k % 2 else b"k,mail\n%d,[EMAIL_ADDRESS]\n"
        assert (tmp_path / "out" / "a" / f"{k:03d}.{['txt', 'csv'][k % 2]}").read_bytes() == want % k
    assert os.listdir(tmp_path / "out" / "_jobs") == []


def test_scanned_files_are_read_once(spark, tmp_path):
    spark.createDataFrame([(i, f"line {i}\nmail a@b.co", f"src{i % 3}") for i in range(12)], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, "<p>" * i) for i in range(9)], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    found = P.s15_scan_files(spark, str(tmp_path))
    assert found._jdf.queryExecution().executedPlan().toString().count("quarry_files") == 1
    chosen = {f"src{i % 3}/batch-0.{P.ENDINGS[P.KINDS[i % 3]]}" for i in range(12)} | {f"pages/{i}.bin" for i in range(9)}
    got = {r.path: (r.kind, r.n_records, r.n_bytes) for r in found.collect()}
    assert set(got) == {p for p in chosen if FS.bucket(p) < 70}
    for p, (kind, n, size) in got.items():
        assert (n, size) == ((1, 3 * int(p[6:-4])) if kind == "binary" else (8 + (kind != "text"), None))


def test_addresses_are_searched_for_beside_an_at_sign(spark):
    """the address field as the pattern alone finds it, with the pattern behind a plain test for its @."""
    texts = ["mail a@b.co and c@d.org", "@", "a@b", "x" * 50, "", "no address", "é@b.co", "two\ta.b+c@d-e.fr."]
    rows = spark.createDataFrame([(x,) for x in texts], "message string").select(P._mail(F.col("message")).alias("got"), F.regexp_extract("message", P.MAIL, 0).alias("want"))
    assert all(r.got == r.want for r in rows.collect())
    assert "WHEN Contains(" in rows._jdf.queryExecution().analyzed().toString() or "WHEN contains(" in rows._jdf.queryExecution().analyzed().toString()


def test_what_a_task_reports_is_small(tmp_path):
    """F8: a task's message to the driver names its folder once, not with each of its files."""
    n = 500
    batch = pa.RecordBatch.from_pydict({"path": [f"a/{k}.txt" for k in range(n)], "start": [0] * n, "record": ["x"] * n, "ending": ["\n"] * n})
    writer = FS.FilesWriter({"path": str(tmp_path / ("long" * 30))})
    told = writer.write(iter([batch]))
    assert len(pickle.dumps(told)) < 40 * n
    writer.commit([told, None])
    assert (tmp_path / ("long" * 30) / "a" / "499.txt").read_bytes() == b"x\n"


def test_cells_as_the_csv_module_reads_them():
    """F8: rows without quotes and line ends are only split, with the same cells."""
    r = random.Random(2)
    for record in ["", ",", "a", *["".join(r.choices('ab ,\t"\r\n\x00', k=r.randrange(1, 8))) for _ in range(5000)]]:
        for kind, sep in FS.SEPARATORS.items():
            assert FS.cells(record, kind) == next(csv.reader(io.StringIO(record, newline=""), delimiter=sep), [])
    assert FS.PLAIN.fullmatch("a,b") and not FS.PLAIN.fullmatch('a,"b"')


def test_lines_and_fields_share_a_run_of_the_detectors(spark, tmp_path):
    """F8: a line has no fields and a CSV row is no line, so that both are searched at once."""
    (tmp_path / "a.txt").write_bytes(b"mail a@b.co\n")
    (tmp_path / "b.csv").write_bytes(b"k,m,n\n1,x@y.org,\n2,plain,q@r.st\n")
    rows = FS.read_files(spark, str(tmp_path))

    def runs(**kw):
        return X.redact_records(rows, **kw)._jdf.queryExecution().analyzed().toString().count("regexp_replace")

    assert 0 < runs() == runs(text_columns=["m"]) == runs(text_columns=["m", "n"]) // 2
    got = {r.record: [tuple(d) for d in r.details] for r in X.redact_records(rows, columns=["k"], text_columns=["m", "n"]).collect()}
    assert got == {"mail [EMAIL_ADDRESS]": [("line", "EMAIL_ADDRESS", 1)], "k,m,n": [], "[redacted],[EMAIL_ADDRESS],": [("m", "EMAIL_ADDRESS", 1), ("k", "REDACTED", 1)],
                   "[redacted],plain,[EMAIL_ADDRESS]": [("n", "EMAIL_ADDRESS", 1), ("k", "REDACTED", 1)]}
