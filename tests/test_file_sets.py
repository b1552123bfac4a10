"""File sets: byte ranges, endings, CSV rows, names, selection, commit and
de-identification, against files written and read with plain Python."""
import os
import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import sensitive as X
from quarry.sources import file_sets as FS

FILES = {
    "a/one.txt": b"first line\nmail a@b.co here\n\nlast without end",
    "a/two.log": b"\r\nwindows\r\nends\r\n",
    "a/empty.txt": b"",
    "b/three.csv": b'id,email,message\n1,x@y.org,"he said ""hi"", card 4111111111111111"\n2,,plain\n3,q@r.st\n',
    "b/four.tsv": b"message\tid\nssn 123-45-6789\t7\nnothing\t8",
    "b/other.csv": b"k,v\n1,m@n.op\n",
    "c/five.bin": bytes(range(256)) * 3,
    "c/ignore/six.txt": b"z@z.zz\n",
    "_hidden/seven.txt": b"no",
    "c/bad.txt": b"caf\xe9 \xff\n",
}


@pytest.fixture
def root(tmp_path):
    for name, data in FILES.items():
        os.makedirs(tmp_path / "in" / os.path.dirname(name), exist_ok=True)
        (tmp_path / "in" / name).write_bytes(data)
    return tmp_path


def under(folder):
    return {os.path.relpath(os.path.join(d, f), folder): open(os.path.join(d, f), "rb").read() for d, _, fs in os.walk(folder) for f in fs}


@pytest.mark.parametrize("split", [1, 7, 1 << 20])
def test_round_trip_in_ranges(spark, root, split):
    rows = FS.read_files(spark, f"{root}/in", kinds=["text", "csv", "tsv", "binary"], split_bytes=split)
    FS.write_files(rows.select("path", "start", "record", "ending", "content"), f"file://{root}/out")
    got = {}
    for name, data in sorted(under(f"{root}/out").items()):
        got[name.split(".part-")[0]] = got.get(name.split(".part-")[0], b"") + data
    want = {n: d.decode("utf-8", "replace").encode() if FS.kind_of(n) != "binary" else d for n, d in FILES.items() if d and not n.startswith("_")}
    assert got == want
    if split > 100:
        assert sorted(under(f"{root}/out")) == sorted(want)


def test_lines_of_random_files(tmp_path):
    import pyarrow.fs as pafs

    r = random.Random(1)
    for _ in range(150):
        data = bytes(r.choices(b"ab\n", k=r.randrange(40)))
        (tmp_path / "f").write_bytes(data)
        step = r.randrange(1, 15)
        with pafs.LocalFileSystem().open_input_file(str(tmp_path / "f")) as f:
            got = [list(FS.lines(f, a, min(a + step, len(data)))) for a in range(0, len(data), step)]
        assert [x for part in got for x in part] == data.splitlines(keepends=True)
        for k, part in enumerate(got):
            begun = [i for i in range(len(data)) if (i == 0 or data[i - 1] == 10) and k * step <= i < (k + 1) * step]
            assert len(part) == len(begun)


def test_selection(spark, root):
    def names(**kw):
        return sorted(x.path for x in FS.read_files(spark, f"{root}/in", **kw).select("path").distinct().collect())

    assert names(kinds=["csv"]) == ["b/other.csv", "b/three.csv"]
    assert names(include=[r"^a/", r"\.bin$"], exclude=["empty"]) == ["a/one.txt", "a/two.log", "c/five.bin"]
    assert names(exclude=["ignore"], kinds=["text"]) == ["a/one.txt", "a/two.log", "c/bad.txt"]
    some = names(percent=50)
    assert some == sorted(n for n in names() if FS.bucket(n) < 50) and names(percent=0) == []
    assert FS.read_files(spark, f"{root}/in", include=["nothing"]).count() == 0


def test_csv_rows(spark, root):
    rows = FS.read_files(spark, f"{root}/in", include=["three", "four"]).orderBy("path", "row").collect()
    assert [(x.header, x.cells) for x in rows] == [(True, None), (False, ["ssn 123-45-6789", "7"]), (False, ["nothing", "8"]),
                                                   (True, None), (False, ["1", "x@y.org", 'he said "hi", card 4111111111111111']), (False, ["2", "", "plain"]), (False, ["3", "q@r.st"])]
    assert {tuple(x.columns) for x in rows} == {("id", "email", "message"), ("message", "id")}


def test_redacted_files_and_details(spark, root):
    X.redact_files(spark, f"{root}/in", f"{root}/out", columns=["email"], text_columns=["message"], exclude=["ignore", "bad"], details=f"{root}/details")
    got = under(f"{root}/out")
    assert got == {"a/one.txt": b"first line\nmail [EMAIL_ADDRESS] here\n\nlast without end", "a/two.log": FILES["a/two.log"],
                   "b/three.csv": b'id,email,message\n1,[redacted],"he said ""hi"", card [CREDIT_CARD_NUMBER]"\n2,[redacted],plain\n3,[redacted]\n',
                   "b/four.tsv": b"message\tid\nssn [US_SOCIAL_SECURITY_NUMBER]\t7\nnothing\t8", "b/other.csv": FILES["b/other.csv"]}
    log = {(x.path, x.field, x.info_type): x.n for x in spark.read.parquet(f"{root}/details").groupBy("path", "field", "info_type").agg(F.sum("n_transformed").alias("n")).collect()}
    assert log == {("a/one.txt", "line", "EMAIL_ADDRESS"): 1, ("b/three.csv", "email", "REDACTED"): 3, ("b/three.csv", "message", "CREDIT_CARD_NUMBER"): 1,
                   ("b/four.tsv", "message", "US_SOCIAL_SECURITY_NUMBER"): 1}


def test_multiline_csv(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    (tmp_path / "in" / "m.csv").write_bytes(b'"a\nb",note\n"1\n2","mail a@b.co\nsecond ""x"""\n3,4\n')
    X.redact_files(spark, f"{tmp_path}/in", f"{tmp_path}/out", columns=["a\nb"], text_columns=["note"], multiline=True, split_bytes=2)
    assert under(f"{tmp_path}/out") == {"m.csv": b'"a\nb",note\n[redacted],"mail [EMAIL_ADDRESS]\nsecond ""x"""\n[redacted],4\n'}


def test_a_failed_job_leaves_nothing(spark, root):
    rows = FS.read_files(spark, f"{root}/in", kinds=["text"])
    broken = rows.withColumn("record", F.when(F.col("path") == "c/bad.txt", F.raise_error(F.lit("broken"))).otherwise(F.col("record")))
    os.makedirs(root / "out" / "a")
    (root / "out" / "a" / "one.txt").write_bytes(b"old")
    with pytest.raises(Exception):
        FS.write_files(broken, f"{root}/out")
    assert under(f"{root}/out") == {"a/one.txt": b"old"}
    with pytest.raises(Exception):
        FS.write_files(rows.select("path", "start", "record", "ending").filter("path = 'a/one.txt'").unionByName(
            rows.select("path", "start", "record", "ending").filter("path = 'a/one.txt'")), f"{root}/out")
    assert under(f"{root}/out") == {"a/one.txt": b"old"}
