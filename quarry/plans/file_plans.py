"""File-set queries (S15, S16, X8) over files derived from ``documents`` and
``pages``: a document's lines stand in a text, CSV or TSV file of its source, each
page in a binary file.  The sink that writes them is the one under test, so names
are known, and the oracles state for every file what it must hold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import sensitive as X
from quarry.plans.registry import register, t
from quarry.plans.sensitive_plans import ALL, duck_findings_sql, duck_redacted_sql, duck_replacements_sql
from quarry.session import scratch_path
from quarry.sources import file_sets as FS

MAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
KINDS = ["text", "csv", "tsv"]
ENDINGS = {"text": "txt", "csv": "csv", "tsv": "tsv"}
HEADER = ["doc_id", "line", "email", "message"]

#: Every line of every document: rid, its file, its place there, and its text.
LINES = rf"""(SELECT doc_id * 1000000 + i AS rid, doc_id, i AS line, kind, source || '/batch-' || (doc_id // 60) || '.' || CASE kind WHEN 'text' THEN 'txt' ELSE kind END AS path,
        string_split(text, chr(10))[i + 1] AS text
 FROM (SELECT doc_id, coalesce(source, 'none') AS source, coalesce(text, '') AS text, {KINDS}[1 + doc_id % 3] AS kind,
              unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents))"""


def _places(spark: SparkSession, d: str) -> DataFrame:
    """The documents with the kind and the path of the file that each stands in."""
    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), (1 + F.col("doc_id") % 3).cast("int"))
    own = t(spark, d, "documents").select("doc_id", F.coalesce("source", F.lit("none")).alias("source"), kind.alias("kind"), "text")
    end = F.when(F.col("kind") == "text", "txt").otherwise(F.col("kind"))
    return own.withColumn("path", F.concat("source", F.lit("/batch-"), F.floor(F.col("doc_id") / 60), F.lit("."), end))


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return _places(spark, d).select("doc_id", "source", "kind", "path", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line", "message"))


def _mail(text: Column) -> Column:
    """The first address in a text, else ''; the pattern is only searched for where there is an @."""
    return F.when(text.contains("@"), F.regexp_extract(text, MAIL, 0)).otherwise("")


def file_set(spark: SparkSession, d: str, binary: bool = False) -> str:
    """The folder that holds the files."""
    own = _lines(spark, d)
    fields = F.array(F.col("doc_id").cast("string"), F.col("line").cast("string"), _mail(F.col("message")), "message")
    body = own.select("path", "doc_id", "line", F.when(F.col("kind") == "text", F.col("message")).otherwise(FS.encoded(fields)).alias("record"))
    heads = _places(spark, d).filter(F.col("kind") != "text").select("path", "kind").distinct().select(
        "path", F.lit(-1).cast("bigint").alias("doc_id"), F.lit(0).alias("line"), FS.encoded(F.array(*[F.lit(h) for h in HEADER])).alias("record"))
    rows = body.unionByName(heads).withColumn("content", F.lit(None).cast("binary"))
    if binary:
        rows = rows.unionByName(t(spark, d, "pages").select(F.concat(F.lit("pages/"), F.col("page_id"), F.lit(".bin")).alias("path"), F.col("page_id").alias("doc_id"),
                                                            F.lit(0).alias("line"), F.lit(None).cast("string").alias("record"), F.col("html").cast("binary").alias("content")))
    root = scratch_path(spark, "files", "set")
    ordered = rows.repartition("path").sortWithinPartitions("path", "doc_id", "line")
    FS.write_files(ordered.select("path", F.lit(0).cast("bigint").alias("start"), "record", F.when(F.col("record").isNotNull(), "\n").alias("ending"), "content"), root)
    return root


def _sums(files: DataFrame, *keys: str, more: Sequence[Column] = ()) -> DataFrame:
    """Records, characters and an order-free checksum by ``keys``, and ``more``."""
    digest = F.conv(F.substring(F.md5(F.coalesce("record", F.lit(""))), 1, 8), 16, 10).cast("bigint")
    return files.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_records"), F.coalesce(F.sum(F.length("record")), F.lit(0)).cast("bigint").alias("n_chars"), F.sum(digest).alias("checksum"), *more)


def _duck_sums(rows: str, *keys: str) -> str:
    own = ", ".join(keys)
    return (f"SELECT {own}, CAST(count(*) AS BIGINT) AS n_records, CAST(coalesce(sum(length(record)), 0) AS BIGINT) AS n_chars, "
            f"CAST(sum(('0x' || substr(md5(coalesce(record, '')), 1, 8))::BIGINT) AS BIGINT) AS checksum FROM ({rows}) GROUP BY {own}")


def _duck_quoted(x: str, kind: str) -> str:
    return f"CASE WHEN contains({x}, '\"') OR contains({x}, chr(13)) OR contains({x}, CASE {kind} WHEN 'tsv' THEN chr(9) ELSE ',' END) THEN '\"' || replace({x}, '\"', '\"\"') || '\"' ELSE {x} END"


def _duck_records(lines: str, email: str, message: str) -> str:
    """(path, kind, record) of the files with the given columns; text files have ``message``."""
    sep = "CASE kind WHEN 'tsv' THEN chr(9) ELSE ',' END"
    return f"""SELECT path, kind, CASE kind WHEN 'text' THEN {message}
         ELSE doc_id || {sep} || line || {sep} || {_duck_quoted(email, 'kind')} || {sep} || {_duck_quoted(message, 'kind')} END AS record FROM {lines}
UNION ALL SELECT DISTINCT path, kind, CASE kind WHEN 'tsv' THEN array_to_string({HEADER}, chr(9)) ELSE array_to_string({HEADER}, ',') END FROM {lines} WHERE kind <> 'text'"""


DUCK_MAIL = f"regexp_extract(text, '{MAIL}')"
CHOSEN = "('0x' || substr(md5(path), 1, 8))::BIGINT % 100 < 70 AND NOT regexp_matches(path, '^src1[0-9]/') AND regexp_matches(path, '^(src|pages/)')"


@register("s15_scan_files", f"""
SELECT path, kind, n_records, n_chars, checksum, CAST(NULL AS BIGINT) AS n_bytes FROM ({_duck_sums(_duck_records(LINES, DUCK_MAIL, 'text'), 'path', 'kind')}) WHERE {CHOSEN}
UNION ALL
SELECT * FROM (SELECT 'pages/' || page_id || '.bin' AS path, 'binary' AS kind, 1 AS n_records, 0 AS n_chars, ('0x' || substr(md5(''), 1, 8))::BIGINT AS checksum,
                      octet_length(encode(coalesce(html, ''))) AS n_bytes FROM pages) WHERE {CHOSEN}""")
def s15_scan_files(spark, d):
    files = FS.read_files(spark, file_set(spark, d, binary=True), include=["^src", "^pages/"], exclude=[r"^src1[0-9]/"], percent=70, split_bytes=1 << 22)
    return _sums(files, "path", "kind", more=[F.sum(F.octet_length("content")).alias("n_bytes")])  # the files are read once


REDACTED = f"(SELECT l.*, m.r FROM {LINES} l JOIN ({duck_redacted_sql(LINES, 'rid', 'text', ALL)}) m ON m.rid = l.rid)"


@register("s16_write_redacted_files", _duck_sums(f"SELECT path, r AS record FROM {REDACTED} WHERE kind = 'text'", "path"))
def s16_write_redacted_files(spark, d):
    # lines with their findings replaced, written under the names they came from
    out = scratch_path(spark, "files", "redacted")
    lines = FS.read_files(spark, file_set(spark, d), kinds=["text"])
    FS.write_files(X.redact_text(lines, "record").select("path", "start", "record", "ending"), out)
    return _sums(FS.read_files(spark, out), "path")


def _job(spark, d) -> tuple[str, str]:
    """The de-identification job over the whole set but one group of sources; (files, details)."""
    out, details = scratch_path(spark, "files", "redacted"), scratch_path(spark, "files", "details")
    X.redact_files(spark, file_set(spark, d), out, columns=["email"], text_columns=["message"], exclude=[r"^src1[0-9]/"], details=details)
    return out, details


KEPT = "NOT regexp_matches(path, '^src1[0-9]/')"


@register("x8_redact_files", _duck_sums(f"SELECT * FROM ({_duck_records(REDACTED, chr(39) + '[redacted]' + chr(39), 'r')}) WHERE {KEPT}", "path", "kind"))
def x8_redact_files(spark, d):
    return _sums(FS.read_files(spark, _job(spark, d)[0]), "path", "kind")


@register("x8_file_details", f"""
SELECT path, CASE kind WHEN 'text' THEN 'line' ELSE 'message' END AS field, info_type, CAST(count(*) AS BIGINT) AS n_transformed
FROM ({duck_replacements_sql(duck_findings_sql(LINES, 'rid', 'text', ALL), 'rid')}) f JOIN {LINES} l ON l.rid = f.rid WHERE {KEPT} GROUP BY path, field, info_type
UNION ALL SELECT path, 'email', 'REDACTED', CAST(count(*) AS BIGINT) FROM {LINES} WHERE kind <> 'text' AND {KEPT} GROUP BY path""")
def x8_file_details(spark, d):
    log = spark.read.parquet(_job(spark, d)[1])
    return log.groupBy("path", "field", "info_type").agg(F.sum("n_transformed").alias("n_transformed"))


@register("x8_redact_csv_files", f"""
SELECT split_part(path, '/', 1) AS source, kind, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) AS BIGINT) AS n_email_redacted,
       CAST(sum(('0x' || substr(md5(r), 1, 8))::BIGINT) AS BIGINT) AS messages
FROM {REDACTED} WHERE kind <> 'text' AND {KEPT} GROUP BY 1, 2""")
def x8_redact_csv_files(spark, d):
    # what another CSV reader, Spark's, finds in the files that were written: its parser runs
    # over their rows, as its file scan would hold every file's status on the driver
    rows = FS.read_files(spark, _job(spark, d)[0], kinds=list(FS.SEPARATORS), fields=False).filter(~F.col("header"))
    read = {kind: F.from_csv("record", "doc_id long, line int, email string, message string",
                             {"sep": sep, "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}) for kind, sep in FS.SEPARATORS.items()}
    found = rows.select(F.split_part("path", F.lit("/"), F.lit(1)).alias("source"), "kind", F.when(F.col("kind") == "tsv", read["tsv"]).otherwise(read["csv"]).alias("row"))
    message = F.coalesce("row.message", F.lit(""))
    return found.groupBy("source", "kind").agg(F.count(F.lit(1)).alias("n_rows"), F.count(F.when(F.col("row.email") == "[redacted]", 1)).alias("n_email_redacted"),
                                               F.sum(F.conv(F.substring(F.md5(message), 1, 8), 16, 10).cast("bigint")).alias("messages"))
