"""Sensitive-data queries (X1-X12) over ``documents``, ``pages``,
``conversations`` and ``customer``.

The DuckDB oracles take the shapes, words and base likelihoods from the
detector catalog and state all rules anew as relations: every match is a row
with its place (a running sum over the parts of the split text), context is a
join of matches with words, overlapping findings are islands of a running
maximum, and a text is put together by an ordered aggregate.  Checksums are
DuckDB list expressions.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import infotypes as I
from quarry.operators import sensitive as X
from quarry.plans.registry import register, t
from quarry.sources import io

# --------------------------------------------------------------------------
# DuckDB forms of the detectors (oracle side)
# --------------------------------------------------------------------------


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _duck_digit(d: str, pos: str) -> str:
    return f"CAST(substr({d}, {pos}, 1) AS INTEGER)"


def _duck_luhn(d: str) -> str:
    x = _duck_digit(d, f"length({d}) - i")
    return (f"(length({d}) >= 2 AND list_sum(list_transform(range(length({d})), lambda i: "
            f"CASE WHEN i % 2 = 1 THEN ({x} * 2) - CASE WHEN {x} * 2 > 9 THEN 9 ELSE 0 END ELSE {x} END)) % 10 = 0)")


def _duck_checksum(kind: str, q: str) -> str:
    digits = f"regexp_replace({q}, '[^0-9]', '', 'g')"
    if kind == "luhn":
        return _duck_luhn(digits)
    if kind == "npi":
        return _duck_luhn(f"('80840' || {digits})")
    if kind == "aba":
        x = _duck_digit(digits, "i + 1")
        return (f"(length({digits}) = 9 AND list_sum(list_transform(range(9), lambda i: {x} * "
                f"[3, 7, 1, 3, 7, 1, 3, 7, 1][i + 1])) % 10 = 0)")
    if kind == "iban":
        s = f"upper(regexp_replace({q}, '\\s', '', 'g'))"
        moved = f"(substr({s}, 5) || substr({s}, 1, 4))"
        vals = (f"list_transform(string_split({moved}, ''), lambda c: CASE WHEN regexp_full_match(c, '[0-9]') "
                f"THEN CAST(c AS BIGINT) ELSE ascii(c) - 55 END)")
        return (f"(list_reduce(list_prepend(CAST(0 AS BIGINT), {vals}), lambda acc, v: CASE WHEN v >= 10 "
                f"THEN (acc * 100 + v) % 97 ELSE (acc * 10 + v) % 97 END) = 1)")
    if kind == "vin":
        s = f"upper({q})"
        ch = f"substr({s}, i + 1, 1)"
        val = (f"CASE WHEN regexp_full_match({ch}, '[0-9]') THEN CAST({ch} AS INTEGER) ELSE "
               f"CAST(substr({_q(I.VIN_VALUES)}, instr({_q(I.VIN_LETTERS)}, {ch}), 1) AS INTEGER) END")
        w = "[" + ", ".join(str(x) for x in I.VIN_WEIGHTS) + "]"
        total = f"list_sum(list_transform(range(17), lambda i: {val} * {w}[i + 1]))"
        return f"(substr({s}, 9, 1) = CASE WHEN {total} % 11 = 10 THEN 'X' ELSE CAST({total} % 11 AS VARCHAR) END)"
    raise ValueError(kind)


def _either_case(word: str) -> str:
    """A word with its letters as classes of both cases (ASCII alone, unlike (?i))."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else "[ \\t]+" if c == " " else c for c in word)


def duck_findings_sql(table: str, id_col: str, text: str, types, min_likelihood="POSSIBLE",
                      overrides=None, field: str | None = None) -> str:
    """(id, field, info_type, likelihood, quote, start, length) rows, as DuckDB SQL."""
    overrides = overrides or {}
    dets = [I.BY_NAME[n] for n in types if I.BY_NAME[n].tier < 4]
    opened, closed = "chr(57344)", "chr(57345)"

    def places(name: str, pattern: str) -> str:
        marked = f"regexp_replace({text}, {_q(f'({pattern})')}, {opened} || '\\1' || {closed}, 'g')"
        return (f"SELECT {id_col}, {_q(name)} AS info_type, string_split({marked}, {opened}) AS parts "
                f"FROM {table} WHERE regexp_matches({text}, {_q(pattern)})")

    def rows(named: str) -> str:
        """Every match of ``named`` with where it starts and ends."""
        return f"""SELECT {id_col}, info_type, s AS start, s + length(quote) AS stop, quote FROM (
  SELECT {id_col}, info_type, k, split_part(part, {closed}, 1) AS quote,
         CAST(sum(length(replace(part, {closed}, ''))) OVER (PARTITION BY {id_col}, info_type ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS INTEGER) AS s
  FROM (SELECT {id_col}, info_type, unnest(parts) AS part, generate_subscripts(parts, 1) AS k FROM {named})) WHERE k > 1"""

    rules = ", ".join(f"({_q(d.name)}, {d.tier}, {I.RANK[d.base]}, {_q(d.checksum or '')}, {I.RANK[overrides.get(d.name, min_likelihood)]})" for d in dets)
    words = [places(d.name, rf"\b(?:{'|'.join(_either_case(w) for w in sorted(d.context, key=lambda w: (-len(w), w)))})\b") for d in dets if d.context]
    checks = " ".join(f"WHEN {_q(kind)} THEN CASE WHEN {_duck_checksum(kind, 'f.quote')} THEN {I.RANK['VERY_LIKELY']} ELSE {I.RANK['UNLIKELY']} END"
                      for kind in sorted({d.checksum for d in dets if d.checksum}))
    checked = f"WHEN r.tier = 1 THEN CASE r.checksum {checks} END" if checks else ""
    none = f"SELECT {id_col}, '' AS info_type, CAST([] AS VARCHAR[]) AS parts FROM {table} WHERE false"
    gap = f"substr(t.{text}, least(f.stop, w.stop) + 1, greatest(f.start, w.start) - least(f.stop, w.stop))"
    names = "[" + ", ".join(_q(x) for x in I.LIKELIHOODS) + "]"
    return f"""SELECT {id_col}, {_q(field or text)} AS field, info_type, {names}[rank + 1] AS likelihood, quote, start, CAST(length(quote) AS INTEGER) AS length FROM (
WITH rules(info_type, tier, base, checksum, threshold) AS (VALUES {rules}),
marked AS ({chr(10).join([' UNION ALL '.join(places(d.name, d.shape) for d in dets)])}),
words AS ({' UNION ALL '.join(words) or none}),
found AS ({rows('marked')}), spoken AS ({rows('words')}),
near AS (SELECT DISTINCT f.{id_col}, f.info_type, f.start FROM found f JOIN spoken w ON w.{id_col} = f.{id_col} AND w.info_type = f.info_type
         JOIN {table} t ON t.{id_col} = f.{id_col}
         WHERE (w.stop <= f.start OR w.start >= f.stop) AND greatest(f.start, w.start) - least(f.stop, w.stop) <= {I.CONTEXT_WINDOW} AND NOT contains({gap}, chr(10)))
SELECT * FROM (SELECT f.{id_col}, f.info_type, f.quote, f.start, r.threshold,
    CASE {checked} WHEN n.start IS NOT NULL THEN greatest(r.base, {I.RANK['LIKELY']}) WHEN r.tier = 3 THEN -1 ELSE r.base END AS rank
  FROM found f JOIN rules r ON r.info_type = f.info_type LEFT JOIN near n ON n.{id_col} = f.{id_col} AND n.info_type = f.info_type AND n.start = f.start)
WHERE rank >= threshold)"""


def duck_replacements_sql(findings: str, id_col: str) -> str:
    """(id, start, stop, info_type): findings that overlap as one, named by the likeliest, longest, leftmost, first by name."""
    ranks = "list_position([" + ", ".join(_q(x) for x in I.LIKELIHOODS) + "], likelihood)"
    return f"""SELECT {id_col}, min(start) AS start, max(start + length) AS stop,
       first(info_type ORDER BY {ranks} DESC, length DESC, start, info_type) AS info_type
FROM (SELECT *, sum(CASE WHEN reach > start THEN 0 ELSE 1 END) OVER (PARTITION BY {id_col} ORDER BY start, length, info_type, quote) AS island
      FROM (SELECT *, coalesce(max(start + length) OVER (PARTITION BY {id_col} ORDER BY start, length, info_type, quote ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS reach
            FROM ({findings})))
GROUP BY {id_col}, island"""


def duck_redacted_sql(table: str, id_col: str, text: str, types, findings: str | None = None) -> str:
    """(id, text, r): the text with its replacements made."""
    found = findings or duck_findings_sql(table, id_col, text, types)
    return f"""SELECT t.{id_col}, t.{text}, coalesce(p.head || substr(t.{text}, p.last + 1), t.{text}) AS r FROM {table} t LEFT JOIN (
  SELECT c.{id_col}, max(c.stop) AS last, string_agg(substr(d.{text}, c.before + 1, c.start - c.before) || '[' || c.info_type || ']', '' ORDER BY c.start) AS head
  FROM (SELECT *, coalesce(lag(stop) OVER (PARTITION BY {id_col} ORDER BY start), 0) AS before FROM ({duck_replacements_sql(found, id_col)})) c
  JOIN {table} d ON d.{id_col} = c.{id_col} GROUP BY c.{id_col}) p ON p.{id_col} = t.{id_col}"""


# --------------------------------------------------------------------------
# inspection
# --------------------------------------------------------------------------

ALL = I.PATTERN_TYPES
CARD_OVERRIDE = {"CREDIT_CARD_NUMBER": "UNLIKELY"}


def _docs(spark, d):
    return t(spark, d, "documents").select("doc_id", "text")


def _partitions(spark) -> int | None:
    """Set by callers whose tables come as one unsplittable file."""
    return int(spark.conf.get("quarry.inspect.partitions", "0")) or None


@register("x1_inspect_documents", duck_findings_sql("documents", "doc_id", "text", ALL))
def x1_inspect_documents(spark, d):
    return X.inspect(_docs(spark, d), "doc_id", "text", min_likelihood="POSSIBLE", partitions=_partitions(spark))


@register("x2_inspect_override", duck_findings_sql("documents", "doc_id", "text", ALL, overrides=CARD_OVERRIDE))
def x2_inspect_override(spark, d):
    return X.inspect(_docs(spark, d), "doc_id", "text", min_likelihood="POSSIBLE", overrides=CARD_OVERRIDE)


@register("x3_save_findings", duck_findings_sql("documents", "doc_id", "text", ALL))
def x3_save_findings(spark, d):
    from quarry.plans.tables_plans import fresh_db
    db, _ = fresh_db(spark, "x3")
    name = io.materialize(X.inspect(_docs(spark, d), "doc_id", "text"), f"{db}.findings")
    return spark.table(name)


@register("x4_findings_summary", f"""
SELECT info_type, likelihood, CAST(count(*) AS BIGINT) AS n_findings
FROM ({duck_findings_sql("documents", "doc_id", "text", ALL, overrides=CARD_OVERRIDE)})
GROUP BY info_type, likelihood""")
def x4_findings_summary(spark, d):
    f = X.inspect(_docs(spark, d), "doc_id", "text", overrides=CARD_OVERRIDE)
    return X.findings_summary(f)


# --------------------------------------------------------------------------
# De-identification
# --------------------------------------------------------------------------


@register("x5_redact_columns", """
SELECT c_custkey, '[redacted]' AS c_name, c_nationkey, '[redacted]' AS c_mktsegment FROM customer""")
def x5_redact_columns(spark, d):
    from quarry.plans.warehouse import customers_with_nulls
    c = customers_with_nulls(spark, d).select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return X.redact_columns(c, ["c_name", "c_mktsegment"])


@register("x6_redact_text", f"""
SELECT doc_id, md5(r) AS text_md5, CAST(length(r) AS INTEGER) AS n_chars, r <> text AS changed
FROM ({duck_redacted_sql('documents', 'doc_id', 'text', ALL)})""")
def x6_redact_text(spark, d):
    docs = _docs(spark, d).withColumn("orig", F.col("text"))
    r = X.redact_text(docs, "text", ids=["doc_id"], partitions=_partitions(spark))
    return r.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").alias("n_chars"),
                    (F.col("text") != F.col("orig")).alias("changed"))


@register("x7_redaction_log", f"""
SELECT doc_id, 'text' AS field, info_type, CAST(count(*) AS INTEGER) AS n_transformed
FROM ({duck_replacements_sql(duck_findings_sql('documents', 'doc_id', 'text', ALL), 'doc_id')}) GROUP BY doc_id, info_type""")
def x7_redaction_log(spark, d):
    return X.redaction_log(_docs(spark, d), "doc_id", ["text"], partitions=_partitions(spark))


GUARD_RULES = [("EMAIL_ADDRESS", "[blocked: contact data]"), ("AUTH_TOKEN", "[blocked: secret]"),
               ("CREDIT_CARD_NUMBER", "[blocked: card number]"), (re.compile("(?:[A-Z]+!! ){20}"), "[blocked: shouting]")]
GUARDED = "(SELECT conv_id * 1000 + turn AS rid, text FROM conversations UNION ALL SELECT -1 - doc_id, text FROM documents)"


def _duck_guard() -> str:
    types = [what for what, _ in GUARD_RULES if isinstance(what, str)]
    found = duck_findings_sql(GUARDED, "rid", "text", types)
    cases = " ".join(f"WHEN {f'list_contains(f.hits, {_q(what)})' if isinstance(what, str) else f'regexp_matches(r.text, {_q(what.pattern)})'} THEN {_q(notice)}"
                     for what, notice in reversed(GUARD_RULES))
    return f"""
SELECT rid, md5(g) AS text_md5, g LIKE '[blocked:%' AS blocked FROM (
  SELECT r.rid, CASE {cases} ELSE r.r END AS g
  FROM ({duck_redacted_sql(GUARDED, 'rid', 'text', ALL)}) r
  LEFT JOIN (SELECT rid, list(DISTINCT info_type) AS hits FROM ({found}) GROUP BY rid) f ON f.rid = r.rid)"""


@register("x9_block_guard", _duck_guard())
def x9_block_guard(spark, d):
    said = t(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("rid"), "text")
    g = X.block_guard(said.unionByName(t(spark, d, "documents").select((-1 - F.col("doc_id")).alias("rid"), "text")), "text", GUARD_RULES, out="g", deidentify=None)
    return g.select("rid", F.md5("g").alias("text_md5"), F.col("g").startswith("[blocked:").alias("blocked"))


# --------------------------------------------------------------------------
# Tier 4: terms of one to four words, taken from the benchmark's texts
# --------------------------------------------------------------------------

TERMS_SQL = f"""(SELECT DISTINCT {X.TERM_TYPES}[1 + item_id // 4 % 4] AS info_type, list_transform(words[2 : 2 + item_id % 4], lambda w: lower(w)) AS words
 FROM (SELECT item_id, regexp_extract_all(text, '[\\p{{L}}\\p{{N}}]+') AS words FROM benchmark))"""

DUCK_TERMS = f"""
WITH parts AS (SELECT doc_id, unnest(p) AS part, generate_subscripts(p, 1) AS k
               FROM (SELECT doc_id, string_split(regexp_replace(text, '([\\p{{L}}\\p{{N}}]+)', chr(57344) || '\\1' || chr(57345), 'g'), chr(57344)) AS p FROM documents)),
placed AS (SELECT doc_id, k - 1 AS k, split_part(part, chr(57345), 1) AS tok,
                  CAST(sum(length(replace(part, chr(57345), ''))) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS INTEGER) AS start FROM parts),
toks AS (SELECT doc_id, k, lower(tok) AS tok, start, start + length(tok) AS stop FROM placed WHERE k > 0),
docs AS (SELECT doc_id, list(tok ORDER BY k) AS words FROM toks GROUP BY doc_id),
hits AS (SELECT DISTINCT a.doc_id, m.info_type, a.start, e.stop FROM toks a JOIN {TERMS_SQL} m ON m.words[1] = a.tok JOIN docs d ON d.doc_id = a.doc_id
         JOIN toks e ON e.doc_id = a.doc_id AND e.k = a.k + len(m.words) - 1 WHERE d.words[a.k : a.k + len(m.words) - 1] = m.words)
SELECT h.doc_id, 'text' AS field, h.info_type, 'LIKELY' AS likelihood, substr(t.text, h.start + 1, h.stop - h.start) AS quote, h.start, CAST(h.stop - h.start AS INTEGER) AS length
FROM hits h JOIN documents t ON t.doc_id = h.doc_id
WHERE NOT EXISTS (SELECT 1 FROM hits o WHERE o.doc_id = h.doc_id AND o.start <= h.start AND o.stop >= h.stop AND o.stop - o.start > h.stop - h.start)"""


def _terms(spark, d):
    words = F.regexp_extract_all("text", F.lit(r"([\p{L}\p{N}]+)"), 1)
    return t(spark, d, "benchmark").select(
        F.element_at(F.array(*[F.lit(x) for x in X.TERM_TYPES]), (1 + F.floor(F.col("item_id") / 4) % 4).cast("int")).alias("info_type"),
        F.array_join(F.slice(words, F.lit(2), (1 + F.col("item_id") % 4).cast("int")), " ").alias("term"))


@register("x1_inspect_terms", DUCK_TERMS)
def x1_inspect_terms(spark, d):
    return X.inspect(_docs(spark, d), "doc_id", "text", types=[], terms=_terms(spark, d))


@register("x6_redact_terms", f"""
SELECT doc_id, md5(r) AS text_md5, CAST(length(r) AS INTEGER) AS n_chars
FROM ({duck_redacted_sql('documents', 'doc_id', 'text', [], f"SELECT * FROM ({duck_findings_sql('documents', 'doc_id', 'text', ALL)}) UNION ALL SELECT * FROM ({DUCK_TERMS})")})""")
def x6_redact_terms(spark, d):
    r = X.redact_text(_docs(spark, d), "text", terms=_terms(spark, d), ids=["doc_id"], partitions=_partitions(spark))
    return r.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").alias("n_chars"))


# --------------------------------------------------------------------------
# Profiles, sensitivity, visibility
# --------------------------------------------------------------------------


def _duck_hits(table, col, names, min_rank):
    if not names:
        return "CAST(0 AS BIGINT)"
    f = duck_findings_sql(table, "_rid", col, names, min_likelihood=I.LIKELIHOODS[min_rank])
    return f"(SELECT CAST(count(DISTINCT _rid) AS BIGINT) FROM ({f}))"


def _duck_profile(table: str, cols: list[tuple[str, str, bool]]) -> str:
    """cols: (name, duck type name for data_type, is_text)."""
    high = [n for n in ALL if I.BY_NAME[n].category in I.HIGH_CATEGORIES]
    other = [n for n in ALL if n not in high]
    src = f"(SELECT row_number() OVER () AS _rid, * FROM {table})"
    rows = []
    for name, dtype, is_text in cols:
        h = _duck_hits(src, name, high, I.RANK["LIKELY"]) if is_text else "CAST(NULL AS BIGINT)"
        o = _duck_hits(src, name, other, I.RANK["POSSIBLE"]) if is_text else "CAST(NULL AS BIGINT)"
        rows.append(
            f"SELECT {_q(table)} AS table_name, {_q(name)} AS column_name, {_q(dtype)} AS data_type, "
            f"CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) - count({name}) AS BIGINT) AS n_nulls, "
            f"CAST(NULL AS BIGINT) AS approx_distinct, CAST(min({name}) AS VARCHAR) AS min_value, "
            f"CAST(max({name}) AS VARCHAR) AS max_value, {str(is_text).lower()} AS is_text, "
            f"{h} AS n_high_findings, {o} AS n_other_findings FROM {table}")
    return "\nUNION ALL\n".join(rows)


DOC_COLS = [("doc_id", "bigint", False), ("text", "string", True), ("lang", "string", True),
            ("source", "string", True), ("n_chars", "bigint", False)]


@register("x10_profile_documents", _duck_profile("documents", DOC_COLS))
def x10_profile_documents(spark, d):
    return X.profile(t(spark, d, "documents"), "documents", distinct=False)


ALL_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()
#: Columns of the tables without long texts, as DuckDB lists them: the findings of texts are checked on documents.
COUNTED = f"""SELECT table_name, column_name, n_rows, n_nulls, true AS distinct_near FROM (
{" UNION ALL ".join(f"SELECT '{n}' AS table_name, * FROM (UNPIVOT (SELECT count(*) - count(COLUMNS(*)) FROM {n}) ON COLUMNS(*) INTO NAME column_name VALUE n_nulls), (SELECT count(*) AS n_rows FROM {n})" for n in ALL_TABLES)})"""


def _identity(field):
    """A column's values by what tells them apart: numbers, dates and times as they
    are (zeros by their sign), texts and nested values over 64 characters by their SHA-256."""
    c, kind = F.col(field.name), field.dataType.typeName()
    if kind in ("float", "double"):
        return F.struct(c.alias("v"), F.when(c == 0, c.cast("string")).alias("zero"))
    if kind in ("byte", "short", "integer", "long", "decimal", "boolean", "date", "timestamp", "timestamp_ntz"):
        return c
    text = c if kind == "string" else F.to_json(F.struct(c))
    return F.when(F.length(text) > 64, F.concat(F.lit("#"), F.sha2(text, 256))).otherwise(text)


def _near(spark, d, report, names):
    """``report`` with whether each approximate distinct count lies within a twentieth
    of the exact one.  Each column is read and grouped alone, in its own type."""
    each = []
    for n in names:
        df = t(spark, d, n)
        for f in df.schema.fields:
            values = df.filter(F.col(f.name).isNotNull()).select(_identity(f).alias("v")).distinct()
            each.append(values.select(F.lit(n).alias("tn"), F.lit(f.name).alias("cn")))
    exact = reduce(DataFrame.unionByName, each).groupBy("tn", "cn").agg(F.count(F.lit(1)).alias("n"))
    both = report.join(exact, (report["table_name"] == exact["tn"]) & (report["column_name"] == exact["cn"]), "left").withColumn("exact", F.coalesce("n", F.lit(0)))
    return both.withColumn("distinct_near", F.abs(F.col("approx_distinct") - F.col("exact")) <= 0.05 * F.col("exact"))


@register("x10_profile_all_tables", COUNTED)
def x10_profile_all_tables(spark, d):
    # every supplied table; approximate distinct counts within a twentieth
    report = X.profile_tables({n: t(spark, d, n) for n in ALL_TABLES})
    return _near(spark, d, report, ALL_TABLES).select("table_name", "column_name", "n_rows", "n_nulls", "distinct_near")


@register("x10_profile_merged", f"""
SELECT table_name, column_name, data_type, n_rows, n_nulls, min_value, max_value, is_text, n_high_findings, n_other_findings, true AS distinct_near, true AS median_near
FROM ({_duck_profile("documents", DOC_COLS)})""")
def x10_profile_merged(spark, d):
    # three runs, each over its slice, stored in one table and merged without reading a document again
    from quarry.plans.tables_plans import fresh_db
    db, _ = fresh_db(spark, "x10")
    docs = t(spark, d, "documents")
    for k in range(3):
        io.materialize(X.profile_parts({"documents": docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(3)) == k)}), f"{db}.profiles", "append")
    report = _near(spark, d, X.profile_report(X.merge_profiles(spark.table(f"{db}.profiles"))), ["documents"])
    medians = docs.agg(*[F.percentile(c, F.array(F.lit(0.47), F.lit(0.53))).alias(c) for c in ("doc_id", "n_chars")])
    bounds = medians.select(F.inline(F.array(*[F.struct(F.lit(c).alias("bn"), F.col(c)[0].alias("low"), F.col(c)[1].alias("high")) for c in medians.columns])))
    near = F.col("approx_median").isNull() | F.col("approx_median").between(F.col("low"), F.col("high"))
    return report.join(bounds, report["column_name"] == bounds["bn"], "left").select(
        "table_name", "column_name", "data_type", "n_rows", "n_nulls", "min_value", "max_value", "is_text", "n_high_findings", "n_other_findings", "distinct_near", near.alias("median_near"))


@register("x11_classify_columns", f"""
SELECT table_name, column_name,
       CASE WHEN NOT is_text OR n_rows = n_nulls THEN 'UNKNOWN' WHEN n_high_findings > 0 THEN 'HIGH'
            WHEN n_other_findings > 0 THEN 'MODERATE' ELSE 'LOW' END AS sensitivity
FROM ({_duck_profile("documents", DOC_COLS)})""")
def x11_classify_columns(spark, d):
    c = X.classify(X.profile(t(spark, d, "documents"), "documents", distinct=False))
    return c.select("table_name", "column_name", "sensitivity")


@register("x11_table_sensitivity", f"""
SELECT table_name, ['UNKNOWN', 'LOW', 'MODERATE', 'HIGH'][1 + max(CASE WHEN NOT is_text OR n_rows = n_nulls THEN 0 WHEN n_high_findings > 0 THEN 3
       WHEN n_other_findings > 0 THEN 2 ELSE 1 END)] AS sensitivity
FROM ({_duck_profile("documents", DOC_COLS)} UNION ALL {_duck_profile("conversations", [("conv_id", "bigint", False), ("turn", "bigint", False), ("role", "string", True), ("text", "string", True)])}
      UNION ALL {_duck_profile("region", [("r_regionkey", "bigint", False), ("r_name", "string", True)])}) GROUP BY table_name""")
def x11_table_sensitivity(spark, d):
    return X.table_sensitivity(X.classify(X.profile_tables({n: t(spark, d, n) for n in ("documents", "conversations", "region")}, distinct=False)))


def _doc_levels_sql() -> str:
    high = [n for n in ALL if I.BY_NAME[n].category in I.HIGH_CATEGORIES]
    f = duck_findings_sql("documents", "doc_id", "text", ALL)
    ranks = "list_position(['VERY_UNLIKELY','UNLIKELY','POSSIBLE','LIKELY','VERY_LIKELY'], likelihood) - 1"
    hl = "[" + ", ".join(_q(x) for x in high) + "]"
    return f"""
(SELECT d.doc_id, d.source,
        CASE WHEN max(CASE WHEN list_contains({hl}, f.info_type) AND {ranks} >= 3 THEN 1 ELSE 0 END) = 1 THEN 'HIGH'
             WHEN count(f.info_type) > 0 THEN 'MODERATE' ELSE 'LOW' END AS level
 FROM documents d LEFT JOIN ({f}) f ON d.doc_id = f.doc_id GROUP BY d.doc_id, d.source)"""


@register("x12_visible_assets", f"""
WITH grants AS (SELECT * FROM (VALUES ('public', 'LOW'), ('analyst', 'LOW'), ('analyst', 'MODERATE'),
                                      ('admin', 'LOW'), ('admin', 'MODERATE'), ('admin', 'HIGH')) g(principal, level))
SELECT g.principal, l.doc_id, l.source FROM {_doc_levels_sql()} l JOIN grants g ON l.level = g.level""")
def x12_visible_assets(spark, d):
    docs = t(spark, d, "documents").select("doc_id", "source", "text")
    f = X.inspect(docs, "doc_id", "text")
    high = [n for n in ALL if I.BY_NAME[n].category in I.HIGH_CATEGORIES]
    per_doc = f.groupBy("doc_id").agg(
        F.max(F.when(F.col("info_type").isin(high) & F.col("likelihood").isin("LIKELY", "VERY_LIKELY"), 1)
              .otherwise(0)).alias("_h"), F.count(F.lit(1)).alias("_n"))
    tags = docs.select("doc_id").join(per_doc, "doc_id", "left").select(
        F.col("doc_id").alias("asset"), F.lit("sensitivity").alias("tag_key"),
        F.when(F.col("_h") == 1, "HIGH").when(F.col("_n") > 0, "MODERATE").otherwise("LOW").alias("tag_value"))
    grants = spark.createDataFrame(
        [("public", "LOW"), ("analyst", "LOW"), ("analyst", "MODERATE"),
         ("admin", "LOW"), ("admin", "MODERATE"), ("admin", "HIGH")], "principal string, tag_value string") \
        .withColumn("tag_key", F.lit("sensitivity"))
    assets = docs.select(F.col("doc_id").alias("asset"), "source")
    v = X.visible_assets(assets, tags, F.broadcast(grants))
    return v.select("principal", F.col("asset").alias("doc_id"), "source")
