"""Sensitive-data jobs (X1-X12): inspection, de-identification,
transformation logs, block guard, column profiles, sensitivity levels and
tag-based visibility.

All of them work on spans: where each detector's matches start and end, with
its likelihood (``with_spans``).  Inspection reports the spans, de-identification
replaces them (spans that overlap as one), the log counts those replacements
and the guard decides on them, so they can't disagree.  Spans are a map-only
job: native regex and checksum expressions in projections of each text row.  No
shuffle, no Python, and each text is scanned whole.  Only the summary (X4),
profiles (X10) and the dictionary types (tier 4) shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from quarry.functions import infotypes as I
from quarry.functions import spans
from quarry.sources import file_sets as FS


def _types(types: Iterable[str] | None) -> list[str]:
    names = list(types) if types is not None else I.PATTERN_TYPES
    unknown = [t for t in names if t not in I.BY_NAME]
    if unknown:
        raise ValueError(f"unknown info types: {unknown}")
    terms = [t for t in names if I.BY_NAME[t].tier == 4]
    if terms:
        raise ValueError(f"info types without a pattern, see dictionary_findings: {terms}")
    return names


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _spread(df: DataFrame, keys: Sequence[str], partitions: int | None) -> DataFrame:
    """``partitions``: deal the rows by ``keys`` before the detectors run.  For
    callers whose input has fewer splits than they have cores (one large file that
    can't be split); by default rows stay where they were read."""
    return df.repartition(partitions, *keys) if partitions else df


def _unused(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        out.append(n)
    return out


def with_spans(df: DataFrame, text_col: str, out: str, types: Iterable[str] | None = None, min_likelihood: str = "POSSIBLE",
               overrides: Mapping[str, str] | None = None) -> DataFrame:
    """``df`` with a column ``out``: array<struct<start, end, no, rank>> of the
    findings in ``text_col`` at or above the threshold of their type; ``no`` is the
    place of the type in ``type_order(types)``.  One projection a step and no shuffle."""
    names = type_order(types)
    if not names:
        return df.withColumn(out, F.expr("CAST(array() AS array<struct<start:int,end:int,no:int,rank:int>>)"))
    dets = [I.BY_NAME[n] for n in names]
    safe, ctx, *flags = _unused(df, "_safe", "_ctx", "_digit", "_run", "_caps", "_maybe")
    sig = dict(zip(("digit", "run", "caps", "maybe"), flags))
    own = I.signals(F.col(_q(text_col)), dets)
    searched = F.when(own["maybe"], F.expr(spans.searchable(_q(text_col))))
    pre = df.select("*", searched.alias(safe), *[own[k].alias(v) for k, v in sig.items()])
    words = I.context_words_found(F.col(safe), [d for d in dets if d.tier == 3])
    pre = pre.select("*", F.when(F.col(sig["digit"]) | F.col(sig["caps"]), words).otherwise(F.array().cast("array<string>")).alias(ctx))
    found = F.expr(I.findings_sql(_q(text_col), _q(safe), dets, _q(ctx), {k: _q(v) for k, v in sig.items()}))
    thresholds = [I.RANK[(overrides or {}).get(n, min_likelihood)] for n in names]
    if len(set(thresholds)) == 1:
        kept = F.filter(found, lambda f: f["rank"] >= thresholds[0])
    else:
        kept = F.filter(found, lambda f: f["rank"] >= F.element_at(F.array(*[F.lit(x) for x in thresholds]), f["no"]))
    return pre.select(*[F.col(_q(c)) for c in df.columns], F.coalesce(kept, F.expr("CAST(array() AS array<struct<start:int,end:int,no:int,rank:int>>)")).alias(out))


def type_order(types: Iterable[str] | None = None) -> list[str]:
    """The types in the order that numbers them and settles ties: by name."""
    return sorted(set(_types(types)))


def _name_of(no: Column, names: Sequence[str]) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names] or [F.lit("")]), no)


def _quote(text_col: str, span: Column) -> Column:
    return F.substring(F.col(_q(text_col)), span["start"] + 1, span["end"] - span["start"])


def inspect(df: DataFrame, id_cols: str | Sequence[str], text_col: str,
            types: Iterable[str] | None = None, min_likelihood: str = "POSSIBLE",
            overrides: Mapping[str, str] | None = None, field: str | None = None,
            terms: DataFrame | None = None, partitions: int | None = None) -> DataFrame:
    """Findings ``(ids..., field, info_type, likelihood, quote, start,
    length)`` at or above ``min_likelihood``, ``start`` in code points from 0;
    ``overrides`` lowers or raises the threshold of single info types (a template
    override).  ``terms`` adds the dictionary types (see ``dictionary_findings``)."""
    ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    names = type_order(types)
    own = _spread(df.select(*ids, text_col), ids, partitions)
    (found,) = _unused(own, "_found")
    item = lambda f: F.struct(_name_of(f["no"], names).alias("info_type"), I.likelihood_name(f["rank"]).alias("likelihood"),
                              _quote(text_col, f).alias("quote"), f["start"].alias("start"), (f["end"] - f["start"]).alias("length"))
    rows = with_spans(own, text_col, found, names, min_likelihood, overrides)
    out = rows.select(*ids, F.lit(field or text_col).alias("field"), F.inline(F.transform(found, item)))
    return out if terms is None else out.unionByName(dictionary_findings(df, ids, text_col, terms, field))


def findings_summary(findings: DataFrame) -> DataFrame:
    """Number of findings per info type and likelihood (partial
    aggregation map-side; output is at most 81 x 5 rows)."""
    return findings.groupBy("info_type", "likelihood").agg(F.count(F.lit(1)).alias("n_findings"))


TOKEN = r"[\p{L}\p{N}]+"
TERM_BLOCK = 16  # words


def dictionary_findings(df: DataFrame, id_cols: str | Sequence[str], text_col: str,
                        terms: DataFrame, field: str | None = None) -> DataFrame:
    """Tier 4: terms ``(info_type, term)`` of any number of words, matched word by
    word (letters and digits, in lower case; what stands between doesn't count).

    A text's words are dealt by blocks of TERM_BLOCK, each with the few words after
    it that the longest term has; every word is joined on the first words of the
    terms, and only what begins a term is compared further and placed in the text.
    Spark chooses the join by the size of the terms (AQE splits a hot word's side).
    Of matches that lie in a longer one of the same text only the longer is
    reported; a term of two types is reported as both."""
    ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    split = F.filter(F.split(F.lower(F.col("term")), rf"[^\p{{L}}\p{{N}}]+"), lambda w: w != "")
    known = (terms.select("info_type", split.alias("_words")).filter(F.size("_words") > 0)
             .groupBy("_words").agg(F.array_sort(F.collect_set("info_type")).alias("_types")).withColumn("_first", F.col("_words")[0]))
    longest = known.agg(F.max(F.size("_words")).alias("n")).first()["n"]  # one number
    if longest is None:
        return df.select(*ids, F.lit("").alias("field"), F.lit("").alias("info_type"), F.lit("").alias("likelihood"), F.lit("").alias("quote"),
                                             F.lit(0).alias("start"), F.lit(0).alias("length")).limit(0)
    safe = df.filter(F.col(text_col).isNotNull()).select(*ids, F.monotonically_increasing_id().alias("_row"), F.expr(spans.searchable(_q(text_col))).alias("_text"))
    # outside, word, outside, .., so a word's place in its block is odd; outer, or Spark
    # would take the arrays apart once more to see whether they are empty
    parted = safe.select(*ids, "_row", F.expr(spans.parts("_text", spans.sql_str(f"({TOKEN})"))).alias("_parts"))
    placed = parted.select(*ids, "_row", "_parts", F.expr(spans.block_starts("_parts", 2 * TERM_BLOCK)).alias("_starts"))
    block = F.slice("_parts", F.col("_b") * (2 * TERM_BLOCK) + 1, F.lit(2 * (TERM_BLOCK + longest - 1)))
    blocks = placed.select(*ids, "_row", "_parts", F.posexplode_outer("_starts").alias("_b", "_from")).select(*ids, "_row", "_from", block.alias("_block"))
    words = blocks.select(*ids, "_row", "_from", "_block", F.posexplode_outer(F.slice("_block", 1, 2 * TERM_BLOCK)).alias("_at", "_word")).filter(F.col("_at") % 2 == 1)
    # what a row carries is a word and the few after it, never the text
    each = words.select(*ids, "_row", F.lower("_word").alias("_first"), F.slice("_block", F.col("_at") + 1, F.lit(2 * longest - 1)).alias("_said"),
                        (F.col("_from") + F.length(F.array_join(F.slice("_block", F.lit(1), F.col("_at")), ""))).alias("start"))
    n = F.size("_words")
    spoken = F.transform(F.sequence(F.lit(0), n - 1), lambda j: F.lower(F.get("_said", 2 * j)))
    second = F.lower(F.get("_said", F.lit(2))) == F.get("_words", F.lit(1))  # most end here
    hits = each.join(known, "_first").filter((n == 1) | (second & (spoken == F.col("_words"))))
    found = hits.select(*ids, "_row", "_types", "start", F.array_join(F.slice("_said", F.lit(1), 2 * n - 1), "").alias("quote")).withColumn("length", F.length("quote"))
    end = F.col("start") + F.col("length")
    earlier = Window.partitionBy(*ids, "_row").orderBy("start", F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    kept = found.withColumn("_reach", F.max(end).over(earlier)).filter(F.col("_reach").isNull() | (F.col("_reach") < end))
    return kept.select(*ids, F.lit(field or text_col).alias("field"), F.explode("_types").alias("info_type"), F.lit("LIKELY").alias("likelihood"), "quote", "start", "length")


# --------------------------------------------------------------------------
# De-identification
# --------------------------------------------------------------------------


def redact_columns(df: DataFrame, cols: Iterable[str], value: str = "[redacted]") -> DataFrame:
    """Replace whole columns by a constant (NULLs too)."""
    cols = set(cols)
    return df.select(*[F.lit(value).alias(c) if c in cols else F.col(c) for c in df.columns])


SPANS = "array<struct<start:int,end:int,no:int,rank:int>>"
TERM_TYPES = sorted(d.name for d in I.DETECTORS if d.tier == 4)


def with_replacements(df: DataFrame, text_col: str, out: str, types: Iterable[str] | None = None, min_likelihood: str = "POSSIBLE",
                      overrides: Mapping[str, str] | None = None, terms: DataFrame | None = None, ids: Sequence[str] = ()) -> DataFrame:
    """``df`` with a column ``out``: array<struct<start, end, info_type>> of what is
    to be replaced in ``text_col``, in text order.  These are the findings that
    ``inspect`` reports; findings that overlap are replaced as one, named by the
    likeliest of them (then the longest, the leftmost, the first by name), so no
    part of a finding stays.  With ``terms``, ``ids`` name the rows one by one."""
    names = type_order(types) + TERM_TYPES
    (found,) = _unused(df, "_found")
    own = with_spans(df, text_col, found, types, min_likelihood, overrides)
    spans_sql = _q(found)
    if terms is not None:
        no = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("info_type")).cast("int")
        said = (dictionary_findings(df, list(ids), text_col, terms)
                .groupBy(*[F.col(i).alias(f"_k{k}") for k, i in enumerate(ids)])
                .agg(F.collect_list(F.struct("start", (F.col("start") + F.col("length")).alias("end"), no.alias("no"), F.lit(I.RANK["LIKELY"]).alias("rank"))).alias("_said")))
        own = own.join(said, reduce(lambda a, b: a & b, [own[i].eqNullSafe(said[f"_k{k}"]) for k, i in enumerate(ids)]), "left")
        spans_sql = f"concat({spans_sql}, coalesce(_said, CAST(array() AS {SPANS})))"
    merged = spans.clusters(spans_sql, "named_struct('rank', _x.rank, 'length', _x.end - _x.start, 'left', -_x.start, 'first', -_x.no)")
    listed = f"array({', '.join(spans.sql_str(n) for n in names)})"
    named = f"transform({merged}, _x -> named_struct('start', _x.start, 'end', _x.end, 'info_type', element_at({listed}, -_x.best.first)))"
    return own.select(*[F.col(_q(c)) for c in df.columns], F.expr(named).alias(out))


def _rebuilt(text_col: str, replacements: str) -> Column:
    return F.expr(spans.replaced(_q(text_col), _q(replacements), "concat('[', _c.info_type, ']')"))


def redact_text(df: DataFrame, col: str, types: Iterable[str] | None = None, min_likelihood: str = "POSSIBLE",
                overrides: Mapping[str, str] | None = None, terms: DataFrame | None = None, ids: Sequence[str] = (),
                partitions: int | None = None) -> DataFrame:
    """Each finding in ``col`` becomes its ``[INFO_TYPE]`` (see
    ``with_replacements``); a NULL stays NULL."""
    (rep,) = _unused(df, "_replaced")
    own = with_replacements(_spread(df, list(ids), partitions), col, rep, types, min_likelihood, overrides, terms, ids)
    return own.select(*[_rebuilt(col, rep).alias(c) if c == col else F.col(_q(c)) for c in df.columns])


def _counts(replacements: str) -> Column:
    """array<struct<info_type, n_transformed>> of a column of replacements."""
    labels = F.col(_q(replacements))["info_type"]
    return F.transform(F.array_sort(F.array_distinct(labels)),
                       lambda x: F.struct(x.alias("info_type"), F.size(F.filter(labels, lambda y: y == x)).alias("n_transformed")))


def _detail(field: Column, replacements: str) -> Column:
    return F.transform(_counts(replacements), lambda x: F.struct(field.alias("field"), x["info_type"].alias("info_type"), x["n_transformed"].alias("n_transformed")))


def redaction_log(df: DataFrame, id_cols: str | Sequence[str], fields: Sequence[str], types: Iterable[str] | None = None,
                  min_likelihood: str = "POSSIBLE", overrides: Mapping[str, str] | None = None, terms: DataFrame | None = None,
                  partitions: int | None = None) -> DataFrame:
    """Which record, field and info type was transformed, and how many
    times: the replacements that ``redact_text`` makes, counted in the row."""
    ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    own = _spread(df.select(*ids, *[f for f in fields if f not in ids]), ids, partitions)
    reps = _unused(own, *[f"_replaced{k}" for k in range(len(fields))])
    for f, rep in zip(fields, reps):
        own = with_replacements(own, f, rep, types, min_likelihood, overrides, terms, ids)
    return own.select(*ids, F.inline(F.concat(*[_detail(F.lit(f), rep) for f, rep in zip(fields, reps)])))


def redact_records(files: DataFrame, columns: Iterable[str] = (), text_columns: Iterable[str] = (), types: Iterable[str] | None = None,
                   value: str = "[redacted]", min_likelihood: str = "POSSIBLE") -> DataFrame:
    """Rows of ``file_sets.read_files`` de-identified, with a column ``details``.
    Of CSV and TSV rows the fields ``columns`` become ``value`` (X5) and findings in
    ``text_columns`` their names (X6); in lines of text files all findings do.
    Headers stay, and rows without a change are as they were read."""
    text_columns = list(text_columns)
    is_line = F.col("kind") == "text"
    # a row is a line or has fields, so lines are searched with the first of the columns, in one run of the detectors
    own = files.withColumn("_new", F.col("cells"))
    for k, c in enumerate(text_columns or [None]):
        text = F.lit(None).cast("string") if c is None else FS.cell(c)
        own = own.withColumn(f"_v{k}", text if k else F.when(is_line, F.col("record")).otherwise(text))
    logs = []
    for k, c in enumerate(text_columns or [None]):
        own = with_replacements(own, f"_v{k}", f"_r{k}", types, min_likelihood)
        logs.append(_detail(F.lit(c) if k else F.when(is_line, "line").otherwise(F.lit(c)), f"_r{k}"))
        if c is not None:
            own = own.withColumn("_new", FS.with_cell(F.col("_new"), c, _rebuilt(f"_v{k}", f"_r{k}")))
    for c in columns:
        own = own.withColumn("_new", FS.with_cell(F.col("_new"), c, F.lit(value)))
        logs.append(F.when(FS.cell(c).isNotNull(), F.array(F.struct(F.lit(c).alias("field"), F.lit("REDACTED").alias("info_type"), F.lit(1).alias("n_transformed")))))
    record = (F.when(is_line, _rebuilt("_v0", "_r0"))
              .when(F.col("cells").isNotNull() & ~F.col("_new").eqNullSafe(F.col("cells")), FS.encoded(F.col("_new"))).otherwise(F.col("record")))
    none = F.array().cast("array<struct<field:string,info_type:string,n_transformed:int>>")
    return own.select(*[record.alias(c) if c == "record" else F.col(c) for c in files.columns],
                      F.concat(*[F.coalesce(x, none) for x in logs]).alias("details"))


def redact_files(spark, root: str, out: str, columns: Iterable[str] = (), text_columns: Iterable[str] = (), types: Iterable[str] | None = None,
                 include: Iterable[str] = (), exclude: Iterable[str] = (), kinds: Iterable[str] = ("text", "csv", "tsv"), percent: int = 100,
                 details: str | None = None, value: str = "[redacted]", min_likelihood: str = "POSSIBLE", multiline: bool = False,
                 split_bytes: int = FS.SPLIT_BYTES) -> None:
    """The files of a set, de-identified (``redact_records``), under the same
    names in ``out``, in one pass from scan to sink without a shuffle.  Files of
    other kinds aren't written.  ``details``: a folder that gets, as Parquet, how
    often each info type was transformed by file and field (sum over the rows of
    one file: each task adds its own)."""
    files = FS.read_files(spark, root, include, exclude, kinds, percent, split_bytes, multiline)
    FS.write_files(redact_records(files, columns, text_columns, types, value, min_likelihood).select("path", "start", "record", "ending", "details"), out, details)


def block_guard(df: DataFrame, col: str, rules: Sequence[tuple[str | re.Pattern, str]], out: str | None = None,
                deidentify: Iterable[str] | None = (), min_likelihood: str = "POSSIBLE") -> DataFrame:
    """The text with the findings of ``deidentify`` (None: all pattern types)
    replaced by their names; but where the text as it came has a finding of a
    blocked type, or matches a blocked pattern, the whole text becomes the rule's
    notice.  ``rules``: (info type, or compiled pattern whose text Spark matches,
    notice); of several that apply the last decides."""
    rules = [(I.SYNONYMS.get(what, what) if isinstance(what, str) else what, notice) for what, notice in rules]
    blocked = type_order([what for what, _ in rules if isinstance(what, str)])
    rep, found = _unused(df, "_replaced", "_blocked")
    own = with_spans(df, col, found, blocked, min_likelihood)
    kept = F.col(_q(col))
    if deidentify is None or list(deidentify):
        own = with_replacements(own, col, rep, deidentify, min_likelihood)
        kept = _rebuilt(col, rep)
    chain = None
    for what, notice in reversed(rules):
        if isinstance(what, str):
            cond = F.array_contains(F.col(_q(found))["no"], blocked.index(what) + 1)
        else:
            cond = F.col(_q(col)).rlike(what.pattern)
        chain = F.when(cond, F.lit(notice)) if chain is None else chain.when(cond, F.lit(notice))
    expr = kept if chain is None else chain.otherwise(kept)
    return own.withColumn(out or col, expr).drop(rep, found)


# --------------------------------------------------------------------------
# Profiles and sensitivity
# --------------------------------------------------------------------------


_ORDERED = ("date", "timestamp", "timestamp_ntz", "boolean")
#: What a stored profile holds of a column beside its names: counts, bounds as text, and sketches.
STORED = ("n_rows", "n_nulls", "min_value", "max_value", "n_high_findings", "n_other_findings", "distinct_sketch", "quantile_sketch")


def profile_parts(tables: Mapping[str, DataFrame], types: Iterable[str] | None = None, min_likelihood: str = "POSSIBLE",
                  sketches: bool = True) -> DataFrame:
    """X10 as parts that can be stored and merged: one row per (table, column) with
    rows, NULLs, smallest and largest value as text, for text columns the number of
    values with a high-category finding at LIKELY or above and with any other
    finding at ``min_likelihood`` or above, and (``sketches``) a HyperLogLog sketch
    of the values and a KLL sketch of numbers.

    Each table is scanned once: the findings of its text columns are flags in the
    same rows, and one aggregation (partial before its shuffle) has all columns."""
    thr = I.RANK[min_likelihood]
    names = type_order(types)
    hi_thr = max(thr, I.RANK["LIKELY"])
    is_high = F.array(*[F.lit(I.BY_NAME[n].category in I.HIGH_CATEGORIES) for n in names] or [F.lit(False)])
    out = None
    for table, df in tables.items():
        fields = list(df.schema.fields)
        own = df.select(*[F.col(_q(f.name)).alias(f"c{i}") for i, f in enumerate(fields)])
        aggs, rows = [F.count(F.lit(1)).alias("n")], []
        for i, f in enumerate(fields):
            c, kind = F.col(f"c{i}"), f.dataType
            text, number = isinstance(kind, StringType), isinstance(kind, NumericType)
            ordered = text or number or kind.typeName() in _ORDERED
            nothing = F.lit(None).cast("long")
            aggs += [F.count(c).alias(f"nn{i}"), *([F.min(c).cast("string").alias(f"mn{i}"), F.max(c).cast("string").alias(f"mx{i}")] if ordered else [])]
            if sketches:
                aggs += [F.hll_sketch_agg(c.cast("string") if ordered else F.to_json(F.struct(c)), F.lit(12)).alias(f"d{i}")]
                aggs += [F.kll_sketch_agg_double(c.cast("double")).alias(f"q{i}")] if number else []
            if text and names:
                own = with_spans(own, f"c{i}", f"f{i}", names, I.LIKELIHOODS[min(thr, hi_thr)])
                aggs += [F.count_if(F.exists(f"f{i}", lambda x: F.element_at(is_high, x["no"]) & (x["rank"] >= hi_thr))).alias(f"h{i}"),
                         F.count_if(F.exists(f"f{i}", lambda x: ~F.element_at(is_high, x["no"]) & (x["rank"] >= thr))).alias(f"o{i}")]
            found = (F.col(f"h{i}"), F.col(f"o{i}")) if text and names else (F.lit(0).cast("long") if text else nothing,) * 2
            rows.append(F.struct(F.lit(table).alias("table_name"), F.lit(f.name).alias("column_name"), F.lit(kind.simpleString()).alias("data_type"), F.lit(text).alias("is_text"),
                                 F.col("n").alias("n_rows"), (F.col("n") - F.col(f"nn{i}")).alias("n_nulls"),
                                 *[(F.col(f"{m}{i}") if ordered else F.lit(None).cast("string")).alias(v) for m, v in (("mn", "min_value"), ("mx", "max_value"))],
                                 found[0].alias("n_high_findings"), found[1].alias("n_other_findings"),
                                 (F.col(f"d{i}") if sketches else F.lit(None).cast("binary")).alias("distinct_sketch"),
                                 (F.col(f"q{i}") if sketches and number else F.lit(None).cast("binary")).alias("quantile_sketch")))
        part = own.agg(*aggs).select(F.inline(F.array(*rows)))
        out = part if out is None else out.unionByName(part)
    return out


def merge_profiles(parts: DataFrame) -> DataFrame:
    """Stored parts of the same tables, however many runs or slices they came from,
    as one row per (table, column): counts added, bounds and sketches merged.  No
    table is read again.  A column whose type changed has a row for each type."""
    # numbers are compared as numbers, all else as text (dates and times are written in order)
    number = ~F.col("data_type").isin("string", *_ORDERED)

    def place(v: str) -> Column:
        return F.struct(F.when(number, F.expr(f"try_cast({v} AS DOUBLE)")).alias("rough"), F.when(number, F.expr(f"try_cast({v} AS DECIMAL(38, 9))")).alias("exact"), F.col(v))

    return parts.groupBy("table_name", "column_name", "data_type", "is_text").agg(
        *[F.sum(c).alias(c) for c in ("n_rows", "n_nulls")],
        F.min_by("min_value", F.when(F.col("min_value").isNotNull(), place("min_value"))).alias("min_value"),
        F.max_by("max_value", F.when(F.col("max_value").isNotNull(), place("max_value"))).alias("max_value"),
        *[F.sum(c).alias(c) for c in ("n_high_findings", "n_other_findings")],
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"), F.when(F.count("quantile_sketch") > 0, F.kll_merge_agg_double("quantile_sketch")).alias("quantile_sketch"))


def profile_report(parts: DataFrame) -> DataFrame:
    """A merged profile to read: the sketches as an approximate number of distinct
    values and, for numbers, the approximate median."""
    median = F.when(F.col("quantile_sketch").isNotNull() & (F.col("n_rows") > F.col("n_nulls")), F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(0.5)))
    return parts.select("table_name", "column_name", "data_type", "n_rows", "n_nulls", F.hll_sketch_estimate("distinct_sketch").alias("approx_distinct"),
                        "min_value", "max_value", "is_text", "n_high_findings", "n_other_findings", median.alias("approx_median"))


def profile_tables(tables: Mapping[str, DataFrame], types: Iterable[str] | None = None,
                   min_likelihood: str = "POSSIBLE", distinct: bool = True) -> DataFrame:
    """X10 over several tables: ``profile_parts`` to read, without the median."""
    parts = profile_parts(tables, types, min_likelihood, distinct)
    if not distinct:
        return parts.select("table_name", "column_name", "data_type", "n_rows", "n_nulls", F.lit(None).cast("long").alias("approx_distinct"),
                            "min_value", "max_value", "is_text", "n_high_findings", "n_other_findings")
    return profile_report(parts).drop("approx_median")


def profile(df: DataFrame, table: str, types: Iterable[str] | None = None,
            min_likelihood: str = "POSSIBLE", distinct: bool = True) -> DataFrame:
    """X10 for one table (see ``profile_tables``)."""
    return profile_tables({table: df}, types, min_likelihood, distinct)


def classify(profiles: DataFrame) -> DataFrame:
    """X11: sensitivity per column: HIGH (a credential, bank/card or
    national-ID finding at LIKELY or above), MODERATE (any other finding),
    LOW (scanned text, no finding), UNKNOWN (not text, or no value)."""
    level = (F.when(~F.col("is_text") | (F.col("n_rows") == F.col("n_nulls")), F.lit("UNKNOWN"))
              .when(F.col("n_high_findings") > 0, F.lit("HIGH"))
              .when(F.col("n_other_findings") > 0, F.lit("MODERATE"))
              .otherwise(F.lit("LOW")))
    return profiles.withColumn("sensitivity", level)


def table_sensitivity(classified: DataFrame) -> DataFrame:
    """X11 per table: the highest column level."""
    order = F.when(F.col("sensitivity") == "HIGH", 3).when(F.col("sensitivity") == "MODERATE", 2) \
             .when(F.col("sensitivity") == "LOW", 1).otherwise(0)
    g = classified.groupBy("table_name").agg(F.max(order).alias("_lvl"))
    return g.select("table_name", F.element_at(F.array(*[F.lit(x) for x in
                                                         ("UNKNOWN", "LOW", "MODERATE", "HIGH")]),
                                               F.col("_lvl") + 1).alias("sensitivity"))


def visible_assets(assets: DataFrame, tags: DataFrame, grants: DataFrame, asset_key: str = "asset") -> DataFrame:
    """A principal sees an asset when the asset carries a tag value the
    principal is granted.  Two equi-joins: grants x tags on (key, value),
    then the assets.  ``tags``: (asset, tag_key, tag_value); ``grants``:
    (principal, tag_key, tag_value)."""
    pairs = tags.join(grants, ["tag_key", "tag_value"]).select("principal", asset_key).distinct()
    return pairs.join(assets, asset_key)
