"""Governance, quality and finding rules (Q1-Q5, Q7-Q9).

Quality scans are one aggregation pass; finding rules are joins against
small rule tables whose size is checked before they are broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.scalar import policy_members

PROTECTED_KEY = "aspect"


# --------------------------------------------------------------------------
# Q1-Q3: quality
# --------------------------------------------------------------------------


def dq_scan(df: DataFrame, rules: Sequence[Mapping]) -> DataFrame:
    """Q1: non-null expectations ``{"column", "dimension", "threshold"}``.
    One pass computes ``count(*)`` and ``count(col)`` for every rule; the
    result has one row per rule.  An empty table passes with ratio 1."""
    aggs = [F.count(F.lit(1)).alias("_rows")] + [
        F.count(F.col(r["column"])).alias(f"_nn{i}") for i, r in enumerate(rules)]
    one = df.agg(*aggs)
    rows = []
    for i, r in enumerate(rules):
        ratio = F.when(F.col("_rows") == 0, F.lit(1.0)).otherwise(F.col(f"_nn{i}") / F.col("_rows"))
        rows.append(F.struct(F.lit(r["column"]).alias("column_name"),
                             F.lit(r.get("dimension", "COMPLETENESS")).alias("dimension"),
                             F.lit(float(r.get("threshold", 1.0))).alias("threshold"),
                             F.col("_rows").alias("n_rows"), F.col(f"_nn{i}").alias("n_passed"),
                             ratio.alias("pass_ratio"),
                             (ratio >= F.lit(float(r.get("threshold", 1.0)))).alias("passed")))
    return one.select(F.inline(F.array(*rows)))


def missing_keys(df: DataFrame, key: str, attrs: Sequence[str], order: bool = True) -> DataFrame:
    """Q3: per attribute, the distinct keys whose attribute is NULL
    (``missing`` names the attribute); a key missing several attributes is
    listed once per attribute."""
    parts = [df.filter(F.col(a).isNull()).select(key, F.lit(a).alias("missing")).distinct() for a in attrs]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy(key, "missing") if order else out


# --------------------------------------------------------------------------
# Q4-Q5: column aspects
# --------------------------------------------------------------------------


def tag_columns(df: DataFrame, cols: Iterable[str], tag: str = "protected", key: str = PROTECTED_KEY) -> DataFrame:
    """Q4: attach an enum-valued aspect to columns (schema metadata)."""
    cols = set(cols)
    out = df
    for c in df.columns:
        if c in cols:
            meta = dict(df.schema[c].metadata or {})
            meta[key] = tag
            out = out.withMetadata(c, meta)
    return out


def column_tags(df: DataFrame, key: str = PROTECTED_KEY) -> dict[str, str]:
    return {f.name: f.metadata[key] for f in df.schema.fields if f.metadata and key in f.metadata}


def project_unprotected(df: DataFrame, mode: str = "drop", tag: str = "protected",
                        key: str = PROTECTED_KEY, value: str = "[redacted]") -> DataFrame:
    """Q5: drop (or redact) the columns tagged ``tag``; the decision reads
    only the schema, so the scan never reads a dropped column."""
    tags = column_tags(df, key)
    prot = {c for c, v in tags.items() if v == tag}
    if mode == "drop":
        return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in prot])
    return df.select(*[F.lit(value).alias(c) if c in prot else F.col(f"`{c}`") for c in df.columns])


# --------------------------------------------------------------------------
# Q7-Q9: finding rules and policies
# --------------------------------------------------------------------------


def mute(findings: DataFrame, rules: DataFrame, category: str = "category") -> DataFrame:
    """Q7: static mute rules ``(category)``: findings of a listed category
    are flagged ``muted``.  The rule table is a checked-size broadcast."""
    r = rules.select(F.col(category).alias("_mute_cat")).distinct().withColumn("_m", F.lit(True))
    j = findings.join(r, F.col(category) == F.col("_mute_cat"), "left")
    return j.withColumn("muted", F.coalesce(F.col("_m"), F.lit(False))).drop("_mute_cat", "_m")


def severity_gate(findings: DataFrame, level: str = "CRITICAL", by: Sequence[str] = ("image",),
                  severity: str = "severity") -> DataFrame:
    """Q8: per ``by`` group, fail when any finding's severity equals
    ``level`` exactly (``CRITICAL-ish`` does not count)."""
    return findings.groupBy(*by).agg(
        F.bool_or(F.coalesce(F.col(severity) == F.lit(level), F.lit(False))).alias("failed"),
        F.count(F.lit(1)).alias("n_findings"))


def policy_bindings(policies: DataFrame, id_col: str = "policy_id", doc: str = "policy") -> DataFrame:
    """F12 over a table of policy documents: ``(id, role, member)``."""
    return policies.select(id_col, F.inline(policy_members(doc)))


def has_binding(policies: DataFrame, wanted: DataFrame, id_col: str = "policy_id", doc: str = "policy") -> DataFrame:
    """Q9: the ``(policy, role, member)`` bindings that match a wanted
    ``(role, member)`` pair (left-semi join; a policy without the member
    yields no row)."""
    b = policy_bindings(policies, id_col, doc)
    w = wanted.select("role", "member").distinct()
    return b.join(w, ["role", "member"], "left_semi")
