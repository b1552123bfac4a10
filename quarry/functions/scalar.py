"""Scalar functions (F1-F12) as native Column expressions.

All of them compile into whole-stage codegen; none leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_date(c, fmt: str = "yyyyMMdd", strict: bool = False) -> Column:
    """PARSE_DATE('%Y%m%d', c).  ``strict`` raises on bad input (ANSI);
    the default returns NULL for it."""
    return F.to_date(_c(c), fmt) if strict else F.try_to_date(_c(c), fmt)


def date_from_parts(y, m, d, strict: bool = False) -> Column:
    """DATE(y, m, d).  ``strict`` raises on an impossible date (ANSI);
    the default gives NULL for it and for NULL parts."""
    if strict:
        return F.make_date(_c(y), _c(m), _c(d))
    parts = F.concat_ws("-", _c(y).cast("string"), _c(m).cast("string"), _c(d).cast("string"))
    return F.try_to_date(parts, "y-M-d")


def to_int64(c, strict: bool = False) -> Column:
    """CAST(c AS INT64); ``try_cast`` unless ``strict``."""
    return _c(c).cast("bigint") if strict else _c(c).try_cast("bigint")


def date_lit(s: str) -> Column:
    """a DATE literal for comparisons (folds to a constant, so it is
    usable as a partition filter)."""
    return F.to_date(F.lit(s))


def trim(c) -> Column:
    """F5."""
    return F.trim(_c(c))


def concat_any(*cols) -> Column:
    """CONCAT of mixed types; each argument is cast to string, a NULL
    argument makes the result NULL."""
    return F.concat(*[_c(c).cast("string") for c in cols])


def array_lit(*values) -> Column:
    """F7."""
    return F.array(*[F.lit(v) for v in values])


def array_length(c) -> Column:
    """F8: ARRAY_LENGTH (NULL for a NULL array)."""
    return F.when(_c(c).isNull(), F.lit(None).cast("int")).otherwise(F.size(_c(c)))


def like(c, pattern: str) -> Column:
    """F9."""
    return _c(c).like(pattern)


def field(c, path: str) -> Column:
    """struct field access along a dotted path."""
    out = _c(c)
    for p in path.split("."):
        out = out.getField(p)
    return out


def decode_message(c, default: str = "World", greeting: str = "Hello ") -> Column:
    """base64 payload -> text; an empty or NULL payload (or one that
    decodes to nothing) becomes ``default``; the result is a greeting."""
    text = F.try_to_binary(_c(c), F.lit("base64"))
    decoded = F.decode(text, "UTF-8")
    name = F.coalesce(F.nullif(decoded, F.lit("")), F.lit(default))
    return F.concat(F.lit(greeting), name, F.lit("!"))


POLICY_SCHEMA = StructType([
    StructField("bindings", ArrayType(StructType([
        StructField("role", StringType()),
        StructField("members", ArrayType(StringType())),
    ]))),
])


def policy_members(doc) -> Column:
    """policy JSON -> array of (role, member) structs (flattened with
    ``inline``/``explode`` by the caller)."""
    parsed = F.from_json(_c(doc), POLICY_SCHEMA)
    return F.flatten(F.transform(
        parsed.getField("bindings"),
        lambda b: F.transform(b.getField("members"),
                              lambda m: F.struct(b.getField("role").alias("role"), m.alias("member")))))
