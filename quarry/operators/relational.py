"""Projections, filters, joins, aggregates, windows, sort/limit and unions.

Everything here is plain DataFrame API so Catalyst can push filters into the
Parquet scan, prune columns, pick the join strategy from statistics and let
AQE re-plan at runtime.  The few places where the naive form would funnel a
heavy key into one task use a two-step form instead (noted per function).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


# --------------------------------------------------------------------------
# P: projections and predicates
# --------------------------------------------------------------------------


def project(df: DataFrame, cols: Mapping[str, str | Column] | Sequence[str]) -> DataFrame:
    """Select with aliases.  ``{"out": "in"}`` or a list of names."""
    if isinstance(cols, Mapping):
        return df.select(
            *[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in cols.items()]
        )
    return df.select(*cols)


def project_side(df: DataFrame, side: str, *extra: str | Column) -> DataFrame:
    """``extra..., side.*`` on an aliased join result."""
    return df.select(*extra, f"{side}.*")


def where_eq(df: DataFrame, col: str, value) -> DataFrame:
    """Equality on string, integer, date or double (exact compare)."""
    return df.filter(F.col(col) == F.lit(value))


def where_not_in(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    """``NOT IN``; a NULL input yields NULL and drops the row."""
    return df.filter(~F.col(col).isin(list(values)))


def where_null(df: DataFrame, col: str, is_null: bool = True) -> DataFrame:
    """P7."""
    c = F.col(col)
    return df.filter(c.isNull() if is_null else c.isNotNull())


def where_range(df: DataFrame, col: str, low, high) -> DataFrame:
    """Open range ``low < col < high`` (sentinel removal)."""
    c = F.col(col)
    return df.filter((c > F.lit(low)) & (c < F.lit(high)))


def where_like(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """P10: SQL LIKE; Catalyst turns ``x%`` / ``%x%`` into StartsWith/Contains."""
    return df.filter(F.col(col).like(pattern))


def label_predicate(eq: Mapping[str, object] | None = None,
                    has: Mapping[str, str] | None = None) -> Column:
    """Conjunction of label equalities and case-insensitive ``has``."""
    cond = F.lit(True)
    for k, v in (eq or {}).items():
        cond = cond & (F.col(k) == F.lit(v))
    for k, v in (has or {}).items():
        cond = cond & F.lower(F.col(k).cast("string")).contains(str(v).lower())
    return cond


def label_filter(df: DataFrame, eq: Mapping[str, object] | None = None,
                 has: Mapping[str, str] | None = None) -> DataFrame:
    return df.filter(label_predicate(eq, has))


# --------------------------------------------------------------------------
# J: joins
# --------------------------------------------------------------------------


def _on(a: DataFrame, b: DataFrame, on) -> Column | list[str]:
    """``on`` may be a list of shared names or a dict left -> right."""
    if isinstance(on, Mapping):
        cond = None
        for lk, rk in on.items():
            c = a[lk] == b[rk]
            cond = c if cond is None else cond & c
        return cond
    return _cols(on)


def join_inner(a: DataFrame, b: DataFrame, on) -> DataFrame:
    """Inner equi-join.  Many-to-many fan-out is kept; AQE splits skew."""
    return a.join(b, _on(a, b, on), "inner")


def join_left(a: DataFrame, b: DataFrame, on) -> DataFrame:
    """J2."""
    return a.join(b, _on(a, b, on), "left")


def left_only(a: DataFrame, b: DataFrame, on, right_cols: Mapping[str, str] | None = None) -> DataFrame:
    """Left rows without a partner, as a left-anti join (no fan-out, no
    right payload shuffled).  ``right_cols`` adds right columns as typed NULLs,
    which is what ``LEFT JOIN ... WHERE r.key IS NULL`` returns."""
    out = a.join(b, _on(a, b, on), "left_anti")
    for name, dtype in (right_cols or {}).items():
        out = out.withColumn(name, F.lit(None).cast(dtype))
    return out


def right_only(a: DataFrame, b: DataFrame, on) -> DataFrame:
    """Right rows without a partner on the left (swapped anti join)."""
    if isinstance(on, Mapping):
        on = {v: k for k, v in on.items()}
    return left_only(b, a, on)


def reconcile(a: DataFrame, b: DataFrame, a_key: str, b_key: str) -> DataFrame:
    """Keys present on exactly one side (full outer join + NULL test).

    Only the two key columns are projected before the join, so the shuffle
    carries keys and nothing else."""
    ka = a.select(F.col(a_key).alias("_a"))
    kb = b.select(F.col(b_key).alias("_b"))
    j = ka.join(kb, F.col("_a") == F.col("_b"), "full")
    return j.filter(F.col("_a").isNull() | F.col("_b").isNull()).select(
        F.col("_a").alias(a_key), F.col("_b").alias(b_key))


def cross_param(df: DataFrame, params: DataFrame) -> DataFrame:
    """Attach the columns of a one-row parameter table to every row.

    Written as one scalar subquery rather than a cross join: Spark evaluates
    it once and fails if the parameter table has more than one row, so the
    size bound is enforced, not assumed.  A parameter table without a row
    gives no rows."""
    row = params.select(F.struct(*params.columns).alias("p")).scalar()
    out = df.withColumn("_params", row).filter(F.col("_params").isNotNull())
    return out.select(*df.columns, *(F.col("_params")[c].alias(c) for c in params.columns))


def unnest(df: DataFrame, array_col: str, alias: str, keep: Sequence[str] | None = None) -> DataFrame:
    """Lateral unnest; empty or NULL arrays drop the row (comma join)."""
    keep = list(keep) if keep is not None else [c for c in df.columns]
    return df.select(*keep, F.explode(F.col(array_col)).alias(alias))


def unnest_chain(df: DataFrame, outer: str, outer_alias: str, inner_field: str,
                 inner_alias: str, keep: Sequence[str] = ()) -> DataFrame:
    """Unnest an array of structs, then an array inside each struct."""
    step = df.select(*keep, F.explode(F.col(outer)).alias(outer_alias))
    return step.select(*keep, outer_alias,
                       F.explode(F.col(f"{outer_alias}.{inner_field}")).alias(inner_alias))


def lookup_one(df: DataFrame, dim: DataFrame, key: str, dim_key: str, value: str,
               out: str) -> DataFrame:
    """Correlated scalar lookup, any one match (``min`` for
    repeatability), NULL when none.  The dimension is reduced to one row per
    key first (partial aggregation), so the join never fans out."""
    one = dim.groupBy(F.col(dim_key).alias("_lk")).agg(F.min(value).alias(out))
    return df.join(one, df[key] == one["_lk"], "left").drop("_lk")


def anti_by_keys(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """NOT EXISTS on a key pair; NULL keys never match."""
    return df.join(other.select(*keys), list(keys), "left_anti")


def join_on_expr(a: DataFrame, b: DataFrame, pairs: Sequence[tuple[Column, Column]],
                 how: str = "inner") -> DataFrame:
    """Equi-join on expressions (trimmed keys, (name, date) pairs).
    Still a hash-partitioned equi-join: each side computes its key once."""
    cond = None
    for l, r in pairs:
        c = l == r
        cond = c if cond is None else cond & c
    return a.join(b, cond, how)


def key_audit(df: DataFrame, key: str, val: str, n: int = 5,
              count_name: str = "n_values", list_name: str = "values") -> DataFrame:
    """J15 (with A3, A4, A5): keys mapping to more than one distinct value.

    Returns key, exact distinct count and the ``n`` smallest distinct values
    joined by ``,``.  Scale: (key, val) is deduplicated first with the
    shuffle keyed on both columns, so a heavy key is spread over many tasks;
    the top-n cut runs as a WindowGroupLimit *before* its shuffle, so at most
    n rows per key per map task move."""
    pairs = df.select(key, val).filter(F.col(val).isNotNull()).distinct()
    counts = pairs.groupBy(key).agg(F.count(F.lit(1)).alias(count_name)).filter(
        F.col(count_name) > 1)
    firsts = string_agg_distinct(pairs, key, val, n, list_name, deduped=True)
    return counts.join(firsts, key, "inner")


# --------------------------------------------------------------------------
# A: aggregates
# --------------------------------------------------------------------------


def distinct(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A1/A2: SELECT DISTINCT / GROUP BY without aggregates."""
    return (df.select(*cols) if cols else df).distinct()


def count_distinct(df: DataFrame, keys: Sequence[str], col: str, name: str) -> DataFrame:
    """A3: exact COUNT(DISTINCT); Catalyst shuffles on (keys, col) first."""
    return df.groupBy(*keys).agg(F.count_distinct(col).alias(name))


def string_agg_distinct(df: DataFrame, key: str, val: str, n: int, name: str,
                        sep: str = ",", deduped: bool = False) -> DataFrame:
    """A4: STRING_AGG(DISTINCT val LIMIT n) with a fixed order (the n
    smallest values, ascending).  Distinct first, rank second: the rank
    filter becomes a WindowGroupLimit that cuts every map task to n rows per
    key before the window shuffle, so heavy keys stay cheap."""
    pairs = df.select(key, val)
    if not deduped:
        pairs = pairs.distinct()
    w = Window.partitionBy(key).orderBy(F.col(val).asc_nulls_last())
    top = pairs.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
    text = F.array_join(F.array_sort(F.collect_list(val)), sep)
    # a group with only NULLs stays, with NULL
    return top.groupBy(key).agg(F.when(F.count(val) > 0, text).alias(name))


def having(df: DataFrame, cond: Column) -> DataFrame:
    """A5: filter on aggregated aliases."""
    return df.filter(cond)


def sum_by(df: DataFrame, keys: Sequence[str], col: str, name: str,
           dedupe: Sequence[str] | None = None) -> DataFrame:
    """SUM by keys, optionally over a deduplicated projection."""
    src = df.select(*dedupe).distinct() if dedupe else df
    return src.groupBy(*keys).agg(F.sum(col).alias(name))


def avg_by(df: DataFrame, keys: Sequence[str], cols: Mapping[str, str]) -> DataFrame:
    """Several AVGs by keys; ``{"out": "in"}``.  Partial aggregation
    happens map-side, so a heavy key moves one partial row per task."""
    return df.groupBy(*keys).agg(*[F.avg(v).alias(k) for k, v in cols.items()])


def array_agg(df: DataFrame, keys: Sequence[str], col: str | Column, name: str,
              distinct: bool = False, sort: bool = True) -> DataFrame:
    """ARRAY_AGG (NULLs dropped; NULL for a group with only NULLs).  The result row holds the whole
    group, so use it where the group is bounded (order lines, products of a
    visit).  With ``distinct`` the (keys, value) pairs are deduplicated by a
    shuffle on both before collecting, so only distinct values are held."""
    c = F.col(col) if isinstance(col, str) else col
    src = df.select(*keys, c.alias("_v"))
    if distinct:
        src = src.distinct()
    agg = F.collect_list("_v")
    return src.groupBy(*keys).agg(F.when(F.count("_v") > 0, F.array_sort(agg) if sort else agg).alias(name))


def pick_one(df: DataFrame, keys: Sequence[str], col: str, name: str) -> DataFrame:
    """ARRAY_AGG(DISTINCT x LIMIT 1) with a fixed choice: ``[min(x)]``
    (NULL for a group with only NULLs)."""
    return df.groupBy(*keys).agg(F.when(F.count(col) > 0, F.array(F.min(col))).alias(name))


def array_size_agg(df: DataFrame, keys: Sequence[str], col: str, name: str,
                   distinct: bool = False) -> DataFrame:
    """ARRAY_LENGTH(ARRAY_AGG(x)) planned as a count, never an array."""
    agg = F.count_distinct(col) if distinct else F.count(col)
    return df.groupBy(*keys).agg(agg.alias(name))


def any_value(df: DataFrame, keys: Sequence[str], col: str, name: str) -> DataFrame:
    """ANY_VALUE, made repeatable as ``min``."""
    return df.groupBy(*keys).agg(F.min(col).alias(name))


def count_nonnull(df: DataFrame, col: str, name: str, keys: Sequence[str] = ()) -> DataFrame:
    """COUNT(expr) counts non-NULL values only."""
    return df.groupBy(*keys).agg(F.count(col).alias(name))


def share_of_total(df: DataFrame, col: str, count_name: str = "n",
                   share_name: str = "share") -> DataFrame:
    """Category counts and each one's share of all rows.

    The total is a scalar subquery over a partially aggregated count, not a
    window over an empty partition spec (which would pull every category
    row into a single task)."""
    total = df.agg(F.count(F.lit(1)).alias("_t"))
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias(count_name))
    return counts.withColumn(share_name, F.col(count_name) / total.select("_t").scalar())


# --------------------------------------------------------------------------
# W / O / U: windows, sort, limit, union
# --------------------------------------------------------------------------


def row_number_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                  name: str = "rn") -> DataFrame:
    """ROW_NUMBER per partition."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
                    name: str = "rn") -> DataFrame:
    """Rank <= n per group.  Callers pass a unique tie key last in
    ``order`` so the cut is deterministic.  Catalyst plants a partial
    WindowGroupLimit below the shuffle: each task forwards <= n rows per
    group, which is what keeps a heavy group from swamping one reducer."""
    return row_number_by(df, keys, order, name).filter(F.col(name) <= n)


def sort(df: DataFrame, *order: Column | str) -> DataFrame:
    """O1: global ORDER BY (range-partitioned sort)."""
    return df.orderBy(*order)


def limit(df: DataFrame, n: int) -> DataFrame:
    """O2: unordered LIMIT (the feature itself: a sample of n rows)."""
    return df.limit(n)


def top_k(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """O3: ORDER BY + LIMIT -> TakeOrderedAndProject (per-task top-k heaps)."""
    return df.orderBy(*order).limit(n)


def union_all(*dfs: DataFrame, order: Sequence[Column | str] | None = None) -> DataFrame:
    """UNION ALL by name, then one ORDER BY over the whole result."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out.orderBy(*order) if order else out
