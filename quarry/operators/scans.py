"""Scans along an order without a sort of a whole key: running sums, running
maxima and ranks for keys that may hold most of the rows.

``prefix_scan`` orders rows only within (key, block of the order): a block of
2^BITS consecutive order values.  One row a block carries on what came before it;
those rows are scanned the same way over blocks of blocks.  ``distributed_rank``
takes its blocks from a range partition, so they hold about as many rows each
whatever the values are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import scratch_path

BITS = 16
#: Order values from -2^31 on: seconds from 1901 to 2038 + 2^31, and all indices of periods.
OFFSET = 1 << 31


def same(a: DataFrame, b: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda x, y: x & y, [a[x].eqNullSafe(b[y]) for x, y in pairs])


def _scan(df: DataFrame, keys: Sequence[str], order: str, value: Column, how: str, out: str, inclusive: bool, levels: int) -> DataFrame:
    agg = {"sum": F.sum, "max": F.max}[how]
    block = f"_{out}_block"
    own = df.withColumn(block, F.shiftright(order, BITS)).withColumn(f"_{out}_value", value)
    within = Window.partitionBy(*keys, block).orderBy(order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    own = own.withColumn(out, agg(f"_{out}_value").over(within))
    if levels > 1:
        blocks = own.groupBy(*keys, block).agg(agg(f"_{out}_value").alias("_block_value"))
        carried = _scan(blocks, keys, block, F.col("_block_value"), how, f"{out}_", False, levels - 1)
        names = [f"_{out}_key{i}" for i in range(len(keys))]
        carried = carried.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(block).alias(f"_{out}_of"), F.col(f"{out}_").alias(f"_{out}_before"))
        own = own.join(carried, same(own, carried, [*zip(keys, names), (block, f"_{out}_of")]), "left")
        both = F.coalesce(F.col(out) + F.col(f"_{out}_before"), out, f"_{out}_before") if how == "sum" else F.greatest(out, f"_{out}_before")
        own = own.withColumn(out, both).drop(*names, f"_{out}_of", f"_{out}_before")
    return own.drop(block, f"_{out}_value")


def prefix_scan(df: DataFrame, keys: Sequence[str], order: str, value: Column, how: str, out: str, inclusive: bool = True) -> DataFrame:
    """``df`` with ``out``: the sum or maximum (``how``) of ``value`` over the rows of
    the same keys up to this one in the order of ``order``, a long from -2^31 to
    2^32 - 2^31 (without this row itself, unless ``inclusive``).  NULL where there is none."""
    at = f"_{out}_at"
    placed = df.withColumn(at, F.col(order).cast("long") + OFFSET)
    return _scan(placed, list(keys), at, value, how, out, inclusive, 2).drop(at)


def distributed_rank(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str = "rn", partitions: int | None = None) -> DataFrame:
    """W1 for keys of any size: ``df`` with ``out``, the row number within its keys.

    Rows are ranged by (keys, order), so a key that holds many rows spans many
    partitions and none is sorted in one task; row numbers are counted within
    (partition, key), and each partition adds how many rows of the key stand in
    the partitions before it: one row a (partition, key).  The ranged rows are
    written to the shared folder, since both uses must see the same partitions."""
    spark = df.sparkSession
    by = [*[F.col(k).asc_nulls_first() for k in keys], *order]
    ranged = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    placed = ranged.sortWithinPartitions(*by).select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_place"))
    path = scratch_path(spark, "rank")
    placed.write.parquet(path)
    rows = spark.read.schema(placed.schema).parquet(path)
    # the places of a (partition, key) follow one another, so its first place gives every row's number
    counts = rows.groupBy("_part", *keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    # of a key's partitions only the first and the last may hold other keys
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    names = [f"_key{i}" for i in range(len(keys))]
    offsets = counts.withColumn("_before", before).select(F.col("_part").alias("_p"), *[F.col(k).alias(n) for k, n in zip(keys, names)], "_first", "_before")
    joined = rows.join(offsets, same(rows, offsets, [("_part", "_p"), *zip(keys, names)]))
    return joined.select(*[rows[c] for c in df.columns], (F.col("_place") - F.col("_first") + F.col("_before") + 1).cast("int").alias(out))
