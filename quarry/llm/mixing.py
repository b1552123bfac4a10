"""Mixing sources to target weights by temperature.

The share of a source in the tokens, to the power of an exponent from 0 (all
sources equal) to 1 (as they are), normalised, is its weight.  The exponent is
bisected to meet a target entropy of the weights, or a limit on the
repetition of any source.  Several halvings are taken in one aggregation over
the table of sources.  The budget is the smallest that repeats every source
once or more (or a given number of tokens), so that a source's repetitions
are its whole epochs and a rest.

A source's documents are permuted in blocks: the order of its blocks, of the
parts of a block and of the documents of a part follows a seeded hash.  The
rest of a budget goes to the first documents in this order.  It is found from
sums by block, then by part of the one block where the budget ends, then by
document of the one part: no window holds more than BLOCKS rows or one part.
All of it is SQL functions.

Cases: a null source is a source.  A null or empty text has no tokens and
comes as often as its source's whole epochs.  Sources without any token are
taken once.  Rows that share a ``doc_id`` and source stay together.  An empty
table gives no rows.  Other columns pass through; ``epoch``,
``mix_block`` and ``mix_order`` replace columns of these names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import checkpointed, table, unused
from quarry.session import scratch_path

MAX_REPEAT = 2.0
BLOCKS = 1024
#: Tokens of one block of the mix, about.
MIX_BLOCK_TOKENS = 4_000_000
SEED = 20
#: Halvings in one aggregation, and aggregations.
HALVINGS, STEPS = 5, 6


def tokens(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")


def _measures(a: float) -> tuple[Column, Column]:
    """(entropy of the weights, largest over smallest repetition) at exponent ``a``."""
    power = F.sum(F.pow("share", F.lit(a)))
    entropy = F.ln(power) - F.lit(a) * F.sum(F.pow("share", F.lit(a)) * F.ln("share")) / power
    return entropy, F.pow(F.max("share") / F.min("share"), F.lit(1.0 - a))


def exponent(shares: DataFrame, target_entropy: float | None = None, max_repeat: float | None = MAX_REPEAT) -> float:
    """The smallest exponent with at most ``max_repeat``, or the largest with
    ``target_entropy`` at least.  ``shares`` (share) has no zeros.  Both
    measures fall as the exponent grows."""
    low, high = 0.0, 1.0
    for _ in range(STEPS):
        n = 1 << HALVINGS
        grid = [low + (high - low) * k / n for k in range(n + 1)]
        row = shares.agg(*(_measures(a)[target_entropy is None].alias(f"m{k}") for k, a in enumerate(grid))).first()
        if row["m0"] is None:
            return 1.0
        bound = max_repeat if target_entropy is None else target_entropy
        over = [k for k in range(n + 1) if row[f"m{k}"] > bound * (1 + 1e-12)]
        if not over:
            return low
        if over[-1] == n:
            return high
        low, high = grid[over[-1]], grid[over[-1] + 1]
    return high if target_entropy is None else low


def budgets(docs: DataFrame, group: str = "source", target_entropy: float | None = None, max_repeat: float | None = MAX_REPEAT,
            total_tokens: int | None = None) -> DataFrame:
    """(group, tokens, weight, repeat) of every source.  ``docs`` has tokens."""
    sums = checkpointed(docs.groupBy(group).agg(F.sum("tokens").alias("tokens")))
    total = sums.agg(F.sum("tokens").alias("n")).first()["n"] or 0
    some = sums.filter("tokens > 0").withColumn("share", F.col("tokens") / F.lit(float(max(total, 1))))
    a = exponent(some, target_entropy, max_repeat)
    norm = some.agg(F.sum(F.pow("share", F.lit(a))).alias("s"), F.max(F.pow("share", F.lit(1 - a))).alias("m")).first()
    # repeat = budget * weight / tokens; the largest share has the smallest repetition
    budget = float(total_tokens) if total_tokens else total * (norm["s"] or 1.0) * (norm["m"] or 1.0)
    share = F.col("tokens") / F.lit(float(max(total, 1)))
    weight = F.when(F.col("tokens") > 0, F.pow(share, F.lit(a)) / F.lit(norm["s"] or 1.0)).otherwise(0.0)
    return sums.withColumn("weight", weight).withColumn(
        "repeat", F.when(F.col("tokens") > 0, F.lit(budget) * F.col("weight") / F.col("tokens")).otherwise(1.0))


def _order(seed: int) -> list[Column]:
    """Hashes that order a source's documents: by block, part and document."""
    own = F.xxhash64(F.lit(seed), F.col("doc_id"))
    block = F.pmod(own, F.lit(BLOCKS))
    part = F.pmod(F.shiftright(own, 20), F.lit(BLOCKS))
    return [F.xxhash64(F.lit(seed + 1), block), F.xxhash64(F.lit(seed + 2), block, part), own]


def cuts(docs: DataFrame, plan: DataFrame, group: str) -> DataFrame:
    """(group, whole, c0, c1, c2) of every source: its whole epochs, and the
    order where the rest of its budget ends (documents before it are in)."""
    whole = F.floor(F.col("repeat") + 1e-9).cast("int")
    plan = plan.select(F.col(group).alias("g"), whole.alias("whole"), F.greatest(F.lit(0.0), (F.col("repeat") - whole) * F.col("tokens")).alias("rest"))
    keys = docs.select(F.col(group).alias("g"), "tokens", *(k.alias(f"k{i}") for i, k in enumerate(_order(SEED))))
    out, inside = plan, keys
    for i in range(3):
        sums = inside.groupBy("g", f"k{i}").agg(F.sum("tokens").alias("n"))
        w = Window.partitionBy("g").orderBy(f"k{i}")
        run = checkpointed(sums).withColumn("upto", F.sum("n").over(w))
        left = out.select(F.col("g").alias("h"), "rest")
        met = run.join(left, run["g"].eqNullSafe(left["h"])).drop("h").filter(F.col("upto") > F.col("rest") + 1e-9)
        first = checkpointed(met.groupBy("g").agg(F.min(F.struct(f"k{i}", "upto", "n")).alias("x"))
                             .select(F.col("g").alias("h"), F.col(f"x.k{i}").alias(f"c{i}"), (F.col("x.upto") - F.col("x.n")).alias("before")))
        out = checkpointed(out.join(first, out["g"].eqNullSafe(first["h"]), "left").drop("h")
                           .withColumn("rest", F.col("rest") - F.coalesce("before", F.lit(0))).drop("before"))
        ends = first.select("h", f"c{i}")
        inside = inside.join(ends, inside["g"].eqNullSafe(ends["h"]) & (inside[f"k{i}"] == ends[f"c{i}"]), "left_semi")
    return out.drop("rest")


def mix(docs: DataFrame, group: str = "source", target_entropy: float | None = None, max_repeat: float | None = MAX_REPEAT,
        total_tokens: int | None = None) -> DataFrame:
    """``docs`` with each row as often as its source's budget has it, and
    ``epoch``, ``mix_block`` (blocks in the order of the mix), ``mix_order``
    (order in the block)."""
    spark = docs.sparkSession
    own = [c for c in docs.columns if c not in ("epoch", "mix_block", "mix_order")]
    docs = docs.select(*own)
    light = checkpointed(docs.select(F.col(group).alias("source"), F.col("doc_id").cast("long").alias("doc_id"), tokens(F.col("text")).alias("tokens")))
    plan = checkpointed(budgets(light, "source", target_entropy, max_repeat, total_tokens))
    path = scratch_path(spark, "mixing")
    # a written table has a known size, by which Spark chooses how to join it
    g, whole, copies_, *cut = [unused(c, docs) for c in ("__g", "__whole", "__copies", "__c0", "__c1", "__c2")]
    cuts(light, plan, "source").toDF(g, whole, *cut).write.parquet(path)
    ends = spark.read.parquet(path)
    n = (plan.agg(F.sum(F.col("repeat") * F.col("tokens")).alias("n")).first()["n"] or 0) // MIX_BLOCK_TOKENS + 1
    k = _order(SEED)
    copies = F.col(whole) + F.when(F.col(cut[0]).isNotNull() & F.coalesce(_less(k, cut), F.lit(False)), 1).otherwise(0)
    joined = docs.join(ends, docs[group].eqNullSafe(ends[g])).withColumn(copies_, copies)
    spread = joined.filter(F.col(copies_) > 0).select(*(docs[c] for c in own), F.explode(F.sequence(F.lit(0), F.col(copies_) - 1)).alias("epoch"))
    at = F.xxhash64(F.lit(SEED + 3), F.col("epoch"), F.col("doc_id").cast("long"))
    return spread.withColumn("mix_block", F.pmod(at, F.lit(int(n)))).withColumn("mix_order", F.xxhash64(F.lit(SEED + 4), at))


def _less(keys: list[Column], ends: list[str]) -> Column:
    """Keys before the ends, in the order of the first that differ; a null end has none after it."""
    out = F.lit(False)
    for k, e in reversed(list(zip(keys, ends))):
        out = (k < F.col(e)) | ((k == F.col(e)) & out)
    return out


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("text")
