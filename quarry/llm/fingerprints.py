"""Document fingerprints by SpotSigs.

Words are runs of letters and digits, lower-cased.  A common word is an
anchor, and so that texts in any language have some, one word in RARE by its
hash is one too; with the next CHAIN content words (those that are no anchors) it makes
a spot signature.  The set of a text's spots, in order and written as hex, is its
fingerprint; two are compared by the Jaccard similarity of their sets.  For all
pairs (``links``) sets are partitioned by length: two sets can only be as like as
the shorter is to the longer, so a set is compared with its own partition and the
next alone, within it only with sets that share one of its rarest spots, and of
those only where the lengths allow it.  All of it is SQL functions.  Anchors and
content words complement each other, so the words after the j-th anchor, at
place p, start at place p - j among the content words; no text is searched
twice.

The next document of a doc_id is that of the next smaller one; the smallest is
followed by the largest.  Ids are ranged, so no task sorts them all.

Cases: a null text is an empty one.  A text without a spot has one signature
made of all its words.  Rows that share a ``doc_id`` are fingerprinted one by
one and are not each other's next; as a next document they count as the one
with the smallest digest.  A null ``doc_id`` comes after all others.  A table
with one doc_id has it as its own next.  Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import checkpointed, table, text_or_empty
from quarry.llm.quality_rules import let

CHAIN = 2
#: Anchors, the common words of four languages.
ANCHORS = tuple("""the of and to in a is that it for was on are as with be by this from at or an but not
    der die und den von zu das mit sich des auf ist im dem nicht ein eine als auch es
    de la le et les un une que dans du en est pour qui au par sur pas ce il
    el y los se del las por con para no su al lo como""".split())
RARE = 5
THRESHOLD = 0.8


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def is_anchor(word: Column) -> Column:
    return word.isin(*ANCHORS) | (F.pmod(F.xxhash64(word), F.lit(RARE)) == 0)


def spots(text: Column) -> Column:
    """The sorted set of a text's spot signatures, as 32-bit hashes."""
    def chains(w):
        anchors = F.filter(F.transform(w, lambda x, i: F.when(is_anchor(x), i)), lambda i: i.isNotNull())
        content = F.filter(w, lambda x: ~is_anchor(x))

        def after(c):
            return F.transform(anchors, lambda p, j: F.when(p - j < F.size(c), F.hash(w[p], *(F.get(c, p - j + k) for k in range(CHAIN)))))

        found = F.array_sort(F.array_distinct(F.array_compact(let(content, after))))
        return let(found, lambda s: F.when(F.size(s) > 0, s).otherwise(F.array(F.hash(w))))

    return let(words(text), chains)


def fingerprint(spots_: Column) -> Column:
    """The set as text: eight hex digits a spot, in order."""
    return F.array_join(F.transform(spots_, lambda x: F.substring(F.hex(x.cast("long") + (1 << 32)), -8, 8)), "")


def likeness(a: Column, b: Column) -> Column:
    """The Jaccard similarity of two sets."""
    return let(F.size(F.array_intersect(a, b)), lambda n: n / (F.size(a) + F.size(b) - n)).cast("double")


def sets(docs: DataFrame) -> DataFrame:
    """(digest, spots, doc_id): the distinct sets of ``docs``, each with its smallest document."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), spots(text_or_empty()).alias("spots"))
    return (own.select("doc_id", "spots", F.md5(fingerprint(F.col("spots")).cast("binary")).alias("digest"))
            .groupBy("digest").agg(F.first("spots").alias("spots"), F.min("doc_id").alias("doc_id")))


def links(found: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b, likeness) by digest, a < b, of all pairs of ``sets`` that are alike
    by ``threshold`` or more (above 0)."""
    own = checkpointed(found.select("digest", "spots"))
    held = own.select("digest", F.explode("spots").alias("spot"))
    often = held.groupBy("spot").agg(F.count("*").alias("n"))
    # a set of s spots shares one of its s - ceil(t s) + 1 rarest with every set it is like
    size = F.size("rare")
    ranked = held.join(often, "spot").groupBy("digest").agg(F.array_sort(F.collect_list(F.struct("n", "spot"))).alias("rare"))
    first = F.slice("rare", F.lit(1), (size - F.ceil(F.round(size * threshold, 9)) + 1).cast("int"))
    part = F.floor(F.log(size.cast("double")) / -math.log(threshold) + 1e-9) if threshold < 1 else size
    rows = ranked.select("digest", size.alias("size"), part.cast("int").alias("part"), F.posexplode(first["spot"]).alias("place", "spot"))
    rows = checkpointed(rows.join(often.filter("n > 1").select("spot"), "spot", "left_semi"))  # others are shared with none
    near = rows.select(F.explode(F.array("part", F.col("part") + 1)).alias("part"), "spot", F.col("digest").alias("a"), F.col("size").alias("a_size"),
                       F.col("place").alias("a_place"), F.col("part").alias("a_part"))
    met = rows.join(near, ["part", "spot"]).filter((F.col("a_part") < F.col("part")) | (F.col("a") < F.col("digest")))
    short, long = F.least("size", "a_size"), F.greatest("size", "a_size")
    ahead = F.least(F.col("size") - F.col("place"), F.col("a_size") - F.col("a_place"))
    enough = F.ceil(F.round((F.col("size") + F.col("a_size")) * (threshold / (1 + threshold)), 9))
    pairs = met.filter((short >= long * threshold - 1e-9) & (ahead + F.least("place", "a_place") >= enough)).select(
        F.least("a", "digest").alias("a"), F.greatest("a", "digest").alias("b")).distinct()
    both = pairs.join(own.toDF("a", "a_spots"), "a").join(own.toDF("b", "b_spots"), "b")
    return both.select("a", "b", likeness(F.col("a_spots"), F.col("b_spots")).alias("likeness")).filter(F.col("likeness") >= threshold)


def next_ids(docs: DataFrame) -> DataFrame:
    """(key, prev, need): each distinct document (key) with the one that it
    follows (prev), and the characters that this one may take from it.
    ``docs`` has doc_id, key (the id as text, never null) and text."""
    ids = docs.groupBy("doc_id", "key").agg((F.max(F.length("text")) / 3).cast("int").alias("need"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    down = F.col("doc_id").desc_nulls_last()
    part = checkpointed(ids.repartitionByRange(n, down)).withColumn("part", F.spark_partition_id())
    own = Window.partitionBy("part").orderBy(down)
    follows = part.select("part", "need", F.col("key").alias("prev"), F.lead("key").over(own).alias("next"))
    # one row a partition: the first document of the partition after it; the last is followed by the first
    heads = part.groupBy("part").agg(F.min(F.struct(F.col("doc_id").isNull(), -F.col("doc_id"), F.col("key").alias("key"))).alias("head"))
    order = Window.orderBy("part")
    after = F.coalesce(F.lead("head.key").over(order), F.first("head.key").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    heads = heads.select("part", after.alias("after"))
    return follows.join(F.broadcast(heads), "part").select(F.coalesce("next", "after").alias("key"), "prev", "need")


def fingerprinted(docs: DataFrame) -> DataFrame:
    """Every row with its fingerprint, that of its edited text, and its likeness to that and to the next document."""
    doc_id = F.col("doc_id").cast("long")
    # the same two columns on both sides of the joins below, so that the texts are shuffled once
    own = docs.select(F.coalesce(doc_id.cast("string"), F.lit("none")).alias("key"), text_or_empty().alias("text"))
    doc_id = F.when(F.col("key") != "none", F.col("key").cast("long"))
    follow = checkpointed(next_ids(own.withColumn("doc_id", doc_id)))
    # the next document sends what the edit may take and its spots
    sent = own.join(follow, "key").select("prev", F.struct(
        F.md5(F.col("text").cast("binary")).alias("digest"), F.substring("text", F.lit(1), F.col("need")).alias("text"), spots(F.col("text")).alias("spots")).alias("next"))
    sent = sent.groupBy(F.col("prev").alias("key")).agg(F.min("next").alias("next"))
    kept = F.length("text") - F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), kept), F.substring(F.col("next.text"), F.lit(1), F.length("text") - kept))
    both = own.join(sent, "key").select(doc_id.alias("doc_id"), "text", F.col("next.spots").alias("next_spots"), edited.alias("edited"))
    # a generator holds what is made once a row
    done = both.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "next_spots",
                       F.inline(F.array(F.struct(spots(F.col("text")).alias("spots"), spots(F.col("edited")).alias("edited_spots")))))
    return done.select("doc_id", "n_chars", "edited_sha256", fingerprint(F.col("spots")).alias("fingerprint"), fingerprint(F.col("edited_spots")).alias("edited_fingerprint"),
                       likeness(F.col("spots"), F.col("edited_spots")).alias("near_edited"), likeness(F.col("spots"), F.col("next_spots")).alias("near_next"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprinted(table(spark, sf_dir, "documents"))
