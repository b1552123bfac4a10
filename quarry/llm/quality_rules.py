"""Quality rules by distribution divergence.

Each document has two histograms: its characters by class, and its words by
common word of some language (all others count as one).  The references are the mean histograms of
the documents of each language that pass the base rules; they come from one
aggregation over the whole table and are one row of fixed width.  A document
is kept if its Jensen-Shannon distances to the nearest reference are within
bounds.  All of it is SQL functions over one scan: nothing is shuffled but
the one row of the references.

Cases: a null or empty text has no words and fails the base rules.  Rows that
share a ``doc_id`` are judged one by one.  A histogram without entries isn't compared.
Neither are the common words of a text under ``MIN_COMPARED_WORDS``, of which
few words tell little; its characters are.  A document in a language
without a reference is compared with all of them as well.  On an empty table,
or one without any document fit as a reference, nothing is compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import checkpointed, table

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Languages with a reference, by the column ``lang``.
LANGUAGES = ("en", "de", "fr", "es")
#: Character classes besides white space and a-z.
SYMBOLS = "[#*$%&|<>]"
CLASSES = (SYMBOLS, "[A-Z]", "[0-9]", r"[.,;:!?'\"()-]", r"[\x21-\x7E&&[^a-zA-Z0-9.,;:!?'\"()#*$%&|<>-]]")
#: Common words of the languages.
COMMON = ("the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "was", "on",
          "der", "die", "und", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist",
          "de", "la", "le", "et", "les", "un", "une", "que", "dans", "du", "en", "est",
          "el", "y", "los", "se", "del", "las", "por", "con", "para", "no", "su", "al")
#: Bounds on the distances, and the fewest words of a text whose common words are compared.
MAX_CLASS_DISTANCE = 0.16
MAX_COMMON_DISTANCE = 0.45
MIN_COMPARED_WORDS = 120


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also inside the lambdas of ``body``."""
    return F.transform(F.array(value), body)[0]


def text_words(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def repeat_words(words: Column) -> Column:
    """Words in a window of three that stands twice or more in the text.
    Windows are told apart by a 64-bit hash."""
    def windows(w):
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))

    def covered(g):
        def same(s):
            twice = F.filter(s, lambda x, j: ((j > 0) & (F.get(s, j - 1)["h"] == x["h"])) | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False)))
            return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

        ordered = F.array_sort(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(g) == F.size(F.array_distinct(g)), 0).otherwise(let(ordered, same))

    return let(words, lambda w: F.when(F.size(w) < 3, 0).otherwise(let(windows(w), covered)))


def base_counts(words: Column, text: Column) -> dict[str, Column]:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeat_words(words).cast("long"),
    }


def histograms(words: Column, text: Column) -> dict[str, Column]:
    """Counts by class (white space, a-z, ``CLASSES``, all other) and by common word (and all other)."""
    white = F.length(text) - F.length(F.array_join(words, ""))
    own = F.filter(F.transform(words, F.lower), lambda x: x.isin(*COMMON))

    def by_class(rest):  # of what is left without white space and a-z, a small part of most texts
        counts = [F.regexp_count(rest, F.lit(c)) for c in CLASSES]
        return let(F.array(*counts), lambda c: F.concat(F.array(white, F.length(text) - white - F.length(rest)), c,
                                                        F.array(F.length(rest) - F.aggregate(c, F.lit(0), lambda a, x: a + x))))

    return {
        "classes": let(F.regexp_replace(text, r"[a-z\x20\x09-\x0D]+", ""), by_class),
        "common": let(own, lambda o: F.array(*(F.size(o) - F.size(F.array_remove(o, w)) for w in COMMON), F.size(words) - F.size(o))),
    }


def shares(counts: Column) -> Column:
    """Counts as shares of their sum; null without a count."""
    total = F.aggregate(counts, F.lit(0), lambda a, x: a + x)
    return F.when(total > 0, F.transform(counts, lambda x: x / total))


def js_distance(p: Column, q: list[float]) -> Column:
    """The square root of the Jensen-Shannon divergence (base 2), from 0 to 1."""
    def half(x, m):
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    parts = F.zip_with(p, F.array(*map(F.lit, q)), lambda x, y: half(x, (x + y) / 2) + half(y, (x + y) / 2))
    return F.sqrt(F.greatest(F.aggregate(parts, F.lit(0.0), lambda a, x: a + x) / 2, F.lit(0.0)))


def features(docs: DataFrame) -> DataFrame:
    """Counts and histograms of every document, from its whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # a generator keeps the words apart from what reads them, so that they are split once a row
    split = docs.select("doc_id", "lang", F.inline(F.array(F.struct(text.alias("text"), text_words(text).alias("words")))))
    cols = base_counts(F.col("words"), F.col("text")) | histograms(F.col("words"), F.col("text"))
    return split.select("doc_id", "lang", *(c.alias(n) for n, c in cols.items()))


def references(feats: DataFrame) -> dict[str, dict[str, list[float]]]:
    """Mean histograms by language: one row of len(LANGUAGES) * (classes + common words) numbers."""
    fit = feats.filter(~F.col("base_failed") & F.col("lang").isin(*LANGUAGES)).select(
        "lang", shares(F.col("classes")).alias("classes"), shares(F.col("common")).alias("common"))
    sizes = {"classes": len(CLASSES) + 3, "common": len(COMMON) + 1}
    means = [F.avg(F.when(F.col("lang") == lang, F.col(h)[i])).alias(f"{lang}_{h}_{i}")
             for lang in LANGUAGES for h, n in sizes.items() for i in range(n)]
    row = fit.agg(*means).first()
    return {h: {lang: [row[f"{lang}_{h}_{i}"] for i in range(n)] for lang in LANGUAGES if row[f"{lang}_{h}_0"] is not None}
            for h, n in sizes.items()}


def with_distances(feats: DataFrame, known: dict[str, dict[str, list[float]]]) -> DataFrame:
    def nearest(hist: str) -> Column:
        refs = list(known[hist].values())
        if not refs:
            return F.lit(None).cast("double")
        return let(shares(F.col(hist)), lambda p: F.array_min(F.array(*(js_distance(p, q) for q in refs))))

    return feats.withColumn("class_distance", nearest("classes")).withColumn("common_distance", nearest("common"))


def judge(docs: DataFrame, max_class: float = MAX_CLASS_DISTANCE, max_common: float = MAX_COMMON_DISTANCE,
          min_words: int = MIN_COMPARED_WORDS) -> DataFrame:
    """One row a document: counts, distances to the nearest references, verdicts.

    The references are taken twice: documents that lie out of bounds of the
    first ones are left out of the second."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    feats = checkpointed(features(docs)).withColumn("n_symbols", F.col("classes")[2].cast("long")).withColumn("base_failed", failed)
    fits = F.coalesce(F.col("class_distance") <= max_class, F.lit(True)) & (
        (F.col("n_words") < min_words) | F.coalesce(F.col("common_distance") <= max_common, F.lit(True)))
    first = references(feats)
    known = references(with_distances(feats, first).filter(fits))
    return with_distances(feats, known).withColumn("kept", ~F.col("base_failed") & fits)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
