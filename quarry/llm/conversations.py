"""Repair of the structure of conversations, by a suffix-shared automaton.

A conversation's signature is one symbol a row: the role's initial and the row's
first fault.  Reduced to what repair can see, the signatures of all conversations
are dealt to ranges of their reversed spelling and sorted; every task walks its
range along one path of the automaton whose nodes are the suffixes of signatures.
A node, reached once however many conversations end in its suffix, holds for
every state of the grammar ``(s?(ua)+)?`` the cost to go and the first step of the
best audit; the rest of that audit is the next node's.  Options of a node begin
with different letters, so ties between whole audits are settled by the first.
Equal signatures, however many, are spread by conversation over tasks.

Signatures come without sorting a conversation in one task: rows without their
texts are sorted by range, written, joined to strings of 2^SEGMENT_BITS rows at most, and
these to one string a conversation.  Rows that are alike in everything count as
one with a multiplicity.  Texts move once, to their conversation: its rows stream
past its audit in order (nothing but the audit is held), since a digest of a
whole conversation can't be split.

Cases: a null role or text is one space; a null conv_id is one conversation; null
turns come first; rows of one turn are ordered by role, then by the text's md5.
Empty texts are blank.  Texts are read whole, whatever their length.  Rows that
are repeated are duplicates after the first.  A conversation without rows after
damage has zeros and an empty audit.  Other columns are ignored.  An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import table, written

SEGMENT_BITS = 12
WHITE = r"\x20\x09-\x0D"
# Initials that the grammar knows, faults in the order in which they count, legal neighbours.
INITIALS = "sua"
FAULTS = ("", "blank", "duplicate", "truncated")
LEGAL = ("su", "ua", "au")
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1

#: The symbol of initial i (3: another) and fault f is the letter 4 * i + f.
SYMBOLS = "abcdefghijklmnop"
#: The same as repair sees it: a row to delete is one whatever its role; capitals are truncated.
SEEN = "sddSuddUaddAxddX"

#: Grammar states: nothing yet, after s, after u, after a.  From each, the role that may be put there, and what it leads to.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
NEXT = ("u", "u", "a", "u")
LEADS = {"s": AFTER_S, "u": AFTER_U, "a": AFTER_A}
ROLES = {"u": "user", "a": "assistant"}
ORDER = ("conv_id", "turn", "role", "text_md5", "copy")


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage: conv_id, turn, role, text, copy.  A row that is
    dropped stays with copy 0 so that its conversation does, without text."""
    spoken = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                  F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    own = spoken.withColumn("fate", F.crc32(key.cast("binary")) % 20)
    text = F.when(F.col("fate").isin(0, 1), "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("fate") == 0, F.array(F.lit(0))).when(F.col("fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return own.select("conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy"))


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("text_md5", F.unhex(F.md5(F.col("text").cast("binary"))))


def _sorted_by() -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in ORDER]


def symbols(rows: DataFrame) -> DataFrame:
    """Distinct rows by conversation and order, with the symbol of the first
    (``symbol``) and of all the same rows after it (``again``, ``times`` in number)."""
    last = F.substring(F.regexp_extract("text", rf"([^{WHITE}])[{WHITE}]*\z", 1), 1, 1)
    initial = F.substring("role", 1, 1)
    slim = (_keyed(rows).select(*ORDER, initial.alias("initial"), (~F.col("text").rlike(rf"[^{WHITE}]")).alias("blank"), (~last.isin(*".!?")).alias("cut"))
            .groupBy(*ORDER, "initial", "blank", "cut").agg((F.count("*") - 1).alias("times")))
    place = F.struct("turn", "copy")
    said = (slim.filter(F.col("copy") > 0).groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("text_md5").alias("t"))
            .agg(F.min(place).alias("first"), F.count("*").alias("n")).filter(F.col("n") > 1).drop("n"))
    joined = slim.join(said, slim["conv_id"].eqNullSafe(said["c"]) & (slim["role"] == said["r"]) & (slim["text_md5"] == said["t"]), "left")
    later = F.coalesce(place > F.col("first"), F.lit(False))
    kind = F.coalesce(*[F.when(F.col("initial") == i, k) for k, i in enumerate(INITIALS)], F.lit(len(INITIALS)))

    def letter(seen: Column) -> Column:
        fault = F.when(F.col("blank"), FAULTS.index("blank")).when(seen, FAULTS.index("duplicate")).when(F.col("cut"), FAULTS.index("truncated")).otherwise(0)
        return F.when(F.col("copy") == 0, "").otherwise(F.substring(F.lit(SYMBOLS), 4 * kind + fault + 1, F.lit(1)))

    return joined.select(*ORDER, letter(later).alias("symbol"), letter(F.lit(True)).alias("again"), "times")


def signatures(rows: DataFrame) -> DataFrame:
    """conv_id, signature and gaps of every conversation."""
    ranged = symbols(rows).repartitionByRange(*_sorted_by()).sortWithinPartitions(*_sorted_by())
    # ids ascend with the order, and within a partition by one
    placed = written(ranged.select("conv_id", "turn", "copy", F.concat("symbol", F.expr("repeat(again, CAST(times AS INT))")).alias("run"), F.monotonically_increasing_id().alias("place")))

    def joined(at: str, text: str) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(at, text))), lambda x: x[text]), "").alias("run")

    segment = F.shiftright("place", SEGMENT_BITS).alias("segment")
    segments = placed.groupBy("conv_id", segment).agg(joined("place", "run"))
    whole = segments.groupBy("conv_id").agg(joined("segment", "run")).withColumnRenamed("run", "signature")
    turns = placed.select("conv_id", F.when(F.col("copy") > 0, F.col("turn")).alias("turn")).distinct().groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    turns = turns.withColumnRenamed("conv_id", "c")
    return whole.join(turns, whole["conv_id"].eqNullSafe(turns["c"])).drop("c")


Node = tuple[tuple[int, ...], tuple[tuple[str, int], ...]]
#: After the last row: the cost and the audit that close the grammar from each state.
CLOSING = ("", "II", "I", "")
END: Node = (tuple(INSERT * len(c) for c in CLOSING), tuple((c, AFTER_A) for c in CLOSING))


@lru_cache(maxsize=1 << 16)
def _node(symbol: str, below: tuple[int, ...]) -> Node:
    """Cost to go and first step (letters, state after the row) from every state
    before a row, given the costs after it."""
    must, cut, initial = symbol == "d", TRUNCATED if symbol.isupper() else 0, symbol.lower()
    best = []
    for q in range(4):
        options = [(DELETE + below[q], "D", q)]
        if not must:
            to = LEADS[NEXT[q]]
            options.append((REROLE + cut + below[to], "R", to))
            if initial == NEXT[q] or (initial == "s" and q == START):
                options.append((KEEP + cut + below[LEADS[initial]], "K", LEADS[initial]))
        best.append(min(options))
    while True:
        with_insert = []
        for q in range(4):
            cost, letters, to = best[LEADS[NEXT[q]]]
            with_insert.append(min(best[q], (INSERT + cost, "I" + letters, to)))
        if with_insert == best:
            return tuple(c for c, _, _ in best), tuple((letters, to) for _, letters, to in best)
        best = with_insert


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walks the sorted reversed signatures; ``path`` is the way from the end to the last one's first row."""
    path: list[tuple[Node, int]] = [(END, 0)]  # costs less the second, so that equal shapes are one
    before, cost, audit = "", 0, ""
    for batch in batches:
        costs, audits = [], []
        for spelled in batch.column(1).to_pylist():
            if spelled != before or not spelled:
                shared = next((k for k, (x, y) in enumerate(zip(spelled, before)) if x != y), min(len(spelled), len(before)))
                del path[shared + 1:]
                for symbol in spelled[shared:]:
                    (below, _), base = path[-1]
                    reached, steps = _node(symbol, below)
                    least = min(reached)
                    path.append(((tuple(c - least for c in reached), steps), base + least))
                cost, state, letters = path[-1][0][0][START] + path[-1][1], START, []
                for (_, steps), _ in reversed(path):
                    step, state = steps[state]
                    letters.append(step)
                before, audit = spelled, "".join(letters)
            costs.append(cost)
            audits.append(audit)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(costs, pa.int64()), pa.array(audits, pa.string())], ["row", "cost", "audit"])


def reports(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit of every conversation."""
    own = signatures(rows).select(F.struct("conv_id", "gaps", "signature").alias("row"), F.reverse(F.translate("signature", SYMBOLS, SEEN)).alias("spelled"))
    walked = own.repartitionByRange("spelled", "row.conv_id").sortWithinPartitions("spelled", "row.conv_id")
    out = walked.mapInArrow(_audits, "row struct<conv_id: bigint, gaps: bigint, signature: string>, cost long, audit string")
    signature = F.col("row.signature")

    def count(fault: str) -> Column:
        own_letters = "".join(SYMBOLS[k] for k in range(FAULTS.index(fault), len(SYMBOLS), len(FAULTS)))
        return F.regexp_count(signature, F.lit(f"[{own_letters}]")).cast("long").alias(fault)

    initials = F.translate(signature, SYMBOLS, "".join(i * len(FAULTS) for i in INITIALS + "x"))
    legal = sum((F.regexp_count(initials, F.lit(f"{a}(?={b})")) for a, b in LEGAL), F.lit(0))
    return out.select("row.conv_id", "row.gaps", *[count(f) for f in FAULTS[1:]],
                      (F.greatest(F.length(signature) - 1, F.lit(0)) - legal).cast("long").alias("illegal"), "cost", "audit")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that follow their conversation's audit, edited as it says."""
    audit, at, state, position = "", 0, START, 0

    def inserted(conv_id) -> Iterator[tuple]:
        nonlocal at, state, position
        while at < len(audit) and audit[at] == "I":
            role = NEXT[state]
            at, state, position = at + 1, LEADS[role], position + 1
            yield conv_id, position, "I", None, ROLES[role], ""

    for batch in batches:
        out: list[tuple] = []
        for conv_id, turn, role, text, told in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "audit"))):
            if told is not None:  # the first row of a conversation
                audit, at, state, position = told, 0, START, 0
                out += inserted(conv_id)
                continue
            letter = audit[at]
            at += 1
            if letter != "D":
                initial = role[:1] if letter == "K" else NEXT[state]
                state, position = LEADS[initial], position + 1
                out.append((conv_id, position, letter, turn, role if letter == "K" else ROLES[initial], text))
            out += inserted(conv_id)
        cols = list(zip(*out)) or [()] * 6
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], ["conv_id", "position", "edit", "turn", "role", "text"])


def repaired(rows: DataFrame, reported: DataFrame) -> DataFrame:
    """The repaired rows: conv_id, position (from 1), edit (K, R or I), turn, role,
    text; within a partition a conversation's rows stand together and in order."""
    own = _keyed(rows.filter(F.col("copy") > 0)).withColumn("audit", F.lit(None).cast("string"))
    # sorts before its rows: its copy is the smallest
    first = reported.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit(None).cast("string").alias("text"),
                            F.lit(0).alias("copy"), F.lit(None).cast("binary").alias("text_md5"), "audit")
    both = own.unionByName(first).repartition("conv_id")
    ordered = both.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("audit").isNull(), *_sorted_by()[1:])
    return ordered.select("conv_id", "turn", "role", "text", "audit").mapInArrow(_edited, "conv_id long, position long, edit string, turn long, role string, text string")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """sha256 of the rows of each conversation as they come, ``role:text`` joined by newlines."""
    now, digest, begun = None, hashlib.sha256(), False
    names = ["conv_id", "sha256"]

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([digest.hexdigest()])], names)

    for batch in batches:
        done = []
        for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
            if not begun or conv_id != now:
                if begun:
                    done.append(row())
                now, digest, begun = conv_id, hashlib.sha256(), True
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        if done:
            yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
    if begun:
        yield row()


def digests(repaired_rows: DataFrame) -> DataFrame:
    """conv_id and sha256 of what ``repaired`` returns."""
    return repaired_rows.select("conv_id", "role", "text").mapInArrow(_digests, "conv_id long, sha256 string")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(table(spark, sf_dir, "conversations"))
    told = written(reports(rows))
    hashed = digests(repaired(rows, told)).withColumnRenamed("conv_id", "c")
    return told.join(hashed, told["conv_id"].eqNullSafe(hashed["c"]), "left").select(
        *told.columns, F.coalesce("sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))
