"""Token counts that follow edits.

A text is split into pre-tokens, the units that byte-pair encoding never
crosses.  Each document keeps them in leaves of a segment tree whose nodes
hold the characters and tokens below them.  An edit finds its first pre-token
by descending the tree, splits anew from a little before it until the new
boundaries meet the old ones again, encodes only those pre-tokens, and
updates the sums above the leaves it touched.

``count_edited`` counts texts before and after edits.  ``plant`` gives the trees
as a table, one row a document: its text and its leaves with their sums.
``follow`` takes such a table and edits, and returns the table after them with
the counts; it encodes what the edits touch, reads the pairs of touched leaves
only, and its result, once written, is the input of the next edits.

Cases: a null or empty text has no tokens; edits of it insert.  Null edits, or
a null list, change nothing.  Offsets are code points of the text as the edits
before have left it, and are clipped to it; a replacement may be empty or
null.  Rows that share a ``doc_id`` are counted one by one.  Other columns are
ignored.  An empty table gives no rows.  A tree whose characters aren't as many
as its text's is an error; a tree without leaves is that of an empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import table, text_or_empty

LEAF = 64
#: A pre-token's end depends on at most so many characters after it ("'re": two
#: after the quote), and on a special token that begins after it.
LOOKAHEAD = 3
#: Distinct pre-tokens whose counts a task remembers.
REMEMBERED = 500_000
LEAVES = "array<struct<n_chars: int, n_tokens: int, chars: array<int>, tokens: array<int>>>"


class Splitter:
    """Splits text into pre-tokens and counts the tokens of each."""

    def __init__(self, vocabulary: str):
        import public_tokenizers
        import regex

        from quarry.llm.packing import encoder

        self.pattern = regex.compile(public_tokenizers.PATTERN)
        encoding = encoder(vocabulary)
        self.encode = encoding.encode_ordinary
        special = sorted(encoding.special_tokens_set, key=lambda s: (-len(s), s))
        self.special = regex.compile("|".join(map(regex.escape, special)) or r"(?!)")
        self.lookahead = LOOKAHEAD + max(map(len, special), default=0)
        self.known: dict[str, int] = dict.fromkeys(special, 1)

    def pieces(self, text: str, at: int = 0) -> Iterator[tuple[int, int]]:
        """(start, end) of the pre-tokens from ``at`` on; special tokens are found first."""
        for s in self.special.finditer(text, at):
            yield from (m.span() for m in self.pattern.finditer(text, at, s.start()))
            yield s.span()
            at = s.end()
        yield from (m.span() for m in self.pattern.finditer(text, at))

    def count(self, piece: str) -> int:
        n = self.known.get(piece)
        if n is None:
            if len(self.known) >= REMEMBERED:
                self.known = {k: 1 for k in self.known if self.special.fullmatch(k)}
            n = self.known[piece] = len(self.encode(piece))
        return n


class Document:
    """A text with its pre-tokens as (characters, tokens) in the leaves of a segment tree."""

    def __init__(self, text: str, splitter: Splitter):
        self.text, self.splitter = text, splitter
        pieces = splitter.pattern.findall(text) if not splitter.special.search(text) else [text[a:b] for a, b in splitter.pieces(text)]
        known, count = splitter.known, splitter.count
        self._plant([(len(p), known[p] if p in known else count(p)) for p in pieces])
        self.encoded = len(pieces)

    @classmethod
    def restored(cls, text: str, leaves: list[np.ndarray], sums: np.ndarray, splitter: Splitter) -> "Document":
        """A text whose leaves, rows of (characters, tokens), and their sums are known."""
        doc = cls.__new__(cls)
        if int(sums[:, 0].sum()) != len(text):
            raise ValueError("the tree is of another text")
        doc.text, doc.splitter, doc.encoded = text, splitter, 0
        doc.leaves = leaves or [[]]
        doc._grow(sums)
        return doc

    def _plant(self, pieces: list[tuple[int, int]]) -> None:
        self.leaves = [pieces[i:i + LEAF] for i in range(0, len(pieces), LEAF)] or [[]]
        self._grow(np.add.reduceat(np.array(pieces, dtype=np.int64), np.arange(0, len(pieces), LEAF)) if pieces else np.zeros((0, 2), np.int64))

    def _grow(self, of_leaves: np.ndarray) -> None:
        """The sums of all nodes above the leaves."""
        self.width = 1 << (len(self.leaves) - 1).bit_length()
        sums = np.zeros((2 * self.width, 2), dtype=np.int64)
        sums[self.width:self.width + len(of_leaves)] = of_leaves
        level = self.width
        while level > 1:
            sums[level // 2:level] = sums[level:2 * level].reshape(-1, 2, 2).sum(axis=1)
            level //= 2
        self.sums = sums.tolist()

    def _leaf(self, leaf: int) -> list[tuple[int, int]]:
        """The pre-tokens of a leaf; a restored one is read when it is first touched."""
        pieces = self.leaves[leaf]
        if isinstance(pieces, np.ndarray):
            pieces = self.leaves[leaf] = list(map(tuple, pieces.tolist()))
        return pieces

    @property
    def tokens(self) -> int:
        return self.sums[1][1]

    @property
    def n_pieces(self) -> int:
        return sum(map(len, self.leaves))

    def _find(self, char: int) -> tuple[int, int, int]:
        """(leaf, place in it, first character) of the pre-token that holds ``char``; past the end: after the last."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if char >= start + self.sums[node][0] and self.sums[node + 1][0]:
                start += self.sums[node][0]
                node += 1
        leaf = node - self.width
        pieces = self._leaf(leaf) if leaf < len(self.leaves) else []
        for i, (size, _) in enumerate(pieces):
            if char < start + size:
                return leaf, i, start
            start += size
        return min(leaf, len(self.leaves) - 1), len(pieces), start

    def _after(self, leaf: int, at: int, start: int) -> tuple[int, int, int]:
        """The place after a pre-token, in the next leaf that has one where its own ends."""
        start += self._leaf(leaf)[at][0]
        at += 1
        while at >= len(self.leaves[leaf]) and leaf + 1 < len(self.leaves):
            leaf, at = leaf + 1, 0
        return leaf, at, start

    def _summed(self, leaf: int) -> None:
        node = leaf + self.width
        self.sums[node] = [sum(c for c, _ in self.leaves[leaf]), sum(t for _, t in self.leaves[leaf])]
        while node > 1:
            node //= 2
            a, b = self.sums[2 * node], self.sums[2 * node + 1]
            self.sums[node] = [a[0] + b[0], a[1] + b[1]]

    def edit(self, start: int, stop: int, new: str) -> int:
        """Replace the characters from ``start`` to ``stop``; the pre-tokens encoded for it."""
        n = len(self.text)
        start = min(max(start, 0), n)
        stop = min(max(stop, start), n)
        text = self.text[:start] + new + self.text[stop:]
        moved, fresh_to = len(text) - n, start + len(new)
        first_leaf, first_at, at = self._find(max(0, start - self.splitter.lookahead - 1))
        old = first_leaf, first_at, at
        found: list[tuple[int, int]] = []
        for a, b in self.splitter.pieces(text, at):
            if a >= fresh_to:  # from here on both texts have the same characters
                while old[1] < len(self.leaves[old[0]]) and old[2] < a - moved:
                    old = self._after(*old)
                if old[2] == a - moved and old[2] >= stop:
                    break
            found.append((b - a, self.splitter.count(text[a:b])))
        else:
            while old[1] < len(self.leaves[old[0]]):
                old = self._after(*old)
        last_leaf, last_at, _ = old
        head, rest = self._leaf(first_leaf)[:first_at], self._leaf(last_leaf)[last_at:]
        if first_leaf == last_leaf:
            self.leaves[first_leaf] = head + found + rest
        else:
            self.leaves[first_leaf] = head + found
            self.leaves[last_leaf] = rest
            for leaf in range(first_leaf + 1, last_leaf):
                self.leaves[leaf] = []
        for leaf in range(first_leaf, last_leaf + 1):
            self._summed(leaf)
        self.text = text
        if len(self.leaves[first_leaf]) > 4 * LEAF:
            self._plant([p for leaf in range(len(self.leaves)) for p in self._leaf(leaf)])
        return len(found)


def _edited(doc: Document, edits: pa.Scalar) -> tuple[int, int, int, int, int]:
    """Tokens before and after, pre-tokens before, pre-tokens encoded anew, characters after."""
    before, pieces, anew = doc.tokens, doc.n_pieces, 0
    for e in edits.as_py() or ():
        if e is not None:
            at = e["start"] or 0
            anew += doc.edit(at, at if e["stop"] is None else e["stop"], e["text"] or "")
    return before, doc.tokens, pieces, anew, len(doc.text)


COUNTS = ["n_tokens", "n_tokens_edited", "n_pieces", "n_reencoded", "n_chars_edited"]


def _counts(rows: list[tuple[int, ...]]) -> list[pa.Array]:
    return [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(COUNTS))]


def _count(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(vocabulary)
        for batch in batches:
            rows = [_edited(Document(text.as_py() or "", splitter), edits) for text, edits in zip(batch.column(1), batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *_counts(rows)], ["doc_id", *COUNTS])

    return run


def _stored(docs: list[Document]) -> pa.Array:
    """The leaves of documents with their sums, empty ones left out."""
    leaves = [np.asarray(leaf, dtype=np.int32) for d in docs for leaf in d.leaves if len(leaf)]
    pairs = np.concatenate([np.zeros((0, 2), np.int32), *leaves])
    ends = pa.array(np.cumsum([0, *map(len, leaves)]), pa.int32())
    sums = np.add.reduceat(pairs, ends.to_numpy()[:-1]) if leaves else pairs
    lists = [pa.ListArray.from_arrays(ends, pa.array(pairs[:, i])) for i in (0, 1)]
    rows = pa.StructArray.from_arrays([pa.array(sums[:, 0], pa.int32()), pa.array(sums[:, 1], pa.int32()), *lists], ["n_chars", "n_tokens", "chars", "tokens"])
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(sum(1 for x in d.leaves if len(x)) for d in docs)]), pa.int32()), rows)


def _restored(texts: pa.Array, leaves: pa.Array, splitter: Splitter) -> Iterator[Document]:
    chars, tokens, sizes, counts = leaves.flatten().flatten()
    sums = np.stack([chars.to_numpy(), tokens.to_numpy()], axis=1)
    pairs = np.stack([sizes.flatten().to_numpy(), counts.flatten().to_numpy()], axis=1)
    ends = np.cumsum([0, *sizes.value_lengths().to_pylist()])
    at = 0
    for text, n in zip(texts, leaves.value_lengths().to_pylist()):
        own = range(at, at + (n or 0))
        yield Document.restored(text.as_py() or "", [pairs[ends[i]:ends[i + 1]] for i in own], sums[own.start:own.stop], splitter)
        at = own.stop


def _plant_all(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(vocabulary)
        for batch in batches:
            docs = [Document(text.as_py() or "", splitter) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _stored(docs)], ["doc_id", "text", "leaves"])

    return run


def _follow(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(vocabulary)
        for batch in batches:
            docs, rows = [], []
            for doc, edits in zip(_restored(batch.column(1), batch.column(2), splitter), batch.column(3)):
                rows.append(_edited(doc, edits))
                docs.append(doc)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([d.text for d in docs], pa.string()), _stored(docs), *_counts(rows)],
                                             ["doc_id", "text", "leaves", *COUNTS])

    return run


def plant(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, text, leaves): the segment tree of every row."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return own.mapInArrow(_plant_all(vocabulary), f"doc_id long, text string, leaves {LEAVES}")


def follow(trees: DataFrame, vocabulary: str, edits: Column) -> DataFrame:
    """``trees``, as ``plant`` or ``follow`` gave them for the same vocabulary, after
    edits like those of ``count_edited``, with the counts."""
    own = trees.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), "leaves", edits.alias("edits"))
    return own.mapInArrow(_follow(vocabulary), f"doc_id long, text string, leaves {LEAVES}, " + ", ".join(f"{c} long" for c in COUNTS))


def count_edited(docs: DataFrame, vocabulary: str, edits: Column) -> DataFrame:
    """Token counts of every row before and after its edits, an array of
    struct<start: int, stop: int, text: string> applied in order."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), edits.alias("edits"))
    return own.mapInArrow(_count(vocabulary), "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))


def sample_edits() -> Column:
    """Edits made from the text itself: a replacement at a third, a deletion in
    the middle, an insertion at two thirds, an addition at the end."""
    text, n = text_or_empty(), F.length(text_or_empty())
    third, half = F.floor(n / 3).cast("int"), F.floor(n / 2).cast("int")

    def edit(start: Column, stop: Column, new: Column) -> Column:
        return F.struct(start.cast("int").alias("start"), stop.cast("int").alias("stop"), new.alias("text"))

    return F.array(edit(third, third + 12, F.substring(text, 1, 8)), edit(half, half + 5, F.lit("")),
                   edit(2 * third, 2 * third, F.substring(text, half, F.lit(20))), edit(n + 100, n + 100, F.concat(F.lit("\n"), F.substring(text, 1, 40))))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.llm.packing import default_vocabulary

    return count_edited(table(spark, sf_dir, "documents"), default_vocabulary(), sample_edits())
