"""License scans: an exact set-similarity join of text blocks with templates.

A document's words are covered by blocks of ``2 * stride`` words, one every
``stride`` words, so that every passage of up to ``stride + 1`` words lies whole
in a block.  A template matches a block that holds at least its threshold's
share of the template's distinct words (containment).  All such pairs are
found, and no others:

* the words of the templates are counted over the blocks of all documents and
  ordered from the rarest on;
* prefix filter: a template that needs k of its n words shares one of its
  n-k+1 first words with every block it matches, so blocks look up only these;
* length filter: the block holds k words of the templates at least;
* positional filter: after the first shared word, the words that follow it in
  template and block must suffice;
* what is left is counted, and compared as text.

The templates are held by every task; ``Templates`` refuses more than MOST_WORDS
words of them, which bounds what is broadcast.  The frequencies that reach the
driver are one number a template word.

Beside the templates, a phrase has a place wherever its words follow one another.

Cases: a null or empty text has no words and no labels, a score of 0.  Rows that
share a ``doc_id`` are scanned one by one, a null ``doc_id`` stays null.  Texts
of any length are scanned whole, a batch of about a megabyte at a time (a longer
text alone).  Other columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import LOWER, buffers, runs, table, text_or_empty, words

STRIDE = 64
THRESHOLD = 0.8
#: Words of all templates together, at most.
MOST_WORDS = 1_000_000

# The phrases of the base, by label.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


class Template(NamedTuple):
    label: str
    text: str
    threshold: float = THRESHOLD


# Opening words of public licenses and of the lines that name them.
# A line of few words counts whole: four words in five don't tell licenses apart.
TEMPLATES = [
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0", 1.0),
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                           "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                    "following conditions are met"),
    Template("cc-by-nc", "Licensed under CC BY-NC 4.0", 1.0),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                    "License as published by the Free Software Foundation"),
    Template("gpl-3.0", "licensed under the GNU General Public License, version 3", 1.0),
    Template("mit", "Released under the MIT License", 1.0),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                    "documentation files (the \"Software\"), to deal in the Software without restriction"),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
]

_BETWEEN = np.ones(256, dtype=bool)
_BETWEEN[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = False
_BETWEEN[128:] = False


def _split(text: str) -> tuple[np.ndarray, list[bytes]]:
    """Hashes of a text's words, and the words."""
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    h, _, start, end = words(raw, np.array([0, len(raw)]), between=_BETWEEN)
    low = LOWER[raw].tobytes()
    return h, [low[a:b] for a, b in zip(start, end)]


class Templates:
    """The templates' words, numbered, and from ``order`` on their index."""

    def __init__(self, templates: Sequence[Template], phrases: Mapping[str, str], stride: int):
        self.stride, self.labels = stride, [t.label for t in templates]
        split = [_split(t.text) for t in templates]
        if sum(len(w) for _, w in split) > MOST_WORDS:
            raise ValueError(f"templates of more than {MOST_WORDS} words")
        for t, (_, own) in zip(templates, split):
            if not 0 < len(own) <= stride + 1:
                raise ValueError(f"a template has 1 to stride + 1 = {stride + 1} words: {t.text!r}")
        self.sets = [frozenset(own) for _, own in split]
        self.needs = [max(1, math.ceil(round(t.threshold * len(s), 9))) for t, s in zip(templates, self.sets)]
        known = {h: w for hs, ws in split for h, w in zip(hs.tolist(), ws)}
        self.hashes = np.array(sorted(known), dtype=np.uint64)
        self.words = [known[h] for h in self.hashes.tolist()]
        self.phrases = [(*_split(p), label) for p, label in phrases.items()]

    def order(self, counts: Mapping[int, int]) -> Templates:
        """Number the words from the rarest on and index every template's prefix."""
        rarest = sorted(range(len(self.words)), key=lambda w: (counts.get(w, 0), self.words[w]))
        self.rank = np.empty(len(rarest), dtype=np.int64)
        self.rank[rarest] = np.arange(len(rarest))
        rank_of = {self.words[w]: int(self.rank[w]) for w in range(len(self.words))}
        self.has = np.zeros((len(rarest), len(self.sets)), dtype=bool)
        postings: list[list[tuple[int, int]]] = [[] for _ in rarest]
        for t, own in enumerate(self.sets):
            ranks = sorted(rank_of[w] for w in own)
            self.has[ranks, t] = True
            for place, r in enumerate(ranks[:len(ranks) - self.needs[t] + 1]):
                postings[r].append((t, place))
        self.first = np.concatenate([[0], np.cumsum([len(p) for p in postings])]).astype(np.int64)
        flat = np.array([x for p in postings for x in p], dtype=np.int64).reshape(-1, 2)
        self.template, self.place = flat[:, 0], flat[:, 1]
        self.size, self.need = np.array([len(s) for s in self.sets]), np.array(self.needs)
        return self

    def numbered(self, h: np.ndarray) -> np.ndarray:
        """The number of every hash that is a template word's, else -1."""
        if not len(self.hashes):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, at, -1)


class Words:
    """The words of a run of rows and the blocks that cover them."""

    def __init__(self, raw: np.ndarray, off: np.ndarray, stride: int):
        self.raw, n_rows = raw, len(off) - 1
        self.h, self.row, self.start, self.end = words(raw, off, between=_BETWEEN)
        self.n = np.bincount(self.row, minlength=n_rows)
        self.first = np.cumsum(self.n) - self.n
        blocks = -(-self.n // stride)
        self.first_block = np.cumsum(blocks) - blocks
        self.at = (np.arange(len(self.h)) - self.first[self.row]) // stride

    def pairs(self, numbers: np.ndarray, several: int) -> tuple[np.ndarray, np.ndarray]:
        """(block, number) of the distinct template words of every block, in this order."""
        own = np.flatnonzero(numbers >= 0)
        block = self.first_block[self.row[own]] + self.at[own]
        second = own[self.at[own] > 0]
        block = np.concatenate([block, block[self.at[own] > 0] - 1])
        key = np.unique(block * several + numbers[np.concatenate([own, second])])
        return key // several, key % several

    def word(self, i: int) -> bytes:
        return LOWER[self.raw[self.start[i]:self.end[i]]].tobytes()


def _count(index: Templates):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(len(index.words), dtype=np.int64)
        for batch in batches:
            raw, off = buffers(batch.column(0))
            for i, j in runs(off):
                part = off[i:j + 1]
                own = Words(raw[part[0]:part[-1]], part - part[0], index.stride)
                _, number = own.pairs(index.numbered(own.h), max(1, len(held)))
                held += np.bincount(number, minlength=len(held))
        yield pa.RecordBatch.from_pydict({"word": pa.array(range(len(held)), pa.int32()), "n": pa.array(held)})

    return run


def _matches(own: Words, index: Templates) -> list[tuple[int, int, int]]:
    """(block, template, shared words) of all pairs that meet the threshold."""
    number = index.numbered(own.h)
    block, rank = own.pairs(np.where(number >= 0, index.rank[number] if len(index.rank) else 0, -1), max(1, len(index.words)))
    if not len(block):
        return []
    starts = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
    size = np.diff(np.append(starts, len(block)))
    nth = np.repeat(np.arange(len(starts)), size)
    place = np.arange(len(block)) - starts[nth]
    looked = index.first[rank + 1] - index.first[rank]
    pair = np.repeat(np.arange(len(block)), looked)
    posting = np.arange(len(pair)) - np.repeat(np.cumsum(looked) - looked, looked) + index.first[rank][pair]
    template = index.template[posting]
    _, firsts = np.unique(nth[pair] * len(index.sets) + template, return_index=True)
    pair, posting, template = pair[firsts], posting[firsts], template[firsts]
    ahead = np.minimum(index.size[template] - index.place[posting], size[nth[pair]] - place[pair])
    ok = (size[nth[pair]] >= index.need[template]) & (ahead >= index.need[template])
    out = []
    for b, t in zip(nth[pair[ok]].tolist(), template[ok].tolist()):
        shared = int(index.has[rank[starts[b]:starts[b] + size[b]], t].sum())
        if shared >= index.need[t]:
            out.append((int(block[starts[b]]), t, shared))
    return out


def _scan(index: Templates):
    item = pa.struct([("label", pa.string()), ("template", pa.int32()), ("word", pa.int64()), ("containment", pa.float64())])
    spot = pa.struct([("label", pa.string()), ("word", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = buffers(batch.column(1))
            for i, j in runs(off):
                part = off[i:j + 1]
                own = Words(raw[part[0]:part[-1]], part - part[0], index.stride)
                spots: list[list[dict]] = [[] for _ in range(i, j)]
                found: list[list[dict]] = [[] for _ in range(i, j)]
                for h, text, label in index.phrases:
                    last = len(own.h) - len(h) + 1
                    hit = np.ones(max(0, last), dtype=bool)
                    for k, x in enumerate(h):
                        hit &= own.h[k:k + len(hit)] == x
                    for w in np.flatnonzero(hit).tolist():
                        r = int(own.row[w])
                        if own.row[w + len(h) - 1] == r and [own.word(w + k) for k in range(len(h))] == text:
                            spots[r].append({"label": label, "word": w - int(own.first[r])})
                for b, t, _ in _matches(own, index):
                    r = int(np.searchsorted(own.first_block, b, side="right")) - 1
                    at = (b - int(own.first_block[r])) * index.stride
                    begin = int(own.first[r]) + at
                    held = {own.word(w) for w in range(begin, min(begin + 2 * index.stride, int(own.first[r] + own.n[r])))}
                    shared = len(index.sets[t] & held)
                    if shared >= index.needs[t]:
                        found[r].append({"label": index.labels[t], "template": t, "word": at, "containment": shared / len(index.sets[t])})
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(own.n, pa.int64()), pa.array(spots, pa.list_(spot)), pa.array(found, pa.list_(item))],
                                                 ["doc_id", "n_words", "places", "matches"])

    return run


def scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, phrases: Mapping[str, str] = PHRASES, stride: int = STRIDE) -> DataFrame:
    """Per row: doc_id, n_words, ``places`` of phrases (label, first word) and
    ``matches`` (label, template, first word of the block, containment)."""
    index = Templates(templates, phrases, stride)
    text = docs.select(text_or_empty().alias("text"))
    counts = text.mapInArrow(_count(index), "word int, n long").groupBy("word").agg(F.sum("n").alias("n"))
    index.order({r["word"]: r["n"] for r in counts.collect()})  # a row a template word
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return own.mapInArrow(_scan(index), "doc_id long, n_words long, places array<struct<label: string, word: long>>, "
                                        "matches array<struct<label: string, template: int, word: long, containment: double>>")


def labelled(scanned: DataFrame) -> DataFrame:
    """One row a document: counts, labels and the best containment (1 where a phrase stands)."""
    place, base = F.col("places.word"), F.col("places.label")
    best = F.coalesce(F.array_max(F.col("matches.containment")), F.lit(0.0))
    return scanned.select("doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(place).alias("first_word"), F.array_max(place).alias("last_word"),
                          F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
                          F.array_join(F.array_sort(F.array_distinct(F.concat(base, F.col("matches.label")))), ",").alias("labels"),
                          F.when(F.size("places") > 0, 1.0).otherwise(best).alias("score"))


def op11_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(scan(table(spark, sf_dir, "documents")))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


OP11_SQL = rf"""
WITH templates(template, label, threshold, text) AS (VALUES {", ".join(f"({k}, {_quoted(t.label)}, CAST({t.threshold} AS DOUBLE), {_quoted(t.text)})" for k, t in enumerate(TEMPLATES))}),
phrases(label, phrase) AS (VALUES {", ".join(f"({_quoted(label)}, {_quoted(p)})" for p, label in PHRASES.items())}),
split AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
terms AS (SELECT DISTINCT template, label, threshold, unnest(regexp_extract_all(lower(text), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM templates),
sizes AS (SELECT template, label, greatest(1, ceil(round(threshold * count(*), 9))) AS need, count(*) AS size FROM terms GROUP BY template, label, threshold),
spoken AS (SELECT doc_id, words[i] AS word, i - 1 AS pos, words FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM split)),
blocks AS (SELECT DISTINCT doc_id, word, unnest([pos // {STRIDE}, pos // {STRIDE} - 1]) AS block FROM spoken WHERE word IN (SELECT word FROM terms)),
shared AS (SELECT b.doc_id, b.block, t.template, count(*) AS n FROM blocks b JOIN terms t USING (word) WHERE b.block >= 0 GROUP BY ALL),
hits AS (SELECT h.doc_id, s.label, h.n / s.size AS containment FROM shared h JOIN sizes s USING (template) WHERE h.n >= s.need),
places AS (SELECT s.doc_id, p.label, s.pos FROM spoken s JOIN phrases p
           ON s.word = split_part(p.phrase, ' ', 1) AND array_to_string(s.words[s.pos + 1 : s.pos + len(string_split(p.phrase, ' '))], ' ') = p.phrase),
based AS (SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY doc_id),
named AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
          FROM (SELECT doc_id, label FROM places UNION SELECT doc_id, label FROM hits) GROUP BY doc_id),
best AS (SELECT doc_id, max(containment) AS containment FROM hits GROUP BY doc_id)
SELECT s.doc_id, CAST(len(s.words) AS BIGINT) AS n_words, coalesce(b.n_base, 0) AS n_base, b.first_word, b.last_word,
       coalesce(b.base_labels, '') AS base_labels, coalesce(n.labels, '') AS labels,
       CASE WHEN b.n_base > 0 THEN 1.0 ELSE coalesce(c.containment, 0) END::DOUBLE AS score
FROM split s LEFT JOIN based b ON b.doc_id = s.doc_id LEFT JOIN named n ON n.doc_id = s.doc_id LEFT JOIN best c ON c.doc_id = s.doc_id
"""
