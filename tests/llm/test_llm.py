"""The llm operators against brute force on small frames: nulls, empty and long
texts, ties, repeated rows, empty tables, extra columns."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quarry.llm import (fingerprints, language_model, line_dedup, mixing, near_dedup, packing, quality_model, quality_rules,
                        queries, token_counts, toxicity)
from quarry.llm.common import crc_mod

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0D]+")
ODD = [(1, "one\nA shared line here\n\n end", "s1"), (2, None, "s1"), (3, "", None), (4, "a shared LINE here \nother text", "s2"), (4, "a shared LINE here \nother text", "s2"),
       (5, "x y z " * 3000, "s2"), (6, "é漢 #$% &|<>\t\x0bw", "s3"), (7, "word " * 9 + "\n" + "word " * 9, "s3"), (None, "A shared line here", "s3")]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en", s, None, "own") for i, t, s in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")


@pytest.fixture(scope="module")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in (1, 4, 5, 6, 7)] + [(8, None, None)], "doc_id long, quality int, toxic int")


def test_packing_covers_every_token_once(odd, empty):
    from tokenizers import Tokenizer

    vocabulary = packing.default_vocabulary()
    hf = Tokenizer.from_file(vocabulary)
    placed = packing.placements(packing.pack(odd, vocabulary)).toPandas()
    want = Counter()
    for i, t, _ in ODD:
        ids = np.array([*hf.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        for k, (a, n) in enumerate(packing.cut(len(ids))):
            want[(-1 if i is None else i, k, a, n, zlib.crc32(ids[a:a + n].tobytes()))] += 1
    got = Counter((-1 if r.doc_id != r.doc_id else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in placed.itertuples())
    assert got == want
    for _, g in placed.sort_values("offset").groupby("sequence_id"):
        assert g.length.sum() <= 2048 and list(g.offset) == [0, *np.cumsum(g.length)[:-1]]
    assert placed.sequence_id.nunique() <= math.ceil(placed.length.sum() / 2048) + 1
    assert packing.placements(packing.pack(empty, vocabulary)).count() == 0


def test_packing_cuts_and_fits():
    assert packing.cut(2048) == [(0, 2048)] and packing.cut(5000) == [(0, 904), (904, 2048), (2952, 2048)] and packing.cut(4096) == [(0, 2048), (2048, 2048)]
    sizes = np.array([5, 5, 4, 3, 2, 1])
    assert [sum(sizes[i] for i in b) for b in packing.best_fit(sizes, 10)] == [10, 10]


def test_near_dedup_finds_all_links(spark, odd, empty):
    r = random.Random(5)
    texts = []
    for _ in range(12):
        base = [f"w{r.randrange(4000)}" for _ in range(200)]
        for edits in (0, 0, 1, 2, 3, 40):
            own = list(base)
            for _ in range(edits):
                own[r.randrange(200)] = "new"
            texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x["doc_id"]: x["class_id"] for x in near_dedup.classed(docs).collect()}
    bags = [Counter(tuple(t.split()[k:k + 5]) for k in range(len(t.split()) - 4)) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if sum((bags[a] & bags[b]).values()) >= 0.8 * sum((bags[a] | bags[b]).values()):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert got == {i: find(i) for i in range(len(texts))}
    kept = near_dedup.keep_first(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 1, 2, 4, 5, 6, 7]
    assert near_dedup.keep_first(empty).count() == 0


@pytest.mark.parametrize("block", [None, 64])
def test_near_dedup_finds_links_in_a_family_of_alike_texts(spark, monkeypatch, block):
    if block:
        monkeypatch.setattr(near_dedup, "BLOCK", block)
    # 1,200 texts of a likeness of about 0.78 share buckets; three of them have a near copy
    texts = [[*(f"t{k}" for k in range(176)), *(f"m{i}_{k}" for k in range(24))] for i in range(1200)]
    for i in range(3):
        texts.append([*texts[390 * i + 40][:179], *(f"c{i}_{k}" for k in range(21))])
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {x["doc_id"]: x["class_id"] for x in near_dedup.classed(docs).collect()}
    bags = [{tuple(t[k:k + 5]) for k in range(len(t) - 4)} for t in texts]
    held = Counter(g for b in bags for g in b)
    place = {g: k for k, g in enumerate(g for g, n in held.items() if n > 1)}  # others are shared by no pair
    has = np.zeros((len(texts), len(place)), np.float32)
    for i, b in enumerate(bags):
        has[i, [place[g] for g in b if g in place]] = 1
    shared, size = has @ has.T, np.array([len(b) for b in bags])
    alike = shared / (size[:, None] + size[None, :] - shared)
    links = [(a, b) for a, b in zip(*np.where(alike >= 0.8)) if a < b]
    assert len(links) == 3 and np.median(alike) > 0.7  # each near pair a class of its own
    assert got == {i: i for i in range(len(texts))} | {int(b): int(a) for a, b in links}


def test_signature_agreement_is_the_weighted_similarity():
    a = " ".join(f"w{i}" for i in range(300)) + " x" * 60
    b = " ".join(f"w{i}" for i in range(30, 330)) + " x" * 20
    raw, off = near_dedup.buffers(pa.array([a, b]))
    sig = near_dedup.signatures(*near_dedup.bags(raw, off), 2, 6000)
    assert abs((sig[0] == sig[1]).mean() - near_dedup.similarities(pa.array([a]), pa.array([b]))[0]) < 0.03


def test_signatures_pass_pairs_at_the_least_similarity():
    k = near_dedup.fewest_agreeing(0.8)
    draws = np.random.default_rng(7).binomial(near_dedup.REGISTERS, 0.8, 200_000)
    assert (draws < k).mean() <= 3 * near_dedup.MISS
    assert (np.random.default_rng(7).binomial(near_dedup.REGISTERS, 0.5, 10_000) < k).mean() > 0.99


def test_text_filter_keeps_all_wanted(spark):
    ids = spark.range(3000).select(F.unhex(F.md5(F.col("id").cast("string").cast("binary"))).alias("node"), "id")
    kept = [r.id for r in ids.filter(near_dedup._among(ids.filter("id < 1000").select("node"))).collect()]
    assert set(range(1000)) <= set(kept) and len(kept) < 1010
    assert ids.filter(near_dedup._among(ids.filter("id < 0").select("node"))).count() == 0


@pytest.mark.parametrize("bits", [1 << 19, 1 << 22])
def test_line_dedup(odd, empty, bits):
    got = {}
    for r in line_dedup.drop_repeated_lines(odd, bits=bits).collect():
        got.setdefault(r["doc_id"], []).append((r["text"], r["n_lines"], r["n_dropped"], r["score"]))
    assert got[1] == [(ODD[0][1], 4, 0, "own")] and got[2] == [(None, 1, 0, "own")] and got[3] == [("", 1, 0, "own")]
    assert got[4] == [("other text", 2, 1, "own")] * 2 and got[None] == [("", 1, 1, "own")] and got[7] == [(ODD[7][1], 2, 0, "own")]
    assert line_dedup.drop_repeated_lines(empty).count() == 0


@pytest.mark.parametrize("n", [2_000, 40_000])
def test_line_filters_stay_sparse(spark, n):
    # one line in a hundred stands in two documents, one line in a third of all
    docs = spark.range(n // 20).select(F.col("id").alias("doc_id"), F.concat_ws("\n", F.transform(F.sequence(F.lit(0), F.lit(19)), lambda k: F.concat(F.lit("line number "), (
        F.when((k == 0) & (F.col("id") % 10 < 2), F.col("id").bitwiseAND(-2) * 20).otherwise(F.col("id") * 20 + k)).cast("string"))),
        F.when(F.col("id") % 3 == 0, "the line of a third")).alias("text"))
    lines = Counter(x for r in docs.collect() for x in r.text.split("\n"))
    first = {}
    for r in sorted(docs.collect(), reverse=True):
        first.update(dict.fromkeys(r.text.split("\n"), r.doc_id))
    got = {r.doc_id: r for r in line_dedup.drop_repeated_lines(docs, bits=1 << 12).collect()}
    assert {r.doc_id: "\n".join(x for x in r.text.split("\n") if first[x] == r.doc_id) for r in docs.collect()} == {i: r.text for i, r in got.items()}
    repeated = sum(c for c in lines.values() if c > 1)
    suspects = line_dedup.suspected(docs, bits=1 << 12).count()
    assert repeated <= suspects <= repeated + 0.05 * sum(c == 1 for c in lines.values())


def test_quality_rules_base_counts(spark, odd, empty):
    r = random.Random(2)
    rows = [(100 + i, " ".join(r.choice(["a", "b", "the", "c\n", "#d", "\n"]) for _ in range(r.choice([0, 2, 60, 400]))), "en") for i in range(40)]
    docs = odd.select("doc_id", "text", "lang").unionAll(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    for x in quality_rules.judge(docs).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        w = WORD.findall(x["text"] or "")
        grams = list(zip(w, w[1:], w[2:]))
        many = Counter(grams)
        repeat = len({i + k for i, g in enumerate(grams) if many[g] > 1 for k in range(3)})
        lines = [line for line in (x["text"] or "").split("\n") if WORD.search(line)]
        assert (x["n_words"], x["word_chars"], x["n_symbols"], x["n_dup_lines"], x["n_repeat_words"]) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x["text"] or "")), len(lines) - len(set(lines)), repeat)
        assert x["base_failed"] == (len(w) < 50 or 100 * repeat > 50 * len(w)) and not (x["kept"] and x["base_failed"])
    assert quality_rules.judge(empty).count() == 0


def test_quality_rules_judge_the_characters_of_short_texts(spark):
    r = random.Random(4)

    def prose(n):
        return [r.choice(["the", "of", "and", "to"]) if r.random() < 0.4 else "".join(r.choices("etaoinshrdlu", k=6)) for _ in range(n)]

    texts = [prose(300) for _ in range(20)] + [prose(n) for n in (50, 80, 119)] + [[w + "%&$#" for w in prose(n)] for n in (50, 80, 119)]
    docs = spark.createDataFrame([(i, " ".join(t), "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    got = {x["doc_id"]: (x["base_failed"], x["kept"]) for x in quality_rules.judge(docs).collect()}
    assert got == {i: (False, i < 23) for i in range(len(texts))}


def test_js_distance(spark):
    p, q = [0.2, 0.8, 0.0], [0.5, 0.1, 0.4]
    m = [(a + b) / 2 for a, b in zip(p, q)]
    want = math.sqrt(sum(a * math.log2(a / c) for a, c in zip(p, m) if a) / 2 + sum(b * math.log2(b / c) for b, c in zip(q, m) if b) / 2)
    got = spark.range(1).select(quality_rules.js_distance(F.array(*map(F.lit, p)), q)).first()[0]
    assert abs(got - want) < 1e-12


@pytest.mark.parametrize("module, query", [(quality_model, queries.op5_quality_model), (toxicity, queries.op6_toxicity)])
def test_classifiers(spark, odd, empty, labels, module, query):
    model = module.fit(odd, labels, F.lit(True))
    got = [r["score"] for r in module.score(odd, model).collect()]
    assert len(got) == len(ODD) and all(0 <= s <= 1 for s in got)
    none = module.fit(empty, labels, F.lit(True))
    assert module.score(empty, none).count() == 0 and module.score(odd, none).count() == len(ODD)
    rows = query(spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").filter("held_out").toPandas()
    y, rank = rows["quality" if module is quality_model else "toxic"].to_numpy(), rows["score"].rank().to_numpy()
    n = y.sum()
    assert (rank[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n)) > 0.95


def test_fingerprints(odd, empty):
    rows = fingerprints.fingerprinted(odd).toPandas()
    assert len(rows) == len(ODD)
    texts = {i: t or "" for i, t, _ in ODD}
    order = sorted((i for i in texts if i is not None), reverse=True) + [None]
    for r in rows.itertuples():
        i = None if r.doc_id != r.doc_id else int(r.doc_id)
        own, after = texts[i], texts[order[(order.index(i) + 1) % len(order)]]
        k = len(own) // 3
        assert r.n_chars == len(own) and r.edited_sha256 == hashlib.sha256((own[:len(own) - k] + after[:k]).encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert rows[rows.doc_id == 4].fingerprint.nunique() == 1
    assert fingerprints.fingerprinted(empty).count() == 0


def test_language_model(odd, empty):
    rows = language_model.score(odd, crc_mod(10) != 0).toPandas()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = [(-1 if i is None else i, [*WORD.findall((t or "").translate(lower)), None]) for i, t, _ in ODD]
    held = {i: zlib.crc32(("" if i == -1 else str(i)).encode()) % 10 == 0 for i, _ in tokens}
    count = Counter(w for i, t in tokens if not held[i] for w in t)
    n, v = sum(count.values()), len(count)
    want = sorted((i, held[i], len(t), sum(count[w] > 0 for w in t), n, round(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), 6)) for i, t in tokens)
    got = sorted((-1 if r.doc_id != r.doc_id else int(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows.itertuples())
    assert got == want and (rows["score"] < 0).all()
    assert language_model.score(empty, F.lit(True)).count() == 0


def test_seating_keeps_customers_and_bounds():
    rng = np.random.default_rng(1)
    c = np.array([0, 1, 2, 50, 100_000])
    t = language_model.seat(c, np.full(5, 0.01), np.array([0, 0, 0, 1, 1]), 2, 0.5, rng)
    assert t[0] == 0 and t[1] == 1 and (t[1:] >= 1).all() and (t <= c).all()


def test_longer_contexts_are_seated_under_their_parents():
    rng = np.random.default_rng(5)
    keys, n = np.unique(np.concatenate([rng.integers(0, 3, 6) + 97 for _ in range(3000)]).reshape(-1, 6).astype(np.uint64) @ np.array([1 << 8 * k for k in range(5, -1, -1)], np.uint64), return_counts=True)
    upper, states = [[]], []
    for sweep in range(3):
        *_, (own, up, customers) = language_model._lower(keys, n, upper)
        levels, _, _ = language_model._seated(*language_model._tally([up], [customers]), upper[-1], language_model.UPPER, 0, np.random.default_rng(sweep))
        upper.append(levels)
        states.append([*levels, *own])
    for state in states:
        assert [len(np.unique(s.keys)) for s in state] == [len(np.unique(language_model.shorter(keys, 5, k))) for k in range(6)]
        context = keys[11] >> np.uint64(8)
        every = (context << np.uint64(8)) | np.arange(256, dtype=np.uint64)
        assert abs(language_model.predictions(state, every, 5).sum() - 1) < 1e-9
    # the parents' chances decide how many tables open: a level seated under uniform ones has fewer
    assert states[1][5].open.sum() > states[0][5].open.sum()
    # a level's customers are the tables of the level above it
    assert all(abs(b.open.sum() - a.total.sum()) < 1e-9 for a, b in zip(states[2], states[2][1:]))


def test_runs_are_seated_whole_stems_at_a_time(monkeypatch):
    monkeypatch.setattr(language_model, "CHUNK_RUNS", 50)
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 1 << 48, 2000).astype(np.uint64) & np.uint64(0x03_03_0F_FF_FF_FF))
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[i:i + 7].view(np.int64)), pa.array(np.ones(len(keys[i:i + 7]), np.int64))], ["key", "n"]) for i in range(0, len(keys), 7)]
    chunks = list(language_model._chunks(iter(batches)))
    assert sorted(np.concatenate([k for k, _ in chunks])) == sorted(keys) and len(chunks) > 5
    stems = [set((k >> np.uint64(24)).tolist()) for k, _ in chunks]
    assert all(not a & b for i, a in enumerate(stems) for b in stems[:i])


def test_predictions_sum_to_one():
    keys = np.unique(np.random.default_rng(3).integers(0, 1 << 24, 500).astype(np.uint64))
    levels, _, _ = language_model._seated(keys, np.full(len(keys), 3), [], 2, 0, np.random.default_rng(0))
    context = keys[7] >> np.uint64(8)
    every = (context << np.uint64(8)) | np.arange(256, dtype=np.uint64)
    assert abs(language_model.predictions(levels, every, 2).sum() - 1) < 1e-9


def test_runs_are_spelled_from_the_nearest_byte():
    text = "Ab é"
    raw, off = language_model.buffers(pa.array([text, ""]))
    got, owner, _, _ = language_model.spelled(raw, off)
    want = []
    for row, t in enumerate([text, ""]):
        said = b"\n" * 5 + b"".join(w.encode() + b" " for w in t.lower().split()) + b"\n"
        want += [(row, int.from_bytes(said[i - 5:i][::-1] + said[i:i + 1], "big")) for i in range(5, len(said))]
    assert sorted(zip(owner.tolist(), got.tolist())) == sorted(want)
    assert language_model.shorter(got, 5, 2).tolist() == [((k >> 32) << 8) | (k & 255) for k in got.tolist()]


SPECIAL = ["a <|endoftext|> b", "<|endoftext|>", "x!!<|endoftext|><|endoftext|>  <|endoftext|>\n", "<|endoftext", "  <|endoftext|>'s"]


def test_special_tokens_are_one_id_each():
    from tokenizers import Tokenizer

    vocabulary = packing.default_vocabulary()
    hf, own, splitter = Tokenizer.from_file(vocabulary), packing.encoder(vocabulary), token_counts.Splitter(vocabulary)
    for t in SPECIAL:
        ids = hf.encode(t, add_special_tokens=False).ids
        assert own.encode(t, allowed_special="all") == ids
        assert token_counts.Document(t, splitter).tokens == len(ids)
    assert own.encode(SPECIAL[0], allowed_special="all") == [64, 220, 50256, 275]


def test_toxicity_features_are_characters():
    texts = ["", "Abc", "aé漢😀bcdE", "ABCdef"]
    raw, off = toxicity.buffers(pa.array(texts))
    got = Counter((int(r), int(h)) for rows, hs in toxicity.ngrams(raw, off) for r, h in zip(rows, hs))
    want = Counter()
    for r, t in enumerate(texts):
        low = t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        for order in toxicity.ORDERS:
            for k in range(len(low) - order + 1):
                h = 0
                for c in low[k:k + order]:
                    h = (h * int(toxicity.SPREAD) + ord(c)) % (1 << 64)
                key = (h * (len(toxicity.ORDERS) + 1) + order - min(toxicity.ORDERS)) % (1 << 64)
                want[r, int(toxicity.mix64(np.array([key], np.uint64))[0] >> np.uint64(64 - toxicity.HASH_BITS))] += 1
    assert got == want


def test_toxicity_counts_and_ratios_by_hand(spark):
    rows = [(k, ("bad words here " if k % 3 == 0 else "good text there ") + "x" * (k % 5), k % 3 == 0) for k in range(60)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    marks = spark.createDataFrame([(k, int(y)) for k, _, y in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, marks, F.lit(True))
    held = {True: Counter(), False: Counter()}
    for _, t, y in rows:
        raw, off = toxicity.buffers(pa.array([t]))
        held[y].update({int(h) for _, hs in toxicity.ngrams(raw, off) for h in hs})
    size = {y: sum(z == y for _, _, z in rows) for y in held}
    ratio = {h: math.log((held[True][h] + 1) / (size[True] + 2)) - math.log((held[False][h] + 1) / (size[False] + 2)) for h in held[True] | held[False]}
    assert {h for h in range(len(model.column)) if model.column[h] >= 0} == set(ratio)
    sure = [h for h in ratio if held[True][h] == size[True] and not held[False][h]]
    assert all(model.weight[model.column[h]] > 0 for h in sure) and sure
    assert [s > 0.5 for s in (r["score"] for r in toxicity.score(docs, model).orderBy("doc_id").collect())] == [y for _, _, y in rows]


def test_rejecting_keeps_all_columns(spark, odd, labels):
    out = toxicity.reject(odd, labels, F.lit(True), cut=2.0)
    assert out.columns == odd.columns and Counter(map(tuple, out.collect())) == Counter(map(tuple, odd.collect()))


def test_mixing_beside_columns_of_its_own_names(spark, odd):
    docs = odd.select("*", *[F.lit(k).alias(c) for k, c in enumerate(("whole", "c0", "__c0", "c1", "c2", "__g", "__copies", "tokens"))])
    out = mixing.mix(docs)
    assert out.columns == [*docs.columns, "epoch", "mix_block", "mix_order"]
    assert set(map(tuple, out.select(*docs.columns).collect())) == set(map(tuple, docs.collect()))


def spot_set(spark, text):
    return set(spark.createDataFrame([(text,)], "text string").select(fingerprints.spots(F.col("text"))).first()[0])


def test_fingerprints_compare_as_their_documents(spark):
    r = random.Random(6)
    base = [r.choice(["the", "of", "and", *(f"w{k}" for k in range(300))]) for _ in range(150)]
    rows = [(k, " ".join(w if r.random() > k / 40 else "other" for w in base)) for k in range(12)] + [(20, ""), (21, "x"), (22, " ".join(base[:8]))]
    got = {x.doc_id: x for x in fingerprints.fingerprinted(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts, order = dict(rows), sorted((k for k, _ in rows), reverse=True)

    def parsed(hexed):
        return {int(hexed[i:i + 8], 16) for i in range(0, len(hexed), 8)}

    def jaccard(a, b):
        return len(a & b) / len(a | b)

    for i, after in zip(order, order[1:] + order[:1]):
        x = got[i]
        assert parsed(x.fingerprint) == {s % (1 << 32) for s in spot_set(spark, texts[i])}
        assert x.near_edited == jaccard(parsed(x.fingerprint), parsed(x.edited_fingerprint))
        assert x.near_next == jaccard(parsed(x.fingerprint), parsed(got[after].fingerprint))


@pytest.mark.parametrize("threshold", [0.8, 0.5])
def test_links_of_fingerprints_are_all_found(spark, threshold):
    r = random.Random(8)
    sets = {}
    for k in range(40):
        base = set(r.sample(range(-500, 500), r.randrange(1, 80)))
        for _ in range(4):
            sets.setdefault(frozenset(base), f"d{len(sets):03d}")
            base = (base - set(r.sample(sorted(base), min(len(base) - 1, r.randrange(4))))) | set(r.sample(range(-500, 500), r.randrange(4)))
    frame = spark.createDataFrame([(d, sorted(s)) for s, d in sets.items()], "digest string, spots array<int>")
    got = {(x.a, x.b): x.likeness for x in fingerprints.links(frame, threshold).collect()}
    want = {tuple(sorted((a, b))): len(s & t) / len(s | t) for s, a in sets.items() for t, b in sets.items() if a < b and len(s & t) >= threshold * len(s | t) - 1e-12}
    assert got == want and len(want) > 60


def test_distinct_sets(spark, odd):
    rows = fingerprints.sets(odd).collect()
    assert len(rows) == len({frozenset(spot_set(spark, t or "")) for _, t, _ in ODD}) and {r.doc_id for r in rows if r.doc_id} <= {i for i, _, _ in ODD}
    assert fingerprints.links(fingerprints.sets(odd).limit(0)).count() == 0


def test_edits_are_counted_as_a_new_encoding(odd, empty):
    vocabulary = packing.default_vocabulary()
    splitter, r = token_counts.Splitter(vocabulary), random.Random(3)
    encode = lambda t: packing.encoder(vocabulary).encode(t, allowed_special="all")
    letters = [*"ab c  '\n\tre'srel 12é!?#漢", "<|endoftext|>", "<|endof", "text|>", "<|"]
    for _ in range(60):
        doc = token_counts.Document("".join(r.choice(letters) for _ in range(r.choice([0, 1, 5, 50, 2000]))), splitter)
        for _ in range(15):
            a = r.randint(0, len(doc.text))
            b, new = min(len(doc.text), a + r.choice([0, 1, 3, 100])), "".join(r.choice(letters) for _ in range(r.choice([0, 1, 2, 20, 600])))
            want = doc.text[:a] + new + doc.text[b:]
            doc.edit(a, b, new)
            assert doc.text == want and doc.tokens == len(encode(want))
    assert token_counts.count_edited(odd, vocabulary, token_counts.sample_edits()).count() == len(ODD)
    assert token_counts.count_edited(empty, vocabulary, token_counts.sample_edits()).count() == 0


def test_mixing(spark, odd, empty):
    rows = [(i, "s0" if i % 10 else f"s{i % 70}", "w " * (20 + i % 7)) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = mixing.mix(docs, max_repeat=1.5).toPandas()
    size = {i: len(t.split()) for i, _, t in rows}
    own = Counter()
    for i, s, _ in rows:
        own[s] += size[i]
    mixed = Counter()
    for r in got.itertuples():
        mixed[r.source] += size[r.doc_id]
    repeat = {s: mixed[s] / own[s] for s in own}
    p = {s: own[s] / sum(own.values()) for s in own}
    a = 1 - math.log(1.5) / math.log(max(p.values()) / min(p.values()))
    for s in own:
        assert abs(repeat[s] - (p[s] / max(p.values())) ** (a - 1)) < 26 / own[s] + 1e-6
    assert set(got.doc_id) == set(size) and not got.duplicated(["doc_id", "epoch"]).any()
    again = mixing.mix(odd)
    assert again.columns == [*odd.columns, "epoch", "mix_block", "mix_order"] and again.count() >= len(ODD)
    assert mixing.mix(empty).count() == 0
    shares = spark.createDataFrame([(0.7,), (0.2,), (0.1,)], "share double")
    e = mixing.exponent(shares, target_entropy=1.0, max_repeat=None)
    w = np.array([0.7, 0.2, 0.1]) ** e
    w /= w.sum()
    assert abs(-(w * np.log(w)).sum() - 1.0) < 1e-6


def test_pipeline_stages(spark, odd):
    docs = odd.withColumn("whole", F.lit(1)).withColumn("c0", F.lit("x")).withColumn("n_dropped", F.lit(2.5))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns, name
        docs = spark.createDataFrame(out.toPandas(), out.schema) if out.count() else out
    assert corpus_pipeline.run(spark, SF).count() > 0
