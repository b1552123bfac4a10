"""Verdicts, gradients, edited counts and pipeline stages against plain Python."""
import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quarry.llm import line_dedup, packing, quality_model, quality_rules, queries, token_counts

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


def histogram(text):
    """(by class, by common word) as the rules count them."""
    words = WORD.findall(text)
    white = len(text) - sum(map(len, words))
    rest = re.sub(r"[a-z\x20\x09-\x0D]+", "", text)
    classes = [len(re.findall(c, rest)) for c in (r"[#*$%&|<>]", "[A-Z]", "[0-9]", r"[.,;:!?'\"()-]", r"(?![a-zA-Z0-9.,;:!?'\"()#*$%&|<>-])[\x21-\x7E]")]
    low = Counter(w.lower() for w in words)
    common = [low[c] for c in quality_rules.COMMON]
    return [white, len(text) - white - len(rest), *classes, len(rest) - sum(classes)], [*common, len(words) - sum(common)]


def repeated(words):
    windows = defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i:i + 3])].append(i)
    return len({i + k for own in windows.values() if len(own) > 1 for i in own for k in range(3)})


def shares(counts):
    return [c / sum(counts) for c in counts] if sum(counts) else None


def distance(p, q):
    m = [(a + b) / 2 for a, b in zip(p, q)]
    total = sum(a * math.log2(a / c) for a, c in zip(p, m) if a) + sum(b * math.log2(b / c) for b, c in zip(q, m) if b)
    return math.sqrt(max(total / 2, 0))


def test_quality_verdicts(spark, documents):
    rows = []
    for doc_id, text, lang in documents:
        words = WORD.findall(text or "")
        failed = len(words) < 50 or 100 * repeated(words) > 50 * len(words)
        rows.append((doc_id, lang, len(words), failed, *map(shares, histogram(text or ""))))

    def references(fits):
        own = [r for r in rows if fits(r) and not r[3] and r[1] in quality_rules.LANGUAGES]
        return [[[float(np.mean(x)) for x in zip(*(r[k] for r in own if r[1] == lang))] for lang in quality_rules.LANGUAGES if any(r[1] == lang for r in own)] for k in (4, 5)]

    def judged(known):
        def fits(r):
            near = [min((distance(r[k], q) for q in refs), default=None) if r[k] else None for k, refs in zip((4, 5), known)]
            return (near[0] is None or near[0] <= quality_rules.MAX_CLASS_DISTANCE) and (
                r[2] < quality_rules.MIN_COMPARED_WORDS or near[1] is None or near[1] <= quality_rules.MAX_COMMON_DISTANCE)

        return fits

    fits = judged(references(judged(references(lambda r: True))))
    want = {r[0]: (r[2], r[3], not r[3] and fits(r)) for r in rows}
    got = {x.doc_id: (x.n_words, x.base_failed, x.kept) for x in queries.op4_quality_rules(spark, SF).collect()}
    assert got == want and 0 < sum(k for _, _, k in want.values()) < len(want)


def test_attention_gradients_are_those_of_the_loss():
    r = np.random.default_rng(3)
    model = quality_model.Model()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    model.mean, model.spread = model.mean.astype(np.float64), model.spread.astype(np.float64)
    x, first, y = r.normal(size=(11, quality_model.WIDTH)), np.array([0, 1, 5, 8]), np.array([1.0, 0, 1, 0])

    def loss():
        s = model.forward(x, first)[-1]
        return -float(np.mean(y * np.log(s) + (1 - y) * np.log(1 - s)))

    for name, g in model.gradients(x, first, y).items():
        for at in r.integers(0, g.size, 12):
            own = model.p[name].reshape(-1)
            kept, step = own[at], 1e-6
            own[at] = kept + step
            up = loss()
            own[at] = kept - step
            down = loss()
            own[at] = kept
            assert abs((up - down) / (2 * step) - g.reshape(-1)[at]) < 1e-6, name
    weights = model.forward(x, first)[3]
    assert np.allclose(np.add.reduceat(weights, first), 1)


def test_passages_cover_every_word():
    texts = ["", "one", " ".join(f"w{k}" for k in range(100)), "x " * (quality_model.PASSAGE_WORDS * quality_model.MAX_PASSAGES + 500)]
    x, first = quality_model.passages(pa.array(texts))
    counts = np.diff(np.append(first, len(x)))
    want = []
    for t in texts:
        n = len(t.split())
        length = max(quality_model.PASSAGE_WORDS, -(-n // quality_model.MAX_PASSAGES))
        want.append(max(1, -(-n // length)))
    assert counts.tolist() == want
    alone = [quality_model.passages(pa.array([t]))[0] for t in texts]
    assert np.allclose(np.concatenate(alone), x)


def test_edited_counts_of_the_query(spark, documents):
    encode = packing.encoder(packing.default_vocabulary())
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    edits = {r.doc_id: [tuple(e) for e in r.e] for r in docs.select("doc_id", token_counts.sample_edits().alias("e")).collect()}
    want = {}
    for doc_id, text, _ in documents:
        text = text or ""
        before = len(encode.encode(text, allowed_special="all"))
        for start, stop, new in edits[doc_id]:
            start = min(max(start, 0), len(text))
            text = text[:start] + new + text[min(max(stop, start), len(text)):]
        want[doc_id] = (before, len(encode.encode(text, allowed_special="all")), len(text))
    rows = queries.op9_token_counts(spark, SF).collect()
    assert {r.doc_id: (r.n_tokens, r.n_tokens_edited, r.n_chars_edited) for r in rows} == want
    assert sum(r.n_reencoded for r in rows) < sum(r.n_pieces for r in rows)


def test_kept_trees_follow_later_edits(spark, tmp_path):
    vocabulary = packing.default_vocabulary()
    encode = packing.encoder(vocabulary)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionAll(
        spark.createDataFrame([(-1, None), (-2, ""), (None, "a <|endoftext|> b"), (-3, "twice"), (-3, "twice"), (-4, "x \u00e9\n" * 9000)], "doc_id long, text string"))
    told = Counter((r.doc_id, r.text or "") for r in docs.collect())
    token_counts.plant(docs, vocabulary).write.parquet(f"{tmp_path}/0")
    for step in range(3):
        trees = spark.read.parquet(f"{tmp_path}/{step}")
        assert Counter((r.doc_id, r.text) for r in trees.collect()) == told
        wanted = trees.select("doc_id", "text", token_counts.sample_edits().alias("e")).collect()
        told = Counter()
        for r in wanted:
            text = r.text
            for e in r.e:
                start = min(max(e.start, 0), len(text))
                text = text[:start] + e.text + text[min(max(e.stop, start), len(text)):]
            told[r.doc_id, text] += 1
        token_counts.follow(trees, vocabulary, token_counts.sample_edits()).write.parquet(f"{tmp_path}/{step + 1}")
        for r in spark.read.parquet(f"{tmp_path}/{step + 1}").collect():
            assert r.n_tokens_edited == len(encode.encode(r.text, allowed_special="all")) == sum(x.n_tokens for x in r.leaves)
            assert all((x.n_chars, x.n_tokens) == (sum(x.chars), sum(x.tokens)) for x in r.leaves) and r.n_chars_edited == len(r.text)
            if r.doc_id == -4:
                assert r.n_pieces > 10_000 and r.n_reencoded < 200
    nothing = token_counts.plant(docs.limit(0), vocabulary)
    assert nothing.count() == 0 and token_counts.follow(nothing, vocabulary, token_counts.sample_edits()).count() == 0


def test_a_kept_tree_counts_only_what_an_edit_touches():
    splitter = token_counts.Splitter(packing.default_vocabulary())
    planted = token_counts.Document("some words, and others " * 3000, splitter)
    stored = token_counts._stored([planted])
    doc, = token_counts._restored(pa.array([planted.text]), stored, splitter)
    assert doc.tokens == planted.tokens and doc.n_pieces == planted.n_pieces
    asked = []
    count = splitter.count
    splitter.count = lambda piece: asked.append(piece) or count(piece)
    n = doc.edit(30_000, 30_010, "new text")
    assert n == len(asked) < 20 and sum(not isinstance(x, np.ndarray) for x in doc.leaves) <= 2
    assert doc.tokens == token_counts.Document(doc.text, splitter).tokens
    with pytest.raises(ValueError, match="another text"):
        list(token_counts._restored(pa.array(["short"]), stored, splitter))


def test_null_edits_change_nothing(spark):
    docs = spark.createDataFrame([(1, "one two", None), (2, "one two", [None]), (3, None, [(0, 0, "new")]), (4, "ab", [(None, None, None), (1, None, "x")])],
                                 "doc_id long, text string, e array<struct<start: int, stop: int, text: string>>")
    got = {r.doc_id: (r.n_tokens, r.n_tokens_edited, r.n_chars_edited) for r in token_counts.count_edited(docs, packing.default_vocabulary(), F.col("e")).collect()}
    assert got[1] == got[2] == (2, 2, 7) and got[3] == (0, 1, 3) and got[4][2] == 3


def test_line_counts_replace_columns_of_their_names(spark):
    docs = spark.createDataFrame([(1, "a common line\nx", "own", 7), (2, "A common LINE", "own", 8)], "doc_id long, text string, n_lines string, n_dropped long")
    rows = {r.doc_id: r for r in line_dedup.drop_repeated_lines(docs).collect()}
    assert (rows[1].n_lines, rows[1].n_dropped, rows[2].n_lines, rows[2].n_dropped, rows[2].text) == (2, 0, 1, 1, "")


def test_pipeline_row_by_row(spark, tmp_path):
    """On documents whose fate can be told by hand: two near copies, a shared line,
    toxic words that the labels mark, sources of unlike size."""
    clean = " ".join(f"plain{k}" for k in range(60))
    rows = [(k, f"{clean} number {k} " + " ".join(f"own{k}w{j}" for j in range(80)), "en", "big" if k % 4 else "small") for k in range(1, 41)]
    rows = [(i, t + "\nthis very line stands in all of them", s, g) for i, t, s, g in rows]
    rows.append((100, rows[0][1].replace("own1w5 ", ""), "en", "big"))  # a near copy of document 1
    rows += [(200 + k, f"vile hateful slur{k} " * 12 + f" tail{k}", "en", "big") for k in range(20)]
    rows.append((300, None, "en", "small"))
    docs = spark.createDataFrame([(*r, None) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(r[0], 1, int(r[0] // 100 == 2)) for r in rows], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = docs
    told = {}
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path}/stage-{name}"
        stage(spark, kept, str(tmp_path)).write.parquet(path)
        kept = spark.read.parquet(path)
        told[name] = kept
    ids = {n: sorted(r.doc_id for r in f.select("doc_id").collect()) for n, f in told.items()}
    assert ids["toxicity"] == [r[0] for r in rows if r[0] // 100 != 2]
    lines = {r.doc_id: r.text for r in told["line_dedup"].collect()}
    assert ids["line_dedup"] == ids["toxicity"] and "this very line" in lines[1] and not any("this very line" in (t or "") for i, t in lines.items() if i != 1)
    assert ids["near_dedup"] == [i for i in ids["line_dedup"] if i != 100]
    mixed = Counter(ids["mixing"])
    assert set(mixed) == set(ids["near_dedup"]) and max(mixed.values()) <= 2
    encode = packing.encoder(packing.default_vocabulary())
    placed = told["packing"].collect()
    assert Counter(r.doc_id for r in placed) == mixed
    assert all(r.length == len(encode.encode(lines[r.doc_id] or "", allowed_special="all")) + 1 for r in placed)
    by_sequence = defaultdict(list)
    for r in placed:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for own in by_sequence.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(n for _, n in own) <= 2048
    # four of the long pieces fill a sequence as far as whole ones can; the short ones lie between
    assert len(by_sequence) == math.ceil(sum(r.length > 2048 / 5 for r in placed) / 4)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == len(placed)
