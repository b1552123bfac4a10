"""License scans, fill-in-middle and conversation repair against brute force."""
import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from quarry.llm import conversations, fill_in_middle, licenses
from quarry.llm.licenses import PHRASES, TEMPLATES, Template

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

MIT = TEMPLATES[8].text
TEXTS = [None, "", "\n", "CC BY", "cc\nBY cc by", "All rights\treserved. ALL-RIGHTS-RESERVED", "the general public  license", "x " * 70 + MIT + " y" * 500,
         "Released under the MIT License.", "Released under the BSD License.", "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0.",
         "éa漢 cc by É", " ".join(w for k, w in enumerate(MIT.split()) if k % 9), " ".join(w for k, w in enumerate(MIT.split()) if k % 2), "a\x7fb\x00c <P>", "word " * 30_000 + MIT + " end" * 9]


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(k, t, 7, "own") for k, t in enumerate(TEXTS)] + [(3, "CC BY", 7, "own"), (None, "cc by", 7, "own")]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words long, row string")


def scanned(text, templates=TEMPLATES, stride=licenses.STRIDE):
    own = WORD.findall((text or "").translate(LOWER))
    spots = [(w, label) for p, label in PHRASES.items() for w in range(len(own)) if own[w:w + len(p.split())] == p.split()]
    found = []
    for b in range(0, len(own), stride):
        block = set(own[b:b + 2 * stride])
        for k, t in enumerate(templates):
            terms = set(WORD.findall(t.text.translate(LOWER)))
            if len(block & terms) >= max(1, math.ceil(round(t.threshold * len(terms), 9))):
                found.append((t.label, k, b, len(block & terms) / len(terms)))
    return len(own), sorted(spots), sorted(found)


def test_license_scan_finds_all_pairs(texts):
    got = Counter((r.doc_id, str(r.n_words), str(sorted((p.word, p.label) for p in r.places)), str(sorted(tuple(m) for m in r.matches))) for r in licenses.scan(texts).collect())
    want = Counter((r.doc_id, *map(str, scanned(r.text))) for r in texts.collect())
    assert got == want
    labels = {r.doc_id: (r.base_labels, r.labels, r.score) for r in licenses.labelled(licenses.scan(texts)).collect() if r.doc_id is not None}
    assert labels[7] == ("", "mit", 1.0) and labels[8] == ("", "mit", 1.0) and labels[9] == ("", "", 0.0) and labels[10][1] == "apache-2.0"
    assert labels[11] == ("cc-by", "cc-by,cc-by-nc", 1.0) and labels[13][1] == "mit" and 0.8 <= labels[13][2] < 1 and labels[14] == ("", "", 0.0) and labels[16][1] == "mit"
    assert licenses.scan(texts.limit(0)).count() == 0


def test_license_join_on_random_sets(spark):
    r = random.Random(3)
    vocabulary = [f"w{k}" for k in range(60)]
    templates = [Template(f"t{k}", " ".join(r.choices(vocabulary, k=r.randrange(1, 12))), r.choice([0.5, 0.7, 0.8, 1.0])) for k in range(25)]
    docs = [" ".join(r.choices(vocabulary + ["other"] * 40, k=r.randrange(0, 90))) for _ in range(60)]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    got = {r.doc_id: sorted(tuple(m) for m in r.matches) for r in licenses.scan(frame, templates, {}, stride=16).collect()}
    want = {k: scanned(d, templates, 16)[2] for k, d in enumerate(docs)}
    assert got == want and sum(map(len, want.values())) > 200
    assert all(not r.matches and not r.places for r in licenses.scan(frame, [], {}).collect())
    with pytest.raises(ValueError):
        licenses.scan(frame, [Template("long", "w " * 99)])


def filled(doc_id, text, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    return (n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < spm else (n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


LINES = ["", "\n", "\n\n", "a", "a\n", "é漢\n😀 b\n\nc", "<P", "<P>", "x\n<M> y\n", "<\nS>\n<\n", "P>\n<S", "l\n" * 5000 + "end", "tail<", "<<S", "\r\n\r"]


@pytest.mark.parametrize("rate", [100, 40])
def test_fill_in_middle_round_trip(spark, rate):
    r = random.Random(1)
    rows = [(k, t) for k, t in enumerate([None, *LINES])] + [(100 + k, "".join(r.choices(["a", "\n", "<", "P", "S", ">", "é", "😀"], k=r.randrange(30)))) for k in range(400)]
    rows += [(3, "a\nb\n"), (3, "a\nb\n"), (None, "x\ny\nz")]
    docs = spark.createDataFrame([(i, t, "f", "own") for i, t in rows], "doc_id long, text string, form string, `row` string").repartition(3)
    out = fill_in_middle.restore(fill_in_middle.fill_in_middle(docs, rate=rate))
    assert out.columns == ["doc_id", "text", "row", "n_units", "form", "prefix_chars", "middle_chars", "fim_text", "restored_text"]
    got = Counter((x.doc_id, x.text, x.n_units, x.form, x.prefix_chars, x.middle_chars, x.fim_text, x.restored_text, x.row) for x in out.collect())
    assert got == Counter((i, t, *filled(i, t, rate), t or "", "own") for i, t in rows)
    assert {x[3] for x in got} == {"plain", "psm", "spm"}
    assert fill_in_middle.restore(fill_in_middle.fill_in_middle(docs.limit(0))).count() == 0


def test_restore_of_broken_marks(spark):
    rows = [("psm", "<P>a<S>b<M>c"), ("spm", "<P>a<S>b<M>c"), ("psm", "<P>a<S>b"), ("psm", "<P>a<S>b<M>c<M>"), ("spm", "<S>a<P>b<M>c"), ("plain", "a"), (None, "a"), ("psm", None)]
    got = [x.restored_text for x in fill_in_middle.restore(spark.createDataFrame(rows, "form string, fim_text string").coalesce(1)).collect()]
    assert got == ["acb", None, None, None, "bca", "a", None, None]


def damage(rows):
    """conversation -> its rows after damage as (turn, role, text), in order."""
    out = defaultdict(list)
    for conv_id, turn, role, text in rows:
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        role, text, fate = " " if role is None else role, " " if text is None else text, zlib.crc32(key.encode()) % 20
        out[conv_id] += []
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out[conv_id] += [(turn, "user" if fate == 4 else role, text, c) for c in range(2 if fate == 3 else 1)]
    return {c: [x[:3] for x in sorted(own, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), hashlib.md5(x[2].encode()).digest(), x[3]))] for c, own in out.items()}


def faults(rows):
    out, seen = [], set()
    for _, role, text in rows:
        said = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


GRAMMAR = re.compile(r"(s?(ua)+)?")


def applied(rows, found, audit):
    """(cost, repaired rows) of an audit, or None where it isn't legal."""
    out, cost, k = [], 0, 0
    for letter in audit:
        role = "au"[len(out) == 0 or out[-1][0][:1] in "sa"] if out else "u"
        if letter == "I":
            cost += 2
            out.append(({"u": "user", "a": "assistant"}[role], ""))
            continue
        if k == len(rows):
            return None
        _, own, text = rows[k]
        if letter == "D":
            cost += 3
        else:
            if found[k] in ("blank", "duplicate"):
                return None
            cost += (found[k] == "truncated") + 2 * (letter == "R")
            out.append((own if letter == "K" else {"u": "user", "a": "assistant"}[role], text))
        k += 1
    if k < len(rows) or not GRAMMAR.fullmatch("".join(r[:1] or "-" for r, _ in out)):
        return None
    return cost, out


def searched(rows, found):
    """The cheapest audit, ASCII-least, of all audits with up to four insertions."""
    best = None
    for extra in range(5):
        for places in itertools.combinations_with_replacement(range(len(rows) + 1), extra):
            for letters in itertools.product("DKR", repeat=len(rows)):
                audit = "".join("I" * places.count(k) + (letters[k] if k < len(rows) else "") for k in range(len(rows) + 1))
                done = applied(rows, found, audit)
                if done and (best is None or (done[0], audit) < best[:2]):
                    best = (done[0], audit, done[1])
    return best


def planned(rows, found):
    """The same by whole strings from the end, for long conversations."""
    lead = {0: ("u", 2), 1: ("u", 2), 2: ("a", 3), 3: ("u", 2)}
    best = {0: (0, ""), 1: (4, "II"), 2: (2, "I"), 3: (0, "")}
    for (_, role, _), fault in zip(rows[::-1], found[::-1]):
        now = {}
        for q in range(4):
            options = [(best[q][0] + 3, "D" + best[q][1])]
            if fault not in ("blank", "duplicate"):
                cut, (need, to) = fault == "truncated", lead[q]
                options.append((best[to][0] + 2 + cut, "R" + best[to][1]))
                if role[:1] == need or (role[:1] == "s" and q == 0):
                    to = {"s": 1, "u": 2, "a": 3}[role[:1]]
                    options.append((best[to][0] + cut, "K" + best[to][1]))
            now[q] = min(options)
        for _ in range(4):
            now = {q: min(now[q], (now[lead[q][1]][0] + 2, "I" + now[lead[q][1]][1])) for q in range(4)}
        best = now
    return best[0]


def told(rows):
    """What the query returns of a conversation's rows."""
    found = faults(rows)
    cost, audit = planned(rows, found)
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    _, out = applied(rows, found, audit)
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, found.count("blank"), found.count("duplicate"), found.count("truncated"),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


def made(r, n_convs, longest):
    rows = []
    for c in range(n_convs):
        for t in range(r.randrange(1, longest)):
            turn = r.choice([t, t, t, t, 2 * t, None])
            rows.append((c, turn, r.choice(["system", "user", "assistant", "assistant", "user", "tool", "", None, "u"]), r.choice(["hi.", "so?", "end", " ", "", None, "ok. \n", "é漢", f"n{t}!"])))
    return rows


def as_rows(frame):
    return Counter((x.conv_id, x.gaps, x.blank, x.duplicate, x.truncated, x.illegal, x.cost, x.audit, x.repaired_sha256) for x in frame.collect())


def run(spark, tmp_path, rows):
    spark.createDataFrame([(*x, "own") for x in rows], "conv_id long, turn long, role string, text string, audit string").repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    return as_rows(conversations.op13_conversation_repair(spark, str(tmp_path)))


def test_plans_are_the_cheapest_of_all():
    r = random.Random(4)
    for _ in range(60):
        rows = [(t, r.choice(["system", "user", "assistant", "tool"]), r.choice(["a.", "b", "c!", " ", "a."])) for t in range(r.randrange(0, 4))]
        found = faults(rows)
        assert planned(rows, found) == searched(rows, found)[:2]


def test_conversation_repair(spark, tmp_path):
    r = random.Random(9)
    rows = made(r, 250, 9) + made(r, 2, 300) + [(None, k, "user", "hi.") for k in range(5)] + [(None, None, None, None)] * 3 + [(900, 4, "user", "a.")] * 4
    rows += [(1000 + c, t, role, "well.") for c in range(40) for t, role in enumerate(["user", "assistant"] * 3)]
    got = run(spark, tmp_path, rows)
    assert got == Counter((c, *told(own)) for c, own in damage(rows).items())
    assert run(spark, tmp_path / "none", []) == Counter()


def test_conversation_over_segments_and_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(conversations, "SEGMENT_BITS", 3)
    rows = [(c, t, "user" if t % 2 else "assistant", f"line {t % 50}.") for c in (1, 2) for t in range(700)]
    assert run(spark, tmp_path, rows) == Counter((c, *told(own)) for c, own in damage(rows).items())


def test_conversation_query_on_the_given_table(spark):
    import duckdb

    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF}/conversations.parquet'").fetchall()
    assert as_rows(conversations.op13_conversation_repair(spark, SF)) == Counter((c, *told(own)) for c, own in damage(rows).items())


def test_repaired_rows(spark):
    rows = spark.createDataFrame([(5, 2, "assistant", "yes.", 1), (5, 3, "user", " ", 1), (6, None, "x", "no", 0)], "conv_id long, turn long, role string, text string, copy int")
    told_ = conversations.reports(rows)
    assert sorted((x.conv_id, x.cost, x.audit) for x in told_.collect()) == [(5, 5, "IKD"), (6, 0, "")]
    assert [tuple(x) for x in conversations.repaired(rows, told_).collect()] == [(5, 1, "I", None, "user", ""), (5, 2, "K", 2, "assistant", "yes.")]
