"""Dictionary terms in long texts, found by blocks of words, and long texts rebuilt by pages."""
import random
import re

from quarry.operators import sensitive as X


def _by_hand(text, terms):
    words = [(m.group().lower(), m.start(), m.end()) for m in re.finditer(r"[^\W_]+", text)]
    hits = set()
    for kind, term in terms:
        said = term.lower().split(" ")
        hits |= {(kind, words[i][1], words[i + len(said) - 1][2]) for i in range(len(words) - len(said) + 1) if [w for w, _, _ in words[i:i + len(said)]] == said}
    return {h for h in hits if not any(o[1] <= h[1] and o[2] >= h[2] and o[2] - o[1] > h[2] - h[1] for o in hits)}


def test_terms_across_blocks(spark):
    r = random.Random(3)
    terms = [("GENDER", "aa"), ("PERSON_NAME", "aa"), ("GENDER", "aa bb"), ("PERSON_NAME", "bb aa cc"), ("STREET_ADDRESS", "cc bb aa aa bb"), ("ETHNIC_GROUP", "É4")]
    texts = ["".join(r.choice(["aa", "BB", "cc", "é4", "x", "𝒳y"]) + r.choice([" ", ", ", "\n", "😀 "]) for _ in range(n)) for n in (0, 1, 15, 16, 17, 33, 64, 700)]
    texts += ["  ", None, "aa", " aa bb", "aa"]
    df = spark.createDataFrame(list(enumerate(texts[:-1])) + [(0, texts[-1])], "id int, text string")
    found = X.dictionary_findings(df, "id", "text", spark.createDataFrame(terms, "info_type string, term string"))
    got = sorted((x.id, x.info_type, x.start, x.start + x.length, x.quote) for x in found.collect())
    want = sorted((i, k, a, b, t[a:b]) for i, t in [*enumerate(texts[:-1]), (0, texts[-1])] if t for k, a, b in _by_hand(t, terms))
    assert got == want and len(got) > 200
    # a text is taken apart once
    assert found._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1


def test_long_texts_are_rebuilt_by_pages(spark):
    r = random.Random(5)
    for n in (0, 1, 511, 512, 513, 1024, 5000):
        text = "".join(r.choice("ab😀é \n") for _ in range(n)) + "a@b.co" + "\n" + "𝒳" * r.randrange(600) + " c@d.org"
        df = spark.createDataFrame([(1, f"{text} {text}")], "id int, text string")
        (row,) = X.inspect(df, "id", "text", ["EMAIL_ADDRESS"]).orderBy("start").groupBy().agg({"start": "collect_list", "length": "collect_list"}).collect()
        spans = sorted(zip(row["collect_list(start)"], row["collect_list(length)"]))
        out, at = "", 0
        for a, size in spans:
            out, at = out + f"{text} {text}"[at:a] + "[EMAIL_ADDRESS]", a + size
        out += f"{text} {text}"[at:]
        plan = X.redact_text(df, "text", ["EMAIL_ADDRESS"])
        assert plan.first().text == out and len(spans) == 4
    assert "regexp_extract_all" in plan._jdf.queryExecution().optimizedPlan().toString()
