"""Spans, their clusters and texts rebuilt from them, against brute force; and
the rules that inspection, de-identification, log and guard share."""
import random
import re

import pytest
from pyspark.sql import functions as F

from quarry.functions import spans
from quarry.operators import sensitive as X

PATTERN = r"[0-9]{2,3}"


def test_spans_of_a_pattern(spark):
    r = random.Random(2)
    texts = ["", "12", "é12 漢 345😀67 8", "a" + spans.OPEN + "12" + spans.CLOSE + "34 55", "12 " * 900, None]
    texts += ["".join(r.choices(["1", "23", " ", "é", "😀", "x", "\n", spans.OPEN], k=r.randrange(40))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").withColumn("safe", F.expr(spans.searchable("text")))
    got = {x.id: x.s for x in df.select("id", F.expr(spans.of_pattern("safe", spans.sql_str(f"({PATTERN})"))).alias("s")).collect()}
    for k, t in enumerate(texts):
        if t is not None:
            assert [tuple(s) for s in got[k]] == [m.span() for m in re.finditer(PATTERN, t, re.ASCII)], t[:60]


def merged(found):
    out = []
    for s, e, no, rank in sorted(found):
        if out and s < out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
            out[-1][2].append((rank, e - s, -s, -no))
        else:
            out.append([s, e, [(rank, e - s, -s, -no)]])
    return [(s, e, -max(keys)[3]) for s, e, keys in out]


def test_clusters_and_texts(spark):
    r = random.Random(7)
    rows = []
    for k in range(120):
        n = r.choice([0, 1, 3, 8, 700])
        size = r.choice([10, 60, 4000])
        found = {(a, a + r.randrange(1, 9), r.randrange(1, 4), r.randrange(1, 5)) for a in (r.randrange(size) for _ in range(n))}
        rows.append((k, "".join(r.choices("abé😀", k=size + 10)), list(found)))
    df = spark.createDataFrame(rows, f"id int, text string, s {X.SPANS}")
    key = "named_struct('rank', _x.rank, 'length', _x.end - _x.start, 'left', -_x.start, 'first', -_x.no)"
    out = df.select("id", F.expr(spans.clusters("s", key)).alias("c")).withColumn("c", F.expr("transform(c, x -> struct(x.start, x.end, -x.best.first))"))
    text = df.select("id", F.expr(spans.replaced("text", spans.clusters("s", key), "concat('<', -_c.best.first, '>')")).alias("r"))
    got, texts = {x.id: [tuple(c) for c in x.c] for x in out.collect()}, {x.id: x.r for x in text.collect()}
    for k, t, found in rows:
        assert got[k] == merged(found)
        want, at = "", 0
        for s, e, no in merged(found):
            want, at = want + t[at:s] + f"<{no}>", e
        assert texts[k] == want + t[at:]


def one(spark, text, **kw):
    df = spark.createDataFrame([(1, text)], "id int, text string")
    return df, {(x.info_type, x.quote): x for x in X.inspect(df, "id", "text", **kw).collect()}


def test_context_on_both_sides(spark):
    for text, likely in [("123-45-6789 is my ssn", True), ("ssn 123-45-6789", True), ("123-45-6789\nssn", False), ("ssn" + "." * 40 + "123-45-6789", True),
                         ("ssn" + "." * 41 + "123-45-6789", False), ("123-45-6789" + "." * 41 + "SSN", False), ("123-45-6789" + "." * 40 + "Ssn", True), ("assn 123-45-6789", False)]:
        _, found = one(spark, text, types=["US_SOCIAL_SECURITY_NUMBER"])
        assert found["US_SOCIAL_SECURITY_NUMBER", "123-45-6789"].likelihood == ("LIKELY" if likely else "POSSIBLE"), text
    _, found = one(spark, "é cedula de ciudadania: 1234567", types=["VENEZUELA_CDI_NUMBER", "COLOMBIA_CDC_NUMBER", "PARAGUAY_CIC_NUMBER"])
    assert [(k, v.start, v.length) for k, v in found.items()] == [(("COLOMBIA_CDC_NUMBER", "1234567"), 24, 7)]
    assert ("AGE", "12") in one(spark, "12 years of age")[1] and not one(spark, "room 12 is free")[1]


def test_only_findings_are_replaced(spark):
    df, found = one(spark, "The DOCUMENT has 123456789 rows, card 4111111111111112")
    assert not found
    assert X.redact_text(df, "text").first().text == "The DOCUMENT has 123456789 rows, card 4111111111111112"
    assert X.redaction_log(df, "id", ["text"]).count() == 0
    df, _ = one(spark, "my ssn é 123-45-6789, mail a.b@c.org!")
    assert X.redact_text(df, "text").first().text == "my ssn é [US_SOCIAL_SECURITY_NUMBER], mail [EMAIL_ADDRESS]!"
    rows = [(1, None, "x"), (2, "", "y"), (3, "a@b.co " * 700, None)]
    df = spark.createDataFrame(rows, "id int, text string, _found string")
    out = {x.id: x for x in X.redact_text(df, "text").collect()}
    assert out[1].text is None and out[2].text == "" and out[3].text == "[EMAIL_ADDRESS] " * 700 and out[1]._found == "x"
    assert X.redaction_log(df, "id", ["text", "_found"]).collect() == [(3, "text", "EMAIL_ADDRESS", 700)]


def test_overlapping_findings_are_replaced_as_one(spark):
    # a card number inside a token: the token covers it, both very likely, the longer names it
    df, found = one(spark, "token=abcdefghijklmnop-4111111111111111-x end")
    assert {k for k, _ in found} >= {"AUTH_TOKEN", "CREDIT_CARD_NUMBER"}
    assert X.redact_text(df, "text").first().text == "[AUTH_TOKEN] end"
    assert [tuple(x)[2:] for x in X.redaction_log(df, "id", ["text"]).collect()] == [("AUTH_TOKEN", 1)]


def test_guard_decides_on_findings_of_the_text_as_it_came(spark):
    df = spark.createDataFrame([(1, "room 12 is free"), (2, "he is of age 44"), (3, "mail a@b.co, SECRET plan"), (4, "mail a@b.co"), (5, None), (6, "card 4111111111111112")], "id int, text string")
    rules = [("AGE", "[age]"), (re.compile("SECRET"), "[secret]"), ("CREDIT_CARD_NUMBER", "[card]")]
    got = {x.id: x.text for x in X.block_guard(df, "text", rules).collect()}
    assert got == {1: "room 12 is free", 2: "[age]", 3: "[secret]", 4: "mail a@b.co", 5: None, 6: "card 4111111111111112"}
    got = {x.id: x.text for x in X.block_guard(df, "text", rules, deidentify=["EMAIL_ADDRESS"]).collect()}
    assert got[4] == "mail [EMAIL_ADDRESS]" and got[3] == "[secret]" and got[5] is None
    assert X.block_guard(df, "text", rules, out="g", deidentify=None).columns == ["id", "text", "g"]


TERMS = [("PERSON_NAME", "Mary Ann"), ("PERSON_NAME", "Mary Ann van Dyke"), ("ETHNIC_GROUP", "van"), ("GENDER", "mary"), ("PERSON_NAME", "ann"), ("STREET_ADDRESS", "12 Elm St."), ("GENDER", "MARY ann"), ("GENDER", " - ")]


def test_terms_of_several_words(spark):
    terms = spark.createDataFrame(TERMS, "info_type string, term string")
    rows = [(1, "Dr. MARY  Ann, Van-Dyke"), (2, "mary ann and Ann of 12 elm st"), (3, None), (4, ""), (5, "Maryann van"), (2, "mary")]
    df = spark.createDataFrame(rows, "id int, text string")
    got = sorted(tuple(x) for x in X.dictionary_findings(df, "id", "text", terms).select("id", "info_type", "quote", "start").collect())
    assert got == sorted([(1, "PERSON_NAME", "MARY  Ann, Van-Dyke", 4), (2, "GENDER", "mary ann", 0), (2, "PERSON_NAME", "mary ann", 0), (2, "PERSON_NAME", "Ann", 13),
                          (2, "STREET_ADDRESS", "12 elm st", 20), (5, "ETHNIC_GROUP", "van", 8), (2, "GENDER", "mary", 0)])
    assert X.dictionary_findings(df, "id", "text", terms.limit(0)).count() == 0
    ids = df.filter("id <> 2 OR text <> 'mary'")
    out = {x.id: x.text for x in X.redact_text(ids, "text", ["US_SOCIAL_SECURITY_NUMBER"], terms=terms, ids=["id"]).collect()}
    assert out == {1: "Dr. [PERSON_NAME]", 2: "[GENDER] and [PERSON_NAME] of [STREET_ADDRESS]", 3: None, 4: "", 5: "Maryann [ETHNIC_GROUP]"}
    log = X.redaction_log(ids, "id", ["text"], [], terms=terms).filter("id = 2").collect()
    assert sorted((x.info_type, x.n_transformed) for x in log) == [("GENDER", 1), ("PERSON_NAME", 1), ("STREET_ADDRESS", 1)]
    both = X.inspect(ids, "id", "text", types=["AGE"], terms=terms)
    assert both.filter("info_type = 'PERSON_NAME'").count() == 3 and both.columns == X.inspect(ids, "id", "text").columns


@pytest.mark.parametrize("seed", [1, 2])
def test_terms_against_brute_force(spark, seed):
    r = random.Random(seed)
    words = ["a", "b", "c", "É", "dd"]
    terms = [(r.choice(X.TERM_TYPES), " ".join(r.choices(words, k=r.randrange(1, 5)))) for _ in range(25)]
    texts = [" ".join(r.choices(words + ["zz"], k=r.randrange(0, 60))) for _ in range(40)]
    want = set()
    for k, t in enumerate(texts):
        at = [m.span() for m in re.finditer(r"\w+", t)]
        said = [t[a:b].lower() for a, b in at]
        hits = {(at[i][0], at[i + len(w) - 1][1], ty) for i in range(len(said)) for ty, x in terms for w in [x.lower().split()] if said[i:i + len(w)] == w}
        want |= {(k, ty, t[s:e], s) for s, e, ty in hits if not any(a <= s and e <= b and b - a > e - s for a, b, _ in hits)}
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    out = X.dictionary_findings(df, "id", "text", spark.createDataFrame(terms, "info_type string, term string"))
    got = [(x.id, x.info_type, x.quote, x.start) for x in out.collect()]
    assert len(got) == len(set(got)) and set(got) == want
