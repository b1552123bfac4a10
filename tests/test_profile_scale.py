"""Exact distinct counts beside the approximate ones, and gates that spare values without findings."""
import datetime as dt
import re

from pyspark.sql import functions as F

from quarry.functions import infotypes as I
from quarry.operators import sensitive as X
from quarry.plans import sensitive_plans as P


def test_exact_distinct_counts_by_type(spark, tmp_path):
    begun = dt.datetime(2024, 1, 1)
    rows = [(i, begun + dt.timedelta(microseconds=i), [0.0, -0.0, float("nan"), None][i % 4], f"{i % 9}" * (i % 2 * 99 + 1), [i % 5]) for i in range(400)]
    spark.createDataFrame(rows, "i long, ts timestamp, d double, s string, a array<int>").write.parquet(f"{tmp_path}/t.parquet")
    spark.createDataFrame([(None,)], "only_null string").write.parquet(f"{tmp_path}/u.parquet")
    report = X.profile_tables({n: spark.read.parquet(f"{tmp_path}/{n}.parquet") for n in "tu"})
    near = P._near(spark, str(tmp_path), report, ["t", "u"])
    got = {r.column_name: (r.exact, r.distinct_near) for r in near.collect()}
    assert got == {"i": (400, True), "ts": (400, True), "d": (3, True), "s": (18, True), "a": (5, True), "only_null": (0, True)}
    assert "Expand" not in near._jdf.queryExecution().optimizedPlan().toString()


def test_findings_in_values_without_digits(spark):
    alone = {"EMAIL_ADDRESS": "a@b.co", "ENCRYPTION_KEY": "-----BEGIN PRIVATE KEY-----", "GCP_CREDENTIALS": '"type": "service_account"', "HTTP_COOKIE": "cookie: a=b",
             "AUTH_TOKEN": f"token {'a' * 20}", "XSRF_TOKEN": f"csrftoken={'b' * 16}", "BASIC_AUTH_HEADER": "Authorization: Basic abcd", "MAC_ADDRESS": "aa-bb-cc-dd-ee-ff",
             "JSON_WEB_TOKEN": "eyJa.eyJb.c", "GCP_API_KEY": f"AIza{'c' * 35}", "STORAGE_SIGNED_URL": "https://x.y/?X-Goog-Signature=abc"}
    rows = spark.createDataFrame([*alone.items(), ("", "N"), ("", "plain words only"), ("", "")], "id string, text string")
    found = {(r.id, r.info_type) for r in X.inspect(rows, "id", "text").collect()}
    assert {(n, n) for n in alone} <= found and not any(i == "" for i, _ in found)
    # a value with nothing that any shape needs isn't handed to the detectors
    maybe = I.signals(F.col("text"), [I.BY_NAME[n] for n in X.type_order()])["maybe"]
    assert sorted(r.text for r in rows.filter(~maybe).collect()) == ["", "N", "plain words only"]


def test_context_words_found_as_listed(spark):
    """The words are looked for by first letter: the longest that fits, in either case, as if all were listed."""
    dets = [d for d in I.DETECTORS if d.tier == 3]
    words = sorted({w for d in dets for w in d.context})
    texts = [*words, *[w.upper().replace(" ", " \t") for w in words], "aged age ages", "tax  file tfn", "cedula de identidad cedula de cedula", "Rut,RUN;run_ dniX", ""]
    got = [r.w for r in spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, x string").select("i", I.context_words_found(F.col("x"), dets).alias("w")).orderBy("i").collect()]
    alt = "|".join(w.replace(" ", "[ \\t]+") for w in sorted(words, key=lambda w: (-len(w), w)))
    assert got == [list(dict.fromkeys(re.sub(r"[ \t]+", " ", m.lower()) for m in re.findall(rf"\b({alt})\b", x, re.I | re.A))) for x in texts]
    assert got[:len(words)] == [[w] for w in words]


def test_gates_let_through_all_that_detectors_need(spark):
    """one cheap test a text, which holds wherever a shape's needs may, and nothing else where it doesn't."""
    dets = [I.BY_NAME[n] for n in X.type_order()]
    needed = [x for d in dets for x in I.NEEDS[d.name].get("any", ())]
    texts = [*needed, *[f"ab{x}cd" for x in needed], "x7", "ABCDEF", "aABCDEFa", "Plain Words of a Few Kinds", "I A m", "Yes.", "", None]
    rows = spark.createDataFrame([(x,) for x in texts], "text string")
    sig = I.signals(F.col("text"), dets)
    got = rows.select("text", *[c.alias(k) for k, c in sig.items()], I.maybe_holds(F.col("text"), dets).alias("holds")).collect()
    for r in got:
        own = re.search("[0-9]|[A-Z0-9]{6}", r.text or "") or any(x in (r.text or "") for d in dets if not any(k in I.NEEDS[d.name] for k in I.SIGNALS) for x in I.NEEDS[d.name]["any"])
        assert r.holds == r.maybe and bool(r.holds) >= bool(own)
        assert all(bool(r[k]) == bool(re.search(v, r.text or "")) for k, v in I.SIGNALS.items())
    assert not any(r.holds for r in got[-5:])
