import pytest
from pyspark.sql import functions as F

from quarry.operators import sensitive as X

# invented specimens; card/IBAN/VIN/routing/NPI values are standard check-digit examples
TEXT = [
    (1, "card 4111111111111111 and 4111111111111112"),
    (2, "write to jane.doe@example.org please"),
    (3, "iban GB82WEST12345698765432 vin 1M8GDM9AXKP042788"),
    (4, "my ssn is 123-45-6789, routing 011000015, npi 1234567893"),
    (5, "number 123-45-6789 without a word"),
    (6, "passport number X1234567 issued"),
    (7, "nothing here"),
]


def docs(spark):
    return spark.createDataFrame(TEXT, "id int, text string")


def found(spark, **kw):
    return {(r.id, r.info_type, r.quote): r.likelihood
            for r in X.inspect(docs(spark), "id", "text", **kw).collect()}


def test_checksums_and_shapes(spark):
    f = found(spark, min_likelihood="UNLIKELY")
    assert f[(1, "CREDIT_CARD_NUMBER", "4111111111111111")] == "VERY_LIKELY"
    assert f[(1, "CREDIT_CARD_NUMBER", "4111111111111112")] == "UNLIKELY"
    assert f[(2, "EMAIL_ADDRESS", "jane.doe@example.org")] == "VERY_LIKELY"
    assert f[(3, "IBAN_CODE", "GB82WEST12345698765432")] == "VERY_LIKELY"
    assert f[(3, "VEHICLE_IDENTIFICATION_NUMBER", "1M8GDM9AXKP042788")] == "VERY_LIKELY"
    assert f[(4, "US_BANK_ROUTING_MICR", "011000015")] == "VERY_LIKELY"
    assert f[(4, "US_HEALTHCARE_NPI", "1234567893")] == "VERY_LIKELY"


def test_context_raises_and_requires(spark):
    f = found(spark)
    assert f[(4, "US_SOCIAL_SECURITY_NUMBER", "123-45-6789")] == "LIKELY"
    assert f[(5, "US_SOCIAL_SECURITY_NUMBER", "123-45-6789")] == "POSSIBLE"
    assert f[(6, "PASSPORT", "X1234567")] == "LIKELY"
    assert not any(k[0] == 7 for k in f)
    # default threshold drops the invalid card; the override keeps it
    assert (1, "CREDIT_CARD_NUMBER", "4111111111111112") not in f
    g = found(spark, overrides={"CREDIT_CARD_NUMBER": "UNLIKELY"})
    assert (1, "CREDIT_CARD_NUMBER", "4111111111111112") in g


def test_redaction_leaves_no_match(spark):
    types = ["CREDIT_CARD_NUMBER", "EMAIL_ADDRESS", "US_SOCIAL_SECURITY_NUMBER"]
    for least in ("UNLIKELY", "POSSIBLE"):
        red = X.redact_text(docs(spark), "text", types, min_likelihood=least)
        assert X.inspect(red, "id", "text", types=types, min_likelihood=least).count() == 0
    txt = {r.id: r.text for r in red.collect()}
    assert txt[2] == "write to [EMAIL_ADDRESS] please"


def test_redaction_log(spark):
    def log(least):
        rows = X.redaction_log(docs(spark), "id", ["text"], ["CREDIT_CARD_NUMBER", "EMAIL_ADDRESS"], min_likelihood=least).collect()
        return {(r.id, r.info_type): r.n_transformed for r in rows}

    # as many as are replaced: one of the two card numbers fails its checksum
    assert log("UNLIKELY") == {(1, "CREDIT_CARD_NUMBER"): 2, (2, "EMAIL_ADDRESS"): 1}
    assert log("POSSIBLE") == {(1, "CREDIT_CARD_NUMBER"): 1, (2, "EMAIL_ADDRESS"): 1}


def test_block_guard_last_rule_wins(spark):
    df = spark.createDataFrame([(1, "mail a@b.co card 4111111111111111"), (2, "fine")], "id int, text string")
    out = {r.id: r.text for r in X.block_guard(df, "text", [("EMAIL_ADDRESS", "E"),
                                                            ("CREDIT_CARD_NUMBER", "C")]).collect()}
    assert out == {1: "C", 2: "fine"}


def test_block_guard_names(spark):
    df = spark.createDataFrame([(1, "vin 1M8GDM9AXKP042788"), (2, "fine")], "id int, text string")
    out = {r.id: r.text for r in X.block_guard(df, "text", [("US_VEHICLE_IDENTIFICATION_NUMBER", "V")]).collect()}
    assert out == {1: "V", 2: "fine"}
    for name in ("PERSON_NAME", "NO_SUCH_TYPE"):
        with pytest.raises(ValueError):
            X.block_guard(df, "text", [(name, "N")])
    with pytest.raises(ValueError):
        X.inspect(df, "id", "text", types=["PERSON_NAME"])


def test_profile_and_classify(spark):
    df = docs(spark).withColumn("empty", F.lit(None).cast("string"))
    p = {r.column_name: r for r in X.classify(X.profile(df, "t")).collect()}
    assert p["text"].sensitivity == "HIGH" and p["id"].sensitivity == "UNKNOWN"
    assert p["empty"].sensitivity == "UNKNOWN" and p["text"].n_rows == 7


def test_dictionary_findings(spark):
    terms = spark.createDataFrame([("GENDER", "female")], "info_type string, term string")
    df = spark.createDataFrame([(1, "Gender: Female."), (2, "none")], "id int, text string")
    out = X.dictionary_findings(df, "id", "text", terms).collect()
    assert [(r.id, r.info_type) for r in out] == [(1, "GENDER")]
