"""Detectors for the 81 info types of the inspection jobs.

Each detector is a shape (a Java regex kept to ASCII classes, no
look-around and no back-references, so DuckDB's RE2 reads it the same way),
an optional checksum written as a native SQL expression, and optional
context words.  A context word counts when it stands at most CONTEXT_WINDOW
characters before or after the match, with no line end between.  Likelihood
contract:

* tier 1 (``checksum``): VERY_LIKELY when the checksum holds, else UNLIKELY;
* tier 2 (distinctive shape): the detector's base likelihood (POSSIBLE, or
  VERY_LIKELY for self-identifying shapes), raised to LIKELY by a context word;
* tier 3 (number shape + required context word): LIKELY with a context word,
  otherwise not reported;
* tier 4 (dictionary): terms supplied by the user (see
  ``sensitive.dictionary_findings``); off by default.

``findings_sql`` gives every match as a span (start, end, no, rank), ``no``
being the detector's place in the given list.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions import spans
from quarry.functions.spans import sql_str

# The 81 info-type names of the inspection jobs, in alphabetical order.
INFO_TYPES = [
    "ADVERTISING_ID", "AGE", "ARGENTINA_DNI_NUMBER", "AUSTRALIA_TAX_FILE_NUMBER", "AUTH_TOKEN",
    "AWS_CREDENTIALS", "AZURE_AUTH_TOKEN", "BASIC_AUTH_HEADER", "BELGIUM_NATIONAL_ID_CARD_NUMBER",
    "BRAZIL_CPF_NUMBER", "CANADA_SOCIAL_INSURANCE_NUMBER", "CHILE_CDI_NUMBER", "CHINA_RESIDENT_ID_NUMBER",
    "COLOMBIA_CDC_NUMBER", "CREDIT_CARD_NUMBER", "CREDIT_CARD_TRACK_NUMBER", "DATE_OF_BIRTH",
    "DENMARK_CPR_NUMBER", "EMAIL_ADDRESS", "ENCRYPTION_KEY", "ETHNIC_GROUP", "FDA_CODE",
    "FINLAND_NATIONAL_ID_NUMBER", "FRANCE_CNI", "FRANCE_NIR", "FRANCE_TAX_IDENTIFICATION_NUMBER",
    "GCP_API_KEY", "GCP_CREDENTIALS", "GENDER", "GERMANY_IDENTITY_CARD_NUMBER",
    "GERMANY_TAXPAYER_IDENTIFICATION_NUMBER", "HONG_KONG_ID_NUMBER", "HTTP_COOKIE", "IBAN_CODE",
    "IMEI_HARDWARE_ID", "INDIA_AADHAAR_INDIVIDUAL", "INDIA_GST_INDIVIDUAL", "INDIA_PAN_INDIVIDUAL",
    "INDONESIA_NIK_NUMBER", "IRELAND_PPSN", "ISRAEL_IDENTITY_CARD_NUMBER", "JAPAN_INDIVIDUAL_NUMBER",
    "JSON_WEB_TOKEN", "KOREA_RRN", "MAC_ADDRESS", "MEXICO_CURP_NUMBER", "NETHERLANDS_BSN_NUMBER",
    "NORWAY_NI_NUMBER", "PARAGUAY_CIC_NUMBER", "PASSPORT", "PERSON_NAME", "PERU_DNI_NUMBER", "PHONE_NUMBER",
    "POLAND_NATIONAL_ID_NUMBER", "PORTUGAL_CDC_NUMBER", "SCOTLAND_COMMUNITY_HEALTH_INDEX_NUMBER",
    "SINGAPORE_NATIONAL_REGISTRATION_ID_NUMBER", "SPAIN_CIF_NUMBER", "SPAIN_DNI_NUMBER", "SPAIN_NIE_NUMBER",
    "SPAIN_NIF_NUMBER", "SPAIN_SOCIAL_SECURITY_NUMBER", "STORAGE_SIGNED_URL", "STREET_ADDRESS",
    "SWEDEN_NATIONAL_ID_NUMBER", "SWIFT_CODE", "THAILAND_NATIONAL_ID_NUMBER", "TURKEY_ID_NUMBER",
    "UK_NATIONAL_HEALTH_SERVICE_NUMBER", "UK_NATIONAL_INSURANCE_NUMBER", "UK_TAXPAYER_REFERENCE",
    "URUGUAY_CDI_NUMBER", "US_BANK_ROUTING_MICR", "US_EMPLOYER_IDENTIFICATION_NUMBER", "US_HEALTHCARE_NPI",
    "US_INDIVIDUAL_TAXPAYER_IDENTIFICATION_NUMBER", "US_SOCIAL_SECURITY_NUMBER",
    "VEHICLE_IDENTIFICATION_NUMBER", "VENEZUELA_CDI_NUMBER", "WEAK_PASSWORD_HASH", "XSRF_TOKEN",
]

# The likelihood scale, lowest first.
LIKELIHOODS = ["VERY_UNLIKELY", "UNLIKELY", "POSSIBLE", "LIKELY", "VERY_LIKELY"]
RANK = {name: i for i, name in enumerate(LIKELIHOODS)}

CONTEXT_WINDOW = 40


@dataclass(frozen=True)
class Detector:
    name: str
    tier: int
    shape: str = ""
    category: str = "other"
    base: str = "POSSIBLE"
    context: tuple[str, ...] = ()
    checksum: str | None = None          # key into CHECKSUMS
    extra: dict = field(default_factory=dict, compare=False, hash=False)

    def context_regex(self) -> str | None:
        """The context words, at word boundaries; letters match in either case."""
        if not self.context:
            return None
        words = "|".join(w.replace(" ", "[ \\t]+") for w in sorted(self.context, key=lambda w: (-len(w), w)))
        return rf"\b((?i:{words}))\b"


# --------------------------------------------------------------------------
# Checksums as native SQL expressions over a quote (a lambda variable)
# --------------------------------------------------------------------------


def _digits(q: str) -> str:
    return f"regexp_replace({q}, '[^0-9]', '')"


def _luhn(q: str) -> str:
    return f"(luhn_check({_digits(q)}) AND length({_digits(q)}) >= 2)"


def _aba(q: str) -> str:
    d = _digits(q)
    return (f"(length({d}) = 9 AND aggregate(sequence(1, 9), 0, (_acc, _i) -> _acc + "
            f"CAST(substring({d}, _i, 1) AS INT) * element_at(array(3, 7, 1, 3, 7, 1, 3, 7, 1), _i)) % 10 = 0)")


def _npi(q: str) -> str:
    return f"luhn_check(concat('80840', {_digits(q)}))"


def _iban(q: str) -> str:
    s = f"upper(regexp_replace({q}, {sql_str(chr(92) + 's')}, ''))"
    moved = f"concat(substring({s}, 5, 64), substring({s}, 1, 4))"
    vals = (f"transform(filter(split({moved}, ''), _c -> _c != ''), _c -> CAST(CASE WHEN _c RLIKE '^[0-9]$' "
            f"THEN CAST(_c AS INT) ELSE ascii(_c) - 55 END AS BIGINT))")
    return (f"(aggregate({vals}, CAST(0 AS BIGINT), (_acc, _v) -> CASE WHEN _v >= 10 "
            f"THEN (_acc * 100 + _v) % 97 ELSE (_acc * 10 + _v) % 97 END) = 1)")


# VIN transliteration (letters -> digits) and position weights.
VIN_LETTERS = "ABCDEFGHJKLMNPRSTUVWXYZ"
VIN_VALUES = "12345678123457923456789"
VIN_WEIGHTS = [8, 7, 6, 5, 4, 3, 2, 10, 0, 9, 8, 7, 6, 5, 4, 3, 2]


def _vin(q: str) -> str:
    ch = f"substring(upper({q}), _i, 1)"
    val = (f"CASE WHEN {ch} RLIKE '^[0-9]$' THEN CAST({ch} AS INT) ELSE "
           f"CAST(substring('{VIN_VALUES}', instr('{VIN_LETTERS}', {ch}), 1) AS INT) END")
    w = ", ".join(str(x) for x in VIN_WEIGHTS)
    total = f"aggregate(sequence(1, 17), 0, (_acc, _i) -> _acc + {val} * element_at(array({w}), _i))"
    return (f"(substring(upper({q}), 9, 1) = "
            f"CASE WHEN {total} % 11 = 10 THEN 'X' ELSE CAST({total} % 11 AS STRING) END)")


CHECKSUMS = {"luhn": _luhn, "aba": _aba, "npi": _npi, "iban": _iban, "vin": _vin}


# --------------------------------------------------------------------------
# The catalog
# --------------------------------------------------------------------------

D = Detector

DETECTORS: list[Detector] = [
    # tier 1: shape + checksum
    D("CREDIT_CARD_NUMBER", 1, r"\b(?:[0-9]{13,19}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{1,7})\b",
      "financial", checksum="luhn"),
    D("IMEI_HARDWARE_ID", 1, r"\b[0-9]{15}\b", "device", checksum="luhn"),
    D("IBAN_CODE", 1, r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", "financial",
      checksum="iban"),
    D("VEHICLE_IDENTIFICATION_NUMBER", 1, r"\b[A-HJ-NPR-Z0-9]{17}\b", "device", checksum="vin"),
    D("US_BANK_ROUTING_MICR", 1, r"\b[0-9]{9}\b", "financial", checksum="aba"),
    D("US_HEALTHCARE_NPI", 1, r"\b[12][0-9]{9}\b", "national_id", checksum="npi"),
    D("CANADA_SOCIAL_INSURANCE_NUMBER", 1, r"\b[0-9]{3}[ -][0-9]{3}[ -][0-9]{3}\b", "national_id",
      checksum="luhn"),
    # tier 2: distinctive shape
    D("EMAIL_ADDRESS", 2, r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9.-]{1,255}\.[A-Za-z]{2,}", "contact", "VERY_LIKELY"),
    D("PHONE_NUMBER", 2, r"(?:\+[0-9]{1,3}[ .-]?)?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}\b", "contact",
      context=("phone", "tel", "mobile", "call")),
    D("MAC_ADDRESS", 2, r"\b[0-9A-Fa-f]{2}(?:[:-][0-9A-Fa-f]{2}){5}\b", "device", context=("mac",)),
    D("SWIFT_CODE", 2, r"\b[A-Z]{4}[A-Z]{2}[A-Z0-9]{2}(?:[A-Z0-9]{3})?\b", "financial", "UNLIKELY",
      context=("swift", "bic")),
    D("CREDIT_CARD_TRACK_NUMBER", 2, r"%B[0-9]{13,19}\^[A-Za-z /]{2,26}\^[0-9]{4,}|;[0-9]{13,19}=[0-9]{4,}",
      "financial", "VERY_LIKELY"),
    D("US_SOCIAL_SECURITY_NUMBER", 2,
      r"\b(?:00[1-9]|0[1-9][0-9]|[1-5][0-9]{2}|6[0-5][0-9]|66[0-57-9]|6[7-9][0-9]|[78][0-9]{2})"
      r"-(?:0[1-9]|[1-9][0-9])-(?:000[1-9]|00[1-9][0-9]|0[1-9][0-9]{2}|[1-9][0-9]{3})\b",
      "national_id", context=("ssn", "social security")),
    D("US_EMPLOYER_IDENTIFICATION_NUMBER", 2, r"\b[0-9]{2}-[0-9]{7}\b", "national_id",
      context=("ein", "employer")),
    D("US_INDIVIDUAL_TAXPAYER_IDENTIFICATION_NUMBER", 2,
      r"\b9[0-9]{2}-(?:5[0-9]|6[0-5]|7[0-9]|8[0-8]|9[0-24-9])-[0-9]{4}\b", "national_id",
      context=("itin", "taxpayer")),
    D("ADVERTISING_ID", 2, r"\b[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\b",
      "device", context=("idfa", "aaid", "advertising")),
    D("STORAGE_SIGNED_URL", 2, r"https://[^\s\"'<>]+[?&]X-Goog-Signature=[0-9a-fA-F]+", "credential",
      "VERY_LIKELY"),
    D("WEAK_PASSWORD_HASH", 2, r"\$(?:1|apr1)\$[./0-9A-Za-z]{1,8}\$[./0-9A-Za-z]{22}", "credential",
      "VERY_LIKELY"),
    D("AUTH_TOKEN", 2, r"\b(?:[Tt]oken|TOKEN|[Bb]earer)\s*[=:]?\s*\"?[A-Za-z0-9._~+/-]{20,}=*\"?",
      "credential", "VERY_LIKELY"),
    D("AWS_CREDENTIALS", 2, r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b", "credential", "VERY_LIKELY"),
    D("AZURE_AUTH_TOKEN", 2, r"\beyJ0eXAiOiJKV1Qi[A-Za-z0-9_-]*\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", "credential",
      "VERY_LIKELY"),
    D("BASIC_AUTH_HEADER", 2, r"(?i:authorization):\s*(?i:basic)\s+[A-Za-z0-9+/]{4,}=*", "credential",
      "VERY_LIKELY"),
    D("ENCRYPTION_KEY", 2, r"-----BEGIN (?:RSA |EC |DSA |OPENSSH |ENCRYPTED )?PRIVATE KEY-----", "credential",
      "VERY_LIKELY"),
    D("GCP_API_KEY", 2, r"\bAIza[0-9A-Za-z_-]{35}", "credential", "VERY_LIKELY"),
    D("GCP_CREDENTIALS", 2, r"\"type\"\s*:\s*\"service_account\"", "credential", "VERY_LIKELY"),
    D("JSON_WEB_TOKEN", 2, r"\beyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", "credential",
      "VERY_LIKELY"),
    D("HTTP_COOKIE", 2, r"(?i:set-cookie|cookie):\s*[A-Za-z0-9_.-]+=[^;\s]+", "credential"),
    D("XSRF_TOKEN", 2, r"(?i:xsrf|csrf)[_-]?(?i:token)\s*[=:]\s*\"?[A-Za-z0-9_-]{16,}\"?", "credential",
      "VERY_LIKELY"),
    # tier 3: number shape + required context word
    D("AGE", 3, r"\b[0-9]{1,3}\b", "demographic", context=("age", "aged")),
    D("DATE_OF_BIRTH", 3, r"\b[0-9]{1,4}[-/.][0-9]{1,2}[-/.][0-9]{1,4}\b", "demographic",
      context=("birth", "dob", "born")),
    D("PASSPORT", 3, r"\b[A-Z0-9]{6,9}\b", "national_id", context=("passport",)),
    D("FDA_CODE", 3, r"\b[0-9]{4,5}-[0-9]{3,4}-[0-9]{1,2}\b", "other", context=("fda", "ndc")),
    D("ARGENTINA_DNI_NUMBER", 3, r"\b[0-9]{2}\.?[0-9]{3}\.?[0-9]{3}\b", "national_id", context=("dni",)),
    D("AUSTRALIA_TAX_FILE_NUMBER", 3, r"\b[0-9]{3} ?[0-9]{3} ?[0-9]{2,3}\b", "national_id",
      context=("tfn", "tax file")),
    D("BELGIUM_NATIONAL_ID_CARD_NUMBER", 3, r"\b[0-9]{3}-?[0-9]{7}-?[0-9]{2}\b", "national_id",
      context=("identiteitskaart", "carte d'identite", "eid")),
    D("BRAZIL_CPF_NUMBER", 3, r"\b[0-9]{3}\.?[0-9]{3}\.?[0-9]{3}-?[0-9]{2}\b", "national_id", context=("cpf",)),
    D("CHILE_CDI_NUMBER", 3, r"\b[0-9]{1,2}\.?[0-9]{3}\.?[0-9]{3}-?[0-9kK]\b", "national_id",
      context=("rut", "run")),
    D("CHINA_RESIDENT_ID_NUMBER", 3, r"\b[0-9]{17}[0-9Xx]\b", "national_id",
      context=("resident id", "shenfenzheng")),
    D("COLOMBIA_CDC_NUMBER", 3, r"\b[0-9]{6,10}\b", "national_id", context=("cedula de ciudadania",)),
    D("DENMARK_CPR_NUMBER", 3, r"\b[0-3][0-9][01][0-9]{3}-?[0-9]{4}\b", "national_id", context=("cpr",)),
    D("FINLAND_NATIONAL_ID_NUMBER", 3, r"\b[0-3][0-9][01][0-9]{3}[-+A][0-9]{3}[0-9A-Y]\b", "national_id",
      context=("henkilotunnus", "hetu")),
    D("FRANCE_CNI", 3, r"\b[0-9]{12}\b", "national_id", context=("cni", "carte nationale")),
    D("FRANCE_NIR", 3, r"\b[12][0-9]{2}[01][0-9](?:2[AB]|[0-9]{2})[0-9]{6}(?: ?[0-9]{2})?\b", "national_id",
      context=("nir", "securite sociale", "insee")),
    D("FRANCE_TAX_IDENTIFICATION_NUMBER", 3, r"\b[0-3][0-9]{12}\b", "national_id",
      context=("numero fiscal", "spi")),
    D("GERMANY_IDENTITY_CARD_NUMBER", 3, r"\b[CFGHJKLMNPRTVWXYZ0-9]{9}\b", "national_id",
      context=("personalausweis",)),
    D("GERMANY_TAXPAYER_IDENTIFICATION_NUMBER", 3, r"\b[0-9]{11}\b", "national_id",
      context=("steuer", "idnr")),
    D("HONG_KONG_ID_NUMBER", 3, r"\b[A-Z]{1,2}[0-9]{6}\(?[0-9A]\)?", "national_id", context=("hkid",)),
    D("INDIA_AADHAAR_INDIVIDUAL", 3, r"\b[2-9][0-9]{3} ?[0-9]{4} ?[0-9]{4}\b", "national_id",
      context=("aadhaar",)),
    D("INDIA_GST_INDIVIDUAL", 3, r"\b[0-9]{2}[A-Z]{5}[0-9]{4}[A-Z][1-9A-Z]Z[0-9A-Z]\b", "national_id",
      context=("gst",)),
    D("INDIA_PAN_INDIVIDUAL", 3, r"\b[A-Z]{3}P[A-Z][0-9]{4}[A-Z]\b", "national_id", context=("pan",)),
    D("INDONESIA_NIK_NUMBER", 3, r"\b[0-9]{16}\b", "national_id", context=("nik",)),
    D("IRELAND_PPSN", 3, r"\b[0-9]{7}[A-W][A-IW]?\b", "national_id", context=("ppsn", "pps")),
    D("ISRAEL_IDENTITY_CARD_NUMBER", 3, r"\b[0-9]{9}\b", "national_id", context=("teudat zehut", "israel id")),
    D("JAPAN_INDIVIDUAL_NUMBER", 3, r"\b[0-9]{4} ?[0-9]{4} ?[0-9]{4}\b", "national_id",
      context=("my number", "kojin bango")),
    D("KOREA_RRN", 3, r"\b[0-9]{6}-[1-4][0-9]{6}\b", "national_id", context=("rrn", "resident registration")),
    D("MEXICO_CURP_NUMBER", 3, r"\b[A-Z][AEIOUX][A-Z]{2}[0-9]{6}[HM][A-Z]{5}[0-9A-Z][0-9]\b", "national_id",
      context=("curp",)),
    D("NETHERLANDS_BSN_NUMBER", 3, r"\b[0-9]{9}\b", "national_id", context=("bsn", "burgerservicenummer")),
    D("NORWAY_NI_NUMBER", 3, r"\b[0-3][0-9][01][0-9]{3} ?[0-9]{5}\b", "national_id",
      context=("fodselsnummer",)),
    D("PARAGUAY_CIC_NUMBER", 3, r"\b[0-9]{6,7}\b", "national_id", context=("cic",)),
    D("PERU_DNI_NUMBER", 3, r"\b[0-9]{8}\b", "national_id", context=("dni",)),
    D("POLAND_NATIONAL_ID_NUMBER", 3, r"\b[0-9]{11}\b", "national_id", context=("pesel",)),
    D("PORTUGAL_CDC_NUMBER", 3, r"\b[0-9]{8} ?[0-9] ?[A-Z]{2}[0-9]\b", "national_id",
      context=("cartao de cidadao",)),
    D("SCOTLAND_COMMUNITY_HEALTH_INDEX_NUMBER", 3, r"\b[0-3][0-9][01][0-9]{7}\b", "national_id",
      context=("chi",)),
    D("SINGAPORE_NATIONAL_REGISTRATION_ID_NUMBER", 3, r"\b[STFGM][0-9]{7}[A-Z]\b", "national_id",
      context=("nric",)),
    D("SPAIN_CIF_NUMBER", 3, r"\b[ABCDEFGHJNPQRSUVW][0-9]{7}[0-9A-J]\b", "national_id", context=("cif",)),
    D("SPAIN_DNI_NUMBER", 3, r"\b[0-9]{8}-?[A-Z]\b", "national_id", context=("dni",)),
    D("SPAIN_NIE_NUMBER", 3, r"\b[XYZ]-?[0-9]{7}-?[A-Z]\b", "national_id", context=("nie",)),
    D("SPAIN_NIF_NUMBER", 3, r"\b[0-9XYZKLM][0-9]{7}-?[A-Z]\b", "national_id", context=("nif",)),
    D("SPAIN_SOCIAL_SECURITY_NUMBER", 3, r"\b[0-9]{2}/?[0-9]{8}/?[0-9]{2}\b", "national_id",
      context=("seguridad social", "nss")),
    D("SWEDEN_NATIONAL_ID_NUMBER", 3, r"\b(?:[0-9]{2})?[0-9]{6}[-+]?[0-9]{4}\b", "national_id",
      context=("personnummer",)),
    D("THAILAND_NATIONAL_ID_NUMBER", 3, r"\b[0-9] ?[0-9]{4} ?[0-9]{5} ?[0-9]{2} ?[0-9]\b", "national_id",
      context=("thai id",)),
    D("TURKEY_ID_NUMBER", 3, r"\b[1-9][0-9]{10}\b", "national_id", context=("kimlik",)),
    D("UK_NATIONAL_HEALTH_SERVICE_NUMBER", 3, r"\b[0-9]{3} ?[0-9]{3} ?[0-9]{4}\b", "national_id",
      context=("nhs",)),
    D("UK_NATIONAL_INSURANCE_NUMBER", 3,
      r"\b[A-CEGHJ-PR-TW-Z][A-CEGHJ-NPR-TW-Z] ?[0-9]{2} ?[0-9]{2} ?[0-9]{2} ?[A-D]\b", "national_id",
      context=("national insurance", "nino")),
    D("UK_TAXPAYER_REFERENCE", 3, r"\b[0-9]{5} ?[0-9]{5}\b", "national_id", context=("utr",)),
    D("URUGUAY_CDI_NUMBER", 3, r"\b[0-9]\.?[0-9]{3}\.?[0-9]{3}-?[0-9]\b", "national_id",
      context=("cedula de identidad",)),
    D("VENEZUELA_CDI_NUMBER", 3, r"\b[VE]-?[0-9]{6,8}\b", "national_id", context=("cedula",)),
    # tier 4: dictionary (terms supplied by the user)
    D("PERSON_NAME", 4, category="contact"),
    D("STREET_ADDRESS", 4, category="contact"),
    D("GENDER", 4, category="demographic"),
    D("ETHNIC_GROUP", 4, category="demographic"),
]

BY_NAME = {d.name: d for d in DETECTORS}
ALL_TYPES = [d.name for d in DETECTORS]
#: Other names that block rules use.
SYNONYMS = {"US_VEHICLE_IDENTIFICATION_NUMBER": "VEHICLE_IDENTIFICATION_NUMBER"}
PATTERN_TYPES = [d.name for d in DETECTORS if d.tier < 4]
assert sorted(BY_NAME) == INFO_TYPES, "detector catalog must cover exactly the 81 info types"

# Necessary conditions (exact, never lossy): a detector's shape cannot match
# a text unless these hold, so the regex only runs where they do.
#   digit  -- the text holds a digit
#   run    -- the text holds a run of three digits
#   caps   -- the text holds a run of six capitals or digits
#   any    -- one of these literals occurs
NEEDS: dict[str, dict] = {
    "CREDIT_CARD_NUMBER": {"run": True},
    "IMEI_HARDWARE_ID": {"run": True},
    "IBAN_CODE": {"digit": True},
    "VEHICLE_IDENTIFICATION_NUMBER": {"caps": True},
    "US_BANK_ROUTING_MICR": {"run": True},
    "US_HEALTHCARE_NPI": {"run": True},
    "CANADA_SOCIAL_INSURANCE_NUMBER": {"run": True},
    "EMAIL_ADDRESS": {"any": ("@",)},
    "PHONE_NUMBER": {"run": True},
    "MAC_ADDRESS": {"any": (":", "-")},
    "SWIFT_CODE": {"caps": True},
    "CREDIT_CARD_TRACK_NUMBER": {"run": True, "any": ("%B", "=")},
    "US_SOCIAL_SECURITY_NUMBER": {"run": True, "any": ("-",)},
    "US_EMPLOYER_IDENTIFICATION_NUMBER": {"run": True, "any": ("-",)},
    "US_INDIVIDUAL_TAXPAYER_IDENTIFICATION_NUMBER": {"run": True, "any": ("-",)},
    "ADVERTISING_ID": {"any": ("-",)},
    "STORAGE_SIGNED_URL": {"any": ("X-Goog-Signature=",)},
    "WEAK_PASSWORD_HASH": {"any": ("$1$", "$apr1$")},
    "AUTH_TOKEN": {"any": ("oken", "OKEN", "earer")},
    "AWS_CREDENTIALS": {"any": ("AKIA", "ASIA")},
    "AZURE_AUTH_TOKEN": {"any": ("eyJ0eXAiOiJKV1Qi",)},
    "BASIC_AUTH_HEADER": {"any": (":",)},
    "ENCRYPTION_KEY": {"any": ("-----BEGIN ",)},
    "GCP_API_KEY": {"any": ("AIza",)},
    "GCP_CREDENTIALS": {"any": ('"service_account"',)},
    "JSON_WEB_TOKEN": {"any": ("eyJ",)},
    "HTTP_COOKIE": {"any": (":",)},
    "XSRF_TOKEN": {"any": ("=", ":")},
    "PASSPORT": {"caps": True},
    "GERMANY_IDENTITY_CARD_NUMBER": {"caps": True},
}
# every other tier-3 shape holds a digit
for _d in DETECTORS:
    if _d.tier == 3:
        NEEDS.setdefault(_d.name, {"digit": True})


SIGNALS = {"digit": "[0-9]", "run": "[0-9]{3}", "caps": "[A-Z0-9]{6}"}


def maybe_holds(text: Column, detectors: list[Detector]) -> Column:
    """Whether a text may hold a digit, six capitals or a literal that one of
    ``detectors`` can't do without: by a class of the characters (one of a literal's
    that is no letter), by a capital after a capital (or after a letter that one
    follows in a literal), and by the literals in small letters."""
    literals = sorted({x for d in detectors if not any(k in NEEDS[d.name] for k in SIGNALS) for x in NEEDS[d.name]["any"]})
    chars, before, small = set(), set(), []
    for x in literals:
        other = [c for c in x if not (c.isalpha() or c.isdigit())]
        capital = [i for i in range(1, len(x)) if "A" <= x[i] <= "Z"]
        if other:
            chars.add(max(other))
        elif capital:
            before.add(x[capital[0] - 1])
        else:
            small.append(x)
    single = "".join(f"\\{c}" for c in sorted(chars))
    pair = "".join(sorted(c for c in before if not "A" <= c <= "Z"))
    return reduce(lambda a, b: a | b, [text.rlike(f"[0-9{single}]"), text.rlike(f"[A-Z{pair}][A-Z]"), *map(text.contains, small)])


def signals(text: Column, detectors: list[Detector]) -> dict[str, Column]:
    """What the gates read, to be computed once per text; ``maybe``: whether the
    needs of any of ``detectors`` may hold at all, most short values' don't, and
    nothing else is looked for in those."""
    maybe = maybe_holds(text, detectors)
    return {k: F.when(maybe, text.rlike(v)).otherwise(False) for k, v in SIGNALS.items()} | {"maybe": maybe}


def gate_sql(text: str, det: Detector, sig: dict[str, str]) -> str:
    """The necessary condition of ``det`` as SQL over the text column and
    the signal columns."""
    need = NEEDS[det.name]
    out = [sig[k] for k in SIGNALS if need.get(k)]
    if need.get("any"):
        out.append("(" + " OR ".join(f"contains({text}, {sql_str(x)})" for x in need["any"]) + ")")
    return " AND ".join(out)


# Categories that make a column "high" sensitivity when found at LIKELY+.
HIGH_CATEGORIES = ("credential", "financial", "national_id")


def likelihood_name(rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in LIKELIHOODS]), rank + 1)


def context_words_found(text: Column, detectors: list[Detector]) -> Column:
    """The distinct context words present in a text, from one scan with an
    alternation of every detector's words.  Detectors whose words are
    absent don't search the text for their shape."""
    words = sorted({w for d in detectors for w in d.context}, key=lambda w: (-len(w), w))
    if not words:
        return F.array().cast("array<string>")
    begun: dict[str, list[str]] = {}
    for w in words:  # by first letter, so that a letter is held against few words; longest first within each
        begun.setdefault(w[0], []).append(w[1:].replace(" ", "[ \\t]+"))
    alt = "|".join(f"[{c}{c.upper()}](?:{'|'.join(rest)})" for c, rest in sorted(begun.items()))
    found = F.regexp_extract_all(text, F.lit(rf"\b((?i:{alt}))\b"), 1)
    return F.array_distinct(F.transform(found, lambda w: F.regexp_replace(F.lower(w), r"[ \t]+", " ")))


def _words_sql(det: Detector, detectors: list[Detector]) -> str:
    """Words whose presence lets ``det`` have context: its own, and those of
    others that hold one of its own (the scan finds the longest)."""
    own = {w for w in det.context}
    own |= {w for d in detectors for w in d.context if any(f" {x} " in f" {w} " for x in det.context)}
    return f"array({', '.join(sql_str(w) for w in sorted(own))})"


def _by_no(detectors: list[Detector], value) -> str:
    return f"element_at(array({', '.join(value(d) for d in detectors)}), _h.no)"


def findings_sql(raw: str, text: str, detectors: list[Detector], ctx: str, sig: dict[str, str]) -> str:
    """array<struct<start, end, no, rank>> of all matches of ``detectors``, as
    one SQL text.  ``raw`` is the text, ``text`` its searchable form, ``ctx``
    the column of ``context_words_found``, ``sig`` those of ``signals``."""
    hits, spoken = [], []
    for no, d in enumerate(detectors, 1):
        gate = gate_sql(raw, d, sig)
        if d.tier == 3:
            gate += f" AND arrays_overlap({ctx}, {_words_sql(d, detectors)})"
        hit = f"CASE WHEN {gate} AND {text} RLIKE {sql_str(d.shape)} THEN named_struct('no', {no}, 'parts', {spans.parts(text, sql_str('(' + d.shape + ')'))}) END"
        (spoken if d.tier == 3 else hits).append(hit)
    nothing = "CAST(array() AS array<struct<no:int,parts:array<string>>>)"
    hits = f"array({', '.join(hits)})" if hits else nothing
    if spoken:  # none of them without a context word
        hits = f"concat({hits}, CASE WHEN size({ctx}) > 0 THEN array({', '.join(spoken)}) ELSE {nothing} END)"
    quote = f"substring({raw}, _v.start + 1, _v.end - _v.start)"
    near = (f"((_w.end <= _v.start AND _v.start - _w.end <= {CONTEXT_WINDOW} AND NOT contains(substring({raw}, _w.end + 1, _v.start - _w.end), '\n'))"
            f" OR (_w.start >= _v.end AND _w.start - _v.end <= {CONTEXT_WINDOW} AND NOT contains(substring({raw}, _v.end + 1, _w.start - _v.end), '\n')))")
    words = _by_no(detectors, lambda d: sql_str(d.context_regex()) if d.context and RANK[d.base] < RANK["LIKELY"] and d.tier > 1 else "CAST(NULL AS STRING)")
    base = _by_no(detectors, lambda d: "-1" if d.tier == 3 else str(RANK[d.base]))
    checks = " ".join(f"WHEN {sql_str(kind)} THEN CASE WHEN {CHECKSUMS[kind]('_q')} THEN {RANK['VERY_LIKELY']} ELSE {RANK['UNLIKELY']} END"
                      for kind in sorted({d.checksum for d in detectors if d.checksum}))
    rank = f"CASE WHEN exists(_c, _w -> {near}) THEN greatest(_base, {RANK['LIKELY']}) ELSE _base END"
    if checks:
        kind = _by_no(detectors, lambda d: sql_str(d.checksum) if d.checksum else "CAST(NULL AS STRING)")
        rank = f"CASE WHEN _kind IS NULL THEN {rank} ELSE {spans.let('_q', quote, f'CASE _kind {checks} END')} END"
    item = f"named_struct('start', _v.start, 'end', _v.end, 'no', _h.no, 'rank', {rank})"
    found = f"transform({spans.of_parts('_h.parts')}, _v -> {item})"
    if checks:
        found = spans.let("_kind", kind, found)
    none = "CAST(array() AS array<struct<start:int,end:int>>)"
    found = spans.let("_base", base, spans.let("_c", f"CASE WHEN {words} IS NULL THEN {none} ELSE {spans.of_pattern(text, words)} END", found))
    return f"CASE WHEN {sig['maybe']} THEN filter(flatten(transform(filter({hits}, _h -> size(_h.parts) > 1), _h -> {found})), _f -> _f.rank >= 0) END"
