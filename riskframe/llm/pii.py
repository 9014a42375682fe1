"""Personal data: regular expressions propose, checksums confirm, context words score (operator 1).

Every step is a column expression.  ``split`` yields the text between the
matches that ``regexp_extract_all`` yields with the same pattern, so running
lengths give each match's code-point offsets.  The base kinds keep the
leftmost, non-overlapping matches of the contract; possessive quantifiers and
look-behinds only spare the engine from retrying inside a run of characters
(a run that fails at its start fails at each later start too), which keeps
very long runs linear and free of recursion.

Added kinds: ``iban`` (length by country code, ISO 7064 mod-97), ``ssn`` and ``secret`` (hexadecimal
keys), the last two only where a context word confirms them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed patterns of the base kinds.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Length of an IBAN by country code.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
_IBAN = "|".join(rf"(?:{'|'.join(codes.split())})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, codes in IBAN_LENGTHS.items())
ADDED = {
    # Only the country code is consumed, so every start is tested and no failed one hides the next.
    "iban": rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?=({_IBAN})(?![A-Za-z0-9]))[A-Z]{{2}}",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    # One case throughout, 32 hexadecimal digits or more, a letter and a digit among them.
    "secret": r"(?<![0-9A-Za-z])(?=[0-9]*[A-Fa-f])(?=[A-Fa-f]*[0-9])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![0-9A-Za-z])",
}
KINDS = {**BASE, **ADDED}
#: Kinds whose text is a group of the pattern, with the number of characters that the pattern consumes.
AHEAD = {"iban": 2}
#: A character without which a kind cannot occur.
HINT = {"email": "@", "phone": "+", "ip": "."}
#: Prior score of a confirmed match, and the words nearby that raise it.
PRIOR = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.5, "iban": 0.8, "ssn": 0.3, "secret": 0.3}
CONTEXT = {
    "email": r"mail|contact|write|kontakt|correo|courriel",
    "ip": r"\bip\b|host|server|address|adresse",
    "card": r"card|visa|credit|karte|carte|tarjeta",
    "phone": r"phone|call|tel|fax|mobile|anruf",
    "iban": r"iban|bank|account|konto|compte|cuenta",
    "ssn": r"ssn|social|security",
    "secret": r"key|token|secret|password|passwd|api",
}
CONTEXT_CHARS, CONTEXT_GAIN, THRESHOLD = 40, 0.2, 0.5
_SPAN = "array<struct<start:int,rank:int,end:int,kind:string,score:double>>"


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _mod97(x: Column) -> Column:
    """Remainder of an IBAN rearranged as a number, folded one character at a time."""
    flat = F.regexp_replace(x, " ", "")
    moved = F.split(F.concat(F.substring(flat, 5, 64), F.substring(flat, 1, 4)), "(?!^)(?!$)")
    value = lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    return F.aggregate(moved, F.lit(0), lambda a, c: (a * F.when(c.rlike("[0-9]"), 10).otherwise(100) + value(c)) % 97)


def _confirmed(kind: str, x: Column) -> Column:
    part = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
    if kind == "ip":
        return x.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        d = _digits(x)
        return F.when(F.length(d).between(12, 19), F.call_function("luhn_check", d)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(x)).between(9, 15)
    if kind == "iban":
        return _mod97(x) == 1
    return F.lit(True)


def _spans(kind: str, rank: int, matches: str, gaps: str) -> Column:
    """Confirmed spans of one kind from its matches and the pieces between them."""
    n = F.size(matches)
    pieces = F.arrays_zip(F.col(matches).alias("m"), F.slice(gaps, F.lit(1), n).alias("before"),
                          F.slice(gaps, F.lit(2), n).alias("after"))
    taken = lambda p: F.lit(AHEAD[kind]) if kind in AHEAD else F.length(p["m"])
    after = lambda p: (F.substring(p["after"], F.length(p["m"]) - taken(p) + 1, F.lit(CONTEXT_CHARS)) if kind in AHEAD
                       else F.left(p["after"], F.lit(CONTEXT_CHARS)))
    near = lambda p: F.lower(F.concat_ws(" ", F.right(p["before"], F.lit(CONTEXT_CHARS)), after(p)))
    def step(acc, p):
        start = acc["at"] + F.length(p["before"])
        end = start + F.length(p["m"])
        score = F.lit(PRIOR[kind]) + F.when(near(p).rlike(CONTEXT[kind]), CONTEXT_GAIN).otherwise(0.0)
        ok = _confirmed(kind, p["m"]) & (F.lit(kind in BASE) | (score >= THRESHOLD))
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"),
                        score.alias("score"))
        return F.struct((start + taken(p)).alias("at"), F.when(ok, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))
    return F.when(n > 0, F.aggregate(pieces, start, step, lambda a: a["out"])).otherwise(F.array().cast(_SPAN))


def with_spans(docs: DataFrame, text: str = "text", out: str = "pii_spans") -> DataFrame:
    """Add ``out``: all spans by (start, kind order).  NULL texts are empty.  Names starting ``_pii_`` are reserved."""
    body = F.coalesce(F.col(text), F.lit(""))
    found = docs
    for kind, pattern in KINDS.items():
        has = F.contains(body, F.lit(HINT[kind])) if kind in HINT else F.lit(True)
        found = found.withColumn(f"_pii_m_{kind}", F.when(has, F.regexp_extract_all(
            body, F.lit(pattern), F.lit(int(kind in AHEAD)))))
    for kind, pattern in KINDS.items():
        m = f"_pii_m_{kind}"
        found = found.withColumn(f"_pii_g_{kind}", F.when(F.size(m) > 0, F.split(body, pattern, -1)))
    spans = F.concat(*(_spans(kind, i, f"_pii_m_{kind}", f"_pii_g_{kind}") for i, kind in enumerate(KINDS)))
    return found.withColumn(out, F.array_sort(spans)).drop(
        *(f"_pii_{x}_{kind}" for kind in KINDS for x in "mg"))


def joined(spans: Column, *fields: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", *(s[f].cast("string") for f in fields))), ",")


def find_pii(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, the base counts, base_sha256, spans, scores, pii_spans.

    Only ``doc_id`` and ``text`` are read, so other columns may have any name;
    NULL and empty texts have no spans; repeated rows give equal rows; an
    empty table gives an empty result.
    """
    base = lambda s: F.filter(s, lambda x: x["kind"].isin(*BASE))
    spans = F.col("pii_spans")
    count = lambda kind: F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return with_spans(docs.select("doc_id", "text")).select(
        "doc_id", *(count(k) for k in BASE),
        F.sha2(joined(base(spans), "kind", "start", "end"), 256).alias("base_sha256"),
        joined(spans, "kind", "start", "end").alias("spans"), joined(spans, "kind", "start", "score").alias("scores"),
        "pii_spans")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """Replace every span (overlapping ones as one, named by the first) with ``<KIND>``; other columns stay."""
    marked = with_spans(docs, text, "_pii_spans")
    body = F.col(text)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    def step(acc, s):
        piece = F.concat(acc["out"], F.array(F.substring(body, acc["at"] + 1, s["start"] - acc["at"]),
                                             F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">"))))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(s["start"] < acc["at"], acc["out"]).otherwise(piece).alias("out"))
    masked = F.aggregate("_pii_spans", start, step, lambda a: F.concat(
        F.array_join(a["out"], ""), F.substring(body, a["at"] + 1, F.length(body))))
    return marked.withColumn(text, F.when(F.size("_pii_spans") > 0, masked).otherwise(body)).drop("_pii_spans")
