r"""Operator 6: personal data.  DataFrame functions only.

Regular expressions propose spans, validators confirm them (Luhn for card
numbers, mod 97 for bank accounts, ranges for addresses, digit counts for
phones), and words near a span adjust its score.  Patterns start only where a
run of their characters starts (or where the last match ended), which leaves
the leftmost matches as they are and keeps long runs linear.

Null texts count as empty; an empty text has no spans; repeated rows and ties
each give their own row; other columns are left alone.  An empty table gives no rows.
Very long texts are searched whole; their spans are placed block by block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

BASE = ("email", "ip", "card", "phone")
#: fixed values: the patterns that propose spans
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)(?![A-Za-z0-9_])",
}
#: fixed values: what a confirmed span scores by itself, and the words that raise it
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.8}
NEAR = {
    "email": r"(?i)mail|contact|write|kontakt|correo",
    "ip": r"(?i)\bip\b|host|server|address|client",
    "card": r"(?i)card|visa|credit|payment|karte|carte|tarjeta",
    "phone": r"(?i)phone|tel|call|mobile|fax|anruf",
    "iban": r"(?i)iban|account|bank|konto|compte|cuenta",
}
#: fixed values: words near a span that speak for a version, part or section number
AGAINST = r"(?i)version|release|build|section|figure|isbn"
CONTEXT, BOOST, CUT = 40, 0.25, 0.3


def mod97(iban: Column) -> Column:
    """The remainder of an account number (no spaces), four leading characters moved last, letters from 10."""
    moved = F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))
    return F.aggregate(F.split(moved, ""), F.lit(0), lambda a, c: F.when(
        c.rlike("^[A-Z]$"), (a * 100 + F.ascii(c) - 55) % 97).when(
        c.rlike("^[0-9]$"), (a * 10 + F.ascii(c) - 48) % 97).otherwise(a))


def valid(kind: str, hit: Column) -> Column:
    digits = F.regexp_replace(hit, "[^0-9]", "")
    if kind == "ip":
        return hit.rlike(r"^(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$")
    if kind == "card":
        return F.length(digits).between(16, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    if kind == "iban":
        return mod97(F.regexp_replace(hit, " ", "")) == 1
    return F.lit(True)


def score(kind: str, s: Column) -> Column:
    near = F.concat_ws(" ", s["before"], s["after"])
    raw = F.lit(PRIOR[kind]) + F.when(near.rlike(NEAR[kind]), BOOST).otherwise(0.0) - F.when(
        near.rlike(AGAINST), CUT).otherwise(0.0)
    return F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), raw)), 2)


def find(docs: DataFrame, text: str = "text", patterns: dict[str, str] = PATTERNS) -> DataFrame:
    """(row, spans): every input row as a struct, and its confirmed spans (kind, start, end, score) by kind, then start."""
    df = docs.select(F.struct("*").alias("row"), C.whole_text(text).alias("_text"))
    df = C.with_spans(df, "_text", patterns, CONTEXT)

    def confirmed(kind: str) -> Column:
        good = F.filter(f"span_{kind}", lambda s: valid(kind, s["hit"]))
        return F.transform(good, lambda s: F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), score(kind, s).alias("score")))

    return df.select("row", F.concat(*[confirmed(k) for k in patterns]).alias("spans"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract rows: counts, digest of the base spans, all spans and their scores, for every document."""
    found = find(C.table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    found = found.select(F.col("row.doc_id").alias("doc_id"), "spans")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc_id", *[count(k) for k in BASE], F.sha2(C.span_text(base), 256).alias("base_sha256"),
        C.span_text(F.col("spans")).alias("spans"), count("iban"),
        F.concat_ws(",", F.transform("spans", lambda s: s["score"].cast("string"))).alias("scores"))
