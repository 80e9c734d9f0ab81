"""Personal data: patterns propose, checksums confirm, context decides.

Base kinds (email, ip, card, phone) are decided by pattern and checksum alone
and always stay.  Two kinds are added: account numbers, which must leave 1
modulo 97 and go where the words nearby speak of a serial number or an example
and not of an account, and nine-digit identity numbers, which stay only with a
context word nearby.  All of it is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import text_or_empty
from millrace.llm.spans import Kind, accounts, digits_of, find_spans, joined, luhn


def _small_parts(match):
    # a part of zeros only is 0: the zeros before the last digit may go
    part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    return match.rlike(rf"^{part}(?:\.{part}){{3}}$")


KINDS = [
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", ("@",)),
    Kind("ip", r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", (), _small_parts),
    # a whole run of digits with single separators, told apart from its
    # neighbours by looking at what stands before and behind
    Kind("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){15,18}+(?![\x20-]?[0-9])", (), luhn),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", ("+",), lambda m: F.length(digits_of(m)).between(8, 15)),
    # whatever may belong to a number and the rest of the last word; the numbers
    # in it end where the checksum says
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?+[A-Z0-9])++[A-Za-z0-9]*+", parts=accounts, base=False, score=0.7, context=r"\b(?:iban|account|konto|compte|cuenta)", against=r"\b(?:serial|order|invoice|tracking|part|example|sample|test)\b"),
    Kind("ssn", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", ("-",), None, base=False, score=0.3, context=r"\b(?:ssn|social security|sozialversicherung|s[eé]curit[eé] sociale|seguridad social)\b", against=r"\b(?:example|sample|test)\b"),
]


def find_pii(docs: DataFrame, kinds: list[Kind] = KINDS) -> DataFrame:
    """doc_id and one column of spans (start, end, match, score) per kind, for every
    row of ``docs`` (doc_id, text).

    Positions are code points, the end exclusive.  A null text counts as empty
    and has no spans; a null doc_id stays null; repeated rows repeat; further
    columns of ``docs`` are dropped, so their names cannot clash.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().cast("string").alias("body"))
    return find_spans(rows, "body", kinds).drop("body")


def _masked(name: str, mask: str):
    return F.transform(F.col(name), lambda s: F.struct(s["start"].alias("s"), (-s["end"]).alias("e"), F.lit(mask).alias("m")))


def redact(docs: DataFrame, mask: str = "[{}]") -> DataFrame:
    """(doc_id, text) with every span replaced by its kind in ``mask``; where
    spans overlap, the one that starts first is replaced and covers the rest."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().cast("string").alias("body"))
    found = find_spans(rows, "body", KINDS)
    spans = F.sort_array(F.concat(*[_masked(k.name, mask.format(k.name)) for k in KINDS]))

    def step(acc, x):
        fits = x["s"] >= acc["at"]
        gap = F.substr(F.col("body"), acc["at"] + 1, x["s"] - acc["at"])
        return F.struct(F.when(fits, -x["e"]).otherwise(F.greatest(acc["at"], -x["e"])).alias("at"), F.when(fits, F.concat(acc["out"], gap, x["m"])).otherwise(acc["out"]).alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    text = F.aggregate(spans, begin, step, lambda acc: F.concat(acc["out"], F.substr(F.col("body"), acc["at"] + 1)))
    return found.select("doc_id", text.alias("text"))


def pii_report(docs: DataFrame) -> DataFrame:
    """The digest of op7: counts of the base kinds, SHA-256 of the base spans
    and all spans as text."""
    base = [k for k in KINDS if k.base]
    found = find_pii(docs)
    counts = [F.size(k.name).cast("bigint").alias(f"n_{k.name}") for k in base]
    return found.select("doc_id", *counts, F.sha2(joined(base, False), 256).alias("base_sha256"), joined(KINDS, False).alias("spans"))
