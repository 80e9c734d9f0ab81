"""Secret scanning over a ledger of blobs.

Every version of every document is content-addressed.  The ledger holds one row
per blob and rule version that was ever scanned, with what was found; a run
scans only pairs that the ledger does not have, one copy of each blob, appends
the outcome, and joins the findings back to every path and version that has the
blob.
Raising a rule's version makes just that rule run again.  All of it is
DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import join_spread, materialize, scratch, text_or_empty
from millrace.llm.spans import SPAN, Kind, find_spans, joined

ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?+\x20*+[:=]\x20*+["']?+([A-Za-z0-9+/_.=-]++)"""
RULES = [
    Kind("assign", ASSIGN, (), lambda m: F.length(F.regexp_extract(m, ASSIGN, 1)) >= 6),
    Kind("access", r"AKIA[A-Z0-9]{16,}+", ("AKIA",)),
    Kind("hex", r"(?<![0-9a-f])[0-9a-f]{24,}+", ()),
    Kind("pem", r"-----BEGIN (?:[A-Z]{1,12} ){0,3}PRIVATE KEY-----", ("PRIVATE KEY-----",), base=False),
    Kind("jwt", r"\beyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{16,}+", ("eyJ",), base=False),
]
LEDGER = f"blob string, rule string, version int, spans {SPAN}"


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """Rows (blob, rule, version, spans) scanned so far; none if it is new."""
    try:
        return spark.read.schema(LEDGER).parquet(ledger)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], LEDGER)


def scan(docs: DataFrame, ledger: str, rules: list[Kind] = RULES, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Scan the blobs of ``docs`` (``keys``, text) that ``ledger`` lacks, append
    to it, and return the keys, blob and one span column per rule.

    ``keys`` name a row: doc_id, or path and version in a history.  Positions
    are code points, the end exclusive.  A null text is the empty blob; null
    keys stay null; repeated rows repeat; an empty table scans nothing; further
    columns are ignored, and no key may be named after a rule.
    """
    spark = docs.sparkSession
    key = F.struct(*[F.col(k).cast("bigint").alias(k) if k == "doc_id" else F.col(k) for k in keys]).alias("key")
    rows = docs.select(key, text_or_empty().cast("string").alias("body")).withColumn("blob", F.sha2("body", 256))
    placed = materialize(rows.select("key", "blob"), "ledger-rows")
    current = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version")) for r in rules])
    known = read_ledger(spark, ledger).groupBy("blob").agg(F.collect_set(F.struct("rule", "version")).alias("seen"))
    # one row stands for its blob; the ledger says which rules it still needs
    blobs = placed.groupBy("blob").agg(F.min("key").alias("first"))
    todo = blobs.join(known, "blob", "left").withColumn("todo", F.when(F.col("seen").isNull(), current).otherwise(F.array_except(current, F.col("seen")))).where(F.size("todo") > 0)
    todo = todo.select(F.col("blob").alias("b"), "first", F.transform("todo", lambda p: p["rule"]).alias("todo"))
    picked = rows.join(todo.hint("shuffle_hash"), (rows["blob"] == todo["b"]) & rows["key"].eqNullSafe(todo["first"])).select("blob", "body", "todo")
    found = find_spans(picked, "body", rules, lambda r: F.array_contains("todo", F.lit(r.name)))
    pairs = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version"), F.col(r.name).alias("spans")) for r in rules])
    fresh_rows = found.select("blob", F.explode(F.filter(pairs, lambda p: F.array_contains(F.col("todo"), p["rule"]))).alias("p")).select("blob", "p.rule", "p.version", "p.spans")
    fresh_rows.write.mode("append").option("compression", "zstd").parquet(ledger)

    versions = [F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version")) for r in rules]
    valid = read_ledger(spark, ledger).where(F.struct("rule", "version").isin(versions))
    # a repeated row may have been scanned twice: any of them will do
    by_blob = valid.groupBy("blob").agg(*[F.max(F.when(F.col("rule") == r.name, F.col("spans"))).alias(r.name) for r in rules])
    back = join_spread(placed, by_blob, "blob", how="left")
    return back.select("key.*", "blob", *[F.coalesce(r.name, F.array().cast(SPAN)).alias(r.name) for r in rules])


def scan_history(history: DataFrame, ledger: str, rules: list[Kind] = RULES) -> DataFrame:
    """Findings in every version of every path of ``history`` (path, version,
    text): path, version, blob, rule, start, end, match.  A blob that stands
    under many paths and versions is scanned once."""
    found = scan(history, ledger, rules, ("path", "version"))
    kinds = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.col(r.name).alias("spans")) for r in rules])
    each = found.select("path", "version", "blob", F.explode(kinds).alias("k")).select("path", "version", "blob", "k.rule", F.explode("k.spans").alias("s"))
    return each.select("path", "version", "blob", "rule", "s.start", "s.end", "s.match")


def secret_report(docs: DataFrame, ledger: str | None = None) -> DataFrame:
    """The digest of op9: counts of the base kinds, SHA-256 of the base spans
    and all spans as text.  Without ``ledger`` a new one is begun."""
    base = [r for r in RULES if r.base]
    found = scan(docs, ledger or scratch(docs.sparkSession, "ledger"))
    counts = [F.size(r.name).cast("bigint").alias(f"n_{r.name}") for r in base]
    return found.select("doc_id", *counts, F.sha2(joined(base, True), 256).alias("base_sha256"), joined(RULES, True).alias("spans"))
