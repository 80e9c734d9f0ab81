"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, exact_dedup, packing, pii, repeats, secrets, simhash, toxicity, training_order, warc
from millrace.llm.common import table


def op1_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of all documents' ids in training order, as read back."""
    return training_order.materialize_order(table(spark, sf_dir, "documents")).drop("ids")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived and read back."""
    pages = warc.warc_round_trip(table(spark, sf_dir, "pages"), payloads=False)
    return pages.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate class of every document."""
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages removed from every document."""
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items verified in the documents."""
    return decontaminate.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.pii_report(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every piece of every document."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, by way of a new ledger."""
    return secrets.secret_report(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group and verdict of every document."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_training_order, op2_warc, op3_toxicity, op4_simhash, op5_repeats, op6_decontamination, op7_pii, op8_packing, op9_secrets, op10_exact_dedup)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


_BASE32 = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(h, {5 * i + 1}, 5) AS BIGINT) >> {shift}) & 31 AS INTEGER) + 1, 1)" for i in range(8) for shift in (15, 10, 5, 0))


def _matches(kind: str, rank: int, pattern: str, good: str) -> str:
    """Matches of one kind with their positions, from the gaps between them."""
    literal = pattern.replace("'", "''")
    return f"""SELECT doc_id, '{kind}' AS kind, {rank} AS kind_rank, start, start + length(m) AS stop FROM (
      SELECT doc_id, m, sum(length(g)) OVER w + coalesce(sum(length(m)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM (
        SELECT doc_id, unnest(regexp_extract_all(t, '{literal}')) AS m, unnest(list_slice(string_split_regex(t, '{literal}'), 1, len(regexp_extract_all(t, '{literal}')))) AS g,
          generate_subscripts(regexp_extract_all(t, '{literal}'), 1) AS i FROM d) WINDOW w AS (PARTITION BY doc_id ORDER BY i)) WHERE {good}"""


def _report(kinds: list[tuple[str, str, str]], order: str) -> str:
    found = " UNION ALL ".join(_matches(k, i, p, g) for i, (k, p, g) in enumerate(kinds))
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k, _, _ in kinds)
    line = f"coalesce(string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT), ',' ORDER BY {order}), '')"
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), f AS ({found}),
      a AS (SELECT doc_id, {counts}, {line} AS spans FROM d LEFT JOIN f USING (doc_id) GROUP BY doc_id)
      SELECT doc_id, {", ".join(f"n_{k}" for k, _, _ in kinds)}, sha256(spans) AS base_sha256, spans FROM a"""


_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = f"list_sum(list_transform(generate_series(1, length({_DIGITS})), lambda i: CASE WHEN i % 2 = 0 THEN (2 * CAST(substr(reverse({_DIGITS}), CAST(i AS INTEGER), 1) AS INTEGER)) // 10 + (2 * CAST(substr(reverse({_DIGITS}), CAST(i AS INTEGER), 1) AS INTEGER)) % 10 ELSE CAST(substr(reverse({_DIGITS}), CAST(i AS INTEGER), 1) AS INTEGER) END)) % 10 = 0"
_SMALL = "(0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}))"

ORACLES: dict[str, str] = {
    "op2_warc": f"""WITH p AS (SELECT page_id, coalesce(html, '') AS b FROM pages), q AS (SELECT page_id, strlen(b) AS n, sha1(b) AS h, min(page_id) OVER (PARTITION BY b) AS first FROM p)
      SELECT page_id, n AS payload_bytes, {_BASE32} AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM q""",
    # the added kinds are not said in SQL; the tables hold none of them
    "op7_pii": _report(
        [
            ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "TRUE"),
            ("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", rf"regexp_full_match(m, '{_SMALL}\.{_SMALL}\.{_SMALL}\.{_SMALL}')"),
            ("card", r"[0-9](?:[\x20-]?[0-9])+", f"length({_DIGITS}) BETWEEN 16 AND 19 AND {_LUHN}"),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 8 AND 15"),
        ],
        "kind_rank, start",
    ),
    "op9_secrets": _report(
        [
            ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", r"""length(regexp_extract(m, '^(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1)) >= 6"""),
            ("access", r"AKIA[A-Z0-9]+", "length(m) >= 20"),
            ("hex", r"[0-9a-f]+", "length(m) >= 24"),
        ],
        "start, kind_rank",
    ),
    "op10_exact_dedup": r"""WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS b FROM documents),
      g AS (SELECT doc_id, b, first_value(doc_id) OVER (PARTITION BY b ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY b) AS group_size FROM d)
      SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(b) AS text_sha256 FROM g""",
}
