"""Aggregation of metric rows: overall, by slice, by source; the winner."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MEANS = ("cer", "cer_strict", "cer_normalized", "wer", "native_numeral_accuracy", "special_char_accuracy", "special_char_f1", "special_char_precision", "special_char_recall")
SLICES = ("issue_type", "contains_native_digits", "source_id", "char_band", "word_band")
DEFAULT_BACKEND = "tesseract"


def _share(flag: str) -> Column:
    return F.avg(F.coalesce(F.col(flag), F.lit(False)).cast("double"))


def core_means(columns: list[str]) -> list[Column]:
    """The aggregates of a set of rows; rates over the rows they apply to."""
    have = lambda c: c in columns
    digits = F.col("gt_has_native_digits")
    out = [F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in MEANS if have(c)]]
    out += [_share("exact_match").alias("exact_match"), _share("exact_match_strict").alias("exact_match_strict")]
    out += [F.avg(F.when(digits, F.col("ascii_digit_contamination").cast("double"))).alias("ascii_digit_contamination_rate"), F.count_if(digits).alias("native_digit_samples")]
    out += [F.avg("reference_id_exact").alias("reference_id_exact_match"), F.count("reference_id_exact").alias("reference_id_applicable")]
    if have("conjunct_error_rate"):
        out += [F.avg("conjunct_error_rate").alias("conjunct_error_rate"), F.count("conjunct_error_rate").alias("conjunct_applicable")]
    if have("latency_ms"):
        out += [F.percentile("latency_ms", 0.5).alias("latency_ms_p50"), F.percentile("latency_ms", 0.95).alias("latency_ms_p95"), F.count("latency_ms").alias("latency_samples")]
    return out


def _labelled(rows: DataFrame) -> DataFrame:
    """Slice labels: empty ones are unknown, sources are trimmed first."""
    known = lambda c: F.coalesce(F.nullif(c, F.lit("")), F.lit("unknown"))
    return rows.withColumns({"issue_type": known(F.col("issue_type")), "source_id": known(F.trim("source_id")), "contains_native_digits": F.when(F.col("gt_has_native_digits"), "true").otherwise("false")})


def overall(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    return rows.groupBy(*(by or [])).agg(*core_means(rows.columns))


def sliced(rows: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Long table (slice, label, n, means): the five slices and the whole
    (slice ``all``) in one pass of grouping sets."""
    labelled, by = _labelled(rows), [F.col(c) for c in by or []]
    keys = [F.col(s) for s in SLICES]
    sets = [[*by], *[[*by, k] for k in keys]]
    wide = labelled.groupingSets(sets, *by, *keys).agg(*core_means(rows.columns), *[F.grouping(s).alias(f"_g_{s}") for s in SLICES])
    which, label = F.lit("all"), F.lit("all")
    for s in SLICES:
        which = F.when(F.col(f"_g_{s}") == 0, f"by_{s}").otherwise(which)
        label = F.when(F.col(f"_g_{s}") == 0, F.col(s)).otherwise(label)
    return wide.withColumns({"slice": which, "label": label}).drop(*SLICES, *[f"_g_{s}" for s in SLICES])


def by_source(rows: DataFrame, most: int = 40) -> DataFrame:
    """The ``most`` sources with the most rows, with their number and how many
    are left out."""
    groups = _labelled(rows).groupBy("source_id").agg(*core_means(rows.columns))
    order = Window.orderBy(F.desc("n"), "source_id")
    counted = groups.crossJoin(F.broadcast(groups.agg(F.count(F.lit(1)).alias("n_sources"))))
    top = counted.orderBy(F.desc("n"), "source_id").limit(most)
    return top.withColumns({"rank": F.row_number().over(order), "omitted_sources": F.greatest(F.col("n_sources") - most, F.lit(0))})


def backend_score(columns: list[str]) -> Column:
    """Weighted quality of a backend's summary; what is missing counts 0."""
    part = lambda c, w: F.coalesce(F.col(c), F.lit(0.0)) * w if c in columns else F.lit(0.0)
    # a mean that is 0 gives way to its stand-in, as a missing one does
    or_else = lambda a, b: F.coalesce(F.nullif(F.col(a), F.lit(0.0)), F.col(b), F.lit(0.0))
    good = part("exact_match", 3) + part("native_numeral_accuracy", 2) + or_else("special_char_f1", "special_char_accuracy") * 1.5 + part("reference_id_exact_match", 2)
    return good - or_else("cer_normalized", "cer") * 2 - part("wer", 1) - part("conjunct_error_rate", 0.5) - part("ascii_digit_contamination_rate", 1.5)


def ranked_backends(summary: DataFrame) -> DataFrame:
    """Backends by score, the larger name first among equals."""
    return summary.select("backend", backend_score(summary.columns).alias("score")).orderBy(F.desc("score"), F.desc("backend"))


def pick_winner(summary: DataFrame) -> str:
    best = ranked_backends(summary).first()
    return best["backend"] if best else DEFAULT_BACKEND
