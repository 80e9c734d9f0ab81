"""Stages that put operators together, each over tables.

Scoring with and without a text layer, duplicates before recognition and after
validation, readings beside their rows, verdict requests, the export package
and benchmark seeding.  Null and empty texts, repeated rows and empty tables
are stated where they matter; further columns stay.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import scoring as S
from millrace.functions import text as T
from millrace.functions.profiles import DEVANAGARI, Profile
from millrace.operators import accept as A
from millrace.operators import cache as C
from millrace.operators import dedup as D
from millrace.operators import select as Q
from millrace.sources import recognisers as X


def best_text(*columns: str):
    """The first of the columns that is neither null nor empty; else empty."""
    return T.first_truthy(*[F.col(c) for c in columns])


def score_stage(df: DataFrame, profile: Profile = DEVANAGARI, rules: S.LaneRules | None = None, mode: str = "auto", skip_visual_only: bool | None = None) -> DataFrame:
    """Score candidates (text_assist, ocr_prediction, expected_text,
    image_width, image_height); hard and normal rows stay.

    Rows with a text are classified by it; with ``mode`` visual their score is
    that of the crop.  Rows without one have only their crop: they are dropped
    where verdicts cannot confirm them (``skip_visual_only``, by default where
    the profile asks for native digits), else hard from ``min_hard`` on and
    normal below it.
    """
    rules = rules or S.LaneRules(allow_ascii_digits=profile.allow_ascii_digits)
    skip = profile.native_digits_only if skip_visual_only is None else skip_visual_only
    width, height = (F.coalesce(F.col(c), F.lit(0)) for c in ("image_width", "image_height"))
    aspect = width / F.greatest(F.coalesce(F.nullif("image_height", F.lit(0)), F.lit(1)), F.lit(1))
    rows = df.withColumn("_text", best_text("text_assist", "ocr_prediction", "expected_text"))
    rows = rows.withColumn("_blank", T.strip(F.col("_text")) == "")
    reading = F.coalesce("ocr_prediction", F.lit(""))
    cheap = S.scored(rows, "ocr_prediction", profile, rules, "_cheap", "_cheap_score").select(*rows.columns, "_cheap_score")
    seen = T.bound(S.visual_complexity(width, height, aspect, F.col("_cheap_score"), reading))
    visual = F.lit(mode == "visual") | (F.lit(mode == "auto") & F.col("_blank"))
    rows = cheap.withColumn("_visual", F.when(visual, seen)).drop("_cheap_score")
    done = S.classify(rows, "_text", profile, rules, score_override="_visual")
    alone = F.col("_blank") & F.col("_visual").isNotNull()
    lane = F.when(~alone, F.col("difficulty")).when(F.col("_visual") >= rules.min_hard, S.HARD).otherwise(S.NORMAL)
    source = F.when(alone, "visual_provisional").otherwise(F.col("hard_signal_source"))
    used = F.when(F.col("_visual").isNotNull(), "visual").otherwise("text")
    score = F.when(alone, F.col("_visual")).otherwise(F.col("complexity_score"))
    done = done.withColumns({"_alone": alone, "difficulty": lane, "hard_signal_source": source, "scoring_mode_used": used, "complexity_score": score})
    kept = done.where(F.col("difficulty").isin(S.HARD, S.NORMAL))
    return (kept.where("NOT _alone") if skip else kept).drop("_text", "_blank", "_visual", "_alone")


def dedup_before_reading(df: DataFrame, page: list[str], seq: str, box: str, digest: str, bits: str, least: float = 0.85, most: int = 8, words: int = 1) -> DataFrame:
    """Candidates before recognition: of overlapping boxes on a page the first
    stays (greedily, in order), of equal images the first, and of near images
    the later, whatever becomes of it.  A row without a digest is like no other."""
    apart = D.cut(D.drop_same_boxes(df, page, seq, box, least))
    known = apart.where(F.col(digest).isNotNull() & F.col(bits).isNotNull())
    kept = D.drop_duplicate_images(known, seq, digest, D.hamming_pairs(known, seq, bits, most, words))
    return kept.unionByName(apart.where(F.col(digest).isNull() | F.col(bits).isNull()))


def dedup_validated(df: DataFrame, seq: str, digest: str, bits: str, text: str = "expected_text", threshold: float = 0.92, most: int = 8) -> DataFrame:
    """``df`` with reject_reason: rows already rejected keep theirs, but their
    images count; then duplicate images go, then similar texts at the threshold
    less 0.04, 0.88 at least.  Rows without an image are judged by text alone."""
    rows = D.cut(df)
    seen = rows.where(F.col(digest).isNotNull() & F.col(bits).isNotNull())
    images = D.drop_duplicate_images(seen, seq, digest, D.hamming_pairs(seen, seq, bits, most)).select(seq)
    gone = C.difference(seen.select(seq), images, seq).withColumn("_image", F.lit("duplicate_image"))
    open_ = D.cut(rows.where("reject_reason IS NULL").join(gone, seq, "left_anti"))
    unique = D.drop_similar_texts(open_, seq, text, max(0.88, threshold - 0.04)).select(seq)
    copies = C.difference(open_.select(seq), unique, seq).withColumn("_copy", F.lit("text_near_duplicate"))
    judged = rows.join(gone, seq, "left").join(copies, seq, "left")
    return judged.withColumn("reject_reason", F.coalesce("reject_reason", "_image", "_copy")).drop("_image", "_copy")


def dedup_reviewed(df: DataFrame, seq: str, text: str = "expected_text", threshold: float = 0.92) -> tuple[DataFrame, DataFrame]:
    """Rows without similar texts, and the flags of what was similar."""
    return D.drop_similar_texts(df, seq, text, threshold), D.similar_text_flags(df, seq, text, threshold)


def resolved_images(df: DataFrame, files: DataFrame) -> DataFrame:
    """``df`` with image: the file name if there is such a file, else the
    stored path if there is, else null.  ``files`` has ``path``."""
    there = files.select("path").distinct()
    named = df.join(there.withColumnRenamed("path", "_named"), F.col("image_filename") == F.col("_named"), "left")
    stored = named.join(there.withColumnRenamed("path", "_stored"), F.col("image_path") == F.col("_stored"), "left")
    return stored.withColumn("image", F.coalesce("_named", "_stored")).drop("_named", "_stored")


def prelabel(df: DataFrame, cache: DataFrame, backend: str, make: Callable[[], X.Backend], version: str, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """(rows with their reading, new cache entries).  ``df`` has the key, image
    and sha256; readings come from the cache where it has them and never become
    labels: an empty expected text takes the text layer."""
    read = D.cut(X.recognise_misses(df, cache, backend, version, make, key))
    rows = df.drop("ocr_prediction").join(read.select(key, "ocr_prediction"), key, "left")
    rows = rows.withColumns({"ocr_backend": F.lit(backend), "ocr_model_version": F.lit(version)})
    new = read.where("NOT from_cache AND ocr_prediction IS NOT NULL").join(df.select(key, "sha256"), key)
    entries = new.select("sha256", F.lit(backend).alias("backend"), F.lit(version).alias("model_version"), F.col("ocr_prediction").alias("payload")).dropDuplicates(["sha256"])
    return C.fill_labels(rows), entries


def verdict_tasks(df: DataFrame) -> DataFrame:
    """One request per row: id, the text to judge, the reading, the lane it is
    meant for, and its context as a struct."""
    context = F.struct("id", "source_id", "crop_type", "word_count", "char_count", F.col("difficulty").alias("heuristic_difficulty"))
    return df.select("id", best_text("expected_text", "text_assist", "ocr_prediction").alias("text"), F.coalesce("ocr_prediction", F.lit("")).alias("ocr_prediction"), F.coalesce("difficulty", F.lit("")).alias("intended_lane"), context.alias("context"))


def seed_benchmark(labels: DataFrame, images: DataFrame, profile: Profile = DEVANAGARI) -> DataFrame:
    """Benchmark rows from labels (image_filename, expected_text, issue_type)
    whose image is among ``images`` (name); the digit flag is taken from the
    labels or, without one there, from the text."""
    name = F.regexp_extract("image_filename", r"([^/]*)/*$", 1)
    rows = labels.withColumn("_name", name).join(images.select(F.col("name").alias("_name")).distinct(), "_name", "left_semi")
    digits = T.has_native_digits(F.col("expected_text"), profile)
    if "contains_native_digits" in labels.columns:
        digits = F.coalesce("contains_native_digits", digits)
    more = ["source_id"] if "source_id" in labels.columns else []
    return rows.select(F.concat(F.lit("images/"), "_name").alias("image_filename"), "expected_text", F.coalesce("issue_type", F.lit("")).alias("issue_type"), *more, digits.alias("contains_native_digits"))


def counts_map(df: DataFrame, column, least: int = 0) -> DataFrame:
    """One row: a JSON object of how often each value occurs, in order of the
    values, those above ``least``.  Meant for a package, which is small."""
    n = df.groupBy(F.coalesce(column.cast("string"), F.lit("unknown")).alias("k")).count().where(F.col("count") > least)
    pairs = F.sort_array(F.collect_list(F.struct("k", "count")))
    return n.agg(F.concat(F.lit("{"), F.array_join(F.transform(pairs, lambda p: F.concat(F.lit('"'), p["k"], F.lit('": '), p["count"].cast("string"))), ", "), F.lit("}")).alias("v"))


def package_report(selected: DataFrame, hard: int, normal: int, per_source: int, profile: Profile = DEVANAGARI, digest: str = "sha256", bits: str = "bits", most: int = 8, ascii_dropped: int = 0, text_dropped: int = 0) -> DataFrame:
    """The report of a package's rows in one row: counts, duplicates found among
    its images, sources over the cap, labels by source and issue, and whether
    every rule holds.  Rows without a digest have no image."""
    seen = selected.where(F.col(digest).isNotNull())
    groups = D.exact_groups(seen, digest, "seq").agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_samples"))
    near = D.hamming_pairs(seen, "seq", bits, most).agg(F.count(F.lit(1)).alias("near_duplicate_samples"))
    base = A.gate_report(selected, hard, normal, per_source, profile).drop("gate_ok")
    missing = selected.agg(F.count_if(F.col(digest).isNull()).alias("missing_images"))
    issue = T.issue_type(F.coalesce("expected_text", F.lit("")), profile)
    maps = {"issue_type_counts": (issue, 0), "gt_sources": (F.col("gt_source"), 0), "per_source_counts": (F.col("source_id"), 0), "source_cap_violations": (F.col("source_id"), per_source)}
    out = base.crossJoin(groups).crossJoin(near).crossJoin(missing)  # every side is one row
    for name, (column, least) in maps.items():
        out = out.crossJoin(counts_map(selected, column, least).withColumnRenamed("v", name))
    out = out.withColumns({"ascii_digit_dropped": F.lit(ascii_dropped), "text_near_duplicates": F.lit(text_dropped), "average_complexity_score": F.round("average_complexity_score", 4)})
    good = F.col("quota_met") & (F.col("over_cap_sources") == 0)
    for name in ("duplicate_samples", "near_duplicate_samples", "ascii_digit_violations", "missing_images", "empty_text"):
        good = good & (F.col(name) == 0)
    return out.withColumn("gate_ok", good)


def export_package(df: DataFrame, hard: int, normal: int, per_source: int, profile: Profile = DEVANAGARI, threshold: float = 0.92, allow_shortfall: bool = False, digest: str = "sha256", bits: str = "bits") -> tuple[DataFrame | None, DataFrame]:
    """(package rows or None, report) of accepted rows.

    What the verdict drops goes first, then similar texts, then the best of each
    lane stay.  Short of a target the export is blocked before anything else;
    digits that the profile bans go after the best were chosen and are not
    replaced.  Rows are handed out only if every rule holds or a shortfall is
    allowed."""
    gated = D.cut(A.export_gate(df))
    unique = D.cut(D.drop_similar_texts(gated, "seq", "expected_text", max(0.88, threshold - 0.04)))
    top = D.cut(Q.top_of_lanes(unique, hard, normal))
    n = top.agg(F.count_if(F.col("difficulty") == "hard").alias("h"), F.count_if(F.col("difficulty") == "normal").alias("n")).first()
    if (n["h"] < hard or n["n"] < normal) and not allow_shortfall:
        spark = df.sparkSession
        return None, spark.createDataFrame([(n["h"] + n["n"], n["h"], n["n"], False, True)], "total_samples bigint, hard_samples bigint, normal_samples bigint, quota_met boolean, export_blocked boolean")
    clean = top if profile.allow_ascii_digits else D.cut(top.where(~T.has_ascii_digits(F.col("expected_text"))))
    report = D.cut(package_report(clean, hard, normal, per_source, profile, digest, bits, ascii_dropped=n["h"] + n["n"] - clean.count(), text_dropped=gated.count() - unique.count()))
    ok = report.first()["gate_ok"] or allow_shortfall
    return (clean if ok else None), report.withColumn("export_blocked", F.lit(not ok))


def internal_records(df: DataFrame, profile: Profile = DEVANAGARI, order: list | None = None) -> DataFrame:
    """Public columns of the package's rows with where they come from."""
    from pyspark.sql import Window

    number = F.row_number().over(Window.orderBy(*(order or [F.col("seq")])))  # a package is small
    public = [F.format_string("/images/%04d.png", number).alias("image_filename"), F.coalesce("expected_text", F.lit("")).alias("expected_text"), T.issue_type(F.coalesce("expected_text", F.lit("")), profile).alias("issue_type")]
    known = [c for c in ("difficulty", "complexity_score", "source_id", "source_url", "source_document", "document_type", "source_page", "original_coordinates", "review_status") if c in df.columns]
    return df.select(*public, *known)
