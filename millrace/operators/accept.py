"""Verdicts, labels, acceptance and the export gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import scoring as S
from millrace.functions import text as T
from millrace.functions.profiles import DEVANAGARI, Profile

LANES = ("hard", "normal", "reject")
REPLY = "exact_match boolean, suspicious boolean, visible_differs boolean, likely_ocr_errors array<string>, diff_spans array<string>, is_complex_for_ocr boolean, suggested_lane string, complexity_notes string, confidence double, notes string"
TEXT_REPLY = "is_plausible_marathi boolean, suspicious boolean, nonsense_tokens array<string>, punctuation_issues array<string>, likely_ocr_garble boolean, is_complex_for_ocr boolean, suggested_lane string, complexity_notes string, confidence double, notes string"


def _lane_of(reply: Column, derive: bool) -> Column:
    """The lane a reply names, else, if allowed, what its flag implies."""
    named = F.lower(T.strip(F.coalesce(reply["suggested_lane"], F.lit(""))))
    out = F.when(named.isin(*LANES), named)
    return out.when(reply["is_complex_for_ocr"], "hard").when(~reply["is_complex_for_ocr"], "normal") if derive else out


def _filled(items: Column) -> Column:
    return F.coalesce(F.size(items) > 0, F.lit(False))


def image_verdict(content: Column) -> Column:
    """Verdict struct of a reply about an image and its text."""
    reply = F.from_json(T.json_in_text(content), REPLY)
    yes = lambda c: F.coalesce(reply[c], F.lit(False))
    exact, lane = yes("exact_match"), _lane_of(reply, True)
    doubt = yes("suspicious") | yes("visible_differs") | ~exact | _filled(reply["likely_ocr_errors"]) | _filled(reply["diff_spans"])
    cleared = exact & ~yes("suspicious") & ~yes("visible_differs")
    none = F.array().cast("array<string>")
    return F.struct(
        F.lit(True).alias("enabled"),
        F.lit(False).alias("skipped"),
        exact.alias("exact_match"),
        F.coalesce(reply["visible_differs"], ~exact).alias("visible_differs"),
        F.coalesce(reply["diff_spans"], none).alias("diff_spans"),
        F.coalesce(reply["likely_ocr_errors"], none).alias("likely_ocr_errors"),
        F.coalesce(reply["is_complex_for_ocr"], lane == "hard").alias("is_complex_for_ocr"),
        lane.alias("suggested_lane"),
        lane.alias("ocr_complexity"),
        (doubt & ~cleared).alias("suspicious"),
        F.coalesce(reply["confidence"], F.lit(0.0)).alias("confidence"),
        F.lit("vision").alias("mode"),
    )


def text_verdict(content: Column) -> Column:
    """Verdict struct of a reply about the text alone: it says nothing about a
    match, so exact_match is null."""
    reply = F.from_json(T.json_in_text(content), TEXT_REPLY)
    yes = lambda c: F.coalesce(reply[c], F.lit(False))
    lane = _lane_of(reply, False)
    doubt = yes("suspicious") | yes("likely_ocr_garble") | ~F.coalesce(reply["is_plausible_marathi"], F.lit(True)) | _filled(reply["nonsense_tokens"])
    return F.struct(
        F.lit(True).alias("enabled"),
        F.lit(False).alias("skipped"),
        F.lit(None).cast("boolean").alias("exact_match"),
        F.coalesce(reply["is_complex_for_ocr"], lane == "hard").alias("is_complex_for_ocr"),
        lane.alias("suggested_lane"),
        lane.alias("ocr_complexity"),
        doubt.alias("suspicious"),
        F.coalesce(reply["confidence"], F.lit(0.0)).alias("confidence"),
        F.lit("text").alias("mode"),
    )


def skipped_verdict(reason: Column | str) -> Column:
    """Verdict of a call that did not happen.  A missing image is suspicious;
    a switched-off client or a failed call is not."""
    reason = F.lit(reason) if isinstance(reason, str) else reason
    return F.struct((reason != "llm_disabled").alias("enabled"), F.lit(True).alias("skipped"), reason.isin("image_missing", "image_encode_failed").alias("suspicious"), reason.alias("notes"))


def needs_text_fallback(error: Column) -> Column:
    """Errors after which the text alone is judged."""
    return F.lower(F.coalesce(error, F.lit(""))).rlike("image|vision|unsupported|400|415")


def with_verdicts(df: DataFrame, verdicts: DataFrame, key: str = "id") -> DataFrame:
    """Attach verdicts by id; rows without one count as skipped."""
    joined = df.join(verdicts, key, "left")
    return joined.withColumns({"llm_enabled": F.coalesce("llm_enabled", F.lit(True)), "llm_skipped": F.coalesce("llm_skipped", F.lit(True))})


def verdict_lane() -> Column:
    return F.lower(T.strip(F.coalesce(F.nullif("ocr_complexity", F.lit("")), F.nullif("suggested_lane", F.lit("")), F.lit(""))))


def merge_verdicts(df: DataFrame, text: str = "expected_text", profile: Profile = DEVANAGARI, rules: S.LaneRules | None = None) -> DataFrame:
    """Relabel classified rows by their verdicts and set the review status.

    Rows with a verdict are classified again with it as label and their score
    as it is; rows that were skipped are demoted without strong signals.
    """
    rules = rules or S.LaneRules(allow_ascii_digits=profile.allow_ascii_digits)
    told, skipped = verdict_lane(), F.coalesce("llm_skipped", F.lit(False))
    use = ~skipped & told.isin(*LANES)
    new = S.lane(rules, told, F.col("complexity_score"))
    demoted = S.demote_unconfirmed(F.col("difficulty"), F.col("hard_signal_source"), F.col("is_strong"))
    df = df.withColumns({"_new": T.bound(new), "_old": T.bound(demoted), "_use": use, "_skipped": skipped})
    pick = lambda c: F.when(F.col("_use"), F.col("_new")[c]).when(F.col("_skipped"), F.col("_old")[c])
    df = df.withColumns({"difficulty": F.coalesce(pick("difficulty"), "difficulty"), "hard_signal_source": F.coalesce(pick("hard_signal_source"), "hard_signal_source"), "complexity_score": F.when(F.col("_use"), F.col("_new.complexity_score")).otherwise(F.col("complexity_score")), "reject_reason": F.coalesce(pick("reject_reason"), "reject_reason"), "lane_applied": F.col("_use")})
    live = ~F.col("_skipped")
    doubt = F.coalesce("suspicious", F.lit(False)) | (live & F.col("exact_match").eqNullSafe(False)) | (live & (F.col("difficulty") == "hard") & F.col("is_complex_for_ocr").eqNullSafe(False)) | (live & (told == "reject"))
    status = F.when(F.col("difficulty") == "reject", "rejected").when(doubt, "needs_llm_attention").otherwise("pending_review")
    return df.withColumn("review_status", status).drop("_new", "_old", "_use", "_skipped")


def without_verdicts(df: DataFrame) -> DataFrame:
    """The same without a model at all: demote, drop what is demoted."""
    demoted = S.demote_unconfirmed(F.col("difficulty"), F.col("hard_signal_source"), F.col("is_strong"))
    out = df.withColumn("_d", T.bound(demoted)).withColumns({"difficulty": F.col("_d.difficulty"), "hard_signal_source": F.col("_d.hard_signal_source"), "llm_skipped": F.lit(True), "llm_enabled": F.lit(False), "review_status": F.lit("pending_review")}).drop("_d")
    return out.where("hard_signal_source != 'demoted_soft_fail'")


def verdict_stats(df: DataFrame) -> DataFrame:
    """One row of counters over rows with verdicts."""
    lane = verdict_lane()
    count = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    return df.agg(F.count(F.lit(1)).alias("ran"), count(F.col("mode") == "vision").alias("vision"), count(F.col("mode") == "text_fallback").alias("text_fallback"), count(F.col("exact_match")).alias("exact_match"), count(F.col("is_complex_for_ocr")).alias("complex_hard"), count(lane == "hard").alias("lane_hard"), count(lane == "normal").alias("lane_normal"), count(lane == "reject").alias("lane_reject"), count(F.col("lane_applied")).alias("lane_applied"), count(F.col("review_status") == "needs_llm_attention").alias("suspicious"))


def attention_first(df: DataFrame, seq: str = "seq") -> DataFrame:
    return df.orderBy(F.when(F.col("review_status") == "needs_llm_attention", 0).otherwise(1), seq)


def choose_label(trust: bool = True) -> Column:
    """Struct (text, gt_source, reason) from assist, ocr and expected text and
    the verdict."""
    assist, ocr, old = (T.strip(F.coalesce(F.col(c), F.lit(""))) for c in ("text_assist", "ocr_prediction", "expected_text"))
    ran = F.coalesce(F.col("has_verdict"), F.lit(True)) & ~F.coalesce("llm_skipped", F.lit(False)) & F.coalesce("llm_enabled", F.lit(True)) & F.lit(trust)
    match, clash = ran & F.col("exact_match").eqNullSafe(True), ran & F.col("exact_match").eqNullSafe(False)
    made = lambda t, s, r=None: F.struct((t if isinstance(t, Column) else F.lit(t)).alias("text"), F.lit(s).alias("gt_source"), F.lit(r).cast("string").alias("reason"))
    first = F.when(assist != "", assist).when(old != "", old).otherwise(ocr)
    out = F.when(match & (first != ""), made(first, "auto_vision_match")).when(match, made("", "auto_empty", "empty_after_vision_match"))
    out = out.when(clash & (ocr != ""), made(ocr, "auto_ocr_vision_corrected")).when(clash, made("", "auto_empty", "vision_mismatch_no_ocr"))
    return out.when(assist != "", made(assist, "auto_pdf_text")).when(ocr != "", made(ocr, "auto_ocr")).when(old != "", made(old, "auto_existing")).otherwise(made("", "auto_empty", "empty_auto_label"))


def accept(df: DataFrame, profile: Profile = DEVANAGARI, rules: S.LaneRules | None = None, trust: bool = True, require_pdf_text: bool = False) -> DataFrame:
    """Accept or reject classified rows; the first failing rule is the reason.

    The complexity gate judges the text that the row was classified by, not the
    label chosen here.  Adds label, gt_source, reason, review_status.
    """
    rules = rules or S.LaneRules(allow_ascii_digits=profile.allow_ascii_digits)
    df = df if "has_verdict" in df.columns else df.withColumn("has_verdict", F.lit(True))
    df = df.withColumn("_label", T.bound(choose_label(trust)))
    skipped = F.coalesce("llm_skipped", F.lit(False)) | ~F.coalesce("llm_enabled", F.lit(True))
    told = verdict_lane()
    derived = F.when((told == "") & ~skipped & F.col("is_complex_for_ocr"), "hard").when((told == "") & ~skipped & ~F.col("is_complex_for_ocr"), "normal").otherwise(told)
    df = df.withColumns({"_told": derived, "_use": F.lit(trust) & ~skipped & derived.isin(*LANES)})
    df = df.withColumns({"_new": T.bound(S.lane(rules, F.col("_told"), F.col("complexity_score"))), "_old": T.bound(S.demote_unconfirmed(F.col("difficulty"), F.col("hard_signal_source"), F.col("is_strong")))})
    lane = F.when(F.col("_use"), F.col("_new.difficulty")).otherwise(F.col("_old.difficulty"))
    text = F.col("_label.text")
    reason = F.when(F.col("_label.reason").isNotNull(), F.col("_label.reason")).when(text == "", "empty_auto_label")
    if not profile.allow_ascii_digits:
        reason = reason.when(T.has_ascii_digits(text), "ascii_digits")
    if require_pdf_text:
        reason = reason.when(~F.col("_label.gt_source").isin("auto_pdf_text", "auto_vision_match"), "no_pdf_text")
    reason = reason.when(F.col("_use") & (lane == "reject"), "llm_complexity_reject").when(lane == "reject", "hard_unconfirmed_llm_soft_fail").when(~lane.isin("hard", "normal"), "no_lane")
    df = df.withColumns({"reason": reason, "label": text, "gt_source": F.col("_label.gt_source"), "accepted_lane": lane, "complexity_score": F.when(F.col("_use"), F.col("_new.complexity_score")).otherwise(F.col("complexity_score"))})
    return df.withColumn("review_status", F.when(F.col("reason").isNull(), "verified").otherwise("rejected")).drop("_label", "_told", "_use", "_new", "_old")


def accept_report(df: DataFrame) -> DataFrame:
    """Counts of accepted rows by label source and lane, rejected by reason."""
    return df.groupBy("review_status", F.when(F.col("reason").isNull(), F.col("gt_source")).alias("gt_source"), F.when(F.col("reason").isNull(), F.col("accepted_lane")).alias("lane"), "reason").agg(F.count(F.lit(1)).alias("n"))


def export_gate(df: DataFrame, require_complex: bool = True) -> DataFrame:
    """Verified rows that the verdict does not drop; hard rows it calls easy
    become normal."""
    live = F.coalesce(F.col("has_verdict"), F.lit(True)) & ~F.coalesce("llm_skipped", F.lit(False)) & F.coalesce("llm_enabled", F.lit(True))
    clash = F.col("exact_match").eqNullSafe(False) & ~F.coalesce("gt_source", F.lit("")).isin("auto_ocr_vision_corrected", "auto_vision_match")
    dropped = live & (clash | F.col("suggested_lane").eqNullSafe("reject"))
    easy = live & F.lit(require_complex) & (F.col("difficulty") == "hard") & F.col("is_complex_for_ocr").eqNullSafe(False)
    kept = df.where((F.col("review_status") == "verified") & ~dropped)
    return kept.withColumns({"difficulty": F.when(easy, "normal").otherwise(F.col("difficulty")), "hard_signal_source": F.when(easy, "export_demoted_not_complex").otherwise(F.col("hard_signal_source"))})


def for_export(df: DataFrame, include_pending: bool = False) -> DataFrame:
    """Rows that the exporter takes; on request everything not rejected."""
    wanted = F.col("review_status").isin("verified", "pending_export")
    if include_pending:
        return df.withColumn("review_status", F.lit("verified"))
    return df.where(wanted).withColumn("review_status", F.lit("verified"))


def gate_report(df: DataFrame, hard_target: int, normal_target: int, per_source: int, profile: Profile = DEVANAGARI, exact_groups: int = 0, near_pairs: int = 0, missing: int = 0, source: str = "source_id", label: str = "expected_text") -> DataFrame:
    """One row: counts of the package and whether every rule holds."""
    ascii_ = T.has_ascii_digits(F.col(label)) & F.lit(not profile.allow_ascii_digits)
    one = df.agg(F.count(F.lit(1)).alias("total_samples"), F.count_if(F.col("difficulty") == "hard").alias("hard_samples"), F.count_if(F.col("difficulty") == "normal").alias("normal_samples"), F.count_if(ascii_).alias("ascii_digit_violations"), F.count_if(T.strip(F.coalesce(F.col(label), F.lit(""))) == "").alias("empty_text"), F.countDistinct(source).alias("sources_used"), F.coalesce(F.avg(F.coalesce("complexity_score", F.lit(0.0))), F.lit(0.0)).alias("average_complexity_score"))
    over = df.groupBy(source).count().where(F.col("count") > per_source).agg(F.count(F.lit(1)).alias("over_cap_sources"))
    out = one.crossJoin(over).withColumn("quota_met", (F.col("hard_samples") >= hard_target) & (F.col("normal_samples") >= normal_target))
    ok = F.col("quota_met") & F.lit(exact_groups == 0 and near_pairs == 0 and missing == 0) & (F.col("ascii_digit_violations") == 0) & (F.col("empty_text") == 0) & (F.col("over_cap_sources") == 0)
    return out.withColumn("gate_ok", ok)


def public_records(df: DataFrame, profile: Profile = DEVANAGARI, order: list[Column] | None = None, text: str = "expected_text") -> DataFrame:
    """Three-column package rows, files renumbered in order."""
    from pyspark.sql import Window

    number = F.row_number().over(Window.orderBy(*(order or [F.col("seq")])))
    issue = F.coalesce(F.nullif("issue_type", F.lit("")), T.issue_type(F.coalesce(F.col(text), F.lit("")), profile)) if "issue_type" in df.columns else T.issue_type(F.coalesce(F.col(text), F.lit("")), profile)
    return df.select(F.format_string("/images/%04d.png", number).alias("image_filename"), F.coalesce(F.col(text), F.lit("")).alias("expected_text"), issue.alias("issue_type"))


def public_name(path: Column, prefix: str = "/images/") -> Column:
    """A file's base name under the package's prefix."""
    return F.replace(F.concat(F.lit(prefix), F.regexp_extract(path, r"([^/]*)/*$", 1)), F.lit("//"), F.lit("/"))


def lane_inventory(df: DataFrame) -> DataFrame:
    """Verified rows by lane."""
    return df.agg(F.count_if((F.col("review_status") == "verified") & (F.col("difficulty") == "hard")).alias("hard"), F.count_if((F.col("review_status") == "verified") & (F.col("difficulty") == "normal")).alias("normal"))
