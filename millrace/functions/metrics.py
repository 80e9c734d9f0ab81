"""Recognition metrics of pairs of texts, as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.functions.profiles import DEVANAGARI, METRIC_SPECIAL, Profile
from millrace.functions.python_side import conjunct_error_rate, word_error_rate
from millrace.functions.scoring import identifier_likeness


def error_rate(ref: Column, hyp: Column) -> Column:
    """Edits per reference character; an empty reference gives 0 or 1."""
    rate = F.levenshtein(ref, hyp) / F.greatest(F.length(ref), F.lit(1))
    return F.when(ref == "", F.when(hyp == "", 0.0).otherwise(1.0)).otherwise(rate)


def only(text: Column, alphabet: str) -> Column:
    """The characters of ``text`` that are in ``alphabet``, in order."""
    escaped = "".join(rf"\x{{{ord(c):X}}}" for c in alphabet)
    return F.regexp_replace(text, f"[^{escaped}]", "")


def subset_accuracy(ref: Column, hyp: Column, alphabet: str) -> Column:
    """One minus the error rate over an alphabet; may be negative."""
    r, h = only(ref, alphabet), only(hyp, alphabet)
    exact = F.when(h == "", 1.0).otherwise(0.0)
    return F.when(r == "", exact).otherwise(1.0 - F.levenshtein(r, h) / F.greatest(F.length(r), F.lit(1)))


def multiset_f1(ref: Column, hyp: Column, alphabet: str = METRIC_SPECIAL) -> tuple[Column, Column, Column]:
    """Precision, recall and F1 of the alphabet's characters as multisets."""
    hits = F.lit(0)
    for c in alphabet:
        hits = hits + F.least(T.count_chars(ref, c), T.count_chars(hyp, c))
    want, got = T.count_chars(ref, alphabet), T.count_chars(hyp, alphabet)
    none = (want == 0) & (got == 0)
    precision = F.when(none, 1.0).when(got == 0, 0.0).otherwise(hits / F.greatest(got, F.lit(1)))
    recall = F.when(none, 1.0).when(want == 0, 0.0).otherwise(hits / F.greatest(want, F.lit(1)))
    both = precision + recall
    f1 = F.when(none, 1.0).when(both == 0, 0.0).otherwise(2 * precision * recall / F.when(both == 0, 1.0).otherwise(both))
    return precision, recall, f1


def reference_like(text: Column, profile: Profile = DEVANAGARI) -> Column:
    text = F.coalesce(text, F.lit(""))
    return (identifier_likeness(text, profile) > 0) | text.rlike(profile.reference_span) | text.rlike(profile.date_like) | (T.count_chars(text, "/") >= 2)


def length_bands(n_chars: Column, n_words: Column) -> tuple[Column, Column]:
    chars = F.when(n_chars <= 25, "short_le_25").otherwise("long_gt_25")
    return chars, F.when(n_words <= 1, "words_1").when(n_words <= 5, "words_2_5").otherwise("words_6_plus")


def scored_pairs(df: DataFrame, ref: str = "ref", hyp: str = "hyp", profile: Profile = DEVANAGARI, issue: str | None = "issue_type", source: str | None = "source_id", native_only: bool = False) -> DataFrame:
    """All metrics of every pair as further columns.

    ``native_only`` leaves the two rates that need Python (words, conjuncts)
    out, for plans that must stay on the JVM.
    """
    raw_r, raw_h = F.coalesce(F.col(ref), F.lit("")), F.coalesce(F.col(hyp), F.lit(""))
    df = df.withColumns({"_r": T.for_compare(F.col(ref)), "_h": T.for_compare(F.col(hyp)), "_rs": T.for_strict(F.col(ref)), "_hs": T.for_strict(F.col(hyp))})
    r, h, rs, hs = (F.col(c) for c in ("_r", "_h", "_rs", "_hs"))
    precision, recall, f1 = multiset_f1(r, h)
    native = T.has_native_digits(raw_r, profile)
    like = reference_like(raw_r, profile)
    n_chars, n_words = T.char_count(F.col(ref)), T.word_count(r)
    char_band, word_band = length_bands(n_chars, n_words)
    out = {
        "cer": error_rate(r, h),
        "cer_strict": error_rate(rs, hs),
        "cer_normalized": error_rate(r, h),
        "exact_match": r == h,
        "exact_match_strict": rs == hs,
        "native_numeral_accuracy": subset_accuracy(r, h, profile.native_digits),
        "ascii_digit_contamination": native & raw_h.rlike("[0-9]") & F.lit(bool(profile.foreign_digits)),
        "gt_has_native_digits": native,
        "ascii_digit_count_in_pred": F.when(native, T.count_chars(raw_h, profile.foreign_digits)).otherwise(0),
        "special_char_accuracy": subset_accuracy(r, h, METRIC_SPECIAL),
        "special_char_precision": precision,
        "special_char_recall": recall,
        "special_char_f1": f1,
        "is_reference_like": like,
        "reference_id_exact": F.when(like, F.when(r == h, 1.0).otherwise(0.0)),
        "char_count": n_chars,
        "word_count": n_words,
        "char_band": char_band,
        "word_band": word_band,
        "issue_type": F.coalesce(F.col(issue), F.lit("")) if issue in df.columns else F.lit(""),
        "source_id": F.coalesce(F.col(source).cast("string"), F.lit("")) if source in df.columns else F.lit(""),
    }
    if not native_only:
        out |= {"wer": word_error_rate(r, h), "conjunct_error_rate": conjunct_error_rate(F.col(ref), F.col(hyp))}
    df = df.withColumns(out)
    if not native_only:
        df = df.withColumn("conjunct_applicable", F.col("conjunct_error_rate").isNotNull())
    return df.drop("_r", "_h", "_rs", "_hs")
