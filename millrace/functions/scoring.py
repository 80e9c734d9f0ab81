"""Structural features, scores and lanes of text lines."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.functions.profiles import BRACKETS, DEVANAGARI, Profile

HARD, NORMAL, REJECT = "hard", "normal", "reject"


@dataclass(frozen=True)
class LaneRules:
    """Thresholds of the lane decision; every call site has its own."""

    min_hard: float = 3.0
    max_normal: float = 2.5
    min_words: int = 2
    max_words: int = 50
    normal_min_words: int = 6
    normal_max_words: int = 40
    min_chars: int | None = None
    max_chars: int | None = None
    allow_ascii_digits: bool = False


def signs_of(text: Column) -> Column:
    """What is neither a Latin letter nor a plain blank: all that the features
    count, in far fewer characters."""
    return F.regexp_replace(text, r"[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F} ]++", "")


def identifier_likeness(text: Column, profile: Profile = DEVANAGARI, signs: Column | None = None) -> Column:
    """2 for a chain of separated digit groups, 1 for a pair; 0.75 more for
    three digits and two separators.  Both begin with a digit."""
    signs = text if signs is None else signs
    digits = T.count_chars(signs, profile.native_digits + profile.foreign_digits)
    chain = F.when(text.rlike(profile.id_chain()), 2.0).when(text.rlike(profile.id_pair()), 1.0).otherwise(0.0)
    more = F.when((digits >= 3) & (T.count_chars(signs, "/-.:") >= 2), 0.75).otherwise(0.0)
    return F.when(digits > 0, chain + more).otherwise(0.0)


def contains_identifier(text: Column, profile: Profile = DEVANAGARI) -> Column:
    return identifier_likeness(text, profile) > 0


def reference_features(text: Column, profile: Profile = DEVANAGARI) -> Column:
    score = identifier_likeness(text, profile)
    return F.struct(score.alias("identifier_likeness_score"), score.alias("reference_pattern_score"), (score > 0).alias("contains_reference_identifier"), T.count_chars(text, "/").alias("slash_count"))


def features(text: Column, profile: Profile = DEVANAGARI, signs: Column | None = None) -> Column:
    """Feature struct of an NFC text; ``signs`` are its ``signs_of``, if they
    are at hand."""
    signs = text if signs is None else signs
    special, native = T.count_chars(signs, profile.special), T.count_chars(signs, profile.native_digits)
    foreign, length = T.count_chars(signs, profile.foreign_digits), F.length(text)
    words = T.word_count(text)
    currency = F.lit(0)
    for sign in profile.currency:
        currency = currency + T.count_of(text, sign)
    likeness = identifier_likeness(text, profile, signs)
    per = F.greatest(length, F.lit(1))
    parts = {
        "native_digit_count": native,
        "ascii_digit_count": foreign,
        "slash_count": T.count_chars(signs, "/"),
        "period_count": T.count_chars(signs, "."),
        "comma_count": T.count_chars(signs, ","),
        "hyphen_count": T.count_chars(signs, "-"),
        "dash_count": T.count_chars(signs, "—–"),
        "colon_count": T.count_chars(signs, ":"),
        "semicolon_count": T.count_chars(signs, ";"),
        "bracket_count": T.count_chars(signs, BRACKETS),
        "symbol_count": special,
        "currency_count": currency,
        "percent_count": T.count_chars(signs, "%"),
        "conjunct_estimate": T.conjuncts(signs),
        "matra_score": T.matra_score(signs),
        "text_length": length,
        "char_count": F.length(T.strip(T.without_joiners(text))),
        "word_count": words,
        "numeric_density": (native + foreign) / per,
        "special_character_density": special / per,
        "identifier_likeness_score": likeness,
        "reference_pattern_score": likeness,
        "dense_text_score": F.least(words / 8.0, F.lit(3.0)) + F.least(length / 80.0, F.lit(2.0)),
    }
    return F.struct(*[c.alias(n) for n, c in parts.items()])


def raw_complexity(f: Column) -> Column:
    """Weighted sum of the features, in a fixed order, not rounded."""
    capped = lambda c, top: F.least(c, F.lit(top))
    score = capped(f["native_digit_count"], 12) * 0.45
    score = score + capped(f["slash_count"], 6) * 0.35
    score = score + capped(f["period_count"], 10) * 0.15
    score = score + capped(f["hyphen_count"] + f["dash_count"], 6) * 0.25
    score = score + capped(f["comma_count"] + f["colon_count"], 8) * 0.12
    score = score + capped(f["bracket_count"], 6) * 0.2
    score = score + capped(f["currency_count"] + f["percent_count"], 4) * 0.5
    score = score + capped(f["conjunct_estimate"], 15) * 0.15
    score = score + f["matra_score"]
    score = score + f["identifier_likeness_score"] * 0.8
    score = score + f["dense_text_score"]
    score = score + f["special_character_density"] * 8
    score = score + f["numeric_density"] * 8
    return score - f["ascii_digit_count"] * 0.5


def complexity(f: Column) -> Column:
    return T.py_round(raw_complexity(f), 4)


def visual_complexity(width: Column, height: Column, aspect: Column, text_score: Column | None = None, text: Column | None = None) -> Column:
    """Score of a crop without a text layer; a cheap reading may help."""
    score = F.when(aspect >= 4.0, 1.5).otherwise(0.0) + F.when(width >= 1200, 0.8).otherwise(0.0) + F.when(height.between(40, 180), 1.0).otherwise(0.0)
    if text_score is None:
        return T.py_round(score + 1.2, 4)
    return T.py_round(score + F.when(T.strip(F.coalesce(text, F.lit(""))) != "", text_score * 0.85).otherwise(1.2), 4)


def too_long(f: Column, rules: LaneRules) -> Column:
    out = f["word_count"] > rules.max_words
    return out if rules.max_chars is None else out | (f["char_count"] > rules.max_chars)


def trivial(text: Column, f: Column, score: Column, rules: LaneRules, profile: Profile = DEVANAGARI, stripped: bool = False) -> Column:
    bare = text if stripped else T.strip(text)
    floor = 8 if rules.min_chars is None else rules.min_chars
    out = (f["char_count"] < floor) | ~T.in_band(f["char_count"], rules.min_chars, rules.max_chars)
    out = out | (f["word_count"] < rules.min_words) | (f["word_count"] > rules.max_words)
    out = out | ((f["word_count"] <= 1) & (score < 2.5))
    for pattern in profile.trivial:
        out = out | bare.rlike(pattern)
    return out


def ordinary_prose(text: Column, f: Column, profile: Profile = DEVANAGARI, stripped: bool = False) -> Column:
    """Flowing text without digits, money, identifiers and hard signs."""
    bare = text if stripped else T.strip(text)
    light = f["colon_count"] + f["semicolon_count"] + f["bracket_count"] + f["hyphen_count"] + f["dash_count"]
    none = (f["native_digit_count"] + f["ascii_digit_count"] + f["currency_count"] + f["percent_count"] + f["slash_count"] == 0) & (f["identifier_likeness_score"] == 0)
    return (bare != "") & none & ~text.rlike(profile.hard_punct) & (light <= 2) & (f["special_character_density"] <= 0.06)


def strong_signals(f: Column) -> Column:
    """Several structural signs of hardness together."""
    digits, likeness, money = f["native_digit_count"], f["identifier_likeness_score"], f["currency_count"] + F.lit(0)
    return (digits >= 2) | ((digits >= 1) & ((likeness > 0) | (f["slash_count"] >= 1) | (f["symbol_count"] >= 3))) | (likeness >= 1.5) | ((money >= 1) & ((digits >= 1) | (f["symbol_count"] >= 2)))


def scored(df: DataFrame, text: str, profile: Profile = DEVANAGARI, rules: LaneRules | None = None, f: str = "features", score: str = "complexity_score") -> DataFrame:
    """``df`` with the feature struct, score and flags of a text column."""
    rules = rules or LaneRules(allow_ascii_digits=profile.allow_ascii_digits)
    out = df.withColumn("_clean", T.bound(T.nfc(F.col(text)))).withColumn("_signs", T.bound(signs_of(F.col("_clean"))))
    out = out.withColumn(f, T.bound(features(F.col("_clean"), profile, F.col("_signs")))).drop("_clean", "_signs")
    out = out.withColumn(score, complexity(F.col(f)))
    out = out.withColumn("_bare", T.bound(T.strip(F.coalesce(F.col(text), F.lit("")))))
    c, bare = F.col(f), F.col("_bare")
    long_ = too_long(c, rules)
    out = out.withColumns(
        {
            "word_count": c["word_count"],
            "char_count": c["char_count"],
            "is_too_long": long_,
            "is_trivial": trivial(bare, c, F.col(score), rules, profile, True) | long_,
            "is_ordinary": ordinary_prose(bare, c, profile, True),
            "is_strong": strong_signals(c),
            "contains_native_numerals": c["native_digit_count"] > 0,
            "contains_special_chars": c["symbol_count"] > 0,
            "contains_reference_identifier": c["identifier_likeness_score"] > 0,
            "contains_conjuncts": c["conjunct_estimate"] > 0,
        }
    )
    return out.drop("_bare")


def lane(rules: LaneRules, label: Column | None = None, score: Column | None = None, f: Column | None = None) -> Column:
    """The decision of a scored row as a struct: difficulty, score, source and
    reason.  ``label`` is a verdict from outside (hard, normal or reject)."""
    f = F.col("features") if f is None else f
    score = F.col("complexity_score") if score is None else score
    told = F.lower(T.strip(F.coalesce(label, F.lit("")))) if label is not None else F.lit("")
    known = told.isin(HARD, NORMAL, REJECT)
    weak = F.col("is_trivial") & ~((f["native_digit_count"] > 0) | (f["identifier_likeness_score"] > 0))
    mid = F.col("word_count").between(rules.normal_min_words, rules.normal_max_words)
    plain = F.col("is_ordinary") & mid
    clamped = F.least(score, F.lit(rules.max_normal))

    def made(difficulty, value, source: str, reason: str | None):
        difficulty = F.lit(difficulty) if isinstance(difficulty, str) else difficulty
        return F.struct(difficulty.alias("difficulty"), value.alias("complexity_score"), F.lit(source).alias("hard_signal_source"), F.lit(reason).cast("string").alias("reject_reason"))

    out = F.when((f["ascii_digit_count"] > 0) & F.lit(not rules.allow_ascii_digits), made(REJECT, score, "none", "ascii_digits"))
    out = out.when(told == REJECT, made(REJECT, score, "llm", "llm_complexity_reject"))
    out = out.when(known & weak, made(REJECT, score, "llm", "trivial_or_too_long"))
    out = out.when((told == HARD) & plain & ~F.col("is_strong"), made(NORMAL, clamped, "llm_demoted_ordinary", None))
    out = out.when(known, made(told, score, "llm", None))
    out = out.when(weak, made(REJECT, score, "none", "trivial_or_too_long"))
    out = out.when(plain, made(NORMAL, clamped, "heuristic_ordinary", None))
    out = out.when(F.col("is_strong") & (score >= rules.min_hard), made(HARD, score, "heuristic_strong", None))
    return out.otherwise(made(REJECT, score, "none", "weak_complexity_awaiting_llm_or_stronger_signals"))


def classify(df: DataFrame, text: str = "text", profile: Profile = DEVANAGARI, rules: LaneRules | None = None, label: str | None = None, score_override: str | None = None) -> DataFrame:
    """Score and assign every row; the decision's fields become columns."""
    rules = rules or LaneRules(allow_ascii_digits=profile.allow_ascii_digits)
    out = scored(df, text, profile, rules)
    score = F.col("complexity_score") if score_override is None else F.coalesce(F.col(score_override), F.col("complexity_score"))
    out = out.withColumn("_lane", T.bound(lane(rules, None if label is None else F.col(label), score)))
    return out.withColumns({n: F.col("_lane")[n] for n in ("difficulty", "complexity_score", "hard_signal_source", "reject_reason")}).drop("_lane")


def demote_unconfirmed(difficulty: Column, source: Column, strong: Column) -> Column:
    """Hard rows without a verdict stay only with strong signals."""
    open_ = (difficulty == HARD) & (F.coalesce(source, F.lit("")) != "llm")
    keep = F.struct(difficulty.alias("difficulty"), source.alias("hard_signal_source"), F.lit(None).cast("string").alias("reject_reason"))
    strong_ = F.struct(difficulty.alias("difficulty"), F.lit("heuristic_strong_soft_fail").alias("hard_signal_source"), F.lit(None).cast("string").alias("reject_reason"))
    out = F.struct(F.lit(REJECT).alias("difficulty"), F.lit("demoted_soft_fail").alias("hard_signal_source"), F.lit("hard_unconfirmed_llm_soft_fail").alias("reject_reason"))
    return F.when(~open_, keep).when(strong, strong_).otherwise(out)


def add_reasons(reasons: Column, *more: Column) -> Column:
    """Distinct reasons in order of appearance; null ones are left out."""
    old = F.coalesce(reasons, F.array().cast("array<string>"))
    return F.array_distinct(F.concat(old, F.array_compact(F.array(*more))))
