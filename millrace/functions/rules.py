"""Rule validation of texts, images and limits."""

from __future__ import annotations

from typing import Any

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.functions.profiles import Profile


def text_issues(text: Column, profile: Profile, min_len: int = 8, min_words: int = 2, max_words: int = 50, min_chars: int | None = None, max_chars: int | None = None) -> Column:
    """Ordered issues of a label text; it is fine when there are none."""
    text = F.coalesce(text, F.lit(""))
    n, words = T.char_count(text), T.word_count(text)
    found = [
        F.when(T.strip(text) == "", "empty_text"),
        F.when(n < (min_len if min_chars is None else min_chars), "too_short"),
        F.when(words < min_words, "too_few_words"),
        F.when(words > max_words, F.format_string(f"too_many_words:%d>{max_words}", words)),
        *T.band_issues(n, min_chars, max_chars),
    ]
    if profile.native_digits_only:
        found.append(T.digit_policy(text))
    if not profile.allow_latin:
        found.append(F.when(text.rlike("[A-Za-z]"), "latin_letters"))
    return F.concat(F.array_compact(F.array(*found)), T.unicode_issues(text))


def text_checks(text: Column, profile: Profile, **limits: Any) -> Column:
    """Struct of the text rules.  A match with an image is never claimed."""
    issues = text_issues(text, profile, **limits)
    return F.struct((F.size(issues) == 0).alias("ok"), issues.alias("issues"), T.char_count(text).alias("char_count"), F.lit(False).alias("image_text_match_verified"), F.lit(True).alias("requires_human_review"))


def laplacian_variance(gray: np.ndarray) -> float:
    """Variance of the four-neighbour Laplacian with repeated edges."""
    g = np.pad(np.asarray(gray, dtype=np.float64), 1, mode="edge")
    centre = g[1:-1, 1:-1]
    return float((g[:-2, 1:-1] + g[2:, 1:-1] + g[1:-1, :-2] + g[1:-1, 2:] - 4.0 * centre).var())


def image_issues(width: Column, height: Column, blur: Column, contrast: Column, min_width: int = 800, min_height: int = 100, min_aspect: float = 4.0, max_height: int = 400, min_blur: float = 20.0, min_contrast: float = 15.0) -> Column:
    """Ordered issues from the measures of an image; null width: missing."""
    aspect = width / F.greatest(height, F.lit(1))
    found = [
        F.when(width < min_width, "narrow_width"),
        F.when(height < min_height, "short_height"),
        F.when(height > max_height, "too_tall"),
        F.when(aspect < min_aspect, "low_aspect"),
        F.when(blur < min_blur, "blurry"),
        F.when(contrast < min_contrast, "low_contrast"),
    ]
    return F.when(width.isNull(), F.array(F.lit("missing_file"))).otherwise(F.array_compact(F.array(*found)))


def blocking_image_issues(issues: Column) -> Column:
    """Only missing and corrupt files reject a row."""
    return F.filter(issues, lambda i: (i == "missing_file") | i.startswith("corrupt"))


def word_limits(config: dict[str, Any], low: int | None = None, high: int | None = None) -> tuple[int, int]:
    low = int(config.get("min_word_count", 2)) if low is None else int(low)
    high = int(config.get("max_word_count", 50)) if high is None else int(high)
    return _ordered(low, high, "word")


def char_limits(config: dict[str, Any], low: int | None = None, high: int | None = None) -> tuple[int | None, int | None]:
    """No band at all unless it is asked for or enforced."""
    if low is None and high is None and not config.get("enforce_char_count"):
        return None, None
    given = lambda value, key, default: int(value if value is not None else config.get(key) if config.get(key) is not None else default)
    return _ordered(given(low, "min_char_count", 4), given(high, "max_char_count", 25), "char")


def _ordered(low: int, high: int, what: str) -> tuple[int, int]:
    low = max(1, low)
    if high < low:
        raise ValueError(f"the largest {what} count, {high}, is below the smallest, {low}")
    return low, high


def crop_height(max_words: int, configured: int) -> int:
    """Longer spans may be taller."""
    for words, height in ((20, 0), (50, 360), (100, 520)):
        if max_words <= words:
            return max(configured, height)
    return max(configured, 720)


def crop_width(max_chars: int | None, configured: int) -> int:
    """Short spans may be narrower."""
    for chars, width in ((25, 80), (40, 200)):
        if max_chars is not None and max_chars <= chars:
            return min(configured, width)
    return configured


def crop_aspect(max_chars: int | None, configured: float) -> float:
    return min(configured, 1.15) if max_chars is not None and max_chars <= 25 else configured
