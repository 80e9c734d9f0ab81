"""Text scalars as column expressions.

Everything runs on the JVM; normalisation to NFC is the static method of the
Unicode library that Spark ships with, called only for rows that hold a
character that NFC may change.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.profiles import ASCII_DIGITS, JOINERS, MATRA, SPACE, VIRAMA, Profile

# A superset of the characters that NFC can change or combine.
_UNSTABLE = (
    r"[[^\x00-\x{2FF}]&&[\p{M}\x{0340}-\x{0345}\x{0374}\x{037E}\x{0387}\x{0958}-\x{095F}\x{09DC}-\x{09DF}\x{0A33}-\x{0A5E}\x{0B5C}\x{0B5D}"
    r"\x{0F43}-\x{0FB9}\x{1100}-\x{11FF}\x{1F00}-\x{1FFF}\x{2000}\x{2001}\x{2126}\x{212A}\x{212B}\x{2329}\x{232A}\x{2ADC}"
    r"\x{F900}-\x{FAFF}\x{FB1D}-\x{FB4F}\x{1D100}-\x{1D1FF}\x{2F800}-\x{2FA1F}]]"
)
# One blank of SPACE; the first test settles nearly every character.
BLANK = rf"[[^!-~\x{{A1}}-\x{{167F}}]&&[{SPACE}]]"
NOT_PLAIN = rf"[[^\x20-~\x{{A1}}-\x{{167F}}]&&[{SPACE}]]"


def nfc(text: Column) -> Column:
    """Text in normal form C; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    composed = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(False))
    return F.when((F.octet_length(text) != F.length(text)) & text.rlike(_UNSTABLE), composed).otherwise(text)


def strip(text: Column) -> Column:
    """Without white space at either end, Unicode white space included."""
    ends = F.concat(F.left(text, F.lit(1)), F.right(text, F.lit(1)))
    return F.when(ends.rlike(BLANK), F.regexp_replace(text, rf"^{BLANK}++|{BLANK}++$", "")).otherwise(text)


def collapse(text: Column) -> Column:
    """Runs of white space as one blank; single blanks need no change."""
    return F.regexp_replace(text, rf"{BLANK}{{2,}}+|{NOT_PLAIN}", " ")


def without_joiners(text: Column) -> Column:
    return F.translate(text, JOINERS, "")


def first_truthy(*columns: Column) -> Column:
    """The first value that is neither null nor empty; else empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def count_chars(text: Column, alphabet: str) -> Column:
    """Occurrences of the characters of ``alphabet``."""
    if not alphabet:
        return F.lit(0)
    return F.length(text) - F.length(F.translate(text, alphabet, ""))


def count_of(text: Column, part: str) -> Column:
    """Non-overlapping occurrences of a string."""
    return F.floor((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)).cast("int")


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, rf"{BLANK}++"), "")


def word_count(text: Column) -> Column:
    return F.size(words_of(F.coalesce(text, F.lit(""))))


def for_char_count(text: Column) -> Column:
    return nfc(without_joiners(F.coalesce(text, F.lit(""))))


def char_count(text: Column) -> Column:
    """Code points after NFC, without joiners and outer white space."""
    return F.length(strip(for_char_count(text)))


def in_band(n: Column, low: int | None, high: int | None) -> Column:
    ok = F.lit(True)
    if low is not None:
        ok = ok & (n >= low)
    if high is not None:
        ok = ok & (n <= high)
    return ok


def band_issues(n: Column, low: int | None, high: int | None) -> list[Column]:
    """Issue texts, null where there is none."""
    out = []
    if low is not None:
        out.append(F.when(n < low, F.format_string(f"too_few_chars:%d<{low}", n)))
    if high is not None:
        out.append(F.when(n > high, F.format_string(f"too_many_chars:%d>{high}", n)))
    return out


def for_dedup(text: Column) -> Column:
    """NFC without any white space."""
    return F.regexp_replace(nfc(text), rf"{BLANK}++", "")


def for_compare(text: Column) -> Column:
    """Without joiners, NFC, stripped, white space collapsed."""
    return collapse(strip(for_char_count(text)))


def for_strict(text: Column) -> Column:
    return strip(F.coalesce(text, F.lit("")))


def has_ascii_digits(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike("[0-9]")


def has_native_digits(text: Column, profile: Profile) -> Column:
    return F.coalesce(text, F.lit("")).rlike(f"[{profile.native_digit_class}]")


def digit_policy(text: Column) -> Column:
    """Message of the native-digits-only rule, null if it is kept."""
    return F.when(has_ascii_digits(text), F.lit("expected_text contains ASCII digits 0-9; only ०-९ allowed"))


def to_native_digits(text: Column, profile: Profile) -> Column:
    return F.translate(text, ASCII_DIGITS, profile.native_digits)


def conjuncts(text: Column) -> Column:
    return count_chars(text, VIRAMA)


def matra_score(text: Column) -> Column:
    return F.least(F.regexp_count(text, F.lit(MATRA)), F.lit(20)).cast("double") * 0.08


def mostly_block(text: Column, profile: Profile, least: float = 0.5) -> Column:
    """Do letters of the profile's block make up the share ``least``?"""
    text = F.coalesce(text, F.lit(""))
    letters = F.regexp_count(text, F.lit(rf"[\p{{L}}{profile.block_class}]"))
    own = F.regexp_count(text, F.lit(f"[{profile.block_class}]"))
    return (letters == 0) | (own / F.greatest(letters, F.lit(1)) >= least)


def unicode_issues(text: Column) -> Column:
    """Ordered issues: replacement character, not in NFC, one entry for each
    control character; a null text has the issue null_text alone."""
    clean = without_joiners(F.coalesce(text, F.lit("")))
    controls = F.regexp_extract_all(clean, F.lit(r"[\p{C}&&[^\n\t]]"), F.lit(0))
    named = F.transform(controls, lambda c: F.format_string("control_char_U+%04X", code_point(c)))
    first = F.array_compact(F.array(F.when(F.contains(text, F.lit("�")), "replacement_character"), F.when(nfc(clean) != clean, "not_nfc_normalized")))
    return F.when(text.isNull(), F.array(F.lit("null_text"))).otherwise(F.concat(first, named))


def unicode_report(text: Column, profile: Profile, least: float = 0.5) -> Column:
    """Struct (ok, issues, text, mostly_native): the issues of a text, its form
    C, and whether the profile's block holds most of its letters."""
    issues = unicode_issues(text)
    return F.struct((F.size(issues) == 0).alias("ok"), issues.alias("issues"), nfc(text).alias("text"), mostly_block(text, profile, least).alias("mostly_native"))


def code_point(char: Column) -> Column:
    """Code point of a one-character string, from its UTF-32 form."""
    return F.conv(F.hex(F.encode(char, "UTF-32")), 16, 10).cast("int")


def encoding_ok(text: Column, profile: Profile) -> Column:
    """Only white space, the profile's block, ASCII without letters,
    punctuation and symbols?"""
    block = r"\x{0900}-\x{097F}" if profile.name == "devanagari" else profile.block_class
    return ~text.rlike(rf"[^{SPACE}{block}\p{{P}}\p{{S}}\x00-\x40\x5B-\x60\x7B-\x7F]")


def normalise_line(text: Column, allow_ascii_digits: bool) -> Column:
    """Stripped and collapsed without joiners; null if it holds ASCII digits
    that the profile does not allow."""
    clean = without_joiners(collapse(strip(F.coalesce(text, F.lit("")))))
    return clean if allow_ascii_digits else F.when(~has_ascii_digits(clean), clean)


def region_type(text: Column, profile: Profile) -> Column:
    """First matching rule; long lines are paragraphs, the rest text lines."""
    out = None
    for label, pattern in profile.region_rules:
        out = F.when(text.rlike(pattern), label) if out is None else out.when(text.rlike(pattern), label)
    return out.when(F.length(text) > 80, "paragraph_section").otherwise("text_line")


def issue_type(text: Column, profile: Profile, crop_type: Column | None = None) -> Column:
    """Label of what makes a text hard to recognise."""
    digits, dates = profile.native_digit_class, F.lit(False)
    for word in profile.date_words:
        dates = dates | F.contains(text, F.lit(word))
    out = F.when(text.rlike(profile.reference_issue), "complex_reference_number")
    out = out.when(text.rlike(f"[{digits}][^\\n]*[{digits}]") & text.rlike("[/.]"), f"{'marathi' if profile.name == 'devanagari' else 'native'}_numerals")
    out = out.when(text.rlike(r"[/₹%()\[\]—]"), "special_chars_issue").when(dates, "date_issue")
    out = out.when(conjuncts(text) >= 3, "conjunct_character_issue")
    if crop_type is not None:
        out = out.when(crop_type == "legal_text", "legal_text")
    return out.otherwise("dense_document_text")


def html_to_text(html: Column) -> Column:
    return F.trim(collapse(F.regexp_replace(F.coalesce(html, F.lit("")), "<[^>]+>", " ")))


def data_url(content: Column, mime: str = "image/png") -> Column:
    return F.concat(F.lit(f"data:{mime};base64,"), F.regexp_replace(F.base64(content), r"\s", ""))


def json_in_text(text: Column) -> Column:
    """The JSON object in a reply: the whole text, a fenced block, or what is
    between the first and the last brace; null if none of them parses."""
    text = strip(F.coalesce(text, F.lit("")))
    fence = F.regexp_extract(text, r"(?s)```(?:json)?\s*(\{.*?\})\s*```", 1)
    brace = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    pick = [F.when(is_json(c), c) for c in (text, fence, brace)]
    return F.coalesce(*pick)


def is_json(text: Column) -> Column:
    return (text != "") & F.get_json_object(text, "$").isNotNull()


def bound(value: Column) -> Column:
    """``value``, evaluated once however often the result is used.

    The condition is always true, but the optimizer takes it for one that is
    not deterministic; so it neither copies the expression into what refers to
    it nor pushes filters on it below, which would copy it into the filter.
    """
    return F.when(F.spark_partition_id() >= 0, value)


def py_round(value: Column, digits: int) -> Column:
    """Round as Python does: the exact binary value decides, ties to even.

    ``value * 10**digits`` is formed without error as a sum of two doubles, so
    that a value just beside a tie is told from one on it.
    """
    scale = float(10**digits)

    def rounded(v: Column) -> Column:
        split = v * 134217729.0
        high = split - (split - v)
        product = v * scale
        error = (high * scale - product) + (v - high) * scale
        base = F.floor(product).cast("double")
        beyond = (product - base - 0.5) + error
        up = (beyond > 0) | ((beyond == 0) & (base % 2 != 0))
        return (base + F.when(up, 1.0).otherwise(0.0)) / scale

    return F.get(F.transform(F.array(value.cast("double")), rounded), F.lit(0))
