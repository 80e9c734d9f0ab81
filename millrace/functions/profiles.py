"""Script profiles: everything that depends on the script of the texts.

The Devanagari profile carries the fixed constants of the domain; the Latin one
lets the same operators run over Latin text, where the digits 0-9 are native.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# White space as a Unicode-aware splitter sees it, spelled out so
# that the JVM and SQL engines agree on it.
SPACE = r"\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
JOINERS = "‍‌"
ASCII_DIGITS = "0123456789"
SPECIAL_CHARS = "/.,-—–:;()[]*%₹«»“”|"
METRIC_SPECIAL = "/.,-—–:;()[]{}*%₹«»“”|"
BRACKETS = "()[]{}"
HARD_PUNCT = r"[/₹%—–*\[\]]"
VIRAMA = "्"
MATRA = r"[\x{093A}-\x{094C}\x{094E}\x{094F}\x{0955}-\x{0957}\x{0962}\x{0963}]"
CONJUNCTS = ("क्ष", "त्र", "ज्ञ", "श्र", "द्व", "त्त", "द्ध", "क्त", "ण्य", "ल्ल", "प्र", "र्")


@dataclass(frozen=True)
class Profile:
    """Script-dependent constants and policy."""

    name: str
    native_digits: str
    native_digit_class: str
    foreign_digits: str
    letter_class: str
    block_class: str
    currency: tuple[str, ...]
    hard_punct: str = HARD_PUNCT
    special: str = SPECIAL_CHARS
    trivial: tuple[str, ...] = ()
    region_rules: tuple[tuple[str, str], ...] = ()
    reference_issue: str = ""
    date_words: tuple[str, ...] = ()
    reference_span: str = ""
    date_like: str = ""
    allow_ascii_digits: bool = False
    allow_latin: bool = False
    extra: dict[str, str] = field(default_factory=dict)

    @property
    def native_digits_only(self) -> bool:
        return not self.allow_ascii_digits

    def id_pair(self) -> str:
        d, a = self.native_digit_class + "0-9", self.native_digit_class + "0-9A-Za-z" + self.letter_class
        return rf"[{d}]{{1,4}}[{SPACE}]*[./\-–—:][{SPACE}]*[{a}]{{1,8}}"

    def id_chain(self) -> str:
        d, a = self.native_digit_class + "0-9", self.native_digit_class + "0-9A-Za-z" + self.letter_class
        return rf"[{d}]+(?:[{SPACE}]*[./\-–—][{SPACE}]*[{a}]+){{2,}}"


# Fixed values of the Devanagari domain.
DEVANAGARI = Profile(
    name="devanagari",
    native_digits="०१२३४५६७८९",
    native_digit_class="०-९",
    foreign_digits=ASCII_DIGITS,
    letter_class="अ-ह",
    block_class=r"\x{0900}-\x{097F}",
    currency=("₹", "रु."),
    trivial=(r"^महाराष्ट्र\.?$", rf"^आज[{SPACE}]+हवामान", rf"^अचूक[{SPACE}]+प्रतिमेतील", rf"^महाराष्ट्र[{SPACE}]+सुंदर"),
    region_rules=(
        ("reference_identifier", rf"प्र\.?[{SPACE}]*क्र|जा\.?[{SPACE}]*क्र|क्रमांक|शासन[{SPACE}]*निर्णय|अधिसूचना"),
        ("date_line", r"दिनांक|(?U)\bदि\."),
        ("financial", r"रु\.|₹|%"),
        ("numbered_section", r"^[०-९]+[.)]"),
    ),
    reference_issue=rf"प्र\.?[{SPACE}]*क्र|जा\.?[{SPACE}]*क्र|क्रमांक|शासन[{SPACE}]*निर्णय",
    date_words=("दि.", "दिनांक"),
    reference_span=rf"प्र\.?[{SPACE}]*क्र|जा\.?[{SPACE}]*क्र|क्रमांक|का\.[{SPACE}]*[०-९]+|[०-९A-Za-zअ-ह.]+/[०-९A-Za-zअ-ह./-]+",
    date_like=rf"दिनांक|दि\.[{SPACE}]*[०-९]|[०-९]{{1,2}}[./-][०-९]{{1,2}}[./-][०-९]{{2,4}}",
)

# The same structure for Latin text: own digits, own words.
LATIN = Profile(
    name="latin",
    native_digits=ASCII_DIGITS,
    native_digit_class="0-9",
    foreign_digits="",
    letter_class="À-ÖØ-öø-ÿ",
    block_class="A-Za-zÀ-ÖØ-öø-ÿ",
    currency=("€", "EUR"),
    trivial=(r"^[Tt]able of contents\.?$",),
    region_rules=(
        ("reference_identifier", rf"No\.[{SPACE}]*[0-9]|Ref[.:]"),
        ("date_line", r"\b[Dd]ate:|[0-9]{4}-[0-9]{2}-[0-9]{2}"),
        ("financial", r"€|EUR|%"),
        ("numbered_section", r"^[0-9]+[.)]"),
    ),
    reference_issue=rf"No\.[{SPACE}]*[0-9]|Ref[.:]",
    date_words=("date:", "Date:"),
    reference_span=r"Ref[.:]|[0-9A-Za-z.]+/[0-9A-Za-z./-]+",
    date_like=r"[0-9]{1,2}[./-][0-9]{1,2}[./-][0-9]{2,4}",
    allow_ascii_digits=True,
    allow_latin=True,
)
