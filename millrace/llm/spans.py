"""Native span finding: regular expressions with positions, as columns.

Spark can extract all matches of a pattern and can split a text at them, but
tells no positions; the lengths of the gaps and of the matches in turn give
them, in code points, since the two walk the same matches.  Everything here is
a column expression and stays on the JVM.

Patterns use possessive quantifiers, which the JVM matches in a loop: long runs
neither backtrack nor exhaust the stack.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fresh

_SIZES = """NO15 BE16 DK18 FI18 FO18 GL18 NL18 MK19 SI19 AT20 BA20 EE20 KZ20 LT20 LU20 XK20 CH21 HR21 LI21 LV21 BG22 BH22
CR22 DE22 GB22 GE22 IE22 ME22 RS22 VA22 AE23 GI23 IL23 IQ23 TL23 AD24 CZ24 ES24 MD24 PK24 RO24 SA24 SE24 SK24 TN24 VG24
LY25 PT25 ST25 IS26 TR26 FR27 GR27 IT27 MC27 MR27 SM27 AL28 AZ28 BY28 CY28 DO28 GT28 HU28 LB28 PL28 SV28 EG29 BR29 PS29
QA29 UA29 JO30 KW30 MU30 MT31 SC31 LC32"""
ACCOUNT_SIZES = {x[:2]: int(x[2:]) for x in _SIZES.split()}
SPAN = "array<struct<start:int,end:int,match:string,score:double>>"


@dataclass(frozen=True)
class Kind:
    """One kind of span.  ``needs`` are strings one of which every match
    contains (a cheap test before the pattern); ``valid`` judges a match;
    ``parts`` gives the spans inside a match whose ends no pattern can tell;
    ``score``, ``context`` and ``against`` weigh kinds that a pattern alone
    cannot decide."""

    name: str
    pattern: str
    needs: tuple[str, ...] = ()
    valid: Callable[[Column], Column] | None = None
    parts: Callable[[Column], Column] | None = None
    base: bool = True
    score: float = 1.0
    context: str = ""
    against: str = ""
    version: int = 1


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]+", "")


def luhn(match: Column) -> Column:
    """Do the digits of ``match`` pass the Luhn checksum?"""
    turned = F.reverse(digits_of(match))

    def add(total: Column, i: Column) -> Column:
        digit = F.ascii(F.substr(turned, i, F.lit(1))) - 48
        doubled = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) % 10 == 0


def mod97(match: Column) -> Column:
    """Does an account number leave 1 modulo 97 (first four characters last,
    letters as 10 to 35)?"""
    plain = F.upper(F.regexp_replace(match, r"\x20", ""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))

    def add(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substr(turned, i, F.lit(1)))
        return F.when(code >= 65, rest * 100 + code - 55).otherwise(rest * 10 + code - 48) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def accounts(match: Column) -> Column:
    """Account numbers inside words divided by single blanks, from left to
    right: of the ends at a word's end that pass ``mod97``, the one at the
    country's length, else the last."""
    words, sizes = F.split(match, " ", -1), F.create_map(*[F.lit(x) for pair in ACCOUNT_SIZES.items() for x in pair])
    none = F.array().cast("array<struct<start:int,end:int,match:string>>")

    def ends(near: Column) -> Column:
        def one(n: Column) -> Column:
            spaced = F.array_join(F.slice(near, F.lit(1), n), " ")
            plain = F.regexp_replace(spaced, " ", "")
            usual = F.coalesce(sizes[F.substr(plain, F.lit(1), F.lit(2))] == F.length(plain), F.lit(False))
            good = F.when(plain.rlike(r"^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$"), mod97(plain)).otherwise(False)
            return F.struct(good.alias("good"), usual.alias("usual"), F.length(spaced).alias("n"), spaced.alias("match"))

        tried = F.transform(F.sequence(F.lit(1), F.size(near)), one)
        return F.array_max(F.filter(tried, lambda x: x["good"]))

    def step(acc: Column, word: Column) -> Column:
        opens = (acc["at"] >= acc["free"]) & word.rlike("^[A-Z]{2}[0-9]{2}")
        found = F.when(opens, ends(F.slice(acc["words"], acc["i"] + 1, F.lit(31))))
        stop = acc["at"] + found["n"]
        span = F.struct(acc["at"].alias("start"), stop.alias("end"), found["match"].alias("match"))
        return F.struct(
            acc["words"].alias("words"),
            (acc["i"] + 1).alias("i"),
            (acc["at"] + F.length(word) + 1).alias("at"),
            F.coalesce(stop, acc["free"]).alias("free"),
            F.when(found.isNotNull(), F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"),
        )

    begin = F.struct(words.alias("words"), F.lit(0).alias("i"), F.lit(0).alias("at"), F.lit(0).alias("free"), none.alias("spans"))
    return F.aggregate(words, begin, step, lambda acc: acc["spans"])


def _found(text: Column, kind: Kind) -> Column:
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    if not kind.needs:
        return found
    test = F.lit(False)
    for part in kind.needs:
        test = test | F.contains(text, F.lit(part))
    return F.when(test, found).otherwise(F.array().cast("array<string>"))


def _placed(text: Column, kind: Kind, found: Column) -> Column:
    """Spans of the matches ``found``, positions from the gaps between them."""
    gaps = F.split(text, kind.pattern, -1)
    pairs = F.zip_with(found, F.slice(gaps, 1, F.size(found)), lambda m, g: F.struct(m.alias("m"), g.alias("g")))
    none = F.array().cast(SPAN)

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["g"])
        end = start + F.length(x["m"])
        score = F.lit(float(kind.score)).alias("score")
        span = F.struct(start.alias("start"), end.alias("end"), x["m"].alias("match"), score)
        if kind.parts:
            inner = F.transform(kind.parts(x["m"]), lambda p: F.struct((start + p["start"]).alias("start"), (start + p["end"]).alias("end"), p["match"].alias("match"), score))
            return F.struct(end.alias("at"), F.concat(acc["spans"], inner).alias("spans"))
        good = kind.valid(x["m"]) if kind.valid else F.lit(True)
        return F.struct(end.alias("at"), F.when(good, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    walked = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda acc: acc["spans"])
    return F.when(F.size(found) > 0, walked).otherwise(none)


def find_spans(df: DataFrame, text: str, kinds: list[Kind], wanted: Callable[[Kind], Column] | None = None, threshold: float = 0.6, reach: int = 40) -> DataFrame:
    """``df`` with one span column per kind, named after the kind.

    ``wanted`` may switch a kind off by row.  Every span tells its score.  Kinds
    with a ``score`` below 1 gain 0.4 when one of their context words stands
    within ``reach`` code points before the span or behind it, lose 0.3 by a
    word ``against`` them there, and stay from ``threshold`` on.
    """
    spots = dict(zip([k.name for k in kinds], fresh([*df.columns, *(k.name for k in kinds)], *[f"found_{k.name}" for k in kinds]), strict=True))
    body = F.col(text)
    first = {}
    for k in kinds:
        found = _found(body, k)
        first[spots[k.name]] = F.when(wanted(k), found).otherwise(F.array().cast("array<string>")) if wanted else found
    out = df.withColumns(first).withColumns({k.name: _placed(body, k, F.col(spots[k.name])) for k in kinds})
    scored = {k.name: F.when(F.size(k.name) > 0, _in_context(body, k, threshold, reach)).otherwise(F.col(k.name)) for k in kinds if k.score < 1}
    out = out.withColumns(scored) if scored else out
    return out.drop(*spots.values())


def _in_context(body: Column, kind: Kind, threshold: float, reach: int) -> Column:
    """The spans whose score, moved by the words nearby, is enough."""

    def weighed(span: Column) -> Column:
        begin = F.greatest(span["start"] - reach, F.lit(0))
        # the words around it, not those that a number itself may spell
        around = F.lower(F.concat(F.substr(body, begin + 1, span["start"] - begin), F.lit(" "), F.substr(body, span["end"] + 1, F.lit(reach))))
        has = lambda words, weight: F.when(around.rlike(words), weight).otherwise(0.0) if words else F.lit(0.0)
        score = F.round(F.lit(kind.score) + has(kind.context, 0.4) - has(kind.against, 0.3), 2)
        return span.withField("score", F.least(score, F.lit(1.0)))

    return F.filter(F.transform(kind.name, weighed), lambda span: span["score"] >= threshold)


def _listed(name: str, rank: int, by_start: bool) -> Column:
    """Sortable texts of one kind's spans."""

    def one(span: Column) -> Column:
        start, kind = span["start"], F.lit(rank)
        text = F.concat(F.lit(name + ":"), start.cast("string"), F.lit(":"), span["end"].cast("string"))
        return F.struct((start if by_start else kind).alias("a"), (kind if by_start else start).alias("b"), text.alias("t"))

    return F.transform(F.col(name), one)


def joined(kinds: list[Kind], by_start: bool) -> Column:
    """``kind:start:end`` of the kinds' span columns, comma-joined: by kind and
    start, or by start and kind."""
    listed = [_listed(k.name, i, by_start) for i, k in enumerate(kinds)]
    return F.array_join(F.transform(F.sort_array(F.concat(*listed)), lambda x: x["t"]), ",")
