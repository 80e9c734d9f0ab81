"""Rows from texts and pages: lines, spans, candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import scoring as S
from millrace.functions import text as T
from millrace.functions.profiles import DEVANAGARI, Profile

DISCOVERY_DPI = 180
MAX_LINE_HEIGHT = 72.0
LINES_PER_DOC = 1_000_000_000


def spread(df: DataFrame) -> DataFrame:
    """``df`` over as many tasks as there are cores, if its files give fewer: a
    small table in one piece would leave all but one core idle.  A table of
    more pieces than that is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    pieces = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df if pieces >= cores else df.repartition(cores)


def text_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per line of a text: doc_id, line_no (from 0), line, seq.

    ``seq`` orders all lines as the texts do; null texts have none."""
    kept = [F.col(c) for c in keep or []]
    lines = docs.select(F.col(doc_id).alias("doc_id"), *kept, F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "line"))
    return lines.withColumn("seq", F.col("doc_id") * LINES_PER_DOC + F.col("line_no"))


def scaled_words(words: DataFrame, dpi: int = DISCOVERY_DPI) -> DataFrame:
    """Word boxes from points to pixels."""
    return words.withColumns({c: F.col(c) * (dpi / 72.0) for c in ("x0", "y0", "x1", "y1")})


def page_lines(words: DataFrame, keys: list[str], allow_ascii_digits: bool = False) -> DataFrame:
    """Lines from word boxes: words by x0 (ties as they come), texts joined,
    boxes united; lines without an acceptable text are left out."""
    part = F.struct("x0", "word", "y0", "x1", "y1", "text")
    grouped = words.groupBy(*keys, "block", "line").agg(F.sort_array(F.collect_list(part)).alias("words"), F.min("x0").alias("bx0"), F.min("y0").alias("by0"), F.max("x1").alias("bx1"), F.max("y1").alias("by1"))
    joined = F.array_join(F.transform("words", lambda w: F.coalesce(w["text"], F.lit(""))), " ")
    out = grouped.withColumn("text", T.normalise_line(joined, allow_ascii_digits)).where("text IS NOT NULL AND text != ''")
    return out.withColumns({"bbox_180": F.array("bx0", "by0", "bx1", "by1"), "line_height_180": F.col("by1") - F.col("by0")}).drop("bx0", "by0", "bx1", "by1")


def word_spans(lines: DataFrame, words: str, low: int, high: int) -> DataFrame:
    """All runs of words whose text has ``low`` to ``high`` characters, with
    span_i, span_j (inclusive) and span_text.  ``words`` is an array column of
    texts; a run longer than ``high`` + 1 characters cannot fit, so each start
    takes no more than that many words along, and work is in proportion to the
    words of a line: further columns of ``lines`` are carried if asked for."""
    # where NFC changes nothing and no word vanishes, sizes tell which runs fit, and a fitting run has few words
    bare = F.transform(words, lambda w: F.length(T.without_joiners(w)))
    sure = ~F.array_join(words, " ").rlike(T._UNSTABLE) & (F.array_min(bare) > 0)
    sized = lines.where(F.size(words) > 0).withColumn("_sure", T.bound(F.coalesce(sure, F.lit(False))))
    most = F.when(F.col("_sure"), F.lit(high // 2 + 1)).otherwise(F.lit(high + 1))
    starts = F.transform(words, lambda w, i: F.struct(i.alias("i"), F.slice(words, i + 1, most).alias("ws")))
    at = sized.withColumn("_at", F.explode(starts)).withColumns({"span_i": F.col("_at.i"), "_ws": F.col("_at.ws")}).drop("_at")
    # of a sure start the text of all its words, of which a fitting run is the beginning up to a blank or the end
    at = at.withColumn("_all", T.bound(F.when(F.col("_sure"), T.without_joiners(F.array_join("_ws", " ")))))
    ends = F.filter(F.sequence(F.lit(low), F.lit(high)), lambda n: (n == F.length("_all")) | (F.substr(F.col("_all"), n + 1, F.lit(1)) == " "))
    known = F.transform(ends, lambda n: T.count_chars(F.left(F.col("_all"), n), " "))
    runs = F.when(F.col("_sure"), known).otherwise(F.sequence(F.lit(0), F.size("_ws") - 1))
    both = at.withColumn("_more", F.explode(runs)).withColumn("span_j", F.col("span_i") + F.col("_more"))
    text = F.array_join(F.slice("_ws", F.lit(1), F.col("_more") + 1), " ")
    spanned = both.withColumn("span_text", T.bound(T.normalise_line(text, False))).drop("_sure", "_ws", "_all", "_more").where("span_text IS NOT NULL")
    return spanned.where(T.char_count(F.col("span_text")).between(low, high))


def acceptable(text: Column, profile: Profile) -> Column:
    """Gates that a candidate's text must pass before it is scored."""
    ok = (text != "") & T.encoding_ok(text, profile)
    if not profile.allow_latin:
        ok = ok & ~text.rlike("[A-Za-z]")
    return ok if profile.allow_ascii_digits else ok & ~T.has_ascii_digits(text)


def candidates(units: DataFrame, keys: list[str], profile: Profile = DEVANAGARI, rules: S.LaneRules | None = None, per_line: int = 1, dual_lane: bool = True, least_score: float = 0.0) -> DataFrame:
    """Scored units that pass the gates, the best ``per_line`` of each line
    (``keys``), one per text.  ``units`` has ``text`` and ``unit_no``; with
    ``line_height_180``, lines over ``MAX_LINE_HEIGHT`` are left out."""
    rules = rules or S.LaneRules(allow_ascii_digits=profile.allow_ascii_digits)
    if "line_height_180" in units.columns:
        units = units.where(F.col("line_height_180") <= MAX_LINE_HEIGHT)
    clean = units.withColumn("text", T.normalise_line(F.col("text"), profile.allow_ascii_digits)).where("text IS NOT NULL")
    scored = S.classify(clean.where(acceptable(F.col("text"), profile)), "text", profile, rules)
    if dual_lane:
        scored = scored.where("difficulty != 'reject'")
    else:
        scored = scored.where(~F.col("is_trivial") & ~F.col("is_too_long") & (F.col("complexity_score") >= least_score)).withColumn("difficulty", F.lit("hard"))
    order = Window.partitionBy(*keys).orderBy(F.desc("complexity_score"), "unit_no")
    once = scored.withColumn("_n", F.row_number().over(Window.partitionBy(*keys, "text").orderBy(F.desc("complexity_score"), "unit_no"))).where("_n = 1").drop("_n")
    kept = once.withColumn("unit_rank", F.row_number().over(order)).where(F.col("unit_rank") <= per_line)
    return kept.withColumn("crop_type", T.region_type(F.col("text"), profile))


def pages_without(pages: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Pages that gave no candidate and fall back to visual bands."""
    return pages.join(found.select(*keys).distinct(), keys, "left_anti")


def render_box(df: DataFrame, dpi: int = 600, margin_x: int = 28, margin_y: int = 8, box: str = "bbox_180") -> DataFrame:
    """Crop rectangle (left, top, width, height) in a page image of
    page_width by page_height pixels; rounding is to even."""
    edge = lambda i: F.bround(F.col(box)[i] * (dpi / DISCOVERY_DPI)).cast("int")
    left, top = F.greatest(F.lit(0), edge(0) - margin_x), F.greatest(F.lit(0), edge(1) - margin_y)
    right, bottom = F.least(F.col("page_width"), edge(2) + margin_x), F.least(F.col("page_height"), edge(3) + margin_y)
    return df.withColumn("bbox_render", F.array(left, top, right - left, bottom - top))
