"""Scoring, rules and rounding on literals of the domain."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import rules as R
from millrace.functions import scoring as S
from millrace.functions import text as T
from millrace.functions.profiles import DEVANAGARI

SLASHED = ["कृषी/पशुसंवर्धन/दुग्धव्यवसाय/मत्स्यव्यवसाय विभाग", "सचिव/उपसचिव/अवर सचिव/कक्ष अधिकारी", "शहर/तालुका/गाव/वाडी यांची यादी", "जल/जमीन/जंगल/प्राणी संवर्धन"]
PROSE = "राज्यातील सर्व नागरिकांना या योजनेचा लाभ घेता येईल"


def lane(spark, text, label=None):
    df = spark.createDataFrame([(text, label)], "text string, label string")
    return S.classify(df, "text", DEVANAGARI, S.LaneRules(), "label").first()


@pytest.mark.parametrize("text", SLASHED)
def test_slashes_alone_are_not_hard(spark, text):
    assert lane(spark, text)["difficulty"] != "hard"


def test_verdict_can_promote_titles_but_not_prose(spark):
    assert (lane(spark, SLASHED[0], "hard")["difficulty"], lane(spark, SLASHED[0], "hard")["hard_signal_source"]) == ("hard", "llm")
    row = lane(spark, PROSE, "hard")
    assert (row["difficulty"], row["hard_signal_source"]) == ("normal", "llm_demoted_ordinary")
    assert row["complexity_score"] <= 2.5


def test_list_marker_is_ordinary(spark):
    assert lane(spark, "(क) " + PROSE)["difficulty"] == "normal"


def test_numerals_with_separators_are_hard(spark):
    row = lane(spark, "शासन क्रमांक २०२२/प्र.क्र.३५७/का.१४ दिनांक १२/०५/२०२२")
    assert (row["difficulty"], row["hard_signal_source"]) == ("hard", "heuristic_strong")


def test_ascii_digits_reject(spark):
    row = lane(spark, "क्रमांक 357 बाबत माहिती")
    assert (row["difficulty"], row["reject_reason"]) == ("reject", "ascii_digits")


def test_demotion(spark):
    out = S.demote_unconfirmed(F.lit("hard"), F.lit("none"), F.lit(False))
    assert spark.range(1).select(out.alias("x")).first()["x"]["hard_signal_source"] == "demoted_soft_fail"


def test_rounding_is_that_of_the_exact_value(spark):
    rng = random.Random(5)
    values = [2.675, 0.285, 1.005, 2.5, 0.00005, 1.00015, 12.34565] + [rng.uniform(0, 30) for _ in range(3000)] + [round(rng.uniform(0, 30), 5) for _ in range(3000)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", T.py_round(F.col("v"), 4).alias("r")).collect()
    assert all(r["r"] == round(r["v"], 4) for r in rows)


def test_text_issues(spark):
    df = spark.createDataFrame([("abc 1",), ("",), (None,), (PROSE,), ("क\u0007ख " + PROSE,)], "t string")
    got = [r[0] for r in df.select(R.text_issues(F.col("t"), DEVANAGARI)).collect()]
    assert got[0][0] == "too_short" and "latin_letters" in got[0]
    assert got[1][0] == got[2][0] == "empty_text"
    assert got[3] == [] and got[4] == ["control_char_U+0007"]


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(alphabet="aA1./-  ‍क्षत्र९₹(é", max_size=30), min_size=40, max_size=60))
def test_counts_agree_with_python(spark, texts):
    import re
    import unicodedata

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", "t", T.char_count(F.col("t")).alias("n"), T.word_count(F.col("t")).alias("w"), T.nfc(F.col("t")).alias("c")).collect()
    for r in rows:
        clean = unicodedata.normalize("NFC", r["t"].replace("‍", "").replace("‌", ""))
        assert r["n"] == len(clean.strip())
        assert r["w"] == len([w for w in re.split(r"\s+", r["t"].strip()) if w])
        assert r["c"] == unicodedata.normalize("NFC", r["t"])


def test_laplacian_of_a_flat_image_is_zero():
    import numpy as np

    assert R.laplacian_variance(np.full((5, 7), 9)) == 0
    with pytest.raises(ValueError):
        R.word_limits({}, 5, 3)
    assert R.char_limits({}) == (None, None) and R.char_limits({"enforce_char_count": True}) == (4, 25)
