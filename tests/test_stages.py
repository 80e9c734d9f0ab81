"""Stages over small tables, plug-ins, and their edge cases."""

import itertools
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import scoring as S
from millrace.functions import text as T
from millrace.functions.profiles import DEVANAGARI, LATIN
from millrace.operators import accept as A
from millrace.operators import dedup as D
from millrace.operators import discover as U
from millrace.operators import lines as L
from millrace.operators import select as Q
from millrace.plans import mining as P
from millrace.plans import stages as G
from millrace.plans.queries import QUERIES
from millrace.sources import files, hosted
from millrace.sources import recognisers as X


def test_scoring_without_a_text_layer(spark):
    rows = [(1, "ref 12/34/56 of 2024, 77.5 %", "", 1300, 100), (2, "", "", 1300, 100), (3, None, None, 300, 300), (4, "", "ref 12/34/56 of 2024, 77.5 %", 10, 0)]
    df = spark.createDataFrame(rows, "seq bigint, text_assist string, ocr_prediction string, image_width int, image_height int").withColumn("expected_text", F.lit(""))
    got = {r["seq"]: r for r in G.score_stage(df, LATIN).collect()}
    assert (got[2]["complexity_score"], got[2]["difficulty"], got[2]["hard_signal_source"]) == (4.5, "hard", "visual_provisional")
    assert (got[3]["complexity_score"], got[3]["difficulty"], got[3]["scoring_mode_used"]) == (1.2, "normal", "visual")
    assert got[1]["scoring_mode_used"] == got[4]["scoring_mode_used"] == "text"
    assert {r["seq"] for r in G.score_stage(df, LATIN, skip_visual_only=True).collect()} == {1, 4}
    by_crop = {r["seq"]: r for r in G.score_stage(df, LATIN, mode="visual").collect()}
    assert by_crop[1]["scoring_mode_used"] == "visual"
    assert G.score_stage(df.where("false"), LATIN).count() == 0


def test_duplicates_before_reading(spark):
    box = lambda x: [float(x), 0.0, float(x + 100), 20.0]
    rows = [(1, "p", box(0), "a", [0x0F0F0F0F0F0F]), (2, "p", box(2), "b", [1 << 40]), (3, "p", box(300), "c", [7]), (4, "q", box(0), "d", [7 | 1 << 50]), (5, "q", box(500), "e", [-1]), (6, "q", box(900), "e", [-1]), (7, "q", box(1500), None, None)]
    df = spark.createDataFrame(rows, "seq bigint, page string, box array<double>, sha string, bits array<bigint>")
    got = {r["seq"] for r in G.dedup_before_reading(df, ["page"], "seq", "box", "sha", "bits").collect()}
    assert got == {1, 4, 7}  # 2 overlaps 1, 3 is near the later 4, and of an equal pair both go


def test_different_crops_are_not_near_by_chance(spark, tmp_path):
    # the images of these pairs differ, but agree in all but four of the first 60 bits of their digests
    rows = [(k, 1, 0, 0, 20.0, 1.0) for k in (735175, 4084764, 2748856, 3825663)]
    spark.createDataFrame(rows, "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double").write.parquet(f"{tmp_path}/lineitem.parquet")
    assert {r["seq"] for r in QUERIES["crop_dedup"](spark, str(tmp_path)).collect()} == {k * 1000 + 1 for k, *_ in rows}


def test_duplicates_after_validation(spark):
    text = "the same long line of text with many words in it"
    rows = [(1, "a", [0], text, None, 1.0), (2, "b", [1 << 30], text + " x", None, 2.0), (3, "c", [0xFFFF0000FFFF], "another text altogether", None, 1.0), (4, "d", [0xFFFF0000FFFE], "rejected before", "too_short", 1.0), (5, None, None, "no image here", None, 1.0)]
    df = spark.createDataFrame(rows, "seq bigint, sha string, bits array<bigint>, expected_text string, reject_reason string, complexity_score double")
    got = {r["seq"]: r["reject_reason"] for r in G.dedup_validated(df, "seq", "sha", "bits").collect()}
    # images 1 and 2 are one bit apart and the earlier goes; so do 3 before 4
    assert got == {1: "duplicate_image", 2: None, 3: "duplicate_image", 4: "too_short", 5: None}
    apart = df.withColumn("bits", F.array(F.xxhash64("sha")))
    got = {r["seq"]: r["reject_reason"] for r in G.dedup_validated(apart, "seq", "sha", "bits").collect()}
    assert got[1] == "text_near_duplicate" and got[2] is None and got[3] is None
    kept, flags = G.dedup_reviewed(df, "seq")
    assert {r["seq"] for r in kept.collect()} == {2, 3, 4, 5} and [(r["id_a"], r["id_b"]) for r in flags.collect()] == [(1, 2)]
    assert G.dedup_validated(df.where("false"), "seq", "sha", "bits").count() == 0


def test_prelabelling_fills_no_label_from_a_reading(spark):
    rows = [(1, b"read me", "s1", "", "layer"), (2, b"two", "s2", "kept", "layer"), (3, b"cached", "s3", None, None)]
    df = spark.createDataFrame(rows, "id bigint, image binary, sha256 string, expected_text string, text_assist string")
    cache = spark.createDataFrame([("s3", "echo", "1", "from cache"), ("s2", "echo", "1", None), ("s1", "echo", "0", "old")], "sha256 string, backend string, model_version string, payload string")
    done, entries = G.prelabel(df, cache, "echo", X.EchoBackend, "1")
    got = {r["id"]: (r["ocr_prediction"], r["expected_text"], r["ocr_model_version"]) for r in done.collect()}
    assert got == {1: ("read me", "layer", "1"), 2: ("two", "kept", "1"), 3: ("from cache", "", "1")}
    assert {(r["sha256"], r["payload"]) for r in entries.collect()} == {("s1", "read me"), ("s2", "two")}


def test_tasks_images_and_seeds(spark):
    df = spark.createDataFrame([(1, "s", "line", 3, 9, "hard", "", "assist", "ocr", "a.png", "/p/x.png"), (2, "s", None, None, None, None, None, None, None, "b.png", "/p/y.png")], "id bigint, source_id string, crop_type string, word_count int, char_count int, difficulty string, expected_text string, text_assist string, ocr_prediction string, image_filename string, image_path string")
    tasks = {r["id"]: r for r in G.verdict_tasks(df).collect()}
    assert (tasks[1]["text"], tasks[1]["intended_lane"], tasks[1]["context"]["heuristic_difficulty"]) == ("assist", "hard", "hard")
    assert (tasks[2]["text"], tasks[2]["ocr_prediction"], tasks[2]["intended_lane"]) == ("", "", "")
    there = spark.createDataFrame([("a.png",), ("/p/x.png",), ("/p/x.png",)], "path string")
    assert {r["id"]: r["image"] for r in G.resolved_images(df, there).collect()} == {1: "a.png", 2: None}
    labels = spark.createDataFrame([("x/1.png", "१२", None, None), ("2.png", "ab", "t", True), ("3.png", None, "t", None)], "image_filename string, expected_text string, issue_type string, contains_native_digits boolean")
    images = spark.createDataFrame([("1.png",), ("2.png",), ("2.png",)], "name string")
    seeds = {r["image_filename"]: (r["issue_type"], r["contains_native_digits"]) for r in G.seed_benchmark(labels, images).collect()}
    assert seeds == {"images/1.png": ("", True), "images/2.png": ("t", True)}


def package_rows(spark, n_hard, n_normal):
    rows = [(i, f"s{i % 3}", "hard" if i < n_hard else "normal", f"{chr(97 + i % 26)} line number {'abcdefghij'[i % 10] * (i + 2)} of the package", float(i), i + 6, "verified", f"d{i}", [hash_of(i)]) for i in range(n_hard + n_normal)]
    df = spark.createDataFrame(rows, "seq bigint, source_id string, difficulty string, expected_text string, complexity_score double, word_count int, review_status string, sha256 string, bits array<bigint>")
    empty = {"has_verdict": F.lit(False), "llm_skipped": F.lit(False), "llm_enabled": F.lit(True), "exact_match": F.lit(None).cast("boolean"), "gt_source": F.lit("auto_pdf_text"), "suggested_lane": F.lit(None).cast("string"), "is_complex_for_ocr": F.lit(None).cast("boolean"), "hard_signal_source": F.lit("llm")}
    return df.withColumns(empty)


def hash_of(i):
    return random.Random(i).getrandbits(62)


def test_export_is_blocked_or_complete(spark):
    df = package_rows(spark, 6, 4)
    rows, report = G.export_package(df, 8, 2, 5, LATIN)
    assert rows is None and report.first()["export_blocked"] and not report.first()["quota_met"]
    rows, report = G.export_package(df, 4, 2, 5, LATIN)
    one = report.first()
    assert rows.count() == 6 and one["gate_ok"] and not one["export_blocked"]
    assert json.loads(one["gt_sources"]) == {"auto_pdf_text": 6} and sum(json.loads(one["per_source_counts"]).values()) == 6
    rows, report = G.export_package(df, 4, 2, 1, LATIN)
    assert rows is None and json.loads(report.first()["source_cap_violations"]) and not report.first()["gate_ok"]
    rows, report = G.export_package(df.withColumn("sha256", F.lit("same")), 4, 2, 5, LATIN, allow_shortfall=True)
    assert rows.count() == 6 and report.first()["duplicate_samples"] == 5 and not report.first()["gate_ok"]
    assert [r["image_filename"] for r in G.internal_records(rows, LATIN).orderBy("image_filename").collect()][0] == "/images/0001.png"


def test_rounds_over_documents(spark):
    docs = spark.createDataFrame([(i, "\n".join(f"ref {i}/{k}/20{k} no. {i * k}.5 of [{k}] sum 7,{k} %" for k in range(3)), f"s{i}") for i in range(12)], "doc_id bigint, text string, source string")
    met, history, picked = P.mine_until(docs, P.MiningLoop(hard=9, normal=0, docs=2, growth=2, rounds=5))
    assert met and history[-1][1] >= 9 and picked.count() == history[-1][1] and [h[3] for h in history] == list(itertools.islice(range(2, 99, 2), len(history)))
    met, history, _ = P.mine_until(docs, P.MiningLoop(hard=900, normal=0, docs=2, growth=2, rounds=2))
    assert not met and len(history) == 2


def test_pages_without_candidates_give_bands(spark):
    words = [("p1", 1, 0, 0, 10.0, 10.0, 60.0, 22.0, "ref"), ("p1", 1, 0, 1, 62.0, 10.0, 190.0, 22.0, "12/34/56"), ("p1", 1, 0, 2, 192.0, 10.0, 290.0, 22.0, "[7.5%]"), ("p1", 1, 1, 0, 10.0, 40.0, 20.0, 140.0, "12/3/4"), ("p1", 1, 1, 1, 30.0, 40.0, 60.0, 140.0, "too 9/9 tall")]
    shape = "page string, block int, line int, word int, x0 double, y0 double, x1 double, y1 double, text string"
    grey = np.full((300, 600), 255, np.uint8)
    grey[50:100] = 0
    rasters = spark.createDataFrame([("p1", grey.tobytes(), 600), ("p2", grey.tobytes(), 600), ("p3", None, 600)], "page string, pixels binary, width int")
    got = P.page_candidates(spark.createDataFrame(words, shape), rasters, ["page"]).collect()
    assert [(r["page"], r["crop_type"] == "visual_band") for r in sorted(got)] == [("p1", False), ("p2", True)]
    band = next(r for r in got if r["page"] == "p2")
    assert band["bbox_180"] == [0.0, 50.0, 600.0, 100.0] and band["complexity_score"] == pytest.approx(3.7)


def test_plug_ins_without_their_library_say_so(spark):
    for name, library in (("tess", "pytesseract"), ("paddle", "paddleocr"), ("surya", "PIL")):
        try:
            __import__(library)
        except ImportError:
            with pytest.raises(RuntimeError, match="needs the library"):
                X.create(name)

    class Two:
        def pages(self, content, dpi):
            if content == b"bad":
                raise ValueError("broken")
            yield from ((n, dpi, dpi, content) for n in (1, 2))

    docs = spark.createDataFrame([("a", b"x"), ("b", b"bad")], "source_id string, content binary")
    got = sorted((r["source_id"], r["page"], r["error"]) for r in X.render_pages(docs, Two).fillna(0, ["page"]).collect())
    assert got == [("a", 1, None), ("a", 2, None), ("b", 0, "broken")]
    assert X.dct_hash(np.arange(6400, dtype=np.uint8).reshape(80, 80)) == X.dct_hash(np.arange(6400, dtype=np.uint8).reshape(80, 80))


def test_hosted_verdicts(spark):
    calls = []

    def transport(request):
        calls.append(request)
        if len(calls) == 1:
            raise OSError("busy")
        return 'Sure: {"exact_match": true} done'

    client = hosted.Client(transport, "m", 1, 0.0)
    assert client.ask({"text": "t"}) == {"exact_match": True} and len(calls) == 2
    assert hosted.Client(lambda _: "nothing", "m", 0).ask({})["skipped"]
    assert hosted.make_client({"llm": {"enabled": False}}, transport) is None and hosted.make_client({"llm": {"enabled": True, "validate": {"model": "v"}}}, transport).model == "v"
    tasks = spark.createDataFrame([(1, "a"), (2, None)], "id bigint, text string")
    assert {r["id"]: json.loads(r["reply"]) for r in hosted.replies(tasks, lambda: None).collect()} == {1: {"skipped": True}, 2: {"skipped": True}}
    assert hosted.replies(tasks, lambda: hosted.Client(lambda r: json.dumps({"seen": r["text"]}), "m")).where("reply LIKE '%\"a\"%'").count() == 1


def test_environment_files():
    text = "# note\nexport A='1'\nB=two\n\nnonsense\nC=\"x=y\""
    assert files.read_env(text, {"B": "set"}) == {"A": "1", "B": "set", "C": "x=y"}


def test_native_script_lines(spark):
    rows = [("शासन निर्णय क्रमांक १२/३४/२०२४ दि. ५.६.२०२४", "hard", "heuristic_strong"), ("पाणी आणि माती यांचे महत्त्व सर्वांना माहीत आहे", "normal", "heuristic_ordinary"), ("क्र. 12", "reject", "none")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "seq bigint, text string, lane string, source string")
    got = S.classify(df, "text", DEVANAGARI).orderBy("seq").collect()
    assert [(r["difficulty"], r["hard_signal_source"]) for r in got] == [r[1:] for r in rows]
    assert got[2]["reject_reason"] == "ascii_digits" and got[1]["features"]["conjunct_estimate"] == 3 and got[0]["features"]["native_digit_count"] == 14
    report = df.select(T.unicode_report(F.col("text"), DEVANAGARI).alias("r")).select("r.*").collect()
    assert [r["ok"] for r in report] == [True] * 3 and [r["mostly_native"] for r in report] == [True] * 3


def test_normal_form_without_python(spark):
    texts = ["éa", "क़", "क़", "Å", "plain", "", None, "ạ̈", "한", "x" * 9000 + "é"]
    import unicodedata

    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string").select("n", T.nfc(F.col("t")).alias("c"))
    assert [r["c"] for r in df.orderBy("n").collect()] == [unicodedata.normalize("NFC", t or "") for t in texts]
    assert "Python" not in df._jdf.queryExecution().toString()


def test_white_space_of_every_kind(spark):
    kinds = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0       　"
    texts = [f"{k}a{k}{k}b c{k}" for k in kinds] + ["", kinds, "a b"]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    t = F.col("t")
    got = df.select("n", T.strip(t).alias("s"), T.collapse(T.strip(t)).alias("c"), T.words_of(t).alias("w"), T.for_dedup(t).alias("d")).orderBy("n").collect()
    assert [(r["s"], r["c"], r["w"], r["d"]) for r in got] == [(x.strip(), " ".join(x.split()), x.split(), "".join(x.split())) for x in texts]


def test_spans_of_a_very_long_line(spark):
    # each span once carried its whole line along
    words = [f"w{'abcdefg'[i % 7] * (i % 7)}" for i in range(60000)]
    df = spark.createDataFrame([(1, words), (2, ["a\u200db", "cc dd", "", "e"]), (3, ["e\u0301x", "yy", "z"])], "seq int, words array<string>")
    got = {(r["seq"], r["span_i"], r["span_j"]) for r in L.word_spans(df, "words", 5, 8).select("seq", "span_i", "span_j").collect()}
    size = [len(w) for w in words]
    want = {(1, i, j) for i in range(len(words)) for j in range(i, min(i + 9, len(words))) if 5 <= sum(size[i : j + 1]) + j - i <= 8}
    assert {g for g in got if g[0] == 1} == want
    assert {g for g in got if g[0] > 1} == {(2, 0, 1), (2, 1, 1), (2, 0, 2), (2, 1, 2), (2, 1, 3), (3, 0, 1), (3, 0, 2)}


def test_sources_without_a_name_share_one_cap(spark):
    rows = [(i, None if i % 2 else "", "hard" if i < 6 else "normal", 5.0, 9, i >= 6) for i in range(12)]
    df = spark.createDataFrame(rows, "seq bigint, source_id string, difficulty string, complexity_score double, word_count int, is_ordinary boolean")
    df = df.withColumns({"contains_native_numerals": F.lit(True), "features": F.struct(F.lit(1.0).alias("identifier_likeness_score"))})
    got = Q.select_lanes(df, 10, 10, 4).collect()
    nameless = [r for r in got if r["source_id"] is None]
    assert len([r for r in nameless if r["difficulty"] == "hard"]) == 3 and len(nameless) == 4


def test_twins_of_short_texts_and_chains_of_boxes(spark):
    texts = ["abcdefghijklmnopqr", "abcdefghijklmnopqrs", "abcdefghijklmnop", "abcdefghijklmnopqrstuvwxyz" * 3, "abcdefghijklmnopqrstuvwxyz" * 3 + "0", "short"]
    df = spark.createDataFrame(list(enumerate(texts)), "seq bigint, text string")
    got = {(r["later"], r["earlier"]): r["score"] for r in D.prefix_twins(df, "seq", "text").collect()}
    from millrace.functions.python_side import prefix_score

    want = {(j, i): prefix_score(texts[j], texts[i]) for j in range(5) for i in range(j)}
    assert got == {k: v for k, v in want.items() if v >= 0.88} and (1, 0) in got and (2, 0) in got
    chain = spark.range(40).select(F.col("id").alias("seq"), F.lit(1).alias("page"), F.array(F.col("id") * 10.0, F.lit(0.0), F.col("id") * 10.0 + 100.0, F.lit(10.0)).alias("box"))
    assert {r["seq"] for r in D.drop_same_boxes(chain, ["page"], "seq", "box", 0.8).collect()} == set(range(0, 40, 2))


def test_verdicts_without_a_model_and_small_helpers(spark):
    df = spark.createDataFrame([("verified", "hard"), ("verified", "normal"), ("pending_export", "hard"), ("rejected", "hard")], "review_status string, difficulty string")
    assert tuple(A.lane_inventory(df).first()) == (1, 1)
    assert A.for_export(df).count() == 3 and A.for_export(df, True).where("review_status = 'verified'").count() == 4
    docs = spark.createDataFrame([(bytearray(b"%PDF-1.7"), "application/pdf"), (bytearray(b"<html>"), "text/html"), (bytearray(b"x" * 6000), None), (bytearray(b"x"), None)], "content binary, kind string")
    assert [r[0] for r in docs.select(U.is_document(F.col("content"), F.col("kind"))).collect()] == [True, False, True, False]
    hits = spark.createDataFrame([("http://s/q", '<a href="/l?uddg=http%3A%2F%2Fa%2Fx.pdf&r">x</a> http://b/y.pdf')], "url string, html string")
    assert [(r["link"], r["rank"]) for r in U.search_hits(hits).orderBy("rank").collect()][0] == ("http://a/x.pdf", 1)
    assert L.spread(spark.range(10).coalesce(1)).count() == 10
