"""Metrics, aggregation, selection and deduplication."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from millrace.functions import metrics as M
from millrace.functions.python_side import conjunct_counts, similarity
from millrace.operators import accept as A
from millrace.operators import dedup as D
from millrace.operators import discover as U
from millrace.operators import metric_summary as MS
from millrace.operators import select as Q


def pair(spark, ref, hyp):
    return M.scored_pairs(spark.createDataFrame([(ref, hyp)], "ref string, hyp string")).first()


def test_joiners_and_words(spark):
    row = pair(spark, "प्र‍क्र", "प्रक्र")
    assert row["exact_match"] and not row["exact_match_strict"]
    row = pair(spark, "अ‌ब", "अब")
    assert row["cer_strict"] > 0 and row["cer_normalized"] == 0
    assert pair(spark, "एक दोन तीन", "एक तीन")["wer"] == pytest.approx(1 / 3)


def test_digits_references_and_signs(spark):
    row = pair(spark, "प्र.क्र.३५७", "प्र.क्र.357")
    assert row["ascii_digit_contamination"] and row["ascii_digit_count_in_pred"] == 3
    assert pair(spark, "प्र.क्र.३५७", "प्र.क्र.३५७")["native_numeral_accuracy"] == 1.0
    ref = "२०२२/प्र.क्र.३५७/का.१४"
    assert pair(spark, ref, ref)["reference_id_exact"] == 1.0 and pair(spark, ref, "wrong")["reference_id_exact"] == 0.0
    assert pair(spark, "साधा मजकूर", "साधा मजकूर")["reference_id_exact"] is None
    row = pair(spark, "अ/ब.क,ड", "अ/ब.क")
    assert row["special_char_precision"] == 1 and 0.5 < row["special_char_recall"] < 1


def test_conjuncts(spark):
    assert conjunct_counts("क्षत्रिय")["क्ष"] == 1
    assert pair(spark, "क्षत्रिय ज्ञानी श्रद्धा द्वार", "कत्रिय जानी श्रद्धा द्वार")["conjunct_error_rate"] > 0
    assert pair(spark, "साधा", "साधा")["conjunct_error_rate"] is None


def test_slices_and_percentiles(spark):
    rows = spark.createDataFrame([("एक", "एक", "x", "s1", 10.0), ("एक दोन तीन चार पाच सहा सात आठ", "एक", "", "s1", 30.0), ("दोन", "तीन", "x", "s2", 20.0)], "ref string, hyp string, issue_type string, source_id string, latency_ms double")
    scored = M.scored_pairs(rows).cache()
    assert MS.overall(scored).first()["latency_ms_p50"] == 20.0
    sliced = {(r["slice"], r["label"]): r["n"] for r in MS.sliced(scored).collect()}
    assert sliced[("by_issue_type", "unknown")] == 1 and sliced[("by_char_band", "long_gt_25")] == 1 and sliced[("all", "all")] == 3
    assert MS.by_source(scored).first()["n_sources"] == 2
    empty = spark.createDataFrame([], "backend string, exact_match double, special_char_f1 double, special_char_accuracy double, cer_normalized double, cer double")
    assert MS.pick_winner(empty) == "tesseract"


@pytest.mark.parametrize(("kwargs", "want"), [({"target": 100}, (80, 20)), ({"target": 1000}, (800, 200)), ({"hard": 10, "normal": 3}, (10, 3)), ({"target": 10, "hard": 4}, (4, 6)), ({"hard": 7}, (7, 20)), ({}, (80, 20))])
def test_quotas(spark, kwargs, want):
    assert Q.lane_targets(spark, **kwargs) == want
    row = spark.createDataFrame([(kwargs.get("target"), kwargs.get("hard"), kwargs.get("normal"), 80, 20)], "target int, hard int, normal int, base_hard int, base_normal int")
    got = Q.scaled_quotas(row).first()
    assert (got["hard_target"], got["normal_target"]) == want


def test_small_targets_fill_both_lanes(spark):
    hard, normal = Q.lane_targets(spark, target=5)
    assert hard + normal == 5 and hard >= 1 and normal >= 1
    assert Q.headroom(10, 5) == 200 and Q.headroom(80, 20) == 400


def greedy(rows, least):
    kept = []
    for seq, text, score in sorted(rows, key=lambda r: (-r[2], -len(r[1]), r[0])):
        if not any(similarity(text.replace(" ", ""), k.replace(" ", "")) >= least for _, k in kept):
            kept.append((seq, text))
    return sorted(s for s, _ in kept)


def test_near_duplicates_as_a_walk(spark):
    rng = random.Random(2)
    base = ["alpha beta gamma delta epsilon zeta", "one two three four five six seven", "the quick brown fox jumps over it"]
    rows = [("", 1.0), ("", 2.0)]
    for b, _ in itertools.product(base, range(8)):
        chars = list(b)
        for _ in range(rng.randrange(4)):
            chars[rng.randrange(len(chars))] = rng.choice("xyz ")
        rows.append(("".join(chars), float(rng.randrange(3))))
    rows = [(i, t, s) for i, (t, s) in enumerate(rows)]
    df = spark.createDataFrame(rows, "seq int, text string, complexity_score double")
    for least in (0.8, 0.92):
        got = sorted(r["seq"] for r in D.drop_similar_texts(df, "seq", "text", least).collect())
        assert got == greedy(rows, least)


def test_similar_texts_of_small_lots_against_all_pairs(spark, monkeypatch):
    rng = random.Random(5)
    texts = ["", "ab"]
    for n in (20, 60, 190, 230, 400):
        base = "".join(rng.choice(["the", "on", "re", "th", "A", "7", "x.", "in"]) for _ in range(n // 2))
        for _ in range(4):
            chars = list(base)
            for _ in range(rng.randrange(1, 2 + n // 9)):
                at = rng.randrange(len(chars))
                chars[at : at + rng.randrange(2)] = rng.choice(["", "q", "e", "th"])
            texts.append("".join(chars))
        texts += [base, base, base[: int(len(base) * 0.93)]]
    monkeypatch.setattr(D, "LOT_ROWS", 3)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "seq int, text string")
    for least in (0.88, 0.92):
        got = {(r["later"], r["earlier"]): r["similarity"] for r in D.similar_texts(df, "seq", "text", least).collect()}
        scores = {(i, j): similarity(texts[i], texts[j]) for i in range(len(texts)) for j in range(i)}
        assert got == {k: s for k, s in scores.items() if s >= least}


def test_many_copies_are_compared_once(spark):
    # pairs of copies would be 200 million rows
    df = spark.range(20000).select(F.col("id").alias("seq"), F.lit("a line that is everywhere").alias("text"), F.lit(1.0).alias("complexity_score"))
    assert [r["seq"] for r in D.drop_similar_texts(df, "seq", "text").collect()] == [0]


def test_prefix_twin_goes(spark):
    long_ = "हा एक लांब मजकूर आहे जो दुसऱ्या ओळीच्या सुरुवातीशी जुळतो"
    df = spark.createDataFrame([("a", 0, long_, 2.0), ("b", 1, long_[:-3], 1.5)], "id string, seq int, text string, complexity_score double")
    assert [r["id"] for r in D.drop_similar_texts(df, "seq", "text", 0.88).collect()] == ["a"]
    assert D.prefix_twins(df, "seq", "text").count() == 1


def test_hamming_pairs_and_image_rules(spark):
    rng = random.Random(3)
    values = [rng.getrandbits(64) - (1 << 63) for _ in range(60)]
    values += [v ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) for v in values[:20]] + values[:3]
    df = spark.createDataFrame([(i, [v], str(v)) for i, v in enumerate(values)], "id int, bits array<bigint>, sha string")
    got = {(r["later"], r["earlier"]) for r in D.hamming_pairs(df, "id", "bits", 8).collect()}
    want = {(i, j) for i in range(len(values)) for j in range(i) if bin((values[i] ^ values[j]) & (2**64 - 1)).count("1") <= 8}
    assert got == want
    pairs = D.hamming_pairs(df, "id", "bits", 8)
    literal = {r["id"] for r in D.drop_duplicate_images(df, "id", "sha", pairs).collect()}
    assert not literal & {0, 1, 2}  # both of an exact pair go
    assert len(D.drop_duplicate_images(df, "id", "sha", pairs, "first").collect()) >= len(literal)


def test_boxes_as_a_walk(spark):
    rows = [(1, 0, [0.0, 0.0, 10.0, 10.0]), (1, 1, [0.0, 0.0, 10.0, 9.5]), (1, 2, [0.0, 0.0, 10.0, 8.2]), (2, 3, [0.0, 0.0, 10.0, 10.0])]
    df = spark.createDataFrame(rows, "page int, seq int, box array<double>")
    assert sorted(r["seq"] for r in D.drop_same_boxes(df, ["page"], "seq", "box").collect()) == [0, 2, 3]


def test_links_and_lists(spark):
    html = '<a href="/d/a.pdf">x</a> <a href="/d/a.pdf">y</a> see https://h.org/b.pdf). <a href="n.html">n</a>'
    pages = spark.createDataFrame([("https://h.org/p/", html)], "url string, html string")
    assert [r["link"] for r in U.page_links(pages).orderBy("pos").collect()] == ["https://h.org/d/a.pdf", "https://h.org/b.pdf"]
    lines = spark.createDataFrame([("# c",), ("",), (" B.PDF ",)], "value string")
    assert [r["link"] for r in U.not_excluded(U.page_links(pages), U.exclude_entries(lines)).collect()] == ["https://h.org/d/a.pdf"]


def test_replies(spark):
    texts = ['{"exact_match": true}', 'ok ```json\n{"exact_match": false, "suggested_lane": "HARD"}\n``` end', "no json", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(A.image_verdict(F.col("t")).alias("v"))
    got = [r["v"] for r in df.collect()]
    assert not got[0]["suspicious"] and got[1]["suggested_lane"] == "hard" and got[1]["is_complex_for_ocr"]
    assert got[2]["suspicious"] and got[3]["suspicious"]


def test_split_keeps_sources_whole(spark):
    df = spark.createDataFrame([(f"s{i % 7}", i) for i in range(70)] + [(None, 99)], "source_id string, i int")
    rows = Q.source_split(df).groupBy("source_id").agg(F.countDistinct("split").alias("n")).collect()
    assert all(r["n"] == (0 if r["source_id"] is None else 1) for r in rows)


def test_recognisers_by_name(spark):
    from millrace.sources import recognisers as O

    df = spark.createDataFrame([("a", b"xy"), ("b", None)], "id string, image binary")
    rows = {r["id"]: r["ocr_prediction"] for r in O.recognise(df, "echo", lambda: O.create("echo")).collect()}
    assert rows == {"a": "xy", "b": None}
    with pytest.raises(ValueError):
        O.create("none")
    assert O.longest_reading(["a", " bcd ", "xyz"]) == "bcd"


def test_stream_scores_what_the_batch_scores(spark, tmp_path):
    from millrace.plans.mining import MiningLoop, classified_lines
    from millrace.streaming.scoring import run_available, scored_stream, stream_documents

    docs = spark.createDataFrame([(i, f"Line {i} of text, 12/{i}-7.\nplain words here", "s") for i in range(6)], "doc_id bigint, text string, source string")
    docs.repartition(3).write.parquet(f"{tmp_path}/in")
    run_available(scored_stream(stream_documents(spark, f"{tmp_path}/in", docs.schema, 1)), f"{tmp_path}/out", f"{tmp_path}/cp")
    got = spark.read.parquet(f"{tmp_path}/out").select("seq", "difficulty").orderBy("seq").collect()
    assert got == classified_lines(docs).select("seq", "difficulty").orderBy("seq").collect()
    assert MiningLoop(2, 1).run(lambda n, d: (n, n, d))[0] and not MiningLoop(9, 9).run(lambda n, d: (1, 1, d))[0]
