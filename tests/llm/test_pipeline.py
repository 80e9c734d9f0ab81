"""The pipeline's stages against brute-force versions of their decisions."""

import itertools
import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from millrace.llm import decontaminate, near_dedup, tokens, toxicity


def test_stages(spark, tmp_path):
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefghijklm") for _ in range(7))
    clean = [" ".join(word() for _ in range(120)) for _ in range(60)]
    items = [" ".join(word() for _ in range(25)) + ". " + " ".join(word() for _ in range(10)) + "." for _ in range(8)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(clean)]
    rows += [(100 + i, clean[i] + "\n", "en", "s", 0) for i in range(3)]  # longer, so these stay
    rows += [(200 + i, clean[i + 10].replace(" ", " ", 1).rsplit(" ", 1)[0] + " zzz", "en", "s", 0) for i in range(5)]
    rows += [(300 + i, clean[i + 20] + " " + items[i], "en", "s", 0) for i in range(4)]
    toxic = [" ".join([word() for _ in range(60)] + ["scoundrel", "villain", "wretched"] * 3) for _ in range(40)]
    rows += [(400 + i, t, "en", "s", 0) for i, t in enumerate(toxic)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    labels = spark.createDataFrame([(r[0], 1, int(r[0] >= 400)) for r in rows], "doc_id bigint, quality int, toxic int")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    ids = {r["doc_id"] for r in out.select("doc_id").distinct().collect()}
    assert ids == (set(range(60)) - {0, 1, 2}) | {100, 101, 102} - set()
    assert len(corpus_pipeline.STAGES) == 5 and [n for n, _ in corpus_pipeline.STAGES][0] == "toxicity"


def test_empty_corpus(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_columns_are_kept(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b c d e f", "en", "s", 11), (2, None, None, None, None)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "x")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, str(tmp_path))
        assert kept.columns == docs.columns and kept.where(F.col("doc_id") == 1).count() == 1


def slow_run(rows, labels, items, model):
    """All stages one after the other, by brute force: rows (doc_id, text)."""
    score = model.scorer()
    kept = [(d, t) for d, t in rows if score(t) < model.cut]
    groups = {}
    for k, (d, t) in enumerate(kept):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), d is None, d or 0, k))
    kept = [kept[k] for k in sorted(min(g)[-1] for g in groups.values())]
    label = list(range(len(kept)))
    prints = [near_dedup.word_prints(t) for _, t in kept]
    for i, j in itertools.combinations(range(len(kept)), 2):
        if label[i] != label[j] and (np.bitwise_count(prints[i] ^ prints[j]) <= 3).any() and near_dedup.similarity(kept[i][1], kept[j][1]) >= 0.8:
            label = [label[i] if x == label[j] else x for x in label]
    first = {}
    for k, x in enumerate(label):
        rank = (kept[k][0] is None, kept[k][0] or 0, k)
        first[x] = min(first.get(x, rank), rank)
    kept = [kept[r[-1]] for r in first.values()]

    def leaks(text):
        words = decontaminate.words_of(text)
        for item in items:
            seen = {n: set(decontaminate.shingles(words, n)) for n in range(1, 6)}
            q, a = decontaminate.question_and_answer(item)
            parts = [decontaminate.shingles(p) for p in (decontaminate.words_of(item), q, a)]
            shares = [sum(s in seen[len(s)] for s in p) / len(p) if p else 1.0 for p in parts]
            if words and shares[0] >= 0.8 and min(shares[1:]) >= 0.5:
                return True
        return False

    out = []
    for d, t in kept:
        if not leaks(t):
            ids = Tokenizer.from_file(tokens.default_vocabulary()).encode(t or "", add_special_tokens=False).ids + [0]
            cuts = tokens.cut_points(len(ids), 2048)
            out += [(d, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(ids)], strict=True))]
    return out


def test_all_stages_against_brute_force(spark, tmp_path):
    rng = random.Random(41)
    vocabulary = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randrange(1, 4))) for _ in range(150)]
    text = lambda n, more=(): " ".join(rng.choice([*vocabulary, *more]) for _ in range(n))
    bad = ["zzvile", "qqfoul", "xxnasty"] * 12
    rows, labels = [], []
    for i in range(240):
        toxic = i % 4 == 0
        rows.append((i, text(rng.randrange(60, 120), bad if toxic else ())))
        if i < 200:
            labels.append((i, 1, int(toxic)))
    items = [f"{text(24)}? {text(12)}." for _ in range(4)]
    rows += [(300 + k, f"{text(50)} {items[k]} {text(40)}") for k in range(4)]
    for k in range(12):
        words = rows[4 * k + 1][1].split()
        words[len(words) // 2] = "changed"
        rows += [(400 + k, " ".join(words)), (500 + k, rows[4 * k + 2][1] + "\n ")]
    rows += [(600, None), (601, ""), (602, " \n"), (None, rows[5][1]), (None, text(80)), (7, rows[7][1]), (603, text(9000)), (604, "<|endoftext|> " + text(30))]
    shape = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame([(d, t, "xx", "s", None) for d, t in rows], shape).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([*labels, (None, 1, 1), (9999, 1, 1), (3, 1, None)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([*enumerate(items), (9, None), (10, "")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    model = toxicity.fit(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet"))
    want = slow_run(rows, labels, items, model)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((key(r[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in got)) == sorted(map(key, want))
    ids = {r["doc_id"] for r in got}
    # of equal texts the longer stays, so the copies with more blanks do
    assert not ids & {*range(300, 304), *range(400, 412), *(4 * k + 2 for k in range(12)), 600, 601} and {602, 603, 604, None} <= ids
    clean = {i for i in range(240) if i % 4} - {4 * k + 2 for k in range(12)}
    assert len(clean - ids) <= 6 and len({i for i in range(0, 240, 4)} & ids) <= 6
    held = {}
    for r in got:
        held.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in held.values():
        ends = list(itertools.accumulate(n for _, n in sorted(places)))
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 2048
