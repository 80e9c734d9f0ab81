"""Toxicity by compression distance.

Two zstandard dictionaries are trained on labelled text.  The ordinary one is
trained on windows of ordinary documents.  The toxic one is trained on what
sets toxic documents apart: each document gives one sample, its words that
toxic documents have far more often than ordinary ones.  A window is compressed
once with the ordinary dictionary and once with the toxic one behind it, and
the bytes that saves are its distance.

A window is one word with the blanks around it, every byte written twice.
Doubling makes the literals of a word that a dictionary lacks cost twice as
much while a match costs the same; with several words to a window the savings
of one drown in the chance matches of the others.  Two dictionaries trained on
all windows of either label tell little: most of both is common syllables.

A document's share and number of windows over each of several thresholds go
through a logistic calibration.  It is fitted on cross-fitted rows: each fifth
is compressed with dictionaries trained on the others.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from millrace.llm.common import fresh

LONGEST = 48  # bytes of a window; a longer word is several
THRESHOLDS = (2, 4, 6, 8, 10, 12, 15, 18)
ORDINARY_BYTES = 64_000
ORDINARY_WINDOWS = 60_000  # bound of the windows the ordinary dictionary is trained on
TOXIC_BYTES = 3_000
LEAST_DOCS = 4
LEAST_ODDS = 2.0  # logarithm
FOLDS = 5
SAMPLE_PER_CLASS = 3_000  # bound of the labelled rows that are fitted on
CACHED = 200_000  # words whose distance a scorer remembers
CUT = 0.7
CLEAN_WEIGHT = 3.0  # a filter's cost of a lost clean row, in missed toxic ones
_NO_LETTERS = re.compile(rb"[\x00-\x40\x5b-\x60\x7b-\x7f]+")


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters (A-Z and everything beyond ASCII)."""
    return _NO_LETTERS.sub(b" ", (text or "").encode("utf-8", "surrogatepass").lower()).split()


def windows(words: list[bytes]) -> list[bytes]:
    """The whole text in windows: words, long ones in pieces."""
    if not any(len(w) > LONGEST for w in words):
        return words
    return [w[i : i + LONGEST] for w in words for i in range(0, len(w), LONGEST)]


def _twice(content: bytes) -> bytes:
    return np.repeat(np.frombuffer(content, np.uint8), 2).tobytes()


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...] = ()
    mean: tuple[float, ...] = ()
    scale: tuple[float, ...] = ()
    cut: float = CUT  # of a filter, from cross-fitted rows

    def scorer(self):
        """Function from a text to its score; holds two compressors."""
        settings = zstandard.ZstdCompressionParameters(window_log=18, hash_log=17, chain_log=17, search_log=6, min_match=6, target_length=32, strategy=zstandard.STRATEGY_BTLAZY2, write_content_size=0)

        def compressor(content: bytes):
            data = zstandard.ZstdCompressionDict(_twice(content), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(compression_params=settings)
            return zstandard.ZstdCompressor(compression_params=settings, dict_data=data).compress

        plain, toxic = compressor(self.ordinary), compressor(self.ordinary + self.toxic)
        known: dict[bytes, int] = {}

        def saving(word: bytes) -> int:
            if (found := known.get(word)) is None:
                if len(known) >= CACHED:
                    known.clear()
                window = _twice(b" " + word + b" ")
                found = known[word] = len(plain(window)) - len(toxic(window))
            return found

        def features(text: str | None) -> np.ndarray:
            saved = np.array([saving(w) for w in windows(words_of(text))] or [0])
            over = [(saved >= t).sum() for t in THRESHOLDS]
            return np.array([*(o / len(saved) for o in over), *np.log1p(over), math.log1p(len(saved)), saved.mean(), saved.max()])

        def score(text: str | None) -> float:
            return float(_logistic((features(text) - self.mean) / self.scale, np.array(self.weights)))

        score.features = features
        return score


def _logistic(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -500, 500)))


def _telling(toxic: list[bytes], ordinary: list[bytes]) -> set[bytes]:
    """Words that toxic documents have far more often than ordinary ones."""
    t, o = Counter(), Counter()
    for line in toxic:
        t.update(set(line.split()))
    t = {w: n for w, n in t.items() if n >= LEAST_DOCS}
    for line in ordinary:
        o.update(t.keys() & set(line.split()))
    log = lambda n, docs: math.log((n + 0.5) / (len(docs) + 1))
    return {w for w, n in t.items() if log(n, toxic) - log(o[w], ordinary) > LEAST_ODDS}


def _trained(size: int, samples: list[bytes], segment: int, least: int) -> bytes:
    """A trained dictionary; too little text is its own dictionary."""
    whole = b"".join(samples)
    if len(whole) <= size or len(samples) < 8:
        return whole[-size:]
    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=least).as_bytes()
    except zstandard.ZstdError:
        return whole[-size:]


def _dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> tuple[bytes, bytes]:
    places = [(line, i) for line in ordinary for i in range(0, len(line), LONGEST)]
    cuts = [line[i : i + LONGEST] for line, i in places[:: max(1, -(-len(places) // ORDINARY_WINDOWS))]]
    telling = _telling(toxic, ordinary)
    samples = [b" " + b" ".join(w for w in dict.fromkeys(line.split()) if w in telling) + b" " for line in toxic]
    return _trained(ORDINARY_BYTES, cuts, 96, 8), _trained(TOXIC_BYTES, samples, 32, 6)


def _calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression with a small ridge, by Newton's method."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-6
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (weight * (y - p)) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def filter_cut(score: np.ndarray, y: np.ndarray, clean_weight: float = CLEAN_WEIGHT) -> float:
    """The score at or above which rejecting costs least: the share of toxic
    rows missed and ``clean_weight`` times the share of clean rows lost.  It
    lies halfway between the scores around it."""
    order = np.argsort(score, kind="stable")
    s, positive = score[order], y[order] > 0
    missed, spared = np.r_[0, np.cumsum(positive)] / positive.sum(), np.r_[0, np.cumsum(~positive)] / (~positive).sum()
    gain = np.where(np.r_[True, s[1:] != s[:-1], True], clean_weight * spared - missed, -np.inf)
    k = int(gain.argmax())
    return float((s[max(0, k - 1)] + s[min(k, len(s) - 1)]) / 2)


def fit_rows(texts: list[str], y: np.ndarray, weight: np.ndarray) -> Model:
    """Dictionaries, calibration and cut from texts with labels 0 and 1."""
    lines = [b" " + b" ".join(words_of(t)) + b" " for t in texts]

    def trained(chosen: np.ndarray) -> Model:
        return Model(*_dictionaries(*([lines[i] for i in np.flatnonzero(chosen & (y == label))] for label in (1, 0))))

    # folds run through each label by itself, so every fold has its share
    fold = np.zeros(len(y), np.int64)
    for label in (0, 1):
        fold[y == label] = np.arange((y == label).sum()) % FOLDS
    x: list = [None] * len(y)
    for k in range(FOLDS):
        kept = fold != k if min((y == 0).sum(), (y == 1).sum()) > FOLDS else np.ones(len(y), bool)
        features = trained(kept).scorer().features
        for i in np.flatnonzero(fold == k):
            x[i] = features(texts[i])
    x = np.array(x)
    mean, scale = x.mean(0), x.std(0) + 1e-9
    w = _calibrate((x - mean) / scale, y, weight / weight.mean())
    cut = filter_cut(_logistic((x - mean) / scale, w), y)
    whole = trained(np.ones(len(y), bool))
    return Model(whole.ordinary, whole.toxic, tuple(w), tuple(mean), tuple(scale), cut)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model | None:
    """Fit on labelled rows whose crc32(doc_id) mod 3 is not 1.

    At most ``per_class`` rows of either label are used, the first by a hash of
    the id; class weights restore the shares of all labelled rows.  Rows with a
    null id, text or label do not take part.  None if a label has no row.
    """
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    ours = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(~held_out("doc_id")).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # labels of documents that are not there take nothing of the bound
    ours = ours.join(texts.select("doc_id"), "doc_id", "left_semi")
    shares = {r["toxic"]: r["count"] for r in ours.groupBy("toxic").count().collect()}
    order = F.xxhash64("doc_id", F.lit(17))
    chosen = ours.where("toxic = 1").orderBy(order, "doc_id").limit(per_class).unionByName(ours.where("toxic = 0").orderBy(order, "doc_id").limit(per_class))
    rows = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "toxic", "text").collect()  # bounded by 2 * per_class
    first = {}
    for r in sorted(rows):
        first.setdefault(r["doc_id"], r)
    rows = list(first.values())
    y = np.array([r["toxic"] for r in rows], float)
    if not len(rows) or y.min() == y.max():
        return None
    share = np.array([shares.get(0, 0) / max(1, (y == 0).sum()), shares.get(1, 0) / max(1, (y == 1).sum())])
    return fit_rows([r["text"] for r in rows], y, share[y.astype(int)])


def held_out(column: str = "doc_id"):
    """Is crc32 of the id as text 1 modulo 3?  False for a null id."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def with_scores(docs: DataFrame, model: Model | None, score: str = "score") -> DataFrame:
    """``docs`` with a column of scores of the whole texts; nothing but the
    text goes into a score.  Null and empty texts have the score of no words;
    without a model every score is 0."""
    if model is None:
        return docs.withColumn(score, F.lit(0.0))
    at = docs.columns.index("text")
    schema = StructType([*docs.schema.fields, StructField(score, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = model.scorer()
        for batch in batches:
            scores = pa.array([of(t.as_py()) for t in batch.column(at)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, score])

    return docs.mapInArrow(run, schema)


def toxicity_scores(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``
    (doc_id, text).

    Null and empty texts are scored like any other; a null doc_id stays null
    and is not held out; repeated rows repeat; an empty table stays empty;
    further columns are ignored.  Without labels of both kinds all scores are 0.
    """
    model = fit(docs, labels, per_class)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = with_scores(rows, model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, cut: float | None = None) -> DataFrame:
    """``docs`` without the rows that score ``cut`` or more, by default the
    ``filter_cut`` of the cross-fitted labelled rows; columns stay.  Rows with a null or empty text, null or repeated ids are
    judged by their text like any other; without labels of both kinds, and for
    an empty table, everything stays."""
    model = fit(docs, labels, per_class)
    if model is None:
        return docs
    (name,) = fresh(docs.columns, "score")
    return with_scores(docs, model, name).where(F.col(name) < (model.cut if cut is None else cut)).select(*docs.columns)
