"""Benchmark decontamination.

The test items go into a BM25 inverted index whose postings come in blocks with
the largest weight of each block.  Every passage of every document is a query:
block-max WAND finds all items that reach a share ``floor`` of the score they
have with themselves.  Weights are divided by that score beforehand, so one
threshold serves all items.  Two bounds are taken for all passages of a
document at once, before any posting is read: each term at its largest weight
in any item, then each term at its largest weight in every range of ``RANGE``
items.  Only a passage with a range whose bound reaches the threshold is
traversed.

Hits are then verified on the words themselves: enough of the item's five-word
shingles must stand in the passage and its surroundings, and both the question
and the answer must be among them.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K1, B = 1.2, 0.75
FLOOR = 0.5
SHINGLE = 5
OVERLAP = 0.8
PART_OVERLAP = 0.5
PIECE = 64  # words of an item that are one entry of the index
BLOCK = 64  # postings of a block
RANGE = 2  # entries whose weights share a bound in the first filter
CELLS = 4_000_000  # passages times ranges that are bounded at once
INDEX_BYTES = 32 << 20  # text of the items in one broadcast index
_WORD = re.compile(r"[^\W_]+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """Words of an item's question and answer: the last sentence answers what
    stands before it; a single sentence is halved."""
    parts = [words_of(s) for s in re.split(r"(?<=[.?!])\s+|\n+", text)]
    parts = [p for p in parts if p]
    if not parts:
        return [], []
    if len(parts) > 1 and sum(map(len, parts[:-1])) >= SHINGLE and len(parts[-1]) >= SHINGLE:
        return [w for p in parts[:-1] for w in p], parts[-1]
    words = [w for p in parts for w in p]
    half = (len(words) + 1) // 2
    return words[:half], words[half:]


def shingles(words: list, size: int = SHINGLE) -> list[tuple]:
    if not words:
        return []
    return [tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]


@dataclass
class Index:
    """Inverted index of item pieces; weights are shares of the self score."""

    items: list[int | None]
    texts: list[str]
    n_docs: int
    df: dict[str, int]
    terms: dict[str, int] = field(default_factory=dict)
    entry_item: list[int] = field(default_factory=list)
    postings: list[tuple[list[int], list[float]]] = field(default_factory=list)
    block_max: list[list[float]] = field(default_factory=list)
    block_end: list[list[int]] = field(default_factory=list)
    top: np.ndarray | None = None
    longest: int = 1
    range_from: np.ndarray | None = None  # by term, into the next two
    range_of: np.ndarray | None = None
    range_top: np.ndarray | None = None

    def build(self, mean_length: float) -> Index:
        raw: dict[str, list[tuple[int, float]]] = defaultdict(list)
        for i, text in enumerate(self.texts):
            words = words_of(text)
            for at in range(0, len(words), PIECE):
                piece = words[at : at + PIECE]
                if at and len(piece) < PIECE // 2:
                    piece = words[-PIECE:]  # no short rest that anything matches
                entry = len(self.entry_item)
                self.entry_item.append(i)
                self.longest = max(self.longest, len(piece))
                norm = K1 * (1 - B + B * len(piece) / mean_length)
                idf = {w: np.log(1 + (self.n_docs - self.df[w] + 0.5) / (self.df[w] + 0.5)) for w in piece}
                score = {w: float(idf[w] * n * (K1 + 1) / (n + norm)) for w, n in Counter(piece).items()}
                own = sum(score.values())
                for w, s in score.items():
                    raw[w].append((entry, s / own))
        self.top = np.zeros(len(raw) + 1)
        self.postings, self.block_max, self.block_end = [([], [])], [[]], [[]]
        for w in sorted(raw):
            self.terms[w] = len(self.postings)
            entries, weights = [e for e, _ in raw[w]], [s for _, s in raw[w]]
            self.postings.append((entries, weights))
            self.block_max.append([max(weights[i : i + BLOCK]) for i in range(0, len(weights), BLOCK)])
            self.block_end.append([entries[min(i + BLOCK, len(entries)) - 1] for i in range(0, len(weights), BLOCK)])
            self.top[self.terms[w]] = max(weights)
        self._bound_ranges()
        return self

    def _bound_ranges(self) -> None:
        """Largest weight of each term in each range of entries it occurs in."""
        counts, ranges, tops = [0], [], []
        for entries, weights in self.postings:
            most: dict[int, float] = {}
            for e, w in zip(entries, weights, strict=True):
                most[e // RANGE] = max(w, most.get(e // RANGE, 0.0))
            counts.append(len(most))
            ranges += most
            tops += most.values()
        self.range_from = np.cumsum(counts)
        self.range_of, self.range_top = np.array(ranges, np.int64), np.array(tops)

    def promising(self, terms: np.ndarray, starts: np.ndarray, stops: np.ndarray, floor: float) -> np.ndarray:
        """Which of the passages have a range of entries that could reach
        ``floor`` with their distinct terms?"""
        lengths = stops - starts
        passage = np.repeat(np.arange(len(starts)), lengths)
        place = np.arange(len(passage)) - np.repeat(np.cumsum(lengths) - lengths - starts, lengths)
        term = terms[place]
        known = term > 0
        width = len(self.postings)
        passage, term = np.divmod(np.unique(passage[known] * width + term[known]), width)
        count = self.range_from[term + 1] - self.range_from[term]
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - self.range_from[term], count)
        n = -(-max(1, len(self.entry_item)) // RANGE)
        bound = np.bincount(np.repeat(passage, count) * n + self.range_of[at], weights=self.range_top[at], minlength=len(starts) * n)
        return bound.reshape(len(starts), n).max(axis=1) >= floor - 1e-9

    def wand(self, query: list[int], floor: float) -> dict[int, float]:
        """All entries whose score with the distinct terms of ``query`` is at
        least ``floor`` (block-max WAND)."""
        found: dict[int, float] = {}
        cursors = [[self.postings[t][0][0], 0, t] for t in query]  # entry, place, term
        slack = floor - 1e-12
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for k, (_, _, t) in enumerate(cursors):
                bound += self.top[t]
                if bound >= slack:
                    pivot = k
                    break
            if pivot < 0:
                break
            target = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == target:
                pivot += 1
            # blocks that hold the target, without decoding postings
            local, skip_to = 0.0, None
            for _, at, t in cursors[: pivot + 1]:
                b = at // BLOCK
                ends = self.block_end[t]
                while b < len(ends) and ends[b] < target:
                    b += 1
                if b < len(ends):
                    local += self.block_max[t][b]
                    skip_to = ends[b] if skip_to is None else min(skip_to, ends[b])
            if local >= slack:
                if cursors[0][0] == target:
                    score = sum(self.postings[t][1][at] for e, at, t in cursors[: pivot + 1])
                    if score >= slack:
                        found[target] = score
                    self._advance(cursors, pivot, target + 1)
                else:
                    self._advance(cursors, pivot, target)
            else:
                after = target + 1 if skip_to is None else skip_to + 1
                if pivot + 1 < len(cursors):
                    after = min(after, cursors[pivot + 1][0])
                self._advance(cursors, pivot, max(after, target + 1))
        return found

    def _advance(self, cursors: list[list[int]], pivot: int, to: int) -> None:
        """Move the cursors up to the pivot to the first entry >= ``to``."""
        alive = []
        for k, (entry, at, t) in enumerate(cursors):
            if k <= pivot and entry < to:
                entries, ends = self.postings[t][0], self.block_end[t]
                b = at // BLOCK
                while b < len(ends) and ends[b] < to:
                    b += 1
                at = max(at, b * BLOCK)
                while at < len(entries) and entries[at] < to:
                    at += 1
                if at >= len(entries):
                    continue
                entry = entries[at]
            alive.append([entry, at, t])
        cursors[:] = alive


@dataclass
class Item:
    question: list[tuple]
    answer: list[tuple]
    both: frozenset

    @classmethod
    def of(cls, text: str) -> Item:
        q, a = question_and_answer(text)
        return cls(shingles(q), shingles(a), frozenset(shingles(words_of(text))))


def _inside(part, seen: dict[int, set]) -> float:
    """Share of the shingles seen; a part shorter than one counts as a whole."""
    return sum(s in seen[len(s)] for s in part) / len(part) if part else 1.0


def document_hits(text: str | None, index: Index, items: list[Item], floor: float) -> list[tuple[int, float, float, float, float]]:
    """(item, score, overlap, question overlap, answer overlap) of the items
    verified in one whole document, best passage each."""
    words = words_of(text)
    if not words:
        return []
    get = index.terms.get
    terms = np.array([get(w, 0) for w in words], dtype=np.int64)
    step = index.longest
    starts = np.arange(0, max(1, len(words) - step), step) if len(words) > 2 * step else np.zeros(1, np.int64)
    stops = np.minimum(starts + 2 * step, len(words))
    total = np.r_[0.0, np.cumsum(index.top[terms])]
    best: dict[int, tuple] = {}
    likely = np.flatnonzero(total[stops] - total[starts] >= floor - 1e-9)
    many = max(1, CELLS * RANGE // max(RANGE, len(index.entry_item)))
    chunks = [likely[i : i + many] for i in range(0, len(likely), many)]
    for k in (k for c in chunks for k in c[index.promising(terms, starts[c], stops[c], floor)].tolist()):
        a, b = int(starts[k]), int(stops[k])
        query = np.unique(terms[a:b])
        query = query[query > 0]
        hits = index.wand(query.tolist(), floor)
        if not hits:
            continue
        scores: dict[int, float] = {}
        for entry, score in hits.items():
            i = index.entry_item[entry]
            scores[i] = max(score, scores.get(i, 0.0))
        reach = max(len(items[i].both) + SHINGLE for i in scores)
        around = words[max(0, a - reach) : b + reach]
        seen = {n: set(shingles(around, n)) for n in {len(s) for i in scores for s in (*items[i].question, *items[i].answer, *items[i].both)}}
        for i, score in scores.items():
            row = (score, _inside(items[i].both, seen), _inside(items[i].question, seen), _inside(items[i].answer, seen))
            if i not in best or (row[1], row[0]) > (best[i][1], best[i][0]):
                best[i] = row
    return [(i, *row) for i, row in sorted(best.items()) if row[1] >= OVERLAP and min(row[2:]) >= PART_OVERLAP]


def _shards(items: DataFrame, index_bytes: int) -> Iterator[tuple[list, list, int, dict, float]]:
    """Items in shards of bounded text, with statistics over all items."""
    clean = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL").distinct()
    size, n = clean.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count(F.lit(1))).first()
    parts = max(1, -(-size // index_bytes))
    for k in range(parts):
        rows = clean.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k).collect()  # about index_bytes at most
        rows = sorted(rows, key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"]))
        if parts == 1:
            split = [words_of(r["text"]) for r in rows]
            df = Counter(w for ws in split for w in set(ws))
            mean = sum(map(len, split)) / max(1, len(split))
        else:
            df, mean = _statistics(clean, {w for r in rows for w in words_of(r["text"])})
        yield [r["item_id"] for r in rows], [r["text"] for r in rows], n, df, max(1.0, mean)


def _statistics(items: DataFrame, wanted: set[str]) -> tuple[dict[str, int], float]:
    """Document frequencies of ``wanted`` (a shard's terms) over all items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count, words = Counter(), 0
            for t in batch.column(0):
                ws = words_of(t.as_py())
                words += len(ws)
                count.update(wanted.intersection(ws))
            count[""] += words  # the empty word carries the sum of lengths
            yield pa.record_batch([pa.array(list(count)), pa.array(list(count.values()), pa.int64())], names=["w", "n"])

    rows = items.select("text").mapInArrow(run, "w string, n bigint").groupBy("w").agg(F.sum("n").alias("n")).collect()
    found = {r["w"]: r["n"] for r in rows}
    return found, found.pop("", 0) / max(1, items.count())


def contaminations(docs: DataFrame, items: DataFrame, floor: float = FLOOR, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """One row per document of ``docs`` (doc_id, text) and item of ``items``
    (item_id, text) that is verified in it: doc_id, item_id, score (share of
    the item's score with itself), overlap, question_overlap, answer_overlap.

    Null and empty texts on either side match nothing; null ids stay null;
    repeated documents give repeated rows, repeated items count once; either
    table may be empty; further columns are ignored.  Items beyond
    ``index_bytes`` of text are taken in shards, each against all documents.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for ids, texts, n, df, mean in _shards(items, index_bytes):
        found = rows.mapInArrow(_searcher(spark, ids, texts, n, df, mean, floor), _HITS)
        out = found if out is None else out.unionByName(found)
    return out


_HITS = "doc_id bigint, item_id bigint, score double, overlap double, question_overlap double, answer_overlap double"


def _searcher(spark, ids: list, texts: list[str], n: int, df: dict[str, int], mean: float, floor: float):
    sent = spark.sparkContext.broadcast((ids, texts, n, dict(df), mean))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_ids, own_texts, own_n, own_df, own_mean = sent.value
        index = Index(own_ids, own_texts, own_n, own_df).build(own_mean)
        items = [Item.of(t) for t in own_texts]
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                rows += [(doc_id.as_py(), own_ids[i], *more) for i, *more in document_hits(text.as_py(), index, items, floor)]
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = (pa.int64(), pa.int64(), *[pa.float64()] * 4)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=[f.split()[0] for f in _HITS.split(", ")])

    return run


def drop_contaminated(docs: DataFrame, items: DataFrame, floor: float = FLOOR) -> DataFrame:
    """``docs`` without the rows in which an item is verified; columns stay."""
    at = docs.columns.index("text")
    out = docs
    for ids, texts, n, df, mean in _shards(items, INDEX_BYTES):
        out = _cleaner(out, at, ids, texts, n, df, mean, floor)
    return out


def _cleaner(docs: DataFrame, at: int, ids, texts, n, df, mean, floor) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast((ids, texts, n, dict(df), mean))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_ids, own_texts, own_n, own_df, own_mean = sent.value
        index = Index(own_ids, own_texts, own_n, own_df).build(own_mean)
        items = [Item.of(t) for t in own_texts]
        for batch in batches:
            clean = [not document_hits(t.as_py(), index, items, floor) for t in batch.column(at)]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
