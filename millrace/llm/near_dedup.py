"""Removal of near copies, by SimHash and a check of the words.

A single fingerprint of three-word shingles finds few copies of four fifths
similarity: each changed word changes three shingles.  So each text has several
fingerprints of its distinct words, with independent hashes, and the binary
tries join every one of them.  What a trie proposes is only a candidate: a link
counts if the two texts' five-word shingles have a Jaccard similarity of 0.8 or
more.  Groups are the components of all such links, and the row with the
smallest doc_id stays.

Links come in two steps, since a group of thousands of copies has millions.
First every class of equal fingerprints is a star and the tries hand out
spanning forests.  A link of these that fails the check may stand for one that
would not; so in every cluster of candidates that the good links leave in more
than one piece, the tries meet again and visit all pairs between its pieces.  A
pair leaves its task only if the counts of the two texts' shingles in
``BUCKETS`` buckets leave room for the similarity asked for (an upper bound, so
nothing true is lost).  Of each two pieces the likeliest pairs are checked
first, eight times as many in each round, and pairs of pieces that have become
one need no check.  After the last round no pair of different groups is
unchecked.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fresh, join_spread, materialize, shuffle_width, tidy
from millrace.llm.simhash import _BIT_TABLE, components, near_links, routed, trie_self_join

PRINTS = 12
SHINGLE = 5
SIMILARITY = 0.8
BUCKETS = 256
AT_ONCE = 5_000  # candidates between pieces that are checked without choosing


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII blanks, A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_prints(text: str | None, prints: int = PRINTS) -> np.ndarray:
    """SimHashes of the distinct words, one per hash function; none gives 0."""
    words = set(words_of(text))
    if not words:
        return np.zeros(prints, np.uint64)
    base = np.array([xxhash.xxh64_intdigest(w) for w in words], dtype=np.uint64)
    out = np.empty(prints, np.uint64)
    with np.errstate(over="ignore"):
        for r in range(prints):
            h = (base ^ np.uint64(0x9E3779B97F4A7C15 * (r + 1) & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xD6E8FEB86659FD93)
            h = (h ^ (h >> np.uint64(32))) * np.uint64(0xA0761D6478BD642F)
            h ^= h >> np.uint64(29)
            columns = h.astype(">u8").view(np.uint8).reshape(-1, 8)
            ones = np.concatenate([np.bincount(columns[:, i], minlength=256) @ _BIT_TABLE for i in range(8)])
            out[r] = int.from_bytes(np.packbits(ones * 2 > len(words)).tobytes(), "big")
    return out


def shingles_of(text: str | None, size: int = SHINGLE) -> set[bytes]:
    """Distinct word shingles; a shorter text is one, no words are none."""
    w = words_of(text)
    return {b" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def jaccard(x: set, y: set) -> float:
    """Similarity of two sets; two empty ones are equal."""
    both = len(x & y)
    return both / (len(x) + len(y) - both) if x or y else 1.0


def similarity(a: str | None, b: str | None, size: int = SHINGLE) -> float:
    """Jaccard similarity of word shingles; texts without words are equal."""
    return jaccard(shingles_of(a, size), shingles_of(b, size))


def shingle_counts(shingles: set[bytes]) -> bytes:
    """Number of shingles, and how many of them fall into each bucket."""
    hashes = np.fromiter((xxhash.xxh64_intdigest(s) for s in shingles), np.uint64, len(shingles))
    counts = np.bincount((hashes % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
    return np.uint32(len(shingles)).tobytes() + counts.astype("<u1" if counts.max() < 256 else "<u4").tobytes()


def counts_of(raw: bytes) -> np.ndarray:
    """``shingle_counts`` as one row, the number first."""
    counts = np.frombuffer(raw, "<u1" if len(raw) == 4 + BUCKETS else "<u4", BUCKETS, 4)
    return np.r_[np.frombuffer(raw, "<u4", 1), counts.astype("<u4")]


def most_similar(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Upper bounds of the similarity, from rows of ``shingle_counts``."""
    both = np.minimum(x[:, 1:], y[:, 1:]).sum(1, dtype=np.int64)
    union = x[:, 0].astype(np.int64) + y[:, 0] - both
    return np.where(union > 0, both / np.maximum(union, 1), 1.0)


def _prints(rows: DataFrame, prints: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [word_prints(t.as_py(), prints).view(np.int64) for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(values, pa.list_(pa.int64()))], names=["row", "prints"])

    return rows.mapInArrow(run, "row bigint, prints array<bigint>")


def _packed(texts: DataFrame) -> DataFrame:
    """Whole texts, compressed for the way to the check of links, and the
    counts of their shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            packed, counts = [], []
            for t in batch.column(1):
                packed.append(pack((t.as_py() or "").encode("utf-8", "surrogatepass")))
                counts.append(pack(shingle_counts(shingles_of(t.as_py()))))
            yield pa.record_batch([batch.column(0), pa.array(packed, pa.binary()), pa.array(counts, pa.binary())], names=["row", "packed", "counts"])

    return texts.mapInArrow(run, "row bigint, packed binary, counts binary")


def _verified(links: DataFrame, asked: DataFrame, least: float) -> DataFrame:
    """The links (a, b) whose texts (row, packed) are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        of = lambda raw: shingles_of(unpack(raw.as_py()).decode("utf-8", "surrogatepass"))
        centre, held = None, set()
        for batch in batches:
            good = []
            for b, x, y in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if b != centre:
                    centre, held = b, of(y)
                good.append(jaccard(of(x), held) >= least)
            yield pa.record_batch([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good, pa.bool_()))

    left = links.join(asked.select(F.col("row").alias("a"), F.col("packed").alias("x")), "a")
    # the smaller end is the centre of a star, in a large class of very many links
    both = join_spread(left, asked.select(F.col("row").alias("b"), F.col("packed").alias("y")), "b", links, by="a")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


def _rooted(links: DataFrame, name: str) -> DataFrame:
    """(node, root) of every node of the links' components, roots included."""
    groups = materialize(components(links), name)
    return groups.select("node", "root").unionByName(groups.select(F.col("root").alias("node"), "root").distinct())


def _ordered(links: DataFrame) -> DataFrame:
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()


def _spanning(lanes: DataFrame) -> DataFrame:
    """Candidates (a, b) that span every cluster of near fingerprints."""
    classes = materialize(lanes.groupBy("lane", "fp").agg(F.min("row").alias("rep"), F.count(F.lit(1)).alias("n")), "near-classes")
    near = near_links(classes.select("lane", "fp"), direct=True)
    side = lambda new, old: classes.select("lane", F.col("fp").alias(old), F.col("rep").alias(new))
    between = near.join(side("ra", "a"), ["lane", "a"]).join(side("rb", "b"), ["lane", "b"]).select(F.col("ra").alias("a"), F.col("rb").alias("b"))
    within = lanes.join(classes.where("n > 1"), ["lane", "fp"]).where("row != rep").select(F.col("row").alias("a"), F.col("rep").alias("b"))
    return _ordered(between.unionByName(within))


def _likely(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """Pairs of one partition's rows that are near, differ in their label and
    may be similar enough by their counts."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    whole = pa.Table.from_batches(held)
    key, fp, label, row = (whole[c].to_numpy() for c in ("key", "fp", "label", "row"))
    value = fp.astype(np.int64).view(np.uint64)
    order = np.lexsort((label, value, key))
    key, value, label, row = key[order], value[order], label[order], row[order]
    # a row comes once per lane and block; its counts are held once
    rows, first, which = np.unique(row, return_index=True, return_inverse=True)
    unpack = zstandard.ZstdDecompressor().decompress
    packed = whole["counts"]
    counts = np.stack([counts_of(unpack(packed[int(order[i])].as_py())) for i in first])
    seen: dict = {}

    def check(i: np.ndarray, j: np.ndarray) -> None:
        a, b = which[i], which[j]
        pairs = np.unique(np.maximum(a, b) * len(rows) + np.minimum(a, b))
        for at in range(0, len(pairs), 100_000):
            a, b = np.divmod(pairs[at : at + 100_000], len(rows))
            bound = most_similar(counts[a], counts[b])
            for k in np.flatnonzero(bound >= least - 1e-9).tolist():
                seen[int(rows[a[k]]), int(rows[b[k]])] = float(bound[k])

    trie_self_join(key, value, known=label, found=check)
    if seen:
        a, b = zip(*seen, strict=True)
        yield pa.record_batch([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b)), pa.array(list(seen.values()))], names=["a", "b", "bound"])


def _across(lanes: DataFrame, links: DataFrame, found: DataFrame, asked: DataFrame, least: float) -> DataFrame:
    """Candidates (a, b, bound) between the pieces into which the good links
    ``found`` part the clusters of ``links``, but for ``links`` themselves."""
    clusters = _rooted(links, "near-clusters").withColumnRenamed("root", "cluster")
    pieces = _rooted(found, "near-pieces").withColumnRenamed("root", "label")
    members = materialize(clusters.join(pieces, "node", "left").select(F.col("node").alias("row"), "cluster", F.coalesce("label", "node").alias("label")), "near-members")
    parted = members.groupBy("cluster").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x != y").select("cluster")
    inside = members.join(parted, "cluster", "left_semi").select("row", "label").join(asked.select("row", "counts"), "row")
    open_ = materialize(lanes.join(inside, "row"), "near-open")
    dealt = routed(open_, more=("label", "row", "counts")).repartition(shuffle_width(open_.sparkSession), "key")
    pairs = dealt.mapInArrow(functools.partial(_likely, least=least), "a bigint, b bigint, bound double")
    return pairs.groupBy("a", "b").agg(F.max("bound").alias("bound")).join(links, ["a", "b"], "left_anti")


def _settled(others: DataFrame, found: DataFrame, asked: DataFrame, least: float) -> DataFrame:
    """``found`` with all good links among ``others`` that join two pieces."""
    share = 1
    while True:
        pieces = _rooted(found, "near-pieces")
        side = lambda n: pieces.select(F.col("node").alias(n), F.col("root").alias(f"l{n}"))
        ends = others.join(side("a"), "a", "left").join(side("b"), "b", "left").select("a", "b", "bound", F.coalesce("la", "a").alias("la"), F.coalesce("lb", "b").alias("lb"))
        others = materialize(ends.where("la != lb"), "near-others")
        left = others.count()
        if not left:
            return found
        chosen = others.select("a", "b")
        if left > AT_ONCE:
            slot = F.pmod(F.xxhash64("a", "b"), F.lit(share))
            best = others.groupBy(F.least("la", "lb"), F.greatest("la", "lb"), slot).agg(F.max_by(F.struct("a", "b"), F.struct("bound", "a", "b")).alias("pair"))
            chosen = materialize(best.select("pair.a", "pair.b"), "near-chosen")
        found = materialize(found.unionByName(_verified(chosen, asked, least)), "near-verified")
        if left <= AT_ONCE:
            return found
        others, share = others.select("a", "b", "bound").join(chosen, ["a", "b"], "left_anti"), share * 8


def near_copies(docs: DataFrame, row: str, prints: int = PRINTS, least: float = SIMILARITY) -> DataFrame:
    """Numbers (column ``row``) of the rows that near copies of theirs replace.

    ``docs`` is a stored table with unique numbers in ``row``.  Null and empty
    texts are copies of each other; a null doc_id gives way to any other.
    """
    with tidy(docs.sparkSession):
        texts = docs.select(F.col(row).alias("row"), F.col("text").cast("string").alias("text"))
        owners = docs.select(F.col(row).alias("node"), F.struct(F.col("doc_id").isNull().alias("o"), F.col("doc_id").cast("bigint").alias("d"), F.col(row).alias("r")).alias("rank"))
        lanes = materialize(_prints(texts, prints), "near-prints").select("row", F.posexplode("prints").alias("lane", "fp"))
        links = materialize(_spanning(lanes), "near-links")
        ends = links.select(F.col("a").alias("row")).unionByName(links.select(F.col("b").alias("row"))).distinct()
        # all texts move once; what the checks move are the texts of links only
        asked = materialize(_packed(texts.join(ends, "row", "left_semi")), "near-texts")
        found = materialize(_verified(links, asked, least), "near-verified")
        found = _settled(materialize(_across(lanes, links, found, asked, least), "near-others"), found, asked, least)
        ranked = materialize(_rooted(found, "near-groups").join(owners, "node"), "near-ranked")
        best = ranked.groupBy("root").agg(F.min("rank").alias("best"))
        gone = materialize(ranked.join(best, "root").where(F.col("rank.r") != F.col("best.r")).select(F.col("node").alias("row")), "near-gone")
    return gone


def drop_near_copies(docs: DataFrame, prints: int = PRINTS, least: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of every group of near copies; columns stay.  Null
    and empty texts are one group, repeated rows another; null ids give way; an
    empty table stays empty."""
    (row,) = fresh(docs.columns, "row")
    stored = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "near-rows")
    gone = near_copies(stored, row, prints, least).select(F.col("row").alias(row))
    return stored.join(gone, row, "left_anti").select(*docs.columns)
