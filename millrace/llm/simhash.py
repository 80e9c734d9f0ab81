"""SimHash near-duplicates by a self-join of binary tries.

Two 64-bit fingerprints that differ in at most three bits agree on at least one
of four 16-bit blocks.  Every distinct fingerprint is therefore dealt, once per
block, to the key (block, value of the block); a key that still holds too many
is dealt again by four 12-bit blocks of the other 48 bits, which is exact for
the same reason.  Inside a partition the fingerprints of all its keys form one
set of binary tries.  Node pairs descend together, carry the bits they differ
in, and are dropped as soon as those exceed the budget or all their leaves are
linked already; only a spanning forest leaves the task, so a group of thousands
of near copies gives thousands of links, not millions.  Forests are joined by
alternating star contractions on checkpointed edge tables.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import join_spread, materialize, shuffle_width, tidy

BUDGET = 3
BITS = 64
CHUNK = 200_000  # node pairs handled at once
LEAF_PAIRS = 64  # node pairs of so many leaf pairs are compared outright
HOT_KEY = 2_000
_BIT_TABLE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of a whole text; no words give 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    n = max(1, len(words) - shingle + 1)
    starts = np.concatenate([[0], ends[: n - 1]]).tolist()
    stops = (ends[min(shingle, len(words)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], 42) for a, b in zip(starts, stops, strict=True)], dtype=">u8")
    columns = hashes.view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(columns[:, i], minlength=256) @ _BIT_TABLE for i in range(8)])
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp bigint) for every row; a null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], dtype=np.uint64)
            yield pa.record_batch([batch.column(0), pa.array(values.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id bigint, fp bigint")


def _merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray, used: list | None = None) -> np.ndarray:
    """Labels (smallest member of each component) after linking a[i] - b[i].

    Each round hooks a root to the smallest root it meets, by one of the given
    links; ``used`` collects those, which together form a spanning forest.
    """
    while True:
        x, y = labels[a], labels[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return labels
        a, b, low, high = a[open_], b[open_], low[open_], high[open_]
        order = np.lexsort((low, high))
        first = order[np.r_[True, high[order][1:] != high[order][:-1]]]
        labels[high[first]] = low[first]
        if used is not None:
            used.append((a[first], b[first]))
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels[:] = up


def trie_self_join(group: np.ndarray, value: np.ndarray, budget: int = BUDGET, used: list | None = None, known: np.ndarray | None = None, found=None) -> np.ndarray:
    """Component labels (positions) of ``value`` under links of at most
    ``budget`` differing bits inside equal ``group``.  Rows must be sorted by
    (group, value) and distinct; sorted order is the trie, a node a range.
    ``used`` collects the links (i, j) of a spanning forest.  With labels that
    are ``known`` nothing is joined: ``found`` is called with every link (i, j)
    between different labels, and rows may repeat a value."""
    n = len(value)
    labels = np.arange(n) if known is None else known
    edges = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if n else np.zeros(0, np.int64)
    lo, hi = edges, np.r_[edges[1:], n]
    many = hi - lo > 1
    # frontiers by bits that differ so far, then by depth: near pairs link
    # first and prune the rest, and all pairs of one frontier descend together
    frontiers: list[list[list[tuple]]] = [[[] for _ in range(BITS + 1)] for _ in range(budget + 1)]
    frontiers[0][BITS].append((lo[many], hi[many], lo[many], hi[many]))

    def push(off: int, a0, a1, b0, b1, depth: int) -> None:
        if off <= budget and len(a0):
            keep = (a1 > a0) & (b1 > b0)
            if keep.any():
                frontiers[off][depth].append((a0[keep], a1[keep], b0[keep], b1[keep]))

    def take() -> Iterator[tuple[int, int, tuple]]:
        for off in range(budget + 1):
            for depth in range(BITS, -1, -1):
                if found := frontiers[off][depth]:
                    whole = [np.concatenate(x) for x in zip(*found, strict=True)]
                    found.clear()
                    for at in range(0, len(whole[0]), CHUNK):  # bounded working sets
                        yield off, depth, tuple(x[at : at + CHUNK] for x in whole)

    for off, depth, (a0, a1, b0, b1) in take():
        bit = depth - 1
        run = np.maximum.accumulate(np.where(np.r_[True, labels[1:] != labels[:-1]], np.arange(n), 0))
        linked = (run[a1 - 1] <= a0) & (run[b1 - 1] <= b0) & (labels[a0] == labels[b0])
        a0, a1, b0, b1 = (x[~linked] for x in (a0, a1, b0, b1))
        same = a0 == b0
        single = same & (a1 - a0 == 1)
        a0, a1, b0, b1, same = (x[~single] for x in (a0, a1, b0, b1, same))
        if not len(a0):
            continue
        pairs = (a1 - a0) * (b1 - b0)
        leaf = (pairs <= LEAF_PAIRS) | (bit < 0)
        if leaf.any():
            la0, lb0, wide, count = a0[leaf], b0[leaf], (b1 - b0)[leaf], pairs[leaf]
            for piece in np.array_split(np.arange(len(count)), 1 + int(count.sum()) // 2_000_000):
                which = np.repeat(piece, count[piece])
                step = np.arange(len(which)) - np.repeat(np.cumsum(count[piece]) - count[piece], count[piece])
                i, j = la0[which] + step // wide[which], lb0[which] + step % wide[which]
                near = (i < j) & (np.bitwise_count(value[i] ^ value[j]) <= budget)
                if known is not None:
                    near &= labels[i] != labels[j]
                    found(i[near], j[near])
                elif near.any():
                    labels = _merge(labels, i[near], j[near], used)
            a0, a1, b0, b1, same = (x[~leaf] for x in (a0, a1, b0, b1, same))
        if not len(a0):
            continue
        ones = np.r_[0, np.cumsum((value >> np.uint64(bit)) & np.uint64(1)).astype(np.int64)]
        am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
        other = ~same
        push(off + 1, a0, am, bm, b1, bit)
        push(off + 1, am[other], a1[other], b0[other], bm[other], bit)
        push(off, am, a1, bm, b1, bit)
        push(off, a0, am, b0, bm, bit)
    return labels


def _forest(batches: Iterator[pa.RecordBatch], budget: int, direct: bool) -> Iterator[pa.RecordBatch]:
    """Links of one partition: every member to the smallest of its component,
    or, if ``direct``, links that keep the budget themselves."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held)
    key = table["key"].to_numpy()
    value = table["fp"].to_numpy().astype(np.int64).view(np.uint64)
    lane = table["lane"].to_numpy()
    order = np.lexsort((value, key))
    key, value, lane = key[order], value[order], lane[order]
    used: list = []
    labels = trie_self_join(key, value, budget, used)
    if direct:
        x, y = (np.concatenate(p) for p in zip(*used, strict=True)) if used else (labels[:0], labels[:0])
    else:
        x = np.flatnonzero(labels != np.arange(len(labels)))
        y = labels[x]
    if len(x):
        signed = value.view(np.int64)
        yield pa.record_batch([pa.array(lane[x]), pa.array(signed[x]), pa.array(signed[y])], names=["lane", "a", "b"])


def near_links(distinct: DataFrame, budget: int = BUDGET, hot: int = HOT_KEY, direct: bool = False) -> DataFrame:
    """Spanning links (lane, a, b) between the distinct fingerprints ``fp`` of
    each ``lane`` (int, from 0 to 15)."""
    dealt = routed(distinct, budget, hot).repartition(shuffle_width(distinct.sparkSession), "key")
    return dealt.mapInArrow(functools.partial(_forest, budget=budget, direct=direct), "lane int, a bigint, b bigint").distinct()


def routed(distinct: DataFrame, budget: int = BUDGET, hot: int = HOT_KEY, more: tuple[str, ...] = ()) -> DataFrame:
    """Every row once per block, under the key of the block's value; rows (lane,
    fp, and the columns ``more``)."""
    if budget != BUDGET:
        raise ValueError("blocks are laid out for a budget of three bits")
    held = ["lane", "fp", *more]
    blocks = F.array(*[F.struct(F.lit(j).alias("j"), F.shiftrightunsigned("fp", 16 * j).bitwiseAND(F.lit(0xFFFF)).alias("v")) for j in range(4)])
    lane = F.col("lane").cast("bigint")
    dealt = distinct.select(*held, F.explode(blocks).alias("k")).select(*held, ((lane * 4 + F.col("k.j")) * 65536 + F.col("k.v")).alias("key"))
    # at most 16 * 4 * 65536 keys exist, so the list of full ones is small at any size
    full = dealt.groupBy("key").count().where(F.col("count") > hot).select("key", F.lit(True).alias("full"))
    marked = dealt.join(F.broadcast(full), "key", "left")
    rest = [F.struct(F.lit(i).alias("i"), _rest_bits(i).alias("v")) for i in range(4)]
    finer = marked.where("full").select(*held, "key", F.explode(F.array(*rest)).alias("r"))
    finer = finer.select(*held, (F.lit(1 << 40) + (F.col("key") * 4 + F.col("r.i")) * 4096 + F.col("r.v")).alias("key"))
    return marked.where(F.col("full").isNull()).select(*held, "key").unionByName(finer)


def _rest_bits(i: int):
    """12 bits of the 48 that lie outside the block that ``key`` names."""
    out = None
    for j in range(4):
        outside = [b for b in range(64) if not 16 * j <= b < 16 * (j + 1)][12 * i : 12 * (i + 1)]
        runs: list[list[int]] = []
        for b in outside:
            if runs and b == runs[-1][-1] + 1:
                runs[-1].append(b)
            else:
                runs.append([b])
        value, at = None, 0
        for run in runs:
            part = F.shiftleft(F.shiftrightunsigned("fp", run[0]).bitwiseAND(F.lit((1 << len(run)) - 1)), at)
            value = part if value is None else value.bitwiseOR(part)
            at += len(run)
        this = F.floor(F.col("key") / 65536) % 4 == j
        out = F.when(this, value) if out is None else out.when(this, value)
    return out


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest
    node reachable.  Large-star and small-star steps alternate on tables
    written to the shared folder until nothing changes; a limit of ``rounds``
    that is reached is an error."""
    edges = materialize(links.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).where("lo < hi").distinct(), "links")
    if edges.isEmpty():
        return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    last = None
    for done in itertools.count():
        if done == rounds:
            raise RuntimeError(f"not settled after {rounds} rounds")
        # large star: larger neighbours go to the smallest of the neighbourhood
        both = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionByName(edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).where("lo < hi").distinct()
        # small star: smaller neighbours and the node itself go to the smallest
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi").select(F.col("m").alias("lo"), F.col("lo").alias("hi")).where("lo < hi")
        edges = materialize(small.unionByName(low.select(F.col("m").alias("lo"), "hi")).distinct(), "links")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()
        if tuple(state) == last:
            break
        last = tuple(state)
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))


def simhash_components(docs: DataFrame, shingle: int = 3, budget: int = BUDGET, hot: int = HOT_KEY) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, fingerprint (16
    lowercase hex digits) and component_id, the smallest doc_id reachable over
    links of at most ``budget`` bits, itself included.

    Null and empty texts have fingerprint zero and are linked like any other.
    Repeated rows come back repeated.  A null doc_id stays null and names a
    component only if no other id is in it.  An empty table stays empty;
    further columns are ignored.
    """
    prints = materialize(fingerprints(docs, shingle), "simhash")
    classes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-classes")
    with tidy(docs.sparkSession):
        roots = components(near_links(classes.select(F.lit(0).alias("lane"), "fp"), budget, hot))
    rooted = materialize(classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    names = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_class = materialize(rooted.join(names, "root").select("fp", "component_id"), "simhash-named")
    return join_spread(prints, of_class, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
