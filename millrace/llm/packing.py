"""Best-fit packing with certified bin counts.

Pieces are dealt to partitions by a hash of their own row, so no key can make
one partition large.  Each partition runs best-fit decreasing on its lengths
and holds the number of bins against a lower bound from dual feasible
functions.  Bins that a partition leaves open beyond its bound, and its least
filled bin (the rounding loss of having partitions at all), give their
documents up; those are dealt anew to as few partitions as hold them and packed
again, until one partition is left or no fewer than half would be.  A round that
does not use fewer bins is not taken; the places before it hold.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import materialize
from millrace.llm.tokens import token_pieces

CAPACITY = 2048
PIECES_PER_PARTITION = 40_000
EXCHANGE_SHARE = 0.02


def lower_bound(lengths: Iterable[int] | np.ndarray, capacity: int) -> int:
    """Bins that any packing of ``lengths`` needs, by dual feasible functions.

    The best of the volume bound, the threshold functions with every cut
    ``a <= capacity / 2`` and the rounding functions ``u_k`` for small ``k``.
    """
    sizes = np.asarray(list(lengths) if not isinstance(lengths, np.ndarray) else lengths, dtype=np.int64)
    if not len(sizes):
        return 0
    count = np.bincount(sizes, minlength=capacity + 1).astype(np.int64)
    value = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int(sizes.sum()) // capacity)
    # threshold a: above capacity - a counts whole, below a counts nothing
    n_above = np.cumsum(count[::-1])[::-1]
    volume = np.cumsum(count * value)
    cuts = np.arange(1, capacity // 2 + 1)
    whole = n_above[capacity - cuts + 1] if len(cuts) else np.zeros(0, np.int64)
    middle = volume[capacity - cuts] - volume[cuts - 1]
    if len(cuts):
        best = max(best, int((whole + -(-middle // capacity)).max()))
    # halves: pieces above half a bin never share one, smaller ones fill the rest
    half = capacity // 2
    for cut in cuts:
        large = n_above[capacity - cut + 1]
        mid = n_above[half + 1] - large
        room = mid * capacity - (volume[capacity - cut] - volume[half])
        small = volume[half] - volume[cut - 1]
        best = max(best, int(large + mid + max(0, -(-(small - room) // capacity))))
    for k in range(1, 25):
        scaled = value * (k + 1)
        exact = scaled % capacity == 0
        weight = np.where(exact, value * k, (scaled // capacity) * capacity)  # times 1 / k
        best = max(best, -(-int((count * weight).sum()) // (capacity * k)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece; ties go by position, so reruns agree.

    Open bins are stacked by the room they have left, and one integer's bits
    say which amounts of room occur: the tightest fit is its lowest bit at or
    above the length.
    """
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    occurring, used = 0, 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = occurring >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            home = open_by_room[room].pop()
            if not open_by_room[room]:
                occurring ^= 1 << room
        else:
            room, home = capacity, used
            used += 1
        bins[i], offsets[i] = home, capacity - room
        if rest := room - size:
            open_by_room[rest].append(home)
            occurring |= 1 << rest
    return bins, offsets


def _pack(group: pa.Table, capacity: int, last: bool, round_no: int) -> pa.Table:
    group = group.sort_by([("row", "ascending")])
    lengths = group["length"].to_numpy().astype(np.int64)
    bins, offsets = best_fit_decreasing(lengths, capacity)
    bound = lower_bound(lengths, capacity)
    n = int(bins.max()) + 1
    filled = np.bincount(bins, weights=lengths, minlength=n)
    gap = n - bound
    given = np.zeros(n, bool)
    if not last:
        slack = np.flatnonzero(filled < capacity)
        order = slack[np.argsort(filled[slack], kind="stable")]
        given[order[: max(gap, 1, int(n * EXCHANGE_SHARE))]] = True
    part = int(group["part"][0].as_py())
    number = (np.int64(round_no) << np.int64(58)) | (np.int64(part) << np.int64(32)) | bins
    return pa.table(
        {
            **{c: group[c] for c in ("row", "doc_id", "piece", "start", "length", "ids_crc32")},
            "sequence_id": pa.array(number, pa.int64()),
            "offset": pa.array(offsets, pa.int64()),
            "released": pa.array(given[bins]),
            "bound": pa.array(np.full(len(bins), bound, np.int64)),
        }
    )


def _packer(capacity: int, last: bool, round_no: int):
    def run(group: pa.Table) -> pa.Table:
        return _pack(group, capacity, last, round_no)

    return run


_PACKED = "row bigint, doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint, released boolean, bound bigint"


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, per_partition: int = PIECES_PER_PARTITION) -> DataFrame:
    """Pack rows (doc_id, piece, start, length, ids_crc32); adds sequence_id,
    offset and ``bound``, the certified least number of bins of the partition
    that placed the row.  Lengths are 1 to ``capacity``.  An empty table stays
    empty."""
    spark = pieces.sparkSession
    rows = materialize(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    total, done = rows.count(), None
    parts = max(1, -(-total // per_partition))
    for round_no in itertools.count():
        last = parts == 1
        dealt = rows.withColumn("part", F.pmod(F.xxhash64("row", F.lit(round_no)), F.lit(parts)))
        packed = dealt.groupBy("part").applyInArrow(_packer(capacity, last, round_no), _PACKED)
        packed = materialize(packed, "packed")
        if done is not None:
            before, after = (x.agg(F.countDistinct("sequence_id")).first()[0] for x in (rows, packed))
            if after >= before:  # the exchange gained nothing: the old places hold
                done = done.unionByName(rows.select(*packed.columns))
                break
        rows = packed.where("released")
        need = max(1, -(-rows.count() // per_partition))
        # an exchange among half as many partitions or more would settle little
        last = last or need * 2 > parts
        kept = packed if last else packed.where(~F.col("released"))
        done = kept if done is None else done.unionByName(kept)
        if last:
            break
        parts = need
    return done.drop("row", "released") if done is not None else spark.createDataFrame([], _PACKED)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """Tokenise ``docs`` (doc_id, text) and pack every piece.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset, bound.  Null and empty texts are the end id alone; repeated rows
    are packed each for itself; null doc_ids stay null; other columns are
    ignored, whatever their names.
    """
    return pack_pieces(token_pieces(docs, capacity, vocabulary), capacity)
