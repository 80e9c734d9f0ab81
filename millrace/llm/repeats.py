"""Removal of repeated passages with run-length Burrows-Wheeler indexes.

Any two equal 50-byte strings choose the same anchor in themselves: the 20-byte
string with the smallest hash, the leftmost of equals.  A text falls into
stretches of neighbouring 50-byte windows with one anchor, and only stretches
with equal anchors can have a window in common, so the corpus can be indexed in
independent buckets of anchors.

1. Every block of documents sends each bucket the anchors and the hashes of its
   stretches, each pair once, with the smallest document id.  Stretches count as
   equal if a 48-bit hash of the anchor and a 64-bit hash of all bytes agree:
   of n different stretches with one anchor, a pair agrees by chance with
   probability below n * n / 2 ** 65.  The bucket
   answers, for a stretch found in more than one document, with the smallest id
   of all; in every other document all its windows are repeats.  For anchors
   with different stretches in different documents it asks for the bytes, once.
2. The asked-for stretches of a bucket form one text, in order of document.  Its
   suffix array gives the Burrows-Wheeler transform, kept as runs, with text
   positions sampled at both ends of every run.  All stretches are streamed
   through it from their ends at once: a step is an LF mapping inside a run, or
   a jump to the nearest run end with the next byte, whichever of the two
   samples agrees longer.  The matching statistics so found point to a row whose
   suffix shares 50 bytes or more; the smallest document of the rows that share
   them decides.
3. Every block marks what it was told, and removes it.

Texts never leave their block but for the stretches asked for.  An anchor that
occurs in a third of all documents sends one record per block.  One with more
than ``HOT`` different stretches is asked for window by window, and those are
dealt by their own hash.
"""

from __future__ import annotations

import functools
import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import shuffle_width

SPAN = 50
ANCHOR = 20
SIDES = ((0, 23), (8, 16), (15, 8), (23, 0))  # a window has l before and 30 - l behind
PIECE = 1 << 20
PLACE_BITS = 22
HOT = 20_000
LOT = 1 << 20  # bytes of fragments under one index
NO_ID = (1 << 63) - 1
BLOCK_BYTES = 16 << 20  # of input files, for one task
BASE = 0x9E3779B97F4A7C15 | 1


def _spread(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
        return x ^ (x >> np.uint64(33))


@functools.lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random word per byte value; powers of the base and of its inverse."""
    with np.errstate(over="ignore"):
        words = _spread(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
        n = 2 * PIECE + 2
        power = np.full(n, BASE, dtype=np.uint64)
        power[0] = 1
        inverse = np.full(n, pow(BASE, -1, 1 << 64), dtype=np.uint64)
        inverse[0] = 1
        return words, np.cumprod(power, dtype=np.uint64), np.cumprod(inverse, dtype=np.uint64)


class Stretches:
    """Stretches of several pieces of text, laid end to end.

    ``start``/``stop``: first and last window of each (places in ``text``);
    ``owner``: piece; ``anchor``: 48-bit anchor hash; ``hash``: 64-bit hash of
    the stretch's bytes; ``sides``: for each of the pairs ``SIDES`` one byte of
    a hash of so many bytes before and behind the anchor, 0 where the stretch
    has fewer.  However a window lies about its anchor, it holds one of these
    surroundings, so stretches with a window in common agree in one of them.
    """

    def __init__(self, pieces: list[bytes]):
        raw = b"".join(pieces)
        self.text = text = np.frombuffer(raw, np.uint8)
        n = len(text)
        ends = np.cumsum([len(p) for p in pieces])
        none = np.zeros(0, np.int64)
        self.start = self.stop = self.owner = none
        self.anchor = self.hash = none.astype(np.uint64)
        self.sides = np.zeros(0, np.uint32)
        if n < SPAN:
            return
        with np.errstate(over="ignore"):
            words = np.ndarray((n - 7,), dtype="<u8", buffer=raw, strides=(1,))
            m = n - ANCHOR + 1
            h = words[:m] * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            h += words[8 : 8 + m]
            h *= np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(32)
            h += words[ANCHOR - 8 : ANCHOR - 8 + m]
            h *= np.uint64(0xA0761D6478BD642F)
            h ^= h >> np.uint64(32)
            places = np.arange(m, dtype=np.uint64)
            mask = np.uint64((1 << PLACE_BITS) - 1)
            low = (h & ~mask) | places
            size = 1
            want = SPAN - ANCHOR + 1
            while size * 2 <= want:
                low = np.minimum(low[:-size], low[size:])
                size *= 2
            if size < want:
                low = np.minimum(low[: len(low) - (want - size)], low[want - size :])
            at = (low & mask).astype(np.int64)
            begin = np.arange(len(at))
            piece = np.searchsorted(ends, begin, side="right") if len(pieces) > 1 else np.zeros(len(at), np.int64)
            new = np.r_[True, (at[1:] != at[:-1]) | (piece[1:] != piece[:-1])]
            start = np.flatnonzero(new)
            stop = np.r_[start[1:], len(at)] - 1
            owner = piece[start]
            stop = np.minimum(stop, ends[owner] - SPAN)  # windows stay inside their piece
            good = stop >= start
            self.start, self.stop, self.owner = start[good], stop[good], owner[good]
            table, power, inverse = _tables()
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(table[text] * power[:n], out=sums[1:])
            self._sums = sums
            # the smallest hashes lie close together; spread them over the buckets
            self.anchor = _spread(h[at[self.start]]) >> np.uint64(16)
            self.hash = self.hashes(self.start, self.stop + SPAN)
            place = at[self.start]
            before, behind = place - self.start, self.stop + SPAN - place - ANCHOR
            packed = np.zeros((len(place), 4), np.uint8)
            for k, (left, right) in enumerate(SIDES):
                there = (before >= left) & (behind >= right)
                own = self.hashes(np.where(there, place - left, 0), np.where(there, place + ANCHOR + right, 0))
                packed[:, k] = np.where(there, (own >> np.uint64(48)).astype(np.uint8) | 1, 0)
            self.sides = packed.view(np.uint32)[:, 0]

    def hashes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hashes of the byte strings [a, b)."""
        with np.errstate(over="ignore"):
            return _spread((self._sums[b] - self._sums[a]) * _tables()[2][a])


def _pieces(texts: list[bytes]) -> Iterator[tuple[list[bytes], list[tuple[int, int]]]]:
    """Texts in lots of about ``PIECE`` bytes: pieces and their (text, place).
    A longer text is cut so that every window lies in just one piece."""
    lot, where, size = [], [], 0
    for k, text in enumerate(texts):
        step = PIECE - SPAN + 1
        for at in range(0, max(1, len(text) - SPAN + 1), step):
            piece = text[at : at + PIECE]
            if lot and size + len(piece) > PIECE:
                yield lot, where
                lot, where, size = [], [], 0
            lot.append(piece)
            where.append((k, at))
            size += len(piece)
    if lot:
        yield lot, where


# ---- records between the steps ------------------------------------------------

_pack_settings = {"level": 1}


def _to_blob(*arrays: np.ndarray) -> bytes:
    head = struct.pack("<B", len(arrays)) + b"".join(struct.pack("<2sQ", a.dtype.str[1:].encode(), len(a)) for a in arrays)
    return head + zstandard.ZstdCompressor(**_pack_settings).compress(b"".join(a.tobytes() for a in arrays))


def _from_blob(blob: bytes) -> list[np.ndarray]:
    count, out, at = blob[0], [], 1
    kinds = []
    for _ in range(count):
        kind, n = struct.unpack_from("<2sQ", blob, at)
        kinds.append((np.dtype(kind.decode()), n))
        at += 10
    raw, at = zstandard.ZstdDecompressor().decompress(blob[at:]), 0
    for kind, n in kinds:
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * kind.itemsize
    return out


def _steps(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending numbers as their first and the steps between them."""
    gaps = np.diff(values, prepend=values[:1])
    return values[:1], gaps.astype("<u4") if int(gaps.max(initial=0)) < 1 << 32 else gaps


def _from_steps(first: np.ndarray, gaps: np.ndarray) -> np.ndarray:
    return first[0] + np.cumsum(gaps, dtype=np.uint64)


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    cols = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.table({n: pa.array(c, kinds[k]) for c, (n, k) in zip(cols, fields, strict=True)})


def _texts(table: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    ids = np.array([NO_ID if d is None else d for d in table["doc_id"].to_pylist()], np.int64)
    return ids, [t or b"" for t in table["body"].to_pylist()]


def _smallest(key: np.ndarray, ids: np.ndarray, *others: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each key the row with the smallest id: key, id, whether the key has
    other ids too, and the other columns."""
    if not len(key):
        return key, ids, np.zeros(0, np.uint8), *others
    order = np.lexsort((ids, key))
    edge = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]])
    last = order[np.r_[edge[1:], len(order)] - 1]
    first = order[edge]
    return key[first], ids[first], (ids[first] != ids[last]).astype(np.uint8), *(o[first] for o in others)


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of equal neighbours."""
    if not len(values):
        return []
    edge = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]).tolist()
    return list(zip(edge, [*edge[1:], len(values)], strict=True))


_ANCHORS = "bucket int, block bigint, blob binary"
_TOLD = "block bigint, kind int, blob binary"
_FRAGMENTS = "bucket int, block bigint, blob binary"


def _send_anchors(buckets: int):
    """Step 1, block side."""

    def run(docs: pa.Table) -> pa.Table:
        block = docs["block"][0].as_py()
        ids, texts = _texts(docs)
        found = []
        for lot, where in _pieces(texts):
            s = Stretches(lot)
            owner = ids[np.array([k for k, _ in where], np.int64)][s.owner]
            found.append((s.hash, owner, s.anchor, s.sides))
        if not found:
            return _table([], _ANCHORS)
        hashes, owners, more, anchors, sides = _smallest(*(np.concatenate(x) for x in zip(*found, strict=True)))
        order = np.argsort(anchors, kind="stable")
        hashes, owners, more, anchors, sides = (x[order] for x in (hashes, owners, more, anchors, sides))
        bucket = ((anchors >> np.uint64(16)) * np.uint64(buckets)) >> np.uint64(32)
        edges = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
        rows = []
        for b in range(buckets):
            a, z = edges[b], edges[b + 1]
            if z > a:
                ids_out = owners[a:z]
                rows.append((b, block, _to_blob(*_steps(anchors[a:z]), hashes[a:z], more[a:z], sides[a:z], ids_out.astype("<u4") if 0 <= ids_out.min() and ids_out.max() < 1 << 32 else ids_out)))
        return _table(rows, _ANCHORS)

    return run


def _agreeing(anchor: np.ndarray, side: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Which rows share anchor and side with a row of another owner?"""
    order = np.lexsort((side, anchor))
    a, s, o = anchor[order], side[order], owner[order]
    edge = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (s[1:] != s[:-1])])
    differ = (np.minimum.reduceat(o, edge) != np.maximum.reduceat(o, edge)) & (s[edge] > 0)
    out = np.zeros(len(order), bool)
    out[order] = np.repeat(differ, np.diff(np.r_[edge, len(order)]))
    return out


def _answer(hot: int):
    """Step 1, bucket side: what each block is told of its stretches."""

    def run(got: pa.Table) -> pa.Table:
        columns: list[list[np.ndarray]] = [[] for _ in range(6)]
        for block, blob in zip(got["block"].to_pylist(), got["blob"].to_pylist(), strict=True):
            first, gaps, h, m, side, o = _from_blob(blob)
            record = (np.full(len(h), block, np.int64), _from_steps(first, gaps), h, o.astype(np.int64), m, side)
            for column, values in zip(columns, record, strict=True):
                column.append(values)
        data = [np.concatenate(x) for x in columns]
        # anchors found in one document only have nothing to tell
        order = np.argsort(data[1], kind="stable")
        blocks, anchors, hashes, owners, more, sides = (x[order] for x in data)
        edge = np.flatnonzero(np.r_[True, anchors[1:] != anchors[:-1]])
        many = (np.minimum.reduceat(owners, edge) != np.maximum.reduceat(owners, edge)) | (np.maximum.reduceat(more, edge) > 0)
        keep = np.repeat(many, np.diff(np.r_[edge, len(anchors)]))
        if not keep.any():
            return _table([], _TOLD)
        data = [x[keep] for x in (blocks, anchors, hashes, owners, more, sides)]
        order = np.lexsort((data[3], data[2], data[1]))
        blocks, anchors, hashes, owners, more, sides = (x[order] for x in data)
        new = np.r_[True, (hashes[1:] != hashes[:-1]) | (anchors[1:] != anchors[:-1])]
        at = np.flatnonzero(new)
        size = np.diff(np.r_[at, len(new)])
        least = np.repeat(owners[at], size)
        # of each anchor, the stretches that agree beside it with one that is
        # at home in another document
        near = sides[at].view(np.uint8).reshape(-1, len(SIDES))
        likely = np.zeros(len(at), bool)
        for k in range(len(SIDES)):
            likely |= _agreeing(anchors[at], near[:, k], owners[at])
        which = np.cumsum(np.r_[0, anchors[at][1:] != anchors[at][:-1]])
        kinds = np.bincount(which, weights=likely)[which]
        # of the first owner every block: rows that share an id may lie in several
        ask = np.where(owners == least, np.repeat(np.where(likely, np.where(kinds > hot, 2, 1), 0), size), 0).astype(np.uint8)
        # a stretch in one document is news only if its bytes are asked for
        told = (ask > 0) | (more > 0) | np.repeat(size > 1, size)
        order = np.flatnonzero(told)[np.argsort(blocks[told], kind="stable")]
        blocks, anchors, hashes, least, ask = (x[order] for x in (blocks, anchors, hashes, least, ask))
        return _table([(int(blocks[a]), 1, _to_blob(*_steps(anchors[a:z]), hashes[a:z], least[a:z], ask[a:z])) for a, z in _runs(blocks)], _TOLD)

    return run


def _known(told: pa.Table) -> tuple[np.ndarray, ...]:
    """Hashes (sorted), anchors, smallest ids and requests of a block."""
    parts = [_from_blob(b) for b, k in zip(told["blob"].to_pylist(), told["kind"].to_pylist(), strict=True) if k == 1]
    if not parts:
        none = np.zeros(0, np.uint64)
        return none, none, none.astype(np.int64), none.astype(np.uint8)
    anchors, hashes, least, ask = (np.concatenate(x) for x in zip(*((_from_steps(*p[:2]), *p[2:]) for p in parts), strict=True))
    order = np.argsort(hashes, kind="stable")
    return hashes[order], anchors[order], least[order], ask[order]


def _look_up(keys: np.ndarray, anchors: np.ndarray, s: Stretches) -> tuple[np.ndarray, np.ndarray]:
    """Which stretches are among the sorted ``keys`` with their ``anchors``,
    and where.  Equal hashes of different anchors stand side by side."""
    if not len(keys):
        return np.zeros(len(s.hash), bool), np.zeros(len(s.hash), np.int64)
    at = np.minimum(np.searchsorted(keys, s.hash), len(keys) - 1)
    while True:
        here = keys[at] == s.hash
        found = here & (anchors[at] == s.anchor)
        on = here & ~found & (at + 1 < len(keys))
        if not on.any():
            return found, at
        at = at + on


def _send_fragments(buckets: int):
    """Step 2, block side: the bytes of the stretches asked for."""

    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        if not docs.num_rows or not told.num_rows:
            return _table([], _FRAGMENTS)
        block = docs["block"][0].as_py()
        keys, anchors, least, ask = _known(told)
        keys, anchors, least, ask = (x[ask > 0] for x in (keys, anchors, least, ask))
        if not len(keys):
            return _table([], _FRAGMENTS)
        _, texts = _texts(docs)
        sent = np.zeros(len(keys), bool)
        out: list[list] = [[] for _ in range(buckets)]
        for lot, _ in _pieces(texts):
            s = Stretches(lot)
            hit, at = _look_up(keys, anchors, s)
            for j in np.flatnonzero(hit).tolist():
                k = at[j]
                if sent[k]:
                    continue
                sent[k] = True
                a, z = int(s.start[j]), int(s.stop[j])
                if ask[k] == 1:
                    bucket = (int(s.anchor[j]) >> 16) * buckets >> 32
                    out[bucket].append((keys[k], anchors[k], least[k], 0, s.text[a : z + SPAN].tobytes()))
                    continue
                places = np.arange(a, z + 1)
                own = s.hashes(places, places + SPAN)
                for off, (w, h) in enumerate(zip(places.tolist(), own.tolist(), strict=True)):
                    out[(h >> 32) * buckets >> 32].append((keys[k], anchors[k], least[k], off, s.text[w : w + SPAN].tobytes()))
        rows = []
        for b, parts in enumerate(out):
            if parts:
                k, n, e, off, raw = zip(*parts, strict=True)
                size = np.array([len(r) for r in raw], "<u4")
                rows.append((b, block, _to_blob(np.array(k, np.uint64), np.array(n, np.uint64), np.array(e, np.int64), np.array(off, "<u4"), size, np.frombuffer(b"".join(raw), np.uint8))))
        return _table(rows, _FRAGMENTS)

    return run


class RunLengthIndex:
    """Run-length Burrows-Wheeler index of a text of fragments.

    ``run_start``/``run_byte``: the runs; ``sample_first``/``sample_last``: text
    positions of the first and last row of each run; ``class_start``: the first
    row of each class of rows that agree in ``span`` bytes, ``class_least`` the
    smallest owner in it.  Nothing is kept per row; the text itself answers how
    far two suffixes agree.  Ranks and rows exist while the index is built.
    """

    def __init__(self, text: np.ndarray, span: int = SPAN, owner: np.ndarray | None = None):
        self.text = text
        n = len(text)
        around = np.resize(text, n + 7)  # circular: rows are rotations
        words = np.ndarray((n,), dtype=">u8", buffer=around.tobytes(), strides=(1,)).astype(np.uint64)
        rank = _ranks(words)
        width, at_span, open_ = 8, None, np.arange(n)
        while True:
            if width * 2 >= span and at_span is None:
                at_span = _refined(rank, np.arange(n), span - width) if span > width else rank.copy()
            # positions that still share their rank with another
            open_ = open_[np.bincount(rank, minlength=n)[rank[open_]] > 1]
            if not len(open_):
                break
            rank = _refined(rank, open_, width)
            width *= 2
        at_span = rank if at_span is None else at_span
        suffix = np.empty(n, np.int64)
        suffix[rank] = np.arange(n)
        classes = at_span[suffix]
        self.class_start = np.flatnonzero(np.r_[True, classes[1:] != classes[:-1]])
        self.class_least = None if owner is None else np.minimum.reduceat(owner[suffix], self.class_start)
        bwt = text[suffix - 1]  # the row of the whole text takes its last byte
        edge = np.flatnonzero(np.r_[True, bwt[1:] != bwt[:-1]])
        self.run_start, self.run_byte = edge, bwt[edge]
        last = np.r_[edge[1:], n] - 1
        self.sample_first, self.sample_last, self.run_last = suffix[edge], suffix[last], last
        order = np.argsort(self.run_byte, kind="stable")
        length = np.r_[edge[1:], n] - edge
        # rows of each byte, before each run: where LF takes the run's first row
        self.run_lf = np.empty(len(edge), np.int64)
        self.run_lf[order] = np.cumsum(length[order]) - length[order]
        self._by_byte = self.run_byte[order].astype(np.int64) * len(edge) + order
        self._order = order

    def least_owner(self, row: np.ndarray) -> np.ndarray:
        """Smallest owner of the rows that agree with ``row`` in the span."""
        return self.class_least[np.searchsorted(self.class_start, row, side="right") - 1]

    def _nearest(self, byte: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Runs of ``byte`` before and after ``run``; -1 where there is none."""
        r = len(self.run_start)
        at = np.searchsorted(self._by_byte, byte.astype(np.int64) * r + run)
        before, after = np.maximum(at - 1, 0), np.minimum(at, r - 1)
        before, after = self._order[before], self._order[after]
        before = np.where((at > 0) & (self.run_byte[before] == byte), before, -1)
        after = np.where((at < r) & (self.run_byte[after] == byte), after, -1)
        return before, after

    def _agree(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Bytes, at most ``most``, in which the suffixes at a and b agree."""
        out = np.zeros(len(a), np.int64)
        n, left = len(self.text), np.arange(len(a))
        step = 16
        while len(left):
            x, y = a[left] + out[left], b[left] + out[left]
            i, j = x[:, None] + np.arange(step), y[:, None] + np.arange(step)
            same = (self.text[np.minimum(i, n - 1)] == self.text[np.minimum(j, n - 1)]) & (i < n) & (j < n)
            run = np.where(same.all(1), step, same.argmin(1))
            out[left] = np.minimum(out[left] + run, most[left])
            left = left[(run == step) & (out[left] < most[left])]
        return out

    def stream(self, start: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Matching statistics of the patterns text[start : start + size], all
        streamed from their ends at once.  Yields, step by step: patterns,
        place in the pattern, row, length matched."""
        row, length = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
        for back in range(1, int(size.max(initial=0)) + 1):
            live = np.flatnonzero(size >= back)
            place = start[live] + size[live] - back
            byte, q, got = self.text[place], row[live], length[live]
            run = np.searchsorted(self.run_start, q, side="right") - 1
            jump = np.flatnonzero(self.run_byte[run] != byte)
            if len(jump):
                before, after = self._nearest(byte[jump], run[jump])
                next_place, most = place[jump] + 1, got[jump]
                up = np.where(before >= 0, self._agree(next_place, self.sample_last[before], most), -1)
                down = np.where(after >= 0, self._agree(next_place, self.sample_first[after], most), -1)
                lower = down > up
                run[jump] = np.where(lower, after, before)
                q[jump] = np.where(lower, self.run_start[after], self.run_last[before])
                got[jump] = np.maximum(up, down)
            q = self.run_lf[run] + q - self.run_start[run]
            row[live], length[live] = q, got + 1
            yield live, size[live] - back, q, got + 1


def _ranks(keys: np.ndarray) -> np.ndarray:
    """Rank of each position: how many keys are smaller than its own."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.r_[True, ordered[1:] != ordered[:-1]]
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))
    return rank


def _refined(rank: np.ndarray, open_: np.ndarray, gap: int) -> np.ndarray:
    """Ranks by twice as much text: positions of equal rank are ordered by the
    rank ``gap`` further on.  Only ``open_`` positions can change.  The text is
    taken as circular, so the rows are rotations and LF holds at the seam."""
    n = len(rank)
    further = open_ + gap
    keys = rank[open_].astype(np.uint64) << np.uint64(32) | rank[np.where(further >= n, further % n, further)].astype(np.uint64)
    order = np.argsort(keys)
    ordered = keys[order]
    place = np.arange(len(order))
    old = ordered >> np.uint64(32)
    group = np.maximum.accumulate(np.where(np.r_[True, old[1:] != old[:-1]], place, 0))
    first = np.maximum.accumulate(np.where(np.r_[True, ordered[1:] != ordered[:-1]], place, 0))
    out = rank.copy()
    out[open_[order]] = old.astype(np.int64) + first - group
    return out


def earlier_windows(fragments: list[bytes], owners: np.ndarray, span: int = SPAN) -> list[np.ndarray]:
    """For each fragment, which of its windows also lie in a fragment of a
    smaller owner.  Fragments are separated by a byte no UTF-8 text has, and
    another ends the text, so that no two rotations of it are equal."""
    order = np.argsort(owners, kind="stable")
    size = np.array([len(fragments[i]) for i in order], np.int64)
    text = np.frombuffer(b"\xff".join([*(fragments[i] for i in order), b""])[:-1] + b"\xfe", np.uint8)
    start = np.cumsum(size + 1) - size - 1
    index = RunLengthIndex(text, span, np.repeat(owners[order], size + 1))
    out = [np.zeros(max(0, n - span + 1), bool) for n in size]
    for live, place, row, matched in index.stream(start, size):
        good = np.flatnonzero((matched >= span) & (place + span <= size[live]))
        if len(good):
            which = live[good]
            early = index.least_owner(row[good]) < owners[order][which]
            for k, p in zip(which[early].tolist(), place[good][early].tolist(), strict=True):
                out[k][p] = True
    back: list = [None] * len(order)
    for k, i in enumerate(order.tolist()):
        back[i] = out[k]
    return back


def _lots(anchors: np.ndarray, frags: list[bytes]) -> Iterator[np.ndarray]:
    """Fragments in lots of about ``LOT`` bytes, each with an index of its own,
    which takes some hundred times its text.  Equal windows have equal anchors,
    so an anchor stays whole; single windows of one anchor are dealt by content."""
    order = np.argsort(anchors, kind="stable")
    size = np.array([len(frags[k]) + 1 for k in order.tolist()], np.int64)
    ready, held = [], 0
    for a, z in _runs(anchors[order]):
        n, own = int(size[a:z].sum()), order[a:z]
        if ready and held + n > LOT:
            yield np.concatenate(ready)
            ready, held = [], 0
        if n > LOT and int(size[a:z].max()) == SPAN + 1:
            part = np.array([zlib.crc32(frags[k]) for k in own.tolist()], np.int64) % -(-n // LOT)
            yield from (own[part == p] for p in np.unique(part).tolist())
            continue
        ready.append(own)
        held += n
    if ready:
        yield np.concatenate(ready)


def _match(got: pa.Table) -> pa.Table:
    """Step 2, bucket side: windows of each fragment that occur earlier."""
    blocks, keys, anchors, owners, offs, frags = [], [], [], [], [], []
    for block, blob in zip(got["block"].to_pylist(), got["blob"].to_pylist(), strict=True):
        k, anchor, e, off, size, raw = _from_blob(blob)
        data, at = raw.tobytes(), 0
        for n in size.tolist():
            frags.append(data[at : at + n])
            at += n
        keys.append(k)
        anchors.append(anchor)
        owners.append(e)
        offs.append(off)
        blocks.append(np.full(len(k), block, np.int64))
    blocks, keys, anchors, owners, offs = map(np.concatenate, (blocks, keys, anchors, owners, offs))
    found: list = [None] * len(frags)
    for lot in _lots(anchors, frags):
        for k, mask in zip(lot.tolist(), earlier_windows([frags[k] for k in lot.tolist()], owners[lot]), strict=True):
            found[k] = mask
    masks = np.array([int((m.astype(np.uint64) << np.arange(len(m), dtype=np.uint64)).sum()) << int(o) for m, o in zip(found, offs.tolist(), strict=True)], np.uint64)
    told = np.flatnonzero(masks > 0)
    order = told[np.argsort(blocks[told], kind="stable")]
    blocks, keys, anchors, masks = (x[order] for x in (blocks, keys, anchors, masks))
    return _table([(int(blocks[a]), 2, _to_blob(keys[a:z], anchors[a:z], masks[a:z])) for a, z in _runs(blocks)], _TOLD)


def _removed(ids: np.ndarray, texts: list[bytes], told: pa.Table) -> list[np.ndarray]:
    """Step 3: a mask of removed bytes for every text of a block."""
    keys, anchors, least, _ = _known(told)
    parts = [_from_blob(b) for b, k in zip(told["blob"].to_pylist(), told["kind"].to_pylist(), strict=True) if k == 2]
    none = np.zeros(0, np.uint64)
    some, places, masks = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (none, none, none)
    if len(some):  # windows asked for one by one come in several records
        order = np.lexsort((places, some))
        some, places, masks = some[order], places[order], masks[order]
        edge = np.flatnonzero(np.r_[True, (some[1:] != some[:-1]) | (places[1:] != places[:-1])])
        some, places, masks = some[edge], places[edge], np.bitwise_or.reduceat(masks, edge)
    out = [np.zeros(len(t), bool) for t in texts]
    if not len(keys):
        return out
    for lot, where in _pieces(texts):
        s = Stretches(lot)
        if not len(s.start):
            continue
        owner = ids[np.array([k for k, _ in where], np.int64)][s.owner]
        hit, at = _look_up(keys, anchors, s)
        whole = hit & (least[at] < owner)
        change = np.zeros(len(s.text) + 1, np.int64)
        np.add.at(change, s.start[whole], 1)
        np.add.at(change, s.stop[whole] + SPAN, -1)
        part, at = _look_up(some, places, s)
        part = np.flatnonzero(part & ~whole)
        if len(part):
            width = (s.stop - s.start)[part] + 1
            which = np.repeat(part, width)
            off = np.arange(len(which)) - np.repeat(np.cumsum(width) - width, width)
            bit = (masks[at[which]] >> off.astype(np.uint64)) & np.uint64(1) > 0
            np.add.at(change, (s.start[which] + off)[bit], 1)
            np.add.at(change, (s.start[which] + off + SPAN)[bit], -1)
        gone = np.cumsum(change[:-1]) > 0
        begin = 0
        for piece, (k, place) in zip(lot, where, strict=True):
            out[k][place : place + len(piece)] |= gone[begin : begin + len(piece)]
            begin += len(piece)
    return out


_CLEANED = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def _clean(with_text: bool):
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        schema = _CLEANED + ", kept binary" * with_text
        if not docs.num_rows:
            return _table([], schema)
        ids, texts = _texts(docs)
        rows = []
        for doc_id, text, gone in zip(docs["doc_id"].to_pylist(), texts, _removed(ids, texts, told), strict=True):
            n = int(gone.sum())
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes() if n else text
            spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
            row = (doc_id, len(text), n, spans, hashlib.sha256(kept).hexdigest())
            rows.append((*row, kept) if with_text else row)
        return _table(rows, schema)

    return run


def remove_repeats(docs: DataFrame, with_text: bool = False, hot: int = HOT) -> DataFrame:
    """Remove from every text of ``docs`` (doc_id, text) the bytes covered by a
    50-byte string that also starts in a document with a smaller doc_id.

    One row per row: doc_id, n_bytes, n_removed, n_spans (maximal removed
    runs), kept_sha256 and, on request, kept (the remaining bytes, which may cut
    a character).  Null and empty texts have nothing to remove.  A null doc_id
    is larger than any other and stays null; repeated rows share an id and do
    not remove each other; texts of any length are cut into overlapping pieces;
    an empty table stays empty; further columns are ignored.
    """
    width = max(shuffle_width(docs.sparkSession), -(-_size_of(docs) // BLOCK_BYTES))
    body = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    labels = F.array(*map(F.lit, _labels(docs.sparkSession, width)))
    block = F.get(labels, F.pmod(F.xxhash64("doc_id", F.octet_length(body)), F.lit(width)).cast("int")).cast("bigint")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), body.alias("body"), block.alias("block"))
    placed = lambda df: df.withColumn("bucket", F.get(labels, F.col("bucket")).cast("bigint"))
    told = placed(rows.groupBy("block").applyInArrow(_typed(_send_anchors(width)), _ANCHORS)).groupBy("bucket").applyInArrow(_typed(_answer(hot)), _TOLD)
    fragments = rows.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_typed2(_send_fragments(width)), _FRAGMENTS)
    more = placed(fragments).groupBy("bucket").applyInArrow(_typed(_match), _TOLD)
    both = told.unionByName(more)
    return rows.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(_typed2(_clean(with_text)), _CLEANED + ", kept binary" * with_text)


def _size_of(docs: DataFrame) -> int:
    """Bytes of the input, by the files if the plan knows them."""
    known = int(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if known < 1 << 60:
        return known
    return docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]


def _labels(spark: SparkSession, width: int) -> list[int]:
    """Group keys of which each lands in a partition of its own, so that every
    task has one block and one bucket of about the same size."""
    place = F.pmod(F.hash(F.col("id")), F.lit(width)).alias("place")
    found = spark.range(40 * width + 400).select("id", place).groupBy("place").agg(F.min("id").alias("id")).collect()
    got = {r["place"]: r["id"] for r in found}
    return [got.get(i, 40 * width + 400 + i) for i in range(width)]


def _typed(f):
    def run(group: pa.Table) -> pa.Table:
        return f(group)

    return run


def _typed2(f):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return f(left, right)

    return run
