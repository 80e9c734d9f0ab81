"""The few scalars that need Python: Arrow-batched functions."""

from __future__ import annotations

import unicodedata
from collections import Counter
from difflib import SequenceMatcher
from urllib.parse import urljoin

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

from millrace.functions.profiles import CONJUNCTS, VIRAMA


def matcher_ratio(a: str, b: str) -> float:
    """Ratio of the longest-match similarity; not symmetric."""
    return 1.0 if not a and not b else SequenceMatcher(None, a, b).ratio()


def common_prefix(a: str, b: str) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[:mid] == b[:mid] else (low, mid - 1)
    return low


def prefix_score(a: str, b: str) -> float:
    """Near 1 if one normalised text nearly begins the other."""
    if not a or not b:
        return 0.0
    short, long_ = sorted((a, b), key=len)
    if len(short) < 16:
        return matcher_ratio(a, b)
    n = common_prefix(short, long_)
    if n == len(short) or (n >= 24 and n / len(short) >= 0.88):
        return n / len(long_)
    return 0.0


def similarity(a: str, b: str) -> float:
    return max(matcher_ratio(a, b), prefix_score(a, b))


COUNTED = 256  # columns of hashed counts


class Counted:
    """Texts with their lengths and, for runs of one, two and three characters,
    how often each hash of a run occurs (at most 255 times is counted)."""

    def __init__(self, texts: list[str]):
        self.texts = texts
        self.size = np.array([len(t) for t in texts], np.int64)
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        self.row = np.repeat(np.arange(len(texts)), self.size)
        self.left = np.repeat(np.cumsum(self.size), self.size) - np.arange(len(codes))
        self.codes = codes
        # of texts of 200 characters or more the matcher starts from rare ones only
        pair, n = np.unique(self.row << 21 | codes.astype(np.int64), return_counts=True)
        rare = n <= self.size[pair >> 21] // 100 + 1
        self.seeds = np.bincount(pair[rare] >> 21, n[rare], len(texts)).astype(np.int64)
        self.seeds[self.size < 200] = 1 << 40
        self._made: dict[int, np.ndarray] = {}

    def counts(self, run: int) -> np.ndarray:
        """Counts by hash of the runs of so many characters, a row a text."""
        if run not in self._made:
            good = self.left >= run
            place = np.flatnonzero(good)
            with np.errstate(over="ignore"):
                h = np.zeros(len(place), np.uint64)
                for i in range(run):
                    h = (h + self.codes[place + i]) * np.uint64(0x9E3779B97F4A7C15)
            cell = self.row[place] * COUNTED + (h >> np.uint64(56)).astype(np.int64)
            got = np.bincount(cell, minlength=len(self.texts) * COUNTED).reshape(-1, COUNTED)
            self._made[run] = np.minimum(got, 255).astype(np.uint8)
        return self._made[run]


def may_be_similar(a: Counted, b: Counted, least: float, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of rows that the bounds leave open, of ``same`` tables each once,
    and how many runs of three characters they share at most.

    Texts of ratio ``least`` are some inserted and deleted characters apart, a
    share 1 - least of both lengths at most.  Each of them changes 2 q - 1 of
    the runs of q characters, in all; hashing and a limit of counts only bring
    texts nearer.  A text that begins the other is nearer still by that count.
    """
    edits = lambda i, j: (1 - least) * (a.size[i] + b.size[j]) + 1e-6
    order = np.argsort(b.size, kind="stable")
    sizes, one = b.size[order], b.counts(1)[order].astype(np.int16)
    # most letters have few hashes, so all but the columns in use can go
    used = np.flatnonzero((a.counts(1).max(0, initial=0) > 0) | (b.counts(1).max(0, initial=0) > 0))
    one, mine = np.ascontiguousarray(one[:, used]), a.counts(1)[:, used].astype(np.int16)
    ratio = least / (2 - least) - 1e-9
    left, right, common = [], [], []
    for i in range(len(a.texts)):
        low = np.searchsorted(sizes, a.size[i] * ratio, side="left")
        high = np.searchsorted(sizes, a.size[i] / ratio, side="right")
        near = np.abs(one[low:high] - mine[i]).sum(1, dtype=np.int32)
        j = order[low + np.flatnonzero(near <= (1 - least) * (a.size[i] + sizes[low:high]) + 1e-6)]
        j = j[j > i] if same else j
        for run in (2, 3):
            if len(j):
                apart = np.abs(b.counts(run)[j].astype(np.int16) - a.counts(run)[i].astype(np.int16)).sum(1, dtype=np.int32)
                near = apart <= (2 * run - 1) * edits(i, j)
                j, apart = j[near], apart[near]
        if len(j):
            left.append(np.full(len(j), i, np.int64))
            right.append(j)
            common.append((np.maximum(a.size[i] - 2, 0) + np.maximum(b.size[j] - 2, 0) - apart) / 2)
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right), np.concatenate(common)) if left else (none, none, none)


def common_subsequence(a: str, places: dict[str, int], n: int) -> int:
    """Length of the longest common subsequence of a and a text of n characters,
    of which ``places`` has a bit for each place of a character."""
    full = open_ = (1 << n) - 1
    for c in a:
        hit = open_ & places.get(c, 0)
        open_ = (open_ + hit | open_ - hit) & full
    return n - open_.bit_count()


def similar_pairs(left: list[str], right: list[str], least: float, same: bool) -> list[tuple[str, str, float]]:
    """(first, second, similarity) of texts so similar, both ways round."""
    a = Counted(left)
    b = a if same else Counted(right)
    rows, cols, common = may_be_similar(a, b, least, same)
    # every matched block but the common prefix holds a rare character of the
    # second text, and has two characters more than runs of three
    enough = least * (a.size[rows] + b.size[cols]) - 1e-6
    there, back = (2 * (common + 2 * (1 + seeds)) >= enough for seeds in (b.seeds[cols], a.seeds[rows]))
    order = np.flatnonzero(there | back)
    order = order[np.argsort(cols[order], kind="stable")]  # what is known of a second text serves for all first ones
    last, fits = -1, np.zeros(len(rows), bool)
    for k, i, j in zip(order.tolist(), rows[order].tolist(), cols[order].tolist(), strict=True):
        if j != last:
            last, places = j, {}
            for at, c in enumerate(b.texts[j]):
                places[c] = places.get(c, 0) | 1 << at
        fits[k] = 2 * common_subsequence(a.texts[i], places, len(b.texts[j])) >= enough[k]
    out = []
    for x, y, xs, ys in ((a, b, rows[there & fits], cols[there & fits]), (b, a, cols[back & fits], rows[back & fits])):
        matcher, last = SequenceMatcher(), -1
        order = np.argsort(ys, kind="stable")
        for i, j in zip(xs[order].tolist(), ys[order].tolist(), strict=True):
            s, t = x.texts[i], y.texts[j]
            if j != last:
                matcher.set_seq2(t)
                last = j
            matcher.set_seq1(s)
            score = max(matcher.ratio(), prefix_score(s, t))
            if score >= least:
                out.append((s, t, score))
    return out


def similar_in_lots(least: float, keys: int):
    """Similar texts of two lots, which ``_side`` tells apart."""

    def run(key: tuple, lots: pa.Table) -> pa.Table:
        across, low, high = (k.as_py() for k in key[keys + 1 : keys + 4])
        texts, sides = lots["_a"].to_pylist(), lots["_side"].to_pylist()
        same = not across and low == high
        left = [t for t, s in zip(texts, sides, strict=True) if same or s == 0]
        right = [] if same else [t for t, s in zip(texts, sides, strict=True) if s == 1]
        found = similar_pairs(left, right, least, same) if left and (same or right) else []
        cols = [pa.array([x[i] for x in found], t) for i, t in enumerate((pa.string(), pa.string(), pa.float64()))]
        own = {name: pa.array([k.as_py()] * len(found), k.type) for name, k in zip(lots.column_names, key[:keys], strict=False)}
        return pa.table(own | dict(zip(("_a", "_b", "similarity"), cols, strict=True)))

    return run


def token_distance(a: list[str], b: list[str]) -> int:
    """Edits that turn one list of tokens into the other."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        left, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            left, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, left + (x != y))
    return row[-1]


@F.pandas_udf(DoubleType())
def word_error_rate(ref: pd.Series, hyp: pd.Series) -> pd.Series:
    """Token edits per reference token, of texts normalised already."""

    def one(r: str | None, h: str | None) -> float:
        x, y = (r or "").split(), (h or "").split()
        return token_distance(x, y) / len(x) if x else float(bool(y))

    return pd.Series([one(r, h) for r, h in zip(ref, hyp, strict=True)], dtype="float64")


def conjunct_counts(text: str | None) -> Counter:
    """Named clusters, longest first and without overlap; then consonants
    joined by a virama in what they leave."""
    text = unicodedata.normalize("NFC", text or "")
    taken, found = bytearray(len(text)), Counter()

    def take(at: int, part: str) -> None:
        if not any(taken[at : at + len(part)]):
            taken[at : at + len(part)] = b"\1" * len(part)
            found[part] += 1

    for cluster in sorted(CONJUNCTS, key=len, reverse=True):
        at = text.find(cluster)
        while at >= 0:
            take(at, cluster)
            at = text.find(cluster, at + 1)
    at = 1
    while at < len(text) - 1:
        # joined pairs are looked for from left to right, each after the last
        if text[at] == VIRAMA and "ऀ" <= text[at - 1] <= "ॿ" and "ऀ" <= text[at + 1] <= "ॿ":
            take(at - 1, text[at - 1 : at + 2])
            at += 3
        else:
            at += 1
    return found


@F.pandas_udf(DoubleType())
def conjunct_error_rate(ref: pd.Series, hyp: pd.Series) -> pd.Series:
    """Share of the reference's conjuncts that the reading lacks; null if the
    reference has none."""

    def one(r: str | None, h: str | None) -> float | None:
        want = conjunct_counts(r)
        return (want - conjunct_counts(h)).total() / want.total() if want else None

    return pd.Series([one(r, h) for r, h in zip(ref, hyp, strict=True)], dtype="float64")


@F.pandas_udf(StringType())
def absolute_url(base: pd.Series, link: pd.Series) -> pd.Series:
    def one(b: str | None, x: str | None) -> str | None:
        try:
            return None if x is None else urljoin(b or "", x)
        except ValueError:
            return None

    return pd.Series([one(b, x) for b, x in zip(base, link, strict=True)], dtype="object")
