"""Tokenisation shared by the packing and the training-order operators.

Ids are those of the byte-level BPE file ``byte_bpe_50k.json``.  The encoder is
the rank form of the same vocabulary, which yields the same ids several times
faster; ``tests/llm`` holds the two against each other.  A text with the string
of a token that the file adds to its vocabulary goes to the file's own encoder.
"""

from __future__ import annotations

import base64
import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END_ID = 0
LONGEST_RUN = 200_000


def default_vocabulary() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


@functools.lru_cache(maxsize=2)
def _encoder(path: str):
    """Encoder for one worker process: text -> uint32 ids without the end id."""
    def by_file(text: str) -> np.ndarray:
        return np.asarray(_tokenizer(path).encode(text, add_special_tokens=False).ids, dtype="<u4")

    ranks_path = path.removesuffix(".json") + ".tiktoken"
    try:
        with open(ranks_path, "rb") as handle:
            pairs = [line.split() for line in handle if line.strip()]
    except FileNotFoundError:
        return by_file  # another vocabulary file: its own library encodes
    import public_tokenizers
    import tiktoken

    added = [t.content for t in _tokenizer(path).get_added_tokens_decoder().values()]
    ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def by_ranks(text: str) -> np.ndarray:
        if any(a in text for a in added) or len(text) > LONGEST_RUN and max(map(len, text.split()), default=0) > LONGEST_RUN:
            return by_file(text)
        return fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)

    return by_ranks


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def encode(text: str | None, path: str) -> np.ndarray:
    """Ids of one document, the end id last.  Null and empty give just that."""
    ids = np.full(1, END_ID, dtype="<u4")
    return np.concatenate([_encoder(path)(text), ids]) if text else ids


def cut_points(length: int, capacity: int) -> list[int]:
    """Starts of the pieces of a document; only the first may be short."""
    first = (length - 1) % capacity + 1
    return [0, *range(first, length, capacity)]


def token_pieces(docs: DataFrame, capacity: int, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """One row per piece of every document of ``docs`` (doc_id, text).

    Columns: doc_id, piece, start, length, ids_crc32 and, on request, ids as
    little-endian 16- or 32-bit binary.  A null doc_id stays null; a repeated
    row gives its pieces again; further columns of ``docs`` are ignored.
    """
    path = vocabulary or default_vocabulary()
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    if with_ids:
        schema += ", ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = encode(text.as_py(), path)
                cuts = cut_points(len(ids), capacity)
                for piece, (a, b) in enumerate(zip(cuts, [*cuts[1:], len(ids)], strict=True)):
                    raw = ids[a:b].tobytes()
                    row = (doc_id.as_py(), piece, a, b - a, zlib.crc32(raw))
                    rows.append((*row, raw) if with_ids else row)
                held += len(ids) * 4 * with_ids
                if held > 16 << 20:
                    yield _as_batch(rows, with_ids)
                    rows, held = [], 0
            if rows:
                yield _as_batch(rows, with_ids)

    keys = F.col("doc_id").cast("bigint").alias("doc_id")
    return docs.select(keys, F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def _as_batch(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    kinds = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    if with_ids:
        kinds.append(("ids", pa.binary()))
    columns = list(zip(*rows, strict=True))
    return pa.record_batch([pa.array(c, t) for c, (_, t) in zip(columns, kinds, strict=True)], names=[n for n, _ in kinds])
