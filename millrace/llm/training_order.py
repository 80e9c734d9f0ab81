"""Training-order materialisation.

Documents are tokenised and joined end to end inside each input partition, cut
into sequences of ``seq_len`` ids, and the partition's last sequence is padded.
A keyed Feistel permutation over the next even power of two, walked along its
cycle until it lands below the number of sequences, gives each sequence its
global slot: no shuffle of a permutation table, no state, and the same slot on
every rerun.  Range partitions of the slots write shards of records of one
fixed stride, so slot ``s`` is byte ``(s mod per_shard) * stride`` of shard
``s div per_shard``: a reader seeks, reads on, and resumes from a slot number.

Record: number of ids (4 bytes), first document's id (8 bytes), ids (2 bytes
each when the vocabulary allows, else 4), padding with the end id, one line
feed; integers are little-endian.  The line feed is what Spark's text writer
puts after each value, so its commit protocol writes the shards: a task that
dies leaves nothing, and any file system that Spark writes will do.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import materialize, scratch
from millrace.llm.tokens import END_ID, default_vocabulary, encode

SEQ_LEN = 2048
PER_SHARD = 4096
KEY = 20_240_229
ROUNDS = 6
PASSES = 4  # in which the shards are written
ID_BYTES = 2
NO_DOC = -(1 << 63)


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """64-bit finaliser: multiply and shift until every bit depends on every."""
    with np.errstate(over="ignore"):
        x = (x + np.uint64(key & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))


def feistel_slots(numbers: np.ndarray, n: int, key: int = KEY) -> np.ndarray:
    """Slots of the sequence numbers: a bijection of [0, n) for every key."""
    half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    mask = np.uint64((1 << int(half)) - 1)
    out = numbers.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        x = out[todo]
        left, right = x >> half, x & mask
        for r in range(ROUNDS):
            left, right = right, left ^ (_mix(right, key * ROUNDS + r) & mask)
        out[todo] = x = (left << half) | right
        todo = todo[x >= np.uint64(n)]
    return out.astype(np.int64)


def _shrink(ids: np.ndarray, id_bytes: int) -> bytes:
    """Ids for the way to their shard: by byte planes, compressed."""
    planes = ids.astype(f"<u{id_bytes}").view(np.uint8).reshape(-1, id_bytes).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _restore(raw: bytes, id_bytes: int) -> bytes:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    return planes.reshape(id_bytes, -1).T.tobytes()


def stride(seq_len: int = SEQ_LEN, id_bytes: int = ID_BYTES) -> int:
    return 12 + seq_len * id_bytes + 1


def sequences(docs: DataFrame, seq_len: int = SEQ_LEN, vocabulary: str | None = None, id_bytes: int = ID_BYTES) -> DataFrame:
    """(part, idx, n_ids, first_doc, ids): the sequences of each partition; ids
    are compressed by byte planes."""
    path = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, owners, idx = np.zeros(0, "<u4"), [], 0  # owners: (place in rest, doc_id)

        def cut(final: bool) -> pa.RecordBatch | None:
            nonlocal rest, owners, idx
            rows = []
            at, k = 0, 0
            while len(rest) - at >= seq_len or (final and len(rest) > at):
                while k + 1 < len(owners) and owners[k + 1][0] <= at:
                    k += 1
                ids = rest[at : at + seq_len]
                if id_bytes == 2 and int(ids.max()) > 0xFFFF:
                    raise ValueError("ids over 65535 need id_bytes=4")
                rows.append((idx, len(ids), owners[k][1], _shrink(ids, id_bytes)))
                at, idx = at + len(ids), idx + 1
            owners = [(p - at, d) for p, d in owners[k:]]
            rest = rest[at:]
            if not rows:
                return None
            cols = list(zip(*rows, strict=True))
            return pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.binary()), strict=True)], names=["idx", "n_ids", "first_doc", "ids"])

        for batch in batches:
            fresh, held = [rest], len(rest)
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = encode(text.as_py(), path)
                owners.append((held, doc_id.as_py()))
                fresh.append(ids)
                held += len(ids)
                if held > 2_000_000:
                    rest = np.concatenate(fresh)
                    if (out := cut(False)) is not None:
                        yield out
                    fresh, held = [rest], len(rest)
            rest = np.concatenate(fresh)
            if (out := cut(False)) is not None:
                yield out
        if (out := cut(True)) is not None:
            yield out

    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cut = source.mapInArrow(run, "idx bigint, n_ids int, first_doc bigint, ids binary")
    return cut.withColumn("part", F.spark_partition_id())


def numbered(seqs: DataFrame, key: int = KEY) -> tuple[DataFrame, int]:
    """Adds seq_no (dense over all partitions) and slot; also their number."""
    counts = seqs.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # one row a partition
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    base = counts.withColumn("base", F.sum("n").over(Window.orderBy("part")) - F.col("n")).select("part", "base")
    kinds = "part int, idx bigint, n_ids int, first_doc bigint, ids binary, seq_no bigint, slot bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column(batch.schema.get_field_index("seq_no")).to_numpy()
            slot = pa.array(feistel_slots(number, total, key), pa.int64())
            yield pa.record_batch([*batch.columns, slot], names=[*batch.schema.names, "slot"])

    with_no = seqs.join(F.broadcast(base), "part").select("part", "idx", "n_ids", "first_doc", "ids", (F.col("base") + F.col("idx")).alias("seq_no"))
    return with_no.mapInArrow(run, kinds), total


def write_shards(seqs: DataFrame, out: str, per_shard: int = PER_SHARD, seq_len: int = SEQ_LEN, id_bytes: int = ID_BYTES, key: int = KEY) -> int:
    """Write shard folders ``out/shard=k`` with one file each; returns the
    number of sequences."""
    slotted, total = numbered(seqs, key)
    body = seq_len * id_bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot, n_ids, first, ids = batch.columns
            rows = []
            for n, d, packed in zip(n_ids.to_pylist(), first.to_pylist(), ids.to_pylist(), strict=True):
                raw = _restore(packed, id_bytes)
                pad = END_ID.to_bytes(id_bytes, "little") * ((body - len(raw)) // id_bytes)
                rows.append(struct.pack("<Iq", n, NO_DOC if d is None else d) + raw + pad)
            yield pa.record_batch([pa.array(slot.to_numpy() // per_shard), slot, pa.array(rows, pa.binary())], names=["shard", "slot", "record"])

    # ids travel unpadded and are padded by the task that writes them; a pass
    # moves its share of the shards, so only that share lies in shuffle files
    shards = max(1, -(-total // per_shard))
    placed = slotted.select("slot", "n_ids", "first_doc", "ids", F.floor(F.col("slot") / per_shard).cast("bigint").alias("shard"))
    for k in range(PASSES):
        dealt = placed.where(F.col("shard") % PASSES == k).repartitionByRange(min(-(-shards // PASSES), 100_000), "shard").sortWithinPartitions("shard", "slot")
        records = dealt.select("slot", "n_ids", "first_doc", "ids").mapInArrow(run, "shard bigint, slot bigint, record binary")
        lines = records.select("shard", F.col("record").cast("string").alias("record"))
        lines.write.mode("append" if k else "overwrite").partitionBy("shard").option("lineSep", "\n").option("compression", "none").text(out)
    return total


def read_shards(spark: SparkSession, out: str, per_shard: int = PER_SHARD, seq_len: int = SEQ_LEN, id_bytes: int = ID_BYTES, start: int = 0) -> DataFrame:
    """Records back from the shards: slot, shard, byte_offset, n_ids,
    first_doc, ids, ids_crc32 (of the ids as 32-bit little-endian).

    A reader that resumes names the slot to ``start`` from: shards before it
    are not opened, records before it not decoded."""
    step = stride(seq_len, id_bytes)
    schema = "slot bigint, shard bigint, byte_offset bigint, n_ids int, first_doc bigint, ids binary, ids_crc32 bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                view = memoryview(content.as_buffer())
                if len(view) % step:
                    raise ValueError(f"shard {shard}: {len(view)} bytes are no multiple of {step}")
                rows = []
                for k in range(max(0, start - shard * per_shard), len(view) // step):
                    record = view[k * step : (k + 1) * step]
                    n, d = struct.unpack_from("<Iq", record)
                    ids = np.frombuffer(record, dtype=f"<u{id_bytes}", count=n, offset=12)
                    rows.append((shard * per_shard + k, shard, k * step, n, None if d == NO_DOC else d, ids.tobytes(), zlib.crc32(ids.astype("<u4").tobytes())))
                cols = list(zip(*rows, strict=True)) if rows else [[]] * 7
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64())
                yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["slot", "shard", "byte_offset", "n_ids", "first_doc", "ids", "ids_crc32"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(out)  # shard is a partition column
    wanted = files.where(F.col("shard") >= start // per_shard)
    return wanted.select(F.col("shard").cast("bigint").alias("shard"), "content").mapInArrow(run, schema)


def materialize_order(docs: DataFrame, out: str | None = None, seq_len: int = SEQ_LEN, per_shard: int = PER_SHARD, key: int = KEY, vocabulary: str | None = None) -> DataFrame:
    """Write the shards for ``docs`` (doc_id, text) and return what they hold.

    Every row gives its ids and the end id, null and empty texts just that;
    a null doc_id is kept as null; repeated rows repeat; an empty table gives
    no record; further columns are ignored.
    """
    spark = docs.sparkSession
    out = out or scratch(spark, "shards")
    seqs = materialize(sequences(docs, seq_len, vocabulary), "sequences")
    if not write_shards(seqs, out, per_shard, seq_len, key=key):
        return spark.createDataFrame([], "slot bigint, shard bigint, byte_offset bigint, n_ids int, first_doc bigint, ids binary, ids_crc32 bigint")
    return read_shards(spark, out, per_shard, seq_len)
