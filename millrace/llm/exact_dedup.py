"""Exact deduplication as a stateful stream.

The rows are first written to a content store whose row numbers are the
content locators.  A stream over the store's narrow columns keeps, per digest,
the row that stays, the digest's row count and the locator; the state lives in
RocksDB on the executors' disks, is checkpointed to the shared folder and never
expires.  Partial aggregation before the shuffle leaves one record per digest
and task, so a digest that holds a third of all rows weighs no more than any
other.  Every hit is then checked: the full bytes at its own locator against
the full bytes at the locator that the state retains.  Digests under which two
different texts were found are resolved by the texts themselves.

A state folder that is named lasts: the next call with it adds its rows to the
content store, and only they go through the stream, against the state that the
earlier ones left.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import fresh, join_spread, materialize, scratch, settings, text_or_empty

BLANKS = r"[\x20\x09-\x0D]+"
FILES_PER_TRIGGER = 4096
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # one small store a partition: no space is set aside for logs
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def normalised(column: str = "text") -> Column:
    """The text without the six ASCII blanks; null counts as empty."""
    return F.regexp_replace(text_or_empty(column), BLANKS, "")


def _keeper() -> Column:
    """Orders rows: most code points, then smallest id (null last), then place."""
    return F.struct((-F.col("n_chars")).alias("o1"), F.col("doc_id").isNull().alias("o2"), F.col("doc_id").alias("o3"), F.col("row").alias("o4"))


def stream_groups(spark: SparkSession, folder: str, schema, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """Run the keyed state over what is new in the content store of ``folder``;
    returns the state's last word per digest: keep_id, keep_row (the locator),
    group_size."""
    out, checkpoint = f"{folder}/state", f"{folder}/checkpoint"
    narrow = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(f"{folder}/content").select("row", "doc_id", "n_chars", "digest")
    grouped = narrow.groupBy("digest").agg(F.min(_keeper()).alias("best"), F.count(F.lit(1)).alias("group_size"))

    def put(batch: DataFrame, number: int) -> None:
        batch.select("digest", F.col("best.o3").alias("keep_id"), F.col("best.o4").alias("keep_row"), "group_size", F.lit(number).alias("batch")).write.mode("overwrite").parquet(f"{out}/batch={number}")

    with settings(spark, _STATE):
        query = grouped.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(put).trigger(availableNow=True).start()
        query.awaitTermination()
    shape = "digest string, keep_id bigint, keep_row bigint, group_size bigint"
    written = _stored(spark, out, shape + ", batch int")
    if written is None:
        return spark.createDataFrame([], shape)  # no rows at all: no batch ran
    # counts only grow, so the largest is the state's final record
    last = written.groupBy("digest").agg(F.max_by(F.struct("keep_id", "keep_row"), F.struct("group_size", "batch")).alias("best"), F.max("group_size").alias("group_size"))
    return last.select("digest", F.col("best.keep_id").alias("keep_id"), F.col("best.keep_row").alias("keep_row"), "group_size")


def _stored(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """The table at ``path``, None where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def exact_groups(docs: DataFrame, row: str | None = None, digest: Column | None = None, files_per_trigger: int = FILES_PER_TRIGGER, state: str | None = None) -> DataFrame:
    """Group the rows of ``docs`` (doc_id, text, ...) by equal normalised text.

    One row per input row: row, doc_id, keep_id, keep_row, group_size, kept,
    text_sha256.  Equal texts keep the row with the most code points, then the
    smallest doc_id; of repeated rows just one is kept.  A null text counts as
    empty, a null doc_id sorts last and stays null; an empty table gives an
    empty result; further columns are ignored.  ``row`` names a column of
    unique row numbers; without it rows are numbered here.  ``digest`` replaces
    the state's key (tests use a weak one: results stay exact).

    ``state`` names a folder, readable by all executors, whose state and
    content outlast the call; the result then has the rows of all calls with
    it, numbered here.
    """
    spark = docs.sparkSession
    folder = state or scratch(spark, "exact")
    path = f"{folder}/content"
    if row is None:
        earlier = _stored(spark, path, "row bigint") if state else None
        first = earlier.agg(F.coalesce(F.max("row") + 1, F.lit(0))).first()[0] if earlier is not None else 0
        number = F.monotonically_increasing_id() + F.lit(first)
    elif state:
        raise ValueError("rows of a lasting state are numbered by it")
    else:
        number = F.col(row)
    clean = docs.select(number.alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("text"))
    clean = clean.withColumn("body", normalised()).withColumn("text_sha256", F.sha2("body", 256))
    store = clean.select("row", "doc_id", F.length("text").cast("bigint").alias("n_chars"), (F.col("text_sha256") if digest is None else digest).alias("digest"), "text_sha256", "body")
    store.write.mode("append").option("compression", "zstd").parquet(path)
    content = spark.read.schema(store.schema).parquet(path)

    groups = materialize(stream_groups(spark, folder, store.schema, files_per_trigger), "exact-groups")
    narrow = content.select("row", "doc_id", "digest", "text_sha256")
    placed = materialize(join_spread(narrow, groups, "digest", by="row"), "exact-placed")

    # full bytes of each hit against the bytes at the retained locator
    hits = placed.where(F.col("row") != F.col("keep_row")).select("row", "keep_row", "digest")
    bytes_of = content.select("row", "body")
    kept_bytes = bytes_of.join(hits.select(F.col("keep_row").alias("row")).distinct(), "row", "left_semi").select(F.col("row").alias("keep_row"), F.col("body").alias("kept_body"))
    checked = join_spread(hits.join(bytes_of, "row"), kept_bytes, "keep_row", hits, by="row")
    clashing = materialize(checked.where(F.col("body") != F.col("kept_body")).select("digest").distinct(), "exact-clashes")
    result = placed
    if not clashing.isEmpty():
        same = content.join(clashing, "digest", "left_semi")
        by_text = same.groupBy("body").agg(F.min(_keeper()).alias("best"), F.count(F.lit(1)).alias("group_size"))
        exact = join_spread(same.select("row", "doc_id", "digest", "text_sha256", "body"), by_text, "body", by="row")
        exact = exact.select("digest", "row", "doc_id", "text_sha256", F.col("best.o3").alias("keep_id"), F.col("best.o4").alias("keep_row"), "group_size")
        result = placed.join(clashing, "digest", "left_anti").unionByName(exact.select(*placed.columns))
    return result.select("row", "doc_id", "keep_id", "keep_row", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256")


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose normalised text another row keeps; all
    columns stay.  The rows are stored with their number first, so the verdict
    meets the very row it was made for, null and repeated ids included."""
    (row,) = fresh(docs.columns, "row")
    stored = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "exact-rows")
    staying = exact_groups(stored, row=row).where("kept").select(F.col("row").alias(row))
    return stored.join(staying, row, "left_semi").select(*docs.columns)
