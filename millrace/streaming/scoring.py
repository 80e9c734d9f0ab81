"""Scoring as a stream: files in, scored lines and lane counts out.

The lane decision looks at one row at a time, so the batch expressions run
unchanged; counts per source are a keyed aggregation with state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.profiles import LATIN, Profile
from millrace.plans.mining import classified_lines


def stream_documents(spark: SparkSession, path: str, schema, files_per_trigger: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def scored_stream(docs: DataFrame, profile: Profile = LATIN) -> DataFrame:
    return classified_lines(docs, profile).select("seq", "doc_id", "source_id", "text", "difficulty", "complexity_score", "hard_signal_source")


def lane_counts(scored: DataFrame) -> DataFrame:
    return scored.groupBy("source_id", "difficulty").agg(F.count(F.lit(1)).alias("n"), F.avg("complexity_score").alias("mean_score"))


def run_available(df: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Process everything there is, then stop; a rerun continues from the
    checkpoint and skips what was done."""
    if mode == "append":
        query = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).format("parquet").option("path", out).start()
    else:
        query = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda batch, number: batch.write.mode("overwrite").parquet(out)).start()
    query.awaitTermination()
