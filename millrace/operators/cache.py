"""Caches, resume logs and keyed tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cache_key(sha256: Column, backend: Column, version: Column) -> Column:
    """Name of a cache entry."""
    safe = F.translate(version, "/ ", "__")
    return F.concat(F.substr(sha256, F.lit(1), F.lit(16)), F.lit("_"), backend, F.lit("_"), safe, F.lit(".json"))


def with_cache(rows: DataFrame, cache: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with what the cache has; from_cache tells hits.  A corrupt
    entry (null payload) is a miss."""
    good = cache.where("payload IS NOT NULL").dropDuplicates(keys)
    joined = rows.join(good.select(*keys, "payload", F.lit(True).alias("from_cache")), keys, "left")
    return joined.withColumn("from_cache", F.coalesce("from_cache", F.lit(False)))


def not_done(rows: DataFrame, done: DataFrame, key: str = "id", prediction: str | None = "ocr_prediction") -> DataFrame:
    """Rows still to do: not in the log, or in it without a prediction."""
    if prediction is None or prediction not in rows.columns:
        return rows.join(done.select(key).distinct(), key, "left_anti")
    marked = rows.join(done.select(key, F.lit(True).alias("_done")).distinct(), key, "left")
    return marked.where(F.col("_done").isNull() | (F.coalesce(prediction, F.lit("")) == "")).drop("_done")


def upsert(table: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """``table`` with ``rows`` in place of those of equal key."""
    return table.join(rows.select(key).distinct(), key, "left_anti").unionByName(rows, allowMissingColumns=True)


def difference(a: DataFrame, b: DataFrame, key: str = "id") -> DataFrame:
    return a.join(b.select(key).distinct(), key, "left_anti")


def fill_labels(rows: DataFrame) -> DataFrame:
    """Empty expected texts take the text layer; readings never become labels."""
    return rows.withColumn("expected_text", F.when(F.coalesce("expected_text", F.lit("")) == "", F.coalesce("text_assist", F.lit(""))).otherwise(F.col("expected_text")))
