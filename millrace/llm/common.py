"""Shared plumbing of the training-data operators.

Intermediate tables go to the folder named by ``spark.checkpoint.dir``; it is
the one place that the driver and every executor can read, so a lost executor
costs a re-read and never a lost block.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


LEAST_HOT = 64
_made: list[str] = []  # folders under the shared one, in order


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only in local mode."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="millrace-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Texts go to Python at most ``rows`` at a time: a batch of whole texts is
    held by the JVM and by Python at once, beside whatever else a task needs."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))
    # tables between steps are files, so a step's shuffles can go when it ends
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Session settings for a while."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def scratch(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Removes what was stored in the shared folder meanwhile, but for the
    table stored last, which is the result."""
    before = len(_made)
    yield
    for path in _made[before:-1]:
        remove(spark, path)
    del _made[before:-1]


def materialize(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the files.

    Its joins are shuffles unless they ask for a broadcast, so the plan is the
    same at every size."""
    spark = df.sparkSession
    small_batches(spark)
    path = scratch(spark, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def join_spread(left: DataFrame, right: DataFrame, key: str, counted: DataFrame | None = None, how: str = "inner", by: str | None = None) -> DataFrame:
    """Join ``left`` with ``right``, whose ``key`` is unique, so that no key
    puts many rows of ``left`` into one task.

    Keys with more than a thousandth of all rows (at most a thousand keys, so
    the list that is broadcast is small at any size) are dealt to several
    tasks, by the column ``by`` or else at random, and their row of ``right``
    goes to each of them.  Null keys match nothing and are dealt likewise.
    ``counted`` is a stored table with the keys of ``left``, by default
    ``left`` itself.
    """
    source = left if counted is None else counted
    limit = max(LEAST_HOT, source.count() // 1000)
    n, salt = fresh([*left.columns, *right.columns], "n_of_key", "salt")
    hot = source.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(n)).where(F.col(n) > limit)
    hot = F.broadcast(hot.select(key, F.ceil(F.col(n) / limit).cast("int").alias(n)))
    draw = F.rand(7) if by is None else F.pmod(F.xxhash64(by), F.lit(1 << 20)) / (1 << 20)
    parts = F.when(F.col(key).isNull(), 1000).otherwise(F.coalesce(F.col(n), F.lit(1)))
    dealt = left.join(hot, key, "left").withColumn(salt, F.floor(draw * parts).cast("int")).drop(n)
    copies = right.join(hot, key, "left").withColumn(salt, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(n), F.lit(1)) - 1))).drop(n)
    return dealt.join(copies, [key, salt], how).drop(salt)


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def fresh(columns: list[str], *names: str) -> list[str]:
    """Names for helper columns that clash with none of ``columns``."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out
