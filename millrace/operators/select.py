"""Quotas, lanes, caps and splits."""

from __future__ import annotations

import random
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def base_lane_counts(profile: dict[str, Any], config: dict[str, Any] | None = None) -> tuple[int, int]:
    """(hard, normal) of the profile; what is missing or 0 comes from the
    configuration, else 80 and 20."""
    config = config or {}
    hard = profile.get("hard_count") or config.get("validation_hard_count", 80)
    normal = profile.get("normal_count") or config.get("validation_normal_count", 20)
    return max(0, int(hard)), max(0, int(normal))


def lane_targets(spark: SparkSession, target: int | None = None, hard: int | None = None, normal: int | None = None, profile: dict[str, Any] | None = None, config: dict[str, Any] | None = None) -> tuple[int, int]:
    """Lane sizes from a total, from explicit counts or from the base ratio:
    ``scaled_quotas`` of one request."""
    request = (target, hard, normal, *base_lane_counts(profile or {}, config))
    row = spark.createDataFrame([request], "target int, hard int, normal int, base_hard int, base_normal int")
    got = scaled_quotas(row).first()
    return got["hard_target"], got["normal_target"]


def scaled_quotas(df: DataFrame, target: str = "target", hard: str = "hard", normal: str = "normal", base_hard: str = "base_hard", base_normal: str = "base_normal") -> DataFrame:
    """A table of requests with the columns hard_target and normal_target."""
    t, h, n, bh, bn = (F.col(c) for c in (target, hard, normal, base_hard, base_normal))
    zero = F.lit(0)
    whole = F.greatest(t, zero)
    ratio = F.bround(whole * (bh / F.greatest(bh + bn, F.lit(1)))).cast("int")
    both = (bh > 0) & (bn > 0) & (whole >= 2)
    share = F.when(both, F.greatest(F.lit(1), F.least(whole - 1, ratio))).otherwise(F.greatest(zero, F.least(whole, ratio)))
    explicit = h.isNotNull() & n.isNotNull()
    hard_out = F.when(explicit, F.greatest(h, zero)).when(t.isNotNull() & h.isNotNull(), F.least(F.greatest(h, zero), whole)).when(t.isNotNull() & n.isNotNull(), whole - F.least(F.greatest(n, zero), whole)).when(t.isNotNull(), share).when(h.isNotNull(), F.greatest(h, zero)).otherwise(F.greatest(bh, zero))
    normal_out = F.when(explicit, F.greatest(n, zero)).when(t.isNotNull(), whole - F.col("hard_target")).when(n.isNotNull(), F.greatest(n, zero)).otherwise(F.greatest(bn, zero))
    return df.withColumn("hard_target", hard_out).withColumn("normal_target", normal_out)


def headroom(hard: int, normal: int, least: int = 200) -> int:
    """How many candidates to extract for a selection of this size."""
    return max(least, 4 * (hard + normal))


def pick_per_source(df: DataFrame, most: int, hard_target: int, normal_target: int, source: str = "source_id", seq: str = "seq") -> DataFrame:
    """At most ``most`` rows of each source: each lane first fills its share,
    hard by score and normal by words; what is left goes to hard, then normal."""
    total = max(hard_target + normal_target, 1)
    normal_share = max(1, round(most * (normal_target / total)))
    hard_share = max(1, most - normal_share)
    value = F.when(F.col("difficulty") == "hard", F.coalesce("complexity_score", F.lit(0.0))).otherwise(F.coalesce(F.col("word_count"), F.lit(0)).cast("double"))
    lanes = df.where(F.col("difficulty").isin("hard", "normal"))
    ranked = lanes.withColumn("_lane_rank", F.row_number().over(Window.partitionBy(source, "difficulty").orderBy(value.desc(), seq)))
    is_hard = F.col("difficulty") == "hard"
    share = F.when(is_hard, hard_share).otherwise(normal_share)
    first = F.col("_lane_rank") <= share
    order = F.when(first & is_hard, 0).when(first, 1).when(is_hard, 2).otherwise(3)
    placed = ranked.withColumn("pick_rank", F.row_number().over(Window.partitionBy(source).orderBy(order, "_lane_rank")))
    return placed.where(F.col("pick_rank") <= most).drop("_lane_rank")


def lane_slots(n_hard: int, n_normal: int, top_k: int, hard_target: int, normal_target: int) -> tuple[int, int]:
    """Slots of the two lanes among ``top_k``; free ones go to the other."""
    total = max(hard_target + normal_target, 1)
    normal = min(n_normal, max(2 * normal_target, round(top_k * (normal_target / total))))
    hard = min(n_hard, max(0, top_k - normal))
    if hard < top_k - normal:
        normal = min(n_normal, top_k - hard)
    if hard + normal < top_k:
        hard = min(n_hard, top_k - normal)
    return hard, normal


def dual_lane_top(df: DataFrame, top_k: int, hard_target: int, normal_target: int, seq: str = "seq") -> DataFrame:
    """The best of both lanes, hard first; ``position`` orders them."""
    n = {r["difficulty"]: r["count"] for r in df.where(F.col("difficulty").isin("hard", "normal")).groupBy("difficulty").count().collect()}
    hard, normal = lane_slots(n.get("hard", 0), n.get("normal", 0), top_k, hard_target, normal_target)
    a = df.where("difficulty = 'hard'").orderBy(F.desc(F.coalesce("complexity_score", F.lit(0.0))), seq).limit(hard)
    b = df.where("difficulty = 'normal'").orderBy(F.desc(F.coalesce("word_count", F.lit(0))), seq).limit(normal)
    order = Window.orderBy(F.when(F.col("difficulty") == "hard", 0).otherwise(1), F.when(F.col("difficulty") == "hard", -F.coalesce("complexity_score", F.lit(0.0))).otherwise(-F.coalesce(F.col("word_count"), F.lit(0)).cast("double")), seq)
    return a.unionByName(b).withColumn("position", F.row_number().over(order))


def select_lane(df: DataFrame, target: int, per_source: int, order: list[Column], used: DataFrame | None = None, source: str = "source_id") -> DataFrame:
    """The first ``target`` rows in an order, at most ``per_source`` of each
    source; ``used`` (source, taken) counts against the cap.  Rows that quality
    rules skip must be filtered before: they never use up a cap.

    ``selection_rank`` is the place in the selection.
    """
    sid = F.coalesce(F.col(source).cast("string"), F.lit("unknown"))
    ranked = df.withColumn("_sid", sid).withColumn("_n", F.row_number().over(Window.partitionBy("_sid").orderBy(*order)))
    if used is not None:
        ranked = ranked.join(used.select(F.col(source).cast("string").alias("_sid"), "taken"), "_sid", "left")
        ranked = ranked.where(F.col("_n") <= per_source - F.coalesce("taken", F.lit(0))).drop("taken")
    else:
        ranked = ranked.where(F.col("_n") <= per_source)
    first = ranked.orderBy(*order).limit(target)
    return first.withColumn("selection_rank", F.row_number().over(Window.orderBy(*order))).drop("_sid", "_n")


def select_lanes(df: DataFrame, hard_target: int, normal_target: int, per_source: int, min_hard: float = 3.0, source: str = "source_id", seq: str = "seq") -> DataFrame:
    """Hard then normal selection.  Hard rows are ordered by score, then
    numerals and identifiers; normal rows by words and score, then sources that
    the hard lane has not used; the source cap holds for both together."""
    score, words = F.coalesce("complexity_score", F.lit(0.0)), F.coalesce("word_count", F.lit(0))
    hard_order = [score.desc(), F.col("contains_native_numerals").desc(), F.col("features.identifier_likeness_score").desc(), F.col(seq)]
    hard = select_lane(df.where((F.col("difficulty") == "hard") & (score >= min_hard)), hard_target, per_source, hard_order, source=source)
    # rows without a source count as one source, in both lanes
    named = F.coalesce(F.col(source).cast("string"), F.lit("unknown"))
    taken = hard.groupBy(named.alias(source)).agg(F.count(F.lit(1)).alias("taken"))
    used = taken.select(F.col(source).alias("_sid"), F.lit(1).alias("_used"))
    normal = df.where((F.col("difficulty") == "normal") & F.col("is_ordinary")).withColumn("_sid", named).join(used, "_sid", "left").drop("_sid")
    normal_order = [words.desc(), score.desc(), F.coalesce("_used", F.lit(0)), F.col(seq)]
    picked = select_lane(normal, normal_target, per_source, normal_order, taken, source).drop("_used")
    return hard.unionByName(picked)


def selection_stats(selected: DataFrame, hard_target: int, normal_target: int, source: str = "source_id") -> DataFrame:
    """(lane, target, selected, shortfall, sources_used), both lanes always."""
    wanted = selected.sparkSession.createDataFrame([("hard", hard_target), ("normal", normal_target)], "difficulty string, target int")
    got = selected.groupBy("difficulty").agg(F.count(F.lit(1)).alias("selected"), F.countDistinct(source).alias("sources_used"))
    both = wanted.join(got, "difficulty", "left").na.fill(0, ["selected", "sources_used"])
    return both.withColumn("shortfall", F.greatest(F.col("target") - F.col("selected"), F.lit(0)))


def top_of_lanes(df: DataFrame, hard: int, normal: int, seq: str = "seq") -> DataFrame:
    """Export order: hard by score, then normal by words, within limits."""
    a = df.where("difficulty = 'hard'").orderBy(F.desc(F.coalesce("complexity_score", F.lit(0.0))), seq).limit(hard)
    b = df.where("difficulty = 'normal'").orderBy(F.desc(F.coalesce("word_count", F.lit(0))), seq).limit(normal)
    return a.unionByName(b)


def ranked_urls(df: DataFrame, keep: int, score: str | None = "score", seq: str = "seq") -> DataFrame:
    """The best ``keep`` links; without scores the first, at 0.5 each."""
    if score is None:
        df, score = df.withColumn("score", F.lit(0.5)), "score"
    return df.orderBy(F.desc(score), seq).limit(keep)


def source_split(df: DataFrame, ratio: float = 0.8, seed: int = 42, source: str = "source_id") -> DataFrame:
    """``df`` with ``split``: whole sources are train or val.

    The distinct sources are shuffled on the driver; they are few beside the
    rows, and the draw must be the same everywhere.  Rows without a source are
    in neither part and have a null split.
    """
    names = sorted(str(r[0]) for r in df.select(source).where(F.col(source).isNotNull() & (F.col(source).cast("string") != "")).distinct().collect())
    random.Random(seed).shuffle(names)
    cut = max(1, int(len(names) * ratio)) if len(names) > 1 else len(names)
    train, val = names[:cut], names[cut:]
    if not val and len(names) > 1:
        train, val = names[:-1], names[-1:]
    parts = df.sparkSession.createDataFrame([*((n, "train") for n in train), *((n, "val") for n in val)], "_name string, split string")
    return df.join(parts, F.col(source).cast("string") == F.col("_name"), "left").drop("_name")
