"""Duplicates: exact, by Hamming distance, by box overlap, by text.

Joins of similar rows never compare all pairs: each has an equality key that
no qualifying pair can miss, and the exact predicate comes after it.
"""

from __future__ import annotations

import itertools
import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from millrace.functions import text as T
from millrace.functions.python_side import similar_in_lots


def first_by(df: DataFrame, keys: list[str | Column], order: list[str | Column]) -> DataFrame:
    """The first row of each key in an order; null keys are one key."""
    ranked = df.withColumn("_first", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_first = 1").drop("_first")


def exact_groups(df: DataFrame, digest: str, item: str) -> DataFrame:
    """(digest, n, first item) of digests that occur more than once."""
    return df.groupBy(digest).agg(F.count(F.lit(1)).alias("n"), F.min(item).alias("first_item")).where("n > 1")


def hamming(a: Column, b: Column, words: int) -> Column:
    """Differing bits of two arrays of ``words`` 64-bit words."""
    out = F.bit_count(a[0].bitwiseXOR(b[0]))
    for i in range(1, words):
        out = out + F.bit_count(a[i].bitwiseXOR(b[i]))
    return out


def sign_bits(vector: Column, bits: int = 64) -> Column:
    """Bits of a vector's signs in 64-bit words, lowest first."""
    words = []
    for start in range(0, bits, 64):
        word = F.lit(0).cast("bigint")
        for i in range(start, min(start + 64, bits)):
            word = word.bitwiseOR(F.when(vector[i] > 0, F.lit(1 << (i - start) if i - start < 63 else -(1 << 63))).otherwise(F.lit(0)).cast("bigint"))
        words.append(word)
    return F.array(*words)


def hamming_pairs(df: DataFrame, item: str, bits: str, most: int = 8, words: int = 1) -> DataFrame:
    """Pairs (later, earlier, dist) of rows at most ``most`` bits apart, the
    order being that of ``item``.

    The bits fall into ``most + 1`` blocks, and rows so close agree on one of
    them: that block and its value are the join key.
    """
    total, parts = 64 * words, most + 1
    edges = [round(i * total / parts) for i in range(parts + 1)]
    blocks = []
    for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
        pieces = []
        for w in range(a // 64, -(-b // 64)):
            low, high = max(a, 64 * w) - 64 * w, min(b, 64 * w + 64) - 64 * w
            piece = F.shiftrightunsigned(F.col(bits)[w], low)
            pieces.append(piece if high - low == 64 else piece.bitwiseAND(F.lit((1 << (high - low)) - 1)))
        blocks.append(F.struct(F.lit(k).alias("k"), F.concat_ws("-", *[p.cast("string") for p in pieces]).alias("v")))
    keyed = df.select(item, bits, F.explode(F.array(*blocks)).alias("_block"))
    a = keyed.select(F.col(item).alias("later"), F.col(bits).alias("_a"), "_block")
    b = keyed.select(F.col(item).alias("earlier"), F.col(bits).alias("_b"), "_block")
    near = a.join(b, "_block").where(F.col("later") > F.col("earlier")).withColumn("dist", hamming(F.col("_a"), F.col("_b"), words))
    return near.where(F.col("dist") <= most).select("later", "earlier", "dist").distinct()


def drop_duplicate_images(df: DataFrame, item: str, digest: str, pairs: DataFrame, mode: str = "reference") -> DataFrame:
    """Rows that survive the image rules.

    ``reference``: of an exact group all but the first go, and of a near pair
    the earlier goes, whatever becomes of the later; so an exact pair, being a
    near pair too, loses both.  ``first``: near pairs with equal digests do not
    count, so one of an exact group stays.
    """
    if mode == "first":
        own = df.select(item, digest)
        pairs = pairs.join(own.select(F.col(item).alias("later"), F.col(digest).alias("_l")), "later").join(own.select(F.col(item).alias("earlier"), F.col(digest).alias("_e")), "earlier").where("_l != _e").select("later", "earlier", "dist")
    firsts = first_by(df, [digest], [item])
    return firsts.join(pairs.select(F.col("earlier").alias(item)).distinct(), item, "left_anti")


def box_iou(a: Column, b: Column) -> Column:
    """Intersection over union of boxes [x0, y0, x1, y1]; 0 if degenerate."""
    zero = F.lit(0.0)
    side = lambda i: F.greatest(zero, F.least(a[i + 2], b[i + 2]) - F.greatest(a[i], b[i]))
    area = lambda x: F.greatest(zero, x[2] - x[0]) * F.greatest(zero, x[3] - x[1])
    inter = side(0) * side(1)
    union = area(a) + area(b) - inter
    return F.when((inter > 0) & (union > 0), inter / F.when(union > 0, union).otherwise(1.0)).otherwise(0.0)


def box_pairs(df: DataFrame, keys: list[str], seq: str, box: str, least: float = 0.85) -> DataFrame:
    """Pairs (later, earlier, iou) of one key that overlap enough."""
    a = df.select(*keys, F.col(seq).alias("later"), F.col(box).alias("_a"))
    b = df.select(*keys, F.col(seq).alias("earlier"), F.col(box).alias("_b"))
    both = a.join(b, keys).where(F.col("later") > F.col("earlier")).withColumn("iou", box_iou(F.col("_a"), F.col("_b")))
    return both.where(F.col("iou") >= least).select(*keys, "later", "earlier", "iou")


def drop_same_boxes(df: DataFrame, keys: list[str], seq: str, box: str, least: float = 0.85) -> DataFrame:
    """Greedy in order of ``seq``: a row goes if it overlaps an earlier one
    that stayed."""
    pairs = box_pairs(df, keys, seq, box, least)
    kept = maximal_independent(df.select(F.col(seq).alias("node")), pairs.select(F.col("later").alias("low"), F.col("earlier").alias("high")))
    return df.join(kept.select(F.col("node").alias(seq)), seq, "left_semi")


def maximal_independent(nodes: DataFrame, edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """Nodes that a greedy walk keeps: a node goes if a kept one ranks above
    it.  ``edges`` has (low, high), the first ranked below the second.

    Each round keeps the nodes that nothing open ranks above and drops what
    ranks below those; the outcome is that of the one-by-one walk.  Rounds are
    cut by checkpoints, so a lost executor repeats one round.  They go on until
    no node is open; a limit of ``rounds`` that is reached is an error.
    """
    kept, open_edges = None, cut(edges.distinct())
    open_nodes = cut(nodes)
    for done in itertools.count():
        if done == rounds:
            raise RuntimeError(f"not settled after {rounds} rounds")
        # what has no open neighbour above it stays
        stays = cut(open_nodes.join(open_edges.select(F.col("low").alias("node")).distinct(), "node", "left_anti"))
        kept = stays if kept is None else kept.unionByName(stays)
        goes = cut(open_edges.join(stays.select(F.col("node").alias("high")), "high", "left_semi").select(F.col("low").alias("node")).distinct())
        settled = stays.unionByName(goes)
        open_nodes = cut(open_nodes.join(settled, "node", "left_anti"))
        if open_nodes.isEmpty():
            break
        gone = settled.select(F.col("node").alias("low"))
        open_edges = cut(open_edges.join(gone, "low", "left_anti").join(goes.select(F.col("node").alias("high")), "high", "left_anti"))
    return kept


def cut(df: DataFrame) -> DataFrame:
    """Write and read again: the plan starts afresh from files that all
    executors share."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="millrace-")
        spark.sparkContext.setCheckpointDir(folder)
    path = f"{folder.rstrip('/')}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def similar_texts(df: DataFrame, seq: str, text: str, least: float = 0.92, keys: list[str] | None = None) -> DataFrame:
    """Pairs (later, earlier, similarity) with ``least`` or more; similarity
    takes the later text first.  ``keys`` restricts pairs to equal columns.

    Rows are grouped by normalised text first, so copies are compared once.
    """
    keys = keys or []
    rows = cut(df.select(*keys, F.col(seq).alias("_seq"), T.for_dedup(F.col(text)).alias("_t")))
    texts = cut(rows.select(*keys, "_t").distinct())
    found = similar_distinct(texts, "_t", least, keys)
    same = texts.select(*keys, F.col("_t").alias("_a"), F.col("_t").alias("_b"), F.lit(1.0).alias("similarity"))
    kinds = cut(found.unionByName(same))
    later = rows.select(*keys, F.col("_seq").alias("later"), F.col("_t").alias("_a"))
    earlier = rows.select(*keys, F.col("_seq").alias("earlier"), F.col("_t").alias("_b"))
    return later.join(kinds, [*keys, "_a"]).join(earlier, [*keys, "_b"]).where("later > earlier").select("later", "earlier", "similarity")


LOT_ROWS, LOT_CHARS = 1024, 2 << 20


def similar_distinct(texts: DataFrame, text: str, least: float, keys: list[str]) -> DataFrame:
    """(keys, _a, _b, similarity) of different texts, both ways round;
    ``texts`` has no row twice.

    Texts so similar are in one or in neighbouring length classes.  A class is
    dealt into lots, and each task compares a pair of lots: lengths and counts
    of letters and of runs of two and three letters bound the similarity from
    above, and only pairs that pass are compared in full.  So no task is larger
    than two lots, whatever the size of a class.
    """
    step = F.ln(F.lit((2 - least) / least * (1 + 1e-9)))
    classed = texts.where(reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys], F.lit(True)))  # null keys are equal to none
    classed = classed.withColumn("_level", F.floor(F.ln(F.greatest(F.length(text), F.lit(1)).cast("double")) / step))
    # so many lots has each class, and those beside it
    size = F.greatest(F.count(F.lit(1)) / LOT_ROWS, F.sum(F.length(text)) / LOT_CHARS, F.lit(1))
    lots = cut(classed.groupBy(*keys, "_level").agg(F.ceil(size).cast("int").alias("_lots")))
    beside = lambda shift, name: lots.select(*keys, (F.col("_level") + shift).alias("_level"), F.col("_lots").alias(name))
    counts = cut(lots.join(beside(-1, "_above"), [*keys, "_level"], "left").join(beside(1, "_below"), [*keys, "_level"], "left"))
    dealt = classed.join(counts, [*keys, "_level"]).withColumn("_lot", F.pmod(F.xxhash64(text), F.col("_lots")).cast("int"))
    numbers = lambda n: F.when(F.col(n) > 0, F.sequence(F.lit(0), F.col(n) - 1)).otherwise(F.array().cast("array<int>"))
    level, lot = F.col("_level"), F.col("_lot")

    def task(level: Column, across: bool, low: Column, high: Column, side: int) -> Column:
        parts = {"_level": level, "_across": F.lit(across), "_low": low, "_high": high, "_side": F.lit(side)}
        return F.struct(*[c.alias(name) for name, c in parts.items()])

    # within a class a pair of lots is (smaller, larger); across, (of this, of the next)
    own = F.transform(numbers("_lots"), lambda j: F.when(j >= lot, task(level, False, lot, j, 0)).otherwise(task(level, False, j, lot, 1)))
    up = F.transform(numbers("_above"), lambda j: task(level, True, lot, j, 0))
    down = F.transform(numbers("_below"), lambda j: task(level - 1, True, j, lot, 1))
    pair = ["_level", "_across", "_low", "_high"]
    sent = dealt.select(*keys, F.col(text).alias("_a"), F.explode(F.concat(own, up, down)).alias("_task")).select(*keys, "_a", *[f"_task.{c}" for c in [*pair, "_side"]])
    # a lot is little to send and much to compare, so tasks are not to be united for their size
    tasks = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * texts.sparkSession.sparkContext.defaultParallelism)
    sent = sent.repartition(tasks, *keys, *pair)
    kinds = {f.name: f.dataType for f in texts.schema.fields}
    schema = StructType([*[StructField(k, kinds[k]) for k in keys], StructField("_a", StringType()), StructField("_b", StringType()), StructField("similarity", DoubleType())])
    return sent.groupBy(*keys, *pair).applyInArrow(similar_in_lots(least, len(keys)), schema)


def drop_similar_texts(df: DataFrame, seq: str, text: str, least: float = 0.92, prefer: str = "complexity_score", keys: list[str] | None = None) -> DataFrame:
    """Greedy by ``prefer`` and length, both falling, then ``seq``: a row goes
    if it is similar to one that stayed.  The rest come in their own order."""
    keys = keys or []
    order = [F.desc(F.coalesce(F.col(prefer).cast("double"), F.lit(0.0))), F.desc(F.length(F.coalesce(F.col(text), F.lit("")))), F.col(seq)]
    # numbers that ascend in this order, over all tasks of the sort
    ranked = cut(df.orderBy(*order).withColumn("_rank", F.monotonically_increasing_id()))
    # a copy goes with whatever becomes of the first of its copies, so only that walks
    plain = ranked.select(*keys, "_rank", T.for_dedup(F.col(text)).alias("_t"))
    alone = reduce(lambda x, y: x | y, [F.col(k).isNull() for k in keys], F.lit(False))  # null keys are equal to none
    firsts = cut(plain.where(~alone).groupBy(*keys, "_t").agg(F.min("_rank").alias("_rank")))
    pairs = cut(similar_distinct(firsts.select(*keys, "_t"), "_t", least, keys))
    ranks = lambda t, rank: firsts.select(*keys, F.col("_t").alias(t), F.col("_rank").alias(rank))
    edges = pairs.join(ranks("_a", "low"), [*keys, "_a"]).join(ranks("_b", "high"), [*keys, "_b"]).where("low > high").select("low", "high")
    kept = maximal_independent(firsts.select(F.col("_rank").alias("node")), edges).unionByName(plain.where(alone).select(F.col("_rank").alias("node")))
    return ranked.join(kept.select(F.col("node").alias("_rank")), "_rank", "left_semi").drop("_rank")


def similar_text_flags(df: DataFrame, seq: str, text: str, least: float = 0.92) -> DataFrame:
    """Report rows (id_a, id_b, similarity to 4 places), earlier id first."""
    pairs = similar_texts(df, seq, text, least)
    return pairs.select(F.col("earlier").alias("id_a"), F.col("later").alias("id_b"), T.py_round(F.col("similarity"), 4).alias("similarity"))


def prefix_twins(df: DataFrame, seq: str, text: str, least: float = 0.88, shortest: int = 16, prefix: int = 24) -> DataFrame:
    """Pairs (later, earlier, score) of texts of which one nearly begins the
    other, of ``shortest`` characters or more.

    Either the shorter begins the longer, or both have ``prefix`` characters
    and most of the shorter in common; so they share the first ``shortest``, and
    their lengths are in one or in neighbouring classes: that is the join key."""
    rows = df.select(F.col(seq).alias("_seq"), T.for_dedup(F.col(text)).alias("_t")).where(F.length("_t") >= shortest)
    level = F.floor(F.ln(F.length("_t").cast("double")) / F.ln(F.lit(1 / least)))
    rows = rows.withColumns({"_key": F.substr("_t", F.lit(1), F.lit(shortest)), "_level": level}).withColumn("_bucket", F.explode(F.array("_level", F.col("_level") + 1)))
    side = lambda seq_, t, level_: rows.select(F.col("_seq").alias(seq_), F.col("_t").alias(t), F.col("_level").alias(level_), "_key", "_bucket")
    both = side("later", "_a", "_la").join(side("earlier", "_b", "_lb"), ["_key", "_bucket"]).where("later > earlier AND _bucket = greatest(_la, _lb)")
    short = F.when(F.length("_a") <= F.length("_b"), F.col("_a")).otherwise(F.col("_b"))
    long_ = F.when(F.length("_a") <= F.length("_b"), F.col("_b")).otherwise(F.col("_a"))
    n = common_prefix_length(F.col("_s"), F.col("_l"))
    both = both.withColumn("_s", short).withColumn("_l", long_).where(F.length("_s") >= F.length("_l") * F.lit(least))
    both = both.withColumn("_n", T.bound(n)).where((F.col("_n") == F.length("_s")) | (F.col("_n") >= prefix) & (F.col("_n") >= F.length("_s") * 0.88))
    return both.withColumn("score", F.col("_n") / F.length("_l")).where(F.col("score") >= least).select("later", "earlier", "score")


def common_prefix_length(a: Column, b: Column) -> Column:
    """Length of the common prefix, by halving the length in question."""
    step = lambda acc, k: F.when(F.substr(a, F.lit(1), acc + k) == F.substr(b, F.lit(1), acc + k), F.least(acc + k, F.length(a), F.length(b))).otherwise(acc)
    powers = F.array(*[F.lit(1 << i) for i in range(30, -1, -1)])
    return F.aggregate(powers, F.lit(0), lambda acc, k: step(acc, k))
