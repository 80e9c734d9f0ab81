"""The mining run: stages composed over tables, and the loop around them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import rules as R
from millrace.functions import scoring as S
from millrace.functions import text as T
from millrace.functions.profiles import LATIN, Profile
from millrace.operators import accept as A
from millrace.operators import dedup as D
from millrace.operators import lines as L
from millrace.operators import select as Q
from millrace.sources.recognisers import page_bands


def extract(docs: DataFrame, profile: Profile = LATIN, source: str = "source") -> DataFrame:
    """Scored candidates of all lines, first of equal texts."""
    lines = L.text_lines(docs, keep=[source]).withColumnRenamed(source, "source_id")
    units = lines.select("seq", "source_id", "doc_id", F.col("line").alias("text"), F.lit(0).alias("unit_no"))
    found = L.candidates(units, ["seq"], profile)
    return D.first_by(found, [T.strip(F.col("text"))], ["seq"])


def validate(df: DataFrame, profile: Profile = LATIN, text: str = "text", **limits: int) -> DataFrame:
    """``df`` with its issues; rows without any are valid."""
    return df.withColumn("issues", R.text_issues(F.col(text), profile, **limits)).withColumn("valid", F.size("issues") == 0)


def select(df: DataFrame, hard: int, normal: int, per_source: int) -> DataFrame:
    return Q.select_lanes(D.cut(df), hard, normal, per_source)


def package(df: DataFrame, profile: Profile, hard: int, normal: int, per_source: int, near: float = 0.88) -> tuple[DataFrame, DataFrame]:
    """(selected rows, gate report) of accepted rows.

    Near copies go first; the best of each lane follow; rows with digits that
    the profile bans go last and are not replaced.
    """
    gated = D.cut(A.export_gate(df))
    unique = D.drop_similar_texts(gated, "seq", "expected_text", near)
    top = Q.top_of_lanes(unique, hard, normal)
    if not profile.allow_ascii_digits:
        top = top.where(~T.has_ascii_digits(F.col("expected_text")))
    return top, A.gate_report(top, hard, normal, per_source, profile)


@dataclass
class MiningLoop:
    """Rounds of mining until the targets are met.

    ``mine(round, docs)`` handles at most ``docs`` documents and returns the
    verified rows by lane and the number of documents seen.  The budget grows
    every round; two rounds without progress, the document cap or the round cap
    end the loop.
    """

    hard: int = 80
    normal: int = 20
    rounds: int = 8
    docs: int = 12
    growth: int = 12
    most_docs: int = 200

    def run(self, mine: Callable[[int, int], tuple[int, int, int]]) -> tuple[bool, list[tuple[int, int, int, int]]]:
        history, stuck, best, budget = [], 0, (-1, -1), self.docs
        for number in range(1, self.rounds + 1):
            hard, normal, seen = mine(number, min(budget, self.most_docs))
            history.append((number, hard, normal, seen))
            if hard >= self.hard and normal >= self.normal:
                return True, history
            stuck = 0 if hard > best[0] or normal > best[1] else stuck + 1
            best = (max(best[0], hard), max(best[1], normal))
            if stuck >= 2 or seen >= self.most_docs:
                break
            budget += self.growth
        return False, history


def mine_until(docs: DataFrame, loop: MiningLoop | None = None, profile: Profile = LATIN, per_source: int = 8, order: str = "doc_id") -> tuple[bool, list[tuple[int, int, int, int]], DataFrame]:
    """Run the stages over more and more documents until the loop ends: whether
    the targets are met, the rounds (number, hard, normal, documents), and the
    last selection."""
    loop, last = loop or MiningLoop(), []

    def mine(number: int, budget: int) -> tuple[int, int, int]:
        chosen = D.cut(docs.orderBy(order).limit(budget))
        picked = D.cut(mine_documents(chosen, profile, loop.hard, loop.normal, per_source))
        last[:] = [picked]
        n = {r["difficulty"]: r["count"] for r in picked.groupBy("difficulty").count().collect()}
        return n.get("hard", 0), n.get("normal", 0), chosen.count()

    met, history = loop.run(mine)
    return met, history, last[0]


def page_candidates(words: DataFrame, rasters: DataFrame, keys: list[str], profile: Profile = LATIN, rules: S.LaneRules | None = None) -> DataFrame:
    """Candidates of pages (``keys``): scored lines of their words, best of each
    line, and for pages that give none the bands of their raster.  Words are
    boxes in points; rasters have pixels row by row and their width."""
    lines = L.page_lines(L.scaled_words(words), keys, profile.allow_ascii_digits)
    units = lines.withColumn("unit_no", F.lit(0))
    found = D.cut(L.candidates(units, [*keys, "block", "line"], profile, rules).select(*keys, "text", "bbox_180", "difficulty", "complexity_score", "crop_type"))
    bands = page_bands(L.pages_without(rasters, found, keys), keys).join(rasters.select(*keys, "width"), keys)
    box = F.array(F.lit(0.0), F.col("top").cast("double"), F.col("width").cast("double"), F.col("bottom").cast("double"))
    seen = bands.select(*keys, F.lit("").alias("text"), box.alias("bbox_180"), F.lit("hard").alias("difficulty"), F.col("visual_score").alias("complexity_score"), F.lit("visual_band").alias("crop_type"))
    return found.unionByName(seen)


def mine_documents(docs: DataFrame, profile: Profile = LATIN, hard: int = 80, normal: int = 20, per_source: int = 8) -> DataFrame:
    """The run without a model: extract, validate, select."""
    found = validate(extract(docs, profile), profile).where("valid")
    return select(found, hard, normal, per_source)


def classified_lines(docs: DataFrame, profile: Profile = LATIN, rules: S.LaneRules | None = None, source: str = "source") -> DataFrame:
    """Every line with its features and lane."""
    lines = L.text_lines(docs, keep=[source]).withColumnRenamed(source, "source_id")
    clean = lines.withColumn("text", T.normalise_line(F.col("line"), profile.allow_ascii_digits)).where("text IS NOT NULL AND text != ''").drop("line")
    return S.classify(clean, "text", profile, rules)
