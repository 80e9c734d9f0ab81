"""Recognisers and rasters: the places where other libraries plug in.

Nothing here needs an image or recognition library; those that want one
register a backend.  Rows go to a backend by Arrow batches, one instance per
task.
"""

from __future__ import annotations

import importlib
import io
import time
from collections.abc import Callable, Iterator
from typing import Any, Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.rules import laplacian_variance
from millrace.operators.cache import with_cache


class Backend(Protocol):
    """A recogniser: find regions, read them, or do both."""

    name: str
    version: str

    def detect(self, image: bytes) -> list[tuple[int, int, int, int]]: ...

    def recognize(self, image: bytes) -> str: ...


def process(backend: Backend, image: bytes) -> list[dict[str, Any]]:
    """Regions with their text; an image without regions is one region."""
    regions = backend.detect(image) or [None]
    return [{"box": box, "text": backend.recognize(image)} for box in regions]


_MAKERS: dict[str, Callable[..., Backend]] = {}
_ALIASES = {"tess": "tesseract", "paddle": "paddleocr"}


def register(name: str, maker: Callable[..., Backend]) -> None:
    _MAKERS[name.lower()] = maker


def create(name: str, **options: Any) -> Backend:
    """Backend by name or alias; an unknown name is an error."""
    key = _ALIASES.get(name.strip().lower(), name.strip().lower())
    if key not in _MAKERS:
        raise ValueError(f"unknown backend {name!r}; there are {sorted(_MAKERS)}")
    return _MAKERS[key](**options)


def clean_name(name: str) -> str:
    """Backend name fit for a file name."""
    return "".join(c if c.isalnum() or c in "-_" else "_" for c in name)


def longest_reading(readings: list[str]) -> str:
    """Of several page modes the longest text, the first among equals."""
    return max((r.strip() for r in readings), key=len, default="")


class EchoBackend:
    """Reads text out of bytes; for tests and dry runs."""

    name, version = "echo", "1"

    def detect(self, image: bytes) -> list[tuple[int, int, int, int]]:
        return []

    def recognize(self, image: bytes) -> str:
        return image.decode("utf-8", "replace")


register("echo", EchoBackend)


def library(name: str, backend: str):
    """A library that a backend needs; without it the error says so."""
    try:
        return importlib.import_module(name)
    except ImportError as error:
        raise RuntimeError(f"backend {backend!r} needs the library {name!r}, which is not installed") from error


class TesseractBackend:
    """Several page modes; the longest reading counts."""

    name, modes = "tesseract", (7, 6, 13)

    def __init__(self, lang: str = "mar", **_: Any):
        self.engine, self.images, self.lang = library("pytesseract", self.name), library("PIL.Image", self.name), lang
        self.version = str(self.engine.get_tesseract_version())

    def detect(self, image: bytes) -> list[tuple[int, int, int, int]]:
        return []

    def recognize(self, image: bytes) -> str:
        with self.images.open(io.BytesIO(image)) as page:
            return longest_reading([self.engine.image_to_string(page, lang=self.lang, config=f"--psm {m}") for m in self.modes])


class PaddleBackend:
    name, version = "paddleocr", "1"

    def __init__(self, lang: str = "mr", **_: Any):
        self.engine, self.images = library("paddleocr", self.name).PaddleOCR(lang=lang), library("PIL.Image", self.name)

    def detect(self, image: bytes) -> list[tuple[int, int, int, int]]:
        return []

    def recognize(self, image: bytes) -> str:
        with self.images.open(io.BytesIO(image)) as page:
            lines = self.engine.ocr(np.asarray(page.convert("RGB"))) or []
        return " ".join(part[1][0] for block in lines for part in block or [])


class SuryaBackend:
    name, version = "surya", "1"

    def __init__(self, **_: Any):
        self.images = library("PIL.Image", self.name)
        self.engine = library("surya.recognition", self.name).RecognitionPredictor()
        self.finder = library("surya.detection", self.name).DetectionPredictor()

    def detect(self, image: bytes) -> list[tuple[int, int, int, int]]:
        with self.images.open(io.BytesIO(image)) as page:
            return [tuple(int(x) for x in box.bbox) for box in self.finder([page])[0].bboxes]

    def recognize(self, image: bytes) -> str:
        with self.images.open(io.BytesIO(image)) as page:
            return " ".join(line.text for line in self.engine([page], det_predictor=self.finder)[0].text_lines)


for _maker in (TesseractBackend, PaddleBackend, SuryaBackend):
    register(_maker.name, _maker)


class Raster(Protocol):
    """Turns a document into page images."""

    def pages(self, content: bytes, dpi: int) -> Iterator[tuple[int, int, int, bytes]]: ...


def render_pages(docs: DataFrame, make: Callable[[], Raster], dpi: int = 180, key: str = "source_id") -> DataFrame:
    """(key, page, width, height, image, error) of the pages of documents (key,
    content).  A document that cannot be rendered is one row with its error, a
    raster that cannot be made one such row for each document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            raster, failure = make(), None
        except Exception as error:
            raster, failure = None, str(error)
        names = [key, "page", "width", "height", "image", "error"]
        for batch in batches:
            for k, content in zip(batch[key], batch["content"], strict=True):
                rows, problem = [], failure
                try:
                    if raster is not None:
                        rows = [(k, n, w, h, image, None) for n, w, h, image in raster.pages(bytes(content), dpi)]
                except Exception as error:
                    rows, problem = [], str(error)
                yield pd.DataFrame(rows or [(k, None, None, None, None, problem)], columns=names)

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, "content").mapInPandas(run, f"{key} {kind}, page int, width int, height int, image binary, error string")


def recognise(df: DataFrame, backend: str, make: Callable[[], Backend], key: str = "id", image: str = "image") -> DataFrame:
    """(key, ocr_prediction, ocr_backend, ocr_model_version, latency_ms, error).

    A backend that cannot be made gives its error in every row, not a failure.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            reader, failure = make(), None
        except Exception as error:
            reader, failure = None, str(error)
        for batch in batches:
            texts, times = [], []
            for raw in batch[image]:
                began = time.perf_counter()
                texts.append(None if reader is None or raw is None else reader.recognize(bytes(raw)))
                times.append((time.perf_counter() - began) * 1000)
            yield pd.DataFrame({key: batch[key], "ocr_prediction": texts, "ocr_backend": backend, "ocr_model_version": None if reader is None else reader.version, "latency_ms": times, "error": failure})

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, image).mapInPandas(run, f"{key} {kind}, ocr_prediction string, ocr_backend string, ocr_model_version string, latency_ms double, error string")


def recognise_misses(df: DataFrame, cache: DataFrame, backend: str, version: str, make: Callable[[], Backend], key: str = "id") -> DataFrame:
    """Readings from the cache where it has them, else from the backend.  The
    version is settled before the lookup, so stores and lookups agree."""
    keyed = df.withColumns({"backend": F.lit(backend), "model_version": F.lit(version)})
    looked = with_cache(keyed, cache, ["sha256", "backend", "model_version"])
    hits = looked.where("from_cache").select(key, F.col("payload").alias("ocr_prediction"), F.lit(True).alias("from_cache"))
    new = recognise(looked.where("NOT from_cache"), backend, make, key).select(key, "ocr_prediction", F.lit(False).alias("from_cache"))
    return hits.unionByName(new)


def ink_bands(gray: np.ndarray, low: int = 28, high: int = 160, split: int = 70, tallest: int = 90, most: int = 8) -> list[dict[str, float]]:
    """Text-like bands of a grey page: rows with enough ink, by runs; tall runs
    are cut.  Best first by visual score and shape."""
    height, width = gray.shape
    ink = (gray[:, ::3] < 200).sum(axis=1)
    dark = ink >= max(8, int(0.02 * width / 3))
    edges = np.flatnonzero(np.diff(np.r_[0, dark.astype(np.int8), 0]))
    bands: list[tuple[int, int]] = []
    for top, bottom in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        if bottom - top > high:
            bands += [(y, min(y + tallest, bottom)) for y in range(top, bottom, split)]
        else:
            bands.append((top, bottom))
    out = []
    for top, bottom in bands:
        tall = bottom - top
        if not low <= tall <= high:
            continue
        aspect = width / tall
        score = round((1.5 if aspect >= 4 else 0.0) + (0.8 if width >= 1200 else 0.0) + (1.0 if 40 <= tall <= 180 else 0.0) + 1.2, 4)
        out.append({"top": top, "bottom": bottom, "visual_score": score, "rank_score": score + min(aspect / 10, 1.5)})
    return sorted(out, key=lambda b: -b["rank_score"])[:most]


def page_bands(pages: DataFrame, keys: list[str], pixels: str = "pixels", width: str = "width") -> DataFrame:
    """(keys, band_no, top, bottom, visual_score) of the text-like bands of grey
    pages given row by row, best first; a page without pixels has none."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for page in batch.itertuples(index=False):
                *key, raw, w = page
                if raw is None or not w:
                    continue
                for n, band in enumerate(ink_bands(np.frombuffer(bytes(raw), np.uint8).reshape(-1, int(w)))):
                    rows.append((*key, n, band["top"], band["bottom"], band["visual_score"]))
            yield pd.DataFrame(rows, columns=[*keys, "band_no", "top", "bottom", "visual_score"])

    kinds = ", ".join(f"`{k}` {pages.schema[k].dataType.simpleString()}" for k in keys)
    return pages.select(*keys, pixels, width).mapInPandas(run, f"{kinds}, band_no int, top int, bottom int, visual_score double")


def image_measures(df: DataFrame, key: str = "id", pixels: str = "pixels", width: str = "width") -> DataFrame:
    """(key, height, blur, contrast) of grey pixels given row by row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, raw, w in zip(batch[key], batch[pixels], batch[width], strict=True):
                grid = np.frombuffer(bytes(raw), np.uint8).reshape(-1, int(w))
                rows.append((k, grid.shape[0], laplacian_variance(grid), float(grid.std())))
            yield pd.DataFrame(rows, columns=[key, "height", "blur", "contrast"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, pixels, width).mapInPandas(run, f"{key} {kind}, height int, blur double, contrast double")


def dct_hash(gray: np.ndarray, size: int = 16) -> bytes:
    """Perceptual hash: signs of the low cosine frequencies about their median,
    ``size * size`` bits."""
    side = size * 4
    y = (np.arange(side) * gray.shape[0] // side).clip(0, gray.shape[0] - 1)
    x = (np.arange(side) * gray.shape[1] // side).clip(0, gray.shape[1] - 1)
    small = gray[np.ix_(y, x)].astype(np.float64)
    k = np.arange(side)
    basis = np.cos(np.pi * np.outer(k[:size], 2 * k + 1) / (2 * side))
    low = basis @ small @ basis.T
    return np.packbits(low > np.median(low)).tobytes()
