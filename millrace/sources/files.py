"""Files in and out: line JSON, documents, manifests, packages."""

from __future__ import annotations

import json
import os
from typing import Any

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.cache import upsert

EXTENSIONS = ("pdf", "png", "jpg", "jpeg", "tif", "tiff")
MANIFEST = "source_id string, source_path string, source_url string, document_type string, filename string, page_count int, ext string"


def read_jsonl(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """Rows of a line JSON file under a fixed schema; a missing path has none.
    Blank lines are skipped; a broken line raises when rows are read."""
    try:
        return spark.read.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def read_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A whole JSON document."""
    reader = spark.read.option("multiLine", True).option("mode", "FAILFAST")
    return (reader.schema(schema) if schema else reader).json(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """UTF-8 line JSON; ``append`` adds to what is there."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def read_excludes(spark: SparkSession, path: str | None) -> DataFrame:
    from millrace.operators.discover import exclude_entries

    empty = spark.createDataFrame([], "value string")
    if not path:
        return exclude_entries(empty)
    try:
        return exclude_entries(spark.read.text(path))
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return exclude_entries(empty)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Files with an accepted extension: path, content, length and digest."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    ext = F.lower(F.regexp_extract("path", r"\.([A-Za-z]+)$", 1))
    return found.withColumn("ext", ext).where(F.col("ext").isin(*EXTENSIONS)).withColumn("sha256", F.sha2("content", 256))


def manifest_rows(docs: DataFrame, document_type: str = "unknown") -> DataFrame:
    """Manifest rows of documents; the id is the stem and a digest of the path."""
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    bare = F.regexp_replace("path", "^file:/*", "/")
    return docs.select(F.concat(stem, F.lit("_"), F.substr(F.sha1(bare), F.lit(1), F.lit(8))).alias("source_id"), F.col("path").alias("source_path"), F.lit("").alias("source_url"), F.lit(document_type).alias("document_type"), name.alias("filename"), F.lit(None).cast("int").alias("page_count"), F.concat(F.lit("."), "ext").alias("ext"))


def update_manifest(manifest: DataFrame, rows: DataFrame) -> DataFrame:
    return upsert(manifest, rows, "source_id")


def manifest_count(spark: SparkSession, path: str) -> int:
    """Sources in a manifest; a missing or broken one has none."""
    try:
        return read_json(spark, path, f"sources array<struct<{MANIFEST.replace(' ', ':').replace(',:', ',')}>>").select(F.size("sources")).first()[0] or 0
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    except PySparkException as error:
        if "MALFORMED" not in str(error):
            raise
        return 0


def read_env(text: str, environment: dict[str, str] | None = None) -> dict[str, str]:
    """Variables of an environment file's text, beneath those that are set:
    ``KEY=value`` lines, quotes around a value and ``export`` before a key left
    out, comments and other lines skipped."""
    found = {}
    for line in text.splitlines():
        key, sign, value = line.strip().removeprefix("export ").partition("=")
        if sign and key.strip() and not key.startswith("#"):
            found[key.strip()] = value.strip().strip("\"'")
    return {**found, **(dict(os.environ) if environment is None else environment)}


def load_config(text: str | None, environment: dict[str, str] | None = None, overrides: dict[str, str] | None = None) -> dict[str, Any]:
    """Settings from JSON text or a YAML file's text; variables named in
    ``overrides`` (variable -> setting) win over both."""
    try:
        import yaml

        config = yaml.safe_load(text or "") or {}
    except ImportError:
        config = json.loads(text or "{}")
    environment = dict(os.environ) if environment is None else environment
    for variable, setting in (overrides or {}).items():
        if variable in environment:
            value = environment[variable]
            config[setting] = value.strip().lower() in ("1", "true", "yes") if isinstance(config.get(setting), bool) else value
    return config


def active_profile(config: dict[str, Any]) -> dict[str, Any]:
    """The profile that the configuration names, with its name."""
    profiles = config.get("profiles") or {}
    name = config.get("active_profile") or next(iter(profiles), "default")
    return {**(profiles.get(name) or {}), "_name": name}


def write_package(df: DataFrame, folder: str, report: dict[str, Any]) -> None:
    """Public rows and the report of an export."""
    write_jsonl(df, f"{folder}/validation")
    df.sparkSession.createDataFrame([(json.dumps(report, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/report")


def write_dataset(df: DataFrame, internal: DataFrame, folder: str, split: DataFrame | None = None) -> None:
    """Public rows, rows with their provenance and, with a split (image_filename,
    split), one folder of public rows for each part."""
    write_jsonl(df, f"{folder}/validation")
    write_jsonl(internal, f"{folder}/metadata")
    if split is not None:
        write_jsonl_by(df.join(split.select("image_filename", "split"), "image_filename"), f"{folder}/parts", "split")


def write_jsonl_by(df: DataFrame, path: str, column: str) -> None:
    df.write.mode("overwrite").partitionBy(column).option("ignoreNullFields", False).json(path)


def markdown_report(rows: list[dict[str, Any]], title: str, digits: int = 4) -> str:
    """Metric table as Markdown; what is missing reads n/a."""
    if not rows:
        return f"# {title}\n\nNo results.\n"
    names = list(rows[0])
    show = lambda v: "n/a" if v is None else f"{v:.{digits}f}" if isinstance(v, float) else str(v)
    body = ["| " + " | ".join(show(r[n]) for n in names) + " |" for r in rows]
    return "\n".join([f"# {title}", "", "| " + " | ".join(names) + " |", "|" + "---|" * len(names), *body, ""])
