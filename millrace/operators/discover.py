"""Links, exclusion lists and downloads, as relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.python_side import absolute_url


def is_document_url(url: Column, extension: str = "pdf") -> Column:
    """Does the path end with the extension, or a query follow it?"""
    path = F.lower(F.regexp_replace(url, r"[?#].*$", ""))
    return path.endswith(f".{extension}") | F.contains(F.lower(url), F.lit(f".{extension}?"))


def base_name(url: Column) -> Column:
    path = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")
    return F.regexp_extract(path, r"([^/]*)/*$", 1)


def page_links(pages: DataFrame, extension: str = "pdf", url: str = "url", html: str = "html", keys: list[str] | None = None) -> DataFrame:
    """Links of every page to documents: href attributes first, resolved
    against the page, then bare addresses; each once per page, with its
    position among them."""
    keys = [F.col(c) for c in keys or []]
    ext = extension.replace(".", r"\.")
    body = F.coalesce(F.col(html), F.lit(""))
    href = F.regexp_extract_all(body, F.lit(rf"""(?i)href=["']([^"']+\.{ext}[^"']*)["']"""), F.lit(1))
    bare = F.regexp_extract_all(body, F.lit(rf"""(?i)https?://[^\s"'<>]+\.{ext}(?:\?[^\s"'<>]*)?"""), F.lit(0))
    tagged = F.concat(F.transform(href, lambda x: F.struct(F.lit(0).alias("kind"), F.trim(x).alias("raw"))), F.transform(bare, lambda x: F.struct(F.lit(1).alias("kind"), F.regexp_replace(x, r"[).,;\]]+$", "").alias("raw"))))
    found = pages.select(*keys, F.col(url).alias("source_page"), F.posexplode(tagged).alias("pos", "x")).select(*keys, "source_page", "pos", F.col("x.kind").alias("kind"), F.col("x.raw").alias("raw"))
    plain = F.col("raw").rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://")
    target = F.when(plain, F.col("raw")).otherwise(absolute_url("source_page", F.when(~plain, F.col("raw"))))
    linked = found.withColumn("link", target)
    good = (F.col("kind") == 1) | (F.col("link").startswith("http") & is_document_url(F.col("link"), extension))
    first = Window.partitionBy(*keys, "source_page", "link").orderBy("pos")
    once = linked.where(good).withColumn("_n", F.row_number().over(first)).where("_n = 1")
    return once.select(*keys, "source_page", "link", "kind", "pos")


def search_hits(pages: DataFrame, most: int = 20, extension: str = "pdf") -> DataFrame:
    """Targets of a search page's redirect links, then its plain links, at most
    ``most`` per page."""
    raw = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(r"(?i)[?&]uddg=([^&\"']+)"), F.lit(1))
    hits = pages.select(F.col("url").alias("source_page"), F.posexplode(raw).alias("pos", "x")).withColumn("link", F.try_url_decode(F.replace("x", F.lit("+"), F.lit("%2B"))))
    hits = hits.where(F.col("link").startswith("http") & is_document_url(F.col("link"), extension)).select("source_page", "link", F.lit(0).alias("kind"), "pos")
    both = hits.unionByName(page_links(pages, extension).select("source_page", "link", F.lit(1).alias("kind"), "pos"))
    once = both.withColumn("_n", F.row_number().over(Window.partitionBy("source_page", "link").orderBy("kind", "pos"))).where("_n = 1")
    order = Window.partitionBy("source_page").orderBy("kind", "pos")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most).select("source_page", "link", "rank")


def last_by_url(links: DataFrame, order: str, url: str = "link") -> DataFrame:
    """The last row of each address: later portals replace earlier ones."""
    ranked = links.withColumn("_n", F.row_number().over(Window.partitionBy(url).orderBy(F.desc(order))))
    return ranked.where("_n = 1").drop("_n")


def exclude_entries(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lower-cased entries of a list; blank lines and comments are left out."""
    entry = F.lower(F.trim(F.col(column)))
    return lines.select(entry.alias("entry")).where("entry != '' AND NOT startswith(entry, '#')").distinct()


def not_excluded(links: DataFrame, excludes: DataFrame, url: str = "link", most: int = 100_000) -> DataFrame:
    """Links that no entry names: not by address, not by base name, and, for
    entries over 8 characters, not as a part.

    The first two are joins by equality.  The third needs every entry at every
    link; the list is sent to the links as one array after its size has been
    checked, and a longer one is taken in slices.
    """
    entries = excludes.select("entry").distinct()
    low = F.lower(F.col(url))
    out = links.withColumns({"_u": low, "_b": F.lower(base_name(F.col(url)))})
    out = out.join(entries.withColumnRenamed("entry", "_u"), "_u", "left_anti").join(entries.withColumnRenamed("entry", "_b"), "_b", "left_anti")
    long_ = entries.where(F.length("entry") > 8)
    slices = max(1, -(-long_.count() // most))
    for k in range(slices):
        part = long_.where(F.pmod(F.xxhash64("entry"), F.lit(slices)) == k).agg(F.collect_list("entry").alias("_entries"))
        out = out.crossJoin(F.broadcast(part)).where(~F.exists("_entries", lambda e: F.contains(F.col("_u"), e))).drop("_entries")
    return out.drop("_u", "_b")


def first_wins(links: DataFrame, order: list[str], url: str = "link") -> DataFrame:
    ranked = links.withColumn("_n", F.row_number().over(Window.partitionBy(url).orderBy(*order)))
    return ranked.where("_n = 1").drop("_n")


def not_ingested(links: DataFrame, done: DataFrame, url: str = "link", done_url: str = "source_url") -> DataFrame:
    """Links whose trimmed, lower-cased address is not among those done."""
    keyed = links.withColumn("_k", F.lower(F.trim(F.col(url))))
    return keyed.join(done.select(F.lower(F.trim(F.col(done_url))).alias("_k")).distinct(), "_k", "left_anti").drop("_k")


def is_document(content: Column, content_type: Column, least: int = 5000) -> Column:
    """Magic bytes decide; without them in the first 1024 bytes only the size
    does, and a web page never counts."""
    head = F.hex(F.substring(content, 1, 1024))
    begins, inside = F.hex(F.substring(content, 1, 4)) == "25504446", F.contains(head, F.lit("25504446"))
    page = F.contains(F.lower(F.coalesce(content_type, F.lit(""))), F.lit("html")) & ~begins
    return ~page & (begins | inside | (F.octet_length(content) >= least))


def downloads(fetched: DataFrame, most: int, seq: str = "seq") -> DataFrame:
    """Outcome of a list of downloads in order (seq, url, sha256, failed,
    skipped): new until ``most`` new ones, copies and failures not counted."""
    usable = ~F.col("failed") & ~F.col("skipped")
    first = F.row_number().over(Window.partitionBy("sha256", usable).orderBy(seq)) == 1
    marked = fetched.withColumn("is_new", usable & first)
    before = F.coalesce(F.sum(F.col("is_new").cast("int")).over(Window.orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    status = F.when(F.col("skipped"), "already_ingested").when(F.col("failed"), "failed").when(F.col("is_new"), "new").otherwise("deduped")
    return marked.withColumn("_before", before).where(F.col("_before") < most).withColumn("status", status).drop("_before", "is_new")


def safe_file_name(url: Column, index: Column, extension: str = "pdf") -> Column:
    """Numbered file name of an address: word characters, dots and hyphens."""
    raw = base_name(F.try_url_decode(F.replace(url, F.lit("+"), F.lit("%2B"))))
    named = F.when(raw == "", F.format_string(f"doc_%04d.{extension}", index)).otherwise(raw)
    clean = F.regexp_replace(named, r"(?U)[^\w.\-]+", "_")
    full = F.when(F.lower(clean).endswith(f".{extension}"), clean).otherwise(F.concat(clean, F.lit(f".{extension}")))
    cut = F.concat(F.substr(F.substr(full, F.lit(1), F.length(full) - 4), F.lit(1), F.lit(100)), F.lit(f".{extension}"))
    return F.format_string("%04d_%s", index, F.when(F.length(full) > 120, cut).otherwise(full))


def source_pool(docs: int, already: int) -> int:
    """Links to look for when ``docs`` new documents are wanted."""
    return max(5 * docs, docs + already + 8)
