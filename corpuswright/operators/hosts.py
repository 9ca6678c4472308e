"""Hosts of a web index: ranking, seeds and links."""

from __future__ import annotations

import re
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuswright.functions.text import hrefs, robots_url, url_host, without_www

_CRAWL = re.compile(r"[A-Z]{2}-[A-Z]+-[0-9]{4}-[0-9]{2}").fullmatch


def index_path(root: str, crawl: str, subset: str = "warc") -> str:
    """The folder of one crawl and subset of a columnar index."""
    if not _CRAWL(crawl) or not re.fullmatch("[a-z]+", subset):
        raise ValueError("no such crawl or subset name")
    return f"{root.rstrip('/')}/crawl={crawl}/subset={subset}"


def index_rows(index: DataFrame, crawl: str, subset: str = "warc", language: str = "tur", mime: str = "text/html", primary_only: bool = True) -> DataFrame:
    """Pages of one crawl of a columnar index that were fetched, are of a type, and have a language first (or at all).

    All conditions are plain comparisons, so partitions are pruned and the rest is pushed to the Parquet reader.
    """
    if not _CRAWL(crawl) or not re.fullmatch("[a-z]+", subset):
        raise ValueError("no such crawl or subset name")
    tongue = F.col("content_languages").startswith(language) if primary_only else F.col("content_languages").contains(language)
    return index.where((F.col("crawl") == crawl) & (F.col("subset") == subset) & (F.col("fetch_status") == 200) & (F.col("content_mime_detected") == mime) & tongue)


def host_rank(rows: DataFrame, host_col: str = "url_host_name", min_pages: int = 1, limit: int = 0) -> DataFrame:
    """``(host, pages)`` of hosts with enough pages, most first, ties by name; ``limit`` 0 is all."""
    out = rows.groupBy(F.col(host_col).alias("host")).agg(F.count("*").alias("pages")).where(F.col("pages") >= min_pages)
    out = out.orderBy(F.desc("pages"), "host")
    return out.limit(limit) if limit > 0 else out


def seeds(csv: DataFrame, min_pages: int = 0) -> DataFrame:
    """``(host, rank)`` of a seed table ``(url_host_name, pages, rank)``: trimmed, blank ones left out, pages that are no
    number count as 0."""
    pages = F.coalesce(F.trim("pages").try_cast("long"), F.lit(0))
    out = csv.select(F.trim("url_host_name").alias("host"), "rank", pages.alias("n")).where(F.coalesce(F.col("host"), F.lit("")) != "")
    return (out.where(F.col("n") >= min_pages) if min_pages > 0 else out).select("host", "rank")


def _first(df: DataFrame, value: Column, name: str) -> DataFrame:
    return df.select(value.alias(name), "rank").where(F.coalesce(F.col(name), F.lit("")) != "").groupBy(name).agg(F.min("rank").alias("rank"))


def allowed_domains(ranked: DataFrame) -> DataFrame:
    """``(domain, rank)``: hosts in lower case without ``www.``, once each, with their first rank."""
    return _first(ranked, without_www("host"), "domain")


def robots_urls(ranked: DataFrame) -> DataFrame:
    """``(robots_url, rank)`` of every host, ``www.`` kept."""
    named = ranked.where(F.trim("host") != "")
    return _first(named, robots_url("host"), "robots_url")


_SKIPPED = r"(?i)^(?:#|mailto:|javascript:)"
_DOCUMENT = r"(?i)\.(?:html?|pdf)$"


def resolve(base: str, link: str) -> Column:
    """Links made absolute; null where that fails."""

    def join(a: str | None, b: str | None) -> str | None:
        try:
            return urljoin(a or "", b) if b is not None else None
        except ValueError:
            return None

    @F.pandas_udf("string")
    def joined(bases: pd.Series, links: pd.Series) -> pd.Series:
        return pd.Series(map(join, bases, links), dtype=object)

    return joined(base, link)


def page_links(pages: DataFrame, page_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(page, pos, href)``: all links of every page in order, repeats included, those within the page or to scripts or mail
    left out."""
    out = pages.select(F.col(page_col).alias("page"), F.col(url_col).alias("base"), F.posexplode(hrefs(html_col)).alias("pos", "href"))
    return out.where((F.col("href") != "") & ~F.col("href").rlike(_SKIPPED)).select("page", "base", "pos", "href")


def archive_links(pages: DataFrame, archive: str = "/eskiler/", **columns: str) -> DataFrame:
    """``(page, link)`` of an index page's documents: on the page's own host, not the page itself, a document by its ending or
    within the archive's path; each once, with its first position."""
    out = page_links(pages, **columns).withColumn("link", resolve("base", "href")).where(F.col("link").isNotNull())
    same = url_host("link") == url_host("base")
    kept = out.where(same & (F.col("link") != F.col("base")) & (F.col("link").rlike(_DOCUMENT) | F.lower("link").contains(archive)))
    return kept.groupBy("page", "link").agg(F.min("pos").alias("pos"))


# Words that addresses of a parliament's transcripts hold.
TRANSCRIPT_MARKERS = ("tutanak", "birlesim", "birleşim", "donem", "dönem", "yasama")


def marked_links(pages: DataFrame, markers: tuple[str, ...] = TRANSCRIPT_MARKERS, **columns: str) -> DataFrame:
    """``(page, link)``: links as they stand whose ending is a document's or that hold a marker; each once."""
    low = F.lower("href")
    kept = page_links(pages, **columns).where(F.col("href").rlike(_DOCUMENT) | F.greatest(F.lit(False), *[low.contains(m) for m in markers]))
    return kept.groupBy("page", F.col("href").alias("link")).agg(F.min("pos").alias("pos"))


def article_file(html: Column | str) -> Column:
    """The first link to an article's own file; links to its citation are another path."""
    return F.nullif(F.regexp_extract(F.col(html) if isinstance(html, str) else html, r"(?i)href\s*=\s*[\"']([^\"']*/download/article-file/[^\"']*)[\"']", 1), F.lit(""))
