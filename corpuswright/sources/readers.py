"""Readers: each gives documents ``(id, text, metadata)`` or what documents are made from."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator, Sequence
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructField, StructType

from corpuswright.functions.text import html_text, html_title

#: Text, an id, and whatever else is known of a document as strings.
DOCUMENT = StructType([StructField("id", StringType()), StructField("text", StringType()), StructField("metadata", MapType(StringType(), StringType()))])


def record(df: DataFrame, id_: Column, text: Column, source: str, license: str, register: str, **more: Column) -> DataFrame:  # noqa: A002
    """Documents with their provenance; facts that are null are left out of the metadata."""
    facts = {"source": F.lit(source), "license": F.lit(license), "register": F.lit(register)} | more
    entries = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in facts.items()])
    metadata = F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))
    return df.select(id_.cast("string").alias("id"), text.alias("text"), metadata.alias("metadata"))


def read_jsonl(spark: SparkSession, path: str, text_key: str = "text", id_key: str = "id", limit: int = -1) -> DataFrame:
    """Documents of JSON lines, plain or compressed; blank lines are skipped. A limit of 0 or less is none."""
    schema = StructType([StructField(id_key, StringType()), StructField(text_key, StringType()), StructField("metadata", MapType(StringType(), StringType()))])
    df = spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json*").json(path)
    df = df.select(F.col(id_key).alias("id"), F.col(text_key).alias("text"), "metadata")
    return df.limit(limit) if limit > 0 else df


def shard_names(spark: SparkSession, path: str) -> list[str]:
    """Shards below a folder in order, by Spark's own reader; warns where two differ only by their compression."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json*").option("recursiveFileLookup", "true").load(path).select("path")
    names = sorted(r.path for r in files.collect())
    stems = [n.removesuffix(".gz").removesuffix(".jsonl").removesuffix(".json") for n in names]
    for stem in sorted({s for s in stems if stems.count(s) > 1}):
        warnings.warn(f"more than one shard is called {stem}", RuntimeWarning, stacklevel=2)
    return names


def _limited(df: DataFrame, limit: int) -> DataFrame:
    return df.limit(limit) if limit > 0 else df


def encyclopedia(rows: DataFrame, limit: int = -1, source: str = "wikipedia", license: str = "cc-by-sa-4.0", prefix: str = "wiki-") -> DataFrame:  # noqa: A002
    """Articles ``(id, title, text, url)``; the limit counts rows that are read."""
    rows = _limited(rows, limit)
    return record(rows, F.concat(F.lit(prefix), F.col("id").cast("string")), F.col("text"), source, license, "encyclopedic", title=F.col("title"), url=F.col("url"))


def legislation(rows: DataFrame, keys: tuple[str, ...] = ("text", "content", "madde", "icerik"), limit: int = -1, source: str = "mevzuat", license: str = "public-domain") -> DataFrame:  # noqa: A002
    """Laws whose text is the first of some columns that is not empty; rows without any are skipped, and the limit counts
    those that stay. Without an ``id`` column ids come from a row's partition and place in it."""
    found = [F.nullif(F.col(k).cast("string"), F.lit("")) for k in keys if k in rows.columns]
    if not found:
        raise ValueError(f"none of the columns {keys} is there")
    number = F.monotonically_increasing_id().cast("string")
    id_ = F.coalesce(F.col("id").cast("string"), number) if "id" in rows.columns else number
    kept = _limited(rows.withColumn("__text", F.coalesce(*found)).withColumn("__id", id_).where(F.col("__text").isNotNull()), limit)
    return record(kept, F.concat(F.lit(f"{source}-"), F.col("__id")), F.col("__text"), source, license, "legal")


def pdf_files(spark: SparkSession, path: str, extract: Callable[[bytes], str | None] | Sequence[Callable[[bytes], str | None]], min_chars: int = 200) -> DataFrame:
    """``(path, text, needs_ocr)`` of the PDF files below a folder: text by the function that is passed in, or by the first of
    several whose text is long enough; files that all fail on, or whose texts are all shorter than ``min_chars``, need
    character recognition and have a null text."""
    ways = [extract] if callable(extract) else list(extract)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.[pP][dD][fF]").option("recursiveFileLookup", "true").load(path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in batches:
            texts = []
            for content in some["content"]:
                found = None
                for way in ways:
                    try:
                        text = way(bytes(content))
                    except Exception:  # noqa: BLE001  one broken file must not end the job
                        continue
                    if text and len(text.strip()) >= min_chars:
                        found = text
                        break
                texts.append(found)
            yield pd.DataFrame({"path": some["path"], "text": texts, "needs_ocr": [t is None for t in texts]})

    return files.select("path", "content").mapInPandas(run, "path string, text string, needs_ocr boolean")


def ocr_backlog(files: DataFrame) -> DataFrame:
    """``(files, with_text, needs_ocr)``: how many of each."""
    return files.agg(F.count("*").alias("files"), F.count_if(~F.col("needs_ocr")).alias("with_text"), F.count_if("needs_ocr").alias("needs_ocr"))


def academic(files: DataFrame, source: str, license: str = "unknown", limit: int = -1) -> DataFrame:  # noqa: A002
    """Documents of the PDF files that have text; the limit counts those."""
    kept = _limited(files.where("not needs_ocr"), limit)
    name = F.regexp_extract("path", r"([^/]*)\.[pP][dD][fF]$", 1)
    return record(kept, F.concat(F.lit(f"{source}-"), name), F.col("text"), source, license, "academic", filename=F.regexp_extract("path", r"([^/]*)$", 1))


OAI = "identifier string, title string, language string, article_url string, dc map<string,array<string>>, token string"


def oai_records(pages: DataFrame, xml_col: str = "xml", article: str = r"^https?://[^/]+/.*/article/\d+") -> DataFrame:
    """``(identifier, title, language, article_url, dc, token)`` of every record of harvested ``ListRecords`` pages.

    ``dc``: all values of every Dublin Core field; ``article_url``: the first identifier of a landing page; ``token``: where the
    page says that the list goes on, null on the last one. A page that is not well-formed is an error.
    """
    import re
    from xml.etree import ElementTree

    dublin, oai = "{http://purl.org/dc/elements/1.1/}", "{http://www.openarchives.org/OAI/2.0/}"
    landing = re.compile(article).match

    def of_page(xml: str) -> Iterator[tuple]:
        root = ElementTree.fromstring(xml)
        token = (root.findtext(f".//{oai}resumptionToken") or "").strip() or None
        for item in root.iter(f"{oai}record"):
            fields: dict[str, list[str]] = {}
            for e in item.iter():
                if isinstance(e.tag, str) and e.tag.startswith(dublin) and (value := (e.text or "").strip()):
                    fields.setdefault(e.tag.removeprefix(dublin), []).append(value)
            first = {k: v[0] for k, v in fields.items()}
            url = next((x for x in fields.get("identifier", []) if landing(x)), None)
            yield (item.findtext(f"{oai}header/{oai}identifier") or "").strip(), first.get("title"), first.get("language"), url, fields, token

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in batches:
            rows = [r for xml in some["xml"] if xml for r in of_page(xml)]
            yield pd.DataFrame(rows, columns=["identifier", "title", "language", "article_url", "dc", "token"])

    return pages.select(F.col(xml_col).alias("xml")).mapInPandas(run, OAI)


def in_language(language: Column | str, names: tuple[str, ...] = ("tr", "tur")) -> Column:
    """Whether a record's language is one of some, or not told."""
    told = F.lower(F.trim(F.col(language) if isinstance(language, str) else language))
    return F.coalesce(told.isin(*names) | (told == ""), F.lit(True))


def harvest(fetch: Callable[[str | None], tuple[list, str | None]], limit: int = 0) -> Iterator:
    """Records of a paged list, page after page until there is no token (or the limit); ``fetch`` takes the token."""
    token, n = None, 0
    while True:
        some, token = fetch(token)
        for item in some:
            yield item
            n += 1
            if 0 < limit <= n:
                return
        if not token:
            return


def gazette_days(spark: SparkSession, first: date, last: date, base: str, archive: str = "eskiler") -> DataFrame:
    """``(day, url)`` of a daily gazette's index pages, both ends included; none if the last day is before the first."""
    days = spark.createDataFrame([(first, last)], "a date, b date").where("a <= b").select(F.explode(F.sequence("a", "b")).alias("day"))
    return days.select("day", F.concat(F.lit(f"{base.rstrip('/')}/{archive}/"), F.date_format("day", "yyyy/MM/yyyyMMdd"), F.lit(".htm")).alias("url"))


def transcript_url(term: Column | str, base: str) -> Column:
    """The index address of a parliament's term."""
    return F.concat(F.lit(f"{base.rstrip('/')}?donem="), F.url_encode(F.col(term).cast("string") if isinstance(term, str) else term))


def fetched(pages: DataFrame, body_col: str = "html", most: int = 10 * 1024 * 1024, status_col: str | None = None) -> DataFrame:
    """The pages that were fetched well (status 200, if there is a column of it) and whose body is of at most so many bytes."""
    out = pages.where(F.octet_length(body_col) <= most)
    return out.where(F.col(status_col) == 200) if status_col else out


def transcripts(pages: DataFrame, extract: Callable[[Column], Column] | None = None, source: str = "tbmm", license: str = "public-domain") -> DataFrame:  # noqa: A002
    """Documents of a parliament's transcripts ``(term, pos, url, html)``: numbered within each term in the order of ``pos``,
    from 0 on, pages without text not counted. A term's pages are numbered in one task; there are some thousands."""
    out = pages.withColumn("__text", (extract or html_text)(F.col("html"))).where(F.coalesce(F.col("__text"), F.lit("")) != "")
    number = F.row_number().over(Window.partitionBy("term").orderBy("pos", "url")) - 1
    id_ = F.concat_ws("-", F.lit(source), F.col("term").cast("string"), F.col("__number").cast("string"))
    return record(out.withColumn("__number", number), id_, F.col("__text"), source, license, "parliamentary", url=F.col("url"), term=F.col("term"))


def fetched_pages(pages: DataFrame, source: str, license: str, register: str, id_: Column, extract: Callable[[Column], Column] = html_text, min_chars: int = 1) -> DataFrame:  # noqa: A002
    """Documents of pages ``(url, html)`` that were fetched before; too short ones are left out."""
    out = pages.withColumn("__text", extract(F.col("html"))).where(F.length("__text") >= min_chars)
    return record(out, id_, F.col("__text"), source, license, register, url=F.col("url"), title=html_title("html"))


def crawl_documents(pages: DataFrame, extract: Callable[[Column], Column] = html_text, min_chars: int = 200, source: str = "crawl", license: str = "unknown") -> DataFrame:  # noqa: A002
    """Documents of crawled pages, by address; texts below ``min_chars`` are left out."""
    return fetched_pages(pages, source, license, "web", F.col("url"), extract, min_chars)


def host_csv(spark: SparkSession, path: str) -> DataFrame:
    """``(url_host_name, pages, rank)`` of a seed list; the rank keeps the order of the file."""
    df = spark.read.option("header", "true").schema("url_host_name string, pages string").csv(path)
    return df.withColumn("rank", F.monotonically_increasing_id())


def text_lines(spark: SparkSession, path: str, limit: int = 0) -> DataFrame:
    return _limited(spark.read.text(path).select(F.col("value").alias("text")), limit)
