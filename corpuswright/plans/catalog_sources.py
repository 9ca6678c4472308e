"""More named queries: what is read and written, web indexes, merges and run statistics."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuswright.functions import markup, text
from corpuswright.operators import blend, calibrate, dedup, hosts, tokens
from corpuswright.plans.catalog import _CHOSEN, _DROPPED, _FREQ, _HOST, _NORMAL, _WS, BUDGET, CLEANING, SOURCES, _counted, _sql_bands, _sql_html, _sql_redact, documents, query, sql_lower, sql_words, table
from corpuswright.plans.clean import clean
from corpuswright.plans.storage import shared_dir
from corpuswright.sources import readers, writers


def _fresh(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/corpuswright/{name}-{uuid.uuid4().hex}"


@query(f"select 'doc-' || doc_id id, md5(text) text_md5, 'store' source, lang register from documents where regexp_matches(text, '[^\\s\\x{{85}}\\x{{a0}}\\x{{2028}}\\x{{2029}}\\x{{3000}}]')")
def jsonl_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as gzipped JSON lines and read again."""
    path = _fresh(spark, "jsonl")
    rows = documents(spark, sf_dir)
    made = readers.record(rows, F.concat(F.lit("doc-"), F.col("doc_id").cast("string")), F.col("text"), "store", "cc0", "any", tongue=F.col("lang"))
    writers.write_records(made, path)
    return readers.read_jsonl(spark, path).select("id", F.md5("text").alias("text_md5"), F.col("metadata")["source"].alias("source"), F.col("metadata")["tongue"].alias("register"))


@query("select 2::bigint shards, 1::bigint repeated")
def shard_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder whose two shards differ only by their compression: both are found, and a warning names the stem."""
    import warnings

    path = _fresh(spark, "shards")
    one = spark.createDataFrame([("a", "text")], "id string, text string").coalesce(1)
    # one writer each, as a writer has files of one compression
    one.write.json(f"{path}/x")
    one.write.option("compression", "gzip").json(f"{path}/y")
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop.Path(f"{path}/all"))
    for part, name in (("x", "shard-0.json"), ("y", "shard-0.json.gz")):
        found = fs.globStatus(hadoop.Path(f"{path}/{part}/part-*"))
        fs.rename(found[0].getPath(), hadoop.Path(f"{path}/all/{name}"))
    with warnings.catch_warnings(record=True) as told:
        warnings.simplefilter("always")
        names = readers.shard_names(spark, f"{path}/all")
    return spark.createDataFrame([(len(names), sum("shard-0" in str(w.message) for w in told))], "shards long, repeated long")


@query("select 'oai:x:' || doc_id identifier, source title, case when doc_id % 5 > 0 then lang end \"language\", case when doc_id % 3 > 0 then 'https://j.example/en/pub/x/article/' || doc_id end article_url, case when doc_id % 7 > 0 then 'next-' || doc_id end token from documents where doc_id % 5 = 0 or lang in ('en', 'fr')")
def oai_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A harvested page made of each document; records in two languages, or in none that is told, stay."""
    tag = lambda name, value: F.concat(F.lit(f"<dc:{name}>"), value, F.lit(f"</dc:{name}>"))
    number = F.col("doc_id").cast("string")
    fields = F.concat(
        tag("title", F.col("source")), tag("title", F.lit("another")), F.when(F.col("doc_id") % 5 > 0, tag("language", F.col("lang"))).otherwise(""), tag("identifier", F.lit("https://hdl.example/1")),
        F.when(F.col("doc_id") % 3 > 0, tag("identifier", F.concat(F.lit("https://j.example/en/pub/x/article/"), number))).otherwise(""), tag("description", F.lit("a &amp; b")),
    )
    token = F.concat(F.lit("<resumptionToken>"), F.when(F.col("doc_id") % 7 > 0, F.concat(F.lit("next-"), number)).otherwise(""), F.lit("</resumptionToken>"))
    xml = F.concat(F.lit('<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/" xmlns:dc="http://purl.org/dc/elements/1.1/"><ListRecords><record><header><identifier>oai:x:'), number, F.lit("</identifier></header><metadata>"), fields, F.lit("</metadata></record>"), token, F.lit("</ListRecords></OAI-PMH>"))
    found = readers.oai_records(documents(spark, sf_dir).select(xml.alias("xml")))
    return found.where(readers.in_language("language", ("en", "fr"))).select("identifier", "title", "language", "article_url", "token")


_INDEX = "select page_id, {host} url_host_name, case when page_id % 5 = 0 then 404 else 200 end fetch_status, case when page_id % 7 = 0 then 'text/plain' else 'text/html' end content_mime_detected, case when page_id % 3 = 0 then 'eng,tur' else 'tur,eng' end content_languages, case when page_id % 11 = 0 then 'CC-MAIN-2023-50' else 'CC-MAIN-2024-10' end crawl, case when page_id % 13 = 0 then 'robotstxt' else 'warc' end subset from pages"


@query(f"select url_host_name host, count(*) pages, count(*) filter (page_id % 3 > 0) first_language from ({_INDEX.format(host=_HOST)}) where fetch_status = 200 and content_mime_detected = 'text/html' and crawl = 'CC-MAIN-2024-10' and subset = 'warc' group by 1")
def index_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hosts of the pages of one crawl of an index that have a language at all, and of those that have it first."""
    table(spark, sf_dir, "pages").createOrReplaceTempView("index_pages")
    rows = spark.table("index_pages").select("page_id", text.url_host("url").alias("host"))
    index = rows.selectExpr("page_id", "host url_host_name", *[x for x in _INDEX.format(host="host").removeprefix("select ").removesuffix(" from pages").split(", ") if x.startswith("case")])
    every = hosts.host_rank(hosts.index_rows(index, "CC-MAIN-2024-10", primary_only=False))
    first = hosts.host_rank(hosts.index_rows(index, "CC-MAIN-2024-10")).withColumnRenamed("pages", "first_language")
    return every.join(first, "host", "left").na.fill(0, ["first_language"])


@query(f"select host, row_number() over (order by pages desc, host) place from (select {_HOST} host, count(*) pages from pages group by 1) where pages >= 3")
def seed_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ranking of hosts written as CSV, read again as seeds."""
    from pyspark.sql import Window

    path = _fresh(spark, "ranking")
    writers.write_ranking(hosts.host_rank(table(spark, sf_dir, "pages").select(text.url_host("url").alias("url_host_name"))).withColumnRenamed("host", "url_host_name"), path)
    found = hosts.seeds(readers.host_csv(spark, path), min_pages=3)
    # a list of hosts, not of pages
    return found.select("host", F.row_number().over(Window.orderBy("rank")).cast("long").alias("place"))


@query(f"select md5(line) line_md5, count(*) n from (select trim(regexp_replace(text, '{_WS}+', ' ', 'g')) line from documents) group by 1")
def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as lines of text and read again."""
    path = _fresh(spark, "lines")
    writers.write_text(documents(spark, sf_dir).select(text.collapse("text").alias("text")), path)
    return readers.text_lines(spark, path).groupBy(F.md5("text").alias("line_md5")).agg(F.count("*").alias("n"))


@query("select page_id, case when page_id % 2 = 0 then '/en/download/article-file/' || page_id end file from pages")
def article_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article's own file among the links of a page, where there is one."""
    number = F.col("page_id").cast("string")
    more = F.concat(F.col("html"), F.lit('<a href="/en/download/citation-file/'), number, F.lit('">cite</a>'), F.when(F.col("page_id") % 2 == 0, F.concat(F.lit('<a class=x href="/en/download/article-file/'), number, F.lit('">PDF</a>'))).otherwise(""))
    return table(spark, sf_dir, "pages").select("page_id", hosts.article_file(more).alias("file"))


@query(f"select 'tbmm-' || term || '-' || (row_number() over (partition by term order by page_id) - 1) id, md5(t) text_md5, url from (select page_id, url, page_id % 3 + 26 term, {_sql_html()} t from pages where octet_length(encode(html)) <= 20000) where t <> ''")
def transcripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of three terms as transcripts; pages beyond a size are not read."""
    pages = table(spark, sf_dir, "pages").select(F.expr("page_id % 3 + 26").alias("term"), F.col("page_id").alias("pos"), "url", "html", F.lit(200).alias("status"))
    made = readers.transcripts(readers.fetched(pages, "html", 20_000, "status"))
    return made.select("id", F.md5("text").alias("text_md5"), F.col("metadata")["url"].alias("url"))


_MORE = "<p>caf&eacute; &#233;&#x1F600; a &lt; b<div>and<br/>so &hellip; on"


def _sql_parsed() -> str:
    out = "replace(html, '<td', chr(10) || '<td')"
    for entity, plain in (("&copy;", "©"), ("&middot;", "·"), ("&eacute;", "é"), ("&#233;", "é"), ("&#x1F600;", "😀"), ("&hellip;", "…"), ("&nbsp;", " ")):
        out = f"replace({out}, '{entity}', '{plain}')"
    return _sql_html().replace("html", out, 1)


@query(f"select page_id, md5(t) text_md5 from (select page_id, {_sql_parsed()} t from (select page_id, html || '{_MORE}' html from pages))")
def html_text_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of pages by a parser, with character references and unclosed elements behind each page."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.concat("html", F.lit(_MORE)).alias("html"))
    return pages.select("page_id", F.md5(markup.html_text("html")).alias("text_md5"))


MERGES = [("t", "h"), ("th", "e"), ("i", "n"), ("in", "g"), ("o", "r")]


def _sql_pieces(w: str) -> str:
    # no symbol but the pair's first ends with its letters, so pairs can be looked for as text
    out = f"array_to_string(string_split({w}, ''), chr(1))"
    for a, b in MERGES:
        out = f"replace({out}, '{a}' || chr(1) || '{b}', '{a}{b}')"
    return f"string_split({out}, chr(1))"


@query(f"select doc_id, coalesce(list_sum([case when length(x) > {tokens.LONGEST_WORD} then 1 else len({_sql_pieces('x')}) end for x in {sql_words('text')}]), 0)::bigint n_tokens from documents")
def merge_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of an analyser that splits words into characters, joined again by a file of merges."""
    import tempfile
    from pathlib import Path

    # read by the driver alone
    path = Path(tempfile.mkdtemp()) / "merges.json"
    tokens.save_merges(str(path), MERGES)
    return tokens.count_tokens(documents(spark, sf_dir), tokens.counter(str(path), list), id_col="doc_id").select("doc_id", F.col("token_count").alias("n_tokens"))


@query(f"select words, different, round(1 - different / words, 9) hit_rate from (select count(*) words, count(distinct x) different from (select unnest({sql_words('text')}) x from documents))")
def cache_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words an analyser need not see again, as each different one is analysed once."""
    return tokens.cache_hits(documents(spark, sf_dir)).withColumn("hit_rate", F.round("hit_rate", 9))


_READY = f"select doc_id, {_NORMAL} text, text raw from judged where drop_reason is null"


@query(f"""with {_DROPPED}, ready as materialized ({_READY}), hidden as ({_sql_redact('select doc_id, text from ready')})
    select (select count(*) from ready) prepared, (select count(*) from ready where text is distinct from raw) normalized, coalesce(sum(iban), 0)::bigint iban, coalesce(sum(phone), 0)::bigint phone, coalesce(sum(tc_kimlik), 0)::bigint tc_kimlik from hidden""")
def clean_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the cleaning run has counted on its way."""
    found = clean(documents(spark, sf_dir), CLEANING, "doc_id").stats
    names = ("prepared", "normalized", "iban", "phone", "tc_kimlik")
    return spark.createDataFrame([tuple(found.get(n, 0) for n in names)], ", ".join(f"{n} long" for n in names))


_NEAR = f"""b as materialized ({_sql_bands()}), l as materialized (select distinct m a, id b from b join (select band, "key", min(id) m from b group by all having count(*) > 1) using (band, "key") where m <> id),
    pairs as materialized (select a, b from l union select b, a from l), reach as (select distinct a id, a r from pairs union select reach.id, pairs.b from reach join pairs on reach.r = pairs.a)"""


@query(f"with recursive {_NEAR} select doc_id, md5(text) text_md5, doc_id in (select id from reach group by id having min(r) < id) removed from documents")
def near_dedup_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that stay and those that go as near duplicates, whole rows of each."""
    kept, gone = dedup.near_dedup(documents(spark, sf_dir), "doc_id")
    both = kept.withColumn("removed", F.lit(False)).unionByName(gone.withColumn("removed", F.lit(True)))
    return both.select("doc_id", F.md5("text").alias("text_md5"), "removed")


@query(f"select source, count(*) docs, sum(tokens)::bigint tokens, md5(string_agg(md5(text), '' order by id)) texts_md5 from ({_CHOSEN}) join (select doc_id id, text from documents) using (id) group by source")
def blend_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A blend written as shards by source, and read again."""
    path = _fresh(spark, "blend")
    counted = _counted(spark, sf_dir)
    chosen = blend.select(counted, SOURCES, BUDGET, seed=7)
    docs = documents(spark, sf_dir).select(F.col("doc_id").alias("id"), F.col("lang").alias("source"), "text")
    writers.write_blend(blend.blend(docs, chosen), path)
    found = spark.read.schema("id long, text string, source string").json(path)
    ordered = F.array_sort(F.collect_list(F.struct("id", F.md5("text").alias("m"))))
    return found.withColumn("tokens", text.word_count("text")).groupBy("source").agg(F.count("*").alias("docs"), F.sum("tokens").alias("tokens"), F.md5(F.array_join(F.transform(ordered, lambda x: x["m"]), "")).alias("texts_md5"))


@query(f"""select piece, sum(freq)::bigint freq from (select freq, unnest(case when length(w) > {tokens.LONGEST_WORD} or length(w) < 6 then ['▁' || w] else ['▁' || left(w, 4), substr(w, 5)] end) piece
    from (select w, count(*) freq from (select unnest({sql_words(sql_lower('text'))}) w from documents) group by w)) group by piece order by freq desc, piece limit 300""")
def top_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent pieces of an analyser that cuts longer words behind their fourth letter; ties by the piece."""
    found = tokens.piece_frequencies(documents(spark, sf_dir), lambda w: [w[:4], w[4:]] if len(w) > 5 else [w])
    return found.orderBy(F.desc("freq"), "piece").limit(300)


@query(f"select (select count(*) from ({_FREQ})) vocabulary, count(*) n_docs from documents where len({sql_words('text')}) > 0")
def calibration_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a calibration tells of its sample: different words and documents that are not blank."""
    docs = documents(spark, sf_dir)
    told = calibrate.calibrated(docs)[1]
    return spark.createDataFrame([(told["n_unique_words"], told["n_docs"])], "vocabulary long, n_docs long")


@query(f"select doc_id, md5(array_to_string({sql_words('text')}, ' ')) decoded_md5 from documents")
def saved_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tokenizer that was saved and loaded again gives texts back, spaces collapsed."""
    import tempfile

    docs, folder = documents(spark, sf_dir), tempfile.mkdtemp()
    # read by the driver alone
    tokens.build_tokenizer(docs, tokens.suffixes, vocabulary=3000, n_merges=50, top=1000).save(folder)
    made = tokens.Tokenizer.load(folder, tokens.suffixes)
    ids = docs.select("doc_id", tokens.encode_column(made)("text").alias("ids"))
    return ids.select("doc_id", F.md5(tokens.decode_column(made)("ids")).alias("decoded_md5"))
