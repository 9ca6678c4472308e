"""Operators on small tables, and the queries against SQL."""

from __future__ import annotations

import gzip
import json
import os
import random
import subprocess
import sys
import warnings
from datetime import date

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from corpuswright.functions.quality import Thresholds
from corpuswright.operators import blend, calibrate, dedup, graph, hosts, tokens
from corpuswright.plans import catalog
from corpuswright.plans.clean import clean
from corpuswright.plans.config import Cleaning, budget, load_recipe
from corpuswright.plans.recipe import run
from corpuswright.sources import readers, writers
from corpuswright.streaming import clean as streaming

SF = "/root/testdata/sf0.001"
SLOW = {"near_dup_groups", "minhash_bands"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in "documents pages benchmark labels conversations events".split():
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def plain(v):
    return round(v, 8) if isinstance(v, float) else str(v)[:19] if hasattr(v, "isoformat") else v


@pytest.mark.parametrize("name", sorted(set(catalog.ORACLES) - SLOW))
def test_query_equals_sql(spark, duck, name):
    df = __spark_entry__.queries()[name](spark, SF)
    result = duck.execute(catalog.ORACLES[name])
    columns = [c[0] for c in result.description]
    wanted = sorted((tuple(plain(v) for v in r) for r in result.fetchall()), key=repr)
    assert sorted(columns) == sorted(df.columns)
    assert sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr) == wanted


def test_components_do_not_depend_on_partitions(spark):
    r = random.Random(4)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(250)]
    made = [{x.node: x.root for x in graph.components(spark.createDataFrame(links, "a long, b long").repartition(n)).collect()} for n in (1, 5)]
    parts = [sorted(sorted(n for n in m if m[n] == v) for v in set(m.values())) for m in made]
    assert parts[0] == parts[1]


def test_near_duplicates_and_recall(spark):
    r = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    docs = []
    for i in range(120):
        base = [r.choice(words) for _ in range(200)]
        docs += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(w if r.random() > 0.01 else "changed" for w in base))]
    df = spark.createDataFrame([*docs, (999, None), (1000, "")], "id long, text string")
    kept, removed = dedup.near_dedup(df)
    gone = {x.id for x in removed.collect()}
    # near copies share over nine tenths of their runs
    assert len(gone) >= 110 and all(g % 2 for g in gone) and {x.id for x in kept.collect()} == {d for d, _ in docs} - gone | {999, 1000}
    exact = spark.createDataFrame([(1, "A  b"), (2, "a b"), (3, None), (4, ""), (5, "c")], "id long, text string")
    assert sorted(x.id for x in dedup.exact_dedup(exact).collect()) == [1, 3, 5]


def test_calibration(spark, tmp_path):
    df = spark.createDataFrame([("bir iki üç dört beş altı",), ("bir iki bir",), ("",), (None,)], "text string")
    for strategy in ("quantile", "10tail", "meanstd"):
        t = calibrate.calibrate(df, strategy)
        assert t.min_doc_words == 10 and t.max_doc_words == 100_000 and t.max_symbol_word_ratio == 0.05 and t.stop_words[0] == "bir"
    with pytest.raises(ValueError):
        calibrate.calibrate(df.where("text = ''"))
    with pytest.raises(ValueError):
        calibrate.limits(df, "other")
    t, told = calibrate.calibrated(df, top_n=3)
    assert (told["n_docs"], told["n_unique_words"], told["thresholds"]["min_doc_words"]) == (2, 6, 10) and set(told["sample_quantiles"]) == set(calibrate.METRICS)
    calibrate.write_artifacts(t, str(tmp_path / "a"), told)
    assert calibrate.load_artifacts(str(tmp_path / "a")) == t and json.loads((tmp_path / "a" / "report.json").read_text()) == told
    # what is missing or broken has the plain limits, not the calibrated ones
    (tmp_path / "a" / "thresholds.json").write_text('{"max_avg_word_length": 9.5, "min_doc_words": "7", "min_stop_words": true, "other": 1}')
    some = calibrate.load_artifacts(str(tmp_path / "a"))
    assert (some.min_doc_words, some.max_avg_word_length, some.min_stop_words, some.stop_words) == (50, 9.5, 2, t.stop_words)
    for broken in ("{broken", "[1]", '{"min_doc_words": 500000}'):
        (tmp_path / "a" / "thresholds.json").write_text(broken)
        some = calibrate.load_artifacts(str(tmp_path / "a"))
        assert (some.min_doc_words, some.min_avg_word_length, some.max_avg_word_length, some.max_symbol_word_ratio, some.max_non_alpha_words_ratio) == (50, 3.0, 12.0, 0.10, 0.70)
    assert calibrate.load_artifacts(str(tmp_path / "none")) == calibrate.PLAIN and Thresholds() != calibrate.PLAIN


@pytest.mark.parametrize("rows, accuracy", [(200_000, 20_000), (40, 50), (12, 20)])
def test_exact_quantiles(spark, monkeypatch, rows, accuracy):
    """Whether the driver may get all values or a few: the quantiles are those of the sorted list."""
    monkeypatch.setattr(calibrate, "EXACT_ROWS", rows)
    monkeypatch.setattr(calibrate, "ACCURACY", accuracy)
    r = random.Random(5)
    values = [(r.choice([0.0, 1.5, r.random(), r.gauss(0, 100)]), r.randrange(9), None) for _ in range(3000)]
    df = spark.createDataFrame(values, "a double, b long, c double").repartition(3).cache()
    points = [0.0, 0.005, 0.1, 0.333, 0.5, 0.995, 1.0]
    found = calibrate.quantiles(df, {"a": points, "b": points, "c": points})

    def by_hand(some, p):
        some = sorted(some)
        h = (len(some) - 1) * p
        return some[int(h)] + (h - int(h)) * (some[min(int(h) + 1, len(some) - 1)] - some[int(h)])

    for c, column in (("a", [v[0] for v in values]), ("b", [v[1] for v in values])):
        assert found[c] == pytest.approx([by_hand(column, p) for p in points])
    assert found["c"] == [0.0] * len(points)


def test_blend(spark):
    df = spark.createDataFrame([(f"{s}{i}", s, 10) for s in "ab" for i in range(40)], "id string, source string, tokens int")
    sources = [blend.Source("a", 3), blend.Source("b", 1), blend.Source("c", 1)]
    chosen = blend.select(df, sources, 505).cache()
    found = {r.source: r for r in blend.manifest(df, chosen, sources, 505).collect()}
    assert (found["a"].achieved_tokens, found["b"].achieved_tokens, found["c"].shortfall_tokens) == (310, 110, 101)
    assert found[None].docs == 42 and blend.blend(df, chosen).count() == 42
    alone = {r.id for r in blend.select(df.where("source = 'a'").repartition(3), [blend.Source("a", 1)], 303).collect()}
    assert alone == {r.id for r in chosen.where("source = 'a'").collect()}
    assert alone != {r.id for r in blend.select(df.where("source = 'a'"), [blend.Source("a", 1)], 303, seed=1).collect()}
    with pytest.raises(ValueError):
        blend.targets([blend.Source("a", 0)], 5)
    none = spark.createDataFrame([(None, "same"), (None, "same"), ("x", "one"), ("x", "one"), ("", "s")], "id string, text string")
    train, held = blend.export_split(none, 0.5)
    assert train.count() + held.count() == 4 and held.count() == 2
    assert [d.count() for d in blend.export_split(none.where("false"))] == [0, 0]


def test_merges(spark):
    words = [(list("abab"), 5), (list("abc"), 3), (list("bc"), 3), (["x"], 99), ([], 1), (list("zz"), 0)]
    assert tokens.learn_merges(words, 3) == [("a", "b"), ("ab", "ab"), ("ab", "c")]
    assert tokens.learn_merges(words, 9, min_freq=6) == [("a", "b")]
    table = spark.createDataFrame([(s, f) for s, f in words], "symbols array<string>, freq long")
    assert tokens.learn_merges_distributed(table, 3) == tokens.learn_merges(words, 3)
    rank = {("a", "b"): 0, ("b", "c"): 1, ("ab", "c"): 2}
    assert tokens.apply_merges(list("abcbc"), rank) == ["abc", "bc"] and tokens.apply_merges([], rank) == []
    assert [r.symbols for r in tokens.merge_pair(spark.createDataFrame([(list("aaab"),)], "symbols array<string>"), "a", "a").collect()] == [["aa", "a", "b"]]


def test_tokenizer(tmp_path):
    analyze = lambda w: {"evler": ["ev", "ler"], "evlerde": ["ev", "ler", "de"], "bozuk": ["boz"]}.get(w, [w])
    made = tokens.Tokenizer([("a", "b"), ("ab", "c")], ["▁ev", "ler", "▁kapı"], analyze)
    assert made.word("evler") == [made.piece_id["▁ev"], made.piece_id["ler"]] and made.word("Evler")[0] == made.cap and made.word("EVLER")[0] == made.upper
    assert made.word("bozuk")[0] == made.boundary and made.word("eVler")[0] == made.boundary and made.word("abc") == [made.boundary, made.byte_id["abc"]]
    texts = ["Evlerde KAPI kapı İĞNE ığdır", "don't 🙂 日本 eVler ▁x abcab", "", "a" * 90, "I i İ ı", "evlerde"]
    assert [made.decode(made.encode(t, True, True)) for t in texts] == texts
    made.table["masa"] = ["ma", "sa"]
    made.save(str(tmp_path))
    again = tokens.Tokenizer.load(str(tmp_path), analyze)
    assert [again.encode(t) for t in [*texts, "masa"]] == [made.encode(t) for t in [*texts, "masa"]] and again.size == made.size
    assert made.byte_id[tokens.ALPHABET[0]] == 7 and made.first_piece == 7 + 256 + 2


def test_counting_and_segmenting(spark, tmp_path):
    df = spark.createDataFrame([(str(i), "one two three") for i in range(40)] + [("e", ""), ("n", None)], "id string, text string")
    sampled = tokens.count_tokens(df, rate=0.5)
    n = sampled.where("token_count is not null").count()
    assert 0 < n < 42 and n == tokens.count_tokens(df.repartition(3), rate=0.5).where("token_count is not null").count()
    with pytest.raises(ValueError):
        tokens.count_tokens(df, rate=0)
    tokens.save_merges(str(tmp_path / "m.json"), [("th", "ree")])
    assert tokens.is_merges_file(str(tmp_path / "m.json"))
    count = tokens.counter(str(tmp_path / "m.json"), lambda w: [w[:2], w[2:]] if len(w) > 3 else [w])
    assert df.where("id = '1'").select(count(F.col("text"))).first()[0] == 3
    made = tokens.segment(df.where("id in ('1', 'e')").unionByName(spark.createDataFrame([("l", "x" * 90 + " bad")], df.schema)), lambda w: 1 / 0 if w == "bad" else [w[:1], w[1:]], "id")
    assert {r.id: r.text for r in made.collect()} == {"1": "o▁ne t▁wo t▁hree", "l": "x" * 90 + " bad"}


def test_hosts_and_links(spark):
    pages = spark.createDataFrame([(1, "http://g.org/a/i.htm", '<a href="/eskiler/2020/x">x</a><a href="b.pdf">b</a><a href="b.pdf">b</a><a href="http://evil.org/c.pdf">c</a><a href="#t">t</a><a href="mailto:x">m</a><a href="i.htm">i</a><a href="plain">p</a>')], "page_id long, url string, html string")
    assert [(r.link, r.pos) for r in hosts.archive_links(pages).orderBy("pos").collect()] == [("http://g.org/eskiler/2020/x", 0), ("http://g.org/a/b.pdf", 1)]
    assert {r.link for r in hosts.marked_links(pages, ("evil",)).collect()} == {"b.pdf", "http://evil.org/c.pdf", "i.htm"}
    index = spark.createDataFrame([("a.tr", 200, "text/html", "tur,eng", "CC-MAIN-2024-10", "warc"), ("a.tr", 200, "text/html", "eng,tur", "CC-MAIN-2024-10", "warc"), ("b.tr", 404, "text/html", "tur", "CC-MAIN-2024-10", "warc")], "url_host_name string, fetch_status int, content_mime_detected string, content_languages string, crawl string, subset string")
    assert [tuple(r) for r in hosts.host_rank(hosts.index_rows(index, "CC-MAIN-2024-10")).collect()] == [("a.tr", 1)]
    assert hosts.host_rank(hosts.index_rows(index, "CC-MAIN-2024-10", primary_only=False)).first().pages == 2
    with pytest.raises(ValueError):
        hosts.index_rows(index, "x'; drop table y")
    csv = spark.createDataFrame([(" www.A.tr ", "5", 0), ("", "9", 1), ("a.tr", "n/a", 2), ("b.tr", "7", 3)], "url_host_name string, pages string, rank long")
    assert [r.host for r in hosts.seeds(csv, 1).orderBy("rank").collect()] == ["www.A.tr", "b.tr"]
    assert [tuple(r) for r in hosts.allowed_domains(hosts.seeds(csv)).orderBy("rank").collect()] == [("a.tr", 0), ("b.tr", 3)]
    link = spark.createDataFrame([('<a href="/tr/download/article-cite-file/1"></a><a href="/tr/download/article-file/22">',)], "html string")
    assert link.select(hosts.article_file("html")).first()[0] == "/tr/download/article-file/22"


OAI = """<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><ListRecords><record><header><identifier>oai:1</identifier></header><metadata>
<dc xmlns:dc="http://purl.org/dc/elements/1.1/"><dc:title> T </dc:title><dc:language>tr</dc:language><dc:identifier>https://id.example/x</dc:identifier>
<dc:identifier>https://j.example/tr/pub/j/article/7</dc:identifier></dc></metadata></record><record><header status="deleted"><identifier>oai:2</identifier></header></record>
<resumptionToken>next</resumptionToken></ListRecords></OAI-PMH>"""


def test_readers_and_writers(spark, tmp_path):
    docs = spark.createDataFrame([("1", "long enough"), ("2", " a ")], "id string, text string")
    assert writers.write_records(docs, str(tmp_path / "out"), min_chars=5) == 1
    back = readers.read_jsonl(spark, str(tmp_path / "out")).collect()
    assert [(r.id, r.text) for r in back] == [("1", "long enough")]
    for bad in ([(None, "x")], [("1", None)]):
        with pytest.raises(Exception, match="a document has no"):
            writers.write_records(spark.createDataFrame(bad, "id string, text string"), str(tmp_path / f"bad{bad[0][0]}"))
    shards = tmp_path / "shards"
    shards.mkdir()
    (shards / "a.jsonl").write_text('{"id":"1","text":"x"}\n\n')
    with gzip.open(shards / "a.jsonl.gz", "wt") as f:
        f.write('{"id":"2","text":"y"}\n')
    with pytest.warns(RuntimeWarning):
        assert len(readers.shard_names(spark, str(shards))) == 2
    assert readers.read_jsonl(spark, str(shards)).where("id is not null").count() == 2
    rows = [tuple(r) for r in readers.oai_records(spark.createDataFrame([(OAI,), (None,)], "xml string")).select("identifier", "title", "language", "article_url", "token").collect()]
    assert rows == [("oai:1", "T", "tr", "https://j.example/tr/pub/j/article/7", "next"), ("oai:2", None, None, None, "next")]
    assert list(readers.harvest(lambda t: ([t], {None: "a", "a": "b", "b": None}[t]))) == [None, "a", "b"]
    assert readers.gazette_days(spark, date(2024, 3, 2), date(2024, 3, 1), "http://g").count() == 0
    (tmp_path / "p.pdf").write_bytes(b"x" * 300)
    (tmp_path / "q.pdf").write_bytes(b"bad")
    files = readers.pdf_files(spark, str(tmp_path / "*.pdf"), lambda b: b.decode() if len(b) > 9 else 1 / 0)
    assert files.where("needs_ocr").count() == 1 and readers.academic(files, "thesis").first().id == "thesis-p"
    langs = spark.createDataFrame([("TR ",), ("eng",), ("",), (None,)], "l string")
    assert [r[0] for r in langs.select(readers.in_language("l")).collect()] == [True, False, True, True]
    (tmp_path / "h.csv").write_text("url_host_name,pages\na.tr,5\n")
    assert readers.host_csv(spark, str(tmp_path / "h.csv")).first().url_host_name == "a.tr"


def test_recipe(spark, tmp_path):
    for name in "ab":
        rows = [{"id": str(i), "text": f"{name} kelime ve bir cümle daha burada yazılı duruyor sayı {i} ile biten uzun satır."} for i in range(20)]
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.jsonl").write_text("\n".join(map(json.dumps, rows)))
    recipe = {"output_root": str(tmp_path / "out"), "target_tokens": "1_00", "sources": [{"name": n, "kind": "jsonl", "weight": 1, "path": str(tmp_path / n)} for n in "ab"], "cleaning": {"languages": [], "quality": False, "near": False}}
    (tmp_path / "r.json").write_text(json.dumps(recipe))
    loaded = load_recipe(str(tmp_path / "r.json"))
    first, again = run(spark, loaded), run(spark, loaded)
    assert first == again and first["totals"]["achieved_tokens"] >= 100 and len(os.listdir(tmp_path / "out" / "blend")) >= 2
    assert budget("20e9") == 20_000_000_000 and budget(7) == 7
    for bad in ({"target_tokens": 0}, {"sources": []}, {"sources": [recipe["sources"][0]] * 2}, {"sources": [{**recipe["sources"][0], "kind": "x"}]}):
        (tmp_path / "b.json").write_text(json.dumps(recipe | bad))
        with pytest.raises(ValueError):
            load_recipe(str(tmp_path / "b.json"))


def test_cleaning_and_stream(spark, tmp_path):
    good = "Bu metin ve bir örnek olarak yazılmış uzun cümlelerden oluşan temiz belgedir."
    rows = [("1", good), ("2", good), ("3", "kısa"), ("4", good.replace("temiz", "güzel") + " Telefon 0532 123 45 67 olarak yazılmıştır."), ("5", None)]
    docs = spark.createDataFrame([(*r, None) for r in rows], readers.DOCUMENT)
    config = Cleaning(languages=("tr",), language_threshold=0.1)
    out = clean(docs, config)
    final = {r.id: r.text for r in out.final.collect()}
    assert set(final) == {"1", "4"} and "<TELEFON>" in final["4"]
    assert {r.id for r in out.removed.collect()} == {"2"} and {r.id for r in out.rejected.collect()} == {"3", "5"}
    docs.coalesce(1).write.json(str(tmp_path / "in"))
    query = streaming.start(streaming.clean_stream(streaming.read_stream(spark, str(tmp_path / "in")), config), str(tmp_path / "out"), str(tmp_path / "check"))
    query.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_entry_works_without_the_training_data_package(tmp_path):
    import shutil
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "corpuswright", tmp_path / "corpuswright", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 40 and not any(n.startswith('op') for n in q) and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    warnings.resetwarnings()


def test_a_word_has_its_time():
    import time

    def slow(word):
        if word == "slow":
            time.sleep(30)
        return [word[:2], word[2:]]

    began = time.time()
    assert tokens.segment_word("slow", slow, 0.2) == "slow" and tokens.segment_word("fast", slow, 0.2) == "fa▁st"
    assert time.time() - began < 10


def test_text_of_files_by_several_ways(spark, tmp_path):
    for name, content in (("a.pdf", b"first " * 60), ("b.PDF", b"second" * 60), ("c.pdf", b"none"), ("d.pdf", b"broken")):
        (tmp_path / name).write_bytes(content)

    def one(content):
        if content == b"broken":
            raise ValueError
        return content.decode() if content.startswith(b"first") else "short"

    two = lambda content: content.decode() if content.startswith(b"second") else None
    files = readers.pdf_files(spark, str(tmp_path), [one, two])
    found = {r.path.rsplit("/", 1)[1]: r.text for r in files.collect()}
    assert found["a.pdf"].startswith("first") and found["b.PDF"].startswith("second") and found["c.pdf"] is found["d.pdf"] is None
    assert tuple(readers.ocr_backlog(files).first()) == (4, 2, 2)


def test_index_path():
    assert hosts.index_path("s3a://index/", "CC-MAIN-2024-10") == "s3a://index/crawl=CC-MAIN-2024-10/subset=warc"
    for crawl, subset in (("CC-MAIN-2024-10/..", "warc"), ("x", "warc"), ("CC-MAIN-2024-10", "warc'")):
        with pytest.raises(ValueError):
            hosts.index_path("r", crawl, subset)


def test_folder_must_be_shared_off_local_masters():
    from types import SimpleNamespace

    from corpuswright.plans import storage

    def session(master, folder):
        conf = SimpleNamespace(get=lambda key, default: folder, set=lambda key, value: None)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, getConf=lambda: SimpleNamespace(get=lambda key, default: "")))

    assert storage.shared_dir(session("yarn", "hdfs:///x/")) == "hdfs:///x"
    assert storage.shared_dir(session("local[4]", "")).startswith("file:/")
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,512]", "k8s://x"):
        with pytest.raises(RuntimeError):
            storage.shared_dir(session(master, ""))


def test_steps_from_the_command_line(spark, tmp_path, capsys):
    from corpuswright.plans import cli

    rows = [(f"{s}{i}", f"the words of document {i} in {s} are these", {"source": s}) for s in ("a", "b") for i in range(20)]
    spark.createDataFrame(rows, "id string, text string, metadata map<string,string>").write.json(str(tmp_path / "docs"))
    docs = str(tmp_path / "docs")
    told = lambda *args: (cli.main(list(args)), json.loads(capsys.readouterr().out.splitlines()[-1]))[1]
    assert told("calibrate", docs, str(tmp_path / "c"))["max_doc_words"] == 100_000 and calibrate.load_artifacts(str(tmp_path / "c")).stop_words
    assert told("export", docs, str(tmp_path / "e"), "--share", "0.25") == {"train": 30, "eval": 10}
    assert told("segment", docs, str(tmp_path / "s"))["lines_out"] == 40
    assert told("fertility", docs)["tokens_per_word"] == 1.0
    blended = told("blend", docs, str(tmp_path / "b"), "--weight", "a=3", "--weight", "b=1", "--tokens", "1_00")
    assert {s["name"]: s["docs"] for s in blended["sources"]} == {"a": 9, "b": 3}
    assert told("tokenizer", docs, str(tmp_path / "t"), "--vocabulary", "400", "--merges", "20")["merges"] <= 20
