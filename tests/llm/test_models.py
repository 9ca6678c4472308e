"""Trained models: held-out accuracy and defined results at the edges."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuswright.llm import html_text, language_id, quality

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_quality_on_held_out_labels(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = quality.score(docs, quality.train(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    good, bad = [r.score for r in out if r.quality == 1], [r.score for r in out if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([r.predicted == r.quality for r in out]) > 0.95


def test_quality_does_not_read_other_columns(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.train(docs, labels)
    plain = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    other = docs.selectExpr("doc_id", "text", "'xx' as lang", "'s' as source", "0.5 as score", "1 as predicted")
    assert {r.doc_id: r.score for r in quality.score(other, model).collect()} == plain


def test_scores_against_plain_average_and_softmax(spark, docs):
    """Every feature's vector, averaged, through the layer and the softmax, one text after another."""
    import zlib

    random = np.random.default_rng(3)
    vectors, layer, bias = random.normal(size=(quality.BUCKETS, 8)), random.normal(size=(8, 2)), random.normal(size=2)
    model = quality.Model(vectors @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0]))

    def bucket(key):
        return ((key * 0x9E3779B97F4A7C15) % 2**64 >> 40) % quality.BUCKETS

    def by_hand(text):
        words = text.split()
        words = words + [quality.REPEAT for a, b in zip(words, words[1:], strict=False) if a == b]
        found = []
        for w in words:
            found.append(bucket(zlib.crc32(w.encode())))
            code = [ord(c) + 1 for c in f"<{w}>"]
            for n in quality.GRAMS:
                for i in range(len(code) - n + 1):
                    key = n
                    for c in code[i : i + n]:
                        key = (key * 0x100000001B3 + c) % 2**64
                    found.append(bucket(key))
        logits = (vectors[found].mean(axis=0) if found else np.zeros(8)) @ layer + bias
        e = np.exp(logits - logits.max())
        return float((e / e.sum())[1])

    some = [(r.doc_id, r.text) for r in docs.where("n_chars < 2000").limit(60).collect()] + [(-1, None), (-2, "a"), (-3, "ab ab ab"), (-4, "日本 été 🙂 🙂"), (-5, " \t")]
    made = {r.doc_id: r.score for r in quality.score(spark.createDataFrame(some, "doc_id long, text string"), model).collect()}
    for i, text in some:
        assert made[i] == pytest.approx(by_hand(text or ""), rel=1e-9, abs=1e-12), text


def test_quality_edges(spark):
    rows = [(1, None), (2, ""), (3, " "), (4, "fine words"), (4, "fine words"), (None, "words"), (5, "word " * 200_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = quality.score(df, quality.train(df, spark.createDataFrame([], "doc_id long, quality int"))).collect()
    assert len(out) == 7 and {r.score for r in out} == {0.5}
    labels = spark.createDataFrame([(4, 1), (4, 0), (4, None), (1, 0), (None, 1), (99, 1), (2, 0)], "doc_id long, quality int")
    out = quality.score(df, quality.train(df, labels)).collect()
    assert len(out) == 7 and all(0 <= r.score <= 1 for r in out) and len({r.score for r in out if r.doc_id in (1, 2, 3)}) == 1
    assert quality.score(df.where("false"), quality.train(df, labels)).count() == 0


def ppm_counts(train, order):
    """One language's tree: how often each byte came after each context."""
    count = {}
    for t in train:
        data = b"\x00" * order + t.lower().encode()
        for i in range(order, len(data)):
            for k in range(order + 1):
                context = count.setdefault(data[i - k : i], {})
                context[data[i]] = context.get(data[i], 0) + 1
    return count


def ppm_bits(count, text, order):
    """Bits of a text: longest context first, escapes by method C, then 8 bits."""
    bits, data = 0.0, b"\x00" * order + text.lower().encode()
    for i in range(order, len(data)):
        for k in range(order, -1, -1):
            seen = count.get(data[i - k : i])
            if seen is None:
                continue
            total = sum(seen.values()) + len(seen)
            if data[i] in seen:
                bits -= math.log2(seen[data[i]] / total)
                break
            bits -= math.log2(len(seen) / total)
        else:
            bits += 8
    return bits


def test_code_lengths_by_hand():
    train = {"a": ["the cat sat on the mat", "a cat"], "b": ["le chat est là", "été"], "c": ["zzz"]}
    trees = language_id.ContextTrees(train, 3)
    texts = ["the mat", "le chat été", "zz", "", "qqq the", "\x00", "ÉTÉ"]
    bits, length = trees.code_lengths(texts)
    for i, t in enumerate(texts):
        for j, language in enumerate(trees.languages):
            assert bits[i, j] == pytest.approx(ppm_bits(ppm_counts(train[language], 3), t, 3)), (t, language)
    assert length.tolist() == [len(t.lower().encode()) for t in texts]


def test_language_on_held_out_rows(docs):
    out = language_id.identify(docs, language_id.train(docs)).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in out]) > 0.98 and all(0 <= r.score <= 1 for r in out)


def test_language_edges(spark):
    rows = [(1, "the cat sat", "en"), (2, "le chat", "fr"), (3, None, "en"), (4, "12 !?", "fr"), (8, "½ ² Ⅷ ٣ _", "fr"), (9, "ª", "fr"), (5, "", None), (6, "the cat", None), (None, "the cat", "en"), (6, "the cat", None), (7, "chat " * 100_000, None)]
    df = spark.createDataFrame([(*r, "x", 2.0, True) for r in rows], "doc_id long, text string, lang string, lang_pred string, score double, is_text boolean")
    out = {(r.doc_id, r.lang_pred) for r in language_id.identify(df, language_id.train(df)).collect()}
    assert {(3, "und"), (4, "und"), (5, "und"), (8, "und")} <= out and (9, "und") not in out
    assert language_id.identify(df.where("false"), language_id.train(df)).count() == 0
    none = language_id.identify(df, language_id.train(df.where("lang is null"))).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}


def test_language_sample_has_every_label(spark):
    """Few long documents, one huge among small ones, repeated rows, an empty label: no label with text is left without."""
    word = lambda a, n: " ".join(a[(i * i + i // 7) % len(a) :][:3] + a[i % len(a)] for i in range(n))
    rows = [(i, word("abcdefgh", 30_000 + i), "long") for i in range(1, 4)]
    rows += [(10, word("klmnopq", 100_000), "huge")] + [(100 + i, f"small text number {i} of this label", "huge") for i in range(200)]
    rows += [(5, "the same row again", "same")] * 3000 + [(400 + i, "", "empty") for i in range(5)] + [(7, None, "null")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language_id.sample(df, "lang", F.lit(True), 80_000, 20_000)
    assert set(found) == {"long", "huge", "same"}
    assert all(10_000 < sum(map(len, found[k])) <= 2 * 20_000 + language_id.PIECE for k in ("long", "huge"))
    assert 0 < sum(map(len, found["same"])) <= 2 * 20_000 + language_id.PIECE
    assert sum(t.startswith("small text") for t in found["huge"]) == 200
    trees = language_id.ContextTrees({"a": ["the cat"], "b": [], "c": [""]})
    assert trees.languages == ["a"]


def test_bounds_apply_to_every_length():
    """Clean prose of no kind that was learned stays at every length, noise and encoded data go at every length from a few words on."""
    import base64

    random = np.random.default_rng(4)
    syllables = "the and for ing tion er ou re st en al ca do mi so lu pe ra to ne vi".split()
    word = lambda: "".join(random.choice(syllables, random.integers(1, 4)))
    learned = [" ".join(word() for _ in range(200)) + "." for _ in range(300)]
    trees = language_id.ContextTrees({"a": learned[:270]})
    most = language_id.bounds(trees, learned[270:])
    judge = lambda texts: [c / max(n, 1) <= most[int(n).bit_length()] for c, n in zip(trees.code_lengths(texts)[0].min(axis=1), trees.code_lengths(texts)[1], strict=True)]
    prose = "A storm came over the hills at night, and by morning every road into the small town was under water. People waited on their roofs for the boats to come."
    sizes = [8, 20, 50, 99, 100, 101, 150, 600, 5000, 60_000]
    assert all(judge([(prose + " ") * 500][:1]) + judge([((prose + " ") * 500)[:n] for n in sizes]))
    for n in sizes[2:]:
        noise = ["".join(random.choice(list("qwzxkjvbnmghfpyu"), n)) for _ in range(20)] + [base64.b64encode(random.bytes(n)).decode()[:n] for _ in range(20)]
        assert not any(judge(noise)), n
    assert np.isinf(language_id.bounds(language_id.ContextTrees({}), ["x"])).all() and np.isinf(language_id.bounds(trees, [])).all()


PAGES = [
    ("<html><body><nav><a href=/>Home</a></nav><article><h1>Title</h1><p>First &amp; second\n  line.</p><p>Another paragraph, longer than the first.</p></article><footer>&copy; me</footer></body></html>", "Title\nFirst & second line.\nAnother paragraph, longer than the first."),
    ("<body><header><h1>Site</h1><ul class=menu><li><a href=/>A</a></ul></header><main><p>The text of the page is here, and it is long enough to read.</p><aside>Related: <a href=x>x</a></aside><form><label>Mail</label><input></form></main><section id=comments><p>First! This is a reader's comment, as long as the text itself is.</p></section></body>", "The text of the page is here, and it is long enough to read."),
    ("<article><p>One<script>var a='<p>no</p>'</script> two.</p><style>p{}</style><!-- <p>no</p> --><div class=\"ad\">Buy this now.</div><p>Three &lt;b&gt; &#233;&#x1F600;.</p></article>", "One two.\nThree <b> é😀."),
    ("<div class=cookie-notice>We use cookies.</div><article><h2>Head</h2><p>Body text with a <a href=x>link in it</a> goes on.<br>Next line.</article>", "Head\nBody text with a link in it goes on.\nNext line."),
    ("", ""),
    (None, ""),
    ("<nav>only a menu</nav>", ""),
    ("<article><p>cut <b", "cut"),
]


@pytest.mark.parametrize("page, text", PAGES)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


def test_pages_table(spark, sf_dir):
    import html
    import re

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    wanted = {}
    for r in pages.collect():
        inner = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        inner = re.sub(r"<div class=\"ad\">.*?</div>|<!--.*?-->|<script.*?</script>", "", inner, flags=re.S)
        parts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", x))).strip() for x in re.split(r"</?(?:p|h1|br|div|ul|li)\b[^>]*>", inner)]
        wanted[r.page_id] = "\n".join(p for p in parts if p)
    out = html_text.extract(pages.withColumn("text", pages.url)).collect()
    assert {r.page_id: r.text for r in out} == wanted and all(r.n_chars == len(r.text) for r in out)


def cut_cost(content, edges, keep):
    return sum(max(c, 0) if not k else max(-c, 0) for c, k in zip(content, keep, strict=True)) + sum(c for a, b, c in edges if keep[a] != keep[b])


def test_minimum_cut_over_all_labellings():
    random = np.random.default_rng(2)
    for _ in range(60):
        n = int(random.integers(1, 9))
        content = random.integers(-20, 20, n).tolist()
        edges = [(int(a), int(b), int(random.integers(1, 15))) for a, b in random.integers(0, n, (int(random.integers(0, 12)), 2)) if a != b]
        keep = html_text.minimum_cut(content, edges)
        best = min(cut_cost(content, edges, [m >> i & 1 == 1 for i in range(n)]) for m in range(1 << n))
        assert cut_cost(content, edges, keep) == best


def test_html_edges(spark):
    rows = [(1, "u", None), (None, None, "<p>x" * 20_000), (1, "u", None), (2, "u", "<" * 50_000), (3, "u", "<div>" * 3000 + "deep text, in many parts." + "</div>" * 10)]
    out = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert out.count() == 5 and out.where("text is null").count() == 0
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
