"""Column functions against values worked out by hand."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpuswright.functions import pii, quality, text


def values(spark, rows, *columns):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, x string")
    return [tuple(r)[1:] for r in df.select("i", *[c.alias(f"c{k}") for k, c in enumerate(columns)]).orderBy("i").collect()]


def test_casing(spark):
    rows = ["ISPARTA İzmir", "ılık iğne", "KISA", "İ", "", None]
    found = values(spark, rows, text.turkish_lower("x"), text.turkish_upper("x"), text.turkish_title("x"))
    assert found == [("ısparta izmir", "ISPARTA İZMİR", "Isparta izmir"), ("ılık iğne", "ILIK İĞNE", "Ilık iğne"), ("kısa", "KISA", "Kısa"), ("i", "İ", "İ"), ("", "", ""), (None, None, None)]


def test_normalize(spark):
    rows = ["a​b­c﻿", "x \t  y", "a  \n\n\n\n b", "é", "  Kept CASE \r\n", None, ""]
    found = [r[0] for r in values(spark, rows, text.normalize("x"))]
    assert found == ["abc", "x y", "a\n\n b", "é", "Kept CASE", None, ""]
    again = [r[0] for r in values(spark, found, text.normalize("x"))]
    assert again == found


def test_words_names_and_urls(spark):
    assert [r[0] for r in values(spark, ["a b c\x1cd", "", None, " \n"], text.word_count("x"))] == [4, 0, 0, 0]
    assert [r[0] for r in values(spark, ["../a b?.pdf", "...", "x" * 300], text.safe_filename("x"))] == ["_a_b_.pdf", "file", "x" * 240]
    urls = ["https://ex.org/a", "http://localhost/", "ftp://ex.org", "http://10.0.0.1/x", "http://172.20.1.1", "http://169.254.169.254/", None, "https://u@EX.org:8/"]
    assert [r[0] for r in values(spark, urls, text.is_safe_url("x"))] == [True, False, False, False, False, False, False, True]
    assert [r[0] for r in values(spark, urls[:2], text.is_safe_url("x", ("other.org",)))] == [False, False]
    assert values(spark, ["<title> A\n b </title>", "<p>"], text.html_title("x")) == [("A b",), (None,)]
    assert values(spark, ["<p>One &amp; two</p><script>x</script><div>three</div>"], text.html_text("x")) == [("One & two\nthree",)]


GOOD_ID, GOOD_IBAN = "10000000146", "TR330006100519786457841326"


def test_checksums(spark):
    ids = [GOOD_ID, "10000000147", "01234567890", "123", "1000000014x", None]
    assert [r[0] for r in values(spark, ids, pii.is_national_id("x"))] == [True, False, False, False, False, False]
    ibans = [GOOD_IBAN, "TR33 0006 1005 1978 6457 8413 26", "tr33-0006-1005-1978-6457-8413-26", "TR340006100519786457841326", "TR33", None]
    assert [r[0] for r in values(spark, ibans, pii.is_iban("x"))] == [True, True, True, False, False, False]


@pytest.mark.parametrize("plate", [False, True])
def test_redaction(spark, plate):
    rows = {
        f"hesap{GOOD_IBAN}, tel 0532 123 45 67, kimlik {GOOD_ID}.": ("hesap<IBAN>, tel <TELEFON>, kimlik <TC_KIMLIK>.", {"iban": 1, "phone": 1, "tc_kimlik": 1}),
        "fatura 12345678901 ve 1234567890": ("fatura 12345678901 ve 1234567890", {}),
        "34 ABC 123": ("<PLAKA>" if plate else "34 ABC 123", {"plate": 1} if plate else {}),
        "+90 (212) 345 67 89 / 5321234567": ("<TELEFON> / <TELEFON>", {"phone": 2}),
        f"{GOOD_ID}{GOOD_ID} 0{GOOD_ID}": (f"{GOOD_ID}{GOOD_ID} 0{GOOD_ID}", {}),
        "": ("", {}),
    }
    df = spark.createDataFrame([(t, "kept") for t in rows], "text string, pii_more string")
    found = {tuple(r)[0]: r for r in pii.redact(df.withColumn("raw", F.col("text")), plate=plate).select("raw", "text", "pii", "pii_more").collect()}
    assert {k: (r.text, r.pii) for k, r in found.items()} == rows
    none = pii.redact(spark.createDataFrame([(None,)], "text string")).first()
    assert none.text is None and not none.pii
    assert values(spark, ["a.b@c.org at 10.1.2.3, 999.1.1.1"], pii.redact_addresses("x")) == [(f"{pii.EMAIL} at {pii.IP}, 999.1.1.1",)]


def test_redaction_after_normalising(spark):
    hidden = GOOD_ID[:5] + "­" + GOOD_ID[5:]
    df = spark.createDataFrame([(hidden,)], "text string")
    assert pii.redact(df).first().text == hidden
    assert pii.redact(df.withColumn("text", text.normalize("text"))).first().text == "<TC_KIMLIK>"


def test_metrics(spark):
    found = values(spark, ["ab # c… d...", "1 2 x", " ", None], quality.metrics("x"))
    m = found[0][0]
    assert (m.n_words, m.symbol_word_ratio, m.non_alpha_words_ratio, m.mean_word_length) == (4, 0.75, 0.25, 9 / 4)
    assert found[1][0].non_alpha_words_ratio == pytest.approx(2 / 3) and found[2][0] is None and found[3][0] is None


def test_filters(spark):
    limits = quality.Thresholds(min_doc_words=3, min_avg_word_length=2, max_avg_word_length=8, stop_words=("ve", "bir"), min_stop_words=1)
    rows = ["iki kelime", "güzel ve uzun bir gün", "a b c d ve", "# # # ve uzun bir güzel", "- ve bir\n- ve bir\n- ve bir", "ve güzel gün...\nve güzel gün…", "ve 12 34 56 abc", "hiçbir durak kelimesi yok", ""]
    assert [r[0] for r in values(spark, rows, quality.gopher_quality("x", limits))] == ["too_few_words", None, "words_too_short", "symbols", "bullets", "symbols", "letters", "stop_words", "blank"]
    for bad in ({"min_doc_words": 9, "max_doc_words": 3}, {"max_symbol_word_ratio": 1.5}, {"alpha_rule": "x"}):
        with pytest.raises(ValueError):
            quality.Thresholds(**bad)
    long = "This sentence is long enough to be a line of its own."
    assert [r[0] for r in values(spark, [long, "no end here but quite long as a line", "Short.\n" * 3, f"{long}\n{long}"], quality.fineweb_quality("x"))] == [None, "line_ends", "short_lines", "repeated_lines"]
    assert [r[0] for r in values(spark, ["one two three four", "same line here\n" * 5, "yes no " * 40], quality.gopher_repetition("x"))] == [None, "dup_line_frac", "top_2_gram"]
    assert quality.gram_shares("a b a b")[0] == 6 / 7 and quality.gram_shares("a b c d e a b c d e")[3] == 5 / 19


def test_language_gate(spark):
    rows = [("the cat and the dog", "en"), ("der Hund und die Katze", None), ("the cat and the dog", None), (None, None), ("", "fr")]
    df = spark.createDataFrame(rows, "x string, lang string")
    assert [r[0] for r in df.select(quality.language_gate("x", ("en",), known=F.col("lang"))).collect()] == [True, False, True, False, False]


def test_text_of_markup_by_a_parser(spark):
    from corpuswright.functions import markup

    pages = [
        ("<head><title>T</title><p>no</head><p>one<p>two &eacute;&#233;&#x1F600; &nbsp;&lt;b&gt;</p><script>if (a < b) '<p>'</script>three", "one\ntwo éé😀 <b>\nthree"),
        ("<head><style>p{}</style><body><template><p>no</template><td>a<td>b", "a\nb"),
        ("<p>cut <a href='x", "cut"),
        ("text <!-- no --> more", "text more"),
        ("<noscript>no <b>no</b></noscript><noscript>no", ""),
        ("", ""),
        (None, None),
    ]
    df = spark.createDataFrame([(i, p) for i, (p, _) in enumerate(pages)], "i int, html string")
    assert [r.t for r in df.select("i", markup.html_text("html").alias("t")).orderBy("i").collect()] == [t for _, t in pages]


def test_addresses_of_six_groups(spark):
    rows = [("2001:db8::1", 1), ("fe80::1:2 and ::1", 2), ("1:2:3:4:5:6:7:8", 1), ("::ffff:10.0.0.1", 1), ("at 10:20:30", 0), ("std::vector", 0), ("a::b::c", 0), ("::", 0)]
    df = spark.createDataFrame(rows, "t string, n int")
    assert all(r.u.count(pii.IP) == r.n for r in df.select("n", pii.redact_addresses("t").alias("u")).collect())
