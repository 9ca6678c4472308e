"""Inputs that the test tables have few of."""

from __future__ import annotations

import numpy as np

from corpuswright.functions import markup, quality
from corpuswright.operators import dedup, tokens
from corpuswright.plans import storage


def test_repetition_of_texts_without_a_character(spark):
    rows = ["", " \n\t ", None, "a", "same line here\n" * 5]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, text string")
    assert [r.why for r in df.select("i", quality.gopher_repetition("text").alias("why")).orderBy("i").collect()] == ["blank", "blank", "blank", None, "dup_line_frac"]
    empty = df.where("i = 0").select(quality.repeated_parts("text").alias("p")).first().p
    assert (empty.dup_line_frac, empty.dup_line_char_frac, empty.dup_para_char_frac) == (0.0, None, None)


def test_references_without_a_semicolon_stay():
    assert markup.read("<title>a &amp; b&amp</title><p>AT&amp;T &copy 1 &notit; &amp;lt; &#65; &#x42; &eacute;&") == "\na & b&amp\n\nAT&T &copy 1 &notit; &lt; A B é&"


def test_held_values_stay_within_bounds():
    """a worker kept a million words, however long."""
    held = tokens.Held(len, most=10, chars=100)
    assert [held["x" * n] for n in range(1, 60)] == list(range(1, 60)) and len(held) <= 10 and sum(map(len, held)) <= 100
    encoder = tokens.MergeEncoder([("a", "b")], list)
    for i in range(300):
        assert encoder.pieces("ab" * 30_000 + str(i))[0][:2] == "ab"
    assert sum(map(len, encoder.seen)) <= tokens.HELD_CHARS


def test_words_are_analysed_once_and_ids_read_in_any_order():
    """F4, F8: every place of a word was analysed, and its ids read, anew."""
    asked = []
    made = tokens.Tokenizer([("a", "b")], ["▁ev", "ler"], lambda w: asked.append(w) or ([w[:2], w[2:]] if w == "evler" else [w]))
    text = "evler Evler EVLER eVler ab  evler x▁y İI"
    ids = made.encode(text, bos=True, eos=True)
    assert made.decode(ids) == made.decode(ids[1:-1]) == " ".join(text.split()) and made.encode(text, True, True) == ids
    assert len(asked) == len({"evler", "Evler", "EVLER", "ab", "İI"})
    broken = [made.piece_id["ler"], made.cap, made.boundary, made.boundary, made.byte_id["a"], made.upper, made.piece_id["ler"], made.cap]
    assert made.decode(broken) == made._decode(broken) and made.decode([]) == "" and made.decode(broken[3:5]) == "a"


def test_least_hashes_against_whole_numbers():
    h = np.array([0, 1, 5, dedup.PRIME - 1, dedup.PRIME, *range(7, 10**9, 10**7 + 1)], np.int64)
    rules = [*dedup.permutations(20), (dedup.PRIME - 1, dedup.PRIME - 1), (1, dedup.PRIME - 1), (1, 0)]
    factors, offsets = (np.array(x, np.int64) for x in zip(*rules, strict=True))
    assert dedup.least_hashes(h, factors, offsets).tolist() == [min((int(x) * a + b) % dedup.PRIME for x in h) for a, b in rules]
    assert len(dedup.shingle_hashes(" \n")) == 0 and len(dedup.shingle_hashes("é b\x1cc d e f é b c d e f")) == 6


def test_counted_words_are_one_row_each(spark, monkeypatch):
    """a row for every place of a word was exchanged and told from others."""
    monkeypatch.setattr(tokens, "HELD_WORDS", 3)
    df = spark.createDataFrame([("a b c d a I",), (None,), ("a İ e f g",)], "text string")
    assert {r.word: r.freq for r in tokens.word_table(df).collect()} == {"a": 3, "b": 1, "c": 1, "d": 1, "ı": 1, "i": 1, "e": 1, "f": 1, "g": 1}


def test_a_file_of_one_row_group_is_dealt_to_tasks(spark, tmp_path, monkeypatch):
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "one"))
    monkeypatch.setattr(storage, "TASK_BYTES", 500)
    df = spark.read.parquet(str(tmp_path / "one"))
    assert storage.spread(df).rdd.getNumPartitions() > 4 and storage.spread(df).count() == 1000
    monkeypatch.setattr(storage, "TASK_BYTES", 1 << 30)
    assert storage.spread(df).rdd.getNumPartitions() == df.rdd.getNumPartitions()
