"""Every stage against plain Python over its own input."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as cp
from corpuswright.llm import decontaminate, language_id, near_dup, packing, quality
from corpuswright.llm.common import fold
from tests.llm.test_models import ppm_bits, ppm_counts
from tests.llm.test_near_copies import kept_by_hand


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert [n for n, _ in cp.STAGES] == ["quality", "language", "near_duplicates", "decontamination", "packing"]
    now = docs
    for name, stage in cp.STAGES[:-1]:
        after = stage(spark, now, sf_dir).cache()
        assert after.columns == docs.columns and set(ids(after)) <= set(ids(now)) and after.count() > 0.8 * now.count()
        if name == "quality":
            # labels of the held-out fold were not learned from
            known = [i for i in ids(now) if i in labels and zlib.crc32(str(i).encode()) % 5 == 0]
            wrong = [i for i in known if (labels[i] == 1) != (i in set(ids(after)))]
            assert len(known) > 50 and len(wrong) <= 0.03 * len(known)
            scored = quality.score(now, quality.train(now, spark.read.parquet(f"{sf_dir}/labels.parquet")))
            assert ids(scored.where("predicted = 1")) == ids(after)
        elif name == "near_duplicates":
            assert ids(after) == kept_by_hand([(r.doc_id, r.text) for r in now.collect()])
        elif name == "decontamination":
            leaking = {r.doc_id for r in decontaminate.leaks(now, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
            assert leaking and ids(after) == [i for i in ids(now) if i not in leaking]
        now = after
    packed = cp.packing_stage(spark, now, sf_dir)
    # where documents are cut depends on how they are dealt to tasks; their tokens do not
    tokens = lambda df: sorted(map(tuple, df.groupBy("doc_id").agg(F.min("doc_tokens"), F.max("doc_tokens"), F.sum("length")).collect()))
    assert set(ids(packed)) == set(ids(now)) and tokens(packed) == tokens(packing.pack(now)) and all(a == b == c for _, a, b, c in tokens(packed))
    assert tokens(cp.run(spark, sf_dir)) == tokens(packed)


def test_odd_documents(spark, sf_dir):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, "123 456", "en", "s", 7), (4, "the cat sat on the mat and it was there", "en", "s", 39), (4, "the cat sat on the mat and it was there", "en", "s", 39), (None, "the dog ran to the house and back", "en", "s", 33), (5, "the sun is in the sky " * 30_000, "en", "s", 660_000)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, predicted int")
    for _, stage in cp.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
    docs = docs.collect()
    assert {r.doc_id for r in docs} <= {4, None, 5} and sum(r.doc_id == 4 for r in docs) == 1
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in cp.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0
    assert near_dup.one_of_each(empty).count() == 0


def test_language_stage_by_hand(spark, sf_dir):
    """What the stage keeps, from trees of Python dicts over the same sample; planted prose stays and planted junk goes."""
    random = np.random.default_rng(8)
    noise = ["".join(random.choice(list("qwzxkjvbnmghfpyu"), n)) for n in (40, 90, 110, 3000)]
    prose = "A storm came over the hills at night, and by morning every road was under water."
    planted = [(-1, None), (-2, "12 345"), (-3, "½"), *((-10 - i, t) for i, t in enumerate(noise)), (-20, prose), (-21, prose * 30), (-22, "Hello there")]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("n_chars < 1500")
    docs = docs.unionByName(spark.createDataFrame([(i, t, None, "planted", len(t or "")) for i, t in planted], "doc_id long, text string, lang string, source string, n_chars long"))
    some = language_id.sample(docs, "lang", fold("doc_id", 5) != 0, language_id.SAMPLE_BYTES, language_id.LANGUAGE_BYTES)
    trees = {k: ppm_counts([t for i, t in enumerate(texts) if i % 10 != 9], language_id.ORDER) for k, texts in some.items()}
    most = language_id.calibrated(docs)[1]
    wanted = []
    for r in docs.collect():
        text = r.text or ""
        n = len(text.lower().encode())
        cost = {k: ppm_bits(count, text, language_id.ORDER) for k, count in sorted(trees.items())}
        best = min(cost, key=cost.get)
        if any(c.isalpha() for c in text) and cost[best] / n <= most[n.bit_length()] + 1e-9:
            wanted.append((r.doc_id, r.lang or best))
    kept = cp.language_stage(spark, docs, sf_dir)
    assert sorted((r.doc_id, r.lang) for r in kept.collect()) == sorted(wanted)
    left = {i for i, _ in wanted}
    assert left & {i for i, _ in planted} == {-20, -21, -22}
    assert kept.where(F.col("lang").isNull()).isEmpty()


def test_wanted_languages(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(cp, "LANGUAGES", ("fr", "de"))
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = cp.language_stage(spark, docs, sf_dir).groupBy("lang").count().collect()
    total = sum(r["count"] for r in kept)
    assert sum(r["count"] for r in kept if r.lang in ("fr", "de")) > 0.98 * total > 0.9 * docs.where("lang in ('fr', 'de')").count()
