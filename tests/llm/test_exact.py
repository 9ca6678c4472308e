"""Operators with an exact plain version: packing, token counts, chat, fingerprints."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from corpuswright.llm import chat, fingerprints, packing, token_counts


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    odd = [(None, "null id"), (-5, None), (-6, ""), (-7, "İstanbul ﬁ ½ ́x <|endoftext|> <|startoftext|> don't 12,345 snake_case    ż 日本語 🙂🙂"), (-7, "twin"), (-8, " \n\t "), (-9, "ab " * 30_000), (-10, "x" * 5000)]
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string")).repartition(3)


def test_packing(spark, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    rows = packing.pack(docs.withColumn("ids", docs.text), with_ids=True).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id, r.doc_tokens].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) and len(r.ids) == r.length
    made = sorted(([i for r in sorted(some, key=lambda r: r.start) for i in r.ids] for some in pieces.values()), key=str)
    twins = docs.groupBy("doc_id").count().where("count > 1").count()
    assert twins == 1
    wanted = sorted(([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in (r.text for r in docs.collect())), key=str)
    assert made == wanted
    for some in pieces.values():
        at = 0
        for r in sorted(some, key=lambda r: r.start):
            assert r.start == at
            at += r.length
        assert at == some[0].doc_tokens
    for some in sequences.values():
        at = 0
        for offset, length in sorted(some):
            assert offset == at
            at += length
        assert at <= 4096 and at & (at - 1) == 0
    tasks = 3
    assert len(rows) < docs.count() + 2 * sum(r.length for r in rows) / 4096 + 140 * tasks
    full = sum(sum(x for _, x in s) == 4096 for s in sequences.values())
    assert full > 0.8 * sum(r.length for r in rows) / 4096
    assert packing.pack(docs.where("false")).count() == 0


def dealt(packer, sizes):
    """All placed pieces of documents of so many tokens, as (document, start, size, sequence, offset)."""
    placed = [p for i, n in enumerate(sizes) for p in packer.add(i, b"abcd" * n)]
    return [(d, s, len(ids) // 4, q, o) for d, s, ids, q, o in placed], [(d, s, len(ids) // 4, q, o) for d, s, ids, q, o in packer.rest()]


def test_harmonic_classes():
    # two of a class, and the head of a third; its tail is of another class
    closed, rest = dealt(packing.HarmonicPacker(16, 100), [6, 7, 7, 40, 16])
    assert closed == [(0, 0, 6, 100, 0), (1, 0, 7, 100, 6), (2, 0, 3, 100, 13), (3, 0, 16, 101, 0), (3, 16, 16, 102, 0), (4, 0, 16, 103, 0)]
    assert rest == [(3, 32, 8, 104, 0), (2, 3, 4, 105, 0)]
    # pieces that fit exactly need no filler
    closed, rest = dealt(packing.HarmonicPacker(16, 0), [4, 4, 4, 4, 8, 8])
    assert closed == [(0, 0, 4, 0, 0), (1, 0, 4, 0, 4), (2, 0, 4, 0, 8), (3, 0, 4, 0, 12), (4, 0, 8, 1, 0), (5, 0, 8, 1, 8)] and rest == []
    with pytest.raises(ValueError):
        packing.HarmonicPacker(12, 0)


def test_harmonic_bins_hold_their_count_of_their_class():
    random = np.random.default_rng(4)
    sizes = np.exp(random.uniform(0, 9.2, 5000)).astype(int).tolist()
    packer = packing.HarmonicPacker(4096, 0)
    closed, rest = dealt(packer, sizes)
    bins = defaultdict(list)
    for piece in closed:
        bins[piece[3]].append(piece)
    for some in bins.values():
        assert [p[4] for p in some] == np.cumsum([0, *(p[2] for p in some)]).tolist()[:-1] and sum(p[2] for p in some) == 4096
        kind = 4096 // some[0][2]
        assert all(4096 // p[2] == kind for p in some[:kind]) and len(some) <= kind + 1
    assert sum(p[2] for p in closed + rest) == sum(sizes)
    # whole bins, one cut a bin, and the end of the task
    assert len(closed + rest) <= len(sizes) + 2 * sum(sizes) // 4096 + 140
    assert all(n & (n - 1) == 0 for n in np.bincount([p[3] - packer.next + 200 for p in rest], [p[2] for p in rest]).astype(int).tolist() if n)


def test_token_counts_equal_the_tokenizer(docs):
    from tokenizers import Tokenizer, decoders, models, pre_tokenizers

    pieces = token_counts.load_pieces(token_counts.default_vocabulary())
    vocabulary = [("<unk>", 0.0), *pieces]
    low = min(s for _, s in pieces)
    tokenizer = Tokenizer(models.Unigram([("<unk>", low), *pieces], 0, byte_fallback=True))
    tokenizer.pre_tokenizer, tokenizer.decoder = pre_tokenizers.Metaspace(), decoders.Metaspace()
    assert len(vocabulary) > 30_000
    texts = {(r.doc_id, r.text) for r in docs.collect()}
    wanted = sorted((i, len(t or ""), len(tokenizer.encode(t, add_special_tokens=False).ids) if t else 0) for i, t in texts if i is not None)
    found = sorted(tuple(r) for r in token_counts.token_counts(docs).where("doc_id is not null").select("doc_id", "n_chars", "n_tokens").collect())
    assert found == wanted
    assert token_counts.token_counts(docs.where("false")).count() == 0


def viterbi_by_hand(pieces, word):
    """Every position, every piece: the best score, of equals the piece that starts first."""
    table, low = dict(pieces), min(s for _, s in pieces) - 10.0
    best, count = [0.0], [0]
    for end in range(1, len(word) + 1):
        found = [(best[start] + table[word[start:end]], -start, count[start] + 1) for start in range(end) if word[start:end] in table]
        if word[end - 1] not in table:
            found.append((best[end - 1] + low, -(end - 1), count[end - 1] + len(word[end - 1].encode())))
        top = max(found)
        best.append(top[0]), count.append(top[2])
    return count[-1]


PIECES = [("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("aba", -3.0), ("▁a", -2.0), ("ba", -2.0), ("bab", -2.5), ("xyz", -1.5)]


def test_searches_agree_with_the_plain_one():
    counter = token_counts.UnigramCounter(PIECES)
    words = ["", "a", "ab", "aba", "abab", "babab", "abcab", "zé", "ab" * 40, "b" * 7, "xyz", "xy", "zxyzy", "\x00a", "🙂b"]
    random = np.random.default_rng(8)
    words += ["".join(random.choice(list("aabbxyzé"), random.integers(1, 30))) for _ in range(300)]
    wanted = [viterbi_by_hand(PIECES, "▁" + w) for w in words]
    assert counter.counts(words) == wanted
    assert [counter.single("▁" + w) for w in words] == wanted
    long = ["".join(random.choice(list("abxyz"), n)) for n in (255, 256, 257, 900)]
    assert counter.counts(long) == [viterbi_by_hand(PIECES, "▁" + w) for w in long]


def test_long_words_go_through_the_automaton():
    counter = token_counts.UnigramCounter(PIECES)
    assert not hasattr(counter, "table")
    read = []

    class Watched:
        def __init__(self, automaton):
            self.automaton = automaton

        def iter(self, text):
            read.append(len(text))
            return self.automaton.iter(text)

    counter.automaton = Watched(counter.automaton)
    assert counter.counts(["ab" * 5000]) == [viterbi_by_hand(PIECES, "▁" + "ab" * 5000)] and read == [10_001]


def test_words_are_held_within_bounds():
    from corpuswright.llm.common import WordCache

    calls = []
    cache = WordCache(lambda some: calls.append(len(some)) or [len(w) for w in some], limit=10, chars=100)
    for i in range(30):
        got = cache.learn([[f"{i}" * 30, "a", "b"]])
        assert got["a"] == 1 and cache.held <= 100 and len(cache.of) <= 10
    assert cache.learn([["x" * 1000, "y"]])["x" * 1000] == 1000 and cache.learn([["z"]])["z"] == 1 and cache.held == 1


def test_columns_of_the_same_names_are_not_read(spark):
    docs = spark.createDataFrame([(1, "a b", 9, "x", 5), (2, None, 8, None, None)], "doc_id long, text string, n_tokens int, n_words string, n_chars int")
    assert sorted(map(tuple, token_counts.token_counts(docs).select("doc_id", "n_chars", "n_words").collect())) == [(1, 3, 2), (2, 0, 0)]


def turns_of(spark, sf_dir):
    odd = [(-1, 0, "user", chat.END + chat.START + "assistant ok"), (-1, 1, "assistant", chat.END + chat.START + "assistant ok"), (-2, 3, "assistant", None), (-2, 1, None, "x\\n<\\|"), (-2, None, "system", ""), (-2, 1, None, "x\\n<\\|"), (None, 1, "user", "q"), (None, 2, "assistant", "a"), (-3, 1, "role\nwith <| feed", "back\\slash")]
    odd += [(-4, i, ("user", "assistant")[i % 2], f"turn {i} " + "word " * (i % 90)) for i in range(1500)]
    odd += [(-5, 0, "system", "be brief"), *((-5, i, ("assistant", "user")[i % 2], "long words " * 700) for i in range(1, 6))]
    return spark.read.parquet(f"{sf_dir}/conversations.parquet").unionByName(spark.createDataFrame(odd, "conv_id long, turn long, role string, text string"))


def test_chat_digests(spark, sf_dir):
    turns = turns_of(spark, sf_dir)
    by = defaultdict(list)
    for r in turns.collect():
        by[r.conv_id].append((r.turn is not None, r.turn or 0, r.role or "", r.text or ""))
    wanted = {}
    for conv, some in by.items():
        some.sort()
        said = "".join(t for *_, role, t in some if role == "assistant")
        wanted[conv] = (len(some), hashlib.sha256("".join(f"{r}\n{t}\n" for *_, r, t in some).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    made = chat.windows(turns.withColumn("window", turns.text))
    found = {r[0]: tuple(r)[1:5] for r in chat.digests(made).collect()}
    assert found == wanted
    total = {r[0]: r[1] for r in made.groupBy("conv_id").agg({"text": "sum"}).limit(0).collect()}
    assert total == {}
    sizes = defaultdict(int)
    for r in made.collect():
        sizes[r.conv_id] += len(r.text)
        assert r.n_tokens <= chat.BUDGET or (r.n_turns == 1 and r.n_repeated <= 1)
        assert r.n_tokens == chat.default_counter()([r.text])[0]
        if r.window and r.conv_id == -5:
            assert chat.parse(r.text)[0] == ("system", "be brief")
    assert {r.conv_id: r.formatted_chars for r in chat.digests(made).collect()} == sizes
    assert chat.digests(chat.windows(turns.where("false"))).count() == 0


def test_chat_history_is_repeated_and_masked(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"t{i}") for i in range(9)]
    made = chat.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), budget=60, history_turns=1, history_tokens=20).orderBy("window").collect()
    assert len(made) > 2 and all(r.n_repeated == 1 for r in made[1:])
    spoken = [chat.unescape(r.text[s.start : s.end]) for r in made for s in r.loss]
    assert spoken == ["t1", "t3", "t5", "t7"]


def windows_by_hand(turns, budget, history_turns, history_tokens):
    """(repeated turns, turns of the span) of every window, by trying every span and every history from the longest down."""
    out, at = [], 0
    size = lambda some: sum(turns[i][1] for i in some)
    while at < len(turns):
        system = [0] if turns[0][0] == "system" and at else []
        own = [i for i in range(max(0, at - history_turns - bool(system)), at) if i not in system][-history_turns:] if history_turns else []
        while own and (size(own) > history_tokens or size([*system, *own, at]) > budget):
            own = own[1:]
        end = len(turns)
        while end > at + 1 and size([*system, *own, *range(at, end)]) > budget:
            end -= 1
        out.append((system + own, list(range(at, end))))
        at = end
    return out


def test_windows_by_hand():
    random = np.random.default_rng(6)
    cases = [([("user", 300), ("assistant", 200), ("user", 1600)], 2048, 2, 512), ([("system", 300), ("assistant", 200), ("user", 1800)], 2048, 2, 512), ([("user", 5)] * 1500, 1_000_000, 2, 512)]
    for _ in range(200):
        n = int(random.integers(1, 40))
        roles = ["system" if random.random() < 0.5 else "user", *random.choice(["user", "assistant", "system"], n - 1).tolist()]
        cases.append((list(zip(roles, random.integers(1, random.choice([5, 30, 120]), n).tolist(), strict=True)), int(random.integers(20, 100)), int(random.integers(0, 4)), int(random.integers(0, 60))))
    for turns, *limits in cases:
        writer, made = chat.Windows(*limits), []
        for i, (role, tokens) in enumerate(turns):
            made += writer.add(role, str(i), tokens)
        made += writer.rest()
        found = []
        for _, text, mask, repeated, own, tokens in made:
            said = [int(t) for _, t in chat.parse(text)]
            assert len(said) == repeated + own and tokens == sum(turns[i][1] for i in said) and len(mask) == sum(turns[i][0] == "assistant" for i in said[repeated:])
            assert tokens <= limits[0] or (own == 1 and repeated == (turns[0][0] == "system" and said[-1] > 0))
            found.append((said[:repeated], said[repeated:]))
        assert found == windows_by_hand(turns, *limits), (turns, limits)


def test_windows_of_many_turns_take_linear_time():
    import time

    began = time.process_time()
    for budget in (2048, 10_000_000):
        writer = chat.Windows(budget, 2, 512)
        assert sum(own for i in range(200_000) for *_, own, _ in writer.add("user", "x", 5)) + sum(own for *_, own, _ in writer.rest()) == 200_000
    assert time.process_time() - began < 20


def lz78(text):
    seen, phrase = set(), ""
    for c in text:
        phrase += c
        if phrase not in seen:
            seen.add(phrase)
            phrase = ""
    return seen


def test_fingerprints(spark, docs):
    docs = docs.where("doc_id is not null").withColumn("near_next", docs.text)
    rows = sorted((r.doc_id, r.text or "") for r in docs.collect())
    found = {}
    for r in fingerprints.fingerprints(docs).collect():
        found.setdefault(r.doc_id, []).append(tuple(r)[1:])
    wanted = defaultdict(list)
    for (doc, text), (_, after) in zip(rows, [*rows[1:], rows[0]], strict=True):
        k = len(text) // 4
        edited = text[: len(text) - k] + after[:k]
        a, b, c = (fingerprints.fingerprint(t) for t in (text, edited, after))
        agree = lambda x, y: sum(x[4 * i : 4 * i + 4] == y[4 * i : 4 * i + 4] for i in range(fingerprints.PLACES)) / fingerprints.PLACES
        like = lambda x, y, p, q: agree(x, y) if p and q else float(not p and not q)
        wanted[doc].append((len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b, like(a, b, text, edited), like(a, c, text, after)))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in wanted.items()}
    assert fingerprints.fingerprints(docs.where("false")).count() == 0
    alone = fingerprints.fingerprints(spark.createDataFrame([(1, "abcdefgh")], "doc_id int, text string")).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and alone.near_next == 1.0


def test_phrases_and_likeness():
    text = "the cat sat on the mat and the dog sat on the log " * 3
    assert set(fingerprints.Parse(text, 40).phrases) == lz78(text)
    phrases = lambda t: lz78(t)
    other = text[:100] + "quite another ending of it all, with new words"
    true = len(phrases(text) & phrases(other)) / len(phrases(text) | phrases(other))
    a, b = (np.frombuffer(bytes.fromhex(fingerprints.fingerprint(t)), ">u2") for t in (text, other))
    assert abs(fingerprints.likeness(a, b, False, False) - true) < 0.25
