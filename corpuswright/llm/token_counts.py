"""Token counts without tokens: a count-only Viterbi search over a unigram vocabulary.

An Aho-Corasick automaton lists every vocabulary piece that occurs in a text; dynamic programming over character
positions carries only the best score and the number of pieces that reach it. Nothing is traced back.

The tokenizer is the unigram model of the ``tokenizers`` library over the pieces and scores of a vocabulary file, with
its Metaspace rule (a space becomes ``\\u2581``, one is put in front, and each starts a word) and byte fallback. Its tie
rule: at a position, among paths of equal score the one whose last piece starts first wins. A character that no piece
of one character covers may be passed at the lowest score less ten, and counts as its UTF-8 bytes. Words are
independent of each other, so each distinct word is searched once per worker.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuswright.llm.common import WordCache, batches, map_arrow

MARK = "▁"
#: Longer words are searched one by one, so that the stepwise search takes few steps.
LONG_WORD = 256
WORDS_AT_ONCE = 40_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def load_pieces(path: str) -> list[tuple[str, float]]:
    """The pieces that may match text, with scores: all but control and unknown symbols."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i))]


class UnigramCounter:
    """Counts pieces of words under a unigram vocabulary."""

    SEP = "\x00"

    def __init__(self, pieces: list[tuple[str, float]]) -> None:
        import ahocorasick

        self.score = np.array([s for _, s in pieces], dtype=np.float64)
        self.length = np.array([len(p) for p, _ in pieces], dtype=np.int64)
        self.unknown = float(self.score.min()) - 10.0
        self.longest = int(self.length.max())
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, (piece, _) in enumerate(pieces):
            if not piece or self.SEP in piece:
                raise ValueError("a piece is empty or holds the separator")
            self.automaton.add_word(piece, i)
        self.automaton.make_automaton()

    def single(self, word: str) -> int:
        """One word, match by match as the automaton lists them (by end, the longest first); holds as many positions as the
        longest piece has characters."""
        ring = self.longest + 1
        best, count = [0.0] * ring, [0] * ring
        done = 0
        length, score, unknown = self.length, self.score, self.unknown

        def pass_over(at: int) -> None:
            """The character before ``at`` by itself, if no piece of it was found and nothing better reaches ``at``."""
            here = best[(at - 1) % ring] + unknown
            if not reached or here > best[at % ring]:
                best[at % ring], count[at % ring] = here, count[(at - 1) % ring] + len(word[at - 1].encode("utf-8", "surrogatepass"))

        reached = bare = True
        for last, piece in self.automaton.iter(word):
            while done <= last:
                # ``done`` is the position that the matches read so far end at
                if done and bare:
                    pass_over(done)
                done += 1
                reached, bare = False, True
            size = int(length[piece])
            here = best[(done - size) % ring] + score[piece]
            bare &= size != 1
            if not reached or here > best[done % ring]:
                best[done % ring], count[done % ring] = here, count[(done - size) % ring] + 1
                reached = True
        while done <= len(word):
            if done and bare:
                pass_over(done)
            done += 1
            reached, bare = False, True
        return count[len(word) % ring]

    def counts(self, words: list[str]) -> list[int]:
        """Pieces of each word (without its leading mark)."""
        out = [0] * len(words)
        short = [i for i, w in enumerate(words) if len(w) < LONG_WORD and self.SEP not in w]
        for at in range(0, len(short), WORDS_AT_ONCE):
            some = short[at : at + WORDS_AT_ONCE]
            for i, n in zip(some, self._stepwise([MARK + words[i] for i in some]).tolist(), strict=True):
                out[i] = n
        for i in set(range(len(words))).difference(short):
            out[i] = self.single(MARK + words[i])
        return out

    def _stepwise(self, words: list[str]) -> np.ndarray:
        """All words at once, one character position after another."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        begins = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
        text = self.SEP.join(words)
        found = np.fromiter(chain.from_iterable(self.automaton.iter(text)), np.int64).reshape(-1, 2)
        end, piece = found[:, 0] + 1, found[:, 1]
        size, score = self.length[piece], self.score[piece]
        # characters that no piece of one character covers
        bare = np.ones(len(text), dtype=bool)
        bare[end[size == 1] - 1] = False
        code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        bare[code == 0] = False
        extra = np.flatnonzero(bare)
        width = 1 + (code[extra] > 0x7F) + (code[extra] > 0x7FF).astype(np.int64) + (code[extra] > 0xFFFF)
        end = np.concatenate((end, extra + 1))
        size = np.concatenate((size, np.ones(len(extra), np.int64)))
        score = np.concatenate((score, np.full(len(extra), self.unknown)))
        adds = np.concatenate((np.ones(len(piece), np.int64), width))
        of = np.searchsorted(begins, end - 1, side="right") - 1
        order = np.lexsort((-size, end, end - begins[of]))
        end, size, score, adds = end[order], size[order], score[order], adds[order]
        depth = end - begins[of[order]]
        best, count = np.zeros(len(text) + 2), np.zeros(len(text) + 2, dtype=np.int64)
        cuts = np.searchsorted(depth, np.arange(1, int(lengths.max()) + 2))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if a == b:
                continue
            to, source = end[a:b], end[a:b] - size[a:b]
            reach = best[source] + score[a:b]
            heads = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1])))
            top = np.maximum.reduceat(reach, heads)
            group = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, b - a)))
            hits = np.flatnonzero(reach == top[group])
            first = hits[np.concatenate(([True], np.diff(group[hits]) > 0))]
            best[to[heads]] = top
            count[to[heads]] = count[source[first]] + adds[a:b][first]
        return count[begins + lengths]


def words_of(text: str) -> list[str]:
    """Words without their leading marks; the empty text has none."""
    if not text:
        return []
    words = text.replace(MARK, " ").split(" ")
    return words[1:] if text[0] in (" ", MARK) else words


@cache
def counter(path: str) -> UnigramCounter:
    return UnigramCounter(load_pieces(path))


@cache
def cached(path: str) -> WordCache:
    return WordCache(counter(path).counts)


def token_counts(df: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_chars, n_words, n_tokens)`` for every row, over the whole text.

    Null and empty texts have zero of each; repeated rows and null ids are kept as they are; other columns are not read.
    Narrow: no shuffle, one row in, one row out.
    """
    path = vocabulary or default_vocabulary()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = cached(path)
        for batch, texts in batches(it):
            words = [words_of(t) for t in texts]
            get = known.learn(words).__getitem__
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(map(len, texts), pa.int64()), pa.array(map(len, words), pa.int64()), pa.array([sum(map(get, w)) for w in words], pa.int64())],
                names=["doc_id", "n_chars", "n_words", "n_tokens"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    narrow = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_arrow(narrow, run, f"doc_id {kind}, n_chars bigint, n_words bigint, n_tokens bigint")
