"""Harmonic packing of token sequences, with no shuffle.

A bin holds ``capacity`` tokens. Documents are cut into whole bins first. What is left of one, ``n`` tokens, is of class ``k``
if ``capacity / (k + 1) < n <= capacity / k``, and a bin of class ``k`` takes exactly ``k`` pieces of its class. What they
leave free is less than any piece of the class, so the head of the next such piece fills it exactly; the tail of that piece
is classed anew by its own length. So there is a cut for each bin at most, and a full bin has no padding.

Each task fills the bins of its own rows and knows nothing of other tasks. What its open bins hold in the end (less than
one bin for each of some ``2 * sqrt(capacity)`` classes) is run together into full bins, and the last of these is cut into
sequences whose lengths are powers of two, which are not padded: over any input, padding is zero.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuswright.llm.common import WordCache, batches, map_arrow

CAPACITY = 4096
END_ID = 2
#: No combining marks, white space or control characters, nor the letter whose lower case is two characters: here lower case
#: and canonical composition work character by character, whatever the Unicode version.
_SIMPLE = re.compile("[!-~\u00a1-\u012f\u0131-\u024f]+").fullmatch
#: The same, with spaces and line feeds.
_PLAIN = re.compile("[ \n!-~\u00a1-\u012f\u0131-\u024f]*").fullmatch


def _of_category(kind: str) -> str:
    """The characters of simple words, in lower case, that are of a Unicode category; some of these lie beyond the simple ones."""
    chars = {chr(c).lower() for c in range(0x21, 0x250) if _SIMPLE(chr(c))}
    return "".join(sorted(re.escape(c) for c in chars if unicodedata.category(c)[0] == kind))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Ids of the ``tokenizers`` library for whole texts, encoding each distinct part of a word once.

    The tokenizer drops white space and no token spans it, so the ids of a text are those of its words (split at spaces and
    line feeds only) one after another. Likewise no token spans two of the parts that its pre-tokenizer makes of a word. Texts
    of Latin letters and signs are cut into these parts at once, others word by word.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        setting = json.loads(Path(path).read_text(encoding="utf-8"))
        pattern = setting["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # over simple words in lower case, listed characters are the same as categories, and ``re`` is faster
        listed = pattern.replace(r"\p{L}", _of_category("L")).replace(r"\p{N}", _of_category("N"))
        self.find = (regex if "\\p" in listed.lower() else re).compile(listed).findall
        # for parts, which are normalised and found already
        spaces = {"type": "WhitespaceSplit"}
        setting |= {"normalizer": None, "added_tokens": [], "pre_tokenizer": {"type": "Sequence", "pretokenizers": [spaces, *setting["pre_tokenizer"]["pretokenizers"][1:]]}}
        self.plain = Tokenizer.from_str(json.dumps(setting))
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.parts = WordCache(self._encode_parts)
        self.cache = WordCache(self._encode)

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _encode_parts(self, parts: list[str]) -> list[bytes]:
        """Ids of strings that are one token of the pre-tokenizer each, set apart by spaces."""
        out: list[bytes] = []
        for at in range(0, len(parts), 1000):
            some = parts[at : at + 1000]
            coded = self.plain.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0]
            ids = np.array(coded.ids, dtype="<u4")
            ends = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(ends) != len(some) or ends[-1] != len(ids):
                out += map(self._ids, some)
                continue
            raw = ids.tobytes()
            out += [raw[4 * a : 4 * b] for a, b in zip([0, *ends], ends, strict=False)]
        return out

    def _by_parts(self, texts: list[str]) -> list[bytes]:
        split = [self.find(t.lower()) for t in texts]
        get = self.parts.learn(split).__getitem__
        return [b"".join(map(get, some)) for some in split]

    def _encode(self, words: list[str]) -> list[bytes]:
        """Words of Latin letters and signs go by their parts, all others through the tokenizer itself."""
        simple = [w for w in words if _SIMPLE(w) and "<|" not in w]
        of = dict(zip(simple, self._by_parts(simple), strict=True))
        return [of[w] if w in of else self._ids(w) for w in words]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        plain = [bool(_PLAIN(t)) and "<|" not in t for t in texts]
        of_plain = iter(self._by_parts([t for t, p in zip(texts, plain, strict=True) if p]))
        words = [t.replace("\n", " ").split(" ") for t, p in zip(texts, plain, strict=True) if not p]
        get = self.cache.learn(words).__getitem__
        of_others = iter([b"".join(map(get, w)) for w in words])
        return [next(of_plain if p else of_others) for p in plain]


@cache
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


class HarmonicPacker:
    """Deals the documents of one task to bins. ``first`` is the task's first sequence id.

    A piece is ``(document, start, ids)``, the ids four bytes each; a placed one has its sequence and offset behind these.
    """

    def __init__(self, capacity: int, first: int) -> None:
        if capacity & (capacity - 1) or capacity < 1:
            raise ValueError("the capacity must be a power of two")
        self.capacity, self.next = capacity, first
        self.open: dict[int, list[tuple]] = {}
        self.free: dict[int, int] = {}

    def _close(self, pieces: list[tuple]) -> list[tuple]:
        sequence, out, at = self.next, [], 0
        self.next += 1
        for document, start, ids in pieces:
            out.append((document, start, ids, sequence, at))
            at += len(ids) // 4
        return out

    def add(self, document: object, ids: bytes) -> list[tuple]:
        """Deals a document; the pieces of all bins that it fills come back, each with its sequence and offset."""
        out: list[tuple] = []
        at, n = 0, len(ids) // 4
        while n - at >= self.capacity:
            out += self._close([(document, at, ids[4 * at : 4 * (at + self.capacity)])])
            at += self.capacity
        while at < n:
            kind = self.capacity // (n - at)
            bin_ = self.open.setdefault(kind, [])
            free = self.free.setdefault(kind, self.capacity)
            size = n - at if len(bin_) < kind else free
            bin_.append((document, at, ids[4 * at : 4 * (at + size)]))
            at += size
            self.free[kind] = free - size
            if free == size:
                out += self._close(self.open.pop(kind))
                del self.free[kind]
        return out

    def rest(self) -> Iterator[tuple]:
        """The pieces of the open bins, run together into full bins and sequences of power-of-two lengths."""
        left = [piece for _, pieces in sorted(self.open.items()) for piece in pieces]
        self.open, self.free = {}, {}
        total = sum(len(ids) // 4 for *_, ids in left)
        sizes = [self.capacity] * (total // self.capacity) + [1 << b for b in range(self.capacity.bit_length() - 2, -1, -1) if total % self.capacity >> b & 1]
        left.reverse()
        for size in sizes:
            pieces = []
            while size:
                document, start, ids = left.pop()
                take = min(size, len(ids) // 4)
                pieces.append((document, start, ids[: 4 * take]))
                if 4 * take < len(ids):
                    left.append((document, start + take, ids[4 * take :]))
                size -= take
            yield from self._close(pieces)


SCHEMA = "doc_id {}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def pack(
    df: DataFrame,
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
    encode: Callable[[list[str]], list[bytes]] | None = None,
) -> DataFrame:
    """One row per piece: where it is in its document and in its sequence, with the checksum of its ids.

    ``with_ids`` adds the ids themselves (``ids``: array of int). Null and empty texts are documents of ``end_id`` alone.
    Repeated rows and null ids are packed as they come; other columns are not read. An empty table gives no rows.
    Bins depend on how rows are dealt to tasks; a task that is run again gives the same bins. Memory: one batch, and the open
    bins, of which each class has one at most.
    """
    path = tokenizer or default_tokenizer()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encode or encoder(path).encode
        context = TaskContext.get()
        packer = HarmonicPacker(capacity, (context.partitionId() if context else 0) << 33)
        tail = int(end_id).to_bytes(4, "little")

        def batch_of(placed: list[tuple]) -> pa.RecordBatch:
            documents, start, ids, sequence, offset = zip(*placed, strict=True)
            doc, total = zip(*documents, strict=True)
            length, crc = [len(x) // 4 for x in ids], list(map(zlib.crc32, ids))
            arrays = [pa.array(doc, doc_type), *(pa.array(x, pa.int64()) for x in (start, length, crc, total, sequence, offset))]
            if with_ids:
                arrays.append(pa.array([np.frombuffer(x, dtype="<u4").astype("int32") for x in ids], pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays(arrays, names=names)

        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids]
        doc_type = pa.int64()
        for batch, texts in batches(it, 4_000_000):
            doc_type, out = batch.schema.field("doc_id").type, []
            for doc, ids in zip(batch.column("doc_id").to_pylist(), ids_of(texts), strict=True):
                ids += tail
                out += packer.add((doc, len(ids) // 4), ids)
            if out:
                yield batch_of(out)
        if out := list(packer.rest()):
            yield batch_of(out)

    kind = df.schema[id_col].dataType.simpleString()
    narrow = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return map_arrow(narrow, run, SCHEMA.format(kind) + ", ids array<int>" * with_ids)
