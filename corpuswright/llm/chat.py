"""Chat formatting in budgeted windows.

A conversation is written as windows of at most ``budget`` tokens, cut between turns: prefix sums of the turns' tokens give
the longest span that fits. Each window starts with the conversation's system turn (if its first turn is one), then repeats
a limited number of the turns before the span, as far as they and the span's first turn fit, then has the span itself. Only
assistant texts of the span are under the loss mask; what is repeated is masked, so each assistant text is learned from once.

A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``. Within roles and texts a backslash is doubled and ``<|`` is written
``<\\|`` (a line feed in a role ``\\n``), so no text can pass for a control string, and ``parse`` gives back what went in.
Tokens are counted in turns as they are written, control strings included.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
BUDGET = 2048
#: Of earlier turns repeated before a span: how many at most, and tokens at most.
HISTORY_TURNS = 2
HISTORY_TOKENS = 512
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str, role: bool = False) -> str:
    text = text.replace("\\", "\\\\").replace("<|", "<\\|")
    return text.replace("\n", "\\n") if role else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text) if "\\" in text else text


def parse(text: str) -> list[tuple[str, str]]:
    """Roles and texts of the turns of a formatted window."""
    out, at = [], 0
    while at < len(text):
        if not text.startswith(START, at):
            raise ValueError(f"no turn starts at {at}")
        line = text.index("\n", at)
        end = text.index(END, line)
        out.append((unescape(text[at + len(START) : line]), unescape(text[line + 1 : end])))
        at = end + len(END) + 1
    return out


def formatted(role: str, text: str) -> tuple[str, str]:
    """A turn as it is written: what comes before its text, and its text."""
    return f"{START}{escape(role, True)}\n", escape(text)


def default_counter() -> Callable[[list[str]], list[int]]:
    from corpuswright.llm.packing import default_tokenizer, encoder

    encode = encoder(default_tokenizer()).encode
    return lambda texts: [len(ids) // 4 for ids in encode(texts)]


class Windows:
    """Writes the windows of one conversation, whose turns come in order; holds the turns of one window and one more."""

    def __init__(self, budget: int, history_turns: int, history_tokens: int) -> None:
        self.budget, self.history_turns, self.history_tokens = budget, history_turns, history_tokens
        self.system: tuple | None = None
        #: The last turns before the span, and what of them is repeated.
        self.before: deque[tuple] = deque(maxlen=history_turns)
        self.repeated: list[tuple] = []
        self.span: list[tuple] = []
        #: Prefix sums of the span's tokens, from those of the repeated turns on.
        self.sums = [0]
        self.number = 0

    def add(self, role: str, text: str, tokens: int) -> Iterator[tuple]:
        turn = (*formatted(role, text), tokens, role == "assistant")
        self.sums.append(self.sums[-1] + tokens)
        self.span.append(turn)
        # the longest span within the budget; a turn that is too long by itself is a span
        end = max(1, bisect_right(self.sums, self.budget) - 1)
        if end < len(self.span):
            yield self.write(end)
            self.start(self.span[end:])
        elif self.number == 0 and len(self.span) == 1 and role == "system":
            self.system = turn

    def start(self, span: list[tuple]) -> None:
        """Begins a span (of one turn: the one that did not fit), and chooses what it repeats."""
        room = self.budget - span[0][2] - (self.system[2] if self.system else 0)
        room = min(room, self.history_tokens)
        kept: list[tuple] = []
        for turn in reversed(self.before):
            room -= turn[2]
            if room < 0:
                break
            kept.append(turn)
        self.repeated = [self.system] * bool(self.system) + kept[::-1]
        self.span = span
        self.sums = [sum(t[2] for t in self.repeated)]
        for turn in span:
            self.sums.append(self.sums[-1] + turn[2])

    def write(self, end: int) -> tuple:
        """The window of the span's first ``end`` turns."""
        parts, size, mask = [], 0, []
        for i, (head, body, _, learned) in enumerate([*self.repeated, *self.span[:end]]):
            if learned and i >= len(self.repeated):
                mask.append({"start": size + len(head), "end": size + len(head) + len(body)})
            parts += head, body, END, "\n"
            size += len(head) + len(body) + len(END) + 1
        self.before.extend(t for t in self.span[:end] if t is not self.system)
        self.number += 1
        return self.number - 1, "".join(parts), mask, len(self.repeated), end, self.sums[end]

    def rest(self) -> Iterator[tuple]:
        if self.span:
            yield self.write(len(self.span))


WINDOW = "conv_id {}, window bigint, text string, loss array<struct<start:bigint,end:bigint>>, n_repeated bigint, n_turns bigint, n_tokens bigint"
_NO = object()


def windows(df: DataFrame, budget: int = BUDGET, history_turns: int = HISTORY_TURNS, history_tokens: int = HISTORY_TOKENS, counter: Callable[[list[str]], list[int]] | None = None) -> DataFrame:
    """Windows of every conversation of ``(conv_id, turn, role, text)``, in order within a partition.

    ``text``: the formatted window; ``loss``: the spans of it under the loss mask; ``n_repeated``: how many of its first
    turns repeat earlier ones. Null roles and texts count as empty; turns with the same number (repeated rows too) all
    stay, in the order of role and text, a null number first; rows of a null ``conv_id`` are one conversation. A turn longer
    than the budget (by itself, or with the system turn, which is never left out) is a window of its own without history; every
    other window keeps the budget. An empty table gives no rows; other columns are not read. Time and memory do not depend
    on how many turns a conversation has.

    One shuffle, on ``conv_id``; a conversation is streamed in turn order and never held whole, however long it is.
    """
    kind = df.schema["conv_id"].dataType.simpleString()
    turns = df.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter or default_counter()
        current, writer = _NO, None
        names = ["conv_id", "window", "text", "loss", "n_repeated", "n_turns", "n_tokens"]
        kinds = [None, pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.int64(), pa.int64(), pa.int64()]
        ready: list[tuple] = []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in it:
            kinds[0] = batch.schema.field("conv_id").type
            roles, texts = batch.column("role").to_pylist(), batch.column("text").to_pylist()
            tokens = count([f"{''.join(formatted(r, t))}{END}\n" for r, t in zip(roles, texts, strict=True)])
            for conv, role, text, n in zip(batch.column("conv_id").to_pylist(), roles, texts, tokens, strict=True):
                if conv != current:
                    if writer:
                        ready += ((current, *w) for w in writer.rest())
                    current, writer = conv, Windows(budget, history_turns, history_tokens)
                ready += ((current, *w) for w in writer.add(role, text, n))
                if len(ready) >= 1000:
                    yield batch_of(ready)
                    ready = []
        if writer:
            ready += ((current, *w) for w in writer.rest())
        if ready:
            yield batch_of(ready)

    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, WINDOW.format(kind))


DIGEST = "conv_id {}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def digests(formatted: DataFrame) -> DataFrame:
    """What is read back from ``windows``, per conversation: digests of its turns, and of its text under the loss mask.

    Narrow: takes the windows in the order and partitions in which ``windows`` gives them, and holds one window.
    """
    kind = formatted.schema["conv_id"].dataType.simpleString()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = _NO, []
        n = loss = chars = 0
        turns_hash = loss_hash = None
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        conv_type = pa.int64()

        def flush() -> pa.RecordBatch:
            arrays = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), [conv_type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()], strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, names=names)

        def over() -> None:
            if current is not _NO:
                rows.append((current, n, turns_hash.hexdigest(), loss, loss_hash.hexdigest(), chars))

        for batch in it:
            conv_type = batch.schema.field("conv_id").type
            for row in batch.to_pylist():
                if row["conv_id"] != current:
                    over()
                    current, n, loss, chars, turns_hash, loss_hash = row["conv_id"], 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                text = row["text"]
                chars += len(text)
                for role, said in parse(text)[row["n_repeated"] :]:
                    n += 1
                    turns_hash.update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                for span in row["loss"]:
                    said = unescape(text[span["start"] : span["end"]])
                    loss += len(said)
                    loss_hash.update(said.encode("utf-8", "surrogatepass"))
            if len(rows) >= 10_000:
                yield flush()
        over()
        if rows:
            yield flush()

    return formatted.mapInArrow(run, DIGEST.format(kind))
