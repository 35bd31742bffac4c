"""Chat formatting in budgeted windows of whole turns.

Running sums of turn tokens close a window before the turn that would exceed the budget. Each
window opens with the conversation's system turn and a limited history, which repeat turns of
earlier windows; only turns that are new in a window are targets of the loss, so every assistant
text is a target once. Texts are escaped, so that what looks like a control string within them
stays text, and `read_back` returns the very turns.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kinspan.llm.tokens import encoder

BUDGET = 1024
HISTORY = 256

# Control strings of the template (fixed values): opening and closing of a turn by its role.
TURNS = {"user": ("[INST]", "[/INST]"), "system": ("[SYS]", "[/SYS]"), "assistant": ("[ANS]", "</s>")}
OPEN, ROLE, TEXT, END = "<s>", "[ROLE]", "[TEXT]", "[/TEXT]"

_CONTROL = re.compile(r"<s>|</s>|\[/?(?:INST|SYS|TEXT)\]|\[(?:ANS|ROLE)\]")
_LOOKALIKE = re.compile(r"([<\[])(\\*)(/?s>|/?(?:INST|SYS|TEXT)\]|(?:ANS|ROLE)\])")
_ESCAPED = re.compile(r"([<\[])\\(\\*)(/?s>|/?(?:INST|SYS|TEXT)\]|(?:ANS|ROLE)\])")

WINDOWS = (
    "conv_id bigint, window bigint, text string, loss array<struct<low: bigint, high: bigint>>,"
    " n_turns bigint, n_repeated bigint, n_tokens bigint"
)


def escape(text: str) -> str:
    """Put a backslash into every control string, and one more where there are some already."""
    return _LOOKALIKE.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """-> the formatted turn, and where its text begins and ends in it (code points)."""
    if role in TURNS:
        opening, closing = TURNS[role]
    else:
        opening, closing = f"{ROLE}{escape(role)}{TEXT}", END
    body = escape(text)
    return f"{opening}{body}{closing}", len(opening), len(opening) + len(body)


def parse(window: str) -> Iterator[tuple[str, str, int]]:
    """The turns of a formatted window: role, text, where the escaped text begins."""
    opened = {opening: role for role, (opening, _) in TURNS.items()}
    closed = {closing for _, closing in TURNS.values()} | {END}
    role, start, role_start = "", 0, 0
    for found in _CONTROL.finditer(window):
        mark = found.group()
        if mark in opened:
            role, start = opened[mark], found.end()
        elif mark == ROLE:
            role_start = found.end()
        elif mark == TEXT:
            role, start = unescape(window[role_start : found.start()]), found.end()
        elif mark in closed:
            yield role, unescape(window[start : found.start()]), start


class _Windows:
    """The windows of one conversation; holds one window and its history, no more."""

    def __init__(self, conv_id: int | None, budget: int, history: int) -> None:
        self.conv_id, self.budget, self.limit = conv_id, budget, history
        self.window = 0
        self.system: tuple | None = None
        self.begun = False
        self.past: deque[tuple] = deque()  # newest turns of up to `history` tokens
        self.past_tokens = 0
        self._open()

    def _open(self) -> None:
        self.lead: list[tuple] = []
        self.turns: list[tuple] = []
        self.tokens = 0

    def add(self, turn: tuple[str, int, int, str], tokens: int) -> Iterator[tuple]:
        """Take a turn (formatted, text bounds, role); gives the window that it closes, if any."""
        if self.turns and self.tokens + tokens > self.budget:
            yield self.close()
        if not self.turns and self.begun:
            system = [self.system] if self.system else []
            room = self.budget - tokens - sum(n for _, n in system)
            history: list[tuple] = []
            for old, n in reversed(self.past):
                if n > room:
                    break
                history.insert(0, (old, n))
                room -= n
            self.lead = system + history
            self.tokens = sum(n for _, n in self.lead)
        if not self.begun and turn[3] == "system":
            self.system = (turn, tokens)
        else:
            self.past.append((turn, tokens))
            self.past_tokens += tokens
            while self.past and self.past_tokens > self.limit:
                self.past_tokens -= self.past.popleft()[1]
        self.begun = True
        self.turns.append((turn, tokens))
        self.tokens += tokens

    def close(self) -> tuple:
        parts, loss, at = [OPEN], [], len(OPEN)
        for number, ((text, low, high, role), _) in enumerate(self.lead + self.turns):
            if number >= len(self.lead) and role == "assistant":
                loss.append({"low": at + low, "high": at + high})
            parts.append(text)
            at += len(text)
        row = (
            self.conv_id, self.window, "".join(parts), loss, len(self.lead) + len(self.turns),
            len(self.lead), self.tokens,
        )
        self.window += 1
        self._open()
        return row


def _by_conversation(df: DataFrame, *order: str) -> DataFrame:
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def format_conversations(
    turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokenizer: str | None = None
) -> DataFrame:
    """conv_id, turn, role, text -> conv_id, window, text, loss, n_turns, n_repeated, n_tokens.

    A row per window. `loss` are the ranges of code points that are targets: texts of assistant
    turns that are new in the window, without their marks. The first n_repeated of the n_turns turns
    repeat earlier ones: the system turn, if the conversation opens with one, and as many of the
    newest turns as have `history` tokens at most and leave room for the next turn. The system turn
    stands in every window: where it and the next turn exceed the budget together, the window has
    these two, whole, and nothing else, and so has more tokens than the budget. Without a system
    turn, a turn over the budget is a window of its own, whole. Turns go by turn, then role and text,
    nulls first; rows that repeat are turns each. Null texts and roles count as empty, rows without
    conv_id as one conversation. Other columns are not read.

    Tokens are counted where rows are read, whatever conversation they are of. The ordered pass over
    a conversation is one task's, which holds one of its windows at a time and only closes windows.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            roles, texts = ([x or "" for x in batch.column(i).to_pylist()] for i in (2, 3))
            made = [format_turn(r, t)[0] for r, t in zip(roles, texts, strict=True)]
            if made:
                tokens, _, _ = encode(pa.array(made, pa.large_string()))
                counted = pa.array(np.asarray(tokens), pa.int64())
                yield pa.RecordBatch.from_arrays([*batch.columns, counted], names=TURN_COLUMNS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: _Windows | None = None
        for batch in batches:
            rows = []
            for conv_id, _, role, text, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if state is None or state.conv_id != conv_id:
                    if state is not None:
                        rows.append(state.close())
                    state = _Windows(conv_id, budget, history)
                rows += state.add((*format_turn(role or "", text or ""), role or ""), n)
            yield _batch(rows)
        if state is not None:
            yield _batch([state.close()])

    narrow = turns.select(
        turns["conv_id"].cast("long"),
        turns["turn"].cast("long"),
        turns["role"].cast("string"),
        turns["text"].cast("string"),
    )
    counted = narrow.mapInArrow(count, "conv_id bigint, turn bigint, role string, text string, tokens bigint")
    return _by_conversation(counted, "turn", "role", "text").mapInArrow(run, WINDOWS)


TURN_COLUMNS = ["conv_id", "turn", "role", "text", "tokens"]


_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("window", pa.int64()),
        ("text", pa.string()),
        ("loss", pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))),
        ("n_turns", pa.int64()),
        ("n_repeated", pa.int64()),
        ("n_tokens", pa.int64()),
    ]
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in _ARROW]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW
    )


DIGESTS = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string,"
    " formatted_chars bigint, n_windows bigint"
)


def read_back(windows: DataFrame) -> DataFrame:
    """Windows -> a row per conversation with what its turns and targets read back are.

    turns_sha256 is over role, line feed, text, line feed of each turn that is no repetition;
    loss_chars and loss_sha256 are over the text under the loss ranges without its escapes.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_windows"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None

        def result() -> pa.RecordBatch:
            key, turns, turn_hash, chars, loss_hash, total, count = state
            row = [key, turns, turn_hash.hexdigest(), chars, loss_hash.hexdigest(), total, count]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names
            )

        for batch in batches:
            for row in batch.to_pylist():
                if state is None or state[0] != row["conv_id"]:
                    if state is not None:
                        yield result()
                    state = [row["conv_id"], 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for number, (role, text, _) in enumerate(parse(row["text"])):
                    if number >= row["n_repeated"]:
                        state[1] += 1
                        state[2].update(f"{role}\n{text}\n".encode())
                for span in row["loss"]:
                    text = unescape(row["text"][span["low"] : span["high"]])
                    state[3] += len(text)
                    state[4].update(text.encode())
                state[5] += len(row["text"])
                state[6] += 1
        if state is not None:
            yield result()

    narrow = windows.select("conv_id", "window", "text", "loss", "n_repeated")
    return _by_conversation(narrow, "window").mapInArrow(run, DIGESTS)
