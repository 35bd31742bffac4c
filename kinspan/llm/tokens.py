"""Token ids of whole texts by a public tokenizer, worked out once per distinct piece.

The tokenizer drops white space and joins nothing across it, so that a text may be cut at ASCII
white space without changing its ids. Within a piece, letters A-Z become lower case (which the
tokenizer does itself) and a closing run of punctuation is cut off after a plain letter or digit,
both only where the piece holds plain Latin characters alone. Each distinct piece is then encoded
once and kept in a cache of bounded size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from kinspan.llm.words import SLICE_BYTES, is_break, ragged

VOCABULARY = "word_bpe_49k.json"
CACHED_PIECES = 300_000

# Fixed values. Plain pieces: printable ASCII and Latin letters that no normalisation changes.
PLAIN = "^[!-~¡-ſ]+$"
LETTERS = "a-zß-öø-ÿ"
# Punctuation that neither opens a special token nor a contraction: all but ' < > |.
CLOSING = "!-&(-/:;=?@\\[-`{}~"
TAIL = f"^(.*[{LETTERS}0-9])([{CLOSING}]+)$"


def tokenizer_path(path: str | None) -> str:
    if path is not None:
        return path
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def _byte_letter(byte: int) -> str:
    """The letter by which a byte-level vocabulary writes a byte from 161 on or within UTF-8."""
    if byte == 173:
        return chr(256 + 67)
    return chr(256 + 34 + byte - 128) if 128 <= byte <= 160 else chr(byte)


class PieceEncoder:
    """Encodes string arrays to flat token ids; one per Python worker and vocabulary."""

    def __init__(self, path: str | None = None, cached: int = CACHED_PIECES) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share the cores already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path(path))
        self.model = self.tokenizer.model
        self.cached = cached
        self.letters = {
            code: "".join(map(_byte_letter, chr(code).encode()))
            for code in range(0xDF, 0x100)
            if code != 0xF7
        }
        self.word = re.compile(f"[{LETTERS}]+")
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.sizes = np.zeros(1 << 12, np.int64)
        self.starts = np.zeros(1 << 12, np.int64)
        self.ids = np.zeros(1 << 14, np.uint32)
        self.n_ids = 0

    def _learn(self, pieces: list[str]) -> None:
        words = [p for p in pieces if self.word.fullmatch(p)]
        others = [p for p in pieces if not self.word.fullmatch(p)]
        tokenize, letters = self.model.tokenize, self.letters
        lists = [
            [t.id for t in tokenize(w if w.isascii() else w.translate(letters))] for w in words
        ]
        for first in range(0, len(others), 1024):
            batch = self.tokenizer.encode_batch(others[first : first + 1024], add_special_tokens=False)
            lists += [e.ids for e in batch]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        ids = np.fromiter((i for x in lists for i in x), np.uint32, int(sizes.sum()))
        seen, total = len(self.known), self.n_ids
        self.known.update(zip(words + others, range(seen, seen + len(lists)), strict=True))
        self.sizes = _room(self.sizes, len(self.known))
        self.starts = _room(self.starts, len(self.known))
        self.ids = _room(self.ids, total + len(ids))
        self.sizes[seen : seen + len(lists)] = sizes
        self.starts[seen : seen + len(lists)] = total + np.cumsum(sizes) - sizes
        self.ids[total : total + len(ids)] = ids
        self.n_ids += len(ids)

    def _numbers(self, pieces: pa.Array) -> np.ndarray:
        """Cache numbers of distinct pieces. They hold until the next call, which may clear the cache."""
        names = pieces.to_pylist()
        get = self.known.get
        numbers = np.fromiter((get(p, -1) for p in names), np.int64, len(names))
        new = np.flatnonzero(numbers < 0)
        if len(new):
            if len(self.known) + len(new) > self.cached and self.known:
                self._clear()
                return self._numbers(pieces)
            self._learn([names[i] for i in new])
            numbers[new] = [self.known[names[i]] for i in new]
        return numbers

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """-> per text: its number of tokens; per piece: start and size of its ids in `self.ids`."""
        lists = pc.ascii_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        number, tail = self._distinct(coded.dictionary)
        index = coded.indices.to_numpy()
        both = np.stack([number[index], tail[index]], 1).ravel()
        sizes = np.where(both >= 0, self.sizes[both], 0)
        at = lists.offsets.to_numpy().astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return ends[2 * (at[1:] - at[0])] - ends[2 * (at[:-1] - at[0])], self.starts[both], sizes

    def _distinct(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Cache numbers of the main part of each piece and of its cut-off tail (-1: none)."""
        if len(pieces) == 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        plain = pc.match_substring_regex(pieces, PLAIN)
        plain = pc.and_(plain, pc.invert(pc.match_substring(pieces, "<|")))
        low = pc.if_else(plain, pc.ascii_lower(pieces), pieces)
        cut = pc.and_(plain, pc.match_substring_regex(low, TAIL))
        main = pc.if_else(cut, pc.replace_substring_regex(low, TAIL, r"\1"), low)
        tail = pc.if_else(cut, pc.replace_substring_regex(low, TAIL, r"\2"), pa.scalar(""))
        coded = pa.concat_arrays([main, tail]).dictionary_encode()
        number = self._numbers(coded.dictionary)[coded.indices.to_numpy()]
        half = len(pieces)
        return number[:half], np.where(cut.to_numpy(zero_copy_only=False), number[half:], -1)

    def token_ids(self, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return self.ids[ragged(starts, sizes)]


def _room(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    more = np.zeros(max(size, 2 * len(array)), array.dtype)
    more[: len(array)] = array
    return more


_ENCODERS: dict[tuple, PieceEncoder] = {}


def encoder(path: str | None = None) -> PieceEncoder:
    """The encoder of this Python worker; it stays for the tasks that follow."""
    if (path,) not in _ENCODERS:
        _ENCODERS[(path,)] = PieceEncoder(path)
    return _ENCODERS[(path,)]


def balanced_pieces(
    data: np.ndarray, at: np.ndarray, max_bytes: int = SLICE_BYTES
) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """Texts in slices of about `max_bytes`: (row of each text or part of one, the strings).

    A text that does not fit is cut before white space, where no token is cut; only a run of more
    than `max_bytes` without any white space makes a slice larger.
    """
    rows, cuts = [], [0]

    def flush() -> tuple[np.ndarray, pa.Array]:
        strings = pa.LargeStringArray.from_buffers(
            len(rows), pa.py_buffer(np.array(cuts, np.int64)), pa.py_buffer(data)
        )
        return np.array(rows, np.int64), strings

    for row in range(len(at) - 1):
        here, end = int(at[row]), int(at[row + 1])
        while True:
            if rows and end - cuts[0] > max_bytes:
                yield flush()
                rows, cuts = [], [here]
            if end - here <= max_bytes:
                break
            stop, step = here + max_bytes, 1 << 16
            while stop < end:
                spaces = np.flatnonzero(is_break(data[stop : min(stop + step, end)]))
                if len(spaces):
                    stop += int(spaces[0])
                    break
                stop = min(stop + step, end)
            rows.append(row)
            cuts.append(stop)
            here = stop
            if here >= end:
                break
        if here < end or at[row] == end:
            rows.append(row)
            cuts.append(end)
    if rows:
        yield flush()
