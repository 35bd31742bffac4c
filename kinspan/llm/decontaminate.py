"""Benchmark decontamination by templates: numbers, names and units become typed placeholders.

Documents and benchmark items are cut into windows of template words; windows meet by a hash join.
Each window has a key of its actual words, so exact copies always meet, and keys of its template. A
capitalised word that opens a sentence may be a plain word or a name, so there is a key for either.
Hits of an item on one diagonal (document position less item position) or on diagonals close by
belong together, and count only if the filling of the placeholders is consistent: each value in the
item always stands for one and the same value in the document. So verbatim questions are found as
well as questions whose numbers, names and units were replaced throughout.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinspan.llm.tables import bitmap, in_bitmap, sorted_groups, stored
from kinspan.llm.words import (
    gram_hashes,
    mix,
    row_slices,
    text_bytes,
    whole_grams,
    word_bounds,
    word_hashes,
)
from kinspan.operators.skew import lookup_join

WINDOW = 8
LEAST_PLAIN = 4  # words of a window that are no placeholders, at least, if values are replaced
LEAST_SHARE = 0.5  # of the item's windows
LEAST_RUN = 50  # words of an item that stand together, whatever share of the item they are
MOST_SHIFT = 16  # between the diagonals of one passage

# Units that make a word after a number a placeholder (fixed values).
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t oz lb lbs pound"
    " pounds ton tons gram grams ml l liter liters litre litres gallon gallons s sec second seconds"
    " min minute minutes h hour hours day days week weeks month months year years dollar dollars"
    " euro euros cent cents percent % degree degrees mph kmh watt watts volt volts joule joules"
).split()

_NUMBER, _UNIT, _NAME, _EITHER = 1, 2, 3, 4
_MARKS = mix(np.array([0, 11, 12, 13], np.uint64))
_EXACT = 1 << 16  # seed of the keys of actual words
_READINGS = 1 << 20  # of windows that are in memory at a time

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_NUMERIC = _DIGIT.copy()
_NUMERIC[[ord(c) for c in ".,:/-+%"]] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:;)]}\"'-*"]] = True


def _hash_of(words: list[str]) -> np.ndarray:
    data, at = text_bytes(pa.array(words))
    return word_hashes(data, at[:-1], at[1:])


def template(data: np.ndarray, at: np.ndarray):
    """-> (template word, value, kind, whole name, word number) of each word, first of each text.

    Words lose punctuation at both ends and their case; those of punctuation alone go. A number is
    a word of digits and separators, a unit one of UNITS after a number, a name a capitalised word.
    One that may open a sentence, a line, a list item or a quotation is a plain word or a name
    (_EITHER): its template word is the plain one. Names that stand together are one whole name,
    without one that may be a plain word; for other words that is the value.
    """
    starts, ends, first = word_bounds(data, at)
    words = len(starts)
    last_byte = data[ends - 1] if words else data[:0]
    low, high = starts.copy(), ends.copy()
    todo = np.flatnonzero(_PUNCTUATION[data[low]]) if words else np.zeros(0, int)
    while len(todo):
        low[todo] += 1
        todo = todo[low[todo] < high[todo]]
        todo = todo[_PUNCTUATION[data[low[todo]]]]
    todo = np.flatnonzero((low < high) & _PUNCTUATION[data[high - 1]]) if words else todo
    while len(todo):
        high[todo] -= 1
        todo = todo[_PUNCTUATION[data[high[todo] - 1]]]
    lowered = _LOWER[data]
    if len(data):
        # Capitals of Latin-1 in UTF-8, but for the multiplication sign.
        latin = np.flatnonzero(data[:-1] == 0xC3) + 1
        latin = latin[(data[latin] >= 0x80) & (data[latin] <= 0x9E) & (data[latin] != 0x97)]
        lowered[latin] += 32
    value = word_hashes(lowered, low, high)
    full = low < high
    head = data[np.minimum(low, max(len(data) - 1, 0))] if words else data[:0]
    other = np.concatenate([[0], np.cumsum(~_NUMERIC[data])])
    number = full & _DIGIT[head] & (other[high] == other[low])
    prior = np.concatenate([[False], number[:-1]]) if words else number
    opens = np.zeros(words, bool)
    opens[first[:-1][first[:-1] < words]] = True
    prior &= ~opens
    unit = full & prior & ~number & np.isin(value, _hash_of(UNITS))
    lines = np.concatenate([[0], np.cumsum(data == 10)])
    after = np.concatenate([[0], ends[:-1]]) if words else ends
    opens |= lines[starts] > lines[after]
    opens[1:] |= _STOP[last_byte[:-1]]
    opens |= low > starts
    capital = lowered[low[full]] != data[low[full]]
    second = np.minimum(low[full] + 1, max(len(data) - 1, 0))
    capital |= (head[full] == 0xC3) & (lowered[second] != data[second])
    name = np.zeros(words, bool)
    name[np.flatnonzero(full)[capital]] = True
    kind = np.where(name, np.where(opens, _EITHER, _NAME), 0)
    kind = np.where(number, _NUMBER, np.where(unit, _UNIT, kind))
    token = np.where((kind == 0) | (kind == _EITHER), value, _MARKS[kind % _EITHER])
    number_in_text = np.arange(words) - np.repeat(first[:-1], np.diff(first))
    value, kind = value[full], kind[full]
    alone = np.ones(len(kind), bool)
    alone[1:] = (kind[1:] != _NAME) | (kind[:-1] != _NAME)
    alone[np.flatnonzero(np.diff(np.searchsorted(first, np.flatnonzero(full), "right"))) + 1] = True
    heads = np.flatnonzero(alone)
    whole = np.repeat(np.add.reduceat(value, heads) if len(heads) else value, np.diff([*heads, len(kind)]))
    return (
        (token[full], value, kind, whole, number_in_text[full]),
        np.concatenate([[0], np.cumsum(full)])[first],
    )


def _sums(words: np.ndarray, n: int, seed: int) -> tuple[np.ndarray, list[np.uint64]]:
    """Weighted sums of all runs of `n` consecutive words, and the weights."""
    runs = max(len(words) - n + 1, 0)
    total, factors = np.zeros(runs, np.uint64), []
    factor = 0x9E3779B97F4A7C15 ^ (2 * seed)
    for i in range(n):
        factors.append(np.uint64(factor))
        total += words[i : i + runs] * factors[-1]
        factor = factor * 0x5851F42D4C957F2D % 2**64 | 1
    return total, factors


def _readings(
    token: np.ndarray, kind: np.ndarray, size: int, least_plain: int, wanted: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """-> first word and key of `wanted` windows, by every reading of words that may be names.

    A reading has `least_plain` plain words at least, and a placeholder: without any it is the
    key of the actual words that finds copies.
    """
    sums, factors = _sums(token, size, size)
    either = np.concatenate([[0], np.cumsum(kind == _EITHER)])
    fixed = np.concatenate([[0], np.cumsum((kind != 0) & (kind != _EITHER))])
    runs = len(sums)
    fixed, either = (x[size : size + runs] - x[:runs] for x in (fixed, either))
    found = np.flatnonzero(wanted & (size - fixed >= least_plain) & (fixed + either > 0))
    lot = np.cumsum(1 << either[found]) // _READINGS
    for at in np.split(found, np.flatnonzero(np.diff(lot)) + 1):
        total, names = sums[at], fixed[at]
        for j in range(size):
            named = (kind[at + j] == _EITHER) & (size - names > least_plain)
            more = (_MARKS[_NAME] - token[at[named] + j]) * factors[j]
            total = np.concatenate([total, total[named] + more])
            names = np.concatenate([names, names[named] + 1])
            at = np.concatenate([at, at[named]])
        yield at[names > 0], mix(total[names > 0])


def template_windows(
    texts: DataFrame, id_column: str, sizes: list[int], passing: np.ndarray | None = None,
    least_plain: int = LEAST_PLAIN,
) -> DataFrame:
    """-> id, copy (hash of the text), window, size, pos (number of its first template word), word
    (first word), words (after its last word), values, kinds and names (of its words), good (it has enough
    plain words), n (template words of the text), n_good and words_good (good windows of the text,
    and the template words in them).

    `passing` is a bitmap that keeps windows from leaving the Python workers if nothing can match.
    Without it the texts are items: each is cut into windows of one size, the largest that fits.
    """
    sent = None if passing is None else texts.sparkSession.sparkContext.broadcast(passing)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = text_bytes(batch.column(1))
            for low, high in row_slices(at):
                (token, value, kind, name, word), first = template(
                    data[at[low] : at[high]], at[low : high + 1] - at[low]
                )
                count = np.diff(first)
                row = np.repeat(np.arange(high - low), count)
                plain = np.concatenate([[0], np.cumsum((kind == 0) | (kind == _EITHER))])
                for size in sizes:
                    whole = whole_grams(first, size, len(token))
                    if sent is None:
                        whole &= np.minimum(count, sizes[-1])[row[: len(whole)]] == size
                    good = whole & (plain[size : size + len(whole)] - plain[: len(whole)] >= min(least_plain, size))
                    n_good = words_good = np.zeros(high - low, np.int64)
                    if sent is None and len(good):
                        edges = np.zeros(len(token) + 1, np.int64)
                        edges[: len(good)] += good
                        edges[size:] -= good
                        inside = np.concatenate([[0], np.cumsum(np.cumsum(edges[:-1]) > 0)])
                        words_good = np.diff(inside[first])
                        n_good = np.bincount(row[: len(good)][good], minlength=high - low)
                    # Copies meet by their words, whatever stands around them.
                    exact = gram_hashes(value, size, seed=_EXACT + size)
                    for at_word, window in (
                        (np.flatnonzero(whole), exact[whole]),
                        *_readings(token, kind, size, min(least_plain, size), whole),
                    ):
                        if sent is not None:
                            passes = in_bitmap(sent.value, window)
                            at_word, window = at_word[passes], window[passes]
                        if not len(at_word):
                            continue
                        slots = at_word[:, None] + np.arange(size)[None, :]
                        bounds = (np.arange(len(at_word) + 1) * size).astype(np.int32)
                        text = row[at_word]
                        of_text = pa.array(text + low)
                        yield pa.RecordBatch.from_arrays(
                            [
                                batch.column(0).take(of_text),
                                batch.column(2).take(of_text),
                                pa.array(window.view(np.int64)),
                                pa.array(np.full(len(at_word), size, np.int32)),
                                pa.array(at_word - first[text]),
                                pa.array(word[at_word]),
                                pa.array(word[at_word + size - 1] + 1),
                                pa.ListArray.from_arrays(
                                    pa.array(bounds), pa.array(value[slots].ravel().view(np.int64))
                                ),
                                pa.ListArray.from_arrays(
                                    pa.array(bounds), pa.array(kind[slots].ravel().astype(np.int8))
                                ),
                                pa.ListArray.from_arrays(
                                    pa.array(bounds), pa.array(name[slots].ravel().view(np.int64))
                                ),
                                pa.array(good[at_word]),
                                pa.array(count[text]),
                                pa.array(n_good[text]),
                                pa.array(words_good[text]),
                            ],
                            names=schema_names,
                        )

    schema = (
        "id bigint, copy bigint, window bigint, size int, pos bigint, word bigint, words bigint,"
        " values array<bigint>, kinds array<tinyint>, names array<bigint>, good boolean, n bigint,"
        " n_good bigint, words_good bigint"
    )
    schema_names = [c.split()[0] for c in schema.split(",")]
    text = F.col("text").cast("string")
    narrow = texts.select(texts[id_column].cast("long"), text, F.xxhash64(text).alias("copy"))
    return narrow.mapInArrow(cut, schema)


Hit = tuple  # item_pos, pos, word, words, good, and the cells
Cell = tuple  # values, kinds and whole names of a word of the item and the document


def _fixed(cell: Cell) -> bool:
    """Whether a pair of words is a placeholder on both sides by any reading."""
    return 0 < cell[2] < _EITHER and 0 < cell[3] < _EITHER


def _agree(a: Cell, b: Cell) -> bool:
    """Whether one value is filled alike: by the same word, or by words of the same whole name."""
    return a[1] == b[1] or a[4:] == b[4:]


def _filled(hits: list[Hit]) -> dict[int, Cell] | None:
    """How each value of the placeholders is filled, or None if not always alike."""
    filled: dict[int, Cell] = {}
    for hit in hits:
        for cell in hit[5] if hit[4] else ():
            if _fixed(cell) and not _agree(filled.setdefault(cell[0], cell), cell):
                return None
    return filled


def _fitting(hits: list[Hit], filled: dict[int, Cell]) -> list[Hit]:
    return [h for h in hits if all(_agree(filled.get(c[0], c), c) for c in h[5] if _fixed(c))]


def _settled(hits: list[Hit]) -> list[Hit] | None:
    """The hits that go together, or None if placeholders are filled inconsistently.

    Where one of the words may be a plain word, two readings that contradict each other do not make
    the whole inconsistent: only the hits that need the rarer one go.
    """
    if all(c[0] == c[1] for h in hits for c in h[5]):
        return hits
    filled = _filled(hits)
    if filled is None:
        return None
    # Windows of few plain words are copies; they are added where nothing speaks against them.
    hits = _fitting(hits, filled)
    said: dict[int, Counter] = defaultdict(Counter)
    for cell in {(h[0] + j, h[1] + j): c for h in hits for j, c in enumerate(h[5])}.values():
        if not _fixed(cell):
            said[cell[0]][cell] += 1
    want = {}
    for value, cells in said.items():
        same = [c for c in cells if c[0] == c[1]]
        want[value] = same[0] if same else max(cells, key=lambda c: (cells[c], c))
    want |= filled
    return [h for h in hits if all(c[0] == c[1] or _agree(want[c[0]], c) for c in h[5])]


def _covered(hits: list[Hit]) -> set[int]:
    return {h[0] + j for h in hits for j in range(len(h[5]))}


def _longest(words: set[int]) -> int:
    """Length of the longest run of consecutive numbers."""
    best = run = 0
    last = None
    for w in sorted(words):
        run = run + 1 if last is not None and w == last + 1 else 1
        best, last = max(best, run), w
    return best


def _consistent_run(hits: list[Hit]) -> list[Hit]:
    """The hits in the longest consistent run of words of an inconsistent diagonal."""
    cells = {h[0] + j: c for h in hits if h[4] for j, c in enumerate(h[5])}
    low, last, best = 0, None, (0, 0)
    filled: dict[int, tuple[Cell, int, int]] = {}  # where last, and where last filled otherwise
    for w in sorted(cells):
        if last is None or w != last + 1:
            low = w
        cell, last = cells[w], w
        if _fixed(cell):
            before, at, other = filled.get(cell[0], (cell, -1, -1))
            other = other if _agree(before, cell) else at
            low = max(low, other + 1)
            filled[cell[0]] = (cell, w, other)
        if w + 1 - low > best[1] - best[0]:
            best = (low, w + 1)
    return [h for h in hits if h[4] and best[0] <= h[0] and h[0] + len(h[5]) <= best[1]]


def _judged(
    hits: list[Hit], n: int, n_good: int, words_good: int, least_share: float, least_run: int
) -> tuple | None:
    """n_windows, item_windows, share, first_word, last_word, verbatim of the best passage among
    hits on diagonals close by, or None if there is too little of the item."""
    size = len(hits[0][5])
    lines: dict[int, list[Hit]] = defaultdict(list)
    for hit in {(h[0], h[1]): h for h in hits}.values():
        lines[hit[1] - hit[0]].append(hit)
    usable = []
    for line in lines.values():
        kept = _settled(line)
        if kept is None:
            kept = _settled(_consistent_run(line))
            if kept and _longest(_covered(kept)) < least_run:
                continue
        if kept:
            usable.append(kept)
    usable.sort(key=lambda line: (-len(line), line[0][1]))
    best = None
    for k, line in enumerate(usable):
        passage, words = line, _covered(line)
        for other in usable[:k] + usable[k + 1 :]:
            if len(words) == n:
                break
            if abs(other[0][1] - other[0][0] - line[0][1] + line[0][0]) <= MOST_SHIFT:
                both = _settled(passage + other)
                if both is None:  # what is filled otherwise at the seam goes
                    both = _settled(passage + _fitting(other, _filled(passage)))
                if both and len(more := _covered(both)) > len(words):
                    passage, words = both, more
        # As many windows as fit in the words that are covered, as if these stood together.
        share = (len(words) - size + 1) / (n - size + 1)
        good = [h for h in passage if h[4]]
        if good:
            share = max(
                share,
                len({h[0] for h in good}) / n_good,
                (len(_covered(good)) - size + 1) / (words_good - size + 1),
            )
        if share < least_share and _longest(words) < least_run:
            continue
        found = (
            len({h[0] for h in passage}),
            n - size + 1,
            min(share, 1.0),
            min(h[2] for h in passage),
            max(h[3] for h in passage) - 1,
            all(c[0] == c[1] for h in passage for c in h[5]),
        )
        if best is None or (found[0], -found[3]) > (best[0], -best[3]):
            best = found
        if len(words) == n:
            break
    return best


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    least_plain: int = LEAST_PLAIN,
    least_share: float = LEAST_SHARE,
    least_run: int = LEAST_RUN,
) -> DataFrame:
    """-> doc_id, item_id, n_windows, item_windows, share, first_word, last_word, verbatim.

    One row per document and item of which a passage has `least_share` of the windows, or a run of
    `least_run` words, with consistent placeholders. A passage is one diagonal and others at most
    MOST_SHIFT words beside it, so words may be put in or left out; `share` is counted over the words
    that are covered, as if they stood together, or over the windows with enough plain words, if that
    is more; n_windows are those found. The passage with most windows is shown (of equal ones the
    first). `verbatim` says that all values are the item's own.

    An item of fewer template words than `window` is one window. Windows with fewer than
    `least_plain` plain words match with their own values only. Texts that are null or empty match
    nothing. Rows that share an id are judged one by one, and give one row. Of other columns nothing
    is read.
    """
    sizes = list(range(1, window + 1))
    items = template_windows(benchmark, "item_id", sizes, least_plain=least_plain)
    items = stored(items.dropDuplicates(["id", "copy", "window", "pos"]), "benchmark-windows")
    used = sorted(r[0] for r in items.select("size").distinct().collect())  # at most `window` rows
    if not used:
        used = [window]
    passing = bitmap(items.select(F.col("window").alias("key")))
    found = template_windows(docs, "doc_id", used, passing, least_plain)
    item = items.select(
        F.col("id").alias("item_id"),
        F.col("copy").alias("item_copy"),
        "window",
        "size",
        F.col("pos").alias("item_pos"),
        F.col("values").alias("item_values"),
        F.col("kinds").alias("item_kinds"),
        F.col("names").alias("item_names"),
        F.col("good").alias("item_good"),
        "n",
        "n_good",
        "words_good",
    )
    hits = lookup_join(
        found.drop("good", "n", "n_good", "words_good"), item, ["window", "size"]
    ).withColumn("band", F.floor((F.col("pos") - F.col("item_pos")) / MOST_SHIFT))
    # Diagonals that lie MOST_SHIFT apart share one of the two bands each is in. An item has a
    # bounded number of windows, and so has a band.
    hits = hits.withColumn("band", F.explode(F.array(F.col("band"), F.col("band") - 1)))
    keys = ["id", "copy", "item_id", "item_copy", "band"]
    names = [
        *keys, "item_pos", "pos", "word", "words", "item_good", "item_values", "values", "item_kinds",
        "kinds", "item_names", "names", "n", "n_good", "words_good",
    ]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, of_cells = [], names[names.index("item_values") : names.index("n")]
        for g in sorted_groups(batches, names, keys):
            cells = (
                list(zip(*x, strict=True))
                for x in zip(*(g[c] for c in of_cells), strict=True)
            )
            places = (g[c] for c in ("item_pos", "pos", "word", "words", "item_good"))
            passage = _judged(
                list(zip(*places, cells, strict=True)),
                g["n"][0], g["n_good"][0], g["words_good"][0], least_share, least_run,
            )
            if passage:
                rows.append((g["id"][0], g["item_id"][0], *passage))
            if len(rows) >= 10000:
                yield made(rows)
                rows = []
        yield made(rows)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(types)
        arrays = [pa.array(c, t) for c, t in zip(columns, types.values(), strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=list(types))

    types = {"doc_id": pa.int64(), "item_id": pa.int64(), "n_windows": pa.int64()}
    types |= {"item_windows": pa.int64(), "share": pa.float64(), "first_word": pa.int64()}
    types |= {"last_word": pa.int64(), "verbatim": pa.bool_()}
    schema = (
        "doc_id bigint, item_id bigint, n_windows bigint, item_windows bigint, share double,"
        " first_word bigint, last_word bigint, verbatim boolean"
    )
    passages = (
        hits.select(*names).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(judge, schema)
    )
    shown = ["n_windows", "item_windows", "share", "first_word", "last_word", "verbatim"]
    best = F.max_by(F.struct(*shown), F.struct("n_windows", -F.col("first_word"), "share"))
    return (
        passages.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.*")
    )
