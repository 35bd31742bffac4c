"""Text columns: splitting, formatting, lengths, substrings, case and delimiters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RELATION_SEP = "\u0001"


def _literal(sep: str) -> str:
    """The separator as a regular expression; one character is split without a regex engine."""
    if len(sep) > 1:
        return f"\\Q{sep}\\E"
    return f"\\{sep}" if sep in ".$|()[{^?*+\\" else sep


def split_all(text: Column, sep: str) -> Column:
    """Every piece, trailing empty ones included."""
    return F.split(text, _literal(sep), -1)


def split_limit(text: Column, sep: str, limit: int) -> Column:
    """At most `limit` pieces; the last one holds the rest of the text."""
    return F.split(text, _literal(sep), limit)


def split_trimmed(text: Column, sep: str) -> Column:
    """The pieces up to the last non-empty one; a text of separators only has no pieces."""
    if len(sep) == 1:
        kept = F.rtrim(text, F.lit(sep))
    else:
        kept = F.regexp_replace(text, f"(?:{_literal(sep)})+$", "")
    only_separators = (kept == "") & (text != "")
    return F.when(only_separators, F.array().cast("array<string>")).otherwise(split_all(kept, sep))


def trimmed_size(pieces: Column, text: Column, sep: str) -> Column:
    """Size of `split_trimmed(text, sep)`, given all `pieces`; most texts need no second split."""
    ends_full = F.try_element_at(pieces, F.lit(-1)) != ""
    return F.when(ends_full, F.size(pieces)).otherwise(F.size(split_trimmed(text, sep)))


def printf(fmt: str, *cols: Column) -> Column:
    return F.format_string(fmt, *cols)


def char_count(text: Column) -> Column:
    return F.length(text)


def byte_count(text: Column) -> Column:
    return F.octet_length(text)


def after_first(text: Column, mark: str) -> Column:
    """What follows the first `mark` character; the whole text where there is none."""
    return F.substr(text, F.instr(text, mark) + F.lit(1))


def from_position(text: Column, start: int) -> Column:
    """The text from the 0-based position `start`."""
    return F.substr(text, F.lit(start + 1))


def code_point(text: Column) -> Column:
    """Unicode code point of the first character."""
    return F.ascii(text)


def upper_case(text: Column) -> Column:
    return F.upper(text)


def lower_case(text: Column) -> Column:
    return F.lower(text)


def swap_delimiter(text: Column, sep: str = RELATION_SEP, shown: str = "\t") -> Column:
    """Replace the field separator by one that can be displayed."""
    return F.replace(text, F.lit(sep), F.lit(shown))


def id_of_row_key(row_key: Column) -> Column:
    """`id` of an `id_epochMillis` row key."""
    return F.regexp_extract(row_key, "^(.*)_[^_]*$", 1)


def millis_of_row_key(row_key: Column) -> Column:
    """Epoch milliseconds of an `id_epochMillis` row key, NULL where it does not end in a number."""
    return F.substring_index(row_key, "_", -1).try_cast("bigint")


def null_if_literal(text: Column, literal: str = "NULL") -> Column:
    """NULL where the text spells `literal` in any case."""
    return F.when(F.upper(text) != literal.upper(), text)
