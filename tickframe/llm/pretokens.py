"""Batches of texts as units and codes, for the tokenizing operators.

A *unit* is a stretch of text that no pre-token crosses: cuts lie before a
single blank and around a single line feed, where the byte-level pattern
always ends a match.  Arrow finds the units and their distinct values; only
distinct units reach the tokenizers.  Texts with other white space, special
strings or doubled blanks are cut by the pattern itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Text bytes handled at a time inside a task; a longer text makes a slice of its own.
SLICE_BYTES = 8 << 20
#: Entries of one generation of a worker's cache; there are two at most.
CACHE_ENTRIES = 150_000
#: White space other than blank and line feed, fixed values of Unicode's White_Space property.
OTHER_SPACE = "\t\x0b\x0c\r\x85\xa0  -     　"
_HARD = "[ \n][ \n]|[" + OTHER_SPACE + "]"


class Recent:
    """A bounded cache: when the young generation is full, the old one goes.

    It only saves work; what falls out is computed again.
    """

    def __init__(self, entries: int = CACHE_ENTRIES):
        self.entries, self.young, self.old = entries, {}, {}

    def get(self, key: str):
        value = self.young.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value

    def put(self, key: str, value) -> None:
        if len(self.young) >= self.entries:
            self.old, self.young = self.young, {}
        self.young[key] = value


def pattern(text: str) -> regex.Pattern:
    """A pre-token pattern with white space as the tokenizers' engines define it."""
    text = text.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\S", r"\P{White_Space}").replace(r"\s", r"\p{White_Space}")
    return regex.compile(text)


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch of about ``most`` bytes of text each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(at, to - at)
        at = to


def _separator(texts: pa.Array) -> str:
    for c in (*range(1, 9), *range(0xE000, 0xF8FF), *range(0xF0000, 0xFFFFD)):
        if not pc.any(pc.match_substring(texts, chr(c))).as_py():
            return chr(c)
    raise ValueError("no character is free to mark units with")


def byte_units(texts: pa.Array, pat: regex.Pattern, special: tuple[str, ...] = ()) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Units per text, the code of each unit in order, and the distinct units.

    ``special`` strings are units of their own and pre-tokens never cross them.
    """
    texts = pc.fill_null(texts, "")
    sep = _separator(texts)
    hard = pc.match_substring_regex(texts, _HARD)
    for s in special:
        hard = pc.or_(hard, pc.match_substring(texts, s))
    marked = pc.replace_substring(pc.replace_substring(texts, " ", sep + " "), "\n", f"{sep}\n{sep}")
    rows = np.flatnonzero(hard.to_numpy(zero_copy_only=False))
    if len(rows):
        cut = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

        def by_pattern(text: str) -> str:
            parts = cut.split(text) if cut else [text]
            return sep.join(u for k, p in enumerate(parts) for u in ([p] if k % 2 else pat.findall(p)))

        marked = pc.replace_with_mask(marked, hard, pa.array([by_pattern(texts[int(i)].as_py()) for i in rows], pa.string()))
    return _coded(pc.split_pattern(marked, sep))


def blank_units(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """As byte_units, cut at every blank and line feed, which are left out."""
    return _coded(pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " "))


def blank_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """As blank_units, with the distinct units as an Arrow array."""
    return _codes(pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " "))


def _coded(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Lists of units without the empty ones."""
    n, codes, values = _codes(lists)
    return n, codes, values.to_pylist()


def _codes(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    n = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    coded = lists.flatten().dictionary_encode()
    codes, values = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    empty = pc.index(values, pa.scalar("", values.type)).as_py()
    if empty >= 0:
        there = codes != empty
        owner = np.repeat(np.arange(len(n)), n)
        n, codes = np.bincount(owner[there], minlength=len(n)), codes[there]
    return n.astype(np.int64), codes, values


def starts(counts: np.ndarray) -> np.ndarray:
    """Exclusive prefix sums with the total as the last item."""
    out = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def ragged(flat: np.ndarray, at: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Concatenation of the pieces flat[at[c]:at[c + 1]] for each c of codes."""
    size = at[codes + 1] - at[codes]
    to = starts(size)
    return flat[np.repeat(at[codes] - to[:-1], size) + np.arange(to[-1])]
