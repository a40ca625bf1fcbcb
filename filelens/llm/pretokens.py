"""Pre-tokens of the byte-level BPE vocabularies.

The split pattern never lets a token run from a non-space character into a
space, so in a text without two white-space characters in a row every space
starts a new unit and every line end is one.  Units are cut with
``str.split`` and looked up whole; the pattern itself runs only on units not
seen before and on texts that do have runs of white space.

A whole Arrow column is cut without a Python object a unit: wherever ASCII white
space follows a character that is none, no pre-token spans the two, and none on
either side depends on the other, runs of white space or not.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import regex

#: Fixed value: the split pattern of the public byte-level BPE vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_RUNS = re.compile(r"[\s\x85]{2}")  # at least the pattern's white space, so the fast cut is never used wrongly
#: The pattern's white space: ASCII, and beyond.
SPACE = "\t\n\v\f\r "
WIDE_SPACE = "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
_IS_SPACE = np.isin(np.arange(256), list(SPACE.encode()))
_WIDE_CODES = np.array([int.from_bytes(c.encode(), "big") for c in WIDE_SPACE])


def raw_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 and bytes of a column of ``large_string`` or ``large_binary``
    without nulls."""
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(len(column) + 1, np.int64), np.zeros(0, np.uint8)
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return ends - ends[0], np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]


def binary_column(ends: np.ndarray, data: np.ndarray) -> pa.Array:
    """Column of ``large_binary`` with these offsets into ``data``."""
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)])


def _after_word(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends before each place ``at`` is no white space."""
    last = data[at - 1]
    word = ~_IS_SPACE[last]
    wide = np.flatnonzero(last >= 0x80)
    if len(wide):
        end = at[wide] - 1
        two = (data[end - 1].astype(np.int64) << 8) | data[end]
        three = (data[np.maximum(end - 2, 0)].astype(np.int64) << 16) | two
        word[wide] = ~(np.isin(two, _WIDE_CODES) | np.isin(three, _WIDE_CODES))
    return word


class Splitter:
    def __init__(self, pattern: str = PATTERN):
        self._find = regex.compile(pattern).findall
        self._cuts = pattern == PATTERN  # texts under another pattern stay whole

    def units(self, text: str) -> list[str]:
        """Pieces whose pre-tokens, one after the other, are those of ``text``."""
        if not text:
            return []
        if _RUNS.search(text):
            return self._find(text)
        units = []
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            if first:
                units.append(first)
            units += [" " + x for x in rest]
            units.append("\n")
        units.pop()
        return units

    def tokens(self, unit: str) -> list[str]:
        return self._find(unit)

    def cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Units of a column of texts (``large_string``), and where each text's begin."""
        ends, data = raw_column(texts)
        mark = np.zeros(len(data) + 1, dtype=bool)
        if self._cuts:
            space = _IS_SPACE[data]
            at = np.flatnonzero(space[1:] & ~space[:-1]) + 1
            mark[at[_after_word(data, at)]] = True
        mark[ends] = True
        cuts = np.flatnonzero(mark)
        return binary_column(cuts, data), np.searchsorted(cuts, ends)

    def tokens_of(self, units: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Pre-tokens of all ``units``, where those of the unit at each place begin,
        and each unit's place.  Units from a space to a word come first: one after
        the other they are a text whose pre-tokens are theirs."""
        ends, data = raw_column(units)
        joins = _IS_SPACE[data[ends[:-1]]] & _after_word(data, ends[1:]) if self._cuts else np.zeros(len(units), dtype=bool)
        order = np.argsort(~joins, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        ends, data = raw_column(units.take(pa.array(order)))
        ends, n = ends.tolist(), int(joins.sum())
        tokens = self._find(data[: ends[n]].tobytes().decode())
        lengths, _ = raw_column(pa.array(tokens, pa.large_string()))
        starts = np.searchsorted(lengths, ends[: n + 1]).tolist()
        for a, b in zip(ends[n:-1], ends[n + 1 :], strict=True):
            tokens += self._find(data[a:b].tobytes().decode())
            starts.append(len(tokens))
        return tokens, np.array(starts), place


def byte_alphabet() -> dict[str, int]:
    """Printable stand-in character of each byte in the JSON vocabularies:
    printable Latin-1 bytes stand for themselves, the others follow from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
