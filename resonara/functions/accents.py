"""Accent folding tables, generated from the Unicode database.

A character is folded by compatibility decomposition followed by the removal of
combining marks.  Hangul syllables stay composed.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterable
from functools import lru_cache

_HANGUL = range(0xAC00, 0xD7A4)
_SURROGATES = range(0xD800, 0xE000)


def fold(char: str) -> str:
    decomposed = unicodedata.normalize("NFKD", char)
    return "".join(c for c in decomposed if not unicodedata.combining(c))


@lru_cache(maxsize=1)
def folding_tables() -> tuple[dict[str, str], dict[str, str]]:
    """``(single, multiple)``: characters folding to exactly one character, and
    characters folding to several (ligatures, fractions, circled numbers)."""
    single: dict[str, str] = {}
    multiple: dict[str, str] = {}
    for code in range(0x80, sys.maxunicode + 1):
        if code in _HANGUL or code in _SURROGATES:
            continue
        char = chr(code)
        folded = fold(char)
        if folded == char or not folded:
            continue
        (single if len(folded) == 1 else multiple)[char] = folded
    return single, multiple


def char_class(chars: Iterable[str]) -> str:
    """Regular-expression class of the characters, neighbours joined to ranges."""
    ranges: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        if ranges and code == ranges[-1][1] + 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "[" + "".join(f"\\x{{{low:x}}}-\\x{{{high:x}}}" for low, high in ranges) + "]"
