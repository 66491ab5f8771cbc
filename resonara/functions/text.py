"""Title, file-name and key cleaning as column expressions."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from resonara.functions.accents import char_class, folding_tables

# --- fixed values -----------------------------------------------------------
FILE_UNSAFE_CHARS = '<>:"/\\|?*'
FANCY_QUOTES = "’\"“”‘"
TITLE_MAX_CHARS = 100
UNKNOWN_TITLE = "unknown_title"
UNKNOWN_CHANNEL = "unknown_channel"
UNKNOWN_ARTIST = "unknown"
CHANNEL_NOISE = (" - topic", " oficial")
# ----------------------------------------------------------------------------

# Every character str.strip() and str.split() treat as blank.
BLANK_CHARS = "".join(chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace())
BLANK = char_class(BLANK_CHARS)
LATIN_END = "\u0250"


def _lit(text: str) -> Column:
    return F.lit(text)


def strip(text: Column) -> Column:
    """Trim all blanks, not only the space that ``trim`` removes."""
    return F.regexp_replace(text, f"^{BLANK}+|{BLANK}+$", "")


def blank_to_null(text: Column) -> Column:
    """NULL, empty and all-blank strings become NULL."""
    return F.when(strip(text) != "", text)


def squeeze(text: Column, joiner: str = " ") -> Column:
    """Split on blanks and join with ``joiner``; no leading or trailing joiner."""
    return F.regexp_replace(strip(text), f"{BLANK}+", joiner)


def _folded(text: Column, blanks: str = "") -> Column:
    """Compatibility-decompose and drop combining marks; ``blanks`` become spaces.

    All one-to-one folds are one ``translate``.  The rare one-to-many folds
    (ligatures, fractions) are expanded only in rows that contain one, which two
    cheap patterns find out.
    """
    single, multiple = folding_tables()
    table = dict(single)
    table.update(dict.fromkeys(blanks, " "))
    folded = F.translate(text, "".join(table), "".join(table.values()))
    pairs = "\x01".join(f"{char}\x02{parts}" for char, parts in multiple.items())
    expansion = F.str_to_map(_lit(pairs), _lit("\x01"), _lit("\x02"))
    expanded = F.array_join(
        F.transform(F.split(folded, ""), lambda c: F.coalesce(F.try_element_at(expansion, c), c)), ""
    )
    latin, other = char_class(c for c in multiple if c < LATIN_END), char_class(c for c in multiple if c >= LATIN_END)
    rare = text.rlike(latin) | (text.rlike(f"[^\\x00-\\x{{{ord(LATIN_END) - 1:x}}}]") & text.rlike(other))
    return F.when(rare, expanded).otherwise(folded)


def fold_accents(text: Column) -> Column:
    return _folded(text)


def normalize_text(text: Column, hyphen_is_blank: bool = True) -> Column:
    """Matching key: no accents, no punctuation, single blanks, lower case.

    ``hyphen_is_blank=False`` is the older rule: hyphens are deleted and inner
    blanks are left alone.
    """
    text = F.coalesce(text, _lit(""))
    if not hyphen_is_blank:
        kept = F.regexp_replace(_folded(text, "_"), r"[^\p{L}\p{N}_" + BLANK[1:], "")
        return F.lower(strip(kept))
    # every blank is a space after the fold, so the cheap space rules are enough
    kept = F.regexp_replace(_folded(text, "_-" + BLANK_CHARS), r"[^\p{L}\p{N}_ ]+", "")
    return F.lower(F.trim(F.regexp_replace(kept, " {2,}", " ")))


def sanitize_title(title: Column) -> Column:
    """Delete file-unsafe characters, trim, and turn spaces into underscores."""
    safe = F.translate(title, FILE_UNSAFE_CHARS, "")
    return F.replace(strip(safe), _lit(" "), _lit("_"))


def clean_title(title: Column, channel: Column) -> Column:
    """Catalogue title: the channel name and unsafe characters removed, words
    joined by ``_``, cut to the catalogue's title length."""
    title = F.coalesce(F.nullif(title, _lit("")), _lit(UNKNOWN_TITLE))
    # replace() with an empty search string leaves the text unchanged
    title = strip(F.replace(title, F.coalesce(channel, _lit("")), _lit("")))
    title = F.translate(title, FILE_UNSAFE_CHARS + FANCY_QUOTES.replace('"', ""), "")
    title = F.replace(F.replace(title, _lit(" - "), _lit(" ")), _lit("—"), _lit(" "))
    return F.substring(squeeze(title, "_"), 1, TITLE_MAX_CHARS)


def _after_channel(title: Column, channel: Column) -> Column:
    """The rest of the title when it starts with a non-empty channel, else NULL."""
    starts = (channel != "") & F.startswith(title, channel)
    return F.when(starts, F.substring(title, F.length(channel) + 1, F.length(title)))


def strip_channel_prefix(title: Column, channel: Column) -> Column:
    """Drop a leading channel name and the separators after it."""
    title = F.coalesce(F.nullif(title, _lit("")), _lit(UNKNOWN_TITLE))
    channel = F.coalesce(F.nullif(channel, _lit("")), _lit(UNKNOWN_CHANNEL))
    rest = strip(F.ltrim(_after_channel(title, channel), _lit("-: ")))
    return F.coalesce(rest, title)


def compact_file_part(title: Column) -> Column:
    """File-name form of a title: no spaces, no unsafe characters."""
    return F.translate(title, " " + FILE_UNSAFE_CHARS, "")


def title_to_filename(title: Column, channel: Column) -> Column:
    """File-name form that keeps words apart with single underscores.

    A ``": "`` separator takes three characters with it, as observed.
    """
    title = F.coalesce(title, _lit(""))
    rest = _after_channel(title, F.coalesce(channel, _lit("")))
    cut = F.when(F.startswith(rest, _lit(" - ")) | F.startswith(rest, _lit(": ")), 3)
    cut = cut.when(F.startswith(rest, _lit("- ")), 2).otherwise(0)
    rest = F.substring(rest, cut + 1, F.length(rest))
    bare = F.replace(strip(F.coalesce(rest, title)), _lit(" "), _lit("_"))
    safe = F.translate(bare, FILE_UNSAFE_CHARS, "_" * len(FILE_UNSAFE_CHARS))
    return F.regexp_replace(safe, "__+", "_")


def sanitize_name(text: Column) -> Column:
    """Lower-case name without channel noise words."""
    text = F.lower(text)
    for noise in CHANNEL_NOISE:
        text = F.replace(text, _lit(noise), _lit(""))
    return strip(text)


def parse_stem(stem: Column) -> Column:
    """``id-song-artist`` file stems as a struct; missing parts get defaults."""
    three = r"^([\s\S]*)-([^-]*)-([^-]*)$"
    two = r"^([^-]*)-([^-]*)$"

    def part(position: int, default: Column) -> Column:
        return (
            F.when(stem.rlike(three), F.regexp_extract(stem, three, position))
            .when(stem.rlike(two) & F.lit(position < 3), F.regexp_extract(stem, two, min(position, 2)))
            .otherwise(default)
        )

    return F.struct(
        part(1, stem).alias("id"),
        part(2, _lit("")).alias("song"),
        part(3, _lit(UNKNOWN_ARTIST)).alias("artist"),
    )


def stem_id(stem: Column) -> Column:
    """Text before the first underscore."""
    return F.split_part(stem, _lit("_"), F.lit(1))


def make_query_id(artist: Column, song: Column) -> Column:
    """``artist::song`` with both sides normalised and spaces as underscores."""
    under = [F.replace(normalize_text(c), _lit(" "), _lit("_")) for c in (artist, song)]
    return F.concat_ws("::", *under)


def split_query_id(query_id: Column) -> Column:
    """Struct ``artist, song, valid``; not exactly two parts is invalid."""
    parts = F.split(query_id, "::")
    valid = F.coalesce(F.size(parts) == 2, F.lit(False))
    return F.struct(
        F.when(valid, F.get(parts, 0)).alias("artist"),
        F.when(valid, F.get(parts, 1)).alias("song"),
        valid.alias("valid"),
    )


def label(artist: Column, song: Column, artist_original: Column | None = None,
          song_original: Column | None = None) -> Column:
    """``Artist - Song``, preferring the joined original spellings."""
    artist = artist if artist_original is None else F.coalesce(artist_original, artist)
    song = song if song_original is None else F.coalesce(song_original, song)
    return F.concat(artist, _lit(" - "), song)


def token_sort(text: Column) -> Column:
    """Blank-separated tokens in code-point order, joined by one space."""
    return F.array_join(F.array_sort(F.split(squeeze(text), " ")), " ")


WORD_CHARS = 63  # strings up to here are compared in 64-bit words, many at once


def _lcs_long(a: str, b: str) -> int:
    # Bit-parallel longest common subsequence: one big-integer step per character.
    position_bits: dict[str, int] = {}
    for i, char in enumerate(a):
        position_bits[char] = position_bits.get(char, 0) | (1 << i)
    every = (1 << len(a)) - 1
    row = every
    for char in b:
        hits = row & position_bits.get(char, 0)
        row = ((row + hits) | (row - hits)) & every
    return len(a) - row.bit_count()


def _lcs_words(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    # The same recurrence with one 64-bit word per pair, all pairs side by side.
    def codes(strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        fixed = strings.astype(f"U{WORD_CHARS}")
        lengths = np.char.str_len(fixed)
        wide = np.ascontiguousarray(fixed).view(np.uint32).reshape(len(fixed), WORD_CHARS)
        return wide[:, :max(int(lengths.max(initial=0)), 1)], lengths

    a_codes, a_lengths = codes(a)
    b_codes, _ = codes(b)
    bits = np.uint64(1) << np.arange(a_codes.shape[1], dtype=np.uint64)
    every = (np.uint64(1) << a_lengths.astype(np.uint64)) - np.uint64(1)
    row = every.copy()
    for step in range(b_codes.shape[1]):
        char = b_codes[:, step:step + 1]
        hits = row & (((a_codes == char) & (char != 0)) * bits).sum(axis=1, dtype=np.uint64)
        row = ((row + hits) | (row - hits)) & every
    return a_lengths - np.bitwise_count(row)


def indel_scores(left: pd.Series, right: pd.Series) -> pd.Series:
    """``200 * LCS / (len a + len b)`` pair by pair; two empty strings score 100."""
    a_lengths, b_lengths = left.str.len(), right.str.len()
    joint = a_lengths + b_lengths
    short = ((a_lengths <= WORD_CHARS) & (b_lengths <= WORD_CHARS)).to_numpy()
    long = np.flatnonzero(~short & joint.notna().to_numpy())
    common = np.full(len(left), np.nan)
    common[short] = _lcs_words(left.to_numpy()[short], right.to_numpy()[short])
    common[long] = [_lcs_long(left.iat[i], right.iat[i]) for i in long]
    return (200.0 * common / joint.where(joint > 0)).mask(joint == 0, 100.0)


@F.pandas_udf(T.DoubleType())
def indel_ratio(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for left, right in pairs:
        yield indel_scores(left, right)


def token_sort_ratio(a: Column, b: Column) -> Column:
    """Order-insensitive similarity of two strings, 0 to 100."""
    return indel_ratio(token_sort(a), token_sort(b))
