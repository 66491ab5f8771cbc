"""Token counts by a finite-state transducer compiled from a piece vocabulary.

The library merges, in a text of single characters, the adjacent pair with the
best score (the leftmost of equals) until no pair is a piece.  Whether two
neighbouring pieces stay apart depends on those two alone, so the last piece of
every prefix of a text follows from a bounded suffix of it: a deterministic
transducer.  Its state is the list of places at which a piece may still be
growing, each with the piece that ends there; a transition reads one character
and carries by how much the token count changes.  States are compiled when a text
first reaches them.

A word with the blanks before it is a chunk.  No piece reaches from a letter over
a blank, so the map of a chunk from entry state to exit state and count is the
same constant from every state: such maps compose by addition, in any order, and
each distinct chunk is run once per table.  Chunks of any length are run whole.
"""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import sentencepiece
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

BLANK = "▁"
TABLE_CHUNKS = 400_000
TABLE_CHUNK_CHARS = 64
TABLE_STATES = 300_000
TABLE_PAIRS = 400_000
#: More than any change of the count by one character: a piece has up to 16 characters, a character up to 4 bytes.
WIDTH = 128

#: A place: the characters read since it, the piece that ends at it ("" where any
#: piece may follow) and the token count there against the count now.
Place = tuple[str, str, int]


class Transducer:
    """Lazily compiled transducer over the characters of a text whose blanks are marked."""

    START = 0

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.growing = {piece[:n]: piece[:n] for piece in scores for n in range(len(piece))}
        self.inner = {piece[n:n + 2] for piece in scores for n in range(len(piece) - 1)}
        self.apart: dict[tuple[str, str], bool] = {}
        self.reset()

    def reset(self) -> None:
        self.places: dict[Place, Place] = {}
        self.states: list[tuple[Place, ...]] = [(("", "", 0),)]
        self.numbers = {self.states[0]: 0}
        self.moves: list[dict[str, int]] = [{}]

    def merge(self, text: str) -> list[str]:
        """The pieces of a short ``text``: best score first, leftmost of equals."""
        symbols, score = list(text), self.scores.get
        while True:
            best, at = None, -1
            for left in range(len(symbols) - 1):
                found = score(symbols[left] + symbols[left + 1])
                if found is not None and (best is None or found > best):
                    best, at = found, left
            if best is None:
                return symbols
            symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]

    def stays_apart(self, left: str, piece: str) -> bool:
        """Whether ``piece`` can follow the piece ``left`` as a token of its own."""
        key = (left, piece)
        known = self.apart.get(key)
        if known is None:
            known = self.apart[key] = self.merge(left + piece) == ([left, piece] if left else [piece])
        return known

    def move(self, state: int, char: str) -> int:
        """Next state and change of the token count in one number, compiled on first use."""
        if char not in self.scores:  # spelt in bytes, and no piece reaches over it
            number, count = self.START, len(char.encode())
        else:
            grown = [(read + char, last, count) for read, last, count in self.states[state]]
            piece, count = next((read, count + 1) for read, last, count in grown
                                if read in self.scores and self.stays_apart(last, read))
            places = []
            for read, last, at in grown:
                if read in self.growing:
                    free = not last or last[-1] + read[0] not in self.inner
                    place = (self.growing[read], "" if free else last, at - count)
                    places.append(self.places.setdefault(place, place))
            place = ("", self.growing.get(piece, piece), 0)
            places.append(self.places.setdefault(place, place))
            key = tuple(places)
            number = self.numbers.setdefault(key, len(self.states))
            if number == len(self.states):
                self.states.append(key)
                self.moves.append({})
        step = self.moves[state][char] = number * WIDTH + count + WIDTH // 2
        return step

    def run(self, chunk: str) -> int:
        """The constant that the chunk's state map adds to a count."""
        moves, state, total = self.moves, self.START, 0
        for char in chunk:
            step = moves[state].get(char) or self.move(state, char)
            state = step // WIDTH
            total += step % WIDTH
        return total - len(chunk) * (WIDTH // 2)


CHUNK = re.compile(f"{BLANK}+[^{BLANK}]*|[^{BLANK}]+")
#: Marks a chunk that no blank precedes.
FIRST = "\0first:"


def _chunks(text: str, leading: bool) -> list[str]:
    """Chunks of a text; a leading single blank is left away, as almost all have it."""
    if leading and BLANK not in text and "  " not in text and text[0] != " " and text[-1] != " " and FIRST not in text:
        return text.split(" ")
    found = CHUNK.findall((BLANK if leading else "") + text.replace(" ", BLANK))
    return [chunk if chunk[0] == BLANK else FIRST + chunk for chunk in found]


def _spelt(chunk: str) -> str:
    if chunk.startswith(FIRST):
        return chunk[len(FIRST):]
    return chunk if chunk.startswith(BLANK) else BLANK + chunk


@lru_cache(maxsize=2)
def _transducer(model: bytes) -> tuple[Transducer, bool]:
    with tempfile.NamedTemporaryFile(suffix=".model") as file:
        file.write(model)
        file.flush()
        pieces = sentencepiece.SentencePieceProcessor(model_file=file.name)
    scores = {pieces.id_to_piece(i): pieces.get_score(i) for i in range(pieces.get_piece_size())
              if not (pieces.is_unknown(i) or pieces.is_control(i) or pieces.is_byte(i) or pieces.is_unused(i))}
    crossing = any(a != BLANK and b == BLANK for piece in scores for a, b in zip(piece, piece[1:]))
    if crossing or "\n" in "".join(scores):
        raise ValueError("pieces reach over the borders of chunks")
    if any(char not in scores for piece in scores for char in piece):
        raise ValueError("a piece holds a character that is no piece")
    return Transducer(scores), pieces.encode(".", out_type=str)[0].startswith(BLANK)


def counter(spark: SparkSession, model_path: str):
    """Function from a text column to its number of tokens, without begin and end tokens.

    For models of merged pieces with byte fallback and without text normalisation.
    A null or an empty text has 0 tokens; texts are counted whole.
    """
    with open(model_path, "rb") as file:
        model = spark.sparkContext.broadcast(file.read())

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        transducer, leading = _transducer(model.value)
        table: dict[str, int] = {}
        for batch in batches:
            counts = []
            for value in batch:
                text = value.as_py()
                if not text:
                    counts.append(0)
                    continue
                chunks = _chunks(text, leading)
                for chunk in set(chunks).difference(table):
                    table[chunk] = transducer.run(_spelt(chunk))
                counts.append(sum(map(table.__getitem__, chunks)))
                if len(table) > TABLE_CHUNKS:
                    table.clear()
                if len(transducer.states) > TABLE_STATES:
                    transducer.reset()
                if len(transducer.apart) > TABLE_PAIRS:
                    transducer.apart.clear()
            for chunk in [chunk for chunk in table if len(chunk) > TABLE_CHUNK_CHARS]:
                del table[chunk]
            yield pa.array(counts, pa.int64())

    return count
