"""What the toxicity operator does to single texts in its tasks: features, terms of words, weights of words."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

PARTS = 3
#: The least weight of a word that counts, and that of a strong one, as ln of odds.
LEAST_WEIGHT, STRONG = 1.0, 2.0
#: Lengths of the pieces of words, ends of words counted as letters.
PIECES = (5, 7)
CACHED_WORDS, CACHED_LISTS, CACHED_LETTERS, COUNTED_TERMS = 150_000, 20_000, 60, 200_000

#: Insults, and words of the second person, by language.
INSULTS = """
    asshole bastard bitch clown coward creep cretin degenerate disgrace disgusting dumb dumbass fool freak garbage
    idiot idiotic idiots imbecile jerk liar loser losers lowlife maggot moron moronic morons nasty parasite pathetic
    pig pigs rat rubbish scum scumbag slob stupid swine trash ugly useless vermin vile worthless
    abschaum arschloch blöd depp dreck dumm dummkopf ekelhaft erbärmlich idioten miststück schwachkopf trottel
    versager wertlos
    abruti connard crétin débile dégoûtant imbécile idiote minable ordure pathétique raclure salaud stupide
    basura bobo escoria estúpido idiota imbécil inútil maldito patético perdedor tonto
""".split()
SECOND_PERSON = """
    you your yours yourself youre ur u du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos
    tú ti tuyo usted ustedes vosotros
""".split()
#: Symbols that stand for letters.
LOOKALIKES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "|": "i"})

FEATURES = ("insults", "insult_share", "insult_kinds", "disguised", "near_you", "you_share",
            "capitals", "shouted", "punctuation", "exclamations", "symbols", "digits", "stretched",
            "repeated_words", "words", "word_length", "doubtful",
            "learnt", "learnt_share", "learnt_kinds", "learnt_sum", "learnt_mean", "learnt_most", "learnt_near")
NEAR = 5
MARKS = ".,;:?!'\"()[]{}<>%&$*#~^=+-_/|"

KNOWN_INSULTS, _you = frozenset(INSULTS), frozenset(SECOND_PERSON)
_word = re.compile(r"[^\W\d_]+")
_spaced = re.compile(r"(?<![^\W_])(?:[^\W\d_] ){3,}[^\W\d_](?![^\W_])")
_long_run = re.compile(r"([^\W\d_])\1{2,}")
#: Insults by first letter, last letter and length, for those whose middle is starred out.
_starred = frozenset((word[0], word[-1], len(word)) for word in INSULTS if len(word) > 3)


def _disguised(text: str, tokens: list[str], stretched: bool, insults: frozenset[str]) -> int:
    """Kinds of insults written with look-alike symbols, stars, gaps or stretched letters."""
    found = 0
    for token in set(tokens):
        piece = token.strip(MARKS)
        if piece.isalpha() and not stretched:
            continue
        letters = re.sub(r"[^\w]|[\d_]", "", piece)
        spelt = token.strip(".,;:?\"()").translate(LOOKALIKES)
        if letters not in insults and spelt in insults:
            found += 1
        elif not piece.isalpha() and letters in insults and len(letters) > 3 and re.fullmatch(r"\w([.*_-]+\w)+", piece):
            found += 1
        elif "*" in piece and re.fullmatch(r"\w[*#]+\w", piece):
            found += (piece[0], piece[-1], len(piece)) in _starred
        elif stretched and letters not in insults and _long_run.search(letters):
            found += _long_run.sub(r"\1", letters) in insults or _long_run.sub(r"\1\1", letters) in insults
    if sum(len(token) == 1 for token in tokens) > 3:
        for match in _spaced.finditer(text):
            letters = match.group().replace(" ", "")
            found += any(word in letters for word in insults if len(word) > 3)
    return found


def _kinds() -> np.ndarray:
    """For each code point below 0x3000: 1 small letter, 2 capital, 3 digit, 4 space, 5 sentence mark, 6 other symbol."""
    kinds = np.full(0x3001, 1, np.uint8)
    for code in range(0x3000):
        char = chr(code)
        kinds[code] = (2 if char.isupper() else 1 if char.isalpha() else 3 if char.isdigit() else 4 if char.isspace()
                       else 5 if char in ".,;:?!'\"()-" else 6)
    return kinds


KINDS = _kinds()


def word_terms(word: str) -> list[str]:
    """The word and its pieces, with marks at its ends."""
    marked = f"^{word}$"
    terms, letters = [marked], len(marked)
    for size in PIECES:
        if letters > size:
            terms += [marked[at:at + size] for at in range(letters - size + 1)]
    return terms


class Lexicon(dict):
    """Weight of a word: the largest that it or a piece of it has; a bounded cache over the weights of the terms."""

    def __init__(self, weights: dict[str, float], cached: int = CACHED_WORDS):
        super().__init__()
        self.weights, self.cached = weights, cached

    def __missing__(self, word: str) -> float:
        weight = max(map(self.weights.get, word_terms(word), repeat(0.0)))
        if len(word) <= CACHED_LETTERS:
            if len(self) >= self.cached:
                self.clear()
            self[word] = weight
        return weight


NO_WORDS = Lexicon({})


def features(text: str, insults: frozenset[str] = KNOWN_INSULTS, learnt: Lexicon = NO_WORDS) -> list[float]:
    """The values of ``FEATURES`` for one whole text; all 0 for an empty one.

    Words of the lexicon outside ``insults`` count as doubtful.
    """
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    kinds_at = KINDS[np.minimum(codes, 0x3000)]
    kinds = np.bincount(kinds_at, minlength=7)
    runs = (codes[2:] == codes[1:-1]) & (codes[1:-1] == codes[:-2]) & (kinds_at[2:] < 3)
    stretched = int(runs.sum())
    lower = text.lower()
    words, tokens = _word.findall(lower), lower.split()
    kinds_of_word = set(words)
    count, chars, letters = max(len(words), 1), max(len(text), 1), max(int(kinds[1] + kinds[2]), 1)
    hits = [] if kinds_of_word.isdisjoint(insults) else [n for n, word in enumerate(words) if word in insults]
    doubtful = 0 if kinds_of_word.isdisjoint(KNOWN_INSULTS - insults) else sum(word in KNOWN_INSULTS and word not in insults for word in words)
    yous = sum(map(_you.__contains__, words))
    weights = {word: weight for word in kinds_of_word if (weight := learnt[word]) >= LEAST_WEIGHT} if learnt.weights else {}
    strong = {word for word, weight in weights.items() if weight >= STRONG}
    marked = [n for n, word in enumerate(words) if word in strong] if strong else []
    near = near_learnt = 0
    if yous:
        near, near_learnt = (sum(not _you.isdisjoint(words[max(n - NEAR, 0):n + NEAR + 1]) for n in places) for places in (hits, marked))
    shouted = sum(len(token) > 2 and token.isupper() for token in text.split()) if kinds[2] > 0.1 * letters else 0
    return [
        float(len(hits)), 1000 * len(hits) / count, float(len({words[n] for n in hits})),
        float(_disguised(lower, tokens, stretched > 0, insults)), float(near), yous / count,
        kinds[2] / letters, shouted / count, kinds[5] / chars, lower.count("!") / chars, kinds[6] / chars, kinds[3] / chars,
        stretched / chars, 1 - len(kinds_of_word) / count, float(np.log1p(len(words))), letters / count, float(doubtful),
        float(len(marked)), 1000 * len(marked) / count, float(len(strong)), sum(weights.values()),
        sum(weights.values()) / max(len(kinds_of_word), 1), max(weights.values(), default=0.0), float(near_learnt),
    ]


def feature_array(insults: frozenset[str] = KNOWN_INSULTS, weights: Sequence[dict[str, float]] = ({},)):
    """Function from a text and the number of one of the lexicons ``weights`` to ``features``."""
    @F.arrow_udf(ArrayType(DoubleType()))
    def values(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        lexicons = [Lexicon(own, CACHED_WORDS // len(weights)) for own in weights]
        for texts, parts in batches:
            yield pa.array([features(text.as_py() or "", insults, lexicons[part]) for text, part in zip(texts, parts.to_pylist())],
                           pa.list_(pa.float64()))

    return values


@F.arrow_udf(ArrayType(StringType()))
def lexicon_words(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """The kinds of lexicon words that a text holds."""
    for batch in batches:
        yield pa.array([sorted(KNOWN_INSULTS.intersection(_word.findall((value.as_py() or "").lower()))) for value in batch], pa.list_(pa.string()))


def term_counter(candidates: dict[str, int] | None):
    """Function for ``mapInArrow`` from ``text, part`` to ``term, part, texts``; only the ``candidates``, by number, if given.

    Counts leave in pieces of bounded size and are added up by the caller.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[Counter] = [Counter() for _ in range(PARTS)]
        known: dict[str, list] = {}

        def counted() -> pa.RecordBatch:
            sizes = [len(own) for own in found]
            columns = [pa.array([term for own in found for term in own], pa.int32() if candidates else pa.string()),
                       pa.array(np.repeat(np.arange(PARTS, dtype=np.int32), sizes)), pa.array([n for own in found for n in own.values()], pa.int64())]
            for own in found:
                own.clear()
            return pa.RecordBatch.from_arrays(columns, ["term", "part", "texts"])

        for batch in batches:
            for text, part in zip(batch["text"], batch["part"].to_pylist()):
                own = set()
                for word in set(_word.findall((text.as_py() or "").lower())):
                    terms = known.get(word)
                    if terms is None:
                        if len(known) >= CACHED_LISTS:
                            known.clear()
                        terms = [candidates[of] for of in word_terms(word) if of in candidates] if candidates else word_terms(word)
                        if len(word) <= CACHED_LETTERS:
                            known[word] = terms
                    own.update(terms)
                found[part].update(own)
                if sum(map(len, found)) >= COUNTED_TERMS:
                    yield counted()
        yield counted()

    return count
