"""String helpers: stripping, word tokens, stop words, codes, keyboard neighbours."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word token: an ASCII letter followed by ASCII letters or digits of any script.
WORD_PATTERN = r"[a-zA-Z][a-zA-Z\p{Nd}]*"

# Four capitals, a no-break space, five digits.
COURSE_CODE_PATTERN = r"([A-Z]{4})\x{A0}(\p{Nd}{5})"

# Words the keyword index leaves out (compared before lowercasing).
STOP_WORDS = [
    "a", "also", "an", "and", "are", "as", "at", "be", "but", "by", "course", "for", "from", "how", "i",
    "ii", "iii", "in", "include", "is", "not", "of", "on", "or", "s", "sequence", "so", "social",
    "students", "such", "that", "the", "their", "this", "through", "to", "topics", "units", "we", "were",
    "which", "will", "with", "yet",
]

# Keys next to each key, in listing order.
NEARBY_KEYS = {
    "q": ["w", "a"],
    "w": ["q", "e", "s"],
    "e": ["w", "r", "d"],
    "r": ["e", "t", "f"],
    "t": ["r", "y", "g"],
    "y": ["t", "u", "h"],
    "u": ["y", "i", "j"],
    "i": ["u", "o", "k"],
    "o": ["i", "p", "l"],
    "p": ["o"],
    "a": ["q", "s", "z"],
    "s": ["w", "a", "d", "z", "x"],
    "d": ["e", "s", "f", "x", "c"],
    "f": ["r", "d", "g", "c", "v"],
    "g": ["t", "f", "h", "v", "b"],
    "h": ["y", "g", "j", "b", "n"],
    "j": ["u", "h", "k", "n", "m"],
    "k": ["i", "j", "l", "m"],
    "l": ["o", "k"],
    "z": ["s", "x"],
    "x": ["z", "s", "d", "c"],
    "c": ["x", "v", "f"],
    "v": ["c", "b", "f", "g"],
    "b": ["v", "n", "g", "h"],
    "n": ["b", "m", "h", "j"],
    "m": ["n", "j", "k"],
}


def strip(text: Column) -> Column:
    """Remove blanks of any kind (not just spaces) from both ends."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def word_tokens(text: Column) -> Column:
    """Every word token of a text, in order, repeats kept."""
    return F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))


def long_word_tokens(text: Column, least: int) -> Column:
    """The word tokens of at least so many characters; the shorter ones never become strings. A token follows no
    letter, and what is left of one that is too short is shorter still."""
    pattern = rf"(?<![a-zA-Z])[a-zA-Z][a-zA-Z\p{{Nd}}]{{{least - 1},}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def index_words(title: Column, desc: Column, lower_first: bool = False) -> Column:
    """Distinct lower-case words of a title and a description without the stop words.

    The stop list is compared before lowercasing, so "The" stays in unless ``lower_first``.
    """
    words = F.concat(
        word_tokens(F.coalesce(title, F.lit(""))), word_tokens(F.coalesce(desc, F.lit("")))
    )
    if lower_first:
        words = F.transform(words, F.lower)
    kept = F.array_except(words, F.array(*[F.lit(w) for w in STOP_WORDS]))
    return F.array_distinct(F.transform(kept, F.lower))


def course_code(title: Column) -> Column:
    """Code such as "CMSC 12200" found in a block title, null when there is none."""
    letters = F.regexp_extract(title, COURSE_CODE_PATTERN, 1)
    digits = F.regexp_extract(title, COURSE_CODE_PATTERN, 2)
    return F.when(letters != "", F.concat_ws(" ", letters, digits))


def nearby_keys(key: Column) -> Column:
    """Array of keys next to ``key`` on the keyboard, empty for anything but a lower-case letter."""
    table = F.create_map(
        *[c for letter, keys in NEARBY_KEYS.items() for c in (F.lit(letter), F.array(*map(F.lit, keys)))]
    )
    return F.coalesce(F.try_element_at(table, key), F.array().cast("array<string>"))


def search_terms(terms: Column) -> Column:
    """Terms of a query string: split on single spaces, empty terms kept."""
    return F.split(terms, " ", -1)
