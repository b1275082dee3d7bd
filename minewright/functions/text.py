"""Token predicates, normalisation and tokenising as Column expressions."""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The token pattern and the marker words that results must agree on. The last class of the pattern
# holds the range from ':' to '_'. (?U) makes \w and \d follow Unicode.
TOKEN_PATTERN = r"(?U)(?:[A-Z]\.)+|\d+(?:\.\d+)?%?|\w+(?:[-']\w+)*|\.\.\.|(?:[.,;\"'?():-_`])"
NUM_WORD = "$NUM$"
UNK_WORD = "$UNK$"
NUM_TOKEN = "<NUM>"
ENG_TOKEN = "<ENG>"
UNK_TOKEN = "<UNK>"
PAD_TOKEN = "<PAD>"
TIME_TAG = "B-TIME"
DATE_SUFFIXES = "年月日"


def _digit_class() -> str:
    """Regex class of the characters that count as digits, by Python's tables: those of the JVM may know fewer scripts."""
    points = [c for c in range(sys.maxunicode + 1) if chr(c).isdigit()]
    first = [c for c in points if not chr(c - 1).isdigit()]
    last = [c for c in points if not chr(c + 1).isdigit()]
    return "[" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in zip(first, last, strict=True)) + "]"


_DIGIT = _digit_class()
# Only a word with this start can hold digits of other scripts; others are spared the long class.
_OTHER_SCRIPT = r"^[0-9]*[^\x00-\x7F]"


def _digits_then(word: Column, rest: str) -> Column:
    """True when the word is one or more digits of any script and then ``rest``."""
    return word.rlike(rf"^[0-9]+{rest}\z") | (word.rlike(_OTHER_SCRIPT) & word.rlike(rf"^{_DIGIT}+{rest}\z"))


def is_ascii_word(word: Column) -> Column:
    """True when no character lies above U+007F."""
    return ~word.rlike(r"[^\x00-\x7F]")


def is_latin_alpha_word(word: Column) -> Column:
    """True when every character is one of A-Z, a-z; the empty word counts."""
    return word.rlike(r"^[A-Za-z]*\z")


def is_number_token(word: Column) -> Column:
    """True when the word is one or more digits of any script."""
    return _digits_then(word, "")


def keep_token(word: Column, stopwords: Sequence[str], drop_single_symbols: bool = True) -> Column:
    """True for ASCII words that are not stop words (compared in lower case) and not one lone symbol."""
    lowered = F.lower(word)
    kept = is_ascii_word(lowered)
    if stopwords:
        kept = kept & ~lowered.isin(*stopwords)
    if drop_single_symbols:
        kept = kept & ((F.char_length(word) != 1) | word.rlike(r"^\p{L}"))
    return kept


def tokenize(text: Column) -> Column:
    """Array of tokens: abbreviations, numbers, words with inner hyphens or apostrophes, ellipses, punctuation."""
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))


def letter_runs(text: Column) -> Column:
    """Array of maximal runs of letters."""
    return F.filter(F.split(text, r"[^\p{L}]+"), lambda w: w != "")


def whitespace_tokens(text: Column) -> Column:
    """Array of whitespace-separated tokens."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def word_runs(text: Column, stopwords: Sequence[str] = ()) -> Column:
    """Array of lower-case tokens of two or more word characters without stop words."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\b\w\w+\b"), F.lit(0))
    return F.filter(words, lambda w: ~w.isin(*stopwords)) if stopwords else words


def normalize_word(word: Column, lowercase: bool = False) -> Column:
    """First normal form: optional lower case, digits become ``$NUM$``."""
    word = F.lower(word) if lowercase else word
    return F.when(is_number_token(word), F.lit(NUM_WORD)).otherwise(word)


def normalize_mixed_word(word: Column) -> Column:
    """Second normal form: digits become ``<NUM>``, Latin-letter words ``<ENG>``."""
    return (
        F.when(is_number_token(word), F.lit(NUM_TOKEN))
        .when(is_latin_alpha_word(word), F.lit(ENG_TOKEN))
        .otherwise(word)
    )


def date_rule(word: Column, tag: Column) -> Column:
    """``B-TIME`` where the word is digits followed by a year, month or day sign, else the given tag."""
    return F.when(_digits_then(word, f"[{DATE_SUFFIXES}]"), F.lit(TIME_TAG)).otherwise(tag)


def characters(word: Column) -> Column:
    """Array of the characters of a word."""
    return F.filter(F.split(word, ""), lambda c: c != "")
