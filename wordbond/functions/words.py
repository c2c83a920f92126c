"""Column expressions on single words and years."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The languages and the letters a word may consist of.
# \A..\z is used because ^..$ also accepts a trailing line break.
WORD_PATTERNS = {
    "english": r"\A[a-z]+\z",
    "hebrew": r"\A[א-ת]+\z",
}


def check_language(language: str) -> str:
    if language not in WORD_PATTERNS:
        raise ValueError(f"language must be one of {sorted(WORD_PATTERNS)}, not {language!r}")
    return language


def fold_case(word: Column | str, language: str) -> Column:
    """Lower-case English words; Hebrew has no case and is left alone."""
    word = F.col(word) if isinstance(word, str) else word
    return F.lower(word) if check_language(language) == "english" else word


def in_alphabet(word: Column | str, language: str) -> Column:
    """True if the word has at least one letter and only letters of the language."""
    word = F.col(word) if isinstance(word, str) else word
    return word.rlike(WORD_PATTERNS[check_language(language)])


def decade_of(year: Column | str) -> Column:
    """The year with its last digit set to zero, in integer arithmetic."""
    year = F.col(year) if isinstance(year, str) else year
    return year - year % F.lit(10)
