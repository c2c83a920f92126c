from .association import npmi, pmi, relative, share
from .sums import exact_sum, rounded
from .words import WORD_PATTERNS, check_language, decade_of, fold_case, in_alphabet

__all__ = [
    "WORD_PATTERNS", "check_language", "decade_of", "exact_sum", "fold_case", "in_alphabet",
    "npmi", "pmi", "relative", "rounded", "share",
]
