from .documents import as_lines, document_bigrams
from .ngrams import read_lines, read_ngrams, split_ngrams
from .stop_words import read_stop_words
from .stored import (
    load_pair_counts, load_pair_scores, read_collocation_lines, read_pair_count_lines,
    read_pair_score_lines,
)

__all__ = [
    "as_lines", "document_bigrams", "load_pair_counts", "load_pair_scores",
    "read_collocation_lines", "read_lines", "read_ngrams", "read_pair_count_lines",
    "read_pair_score_lines", "read_stop_words", "split_ngrams",
]
