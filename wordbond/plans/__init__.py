from .collocations import (
    NGRAM_COLUMNS,
    clean_ngrams, collocations, count_pairs, score_ngrams, score_pairs, select_collocations,
    top_collocations,
)

__all__ = [
    "NGRAM_COLUMNS",
    "clean_ngrams", "collocations", "count_pairs", "score_ngrams", "score_pairs",
    "select_collocations", "top_collocations",
]
