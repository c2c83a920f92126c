"""Association scores of word pairs in large n-gram corpora, on Spark."""

from .operators import JoinLimits
from .plans import (
    clean_ngrams, collocations, count_pairs, score_ngrams, score_pairs, select_collocations,
    top_collocations,
)
from .settings import spark_settings
from .workspace import Workspace

__all__ = [
    "JoinLimits", "Workspace", "clean_ngrams", "collocations", "count_pairs", "score_ngrams",
    "score_pairs", "select_collocations", "spark_settings", "top_collocations",
]
