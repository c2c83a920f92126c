from .lines import collocation_lines, save_collocation_lines, save_sequence_lines, save_top_listing
from .merging import merge_pair_counts
from .tables import (
    save_pair_count_lines, save_pair_counts, save_pair_score_lines, save_pair_scores,
)

__all__ = [
    "collocation_lines", "merge_pair_counts", "save_collocation_lines", "save_pair_count_lines", "save_pair_counts",
    "save_pair_score_lines", "save_pair_scores", "save_sequence_lines", "save_top_listing",
]
