from .cleaning import drop_stop_words, keep_language, reject_malformed, with_decade
from .counting import (
    Marginal, attach_decade_total, attach_left_marginal, attach_right_marginal,
    count_pairs_per_decade, count_rollup, decade_totals, duplicate_pairs, locate_by_left, marginals,
)
from .joining import (
    JoinLimits, Located, attach_totals, broadcast_if_small, local_table, locate, store_totals,
)
from .ordering import order_collocations, order_counts, order_scores, order_top_rows
from .quarantine import Quarantined, quarantine_ngrams
from .sampling import sample_rows, sample_rows_by_hash
from .scoring import (
    drop_whole_decade_pairs, npmi_totals, running_npmi_totals, scoped_totals,
    whole_decade_pairs, with_npmi, with_relative_npmi,
)
from .selecting import (
    drop_high_scores, drop_repeated_scores, drop_self_pairs, keep_high_scores, top_k_per_decade,
)
from .uniqueness import find_duplicate_pairs, require_unique_pairs

__all__ = [
    "JoinLimits", "Located", "Marginal", "Quarantined", "attach_decade_total", "attach_left_marginal", "attach_right_marginal",
    "attach_totals", "broadcast_if_small", "count_pairs_per_decade", "count_rollup",
    "decade_totals", "drop_high_scores", "drop_repeated_scores", "drop_self_pairs",
    "drop_stop_words", "drop_whole_decade_pairs", "duplicate_pairs", "find_duplicate_pairs", "keep_high_scores",
    "keep_language", "local_table", "locate", "locate_by_left",
    "marginals", "npmi_totals", "order_collocations", "order_counts",
    "order_scores", "order_top_rows", "quarantine_ngrams", "reject_malformed", "require_unique_pairs", "running_npmi_totals",
    "sample_rows", "sample_rows_by_hash", "scoped_totals", "store_totals", "top_k_per_decade",
    "whole_decade_pairs", "with_decade", "with_npmi", "with_relative_npmi",
]
