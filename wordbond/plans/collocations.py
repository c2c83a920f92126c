"""The user's entry points: from n-gram rows to the best pairs of each decade."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from ..functions.words import check_language
from ..operators.cleaning import check_mode, drop_stop_words, keep_language, reject_malformed, with_decade
from ..operators.counting import (
    LEFT_LEVEL, RIGHT_LEVEL, Marginal, attach_decade_total, attach_left_marginal, attach_right_marginal,
    count_pairs_per_decade, locate_by_left, marginals,
)
from ..operators.joining import JoinLimits, attach_totals, store_totals
from ..operators.ordering import order_collocations, order_top_rows
from ..operators.quarantine import quarantine_ngrams
from ..operators.sampling import check_fraction, sample_rows, sample_rows_by_hash
from ..operators.scoring import TOTAL_SCOPES, scoped_totals, with_npmi, with_relative_npmi
from ..operators.selecting import (
    drop_high_scores, drop_repeated_scores, drop_self_pairs as without_self_pairs,
    keep_high_scores, top_k_per_decade,
)
from ..operators.uniqueness import require_unique_pairs
from ..settings import require_ansi, shuffle_tasks
from ..sources.ngrams import bounded_splits, check_split_size, read_lines, split_ngrams
from ..sources.stop_words import read_stop_words
from ..workspace import Workspace

SAMPLE_METHODS = ("row", "hash", "fields")
QUARANTINE = "QUARANTINE"
NGRAM_COLUMNS = ("w1", "w2", "year", "match_count")


def _check_threshold(name: str, value: float) -> None:
    if not value >= 0:
        raise ValueError(f"{name} must be a number of at least 0")


def clean_ngrams(
    ngrams: DataFrame,
    stop_words: DataFrame | str | Iterable[str] | None = None,
    *,
    language: str,
    fraction: float = 1.0,
    seed: int | None = None,
    sample_by: str = "row",
    mode: str = "FAILFAST",
    quarantine: str | None = None,
    workspace: Workspace | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Sample, split and filter n-gram records into ``decade, w1, w2, match_count``.

    ``ngrams`` is a table of lines (column ``value``) or of ``w1, w2, year,
    match_count``. ``stop_words`` is a table (column ``word``), a file path or
    words. ``sample_by="hash"`` samples lines by their text, ``"fields"`` rows by the
    text of their four fields. ``mode="QUARANTINE"`` takes lines, stores the clean rows at once and
    saves bad ones with reason and file to the folder ``quarantine``. Otherwise ``tasks`` bounds
    the tasks of a scan in many small splits: each then takes several, one after the other.
    """
    require_ansi(ngrams.sparkSession)
    check_language(language), check_fraction(fraction)
    if (mode == QUARANTINE) != (quarantine is not None):
        raise ValueError(f"mode={QUARANTINE!r} and a folder named by quarantine go together")
    if mode != QUARANTINE:
        check_mode(mode)
    elif "value" not in ngrams.columns:
        raise ValueError(f"mode={QUARANTINE!r} needs a table of lines")
    if sample_by not in SAMPLE_METHODS:
        raise ValueError(f"sample_by must be one of {SAMPLE_METHODS}, not {sample_by!r}")
    if sample_by == "hash":
        if "value" not in ngrams.columns:
            raise ValueError("sample_by='hash' needs a table of lines; for one of fields take 'fields'")
        ngrams = sample_rows_by_hash(ngrams, fraction)
    elif sample_by == "fields":
        if "value" in ngrams.columns:
            raise ValueError("sample_by='fields' needs a table of w1, w2, year, match_count")
        ngrams = sample_rows_by_hash(ngrams, fraction, NGRAM_COLUMNS)
    else:
        ngrams = sample_rows(ngrams, fraction, seed)
    if isinstance(stop_words, str):
        stop_words = read_stop_words(ngrams.sparkSession, stop_words)
    if mode == QUARANTINE:
        workspace = workspace or Workspace(ngrams.sparkSession)
        return quarantine_ngrams(ngrams, stop_words, language, workspace, quarantine).kept
    if tasks is not None:  # below the joins, which each split would set up again
        ngrams = ngrams.coalesce(tasks)
    if "value" in ngrams.columns:
        ngrams = split_ngrams(ngrams, mode)
    kept = drop_stop_words(keep_language(ngrams, language), stop_words)
    return with_decade(reject_malformed(kept, mode))


def _counted(
    cleaned: DataFrame, workspace: Workspace, limits: JoinLimits, split_size: int | None = None, located: bool = False
) -> tuple[DataFrame, dict[int, Marginal]]:
    with bounded_splits(cleaned.sparkSession, split_size):  # the one scan of the input
        pairs = workspace.store(count_pairs_per_decade(cleaned), "pairs")
    counted = marginals(pairs, workspace, limits=limits)
    if not located or counted[LEFT_LEVEL].size.bytes <= limits.broadcast_bytes:
        with_left = attach_left_marginal(pairs, counted)
    else:  # stored by first word, so that whoever reads the counts joins in place
        with_left = locate_by_left(pairs, counted, workspace).attach()
    pair_counts = attach_decade_total(with_left, counted)
    return pair_counts.select("decade", "w1", "w2", "c12", "n", "c1"), counted


def count_pairs(
    ngrams: DataFrame,
    stop_words: DataFrame | str | Iterable[str] | None = None,
    *,
    workspace: Workspace | None = None,
    limits: JoinLimits = JoinLimits(),
    **cleaning,
) -> DataFrame:
    """``decade, w1, w2, c12, n, c1``: counts of each pair, its decade and first word.

    Takes the keyword arguments of :func:`clean_ngrams`.
    """
    workspace = workspace or Workspace(ngrams.sparkSession)
    cleaned = clean_ngrams(ngrams, stop_words, workspace=workspace, **cleaning)
    return _counted(cleaned, workspace, limits, located=True)[0]


def _scored(pair_counts: DataFrame, counted: dict[int, Marginal]) -> DataFrame:
    return with_npmi(attach_right_marginal(pair_counts, counted)).select(
        "decade", "w1", "w2", "c12", "n", "c1", "c2", "npmi"
    )


def score_pairs(
    pair_counts: DataFrame,
    *,
    workspace: Workspace | None = None,
    stored: bool = False,
    validate: bool = True,
    limits: JoinLimits = JoinLimits(),
) -> DataFrame:
    """Add the second word's count ``c2`` and the score ``npmi``.

    The counts are read twice, so they are stored first unless ``stored`` says
    that they already come from files. ``validate`` raises if a pair has several
    rows in a decade, which costs three scans of the keys and a shuffle of packed
    hashes; :func:`count_pairs` never gives any, so switch it off for its result.
    """
    workspace = workspace or Workspace(pair_counts.sparkSession)
    if not stored:
        pair_counts = workspace.store(pair_counts, "pair-counts")
    if validate:
        require_unique_pairs(pair_counts, workspace, stored=True)
    counted = marginals(pair_counts, workspace, levels=(RIGHT_LEVEL,), limits=limits)
    return _scored(pair_counts, counted)


def score_ngrams(
    ngrams: DataFrame,
    stop_words: DataFrame | str | Iterable[str] | None = None,
    *,
    workspace: Workspace | None = None,
    limits: JoinLimits = JoinLimits(),
    split_size: int | None = None,
    **cleaning,
) -> DataFrame:
    """:func:`count_pairs` and :func:`score_pairs` in one, sharing all marginals.

    The counts are read once here, so they are not stored by first word. Takes the keyword arguments of :func:`clean_ngrams`. ``split_size`` bounds the
    bytes of one split of the scan below ``ngrams``; a task counts several of them where
    there are more than the session has shuffle partitions and cores.
    """
    check_split_size(split_size)
    workspace = workspace or Workspace(ngrams.sparkSession)
    if split_size is not None:
        cleaning.setdefault("tasks", shuffle_tasks(ngrams.sparkSession))
    cleaned = clean_ngrams(ngrams, stop_words, workspace=workspace, **cleaning)
    return _scored(*_counted(cleaned, workspace, limits, split_size))


def select_collocations(
    scores: DataFrame,
    *,
    min_npmi: float,
    rel_min_npmi: float,
    total_scope: str = "decade",
    buckets: int = 11,
    ordered: bool = True,
    workspace: Workspace | None = None,
    stored: bool = False,
    limits: JoinLimits = JoinLimits(),
) -> DataFrame:
    """Add ``total_npmi`` and ``rel_npmi``; keep pairs that reach either threshold.

    ``total_scope="running"`` adds to a decade's total those of the earlier
    decades with the same ``decade % buckets``.
    """
    _check_threshold("min_npmi", min_npmi)
    _check_threshold("rel_min_npmi", rel_min_npmi)
    if total_scope not in TOTAL_SCOPES:
        raise ValueError(f"total_scope must be one of {TOTAL_SCOPES}, not {total_scope!r}")
    workspace = workspace or Workspace(scores.sparkSession)
    if not stored:
        scores = workspace.store(scores, "scores")
    totals, sizes = store_totals(
        scoped_totals(scores, total_scope, buckets), workspace, "npmi-totals", limits=limits
    )
    with_total = attach_totals(scores, totals, ["decade"], ["w1", "w2"], sizes[None], limits)
    kept = keep_high_scores(with_relative_npmi(with_total), min_npmi, rel_min_npmi)
    return order_collocations(kept, workspace) if ordered else kept


def collocations(
    spark: SparkSession,
    source: DataFrame | str | list[str],
    *,
    language: str,
    min_npmi: float,
    rel_min_npmi: float,
    stop_words: DataFrame | str | Iterable[str] | None = None,
    format: str = "text",
    split_size: int | None = None,
    fraction: float = 1.0,
    seed: int | None = None,
    sample_by: str = "row",
    mode: str = "FAILFAST",
    quarantine: str | None = None,
    total_scope: str = "decade",
    buckets: int = 11,
    ordered: bool = True,
    workspace: Workspace | None = None,
    limits: JoinLimits = JoinLimits(),
) -> DataFrame:
    """Strongly associated word pairs of each decade, from files or a table.

    ``split_size`` bounds the bytes of one input split, ``limits`` choose between
    joins by measured size.
    """
    check_split_size(split_size)
    _check_threshold("min_npmi", min_npmi)
    _check_threshold("rel_min_npmi", rel_min_npmi)
    workspace = workspace or Workspace(spark)
    ngrams = source if isinstance(source, DataFrame) else read_lines(
        spark, source, format, split_size if format == "sequence" else None
    )
    scores = score_ngrams(
        ngrams, stop_words, workspace=workspace, limits=limits, split_size=split_size,
        language=language, fraction=fraction, seed=seed, sample_by=sample_by, mode=mode, quarantine=quarantine,
    )
    return select_collocations(
        scores, min_npmi=min_npmi, rel_min_npmi=rel_min_npmi, total_scope=total_scope,
        buckets=buckets, ordered=ordered, workspace=workspace, limits=limits,
    )


def top_collocations(
    scores: DataFrame,
    k: int = 10,
    max_npmi: float | None = None,
    *,
    drop_self_pairs: bool = True,
    inclusive: bool = False,
    deduplicate: bool = True,
    ordered: bool = True,
    workspace: Workspace | None = None,
    stored: bool = False,
) -> DataFrame:
    """The ``k`` best pairs of each decade with a score of at most ``max_npmi``.

    ``inclusive`` keeps one more. ``deduplicate`` costs a shuffle; switch it off
    for rows that cannot repeat, such as those of :func:`select_collocations`.
    ``scores`` is computed once, and what may be listed is stored; ``stored`` says
    that ``scores`` comes from files, so that without a shuffle it is read again.
    """
    if k < 0:
        raise ValueError("k must be at least 0")
    scores = drop_high_scores(scores, max_npmi)
    if drop_self_pairs:
        scores = without_self_pairs(scores)
    if deduplicate:
        scores = drop_repeated_scores(scores)
    top = top_k_per_decade(scores, k + 1 if inclusive else k, workspace, stored and not deduplicate)
    return order_top_rows(top) if ordered else top
