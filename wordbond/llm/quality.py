"""Quality rules: counted base rules, and boosted trees over statistics of whole documents.

The base rules count words (runs of anything but ASCII white space), their code
points, symbols, repeated lines and words in repeated runs of three; documents that
are short or repeat themselves fail. What passes is judged by gradient-boosted
trees over shares and means of such statistics, learnt from labels of quality.

The trees are fitted here, by logistic loss over histograms of the features. Some
features are monotonic: the score never rises as the share of symbols, of repeated
lines, of repeated words, of capitals or of exclamation marks does. A split that would
break that is not taken, and the values below a split stay on their side of its
middle. For scoring, all trees are laid out in one set of arrays, and a batch of
documents walks down all of them at once, a level at a time.

The fit takes at most ``sample_rows`` labelled texts, half of each kind, chosen by
hash among the distinct texts, so copies weigh no more than their text. Of labels
that disagree about equal texts the more frequent holds, the better one on a draw.
Statistics and scores cover every document and its whole text. Only counts and
scores come back from Python, and texts are never shuffled.

Null texts count as empty and have no words; such documents fail the base rules.
Very long texts are counted in arrays of numbers. Repeated rows and ids are judged
one by one. Labels that are null, and labels of unknown ids, teach nothing; of
several labels of an id the largest holds. Without labels of both kinds every
document has the share of good ones as its score (1 if there are none), so then the
base rules decide. An empty table gives an empty result. Ids may be of any type
that can be compared; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..operators.joining import broadcast_if_small
from ..workspace import Workspace
from .batches import small_batches
from .toxicity import held_out
from .words import binary_values

# Base rules.
MIN_WORDS, MAX_REPEATED_PERCENT, RUN = 50, 50, 3
# Bounds of the fit: labelled texts, trees, their depth, bins of a feature, texts in a leaf.
SAMPLE_ROWS, TREES, DEPTH, BINS, LEAF_ROWS = 8_000, 60, 4, 64, 10
RATE, SHRINK, THRESHOLD = 0.2, 1.0, 0.5

_SPACE, _SYMBOLS, _LINE_END = b" \t\n\x0b\x0c\r", b"#*$%&|<>", b"\n"
_CAPITALS, _SMALL, _DIGITS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789"

COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_distinct_words", "n_capitals", "n_small", "n_digits", "n_exclamations", "n_ends", "n_bytes",
]
# A feature, and its sign: -1 where the score may only fall as the feature rises.
FEATURES = {
    "words": 0, "word_length": 0, "symbols": -1, "repeated_lines": -1, "repeated_words": -1, "line_length": 0,
    "distinct_words": 0, "capitals": -1, "small": 0, "digits": 0, "exclamations": -1, "sentence_length": 0,
}


# --- statistics --------------------------------------------------------------


def repeated_words(words: list[bytes], run: int = RUN) -> int:
    """Words that lie in a run of ``run`` words found at least twice."""
    places = len(words) - run + 1
    if places < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(word, len(numbers)) for word in words], np.int64)
    keys, size = ids[:places], len(numbers)
    for shift in range(1, run):
        if size * len(numbers) >= 1 << 62:  # number the runs so far anew
            _, keys = np.unique(keys, return_inverse=True)
            size = places
        keys = keys * len(numbers) + ids[shift:places + shift]
        size *= len(numbers)
    _, which, counts = np.unique(keys, return_inverse=True, return_counts=True)
    again = counts[which] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(run):
        covered[shift:places + shift] |= again
    return int(covered.sum())


def document_counts(text: bytes) -> list[int]:
    """``COUNTS`` of one text."""
    words = text.split()  # at the same bytes as _SPACE
    solid = text.translate(None, _SPACE)
    lines = [line for line in text.split(_LINE_END) if line.strip(_SPACE)]

    def number_of(characters: bytes) -> int:
        return len(solid) - len(solid.translate(None, characters))

    return [
        len(words), len(solid.decode(errors="replace")), number_of(_SYMBOLS), len(lines) - len(set(lines)),
        repeated_words(words), len(lines), len(set(words)), number_of(_CAPITALS), number_of(_SMALL),
        number_of(_DIGITS), number_of(b"!"), number_of(b".?!"), len(text),
    ]


def base_failed(counts: np.ndarray) -> np.ndarray:
    """Too short, or more than half of the words in repeated runs."""
    words, repeated = counts[:, 0], counts[:, 4]
    return (words < MIN_WORDS) | (100 * repeated > MAX_REPEATED_PERCENT * words)


def features(counts: np.ndarray) -> np.ndarray:
    """``FEATURES`` of each row of ``COUNTS``."""
    c = dict(zip(COUNTS, counts.T.astype(float)))
    words, chars, lines = (np.maximum(c[name], 1.0) for name in ("n_words", "word_chars", "n_lines"))
    return np.stack([
        np.log1p(c["n_words"]), c["word_chars"] / words, c["n_symbols"] / chars, c["n_dup_lines"] / lines,
        c["n_repeat_words"] / words, c["n_words"] / lines, c["n_distinct_words"] / words, c["n_capitals"] / chars,
        c["n_small"] / chars, c["n_digits"] / chars, c["n_exclamations"] / chars,
        c["n_words"] / np.maximum(c["n_ends"], 1.0),
    ], axis=1)


# --- trees -------------------------------------------------------------------


@dataclass
class Forest:
    """Trees as arrays: an inner node goes left where its feature is at most the bound.

    Leaves lead to themselves, so all documents take as many steps as the deepest tree has levels.
    """

    base: float
    depth: int = 0
    roots: list[int] = field(default_factory=list)
    feature: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    bound: np.ndarray = field(default_factory=lambda: np.zeros(0))
    left: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    right: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def margin(self, rows: np.ndarray) -> np.ndarray:
        """The log-odds of good quality for rows of features."""
        if not self.roots:
            return np.full(len(rows), self.base)
        at = np.tile(np.array(self.roots, np.int32), (len(rows), 1))
        which = np.arange(len(rows))[:, None]
        for _ in range(self.depth):
            at = np.where(rows[which, self.feature[at]] <= self.bound[at], self.left[at], self.right[at])
        return self.base + self.value[at].sum(axis=1)

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(rows)))


@dataclass
class _Node:
    """A part of the sample while a tree grows; its value must lie between ``low`` and ``high``."""

    rows: np.ndarray
    low: float
    high: float
    place: int


def _value(gradient, hessian, low: float, high: float):
    return np.clip(-gradient / (hessian + SHRINK), low, high)


def _gain(gradient, hessian, value):
    """What a leaf of this value takes off the loss."""
    return -(gradient * value + 0.5 * (hessian + SHRINK) * value * value)


class _Grower:
    """Grows trees on binned features."""

    def __init__(self, rows: np.ndarray, signs: np.ndarray, depth: int, bins: int, leaf_rows: int):
        self.signs, self.depth, self.bins, self.leaf_rows = signs, depth, bins, leaf_rows
        shares = np.arange(1, bins) / bins
        self.cuts = [np.unique(np.quantile(rows[:, f], shares, method="lower")) for f in range(rows.shape[1])]
        self.binned = np.stack(
            [np.searchsorted(cuts, rows[:, f], side="left") for f, cuts in enumerate(self.cuts)], axis=1
        )

    def _best_split(self, node: _Node, gradient: np.ndarray, hessian: np.ndarray):
        """``(gain, feature, bin, value left, value right)`` of the best split allowed, or None."""
        g, h = gradient[node.rows], hessian[node.rows]
        total_g, total_h = g.sum(), h.sum()
        whole = _gain(total_g, total_h, _value(total_g, total_h, node.low, node.high))
        best = None
        for f in range(self.binned.shape[1]):
            where = self.binned[node.rows, f]
            left_g = np.cumsum(np.bincount(where, g, self.bins))[:-1]
            left_h = np.cumsum(np.bincount(where, h, self.bins))[:-1]
            left_n = np.cumsum(np.bincount(where, minlength=self.bins))[:-1]
            values = (
                _value(left_g, left_h, node.low, node.high),
                _value(total_g - left_g, total_h - left_h, node.low, node.high),
            )
            gains = _gain(left_g, left_h, values[0]) + _gain(total_g - left_g, total_h - left_h, values[1]) - whole
            allowed = (left_n >= self.leaf_rows) & (len(node.rows) - left_n >= self.leaf_rows)
            allowed &= np.arange(self.bins - 1) < len(self.cuts[f])
            allowed &= self.signs[f] * (values[1] - values[0]) >= 0
            gains = np.where(allowed, gains, -np.inf)
            at = int(gains.argmax())
            if gains[at] > 1e-9 and (best is None or gains[at] > best[0]):
                best = (gains[at], f, at, values[0][at], values[1][at])
        return best

    def tree(self, gradient: np.ndarray, hessian: np.ndarray) -> list[tuple[int, float, int, int, float]]:
        """Nodes ``(feature, bound, left, right, value)``, the root first."""
        everything = np.arange(len(gradient))
        nodes = [(0, np.inf, 0, 0, float(_value(gradient.sum(), hessian.sum(), -np.inf, np.inf)))]
        level = [_Node(everything, -np.inf, np.inf, 0)]
        for _ in range(self.depth):
            below = []
            for node in level:
                split = self._best_split(node, gradient, hessian)
                if split is None:
                    continue
                _, f, at, *values = split
                goes_left = self.binned[node.rows, f] <= at
                middle = (values[0] + values[1]) / 2
                left_range, right_range = (node.low, node.high), (node.low, node.high)
                if self.signs[f] < 0:  # the left side scores at least as high
                    left_range, right_range = (middle, node.high), (node.low, middle)
                elif self.signs[f] > 0:
                    left_range, right_range = (node.low, middle), (middle, node.high)
                places = len(nodes), len(nodes) + 1
                for rows, bounds, place, value in zip(
                    (node.rows[goes_left], node.rows[~goes_left]), (left_range, right_range), places, values
                ):
                    nodes.append((0, np.inf, place, place, float(value)))
                    below.append(_Node(rows, *bounds, place))
                nodes[node.place] = (f, float(self.cuts[f][at]), *places, 0.0)
            level = below
        return nodes


def grow_forest(
    rows: np.ndarray, good: np.ndarray, signs: np.ndarray | None = None,
    trees: int = TREES, depth: int = DEPTH, bins: int = BINS, leaf_rows: int = LEAF_ROWS, rate: float = RATE,
) -> Forest:
    """Boosted trees for the log-odds that a row of features is good."""
    signs = np.zeros(rows.shape[1]) if signs is None else signs
    share = float(good.mean()) if len(good) else 1.0
    base = float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
    if share in (0.0, 1.0):
        return Forest(base)
    grower = _Grower(rows, signs, depth, bins, leaf_rows)
    forest, made = Forest(base, depth), []
    margin = np.full(len(rows), base)
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-margin))
        nodes = grower.tree(chance - good, chance * (1 - chance))
        start = len(made)
        forest.roots.append(start)
        made += [(f, bound, left + start, right + start, rate * value) for f, bound, left, right, value in nodes]
        tree = _laid_out(Forest(0.0, depth, [start]), made)
        margin += tree.margin(rows)
    return _laid_out(forest, made)


def _laid_out(forest: Forest, nodes: list[tuple]) -> Forest:
    columns = list(zip(*nodes))
    for name, column, kind in zip(
        ("feature", "bound", "left", "right", "value"), columns, (np.int32, float, np.int32, np.int32, float)
    ):
        setattr(forest, name, np.array(column, kind))
    return forest


# --- Spark -------------------------------------------------------------------


def _sample(
    docs: DataFrame, labels: DataFrame, workspace: Workspace, sample_rows: int, id_column: str, text_column: str
) -> DataFrame:
    """``_text, _good``: at most ``sample_rows`` distinct texts, half of them of each kind if there are so many."""
    known = labels.filter(F.col("quality").isNotNull() & ~held_out(id_column)).groupBy(
        F.col(id_column).alias("_id")
    ).agg((F.max("quality") > 0).alias("_good"))
    text = F.coalesce(F.col(text_column).cast("binary"), F.lit(b""))
    rows = docs.select(F.col(id_column).alias("_id"), text.alias("_text"))
    hashed = rows.select("_id", F.unhex(F.md5("_text")).alias("_md5"))
    texts = workspace.store(
        hashed.join(broadcast_if_small(known), "_id").groupBy("_md5").agg(
            (F.avg(F.col("_good").cast("double")) >= 0.5).alias("_good"), F.min("_id").alias("_id"),
        ), "labelled-texts",
    )
    half = sample_rows // 2
    counts = dict(texts.groupBy("_good").count().collect())
    # First the share of each kind that is sure to hold enough, so that few rows are sorted.
    place = F.pmod(F.xxhash64("_md5"), F.lit(1 << 30))
    chosen = [
        texts.filter((F.col("_good") == kind) & (place <= int(min(1.0, 2 * half / counts.get(kind, 1)) * (1 << 30))))
        .orderBy("_md5").limit(half) for kind in (True, False)
    ]
    picked = F.broadcast(chosen[0].union(chosen[1]))  # at most sample_rows hashes
    found = rows.join(picked, "_id").filter(F.unhex(F.md5("_text")) == F.col("_md5"))
    return found.select("_md5", "_text", "_good")


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    workspace: Workspace,
    sample_rows: int = SAMPLE_ROWS,
    id_column: str = "doc_id",
    text_column: str = "text",
    **growing,
) -> Forest:
    """Trees fitted on a bounded sample of the labelled texts that are not held out.

    ``growing`` are arguments of :func:`grow_forest`.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [document_counts(text) for text in binary_values(batch.column("_text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_md5"), pa.array(counts, pa.list_(pa.int64())), batch.column("_good")],
                ["_md5", "_counts", "_good"],
            )

    sample = _sample(docs, labels, workspace, sample_rows, id_column, text_column)
    with small_batches(docs.sparkSession):
        counted = sample.mapInArrow(run, "_md5 binary, _counts array<bigint>, _good boolean")
        # Rows that repeat an id and its text count once.
        rows = counted.groupBy("_md5").agg(F.first("_counts").alias("_counts"), F.first("_good").alias("_good")).collect()
    rows.sort(key=lambda row: bytes(row._md5))
    counts = np.array([row._counts for row in rows], np.int64).reshape(-1, len(COUNTS))
    good = np.array([row._good for row in rows], float)
    return grow_forest(features(counts), good, np.array(list(FEATURES.values())), **growing)


def judge_quality(
    docs: DataFrame,
    forest: Forest,
    threshold: float = THRESHOLD,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score``."""
    shown = COUNTS[:5]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.array(
                [document_counts(text) for text in binary_values(batch.column(1))], np.int64
            ).reshape(-1, len(COUNTS))
            failed, score = base_failed(counts), forest.score(features(counts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(counts[:, i]) for i in range(len(shown))),
                 pa.array(failed), pa.array(~failed & (score >= threshold)), pa.array(score)],
                [id_column, *shown, "base_failed", "kept", "score"],
            )

    rows = docs.select(F.col(id_column), F.col(text_column).cast("binary"))
    kind = dict(rows.dtypes)[id_column]
    schema = f"`{id_column}` {kind}, " + ", ".join(f"{name} bigint" for name in shown)
    return rows.mapInArrow(run, f"{schema}, base_failed boolean, kept boolean, score double")
