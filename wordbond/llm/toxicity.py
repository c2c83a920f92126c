"""Toxic spans by a linear-chain conditional random field, and document scores.

Labels are given for documents, the field is trained on tokens. In between stands
a count over all labelled training documents, equal texts once: word beginnings
that occur in toxic documents far more often than their share of documents
explains (a likelihood ratio test against all beginnings) mark the tokens of toxic
documents as toxic. All that pass are kept, in a stored table.
The field is then fitted on a bounded sample of sentences from at most
``SAMPLE_DOCUMENTS`` distinct labelled texts, a sentence of more than ``WINDOW``
words cut into pieces with the marked words in their middle; its features are the word, its beginnings
and ending, and its neighbours' beginnings, so it also tags forms it has not seen.

Every document is scored over its whole text: forward-backward gives each token's
marginal; a document's largest marginal, expected number of toxic tokens and
length give its score by a logistic curve fitted on the sample. Tokens above one half are the
offending spans. Sentences are the chains; one of more than ``CHAIN`` tokens is
several chains.

Labels, language, source and id are no inputs of a score. Null and empty texts
score like any text without toxic tokens. Repeated rows and equal ids are scored
one by one, but learnt from once for each distinct text, under the label of its
smallest id. Without labels of both kinds every score is the share of toxic texts
(0 if there are none). An empty table gives an empty result; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.joining import broadcast_if_small
from ..workspace import Workspace
from .batches import small_batches
from .words import binary_values

SAMPLE_DOCUMENTS, SENTENCES_PER_DOCUMENT = 2000, 12
CHAIN, STEPS, WINDOW = 1024, 150, 64
BEGINNINGS = (3, 4, 5, 7)
# Entries that a task's counts and its word table hold before they are handed on or made anew.
COUNTED, KNOWN = 100_000, 400_000

_WORD = re.compile(rb"[a-z\x80-\xff]+")
_END = re.compile(rb"[.!?\n]+")


def sentences(text: bytes) -> Iterator[list[bytes]]:
    """The words (runs of letters, A-Z lower-cased) of each sentence, cut into chains."""
    for sentence in _END.split(text.lower()):
        words = _WORD.findall(sentence)
        if len(words) > CHAIN:
            for start in range(0, len(words), CHAIN):
                yield words[start:start + CHAIN]
        elif words:
            yield words


def _beginnings(word: bytes) -> list[str]:
    """The word itself, marked as whole, and its proper beginnings."""
    text = word.decode(errors="replace").lower()
    size = len(text)
    return [text + "$", *[text[:n] for n in BEGINNINGS if n < size]]


def _features(word: bytes) -> list[str]:
    """A word's own features; :class:`_Tagger` sums their weights the same way."""
    return [*_beginnings(word), "-" + word.decode(errors="replace").lower()[-3:]]


def _context(word: bytes) -> str:
    return word.decode(errors="replace").lower()[:4]


# --- labels ------------------------------------------------------------------


def held_out(id_column: str) -> Column:
    """Documents that nothing is learnt from: crc32 of the id as text, modulo 5, is 0."""
    text = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    return F.crc32(text) % 5 == 0


def _labelled(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """``_id, _text, _toxic, _md5`` of the training documents; of several labels the largest holds."""
    known = labels.filter(F.col("toxic").isNotNull() & ~held_out(id_column)).groupBy(
        F.col(id_column).alias("_id")
    ).agg((F.max("toxic") > 0).alias("_toxic"))
    text = F.coalesce(F.col(text_column).cast("binary"), F.lit(b""))
    rows = docs.select(F.col(id_column).alias("_id"), text.alias("_text"))
    return rows.join(broadcast_if_small(known), "_id").withColumn("_md5", F.unhex(F.md5("_text")))


def _distinct(labelled: DataFrame, workspace: Workspace) -> tuple[DataFrame, DataFrame]:
    """The distinct texts as ``_md5, _id, _toxic, _n``, and one row of ``labelled`` for each.

    Of equal texts the one with the smallest id stands, with its label; ``_n`` says
    how often that id has the text.
    """
    texts = workspace.store(
        labelled.groupBy("_md5", "_id", "_toxic").agg(F.count("*").alias("_n"))
        .groupBy("_md5").agg(F.min(F.struct("_id", "_toxic", "_n")).alias("_first"))
        .select("_md5", "_first.*"), "distinct-texts",
    )
    keys = ["_md5", "_id"]
    once = labelled.join(broadcast_if_small(texts.filter("_n = 1").select(*keys)), keys, "left_semi")
    again = texts.filter("_n > 1").select(*keys)
    if not again.isEmpty():
        repeated = labelled.join(broadcast_if_small(again), keys, "left_semi")
        once = once.unionByName(repeated.dropDuplicates(["_md5"]))
    return texts, once


def _count_labels(rows: DataFrame) -> tuple[int, int]:
    """Rows labelled toxic and clean."""
    counts = dict(rows.groupBy("_toxic").count().collect())
    return counts.get(True, 0), counts.get(False, 0)


def _beginning_counts(once: DataFrame) -> DataFrame:
    """``beginning, toxic, clean``: in how many toxic and clean texts each word beginning occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = {}

        def out() -> pa.RecordBatch:
            columns = list(zip(*counts.values())) or [(), ()]
            return pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), *(pa.array(c, pa.int64()) for c in columns)],
                ["beginning", "toxic", "clean"],
            )

        for batch in batches:
            for text, label in zip(binary_values(batch.column("_text")), batch.column("_toxic").to_pylist()):
                seen: set[str] = set()
                for word in set(_WORD.findall(text.lower())):
                    seen.update(_beginnings(word))
                for beginning in seen:
                    counts.setdefault(beginning, [0, 0])[0 if label else 1] += 1
                if len(counts) > COUNTED:
                    yield out()
                    counts.clear()
        yield out()

    counts = once.select("_text", "_toxic").mapInArrow(run, "beginning string, toxic bigint, clean bigint")
    return counts.groupBy("beginning").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _lexicon(once: DataFrame, toxic: int, clean: int, workspace: Workspace) -> DataFrame:
    """Word beginnings that mark toxic documents; they and the base rate are counted over distinct texts."""
    counted = workspace.store(_beginning_counts(once), "beginnings")
    base = toxic / (toxic + clean)
    share = F.col("toxic") / (F.col("toxic") + F.col("clean"))
    gain = F.col("toxic") * F.log(share / base) + F.when(
        F.col("clean") > 0, F.col("clean") * F.log((1 - share) / (1 - base))
    ).otherwise(0.0)
    judged = counted.filter(F.col("toxic") >= 2).filter(share > base).withColumn("gain", gain)
    bar = 2 * float(np.log(max(counted.count(), 2)))
    found = judged.filter((F.col("gain") >= bar) & (share >= 0.5))
    return workspace.store(found.select("beginning"), "lexicon")


def _marks(sample: DataFrame, lexicon: DataFrame) -> set[str]:
    """The beginnings of the lexicon that the sample holds; those of other texts mark nothing in it."""
    found = lexicon.join(_beginning_counts(sample), "beginning", "left_semi")
    return {row.beginning for row in found.collect()}


def _sample(once: DataFrame, texts: DataFrame) -> DataFrame:
    """At most ``SAMPLE_DOCUMENTS`` distinct texts, half of them toxic if there are so many."""
    half = SAMPLE_DOCUMENTS // 2
    chosen = [
        texts.filter(F.col("_toxic") == kind).orderBy("_md5").limit(half).select("_md5") for kind in (True, False)
    ]
    picked = F.broadcast(chosen[0].union(chosen[1]))  # at most SAMPLE_DOCUMENTS hashes
    return once.join(picked, "_md5", "left_semi")


def _pieces(hit: list[int], window: int) -> Iterator[slice]:
    """A chain cut into pieces of at most ``window`` words, with marked words in the middle where there is room."""
    at, size = 0, len(hit)
    while size - at > window:
        first = hit.index(1, at) if 1 in hit[at:] else size
        start = max(at, min(first - window // 2, size - window))
        for left in range(at, start, window):
            yield slice(left, min(left + window, start))
        yield slice(start, start + window)
        at = start + window
    if at < size:
        yield slice(at, size)


def _spread(items: list, count: int) -> list:
    """At most ``count`` items, evenly spread."""
    count = min(count, len(items))
    return [items[place * len(items) // count] for place in range(count)]


def _training_sentences(
    sample: DataFrame, marks: set[str], window: int = WINDOW
) -> list[tuple[list[bytes], list[int]]]:
    """Some sentences of each sampled document with a label for each word.

    Half are marked ones and half are others, both spread over the text. Sentences
    of more than ``window`` words are cut, and each piece is a sentence of its own.
    """
    shared = sample.sparkSession.sparkContext.broadcast(marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = shared.value
        for batch in batches:
            words, tags = [], []
            for text, label in zip(binary_values(batch.column("_text")), batch.column("_toxic").to_pylist()):
                marked, other = [], []
                for sentence in sentences(text):
                    hit = [int(not marks.isdisjoint(_beginnings(word))) for word in sentence]
                    tag = hit if label else [0] * len(sentence)
                    for piece in _pieces(hit, window):
                        (marked if any(hit[piece]) else other).append((sentence[piece], tag[piece]))
                half = SENTENCES_PER_DOCUMENT // 2
                for sentence, tag in _spread(marked, half) + _spread(other, half):
                    words.append(sentence)
                    tags.append(tag)
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.list_(pa.binary())), pa.array(tags, pa.list_(pa.int32()))], ["words", "tags"]
            )

    rows = sample.select("_text", "_toxic").mapInArrow(run, "words array<binary>, tags array<int>").collect()
    return sorted(([bytes(word) for word in row.words], row.tags) for row in rows)  # whatever the order of files


# --- the field ---------------------------------------------------------------


def _walk(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Token numbers at place 0, 1, ... of all chains that are long enough."""
    starts = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    starts, sizes = starts[order], -lengths[order]
    for place in range(int(-sizes[0]) if len(sizes) else 0):
        yield starts[: np.searchsorted(sizes, -place, "left")] + place


def log_odds(emission: np.ndarray, lengths: np.ndarray, moves: np.ndarray):
    """Forward and backward log-odds of the toxic tag for tokens of chains.

    ``emission`` holds each token's own log-odds and ``moves[i, j]`` the score of
    tag j after tag i. Their sum is the log-odds of the marginal.
    """
    forward, backward = emission.copy(), np.zeros_like(emission)
    places = list(_walk(lengths))
    (oo, ot), (to, tt) = moves
    for at in places[1:]:
        before = forward[at - 1]
        forward[at] += np.logaddexp(ot, tt + before) - np.logaddexp(oo, to + before)
    for at in reversed(places[1:]):
        after = emission[at] + backward[at]
        backward[at - 1] = np.logaddexp(to, tt + after) - np.logaddexp(oo, ot + after)
    return forward, backward


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _pair_marginals(emission, forward, backward, lengths, moves):
    """Expected number of each move, summed over chains; rows are the tag before."""
    first = np.zeros(len(emission), bool)
    first[np.cumsum(lengths) - lengths] = True
    at = np.flatnonzero(~first)
    scores = np.empty((len(at), 2, 2))
    for i in (0, 1):
        for j in (0, 1):
            scores[:, i, j] = i * forward[at - 1] + moves[i, j] + j * (emission[at] + backward[at])
    scores -= scores.max(axis=(1, 2), keepdims=True)
    weights = np.exp(scores)
    return (weights / weights.sum(axis=(1, 2), keepdims=True)).sum(axis=0)


def _fit_field(chains: list[tuple[list[bytes], list[int]]]) -> tuple[dict[str, float], np.ndarray]:
    """Weights by feature and the move scores, by regularised likelihood ascent."""
    names: dict[str, int] = {"": 0}
    token, feature = [], []
    number = 0
    for words, _ in chains:
        context = [_context(word) for word in words]
        for place, word in enumerate(words):
            found = ["", *_features(word)]
            if place:
                found.append("<" + context[place - 1])
            if place + 1 < len(words):
                found.append(">" + context[place + 1])
            for name in found:
                feature.append(names.setdefault(name, len(names)))
                token.append(number)
            number += 1
    token, feature = np.array(token), np.array(feature)
    tags = np.array([tag for _, labels in chains for tag in labels], float)
    lengths = np.array([len(words) for words, _ in chains])
    weights, moves = np.zeros(len(names)), np.zeros((2, 2))
    inner = np.ones(len(tags), bool)
    inner[np.cumsum(lengths) - lengths] = False
    at = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (tags[at - 1].astype(int), tags[at].astype(int)), 1)
    slope, square, slope_m, square_m = (np.zeros_like(x) for x in (weights, weights, moves, moves))
    for step in range(1, STEPS + 1):
        emission = np.bincount(token, weights[feature], len(tags))
        forward, backward = log_odds(emission, lengths, moves)
        error = tags - _sigmoid(forward + backward)
        grad = np.bincount(feature, error[token], len(names)) - 0.1 * weights
        grad_m = seen - _pair_marginals(emission, forward, backward, lengths, moves) - 0.1 * moves
        for value, g, m, v in ((weights, grad, slope, square), (moves, grad_m, slope_m, square_m)):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            value += 0.2 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return {name: float(weights[i]) for name, i in names.items()}, moves


@dataclass(frozen=True)
class ToxicityModel:
    """The field's weights, its move scores, and the curve from marginals to scores."""

    weights: dict[str, float] | None
    moves: np.ndarray | None
    curve: tuple[float, float, float, float]

    def score(self, largest: np.ndarray, expected: np.ndarray, words: np.ndarray) -> np.ndarray:
        return _sigmoid(_evidence(largest, expected, words) @ np.array(self.curve))


def _evidence(largest: np.ndarray, expected: np.ndarray, words: np.ndarray) -> np.ndarray:
    """What a document's marginals come to; long texts meet more words by chance."""
    return np.stack([np.ones(len(largest)), largest, np.log1p(expected), np.log1p(words)], axis=1)


class _Tagger:
    """Marginals of the words of many documents at once, with a table of known words."""

    def __init__(self, model: ToxicityModel):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.table = np.zeros((1024, 3))

    def _learn(self, words: list[bytes]) -> None:
        get, first = self.model.weights.get, len(self.known)
        if first + len(words) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros((len(self.table) + len(words), 3))])
        known, rows = self.known, []
        for place, word in enumerate(words, first):
            known[word] = place
            text = word.decode(errors="replace").lower()
            own, size, context = get(text + "$", 0.0) + get("-" + text[-3:], 0.0), len(text), text[:4]
            for n in BEGINNINGS:
                if n < size:
                    own += get(text[:n], 0.0)
            rows.append((own, get("<" + context, 0.0), get(">" + context, 0.0)))
        self.table[first:len(known)] = np.array(rows).reshape(-1, 3)

    def tag(self, texts: list[bytes]):
        """Lengths of all chains, chains per text, and each word's marginal log-odds."""
        chains, per_text = [], []
        for text in texts:
            before = len(chains)
            chains += sentences(text)
            per_text.append(len(chains) - before)
        lengths = np.fromiter(map(len, chains), np.int64, len(chains))
        if not chains:
            return lengths, np.array(per_text, np.int64), np.empty(0)
        if len(self.known) > KNOWN:
            self._forget()
        words = list(itertools.chain.from_iterable(chains))
        self._learn(list(set(words).difference(self.known)))
        table = self.table
        ids = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        emission = table[ids, 0] + self.model.weights[""]
        starts = np.cumsum(lengths) - lengths
        inner = np.ones(len(ids), bool)
        inner[starts] = False
        at = np.flatnonzero(inner)
        emission[at] += table[ids[at - 1], 1]
        emission[at - 1] += table[ids[at], 2]
        forward, backward = log_odds(emission, lengths, self.model.moves)
        return lengths, np.array(per_text, np.int64), np.clip(forward + backward, -30, 30)

    def measure(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Largest marginal log-odds, expected toxic words, and words of each text."""
        lengths, per_text, odds = self.tag(texts)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        edges = ends[np.concatenate([[0], np.cumsum(per_text)])]
        largest, expected = np.full(len(texts), -30.0), np.zeros(len(texts))
        filled = np.flatnonzero(np.diff(edges))
        if len(filled):
            largest[filled] = np.maximum.reduceat(odds, edges[filled])
            expected[filled] = np.add.reduceat(_sigmoid(odds), edges[filled])
        return largest, expected, np.diff(edges).astype(float)


def _scores(model: ToxicityModel, tagger: _Tagger | None, texts: list[bytes]) -> np.ndarray:
    return model.score(*(tagger.measure(texts) if tagger else np.zeros((3, len(texts)))))


def _groups(column: pa.Array, size: int = 1 << 20) -> Iterator[tuple[list[int], list[bytes]]]:
    """The texts of a column, and their places in it, in runs of about ``size`` bytes."""
    rows, texts, held = [], [], 0
    for row, text in enumerate(binary_values(column)):
        rows.append(row)
        texts.append(text)
        held += len(text)
        if held >= size:
            yield rows, texts
            rows, texts, held = [], [], 0
    if rows:
        yield rows, texts


def _fit_curve(sample: DataFrame, weights, moves, base: float) -> tuple[float, float, float, float]:
    """A logistic curve over the sample's texts, weighted back to the share of toxic ones among distinct texts."""
    model = ToxicityModel(weights, moves, (0.0, 0.0, 0.0, 0.0))
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = _Tagger(shared.value)
        for batch in batches:
            labels = batch.column("_toxic").to_pylist()
            for rows, texts in _groups(batch.column("_text")):
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, tagger.measure(texts)), pa.array([labels[r] for r in rows])],
                    ["largest", "expected", "words", "toxic"],
                )

    rows = sample.select("_text", "_toxic").mapInArrow(
        run, "largest double, expected double, words double, toxic boolean"
    ).collect()
    rows.sort()
    x = _evidence(*(np.array([r[i] for r in rows]) for i in range(3)))
    y = np.array([float(r.toxic) for r in rows])
    share = y.mean()
    weight = np.where(y > 0, base / share, (1 - base) / (1 - share))
    # Held near the largest marginal itself, which it falls back to if labels tell little;
    # length, which alone says nothing of what a text holds, is held most.
    prior = np.array([0.0, 1.0, 0.0, 0.0])
    curve, ridge = prior.copy(), np.diag([1.0, 1.0, 1.0, 12.0]) * len(y) / 2000
    for _ in range(50):
        p = _sigmoid(x @ curve)
        grad = x.T @ (weight * (y - p)) - ridge @ (curve - prior)
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge
        curve = curve + np.linalg.solve(hess, grad)
    # More toxic words never make a text less toxic.
    return float(curve[0]), max(float(curve[1]), 0.0), max(float(curve[2]), 0.0), float(curve[3])


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    workspace: Workspace,
    id_column: str = "doc_id",
    text_column: str = "text",
    window: int = WINDOW,
) -> ToxicityModel:
    """Learn from the labelled documents that are not held out.

    ``window`` is the length of the pieces that long sentences are cut into for
    the fit; scoring never cuts them.
    """
    labelled = _labelled(docs, labels, id_column, text_column)
    texts, once = _distinct(labelled, workspace)
    toxic, clean = _count_labels(texts)
    base = toxic / max(toxic + clean, 1)
    if not toxic or not clean:
        return ToxicityModel(None, None, (40.0 if base == 1 else -40.0, 0.0, 0.0, 0.0))
    sample = workspace.store(_sample(once, texts), "sample")
    with small_batches(docs.sparkSession):
        marks = _marks(sample, _lexicon(once, toxic, clean, workspace))
        chains = _training_sentences(sample, marks, window)
    if not chains:
        return ToxicityModel(None, None, (float(np.log(base / (1 - base))), 0.0, 0.0, 0.0))
    weights, moves = _fit_field(chains)
    with small_batches(docs.sparkSession):
        return ToxicityModel(weights, moves, _fit_curve(sample, weights, moves, base))


def _spans(text: bytes, odds: np.ndarray) -> list[dict]:
    """Code-point offsets of the words whose marginal is above one half."""
    places = [m.span() for m in _WORD.finditer(text.lower())]
    found = []
    for place in np.flatnonzero(odds > 0).tolist():
        start, end = places[place]
        before = len(text[:start].decode(errors="replace"))
        length = len(text[start:end].decode(errors="replace"))
        found.append({"start": before, "end": before + length, "probability": float(_sigmoid(odds[place]))})
    return found


def score_column(text: Column, model: ToxicityModel, spark: SparkSession) -> Column:
    """The score of each text; only texts go to Python, and only scores come back."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        tagger = _Tagger(model) if model.weights is not None else None
        for column in columns:
            found = [_scores(model, tagger, texts) for _, texts in _groups(column)]
            yield pa.array(np.concatenate([np.empty(0), *found]))

    return score(text.cast("binary"))


def score_toxicity(
    docs: DataFrame,
    model: ToxicityModel,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_spans: bool = False,
) -> DataFrame:
    """Per document: id, ``score``, ``predicted``, and on request the offending ``spans``."""
    spark, text = docs.sparkSession, F.col(text_column)
    spans = [find_spans(text, model, spark).alias("spans")] * with_spans
    scored = docs.select(F.col(id_column), score_column(text, model, spark).alias("score"), *spans)
    return scored.select(
        id_column, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), *["spans"] * with_spans
    )


def find_spans(text: Column, model: ToxicityModel, spark: SparkSession) -> Column:
    """The offending words of each text: code-point offsets and probability."""
    shared = spark.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]))

    @F.arrow_udf("array<struct<start: bigint, end: bigint, probability: double>>")
    def spans(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tagger = _Tagger(shared.value) if shared.value.weights is not None else None
        for column in columns:
            yield pa.array([
                _spans(text, tagger.tag([text])[2]) if tagger else [] for text in binary_values(column)
            ], kind)

    return spans(text.cast("binary"))


def keep_clean(docs: DataFrame, model: ToxicityModel, text_column: str = "text") -> DataFrame:
    """The documents not predicted toxic, with all their columns; no join is needed."""
    return docs.filter(score_column(F.col(text_column), model, docs.sparkSession) < 0.5)
