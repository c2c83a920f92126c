"""Cross-entropy difference: how much more a text resembles the target than the corpus.

Two bigram models of one kind are counted over whole texts: the target model over
the target documents, the background model over all documents. Both share one
vocabulary, all words of the corpus, so their losses are comparable word by word::

    p(w)     = (c(w) + ALPHA) / (N + ALPHA * V)
    p(w | v) = (c(v, w) + MU * p(w)) / (c(v) + MU)

A document is its words between a begin and an end mark; ``score`` is the mean over
its words and the end mark of the target loss less the background loss, in nats.
Low scores are like the target.

Words are runs of letters and digits, A-Z lower-cased. N-grams are counted by a
64-bit hash. Tasks count their texts chunk by chunk; a chunk's distinct n-grams go
to the n-gram's bucket with their counts, are summed there over all chunks, and
the sums go back to the chunk, whose documents they score. So the work and what is
exchanged grow with the corpus, no table of n-grams is ever in one place, and a
frequent n-gram is one entry per chunk.

The input is read twice and must come in the same chunks, as stored files do; a
checksum per chunk fails the job otherwise. ``stored=False`` stores it first.

Null and empty texts are scored on their end mark alone. Equal ids and repeated
rows are counted and scored one by one. Without target documents the target model
is even over the vocabulary. An empty table gives an empty result; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..operators.joining import broadcast_if_small
from ..workspace import Workspace
from .batches import small_batches
from .words import binary_values

CHUNK_BYTES = 1 << 23
ALPHA, MU = 0.5, 5.0
_WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
_BEGIN, _END = 0, 1  # places of the marks in every chunk's word list
_MARKS = np.array([0x9E3779B97F4A7C15, 0xD1B54A32D192ED03], np.uint64)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _pack(values: np.ndarray) -> bytes:
    return zstandard.compress(values.tobytes(), 1)


def _unpack(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


@dataclass
class _Chunk:
    """Documents as places in the chunk's list of words, and the words' hashes."""

    hashes: np.ndarray
    documents: list[np.ndarray]

    def sequence(self) -> tuple[np.ndarray, np.ndarray]:
        """Contexts and the words that follow them, document after document."""
        lengths = np.fromiter(map(len, self.documents), np.int64, len(self.documents))
        words = np.full(int(lengths.sum()) + len(lengths), _END, np.int32)
        ends = np.cumsum(lengths + 1) - 1
        inner = np.ones(len(words), bool)
        inner[ends] = False
        words[inner] = np.concatenate(self.documents) if len(self.documents) else []
        contexts = np.empty_like(words)
        contexts[1:] = words[:-1]
        contexts[np.concatenate([[0], ends[:-1] + 1])] = _BEGIN
        return contexts, words

    def grams(self):
        """Sorted keys of all n-grams; each bigram's and each word's place among them.

        Keys of words are even, those of bigrams odd.
        """
        contexts, words = self.sequence()
        with np.errstate(over="ignore"):
            one = self.hashes & ~np.uint64(1)
            turned = (self.hashes << np.uint64(31)) | (self.hashes >> np.uint64(33))
            pairs = (self.hashes[contexts] * _MIX) ^ turned[words]
            pairs = ((pairs ^ (pairs >> np.uint64(29))) * _MIX) | np.uint64(1)
        unique, place = np.unique(pairs, return_inverse=True)
        keys = np.sort(np.concatenate([unique, np.unique(one)]))
        return keys, np.searchsorted(keys, unique)[place], np.searchsorted(keys, one), contexts, words


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, list, list[bool], _Chunk]]:
    """Number, ids, target flags and words of each chunk of a task's rows."""
    number = itertools.count(TaskContext.get().partitionId() << 32)
    owners, flags, documents, places, held = [], [], [], {}, 0

    def made():
        named = np.fromiter(map(xxhash.xxh3_64_intdigest, places), np.uint64, len(places))
        return next(number), owners, flags, _Chunk(np.concatenate([_MARKS, named]), documents)

    for batch in batches:
        ids, target = batch.column("_id"), batch.column("_target").to_pylist()
        for row, text in enumerate(binary_values(batch.column("_text"))):
            if owners and held + len(text) > size:
                yield made()
                owners, flags, documents, places, held = [], [], [], {}, 0
            words = _WORD.findall(text.lower())
            for word in set(words).difference(places):
                places[word] = len(places) + 2
            owners.append(ids[row].as_py())
            flags.append(bool(target[row]))
            documents.append(np.fromiter(map(places.__getitem__, words), np.int32, len(words)))
            held += len(text)
    if owners:
        yield made()


def _check(keys: np.ndarray) -> int:
    return int(np.bitwise_xor.reduce(keys).view(np.int64)) if len(keys) else 0


def _count_rows(buckets: int, size: int):
    """Rows (bucket, chunk, keys, target, background): a chunk's counts in each range of keys."""
    width = (1 << 64) // buckets + 1
    bounds = np.array([min(i * width, (1 << 64) - 1) for i in range(1, buckets)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, _, flags, chunk in _chunks(batches, size):
            keys, pairs, ones, contexts, words = chunk.grams()
            lengths = [len(d) + 1 for d in chunk.documents]
            target = np.repeat(np.array(flags, float), lengths)
            counts = []
            for weight in (target, np.ones(len(words))):
                total = np.bincount(pairs, weight, len(keys))
                total += np.bincount(ones[words], weight, len(keys))
                total[ones[_BEGIN]] += weight[contexts == _BEGIN].sum()
                counts.append(total.astype("<u4"))
            edges = [0, *np.searchsorted(keys, bounds).tolist(), len(keys)]
            rows = []
            for bucket, (a, b) in enumerate(zip(edges, edges[1:])):
                if b > a:
                    steps = np.diff(keys[a:b], prepend=np.uint64(0))
                    rows.append((bucket, number, _pack(steps), _pack(counts[0][a:b]), _pack(counts[1][a:b])))
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()),
                 *(pa.array(c, pa.binary()) for c in columns[2:])],
                ["bucket", "chunk", "keys", "target", "background"],
            )

    return run


def _sum_bucket(table: pa.Table) -> pa.Table:
    """Replace the counts of each chunk by their sums over all chunks.

    The bucket's number of words, and the sizes of both models, ride on its first row.
    """
    rows = table.to_pydict()
    keys = [np.cumsum(_unpack(k, "<u8"), dtype=np.uint64) for k in rows["keys"]]
    unique, place = np.unique(np.concatenate(keys), return_inverse=True)
    edges = np.cumsum([0, *map(len, keys)])
    sums = []
    for name in ("target", "background"):
        counted = np.concatenate([_unpack(c, "<u4") for c in rows[name]])
        sums.append(np.bincount(place, counted, len(unique)))
    words = (unique & np.uint64(1)) == 0
    words &= unique != (_MARKS[_BEGIN] & ~np.uint64(1))
    stats = [int(words.sum()), *(int(s[words].sum()) for s in sums)]
    back = [[_pack(s[place[a:b]].astype("<u8")) for a, b in zip(edges, edges[1:])] for s in sums]
    rest = len(keys) - 1
    return pa.table({
        "chunk": pa.array(rows["chunk"], pa.int64()), "bucket": pa.array(rows["bucket"], pa.int32()),
        "check": pa.array([_check(k) for k in keys], pa.int64()),
        "target": pa.array(back[0], pa.binary()), "background": pa.array(back[1], pa.binary()),
        **{name: pa.array([stat] + [0] * rest, pa.int64())
           for name, stat in zip(("words", "target_size", "background_size"), stats)},
    })


def _document_rows(size: int, kind: pa.DataType):
    """Rows (chunk, id, places, hashes); the chunk's first row holds its words' hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, owners, _, chunk in _chunks(batches, size):
            yield pa.RecordBatch.from_arrays(
                [pa.array([number] * len(owners), pa.int64()), pa.array(owners, kind),
                 pa.array([_pack(d) for d in chunk.documents], pa.binary()),
                 pa.array([_pack(chunk.hashes)] + [None] * (len(owners) - 1), pa.binary())],
                ["chunk", "_id", "places", "hashes"],
            )

    return run


def _losses(chunk: _Chunk, counts: np.ndarray, grams, size: float, words: int, alpha: float, mu: float):
    _, pairs, ones, context, word = grams
    single = (counts[ones] + alpha) / (size + alpha * words)
    return -np.log((counts[pairs] + mu * single[word]) / (counts[ones][context] + mu))


def _score(name: str, kind: pa.DataType, sizes: dict[str, int], alpha: float, mu: float):
    def run(documents: pa.Table, sums: pa.Table) -> pa.Table:
        documents, sums = documents.to_pydict(), sums.sort_by("bucket").to_pydict()
        hashes = next(h for h in documents["hashes"] if h is not None)
        chunk = _Chunk(_unpack(hashes, "<u8"), [_unpack(p, "<i4") for p in documents["places"]])
        grams = chunk.grams()
        counts = [
            np.concatenate([_unpack(c, "<u8") for c in sums[kind_of]] or [np.empty(0, "<u8")])
            for kind_of in ("target", "background")
        ]
        check = 0
        for part in sums["check"]:
            check ^= part
        if len(counts[0]) != len(grams[0]) or check != _check(grams[0]):
            raise RuntimeError("the input came in other chunks when read again: pass stored=False")
        lengths = np.fromiter(map(len, chunk.documents), np.int64, len(chunk.documents))
        starts = np.cumsum(lengths + 1) - lengths - 1
        mean = [
            np.add.reduceat(_losses(chunk, c, grams, sizes[s], sizes["words"], alpha, mu), starts) / (lengths + 1)
            for c, s in zip(counts, ("target_size", "background_size"))
        ]
        return pa.table({
            name: pa.array(documents["_id"], kind), "n_words": pa.array(lengths, pa.int64()),
            "target_loss": pa.array(mean[0]), "background_loss": pa.array(mean[1]),
            "score": pa.array(mean[0] - mean[1]),
        })

    return run


def score_documents(
    docs: DataFrame,
    target_ids: DataFrame,
    workspace: Workspace,
    stored: bool = False,
    buckets: int | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    alpha: float = ALPHA,
    mu: float = MU,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Per document: id, ``n_words, target_loss, background_loss, score``.

    ``target_ids`` (one column) names the target documents. ``buckets`` (by default
    the session's shuffle partitions) is the number of tasks that share the n-grams;
    one holds its n-grams in memory, some million at best.
    """
    spark = docs.sparkSession
    wanted = target_ids.select(F.col(target_ids.columns[0]).alias("_wanted")).filter(
        "_wanted IS NOT NULL"
    ).distinct()
    marked = broadcast_if_small(wanted)
    rows = docs.select(
        F.col(id_column).alias("_id"), F.col(text_column).cast("binary").alias("_text")
    ).join(marked, F.col("_id") == F.col("_wanted"), "left").select(
        "_id", "_text", F.col("_wanted").isNotNull().alias("_target")
    )
    # A shuffled join deals rows out anew on each read; a broadcast one leaves them in place.
    if not stored or marked is wanted:
        rows = workspace.store(rows, "marked-documents")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = rows.schema["_id"].dataType.simpleString()
    arrow_kind = pa.string() if kind == "string" else {"bigint": pa.int64(), "int": pa.int32()}[kind]
    counted = rows.mapInArrow(
        _count_rows(buckets, chunk_bytes),
        "bucket int, chunk bigint, keys binary, target binary, background binary",
    )
    summed = counted.groupBy("bucket").applyInArrow(
        _sum_bucket, "chunk bigint, bucket int, check bigint, target binary, background binary,"
        " words bigint, target_size bigint, background_size bigint",
    )
    with small_batches(spark):
        sums, sizes = workspace.store_observed(
            summed, "sums", [F.sum(n).alias(n) for n in ("words", "target_size", "background_size")]
        )
    documents = rows.mapInArrow(
        _document_rows(chunk_bytes, arrow_kind), f"chunk bigint, _id {kind}, places binary, hashes binary"
    )
    columns = sums.select("chunk", "bucket", "check", "target", "background")
    return documents.groupBy("chunk").cogroup(columns.groupBy("chunk")).applyInArrow(
        _score(id_column, arrow_kind, {name: size or 0 for name, size in sizes.items()}, alpha, mu),
        f"`{id_column}` {kind}, n_words bigint, target_loss double, background_loss double, score double",
    )
