"""Byte-level BPE encoding and decoding over a table of distinct words.

Texts are split where a byte-level tokenizer with the usual pattern (a word takes
one blank before it) surely starts a new pre-token, so every split part is encoded
alike alone and in its text. The work is one exchange by word and one by chunk:

1. Spark tasks split their texts, chunk by chunk, into the chunk's distinct words
   and, for each document, the words' places in that list.
2. The words are exchanged by their hash, so that each distinct word meets all its
   chunks in one task, and there the library encodes it once.
3. Ids are joined back to the documents by chunk and place, and to the pieces they
   stand for: the id-to-piece table has a row per id, so the tokenizer bounds its
   size, and it is broadcast to where the ids are. Decoding uses nothing else of the
   tokenizer.

A chunk is a run of documents of about ``CHUNK_BYTES`` within a task, or a single
longer document. The input is read twice and must come in the same chunks both
times, as rows of stored files do; each chunk carries a checksum of its words, and
a mismatch fails the job. ``stored=False`` stores the input first.

Null texts are empty: no ids, and the decoded text is empty. Equal ids and
repeated rows each give a row, an empty table an empty result; ids may be of any
type that Arrow knows, null among them; other columns, whatever their names, are not
read.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..workspace import Workspace
from .words import binary_values, load_tokenizer

CHUNK_BYTES = 1 << 25
# Distinct words that a task remembers; words beyond are encoded again.
KNOWN_WORDS = 1_000_000

# Texts without any of these are cut before every blank and around every line end
# by plain string work: runs of three blanks or line ends, runs of two at the end,
# other white space, and the zero byte used as the mark.
_RARE = re.compile(
    rb"[ \n]{3}|[ \n]{2}\Z|[\x00\t\x0b-\r\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80"
    rb"|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"
)


def split_words(text: bytes, tokenizer) -> list[bytes]:
    """Parts of a text that the tokenizer encodes independently of each other."""
    special = _specials(tokenizer)
    if special is not None and special.search(text):
        parts = special.split(text)
        return [word for i, part in enumerate(parts) if part
                for word in ([part] if i % 2 else _split_plain(part, tokenizer))]
    return _split_plain(text, tokenizer)


def _split_plain(text: bytes, tokenizer) -> list[bytes]:
    if _RARE.search(text):
        string = text.decode(errors="replace")
        return [string[a:b].encode() for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(string)]
    marked = text.replace(b" ", b"\0 ").replace(b"\n", b"\0\n\0")
    return [word for word in marked.split(b"\0") if word]


@functools.lru_cache(maxsize=4)
def _special_pattern(contents: tuple[str, ...]) -> re.Pattern | None:
    if not contents:
        return None
    longest = sorted(contents, key=len, reverse=True)
    return re.compile(b"(" + b"|".join(re.escape(x.encode()) for x in longest) + b")")


def _specials(tokenizer) -> re.Pattern | None:
    added = tokenizer.get_added_tokens_decoder().values()
    return _special_pattern(tuple(token.content for token in added))


@functools.lru_cache(maxsize=1)
def _byte_of_char() -> dict[str, int]:
    """Byte-level BPE writes printable bytes as themselves, the others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printable]
    return {chr(b): b for b in printable} | {chr(256 + n): b for n, b in enumerate(others)}


def pieces_of(tokenizer) -> list[bytes]:
    """The bytes of each id."""
    table, byte_of = [b""] * tokenizer.get_vocab_size(with_added_tokens=True), _byte_of_char()
    for token, place in tokenizer.get_vocab(with_added_tokens=True).items():
        known = all(char in byte_of for char in token)
        table[place] = bytes(byte_of[char] for char in token) if known else token.encode()
    return table


def _squeeze(values: np.ndarray) -> bytes:
    return zstandard.compress(values.tobytes(), 1)


def _expand(data: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), kind)


class _Chunk:
    """The distinct words of some documents, in the order they first occur."""

    def __init__(self):
        self.size, self.owners, self.documents = 0, [], []
        self.places: dict[bytes, int] = {}

    def add(self, owner, text: bytes, tokenizer) -> None:
        places, words = self.places, split_words(text, tokenizer)
        for word in set(words).difference(places):
            places[word] = len(places)
        self.size += len(text)
        self.owners.append(owner)
        self.documents.append(np.fromiter(map(places.__getitem__, words), "<i4", len(words)))

    def checks(self) -> np.ndarray:
        return np.fromiter(map(zlib.crc32, self.places), "<u4", len(self.places))


def _chunks(batches: Iterator[pa.RecordBatch], path: str, size: int) -> Iterator[tuple[int, _Chunk]]:
    tokenizer = load_tokenizer(path)
    first = TaskContext.get().partitionId() << 32
    number, chunk = itertools.count(first), _Chunk()
    for batch in batches:
        for owner, text in zip(batch.column(0), binary_values(batch.column(1))):
            if chunk.owners and chunk.size + len(text) > size:
                yield next(number), chunk
                chunk = _Chunk()
            chunk.add(owner, text, tokenizer)
    if chunk.owners:
        yield next(number), chunk


def _word_rows(path: str, buckets: int, size: int):
    """Rows (bucket, chunk, check, words, lengths) with the chunk's words of that bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, chunk in _chunks(batches, path, size):
            checks, rows = chunk.checks(), []
            bucket, words = checks % buckets, list(chunk.places)
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for b in range(buckets):
                chosen = order[edges[b]:edges[b + 1]]
                if len(chosen):
                    mine = [words[i] for i in chosen.tolist()]
                    rows.append((
                        b, number, int(checks[chosen].sum(dtype=np.int64)),
                        zstandard.compress(b"".join(mine), 1),
                        _squeeze(np.fromiter(map(len, mine), "<u4", len(mine))),
                    ))
            yield from _batches(rows, ("bucket", "chunk", "check", "words", "lengths"), 64)

    return run


def _document_rows(path: str, buckets: int, size: int, kind: pa.DataType):
    """Rows (chunk, id, places, bucket, check); the chunk's first row says the words' buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, chunk in _chunks(batches, path, size):
            checks = chunk.checks()
            whole = [_squeeze((checks % buckets).astype("<u4"))] + [None] * (len(chunk.owners) - 1)
            yield pa.RecordBatch.from_pydict({
                "chunk": pa.array([number] * len(chunk.owners), pa.int64()),
                "_id": pa.array([owner.as_py() for owner in chunk.owners], kind),
                "places": pa.array([_squeeze(p) for p in chunk.documents], pa.binary()),
                "buckets": pa.array(whole, pa.binary()),
                "check": pa.array([int(checks.sum(dtype=np.int64))] * len(chunk.owners), pa.int64()),
            })

    return run


def _batches(rows: list[tuple], names: tuple[str, ...], step: int) -> Iterator[pa.RecordBatch]:
    kinds = {"words": pa.binary(), "lengths": pa.binary(), "counts": pa.binary(), "ids": pa.binary(),
             "bucket": pa.int32(), "chunk": pa.int64(), "check": pa.int64()}
    for at in range(0, len(rows), step):
        columns = zip(*rows[at:at + step])
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, kinds[name]) for name, column in zip(names, columns)], list(names)
        )


def _encode_rows(path: str):
    """Encode each distinct word of a task's buckets once: rows (chunk, bucket, check, counts, ids)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, known = load_tokenizer(path), {}
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                joined = zstandard.decompress(row["words"])
                ends = np.cumsum(_expand(row["lengths"], "<u4"), dtype=np.int64).tolist()
                words = [joined[a:b] for a, b in zip([0, *ends], ends)]
                new = list(set(words).difference(known))
                if len(known) > KNOWN_WORDS:
                    known, new = {}, list(set(words))
                encoded = tokenizer.encode_batch_fast(
                    [word.decode(errors="replace") for word in new], add_special_tokens=False
                )
                for word, found in zip(new, encoded):
                    known[word] = np.array(found.ids, "<u4").tobytes()
                ids = [known[word] for word in words]
                rows.append((
                    row["chunk"], row["bucket"], row["check"],
                    _squeeze(np.fromiter(map(len, ids), "<u4", len(ids)) // 4),
                    zstandard.compress(b"".join(ids), 1),
                ))
            yield from _batches(rows, ("chunk", "bucket", "check", "counts", "ids"), 64)

    return run


def _joined(documents: pa.Table, words: pa.Table) -> Iterator[tuple[object, np.ndarray]]:
    """Each document of a chunk with its ids."""
    documents = documents.to_pydict()
    first = next(i for i, b in enumerate(documents["buckets"]) if b is not None)
    bucket = _expand(documents["buckets"][first], "<u4")
    words = words.sort_by("bucket").to_pydict()
    if sum(words["check"]) != documents["check"][0]:
        raise RuntimeError("the input came in other chunks when read again: pass stored=False")
    counts = np.concatenate([_expand(c, "<u4") for c in words["counts"]] or [np.empty(0, "<u4")])
    ids = np.concatenate([_expand(x, "<u4") for x in words["ids"]] or [np.empty(0, "<u4")])
    # Words lie by bucket, and within it in the order they first occur.
    count_of, start_of = np.empty(len(bucket), np.int64), np.empty(len(bucket), np.int64)
    order = np.argsort(bucket, kind="stable")
    count_of[order], start_of[order] = counts, np.cumsum(counts, dtype=np.int64) - counts
    for owner, packed in zip(documents["_id"], documents["places"]):
        places = _expand(packed, "<i4")
        count = count_of[places]
        ends = np.cumsum(count)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(start_of[places] - ends + count, count)
        yield owner, ids[at]


@dataclass(frozen=True)
class PieceTable:
    """The id-to-piece table: a row per id, of which a vocabulary bounds the number, so it is broadcast."""

    pieces: bytes
    starts: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, tokenizer) -> "PieceTable":
        pieces = pieces_of(tokenizer)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        return cls(b"".join(pieces), np.cumsum(lengths) - lengths, lengths)

    def join(self, ids: np.ndarray) -> bytes:
        """The pieces of ids, put together in their order."""
        counts = self.lengths[ids]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.starts[ids] - ends + counts, counts)
        return np.frombuffer(self.pieces, np.uint8)[at].tobytes()


def _finish(table: Broadcast, name: str, kind: pa.DataType, with_ids: bool):
    def run(documents: pa.Table, words: pa.Table) -> pa.Table:
        pieces, text_of, rows = table.value, _id_texts(len(table.value.lengths)), []
        for owner, ids in _joined(documents, words):
            listed = ids.tolist()
            decoded = pieces.join(ids).decode(errors="replace").encode()
            rows.append((
                owner, len(listed), hashlib.sha256(",".join(map(text_of.__getitem__, listed)).encode()).hexdigest(),
                hashlib.sha256(decoded).hexdigest(), ids.astype("<i4") if with_ids else None,
                decoded.decode() if with_ids else None,
            ))
        columns = list(zip(*rows))
        fields = [(name, kind), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
                  ("decoded_sha256", pa.string()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())]
        chosen = fields if with_ids else fields[:4]
        return pa.table({f: pa.array(column, k) for (f, k), column in zip(chosen, columns)})

    return run


@functools.lru_cache(maxsize=2)
def _id_texts(count: int) -> list[str]:
    return [str(place) for place in range(count)]


def encode_decode(
    docs: DataFrame,
    tokenizer_path: str,
    workspace: Workspace | None = None,
    stored: bool = False,
    buckets: int | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = False,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Per document: id, ``n_tokens, ids_sha256, decoded_sha256`` and on request ``ids, decoded``.

    ``buckets`` (by default the session's shuffle partitions) is the number of
    tasks that share the distinct words.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).alias("_id"), F.col(text_column).cast("binary").alias("_text"))
    if not stored:
        rows = (workspace or Workspace(spark)).store(rows, "texts")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = rows.schema["_id"].dataType.simpleString()
    arrow_kind = to_arrow_type(rows.schema["_id"].dataType)
    pieces = spark.sparkContext.broadcast(PieceTable.of(load_tokenizer(tokenizer_path)))

    words = rows.mapInArrow(
        _word_rows(tokenizer_path, buckets, chunk_bytes),
        "bucket int, chunk bigint, check bigint, words binary, lengths binary",
    )
    encoded = words.repartition(buckets, "bucket").mapInArrow(
        _encode_rows(tokenizer_path),
        "chunk bigint, bucket int, check bigint, counts binary, ids binary",
    )
    places = rows.mapInArrow(
        _document_rows(tokenizer_path, buckets, chunk_bytes, arrow_kind),
        f"chunk bigint, _id {kind}, places binary, buckets binary, check bigint",
    )
    result = f"`{id_column}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return places.groupBy("chunk").cogroup(encoded.groupBy("chunk")).applyInArrow(
        _finish(pieces, id_column, arrow_kind, with_ids),
        result + ", ids array<int>, decoded string" * with_ids,
    )
