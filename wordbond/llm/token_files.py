"""Token ids in binary shards with a minimal perfect hash index.

Documents are range-partitioned and sorted by key, and each partition streams its
ids into ``shard-N.ids``: raw little-endian numbers, two bytes each if the
vocabulary allows. ``shard-N.idx`` maps a key to its documents in constant time
and without storing keys: the key's hash picks a bucket, the bucket's displacement
sends it to its slot, the slot's stored fingerprint tells foreign keys, and the
slot names the document whose offsets bound the ids. A small ``manifest`` table
has a row per shard.

Files are written under a temporary name and renamed, so a repeated task replaces
them whole. They live in a folder that all executors reach through pyarrow's file
systems. Null keys come first; equal keys lie next to each other, ordered by the
hash of their texts, and are found together, also where they fill several shards.
Null texts are empty. An empty table gives shards without documents or none;
other columns, whatever their names, are not read.
"""

from __future__ import annotations

import bisect
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .batches import small_batches
from .words import binary_values, token_ids

END = 1
_MAGIC = b"MPHTOK01"
_HEADER = struct.Struct("<8sIQQQ")  # magic, bytes per id, keys, buckets, documents
_KEYS_PER_BUCKET = 2
_MASK = (1 << 64) - 1
_FIELDS = "first_key {0}, last_key {0}, shard int, documents bigint, ids bigint, width int"


# --- the index ---------------------------------------------------------------


def _key_hash(key: int | str | None) -> tuple[int, int]:
    if key is None:
        data = b"\x00"
    else:
        data = b"\x01" + struct.pack("<q", key) if isinstance(key, int) else b"\x02" + key.encode()
    whole = xxhash.xxh3_128_intdigest(data)
    return whole & _MASK, whole >> 64


def _slot(high: int, displacement: int, slots: int) -> int:
    mixed = (high ^ displacement * 0x9E3779B97F4A7C15) & _MASK
    mixed = (mixed ^ mixed >> 30) * 0xBF58476D1CE4E5B9 & _MASK
    mixed = (mixed ^ mixed >> 27) * 0x94D049BB133111EB & _MASK
    return (mixed ^ mixed >> 31) % slots


def build_index(keys: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Displacements by bucket, fingerprints by slot, and the slot of each (distinct) key.

    Buckets are placed from large to small: a displacement is sought that sends
    all keys of a bucket to free slots. A bucket of one key names a free slot
    outright, as a negative displacement, so every slot is filled.
    """
    count = len(keys)
    buckets = max(1, -(-count // _KEYS_PER_BUCKET))
    members: list[list[int]] = [[] for _ in range(buckets)]
    hashes = [_key_hash(key) for key in keys]
    for place, (low, _) in enumerate(hashes):
        members[low % buckets].append(place)
    displacement = np.zeros(buckets, "<i8")
    slot_of, used = np.zeros(count, np.int64), bytearray(count)
    order = sorted(range(buckets), key=lambda b: -len(members[b]))
    for bucket in order:
        group = members[bucket]
        if len(group) < 2:
            break
        tried = 0
        while True:
            slots = [_slot(hashes[place][1], tried, count) for place in group]
            if len(set(slots)) == len(slots) and not any(used[slot] for slot in slots):
                break
            tried += 1
        displacement[bucket] = tried
        for place, slot in zip(group, slots):
            slot_of[place], used[slot] = slot, 1
    free = (slot for slot in range(count) if not used[slot])
    for bucket in order:
        if len(members[bucket]) == 1:
            slot_of[members[bucket][0]] = slot = next(free)
            displacement[bucket] = -slot - 1
    prints = np.zeros(count, "<u4")
    prints[slot_of] = [low >> 32 for low, _ in hashes]
    return displacement, prints, slot_of


class Shard:
    """Keyed access to one shard; the index is read once, ids on demand."""

    def __init__(self, files: pa.fs.FileSystem, path: str):
        raw = files.open_input_file(f"{path}.idx").readall()
        magic, self.width, keys, buckets, documents = _HEADER.unpack_from(raw)
        if magic != _MAGIC:
            raise ValueError(f"{path}.idx is no token index")
        at = _HEADER.size

        def array(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(raw, kind, count, at)
            at += found.nbytes
            return found

        self.displacement, self.prints = array("<i8", buckets), array("<u4", keys)
        self.first, self.copies = array("<u4", keys), array("<u4", keys)
        self.offsets = array("<u8", documents + 1)
        self.ids = files.open_input_file(f"{path}.ids")

    def find(self, key: int | str | None) -> range:
        """The numbers, within the shard, of the documents with this key."""
        if not len(self.prints):
            return range(0)
        low, high = _key_hash(key)
        moved = int(self.displacement[low % len(self.displacement)])
        slot = -moved - 1 if moved < 0 else _slot(high, moved, len(self.prints))
        if self.prints[slot] != low >> 32:
            return range(0)
        return range(self.first[slot], self.first[slot] + self.copies[slot])

    def read(self, number: int) -> np.ndarray:
        """The ids of a document by its number."""
        start, stop = (int(x) * self.width for x in self.offsets[number:number + 2])
        return np.frombuffer(self.ids.read_at(stop - start, start), f"<u{self.width}")


# --- writing -----------------------------------------------------------------


def _file_system(folder: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", folder))


def _write_index(files, path: str, width: int, keys: list, lengths: list[int]) -> None:
    distinct, first = [], []
    for place, key in enumerate(keys):  # equal keys are neighbours
        if not place or key != keys[place - 1]:
            distinct.append(key)
            first.append(place)
    displacement, prints, slot_of = build_index(distinct)
    begin, copies = np.zeros(len(distinct), "<u4"), np.zeros(len(distinct), "<u4")
    begin[slot_of], copies[slot_of] = first, np.diff(first + [len(keys)])
    offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).astype("<u8")
    with files.open_output_stream(path) as out:
        out.write(_HEADER.pack(_MAGIC, width, len(distinct), len(displacement), len(keys)))
        for part in (displacement, prints, begin, copies, offsets):
            out.write(part.tobytes())


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    end: int | None = END,
    shards: int | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Write shards in ascending key order and return the manifest.

    ``shards`` (by default the session's shuffle partitions) should leave each
    some ten thousand to a million documents: a task holds its keys and offsets.
    """
    spark = docs.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col(id_column).alias("_key"), F.col(text_column).cast("binary").alias("_text"),
    ).withColumn("_hash", F.xxhash64("_text"))
    kind = rows.schema["_key"].dataType.simpleString()
    ordered = (
        rows.repartitionByRange(shards, "_key", "_hash").sortWithinPartitions("_key", "_hash")
        .select("_key", "_text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        shard = task.partitionId()
        files, root = _file_system(folder)
        files.create_dir(root, recursive=True)
        path, attempt = f"{root}/shard-{shard:06d}", f"{root}/_attempt-{task.taskAttemptId()}"
        keys, lengths, width = [], [], 4
        with files.open_output_stream(f"{attempt}.ids") as out:
            for batch in batches:
                keys += batch.column(0).to_pylist()
                for ids in token_ids(binary_values(batch.column(1)), tokenizer_path, end):
                    out.write(ids.tobytes())
                    lengths.append(len(ids))
                    width = ids.itemsize
        _write_index(files, f"{attempt}.idx", width, keys, lengths)
        for suffix in (".ids", ".idx"):
            files.move(attempt + suffix, path + suffix)
        if keys:
            yield pa.RecordBatch.from_pydict({
                "first_key": [keys[0]], "last_key": [keys[-1]], "shard": pa.array([shard], pa.int32()),
                "documents": [len(keys)], "ids": [sum(lengths)], "width": pa.array([width], pa.int32()),
            })

    manifest = ordered.mapInArrow(run, _FIELDS.format(kind))
    with small_batches(spark):
        manifest.write.parquet(f"{folder}/manifest")
    return spark.read.schema(manifest.schema).parquet(f"{folder}/manifest")


# --- reading -----------------------------------------------------------------


def _order(key) -> tuple:
    """Keys in Spark's order: null first."""
    return (False,) if key is None else (True, key)


def read_token_files(spark: SparkSession, folder: str, keys: DataFrame, with_ids: bool = False) -> DataFrame:
    """Look up keys (one column) in the files; distinct keys that are missing give no row.

    Returns the key, ``start`` (ids of all documents before it), ``n_tokens``,
    ``ids_crc32`` over the ids as four-byte numbers, and on request ``ids``.
    """
    (name,) = keys.columns
    manifest = sorted(  # a row per shard
        spark.read.parquet(f"{folder}/manifest").collect(), key=lambda row: row.shard
    )
    before = np.concatenate([[0], np.cumsum([row.ids for row in manifest])]).tolist()
    shared = spark.sparkContext.broadcast((
        [row.shard for row in manifest], [_order(row.first_key) for row in manifest],
        [_order(row.last_key) for row in manifest],
        dict(zip([row.shard for row in manifest], before)),
    ))
    kind = keys.schema[name].dataType.simpleString()

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards, first, last, _ = shared.value
        for batch in batches:
            rows, where = [], []
            for row, key in enumerate(batch.column(0).to_pylist()):
                key = _order(key)
                for place in range(bisect.bisect_left(last, key), bisect.bisect_right(first, key)):
                    rows.append(row)
                    where.append(shards[place])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(where, pa.int32())],
                ["_key", "_shard"],
            )

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _file_system(folder)
        starts, open_shard, shard = shared.value[3], None, None
        for batch in batches:
            rows = []
            numbers = batch.column("_shard").to_pylist()
            for place, (key, number) in enumerate(zip(batch.column("_key").to_pylist(), numbers)):
                if number != open_shard:
                    open_shard, shard = number, Shard(files, f"{root}/shard-{number:06d}")
                for document in shard.find(key):
                    ids = shard.read(document)
                    start = starts[number] + int(shard.offsets[document])
                    crc = zlib.crc32(ids.astype("<u4").tobytes())
                    rows.append((place, start, len(ids), crc, ids if with_ids else None))
            columns = list(zip(*rows)) if rows else [()] * 5
            out = [batch.column("_key").take(pa.array(columns[0], pa.int64()))]
            out += [pa.array(column, pa.int64()) for column in columns[1:4]]
            if with_ids:
                out.append(pa.array([x.astype("<i4") for x in columns[4]], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(out, names[:len(out)])

    names = [name, "start", "n_tokens", "ids_crc32", "ids"]
    routed = keys.distinct().mapInArrow(route, f"_key {kind}, _shard int")
    by_shard = routed.repartition(max(len(manifest), 1), "_shard").sortWithinPartitions("_shard", "_key")
    return by_shard.mapInArrow(
        look_up, f"`{name}` {kind}, start bigint, n_tokens bigint, ids_crc32 bigint"
        + ", ids array<int>" * with_ids,
    )
