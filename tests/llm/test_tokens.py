"""Word-wise encoding, packing and token files against the tokenizers library."""

import bisect
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from wordbond.llm import packing, queries, token_files, words

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "\n\t", "plain words", "It's we'll THEY'D o'clock 1234 x²½", "a b c\u0085d\x1ce",
    "Straße ŒUVRE İstanbul ΣΑΣ ΑΣ", "é ́x ö\n̈", "日本語 テキスト。 한국어 ไทย", "🙂👍🏽 …—“q”",
    "<|endoftext|> a<|startoftext|>b < |endoftext|>", "\x00\x01 \x0b\x0c", "word " * 30_000, "x" * 50_000,
    "a​b ‍ c﻿d", "ǅ ﬁ Ⅷ ①", "'s 't 's's ''s",
]
SCHEMA = "doc_id bigint, text string, _key string, piece string, length string, ids string"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "a", "b", "c", "d") for i, t in rows], SCHEMA)


def library_ids(text, end=(1,)):
    return words.load_tokenizer(PATH).encode(text or "", add_special_tokens=False).ids + list(end)


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("block", [7, 1 << 22])
def test_words_encode_as_whole_texts(monkeypatch, block):
    monkeypatch.setattr(words, "CACHE_WORDS", 50)
    monkeypatch.setattr(words, "CACHE_PARTS", 30)
    monkeypatch.setattr(words.blocks, "__defaults__", (block,))
    encoder = words.WordEncoder(PATH)
    for text in ODD:
        found = np.frombuffer(encoder.encode((text or "").encode()), encoder.dtype).tolist()
        assert found == library_ids(text, ())


def test_every_character_encodes_as_in_whole_texts():
    encoder = words.WordEncoder(PATH)
    for start in range(0, 0x11000, 64):
        chars = [chr(c) for c in range(start, start + 64) if not 0xD800 <= c < 0xE000]
        text = " ".join(f"a{c}b {c} 1{c}" for c in chars)
        found = np.frombuffer(encoder.encode(text.encode()), encoder.dtype).tolist()
        assert found == library_ids(text, ())


def test_tokenizers_that_keep_white_space_are_refused():
    with pytest.raises(ValueError, match="white space"):
        words.WordEncoder(public_tokenizers.path("byte_bpe_50k.json"))


def brute_best_fit(lengths, capacity):
    rooms = []
    for length in sorted(lengths, reverse=True):
        place = bisect.bisect_left(rooms, length)
        room = rooms.pop(place) if place < len(rooms) else capacity
        bisect.insort(rooms, room - length)
    return sorted(rooms)


def spread(runs, histogram):
    """The bins that a table of runs fills: {bin: [(offset, length)]}."""
    bins = {}
    for place, (length, first, start, per_bin, offset) in enumerate(runs):
        after = [r[1] for r in runs[place + 1:] if r[0] == length]
        for d in range((after[0] if after else histogram[length]) - first):
            bins.setdefault(start + d // per_bin, []).append((offset + d % per_bin * length, length))
    return bins


@pytest.mark.parametrize("seed", range(30))
def test_runs_equal_best_fit_decreasing_piece_by_piece(seed):
    draw = random.Random(seed)
    capacity = draw.choice([1, 7, 10, 64, 100])
    lengths = [min(capacity, 1 + int(draw.expovariate(3 / capacity))) for _ in range(draw.randrange(400))]
    histogram = {x: lengths.count(x) for x in lengths}
    bins = spread(packing.best_fit_decreasing(histogram, capacity).tolist(), histogram)
    assert sorted(capacity - sum(n for _, n in held) for held in bins.values()) == brute_best_fit(lengths, capacity)
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity


def check_packed(found, rows, capacity):
    ids = {}
    for i, text in rows:
        ids.setdefault(i, []).append(library_ids(text))
    bins = {}
    for r in found:
        assert any(crc(x[r.start:r.start + r.length]) == r.ids_crc32 for x in ids[r.doc_id])
        assert r.start == r.piece * capacity
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    whole = [(str(i), start) for i, all_ids in ids.items() for x in all_ids for start in range(0, len(x), capacity)]
    assert sorted(whole) == sorted((str(r.doc_id), r.start) for r in found)
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    lengths = [r.length for r in found]
    assert len(bins) == len(brute_best_fit(lengths, capacity))


def test_packing_of_odd_documents(spark, workspace):
    rows = [*enumerate(ODD), (None, "no id"), (100, "same"), (101, "same"), (102, "same")]
    packed = packing.pack_documents(table(spark, rows), workspace, PATH, capacity=64, with_ids=True)
    found = packed.collect()
    check_packed(found, rows, 64)
    built = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    for r in found:
        assert built[r.sequence_id][r.offset:r.offset + r.length] == r.ids


def test_packing_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check_packed(queries.op10_best_fit_packing(spark, SF).collect(), rows, 4096)


def test_empty_tables(spark, workspace):
    assert packing.pack_documents(table(spark, []), workspace, PATH).collect() == []
    folder = workspace.new_path("none")
    token_files.write_token_files(table(spark, []), folder, PATH)
    assert token_files.read_token_files(spark, folder, table(spark, [(1, "")]).select("doc_id")).collect() == []


@pytest.mark.parametrize("count", [0, 1, 2, 3, 10, 3000])
def test_index_is_minimal_and_perfect(count):
    keys = [*range(count - count // 2), *(f"k{i}" for i in range(count // 2))]
    displacement, prints, slots = token_files.build_index(keys)
    assert sorted(slots) == list(range(count)) and len(prints) == count
    for key, slot in zip(keys, slots):
        low, high = token_files._key_hash(key)
        moved = int(displacement[low % len(displacement)])
        assert (-moved - 1 if moved < 0 else token_files._slot(high, moved, count)) == slot
        assert prints[slot] == low >> 32


def expected_files(rows):
    start, found = 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library_ids(text)
        found.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    return found


def test_token_files_of_odd_documents(spark, workspace):
    rows = [*enumerate(ODD, -3), (None, "no id"), (5000, "last")]
    folder = workspace.new_path("files")
    manifest = token_files.write_token_files(table(spark, rows), folder, PATH, shards=5)
    assert sum(r.documents for r in manifest.collect()) == len(rows)
    keys = table(spark, rows + [(777, "missing"), (-99, ""), (10**9, "")]).select("doc_id")
    found = token_files.read_token_files(spark, folder, keys, with_ids=True).collect()
    assert sorted((tuple(r)[:4] for r in found), key=lambda r: r[1]) == expected_files(rows)
    assert all(crc(r.ids) == r.ids_crc32 for r in found)


def test_equal_keys_are_all_found(spark, workspace):
    rows = [(1, "a"), (7, "b c"), (9, "z")] + [(7, f"text {i}") for i in range(40)] + [(7, "b c")]
    folder = workspace.new_path("files")
    token_files.write_token_files(table(spark, rows), folder, PATH, shards=6)
    found = token_files.read_token_files(spark, folder, table(spark, rows).select("doc_id")).collect()
    assert sorted((r.doc_id, r.ids_crc32) for r in found) == sorted((i, crc(library_ids(t))) for i, t in rows)
    place = 0
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == place
        place += r.n_tokens


def test_text_keys(spark, workspace):
    docs = spark.createDataFrame([("b", "x y"), ("", "z"), ("é", "w"), (None, "v")], "name string, text string")
    folder = workspace.new_path("files")
    token_files.write_token_files(docs, folder, PATH, shards=2, id_column="name")
    found = token_files.read_token_files(spark, folder, docs.select("name")).collect()
    assert [r.name for r in sorted(found, key=lambda r: r.start)] == [None, "", "b", "é"]


def test_token_files_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    found = queries.op5_token_files(spark, SF).collect()
    assert sorted(map(tuple, found)) == sorted(expected_files(rows))


def test_words_of_letters_marks_and_symbols_encode_as_the_library_does():
    encoder, draw = words.WordEncoder(PATH), random.Random(5)
    assert encoder.letters is not None
    alphabet = "abZéÉßŉİıŸſƀ9٣½.,'-…“Σςαक्한가́̈🙂_#ÀàÇⅷʰ"
    many = ["".join(draw.choice(alphabet) for _ in range(draw.randrange(1, 9))) for _ in range(20_000)]
    for start in range(0, len(many), 500):
        text = " ".join(many[start:start + 500])
        found = np.frombuffer(encoder.encode(text.encode()), encoder.dtype).tolist()
        assert found == library_ids(text, ())
