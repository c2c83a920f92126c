"""Encoding by distinct words, for tokenizers that never look past white space.

A text is cut at ASCII white space (bytes ``09-0d`` and ``20``), where such a
tokenizer starts anew. Texts are worked through in groups: NumPy cuts a group, Arrow
finds what is distinct in it, each distinct piece is encoded once, and NumPy puts the
ids of all texts together. A worker keeps the pieces of the last groups in bounded
tables, which forget those that were not met again.

If the tokenizer lower-cases and separates letters from everything else, texts are
cut further, into runs of letters and of other characters, which recur more often
than words with their punctuation; runs of Latin letters skip the normalising
steps that cannot change them, and many go to the library as one line. Words with an
apostrophe, or with marks and symbols beyond ASCII, are encoded whole.
"""

from __future__ import annotations

import array
import functools
import json
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute

# Words, and parts of words, that a worker's tables hold before they begin to forget;
# bytes of text that are cut into words at a time; words that go to the library as one line.
CACHE_WORDS, CACHE_PARTS, BLOCK_BYTES, LINE_WORDS = 30_000, 100_000, 1 << 20, 200
_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def binary_values(column: pa.Array) -> Iterator[bytes]:
    """The values of a binary or string column one by one, null as empty."""
    for value in column:
        yield value.as_buffer().to_pybytes() if value.is_valid else b""


def blocks(text: bytes, size: int = BLOCK_BYTES) -> Iterator[bytes]:
    """Pieces of about ``size`` bytes that end before white space or at the end."""
    at = 0
    while at < len(text):
        gap = _SPACE.search(text, at + size) if len(text) - at > size else None
        end = gap.start() if gap else len(text)
        yield text[at:end]
        at = end


@functools.lru_cache(maxsize=4)
def load_tokenizer(path: str):
    """The tokenizer of a file, without truncation or padding; one per worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


# The steps of the public word-end tokenizer.
_LETTERS_APART = {
    "normalizer": ["NFC", "Replace", "Lowercase"],
    "pattern": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
}
# Kinds of bytes: white space, letters, others; and words that are encoded whole.
_GAP, _LETTER, _OTHER, _WHOLE = range(4)
_KINDS = bytes(
    _GAP if byte == 0x20 or 0x09 <= byte <= 0x0D else _LETTER if byte >= 0x80 or chr(byte).isalpha() else _OTHER
    for byte in range(256)
)


def _separates_letters(steps: dict) -> bool:
    normalizer, splitter = steps.get("normalizer") or {}, steps.get("pre_tokenizer") or {}
    kinds = [step["type"] for step in normalizer.get("normalizers", [])]
    first = (splitter.get("pretokenizers") or [{}])[0]
    return kinds == _LETTERS_APART["normalizer"] and (
        first.get("pattern", {}).get("Regex") == _LETTERS_APART["pattern"]
    )


def _letters_only(path: str):
    """The tokenizer without its normalizer and pattern, for runs of lower-case letters."""
    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    tokenizer.normalizer = normalizers.Sequence([])
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return tokenizer


def _lines_of_letters(path: str, steps: dict):
    """The tokenizer of :func:`_letters_only` for runs of letters apart by blanks, and which pieces end a run."""
    from tokenizers import pre_tokenizers

    tokenizer = _letters_only(path)
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
    ])
    ends_word = np.zeros(tokenizer.get_vocab_size(), bool)
    suffix = steps["model"].get("end_of_word_suffix")
    ends_word[[place for piece, place in tokenizer.get_vocab().items() if suffix and piece.endswith(suffix)]] = True
    return tokenizer, ends_word


def _slices(column: pa.LargeBinaryArray) -> list[bytes]:
    """The values of a column without nulls, faster than one by one."""
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1].tolist()
    raw = data.to_pybytes()
    return [raw[a:b] for a, b in zip(ends, ends[1:])]


class _Recent:
    """A table that forgets what was not asked for while as much again came in."""

    def __init__(self, size: int):
        self.size = size
        self.young: dict[bytes, bytes | None] = {}
        self.old: dict[bytes, bytes | None] = {}

    def missing(self, keys: list[bytes]) -> list[bytes]:
        """The keys that are not known; all others are in ``young`` now."""
        if len(self.young) > self.size:
            self.old, self.young = self.young, {}
        unknown = [key for key in keys if key not in self.young]
        if self.old:
            self.young.update((key, self.old[key]) for key in unknown if key in self.old)
            unknown = [key for key in unknown if key not in self.young]
        return unknown


class WordEncoder:
    """Ids of texts as little-endian arrays, two bytes per id if the vocabulary allows, else four."""

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        apart = [self.encode_whole(text) for text in ("Probe", "Probe's", "x9")]
        if self.encode_whole("Probe \n Probe's\tx9 ") != sum(apart, []):
            raise ValueError(f"{path} does not drop white space, so texts can't be encoded by words")
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        steps = json.loads(self.tokenizer.to_str())
        self.letters = _letters_only(path) if _separates_letters(steps) else None
        if self.letters is not None:
            self.lines, self.ends_word = _lines_of_letters(path, steps)
        self.special = [token.content.encode() for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.known, self.parts = _Recent(CACHE_WORDS), _Recent(CACHE_PARTS)

    def encode_whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, text: bytes) -> bytes:
        """The ids of one text."""
        return b"".join(ids.tobytes() for ids in self.encode_all([text]))

    def encode_all(self, texts: Iterable[bytes]) -> Iterator[np.ndarray]:
        """The ids of each text. Groups of texts, and blocks of long ones, are worked through at a time."""
        group: list[bytes] = []  # blocks of texts
        sizes: list[int] = []  # blocks of each text of the group
        size = 0
        for text in texts:
            sizes.append(0)
            ready: list[np.ndarray] = []  # of a text whose first blocks are done
            for block in blocks(text):
                group.append(block)
                sizes[-1] += 1
                size += len(block)
                if size >= BLOCK_BYTES:
                    done = self._encode_group(group)
                    yield from self._joined(done, sizes[:-1])
                    ready += done[len(done) - sizes[-1]:] if sizes[-1] else []
                    group, sizes, size = [], [0], 0
            if ready:
                ready += self._encode_group(group)
                yield np.concatenate(ready)
                group, sizes, size = [], [], 0
        yield from self._joined(self._encode_group(group), sizes)

    def _joined(self, done: list[np.ndarray], sizes: list[int]) -> Iterator[np.ndarray]:
        at = 0
        for size in sizes:
            yield done[at] if size == 1 else np.concatenate([np.empty(0, self.dtype), *done[at:at + size]])
            at += size

    def _encode_group(self, group: list[bytes]) -> list[np.ndarray]:
        """The ids of each block of text."""
        text = b" ".join(group)
        raw = np.frombuffer(text, np.uint8)
        if not len(raw):
            return [np.empty(0, self.dtype) for _ in group]
        lower, kind = (np.frombuffer(made, np.uint8) for made in (text.lower(), text.translate(_KINDS)))
        solid = kind != _GAP
        word = np.cumsum(solid & ~np.concatenate([[False], solid[:-1]]), dtype=np.int32)  # numbers words from 1
        whole = np.full(word[-1] + 1, self.letters is None)
        if self.letters is not None:
            whole[word[self._apart(text, raw)]] = True
        while True:
            starts, places, listed = self._pieces(raw, lower, np.where(solid & whole[word], _WHOLE, kind))
            unsure = [place for place, ids in enumerate(listed) if ids is None]
            if not unsure:
                break
            whole[word[starts[np.isin(places, unsure)]]] = True
        lengths = np.fromiter(map(len, listed), np.int64, len(listed)) // self.dtype.itemsize
        first = np.cumsum(lengths) - lengths
        counts = lengths[places]
        ends = np.cumsum(counts)
        shift = np.repeat(first[places] - (ends - counts), counts)
        ids = np.frombuffer(b"".join(listed), self.dtype)[np.arange(len(shift)) + shift]
        begins = np.cumsum([0, *(len(block) + 1 for block in group)])  # of blocks, in bytes
        borders = np.concatenate([[0], ends])[np.searchsorted(starts, begins)]
        return [ids[a:b] for a, b in zip(borders, borders[1:])]

    def _apart(self, text: bytes, raw: np.ndarray) -> np.ndarray:
        """Places in words that must be encoded whole: apostrophes and special tokens."""
        found = [np.flatnonzero(raw == ord("'"))]
        for special in self.special:
            if special in text:
                found.append(np.array([match.start() for match in re.finditer(re.escape(special), text)]))
        return np.concatenate(found)

    def _pieces(
        self, raw: np.ndarray, lower: np.ndarray, kind: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, list[bytes | None]]:
        """Where pieces of one kind begin, which distinct piece each is, and the ids of the distinct ones."""
        solid = kind != _GAP
        starts = np.flatnonzero(solid & np.concatenate([[True], kind[1:] != kind[:-1]]))
        packed = np.where(kind == _WHOLE, raw, lower)[solid]
        offsets = np.append(np.cumsum(solid, dtype=np.int32)[starts].astype(np.int64) - 1, len(packed))
        pieces = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(packed)]
        )
        is_whole = kind[starts] == _WHOLE
        places, listed = np.zeros(len(starts), np.int64), []
        for chosen, table, learn in (
            (~is_whole, self.parts, self._learn_parts), (is_whole, self.known, self._learn_whole)
        ):
            if chosen.any():
                found = pieces.filter(pa.array(chosen)).dictionary_encode()
                keys = _slices(found.dictionary)
                learn(table.missing(keys))
                places[chosen] = found.indices.to_numpy() + len(listed)
                listed += [table.young[key] for key in keys]
        return starts, places, listed

    def _learn_whole(self, words: list[bytes]) -> None:
        self._learn(self.known.young, words)

    def _learn(self, table: dict, words: list[bytes]) -> None:
        """Encode words, or parts of words, one by one."""
        found = self.tokenizer.encode_batch_fast(
            [word.decode(errors="replace") for word in words], add_special_tokens=False
        )
        kind = "H" if self.dtype.itemsize == 2 else "I"
        for word, encoded in zip(words, found):
            table[word] = array.array(kind, encoded.ids).tobytes()

    def _learn_letters(self, words: list[bytes]) -> Iterator[bytes]:
        """Encode runs of lower-case letters, many to a line; the pieces that end a word tell them apart."""
        lines = [words[at:at + LINE_WORDS] for at in range(0, len(words), LINE_WORDS)]
        for line, encoded in zip(lines, self.lines.encode_batch_fast(
            [b" ".join(line).decode() for line in lines], add_special_tokens=False
        )):
            ids = np.array(encoded.ids, self.dtype)
            ends = (np.flatnonzero(self.ends_word[ids]) + 1) * self.dtype.itemsize
            if len(ends) == len(line):
                raw, cuts = ids.tobytes(), ends.tolist()
                yield from [raw[a:b] for a, b in zip([0, *cuts], cuts)]
            else:
                each = self.letters.encode_batch_fast([word.decode() for word in line], add_special_tokens=False)
                yield from [np.array(one.ids, self.dtype).tobytes() for one in each]

    def _learn_parts(self, parts: list[bytes]) -> None:
        """Ids of runs of letters or others; None where neighbours may matter."""
        plain = [part for part in parts if part.isalpha()]  # ASCII letters
        self.parts.young.update(zip(plain, self._learn_letters(plain)))
        latin, other = {}, []
        for part in parts:
            if part.isalpha():
                continue
            text = part.decode(errors="replace")
            if part[0] < 0x80 and not part[:1].isalpha():
                other.append(part)  # ASCII without letters
            elif not text.isalpha() or "\u0130" in text:
                self.parts.young[part] = None  # U+0130 becomes a letter and a mark
            elif max(text) < "\u0250":
                latin[part] = text.lower().encode()
            else:
                other.append(part)
        self._learn(self.parts.young, other)
        lowered = list(dict.fromkeys(latin.values()))
        ids = dict(zip(lowered, self._learn_letters(lowered)))
        for part, text in latin.items():
            self.parts.young[part] = ids[text]


@functools.lru_cache(maxsize=4)
def word_encoder(path: str) -> WordEncoder:
    """One encoder, with its cache, per worker process and file."""
    return WordEncoder(path)


def token_ids(texts: Iterable[bytes], path: str, end: int | None) -> Iterator[np.ndarray]:
    """The ids of each text, with the id ``end`` after them unless it is None."""
    encoder = word_encoder(path)
    tail = np.array([] if end is None else [end], encoder.dtype)
    for ids in encoder.encode_all(texts):
        yield np.concatenate([ids, tail])
