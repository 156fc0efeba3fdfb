"""Token ids of whole texts from a tokenizer file, in bounded memory.

Blanks never reach the model of such a tokenizer, so a text's ids are those of its blank-separated words one after
the other, and each word is encoded once and then looked up. The different words of a group of texts are looked up
together; new ones are cut into pieces together, and each piece is encoded once by the model. Words with unusual
characters are cut the tokenizer's own way. Whether a tokenizer file allows this is checked when it is loaded; if not,
texts are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
from array import array
from collections.abc import Iterator
from itertools import pairwise, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are cut at blanks into segments of about this many bytes.
SEGMENT = 1 << 20
# Short texts are looked up together, about this many bytes of them, and get their ids by about this many words.
GROUP = 1 << 22
GATHERED = 1 << 17
# Words and pieces kept between texts, in two generations: when the young one is full it becomes the old one, and what
# the old one held is dropped unless it was met again meanwhile. So frequent words are encoded once.
WORDS = 400_000
PIECES = 300_000

_BLANK = re.compile(rb"[\x20\x09-\x0D]")
# Capitals that compose with none of these marks (U+0308, U+030A, U+030C, U+0331, U+0344) while their small letters do.
_MARKED = re.compile(rb"[HJTWY](?=[\x80-\xff]*(?:\xcc[\x88\x8a\x8c\xb1]|\xcd\x84))")
# Words of ASCII letters, digits and signs and of Latin letters that are composed already and fold to one letter each.
_PLAIN = re.compile("[\x21-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]*")
# The split rule of the supported files for such words, which are folded and end with _END.
_PIECES = re.compile(rb"'(?:s|t|re|ve|m|ll|d)|[a-z\x80-\xff]+|[0-9]|[^a-z0-9\x80-\xff\n]+|\n")
_END = b"\n"


def segments(text: bytes, size: int = SEGMENT) -> Iterator[bytes]:
    """The text in slices that end before a blank; a word longer than ``size`` stays whole."""
    start = 0
    while len(text) - start > size:
        found = _BLANK.search(text, start + size)
        if found is None:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def folded(text: bytes) -> bytes:
    """The text with A-Z in lower case, but for capitals before a mark: marks are composed before letters are folded."""
    small = text.lower()
    if b"\xcc" in text or b"\xcd" in text:
        kept = bytearray(small)
        for found in _MARKED.finditer(text):
            kept[found.start()] = text[found.start()]
        return bytes(kept)
    return small


def by_words(path: str) -> bool:
    """Whether the file splits at blanks, folds case and encodes each piece on its own."""
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    rules = [rule.get("type") for rule in (parts.get("normalizer") or {}).get("normalizers", [])]
    splits = (parts.get("pre_tokenizer") or {}).get("pretokenizers", [])
    split = splits[0].get("pattern", {}).get("Regex", "") if splits else ""
    return (
        rules == ["NFC", "Replace", "Lowercase"]
        and [one.get("type") for one in splits] == ["Split", "ByteLevel"]
        and split == r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        and not splits[1].get("add_prefix_space")
        and not splits[1].get("use_regex")
        and parts["model"]["type"] == "BPE"
    )


def _byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in byte-level vocabularies: printable bytes as they are, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = (byte for byte in range(256) if byte not in plain)
    return {byte: chr(byte) for byte in plain} | {byte: chr(256 + i) for i, byte in enumerate(other)}


class _Grown:
    """An array that grows by doubling."""

    def __init__(self, kind):
        self.values, self.size = np.zeros(1 << 12, kind), 0

    def extend(self, more: np.ndarray) -> None:
        end = self.size + len(more)
        if end > len(self.values):
            values = np.zeros(max(end, 2 * len(self.values)), self.values.dtype)
            values[: self.size] = self.values[: self.size]
            self.values = values
        self.values[self.size : end] = more
        self.size = end


class _Memo(dict):
    """Byte strings to numbers, and the ids of each number.

    New strings wait in ``new`` until ``make`` is given all of them: it yields which of them, their ids one after the
    other, and how many each has. Strings that the older generation knows are copied from it. No memo refers to what
    makes its ids, so that all of it is freed as soon as it is dropped.
    """

    def __init__(self, older: "_Memo | None" = None):
        super().__init__()
        self.older = older
        self.new: list[bytes] = []
        self.ids, self.lengths, self.starts = _Grown(np.uint32), _Grown(np.int32), _Grown(np.int64)
        if older is not None:
            older.older = None

    def __missing__(self, key: bytes) -> int:
        number = self[key] = len(self)
        self.new.append(key)
        return number

    def numbers(self, keys: list[bytes], make) -> np.ndarray:
        found = np.fromiter(map(self.__getitem__, keys), np.int64, len(keys))
        new, self.new = self.new, []
        if new:
            self._add(new, make)
        return found

    def _add(self, new: list[bytes], make) -> None:
        starts, lengths = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)

        def put(at: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
            starts[at] = self.ids.size + np.cumsum(counts) - counts
            lengths[at] = counts
            self.ids.extend(ids)

        older = {} if self.older is None else self.older
        known = np.fromiter(map(older.get, new, repeat(-1)), np.int64, len(new))
        again, unknown = np.flatnonzero(known >= 0), np.flatnonzero(known < 0)
        if len(again):
            put(again, *older.gather(known[again]))
        if len(unknown):
            for at, ids, counts in make([new[i] for i in unknown.tolist()]):
                put(unknown[at], ids, counts)
        self.starts.extend(starts)
        self.lengths.extend(lengths)

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these numbers one after the other, and how many each has."""
        lengths = self.lengths.values[numbers].astype(np.int64)
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        places = np.arange(total) + np.repeat(self.starts.values[numbers] - (ends - lengths), lengths)
        return self.ids.values[places], lengths


class Encoder:
    """Encodes texts with the tokenizer of one file; made inside the task that uses it."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.split = by_words(path)
        tokens = self.tokenizer.get_added_tokens_decoder().values()
        self.special = tuple(token.content.lower().encode() for token in tokens)
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.bytes = {ord(letter): byte for byte, letter in self.letters.items()}
        self.words, self.pieces = _Memo(), _Memo()

    def _encode_pieces(self, pieces: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        tokenize, found, counts = self.model.tokenize, array("I"), []
        for piece in pieces:
            letters = piece.decode("latin-1")
            if not (piece.isascii() and letters.isprintable()):
                letters = letters.translate(self.letters)
            tokens = tokenize(letters) if piece != _END else []
            found.extend([token.id for token in tokens])
            counts.append(len(tokens))
        yield np.arange(len(pieces)), np.frombuffer(found, np.uint32), np.array(counts, np.int64)

    def _split(self, word: str) -> list[bytes]:
        """The pieces that the model gets for a word, by the tokenizer's own rules."""
        text = self.tokenizer.normalizer.normalize_str(word)
        pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(text)
        return [piece.translate(self.bytes).encode("latin-1") for piece, _ in pieces]

    def _encode_words(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        if len(self.pieces) > PIECES:
            self.pieces = _Memo(self.pieces)
        texts = b"\n".join(words).decode().split("\n")
        odd = [i for i, text in enumerate(texts) if not _PLAIN.fullmatch(text)]
        rest = [self._split(texts[i]) for i in odd]
        for i in odd:
            texts[i] = ""
        plain = _PIECES.findall("\n".join([*texts, ""]).lower().encode())
        for at, pieces in (
            (np.arange(len(texts)), plain),
            (np.array(odd, np.int64), [piece for some in rest for piece in (*some, _END)]),
        ):
            numbers = self.pieces.numbers(pieces, self._encode_pieces)
            ids, lengths = self.pieces.gather(numbers)
            ends = np.cumsum(lengths)[numbers == self.pieces[_END]]
            yield at, ids, np.diff(ends, prepend=0)

    def _group(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        if len(self.words) > WORDS:
            self.words = _Memo(self.words)
        # What is blank to Arrow is what _BLANK matches. Blanks at an end leave an empty word, which has no ids.
        words = pc.ascii_split_whitespace(pa.array([folded(text) for text in texts], pa.binary()).view(pa.string()))
        distinct = words.flatten().view(pa.binary()).dictionary_encode()
        numbers = self.words.numbers(distinct.dictionary.to_pylist(), self._encode_words)
        indices, ends = distinct.indices.to_numpy(), words.offsets.to_numpy()
        cuts = np.searchsorted(ends, np.arange(0, ends[-1], GATHERED))
        for first, last in pairwise(np.unique([0, *cuts.tolist(), len(texts)]).tolist()):
            at = ends[first : last + 1]
            ids, lengths = self.words.gather(numbers[indices[at[0] : at[-1]]])
            places = np.concatenate([[0], np.cumsum(lengths)])[at - at[0]]
            for start, end in pairwise(places.tolist()):
                yield ids[start:end]

    def _whole(self, text: bytes) -> bool:
        """Whether the text has to go through the tokenizer in one piece."""
        folded = text.lower()
        return not self.split or any(token in folded for token in self.special)

    def encode(self, text: bytes) -> Iterator[np.ndarray]:
        """The ids of one UTF-8 text of any length, as uint32 arrays one after the other."""
        if self._whole(text):
            yield np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, np.uint32)
            return
        for segment in segments(text):
            yield from self._group([segment])

    def encode_all(self, texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, bool]]:
        """(number of the text, ids, whether they end the text) in order; short texts are looked up together."""
        group: list[int] = []
        size = 0

        def flush():
            for i, ids in zip(group, self._group([texts[i] for i in group])):
                yield i, ids, True

        for i, text in enumerate(texts):
            alone = len(text) > SEGMENT or self._whole(text)
            if group and (alone or size + len(text) > GROUP):
                yield from flush()
                group, size = [], 0
            if alone:
                for ids in self.encode(text):
                    yield i, ids, False
                yield i, np.zeros(0, np.uint32), True
            else:
                group.append(i)
                size += len(text)
        if group:
            yield from flush()


def encoder(path: str) -> Encoder:
    """The encoder of this process: Python workers run many tasks and need not load the file for each."""
    kept = sys.modules.setdefault("_touchline_encoders", types.ModuleType("_touchline_encoders"))
    if path not in kept.__dict__:
        kept.__dict__[path] = Encoder(path)
    return kept.__dict__[path]


def forget() -> None:
    """Drop the encoders of this process, for tasks that need its memory for other things."""
    if sys.modules.pop("_touchline_encoders", None) is not None:
        pa.default_memory_pool().release_unused()
