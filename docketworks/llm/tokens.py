"""Token ids of whole texts by a public tokenizer file, one chunk of text at a time.

The tokenizer files of kind "word" drop white space before they look for words, so
no token spans a blank: the ids of a text are the ids of its chunks in order. Chunks
repeat far more often than texts, so each is encoded once and kept in a table of
bounded size. Only blank, tab, line feed and carriage return separate chunks; every other
kind of white space stays inside and is left to the tokenizer.

A chunk of plain Latin characters is cut into words as the file's pattern does, and each distinct word goes
through the library's merges once. Words repeat more often than chunks, which hold punctuation and
capitals, and need no normalising of their own. All other chunks are encoded by the library as a whole, and
so is everything if the file does not have the steps that this relies on.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import regex

KEPT_CHUNKS = 600_000
KEPT_CHARS = 16_000_000
KEPT_WORDS = 200_000

# Fixed values of the files of kind "word": the pattern that finds words, and the steps before it
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
STEPS = ["NFC", "Replace", "Lowercase"]
#: Characters that normalising changes to lower case only, alike in every version of Unicode.
PLAIN = regex.compile("[!-~\u00a1-\u012f\u0131-\u017f]*")
MARKS = frozenset(".,;:!?")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if it can be printed, else one from U+0100 on."""
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(0x100) if b not in printed]
    return {**{b: chr(b) for b in printed}, **{b: chr(0x100 + i) for i, b in enumerate(others)}}


class Words(dict):
    """Ids of lower-case words by the merges of the library's model, as bytes of ``kind``."""

    def __init__(self, model, kind: np.dtype):
        self._model, self._letters, self.kind = model, byte_letters(), kind

    def __missing__(self, word: str) -> bytes:
        spelled = word if word.isascii() else word.encode().decode("latin-1").translate(self._letters)
        ids = [token.id for token in self._model.tokenize(spelled)]
        found = self[word] = np.array(ids, self.kind).tobytes()
        return found


class Chunks(dict):
    """Numbers of chunks; ``new`` has those that were met for the first time."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, chunk: str) -> int:
        value = self[chunk] = len(self)
        self.new.append(chunk)
        return value


def finds_words(path: str) -> bool:
    """Whether the file looks for words as ``WORDS`` does, after ``STEPS``, and merges their bytes."""
    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    steps = (made.get("normalizer") or {}).get("normalizers") or []
    cuts = (made.get("pre_tokenizer") or {}).get("pretokenizers") or []
    return (
        [s.get("type") for s in steps] == STEPS and [c.get("type") for c in cuts] == ["Split", "ByteLevel"]
        and cuts[0].get("pattern") == {"Regex": WORDS} and cuts[0].get("invert") is True
        and not cuts[1].get("add_prefix_space") and not cuts[1].get("use_regex")
    )


def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions ``starts[i], starts[i] + 1, ...`` for each i, ``lengths[i]`` of them."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


class ChunkEncoder:
    """Ids of texts; forgets all chunks when the table is full."""

    def __init__(self, path: str):
        self._tokenizer = tokenizer(path)
        special = [(t.content, i) for i, t in self._tokenizer.get_added_tokens_decoder().items() if t.special]
        self._border, self._border_id = special[0] if special else (None, None)
        self._words = None
        if finds_words(path):
            small = self._tokenizer.get_vocab_size() <= 1 << 16
            self._words = Words(self._tokenizer.model, np.dtype(np.uint16 if small else np.uint32))
        self._special = regex.compile("|".join(regex.escape(content) for content, _ in special) or r"(?!)")
        self._find = regex.compile(WORDS).findall
        self._forget()

    def _forget(self) -> None:
        self._index = Chunks()
        self._chars = 0
        self._starts = np.zeros(1024, np.int64)
        self._lengths = np.zeros(1024, np.int64)
        self._flat = np.zeros(4096, np.uint32)
        self._used = 0

    def _by_words(self, chunk: str) -> bytes | None:
        """Ids of a plain chunk; None for all others."""
        words = self._words
        if chunk.isalpha():
            return words[chunk.lower()] if chunk.isascii() or PLAIN.fullmatch(chunk) else None
        head, mark = chunk[:-1], chunk[-1:]
        if mark in MARKS and head.isalpha() and (head.isascii() or PLAIN.fullmatch(head)):
            return words[head.lower()] + words[mark]
        if PLAIN.fullmatch(chunk) and not self._special.search(chunk):
            return b"".join([words[w] for w in self._find(chunk.lower())])
        return None

    def _encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each chunk has, and the ids of all."""
        if self._words is None:
            return self._encode_whole(chunks)
        if len(self._words) > KEPT_WORDS:
            self._words.clear()
        parts = list(map(self._by_words, chunks))
        others = [i for i, part in enumerate(parts) if part is None]
        kind = self._words.kind
        if others:
            lengths, ids = self._encode_whole([chunks[i] for i in others])
            for i, found in zip(others, np.split(ids, np.cumsum(lengths)[:-1])):
                parts[i] = found.astype(kind).tobytes()
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // kind.itemsize
        return sizes, np.frombuffer(b"".join(parts), kind).astype(np.uint32)

    def _encode_whole(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same by the library alone.

        The library splits a text at special tokens before anything else, so many chunks with
        one between them are encoded in one call as if each were alone.
        """
        encode = self._tokenizer.encode_batch_fast
        if self._border is None or any(self._border in c for c in chunks):
            found = [e.ids for e in encode(chunks, add_special_tokens=False)]
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            return lengths, np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum()))
        ids = np.array(encode([self._border.join(chunks)], add_special_tokens=False)[0].ids, np.uint32)
        borders = np.flatnonzero(ids == self._border_id)
        lengths = np.diff(borders, prepend=-1, append=len(ids)) - 1
        return lengths, np.delete(ids, borders)

    def _learn(self, chunks: list[str]) -> None:
        """Ids of the chunks numbered last."""
        begin = len(self._index) - len(chunks)
        for at in range(0, len(chunks), 4096):
            some = chunks[at:at + 4096]
            lengths, more = self._encode(some)
            first, used = begin + at, self._used
            while first + len(some) > len(self._starts):
                self._starts = np.concatenate([self._starts, np.zeros_like(self._starts)])
                self._lengths = np.concatenate([self._lengths, np.zeros_like(self._lengths)])
            while used + len(more) > len(self._flat):
                self._flat = np.concatenate([self._flat, np.zeros_like(self._flat)])
            self._starts[first:first + len(some)] = used + np.cumsum(lengths) - lengths
            self._lengths[first:first + len(some)] = lengths
            self._flat[used:used + len(more)] = more
            self._used = used + len(more)
            self._chars += sum(map(len, some))

    def encode(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """One array of ids per text; a missing text has none."""
        if len(self._index) > KEPT_CHUNKS or self._chars > KEPT_CHARS:
            self._forget()
        chunks: list[str] = []
        counts = []
        for text in texts:
            mine = (text or "").replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
            counts.append(len(mine))
            chunks += mine
        which = np.fromiter(map(self._index.__getitem__, chunks), np.int64, len(chunks))
        if self._index.new:
            self._learn(self._index.new)
            self._index.new = []
        lengths = self._lengths[which]
        ids = self._flat[gather(self._starts[which], lengths)]
        ends = np.cumsum(lengths)[np.cumsum(counts) - 1] if counts else []
        return np.split(ids, ends[:-1]) if len(counts) else []


@lru_cache(maxsize=2)
def chunk_encoder(path: str) -> ChunkEncoder:
    """The encoder of this process, kept from task to task."""
    return ChunkEncoder(path)
