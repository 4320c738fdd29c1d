"""Exact token counts of every prefix of a text, by dynamic programming over byte-level BPE.

For each prefix of a piece there is one token t that ends its encoding: the token that is a
suffix of the prefix and stands beside the last token of what is left without BPE wanting
to merge across their border. So ``count[i] = count[i - len(t)] + 1``, with one pass over the
bytes, and nothing is encoded twice.

The pre-tokenizer cuts a text into pieces; the cut depends on at most the white space before
a word, so a text is handled in *units* (a word with the white space before it) whose tables do
not depend on anything around them. Units repeat, so each table is made once per process, all
new units of a batch at a time as numpy columns, and kept in a store of bounded size.

A text's table is one signed byte per character: how the count changes with that character.
It is as long as the text, and answers how many tokens a prefix has and where to truncate for
a budget without the tokenizer.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketworks.llm.tables import through
from docketworks.llm.tokens import gather

# Fixed values of the pre-tokenizer
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
PIECE = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
UNIT = rf"(?:\s+(?!\S))?+(?:{PIECE}|\s+)|\s+"

KEPT_UNITS = 400_000
KEPT_CHARS = 16_000_000
BLOCK_BYTES = 200_000


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class Lookup:
    """Integers to integers, many at a time: open addressing in arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(len(keys) * 6).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        left = np.arange(len(keys))
        slots = self._slot(keys)
        while len(left):
            free = self.keys[slots[left]] < 0
            taken, first = np.unique(slots[left][free], return_index=True)
            chosen = left[free][first]
            self.keys[taken], self.values[taken] = keys[chosen], values[chosen]
            left = np.setdiff1d(left, chosen, assume_unique=True)
            slots[left] = (slots[left] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values, -1 for unknown keys."""
        slots = self._slot(keys)
        there = self.keys[slots]
        found = np.where(there == keys, self.values[slots], -1)
        left = np.flatnonzero((there != keys) & (there >= 0))
        while len(left):
            slots[left] = (slots[left] + 1) & (len(self.keys) - 1)
            there = self.keys[slots[left]]
            same = there == keys[left]
            found[left[same]] = self.values[slots[left[same]]]
            left = left[~same & (there >= 0)]
        return found


class Merges:
    """Tokens numbered in the order in which BPE merges them: single bytes 0-255, then by rank."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        of_char = {c: b for b, c in enumerate(byte_alphabet())}
        number = {bytes([b]): b for b in range(256)}
        lefts, rights = list(range(256)), list(range(256))
        for pair in model["model"]["merges"]:
            a, b = (bytes(of_char[c] for c in part)
                    for part in (pair.split(" ") if isinstance(pair, str) else pair))
            number.setdefault(a + b, len(lefts))
            lefts.append(number[a])
            rights.append(number[b])
        self.left, self.right = np.array(lefts, np.int64), np.array(rights, np.int64)
        merged = np.arange(256, len(lefts))
        self.pairs = Lookup(self.left[256:] << 20 | self.right[256:], merged.astype(np.int32))
        self.specials = [t["content"] for t in model["added_tokens"]]
        # a trie over all tokens: (node, byte) to node
        nodes: dict[tuple[int, int], int] = {}
        ends = [-1]
        for token, n in number.items():
            at = 0
            for byte in token:
                to = nodes.get((at, byte))
                if to is None:
                    to = nodes[at, byte] = len(ends)
                    ends.append(-1)
                at = to
            ends[at] = n
        keys = np.array([at << 8 | byte for at, byte in nodes], np.int64)
        self.trie = Lookup(keys, np.fromiter(nodes.values(), np.int32, len(nodes)))
        self.ends = np.array(ends, np.int64)
        self._seen = np.full(1 << 20, -1, np.int64)
        self._stands = np.zeros(1 << 20, bool)

    def stand(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether tokens a, b side by side are what BPE makes of their bytes."""
        keys = a << 20 | b
        slots = ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)
        unknown = np.flatnonzero(self._seen[slots] != keys)
        result = self._stands[slots]
        if len(unknown):
            some, back = np.unique(keys[unknown], return_inverse=True)
            found = self._undo(some >> 20, some & ((1 << 20) - 1))
            result[unknown] = found[back]
            self._seen[slots[unknown]], self._stands[slots[unknown]] = keys[unknown], found[back]
        return result

    def _undo(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Undo the merges beside the border, latest first.

        If a pair across the border could have been merged before the merge just undone, BPE
        would have done that instead. On a tie the left place is merged first.
        """
        result = np.ones(len(a), bool)
        limit = np.full(len(a), np.iinfo(np.int64).max)
        todo = np.arange(len(a))
        a, b = a.copy(), b.copy()
        while len(todo):
            across = self.pairs.get(a[todo] << 20 | b[todo])
            broken = (across >= 0) & (across < limit[todo])
            result[todo[broken]] = False
            todo = todo[~broken & ((a[todo] > 255) | (b[todo] > 255))]
            left = a[todo] > b[todo]
            x, y = todo[left], todo[~left]
            limit[x], a[x] = a[x], self.right[a[x]]
            limit[y], b[y] = b[y] + 1, self.left[b[y]]
        return result

    def prefixes(self, block: np.ndarray) -> np.ndarray:
        """Counts of all prefixes of pieces of equal length, given as rows of bytes."""
        rows, size = block.shape
        last = np.zeros((rows, size + 1), np.int64)
        count = np.zeros((rows, size + 1), np.int32)
        each, root = np.arange(rows), np.zeros(rows, np.int64)
        row, start, node = each[:0], each[:0], root[:0]
        for i in range(1, size + 1):
            # the strings that end here and begin some token
            row, node = np.concatenate([row, each]), np.concatenate([node, root])
            start = np.concatenate([start, np.full(rows, i - 1)])
            node = self.trie.get(node << 8 | block[row, i - 1]).astype(np.int64)
            alive = node >= 0
            row, start, node = row[alive], start[alive], node[alive]
            token = self.ends[node]
            whole = np.flatnonzero(token >= 0)
            r, s, t = row[whole], start[whole], token[whole]
            fits = s == 0
            inner = np.flatnonzero(~fits)
            fits[inner] = self.stand(last[r[inner], s[inner]], t[inner])
            r, s, t = r[fits], s[fits], t[fits]
            last[r, i] = t
            count[r, i] = count[r, s] + 1
        return count[:, 1:]


class PrefixTables:
    """Tables of texts, from tables of their units."""

    def __init__(self, path: str):
        import regex

        self.merges = Merges(path)
        self._units = regex.compile(UNIT).findall
        self._blank = regex.compile(r"\s+").match
        self._special = regex.compile("(" + "|".join(map(regex.escape, self.merges.specials)) + ")") \
            if self.merges.specials else None
        self._forget()

    def _forget(self) -> None:
        self._index: dict[str, int] = {}
        self._chars = 0
        self._starts = self._lengths = self._carry = np.zeros(0, np.int64)
        self._flat = np.zeros(0, np.int8)

    # -- tables of units ----------------------------------------------------------

    def _counts(self, piece: str) -> list[int]:
        """Counts of the prefixes of one piece, by characters."""
        data = np.frombuffer(piece.encode(), np.uint8)
        found = self.merges.prefixes(data[None, :])[0]
        ends = np.append((data[1:] & 0xC0) != 0x80, True)
        return found[ends].tolist()

    def _odd(self, unit: str) -> tuple[np.ndarray, int]:
        """Changes and carry of a unit that is cut in several ways, depending on its end."""
        if unit in CONTRACTIONS:  # cut short, the apostrophe is a piece of its own
            counts = [1] + [1 + self._counts(unit[1:k])[-1] for k in range(2, len(unit))]
            counts.append(self._counts(unit)[-1])
            return np.diff(counts, prepend=0), 0
        first = self._blank(unit).end()
        counts = self._counts(unit[:first])
        if first == len(unit):
            # before a word the last white space is a piece of its own
            return np.diff(counts, prepend=0), counts[-2] + self._counts(unit[-1])[-1] - counts[-1]
        before = counts[first - 2]
        counts += [before + c for c in self._counts(unit[first - 1:])[1:]]
        return np.diff(counts, prepend=0), 0

    def _learn(self, units: list[str]) -> None:
        odd, plain = [], defaultdict(list)
        for unit in units:
            if unit in CONTRACTIONS or len(unit) > 1 and self._blank(unit[:2] or "", 1) and self._blank(unit):
                odd.append(unit)
            else:
                plain[len(data := unit.encode())].append((unit, data))
        names, changes, lengths, carry = [], [], [], []
        for size, same in plain.items():
            step = max(1, BLOCK_BYTES // size)
            for at in range(0, len(same), step):
                some = same[at:at + step]
                block = np.frombuffer(b"".join(d for _, d in some), np.uint8).reshape(len(some), size)
                counts = self.merges.prefixes(block)
                ends = np.ones(block.shape, bool)
                ends[:, :-1] = (block[:, 1:] & 0xC0) != 0x80
                chars = ends.sum(1)
                flat = counts[ends]
                change = np.diff(flat, prepend=0)
                first = np.cumsum(chars) - chars
                change[first] = flat[first]
                names += [u for u, _ in some]
                changes.append(change.astype(np.int8))
                lengths.append(chars)
                carry.append(np.zeros(len(some), np.int64))
        for unit in odd:
            change, more = self._odd(unit)
            names.append(unit)
            changes.append(change.astype(np.int8))
            lengths.append(np.array([len(change)]))
            carry.append(np.array([more]))
        new = np.concatenate(lengths)
        starts = len(self._flat) + np.cumsum(new) - new
        self._index.update(zip(names, range(len(self._index), len(self._index) + len(names))))
        self._flat = np.concatenate([self._flat, *changes])
        self._starts = np.concatenate([self._starts, starts])
        self._lengths = np.concatenate([self._lengths, new])
        self._carry = np.concatenate([self._carry, *carry])
        self._chars += int(new.sum())

    # -- tables of texts ----------------------------------------------------------

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        """Tables of texts in which special tokens do not count."""
        found = [self._units(t) for t in texts]
        missing = [u for u in dict.fromkeys(u for units in found for u in units) if u not in self._index]
        if missing:
            self._learn(missing)
        result = []
        for units in found:
            which = np.fromiter(map(self._index.__getitem__, units), np.int64, len(units))
            lengths = self._lengths[which]
            table = self._flat[gather(self._starts[which], lengths)]
            carry = self._carry[which[:-1]]
            if carry.any():
                table[np.cumsum(lengths)[:-1]] += carry.astype(np.int8)
            result.append(table)
        return result

    def tables(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """Per text, the change of the count with each character."""
        if len(self._index) > KEPT_UNITS or self._chars > KEPT_CHARS:
            self._forget()
        parts = [self._special.split(t or "") if self._special else [t or ""] for t in texts]
        # a cut inside a special token leaves plain text: its letters but the last count as such
        plain = iter(self._plain([
            p[i] + (p[i + 1][:-1] if i + 1 < len(p) else "") for p in parts for i in range(0, len(p), 2)
        ]))
        result = []
        for p in parts:
            pieces = []
            for i in range(0, len(p), 2):
                pieces.append(next(plain))
                if i + 1 < len(p):
                    before = int(pieces[-1][:len(p[i])].sum(dtype=np.int64))
                    after = int(pieces[-1].sum(dtype=np.int64))
                    pieces.append(np.array([before + 1 - after], np.int8))
            result.append(pieces[0] if len(pieces) == 1 else np.concatenate(pieces))
        return result


@lru_cache(maxsize=1)
def prefix_tables(path: str) -> PrefixTables:
    return PrefixTables(path)


def tokens_at(table: bytes, chars: int) -> int:
    """Tokens of the first ``chars`` characters."""
    return int(np.frombuffer(table, np.int8, min(chars, len(table))).sum(dtype=np.int64))


def longest_prefix(table: np.ndarray | bytes, budget: int) -> int:
    """Characters of the longest prefix with at most ``budget`` tokens."""
    changes = np.frombuffer(table, np.int8) if isinstance(table, bytes) else table
    fits = np.flatnonzero(np.cumsum(changes, dtype=np.int64) <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def count_prefixes(docs: DataFrame, tokenizer_path: str, limit: int, keep_tables: bool = False) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens``, ``fitting_chars`` (longest prefix within ``limit``).

    ``keep_tables`` adds ``prefix_table``, a byte per character (see above). Special tokens in a
    text count as the tokenizer library counts them. A null or empty text has no tokens.
    Rows are handled one by one, so null and repeated ids pass through; an empty table
    gives an empty result.
    """
    schema = "doc_id long, n_bytes long, n_tokens long, fitting_chars long" + ", prefix_table binary" * keep_tables

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = prefix_tables(tokenizer_path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            tables = counter.tables(texts)
            columns = [
                batch.column(0),
                pa.array([len((t or "").encode()) for t in texts], pa.int64()),
                pa.array([int(t.sum(dtype=np.int64)) for t in tables], pa.int64()),
                pa.array([longest_prefix(t, limit) for t in tables], pa.int64()),
            ]
            names = ["doc_id", "n_bytes", "n_tokens", "fitting_chars"]
            if keep_tables:
                columns.append(pa.array([t.tobytes() for t in tables], pa.binary()))
                names.append("prefix_table")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return through(docs.select(F.col("doc_id").cast("long"), "text"), schema, work)
