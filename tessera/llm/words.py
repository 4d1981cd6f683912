"""Words of whole texts as numpy arrays, in the workers.

Texts are cut and hashed many at a time, by array operations over their bytes: a word's hash is a
polynomial of its letters, taken from running sums, and then mixed.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash

try:
    _trim = ctypes.CDLL(None).malloc_trim
except AttributeError:  # another C library
    _trim = None

#: Bytes of texts that are cut at once; a text that is longer is cut by itself, its words hashed in such pieces.
CHUNK = 1 << 18
#: Words of more bytes are hashed by xxh3, as sums over long words of two letters might be made to meet.
LONG = 256


def scramble(x: np.ndarray) -> np.ndarray:
    """A fixed one-to-one mixing of 64-bit values (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: An odd factor for sums over letters or words, and its inverse modulo 2**64.
_STEP = np.uint64(0x9E3779B97F4A7C17)
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))


def _powers(factor: np.uint64) -> np.ndarray:
    out = np.full(CHUNK + 1, factor, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_AHEAD, _BEHIND = _powers(_STEP), _powers(_BACK)


class Alphabet:
    """Which bytes stand in words (the others part them), and the byte that each counts as."""

    def __init__(self, fold: Callable[[int], int | None]):
        folded = [fold(c) for c in range(256)]
        self.inside = np.array([f is not None for f in folded])
        self.values = scramble(np.array([0x51ED270B + (f or 0) for f in folded], np.uint64))
        self.table = bytes(0x20 if f is None else f for f in folded)


def _lower(c: int) -> int:
    return c + 32 if 0x41 <= c <= 0x5A else c


def _spaces(c: int) -> bool:
    return c == 0x20 or 0x09 <= c <= 0x0D


#: Words `[^\x20\x09-\x0D]+`, as they are and with A-Z lower-cased.
SPACED = Alphabet(lambda c: None if _spaces(c) else c)
LOWERED = Alphabet(lambda c: None if _spaces(c) else _lower(c))
#: Words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after A-Z were lower-cased; bytes from 0x80 up are letters.
LETTERED = Alphabet(lambda c: _lower(c) if c >= 0x80 or chr(c).isalnum() else None)


def spaced_words(raw: bytes | None) -> list[bytes]:
    r"""Words `[^\x20\x09-\x0D]+` of UTF-8 bytes: bytes.split() parts at just these six."""
    return raw.split() if raw else []


def lettered_words(raw: bytes | None) -> list[bytes]:
    r"""A-Z lower-cased, words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of UTF-8 bytes."""
    return raw.translate(LETTERED.table).split() if raw else []


class Cut:
    """Words of the texts of some rows that follow each other.

    first, rows: which rows of the batch; edges: where each row's words begin, and the last ones end;
    hashes, starts, ends: of each word, its places being bytes of data.
    """

    def __init__(self, first: int, data: np.ndarray, at: np.ndarray, alphabet: Alphabet):
        self.first, self.rows, self.data, self.alphabet = first, len(at) - 1, data, alphabet
        inside = alphabet.inside[data]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        # a text's first letter begins a word and its last one ends one, whatever the neighbours hold
        cuts = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(data))]
        begins[cuts] = inside[cuts]
        ends[cuts - 1] = inside[cuts - 1]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.edges = np.searchsorted(self.starts, at)
        self.hashes = self._hash()

    def _hash(self) -> np.ndarray:
        starts, ends = self.starts, self.ends
        out, at = np.empty(len(starts), np.uint64), 0
        while at < len(starts):
            base = int(starts[at])
            upto = max(at + 1, int(np.searchsorted(ends, base + CHUNK, "right")))
            if ends[upto - 1] - base <= CHUNK:
                sums = np.zeros(int(ends[upto - 1]) - base + 1, np.uint64)
                np.cumsum(self.alphabet.values[self.data[base : ends[upto - 1]]] * _AHEAD[: len(sums) - 1], out=sums[1:])
                own = starts[at:upto] - base
                out[at:upto] = (sums[ends[at:upto] - base] - sums[own]) * _BEHIND[own]
            at = upto
        out = scramble(out)
        for i in np.flatnonzero(ends - starts > LONG).tolist():
            out[i] = xxhash.xxh3_64_intdigest(self.data[starts[i] : ends[i]].tobytes().translate(self.alphabet.table))
        return out

    def counts(self) -> np.ndarray:
        return np.diff(self.edges)

    def joined(self) -> tuple[bytes, np.ndarray]:
        """The words of each row with one blank between them, row after row, and where each row's begin and end."""
        size = self.ends - self.starts + 1
        last = self.edges[1:][self.counts() > 0] - 1
        keep = self.alphabet.inside[self.data]
        after = self.ends.copy()
        behind = np.delete(after, last)  # the place behind each word that is not its row's last
        # that place lies in the row, as another word follows there
        keep[behind] = True
        text = self.data[keep]
        size[last] -= 1
        upto = np.concatenate([[0], np.cumsum(size)])
        text[upto[1:][np.delete(np.arange(len(size)), last)] - 1] = 0x20
        return text.tobytes(), upto[self.edges]


def cut_rows(column: pa.Array, alphabet: Alphabet, most: int = CHUNK) -> Iterator[Cut]:
    """The rows of a binary column, in cuts of about `most` bytes; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, offsets, raw = column.buffers()
    at = np.frombuffer(offsets, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if column.null_count and (np.diff(at)[column.is_null().to_numpy(zero_copy_only=False)] > 0).any():
        yield from cut_rows(column.fill_null(b""), alphabet, most)
        return
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.empty(0, np.uint8)
    row = 0
    while row < len(column):
        upto = min(len(column), max(row + 1, int(np.searchsorted(at, at[row] + most, "right")) - 1))
        yield Cut(row, data[at[row] : at[upto]], at[row : upto + 1] - at[row], alphabet)
        row = upto
    give_back()


def give_back() -> None:
    """Return freed memory to the system: workers live on, and hold it while other stages run."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def spread(begin: np.ndarray, many: np.ndarray) -> np.ndarray:
    """begin, begin + 1 and so on, `many` of them, for each entry."""
    return np.arange(int(many.sum())) + np.repeat(begin - (many.cumsum() - many), many)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """The hash of each `width` consecutive words; empty if there are fewer words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out += hashes[i : i + n]
        out *= _STEP
    return scramble(out)


def whole(hashes: np.ndarray) -> np.ndarray:
    """The hash of all words as one window, with its length."""
    out = np.uint64(len(hashes) + 1)
    with np.errstate(over="ignore"):
        for h in hashes:
            out = (out + h) * _STEP
    return scramble(np.array([out], np.uint64))


def fold_sums(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The sum, modulo 2**64, of each row's values."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    return sums[edges[1:]] - sums[edges[:-1]]
