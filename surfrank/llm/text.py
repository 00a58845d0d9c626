"""Words and word hashes of Arrow string columns, shared by the operators here.

A word is a maximal run of bytes other than space and ``\\x09``-``\\x0D`` in the
UTF-8 text (the contract's ``[^\\x20\\x09-\\x0D]+``).  Hashes are polynomial over
the bytes of a word, modulo 2**64, with a pseudorandom value for each byte, and
then mixed; they are computed for a whole slice of texts at once and never one
word at a time.  Slices are cut at white space, so the working memory does not
depend on the length of a text beyond its words' hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes hashed in one go; bounds the working arrays, and the kept powers, to a few MB in each Python worker.
SLICE_BYTES = 1 << 17

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix64's finaliser)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD1342543DE82EF95))
_LOWER_BYTE = _BYTE.copy()
_LOWER_BYTE[0x41:0x5B] = _BYTE[0x61:0x7B]
_POWERS: dict[int, np.ndarray] = {}


def powers(n: int, base: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept and grown by doubling."""
    have = _POWERS.get(base)
    if have is None:
        have = np.ones(1, dtype=np.uint64)
    while len(have) < n:
        have = np.concatenate([have, have * _U(pow(base, len(have), 1 << 64))])
    _POWERS[base] = have
    return have[:n]


def run_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Polynomial hash sum(values[i] * base**(i - start)) of each range [start, end)."""
    n = len(values)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values * powers(n, base), out=sums[1:])
    return (sums[ends] - sums[starts]) * powers(n + 1, pow(base, -1, 1 << 64))[starts]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column, without a copy; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    if len(column) == 0 or offs is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    offsets = np.frombuffer(offs, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def _slices(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about SLICE_BYTES that end at a text's end or at white space."""
    at, n = 0, len(data)
    while at < n:
        end = min(n, at + SLICE_BYTES)
        if end < n:
            k = int(np.searchsorted(offsets, end, side="right")) - 1
            if offsets[k] > at:
                end = int(offsets[k])
            else:  # one long text: cut it at white space
                stop = int(offsets[k + 1])
                while end < stop and not _IS_SPACE[data[end]]:
                    end += 1
        yield at, end
        at = end


def words_of(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the column in order, and the words of each text.

    The second array has len(column) + 1 offsets into the first.  ``lower``
    folds A-Z before hashing.
    """
    data, offsets = text_buffers(column)
    table = _LOWER_BYTE if lower else _BYTE
    hashes, counts = [np.zeros(0, dtype=np.uint64)], np.zeros(len(offsets) - 1, dtype=np.int64)
    for at, end in _slices(data, offsets):
        part = data[at:end]
        word = ~_IS_SPACE[part]
        inner = offsets[(offsets > at) & (offsets < end)] - at
        before = np.empty_like(word)
        before[0], before[1:] = False, word[:-1]
        before[inner] = False
        after = np.empty_like(word)
        after[-1], after[:-1] = False, word[1:]
        after[inner - 1] = False
        starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
        if len(starts) == 0:
            continue
        sums = run_sums(table[part], starts, ends)
        hashes.append(mix(sums + (ends - starts).astype(np.uint64)))
        text = np.searchsorted(offsets, starts + at, side="right") - 1
        counts += np.bincount(text, minlength=len(counts))
    out = np.zeros(len(counts) + 1, dtype=np.int64)
    np.cumsum(counts, out=out[1:])
    return np.concatenate(hashes), out


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` words; of fewer words, the whole run as one; of none, none."""
    if len(words) == 0:
        return words
    size = min(size, len(words))
    out = np.zeros(len(words) - size + 1, dtype=np.uint64)
    for k in range(size):
        out = out * _U(_BASE) + words[k : len(words) - size + 1 + k]
    return mix(out + _U(size))
