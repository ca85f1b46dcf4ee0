"""Words and word n-grams of many texts at once, as 64-bit hashes in NumPy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
#: Bases of two independent rolling hashes.
BASES = (_BASE, _U(0xD6E8FEB86659FD93))
_MIX1, _MIX2 = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB)
#: White space of the word pattern ``[^\x20\x09-\x0D]+``.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: Lower case of A-Z, byte by byte.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix64's finaliser)."""
    x = (x ^ (x >> _U(30))) * _MIX1
    x = (x ^ (x >> _U(27))) * _MIX2
    return x ^ (x >> _U(31))


def salt(n: int) -> np.uint64:
    """A number of its own for every ``n``, to tell uses of one hash apart."""
    return _U(n * int(_BASE) % (1 << 64))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a string column and where each begins; NULL is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]] if len(at) else raw[:0], at - (at[0] if len(at) else 0)


def slices(batch: pa.RecordBatch, column: int, size: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``size`` bytes in a string column, at least one row each."""
    if not batch.num_rows:
        return
    _, at = utf8(batch.column(column))
    begin = 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(at, at[begin] + size, "right")) - 1)
        yield batch.slice(begin, end - begin)
        begin = end


def _powers(n: int, base: np.uint64 = _BASE) -> tuple[np.ndarray, np.ndarray]:
    inverse = _U(pow(int(base), -1, 1 << 64))
    up, down = np.full(n, base), np.full(n, inverse)
    if n:
        up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def word_spans(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word, and the text each belongs to."""
    inside = ~SPACES[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = at[:-1][at[:-1] < len(raw)]
    first[starts] = inside[starts]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = at[1:][at[1:] > 0] - 1
    last[ends] = inside[ends]
    begin, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return begin, end, np.searchsorted(at, begin, "right") - 1


def rolling(raw: np.ndarray, base: np.uint64 = _BASE):
    """A function that hashes pieces of ``raw``, given where they begin and their length."""
    up, down = _powers(len(raw) + 1, base)
    sums = np.zeros(len(raw) + 1, _U)
    np.cumsum((raw.astype(_U) + _U(1)) * up[:-1], out=sums[1:])

    def hashes(begin: np.ndarray, length) -> np.ndarray:
        return mix((sums[begin + length] - sums[begin]) * down[begin])

    return hashes


def word_hashes(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word, equal for equal words wherever they stand."""
    up, down = _powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, _U)
    np.cumsum((raw.astype(_U) + _U(1)) * up[:-1], out=sums[1:])
    return mix((sums[end] - sums[begin]) * down[begin] + mix((end - begin).astype(_U)))


def gram_hashes(words: np.ndarray, owner: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and owner of every run of ``width`` words within one text."""
    n = len(words) - width + 1
    if n <= 0:
        return words[:0], owner[:0]
    total = np.zeros(n, _U)
    for k in range(width):
        total += mix(words[k : n + k] + salt(k + 1))
    keep = owner[:n] == owner[width - 1 :]
    return mix(total[keep] + _U(width)), owner[:n][keep]


def shingle_sets(column: pa.Array, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word shingles of every text: sorted hashes text by text, and where each begins.

    A-Z count as a-z.  A text with fewer words than ``width`` has its whole word
    sequence as the one shingle; a text without words has none.
    """
    raw, at = utf8(column)
    raw = LOWER[raw]
    begin, end, owner = word_spans(raw, at)
    words = word_hashes(raw, begin, end)
    found, whose = gram_hashes(words, owner, width)
    n_words = np.bincount(owner, minlength=len(column))
    short = np.flatnonzero((n_words > 0) & (n_words < width))
    if len(short):
        firsts = np.searchsorted(owner, short)
        extra = np.empty(len(short), _U)
        for k, (i, n) in enumerate(zip(firsts, n_words[short], strict=True)):
            extra[k] = gram_hashes(words[i : i + n], owner[i : i + n], int(n))[0][0]
        found, whose = np.concatenate([found, extra]), np.concatenate([whose, short])
    order = np.lexsort((found, whose))
    found, whose = found[order], whose[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (whose[1:] != whose[:-1])
    found, whose = found[new], whose[new]
    return found, np.searchsorted(whose, np.arange(len(column) + 1))
