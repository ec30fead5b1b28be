"""A gap-weighted subsequence kernel between short strings, for many strings and a few landmarks at once."""

from __future__ import annotations

from itertools import combinations

import numpy as np

LENGTH, DECAY, POWER = 3, 0.7, 2
# Subsequences that are looked up at once.
CELLS = 1 << 21


def _codes(strings: list[str]) -> np.ndarray:
    """Code points, one row a string, 0 after its end."""
    width = max(map(len, strings), default=0)
    joined = "".join(s.ljust(width, "\0") for s in strings)
    return np.frombuffer(joined.encode("utf-32-le"), np.uint32).reshape(len(strings), width)


def _places(size: int, length: int, decay: float) -> tuple[np.ndarray, np.ndarray]:
    """All ways to pick ``length`` places of a string, and decay to the power of the places they span."""
    picked = np.array(list(combinations(range(size), length)), np.int64).reshape(-1, length)
    return picked, (decay ** (picked[:, -1] - picked[:, 0] + 1)).astype(np.float32) if len(picked) else np.zeros(0, np.float32)


def _by_length(strings: list[str]):
    """(rows, codes) of the strings of each length."""
    sizes = np.array([len(s) for s in strings], np.int64)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        yield size, rows, _codes([strings[i] for i in rows])


def raw_kernel(left: list[str], right: list[str], length: int = LENGTH, decay: float = DECAY) -> np.ndarray:
    """Sum over common subsequences of ``length`` characters of decay to the power of the places they span in both.

    The subsequences of the right strings are listed with their weights; those of the left ones are looked up.
    """
    letters = np.unique(_codes(right))
    letters = letters[letters != 0]
    base = len(letters) + 1
    scale = base ** np.arange(length - 1, -1, -1)

    def numbered(codes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(letters, codes), max(len(letters) - 1, 0))
        return np.where(letters[at] == codes, at + 1, 0) if len(letters) else np.zeros(codes.shape, np.int64)

    number, column, weight = [], [], []
    for size, rows, codes in _by_length(right):
        picked, decays = _places(size, length, decay)
        number.append((numbered(codes)[:, picked] @ scale).ravel())
        column.append(np.repeat(rows, len(picked)))
        weight.append(np.tile(decays, len(rows)))
    known, row = np.unique(np.concatenate(number), return_inverse=True) if number else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    table = np.zeros((len(known), len(right)), np.float32)
    if len(known):
        np.add.at(table, (row, np.concatenate(column)), np.concatenate(weight))
    where = np.full(base**length, -1, np.int32)
    where[known] = np.arange(len(known))
    out = np.zeros((len(left), len(right)), np.float32)
    for size, rows, codes in _by_length(left):
        picked, decays = _places(size, length, decay)
        codes = numbered(codes)
        step = max(1, CELLS // max(1, len(picked)))
        for at in range(0, len(rows) if len(picked) else 0, step):
            found = where[codes[at : at + step][:, picked] @ scale]
            string, place = np.nonzero(found >= 0)
            if len(string):
                parts = table[found[string, place]] * decays[place][:, None]
                heads = np.flatnonzero(np.concatenate([[True], string[1:] != string[:-1]]))
                out[rows[at + string[heads]]] = np.add.reduceat(parts, heads, axis=0)
    return out


def self_kernel(strings: list[str], length: int = LENGTH, decay: float = DECAY) -> np.ndarray:
    """The raw kernel of each string with itself."""
    out = np.zeros(len(strings), np.float32)
    for size, rows, codes in _by_length(strings):
        if size < length:
            continue
        inner = [np.ones((size + 1, len(rows)), np.float32), *(np.zeros((size + 1, len(rows)), np.float32) for _ in range(length - 1))]
        total = np.zeros(len(rows), np.float32)
        for i in range(size):
            same = (codes == codes[:, i : i + 1]).T
            for j in range(size):
                total += decay**2 * same[j] * inner[length - 1][j]
            for q in range(length - 1, 0, -1):
                run = np.zeros(len(rows), np.float32)
                for j in range(size):
                    run = decay * run + decay**2 * same[j] * inner[q - 1][j]
                    inner[q][j + 1] = decay * inner[q][j + 1] + run
        out[rows] = total
    return out


def kernel(left: list[str], right: list[str]) -> np.ndarray:
    """The normalised kernel, sharpened by a power; 0 for strings too short to have a subsequence."""
    scale = np.sqrt(self_kernel(left)[:, None] * self_kernel(right)[None, :])
    return (raw_kernel(left, right) / np.where(scale > 0, scale, 1)) ** POWER
