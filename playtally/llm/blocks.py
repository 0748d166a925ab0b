"""Texts of a task as flat byte arrays, so that numpy handles words and windows of many texts at once.

Every helper works on a block of texts of bounded size. A single text longer than the bound forms a
block of its own; nothing is cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLOCK_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BYTE_CODES = np.random.default_rng(20240601).integers(1, 2**63, 256, dtype=np.uint64)


def text_blocks(texts: list, limit: int = BLOCK_BYTES, gap: int = 1) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """(first row, row after the last, bytes, n + 1 offsets) of runs of texts; a null is empty.

    `gap` newlines follow each text, so words of neighbours never join; offsets count them to the text before.
    """
    first, size, parts = 0, 0, []
    for row, text in enumerate(texts):
        part = (text.encode("utf-8", "surrogatepass") if isinstance(text, str) else bytes(text or b"")) + b"\n" * gap
        if parts and size + len(part) > limit:
            yield first, row, b"".join(parts), np.cumsum([0, *map(len, parts)])
            first, size, parts = row, 0, []
        parts.append(part)
        size += len(part)
    if parts:
        yield first, first + len(parts), b"".join(parts), np.cumsum([0, *map(len, parts)])


def byte_table(inside: bytes = b"", outside: bytes | None = None) -> np.ndarray:
    """Which bytes belong to a word: those of `inside`, or all but those of `outside`."""
    table = np.zeros(256, bool) if outside is None else np.ones(256, bool)
    table[np.frombuffer(inside if outside is None else outside, np.uint8)] = outside is None
    return table


#: Words of the quality and near-duplicate contracts: runs of anything but ASCII white space.
SPACED = byte_table(outside=bytes([0x20, *range(0x09, 0x0E)]))
#: Words of the decontamination contract: letters and digits after lower-casing, and all beyond ASCII.
PLAIN = byte_table(outside=bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
#: A-Z to a-z, the rest as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def word_bounds(codes: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the maximal runs of word bytes."""
    flags = np.zeros(len(codes) + 2, np.int8)
    flags[1:-1] = is_word[codes]
    edges = np.diff(flags)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def mixed(values: np.ndarray) -> np.ndarray:
    """Each 64-bit value scrambled, one to one."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """At least n powers of the base and of its inverse, kept by the worker."""
    if len(_powers[0]) < n:
        for i, base in enumerate((int(_BASE), pow(int(_BASE), -1, 1 << 64))):
            steps = np.full(max(n, BLOCK_BYTES + 64), base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes in each [start, end); equal bytes give equal hashes wherever they lie."""
    up, down = powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[codes] * up[:len(codes)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each k neighbouring values, by the position of the first."""
    n = max(0, len(hashes) - k + 1)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = mixed(out * _BASE + hashes[i:i + n])
    return out


def windowed_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of each `width` neighbours, in two running minima whatever the width."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:len(values)] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def char_offsets(codes: np.ndarray) -> np.ndarray:
    """For each byte position the number of code points that start before it."""
    out = np.zeros(len(codes) + 1, np.int64)
    np.cumsum((codes & 0xC0) != 0x80, out=out[1:])
    return out
