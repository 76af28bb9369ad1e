"""Words of many texts at once: runs of bytes that a table keeps, hashed and counted in arrays, a block of text at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

#: Bytes of text handled by one array operation; bounds a worker's memory.
BLOCK = 1 << 20
#: Counted words that a task holds before it sends them on.
HELD = 600_000
LANES = 3
MASKS = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
MIX, FOLD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def pieces(data: bytes) -> Iterator[bytes]:
    """A long text, its separators blanks already, in parts of about BLOCK bytes that end between words; a longer word stays whole."""
    at = 0
    while at < len(data):
        stop = data.find(b" ", at + BLOCK) if at + BLOCK < len(data) else -1
        stop = len(data) if stop < 0 else stop
        yield data[at:stop]
        at = stop


def blocks(texts: list[bytes]) -> Iterator[tuple[list[int], list[bytes]]]:
    """Places and texts in groups of about BLOCK bytes; a longer text makes a group of its own, in parts with the same place."""
    which: list[int] = []
    parts: list[bytes] = []
    size = 0
    for i, data in enumerate(texts):
        if len(data) > BLOCK:
            if parts:
                yield which, parts
                which, parts, size = [], [], 0
            for part in pieces(data):
                yield [i], [part]
            continue
        which.append(i)
        parts.append(data)
        size += len(data)
        if size > BLOCK:
            yield which, parts
            which, parts, size = [], [], 0
    if parts:
        yield which, parts


def found(parts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The parts as one, and of each word of them its start, its end and the number of its part."""
    data = b" ".join([*parts, b" " * 8 * LANES])
    inside = np.frombuffer(data, np.uint8) != 32
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edges = np.concatenate([[0], edges])
    starts, ends = edges[::2], edges[1::2]
    part = np.searchsorted(np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1), starts, side="right")
    return data, starts, ends, part


def hashed(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word; equal hashes are taken for equal words."""
    at = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    sizes = ends - starts
    with np.errstate(over="ignore"):
        out = (sizes.astype(np.uint64) * FOLD) ^ (at[starts] & MASKS[np.minimum(sizes, 8)]) * MIX
        for lane in range(1, LANES):
            some = np.flatnonzero(sizes > 8 * lane)
            more = at[starts[some] + 8 * lane] & MASKS[np.minimum(sizes[some] - 8 * lane, 8)]
            x = out[some]
            out[some] = (x ^ (x >> np.uint64(29))) * FOLD ^ (more * MIX + (more >> np.uint64(32)))
        for i in np.flatnonzero(sizes > 8 * LANES).tolist():
            out[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]])
        out ^= out >> np.uint64(32)
        out *= MIX
        return out ^ (out >> np.uint64(29))


class Counted:
    """Sums by (group, word) over the blocks of a task: occurrences and texts."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.parts: list[tuple] = []
        self.size = 0

    def add(self, data: bytes, starts: np.ndarray, ends: np.ndarray, text: np.ndarray, group: np.ndarray | None = None) -> None:
        """``text``: the number of each word's text, rising; ``group``: of each word."""
        if not len(starts):
            return
        keys = hashed(data, starts, ends)
        if group is not None:
            with np.errstate(over="ignore"):
                keys = keys ^ (group.astype(np.uint64) + np.uint64(1)) * FOLD
        order = np.argsort(keys, kind="stable")
        keys, text = keys[order], text[order]
        new = np.append(True, keys[1:] != keys[:-1])
        heads = np.flatnonzero(new)
        n = np.diff(np.append(heads, len(keys)))
        df = np.add.reduceat((new | np.append(True, text[1:] != text[:-1])).astype(np.int64), heads)
        first = order[heads]
        words = pa.array([data[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)], pa.binary())
        self.parts.append((keys[heads], n, df, np.zeros(len(first), np.int64) if group is None else group[first], words))
        self.size += len(first)

    def merged(self, one_text: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
        """(n, df, group, word) of what was added, each (group, word) once; ``one_text``: all of it is of one text."""
        if not self.parts:
            return *(np.zeros(0, np.int64),) * 3, pa.array([], pa.binary())
        keys, n, df, group = (np.concatenate([p[i] for p in self.parts]) for i in range(4))
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        heads = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        n, df = (np.add.reduceat(x[order], heads) for x in (n, df))
        first = order[heads]
        words = pa.concat_arrays([p[4] for p in self.parts]).take(pa.array(first))
        return n, np.minimum(df, 1) if one_text else df, group[first], words

    def fold(self, one: Counted) -> None:
        """Add the words of one long text that were counted in parts."""
        n, df, group, words = one.merged(one_text=True)
        if len(n):
            whole = b" ".join([*words.to_pylist(), b" " * 8 * LANES])
            sizes = np.fromiter((len(x) for x in words.to_pylist()), np.int64, len(words))
            starts = np.cumsum(sizes + 1) - sizes - 1
            keys = hashed(whole, starts, starts + sizes)
            with np.errstate(over="ignore"):
                keys = keys ^ (group.astype(np.uint64) + np.uint64(1)) * FOLD
            self.parts.append((keys, n, df, group, words))
            self.size += len(n)
