"""Vectorised word hashing over the bytes of many texts at once (runs inside Spark tasks)."""

from __future__ import annotations

import ctypes
import functools
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Odd multipliers; any odd numbers serve, these only have to stay the same within one job.
_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)
_SHINGLE = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)
BLOCK_BYTES = 1 << 20


def _lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def white_space() -> np.ndarray:
    """Separators of ``[^\\x20\\x09-\\x0D]+``."""
    table = np.zeros(256, dtype=bool)
    table[[0x20, 9, 10, 11, 12, 13]] = True
    return table


def not_letters() -> np.ndarray:
    """Separators of runs of ASCII letters and digits and of all other characters above ASCII."""
    table = np.ones(256, dtype=bool)
    for low, high in ((48, 58), (65, 91), (97, 123), (128, 256)):
        table[low:high] = False
    return table


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def give_back(run):
    """Decorate the generator of a task: when it ends, the worker, which lives on for other tasks,
    returns the memory it no longer uses to the system."""

    @functools.wraps(run)
    def wrapped(*args):
        try:
            yield from run(*args)
        finally:
            pa.default_memory_pool().release_unused()
            if sys.platform == "linux":
                ctypes.CDLL(None).malloc_trim(0)

    return wrapped


class WordHasher:
    """Hashes the lower-cased words of texts; keeps its power tables between calls."""

    def __init__(self, separators: np.ndarray):
        self.separators = separators
        self.lower = _lower()
        self.powers = np.empty(0, np.uint64)

    def _tables(self, n: int) -> None:
        if len(self.powers) < n:
            size = max(n, BLOCK_BYTES)
            for name, base in (("powers", _P), ("inverse", _P_INVERSE)):
                table = np.full(size, base, np.uint64)
                table[0] = 1
                setattr(self, name, np.cumprod(table, dtype=np.uint64))

    def words(self, data: np.ndarray, offsets: np.ndarray, size: int = BLOCK_BYTES) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every word and, per text, where its words begin (one entry more at the end).

        More than ``size`` bytes are read in pieces cut between words, so beyond the hashes memory
        does not grow with a text."""
        if len(data) <= size:
            return self._block(data, offsets)
        found, begins = [np.empty(0, np.uint64)], [0]
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            parts = list(self._pieces(data[a:b], size))
            found += parts
            begins.append(begins[-1] + sum(map(len, parts)))
        return np.concatenate(found), np.array(begins, np.int64)

    def _pieces(self, text: np.ndarray, size: int) -> Iterator[np.ndarray]:
        """Hashes of the words of one text, piece by piece."""
        at = 0
        while at < len(text):
            part = text[at : at + size]
            cuts = np.flatnonzero(self.separators[self.lower[part]]) if len(part) == size else None
            if cuts is None or len(cuts):
                part = part if cuts is None else part[: cuts[-1] + 1]
                yield self._block(part, np.array([0, len(part)]))[0]
                at += len(part)
                continue
            total = length = 0  # one word fills the piece: its sum is added up piece by piece
            while at < len(text):
                part = self.lower[text[at : at + size]]
                cuts = np.flatnonzero(self.separators[part])
                part = part[: cuts[0]] if len(cuts) else part
                self._tables(len(part) + 1)
                own = ((part.astype(np.uint64) + np.uint64(1)) * self.powers[: len(part)]).sum(dtype=np.uint64)
                total = (total + pow(_P, length, 1 << 64) * int(own)) % (1 << 64)
                length += len(part)
                at += len(part)
                if len(cuts):
                    break
            yield mix(np.array([(total + length) % (1 << 64)], np.uint64))

    def _block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(data)
        if n == 0:
            return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
        self._tables(n + 1)
        low = self.lower[data]
        inside = ~self.separators[low]
        first = np.zeros(n + 1, bool)
        first[offsets] = True
        starts = inside.copy()
        starts[1:] &= ~inside[:-1] | first[1:n]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | first[1:n]
        starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((low.astype(np.uint64) + np.uint64(1)) * self.powers[:n], out=total[1:])
        hashes = mix((total[ends] - total[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))
        return hashes, np.searchsorted(starts, offsets)


def blocks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a column of texts (null counts as empty) into runs of whole texts of about
    ``BLOCK_BYTES``: first row, row after the last, their bytes, offsets into these."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = texts.cast(pa.large_string()).fill_null("")
    if len(texts) == 0:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    low = 0
    while low < len(texts):
        high = int(np.searchsorted(offsets, offsets[low] + BLOCK_BYTES, side="right")) - 1
        high = min(max(high, low + 1), len(texts))
        part = offsets[low : high + 1]
        yield low, high, data[part[0] : part[-1]], part - part[0]
        low = high


def shingles(hashes: np.ndarray, begins: np.ndarray, width: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its runs of ``width`` words; fewer words make one
    run, no word makes none."""
    n = len(hashes)
    runs = np.empty(0, np.uint64)
    if n >= width:
        runs = np.zeros(n - width + 1, np.uint64)
        for low in range(0, len(runs), BLOCK_BYTES):  # so that only the sums are as long as the text
            own = runs[low : low + BLOCK_BYTES]
            for k in range(width):
                own += mix(hashes[low + k : low + k + len(own)] + np.uint64(k)) * np.uint64(_SHINGLE[k % 5])
            own[:] = mix(own)
    out = []
    for a, b in zip(begins[:-1].tolist(), begins[1:].tolist()):
        if b - a >= width:
            found = np.sort(runs[a : b - width + 1])
            keep = np.ones(len(found), bool)
            np.not_equal(found[1:], found[:-1], out=keep[1:])
            out.append(found[keep])
        elif b > a:
            whole = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for k, h in enumerate(hashes[a:b]):
                    whole = whole * np.uint64(_SHINGLE[0]) + h * np.uint64(_SHINGLE[k % 5] + 2 * k)
            out.append(mix(np.array([whole], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out
