"""Token ids of whole texts by the ``tokenizers`` library, each distinct piece encoded once.

A byte-level BPE merges only inside the pieces its pattern cuts. Where all white space of a text is
single, every blank or line break begins such a piece, and so does a comma or full stop after a
letter or digit. Texts are cut there; a worker hands a piece to the library the first time it meets
it and afterwards copies its ids. Pieces are told apart by 128 bits of hash. All other texts
(doubled or outer white space, white space beyond ASCII, the text of a special token) are encoded
as they are. Either way gives the ids of encoding the whole text. Texts of 1 MB or more go through in
pieces, so a task holds the ids of a text and not much more.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from corpuslink.llm.wordhash import BLOCK_BYTES, blocks, mix

cloudpickle.register_pickle_by_value(sys.modules[__name__])

END_ID = 0
#: Distinct pieces a worker remembers before it starts afresh (about 60 MB).
REMEMBERED = 800_000
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class _Places:
    """Open-addressing table from hashes (not zero) to places, looked up many at a time."""

    def __init__(self, bits: int = 18):
        self.bits, self.n = bits, 0
        self.keys = np.zeros(1 << bits, np.uint64)
        self.places = np.full(1 << bits, -1, np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        slots = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        out = self.places[slots]
        open_ = np.flatnonzero((self.keys[slots] != hashes) & (out >= 0))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & ((1 << self.bits) - 1)
            at = slots[open_]
            out[open_] = self.places[at]
            open_ = open_[(self.keys[at] != hashes[open_]) & (out[open_] >= 0)]
        return out

    def add(self, hashes: np.ndarray) -> None:
        """Distinct hashes that are not in the table get the next places in order."""
        if 2 * (self.n + len(hashes)) > len(self.keys):
            old = np.flatnonzero(self.places >= 0)
            keys, places = self.keys[old], self.places[old]
            self.bits = int(2 * (self.n + len(hashes))).bit_length()
            self.keys = np.zeros(1 << self.bits, np.uint64)
            self.places = np.full(1 << self.bits, -1, np.int32)
            self._put(keys, places)
        self._put(hashes, np.arange(self.n, self.n + len(hashes), dtype=np.int32))
        self.n += len(hashes)

    def _put(self, keys: np.ndarray, places: np.ndarray) -> None:
        slots = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(keys):
            free = np.flatnonzero(self.places[slots] < 0)
            self.places[slots[free]] = places[free]  # of several for one slot the last one stays
            self.keys[slots[free]] = keys[free]
            left = self.places[slots] != places
            keys, places, slots = keys[left], places[left], (slots[left] + 1) & ((1 << self.bits) - 1)


class _Grown:
    def __init__(self, dtype: type, size: int = 1 << 16):
        self.data, self.used = np.zeros(size, dtype), 0

    def extend(self, values: np.ndarray) -> None:
        if self.used + len(values) > len(self.data):
            self.data = np.concatenate([self.data, np.zeros(max(len(self.data), len(values)), self.data.dtype)])
        self.data[self.used : self.used + len(values)] = values
        self.used += len(values)


class PieceEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        n = self.tokenizer.get_vocab_size()
        # A token of the byte-level alphabet has one character for each of its bytes.
        self.n_bytes = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(n)], np.int64)
        self.break_ids = len(self.tokenizer.encode("\n", add_special_tokens=False).ids)
        self.powers = np.empty((2, 0), np.uint64)
        self.white = np.zeros(256, bool)
        self.white[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
        self.wordy = np.zeros(256, bool)
        for low, high in ((48, 58), (65, 91), (97, 123)):
            self.wordy[low:high] = True
        self._forget()

    def _forget(self) -> None:
        self.places = _Places()
        self.second = _Grown(np.uint64)
        self.flat = _Grown(np.uint32)
        self.begin = _Grown(np.int64)
        self.begin.extend(np.zeros(1, np.int64))

    def _tables(self, n: int) -> None:
        if self.powers.shape[1] < n:
            size = max(n, BLOCK_BYTES + 1)
            self.powers = np.ones((2, size), np.uint64)
            self.inverse = np.ones((2, size), np.uint64)
            for row, base in enumerate(_BASES):
                self.powers[row, 1:], self.inverse[row, 1:] = base, pow(base, -1, 1 << 64)
            np.cumprod(self.powers, axis=1, out=self.powers)
            np.cumprod(self.inverse, axis=1, out=self.inverse)

    def _cuts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where pieces begin, and which texts have to be encoded as they are."""
        n = len(data)
        white = self.white[data]
        first = np.zeros(n, bool)
        first[offsets[:-1][offsets[:-1] < n]] = True
        start = first | (data == 32) | (data == 10)
        start[1:] |= (data[:-1] == 10)
        before = self.wordy[data]
        before[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        start[1:] |= ((data[1:] == 44) | (data[1:] == 46)) & before[:-1]
        odd = np.zeros(n, bool)
        odd[1:] = white[1:] & white[:-1]
        odd |= first & white
        last = offsets[1:] - 1
        odd[last[last >= 0]] |= white[last[last >= 0]]
        odd[:-1] |= (data[:-1] == 60) & (data[1:] == 124)
        odd[:-1] |= (data[:-1] == 0xC2) & ((data[1:] == 0x85) | (data[1:] == 0xA0))
        odd[:-1] |= (data[:-1] == 0xE1) & (data[1:] == 0x9A)
        wide = np.flatnonzero((data[:-2] == 0xE2) | (data[:-2] == 0xE3)) if n > 2 else np.empty(0, np.int64)
        if len(wide):
            lead, two, three = data[wide], data[wide + 1], data[wide + 2]
            blank = (lead == 0xE2) & (two == 0x80) & ((three <= 0x8A) | (three == 0xA8) | (three == 0xA9) | (three == 0xAF))
            blank |= (two == 0x80) & (lead == 0xE3) & (three == 0x80)
            blank |= (lead == 0xE2) & (two == 0x81) & (three == 0x9F)
            odd[wide[blank]] = True
        return np.flatnonzero(start), np.unique(np.searchsorted(offsets, np.flatnonzero(odd), side="right") - 1)

    def _learn(self, pieces: list[bytes], hashes: np.ndarray, second: np.ndarray) -> None:
        if b"\n" in pieces:  # the one piece that is white space itself
            i = pieces.index(b"\n")
            self._add(np.array(self.tokenizer.encode("\n", add_special_tokens=False).ids, np.uint32),
                      np.array([self.break_ids]), hashes[i : i + 1], second[i : i + 1])
            pieces = pieces[:i] + pieces[i + 1 :]
            hashes, second = np.delete(hashes, i), np.delete(second, i)
        # A piece with a blank in front stays apart behind any other; the others get a line break.
        blank = np.array([p[:1] == b" " for p in pieces], bool)
        order = np.argsort(~blank, kind="stable")
        n_blank = int(blank.sum())
        ordered = [pieces[i] for i in order.tolist()]
        others = [b"\n" + p for p in ordered[n_blank:]]
        text = b"".join(ordered[:n_blank] + others).decode()
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
        sizes = [len(p) for p in ordered[:n_blank]] + [len(p) for p in others]
        ends = np.searchsorted(np.cumsum(self.n_bytes[ids]), np.cumsum(sizes), side="left") + 1
        counts = np.diff(ends, prepend=0)
        if len(others):
            drop = (ends - counts)[n_blank:]
            keep = np.ones(len(ids), bool)
            for k in range(self.break_ids):
                keep[drop + k] = False
            ids = ids[keep]
            counts[n_blank:] -= self.break_ids
        self._add(ids, counts, hashes[order], second[order])

    def _add(self, ids: np.ndarray, counts: np.ndarray, hashes: np.ndarray, second: np.ndarray) -> None:
        self.begin.extend(self.flat.used + np.cumsum(counts))
        self.flat.extend(ids)
        self.places.add(hashes)
        self.second.extend(second)

    def block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a block in a row and, per text, how many."""
        n = len(data)
        if n == 0:
            return np.empty(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        if self.places.n > REMEMBERED:
            self._forget()
        self._tables(n + 1)
        starts, odd = self._cuts(data, offsets)
        ends = np.append(starts[1:], n)
        text_of = np.searchsorted(offsets, starts, side="right") - 1
        if len(odd):
            regular = np.ones(len(offsets) - 1, bool)
            regular[odd] = False
            keep = regular[text_of]
            starts, ends, text_of = starts[keep], ends[keep], text_of[keep]
        hashes, total, wide = [], np.zeros(n + 1, np.uint64), data.astype(np.uint64) + np.uint64(1)
        for row in range(2):
            np.cumsum(wide * self.powers[row, :n], out=total[1:])
            hashes.append(mix((total[ends] - total[starts]) * self.inverse[row, starts] + (ends - starts).astype(np.uint64)))
        one, two = hashes[0] | np.uint64(1), hashes[1]
        at = self.places.find(one)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new, where = np.unique(one[missing], return_index=True)
            where = missing[where]
            raw = data.tobytes()
            self._learn([raw[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist())], new, two[where])
            at[missing] = self.places.find(one[missing])
        if (self.second.data[at] != two).any():
            odd = np.union1d(odd, text_of[self.second.data[at] != two])
            keep = ~np.isin(text_of, odd)
            at, text_of = at[keep], text_of[keep]
        begin = self.begin.data[at]
        counts = self.begin.data[at + 1] - begin
        after = np.cumsum(counts)
        ids = self.flat.data[np.repeat(begin - (after - counts), counts) + np.arange(after[-1] if len(after) else 0)]
        edges = np.concatenate([[0], after])[np.searchsorted(text_of, np.arange(len(offsets)))]
        lengths = np.diff(edges)
        if len(odd):
            parts, last = [], 0
            for i in odd.tolist():
                text = data[offsets[i] : offsets[i + 1]].tobytes().decode()
                own = self.tokenizer.encode(text, add_special_tokens=False).ids
                parts += [ids[edges[last] : edges[i]], np.array(own, np.uint32)]
                lengths[i], last = len(own), i
            ids = np.concatenate([*parts, ids[edges[last] :]])
        return ids, lengths

    def encode(self, texts: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """For runs of rows: first row, row after the last, ids in a row, ids per text.

        A text of more than ``size`` bytes is encoded in pieces, so beyond its ids memory does not
        grow with it. One without a place to cut for that long is encoded whole."""
        for low, high, data, offsets in blocks(texts):
            if len(data) <= size:
                yield low, high, *self.block(data, offsets)
                continue
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                parts = [self.block(part, np.array([0, len(part)]))[0] for part in _long_pieces(data[a:b], size)]
                ids = np.concatenate(parts) if parts else np.empty(0, np.uint32)
                yield low + i, low + i + 1, ids, np.array([len(ids)])


def _long_pieces(data: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """A text in pieces of about ``size`` bytes. It is cut in front of single blanks between two ASCII
    characters that are no white space: there a new piece of the pattern begins, whatever stands
    before and behind."""
    at = 0
    while len(data) - at > size:
        reach, found = size, ()
        while not len(found):
            part = data[at : at + reach + 1]
            solid = (part > 32) & (part < 127)
            found = np.flatnonzero(solid[:-2] & (part[1:-1] == 32) & solid[2:]) + 1
            if at + reach + 1 >= len(data):
                break
            reach *= 2
        if not len(found):
            break
        yield data[at : at + int(found[-1])]
        at += int(found[-1])
    if at < len(data):
        yield data[at:]


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The worker's own encoder, kept from task to task."""
    import builtins

    kept = builtins.__dict__.setdefault("_piece_encoders", _ENCODERS)
    if path not in kept:
        kept[path] = PieceEncoder(path)
    return kept[path]
