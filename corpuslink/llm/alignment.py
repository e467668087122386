"""Alignment of two tokenizers over whole texts by merge-path partitioning.

Both tokenizers write every text as bytes: A encodes a blank and the text with a byte-level BPE, B
encodes the text with a sentence-piece model that puts the blank in front itself. Each gives an
ascending row of byte offsets where its tokens end. Merging the two rows tells which tokens overlap,
and where both end at once, which cuts them into groups.

The merge is divided by diagonals: on the grid of A ends by B ends, every ``STEP``-th diagonal is
searched, by bisection, for the place where the merge crosses it. Between two crossings lies a piece
of exactly ``STEP`` ends that needs nothing of the others, so all pieces of a block of texts are
merged side by side, one end of each at a time, in arrays. A piece emits the overlaps and the common
ends it meets; the group a piece starts in the middle of is stitched to the end of the piece before
by numbering groups through the counts of common ends of all pieces before.

A link is an A token and a B token that end together. How often each pair of ids is linked in all
texts is counted by a combining aggregation over blocks of texts; the counts return to the blocks
that asked for them, never to single texts, so what is shuffled grows with the distinct pairs of a
block.

Texts are cut into segments at single blanks between characters that are no white space. Neither
tokenizer has a token across such a place, so a worker encodes each distinct segment once. Where a
text has none, it is encoded whole. Texts of ``BLOCK_BYTES`` or more go through in pieces cut at
such blanks; memory does not grow with them unless they lack these blanks.

Null and empty texts, and texts whose tokens of A or B do not spell the blank and the text again
(characters a model rewrites), have no tokens: zeros, and an empty string for the groups. Rows are
aligned one by one, also where ids or texts repeat. Columns other than the id and ``text`` are not
read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslink.llm.grouped_stream import held_then_streamed
from corpuslink.llm.tokens import _BASES, _Grown, _Places
from corpuslink.llm.wordhash import BLOCK_BYTES, blocks, give_back, mix
from corpuslink.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Ends of a piece of the merge.
STEP = 64
#: Bytes of texts whose links are counted together.
COUNT_BYTES = 16 << 20
#: Distinct segments, and ids of them, that a worker remembers before it starts afresh.
REMEMBERED = 800_000
REMEMBERED_IDS = 8_000_000
_FAR = np.int64(1) << 62


# ---------------------------------------------------------------- the merge


def crossings(a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """How many of ``a`` are among the first 0, step, 2 step, ... ends of the merge of ``a`` and ``b``
    (equal ends: ``a`` first), and among all. One bisection per diagonal, all at once."""
    total = len(a) + len(b)
    diagonals = np.append(np.arange(0, total, step), total)
    low, high = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) // 2
        first = a[middle] <= b[diagonals[open_] - 1 - middle]
        low[open_[first]] = middle[first] + 1
        high[open_[~first]] = middle[~first]
        open_ = open_[low[open_] < high[open_]]
    return low


def merge_pieces(a: np.ndarray, b: np.ndarray, step: int = STEP) -> tuple[np.ndarray, ...]:
    """Merge two ascending rows of ends of the same bytes, in pieces of ``step``.

    Returns the overlaps (place in ``a``, place in ``b``) and the common ends (how many of ``a`` and
    of ``b`` end there or before), both in order: the pieces' own lists one after the other."""
    i = crossings(a, b, step)
    diagonals = np.minimum(np.arange(len(i)) * step, len(a) + len(b))
    left, i, j = diagonals[1:] - diagonals[:-1], i[:-1].copy(), (diagonals - i)[:-1]
    far_a, far_b = np.append(a, _FAR), np.append(b, _FAR)
    before = np.maximum(np.where(i > 0, far_a[i - 1], 0), np.where(j > 0, far_b[j - 1], 0))
    n = len(left)
    shape = (n, min(step, int(left.max(initial=0))))
    overlaps, commons = np.zeros(shape, bool), np.zeros(shape, bool)
    of_a, of_b = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
    for t in range(shape[1]):
        end_a, end_b = far_a[i], far_b[j]
        take_a = end_a <= end_b
        end = np.minimum(end_a, end_b)
        of_a[:, t], of_b[:, t] = i, j
        overlaps[:, t] = end > before
        # The other row's end just before may belong to the piece before.
        commons[:, t] = ~take_a & (i > 0) & (far_a[i - 1] == end_b)
        i, j, before = i + take_a, j + ~take_a, end
        if t + 1 < shape[1]:
            i, j = np.minimum(i, len(a)), np.minimum(j, len(b))
    inside = np.arange(shape[1])[None, :] < left[:, None]
    overlaps &= inside
    commons &= inside
    return of_a[overlaps], of_b[overlaps], of_a[commons], of_b[commons] + 1


# ---------------------------------------------------------------- the two encodings


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_alphabet() -> dict[str, int]:
    """Byte of each character of the byte-level alphabet: printable bytes stand for themselves, the
    others, in order, for the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class _Segments:
    """Ids of one tokenizer for all remembered segments."""

    def __init__(self):
        self.ids, self.begin = _Grown(np.int32), _Grown(np.int64)
        self.begin.extend(np.zeros(1, np.int64))

    def add(self, lists: list) -> None:
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        self.begin.extend(self.ids.used + np.cumsum(counts))
        self.ids.extend(np.concatenate([np.asarray(x, np.int32) for x in lists]))

    def gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begin = self.begin.data[at]
        counts = self.begin.data[at + 1] - begin
        after = np.cumsum(counts)
        return self.ids.data[np.repeat(begin - (after - counts), counts) + np.arange(after[-1] if len(after) else 0)], counts


class PairEncoder:
    """Ids of both tokenizers for many texts, each distinct segment encoded once."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True
        alphabet = byte_alphabet()
        n_a, n_b = self.a.get_vocab_size(), self.b.get_piece_size()
        added = {i: t.content.encode() for i, t in self.a.get_added_tokens_decoder().items()}
        self.bytes_a = [
            added[i] if i in added else bytes(alphabet[c] for c in self.a.id_to_token(i) or "") for i in range(n_a)
        ]
        self.bytes_b = [
            bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
            else self.b.id_to_piece(i).replace("▁", " ").encode()
            for i in range(n_b)
        ]
        self.n_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.n_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.solid = np.zeros(256, bool)
        self.solid[33:127] = True
        size = BLOCK_BYTES + 2
        self.powers, self.inverse = np.ones((2, size), np.uint64), np.ones((2, size), np.uint64)
        for row, base in enumerate(_BASES):
            self.powers[row, 1:], self.inverse[row, 1:] = base, pow(base, -1, 1 << 64)
        np.cumprod(self.powers, axis=1, out=self.powers)
        np.cumprod(self.inverse, axis=1, out=self.inverse)
        self._forget()

    def _forget(self) -> None:
        self.places, self.second, self.good = _Places(), _Grown(np.uint64), _Grown(bool)
        self.of_a, self.of_b = _Segments(), _Segments()

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """Blanks at which a text may be cut: between an ASCII character that is no white space or a
        Latin letter of two bytes, on both sides."""
        ok = np.zeros(len(data), bool)
        if len(data) > 2:
            before = self.solid[data[:-2]].copy()
            before[1:] |= data[:-3] == 0xC3
            after = self.solid[data[2:]] | (data[2:] == 0xC3)
            ok[1:-1] = (data[1:-1] == 32) & before & after
        return ok

    def _encoded(self, segments: list[bytes]) -> tuple[list, list, np.ndarray]:
        """Ids by A and B of segments that begin with a blank, and whether both spell them."""
        texts = [s.decode() for s in segments]
        of_a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        of_b = self.b.encode([t[1:] for t in texts], num_threads=1)
        spell_a, spell_b = self.bytes_a.__getitem__, self.bytes_b.__getitem__
        good = [
            b"".join(map(spell_a, x)) == s and b"".join(map(spell_b, y)) == s for s, x, y in zip(segments, of_a, of_b)
        ]
        return of_a, of_b, np.array(good, bool)

    def block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """Ids by A, ids by B of all texts in a row; per text how many of each, and whether they
        spell it (texts that they do not spell have none). Every text begins with a blank."""
        n, n_texts = len(data), len(offsets) - 1
        if n == 0:
            none, zeros = np.empty(0, np.int32), np.zeros(n_texts, np.int64)
            return none, none, zeros, zeros, np.zeros(n_texts, bool)
        if n > BLOCK_BYTES:  # one text without a place to cut
            of_a, of_b, good = self._encoded([data.tobytes()])
            of_a, of_b = (np.asarray(x[0] if good[0] else [], np.int32) for x in (of_a, of_b))
            return of_a, of_b, np.array([len(of_a)]), np.array([len(of_b)]), good
        if self.places.n > REMEMBERED or self.of_a.ids.used > REMEMBERED_IDS:
            self._forget()
        first = self.cuts(data)
        # A text's own first byte begins a segment; the byte before belongs to another text.
        first[offsets[:-1]] = True
        last = offsets[1:] - 1
        first[last[last > offsets[:-1]]] = False
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], n)
        text_of = np.searchsorted(offsets, starts, side="right") - 1
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
            segments = [raw[x:y] for x, y in zip(starts[where].tolist(), ends[where].tolist())]
            of_a, of_b, good = self._encoded(segments)
            self.of_a.add(of_a), self.of_b.add(of_b)
            self.places.add(new), self.second.extend(two[where]), self.good.extend(good)
            at[missing] = self.places.find(one[missing])
        good = np.ones(n_texts, bool)
        good[text_of[~self.good.data[at]]] = False
        clash = np.unique(text_of[self.second.data[at] != two])
        doubtful = np.union1d(np.flatnonzero(~good), clash)
        if len(doubtful):  # encoded whole, which decides
            keep = np.ones(n_texts, bool)
            keep[doubtful] = False
            raw = [data[offsets[i] : offsets[i + 1]].tobytes() for i in doubtful.tolist()]
            own_a, own_b, spelt = self._encoded(raw)
            good[doubtful] = spelt
            at, text_of = at[keep[text_of]], text_of[keep[text_of]]
        out = []
        for table, own in ((self.of_a, own_a if len(doubtful) else []), (self.of_b, own_b if len(doubtful) else [])):
            ids, counts = table.gather(at)
            per_text = np.bincount(text_of, counts, n_texts).astype(np.int64)
            if len(doubtful):
                edges = np.concatenate([[0], np.cumsum(per_text)])
                parts, low = [], 0
                for i, found, ok in zip(doubtful.tolist(), own, spelt.tolist()):
                    if ok:
                        parts += [ids[low : edges[i]], np.asarray(found, np.int32)]
                        low, per_text[i] = edges[i], len(found)
                ids = np.concatenate([*parts, ids[low:]])
            out.append((ids, per_text))
        return out[0][0], out[1][0], out[0][1], out[1][1], good

    def pieces(self, data: np.ndarray, size: int) -> Iterator[np.ndarray]:
        """A long text in pieces of about ``size`` bytes that begin at blanks where it may be cut."""
        at, n = 0, len(data)
        while n - at > size:
            reach = size
            while True:
                # The byte behind a blank has to be seen; three bytes before the first one too.
                part = data[at : at + reach + 2]
                found = np.flatnonzero(self.cuts(part)[:reach])
                found = found[found > 0]
                if len(found) or at + reach >= n:
                    break
                reach *= 2
            if not len(found):
                break
            yield data[at : at + int(found[-1])]
            at += int(found[-1])
        yield data[at:]


_ENCODERS: dict[tuple[str, str], PairEncoder] = {}


def pair_encoder(path_a: str, path_b: str) -> PairEncoder:
    """The worker's own encoder, kept from task to task."""
    import builtins

    kept = builtins.__dict__.setdefault("_pair_encoders", _ENCODERS)
    if (path_a, path_b) not in kept:
        kept[path_a, path_b] = PairEncoder(path_a, path_b)
    return kept[path_a, path_b]


class Aligned:
    """Several texts in a row, aligned: ids of both sides, overlaps and common ends."""

    def __init__(self, encoder: PairEncoder, data: np.ndarray, offsets: np.ndarray, step: int = STEP):
        self.a, self.b, n_a, n_b, self.good = encoder.block(data, offsets)
        self.ends_a, self.ends_b = np.cumsum(encoder.n_a[self.a]), np.cumsum(encoder.n_b[self.b])
        self.over_a, self.over_b, self.cut_a, self.cut_b = merge_pieces(self.ends_a, self.ends_b, step)
        self.text_a, self.text_b = np.concatenate([[0], np.cumsum(n_a)]), np.concatenate([[0], np.cumsum(n_b)])
        # The end of a text is a common end, so no group and no piece of text runs into the next.
        self.text_cut = np.searchsorted(self.cut_a, self.text_a, side="right")

    def rendered(self) -> tuple[bytes, np.ndarray]:
        """``a1,a2|b1;a3|b2`` of all texts in a row, each group with its ``;``, and where texts begin."""
        group_a = np.searchsorted(self.cut_a, np.arange(len(self.a)), side="right")
        group_b = np.searchsorted(self.cut_b, np.arange(len(self.b)), side="right")
        before_a = np.concatenate([[0], self.cut_b])[group_a] if len(self.a) else np.empty(0, np.int64)
        after_b = self.cut_a[group_b] if len(self.b) else np.empty(0, np.int64)
        values = np.empty(len(self.a) + len(self.b), np.int64)
        values[np.arange(len(self.a)) + before_a] = self.a
        values[np.arange(len(self.b)) + after_b] = self.b
        marks = np.full(len(values), ord(","), np.uint8)
        marks[self.cut_a + np.concatenate([[0], self.cut_b[:-1]]) - 1 if len(self.cut_a) else []] = ord("|")
        marks[self.cut_a + self.cut_b - 1] = ord(";")
        digits = max(1, len(str(int(values.max(initial=0)))))
        width = np.ones(len(values), np.int64)
        for d in range(1, digits):
            width += values >= 10**d
        cells = np.zeros((len(values), digits + 1), np.uint8)
        for d in range(digits):  # the place ``width - 1 - d`` holds the digit of 10**d
            has = width > d
            cells[np.flatnonzero(has), width[has] - 1 - d] = 48 + (values[has] // 10**d) % 10
        cells[np.arange(len(values)), width] = marks
        size = np.concatenate([[0], np.cumsum(width + 1)])
        text = cells[np.arange(digits + 1)[None, :] <= width[:, None]].tobytes()
        return text, size[self.text_a + self.text_b]


def _framed(texts: pa.ChunkedArray | pa.Array) -> pa.Array:
    """A blank in front of every text."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = texts.cast(pa.large_string()).fill_null("")
    return pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts, pa.scalar("", pa.large_string()))


def aligned_texts(encoder: PairEncoder, texts: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, Aligned, bool]]:
    """For runs of texts, or pieces of a long one: first text, text after the last, their alignment,
    and whether the text goes on in the next piece. A long text with a piece that is not spelt again
    gives one empty alignment."""
    for low, high, data, offsets in blocks(_framed(texts)):
        if len(data) <= size:
            yield low, high, Aligned(encoder, data, offsets), False
            continue
        for i, (x, y) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            one = data[x:y]
            spelt = y - x <= size or all(
                encoder.block(piece, np.array([0, len(piece)]))[4][0] for piece in encoder.pieces(one, size)
            )
            if not spelt:
                one = one[:0]
            rest = list(_edges(encoder, one, size))
            for k, (p, q) in enumerate(rest):
                piece = one[p:q]
                yield low + i, low + i + 1, Aligned(encoder, piece, np.array([0, len(piece)])), k + 1 < len(rest)


def _edges(encoder: PairEncoder, data: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    at = 0
    for piece in encoder.pieces(data, size):
        yield at, at + len(piece)
        at += len(piece)


# ---------------------------------------------------------------- over tables

_GROUPS = "group_no bigint, a_ids array<int>, b_ids array<int>, start bigint, end bigint"


def token_groups(docs: DataFrame, tokenizers: tuple[str, str] | None = None, id_column: str = "doc_id") -> DataFrame:
    """One row per group of every row of ``docs``: its id, ``group_no`` from 0, the ids of both
    sides, and its bytes in the blank and the text (``start``, ``end``)."""
    paths = tokenizers or default_tokenizers()
    chosen = docs.select(F.col(id_column), F.col("text").cast("string").alias("text"))
    schema = T.StructType([chosen.schema[id_column], *T.StructType.fromDDL(_GROUPS).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = pair_encoder(*paths)
        for batch in batches:
            number = start = 0
            for low, high, found, more in aligned_texts(encoder, batch["text"]):
                for i in range(low, high):
                    a, b = found.text_cut[i - low], found.text_cut[i - low + 1]
                    if b > a:
                        cut_a, cut_b = found.cut_a[a:b], found.cut_b[a:b]
                        from_a, from_b = (
                            np.concatenate([[edge], cut[:-1]])
                            for edge, cut in ((found.text_a[i - low], cut_a), (found.text_b[i - low], cut_b))
                        )
                        base = found.ends_a[from_a[0] - 1] if from_a[0] else 0
                        ends = found.ends_a[cut_a - 1] - base + start
                        lists = [
                            pa.ListArray.from_arrays(
                                pa.array(np.append(x, y[-1]) - x[0], pa.int32()), pa.array(ids[x[0] : y[-1]], pa.int32())
                            )
                            for x, y, ids in ((from_a, cut_a, found.a), (from_b, cut_b, found.b))
                        ]
                        own = pa.array([batch[0][i].as_py()] * len(ends), batch.schema.field(0).type)
                        yield pa.RecordBatch.from_arrays(
                            [own, pa.array(np.arange(len(ends)) + number), *lists,
                             pa.array(np.concatenate([[start], ends[:-1]])), pa.array(ends)],
                            names=schema.names,
                        )
                        number, start = (number + len(ends), int(ends[-1])) if more else (0, 0)
                    elif not more:
                        number = start = 0

    return chosen.mapInArrow(give_back(run), schema)


def _merged(codes: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order and the sums of their times."""
    if not codes:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    found, where = np.unique(np.concatenate(codes), return_inverse=True)
    return found, np.bincount(where, np.concatenate(times), len(found)).astype(np.int64)


_DIGEST = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"


def aligned_documents(
    docs: DataFrame,
    tokenizers: tuple[str, str] | None = None,
    id_column: str = "doc_id",
    count_bytes: int = COUNT_BYTES,
    size: int = BLOCK_BYTES,
) -> DataFrame:
    """Per row of ``docs``: its id, tokens of both sides (``n_a``, ``n_b``), ``n_groups``,
    ``n_links``, ``n_best`` (links whose pair of ids is linked most often, in all texts, of the pairs
    with its B id), ``count_sum`` (of the pairs' counts over its links) and ``groups_sha256``."""
    paths = tokenizers or default_tokenizers()
    spark = docs.sparkSession
    chosen = docs.select(F.col(id_column).alias("id"), F.col("text").cast("string").alias("text"))
    id_field = chosen.schema["id"]
    schema = T.StructType(
        [T.StructField("block", T.LongType()), id_field, *T.StructType.fromDDL(_DIGEST).fields,
         *T.StructType.fromDDL("codes binary, times binary, code bigint, n bigint").fields]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = pair_encoder(*paths)
        n_b = len(encoder.n_b)
        task = TaskContext.get()
        block = (task.partitionId() if task else 0) << 32
        codes, times, held = [], [], 0

        def counted() -> pa.RecordBatch:
            found, n = _merged(codes, times)
            missing = [pa.nulls(len(found), t) for t in kinds[1:9]]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(found), block)), *missing, pa.array(found), pa.array(n)], names=schema.names
            )

        kinds: list[pa.DataType] = []
        for batch in batches:
            kinds = [pa.int64(), batch.schema.field("id").type, *[pa.int64()] * 4, pa.string(), pa.binary(), pa.binary()]
            rows: list[tuple] = []
            digest, sums, own = hashlib.sha256(), [0, 0, 0], ([], [])
            for low, high, found, more in aligned_texts(encoder, batch["text"], size):
                text, begins = found.rendered()
                links = found.a[found.cut_a - 1].astype(np.int64) * n_b + found.b[found.cut_b - 1]
                for i in range(low, high):
                    k = i - low
                    n = [int(x[k + 1] - x[k]) for x in (found.text_a, found.text_b, found.text_cut)]
                    pairs, repeats = np.unique(links[found.text_cut[k] : found.text_cut[k + 1]], return_counts=True)
                    part = text[begins[k] : begins[k + 1]]
                    digest.update(part if more else part[:-1])
                    sums = [x + y for x, y in zip(sums, n)]
                    own[0].append(pairs), own[1].append(repeats)
                    if more:
                        if len(own[0]) > 32:
                            own = tuple([x] for x in _merged(*own))
                        continue
                    pairs, repeats = _merged(*own) if len(own[0]) > 1 else (pairs, repeats)
                    rows.append(
                        (block, None, sums[0], sums[1], sums[2], sums[2], digest.hexdigest() if sums[0] else "",
                         pairs.astype("<i8").tobytes() if n_b * len(encoder.n_a) >> 32 else pairs.astype("<u4").tobytes(),
                         repeats.astype("<u4").tobytes())
                    )
                    codes.append(pairs), times.append(repeats)
                    held += len(pairs)
                    digest, sums, own = hashlib.sha256(), [0, 0, 0], ([], [])
                if len(codes) > 4096:
                    codes, times = ([x] for x in _merged(codes, times))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds]
            columns[1] = batch["id"].slice(0, len(rows))
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.nulls(len(rows), pa.int64()), pa.nulls(len(rows), pa.int64())], names=schema.names
            )
            if held * 8 >= count_bytes:
                yield counted()
                block, codes, times, held = block + 1, [], [], 0
        if codes:
            yield counted()

    stored = cut_lineage(chosen.mapInArrow(give_back(run), schema))
    asked = stored.where("code is not null").select("block", "code", "n")
    counts = asked.groupBy("code").agg(F.sum("n").alias("count"))
    n_b = F.lit(_pieces_of(paths[1]))
    counts = cut_lineage(counts.withColumn("b_id", F.col("code") % n_b))
    highest = counts.groupBy("b_id").agg(F.max("count").alias("highest"))
    known = counts.join(highest, "b_id").select("code", "count", (F.col("count") == F.col("highest")).alias("best"))
    answers = asked.select("block", "code").join(known, "code")
    wanted = stored.where("code is null").drop("code", "n")
    dealt = held_then_streamed(answers, wanted, "block", int(spark.conf.get("spark.sql.shuffle.partitions")))
    names = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, table = None, [], None
        for batch in batches:
            numbers, streamed = batch["block"].to_numpy(), batch["streamed_row"].to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((np.diff(numbers) != 0) | (np.diff(streamed.astype(int)) != 0)) + 1
            for x, y in zip([0, *edges.tolist()], [*edges.tolist(), len(numbers)]):
                if numbers[x] != group:
                    group, held, table = int(numbers[x]), [], None
                part = batch.slice(x, y - x)
                if not streamed[x]:
                    held.append([part[c].to_numpy(zero_copy_only=False) for c in ("code", "count", "best")])
                    continue
                if table is None:
                    table = [np.concatenate(c) for c in zip(*held)] if held else [np.empty(0, np.int64)] * 3
                    order = np.argsort(table[0])
                    table, held = [c[order] for c in table], []
                n_best, count_sum = [], []
                for codes, times in zip(part["codes"], part["times"]):
                    repeats = np.frombuffer(times.as_py(), "<u4").astype(np.int64)
                    raw = codes.as_py()
                    pairs = np.frombuffer(raw, "<u4" if len(raw) == 4 * len(repeats) else "<i8").astype(np.int64)
                    at = np.searchsorted(table[0], pairs)
                    n_best.append(int(repeats[table[2][at].astype(bool)].sum()) if len(at) else 0)
                    count_sum.append(int((repeats * table[1][at]).sum()) if len(at) else 0)
                yield pa.RecordBatch.from_arrays(
                    [part["id"], part["n_a"], part["n_b"], part["n_groups"], part["n_links"],
                     pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), part["groups_sha256"]],
                    names=names,
                )

    fields = T.StructType.fromDDL(
        "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    ).fields
    return dealt.mapInArrow(give_back(look_up), T.StructType([id_field, *fields])).withColumnRenamed("id", id_column)


def _pieces_of(path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path).get_piece_size()
