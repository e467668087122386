"""Benchmark decontamination by a broadcast hash set of normalised test n-grams.

Words are runs of ASCII letters, digits and characters above ASCII, with A-Z in lower case. An item's
windows are its runs of ``width`` consecutive words; an item of fewer words, but not none, is one
window. The distinct windows are kept as hashes with their words. Every text is hashed word by word
and window by window in vectorised passes; windows whose hash is in the set are verified word for
word, so a collision is never a hit. Every word inside a verified window is hit.

The set is broadcast while it has at most ``MAX_WINDOWS`` rows and ``MAX_BYTES`` bytes of words.
Beyond that the hashes of all text windows are joined to the set, and each text is scanned with the
windows that this finds for it alone; the results are the same.

Texts of ``BLOCK_BYTES`` or more are scanned in pieces cut between words, with the last words of a
piece kept in front of the next; a single word of that size stands as its SHA-256. So memory does
not grow with a text beyond the text itself.

A null text has no words. An item with a null id still hits words but is not listed; several rows of
one item id count as one item. Rows are judged one by one, also where ids repeat. Other columns are
kept by ``without_hits`` and not read otherwise. An empty benchmark hits nothing; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslink.llm.grouped_stream import held_then_streamed
from corpuslink.llm.wordhash import BLOCK_BYTES, WordHasher, blocks, give_back, mix, not_letters
from corpuslink.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTH = 10
#: Bounds of the broadcast set: rows (one per window and item) and bytes of their words.
MAX_WINDOWS = 1 << 20
MAX_BYTES = 1 << 27
_WINDOW = "length int, hash bigint, words binary, item string"


class Words(WordHasher):
    """Places and hashes of the words of several texts, and hashes of their windows."""

    def __init__(self):
        super().__init__(not_letters())

    def read(self, data: np.ndarray, offsets: np.ndarray) -> None:
        n = len(data)
        self._tables(n + 1)
        self.data = low = self.lower[data]
        inside = ~self.separators[low]
        first = np.zeros(n + 1, bool)
        first[offsets] = True
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        starts = np.flatnonzero(inside & (~before | first[:n]))
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        ends = np.flatnonzero(inside & (~after | first[1:])) + 1
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((low.astype(np.uint64) + np.uint64(1)) * self.powers[:n], out=total[1:])
        words = mix((total[ends] - total[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))
        self.starts, self.ends, self.begins = starts, ends, np.searchsorted(starts, offsets)
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * self.powers[: len(words)], out=self.sums[1:])

    def windows(self, length: int) -> np.ndarray:
        """Hash of the window of ``length`` words that begins at each word (of any text: those that
        run into the next text are left out by the caller)."""
        n = len(self.starts) - length + 1
        if n <= 0:
            return np.empty(0, np.uint64)
        return mix((self.sums[length:] - self.sums[:n]) * self.inverse[:n] + np.uint64(length))

    def text_of(self, words: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begins, words, side="right") - 1

    def joined(self, first: int, length: int) -> bytes:
        """Words of a window, one blank between them."""
        places = zip(self.starts[first : first + length].tolist(), self.ends[first : first + length].tolist())
        return b" ".join([self.data[a:b].tobytes() for a, b in places])


def pieces(data: np.ndarray, separators: np.ndarray, lower: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, int, int]]:
    """Pieces of a long text cut behind separators: bytes, where they begin and, for a word of
    ``size`` or more bytes, which comes alone as its digest, where it ends (else -1)."""
    at, n = 0, len(data)
    while at < n:
        part = data[at : at + size]
        cuts = np.flatnonzero(separators[part])
        if len(part) < size:
            yield part, at, -1
            return
        if len(cuts):
            yield part[: cuts[-1] + 1], at, -1
            at += int(cuts[-1]) + 1
            continue
        digest, end = hashlib.sha256(), at
        while end < n:
            part = data[end : end + size]
            cuts = np.flatnonzero(separators[part])
            part = part[: cuts[0]] if len(cuts) else part
            digest.update(lower[part].tobytes())
            end += len(part)
            if len(cuts):
                break
        # No text holds the byte 0xFF, so a digest never equals a word.
        yield np.frombuffer(b"\xff" + digest.hexdigest().encode(), np.uint8), at, end
        at = end


class Carried:
    """The words of a long text piece by piece; ``keep`` words stay in front of the next piece."""

    def __init__(self, words: Words, keep: int):
        self.words, self.keep = words, keep
        self.front, self.starts, self.ends = b"", np.empty(0, np.int64), np.empty(0, np.int64)

    def read(self, data: np.ndarray, size: int) -> Iterator[int]:
        """After each piece ``words`` holds it, ``starts`` and ``ends`` tell where its words are in
        the whole text, and the number of words from the piece before is given."""
        w = self.words
        for part, at, word_end in pieces(data, w.separators, w.lower, size):
            front = np.frombuffer(self.front, np.uint8)
            w.read(np.concatenate([front, part]), np.array([0, len(front) + len(part)]))
            old = len(self.starts)
            self.starts = np.concatenate([self.starts, w.starts[old:] - len(front) + at])
            ends = w.ends[old:] - len(front) + at if word_end < 0 else np.array([word_end])
            self.ends = np.concatenate([self.ends, ends])
            yield old
            last = max(0, len(self.starts) - self.keep)
            kept = len(self.starts) - last
            self.front = w.joined(last, kept) + b" " if kept else b""
            self.starts, self.ends = self.starts[last:], self.ends[last:]


class WindowSet:
    """Windows by length and hash, with their words and items."""

    def __init__(self, lengths: np.ndarray, hashes: np.ndarray, words: list[bytes], items: list[str | None]):
        order = sorted(range(len(words)), key=lambda i: (lengths[i], hashes[i], words[i]))
        self.texts: list[bytes] = []
        self.items: list[set[str]] = []
        self.longest = int(max(lengths, default=1))
        by_length: dict[int, list[int]] = {}
        for i in order:
            key = (int(lengths[i]), words[i])
            if not self.texts or key != last:
                by_length.setdefault(key[0], []).append(int(hashes[i]))
                self.texts.append(words[i])
                self.items.append(set())
            last = key
            if items[i] is not None:
                self.items[-1].add(items[i])
        self.tables, first = {}, 0
        for length, own in sorted(by_length.items()):
            found = np.array(own, np.uint64)
            bits = max(16, int(8 * len(found)).bit_length())
            seen = np.zeros(1 << bits, bool)
            seen[found >> np.uint64(64 - bits)] = True
            self.tables[length] = (seen, np.uint64(64 - bits), found, first)
            first += len(found)

    def verified(self, words: Words) -> Iterator[tuple[int, int, int]]:
        """First word, length and window of every occurrence inside one text."""
        for length, (seen, shift, found, first) in self.tables.items():
            hashes = words.windows(length)
            maybe = np.flatnonzero(seen[hashes >> shift])
            maybe = maybe[words.text_of(maybe) == words.text_of(maybe + length - 1)]
            low = np.searchsorted(found, hashes[maybe], side="left")
            high = np.searchsorted(found, hashes[maybe], side="right")
            some = high > low
            for place, a, b in zip(maybe[some].tolist(), low[some].tolist(), high[some].tolist()):
                text = words.joined(place, length)
                for window in range(first + a, first + b):
                    if self.texts[window] == text:
                        yield place, length, window


class Scan:
    """What a text holds of the benchmark: words, hit words, items, runs of hit words in bytes."""

    __slots__ = ("n_words", "n_hit", "items", "spans", "open")

    def __init__(self):
        self.n_words, self.n_hit, self.items, self.spans, self.open = 0, 0, set(), [], False

    def add(self, starts: np.ndarray, ends: np.ndarray, hit: np.ndarray) -> None:
        """The next words of the text. A run of hit words may go on from those before (``open``)."""
        if not len(hit):
            return
        self.n_words += len(hit)
        self.n_hit += int(hit.sum())
        edges = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if a == 0 and self.open:
                self.spans[-1] = (self.spans[-1][0], int(ends[b - 1]))
            else:
                self.spans.append((int(starts[a]), int(ends[b - 1])))
        self.open = bool(hit[-1])


def scan_long(words: Words, held: WindowSet, data: np.ndarray, size: int) -> Scan:
    """One text of any length, piece by piece."""
    out, carried = Scan(), Carried(words, held.longest - 1)
    flags = np.empty(0, bool)
    for old in carried.read(data, size):
        hit = np.zeros(len(carried.starts), bool)
        hit[:old] = flags
        for place, length, window in held.verified(words):
            hit[place : place + length] = True
            out.items |= held.items[window]
        done = max(0, len(hit) - carried.keep)
        out.add(carried.starts[:done], carried.ends[:done], hit[:done])
        flags = hit[done:]
    out.add(carried.starts, carried.ends, flags)
    return out


def scans(words: Words, held: WindowSet, texts: pa.Array, size: int = BLOCK_BYTES) -> Iterator[Scan]:
    """One scan per text, in order."""
    for low, high, data, offsets in blocks(texts):
        if len(data) >= size:
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                yield scan_long(words, held, data[a:b], size)
            continue
        words.read(data, offsets)
        change, items = np.zeros(len(words.starts) + 1, np.int64), {}
        for place, length, window in held.verified(words):
            change[place] += 1
            change[place + length] -= 1
            items.setdefault(int(words.text_of(place)), set()).update(held.items[window])
        hit = np.cumsum(change[:-1]) > 0
        any_hit = np.concatenate([[0], np.cumsum(hit)])
        begins = words.begins
        n_hit = any_hit[begins[1:]] - any_hit[begins[:-1]]
        for i in range(high - low):
            one, a, b = Scan(), int(begins[i]), int(begins[i + 1])
            if n_hit[i]:
                one.items = items.get(i, set())
                one.add(words.starts[a:b] - offsets[i], words.ends[a:b] - offsets[i], hit[a:b])
            else:
                one.n_words = b - a
            yield one


def windows_of(items: DataFrame, width: int = WIDTH, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """Distinct windows of all items with the items that hold them: ``length``, ``hash``, ``words``,
    ``item`` (the id as text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            for i, text in enumerate(batch["text"]):
                data = np.frombuffer((text.as_py() or "").encode(), np.uint8)
                n, short, carried = 0, None, Carried(words, width - 1)
                for old in carried.read(data, BLOCK_BYTES):
                    n += len(words.starts) - old
                    hashes = words.windows(width).view(np.int64)
                    short = None if len(hashes) else (len(words.starts), words.windows(len(words.starts)), words.joined(0, len(words.starts)))
                    for at in range(0, len(hashes), 10_000):
                        part = range(at, min(at + 10_000, len(hashes)))
                        yield rows(width, hashes[part.start : part.stop], [words.joined(p, width) for p in part], batch["item"][i])
                if 0 < n < width:
                    yield rows(short[0], short[1].view(np.int64), [short[2]], batch["item"][i])

    def rows(length: int, hashes: np.ndarray, joined: list[bytes], item: pa.Scalar) -> pa.RecordBatch:
        n = len(joined)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, length, np.int32)), pa.array(hashes), pa.array(joined, pa.binary()), pa.array([item.as_py()] * n, pa.string())],
            names=["length", "hash", "words", "item"],
        )

    named = items.select(F.col(id_column).cast("string").alias("item"), F.col(text_column).cast("string").alias("text"))
    return named.mapInArrow(give_back(run), _WINDOW).distinct()


def _window_arrays(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[bytes], list[str | None]]:
    return (
        table["length"].to_numpy(), table["hash"].to_numpy().astype(np.int64).view(np.uint64),
        table["words"].to_pylist(), table["item"].to_pylist(),
    )


def _scanned(docs: DataFrame, windows: DataFrame, text: str, fields: list[T.StructField], emit, max_windows: int) -> DataFrame:
    """``emit(batch, scans)`` of all ``docs``; a batch has the columns of ``docs``."""
    spark = docs.sparkSession
    windows = cut_lineage(windows)
    n, n_bytes = windows.agg(F.count("*"), F.sum(F.octet_length("words"))).first()
    if n <= max_windows and (n_bytes or 0) <= MAX_BYTES:
        shared = spark.sparkContext.broadcast(_window_arrays(windows.toArrow()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words, held = Words(), WindowSet(*shared.value)
            for batch in batches:
                yield from emit(batch, scans(words, held, batch[text]))

        return docs.mapInArrow(give_back(run), T.StructType(fields))

    row = "row"
    while row.lower() in {c.lower() for c in docs.columns}:
        row += "_"
    numbered = cut_lineage(docs.withColumn(row, F.monotonically_increasing_id()))
    lengths = [r[0] for r in windows.select("length").distinct().collect()]  # at most WIDTH rows

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()

        def found(number: int, length: int, hashes: np.ndarray) -> pa.RecordBatch:
            hashes = np.unique(hashes).view(np.int64)
            cells = [np.full(len(hashes), number), np.full(len(hashes), length, np.int32), hashes]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in cells], names=["row", "length", "hash"])

        for batch in batches:
            numbers = batch[row].to_pylist()
            for low, _, data, offsets in blocks(batch[text]):
                for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                    for _ in Carried(words, max(lengths) - 1).read(data[a:b], BLOCK_BYTES):
                        for length in lengths:
                            yield found(numbers[low + i], length, words.windows(length))

    met = (
        numbered.select(row, text)
        .mapInArrow(give_back(hashed), "row bigint, length int, hash bigint")
        .join(windows, ["length", "hash"])
        .select("row", "length", "hash", "words", "item")
        .distinct()
    )
    names = docs.columns
    held_rows = met.select(F.col("row").alias("_group"), F.struct("length", "hash", "words", "item").alias("_window"))
    doc_rows = numbered.select(F.col(row).alias("_group"), F.struct(*(F.col(f"`{c}`") for c in names)).alias("_doc"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = held_then_streamed(held_rows, doc_rows, "_group", partitions)

    def one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, own, group = Words(), [], None
        for batch in batches:
            groups = batch["_group"].to_pylist()
            streamed = batch["streamed_row"].to_pylist()
            for i, (number, is_doc) in enumerate(zip(groups, streamed)):
                if number != group:
                    group, own = number, []
                if not is_doc:
                    own.append(batch["_window"][i].as_py())
                    continue
                held = WindowSet(
                    np.array([w["length"] for w in own]), np.array([w["hash"] for w in own], np.int64).view(np.uint64),
                    [bytes(w["words"]) for w in own], [w["item"] for w in own],
                )
                doc = pa.RecordBatch.from_struct_array(batch["_doc"].slice(i, 1))
                yield from emit(doc, scans(words, held, doc[text]))

    return dealt.mapInArrow(give_back(one_by_one), T.StructType(fields))


def contamination(
    docs: DataFrame, items: DataFrame, width: int = WIDTH, id_column: str = "doc_id", max_windows: int = MAX_WINDOWS
) -> DataFrame:
    """Per row of ``docs``: its id, ``n_words``, ``n_hit`` (hit words), ``item_ids`` (sorted as
    strings) and ``spans`` (first and end byte of every run of hit words)."""
    chosen = docs.select(F.col(id_column), F.col("text").cast("string").alias("text"))
    spans = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    fields = [
        chosen.schema[id_column], T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
        T.StructField("item_ids", T.ArrayType(T.StringType())), T.StructField("spans", spans),
    ]
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def emit(batch: pa.RecordBatch, found: Iterable[Scan]) -> Iterator[pa.RecordBatch]:
        n_words, n_hit, ids, places = [], [], [], []
        for scan in found:
            n_words.append(scan.n_words), n_hit.append(scan.n_hit)
            ids.append(sorted(scan.items, key=str.encode))
            places.append([{"start": a, "end": b} for a, b in scan.spans])
        yield pa.RecordBatch.from_arrays(
            [batch[id_column], pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
             pa.array(ids, pa.list_(pa.string())), pa.array(places, span_type)],
            names=[f.name for f in fields],
        )

    return _scanned(chosen, windows_of(items, width), "text", fields, emit, max_windows)


def without_hits(
    docs: DataFrame, items: DataFrame, remove: str = "documents", most_hit: int = 0, width: int = WIDTH,
    max_windows: int = MAX_WINDOWS,
) -> DataFrame:
    """``docs`` with all their columns, cleaned. ``remove="documents"``: rows with more than
    ``most_hit`` hit words go. ``remove="spans"``: the runs of hit words are cut out of the texts (a
    blank takes the place of each); texts without hits stay as they are, byte for byte."""
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    place = docs.columns.index("text")

    def cut(text: str, spans: list[tuple[int, int]]) -> str:
        data, parts, last = text.encode(), [], 0
        for a, b in spans:
            parts.append(data[last:a])
            last = b
        return b" ".join([*parts, data[last:]]).decode()

    def emit(batch: pa.RecordBatch, found: Iterable[Scan]) -> Iterator[pa.RecordBatch]:
        found = list(found)
        if remove == "documents":
            yield batch.filter(pa.array([scan.n_hit <= most_hit for scan in found], pa.bool_()))
        elif any(scan.spans for scan in found):
            texts = [cut(t, scan.spans) if scan.spans else t for t, scan in zip(batch["text"].to_pylist(), found)]
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))
        else:
            yield batch

    return _scanned(docs, windows_of(items, width), "text", list(docs.schema.fields), emit, max_windows)
