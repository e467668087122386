"""N-gram Jaccard join of whole texts with adaptive multi-match prefixes.

A text is the set of its distinct word shingles. All sets are ordered alike: rare shingles first.
A set of n that shares at least m shingles with another meets it in at least k shingles of its first
n - m + k. With k = 1 that is the usual prefix; a longer prefix asks for k shared shingles before a
pair is looked at. Each document takes the k whose estimated cost (entries it meets, and candidates
to verify, at most entries / k) is least, and the prefix for m = ceil(t n), the least that any
partner shares. Two documents compare at the smaller of their two k, in the prefixes for the m of
their two sizes; shingles found in no other document count against what they can share.

How it runs:

1. One scan gives each document its set's size and a 128-bit digest; equal sets are linked by it.
2. A second scan cuts the sets into chunks and sends shingles (48 bits each, sorted) to where their
   document frequency is counted; only shingles found twice or more return to their chunk. A
   document whose rare shingles already fill its prefix is finished here.
3. Links are collected until they connect what they can, cheapest first: every document with one
   document of each prefix shingle, the one with the smallest share of shingles of its own (in a
   group of edited copies, the text they come from), then again with another one where a shingle
   still joins several components. Documents that could still be linked get their prefixes anew,
   from the shingles that meet several components, and all that share some are compared, but only
   across components. In every one of these steps a pair is verified only if it shares as many
   prefix shingles as its smaller k asks for; the first two see only the shingles that chose the
   same document and so may miss a pair, the last one misses none. Components are thus exact while
   copies of one text are never all paired.

Candidates are verified exactly, on the shingles that occur twice or more and the sets' sizes. A
shingle is a 64-bit hash; its upper 48 bits are compared between documents.

Texts of 1 MB or more are hashed in pieces; the hashes of a text are in one task (about 10 bytes for
each of its bytes). Null or empty texts have the empty set and no links. Fewer words than the width make one shingle.
Rows that share a ``doc_id`` are one node of the graph, each row is returned. Columns other than
``doc_id`` and ``text`` are not read; a null ``doc_id`` has its own row and no links.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslink.llm.components import components
from corpuslink.llm.wordhash import WordHasher, blocks, give_back, mix, shingles, white_space
from corpuslink.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_TOKENS = 1_000_000
#: Shingles that one task counts at a time, on average.
GROUP_SHINGLES = 1 << 22
#: Cost of verifying a candidate in units of meeting one entry of an index.
VERIFY_COST = 8.0
LONGEST = 24


def _sets(batches: Iterator[pa.RecordBatch], width: int):
    hasher = WordHasher(white_space())
    for batch in batches:
        ids = batch["doc_id"]
        for low, high, data, offsets in blocks(batch["text"]):
            yield ids[low:high], shingles(*hasher.words(data, offsets), width)


def _digest(tokens: np.ndarray) -> bytes:
    one, two = mix(tokens).sum(dtype=np.uint64), mix(tokens ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return one.tobytes() + two.tobytes()


def set_sizes(docs: DataFrame, width: int = 5) -> DataFrame:
    """``doc_id``, ``n_shingles`` and the ``digest`` of the set (null if it is empty)."""

    @give_back
    def size(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sets in _sets(batches, width):
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_digest(s) if len(s) else None for s in sets], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "digest"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        size, "doc_id bigint, n_shingles bigint, digest binary"
    )


_PARTS = "g int, chunk bigint, docs binary, sizes binary, digests binary, low binary, high binary, place binary"
_BACK = "chunk bigint, docs binary, sizes binary, digests binary, low binary, high binary, place binary, df binary"
_PREFIXES = (
    "doc bigint, digest binary, n int, k int, own int, prefix array<bigint>, place array<int>, low binary, high binary"
)


def _table(rows: list[dict], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = [part.strip().split(" ") for part in schema.split(",")]
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema([(n, kinds[k]) for n, k in fields]))


def _dealt_shingles(docs: DataFrame, width: int, groups: int) -> DataFrame:
    """Chunks of documents cut by shingle: group, chunk, shingles and the document's place. Of equal
    sets in a chunk the smallest id stands for all, so the smallest of all copies is always dealt."""

    @give_back
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        ids, sets, seen, total = [], [], {}, 0

        def cut() -> pa.RecordBatch:
            tokens = np.concatenate(sets) >> np.uint64(16)
            sizes = np.array([len(s) for s in sets], np.uint32)
            place = np.repeat(np.arange(len(sets), dtype=np.uint16), sizes)
            order = np.argsort(tokens, kind="stable")
            tokens, place = tokens[order], place[order]
            high = (tokens >> np.uint64(32)).astype(np.uint16)
            low = tokens.astype(np.uint32)
            edges = np.searchsorted(((tokens >> np.uint64(16)) * np.uint64(groups)) >> np.uint64(32), np.arange(groups + 1)).tolist()
            rows = [
                {"g": g, "chunk": chunk, "low": low[a:b].tobytes(), "high": high[a:b].tobytes(),
                 "place": place[a:b].tobytes()}
                for g, (a, b) in enumerate(zip(edges[:-1], edges[1:])) if b > a
            ]
            head = {"g": (chunk * 7919 + (chunk >> 32)) % groups, "chunk": chunk,
                    "docs": np.array(ids, np.int64).tobytes(), "sizes": sizes.tobytes(),
                    "digests": b"".join(seen)}
            return _table([head, *rows], _PARTS)

        for doc_ids, found in _sets(batches, width):
            for doc_id, tokens in zip(doc_ids.to_pylist(), found):
                if not len(tokens) or doc_id is None:
                    continue
                place = seen.setdefault(_digest(tokens), len(ids))
                if place < len(ids):  # equal sets are linked by their digest
                    ids[place] = min(ids[place], doc_id)
                    continue
                ids.append(doc_id)
                sets.append(tokens)
                total += len(tokens)
                if total >= CHUNK_TOKENS or len(ids) == 1 << 16:
                    yield cut()
                    ids, sets, seen, total, chunk = [], [], {}, 0, chunk + 1
        if ids:
            yield cut()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(deal, _PARTS)


def _join_bytes(column: pa.ChunkedArray, dtype: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def _repeated(table: pa.Table) -> pa.Table:
    """Of one group: for each chunk its shingles that occur in two documents or more."""
    heads = table.filter(table["docs"].is_valid())
    rows = [r | {"df": None} for r in heads.select(["chunk", "docs", "sizes", "digests"]).to_pylist()]
    body = table.filter(table["low"].is_valid())
    if body.num_rows:
        low = _join_bytes(body["low"], np.uint32)
        tokens = (_join_bytes(body["high"], np.uint16).astype(np.uint64) << np.uint64(32)) | low
        counts = [len(x) // 4 for x in body["low"].to_pylist()]
        row = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        place = _join_bytes(body["place"], np.uint16)
        order = np.argsort(tokens, kind="stable")
        ordered = tokens[order]
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        size = np.diff(np.append(first, len(ordered)))
        df = np.repeat(size, size)
        keep = df > 1
        order, ordered, df = order[keep], ordered[keep], np.minimum(df[keep], 65535).astype(np.uint16)
        row, place = row[order], place[order]
        by_row = np.argsort(row, kind="stable")
        edges = np.searchsorted(row[by_row], np.arange(len(counts) + 1)).tolist()
        for chunk, a, b in zip(body["chunk"].to_pylist(), edges[:-1], edges[1:]):
            if b > a:
                own = by_row[a:b]
                rows.append(
                    {"chunk": chunk, "low": ordered[own].astype(np.uint32).tobytes(),
                     "high": (ordered[own] >> np.uint64(32)).astype(np.uint16).tobytes(),
                     "place": place[own].tobytes(), "df": df[own].tobytes()}
                )
    return pa.Table.from_batches([_table(rows, _BACK)])


def prefix_length(df: np.ndarray, n: int, percent: int) -> tuple[int, int, int]:
    """For the ascending frequencies of a set's repeated shingles: the k of least estimated cost,
    how many of them its prefix for k holds, and how many the prefix for 1 does. The cost is that
    of partners of its own size, which share more than the least."""
    least = -(-n * percent // 100)
    unique = n - len(df)
    base = n - least + 1 - unique
    if base <= 0:
        return 1, 0, 0
    ks = np.arange(1, min(LONGEST, least) + 1)
    alike = n + 2 * n * -percent // (100 + percent) - unique  # repeated shingles of that prefix less k
    entries = np.concatenate([[0], np.cumsum(df.astype(np.int64) - 1)])[np.clip(alike + ks, 0, len(df))]
    k = int(ks[np.argmin(entries * (1.0 + VERIFY_COST / ks))])
    return k, base - 1 + k, base


def _prefixes(percent: int):
    def choose(table: pa.Table) -> pa.Table:
        head = table.filter(table["docs"].is_valid()).to_pylist()[0]
        docs, sizes = np.frombuffer(head["docs"], np.int64), np.frombuffer(head["sizes"], np.uint32)
        body = table.filter(table["low"].is_valid())
        tokens = _join_bytes(body["low"], np.uint32).astype(np.uint64)
        tokens |= _join_bytes(body["high"], np.uint16).astype(np.uint64) << np.uint64(32)
        place, df = _join_bytes(body["place"], np.uint16), _join_bytes(body["df"], np.uint16)
        order = np.lexsort((tokens, df, place))
        tokens, df = tokens[order], df[order]
        edges = np.searchsorted(place[order], np.arange(len(docs) + 1)).tolist()
        out: dict[str, list] = {name: [] for name in ("doc", "digest", "n", "k", "own", "prefix", "place", "low", "high")}
        for i, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
            n = int(sizes[i])
            k, long, base = prefix_length(df[a:b], n, percent)
            if not base:
                continue
            own = np.sort(tokens[a:b])
            unique = n - (b - a)  # these come first in the order
            for name, value in zip(
                out,
                (int(docs[i]), head["digests"][16 * i : 16 * i + 16], n, k, unique, tokens[a : a + long].astype(np.int64),
                 np.arange(unique, unique + long, dtype=np.int32),
                 own.astype(np.uint32).tobytes(), (own >> np.uint64(32)).astype(np.uint16).tobytes()),
            ):
                out[name].append(value)
        kinds = (pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary())
        return pa.table({name: pa.array(v, kind) for (name, v), kind in zip(out.items(), kinds)})

    return choose


def _refined(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Entries of documents that are still to be compared across components (``doc``,
    ``component``), with prefixes chosen anew: only a shingle that meets several components can be
    shared by a pair, all others of a set count as its own."""

    @give_back
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                low = np.frombuffer(batch["low"][i].as_py(), np.uint32)
                high = np.frombuffer(batch["high"][i].as_py(), np.uint16).astype(np.int64)
                same = lambda c: pa.array(np.full(len(low), batch[c][i].as_py()))
                yield pa.RecordBatch.from_arrays(
                    [same("set"), same("doc"), same("n"), same("component"), pa.array((high << 32) | low)],
                    names=["set", "doc", "n", "component", "token"],
                )

    held = (
        sets.join(members, "doc")
        .select(F.xxhash64("doc", "n", "low").alias("set"), "doc", "n", "component", "low", "high")
        .mapInArrow(each, "set bigint, doc bigint, n bigint, component bigint, token bigint")
    )
    held = cut_lineage(held)
    several = (
        held.groupBy("token")
        .agg(F.count("*").alias("df"), F.min("component").alias("a"), F.max("component").alias("b"))
        .where("a < b")
    )
    # One row per document, as long as its own set.
    shared = (
        held.join(several.select("token", "df"), "token")
        .groupBy("set", "doc", "n", "component")
        .agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("shared"))
        .select("doc", "n", "component", "shared.df", "shared.token")
    )

    @give_back
    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                k, long, _ = prefix_length(np.array(r["df"], np.int64), r["n"], percent)
                own = r["n"] - len(r["df"])
                rows += [
                    {"doc": r["doc"], "n": r["n"], "component": r["component"], "k": k, "own": own, "token": t, "place": own + i}
                    for i, t in enumerate(r["token"][:long])
                ]
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = pa.schema([(c, pa.int64()) for c in ("doc", "n", "component", "k", "own", "token", "place")])
    return cut_lineage(shared.mapInArrow(choose, ", ".join(f"{c} bigint" for c in schema.names)))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the distinct pairs (``a``, ``b``) that are similar enough."""
    left = sets.select(F.col("doc").alias("a"), F.col("n").alias("na"), F.col("low").alias("la"), F.col("high").alias("ha"))
    right = sets.select(F.col("doc").alias("b"), F.col("n").alias("nb"), F.col("low").alias("lb"), F.col("high").alias("hb"))

    def tokens(low: bytes, high: bytes) -> np.ndarray:
        return (np.frombuffer(high, np.uint16).astype(np.uint64) << np.uint64(32)) | np.frombuffer(low, np.uint32)

    @give_back
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for na, la, ha, nb, lb, hb in zip(*(batch[c].to_pylist() for c in ("na", "la", "ha", "nb", "lb", "hb"))):
                both = np.sort(np.concatenate([tokens(la, ha), tokens(lb, hb)]))
                shared = int((both[1:] == both[:-1]).sum())
                keep.append((100 + percent) * shared >= percent * (na + nb))
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept["a"], kept["b"]], names=["a", "b"])

    return pairs.join(left, "a").join(right, "b").mapInArrow(check, "a bigint, b bigint")


def _needed(percent: int):
    """Shingles a pair of these sizes has to share."""
    return F.ceil(percent * (F.col("na") + F.col("nb")) / (100 + percent))


def _can_share(percent: int):
    """A pair can share no more shingles than either has beyond those of its own."""
    need = _needed(percent)
    return (F.col("na") - F.col("owna") >= need) & (F.col("nb") - F.col("ownb") >= need)


def _multi_match(met: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (``a``, ``b``) that share as many prefix shingles as the smaller k of the two
    asks for. ``met`` has a row per pair and shingle, with ``n``, ``k``, ``own`` and ``place`` of both."""
    k, need = F.least("ka", "kb"), _needed(percent)
    return (
        met.where(_can_share(percent))
        .where((F.col("placea") < F.col("na") - need + k) & (F.col("placeb") < F.col("nb") - need + k))
        .groupBy("a", "b", k.alias("k"))
        .agg(F.count("*").alias("shared"))
        .where("shared >= k")
        .select("a", "b")
    )


def _matched(entries: DataFrame, percent: int) -> DataFrame:
    """:func:`_multi_match` of every document with the ``centre`` of each of its prefix shingles. Each
    shingle of a pair counts once, whichever of the two was the other's centre."""
    parts = ("n", "k", "own", "place")
    first = F.col("doc") < F.col("centre.doc")
    pick = lambda x, y: F.when(first, x).otherwise(y)
    met = entries.where("doc <> centre.doc").select(
        pick(F.col("doc"), F.col("centre.doc")).alias("a"),
        pick(F.col("centre.doc"), F.col("doc")).alias("b"),
        *[pick(F.col(p), F.col(f"centre.{p}")).alias(f"{p}a") for p in parts],
        *[pick(F.col(f"centre.{p}"), F.col(p)).alias(f"{p}b") for p in parts],
    )
    return _multi_match(met, percent)


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Components of ``labels`` with further links between them, if there are any."""
    if links.isEmpty():
        return labels
    known = labels.where("id <> component").select(F.col("id").alias("a"), F.col("component").alias("b"))
    return cut_lineage(components(known.union(links)))


def similar_documents(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every row of ``docs``: the smallest id
    reachable through pairs of Jaccard similarity ``percent`` / 100 or more."""
    spark = docs.sparkSession
    marks = cut_lineage(set_sizes(docs, width))
    # Stored, so that the join back is one of plain shuffles, in which the runtime can split a
    # large group of copies.
    equal = cut_lineage(
        marks.where("digest is not null and doc_id is not null")
        .groupBy("digest", "n_shingles")
        .agg(F.min("doc_id").alias("b"), F.count("*").alias("copies"))
        .where("copies > 1")
    )
    copies = cut_lineage(
        marks.join(equal, ["digest", "n_shingles"])
        .where("doc_id <> b")
        .select(F.col("doc_id").alias("a"), "b", "digest")
        .distinct()
    )

    # As many groups as the shingles need, and no fewer than keep all tasks busy.
    total = marks.agg(F.sum("n_shingles")).first()[0] or 0
    groups = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // GROUP_SHINGLES))
    returned = _dealt_shingles(docs, width, groups).groupBy("g").applyInArrow(_repeated, _BACK)
    sets = cut_lineage(returned.groupBy("chunk").applyInArrow(_prefixes(percent), _PREFIXES))
    # A prefix shingle met by one document alone links nothing.
    # The smallest id of a set stands for its copies; another set of the same id is no copy.
    copied = copies.select(F.col("a").alias("doc"), "digest")
    entries = sets.join(copied, ["doc", "digest"], "left_anti").select(
        "doc", "n", "k", "own", F.explode(F.arrays_zip("prefix", "place")).alias("e")
    ).select("doc", "n", "k", "own", F.col("e.prefix").alias("token"), F.col("e.place").alias("place"))
    most_shared = F.min_by(
        F.struct("doc", "n", "k", "own", "place"),
        F.floor(1000 * F.col("own") / F.col("n")) + F.pmod(F.xxhash64("doc"), F.lit(1 << 40)) / float(1 << 40),
    )
    met = (
        entries.groupBy("token")
        .agg(F.min("doc").alias("low"), F.max("doc").alias("high"), most_shared.alias("centre"))
        .where("low < high")
    )
    entries = cut_lineage(entries.join(met.select("token", "centre"), "token"))
    one_each = _matched(entries, percent)
    links = cut_lineage(copies.select("a", "b").distinct().union(_verified(one_each, sets, percent)))
    labels = cut_lineage(components(links))

    def across() -> DataFrame:
        """Entries of shingles that still meet several components."""
        own = (
            entries.drop("centre")
            .join(labels.withColumnRenamed("id", "doc"), "doc", "left")
            .withColumn("component", F.coalesce("component", "doc"))
        )
        several = (
            own.groupBy("token")
            .agg(
                F.min("component").alias("low"),
                F.max("component").alias("high"),
                F.min_by(F.struct("doc", "n", "k", "own", "place", "component"), F.xxhash64("doc", "token")).alias("centre"),
            )
            .where("low < high")
        )
        return own.join(several.select("token", "centre"), "token")

    left = cut_lineage(across())
    again = _matched(left.where("component <> centre.component"), percent)
    labels = _joined(labels, cut_lineage(_verified(again, sets, percent)))

    rest = _refined(across().select("doc", "component").distinct(), sets, percent)
    side = lambda x: rest.select(
        "token", F.col("doc").alias(x), F.col("n").alias(f"n{x}"), F.col("k").alias(f"k{x}"),
        F.col("own").alias(f"own{x}"), F.col("place").alias(f"place{x}"), F.col("component").alias(f"component{x}"),
    )
    met = side("a").join(side("b"), "token").where((F.col("a") < F.col("b")) & (F.col("componenta") != F.col("componentb")))
    pairs = _multi_match(met, percent)
    labels = _joined(labels, cut_lineage(_verified(pairs, sets, percent)))
    return (
        marks.select("doc_id", "n_shingles")
        .join(labels.withColumnRenamed("id", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    )


def without_near_copies(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with the rows of the smallest id of each component, with all its columns. Rows
    without an id stay."""
    found = similar_documents(docs, width, percent)
    gone = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
