"""Resharding by minimum-cost flow: the fewest bytes move from old shards to new capacities.

Documents fall into blocks by the hash of their text, so equal texts share a block. Block sizes are
counted on the cluster; at most ``old shards x blocks x parts`` sums reach the driver, where a flow
from old shard sizes to new capacities (a byte that stays costs nothing, one that moves costs one)
says how much each shard sends where, and blocks are picked to follow it. A block larger than a
shard may hold is dealt out by its parts (split by ``doc_id``). Rows are numbered within parts, so
no task numbers a whole shard.

A :class:`Layout` keeps shards as files. Every row has a key of its own, told when it is first
written, so null and repeated ids are rows like others. Resharding writes the shards that lose or
gain rows anew, without moving a text through a shuffle, then a list that says for each shard which
files are live; a shard that loses all its rows is no longer listed. Until that list is complete the
old one holds, so a run cut off half-way changes nothing. Files that are live in no list any more are
then removed.

The size of a document is the UTF-8 length of its text plus one; a null text counts as none, its
checksum is that of the empty text. Repeated rows each get a place. Placing reads ``doc_id`` and
``text`` alone; files keep all columns (``row_key`` and ``shard`` must not be among them). An empty
table gives no rows.
"""

from __future__ import annotations

import heapq
from collections import defaultdict, deque

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslink.session import cut_lineage, discard, list_folders

BLOCKS = 128
PARTS = 16


def minimum_cost_flow(sizes: list[int], capacities: list[int], cost) -> dict[tuple[int, int], int]:
    """Bytes from each old shard to each new one, of least total ``cost(i, j)`` per byte, by
    successive shortest augmenting paths. The capacities must hold all sizes."""
    n, m = len(sizes), len(capacities)
    source, sink = n + m, n + m + 1
    to, room, price, out = [], [], [], defaultdict(list)

    def arc(a: int, b: int, most: int, per: int) -> None:
        for x, y, r, p in ((a, b, most, per), (b, a, 0, -per)):
            out[x].append(len(to))
            to.append(y), room.append(r), price.append(p)

    for i, size in enumerate(sizes):
        arc(source, i, size, 0)
        for j in range(m):
            arc(i, n + j, size, cost(i, j))
    for j, capacity in enumerate(capacities):
        arc(n + j, sink, capacity, 0)
    while True:
        best, via, queue = {source: 0}, {}, deque([source])
        while queue:
            a = queue.popleft()
            for e in out[a]:
                if room[e] and best[a] + price[e] < best.get(to[e], 1 << 62):
                    best[to[e]], via[to[e]] = best[a] + price[e], e
                    queue.append(to[e])
        if sink not in via:
            break
        path, at = [], sink
        while at != source:
            path.append(via[at])
            at = to[via[at] ^ 1]
        much = min(room[e] for e in path)
        for e in path:
            room[e] -= much
            room[e ^ 1] += much
    if sum(room[e] for e in out[source]):
        raise ValueError("the new shards cannot hold all bytes")
    return {
        (i, j): room[e ^ 1] for i in range(n) for e in out[i] if e % 2 == 0 and room[e ^ 1] for j in [to[e] - n]
    }


def follow_flow(
    blocks: dict[tuple, int], flow: dict[tuple[int, int], int], capacities: list[int]
) -> dict[tuple, int]:
    """New shard of every block ``(old, ...)``: largest first, each to the shard that still lacks
    most of what the flow owes it; then blocks move from the fullest to the emptiest shard as long
    as that evens them out."""
    owed = defaultdict(list)
    for (i, j), much in flow.items():
        heapq.heappush(owed[i], (-much, i != j, j))
    load, held, where = [0] * len(capacities), defaultdict(set), {}
    for block, size in sorted(blocks.items(), key=lambda b: (-b[1], b[0])):
        much, moves, j = heapq.heappop(owed[block[0]]) if owed[block[0]] else (0, True, 0)
        where[block] = j
        load[j] += size
        held[j].add(block)
        heapq.heappush(owed[block[0]], (much + size, moves, j))
    for _ in range(20 * len(capacities)):
        over = [load[j] - capacities[j] for j in range(len(capacities))]
        full, empty = over.index(max(over)), over.index(min(over))
        gap = over[full] - over[empty]
        fits = [b for b in held[full] if 0 < blocks[b] < gap]
        if not fits:
            break
        block = min(fits, key=lambda b: (abs(2 * blocks[b] - gap), b))
        held[full].remove(block)
        held[empty].add(block)
        load[full] -= blocks[block]
        load[empty] += blocks[block]
        where[block] = empty
    return where


def document_sizes(docs: DataFrame, old_shards: int) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32`` and the ``old_shard`` of a layout by the text's hash."""
    text = F.coalesce("text", F.lit(""))
    digest = F.xxhash64(text)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(digest, F.lit(old_shards)).cast("int").alias("old_shard"),
        F.pmod(F.xxhash64(digest), F.lit(BLOCKS)).cast("int").alias("block"),
    )


def _unit_columns() -> list[Column]:
    return [F.col("old_shard"), F.col("block"), F.pmod(F.xxhash64("doc_id"), F.lit(PARTS)).cast("int").alias("part")]


UNIT = ["old_shard", "block", "part"]


def plan_units(sized: DataFrame, old_shards: int, new_shards: int) -> list[tuple[int, int, int, int, int, int]]:
    """``(old_shard, block, part, shard, first_slot, n)`` of every unit of rows when ``old_shards``
    become ``new_shards``. ``sized`` has ``doc_id``, ``size``, ``old_shard`` and ``block``. Shards
    numbered alike are the same place. At most ``old_shards * BLOCKS * PARTS`` rows."""
    units = [
        (tuple(r[:3]), r[3], r[4])
        for r in sized.select("size", *_unit_columns()).groupBy(*UNIT).agg(F.sum("size"), F.count("*")).orderBy(*UNIT).collect()
    ]
    total = sum(size for _, size, _ in units)
    capacities = [total // new_shards + (j < total % new_shards) for j in range(new_shards)]
    of_block: dict[tuple, int] = defaultdict(int)
    for u, size, _ in units:
        of_block[u[:2]] += size
    pieces: dict[tuple, int] = defaultdict(int)
    for u, size, _ in units:
        pieces[u[:2] if of_block[u[:2]] <= capacities[-1] else u] += size
    old_sizes = [0] * old_shards
    for piece, size in pieces.items():
        old_sizes[piece[0]] += size
    flow = minimum_cost_flow(old_sizes, capacities, lambda i, j: int(i != j))
    where = follow_flow(pieces, flow, capacities)
    filled, places = [0] * new_shards, []
    for u, _, n in units:
        shard = where[u[:2]] if u[:2] in where else where[u]
        places.append((*u, shard, filled[shard], n))
        filled[shard] += n
    return places


def _placed(sized: DataFrame, places: list[tuple], order: list[str]) -> DataFrame:
    """``sized`` with ``shard`` and ``slot``: rows are numbered in their unit."""
    spark = sized.sparkSession
    # As many places as units: bounded by the three parameters, so every task may have them all.
    table = spark.createDataFrame(
        [p[:5] for p in places], "old_shard int, block int, part int, shard int, first_slot long"
    )
    numbered = Window.partitionBy(*UNIT).orderBy(*order)
    return (
        sized.withColumn("part", _unit_columns()[2])
        .withColumn("_n", F.row_number().over(numbered) - 1)
        .join(F.broadcast(table), UNIT)
        .withColumn("slot", F.col("first_slot") + F.col("_n"))
        .drop("_n", "first_slot", "part")
    )


def reshard(sized: DataFrame, old_shards: int, new_shards: int) -> DataFrame:
    """``sized`` (``doc_id``, ``size``, ``old_shard``, ``block``) with ``shard`` and ``slot``. It is
    read twice, so it should be a stored table."""
    return _placed(sized, plan_units(sized, old_shards, new_shards), ["doc_id"])


def reshard_documents(docs: DataFrame, old_shards: int, new_shards: int) -> DataFrame:
    """Shard and slot of every document when ``old_shards`` become ``new_shards``."""
    return reshard(cut_lineage(document_sizes(docs, old_shards)), old_shards, new_shards)


class Layout:
    """Shards of documents as files below ``folder``.

    ``files=V/shard=N`` holds rows, ``slots=V`` their shard and slot by ``row_key``, and ``live=V`` the
    list: for every shard the version of its files. The newest complete list counts."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _versions(self, kind: str) -> list[int]:
        names = list_folders(self.spark, self.folder, done=True)
        return sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{kind}="))

    def live(self) -> dict[int, int]:
        """Version of the files of every shard."""
        version = max(self._versions("live"), default=None)
        if version is None:
            return {}
        found = self.spark.read.schema("shard int, version int").parquet(f"{self.folder}/live={version}")
        return {r[0]: r[1] for r in found.collect()}  # a row per shard

    def _commit(self, version: int, live: dict[int, int]) -> None:
        table = self.spark.createDataFrame(sorted(live.items()), "shard int, version int")
        table.coalesce(1).write.parquet(f"{self.folder}/live={version}")
        for old in self._versions("live"):
            if old < version:
                discard(self.spark, f"{self.folder}/live={old}")
                discard(self.spark, f"{self.folder}/slots={old}")
        for old in self._versions("files"):
            for shard in list_folders(self.spark, f"{self.folder}/files={old}"):
                if live.get(int(shard.partition("=")[2])) != old:
                    discard(self.spark, f"{self.folder}/files={old}/{shard}")
            if old not in live.values():
                discard(self.spark, f"{self.folder}/files={old}")

    def write(self, docs: DataFrame, shards: int) -> None:
        """A first layout: every row in the shard of its text's hash."""
        version = max(self._versions("live"), default=-1) + 1
        rows = docs.withColumn("row_key", F.monotonically_increasing_id())
        rows = rows.withColumn("shard", F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(shards)).cast("int"))
        path = f"{self.folder}/files={version}"
        rows.write.mode("overwrite").partitionBy("shard").parquet(path)
        held = self.spark.read.schema(_with_shard(docs.schema)).parquet(path)
        sized = cut_lineage(self._sized(held))
        places = [(*u[:3], u[0], first, n) for u, first, n in _own_places(sized)]
        slots = _placed(sized, places, ["doc_id", "row_key"]).select("row_key", "shard", "slot")
        slots.write.mode("overwrite").parquet(f"{self.folder}/slots={version}")
        self._commit(version, {p[3]: version for p in places})

    @staticmethod
    def _sized(rows: DataFrame) -> DataFrame:
        text = F.coalesce("text", F.lit(""))
        return rows.select(
            "row_key",
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
            F.col("shard").alias("old_shard"),
            F.pmod(F.xxhash64(F.xxhash64(text)), F.lit(BLOCKS)).cast("int").alias("block"),
        )

    def _files(self, schema: T.StructType, shards: list[int] | None = None) -> DataFrame:
        """Rows of the live files (of some shards)."""
        found = None
        live = {s: v for s, v in self.live().items() if shards is None or s in shards}
        for version in sorted(set(live.values())):
            part = self.spark.read.schema(schema).parquet(f"{self.folder}/files={version}")
            part = part.where(F.col("shard").isin([s for s, v in live.items() if v == version]))
            found = part if found is None else found.unionByName(part)
        return self.spark.createDataFrame([], schema) if found is None else found

    def read(self, schema: T.StructType) -> DataFrame:
        """All rows (``schema``, without the layout's own columns) with ``row_key`` and ``shard``."""
        return self._files(_with_shard(schema))

    def slots(self) -> DataFrame:
        """``(row_key, shard, slot)`` of all rows."""
        version = max(self._versions("live"), default=None)
        schema = "row_key bigint, shard int, slot bigint"
        if version is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/slots={version}")

    def reshard(self, schema: T.StructType, new_shards: int) -> list[int]:
        """Change to ``new_shards`` shards and return the numbers of those written anew or emptied."""
        live = self.live()
        old_shards = max(live, default=-1) + 1
        if not live:
            return []
        version = max(self._versions("live")) + 1
        sized = cut_lineage(self._sized(self.read(schema)))
        places = plan_units(sized, max(old_shards, 1), new_shards)
        moving = [p for p in places if p[0] != p[3]]
        affected = sorted({s for p in moving for s in (p[0], p[3])})
        # The rows of affected shards; their unit tells where they go, so no text is shuffled.
        table = self.spark.createDataFrame([p[:4] for p in places], "old_shard int, block int, part int, new_shard int")
        rows = self._files(_with_shard(schema), affected)
        text = F.coalesce("text", F.lit(""))
        unit = [
            F.col("shard").alias("old_shard"),
            F.pmod(F.xxhash64(F.xxhash64(text)), F.lit(BLOCKS)).cast("int").alias("block"),
            F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(PARTS)).cast("int").alias("part"),
        ]
        names = [*schema.names, "row_key"]
        moved = rows.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("_row"), *unit).join(F.broadcast(table), UNIT)
        kept = [F.col("_row")[c].alias(c) for c in names]
        moved.select(*kept, F.col("new_shard").alias("shard")).write.mode("overwrite").partitionBy("shard").parquet(
            f"{self.folder}/files={version}"
        )
        slots = _placed(sized, places, ["doc_id", "row_key"]).select("row_key", "shard", "slot")
        slots.write.mode("overwrite").parquet(f"{self.folder}/slots={version}")
        filled = {p[3] for p in places}
        self._commit(version, {s: version if s in affected else live[s] for s in filled})
        return affected


def _with_shard(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("row_key", T.LongType()), T.StructField("shard", T.IntegerType())])


def _own_places(sized: DataFrame) -> list[tuple[tuple, int, int]]:
    """Units in order with their first slot when every row stays in its shard, and their rows."""
    filled: dict[int, int] = defaultdict(int)
    out = []
    for r in sized.select(*_unit_columns()).groupBy(*UNIT).count().orderBy(*UNIT).collect():
        out.append((tuple(r[:3]), filled[r[0]], r[3]))
        filled[r[0]] += r[3]
    return out
